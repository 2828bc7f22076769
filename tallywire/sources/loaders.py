"""Typed loading of the two base tables from CSV or Parquet, and split selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallywire import names


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_I, _L, _S = T.IntegerType(), T.LongType(), T.StringType()

# Time columns are declared as text: some rows hold "0" instead of a time.
EVENT_SCHEMA = _schema(
    ("attack_id", _L), ("card", _S), ("victim", _S), ("port", _I), ("attack_code", _S),
    ("detect_count", _I), ("packet_speed", _L), ("data_speed", _L), ("avg_packet_len", _I),
    ("avg_source_ip_count", _I), ("start_time", _S), ("end_time", _S), ("type", _S),
)
COMPONENT_SCHEMA = _schema(
    ("attack_id", _L), ("detect_count", _I), ("card", _S), ("victim", _S), ("port", _I),
    ("attack_code", _S), ("packet_speed", _L), ("data_speed", _L), ("avg_packet_len", _I),
    ("source_ip_count", _I), ("time", _S),
)
SCHEMAS = {"events": EVENT_SCHEMA, "components": COMPONENT_SCHEMA}
TIME_COLUMNS = {"events": ["start_time", "end_time"], "components": ["time"]}


def lenient_timestamp(column: str) -> F.Column:
    """Text to timestamp; anything that is no time becomes NULL."""
    return F.try_to_timestamp(F.col(column)).cast("timestamp_ntz")


def csv_path(root: str, set_name: str, kind: str) -> str:
    return f"{root}/traffic_{set_name}_{kind}.csv"


def stored_csv(spark: SparkSession, root: str, set_name: str, kind: str) -> str:
    """The plain file of a set, or the gzip one if only that exists."""
    plain = csv_path(root, set_name, kind)
    return f"{plain}.gz" if not path_exists(spark, plain) and path_exists(spark, f"{plain}.gz") else plain


def read_csv(spark: SparkSession, root: str, kind: str, sets: list[str]) -> DataFrame:
    """CSV files (plain or gzip) of some sets as one typed table tagged with the set.

    Columns are found by the names in each file's header, in any order; a missing one is an error, further ones are left out.
    """
    parts = {s: _by_header(spark, stored_csv(spark, root, s, kind), SCHEMAS[kind]) for s in sets}
    return tagged_union(parts).withColumns({c: lenient_timestamp(c) for c in TIME_COLUMNS[kind]})


def _by_header(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def tagged_union(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables of several sets in one, each row tagged with its set."""
    tagged = [df.withColumn("set_name", F.lit(name)) for name, df in tables.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def load_split(spark: SparkSession, root: str, kind: str, split: str) -> DataFrame:
    """One split of one table: from Parquet if it was written, else from CSV.

    The Parquet layout has ``split`` as a partition column, so only its files are read.
    """
    if split not in names.SPLIT_SETS:
        raise ValueError(f"unknown split {split!r}; one of {list(names.SPLIT_SETS)}")
    stored = f"{root}/parquet/{kind}"
    if path_exists(spark, f"{stored}/split={split}"):
        return spark.read.parquet(stored).filter(F.col("split") == split)
    return read_csv(spark, root, kind, names.SPLIT_SETS[split]).withColumn("split", F.lit(split))


def load_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All six tables, keyed ``<split>_<kind>``."""
    return {
        f"{split}_{kind}": load_split(spark, root, kind, split)
        for split in names.SPLIT_SETS for kind in ("components", "events")
    }
