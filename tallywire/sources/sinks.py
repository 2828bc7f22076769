"""Writers for tables, fitted thresholds and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tallywire.operators.cleaning import Thresholds
from tallywire.sources.loaders import csv_path

_CAPS = T.MapType(T.StringType(), T.DoubleType())
THRESHOLD_SCHEMA = T.StructType([
    T.StructField("event_caps", _CAPS), T.StructField("component_caps", _CAPS),
    T.StructField("event_avg_pkt_len_median", T.DoubleType()),
    T.StructField("component_avg_pkt_len_median", T.DoubleType()),
    T.StructField("cap_quantile", T.DoubleType()),
])


def save_parquet(df: DataFrame, root: str, kind: str) -> str:
    """Zstd Parquet partitioned by split; an existing table is left alone."""
    path = f"{root}/parquet/{kind}"
    df.write.partitionBy("split").option("compression", "zstd").mode("ignore").parquet(path)
    return path


def save_csv_set(df: DataFrame, root: str, set_name: str, kind: str) -> str:
    """One set as gzip CSV with a header."""
    path = csv_path(root, set_name, kind)
    df.write.option("header", True).option("compression", "gzip").mode("overwrite").csv(path)
    return path


def save_bucketed(df: DataFrame, table: str, buckets: int, key: str = "attack_id") -> None:
    """A catalogue table bucketed on the join key, so later joins need no shuffle.

    Rows are first laid out by bucket, so each bucket is one file.
    """
    laid_out = df.repartition(buckets, key)
    laid_out.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet").saveAsTable(table)


def save_thresholds(spark: SparkSession, fitted: Thresholds, path: str) -> None:
    d = fitted.as_dict()
    row = tuple(d[f.name] for f in THRESHOLD_SCHEMA.fields)
    spark.createDataFrame([row], THRESHOLD_SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def load_thresholds(spark: SparkSession, path: str) -> Thresholds:
    row = spark.read.schema(THRESHOLD_SCHEMA).json(path).first()
    return Thresholds(**row.asDict())


def save_metrics(df: DataFrame, path: str) -> None:
    """A result table (models x classes rows, so small) as one CSV file with a header."""
    df.coalesce(1).write.option("header", True).mode("overwrite").csv(path)


__all__ = ["path_exists", "save_parquet", "save_csv_set", "save_bucketed", "save_thresholds",
           "load_thresholds", "save_metrics"]
