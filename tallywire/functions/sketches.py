"""Mergeable sketches per time bucket: distinct sources and quantiles that are kept between runs and never need old rows again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: 2**14 registers: a standard error of 0.8 %, 16 KB at most for each bucket.
SOURCE_BITS = 14
#: Items a quantile sketch keeps at its lowest level: ranks are off by 0.4 % or less.
QUANTILE_ITEMS = 800


def source_sketches(sightings: DataFrame, bucket_s: float, source: str = "src", at: str = "offset_s", bits: int = SOURCE_BITS) -> DataFrame:
    """(bucket, sketch) of the sources seen in each bucket; sketches are combined before the shuffle. NULL sources do not count."""
    bucket = F.floor(F.col(at) / bucket_s).alias("bucket")
    return sightings.groupBy(bucket).agg(F.hll_sketch_agg(F.col(source).cast("string"), F.lit(bits)).alias("sketch"))


def merged_sources(kept: DataFrame, *by: str) -> DataFrame:
    """One sketch for all that share ``by``."""
    return kept.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def sources_in_buckets(kept: DataFrame) -> DataFrame:
    return merged_sources(kept, "bucket").select("bucket", F.hll_sketch_estimate("sketch").alias("sources"))


def estimated_sources(kept: DataFrame, ranges: DataFrame, bucket_s: float) -> DataFrame:
    """About how many distinct sources the buckets that overlap each range [t0, t1) saw; the exact form is
    ``capture.sources_in_ranges``."""
    first, last = F.floor(F.col("t0") / bucket_s), F.ceil(F.col("t1") / bucket_s) - 1
    listed = ranges.filter("t1 > t0").select("range_id", F.explode(F.sequence(first, last)).alias("bucket"))
    found = listed.join(merged_sources(kept, "bucket"), "bucket").groupBy("range_id").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sources"))
    return ranges.join(found, "range_id", "left").withColumn("sources", F.coalesce("sources", F.lit(0)))


def kept_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all runs."""
    return spark.read.schema("bucket bigint, sketch binary").parquet(path)


def quantile_sketches(df: DataFrame, by: list[str], columns: dict[str, Column], items: int = QUANTILE_ITEMS) -> DataFrame:
    """One sketch per column and group, such as a file or a day. NULLs do not count."""
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(c.cast("double"), F.lit(items)).alias(n) for n, c in columns.items()])


def sketched_quantiles(kept: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """(name, value, n) of the merged sketches: ``value`` has about the wanted rank among all n values, none of which is read again.
    A column without values has no row.

    The exact form, and the default for caps, is ``quantiles.quantile_table``.
    """
    whole = kept.agg(*[F.kll_merge_agg_double(c).alias(c) for c in wanted])
    size, value = F.kll_sketch_get_n_double, F.kll_sketch_get_quantile_double
    return whole.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.when(size(c) > 0, value(c, F.lit(q))).alias("value"), size(c).alias("n"))
        for c, q in wanted.items()])).alias("r")).select("r.*").filter("n > 0")
