"""Row numbers, running sums and lags over groups of any size.

Groups of bounded size use a plain window. If any group is larger, the rows are range-partitioned
by group and order, the partition number is pinned by a checkpoint, windows run inside
(group, partition), and the totals of the earlier partitions are added. One huge
group is thus spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywire.functions.quantiles import matching
from tallywire.session import fits_one_task, group_row_limit, materialize


def bounded_groups(df: DataFrame, groups: list[str], limit: int | None = None) -> bool:
    """Whether a task may hold any one group of ``df``: only counts of rows per group are shuffled."""
    bound = group_row_limit(df.sparkSession) if limit is None else limit
    if fits_one_task(df, bound):
        return True
    return bool(groups) and df.groupBy(*groups).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > bound).isEmpty()


def ordered(
    df: DataFrame,
    groups: list[str],
    order: list[Column],
    rank: str = "rn",
    sums: dict[str, Column] | None = None,
    limit: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Add a 1-based row number and running sums up to and including each row.

    ``order`` must be total inside a group. A known upper bound of the rows in any group
    (``at_most``) can save counting them.
    """
    sums = sums or {}
    bound = group_row_limit(df.sparkSession) if limit is None else limit
    if (at_most is not None and at_most <= bound) or bounded_groups(df, groups, bound):
        return _windowed(df, groups, order, rank, sums)

    work = df.select("*", *[c.alias(f"_v_{n}") for n, c in sums.items()])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = work.repartitionByRange(parts, *[F.col(g) for g in groups], *order)
    pinned = materialize(ranged.withColumn("_part", F.spark_partition_id()))
    local = _windowed(pinned, groups + ["_part"], order, "_local", {n: F.col(f"_v_{n}") for n in sums})

    block_totals = pinned.groupBy(*groups, "_part").agg(
        F.count("*").alias("_rows"), *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums]
    )
    earlier = (
        Window.partitionBy(*groups).orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = block_totals.select(
        *groups, "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *[F.sum(f"_t_{n}").over(earlier).alias(f"_b_{n}") for n in sums],
    )
    joined = matching(local, offsets, groups + ["_part"], "inner")
    # As in a window, NULLs add nothing and a sum of nothing but NULLs is NULL.
    whole = lambda n: F.coalesce(F.col(n) + F.col(f"_b_{n}"), F.col(n), F.col(f"_b_{n}"))
    kept = [c for c in df.columns]
    return joined.select(
        *kept, (F.col("_local") + F.col("_rows_before")).cast("bigint").alias(rank),
        *[whole(n).alias(n) for n in sums],
    )


def _windowed(df, groups, order, rank, sums):
    by = Window.partitionBy(*groups).orderBy(*order)
    running = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "*", F.row_number().over(by).cast("bigint").alias(rank),
        *[F.sum(c).over(running).alias(n) for n, c in sums.items()],
    )


def with_previous(
    df: DataFrame, groups: list[str], order: list[Column], columns: list[str], limit: int | None = None
) -> DataFrame:
    """Add ``prev_<column>`` from the row before, NULL on the first row of a group."""
    if bounded_groups(df, groups, limit):
        by = Window.partitionBy(*groups).orderBy(*order)
        return df.select("*", *[F.lag(c).over(by).alias(f"prev_{c}") for c in columns])
    numbered = ordered(df, groups, order, "_rn", limit=limit)
    shifted = numbered.select(
        *groups, (F.col("_rn") + 1).alias("_rn"), *[F.col(c).alias(f"prev_{c}") for c in columns]
    )
    # Joined on (group, row number): a huge group hashes over every partition.
    return matching(numbered, shifted, groups + ["_rn"], "left").drop("_rn")


def top_per_group(df: DataFrame, groups: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows per group; Spark limits each group before the shuffle."""
    by = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(by)).filter(F.col("rn") <= n)
