"""Exact quantiles per group that survive groups of any size.

A group of bounded size is answered by Spark's ``percentile``. A group that may
hold a large part of the table is never brought into one task: its values are
counted between splitters taken from a sketch (combined on the map side, so only
counts are shuffled), the part holding the wanted rank becomes the next value
range, and the rounds stop when few enough rows are left to be sorted. All
quantiles of a table are counted in the same pass over it. Groups
whose values are all NULL and groups with NULL keys stay on both paths.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywire.functions.expressions import sorted_quantile
from tallywire.session import fits_one_task, group_row_limit, materialize

SPLITTERS = 1000
_BROADCAST_ROWS = 100_000


def oversized_groups(df: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame | None:
    """Keys with more rows than the limit, or None when there are none.

    There can be no more such keys than rows / limit.
    """
    big, _ = _split(df, keys, limit)
    return big


def _split(df: DataFrame, keys: list[str], limit: int | None = None) -> tuple[DataFrame | None, bool]:
    """The oversized keys, and whether any row belongs to another key."""
    bound = group_row_limit(df.sparkSession) if limit is None else limit
    total = df.count()
    if total <= bound:
        return None, True
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    big = materialize(sizes.filter(F.col("_rows") > bound))
    inside = big.agg(F.sum("_rows")).first()[0]
    if not inside:
        return None, True
    return big.select(*keys), inside < total


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a materialized table only when its row count is small."""
    return F.broadcast(df) if df.count() <= _BROADCAST_ROWS else df


def quantile_table(
    df: DataFrame,
    keys: list[str],
    wanted: dict[str, tuple[Column, float]],
    limit: int | None = None,
) -> DataFrame:
    """One row per group with a linear-interpolated quantile per entry of ``wanted``.

    ``wanted`` maps an output name to (expression, probability); NULLs are left out. One Column object given with
    several probabilities is kept and sketched once.
    """
    bound = group_row_limit(df.sparkSession) if limit is None else limit
    plain = [F.percentile(c.cast("double"), F.lit(float(p))).alias(n) for n, (c, p) in wanted.items()]
    if fits_one_task(df, bound):
        return df.groupBy(*keys).agg(*plain)
    if not keys:
        everything = df.withColumn("_all", F.lit(0))
        return _by_counting(everything, ["_all"], wanted, bound).drop("_all")
    big, others = _split(df, keys, bound)
    if big is None:
        return df.groupBy(*keys).agg(*plain)
    if not others:
        return _by_counting(df, keys, wanted, bound)
    big = bounded_broadcast(big)
    rest = matching(df, big, keys, "left_anti").groupBy(*keys).agg(*plain)
    large = _by_counting(matching(df, big, keys, "left_semi"), keys, wanted, bound)
    return rest.unionByName(large)


def matching(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys of ``left`` are kept."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, on, how).drop(*[f"_r_{k}" for k in keys])


def _by_counting(
    df: DataFrame, keys: list[str], wanted: dict[str, tuple[Column, float]], bound: int
) -> DataFrame:
    """Values are only ever compared, so infinities, NaN (the greatest value) and any range are fine.

    Values stay in the row they come in: a round is one aggregate over all targets, and no row is multiplied
    but those whose value is in the last range of a target.
    """
    items = list(wanted.items())
    ranked: list[Column] = []  # an expression wanted at several probabilities is kept and sketched once
    for _, (c, _) in items:
        if not any(c is other for other in ranked):
            ranked.append(c)
    of = [next(j for j, other in enumerate(ranked) if other is c) for _, (c, _) in items]
    # Every round reads the rows again, so they are kept once with nothing but what is ranked.
    every = materialize(df.select(*keys, *[c.cast("double").alias(f"v_{j}") for j, c in enumerate(ranked)]))
    values = [F.col(f"v_{j}") for j in of]
    whole = every.groupBy(*keys).agg(*[
        F.struct(F.count(f"v_{j}").alias("n"), F.min(f"v_{j}").alias("lo"), F.max(f"v_{j}").alias("hi"),
                 *_sketch(F.col(f"v_{j}"))).alias(f"w_{j}")
        for j in range(len(ranked))
    ])
    state = materialize(whole.select(*keys, *[
        F.struct(
            (F.lit(float(p)) * (F.col(f"w_{j}.n") - 1)).alias("at"), f"w_{j}.lo", f"w_{j}.hi",
            F.lit(0).cast("bigint").alias("below"), F.col(f"w_{j}.n").alias("inside"),
            ((F.col(f"w_{j}.n") == 0) | (F.col(f"w_{j}.lo") == F.col(f"w_{j}.hi"))).alias("done"),
            f"w_{j}.numbers", f"w_{j}.grid",
        ).alias(f"s_{i}")
        for i, (j, (_, (_, p))) in enumerate(zip(of, items))
    ]))
    state = materialize(_narrow(every, values, state, keys))
    large = lambda i: ~F.col(f"s_{i}.done") & (F.col(f"s_{i}.inside") > bound)
    while not state.filter(reduce(lambda a, b: a | b, [large(i) for i in range(len(items))])).isEmpty():
        state = materialize(_narrow(every, values, _sketched(every, values, state, keys), keys))
    open_rows = (
        _in_range(every, values, state, keys)
        .groupBy(*keys, "item")
        .agg(F.first("at").alias("at"), F.first("below").alias("below"), F.sort_array(F.collect_list("v")).alias("vs"))
    )
    first = F.get("vs", (F.floor("at") - F.col("below")).cast("int"))
    second = F.get("vs", (F.ceil("at") - F.col("below")).cast("int"))
    targets = F.array(*[F.struct(F.lit(i).alias("item"), *[F.col(f"s_{i}.{x}") for x in ("at", "lo", "hi", "done")]) for i in range(len(items))])
    ended = state.select(*keys, F.explode(targets).alias("t")).select(*keys, "t.*").filter("done")
    finished = open_rows.select(*keys, "item", _between(first, second).alias("q")).unionByName(
        ended.select(*keys, "item", _between(F.col("lo"), F.col("hi")).alias("q")))
    return finished.groupBy(*keys).agg(*[
        F.max(F.when(F.col("item") == i, F.col("q"))).alias(n) for i, (n, _) in enumerate(items)
    ])


def _between(first: Column, second: Column) -> Column:
    """Linear interpolation as ``percentile`` does it: no arithmetic between equal values."""
    part = F.col("at") - F.floor("at")
    return F.when((first == second) | (part == 0), first).otherwise(first * (1 - part) + second * part)


def _sketch(v: Column) -> list[Column]:
    """How many values are numbers, and values at SPLITTERS even steps of rank; sketches cannot rank NaN."""
    number = F.when(~F.isnan(v), v)
    return [F.count(number).alias("numbers"), F.percentile_approx(number, [i / SPLITTERS for i in range(SPLITTERS + 1)]).alias("grid")]


def _open(state: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """What the rows are compared with, flat: ``<name>_<item>``, NULL where the target is done."""
    items = [c.removeprefix("s_") for c in state.columns if c not in keys]
    return bounded_broadcast(state.select(*keys, *[
        F.when(~F.col(f"s_{i}.done"), F.col(f"s_{i}.{n}")).alias(f"{n}_{i}") for i in items for n in names
    ]))


def _inside(v: Column, i: int) -> Column:
    return v.between(F.col(f"lo_{i}"), F.col(f"hi_{i}"))


def _sketched(every: DataFrame, values: list[Column], state: DataFrame, keys: list[str]) -> DataFrame:
    """The state with new sketches, of the values still in range."""
    found = matching(every, _open(state, keys, ["lo", "hi"]), keys, "inner").groupBy(*keys).agg(*[
        F.struct(*_sketch(F.when(_inside(v, i), v))).alias(f"w_{i}") for i, v in enumerate(values)
    ])
    return matching(found, state, keys, "inner").select(*keys, *[
        F.struct(*[f"s_{i}.{n}" for n in ("at", "lo", "hi", "below", "inside", "done")], f"w_{i}.numbers", f"w_{i}.grid").alias(f"s_{i}")
        for i in range(len(values))
    ])


def _in_range(every: DataFrame, values: list[Column], state: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, item, at, below, v) of the values in the ranges that are left."""
    placed = matching(every, _open(state, keys, ["lo", "hi", "at", "below"]), keys, "inner").filter(
        reduce(lambda a, b: a | b, [F.coalesce(_inside(v, i), F.lit(False)) for i, v in enumerate(values)]))
    cells = F.array(*[
        F.when(_inside(v, i), F.struct(F.lit(i).alias("item"), F.col(f"at_{i}").alias("at"), F.col(f"below_{i}").alias("below"), v.alias("v")))
        for i, v in enumerate(values)
    ])
    return placed.select(*keys, F.explode(cells).alias("cell")).filter("cell IS NOT NULL").select(*keys, "cell.*")


def _narrow(every: DataFrame, values: list[Column], state: DataFrame, keys: list[str]) -> DataFrame:
    """One counting round. Three splitters stand around the wanted rank, so there are five bins: below, between, equal to
    the one in the middle, between, above. The range of each open target shrinks to one bin, or to the border of two.
    All rows are counted, the ones before the range in the lowest bin, so a bin's end is a rank in the group."""
    count = range(len(values))
    marked = state.select(*keys, *[
        F.struct(f"s_{i}.*", *_splitters(F.col(f"s_{i}"))).alias(f"s_{i}") for i in count])
    marked = materialize(marked)
    counts = []
    for i, v in enumerate(values):
        a, m, b = F.col(f"a_{i}"), F.col(f"m_{i}"), F.col(f"b_{i}")
        counts += [
            F.count_if(v < a).alias(f"low_{i}"), F.count_if((v >= a) & (v < m)).alias(f"left_{i}"),
            F.count_if(v == m).alias(f"mid_{i}"), F.count_if((v > m) & (v <= b)).alias(f"right_{i}"),
            F.max(F.when(v < a, v)).alias(f"low_most_{i}"), F.max(F.when((v >= a) & (v < m), v)).alias(f"left_most_{i}"),
            F.min(F.when((v > m) & (v <= b), v)).alias(f"right_least_{i}"), F.min(F.when(v > b, v)).alias(f"high_least_{i}"),
        ]
    counted = matching(every, _open(marked, keys, ["a", "m", "b"]), keys, "inner").groupBy(*keys).agg(*counts)
    both = matching(counted, marked, keys, "inner")
    return both.select(*keys, *[_shrunk(i).alias(f"s_{i}") for i in count])


def _splitters(s: Column) -> list[Column]:
    """The sketch's value near the wanted rank, and the ones a step before and two behind it."""
    rank = F.least(F.floor(s["at"]) - s["below"], s["numbers"] - 1) / F.greatest(s["numbers"] - 1, F.lit(1))
    step = F.floor(rank * SPLITTERS).cast("int")
    return [F.get(s["grid"], F.greatest(step - 1, F.lit(0))).alias("a"), F.get(s["grid"], step).alias("m"),
            F.get(s["grid"], F.least(step + 2, F.lit(SPLITTERS))).alias("b")]


def _shrunk(i: int) -> Column:
    s = F.col(f"s_{i}")
    ends = [F.col(f"low_{i}")]
    for name in ("left", "mid", "right"):
        ends.append(ends[-1] + F.col(f"{name}_{i}"))
    starts = [s["below"], *ends]
    ends.append(s["below"] + s["inside"])
    least = [s["lo"], s["a"], s["m"], F.col(f"right_least_{i}"), F.col(f"high_least_{i}")]
    most = [F.col(f"low_most_{i}"), F.col(f"left_most_{i}"), s["m"], s["b"], s["hi"]]
    bins = F.array(*[F.struct(x.alias("start"), y.alias("end"), lo.alias("lo"), hi.alias("hi")) for x, y, lo, hi in zip(starts, ends, least, most)])
    holding = lambda rank: F.get(F.filter(bins, lambda x: (x["start"] <= rank) & (rank < x["end"])), F.lit(0))
    x, y = holding(F.floor(s["at"])), holding(F.ceil(s["at"]))
    # Both ranks in one bin: go on inside it. In two bins: they are its border values.
    split = x["start"] != y["start"]
    lo, hi = F.when(split, x["hi"]).otherwise(x["lo"]), F.when(split, y["lo"]).otherwise(x["hi"])
    kept = [s[n].alias(n) for n in ("at", "lo", "hi", "below", "inside", "done")]
    now = F.struct(s["at"].alias("at"), lo.alias("lo"), hi.alias("hi"), x["start"].alias("below"), (x["end"] - x["start"]).alias("inside"),
                   (split | (lo == hi)).alias("done"))
    return F.when(s["done"], F.struct(*kept)).otherwise(now)


def median_and_deviation(
    df: DataFrame, keys: list[str], columns: dict[str, Column], limit: int | None = None
) -> DataFrame:
    """Per group and column: ``<name>_median`` and ``<name>_mad``.

    Groups under the limit keep their values in one sorted array, so one shuffle
    gives both. Larger groups take two rounds of exact counting quantiles.
    """
    bound = group_row_limit(df.sparkSession) if limit is None else limit
    big = oversized_groups(df, keys, bound)
    if big is None:
        return _from_arrays(df, keys, columns)
    big = bounded_broadcast(big)
    rest = _from_arrays(matching(df, big, keys, "left_anti"), keys, columns)
    large = matching(df, big, keys, "left_semi")
    medians = materialize(quantile_table(
        large, keys, {f"{n}_median": (c, 0.5) for n, c in columns.items()}, bound
    ))
    centred = large.select(*keys, *[c.cast("double").alias(f"_{n}") for n, c in columns.items()])
    centred = matching(centred, bounded_broadcast(medians), keys, "inner")
    spread = quantile_table(centred, keys, {
        f"{n}_mad": (F.abs(F.col(f"_{n}") - F.col(f"{n}_median")), 0.5) for n in columns
    }, bound)
    return rest.unionByName(matching(medians, spread, keys, "inner"))


def _from_arrays(df: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    # Bounded groups, and arrays do not shrink on the map side: group after one exchange.
    packed = df.select(*keys, *[c.alias(n) for n, c in columns.items()]).repartition(*keys).groupBy(*keys).agg(*[
        F.sort_array(F.collect_list(F.col(n).cast("double"))).alias(n) for n in columns
    ])
    with_median = packed.select("*", *[
        sorted_quantile(F.col(n), 0.5).alias(f"{n}_median") for n in columns
    ])
    return with_median.select(*keys, *[f"{n}_median" for n in columns], *[
        deviation(F.col(n), F.col(f"{n}_median")).alias(f"{n}_mad") for n in columns
    ])


def deviation(values: Column, centre: Column) -> Column:
    """Median absolute deviation of an array of values around ``centre``."""
    return sorted_quantile(F.sort_array(F.transform(values, lambda v: F.abs(v - centre))), 0.5)
