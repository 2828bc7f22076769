"""Exploratory aggregates: class mixes, top lists, histograms, spreads, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywire import names
from tallywire.functions.expressions import family, log1p_floor0, seconds_between
from tallywire.functions.quantiles import matching, quantile_table
from tallywire.functions.ranking import ordered, top_per_group

PERCENT = 100.0


def fixed_counts(df: DataFrame, column: str, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """Rows per listed value in listed order, zero where absent, with the share in percent.

    The counts are taken side by side in one aggregate, so no join fills the gaps.
    """
    keys = keys or []
    counts = df.groupBy(*keys).agg(*[F.count_if(F.col(column) == v).alias(f"_{i}") for i, v in enumerate(values)])
    cells = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(v).alias(column), F.col(f"_{i}").alias("n"))
        for i, v in enumerate(values)
    ])
    total = sum((F.col(f"_{i}") for i in range(1, len(values))), F.col("_0"))
    rows = counts.select(*keys, total.alias("_total"), F.explode(cells).alias("cell"))
    return rows.select(
        *keys, "cell.*", F.coalesce(F.try_divide(F.col("cell.n") * PERCENT, F.col("_total")), F.lit(0.0)).alias("pct")
    )


def class_mix(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return fixed_counts(df, "type", names.CLASSES, keys)


def code_types(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The class each attack code stands for: that of its lowest event id."""
    return events.groupBy(*(keys or []), "attack_code").agg(F.min_by("type", "attack_id").alias("type"))


def component_class_mix(events: DataFrame, components: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Class mix of components through their code. Codes are counted before the join."""
    keys = keys or []
    per_code = components.groupBy(*keys, "attack_code").agg(F.count("*").alias("rows"))
    typed = per_code.join(code_types(events, keys), [*keys, "attack_code"], "left")
    sums = typed.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("type") == t, F.col("rows"))), F.lit(0)).alias(f"_{i}")
        for i, t in enumerate(names.CLASSES)
    ])
    cells = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(t).alias("type"), F.col(f"_{i}").alias("n"))
        for i, t in enumerate(names.CLASSES)
    ])
    total = F.col("_0") + F.col("_1") + F.col("_2")
    return sums.select(*keys, total.alias("_t"), F.explode(cells).alias("cell")).select(
        *keys, "cell.*", F.coalesce(F.try_divide(F.col("cell.n") * PERCENT, F.col("_t")), F.lit(0.0)).alias("pct")
    )


def class_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    return quantile_table(df, ["type"], {c: (F.col(c), 0.5) for c in columns})


def class_means(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy("type").agg(*[F.avg(c).alias(c) for c in columns])


def with_durations(events: DataFrame) -> DataFrame:
    """Events with both times, and the seconds between them."""
    both = events.dropna(subset=["start_time", "end_time"])
    return both.withColumn("duration_s", seconds_between("start_time", "end_time"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values, NULL left out; ties go to the smaller value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(n)


def top_values_and_other(df: DataFrame, column: str, n: int) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc(column)).limit(n)
    rest = counts.join(F.broadcast(top.select(column)), column, "left_anti")
    other = rest.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("Other").alias(column), "n")
    return top.unionByName(other)


def top_values_per_class(df: DataFrame, column: str, n: int) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy("type", column).agg(F.count("*").alias("n"))
    return top_per_group(counts, ["type"], [F.desc("n"), F.asc(column)], n)


def daily_counts(events: DataFrame) -> DataFrame:
    dated = events.dropna(subset=["start_time"]).withColumn("day", F.to_date("start_time"))
    return dated.groupBy("day", "type").agg(F.count("*").alias("n"))


def class_clipped(df: DataFrame, column: str, q: float) -> DataFrame:
    """The column clipped, inside each class, at that class's own quantile."""
    caps = quantile_table(df, ["type"], {"_cap": (F.col(column), q)})
    joined = matching(df, F.broadcast(caps), ["type"], "left")  # one row per class
    return joined.withColumn(column, F.least(F.col(column).cast("double"), F.col("_cap"))).drop("_cap")


def histogram(df: DataFrame, column: str, bins: int, log: bool = False) -> DataFrame:
    """Density histogram per class, every bin present; ``log`` spaces the bins by log10.

    Only the range of each class and one count per bin are shuffled.
    """
    value = F.log10(F.col(column)) if log else F.col(column).cast("double")
    placed = df.filter(F.col(column).isNotNull()).select("type", value.alias("v"))
    spans = placed.groupBy("type").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count("*").alias("total"))
    flat = F.col("a") == F.col("b")
    spans = spans.select(
        "type", "total", F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
    )
    spans = F.broadcast(spans)  # one row per class
    slot = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counts = placed.join(spans, "type").groupBy("type", slot.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    grid = spans.select("type", "total", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / bins
    left, right = F.col("lo") + step * F.col("bin"), F.col("lo") + step * (F.col("bin") + 1)
    if log:
        left, right = F.pow(F.lit(10.0), left), F.pow(F.lit(10.0), right)
    n = F.coalesce("n", F.lit(0))
    return grid.join(counts, ["type", "bin"], "left").select(
        "type", "bin", left.alias("left_edge"), n.alias("n"),
        (n / (F.col("total") * (right - left))).alias("density"),
    )


def skew_switch(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: maximum, median, and whether its spread asks for a log scale."""
    medians = _by_column(quantile_table(df, [], {c: (F.col(c), 0.5) for c in columns}), columns, "median")
    maxima = _by_column(df.agg(*[F.max(c).cast("double").alias(c) for c in columns]), columns, "most")
    both = maxima.join(medians, "name")
    return both.withColumn("use_log", (F.col("most") > 10 * F.col("median")) & (F.col("median") > 0))


def log_where_skewed(df: DataFrame, columns: list[str], switch: DataFrame | None = None) -> DataFrame:
    """Replace the columns that need it by their log1p; the switch is one flag per column, that of ``df`` unless given."""
    switch = skew_switch(df, columns) if switch is None else switch
    chosen = {r["name"] for r in switch.filter("use_log").select("name").collect()}
    return df.withColumns({
        c: log1p_floor0(c) if c in chosen else F.col(c).cast("double") for c in columns
    })


def _by_column(row: DataFrame, columns: list[str], value: str) -> DataFrame:
    pairs = [v for c in columns for v in (F.lit(c), F.col(c).cast("double"))]
    return row.select(F.explode(F.create_map(*pairs)).alias("name", value))


def duration_spread(events: DataFrame) -> DataFrame:
    """Per class: mean, median, minimum and maximum of log10 seconds, for positive durations."""
    logs = with_durations(events).filter("duration_s > 0").select(
        "type", F.log10(F.greatest("duration_s", F.lit(0.1))).alias("v"))
    plain = logs.groupBy("type").agg(F.avg("v").alias("mean"), F.min("v").alias("least"), F.max("v").alias("most"))
    return plain.join(quantile_table(logs, ["type"], {"median": (F.col("v"), 0.5)}), "type")


def component_shares(counts: DataFrame, column: str = "detect_count") -> DataFrame:
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0)) * PERCENT
    n = F.col(column)
    return counts.agg(share(n == 1).alias("single"), share(n > 1).alias("several"), share(n > 10).alias("many"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair, from one aggregate over the rows without NULLs."""
    full = df.dropna(subset=columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = full.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    at = lambda a, b: F.col(f"`{a}|{b}`") if (a, b) in pairs else F.col(f"`{b}|{a}`")
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), at(a, b).alias("corr")) for a in columns for b in columns]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, median, 99th percentile and maximum per column, one row per column."""
    plain = df.agg(*[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.max(c).alias(f"{c}_max") for c in columns])
    cells = [F.struct(F.lit(c).alias("name"), F.col(f"{c}_mean").alias("mean"),
                      F.col(f"{c}_max").cast("double").alias("most")) for c in columns]
    plain = plain.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    marks = quantile_table(df, [], {f"{c}_{k}": (v, p) for c in columns for v in [F.col(c)] for k, p in (("p50", 0.5), ("p99", 0.99))})
    cells = [F.struct(F.lit(c).alias("name"), F.col(f"{c}_p50").alias("median"), F.col(f"{c}_p99").alias("p99"))
             for c in columns]
    return plain.join(marks.select(F.explode(F.array(*cells)).alias("c")).select("c.*"), "name")


def quality_audit(df: DataFrame, numeric: list[str]) -> DataFrame:
    """NULLs, constant columns, negatives, zero share, bad ports, duplicate rows."""
    checks: dict[str, Column] = {}
    for c in df.columns:
        checks[f"nulls:{c}"] = F.count_if(F.col(c).isNull())
        checks[f"constant:{c}"] = F.coalesce(F.min(c) == F.max(c), F.lit(False)).cast("int")
    for c in numeric:
        checks[f"negative:{c}"] = F.count_if(F.col(c) < 0)
        checks[f"zero_pct:{c}"] = F.avg(F.when(F.col(c) == 0, 100.0).otherwise(0.0))
    if "port" in df.columns:
        checks["bad_port"] = F.count_if(~F.col("port").between(0, 65535))
    row = df.agg(*[c.cast("double").alias(n) for n, c in checks.items()])
    pairs = [v for n in checks for v in (F.lit(n), F.col(f"`{n}`"))]
    rows = row.select(F.explode(F.create_map(*pairs)).alias("check", "value"))
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("double").alias("value"))
    return rows.unionByName(copies.select(F.lit("duplicate_rows").alias("check"), "value"))


def _z_scores(table: DataFrame, columns: list[str], spread) -> DataFrame:
    """Z-scores down each column of a small table (one row per code or family)."""
    everything = Window.partitionBy(F.lit(0))
    return table.withColumns({
        f"z_{c}": (F.col(c) - F.avg(c).over(everything)) / (spread(c).over(everything) + F.lit(1e-9)) for c in columns
    })


def fingerprints(events: DataFrame, columns: list[str], n: int = 15) -> DataFrame:
    """For the n most frequent codes: feature means, most frequent class, count, z-scores
    with population deviation. Equal class counts go to the class listed first."""
    table = events.groupBy("attack_code").agg(
        F.count("*").alias("n"), *[F.avg(c).alias(c) for c in columns],
        *[F.count_if(F.col("type") == t).alias(f"_{i}") for i, t in enumerate(names.CLASSES)])
    top = table.orderBy(F.desc("n"), F.asc("attack_code")).limit(n)
    ranked = F.array_max(F.array(*[
        F.struct(F.col(f"_{i}").alias("n"), F.lit(-i).alias("place"), F.lit(t).alias("type"))
        for i, t in enumerate(names.CLASSES)
    ]))
    top = top.withColumn("modal_type", ranked["type"])
    return _z_scores(top, columns, F.stddev_pop).select(
        "attack_code", "n", "modal_type", *columns, *[f"z_{c}" for c in columns])


def family_mix(events: DataFrame) -> DataFrame:
    """DDoS families in fixed order, zero where absent."""
    ddos = events.filter(F.col("type") == names.CLASSES[names.DDOS]).withColumn("family", family("attack_code"))
    return fixed_counts(ddos, "family", names.FAMILIES)


def family_signature(events: DataFrame, columns: list[str]) -> DataFrame:
    """Feature means per DDoS family and their z-scores with sample deviation."""
    ddos = events.filter(F.col("type") == names.CLASSES[names.DDOS]).withColumn("family", family("attack_code"))
    means = ddos.groupBy("family").agg(*[F.avg(c).alias(c) for c in columns])
    return _z_scores(means, columns, F.stddev_samp).select("family", *columns, *[f"z_{c}" for c in columns])


def port_heat(events: DataFrame, n: int = 10) -> DataFrame:
    """Share of each class on each of the n ports that are most frequent overall."""
    counts = events.groupBy("port").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("type") == t).alias(f"_{i}") for i, t in enumerate(names.CLASSES)])
    everything = Window.partitionBy(F.lit(0))  # at most 65,536 rows, one per port
    shares = counts.select("port", "n", *[
        F.coalesce(F.try_divide(F.col(f"_{i}") * PERCENT, F.sum(f"_{i}").over(everything)), F.lit(0.0)).alias(f"pct_{i}")
        for i in range(len(names.CLASSES))
    ])
    return shares.orderBy(F.desc("n"), F.asc("port")).limit(n)


def separability(events: DataFrame, columns: list[str]) -> DataFrame:
    """Between-class over within-class variance per feature, ranked."""
    per_class = events.groupBy("type").agg(*[
        F.struct(F.count(c).cast("double").alias("n"), F.avg(c).alias("mean"), F.var_pop(c).alias("var")).alias(c)
        for c in columns
    ])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in columns])
    rows = per_class.select(F.explode(cells).alias("cell")).select("cell.feature", "cell.s.*")
    same = Window.partitionBy("feature")  # three rows, one per class
    grand = F.sum(F.col("n") * F.col("mean")).over(same) / F.sum("n").over(same)
    rows = rows.withColumn("gap", F.col("n") * F.pow(F.col("mean") - grand, F.lit(2.0)))
    scores = rows.groupBy("feature").agg(
        (F.sum("gap") / (F.sum(F.col("n") * F.col("var")) + F.lit(1e-9))).alias("score"))
    return scores.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), "feature")))


def separating_pairs(ranked: DataFrame) -> DataFrame:
    """Fixed choice of three pairs by rank: (1,2), (1,3), (2,4)."""
    wanted = F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(a).alias("x"), F.lit(b).alias("y"))
                       for i, (a, b) in enumerate([(1, 2), (1, 3), (2, 4)])])
    by_place = ranked.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("place", "feature"))).alias("m"))
    pairs = by_place.select("m", F.explode(wanted).alias("w"))
    return pairs.select("w.pair", F.element_at("m", F.col("w.x")).alias("feature_x"),
                        F.element_at("m", F.col("w.y")).alias("feature_y"))


def ellipses(df: DataFrame, x: str, y: str) -> DataFrame:
    """Per class the 95 % ellipse of the points inside the 5-95 % box of both axes."""
    points = df.select("type", F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    box = quantile_table(points, ["type"], {
        f"{c}{k}": (v, p) for c in ("x", "y") for v in [F.col(c)] for k, p in ((0, 0.05), (1, 0.95))})
    inside = points.join(F.broadcast(box), "type").filter(  # one row per class
        F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1")))
    m = inside.groupBy("type").agg(
        F.count("*").alias("n"), F.avg("x").alias("mean_x"), F.avg("y").alias("mean_y"),
        F.covar_samp("x", "x").alias("a"), F.covar_samp("x", "y").alias("b"), F.covar_samp("y", "y").alias("d"),
    ).filter("n >= 10")
    half = (F.col("a") - F.col("d")) / 2
    root = F.sqrt(half * half + F.col("b") * F.col("b"))
    middle = (F.col("a") + F.col("d")) / 2
    axis = lambda v: 2 * F.sqrt(F.greatest(v, F.lit(0.0)) * F.lit(5.991))
    return m.select(
        "type", "n", "mean_x", "mean_y", axis(middle - root).alias("width"), axis(middle + root).alias("height"),
        F.degrees(F.atan2(middle + root - F.col("a"), F.col("b"))).alias("angle"))


def concentration(events: DataFrame, key: str = "victim", limit: int | None = None) -> DataFrame:
    """Values ranked by count with the running share of all rows."""
    known = events.filter(F.col(key).isNotNull()).select(key)
    total = known.count()
    counts = known.groupBy(key).agg(F.count("*").alias("n"))
    ranked = ordered(counts, [], [F.desc("n"), F.asc(key)], "place", {"running": F.col("n")}, limit, at_most=total)
    return ranked.select(key, "n", "place", (F.col("running") * PERCENT / F.lit(float(max(total, 1)))).alias("cum_pct"))


def covering(ranked: DataFrame, pct: float = 80.0) -> DataFrame:
    """How many of the ranked values stay within the given share."""
    return ranked.agg(F.count_if(F.col("cum_pct") <= pct).alias("n_covering"))


_PRIME = (1 << 61) - 1


def draw(key: str, seed: int) -> Column:
    """A repeatable pseudo-random order over a whole-number key of any size.

    Different keys below the prime get different draws, so nothing is decided by the key itself. Products are
    taken in decimals, which hold them exactly (fixed values: the two multipliers and 2**61 - 1).
    """
    wide = lambda x: x.cast("decimal(20,0)")
    mixed = F.pmod(wide(F.col(key)) * F.lit(1181783497276652981).cast("decimal(19,0)") + F.lit(seed), F.lit(_PRIME)).cast("bigint")
    folded = mixed.bitwiseXOR(F.shiftright(mixed, 29))
    return F.pmod(wide(folded) * F.lit(1099511628211).cast("decimal(18,0)"), F.lit(_PRIME)).cast("bigint")


def draw_sql(key: str, seed: int) -> str:
    """The same order as SQL text with 128-bit integers."""
    mixed = f"((CAST({key} AS HUGEINT) * 1181783497276652981 + {seed}) % {_PRIME} + {_PRIME}) % {_PRIME}"
    return f"(xor({mixed}, ({mixed}) >> 29) * 1099511628211) % {_PRIME}"


def stratified_sample(df: DataFrame, key: str, cap: int, seed: int = 0, label: str = "type") -> DataFrame:
    """Per class, NULL being one, min(n_c, max(1, cap * n_c div n)) rows, the first of a repeatable order."""
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}  # one row per class
    total = sum(sizes.values())
    if total <= cap:
        return df  # every class would be taken whole
    take = F.lit(0)
    for value, n in sizes.items():
        take = F.when(F.col(label).eqNullSafe(F.lit(value)), min(n, max(1, cap * n // total))).otherwise(take)
    drawn = df.withColumn("_draw", draw(key, seed))
    ranked = ordered(drawn, [label], [F.asc("_draw"), F.asc(key)], "_rn")
    return ranked.filter(F.col("_rn") <= take).drop("_draw", "_rn")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows, the first of a repeatable order: a distributed top-n, no global sort."""
    return df.orderBy(draw(key, seed), F.asc(key)).limit(n)
