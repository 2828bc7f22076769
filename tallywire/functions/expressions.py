"""Column expressions. Every function returns a JVM-side expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from tallywire import names


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log1p_floor0(c: Column | str) -> Column:
    """log(1 + max(c, 0)); NULL stays NULL so that later fallbacks still see it."""
    c = _col(c)
    return F.when(c.isNotNull(), F.log1p(F.greatest(c.cast("double"), F.lit(0.0))))


def guarded_ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom with the denominator raised to at least one."""
    return _col(top) / F.greatest(_col(bottom), F.lit(1.0))


def capped(c: Column | str, cap: float) -> Column:
    """min(c, cap); NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(c.cast("double"), F.lit(float(cap))))


def finite_or_zero(c: Column | str) -> Column:
    c = _col(c)
    unusable = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(unusable, F.lit(0.0)).otherwise(c)


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds from start to end with fractions, not below zero; NULL if unknown."""
    span = seconds_between(start, end)
    return F.when(span.isNotNull(), F.greatest(span, F.lit(0.0)))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return (micros(end) - micros(start)) / F.lit(1e6)


def micros(c: Column | str) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def class_code(column: str) -> Column:
    """Class name to its fixed code; anything unknown is NULL."""
    cases = " ".join(f"WHEN '{name}' THEN {code}" for code, name in enumerate(names.CLASSES))
    return F.expr(f"CASE {column} {cases} END")


def class_name(c: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names.CLASSES]), _col(c) + 1)


def port_flags(port: str) -> list[Column]:
    """One 0/1 column per port group."""
    listed = lambda ports: f"{port} IN ({', '.join(map(str, ports))})"
    tests = [
        f"{port} = 0", listed(names.DNS_PORTS), listed(names.AMPLIFICATION_PORTS), listed(names.HTTP_PORTS),
        listed(names.HTTPS_PORTS), f"{port} >= {names.FIRST_EPHEMERAL_PORT}",
    ]
    return [F.expr(f"if({t}, 1D, 0D) AS {n}") for t, n in zip(tests, names.PORT_FEATURES)]


def token_column(token: str) -> str:
    return "atk_" + token.lower().replace(" ", "_")


def token_flags(code: str) -> list[Column]:
    """One 0/1 column per known token, matched as a literal, ignoring case."""
    return [
        F.expr(f"if(contains(lower(trim({code})), '{t.lower()}'), 1, 0) AS {token_column(t)}")
        for t in names.ATTACK_TOKENS
    ]


def family(code: Column | str) -> Column:
    """First matching family of an attack code, else Other."""
    text = F.lower(F.coalesce(_col(code), F.lit("")))
    out = None
    for needle, label in names.FAMILY_RULES:
        hit = F.contains(text, F.lit(needle))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit("Other"))


def strategy_of(model: Column | str) -> Column:
    """The bracketed resampling tag of a model label, or none."""
    tag = F.regexp_extract(_col(model), r"\[(SMOTE|ADASYN)\]", 1)
    return F.when(tag == "", F.lit("none")).otherwise(tag)


def base_model_of(model: Column | str) -> Column:
    return F.regexp_replace(_col(model), r" \[(SMOTE|ADASYN)\]", "")


def data_rate(columns: Iterable[str]) -> Column:
    """Data speed if the table has it, else packet speed times length (else zero)."""
    columns = set(columns)
    if "data_speed" in columns:
        return F.col("data_speed").cast("double")
    length = F.col("avg_packet_len") if "avg_packet_len" in columns else F.lit(0)
    return (F.col("packet_speed") * length).cast("double")


def in_burst(offset_seconds: Column | str, interval_s: float, duration_s: float) -> Column:
    return F.pmod(_col(offset_seconds), F.lit(interval_s)) < F.lit(duration_s)


def sorted_quantile(ordered: Column, p: float) -> Column:
    """Linear-interpolated quantile of an ascending array; NULL when it is empty."""
    at = F.lit(float(p)) * (F.size(ordered) - 1)
    low = F.floor(at).cast("int")
    below = F.get(ordered, low)
    above = F.get(ordered, F.ceil(at).cast("int"))
    return F.when(F.size(ordered) > 0, below + (above - below) * (at - low))
