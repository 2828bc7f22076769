import pytest
from pyspark.sql import functions as F

from tallywire.functions.ranking import ordered, with_previous
from tallywire.operators.explore import concentration, stratified_sample


@pytest.fixture(scope="module")
def rows(spark):
    data = [(0 if i % 3 == 0 else i % 7, (i * 37) % 500, i) for i in range(500)]
    return spark.createDataFrame(data, "g int, x int, id int").persist(), data


@pytest.mark.parametrize("limit", [1, 10_000])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_row_numbers_and_sums(rows, limit, groups):
    df, data = rows
    out = ordered(df, groups, [F.desc("x"), F.asc("id")], "rn", {"total": F.col("x")}, limit)
    got = {r["id"]: (r["rn"], r["total"]) for r in out.collect()}
    want, state = {}, {}
    for g, x, i in sorted(data, key=lambda r: (-r[1], r[2])):
        key = g if groups else None
        n, t = state.get(key, (0, 0))
        state[key] = want[i] = (n + 1, t + x)
        want[i] = state[key]
    assert got == want


@pytest.mark.parametrize("limit", [1, 10_000])
def test_previous_row(rows, limit):
    df, data = rows
    got = {r["id"]: r["prev_x"] for r in with_previous(df, ["g"], [F.asc("id")], ["x"], limit).collect()}
    last, want = {}, {}
    for g, x, i in data:
        want[i] = last.get(g)
        last[g] = x
    assert got == want


@pytest.mark.parametrize("limit", [1, 10_000])
def test_concentration_reaches_everything(rows, limit):
    df, _ = rows
    out = concentration(df, "g", limit).orderBy("place").collect()
    assert out[0]["g"] == 0 and out[-1]["cum_pct"] == pytest.approx(100.0)
    assert [r["place"] for r in out] == list(range(1, len(out) + 1))


def test_stratified_quota(spark, tiny_groups):
    data = [(i, "a" if i < 90 else "b" if i < 99 else "c") for i in range(100)]
    df = spark.createDataFrame(data, "attack_id bigint, type string")
    got = {r["type"]: r["count"] for r in stratified_sample(df, "attack_id", 20).groupBy("type").count().collect()}
    assert got == {"a": 18, "b": 1, "c": 1}
    assert stratified_sample(df, "attack_id", 1000).count() == 100


@pytest.mark.parametrize("limit", [1, 10_000])
def test_null_groups_and_null_sums(spark, limit):
    data = [(None if i % 3 == 0 else i % 2, None if i < 40 else i, i) for i in range(120)]
    df = spark.createDataFrame(data, "g int, x int, id int")
    got = {r["id"]: (r["rn"], r["total"]) for r in ordered(df, ["g"], [F.asc("id")], "rn", {"total": F.col("x")}, limit).collect()}
    want, state = {}, {}
    for g, x, i in data:
        n, t = state.get(g, (0, None))
        state[g] = want[i] = (n + 1, t if x is None else (t or 0) + x)
    assert got == want
    back = {r["id"]: r["prev_id"] for r in with_previous(df, ["g"], [F.asc("id")], ["id"], limit).collect()}
    last = {}
    for g, _, i in data:
        assert back[i] == last.get(g)
        last[g] = i


def test_samples_cover_every_key(spark):
    from tallywire.operators.explore import draw, sample_rows, stratified_sample
    ids = [r["id"] for r in sample_rows(spark.range(3_000_000), "id", 1500, 42).collect()]
    assert min(ids) < 30_000 and max(ids) > 2_970_000 and len({i % 10_007 for i in ids}) > 1000
    thirds = [sum(a <= i < a + 1_000_000 for i in ids) for a in (0, 1_000_000, 2_000_000)]
    assert all(400 < t < 600 for t in thirds)
    huge = spark.range(2**62, 2**62 + 1000)
    assert huge.select(draw("id", 1).alias("d")).distinct().count() == 1000
    mixed = spark.createDataFrame([(i, None if i < 10 else "a") for i in range(100)], "id bigint, type string")
    assert stratified_sample(mixed, "id", 100).count() == 100
    assert stratified_sample(mixed, "id", 50).filter("type IS NULL").count() == 5


def test_many_bounded_groups_take_one_plain_window(rows):
    df, _ = rows
    plan = ordered(df, ["g"], [F.asc("id")], limit=300)._jdf.queryExecution().toString()
    assert "_local" not in plan and "prev_x" in with_previous(df, ["g"], [F.asc("id")], ["x"], 300).columns
    assert "Join" not in with_previous(df, ["g"], [F.asc("id")], ["x"], 300)._jdf.queryExecution().toString()
    assert "_local" in ordered(df, ["g"], [F.asc("id")], limit=100)._jdf.queryExecution().toString()
