"""Shards, top-k and quality rules against brute force; held-out accuracy; the queries' SQL."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallywire.llm import ngram_quality, sharding, topk

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def shards(docs, n=8, **more):
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    return sharding.shard_by_size(docs, n, key=F.crc32(F.coalesce("text", F.lit("")).cast("binary")), tie=F.col("doc_id"), size=size,
                                  columns={"doc_id": F.col("doc_id"), "size": size}, **more).collect()


def check_shards(rows, n):
    total, at = sum(r.size for r in rows), Counter()
    for r in rows:
        at[r.shard] += r.size
    most = max((r.size for r in rows), default=0)
    assert all(abs(at[s] - total / n) <= most + 1 for s in range(n))
    for s in range(n):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_shards_are_equal(make, odd_rows):
    draw = random.Random(1)
    rows = [(i, "x" * int(draw.paretovariate(1)) * 10) for i in range(2000)] + [(5000 + i, "one hot text") for i in range(1000)]
    got = shards(make(rows), sample=256, ranges=16)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    check_shards(got, 8)
    check_shards(shards(make(rows), sample=6, ranges=12), 8)  # so few samples leave ranges to be cut again
    odd = shards(make(odd_rows), 3)
    assert Counter(r.doc_id for r in odd) == Counter(i for i, _ in odd_rows)
    check_shards(odd, 3)
    assert shards(make(rows).limit(0)) == []


def plain_top(vectors, k):
    import math
    good = {}
    for i, v in sorted((x for x in vectors if x[0] is not None and x[1] is not None), key=lambda x: x[0]):
        if all(c is not None and math.isfinite(c) for c in v):
            whole = [math.floor(1024 * float(c)) for c in v]
            good[i] = min(good.get(i, whole), whole)
    out = []
    for q, v in good.items():
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, min(-s, 2**63 - 1)) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("tile,k", [(8192, 10), (7, 3)])
def test_top_k(spark, tile, k):
    draw = random.Random(4)
    rows = [(i, [draw.choice([-0.5, 0.25, 0.1, -0.001]) for _ in range(4)]) for i in range(0, 900, 3)]
    rows += [(901, [0.1, None, 0.2, 0.3]), (1000, [float("nan")] * 4), (1100, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.1] * 4), (1200, None),
             (1300, [0.5, 0.5]), (1303, [0.5, 0.1]), (300, [0.1] * 4), (1400, []), (1500, [1e9] * 3), (1501, [2e9] * 3)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit("clash"))
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = topk.top_k(table, F.col("vec_id") % 100 == 0, k, query_tile=tile // 2, shard_tile=tile)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == plain_top(rows, k)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 100 == 0, k).count() == 0


def plain_counts(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_base_counts():
    draw = random.Random(6)
    for n in (0, 1, 4, 5, 6, 40, 300):
        for kinds in (1, 2, 3, 40):
            text = "".join(f"w{draw.randrange(kinds)}é" + draw.choice([" ", "\n", "  ", "\t\n \n", " %| "]) for _ in range(n))
            assert ngram_quality.base_counts(text) == plain_counts(text)
    many = " ".join(f"w{i}" for i in range(9000)) + " " + " ".join(f"w{i}" for i in range(20))
    assert ngram_quality.base_counts(many) == plain_counts(many)


def test_scores_do_not_depend_on_partitions(spark, make, odd_rows):
    rows = odd_rows + [(100 + i, f"plain prose number {i} with some more words that one may read on and on") for i in range(30)] \
        + [(200 + i, " ".join(f"JUNK{i}{k}$$$ ###{k}" for k in range(9))) for i in range(10)]
    trusted = spark.createDataFrame([(i,) for i in range(100, 120)] + [(None,), (100,), (12345,)], "doc_id bigint")
    found = []
    for parts in (1, 5):
        docs = make(rows, parts).withColumn("kept", F.lit("clash"))
        out = ngram_quality.judged(docs, trusted).collect()
        found.append(sorted((r.row.doc_id or -1, r.n_words, r.score, r.base_failed, r.kept) for r in out))
        assert out[0].row.kept == "clash"
    assert found[0] == found[1] and len(found[0]) == len(rows)
    kept = {i: k for i, _, _, _, k in found[0]}
    assert all(kept[i] for i in range(100, 130)) and not any(kept[i] for i in range(200, 210))
    assert ngram_quality.judged(make(rows).limit(0), trusted).count() == 0
    no_model = ngram_quality.judged(make(rows), trusted.limit(0)).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in no_model)


@needs_tables
def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fit = labels.filter("doc_id % 2 = 0 AND quality = 1").select("doc_id")
    out = ngram_quality.judged(docs, fit).select(F.col("row.doc_id").alias("doc_id"), "base_failed", "kept")
    held = out.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed").select("kept", "quality").collect()
    right = sum(r.kept == (r.quality == 1) for r in held)
    assert len(held) > 100 and right / len(held) > 0.97


@needs_tables
def test_queries_match_sql(spark):
    from check import compare, connect
    from tallywire.llm.queries import ORACLES, QUERIES
    con = connect(SF)
    for name, sql in ORACLES.items():
        assert compare(QUERIES[name](spark, SF), con, sql).startswith("ok"), name
    con.close()
