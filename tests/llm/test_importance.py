"""Importance resampling against a plain version."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywire.llm import importance
from tallywire.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_features(text, max_run=1):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i:i + k]) for k in range(1, max_run + 1) for i in range(len(words) - k + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def plain_draw(docs, target, percent=10, max_run=1):
    """(doc_id, n_words, n_features, weight, score, rank) of (doc_id, text) rows."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, plain_features(text, max_run)[1]))
    for text in target:
        t.update(map(bucket, plain_features(text, max_run)[1]))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    rows = []
    for i, text in docs:
        words, found = plain_features(text, max_run)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for place, r in enumerate(able):
        r.append(place + 1 if place < percent * len(able) // 100 else None)
    for r in rows:
        if r[1] < 20:
            r.append(None)
    return rows


def test_buckets_of_any_bytes():
    draw = random.Random(5)
    texts = ["".join(draw.choice("abZ09 -_é中\n.") for _ in range(draw.randrange(60))) for _ in range(200)] + [None, "", "x" * 3000, "é" * 700, "One one ONE"]
    for run in (1, 3):
        batch = pa.RecordBatch.from_arrays([pa.array(["cut away"] + texts, pa.string())], names=["text"]).slice(1)
        data, begins, lengths, rows, n_words = importance.features(batch, "text", run)
        got = list(zip(rows.tolist(), importance.crc_buckets(data, begins, lengths).tolist()))
        want = [(i, bucket(f)) for i, t in enumerate(texts) for f in plain_features(t, run)[1]]
        assert Counter(got) == Counter(want)
        assert n_words.tolist() == [len(plain_features(t)[0]) for t in texts]


@pytest.mark.parametrize("max_run,rank_rows", [(1, 10 ** 6), (2, 50)])
def test_draw(spark, make, odd_rows, max_run, rank_rows):
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(80)]
    rows = odd_rows + [(100 + i, " ".join(draw.choices(vocabulary, k=draw.randrange(60)))) for i in range(400)]
    rows += [(1000, " ".join(vocabulary))] * 3 + [(None, " ".join(vocabulary))] * 2
    target = ["w1 w2 w3 w1", None, "", "W7 w8-w9"]
    docs = make(rows, 3).withColumn("rank", F.lit("clash")).withColumn("id", F.lit("clash")).withColumn("weight", F.lit(0))
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.drawn(docs, bench, 10, max_run=max_run, rank_rows=rank_rows)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, plain_draw(rows, target, max_run=max_run)), key=key)
    ids = {r.id for r in got.filter("rank IS NOT NULL").collect()}
    back = importance.resampled(docs, bench, 10, max_run=max_run)
    assert back.columns == docs.columns and {r.doc_id for r in back.collect()} == ids
    assert importance.drawn(docs.limit(0), bench, 10).count() == 0
    nothing = importance.drawn(docs, bench.limit(0), 10, max_run=max_run).collect()
    assert sorted(map(tuple, nothing), key=key) == sorted(map(tuple, plain_draw(rows, [], max_run=max_run)), key=key)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_query(spark):
    out = QUERIES["op11_importance_draw"](spark, SF)
    assert dict(out.dtypes) | {"doc_id": "bigint"} == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank", "n_words"], "bigint")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    want = sorted((i, n, w, s, r or 0) for i, _, n, w, s, r in plain_draw(docs, target))
    assert sorted((r.doc_id, r.n_features, r.weight, r.score, r.rank or 0) for r in out.collect()) == want


def test_crc_table_is_the_standard_one():
    data = np.frombuffer(b"123456789", np.uint8)
    assert importance.crc_buckets(data, np.array([0]), np.array([9]), 1 << 31).tolist() == [0xCBF43926 % (1 << 31)]
