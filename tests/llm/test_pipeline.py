"""Every stage of the pipeline against a brute-force version, each on what its predecessor kept."""

import math
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywire.llm import line_dedup, ngram_quality
from tests.llm.test_dedup import plain_components, plain_fingerprint, plain_lines, plain_removal
from tests.llm.test_search_and_rules import plain_counts
from tests.llm.test_tokens import WORD, library_ids

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def plain_quality(rows, trusted):
    """Ids that stay: base rules and the mean log ratio of hashed n-grams, one document at a time."""
    def bucket(gram):
        h = int.from_bytes(gram, "little") * 0x9E3779B1 % 2**32
        h ^= h >> 15
        return h * 0x85EBCA77 % 2**32 >> 16

    grams = {i: [bucket(b[p:p + 4]) for p in range(len(b) - 3)] for i, t in rows for b in [(t or "").encode()]}
    raw, good = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in trusted:
            good.update(g)
    size, a, b = ngram_quality.BUCKETS, sum(good.values()), sum(raw.values())
    ratio = {k: round(65536 * (math.log((good[k] + 1) / (a + size)) - math.log((n + 1) / (b + size)))) for k, n in raw.items()}
    kept = set()
    for i, t in rows:
        n, _, _, _, repeat = plain_counts(t or "")
        total = sum(ratio[g] for g in grams[i])
        if n >= 10 and 100 * repeat <= 20 * n and total >= round(ngram_quality.THRESHOLD * 65536) * len(grams[i]):
            kept.add(i)
    return kept


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    stages = dict(corpus_pipeline.STAGES)
    step = lambda name, given: given.sparkSession.createDataFrame(
        stages[name](spark, given, SF).collect(), given.schema)

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    good = step("quality_rules", docs)
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == plain_quality(rows, trusted)
    assert 100 < good.count() < docs.count()

    given = [(r.doc_id, r.text, r.source) for r in good.collect()]
    lines = step("line_dedup", good)
    got = lines.collect()
    assert sorted((r.doc_id or -1, r.source or "", r.text) for r in got) == plain_lines(given, line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert all(r.n_chars == len(r.text) for r in got)

    ids = sorted(r.doc_id for r in got)
    text = {r.doc_id: r.text for r in got}
    label = plain_components([plain_fingerprint(text[i]) for i in ids], 3)
    near = step("near_dedup", lines)
    assert sorted(r.doc_id for r in near.collect()) == [ids[i] for i in range(len(ids)) if label[i] == i]

    given = [(r.doc_id, r.text) for r in near.collect()]
    passages = step("suffix_dedup", near)
    got = sorted((r.doc_id, r.text) for r in passages.collect())
    assert got == [(i, b.decode(errors="ignore")) for i, _, _, b in plain_removal(given)]

    packed = stages["packing"](spark, passages, SF).collect()
    room = Counter()
    for r in packed:
        room[r.sequence_id] += r.length
    total = sum(len(library_ids(WORD, t)) + 1 for _, t in got)
    assert sum(room.values()) == total and max(room.values()) <= 4096 and len(room) <= -(-total // 4096) + 1


def test_run_of_odd_documents(spark, tmp_path, make, odd_rows):
    prose = "several plain words of ordinary prose that the rules have no reason to reject at all number {}"
    rows = odd_rows + [(100 + i, prose.format(i)) for i in range(8)] + [(105, prose.format(5)), (None, prose.format("none"))]
    docs = make(rows).withColumn("_first", F.lit(1)).withColumn("kept", F.lit(None).cast("string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    given = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        given = spark.read.parquet(f"{tmp_path}/{name}")
    left = Counter(r.doc_id for r in given.collect())
    assert left[100] == 1 and left[105] <= 1 and left[None] == 1
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= given.count()
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_near_duplicates_of_odd_rows(spark, make, odd_rows):
    """One document of each group stays; rows that share an id with other texts are documents of their own."""
    kept = lambda docs: sorted((r.doc_id or -1, r.text or "") for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert [i for i, _ in kept(make(odd_rows))] == [-1, 1, 4, 5, 7, 8]
    assert kept(make(odd_rows).limit(0)) == []
    a, b = (" ".join(f"{x}{i}" for i in range(200)) for x in "ab")
    rows = [(5, a), (5, a), (5, b), (6, a + " and"), (7, b), (None, a), (None, "words that no other document of these has")]
    assert kept(make(rows).withColumn("name", F.lit("clash"))) == [(-1, a), (-1, "words that no other document of these has"), (5, a), (5, b)]
