"""The subsequence kernel against its definition, and the classifier on held-out labels."""

import itertools
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywire.llm import toxicity
from tallywire.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def plain_map(text):
    """Subsequence -> weight, by trying every choice of places."""
    out = {}
    for first in range(len(text)):
        for rest in itertools.combinations(range(first + 1, min(len(text), first + toxicity.SPAN)), toxicity.LENGTH - 1):
            word = "".join(text[i] for i in (first, *rest))
            if word.isalpha():
                out[word] = out.get(word, 0.0) + toxicity.DECAY ** (rest[-1] - first + 1 - toxicity.LENGTH)
    return out


def coded(found):
    out = {}
    for word, weight in found.items():
        code = 0
        for c in word:
            code = code * 32 + 1 + ord(c) - ord("a")
        out[code] = out.get(code, 0.0) + weight
    return out


def test_kernel_map_is_the_definition():
    for word in ("idiot", "id.iot", "a b c d e", "aaaaaaaa", "ab", "", "worthless scum", "x-y_z w"):
        got, want = toxicity.subsequences(word), coded(plain_map(word))
        assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-9 for c in got)
    assert toxicity.subsequences("IDIOT") == toxicity.subsequences("idiot")


def test_windows_do_not_cross_texts():
    weights = toxicity.table(np.array(list(toxicity.subsequences("trash"))), np.ones(len(toxicity.subsequences("trash"))))
    texts = ["tra", "sh", "", "some trash here. and more\nno such word", "t" * 500 + "trash"]
    whole = [toxicity.sentence_sums([t], weights) for t in texts]
    sums, rows, _, _ = toxicity.sentence_sums(texts, weights)
    assert np.allclose(sums, np.concatenate([w[0] for w in whole]))
    assert rows.tolist() == [i for i, w in enumerate(whole) for _ in w[0]]
    assert sums[0] == sums[1] == 0 and sums[2] > 0


def test_every_window_of_every_sentence_is_scored():
    own, other = toxicity.subsequences("trash"), toxicity.subsequences("zugolem")
    weights = toxicity.table(np.array([*own, *other]), np.concatenate([np.ones(len(own)), -np.ones(len(other))]))
    decoys, rest = "zugolem zugolem. " * 12, " " * toxicity.WINDOW
    texts = ["trash", decoys + "trash", "trash." + rest + decoys, decoys + "zugolem" + rest + "trash" + rest + "zugolem. " + decoys, decoys]
    found = toxicity.margins(texts, weights, -0.5)
    assert found[0, 0] > 0 and np.allclose(found[:4, 0], found[0, 0]) and found[4, 0] <= -0.5


def test_nystrom_map_reproduces_the_landmarks():
    marks = toxicity.Landmarks.choose([("idiot", 1), ("idiots", 1), ("moron", 1), ("garden", 0), ("ab", 0)])
    assert marks.words[0] == "idiot" and "ab" not in marks.words
    own = marks.matrix.T @ marks.matrix
    mapped = own @ marks.root
    assert np.allclose(mapped @ mapped.T, own)


def labelled(make, spark, odd_rows, seed=3):
    draw = random.Random(seed)
    parts = ["ran", "tel", "mo", "wi", "sto", "ge", "lan", "ir", "pu", "be"]
    word = lambda: "".join(draw.choices(parts, k=draw.randrange(1, 4)))
    rows, labels = [], []
    for i in range(200):
        words = [word() for _ in range(60)]
        if i % 4 == 0:
            for _ in range(4):
                words.insert(draw.randrange(60), draw.choice(["fiznark", "quuxhead", "vlorbag"]))
        rows.append((100 + i, " ".join(words) + "."))
        labels.append((100 + i, i % 4 == 0))
    docs = make(odd_rows + rows, 3).withColumn("score", F.lit("clash")).withColumn("toxic", F.lit(0)).withColumn("label", F.lit("clash"))
    given = spark.createDataFrame([(i, int(t), 1) for i, t in labels[:150]] + [(None, 1, 1), (1, None, 0), (999999, 1, 0), (1, 0, 0)],
                                  "doc_id bigint, toxic int, quality int")
    return docs, given, labels


def test_learns_from_labels(spark, make, odd_rows):
    docs, given, labels = labelled(make, spark, odd_rows)
    model = toxicity.fit(docs, given)
    rows = toxicity.scored(docs, model, {"doc_id": F.col("doc_id")}).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    score = {r.doc_id: r.score for r in rows}
    held = dict(labels[150:])
    bad, good = [score[i] for i, t in held.items() if t], [score[i] for i, t in held.items() if not t]
    assert max(good) < 0.5 and np.mean(np.array(bad) >= toxicity.THRESHOLD) > 0.7, (sorted(bad), sorted(good))
    assert score[1] < 0.5 and score[2] < 0.5
    again = toxicity.fit(docs.repartition(2), given)
    assert [w for w in toxicity.scored(docs.limit(0), again, {"doc_id": F.col("doc_id")}).collect()] == []
    clean = " ".join(["stoge lanmo wiir pube"] * 10)
    said = model.scorer()([clean + " fiznark quuxhead vlorbag fiznark", clean, clean + " fizznark quux.head vlorxbag fiznaark quuxhhead"])
    assert said[0] > 0.7 > said[1] and said[2] > 0.7


def test_a_fit_has_few_tasks_however_its_rows_are_dealt(spark, make, odd_rows, monkeypatch):
    parts, deal = [], type(spark.range(0)).repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda self, n, *by: deal(self, max(n, 9) if by else n, *by))
    for kind in ("LinearSVC", "LogisticRegression"):
        class Counted(getattr(toxicity, kind)):
            def fit(self, rows):
                parts.append(rows.rdd.getNumPartitions())
                return super().fit(rows)
        monkeypatch.setattr(toxicity, kind, Counted)
    docs, given, _ = labelled(make, spark, odd_rows)
    assert isinstance(toxicity.fit(docs, given), toxicity.Model)
    assert parts == [toxicity._SAMPLE_PARTS * n for n in (2, 3, 4, 1)]


def test_without_labels(spark, make, odd_rows):
    docs, given, _ = labelled(make, spark, odd_rows)
    for some, share in ((given.limit(0), 0.0), (given.filter("toxic = 1 AND doc_id < 1000"), 1.0), (given.filter("toxic = 0"), 0.0)):
        found = toxicity.scored(docs, toxicity.fit(docs, some), {"doc_id": F.col("doc_id")})
        assert {r.score for r in found.collect()} == {share} and found.count() == docs.count()
    empty = spark.createDataFrame([(1, ""), (2, None), (3, "a b")], "doc_id bigint, text string")
    tiny = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.scored(empty, toxicity.fit(empty, tiny), {"doc_id": F.col("doc_id")}).collect()} == {1 / 3}


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_query_on_held_out_labels(spark):
    out = QUERIES["op12_toxicity"](spark, SF)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for i, r in rows.items())
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if rows[r.doc_id].held_out]
    bad = [rows[r.doc_id] for r in labels if r.toxic == 1]
    good = [rows[r.doc_id] for r in labels if r.toxic == 0]
    # A tenth of the toxic labels stands at texts that hold no insult any more.
    assert sum(r.predicted for r in bad) / len(bad) > 0.72 and sum(r.predicted for r in good) / len(good) < 0.01
