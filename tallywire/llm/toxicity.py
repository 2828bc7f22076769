"""Toxicity by a support vector machine on a gap-weighted subsequence kernel, with Nystrom landmarks.

*Kernel.* Letters are folded into 31 classes; everything else is a separator, which a subsequence may skip and never
holds. Two strings share a subsequence of ``LENGTH`` letters when both hold these letters in order within ``SPAN``
characters; every occurrence counts ``DECAY`` to the power of the characters it skips. An insult with a character put in,
left out or set apart by dots still shares most of its subsequences.

*Landmarks.* Words of the training texts, taken by how unevenly the labels share them, as long as no chosen one is too
alike. The Nystrom map of a sentence is W**-1/2 k(sentence, landmarks), W being the landmarks' own kernel matrix.

*Sentences.* A sentence has a window of ``WINDOW`` characters at each of its characters, and the best one speaks for it. A window's value is
a sum of one weight per subsequence, so all windows of all sentences are compared by looking up the subsequences that start at each character.

*Training.* Labels are of documents, the machine learns on windows, in ``ROUNDS`` linear SVMs on the map. Each round searches every window of the
sample anew and takes the best windows of the ``SHOWN`` best sentences of a document: at first by how much they cover of the landmarks that lean to
the toxic side, then by the margin of the machine before. The next machine learns on all windows so taken from clean documents, of this round and the
ones before, and on the best of toxic ones in this round. A logistic fit on a document's three best margins and its length makes probabilities.

*Scoring.* The margin is linear in the map, so it folds into one weight per subsequence as well. Every window of every sentence is scored. Texts
are scored whole in one pass without a shuffle.

The fit takes at most ``SAMPLE`` labelled rows of each label, those with the smallest hash of the id; all documents are
scored. NULL and empty texts have no sentence: their margins are the lowest that count, -1. Labels that are NULL or whose id is
NULL are not used, an id labelled twice is toxic if one of its labels is; a NULL id is scored and never held out. Without labels of both kinds every score is the share of toxic
labels, or 0. Repeated rows get equal scores. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tallywire.llm.common import slices, strings
from tallywire.session import materialize

LENGTH = 4
SPAN = 7
DECAY = 0.7
CLASSES = 32
LANDMARKS = 128
#: A word is no landmark when its cosine in the kernel to a chosen one is above this.
ALIKE = 0.8
#: Standard errors by which a word must be commoner in toxic documents, unless no word is.
MIN_Z = 4.5
SAMPLE = 4_000
ROUNDS = 3
SENTENCE = 200
SHOWN = 6
THRESHOLD = 0.7
_CANDIDATES = 4_000
#: The sample is bounded, and every step of a fit is a job over its partitions, in a union of one more round each time. The sample is
#: coalesced to this many however it is dealt, as each step also writes a shuffle file per task.
_SAMPLE_PARTS = 4
_SLICE = 1 << 19
#: The part of a sentence that speaks for it: an insult of ten letters with a character between each two fits.
WINDOW = 20
_PAD = SPAN + WINDOW
_ENDS = ".!?"
#: Offsets of the letters after the first one, with the characters skipped: all patterns inside the span.
_PATTERNS = [(c, c[-1] + 1 - LENGTH) for c in itertools.combinations(range(1, SPAN), LENGTH - 1)]


def _letter_classes() -> np.ndarray:
    """Class of each character below U+0250: 0 is a separator."""
    out = np.zeros(0x250, np.uint32)
    for code in range(0x250):
        c = chr(code)
        if "a" <= c <= "z":
            out[code] = 1 + code - ord("a")
        elif c.isdigit():
            out[code] = 27
        elif code >= 0x80 and c.isalpha():
            out[code] = 28 + code % 4
    return out


_CLASS = _letter_classes()


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of every character, sentence of every character, row of every sentence) of the lower-cased texts.

    A sentence ends behind a mark that white space follows, with its text, and after ``SENTENCE`` characters; an occurrence belongs to the
    sentence it starts in.
    """
    lower = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in lower], np.int64)
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    classes = np.where(codes < len(_CLASS), _CLASS[np.minimum(codes, len(_CLASS) - 1)], 28 + codes % 4).astype(np.uint32)
    first = np.zeros(len(codes), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    ends, blank = np.isin(codes, [ord(c) for c in _ENDS]), np.isin(codes, [9, 10, 13, 32])
    first[1:] |= (ends[:-1] & blank[1:]) | (codes[:-1] == 10)
    begins = np.flatnonzero(first)
    inside = np.arange(len(codes)) - np.repeat(begins, np.diff(np.append(begins, len(codes))))
    first |= inside % SENTENCE == 0
    begins = np.flatnonzero(first)
    rows = np.repeat(np.arange(len(texts)), sizes)
    return classes, np.cumsum(first) - 1, rows[begins]


def occurrences(classes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each pattern the code of the subsequence starting at each character, and its weight.

    Codes with a zero digit hold a separator; ``padded`` puts enough of them between texts that nothing crosses.
    """
    shifted = [classes << np.uint32(5 * (LENGTH - 1 - k)) for k in range(LENGTH)]
    size = len(classes) - SPAN + 1
    for offsets, skipped in _PATTERNS:
        code = shifted[0][:size].copy()
        for k, at in enumerate(offsets, start=1):
            code |= shifted[k][at:at + size]
        yield code, DECAY ** skipped


def padded(classes: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes with separators behind each text, and the place of each character in them."""
    if not len(classes):
        return np.zeros(_PAD, np.uint32), np.zeros(0, np.int64)
    places = np.arange(len(classes)) + _PAD * (text_of - text_of[0])
    out = np.zeros(int(places[-1]) + 1 + _PAD, np.uint32)
    out[places] = classes
    return out, places


def _whole(code: np.ndarray) -> np.ndarray:
    """Whether no letter of the subsequence is a separator."""
    out = np.ones(len(code), bool)
    for k in range(LENGTH):
        out &= (code >> np.uint32(5 * k)) & np.uint32(31) != 0
    return out


def subsequences(word: str) -> dict[int, float]:
    """The kernel's own map of one string: code of the subsequence -> weight."""
    classes, _, _ = letters([word])
    stream, _ = padded(classes, np.zeros(len(classes), np.int64))
    found: dict[int, float] = {}
    for code, weight in occurrences(stream):
        for c in code[_whole(code)].tolist():
            found[c] = found.get(c, 0.0) + weight
    return found


@dataclass(frozen=True)
class Landmarks:
    """The landmarks' subsequences as a matrix (subsequence, landmark), unit columns, and W**-1/2.

    ``lean`` is 1 for words that lean to the toxic side, ``sizes`` are their norms.
    """

    words: list[str]
    lean: np.ndarray
    sizes: np.ndarray
    codes: np.ndarray
    matrix: np.ndarray
    root: np.ndarray

    @staticmethod
    def choose(ranked: list[tuple[str, int]], most: int = LANDMARKS) -> "Landmarks":
        """The first words of ``ranked`` that are not too alike."""
        chosen, lean, sizes, maps = [], [], [], []
        for word, side in ranked:
            own = subsequences(word)
            size = sum(v * v for v in own.values()) ** 0.5
            if not size:
                continue
            own = {c: v / size for c, v in own.items()}
            if all(sum(v * other.get(c, 0.0) for c, v in own.items()) <= ALIKE for other in maps):
                chosen.append(word)
                lean.append(side)
                sizes.append(size)
                maps.append(own)
                if len(chosen) == most:
                    break
        codes = np.array(sorted(set().union(*maps)), np.int64) if maps else np.zeros(0, np.int64)
        matrix = np.zeros((len(codes), len(maps)))
        for j, own in enumerate(maps):
            matrix[np.searchsorted(codes, list(own)), j] = list(own.values())
        values, vectors = np.linalg.eigh(matrix.T @ matrix)
        keep = values > 1e-10
        return Landmarks(chosen, np.array(lean, float), np.array(sizes), codes, matrix, (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T)

    def cover(self) -> np.ndarray:
        """The weight of each subsequence in what a window covers: a whole landmark counts one."""
        return self.matrix @ (self.lean / self.sizes)

    def weights(self, svm: np.ndarray) -> np.ndarray:
        """The weight of each subsequence under a linear machine on the map."""
        return self.matrix @ (self.root @ svm)


def table(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(CLASSES ** LENGTH, np.float32)
    out[codes] = weights
    return out


def sentence_sums(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(best sum of every sentence, row of every sentence, place where its best window begins, padded classes).

    A window holds the subsequences that start in ``WINDOW`` characters from one of the sentence's own.
    """
    classes, sentence, rows = letters(texts)
    stream, places = padded(classes, rows[sentence])
    if not len(classes):
        return np.zeros(0), rows, places, stream
    by_skip: dict[float, np.ndarray] = {}
    for code, weight in occurrences(stream):
        found = weights[code]
        by_skip[weight] = by_skip[weight] + found if weight in by_skip else found
    upto = np.concatenate([[0.0], np.cumsum(sum(weight * found.astype(np.float64) for weight, found in by_skip.items()))])
    sums = upto[np.minimum(places + WINDOW, len(upto) - 1)] - upto[places]
    begins = np.flatnonzero(np.diff(sentence, prepend=-1))
    best = np.maximum.reduceat(sums, begins)
    at_best = np.flatnonzero(sums == best[sentence])
    at_best = at_best[np.diff(sentence[at_best], prepend=-1) != 0]
    return best, rows, places[at_best], stream


def _best(sums: np.ndarray, rows: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The sentences with the highest sums, ``most[row]`` of each row at most, by row."""
    order = np.lexsort([-sums, rows])
    owner = rows[order]
    place = np.arange(len(order)) - np.searchsorted(owner, owner)
    return order[place < most[owner]]


def shown(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, places of the window's characters) of the sentences the fit takes from each text, and the padded classes."""
    sums, rows, begins, stream = sentence_sums(texts, weights)
    chosen = _best(sums, rows, np.full(len(texts), SHOWN))
    return rows[chosen], begins[chosen][:, None] + np.arange(WINDOW), stream


def margins(texts: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """(the three best margins over the sentences, logarithm of the length) of every text; a sentence has that of its best window."""
    sums, rows, _, _ = sentence_sums(texts, weights)
    value = sums + bias
    order = np.lexsort([-value, rows])
    owner = rows[order]
    rank = np.arange(len(order)) - np.searchsorted(owner, owner)
    out = np.full((len(texts), 4), np.inf)
    out[owner[rank < 3], rank[rank < 3]] = value[order][rank < 3]
    out[:, :3] = np.where(np.isinf(out[:, :3]), np.minimum(-1.0, out.min(axis=1, keepdims=True)), out[:, :3])
    out[:, 3] = np.log1p([len(t) for t in texts])
    return out


def ranked_words(sample: DataFrame) -> list[tuple[str, int]]:
    """(word, 1 or 0) by how unevenly toxic and clean documents share them, mixed two to one with the commonest others."""
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: F.length(w).between(LENGTH, 40)))
    counts = sample.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good"))
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}  # two rows
    bad, good = totals.get(1, 0), totals.get(0, 0)
    gap = F.col("bad") / F.lit(bad) - F.col("good") / F.lit(good)
    share = (F.col("bad") + F.col("good")) / F.lit(bad + good)
    z = gap / F.sqrt(share * (1 - share + F.lit(1e-9)) * F.lit(1 / bad + 1 / good))
    by = counts.withColumn("z", F.round(z, 9))
    toxic = by.filter("z > 0").orderBy(F.desc("z"), "word").limit(_CANDIDATES).collect()
    toxic = [r for r in toxic if r["z"] >= MIN_Z] or toxic
    plain = by.filter("z <= 0").orderBy(F.desc("good"), "word").limit(_CANDIDATES).collect()
    left, right = [(r["word"], 1) for r in toxic], [(r["word"], 0) for r in plain]
    out = []
    while left or right:
        out += left[:2] + right[:1]
        left, right = left[2:], right[1:]
    return out


def _sentences(sample: DataFrame, marks: Landmarks, machine: np.ndarray | None) -> DataFrame:
    """(label, z: the Nystrom maps, cover) of the best sentences of each sample document by the machine, or by what they cover; a row per document."""
    width = len(marks.words)
    by = marks.cover() if machine is None else marks.weights(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, column = table(marks.codes, by), np.full(CLASSES ** LENGTH, -1, np.int32)
        column[marks.codes] = np.arange(len(marks.codes))
        for part in slices(batches, "text", _SLICE):
            rows, windows, stream = shown(strings(part, "text"), order)
            near = np.zeros((len(rows), width))
            for some in np.array_split(np.arange(len(rows)), max(1, len(rows) // 256)):
                own, found = windows[some], np.zeros((len(some), len(marks.codes)))
                for code, weight in occurrences(stream):
                    hit = column[code[np.minimum(own, len(code) - 1)]]
                    owner, _ = there = np.nonzero((hit >= 0) & (own < len(code)))
                    np.add.at(found, (owner, hit[there]), weight)
                near[some] = found @ marks.matrix
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=part.num_rows))]).astype(np.int32)
            flat = pa.array((near @ marks.root).astype(np.float32).ravel())
            yield pa.RecordBatch.from_arrays([
                part.column("toxic").cast(pa.float64()), pa.ListArray.from_arrays(pa.array(ends * width), flat),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(near @ (marks.lean / marks.sizes))),
            ], names=["label", "z", "cover"])

    return sample.mapInArrow(run, "label double, z array<float>, cover array<double>")


def _picked(seen: DataFrame, machine: tuple[np.ndarray, float] | None) -> DataFrame:
    """(label, features): all shown sentences of clean documents; of toxic ones the best, and up to three with a positive margin.

    Before there is a machine, the two that cover most.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, kept = [], []
            for label, z, cover in zip(*(c.to_pylist() for c in batch.columns)):
                if not cover:
                    continue
                maps = np.array(z).reshape(len(cover), -1)
                if label == 1:
                    margin = np.array(cover) if machine is None else maps @ machine[0] + machine[1]
                    order = np.argsort(-margin, kind="stable")
                    positive = 2 if machine is None else max(1, int((margin[order[:3]] > 0).sum()))
                    maps = maps[order[:positive]]
                labels += [label] * len(maps)
                kept += list(maps)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.float64()), pa.array(kept, pa.list_(pa.float32()))], names=["label", "features"])

    return seen.mapInArrow(run, "label double, features array<float>")


def _machine(sample: DataFrame, seen: DataFrame, marks: Landmarks) -> tuple[np.ndarray, float]:
    """(weights of the subsequences, bias): SVMs, each of which chooses the next one's windows from the whole sample."""
    machine = clean = None
    for _ in range(ROUNDS):
        best = materialize(_picked(seen if machine is None else _sentences(sample, marks, machine[0]), machine))
        clean = best.filter("label = 0") if clean is None else clean.unionByName(best.filter("label = 0"))
        picked = clean.unionByName(best.filter("label = 1")).select("label", array_to_vector(F.col("features").cast("array<double>")).alias("features"))
        share = {r["label"]: r["count"] for r in picked.groupBy("label").count().collect()}  # two rows
        even = F.when(F.col("label") == 1, sum(share.values()) / (2 * share[1.0])).otherwise(sum(share.values()) / (2 * share[0.0]))
        svm = LinearSVC(maxIter=30, regParam=1e-3, standardization=False, weightCol="weight").fit(picked.withColumn("weight", even))
        machine = np.array(svm.coefficients), float(svm.intercept)
    return marks.weights(machine[0]), machine[1]


@dataclass(frozen=True)
class Model:
    codes: np.ndarray
    weights: np.ndarray     # per code: the machine
    bias: float
    slope: np.ndarray       # of the margins
    intercept: float

    def scorer(self) -> Callable[[list[str]], np.ndarray]:
        weights = table(self.codes, self.weights)

        def scores(texts: list[str]) -> np.ndarray:
            z = margins(texts, weights, self.bias) @ self.slope + self.intercept
            return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return scores


def _margin_rows(sample: DataFrame, marks: Landmarks, weights: np.ndarray, bias: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = table(marks.codes, weights)
        for part in slices(batches, "text", _SLICE):
            found = margins(strings(part, "text"), dense, bias)
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic").cast(pa.float64()), pa.array(list(found), pa.list_(pa.float64()))], names=["label", "features"])

    return sample.mapInArrow(run, "label double, features array<double>")


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, most: int) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled ids of each label."""
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("toxic")).filter("id IS NOT NULL AND toxic IN (0, 1)") \
        .groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("id"), F.col("id")]
    some = known.filter("toxic = 1").orderBy(*order).limit(most).unionByName(known.filter("toxic = 0").orderBy(*order).limit(most))
    rows = docs.select(F.col(id_column).alias("doc"), F.coalesce(text_column, F.lit("")).alias("text"))
    return rows.join(F.broadcast(some), rows["doc"] == some["id"]).select("text", "toxic")  # at most 2 * most rows


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    sample: int = SAMPLE, landmarks: int = LANDMARKS,
) -> Model | float:
    """The model of the labelled rows, or the share of toxic ones where one label is missing."""
    rows = labelled_sample(docs, labels, id_column, text_column, label_column, sample)
    rows = materialize(rows.repartition(_SAMPLE_PARTS, F.xxhash64("text")).coalesce(_SAMPLE_PARTS))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return float(1 in counts)
    marks = Landmarks.choose(ranked_words(rows), landmarks)
    if not marks.words:
        return counts[1] / sum(counts.values())
    seen = materialize(_sentences(rows, marks, None))
    if seen.filter(F.size("cover") > 0).select("label").distinct().count() < 2:
        return counts[1] / sum(counts.values())
    weights, bias = _machine(rows, seen, marks)
    given = materialize(_margin_rows(rows, marks, weights, bias))
    curve = LogisticRegression(maxIter=25, regParam=1e-4).fit(given.select("label", array_to_vector("features").alias("features")))
    return Model(marks.codes, weights, bias, np.array(curve.coefficients), float(curve.intercept))


def scored(docs: DataFrame, model: Model | float, columns: dict[str, Column], text_column: str = "text") -> DataFrame:
    """``columns`` of every document and its score."""
    rows = docs.select(*[c.alias(n) for n, c in columns.items()], F.col(text_column).alias("_text"))
    if isinstance(model, float):
        return rows.drop("_text").withColumn("score", F.lit(model))
    names = [*columns, "score"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = model.scorer()
        for part in slices(batches, "_text", _SLICE):
            found = scores(strings(part, "_text"))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found)], names=names)

    return rows.mapInArrow(run, f"{kinds}, score double")
