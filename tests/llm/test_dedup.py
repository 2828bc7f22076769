"""Near-duplicates, repeated strings and lines against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallywire.llm import line_dedup, simhash, suffix_dedup
from tallywire.llm.common import link_components


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(fps, radius):
    """{index: smallest index reachable}, all pairs compared."""
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("radius,blocks,tile", [(3, 6, 4096), (3, 6, 8), (1, 3, 5), (6, 8, 16)])
def test_links_lose_nothing(spark, radius, blocks, tile):
    draw = random.Random(radius)
    fps = {draw.getrandbits(64) for _ in range(150)}
    for x in list(fps)[:60]:
        for _ in range(4):
            for b in draw.sample(range(64), draw.randint(1, radius + 2)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps, key=signed)
    table = spark.createDataFrame([(signed(x), signed(x), []) for x in fps], "node bigint, fp bigint, more array<bigint>")
    got = {r.node: r.component for r in link_components(simhash.link_fingerprints(table, radius, blocks, tile=tile)).collect()}
    label = plain_components(fps, radius)
    want = {signed(x): signed(fps[c]) for x, c in zip(fps, label) if label.count(c) > 1}
    assert got == want


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 12), st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=80))
def test_bit_sliced_distances(radius, fps):
    fps = np.array(fps + [fps[0] ^ 0b1011, fps[0] ^ ((1 << radius) - 1)], np.uint64)
    planes = simhash.bit_planes(fps)
    words = len(fps) // 64 + (len(fps) % 64 > 0)
    for q in fps[:5]:
        entry, hits = simhash.close_words(planes, np.full(words, q), np.arange(words), np.full(words, 2**64 - 1, np.uint64), radius)
        got = {64 * e + b for e, h in zip(entry.tolist(), hits.tolist()) for b in range(64) if h >> b & 1 and 64 * e + b < len(fps)}
        assert got == {i for i, f in enumerate(fps) if bin(int(f ^ q)).count("1") <= radius}


def test_components_of_odd_rows(make, odd_rows):
    rows = odd_rows + [(50 + i, "Same  WORDS\there") for i in range(20)]
    docs = make(rows).withColumn("fp", F.lit("a clash")).withColumn("node", F.lit(1))
    got = simhash.near_components(docs, tile=4).collect()
    ids = [i for i, _ in rows]
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(fps, 3)
    want = sorted((i or -1, f, min((ids[j] for j in range(len(ids)) if label[j] == c and ids[j] is not None), default=None) or -1)
                  for i, f, c in zip(ids, fps, label))
    assert sorted((r.doc_id or -1, r.fp % (1 << 64), r.component_id or -1) for r in got) == want
    assert simhash.near_components(docs.limit(0)).count() == 0


def test_confirmation_keeps_strangers_apart(make):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [draw.choice(words) for _ in range(300)]
    near = list(base)
    near[100] = "changed"
    other = [draw.choice(words) for _ in range(300)]
    docs = make([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(other)), (4, " ".join(other[150:] + base[150:]))])
    got = {r.doc_id: r.component_id for r in simhash.near_components(docs, radius=10, blocks=12, confirm=simhash.Confirm()).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_chains_and_stars_of_links(spark):
    chain = [(i, i + 1) for i in range(60)] + [(200, 300 + i) for i in range(500)] + [(900, 900), (-5, 10**15)]
    got = {r.node: r.component for r in link_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, **{300 + i: 200 for i in range(500)}, -5: -5, 10**15: -5}


def plain_removal(rows, length=50):
    """{position in rows: (removed spans, bytes left)} with every window looked up."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first[b[p:p + length]] = min(first.get(b[p:p + length], 1 << 63), i if i is not None else (1 << 63) - 1)
    out = []
    for i, t in rows:
        b, own = (t or "").encode(), i if i is not None else (1 << 63) - 1
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < own:
                gone[p:p + length] = True
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1)) if len(b) else 0
        out.append((-1 if i is None else i, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out)


def removal(out):
    return sorted((-1 if r.row.doc_id is None else r.row.doc_id, r.n_bytes, len(r.begins), bytes(r.kept)) for r in out.collect())


@pytest.mark.parametrize("batch_bytes,hot", [(8 << 20, 2000), (700, 3), (3000, 10)])
def test_repeated_strings(make, odd_rows, batch_bytes, hot):
    draw = random.Random(9)
    alphabet = "abcdeé "
    passages = ["".join(draw.choice(alphabet) for _ in range(n)) for n in (49, 50, 51, 80, 200)]
    rows = list(odd_rows)
    for i in range(60):
        parts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 90)))]
        for _ in range(draw.randint(0, 3)):
            parts += [draw.choice(passages), "".join(draw.choice("xyz") for _ in range(draw.randint(0, 8)))]
        rows.append((draw.randint(10, 60), "".join(parts)))
    rows += [(70 + i, "ab" * draw.randint(20, 90)) for i in range(6)] + [(80, "a" * 120), (81, rows[20][1]), (82, rows[20][1])]
    docs = make(rows, 3).withColumn("kept", F.lit("a clash")).withColumn("batch", F.lit(1))
    assert removal(suffix_dedup.remove_repeats(docs, batch_bytes=batch_bytes, hot=hot)) == plain_removal(rows)


def test_repeats_of_an_empty_table(make):
    assert suffix_dedup.remove_repeats(make([(1, "x")]).limit(0)).count() == 0
    assert removal(suffix_dedup.remove_repeats(make([(1, None), (2, "")]))) == [(1, 0, 0, b""), (2, 0, 0, b"")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.text("ab", max_size=12)), min_size=1, max_size=12), st.randoms())
def test_merge_sort_orders_suffixes(pieces, draw):
    data, at, ids, groups = b"", [], [], {}
    for group, text in pieces:
        groups.setdefault(group, []).append(text.encode().ljust(12, b"c") * 5)
    origin = []
    sizes = []
    for group in groups.values():
        sizes.append(len(group))
        for b in group:
            at.append(len(data))
            origin += [len(data)] * len(b)
            data += b
            ids.append(draw.randint(0, 3))
    s = suffix_dedup.Suffixes(np.frombuffer(data, np.uint8), np.array(origin), np.array(at))
    rank = s.merge_sort(np.array(sizes), np.array(ids))
    low = 0
    for n in sizes:
        want = sorted(range(low, low + n), key=lambda i: (data[at[i]:at[i] + 50], ids[i], i))
        assert rank[low:low + n].tolist() == want
        low += n
    same = s.equal_to_next(rank, np.array(sizes))
    text = [data[at[i]:at[i] + 50] for i in rank]
    edges = set(np.cumsum(sizes).tolist())
    assert same.tolist() == [text[i] == text[i + 1] and i + 1 not in edges for i in range(len(rank) - 1)]


def test_every_window_has_one_record():
    draw = np.random.default_rng(1)
    data = draw.integers(97, 100, 5000).astype(np.uint8)
    ends = np.array([0, 30, 80, 80, 1500, 1549, 5000])
    r = suffix_dedup.anchored(data, ends)
    got = suffix_dedup._ranges(r.start, r.stop - r.start).tolist()
    bounds = [0, *ends.tolist()]
    assert got == [p for a, b in zip(bounds, bounds[1:]) for p in range(a, b - 49)]


def plain_lines(rows, ratio, least):
    pages, held = {}, {}
    for _, t, s in rows:
        pages[s] = pages.get(s, 0) + 1
        for line in {x for x in (t or "").split("\n") if re.search(r"[^ \t\r\f\v]", x)} if t is not None else ():
            held[s, line] = held.get((s, line), 0) + 1
    drop = {k for k, n in held.items() if n >= least and n > ratio * pages[k[0]]}
    return sorted((i or -1, s or "", t if t is None else "\n".join(x for x in t.split("\n") if (s, x) not in drop)) for i, t, s in rows)


def test_lines_of_a_site(make):
    draw = random.Random(2)
    rows = []
    for i in range(120):
        lines = [f"own {i} {k}" for k in range(draw.randint(0, 4))] + draw.sample(["menu", "rare", " ", "", "foot\r", "Ünï"], draw.randint(0, 5))
        draw.shuffle(lines)
        rows.append((i, "\n".join(lines), draw.choice(["a", "b", None])))
    rows += [(500, None, "a"), (501, "", "c"), (None, "menu\nx", "a"), (7, rows[7][1], rows[7][2]), (600, "menu\n" * 3000 + "z", "a")]
    docs = make(rows).withColumn("_row", F.lit(0)).withColumn("host", F.lit("clash"))
    out = line_dedup.drop_boilerplate(docs, ratio=0.4, min_pages=5)
    assert out.columns == [*docs.columns, "n_dropped"]
    assert sorted((r.doc_id or -1, r.source or "", r.text) for r in out.collect()) == plain_lines(rows, 0.4, 5)
    assert line_dedup.drop_boilerplate(docs.limit(0)).count() == 0
