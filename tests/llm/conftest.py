import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars int"


@pytest.fixture
def make(spark):
    """documents from (doc_id, text) or (doc_id, text, source) rows."""
    def build(rows, parts=2):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(parts)
    return build


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, a very long one, ties and a repeated row."""
    long = " ".join(f"word{i % 997} and{i}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n "), (4, long), (5, "same words here"), (6, "same words here"), (6, "same words here"),
            (None, "no id at all"), (7, "Ünïcode ﬁ 中文 <|endoftext|> ① ▁x"), (8, "a" * 5000), (9, None)]
