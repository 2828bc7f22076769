"""Boilerplate lines by their frequency on a site.

For each host, a line's ratio is the number of the host's pages that hold it over all
pages of the host. Lines above ``ratio`` that stand on at least ``min_pages`` pages are dropped from every page of
that host. Lines are compared exactly; those without a visible character are kept.

Counting shuffles two hashes of a line instead of its text, combined before the shuffle, so a
line that stands on a third of all pages is one row per task. What is dropped is then looked up
per page, and pages with nothing to drop pass unchanged.

A NULL text stays NULL; a NULL host is a host of its own; a row that repeats a page id counts as a page
of its own. All columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RATIO = 0.1
MIN_PAGES = 5


def drop_boilerplate(
    pages: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source",
    ratio: float = RATIO, min_pages: int = MIN_PAGES, count_column: str | None = "n_dropped",
) -> DataFrame:
    """``pages`` with ``text_column`` rewritten, and in ``count_column``, if named, the number of lines that went."""
    host, page = F.coalesce(F.concat(F.lit("h"), F.col(host_column).cast("string")), F.lit("")), F.col(id_column)
    lines = F.split(F.col(text_column), "\n", -1)
    shown = F.filter(F.array_distinct(lines), lambda x: F.trim(F.translate(x, "\t\r\f\x0b", "    ")) != "")
    mark = lambda x: F.struct(F.xxhash64(x).alias("h"), F.crc32(x.cast("binary")).alias("c"), F.length(x).alias("n"))
    keyed = pages.select(host.alias("host"), page.alias("page"), F.explode(F.transform(shown, mark)).alias("line")) \
        .select("host", "page", "line.*")
    sizes = pages.groupBy(host.alias("host")).agg(F.count("*").alias("pages"))
    held = keyed.groupBy("host", "h", "c", "n").agg(F.count("*").alias("held")).filter(F.col("held") >= min_pages)
    common = held.join(sizes, "host").filter(F.col("held") > F.lit(ratio) * F.col("pages")).select("host", "h", "c", "n")
    # At most (lines of a page / ratio) lines of a host are common, so a page's list is bounded by that.
    per_page = keyed.join(common, ["host", "h", "c", "n"], "left_semi").groupBy("host", "page").agg(
        F.collect_set(F.struct("h", "c", "n")).alias("_drop"))
    named = pages.select(F.struct("*").alias("_row"), host.alias("host"), page.alias("page"))
    joined = named.join(per_page, named["host"].eqNullSafe(per_page["host"]) & named["page"].eqNullSafe(per_page["page"]), "left")
    old = F.split(F.col("_row")[text_column], "\n", -1)
    kept = F.filter(old, lambda x: ~F.array_contains("_drop", mark(x)))
    text = F.when(F.col("_drop").isNull(), F.col("_row")[text_column]).otherwise(F.array_join(kept, "\n"))
    dropped = F.when(F.col("_drop").isNull(), 0).otherwise(F.size(old) - F.size(kept))
    return joined.select(*[
        (text if c == text_column else F.col("_row")[c]).alias(c) for c in pages.columns
    ], *([dropped.cast("bigint").alias(count_column)] if count_column else []))


ORACLE = f"""
WITH lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents),
held AS (SELECT source, line, count(DISTINCT doc_id) AS held FROM lines WHERE regexp_matches(line, '[^\\t-\\r ]') GROUP BY 1, 2),
sizes AS (SELECT source, count(*) AS pages FROM documents GROUP BY 1),
common AS (SELECT source, line FROM held JOIN sizes USING (source)
           WHERE held >= {MIN_PAGES} AND held > CAST({RATIO} AS DOUBLE) * pages),
numbered AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS at FROM documents),
marked AS (SELECT n.*, c.line IS NOT NULL AS gone FROM numbered n LEFT JOIN common c USING (source, line))
SELECT d.doc_id, coalesce(string_agg(m.line, chr(10) ORDER BY m.at) FILTER (WHERE NOT m.gone), '') AS text,
       CAST(count_if(m.gone) AS BIGINT) AS n_dropped
FROM documents d JOIN marked m USING (doc_id) GROUP BY d.doc_id
"""
