"""Operator 13: line dedup by range-partitioned hashes and keep bitmaps, all with DataFrame functions.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys become
128-bit hashes, which are range-partitioned together with the document and sorted by (hash,
document, position) inside the partitions, so a frequent line spreads over many ranges. Each
range streams its rows in that order and passes on the first occurrence of a key in a document;
these are counted by key, the counts of one range before the shuffle. Keys found in
``min_docs`` documents or more drop their lines. What comes back is no text but one keep bitmap
per document that loses a line, compressed to runs of kept lines (``apply_bitmaps`` cuts texts by it).

Documents are told apart by id: rows that share an id (null ids too) count as one document, and
each of their texts gets its own bitmap. Null and empty texts are one empty line; empty keys are
never dropped. A very long text is one row of its task; its lines spread like all others. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traveltiers.llm.common import cut, table

MIN_DOCS = 10
_BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower_ascii(c: Column) -> Column:
    """A-Z lower-cased and nothing else; the quicker ``lower`` where the text has only ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def _lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def _named(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc, th, t): the id, a hash that tells texts of one id apart, and the text."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(t).alias("th"), t.alias("t"))


def line_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(h1, h2, doc, pos, th, n): a row per line with a non-empty key; n is the number of lines of its text."""
    split = _named(docs, text, key).select("doc", "th", _lines(_lower_ascii(F.col("t"))).alias("a"))
    rows = split.select("doc", "th", F.size("a").alias("n"), F.posexplode("a").alias("pos", "line"))
    rows = rows.select("doc", "th", "n", "pos", F.btrim("line", F.lit(_BLANK)).alias("line")).where(F.col("line") != "")
    return rows.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"), "doc", "pos", "th", "n")


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc, th, n, n_dropped, keep) for each text that loses a line.

    ``keep`` is the bitmap of kept lines as runs (start, n), in order. With ``keep_first`` the
    first occurrence of a frequent key, by document and position, stays.
    """
    order = ["h1", "h2", "doc", "pos"]
    ranged = cut(line_rows(docs, text, key).repartitionByRange("h1", "h2", "doc").sortWithinPartitions(*order, "th"))
    w = Window.partitionBy("h1", "h2", "doc").orderBy("pos", "th")
    firsts = ranged.withColumn("nth", F.row_number().over(w)).where("nth = 1")
    at = F.struct("doc", "pos", "th")
    often = firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.min(at).alias("first")).where(F.col("docs") >= min_docs)
    dropped = ranged.join(often.select("h1", "h2", *(["first"] if keep_first else [])), ["h1", "h2"])
    if keep_first:
        dropped = dropped.where(~at.eqNullSafe(F.col("first")))
    # Repeated rows of one id and text bring the same positions; the set holds them once.
    by_text = dropped.groupBy("doc", "th").agg(F.first("n").alias("n"), F.array_sort(F.collect_set("pos")).alias("gone"))
    before = F.concat(F.array(F.lit(-1)), F.col("gone"))
    gaps = F.transform(F.concat(F.col("gone"), F.array("n")),
                       lambda x, i: F.struct((F.get(F.col("before"), i) + 1).alias("start"), (x - F.get(F.col("before"), i) - 1).alias("n")))
    return by_text.withColumn("before", before).select(
        "doc", "th", "n", F.size("gone").alias("n_dropped"), F.filter(gaps, lambda g: g["n"] > 0).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc, n_lines, n_dropped, kept) per row: the text without the lines that its bitmap leaves out."""
    bits = bitmaps.select(F.col("doc").alias("bdoc"), F.col("th").alias("bth"), "n_dropped", "keep")
    joined = _named(docs, text, key).join(bits, F.col("doc").eqNullSafe(F.col("bdoc")) & (F.col("th") == F.col("bth")), "left")
    lines = _lines(F.col("t"))
    cut_text = F.array_join(F.flatten(F.transform("keep", lambda g: F.slice(F.col("a"), g["start"] + 1, g["n"]))), "\n")
    return joined.withColumn("a", lines).select(
        "doc", F.size("a").cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.col("t")).otherwise(cut_text).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = apply_bitmaps(docs, keep_bitmaps(docs))
    return out.select(F.col("doc").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH rows_of AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
split_up AS (SELECT doc_id, rid, string_split(t, chr(10)) AS a FROM rows_of),
lines AS (
  SELECT doc_id, rid, unnest(a) AS line, unnest(range(len(a))) AS pos FROM split_up),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k FROM lines),
often AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= {MIN_DOCS}),
marked AS (SELECT keyed.*, often.k IS NOT NULL AS gone FROM keyed LEFT JOIN often ON keyed.k = often.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id
"""
