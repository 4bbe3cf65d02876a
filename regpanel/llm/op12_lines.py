"""Lines that many documents share, dropped from all of them but one.

Texts are split at line feeds; a line's key is the line without ASCII white space at its ends
and with A-Z lower-cased. The positions of all lines whose key is long enough are exploded
with the key's 128-bit digest, the distinct documents per digest are counted, and
keys found in enough documents lose their lines in every document but the one with the largest id.
What is left is put together again by position.

Scale. Only digests, ids and positions are exploded and shuffled, texts move once. Counting is
two aggregations, by digest and document and then by digest, both combined before their
shuffle, so a line that every document holds arrives as one row per map task. The decisions go
back to the lines by two joins: a key that has more than one in ``HOT_SHARE`` of all exploded lines is hot, of
these there can be no more than ``HOT_SHARE``, so they are broadcast; the others are joined by digest, where no
key has more lines than that share. A document's dropped positions are collected in one row, which its own
text bounds. Rows are grouped by a digest of id and text before that, so rows repeated as a whole move once. All
steps are built-in expressions; the exploded lines and the decisions are written to the shared folder.

Defined results: a null text counts as empty, which is one empty line; rows that share an id are one
document in the count, and each has its own result; rows repeated as a whole are returned as often; rows
without an id are one document, smaller than all others. A text all of whose lines drop becomes
empty. Different keys meet under one digest with a chance of one in 2^128 a pair. An empty table gives an empty
result. Only the key and the text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Code points that a key has at least, and documents that it is found in.
LEAST_CHARS, LEAST_DOCS = 40, 5
#: The most hot keys there can be: each has more than this part of the exploded lines.
HOT_SHARE = 10_000
#: White space that is stripped: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased; other letters stay."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def keyed_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Columns row_key (a digest of id and text), doc_id, text (null: empty)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    named = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit("\n"), whole)
    return docs.select(F.unhex(F.md5(named.cast("binary"))).alias("row_key"), F.col(key).alias("doc_id"), whole.alias("text"))


def exploded_lines(rows: DataFrame, least_chars: int) -> DataFrame:
    """The long lines: row_key, doc_id, pos, line_key (128-bit digest)."""
    lines = rows.select("row_key", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    # The line is no shorter than its key, which spares most short lines the work.
    long = lines.where(F.length("line") >= least_chars).select("row_key", "doc_id", "pos", line_key(F.col("line")).alias("key"))
    return long.where(F.length("key") >= least_chars).select("row_key", "doc_id", "pos", F.unhex(F.md5(F.col("key").cast("binary"))).alias("line_key"))


def shared_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    """Keys found in ``least_docs`` documents or more: line_key, keep_id, n_lines."""
    by_doc = lines.groupBy("line_key", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    found = by_doc.groupBy("line_key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep_id"), F.sum("n").alias("n_lines"))
    return found.where(F.col("n_docs") >= least_docs).drop("n_docs")


def dropped_positions(lines: DataFrame, least_docs: int) -> DataFrame:
    """Positions that drop, per row that has any: row_key, dropped (distinct positions)."""
    shared = written(shared_keys(lines, least_docs), "shared-lines")
    hot = F.col("n_lines") * HOT_SHARE > F.lit(lines.count())
    few, many = shared.where(hot).select("line_key", "keep_id"), shared.where(~hot).select("line_key", "keep_id")
    # Fewer than HOT_SHARE keys of 24 bytes, whatever the table.
    met = lines.join(F.broadcast(few), "line_key")
    rest = lines.join(F.broadcast(few.select("line_key")), "line_key", "left_anti").join(many, "line_key")
    goes = met.unionByName(rest).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return goes.groupBy("row_key").agg(F.collect_set("pos").alias("dropped"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                least_docs: int = LEAST_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (of the lines that stay), n_lines (before), n_dropped."""
    rows = keyed_rows(docs, key, text)
    lines = written(exploded_lines(rows, least_chars), "lines")
    dropped = written(dropped_positions(lines, least_docs), "dropped-lines")
    once = rows.groupBy("row_key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("_copies"))
    # A generator keeps the split from being repeated for every line that is looked up.
    split = once.join(dropped, "row_key", "left").select("doc_id", "text", "dropped", "_copies", F.explode(F.array(F.split("text", "\n", -1))).alias("_lines"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(stays, lambda at: F.get(F.col("_lines"), at)), "\n")
    result = split.select("doc_id", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("text"),
                          F.size("_lines").cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), "_copies")
    return result.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")).drop("_copies", "_copy")


def line_digests(deduped: DataFrame) -> DataFrame:
    """Columns doc_id, n_lines, n_dropped, kept_sha256."""
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, pos, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
           FROM (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
k AS (SELECT doc_id, pos, line, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keep_id AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
