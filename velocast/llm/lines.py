"""Line dedup over a whole corpus (operator 11).

Every text is exploded into lines, each line is normalised and hashed, and distinct documents
are counted for each hash.  Lines whose hash is in ``min_docs`` documents or more are dropped
except in the document of the smallest id that holds one; what stays is put together again by
position.

Only hashes, ids and positions are exploded and shuffled; each text is shuffled once, as its
array of lines, to meet the positions that it loses.  The count is combined by (hash, id)
before it is combined by hash.  Hashes that hold at least 1/``HOT`` of all repeated lines are
``HOT`` at most, by counting, so these are broadcast; the others meet their lines in a join in
which no key holds more than that share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velocast.llm.shared import fresh, keep

BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOT = 10_000


def trim(line: Column) -> Column:
    """The line without space, tab, CR, LF, VT, FF at its ends."""
    return F.btrim(line, F.lit(BLANK))


def lower(x: Column) -> Column:
    """A-Z lower-cased; lower() changes no more than that where every character is one byte."""
    return F.when(F.octet_length(x) == F.char_length(x), F.lower(x)).otherwise(F.translate(x, UPPER, LOWER))


def split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def exploded(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, k1, k2, pos, h): the lines that count, by row key and position, with 128-bit hashes."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    lines = rows.select("id", *row_key("id", "text"), F.posexplode(split(F.col("text"))).alias("pos", "line"))
    # a generator is evaluated once, a column would be for each use of it
    lines = lines.select("id", "k1", "k2", "pos", F.explode(F.array(trim(F.col("line")))).alias("x")).where(F.char_length("x") >= min_chars)
    return lines.select("id", "k1", "k2", "pos", F.unhex(F.substring(F.sha2(lower(F.col("x")), 256), 1, 32)).alias("h"))


def row_key(id_col: str, text: str) -> list[Column]:
    """128 bits of id and text: rows that are equal in both lose the same lines."""
    return [F.xxhash64(id_col, text).alias("k1"), F.xxhash64(text, id_col).alias("k2")]


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
             min_docs: int = 2) -> DataFrame:
    """(h, n_docs, n_lines, first_id) of the normalised lines in ``min_docs`` documents or more."""
    return _counted(exploded(docs, id_col, text_col, min_chars), min_docs)


def _counted(lines: DataFrame, min_docs: int) -> DataFrame:
    per_doc = lines.groupBy("h", "id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("h").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_lines"),
                                    F.min("id").alias("first_id")).where(F.col("n_docs") >= min_docs)


def _lost(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """(k1, k2, lost): by row key, the positions of the lines to drop."""
    lines = keep(exploded(docs, id_col, text_col, min_chars))  # hashes and positions: the texts are split once
    found = keep(_counted(lines, min_docs).select("h", "n_lines", "first_id"))
    total = found.agg(F.sum("n_lines")).first()[0] or 0
    # at most HOT hashes can each hold this share of the lines
    hot = found.where(F.col("n_lines") * HOT > total).select("h", "first_id")
    rest = found.where(F.col("n_lines") * HOT <= total).select("h", "first_id")
    hit = lines.join(F.broadcast(hot), "h").unionByName(
        lines.join(F.broadcast(hot.select("h")), "h", "left_anti").join(rest, "h"))
    drop = hit.where(~F.col("id").eqNullSafe(F.col("first_id"))).select("k1", "k2", "pos").distinct()
    return drop.groupBy("k1", "k2").agg(F.collect_list("pos").alias("lost"))


def _marked(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> tuple[DataFrame, str, str]:
    """``docs`` with its lines as an array, and the positions lost (null: none), and those columns' names."""
    k1, k2, lines, lost = fresh(docs, "k1", "k2", "lines", "lost")
    text = F.col(f"`{text_col}`")
    key = row_key(F.col(f"`{id_col}`"), F.coalesce(text, F.lit("")))
    found = _lost(docs, id_col, text_col, min_chars, min_docs).toDF(k1, k2, lost)
    # the split is made below the join, so that the lambda above it reads an array that stands
    rows = docs.withColumns({k1: key[0], k2: key[1], lines: split(text)}).drop(text_col)
    return rows.join(found, [k1, k2], "left").drop(k1, k2), lines, lost


def _kept(lines: str, lost: str) -> Column:
    """The lines that stay, joined; linear in the number of lines."""
    at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost))
    return F.when(F.col(lost).isNull(), F.array_join(lines, "\n")).otherwise(
        F.array_join(F.transform(at, lambda i: F.get(F.col(lines), i)), "\n"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
          min_docs: int = 2) -> DataFrame:
    """``docs`` without the lines that repeat across documents: same rows, columns and order of columns.

    A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at its ends, A-Z
    lower-cased.  Keys of at least ``min_chars`` code points that at least ``min_docs``
    documents hold lose all their lines, except in the document of the smallest id, which
    keeps all it has.  Rows of one id are one document; the rows without an id are one
    document too, which comes last.  Null text stays null, a text that loses all its lines
    becomes empty, and an empty table stays empty.
    """
    rows, lines, lost = _marked(docs, id_col, text_col, min_chars, min_docs)
    out = rows.withColumn(text_col, _kept(lines, lost))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
           min_docs: int = 2) -> DataFrame:
    """(id, n_lines, n_dropped, kept_sha256), one row per row of ``docs``; rules of :func:`dedup`.

    Null or empty text is one empty line.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(text_col))
    rows, lines, lost = _marked(rows, id_col, text_col, min_chars, min_docs)
    return rows.select(id_col, F.size(lines).cast("long").alias("n_lines"),
                       F.when(F.col(lost).isNull(), 0).otherwise(F.size(lost)).cast("long").alias("n_dropped"),
                       F.sha2(_kept(lines, lost), 256).alias("kept_sha256"))
