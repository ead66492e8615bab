"""Secrets and how widely each is owned, in DataFrame functions only (operator 7).

Candidates are the base matches of three patterns and looser ones (mixed tokens of 24
characters or more, without an upper bound).
Each candidate's hash is counted over the whole corpus by distinct repositories and
distinct owners.  What many owners hold is an example that was copied about; a value
that at most ``owners`` owners hold looks live.  Looser candidates are added as spans
only where they look live; base spans always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velocast.llm.shared import fresh, keep
from velocast.llm.spans import SPAN, digest, matches

KINDS = ("assign", "access", "hex")
#: The key words and forms of the base patterns.
NAME = r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?"
ASSIGN = NAME + r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: A whole run, however long; that it has a digit and letters of both cases is told afterwards.
LOOSE = r"[A-Za-z0-9+/_=-]{24,}+"


def base(text: Column) -> Column:
    """The base spans of a non-null text, by start, then kind as in KINDS."""
    assign = F.filter(matches(text, ASSIGN, "assign"), lambda x: F.length(secret_of(x)) >= 12)
    return by_start(F.concat(assign, matches(text, ACCESS, "access"), matches(text, HEX, "hex")))


def secret_of(x: Column) -> Column:
    """The value itself, without the name before it."""
    return F.when(x["kind"] == "assign", F.regexp_replace(x["value"], "^" + NAME, "")).otherwise(x["value"])


def mixed(value: Column) -> Column:
    """Whether a token has a digit and letters of both cases."""
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def by_start(spans: Column) -> Column:
    rank = F.create_map(*[F.lit(v) for i, k in enumerate((*KINDS, "token")) for v in (k, i)])
    return F.transform(F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("s"), rank[x["kind"]].alias("r"), x.alias("x")))), lambda y: y["x"])


def find(docs: DataFrame, text: str = "text", repository: str = "source", owner: str = "source",
         owners: int = 2, carried: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carried``, which need ``repository`` and ``owner``) with ``base_spans``, ``spans`` and ``n_live``, how many spans look live.

    A null text counts as empty.  A null repository or owner counts as one of its own
    name.  Rows are independent but for the corpus counts, where repeated rows add no
    owner; extra columns come through, clashing names included.
    """
    b, m, s, live, rid = fresh(docs, "base_spans", "more_spans", "spans", "n_live", "row_key")
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    d = docs.withColumn(b, base(t))
    d = d.withColumn(m, F.filter(F.when(t.rlike("[A-Za-z0-9+/_=-]{24}"), matches(t, LOOSE, "token")).otherwise(F.array().cast(SPAN)), lambda x: mixed(x["value"]) & ~F.exists(
        F.col(b), lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))))
    if carried is not None:
        d = d.select(*[F.col(f"`{x}`") for x in carried], b, m)
    d = keep(d.withColumn(rid, F.monotonically_increasing_id()))  # the text is scanned once
    has = (F.size(b) > 0) | (F.size(m) > 0)
    some = d.where(has)
    none = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00none"))
    cands = some.select(rid, none(repository).alias("repo"), none(owner).alias("own"),
                        F.explode(F.concat(b, m)).alias("x")).withColumn("hash", F.sha2(secret_of(F.col("x")), 256))
    held = cands.select("hash", "repo", "own").distinct()
    n_own = held.select("hash", "own").distinct().groupBy("hash").agg(F.count("*").alias("n_own"))
    n_repo = held.select("hash", "repo").distinct().groupBy("hash").agg(F.count("*").alias("n_repo"))
    counts = n_own.join(n_repo, "hash")
    judged = cands.join(counts, "hash").withColumn(
        "live", (F.col("n_own") <= owners) & (F.col("n_repo") <= owners) & (F.size(F.array_distinct(F.split(F.col("x.value"), ""))) > 4))
    per = judged.groupBy(rid).agg(
        F.collect_list(F.when(F.col("live") & (F.col("x.kind") == "token"), F.col("x"))).alias("\x01more"),
        F.sum(F.col("live").cast("long")).alias("\x01live"))
    full = some.join(per, rid).withColumn(s, by_start(F.concat(F.col(b), F.col("\x01more")))).withColumn(
        live, F.col("\x01live")).drop(rid, "\x01more", "\x01live")
    return d.where(~has).withColumn(s, F.array().cast(SPAN)).withColumn(live, F.lit(0).cast("long")).drop(rid).unionByName(full).drop(m)


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    d = find(docs.select(F.col(f"`{id_col}`"), F.col(f"`{source}`").alias("source"),
                         F.col(f"`{text}`").cast("string").alias("\x00t")), "\x00t", carried=[id_col, "source"])
    n = lambda k: F.size(F.filter("base_spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return d.select(id_col, *[n(k) for k in KINDS], F.sha2(digest(F.col("base_spans")), 256).alias("base_sha256"),
                    digest(F.col("spans")).alias("spans"), "n_live")
