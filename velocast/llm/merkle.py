"""Merkle manifest of a dataset by sibling-shift self-joins (operator 13).

Leaves are numbered within their group.  At each level the nodes of slot zero compute the
indices of their siblings by adding the slot offsets 1 .. arity - 1 to their own, meet them in
an equi-join of the level with itself, and emit the parent: the hash of the run's digests in
order.  The runs' digests are kept by level; a proof is put together from the top down, each
run taking over the path of its parent, so a leaf joins one row only.

Every join is on (group, index): no key holds more than ``arity`` rows, however large a group
is.  Leaves are numbered by a range shuffle on (group, order, digest, row), so that equal ids
and repeated rows are spread too; the driver holds no digest, only the largest group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velocast.llm.shared import keep

HEX = 64
_ROW = 33  # bits of the row number in monotonically_increasing_id()


def h(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """``-`` if null, else the UTF-8 byte count, ``:`` and the value as text."""
    s = c.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a group ``g``) and ``i``, its place in the group from 0 by ``order``, and
    ``n``, the group's size.  Rows that are equal in ``order`` are numbered in any order."""
    rows = rows.withColumn("tag", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("g", *order, "tag").sortWithinPartitions("g", *order, "tag")
    rows = keep(rows.drop("tag").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", _ROW)
    # at most a row for each partition and group
    parts = rows.groupBy(part.alias("part"), "g").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("m"))
    parts = parts.selectExpr("part", "g", "low", "sum(m) OVER (PARTITION BY g ORDER BY part) - m AS before",
                             "sum(m) OVER (PARTITION BY g) AS n")
    out = rows.withColumn("part", part).join(parts, ["part", "g"])
    return out.withColumn("i", F.col("at") - F.col("low") + F.col("before")).drop("part", "at", "low", "before")


def levels(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """From (g, i, n, d): for each level its runs (g, r, n, w), ``w`` the run's digests in order
    and ``n`` the number of runs of the group; and (g, root)."""
    nodes, runs, roots = nodes.select("g", "i", "n", "d"), [], nodes.where("n = 1").select("g", F.col("d").alias("root"))
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level = nodes.where("n > 1")
        offsets = F.sequence(F.lit(0), F.least(F.lit(arity), F.col("n") - F.col("i")).cast("int") - 1)
        ask = level.where(F.col("i") % arity == 0).select("g", (F.col("i") / arity).cast("long").alias("r"), "n",
                                                        F.col("i").alias("zero"), F.explode(offsets).alias("slot"))
        ask = ask.withColumn("i", F.col("zero") + F.col("slot"))
        met = ask.join(level.select("g", "i", "d"), ["g", "i"])
        run = met.groupBy("g", "r").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("slot", "d"))).alias("s"))
        run = keep(run.select("g", "r", F.ceil(F.col("n") / arity).cast("long").alias("n"), F.array_join(F.col("s.d"), "").alias("w")))
        runs.append(run)
        nodes = run.select("g", F.col("r").alias("i"), "n", h(F.col("w")).alias("d"))
        roots = roots.unionByName(nodes.where("n = 1").select("g", F.col("d").alias("root")))
        most = -(-most // arity)
    return runs, roots


def _below(nodes: DataFrame, parents: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (g, i, ...) with the path of each, from the run it stands in; a run without
    digests holds a node alone at the top, whose path is what lies above."""
    run = parents.withColumnsRenamed({"w": "run", "path": "above"})
    out = nodes.withColumn("r", (F.col("i") / arity).cast("long")).join(run, ["g", "r"])
    step = F.struct((F.col("i") % arity).cast("int").alias("slot"), F.col("run").alias("w"))
    return out.withColumn("path", F.when(F.col("run").isNull(), F.col("above")).otherwise(
        F.concat(F.array(step), "above"))).drop("r", "run", "above")


def proofs(nodes: DataFrame, runs: list[DataFrame], top: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (g, i, n, ...) with ``path``: (slot, w) of each level from the node's to the top,
    followed by what ``top`` (g, path, ...) has above the group; its other columns are added."""
    extra = [c for c in top.columns if c not in ("g", "path")]
    alone = lambda df: df.where("n = 1").select("g").distinct()
    parents = None
    for j in range(len(runs), -1, -1):
        level = runs[j - 1].select("g", F.col("r").alias("i"), "n", "w") if j else nodes
        # groups that end at this level: one node, below which the path above the group begins
        ends = alone(level).join(top, "g").select("g", F.lit(0).cast("long").alias("r"), F.lit(None).cast("string").alias("w"), "path", *extra)
        parents = ends if parents is None else parents.unionByName(ends)
        level = _below(level, parents, arity)
        if j:
            parents = keep(level.select("g", F.col("i").alias("r"), "w", "path", *extra))
    return level


def left(x: Column) -> Column:
    return F.substring(x["w"], F.lit(1), x["slot"] * HEX)


def right(x: Column) -> Column:
    return F.substring(x["w"], (x["slot"] + 1) * HEX + 1, F.length(x["w"]))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    return h(F.array_join(F.transform(path, lambda x: F.concat(left(x), right(x))), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda d, x: h(left(x), d, right(x)))


def manifest(docs: DataFrame, fields: list[str], order: str = "doc_id", group: str = "lang", arity: int = 8,
             changed: dict[str, Column] | None = None) -> DataFrame:
    """(order, group, leaf, other, i, n, subroot, root, path), one row per row of ``docs``.

    A leaf hashes ``fields`` (see :func:`field`).  Leaves of a group ascend by ``order``, null
    first; rows of equal ``order`` by digest.  While several nodes remain, every ``arity``
    consecutive ones (the last run: fewer, even one) become the hash of their digests; what
    remains is ``subroot``, for a lone leaf the leaf.  Subroots, ordered by group as bytes of
    UTF-8, null first, give ``root`` likewise.  ``path`` holds slot and digests of each run from
    the leaf to the root.  ``other`` is the leaf with the columns of ``changed`` in place of the
    fields of that name, for checks of tampering.  A null group is a group; repeated rows are
    leaves each; an empty table gives an empty one.
    """
    changed = changed or {}
    cols = {c: F.col(f"`{c}`") for c in fields}
    g = F.col(f"`{group}`").cast("string")
    leaves = keep(docs.select(
        # null before all other groups, the empty one included
        F.when(g.isNull(), "").otherwise(F.concat(F.lit("."), g)).alias("g"), F.col(f"`{order}`").alias("o"),
        h(*[field(c) for c in cols.values()]).alias("d"),
        h(*[field(changed.get(n, c)) for n, c in cols.items()]).alias("e")))
    leaves = keep(numbered(leaves, ["o", "d", "e"]))
    runs, subroots = levels(leaves, arity)
    subs = keep(numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("root").alias("d")), ["name"]))
    over, roots = levels(subs, arity)
    top = roots.select("g", F.array().cast("array<struct<slot:int,w:string>>").alias("path"), "root")
    top = proofs(subs, over, top, arity).select(F.col("name").alias("g"), "path", F.col("d").alias("subroot"), "root")
    out = proofs(leaves, runs, keep(top), arity)
    return out.select(F.col("o").alias(order), F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias(group),
                      F.col("d").alias("leaf"), F.col("e").alias("other"), "i", "n", "subroot", "root", "path")


def audit(docs: DataFrame, fields: list[str], order: str = "doc_id", group: str = "lang", arity: int = 8,
          changed: dict[str, Column] | None = None) -> DataFrame:
    """The manifest as digests: (order, leaf, subroot, root, proof_sha256, folded_root, verified).

    ``folded_root`` folds the leaf with the columns of ``changed`` along the original siblings;
    ``verified`` tells whether it equals the root.
    """
    m = manifest(docs, fields, order, group, arity, changed)
    m = m.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": fold(F.col("other"), F.col("path"))})
    return m.select(order, "leaf", "subroot", "root", "proof_sha256", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))
