"""Embedding near-dedup by spherical-cap filters (operator 8).

Filter directions are a random product code: the space, turned by a seeded random
rotation, is cut into blocks of dimensions, each with its own random unit directions; a
filter is one direction of each block.  List decoding takes, block after block with the
largest sum still possible as a bound, all filters whose inner product with the vector
exceeds the threshold, and where those are few, the vector's ``fewest`` best ones: no vector
is without filters, and a copy of a vector has the same.  Vectors meet in their filters;
pairs are verified by cosine in double precision.  Each pair counts once, at the least
filter that both share.  Few dimensions have few directions, so that caps stay wider than
the angle of a link.

Equal vectors are grouped first.  A filter's vectors are cut into parts of bounded size
and every pair of parts is one task's work, so a hot filter is spread out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocast.llm.shared import components, keep

PART = 2000


class Filters:
    """``size`` directions in each of ``blocks`` blocks; the threshold is in units of
    1/sqrt(dim), the spread of a random direction's inner product.  A vector has at least its
    ``fewest`` best filters."""

    def __init__(self, dim: int, blocks: int = 2, size: int = 128, threshold: float = 2.9, seed: int = 11, fewest: int = 24):
        size = min(size, 1 << max(2, dim // 2))
        rng = np.random.default_rng(seed)
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = np.linspace(0, dim, min(blocks, dim) + 1).astype(int)
        self.codes = []
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            c = rng.standard_normal((size, b - a))
            # each block's part has the length that its share of the dimensions gives a unit vector
            self.codes.append(c / np.linalg.norm(c, axis=1, keepdims=True) * np.sqrt((b - a) / dim))
        self.size, self.least, self.fewest = size, threshold / np.sqrt(dim), fewest

    def limits(self, score: list) -> np.ndarray:
        """By row: the threshold, or the ``fewest``-th best sum where that is less."""
        best = np.zeros((len(score[0]), 1))
        for s in score:  # the best sums are made of the best sums of the blocks before and the block's best
            s = -np.partition(-s, min(self.fewest, s.shape[1]) - 1, axis=1)[:, :self.fewest]
            best = (best[:, :, None] + s[:, None, :]).reshape(len(s), -1)
            best = -np.partition(-best, min(self.fewest, best.shape[1]) - 1, axis=1)[:, :self.fewest]
        return np.minimum(self.least, best.min(axis=1)) - 1e-12

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for all filters that exceed the threshold."""
        x = unit @ self.turn
        score = [x[:, a:b] @ c.T for a, b, c in zip(self.cuts[:-1], self.cuts[1:], self.codes)]
        best, least = [s.max(axis=1) for s in score], self.limits(score)
        row, code, total = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
        for i, s in enumerate(score):
            rest = sum((b[row] for b in best[i + 1:]), np.zeros(len(row)))
            k, d = np.nonzero(total[:, None] + s[row] + rest[:, None] >= least[row, None])
            row, code, total = row[k], code[k] * self.size + d, total[k] + s[row[k], d]
        return row, code


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple]:
    """(node, root) of the components of pairs within one task."""
    up: dict = {}

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return [(x, top(x)) for x in list(up) if top(x) != x]


def links(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", least: float = 0.95,
          blocks: int = 2, size: int = 128, threshold: float = 2.9, seed: int = 11, fewest: int = 24) -> DataFrame:
    """(id, n_links, component_id), one row per row of ``vectors``.

    ``n_links`` counts the other rows linked directly (repeated rows and equal vectors
    are other rows); ``component_id`` is the smallest id reachable.  Null or zero vectors,
    and those with null or non-finite components, link with nothing; vectors of different
    lengths don't either.  A null id is never the smallest unless its component has none.
    """
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(F.coalesce(good, F.lit(False)), F.transform("v", lambda x: x + 0.0)))
    rows = rows.withColumn("h", F.when(F.col("v").isNotNull(), F.sha2(F.array_join(F.transform("v", lambda x: x.cast("string")), ","), 256)))
    rows = keep(rows)
    ids = rows.where("h is not null").groupBy("h").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.first("v").alias("v"))
    # each distinct vector gets a number: its place among the hashes is not needed, only that numbers differ
    reps = keep(ids.withColumn("rep", F.monotonically_increasing_id()).withColumn("dim", F.size("v")))
    dims = [r[0] for r in reps.select("dim").distinct().collect()]
    pairs = None
    for dim in dims:
        got = _pairs(reps.where(F.col("dim") == dim), dim, least, Filters(dim, blocks, size, threshold, seed, fewest))
        pairs = got if pairs is None else pairs.unionByName(got)
    if pairs is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"))
    pairs = keep(pairs)
    counts = pairs.where("root is null").groupBy("node").agg(F.sum("links").alias("links"))
    comp = components(pairs.where("root is not null"), "node", "root")
    comp = comp.join(reps.select(F.col("rep").alias("node"), "low"), "node")
    comp = comp.join(comp.groupBy("root").agg(F.min("low").alias("lowest")), "root").select("node", "lowest", "root")
    one = reps.select("h", "n", "low", F.col("rep").alias("node")).join(counts, "node", "left").join(comp, "node", "left").select(
        "h", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("lowest", "low").alias("component_id"))
    return rows.select("id", "h").join(one, "h", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("h").isNull(), F.col("id")).otherwise(F.col("component_id")).cast("long").alias("component_id"))


def _pairs(reps: DataFrame, dim: int, least: float, filters: Filters) -> DataFrame:
    """Rows (node, root, links): links counted for a node (root null), and tree edges."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.array(b.column(1).to_pylist(), np.float64).reshape(-1, dim)
            unit = v / np.abs(v).max(axis=1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            row, code = filters.decode(unit)
            order = np.lexsort((code, row))
            row, code = row[order], code[order]
            cut = np.searchsorted(row, np.arange(len(v) + 1))
            rep, n = b.column(0).to_numpy(), b.column(2).to_numpy()
            for at in range(0, len(row), 5000):
                r = row[at:at + 5000]
                yield pa.RecordBatch.from_arrays([
                    pa.array(code[at:at + 5000]), pa.array(rep[r]), pa.array(n[r]),
                    pa.array([unit[i].tobytes() for i in r], pa.binary()),
                    pa.array([code[cut[i]:cut[i + 1]].astype(np.int64).tobytes() for i in r], pa.binary())],
                    ["f", "rep", "n", "u", "codes"])

    sent = keep(reps.select("rep", "v", "n").mapInArrow(send, "f long, rep long, n long, u binary, codes binary"))
    held = sent.groupBy("f").count().where("count > 1").withColumn("parts", F.ceil(F.col("count") / PART).cast("int"))
    s = sent.join(held, "f").withColumn("p", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    # cell (i, j), i <= j: part i against part j of a filter
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.struct(
        F.least("p", q).alias("i"), F.greatest("p", q).alias("j")))
    s = s.select("f", "parts", "rep", "n", "u", "codes", "p", F.explode(cells).alias("c")).select("f", "parts", "c.i", "c.j", "rep", "n", "u", "codes", "p")

    NONE = pd.DataFrame({"node": pd.array([], "int64"), "root": pd.array([], "Int64"), "links": pd.array([], "int64")})  # noqa: N806

    def cell(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[1]), int(key[2])
        g = g.sort_values("f")
        at = np.flatnonzero(np.diff(g["f"].to_numpy(), prepend=-1))
        done = [one(int(g["f"].iloc[x]), i, j, g.iloc[x:y]) for x, y in zip(at, [*at[1:], len(g)])]
        return pd.concat([x for x in done if len(x)] or [NONE])

    def one(f: int, i: int, j: int, g: pd.DataFrame) -> pd.DataFrame:
        first, second = g[g.p == i], g[g.p == j]
        if not len(first) or not len(second):
            return NONE
        side = lambda x: (x["rep"].to_numpy(), x["n"].to_numpy(), np.frombuffer(b"".join(x["u"]), np.float64).reshape(-1, dim), [np.frombuffer(c, np.int64) for c in x["codes"]])
        ra, na, ua, ca = side(first)
        rb, nb, ub, cb = side(second)
        near = ua @ ub.T >= least
        if i == j:
            near = np.triu(near, 1)
        x, y = np.nonzero(near)
        if not len(x):
            return NONE
        # a pair belongs to the least filter that both share: those with an earlier one are another cell's
        before_a = [c[:np.searchsorted(c, f)] for c in ca]
        before_b = [c[:np.searchsorted(c, f)] for c in cb]
        if len(x):
            every = np.unique(np.concatenate([*before_a, *before_b, np.zeros(0, np.int64)]))
            mark = lambda cs: np.stack([np.isin(every, c, assume_unique=True) for c in cs]).astype(np.float32)
            if len(every):
                xs, ys = np.unique(x), np.unique(y)
                ma, mb = mark([before_a[k] for k in xs]), mark([before_b[k] for k in ys])
                shared = (ma @ mb.T > 0)[np.searchsorted(xs, x), np.searchsorted(ys, y)]
                x, y = x[~shared], y[~shared]
        node = np.concatenate([np.bincount(x, nb[y], len(ra)), np.bincount(y, na[x], len(rb))]).astype(np.int64)
        who = np.concatenate([ra, rb])
        tree = _forest(ra[x], rb[y])
        out = pd.DataFrame({"node": np.concatenate([who[node > 0], np.array([t[0] for t in tree], np.int64)]),
                            "links": np.concatenate([node[node > 0], np.zeros(len(tree), np.int64)])})
        out["root"] = pd.array([None] * int((node > 0).sum()) + [t[1] for t in tree], dtype="Int64")
        return out[["node", "root", "links"]]

    # filters of one part share groups of 64 by number, as each alone is little work
    s = s.withColumn("g", F.when((F.col("i") == 0) & (F.col("j") == 0) & (F.col("parts") == 1), -1 - F.floor(F.col("f") / 64)).otherwise(F.col("f"))).drop("parts")
    return s.groupBy("g", "i", "j").applyInPandas(cell, "node long, root long, links long")
