"""Centroid clustering by bisector tournaments, in exact integers (operator 12).

For two centroids a < b the bisector is 2 (b - a) . x = |b|^2 - |a|^2: a normal and a threshold,
both integers, made once a round for every pair.  A vector meets the centroids one after the
other; the sign of one linear test of the champion against the next eliminates one of them, so
k - 1 tests leave the nearest, and zero favours the smaller number.  Only the last pass computes
a distance, to the winner, exactly.

Each round is one scan: a task adds up its vectors by cluster and sends k x dim sums, whole
numbers in digits of base 2^32, which Spark adds in decimals.  The driver holds k centroids and
k (k - 1) / 2 bisectors, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velocast.llm.shared import keep

DIGIT = 32
#: Sums of this many bits at most are made in 64-bit integers, larger ones in Python's.
SAFE = 61


def whole(v: np.ndarray, bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(2^bits * v): 64-bit integers, and the rows with a larger number than ``most``."""
    with np.errstate(over="ignore"):
        x = np.floor(v * float(1 << bits))
    large = (np.abs(x) > most).any(axis=1)
    return np.where(large[:, None], 0, x).astype(np.int64), large


def whole_exact(v: np.ndarray, bits: int) -> np.ndarray:
    """The same in Python's integers, for components of any size."""
    one = lambda x: int(x) << bits if abs(x) >= 2.0 ** 53 else math.floor(x * (1 << bits))
    return np.array([[one(x) for x in r] for r in v.tolist()], object).reshape(v.shape)


class Tournament:
    """Bisectors of all pairs of ``centroids`` (lists of integers)."""

    def __init__(self, centroids: list[list[int]], bits: int):
        self.bits, self.k, dim = bits, len(centroids), len(centroids[0])
        self.most = math.isqrt((1 << SAFE) // (4 * dim))
        small = max((abs(x) for c in centroids for x in c), default=0) <= self.most
        self.kind = np.int64 if small else object
        self.exact = np.array(centroids, object).reshape(self.k, dim)
        square = (self.exact ** 2).sum(axis=1)
        self.normal = np.zeros((self.k, self.k, dim), self.kind)
        self.least = np.zeros((self.k, self.k), self.kind)
        for a in range(self.k):
            for b in range(a + 1, self.k):
                self.normal[a, b] = 2 * (self.exact[b] - self.exact[a])
                self.least[a, b] = square[b] - square[a]

    def groups(self, v: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, integer vectors, winners): the rows of usual size, then the others."""
        x, large = whole(v, self.bits, self.most if self.kind is np.int64 else -1)
        for rows in (np.flatnonzero(~large), np.flatnonzero(large)):
            if len(rows):
                y = x[rows] if not large[rows[0]] else whole_exact(v[rows], self.bits)
                yield rows, y, self.winners(y)

    def winners(self, x: np.ndarray) -> np.ndarray:
        champion = np.zeros(len(x), np.int64)
        normal, least = (self.normal, self.least) if x.dtype == self.kind else (self.normal.astype(object), self.least.astype(object))
        for b in range(1, self.k):
            side = (x * normal[champion, b]).sum(axis=1) - least[champion, b]
            champion[side > 0] = b
        return champion

    def distances(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        c = self.exact[cluster] if x.dtype == object else self.exact.astype(np.int64)[cluster]
        return ((x - c) ** 2).sum(axis=1)


def digits(x: int) -> list[int]:
    """Base 2^32, least first, each with the sign of ``x``."""
    out, sign, x = [], -1 if x < 0 else 1, abs(x)
    while x:
        out.append(sign * (x & (1 << DIGIT) - 1))
        x >>= DIGIT
    return out


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str, vector: str, dim: int) -> DataFrame:
    """(id, v): rows with exactly ``dim`` components, none null or non-finite."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return rows.where((F.size("v") == dim) & F.forall("v", good))


def first_centroids(rows: DataFrame, k: int, bits: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:id``, in ascending hash order."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    best = rows.orderBy(by, "id", "v").limit(k).collect()
    return whole_exact(np.array([r["v"] for r in best], np.float64), bits).tolist() if best else []


def _round(rows: DataFrame, t: Tournament, dim: int) -> list[list[int]]:
    """The next centroids: floor(sum / count), or as before where a cluster is empty."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((t.k, dim), object), [0] * t.k
        for b in batches:
            for _, x, who in t.groups(matrix(b.column(0), dim)):
                for c in np.unique(who).tolist():
                    total[c] += x[who == c].sum(axis=0).astype(object)
                    count[c] += int((who == c).sum())
        out = [(c, -1, 0, count[c]) for c in range(t.k) if count[c]]
        out += [(c, d, i, part) for c in range(t.k) if count[c] for d in range(dim) for i, part in enumerate(digits(int(total[c, d])))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["c", "d", "i", "part"])

    parts = rows.select("v").mapInArrow(sums, "c int, d int, i int, part long")
    got = parts.groupBy("c", "d", "i").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect()
    total, count = np.zeros((t.k, dim), object), [0] * t.k
    for c, d, i, part in got:
        if d < 0:
            count[c] = int(part)
        else:
            total[c, d] += int(part) << DIGIT * i
    return [[s // count[c] for s in total[c].tolist()] if count[c] else t.exact[c].tolist() for c in range(t.k)]


def fit(rows: DataFrame, k: int, dim: int, rounds: int, bits: int, seed: int) -> list[list[int]]:
    """The centroids after ``rounds`` rounds (fewer where a round changes nothing)."""
    centroids = first_centroids(rows, k, bits, seed)
    for _ in range(rounds if centroids else 0):
        after = _round(rows, Tournament(centroids, bits), dim)
        if after == centroids:
            break
        centroids = after
    return centroids


def assign(rows: DataFrame, centroids: list[list[int]], dim: int, bits: int) -> DataFrame:
    """(id, cluster, distance): the nearest centroid and the squared distance to it."""
    schema = T.StructType([rows.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not centroids:
        return rows.sparkSession.createDataFrame([], schema)
    t = Tournament(centroids, bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster, far = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, object)
            for at, x, who in t.groups(matrix(b.column(1), dim)):
                cluster[at], far[at] = who, t.distances(x, who)
            far = [int(d) if d < 1 << 63 else None for d in far]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster), pa.array(far, pa.int64())], ["id", "cluster", "distance"])

    return rows.mapInArrow(send, schema)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 8, dim: int = 64,
            rounds: int = 10, bits: int = 10, seed: int = 3) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256), a row per usable vector.

    Vectors of exactly ``dim`` components, none null or non-finite, become integers
    floor(2^bits * x); others are left out.  Centroids start as the ``k`` vectors with the
    smallest sha256 of ``seed:id`` (a null id counts as empty text; equal hashes by id, then by
    components) and number fewer where there are fewer vectors.  Each round assigns every vector
    to the nearest centroid, ties to the smaller number, and replaces every non-empty centroid by
    floor(sum / count) of its vectors.  Repeated rows count each.  Numbers of any size are exact
    inside; a distance or inertia beyond a long is null.  An empty table gives an empty one.
    """
    rows = usable(vectors, id_col, vector, dim)
    centroids = fit(rows, k, dim, rounds, bits, seed)
    held = keep(assign(rows, centroids, dim, bits))
    exact = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    per = held.groupBy("cluster").agg(exact.alias("s")).collect()
    total = None if any(r["s"] is None for r in per) else sum(int(r["s"]) for r in per)
    fits = lambda x: int(x) if x is not None and x < 1 << 63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = held.sparkSession.createDataFrame(
        [(r["cluster"], fits(r["s"]), fits(total), sha[r["cluster"]]) for r in per],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return held.join(F.broadcast(of), "cluster").select(  # k rows
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
