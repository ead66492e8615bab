"""SimHash near-dedup by anchor-point covering (operator 1).

Fingerprints are 64-bit SimHashes of word shingles.  The anchors are the words of
a covering code of 64 bits, the direct sum of perfect codes: one binary Golay code
of 23 bits (radius 3), repetition codes of 7 bits (radius 3) and, on what bits are
left, the code whose only word is zero (its radius is its length).  Each
fingerprint has one home anchor, the nearest word block by block.  It is replicated
to every anchor within the covering radius plus the threshold: in block ``i`` an
anchor costs ``max(0, distance - radius_i)``, and all anchors whose costs add up to
at most the threshold are taken.

Why no pair is lost: let ``x`` and ``y`` differ in ``d_i`` bits of block ``i``, with
``sum d_i <= t``.  The home ``c`` of ``x`` has ``dist(x_i, c_i) <= radius_i``, so
``dist(y_i, c_i) <= radius_i + d_i`` and ``y`` has a replica at ``c``.  Comparing the
fingerprints at home in an anchor with the replicas sent there finds every pair.

Exact copies share a fingerprint and are grouped before the replication, so a group
of copies costs one row.  At most 43,744 other fingerprints lie within 3 bits, so
links are bounded by the number of distinct fingerprints, not by its square.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocast.llm.shared import components, fresh, keep

GOLAY = 0b101011100011  # fixed value: generator polynomial of the binary Golay code

#: Codes by the number of distinct fingerprints that they suit: blocks as (kind, bits).
#: More fingerprints need more anchors, so that few share one; the links found are
#: the same with any code.
CODES = (
    (1 << 22, (("golay", 23), *[("repeat", 7)] * 5, ("zero", 6))),
    (1 << 62, (("golay", 23), ("golay", 23), ("repeat", 9), ("repeat", 9))),
)


# ------------------------------------------------------------- fingerprints

def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text with A-Z lower-cased."""
    return text.lower().split()


def fingerprint(words: list[bytes], shingle: int = 3, seed: int = 42) -> int:
    """The unsigned SimHash: a bit is set if it is in over half the shingle hashes."""
    if not words:
        return 0
    if len(words) < shingle:
        shingles, n = [b" ".join(words)], 1
    else:
        n = len(words) - shingle + 1
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.fromiter(map(functools.partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, carried: list[str], text: str = "text", shingle: int = 3,
                     seed: int = 42, out: str = "fp") -> DataFrame:
    """The columns ``carried`` of ``docs`` and ``out``, the fingerprint as a signed long."""
    src = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias("\x00text"))
    schema = src.drop("\x00text").withColumn(out, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1).cast(pa.binary())
            fps = np.fromiter((fingerprint(words_of(t.as_py() or b""), shingle, seed) for t in texts),
                              np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))],
                                             [*b.schema.names[:-1], out])

    return src.mapInArrow(run, schema)


def as_hex(fp: str):
    """A signed long column as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


# ------------------------------------------------------------- anchors

class _Block:
    """One code of the sum: its errors by syndrome, each with its cost."""

    def __init__(self, kind: str, bits: int, shift: int, t: int):
        self.kind, self.bits, self.shift, self.t = kind, bits, shift, t
        if kind == "zero":
            return
        radius = 3 if kind == "golay" else bits // 2
        single = np.array([self._syndrome_of(1 << i) for i in range(bits)], np.int64)
        errors, syndromes, costs = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        last_e, last_s, top = errors[0], syndromes[0], np.full(1, -1)
        for w in range(1, min(bits, radius + t) + 1):
            e, s, p = [], [], []
            for i in range(bits):  # patterns of weight w: a higher bit on those of weight w - 1
                m = top < i
                e.append(last_e[m] | (1 << i))
                s.append(last_s[m] ^ single[i])
                p.append(np.full(int(m.sum()), i))
            last_e, last_s, top = map(np.concatenate, (e, s, p))
            errors.append(last_e)
            syndromes.append(last_s)
            costs.append(np.full(len(last_e), max(0, w - radius)))
        e, s, c = map(np.concatenate, (errors, syndromes, costs))
        order = np.lexsort((c, s))
        self.errors, self.costs = e[order], c[order]
        n = 1 << (11 if kind == "golay" else bits - 1)
        self.start = np.searchsorted(s[order], np.arange(n))
        self.upto = np.stack([np.bincount(s[c <= k], minlength=n) for k in range(t + 1)])

    def _syndrome_of(self, v: int) -> int:
        if self.kind == "repeat":
            return (v ^ (v >> 1)) & ((1 << (self.bits - 1)) - 1)
        for i in range(self.bits - 1, 10, -1):
            if v >> i & 1:
                v ^= GOLAY << (i - 11)
        return v

    def syndrome(self, v: np.ndarray) -> np.ndarray:
        if self.kind == "repeat":
            return (v ^ (v >> 1)) & ((1 << (self.bits - 1)) - 1)
        v = v.copy()
        for i in range(self.bits - 1, 10, -1):
            v ^= (v >> i & 1) * (GOLAY << (i - 11))
        return v


@functools.lru_cache(maxsize=8)
def _blocks(code: tuple, t: int) -> tuple:
    out, shift = [], 0
    for kind, bits in code:
        out.append(_Block(kind, bits, shift, t))
        shift += bits
    if shift != 64:
        raise ValueError("the blocks of an anchor code must add up to 64 bits")
    return tuple(out)


def anchors_of(fps: np.ndarray, code: tuple, t: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor): all anchors that cost at most ``reach`` for each unsigned fingerprint."""
    row, anchor, left = np.arange(len(fps)), fps.astype(np.uint64), np.full(len(fps), reach)
    for b in _blocks(code, t):
        mask = np.uint64(((1 << b.bits) - 1) << b.shift)
        if b.kind == "zero":
            anchor = anchor & ~mask
            continue
        s = b.syndrome(((anchor & mask) >> np.uint64(b.shift)).astype(np.int64))
        n = b.upto[left, s]
        at = np.repeat(b.start[s] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        row, left = np.repeat(row, n), np.repeat(left, n) - b.costs[at]
        anchor = np.repeat(anchor, n) ^ (b.errors[at].astype(np.uint64) << np.uint64(b.shift))
    return row, anchor


def _replicas(fps: DataFrame, code: tuple, t: int, reach: int, fp: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(v), 500):
                part = v[at:at + 500]
                row, anchor = anchors_of(part, code, t, reach)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(part[row].view(np.int64))], ["anchor", fp])

    return fps.select(F.col("fp").alias(fp)).mapInArrow(run, f"anchor long, {fp} long")


def links(fps: DataFrame, distance: int = 3, code: tuple | None = None) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct longs ``fp`` that differ in at most
    ``distance`` bits, each once: at the home anchor of the smaller one."""
    if code is None:
        n = fps.count()
        code = next(c for most, c in CODES if n <= most)
    home = _replicas(fps, code, distance, 0, "a")
    sent = _replicas(fps, code, distance, distance, "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return home.join(sent, "anchor").where(near & (F.col("a") < F.col("b"))).select("a", "b")


# ------------------------------------------------------------- operator

def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
           distance: int = 3, seed: int = 42, carried: tuple = ()) -> DataFrame:
    """Near-copy groups: ``id_col``, ``carried``, ``fp`` (signed long) and
    ``component_id``, the smallest id reachable by links of at most ``distance`` bits.

    One row per row of ``docs``, repeated rows and ids included.  A null or wordless
    text has fingerprint zero and is linked like any other; a null id is never the
    smallest unless its whole group has none (then ``component_id`` is null).
    Columns of ``docs`` not named in ``carried`` are ignored; empty gives empty.
    """
    rows = keep(with_fingerprint(docs, [id_col, *carried], text, shingle, seed))
    fps = keep(rows.groupBy("fp").agg(F.min(f"`{id_col}`").alias("least")))
    found = components(links(fps, distance))
    linked = found.join(fps, found["node"] == fps["fp"]).select("node", "root", "least")
    linked = linked.join(linked.groupBy("root").agg(F.min("least").alias("lowest")), "root")
    whole = fps.join(linked.select(F.col("node").alias("fp"), "root", "lowest"), "fp", "left").select(
        "fp", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("lowest")).alias("component_id"))
    return rows.join(whole, "fp").select(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in carried],
                                         "fp", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
          distance: int = 3, seed: int = 42) -> DataFrame:
    """The columns of ``docs``; of each near-copy group one row, that of the least id.

    Rows are told apart by id and text: repeated rows count as one, and a row with a
    null id stays only where its whole group has no id (the one with the least text
    hash).
    """
    (mark,) = fresh(docs, "text_hash")
    marked = docs.withColumn(mark, F.xxhash64(F.col(f"`{text}`").cast("string")))
    found = groups(marked, id_col, text, shingle, distance, seed, carried=(mark,))
    # the group's row is (component, root) safe: fingerprints of one group share component_id
    # unless it is null; then the fingerprint itself tells groups without ids apart
    rank = F.struct(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.col(mark))
    key = F.when(F.col("component_id").isNull(), F.col("fp"))
    best = (found.groupBy("component_id", key.alias("key")).agg(F.min(rank).alias("r"))
            .select(F.col(f"r.`{id_col}`").alias("\x01id"), F.col(f"r.{mark}").alias("\x01hash")).distinct())
    same = marked[id_col].eqNullSafe(best["\x01id"]) & (marked[mark] == best["\x01hash"])
    return marked.join(best, same, "left_semi").dropDuplicates([id_col, mark]).drop(mark)
