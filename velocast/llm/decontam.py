"""Benchmark decontamination by a positional inverted index (operator 2).

``build_index`` turns whole documents into index segments, one row each, written to the
shared folder: the segment's documents with their word counts, its terms, and each
term's sorted list of token positions.  A segment holds whole documents up to about
``SEGMENT_WORDS`` words, so its size is bounded by that and by one document.
``search`` orders the terms of each test window from the rarest in the corpus, takes the
rarest term's list less its offset, and intersects it with the next terms' offset-adjusted
lists (exact phrase), or keeps positions with all terms within ``slack`` words (proximity).
The test set is read in blocks of bounded size; each block meets every segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velocast.llm.shared import keep

WINDOW = 10
SEGMENT_WORDS = 500_000
BLOCK_CHARS = 4_000_000
#: Bytes that are not of a word become spaces; A-Z become a-z.
_TABLE = bytes(ord(chr(i).lower()) if chr(i).isascii() and chr(i).isalnum() else i if i >= 0x80 else 0x20 for i in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text with A-Z lower-cased."""
    return text.translate(_TABLE).split()


def windows_of(words: list[bytes], w: int = WINDOW) -> list[tuple]:
    if not words:
        return []
    return [tuple(words[i:i + w]) for i in range(max(1, len(words) - w + 1))]


# ------------------------------------------------------------- index

SEGMENT = ("keys array<binary>, doc_words array<long>, doc_start array<long>, "
           "terms array<binary>, term_start array<long>, positions array<int>")


def build_index(docs: DataFrame, key: str, text: str = "text", vocabulary: frozenset | None = None) -> DataFrame:
    """Segments of the positional index of ``text``, for the terms in ``vocabulary`` or all.

    ``key`` is a binary column that names a row.  Documents lie in a segment one after the
    other with a gap that no window spans.
    """
    gap = 2 * WINDOW + 64
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary) if vocabulary is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = {t: i for i, t in enumerate(sorted(vocab.value))} if vocab is not None else None

        def segment(keys, counts, parts):
            starts = np.cumsum([0] + [c + gap for c in counts])[:-1]
            ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
            pos = np.concatenate([p[1] + s for p, s in zip(parts, starts)]) if parts else np.zeros(0, np.int64)
            order = np.argsort(ids, kind="stable")
            ids, pos = ids[order], pos[order]
            used, first = np.unique(ids, return_index=True)
            names = list(ids_of)
            return pa.RecordBatch.from_arrays([
                pa.array([keys], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int64())),
                pa.array([starts.tolist()], pa.list_(pa.int64())),
                pa.array([[names[i] for i in used]], pa.list_(pa.binary())),
                pa.array([np.append(first, len(ids)).tolist()], pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array([0, len(pos)], pa.int32()), pa.array(pos.astype(np.int32)))],
                ["keys", "doc_words", "doc_start", "terms", "term_start", "positions"])

        ids_of: dict = dict(only) if only is not None else {}
        keys, counts, parts, held = [], [], [], 0
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            for k, t in zip(b.column(0), texts):
                ws = words_of(t.as_py() or b"")
                if only is None:
                    ids = np.fromiter((ids_of.setdefault(x, len(ids_of)) for x in ws), np.int64, len(ws))
                else:
                    get = only.get
                    ids = np.fromiter((get(x, -1) for x in ws), np.int64, len(ws))
                at = np.flatnonzero(ids >= 0)
                keys.append(k.as_py())
                counts.append(len(ws))
                parts.append((ids[at], at))
                held += len(ws) + gap
                if held >= SEGMENT_WORDS:
                    yield segment(keys, counts, parts)
                    ids_of = dict(only) if only is not None else {}
                    keys, counts, parts, held = [], [], [], 0
        if keys:
            yield segment(keys, counts, parts)

    return docs.select(F.col(key), F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(run, SEGMENT)


def term_counts(index: DataFrame) -> DataFrame:
    """(term, n): how often each indexed term occurs in the corpus."""
    sizes = F.zip_with(F.col("terms"), F.sequence(F.lit(0), F.size("terms") - 1), lambda t, i: F.struct(
        t.alias("term"), (F.element_at("term_start", i + 2) - F.element_at("term_start", i + 1)).alias("n")))
    return index.where(F.size("terms") > 0).select(F.inline(sizes)).groupBy("term").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------- search

def _near(lists: list, at: np.ndarray, span: int) -> np.ndarray:
    """The positions in ``at`` that have each list's next word within ``span``."""
    for x in lists:
        if not len(at):
            break
        i = np.searchsorted(x, at - span)
        at = at[(i < len(x)) & (x[np.minimum(i, len(x) - 1)] <= at + span)]
    return at


def match(terms: dict, plan: list[tuple], slack: int) -> tuple[dict, dict]:
    """Phrase starts by window, and places outside those phrases where a window matches in
    proximity, in one segment.

    ``terms`` gives each term's sorted positions; ``plan`` has (window, terms in order of
    rarity with their offsets).
    """
    exact, close = {}, {}
    for w, ordered in plan:
        if any(t not in terms for t, _ in ordered):
            continue
        t0, o0 = ordered[0]
        at = terms[t0] - o0
        for t, o in ordered[1:]:
            if not len(at):
                break
            x = terms[t] - o
            i = np.searchsorted(x, at)
            at = at[(i < len(x)) & (x[np.minimum(i, len(x) - 1)] == at)]
        if len(at):
            exact[w] = at
        if slack >= 0:
            span = len(ordered) - 1 + slack
            places = terms[t0]
            if len(at):  # what stands in an exact match of the window is no place of its own
                i = np.searchsorted(at, places, "right") - 1
                places = places[(i < 0) | (places >= at[np.maximum(i, 0)] + len(ordered))]
            at = _near([terms[t] for t, _ in ordered[1:6]], places, span)
            for p in at:  # few are left: each start of a span that holds p is tried
                own = [terms[t][np.searchsorted(terms[t], p - span):np.searchsorted(terms[t], p + span, "right")] for t, _ in ordered]
                if all(len(x) for x in own) and any(
                        all(((x >= s) & (x <= s + span)).any() for x in own) for s in np.unique(np.concatenate(own)) if s <= p <= s + span):
                    close.setdefault(w, []).append(p)
    return exact, close


def search(index: DataFrame, windows: list[tuple], counts: dict, slack: int = 2, w: int = WINDOW) -> DataFrame:
    """For each document of the index: key, n_words, hits (array of [start, end) of words,
    disjoint and sorted), items and near_items (sorted item strings).

    ``windows``: (item, tuple of words); ``counts``: corpus counts by term.
    """
    items: dict = {}
    for item, win in windows:
        items.setdefault(win, set()).add(item)
    plan = []
    for win in sorted(items):
        if all(t in counts for t in win):
            plan.append((win, sorted(((t, o) for o, t in enumerate(win)), key=lambda x: (counts[x[0]], x[1]))))
    held = index.sparkSession.sparkContext.broadcast((plan, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, items = held.value
        for b in batches:
            for r in range(b.num_rows):
                row = {n: b.column(n)[r] for n in b.schema.names}
                keys, counts = row["keys"].as_py(), row["doc_words"].as_py()
                starts = row["doc_start"].values.to_numpy()
                names, cut = row["terms"].as_py(), row["term_start"].values.to_numpy()
                pos = row["positions"].values.to_numpy().astype(np.int64)
                terms = {t: pos[cut[i]:cut[i + 1]] for i, t in enumerate(names)}
                exact, close = match(terms, plan, slack)
                spans: dict = {}
                got: dict = {}
                near: dict = {}
                for win, at in exact.items():
                    doc = np.searchsorted(starts, at, "right") - 1
                    for p, d in zip(at, doc):
                        spans.setdefault(int(d), []).append((int(p - starts[d]), int(p - starts[d]) + len(win)))
                        got.setdefault(int(d), set()).update(items[win])
                for win, at in close.items():
                    for p in at:
                        near.setdefault(int(np.searchsorted(starts, p, "right") - 1), set()).update(items[win])
                out = [[], [], [], [], []]
                for d, k in enumerate(keys):
                    out[0].append(k)
                    out[1].append(counts[d])
                    out[2].append([{"a": a, "b": e} for a, e in merged(spans.get(d, []))])
                    out[3].append(sorted(got.get(d, ())))
                    out[4].append(sorted(near.get(d, ())))
                yield pa.RecordBatch.from_arrays([
                    pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                    pa.array(out[3], pa.list_(pa.string())), pa.array(out[4], pa.list_(pa.string()))],
                    ["key", "n_words", "hits", "items", "near_items"])

    return index.mapInArrow(run, "key binary, n_words long, hits array<struct<a:long,b:long>>, "
                                 "items array<string>, near_items array<string>")


def merged(spans: list[tuple]) -> list[tuple]:
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def find(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text: str = "text",
         item_col: str = "item_id", item_text: str = "text", w: int = WINDOW, slack: int = 2) -> DataFrame:
    """(key, n_words, hits, items, near_items), one row per row of ``docs``.

    ``key`` is ``row_key`` of the row: rows with equal keys have equal results, and stay as many
    rows.  A null text has no words; an item without words has no window; a null item id counts
    as the string ``null``; repeated items count once.  An empty test set hits nothing.
    """
    rows = docs.select(row_key(id_col, text).alias("key"), F.col(f"`{text}`").cast("string").alias("t"))
    tests = bench.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"),
                         F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("t")).distinct()
    chars = tests.agg(F.sum(F.length("t") + 16)).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    tests = tests.withColumn("block", F.pmod(F.xxhash64("item", "t"), F.lit(blocks)))
    out = None
    for i in range(blocks):  # each block is bounded by BLOCK_CHARS and meets the whole corpus
        wins = [(r["item"], x) for r in tests.where(F.col("block") == i).collect()
                for x in windows_of(words_of(r["t"].encode()), w)]
        vocab = frozenset(t for _, x in wins for t in x)
        index = keep(build_index(rows, "key", "t", vocab))
        counts = {bytes(r["term"]): r["n"] for r in term_counts(index).collect()}  # at most the block's terms
        found = search(index, wins, counts, slack, w)
        out = found if out is None else out.unionByName(found)
    if blocks > 1:  # each block returns every row: those of one key have one result a block
        every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
        out = out.groupBy("key", "n_words").agg(every("hits"), every("items"), every("near_items"), (F.count("*") / blocks).cast("long").alias("copies"))
        out = out.withColumn("hits", _union("hits")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "copy")
    return out


def row_key(id_col: str, text: str) -> Column:
    """The SHA-256 of the text (of an empty one for null), then the id, marked as null or not."""
    i = F.col(f"`{id_col}`").cast("string")
    return F.concat(F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), 256)), F.when(i.isNull(), F.lit(b"\x00")).otherwise(
        F.concat(F.lit(b"\x01"), F.to_binary(i, F.lit("utf-8")))))


def _union(c: str):
    """Disjoint sorted intervals from any intervals."""
    start = F.array().cast("array<struct<a:bigint,b:bigint>>")

    def step(acc, x):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))))
        return F.when((F.size(acc) > 0) & (x["a"] <= F.try_element_at(acc, F.lit(-1))["b"]), joined).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(c), start, step)


def report(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id") -> DataFrame:
    d = find(docs, bench, id_col)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["b"] - x["a"])
    kind = docs.schema[id_col].dataType
    told = F.when(F.substring("key", 33, 1) == F.lit(b"\x01"), F.expr("substring(key, 34)").cast("string"))
    return d.select(told.cast(kind).alias(id_col), "n_words", n_hit.alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near"))


def clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text: str = "text", most: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose share of hit words is at most ``most``, all columns kept."""
    d = find(docs, bench, id_col, text)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["b"] - x["a"])
    bad = d.where(n_hit > F.lit(most) * F.col("n_words")).select(F.col("key").alias("\x01key")).distinct()
    return docs.join(bad, row_key(id_col, text) == F.col("\x01key"), "left_anti")
