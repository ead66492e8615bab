"""Language ID by multilingual mixture inference (operator 6).

Training counts hashed character n-grams by language over all training texts.  A
document is a mixture: each of its n-grams comes from one of its languages.
Expectation-maximisation estimates the proportions; the language set is grown while the
likelihood gains more than the penalty of another language.  The prediction is the
language of the largest proportion, its score that proportion.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
_LETTER = re.compile(r"[^\W\d_]")
_SPACES = re.compile(r"[\W\d_]+")


def grams(text: str) -> np.ndarray:
    """Hash buckets of the 3-grams of letters of the whole text, words apart by one space."""
    t = " " + _SPACES.sub(" ", text.lower()).strip() + " "
    c = np.frombuffer(t.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    h = c[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ c[2:] * np.uint64(0x165667B19E3779F9)
    return (h >> np.uint64(47)).astype(np.int64) & (BUCKETS - 1)


def has_letter(text: str) -> bool:
    """Whether the text has a letter; numerals such as fractions and superscripts are none."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows with a language; null texts add nothing."""
    src = docs.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{lang}`").cast("string").alias("l"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for t, lang in zip(b.column(0), b.column(1).to_pylist()):
                if lang not in held:
                    held[lang] = np.zeros(BUCKETS, np.int64)
                g = grams(t.as_py() or "")
                held[lang] += np.bincount(g, minlength=BUCKETS)
        for lang, n in held.items():  # one table of fixed size for each language
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])
            if not len(at):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0]), pa.array([0])], ["lang", "bucket", "n"])

    return src.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def model_of(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log-likelihood of each bucket: languages times BUCKETS numbers, whatever the corpus."""
    rows = counts.toPandas()
    langs = sorted(rows["lang"].unique())
    n = np.full((len(langs), BUCKETS), 0.5)
    for i, lang in enumerate(langs):
        own = rows[rows["lang"] == lang]
        n[i, own["bucket"].to_numpy()] += own["n"].to_numpy()
    return langs, np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float64)


def infer(buckets: np.ndarray, table: np.ndarray, penalty: float = 8.0, rounds: int = 30) -> dict[int, float]:
    """Proportions of the chosen languages (row of ``table`` to share)."""
    g, n = np.unique(buckets, return_counts=True)
    ll = table[:, g]
    ll = ll - ll.max(axis=0)
    p = np.exp(ll)
    single = ll @ n
    chosen, best = [int(np.argmax(single))], float(single.max())
    share = np.ones(1)
    cost = penalty + 0.5 * np.log(max(2, n.sum()))
    while len(chosen) < len(table):
        # gain in likelihood at a small step towards each language: none above 0 ends the search
        mixed = share @ p[chosen]
        slope = (p / mixed) @ n - n.sum()
        slope[chosen] = -1
        nxt = int(np.argmax(slope))
        if slope[nxt] <= 0:
            break
        trial, q = chosen + [nxt], p[chosen + [nxt]]
        s = np.append(share * 0.9, 0.1)
        for _ in range(rounds):
            r = s[:, None] * q
            new = (r / r.sum(axis=0)) @ n / n.sum()
            if np.abs(new - s).max() < 1e-4:
                s = new
                break
            s = new
        value = float(np.log(s @ q) @ n)
        if value - best <= cost:
            break
        chosen, share, best = trial, s, value
    return dict(zip(chosen, share.tolist()))


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, carried: list[str], text: str = "text") -> DataFrame:
    """``carried`` columns, lang_pred, score and n_langs for each row.

    A null text, or one without a letter, is ``und`` with score 0 and no language; so is
    every text where nothing was learned.
    """
    held = docs.sparkSession.sparkContext.broadcast((langs, table))
    src = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias("\x00t"))
    schema = src.drop("\x00t").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "n_langs": F.lit(0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = held.value
        for b in batches:
            name, score, many = [], [], []
            for t in b.column(b.num_columns - 1):
                t = t.as_py()
                g = grams(t) if t and langs and has_letter(t) else ()
                if len(g):
                    found = infer(g, table)
                    top = max(found, key=lambda k: (found[k], -k))
                    name.append(langs[top])
                    score.append(min(1.0, max(0.0, found[top])))
                    many.append(len(found))
                else:
                    name.append("und")
                    score.append(0.0)
                    many.append(0)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(many, pa.int32())],
                                             [*b.schema.names[:-1], "lang_pred", "score", "n_langs"])

    return src.mapInArrow(run, schema)


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def report(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    langs, table = model_of(train(docs.where(~held_out(id_col))))
    marked = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), "text")
    return predict(marked, langs, table, [id_col, "held_out"])


def reject(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` with a language, all columns kept.

    Null texts, texts without a letter and, where nothing was learned, all rows go.  A
    document of several languages stays, as its parts are known: with three of them the
    largest share is often below a half.  ``least`` asks for a largest share of that size.
    Where the language column is null, kept rows get the predicted language.
    """
    langs, table = model_of(train(docs.where(~held_out(id_col)), text, lang))
    # the rows go through the prediction whole, under names that can't clash: nothing is shuffled
    plain = [f"c{i}" for i in range(len(docs.columns))]
    p = predict(docs.toDF(*plain), langs, table, plain, plain[docs.columns.index(text)])
    p = p.where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    named, kind = plain[docs.columns.index(lang)], docs.schema[lang].dataType
    return p.withColumn(named, F.coalesce(named, F.col("lang_pred").cast(kind))).select(*plain).toDF(*docs.columns)
