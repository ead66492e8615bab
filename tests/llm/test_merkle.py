"""The Merkle manifest (operator 13) against a tree built in plain Python."""

import hashlib
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from velocast.llm import merkle

SF = "/root/testdata/sf0.01"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*[part(text if c == "text" else row[c]) for c in FIELDS])


def climb(level, arity):
    """Root of the digests, and the (left, right) siblings of each, level by level."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, p in enumerate(paths):
            run = at[i] // arity * arity
            p.append(("".join(level[run:at[i]]), "".join(level[at[i] + 1:run + arity])))
            at[i] //= arity
        level = [h(*level[k:k + arity]) for k in range(0, len(level), arity)]
    return level[0], paths


def simple(rows, arity=8, tamper=lambda r: r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0):
    by = {}
    for r in rows:
        r["leaf"] = leaf(r, r["text"])
        t = r["text"]
        r["other"] = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) if t is not None and tamper(r) else r["leaf"]
        by.setdefault(r["lang"], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    subs = []
    for x in langs:
        by[x].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"], r["other"]))
        root, paths = climb([r["leaf"] for r in by[x]], arity)
        subs.append(root)
        for r, p in zip(by[x], paths):
            r["subroot"], r["path"] = root, p
    root, above = climb(subs, arity) if subs else (None, [])
    out = []
    for x, up in zip(langs, above):
        for r in by[x]:
            fold = r["other"]
            for a, b in r["path"] + up:
                fold = h(a, fold, b)
            out.append((r["doc_id"], r["leaf"], r["subroot"], root, h(*[a + b for a, b in r["path"] + up]), fold, fold == root))
    return sorted(out, key=str)


def test_query_is_the_tree(spark):
    got = E.queries()["op13_merkle"](spark, SF).collect()
    want = simple(pd.read_parquet(f"{SF}/documents.parquet").astype(object).to_dict("records"))
    assert sorted((tuple(r) for r in got), key=str) == want
    assert any(r.verified for r in got) and not all(r.verified for r in got)


ODD = ([dict(doc_id=1, source=None, lang="en", n_chars=3, text="Abc"), dict(doc_id=None, source="s", lang="en", n_chars=None, text=None)]
       + [dict(doc_id=7, source="s", lang="en", n_chars=1, text="Z") for _ in range(9)]
       + [dict(doc_id=7, source="s", lang="en", n_chars=1, text="Y"), dict(doc_id=3, source="s", lang=None, n_chars=0, text="")]
       + [dict(doc_id=i, source="é", lang="", n_chars=2, text="q" * 40_000) for i in range(4)]
       + [dict(doc_id=i, source="s", lang=f"l{i % 5}", n_chars=2, text="Q") for i in range(20, 90)])


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_odd_rows(spark, arity):
    """Nulls, ties, repeated rows, a lone leaf, an empty group name, long texts, clashing columns."""
    docs = spark.createDataFrame([tuple(r[c] for c in FIELDS) + ("x", 5, "y") for r in ODD],
                                 "doc_id long, source string, lang string, n_chars long, text string, g string, i long, path string").repartition(5)
    tampered = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    text = F.when(tampered, F.lower("text")).otherwise(F.col("text"))
    got = merkle.audit(docs, FIELDS, arity=arity, changed={"text": text})
    assert sorted((tuple(r) for r in got.collect()), key=str) == simple([dict(r) for r in ODD], arity)
    assert merkle.audit(docs.limit(0), FIELDS, arity=arity).count() == 0


def test_paths_of_an_untouched_table_verify(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "if(id < 290, 'hot', 'few') AS lang", "cast(id AS string) AS text")
    m = merkle.manifest(docs, ["doc_id", "text"])
    ok = m.select((merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"), "i", "lang", F.size("path").alias("s")).collect()
    assert all(r.ok for r in ok) and {r.i for r in ok if r.lang == "hot"} == set(range(290))
    assert {(r.lang, r.s) for r in ok} == {("hot", 4), ("few", 3)}  # 290 -> 37 -> 5 -> 1, 10 -> 2 -> 1, and the langs
    one = merkle.manifest(docs.limit(1), ["doc_id"]).collect()[0]
    assert one.leaf == one.subroot == one.root and one.path == []
