"""Line dedup (operator 11) against a plain version, and its odd rows."""

import hashlib

import pandas as pd
import pytest

import __spark_entry__ as E
from velocast.llm import lines

SF = "/root/testdata/sf0.01"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def simple(rows, min_chars=10, min_docs=2):
    """[(id, lines, lines that stay)]; rows without an id are one document, the last one."""
    order = lambda i: (i is None, i if i is not None else 0)
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if len(held.get(key(x), ())) < min_docs or min(held[key(x)], key=order) == i]
        out.append((i, all_, kept))
    return out


def digest(rows):
    return sorted(((i, len(a), len(a) - len(k), hashlib.sha256("\n".join(k).encode()).hexdigest()) for i, a, k in rows), key=str)


def test_query(spark):
    got = E.queries()["op11_lines"](spark, SF).collect()
    d = pd.read_parquet(f"{SF}/documents.parquet")
    want = digest(simple(list(zip(d.doc_id.tolist(), d.text))))
    assert sorted((tuple(r) for r in got), key=str) == want and sum(r.n_dropped for r in got) > 0


LONG = "A line of TEN or more"
ODD = [(3, f"{LONG}\nshort\n \t{LONG.lower()}\r\n"), (1, f"only here, once\n{LONG}"), (2, None), (4, ""), (4, ""), (None, f"{LONG}\n\nmine alone, null"),
       (None, "mine alone, null"), (5, "\n\n"), (6, LONG), (6, LONG), (6, f"{LONG}\nonly here, six"), (7, "ÄÖÜ äöü ÄÖÜ\nKELVIN sign K"),
       (8, "ÄÖÜ äöü ÄÖÜ\nkelvin sign k"), (9, "ÄÖÜ ÄÖÜ ÄÖÜ\nnine chars"[:-1]), (10, "nine char\nNINE CHARS"), (11, "nine chars"),
       (12, "\n".join(f"line number {i}" for i in range(20_000))), (13, "\n".join(f"Line Number {i} " for i in range(0, 20_000, 2)))]


@pytest.mark.parametrize("hot", [lines.HOT, 4])
def test_odd_rows(spark, monkeypatch, hot):
    """Nulls, empty and long texts, ties, repeated rows and ids, clashing columns; hot lines or not."""
    monkeypatch.setattr(lines, "HOT", hot)
    docs = spark.createDataFrame([(i, t, f"k{n}", n) for n, (i, t) in enumerate(ODD)], "doc_id long, text string, lost string, k1 int").repartition(4)
    assert sorted((tuple(r) for r in lines.report(docs).collect()), key=str) == digest(simple(ODD))
    out = lines.dedup(docs)
    assert out.columns == docs.columns
    got = {r.k1: r for r in out.collect()}
    for n, (i, _, kept) in enumerate(simple(ODD)):
        assert got[n].lost == f"k{n}" and got[n].text == (None if ODD[n][1] is None else "\n".join(kept))
    assert lines.report(docs.limit(0)).count() == 0 and lines.dedup(docs.limit(0)).count() == 0


def test_more_documents_than_two(spark):
    rows = [(i, "\n".join(x for k, x in enumerate(["held by all three", "held by two of them"]) if i or not k)) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in lines.report(docs, min_docs=3).collect()), key=str) == digest(simple(rows, min_docs=3))
    assert {(r.n_docs, r.n_lines, r.first_id) for r in lines.repeated(docs).collect()} == {(3, 3, 0), (2, 2, 1)}


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", LONG), ("a", LONG)], "doc_id string, text string")
    assert {(r.doc_id, r.text) for r in lines.dedup(docs).collect()} == {("a", LONG), ("b", "")}
