"""Centroid clustering (operator 12) against plain integers, and its odd rows."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from velocast.llm import centroids

SF = "/root/testdata/sf0.01"


def simple(rows, k=8, dim=64, rounds=10, bits=10, seed=3):
    kept = [(i, [math.floor(Fraction(x) * 2 ** bits) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    text = lambda i: "" if i is None else str(i)
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{text(r[0])}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda: [min(range(len(c)), key=lambda j: (dist(v, c[j]), j)) for _, v in kept]
    for _ in range(rounds):
        who = near()
        for j in range(len(c)):
            if mine := [v for (_, v), w in zip(kept, who) if w == j]:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    who = near()
    far = [dist(v, c[w]) for (_, v), w in zip(kept, who)]
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    fit = lambda x: x if x < 2 ** 63 else None
    return sorted(((i, w, fit(f), fit(sum(y for y, z in zip(far, who) if z == w)), fit(sum(far)), sha[w])
                   for (i, _), w, f in zip(kept, who, far)), key=str)


def test_query(spark):
    got = E.queries()["op12_centroids"](spark, SF).collect()
    d = pd.read_parquet(f"{SF}/embeddings.parquet")
    assert sorted((tuple(r) for r in got), key=str) == simple([(i, [float(x) for x in v]) for i, v in zip(d.vec_id.tolist(), d.embedding)])


def run(spark, rows, k=3, dim=2, rounds=4):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, cluster int").repartition(3)
    got = centroids.cluster(df, k=k, dim=dim, rounds=rounds)
    return sorted((tuple(r) for r in got.collect()), key=str), df


def test_odd_rows(spark):
    """Nulls, wrong lengths, non-finite components, ties, repeated rows, clashing columns, empty tables."""
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.0]), (3, [0.5, 0.0]), (4, None), (5, [1.0]), (6, [1.0, None]), (7, [1.0, math.nan]),
            (8, [math.inf, 1.0]), (None, [0.25, -3.0]), (9, [-0.3, 1e-9]), (10, []), (11, [2.0, 2.0]), (11, [2.0, 1.0])]
    got, df = run(spark, rows)
    assert got == simple(rows, 3, 2, 4)
    assert centroids.cluster(df.limit(0), k=3, dim=2).count() == 0
    few = rows[:2]
    assert run(spark, few, k=5)[0] == simple(few, 5, 2, 4)


@pytest.mark.parametrize("big", [3e5, 1e9, 1e15, 3e38, 1.7e308])
def test_components_of_any_size(spark, big):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=2)]) for i in range(20)] + [(50 + i, [big * float(x) for x in rng.uniform(-1, 1, 2)]) for i in range(6)]
    assert run(spark, rows)[0] == simple(rows, 3, 2, 4)


def test_the_tournament_is_the_nearest_centroid():
    """Every test by hand: ties, equal centroids, both kinds of integers."""
    rng = np.random.default_rng(1)
    for scale in (3, 40_000_000_000):
        c = rng.integers(-3, 4, (6, 4)) * scale
        c[4] = c[1]
        t = centroids.Tournament(c.tolist(), 0)
        v = rng.integers(-4, 5, (300, 4)).astype(float) * scale
        seen = 0
        for rows, x, who in t.groups(v):
            for r, w in zip(rows, who):
                d = [sum((int(a) - int(b)) ** 2 for a, b in zip(v[r], y)) for y in c.tolist()]
                assert w == d.index(min(d))
                seen += 1
        assert seen == 300


def test_digits():
    for x in (0, 5, -5, 2 ** 32, -(2 ** 100) + 7):
        assert sum(d << 32 * i for i, d in enumerate(centroids.digits(x))) == x
