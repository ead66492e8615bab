"""Mixing sources to target weights by subset-sum budget fitting (operator 9).

Documents are counted by exact length within each source.  Every document is taken
``floor(target / size)`` times whole; the rest of the budget is filled by lengths: a
proportional share of each length's documents, then the largest lengths down to a
remainder of bounded words, then a bounded-knapsack dynamic program over that; where it
misses, documents are given back, short ones first, and it runs again.  Which
documents of a length are taken follows from a seeded hash, found by a histogram of
hash ranges, so no task sorts a whole group.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velocast.llm.shared import keep

WORD = r"[^\x20\x09-\x0D]+"
RANGES = 4096


def targets_of(sizes: list[tuple], weights: tuple = (5, 2, 1), share: float = 1.5,
               most: float = 2.0) -> dict:
    """Target words by source: weights repeat over the sources in order, targets stop at
    ``most`` times the source's size, and the excess is reshared by weight."""
    total = share * sum(s for _, s in sizes)
    weight = {k: weights[i % len(weights)] for i, (k, _) in enumerate(sizes)}
    free, target, left = dict(sizes), {}, total
    while free:
        w = sum(weight[k] for k in free)
        over = [k for k, s in free.items() if left * weight[k] / w > most * s]
        if not over:
            target |= {k: left * weight[k] / w for k in free}
            break
        for k in over:
            target[k] = most * free.pop(k)
            left -= target[k]
    return target


def subset_sum(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length make the most words up to ``budget``: bounded knapsack, exact."""
    # by[w]: the step that first made w words; a step adds k documents of length i, each count in powers of two
    by, steps, taken = np.full(budget + 1, -1, np.int32), [], [0] * len(lengths)
    by[0] = 0
    for i in sorted((i for i, n in enumerate(lengths) if n), key=lambda i: -lengths[i]):
        spare, k = min(counts[i], budget // lengths[i]), 1
        while spare > 0 and by[budget] < 0:
            k = min(k, spare)
            steps.append((i, k))
            new = np.flatnonzero(by[:budget + 1 - k * lengths[i]] >= 0) + k * lengths[i]
            by[new[by[new] < 0]] = len(steps)
            spare, k = spare - k, 2 * k
        if by[budget] >= 0:
            break
    w = int(np.flatnonzero(by >= 0)[-1])
    while w:
        i, k = steps[by[w] - 1]
        taken[i] += k
        w -= k * lengths[i]
    return taken


def sparse_sum(lengths: list[int], counts: list[int], budget: int, most_sums: int = 1 << 17) -> list[int] | None:
    """The same over the sums that can be made at all, whatever their size; None where there are
    more than ``most_sums`` of them."""
    sums, steps, found = np.zeros(1, np.int64), [], []
    for i in sorted((i for i, n in enumerate(lengths) if n), key=lambda i: -lengths[i]):
        spare, k = min(counts[i], budget // lengths[i]), 1
        while spare > 0 and sums[-1] < budget:
            k = min(k, spare)
            new = sums[sums <= budget - k * lengths[i]] + k * lengths[i]
            more = np.union1d(sums, new)
            if len(more) > most_sums:
                return None
            steps.append((i, k))
            found.append(sums)
            sums, spare, k = more, spare - k, 2 * k
    taken, w = [0] * len(lengths), int(sums[-1])
    for (i, k), before in zip(reversed(steps), reversed(found)):
        at = int(np.searchsorted(before, w))
        if at == len(before) or before[at] != w:  # only with this step
            taken[i] += k
            w -= k * lengths[i]
    return taken


def fit(lengths: list[int], counts: list[int], budget: int, dp_words: int = 1 << 16, most_words: int = 1 << 20) -> list[int]:
    """How many documents of each length to take so that their words come nearest to
    ``budget`` from below: proportional, then largest first, then exact subset sum.

    The program runs on a remainder of at most ``dp_words`` and one length, again on up to
    ``most_words`` where it misses; it is exact for the whole budget up to there.  Where that
    misses too, it runs over the sums that documents can make, exact for a budget of any size
    with up to 2^17 of them, as where documents are few.
    """
    words = lambda k: sum(a * b for a, b in zip(lengths, k))
    best = _fit(lengths, counts, budget, dp_words, most_words)
    if words(best) < min(budget, words(counts)):
        grid = math.gcd(*lengths)
        other = sparse_sum([n // grid for n in lengths], counts, budget // grid)
        if other and words(other) > words(best):
            return other
    return best


def _fit(lengths: list[int], counts: list[int], budget: int, dp_words: int, most_words: int) -> list[int]:
    total = sum(a * b for a, b in zip(lengths, counts))
    if total <= budget:
        return list(counts)
    grid = math.gcd(*lengths)  # not 0, as there are words; sums are multiples of it
    lengths, budget, total = [n // grid for n in lengths], budget // grid, total // grid
    take = [budget * c // total if n else 0 for n, c in zip(lengths, counts)]
    left = budget - sum(a * b for a, b in zip(lengths, take))
    order = sorted((i for i, n in enumerate(lengths) if n), key=lambda i: -lengths[i])
    for i in order:
        if left <= dp_words or left <= most_words and left < dp_words + lengths[i] and take[i] < counts[i]:
            break
        more = min(counts[i] - take[i], (left - dp_words) // lengths[i])
        take[i] += more
        left -= more * lengths[i]
    if left > max(most_words, 2 * dp_words):  # every length left is over half of it: at most one more document fits
        one = next((i for i in order if take[i] < counts[i] and lengths[i] <= left), None)
        return [k + (i == one) for i, k in enumerate(take)]
    while True:
        more = subset_sum(lengths, [c - k for c, k in zip(counts, take)], left)
        best = [a + b for a, b in zip(take, more)]
        if sum(a * b for a, b in zip(lengths, best)) == budget or not any(take[i] for i in order):
            return best
        held, wide = left, min(4 * left + dp_words, most_words)
        for i in reversed(order):  # a miss: documents are given back, short ones first
            back = min(take[i], max(0, wide - left) // lengths[i])
            take[i] -= back
            left += back * lengths[i]
        if left == held:
            return best


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """(id, size, source_size, target, taken), one row per row of ``docs``.

    A null or wordless text has size 0 and taken 0.  A null source is a source, last in
    order.  Repeated rows are separate documents with equal hashes; which of them is
    taken is the same multiset on every run.  Clashing extra columns are not read.
    The number of sources is collected (one row each), the documents are not.
    """
    t = F.col(f"`{text}`").cast("string")
    rows = keep(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source}`").cast("string").alias("src"),
        F.coalesce(F.regexp_count(t, F.lit(WORD)), F.lit(0)).cast("long").alias("size")).withColumn(
            "h", F.xxhash64(F.lit(seed), F.col("id").cast("string"), "size")))
    bins = rows.groupBy("src", "size").agg(F.count("*").alias("n"))
    bins = keep(bins)
    spark = docs.sparkSession
    sizes = sorted(((r["src"], int(r["s"])) for r in bins.groupBy("src").agg(F.sum(
        F.col("size") * F.col("n")).alias("s")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    target = targets_of(sizes, weights, share, most)
    plan = spark.createDataFrame([(k, s, float(target[k])) for k, s in sizes],
                                 "src string, source_size long, target double")

    def one(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("size")
        goal, whole = int(round(float(g.target.iloc[0]))), int((g["size"] * g.n).sum())
        times = min(goal // whole, int(most)) if whole else 0
        rest = min(goal - times * whole, whole) if times < most else 0
        lens, ns = [int(x) for x in g["size"]], [int(x) for x in g.n]
        k = fit(lens, ns, rest) if rest > 0 else [0] * len(lens)
        return pd.DataFrame({"src": g.src, "size": g["size"], "times": times, "k": k})

    planned = bins.join(F.broadcast(plan), bins["src"].eqNullSafe(plan["src"])).select(
        bins["src"], "size", "n", "target")
    chosen = planned.groupBy("src").applyInPandas(one, "src string, size long, times long, k long")
    chosen = keep(chosen.join(F.broadcast(plan.withColumnRenamed("src", "psrc")),
                              F.col("src").eqNullSafe(F.col("psrc"))).drop("psrc"))
    # the k documents of least hash in each (source, length): first by hash range, then inside one range
    at = F.pmod(F.shiftrightunsigned("h", 40), F.lit(RANGES))
    rows = rows.withColumn("range", at)
    by = rows.groupBy("src", "size", "range").agg(F.count("*").alias("held"))
    w = Window.partitionBy("src", "size").orderBy("range")
    by = by.withColumn("before", F.sum("held").over(w) - F.col("held"))
    c = chosen.alias("c")
    ranged = by.alias("b").join(c, F.expr("b.src <=> c.src and b.size = c.size")).select(
        "b.src", "b.size", "b.range", "times", "source_size", "target",
        F.expr("k - before").alias("room"), "b.held")
    r, g = rows.alias("r"), ranged.alias("g")
    out = r.join(g, F.expr("r.src <=> g.src and r.size = g.size and r.range = g.range")).select(
        "r.id", "r.src", "r.size", "r.range", "r.h", "times", "source_size", "target", "room", "held")
    split = (F.col("room") > 0) & (F.col("room") < F.col("held"))
    cut = out.where(split).withColumn("rn", F.row_number().over(
        Window.partitionBy("src", "size", "range").orderBy("h", F.col("id").cast("string"))))
    whole = out.where(~split).withColumn("rn", F.lit(1))
    extra = F.when(F.col("rn") <= F.col("room"), 1).otherwise(0)
    extra = F.when(F.col("room") >= F.col("held"), 1).otherwise(extra)
    return whole.unionByName(cut).select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        ((F.col("times") + extra) * F.col("size")).alias("taken"))
