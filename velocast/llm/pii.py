"""Personal data by weak supervision, in DataFrame functions only (operator 5).

Candidates are the base matches of four patterns and looser ones (written-out
addresses, bare phone numbers; names of persons are none).  Labelers for the regex, short
lists (endings of domains, first digits of cards), context and shape vote on each candidate
(1 yes, 0 no, -1 silent).  Counts of the vote patterns,
a table bounded by 3^labelers, go to an expectation-maximisation that estimates each
labeler's reliability and each pattern's posterior.  The final span classifier is a
naive Bayes model over span and context features, trained on the candidates weighted
by those posteriors; it decides on the looser candidates.  Base spans always stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velocast.llm.shared import fresh, keep
from velocast.llm.spans import SPAN, chunks, cut, digest, digits, let, luhn, matches, with_sums

KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9 -]*[0-9]"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
LOOSE = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63} ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z]{2,24}",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
}
#: Words before a span that speak for personal data.
CUES = r"(?i)(?:e-?mail|mail|phone|tel|call|fax|contact|mobile|reach|write|address|card|ip)\W{0,3}$"
#: Endings of domains and first digits of card networks and area codes.
DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$"
CONTEXT = 24


def base(text: Column) -> Column:
    """The base spans of a non-null text, by kind as in KINDS, then by start."""
    # a dot that can't stand inside a domain becomes '%', which a local part takes alike
    mail = F.when(F.contains(text, F.lit("@")), F.regexp_replace(
        text, r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])", "%")).otherwise(F.lit(""))
    # a separator that can't stand inside a card number becomes '#'
    card = F.regexp_replace(text, r"(?<![0-9])[ -]|[ -](?![0-9])", "#")
    card = F.when(text.rlike(r"[0-9](?:[ -]?[0-9]){15}"), card).otherwise(F.lit(""))
    email = F.when(F.contains(text, F.lit("@")), matches(mail, EMAIL, "email", text)).otherwise(F.array().cast(SPAN))
    ip = F.filter(matches(text, IP, "ip"), lambda x: F.forall(
        F.split(x["value"], r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", "")).between(1, 3)
        & (F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 3).cast("int") <= 255)))
    cards = F.filter(matches(card, CARD, "card", text), lambda x: F.length(digits(x["value"])).between(16, 19)
                     & luhn(digits(x["value"])))
    phone = F.filter(matches(text, PHONE, "phone"), lambda x: F.length(digits(x["value"])).between(8, 15))
    return F.concat(email, ip, cards, phone)


def _loose(text: Column, found: Column) -> Column:
    """Looser candidates that overlap no base span."""
    more = F.concat(*[matches(text, p, k) for k, p in LOOSE.items()])
    return F.filter(more, lambda x: ~F.exists(found, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))


def _features(x: Column) -> dict[str, Column]:
    """Votes (-1, 0 or 1) and features of a candidate (kind, value, is_base, left, right)."""
    yes = lambda cond: F.when(cond, 1).otherwise(0)
    kind, value = x["kind"], x["value"]
    return {
        "kind": kind,
        "v_regex": yes(x["is_base"]),
        "v_gazetteer": F.when(kind == "email", yes(F.regexp_replace(value, r" ?[\[(]dot[\])] ?", ".").rlike(DOMAINS)))
        .when(kind == "card", yes(value.rlike("^[3-6]"))).otherwise(-1),
        "v_context": yes(x["left"].rlike(CUES)),
        "v_shape": F.when(kind == "phone", yes(digits(value).rlike("^1?[2-9][0-9]{9}$")))
        .when(kind == "ip", yes(~value.rlike(r"^(?:0|127|255)\."))).otherwise(-1),
        "f_cue": x["left"].rlike(CUES).cast("string"),
        "f_left": F.when(x["left"] == "", "none").when(x["left"].rlike(r"\s$"), "space").otherwise("other"),
        "f_right": F.when(x["right"] == "", "none").when(x["right"].rlike(r"^[\s.,;:]"), "end").otherwise("other"),
        "f_length": F.least(F.length(value) / 8, F.lit(6)).cast("int").cast("string"),
    }


LABELERS = ("v_regex", "v_gazetteer", "v_context", "v_shape")
FEATURES = ("kind", "f_cue", "f_left", "f_right", "f_length", *LABELERS[1:])


def em(patterns: dict[tuple, int], rounds: int = 50) -> tuple[dict[tuple, float], list[tuple]]:
    """Posterior of each vote pattern, and (hit rate, false-alarm rate) of each labeler,
    by expectation-maximisation over counts of patterns (votes independent given truth)."""
    if not patterns:
        return {}, []
    m = len(next(iter(patterns)))
    prior, rate = 0.7, [(0.8, 0.3)] * m
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for v in patterns:
            a, b = prior, 1 - prior
            for x, (h, f) in zip(v, rate):
                if x >= 0:
                    a, b = a * (h if x else 1 - h), b * (f if x else 1 - f)
            post[v] = a / (a + b)
        n = sum(patterns.values())
        prior = min(0.99, max(0.01, sum(c * post[v] for v, c in patterns.items()) / n))
        rate = []
        for i in range(m):
            said = [(v, c) for v, c in patterns.items() if v[i] >= 0]
            yes, no = sum(c * post[v] for v, c in said), sum(c * (1 - post[v]) for v, c in said)
            rate.append(((sum(c * post[v] for v, c in said if v[i]) + 4) / (yes + 5),
                         (sum(c * (1 - post[v]) for v, c in said if v[i]) + 1) / (no + 5)))
    return post, rate


def _candidates(text: Column, base_spans: Column, more: Column) -> Column:
    """Base and looser spans with the text beside them."""
    def told(arr: Column, is_base: bool, parts: Column) -> Column:
        return F.transform(arr, lambda x: F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
            F.lit(is_base).alias("is_base"), cut(parts, F.greatest(x["start"] - CONTEXT, F.lit(0)), x["start"]).alias("left"),
            cut(parts, x["end"], x["end"] + 1).alias("right")))

    return let(chunks(text), lambda p: F.concat(told(base_spans, True, p), told(more, False, p)))


def train(cands: DataFrame):
    """The final classifier from the candidates ``x``: a function from a candidate column
    to its probability.

    Votes and features take few values each, so the table of their patterns that the
    driver reads is bounded by their product, whatever the corpus.
    """
    v = cands.select(*[c.alias(k) for k, c in _features(F.col("x")).items()])
    keys = [*LABELERS, "f_cue", "f_left", "f_right", "f_length"]
    table = v.groupBy("kind", *keys).count().collect()
    votes: dict[tuple, int] = {}
    for r in table:
        k = tuple(r[x] for x in LABELERS)
        votes[k] = votes.get(k, 0) + r["count"]
    post, _ = em(votes)
    yes, no, seen = 1.0, 1.0, {}
    for r in table:
        p = post[tuple(r[x] for x in LABELERS)]
        yes, no = yes + r["count"] * p, no + r["count"] * (1 - p)
        for f in FEATURES:
            a, b = seen.get((f, str(r[f])), (0.0, 0.0))
            seen[f, str(r[f])] = a + r["count"] * p, b + r["count"] * (1 - p)

    def probability(x: Column) -> Column:
        score, value = F.lit(math.log(yes / no)), _features(x)
        for f in FEATURES:
            rule = F.lit(0.0)
            for (g, known), (a, b) in sorted(seen.items()):
                if g == f:
                    rule = F.when(value[f].cast("string") == known, math.log((a + 1) / (yes + 2)) - math.log((b + 1) / (no + 2))).otherwise(rule)
            score = score + rule
        return 1 / (1 + F.exp(-score))

    return probability


def find(docs: DataFrame, text: str = "text", least: float = 0.5, carried: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carried``) with ``base_spans`` and ``spans``, arrays of kind,
    start, end (code points, end exclusive) and value; ``spans`` by kind, then start.

    A null text counts as empty and has no spans.  Rows are independent, so repeated rows
    and ids, null ids and extra columns (clashing names included) come through as they are.
    The text is read once to train and once to decide; without ``text`` in ``carried`` it is
    read once, as only the candidates are kept.
    """
    b, c, s = fresh(docs, "base_spans", "candidates", "spans")
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    some = t.rlike("[@0-9]")  # every candidate has one of these
    light = carried is not None and text not in carried
    d = docs.withColumn(b, F.when(some, base(t)).otherwise(F.array().cast(SPAN)))
    d = d.withColumn(c, F.when(some, _candidates(t, F.col(b), _loose(t, F.col(b)))))
    d = d.withColumn(c, F.coalesce(c, F.expr("filter(array(named_struct('kind','','start',0,'end',0,'value','','is_base',false,'left','','right','')), x -> false)")))
    if carried is not None:
        d = d.select(*[F.col(f"`{x}`") for x in carried], b, c)
    if light:
        d = keep(d)
        cands = d.select(F.explode(c).alias("x"))
    else:
        cands = keep(d.select(F.explode(c).alias("x")))
    probability = train(cands)
    more = F.filter(F.col(c), lambda x: ~x["is_base"] & (probability(x) >= least))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    every = F.concat(F.col(b), F.transform(more, lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"))))
    return d.withColumn(s, F.transform(F.array_sort(F.transform(every, lambda x: F.struct(
        rank[x["kind"]].alias("r"), x["start"].alias("s"), x.alias("x")))), lambda y: y["x"])).drop(c)


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    d = find(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text}`").cast("string").alias("\x00t")), "\x00t", carried=[id_col])
    n = lambda k: F.size(F.filter("base_spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return d.select(id_col, *[n(k) for k in KINDS], F.sha2(digest(F.col("base_spans")), 256).alias("base_sha256"),
                    digest(F.col("spans")).alias("spans"))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs``, each span of its text replaced by its kind in angle brackets."""
    b, s = fresh(docs, "base_spans", "spans")
    d = find(docs, text)
    t = F.col(f"`{text}`")
    order = F.array_sort(F.transform(F.col(s), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    # a span that begins before the end of an earlier one is covered by that one's mark
    ends = with_sums(order, lambda x: x["end"], lambda a, x: F.greatest(a, x))

    def joined(q: Column) -> Column:
        apart = F.filter(q["ends"], lambda y: y["x"]["start"] >= y["before"])
        marks = F.transform(apart, lambda y: F.concat(cut(q["parts"], y["before"], y["x"]["start"]), F.lit("<"), y["x"]["kind"], F.lit(">")))
        last = F.aggregate(q["ends"], F.lit(0), lambda m, y: F.greatest(m, y["x"]["end"]))
        return F.concat(F.array_join(marks, ""), let(F.struct(q["parts"].alias("parts"), last.alias("last"), q["n"].alias("n")), lambda z: cut(z["parts"], z["last"], z["n"])))

    new = let(F.struct(ends.alias("ends"), chunks(t).alias("parts"), F.length(t).alias("n")), joined)
    return d.withColumn(text, F.when(t.isNull() | (F.size(s) == 0), t).otherwise(new)).select(*[F.col(f"`{c}`") for c in docs.columns])
