"""Spans of regular-expression matches by DataFrame functions alone.

``split`` gives the text between matches and ``regexp_extract_all`` the matches; their
lengths, added up, are the code-point offsets.  Both walk Java's leftmost
non-overlapping matches.  Sums up to each match are made by blocks of about the square root
of their number, and parts of a text are read from chunks of it, so a text of very many
matches costs little more than its length.  The patterns here have no repeated groups (Java recurses on
those), and no run of characters is scanned again from each of its characters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def matches(text: Column, pattern: str, kind: str, original: Column | None = None) -> Column:
    """Array of (kind, start, end, value) for each match in ``text``; the value is read
    from ``original``, a text of the same length, where one is given."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found,
                       lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("n"), m.alias("m")))
    source = F.lit(None).cast("array<string>") if original is None else chunks(original)

    def spans(s: Column) -> Column:
        def one(x: Column, before: Column) -> Column:
            start = before + x["g"]
            end = start + x["n"]
            value = x["m"] if original is None else cut(s["source"], start, end)
            return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"))
        return F.transform(with_sums(s["pairs"], lambda x: x["g"] + x["n"]), lambda y: one(y["x"], y["before"]))

    out = let(F.struct(pairs.alias("pairs"), source.alias("source")), spans).cast(SPAN)
    # most texts have no match: only those with one are walked
    return F.when(text.rlike(pattern), out).otherwise(F.array().cast(SPAN))


def let(value: Column, use) -> Column:
    """``use`` of ``value``, which is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def with_sums(items: Column, size, add=lambda a, x: a + x) -> Column:
    """Array of (x, before): each element with the sum of ``size`` of those before it, or what
    ``add`` makes of them in place of a sum (0 for none)."""
    def summed(s: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(s["items"]))).cast("int"), F.lit(1))
        total = lambda at, n: F.aggregate(F.slice(s["sizes"], at, n), F.lit(0), add)

        def placed(w: Column) -> Column:
            block = F.transform(F.sequence(F.lit(0), (F.size(s["items"]) / w).cast("int")), lambda i: total(F.lit(1), i * w))
            return let(F.struct(block.alias("block"), w.alias("w")), lambda k: F.transform(s["items"], lambda x, i: F.struct(
                x.alias("x"), add(F.get(k["block"], (i / k["w"]).cast("int")), total((i / k["w"]).cast("int") * k["w"] + 1, i % k["w"])).alias("before"))))

        return let(width, placed)

    return let(items, lambda a: let(F.struct(a.alias("items"), F.transform(a, size).alias("sizes")), summed))


CHUNK = 512


def chunks(text: Column) -> Column:
    """The text in parts of ``CHUNK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text in :func:`chunks`, from the parts that hold them."""
    first = (start / CHUNK).cast("int")
    few = F.array_join(F.slice(parts, first + 1, F.greatest(((end - 1) / CHUNK).cast("int") - first + 1, F.lit(0))), "")
    return F.when(end > start, F.substring(few, start - first * CHUNK + 1, end - start)).otherwise("")


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of ASCII digits passes the Luhn test."""
    ds = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    total = F.aggregate(F.filter(ds, lambda d: d.isNotNull()), F.lit(0), lambda a, d: a + d.cast("int"))
    return total % 10 == 0
