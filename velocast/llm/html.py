"""Main text of web pages by equivalence-class template deduction (operator 3).

A page's tokens are its tags and end tags, each with the path of tags that it stands in, and its
text runs with theirs.  A token's occurrence vector says how often each page of its host has
it; two 64-bit exclusive ors of the hashes of (page, how often) stand for the vector, so it is
built by a map-side aggregate and a host with a third of all pages is no single task.  Tokens of a
host with equal vectors form an equivalence class; a class counts with two or more tokens on at
least half, and at least three, of the host's distinct pages.  It is valid as far as its tokens
stand in one order on every page (others leave it) and classes nest: one that is open when an
enclosing one goes on is dropped.  A valid class has slots, what stands between two of its
tokens; the slot that a token stands in tells roles of equal tokens apart, and classes are
found again over roles.  The template of a host are the nested classes over roles.

The article is chosen from the template's slots by what all pages of the host hold there; the lists of tags
and names (``DROP``, ``NOISE``) label runs, as does ``<article>`` or ``<main>``.  A text run
that is in a class with its own element is of the template and dropped, inside an article
too, unless such runs are most of the host's text: then its pages are copies.  Hosts
of one or two pages share one template.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velocast.llm.shared import keep
from velocast.session import scratch_path

#: A tag ends at the first ``>`` outside a quoted value, or with the page: no match is given up half-way.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
ATTR = re.compile(r"(?:^|[\s/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
HIDDEN = re.compile(r"(?:^|[\s/])(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true)|display\s*:\s*none", re.I)
#: Tags of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROP = frozenset("script style textarea title xmp iframe noembed noframes noscript head nav header footer aside form button select "
                 "option template svg math canvas object audio video dialog menu label fieldset input".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
SHUT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Names of classes, ids and roles of what is not the article.
NOISE = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|adbox|banner|sponsor|sponsored|promo|cookie|cookies|consent|gdpr|notice|"
                   r"alert|popup|modal|overlay|newsletter|subscribe|signup|login|comment|comments|commentlist|replies|disqus|respond|sidebar|side|widget|"
                   r"menu|nav|navbar|navigation|breadcrumb|breadcrumbs|pagination|pager|share|sharing|social|related|recommended|"
                   r"footer|header|masthead|toolbar|search|skip|complementary|contentinfo|dialog)(?=$|[\s_-])", re.I)

#: The token that each page has once.
PAGE = 0
_INT, _LONG, _BOOL = (pa.int32(), "int"), (pa.int64(), "long"), (pa.bool_(), "boolean")
_ROWS = "host string, page long, keys array<long>, info array<int>, up array<int>"


def runs(page: str) -> Iterator[tuple]:
    """('tag', path), ('end', path) and ('text', path, raw text, noise, article, block number) in page order.

    ``path`` is a hash of the names of the tags that are open, the tag itself included; unclosed paragraphs, list items and
    cells end where the next block begins; raw text of scripts and the like is one run; a line
    break is white space.  Linear in the page, however deep or malformed: an open tag holds what
    its ancestors add up to, and the place of the nearest open block.
    """
    # (tag, path, noise, articles and mains, articles, index of the nearest open block)
    stack: list = [("", 0, False, 0, 0, -1)]
    open_tags: Counter = Counter()
    block, at, n = 0, 0, len(page)

    def told(text):
        _, path, noise, article, _, _ = stack[-1]
        return ("text", path, text, noise, article, block)

    def close(i):
        ends = [("end", x[1]) for x in reversed(stack[i:])]
        for x in stack[i:]:
            open_tags[x[0]] -= 1
        del stack[i:]
        return ends

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            yield told(page[at:])
            return
        if m.start() > at:
            yield told(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            block += 1
        if m[1]:
            if open_tags[tag]:
                yield from close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
            continue
        if tag in BLOCK:
            i = stack[-1][5]
            if i > 0 and (stack[i][0] == "p" or stack[i][0] in SHUT.get(tag, ())):
                yield from close(i)
        _, path, noise, article, within, nearest = stack[-1]
        # short attributes recur and are remembered; long ones (data in a URL) would fill the memory
        name, told_bad = (_named if len(m[3]) <= 200 else _named.__wrapped__)(tag, m[3]) if m[3] else (tag, False)
        bad = told_bad or tag in DROP and not (tag == "header" and within)
        key = _key(path, name)
        yield ("tag", key)
        if tag == "br":
            yield told("\n")
        if tag in VOID or m[0].endswith("/>") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        open_tags[tag] += 1
        stack.append((tag, key, noise or bad, article + (tag in ("article", "main")), within + (tag == "article"),
                      len(stack) if tag in BLOCK else nearest))


@functools.lru_cache(maxsize=4096)
def _named(tag: str, attributes: str) -> tuple[str, bool]:
    """(tag with its names, whether they tell that it is hidden or not the article)."""
    names = " ".join(next(v for v in a[1:] if v or v is a[-1]) for a in ATTR.findall(attributes))
    bad = bool(names and tag not in ("html", "body", "article", "main") and NOISE.search(names)) or bool(HIDDEN.search(attributes))
    return (f"{tag}.{names}" if names else tag), bad


def _key(path: int, token: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\x00{token}") - (1 << 63)


def tokens(page: str) -> tuple:
    """(runs, keys, info, up) of a page, a value per token: info is -1 for tags, else the text's
    characters times four, plus 1 for noise, plus 2 in an article; up is the place of a text's own tag.  A blank
    run has key ``PAGE``."""
    found, keys, info, up, at = list(runs(page)), [], [], [], {}
    for r in found:
        if r[0] == "text":
            text = " ".join(r[2].split())
            keys.append(_key(r[1], "#" + text) if text else PAGE)
            info.append(len(text) << 2 | (2 if r[4] else 0) | (1 if r[3] else 0))
            up.append(at.get(r[1], -1))
        else:
            if r[0] == "tag":
                at[r[1]] = len(keys)
            keys.append(r[1] if r[0] == "tag" else ~r[1])
            info.append(-1)
            up.append(-1)
    return found, keys, info, up


def sweep(keys: list, of: dict) -> tuple[list, set, set]:
    """(slot of each token, tokens out of order, classes that cross others), with ``of`` mapping
    tokens to (class, place in it, its size).  A slot is (class, how many of its tokens were met), of the
    innermost class that is open.  Linear in the page: a class is opened and closed once an occurrence."""
    stack, due, slots, late, crossed, here = [], {}, [], set(), set(), (0, 0)
    for k in keys:
        t = of.get(k)
        if t:
            c, i, n = t
            if c not in due:
                if i:
                    late.add(k)
                else:
                    due[c] = 1
                    stack.append(c)
            elif i < due[c]:
                late.add(k)
            else:
                while stack[-1] != c:
                    crossed.add(stack[-1])
                    del due[stack.pop()]
                due[c] = i + 1
                if i == n - 1:
                    del due[stack.pop()]
            here = (stack[-1], due[stack[-1]]) if stack else (0, 0)
        slots.append(here)
    return slots, late, crossed


def roles(keys: list, first: dict) -> list:
    """Tokens told apart by the slot of the classes ``first`` that they stand in (hashes of integers: the same in every process)."""
    if not first:
        return keys
    return [k if k == PAGE or k in first else hash((k, *s)) for k, s in zip(keys, sweep(keys, first)[0])]


def _fixed(of: dict, keys: list, i: int, up: int) -> bool:
    """Whether a text run is in a class together with its own tag."""
    t = of.get(keys[i])
    u = of.get(keys[up]) if t and up >= 0 else None
    return bool(u) and u[0] == t[0]


class Template:
    """A host's classes, at first and over roles, the slots of its article, whether tags mark it, and whether fixed text is dropped."""

    __slots__ = ("first", "last", "slots", "marked", "drop")

    def __init__(self, row: dict):
        of = lambda x: {t["token"]: (t["class"], t["i"], t["n"]) for t in x or ()}
        self.first, self.last = of(row.get("first_tokens")), of(row.get("last_tokens"))
        self.slots = {(x["class"], x["i"]) for x in row.get("slots") or ()}
        self.marked, self.drop = bool(row.get("marked")), bool(row.get("fixed_drop"))


def _templated(columns: list[str]):
    """A function from (batch, row) to the row's template; those read last are held, up to 200,000 tokens and one more."""
    held: dict = {}
    size = 0

    def get(b: pa.RecordBatch, i: int) -> Template:
        nonlocal size
        host = b.column(0)[i].as_py()
        if host not in held:
            if size > 200_000:
                held.clear()
                size = 0
            held[host] = Template({c: b.column(c)[i].as_py() for c in columns})
            size += len(held[host].first) + len(held[host].last) + len(held[host].slots) + 1
        return held[host]

    return get


def _parsed(pages: DataFrame) -> DataFrame:
    """The tokens of each distinct page (by content hash) of a host, as a table; copies give
    equal tokens, so tokens, not texts, are shuffled and one of them stays.  Hosts of fewer than three
    pages are one group, that of the empty name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [tokens(t.as_py())[1:] for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([x[j] for x in out], pa.list_(t)) for j, t in enumerate((pa.int64(), pa.int32(), pa.int32())))],
                                             ["host", "page", "keys", "info", "up"])

    spark = pages.sparkSession
    path = scratch_path(spark, "html", "tokens")
    pages.select("host", F.xxhash64("t").alias("page"), "t").mapInArrow(run, _ROWS).dropDuplicates(["host", "page"]).write.parquet(path)
    one = spark.read.parquet(path)
    many = _table(one.groupBy("host").count().where("count >= 3").select("host", F.col("host").alias("group")), "hosts")
    return one.join(many, "host", "left").select(F.coalesce("group", F.lit("")).alias("host"), "page", "keys", "info", "up")


def _table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again: Spark knows its bytes, so it broadcasts a small one and else splits a hot host in the join."""
    path = scratch_path(df.sparkSession, "html", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _per_page(parsed: DataFrame, templates: DataFrame | None, each, reads: list[str], kinds: dict) -> DataFrame:
    """(host, page, columns of ``kinds``): the rows that ``each`` (template, columns ``reads``) gives of each page.

    ``kinds`` holds (Arrow type, Spark type) by name."""
    wanted = [c for c in templates.columns if c != "host"] if templates is not None else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _templated(wanted)
        for b in batches:
            out = [each(of(b, i), *x) for i, x in enumerate(zip(*(b.column(c).to_pylist() for c in reads)))]
            of_row = pa.array([i for i, x in enumerate(out) for _ in x], pa.int32())
            cols = list(zip(*(x for o in out for x in o))) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0).take(of_row), b.column(1).take(of_row), *(pa.array(c, t) for c, (t, _) in zip(cols, kinds.values()))],
                                             ["host", "page", *kinds])

    rows = parsed.join(templates, "host", "left") if wanted else parsed
    return rows.select("host", "page", *reads, *wanted).mapInArrow(run, "host string, page long, " + ", ".join(f"`{n}` {t}" for n, (_, t) in kinds.items()))


def classes(parsed: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """(host, token, class, first): the large and frequent classes over tokens, or with
    ``templates`` over their roles; ``first`` orders a class by the first page that has it.

    Each token stands on at least half of its host's pages, so a host's classes are bounded by
    twice the tokens of an average page.
    """
    def each(t, keys):
        seen: dict = {}
        for i, k in enumerate(roles(keys, t.first)):
            if k != PAGE:
                c = seen.get(k)
                seen[k] = (c[0] + 1, c[1]) if c else (1, i)
        return [(PAGE, 1, 0), *((k, c, i) for k, (c, i) in seen.items())]

    found = _per_page(parsed, templates, each, ["keys"], {"token": _LONG, "c": _INT, "first": _INT})
    # the place on the page of the least hash, as one number: hashed aggregates take numbers, not structs
    place = F.shiftleft(F.shiftright("page", 24), 24) + F.least("first", F.lit((1 << 24) - 1))
    vec = keep(found.groupBy("host", "token").agg(
        F.bit_xor(F.xxhash64("page", "c", F.lit(1))).alias("s1"), F.bit_xor(F.xxhash64("page", "c", F.lit(2))).alias("s2"),
        F.count("*").alias("df"), F.min(place).alias("first")).where("df >= 3"))
    n = vec.where(F.col("token") == PAGE).select("host", F.col("df").alias("pages"))
    large = vec.where(F.col("token") != PAGE).join(n, "host").where("2 * df >= pages")
    return large.select("host", "token", F.xxhash64("s1", "s2", "df").alias("class"), "first")


def _numbered(found: DataFrame, name: str) -> DataFrame:
    """(host, ``name``): the classes of two or more tokens, with each token's place."""
    w = Window.partitionBy("host", "class")
    placed = found.withColumns({"n": F.count("*").over(w), "i": F.row_number().over(w.orderBy("first", "token")) - 1}).where("n >= 2")
    return placed.groupBy("host").agg(F.collect_list(F.struct("token", "class", "i", F.col("n").cast("int").alias("n"))).alias(name))


def valid(parsed: DataFrame, found: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """``found`` (see :func:`classes`) without the tokens out of order on a page and the classes that cross others."""
    def each(t, keys):
        _, late, crossed = sweep(roles(keys, t.first), t.last)
        return [(k, False) for k in late] + [(k, True) for k in crossed]

    found = _table(found, "classes")
    tried = _numbered(found, "last_tokens")
    if templates is not None:
        tried = templates.join(tried, "host")
    bad = _table(_per_page(parsed, _table(tried, "tried"), each, ["keys"], {"x": _LONG, "whole": _BOOL}).select("host", "x", "whole").distinct(), "bad")
    return (found.join(bad.where("not whole").select("host", F.col("x").alias("token")), ["host", "token"], "left_anti")
            .join(bad.where("whole").select("host", F.col("x").alias("class")), ["host", "class"], "left_anti"))


def article_slots(parsed: DataFrame, templates: DataFrame) -> DataFrame:
    """(host, slots, marked, fixed_drop): the slots of the article by the text of all pages of a host.

    Text that is neither noise nor fixed counts.  The host is marked where a quarter of it or more lies in
    ``<article>`` or ``<main>`` (less is a teaser): then the slots with a quarter or more of theirs there are
    chosen, and otherwise all with text.  Fixed text is dropped unless it is over three quarters of what those hold.
    """
    def each(t, keys, info, up):
        keys, sums = roles(keys, t.first), {}
        for i, s in enumerate(sweep(keys, t.last)[0]):
            if info[i] > 3 and not info[i] & 1:
                x, n = sums.setdefault(s, [0, 0, 0]), info[i] >> 2
                if _fixed(t.last, keys, i, up[i]):
                    x[2] += n
                else:
                    x[0] += n
                    x[1] += n if info[i] & 2 else 0
        return [(*s, *x) for s, x in sums.items()]

    found = _per_page(parsed, templates, each, ["keys", "info", "up"], {"class": _LONG, "i": _INT, "good": _LONG, "article": _LONG, "fixed": _LONG})
    sums = found.groupBy("host", "class", "i").agg(*(F.sum(c).alias(c) for c in ("good", "article", "fixed")))
    w = Window.partitionBy("host")
    marked = (F.sum("article").over(w) > 0) & (4 * F.sum("article").over(w) >= F.sum("good").over(w))
    chosen = sums.withColumn("marked", marked).where("not marked or 4 * article >= good")
    return chosen.groupBy("host").agg(F.collect_list(F.struct("class", "i")).alias("slots"), F.first("marked").alias("marked"),
                                      (F.sum("fixed") <= 3 * F.sum("good")).alias("fixed_drop"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, first_tokens, last_tokens, slots, marked, fixed_drop), see :class:`Template`, of hosts of three pages
    or more; the host of the empty name stands for the others."""
    parsed = _parsed(pages)
    first = _table(_numbered(valid(parsed, classes(parsed)), "first_tokens"), "first")
    last = _numbered(valid(parsed, classes(parsed, first), first), "last_tokens")
    both = _table(parsed.select("host").distinct().join(first, "host", "left").join(last, "host", "left"), "last")
    return both.join(article_slots(parsed, both), "host", "left")


def main_text(page: str, template: Template | frozenset | None) -> str:
    """The text of the article's slots: blocks in page order, white space made one space."""
    found, keys, info, up = tokens(page)
    good = [(i, r) for i, r in enumerate(found) if r[0] == "text" and not r[3]]
    chosen = []
    if template:
        keys = roles(keys, template.first)
        slots = sweep(keys, template.last)[0]
        if template.drop:
            good = [(i, r) for i, r in good if not _fixed(template.last, keys, i, up[i])]
        chosen = [(i, r) for i, r in good if slots[i] in template.slots]
    chosen = [(i, r) for i, r in chosen if info[i] > 3] or good  # or the page has nothing in the slots of its host's article
    if not template or template.marked or chosen is good:
        chosen = [(i, r) for i, r in chosen if r[4] and info[i] > 3] or chosen
    held = {i for i, _ in chosen}
    blocks: dict = {}
    for i, r in good:
        if i in held or info[i] <= 3:  # white space between runs stays
            blocks.setdefault(r[5], []).append(r[2])
    out = (" ".join(entities.unescape("".join(x)).split()) for x in blocks.values())
    return "\n\n".join(x for x in out if x)


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text, n_chars), one row per row of ``pages``.

    A null html has empty text; a null or odd url is a host of its own; a host with one
    distinct page or two has the template of all such hosts.  Repeated rows count once in a template.  Extra columns
    are not read.
    """
    t = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    u = F.col(f"`{url}`").cast("string")
    host = F.coalesce(F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), u.alias("url"), host.alias("host"), t.alias("t"))
    found = _table(templates(rows), "templates")
    wanted = [c for c in found.columns if c != "host"]
    shared = [r.asDict(recursive=True) for r in found.where("host = ''").collect()]  # one row, bounded by the tokens of a page
    full = rows.join(found, "host", "left").select("host", "id", "url", "t", *wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, small = _templated(wanted), Template(shared[0]) if shared else None
        for b in batches:
            own = [of(b, i) if b.column("marked")[i].is_valid else small for i in range(b.num_rows)]
            out = [main_text(t.as_py(), k) for t, k in zip(b.column(3), own)]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                                             ["id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return full.mapInArrow(run, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id_col)
