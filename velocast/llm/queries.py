"""The registered queries of this subpackage, thin over its operators, and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from velocast.llm import (centroids, decontam, html, langid, licenses, lines, merkle, mixing, neardup, pii, secrets,
                          simhash, warc)

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def put(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql.strip()
        return f
    return put


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


@query("op2_decontam")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_langid")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query("op7_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query("op3_html")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query("op10_licenses")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op4_warc", """
SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN octet_length(encode(h)) < 100 OR page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN octet_length(encode(h)) < 100 OR page_id = f THEN NULL ELSE f END AS refers_to
FROM (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS f
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


@query("op8_neardup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.links(table(spark, sf_dir, "embeddings")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op11_lines", r"""
WITH l AS (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, coalesce(r.first_id <> k.doc_id, false) AS lost FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def _cluster_sql(rounds: int = 10, k: int = 8) -> str:
    """The rounds written out, over one row per vector and dimension."""
    near = lambda c: f"""SELECT vec_id, arg_min(c, dist * {k} + c) AS c, min(dist) AS dist
  FROM (SELECT v.vec_id, m.c, sum((v.x - m.x) * (v.x - m.x)) AS dist FROM v JOIN {c} m ON v.d = m.d GROUP BY 1, 2) GROUP BY 1"""  # noqa: E731
    parts = ["""f AS (SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([e for e in embedding if e IS NULL OR NOT isfinite(e)]) = 0)""",
             """v AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS d,
  CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS HUGEINT) AS x FROM f)""",
             f"""m0 AS MATERIALIZED (SELECT s.c, v.d, v.x FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c
  FROM f QUALIFY c < {k}) s ON v.vec_id = s.vec_id)"""]
    for i in range(rounds):
        parts += [f"a{i} AS MATERIALIZED ({near(f'm{i}')})",
                  f"""m{i + 1} AS MATERIALIZED (SELECT o.c, o.d, coalesce(n.x, o.x) AS x FROM m{i} o LEFT JOIN (
  SELECT c, d, (s - ((s % n) + n) % n) // n AS x FROM (
    SELECT a.c, v.d, CAST(sum(v.x) AS HUGEINT) AS s, count(*) AS n FROM a{i} a JOIN v ON a.vec_id = v.vec_id GROUP BY 1, 2)) n
  ON o.c = n.c AND o.d = n.d)"""]
    return "WITH " + ",\n".join(parts) + f""",
z AS ({near(f'm{rounds}')}),
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS sha FROM m{rounds} GROUP BY c)
SELECT vec_id, CAST(z.c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
       CAST(sum(dist) OVER (PARTITION BY z.c) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia,
       h.sha AS centroid_sha256 FROM z JOIN h ON z.c = h.c"""


@query("op12_centroids", _cluster_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def _merkle_sql(heights: tuple[int, int] = (8, 4), a: int = 8) -> str:
    """The levels written out, up to ``a`` ** heights leaves of a lang and langs."""
    field = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda t: "sha256(" + " || ".join(field(t if c == "text" else c) for c in LEAF) + ")"
    # crc32 byte by byte, with the remainders of all bytes as a list
    rest = [zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)]
    crc = f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [ascii(c) for c in string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda r, b: xor(({rest})[(xor(r, b) & 255) + 1], r >> 8)), 4294967295)"""
    # p: the siblings met so far, e: the digest folded so far; a lone node stays as it is
    parts = [f"""w AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, {leaf('text')} AS d,
  CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS e FROM documents)""",
             "n0 AS MATERIALIZED (SELECT coalesce('.' || lang, '') AS g, i, d FROM w)",
             "l0 AS MATERIALIZED (SELECT doc_id, d AS leaf, coalesce('.' || lang, '') AS g, i, '' AS p, e FROM w)"]

    def climb(n, x, first, last):
        for j in range(first, last):
            parts.append(f"""{n}{j + 1} AS MATERIALIZED (SELECT g, r AS i, CASE WHEN any_value(m) = 1 THEN any_value(d)
  ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d, string_agg(d, '' ORDER BY i) AS run, any_value(m) AS m
  FROM (SELECT g, i, d, i // {a} AS r, count(*) OVER (PARTITION BY g) AS m FROM {n}{j}) GROUP BY g, r)""")
            cut = f"substr(run, 1, CAST(64 * (x.i % {a}) AS BIGINT))", f"substr(run, CAST(64 * (x.i % {a}) + 65 AS BIGINT))"
            parts.append(f"""{x}{j + 1} AS MATERIALIZED (SELECT x.* EXCLUDE (i, p, e), x.i // {a} AS i,
  CASE WHEN m = 1 THEN p ELSE p || {cut[0]} || {cut[1]} END AS p, CASE WHEN m = 1 THEN e ELSE sha256({cut[0]} || e || {cut[1]}) END AS e
  FROM {x}{j} x JOIN {n}{j + 1} n ON x.g = n.g AND x.i // {a} = n.i)""")

    climb("n", "l", 0, heights[0])
    t = heights[0]
    parts += [f"u AS (SELECT g AS lk, d, row_number() OVER (ORDER BY encode(g)) - 1 AS i FROM n{t})",
              "t0 AS MATERIALIZED (SELECT '' AS g, i, d FROM u)",
              f"r0 AS MATERIALIZED (SELECT doc_id, leaf, u.d AS subroot, '' AS g, u.i, p, e FROM l{t} l JOIN u ON l.g = u.lk)"]
    climb("t", "r", 0, heights[1])
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, t.d AS root, sha256(p) AS proof_sha256, e AS folded_root, e = t.d AS verified
FROM r{heights[1]} CROSS JOIN t{heights[1]} t"""


@query("op13_merkle", _merkle_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("doc_id").isNotNull()
    text = F.when(tampered, F.translate("text", lines.UPPER, lines.LOWER)).otherwise(F.col("text"))
    return merkle.audit(table(spark, sf_dir, "documents"), LEAF, changed={"text": text})


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
