"""The registered queries of the operators, and their oracle SQL where SQL can state the result."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def importable(fn):
    """Let Python workers on the same file system find the package, from whatever folder the driver runs."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    @functools.wraps(fn)
    def run(spark: SparkSession, *args) -> DataFrame:
        environment = spark.sparkContext.environment
        paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
        return fn(spark, *args)

    return run


def query(name: str):
    def register(fn):
        QUERIES[name] = importable(fn)
        return QUERIES[name]

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.token_files import encode_corpus

    return encode_corpus(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.line_dedup import dedup_lines

    lines = dedup_lines(table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op10_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id < r.last_doc AS dropped FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


ALLOW, BLOCK = ["com/", "www.example.com/en/"], ["example.com/en/", "net/es/", "net/fr/"]


@query("op2_url_filter")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.url_filter import judge_pages

    return judge_pages(table(spark, sf_dir, "pages"), ALLOW, BLOCK).drop("trust", "distrust")


def url_oracle(rounds: int = 20, damping: float = 0.85, threshold: float = 0.5) -> str:
    """The rules, the link graph and each round of propagation as a CTE."""
    rest = "CASE WHEN position('://' IN {0}) > 0 THEN substr({0}, position('://' IN {0}) + 3) ELSE '' END"
    lower = "translate(regexp_extract({0}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    listed = ", ".join(
        f"('{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}', '{a}')" for a, rules in (("allow", ALLOW), ("block", BLOCK)) for r in rules
    )
    steps = ["SELECT kind, host, seed AS rank FROM start"]
    for i in range(rounds):
        steps.append(f"""SELECT kind, host, sum(rank) AS rank FROM (
          SELECT kind, host, seed AS rank FROM start UNION ALL
          SELECT s.kind, s.next AS host, {damping} * r.rank * s.share FROM r{i} r JOIN steps s ON r.kind = s.kind AND r.host = s.host) GROUP BY ALL""")
    chain = ", ".join(f"r{i} AS MATERIALIZED ({s})" for i, s in enumerate(steps))
    return rf"""
    WITH rules(rule_host, rule_path, rule, action) AS (VALUES {listed}),
    cut AS (SELECT row_number() OVER () AS n, page_id, html, {rest.format("coalesce(url, '')")} AS rest FROM pages),
    parsed AS MATERIALIZED (SELECT n, page_id, html, {lower.format('rest')} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    fits AS (
      SELECT p.n, arg_max(struct_pack(rule := r.rule, action := r.action), length(r.rule)) AS hit
      FROM parsed p JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
      GROUP BY p.n),
    ruled AS MATERIALIZED (SELECT p.page_id, p.host, p.path, f.hit.rule AS rule, f.hit.action AS action FROM parsed p LEFT JOIN fits f ON p.n = f.n),
    seeds AS (
      SELECT host, avg(CASE WHEN action = 'allow' THEN 1.0 ELSE 0.0 END) AS trust, avg(CASE WHEN action = 'block' THEN 1.0 ELSE 0.0 END) AS distrust
      FROM ruled GROUP BY host),
    start AS MATERIALIZED (SELECT 'trust' AS kind, host, trust AS seed FROM seeds WHERE trust > 0
      UNION ALL SELECT 'distrust', host, distrust FROM seeds WHERE distrust > 0),
    found AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1)) AS link FROM parsed),
    named AS (SELECT src, CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END AS link FROM found),
    linked AS (SELECT src, {lower.format('(' + rest.format('link') + ')')} AS dst FROM named),
    edges AS (SELECT src, dst, count(*) AS links FROM linked WHERE dst <> '' AND src <> '' AND dst <> src GROUP BY ALL),
    sides AS (SELECT 'trust' AS kind, src AS host, dst AS next, links FROM edges UNION ALL SELECT 'distrust', dst, src, links FROM edges),
    steps AS MATERIALIZED (SELECT kind, host, next, links / sum(links) OVER (PARTITION BY kind, host) AS share FROM sides),
    {chain},
    ranks AS (SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0) AS trust, coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0) AS distrust
      FROM r{rounds} GROUP BY host)
    SELECT p.page_id, p.host, p.path, p.rule, coalesce(p.action,
      CASE WHEN k.distrust >= {threshold} AND k.distrust > k.trust THEN 'block' ELSE 'allow' END) AS verdict
    FROM ruled p LEFT JOIN ranks k ON p.host = k.host
    """


ORACLE["op2_url_filter"] = url_oracle()


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.ordinal import grade, train

    docs = table(spark, sf_dir, "documents")
    return grade(docs, train(docs, table(spark, sf_dir, "labels")))


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Target weights of the mixture: src0, by far the largest source, gets a fifth, the others shares that rise in steps.
TARGETS = {"src0": 20.0} | {f"src{i}": 2.0 + i % 5 for i in range(1, 20)}


@query("op8_source_mixing")
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.pfair import mix

    rows = mix(table(spark, sf_dir, "documents").select("doc_id", "source"), TARGETS)
    return rows.select("doc.doc_id", "doc.source", "block", "slot", "released", "due", "place")


@query("op3_near_dedup")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op3_near_dedup"] = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingled AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM docs
), sized AS MATERIALIZED (SELECT doc_id, len(s) AS n FROM shingled),
flat AS MATERIALIZED (SELECT doc_id, hash(unnest(s)) AS h FROM shingled),
links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM flat x JOIN flat y ON x.h = y.h JOIN sized p ON p.doc_id = x.doc_id JOIN sized q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 75 * (any_value(p.n) + any_value(q.n) - count(*))
), reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id
), least AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sized s JOIN least l ON s.doc_id = l.doc_id
"""


@query("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.spotsigs import fingerprints, likeness

    rows = fingerprints(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("own", "").alias("fingerprint"), F.array_join("edited_own", "").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def spot_sql() -> str:
    from tillhouse.llm.spotsigs import common_words

    listed = ", ".join(f"'{w}'" for w in common_words())
    return rf"""
    WITH docs AS (
      SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next_text
      FROM documents
    ), edits AS MATERIALIZED (
      SELECT doc_id, text, substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) AS edited_text, next_text FROM docs
    ), texts AS (
      SELECT doc_id, 'own' AS kind, text FROM edits UNION ALL SELECT doc_id, 'edited', edited_text FROM edits UNION ALL SELECT doc_id, 'next', next_text FROM edits
    ), words AS (
      SELECT doc_id, kind, text, list_filter(string_split(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM texts
    ), content AS (
      SELECT doc_id, kind, text, w, list_filter(range(1, len(w) + 1), lambda i: NOT list_contains([{listed}], w[i])) AS spots FROM words
    ), chains AS (
      SELECT doc_id, kind, text, list_transform(list_filter(range(1, len(spots) + 1), lambda k: k = 1 OR spots[k] - spots[k - 1] > 1), lambda k:
        ' ' || w[spots[k]] || ' ' || CASE WHEN k < len(spots) THEN CASE WHEN spots[k + 1] - spots[k] > 1 THEN '# ' ELSE '' END || w[spots[k + 1]] || ' ' ELSE '' END) AS c
      FROM content
    ), sets AS MATERIALIZED (
      SELECT doc_id, kind, CASE WHEN len(c) > 0 THEN list_sort(list_distinct(list_transform(c, lambda x: substr(md5(x), 1, 8))))
        WHEN text = '' THEN [] ELSE [substr(md5(text), 1, 8)] END AS s
      FROM chains
    ), wide AS (
      SELECT doc_id, any_value(s) FILTER (WHERE kind = 'own') AS own, any_value(s) FILTER (WHERE kind = 'edited') AS edited, any_value(s) FILTER (WHERE kind = 'next') AS next_own
      FROM sets GROUP BY doc_id
    )
    SELECT e.doc_id, length(e.text) AS n_chars, sha256(e.edited_text) AS edited_sha256, array_to_string(own, '') AS fingerprint, array_to_string(edited, '') AS edited_fingerprint,
      CASE WHEN own = edited THEN 1.0::DOUBLE ELSE len(list_intersect(own, edited))::DOUBLE / (len(own) + len(edited) - len(list_intersect(own, edited))) END AS near_edited,
      CASE WHEN own = next_own THEN 1.0::DOUBLE ELSE len(list_intersect(own, next_own))::DOUBLE / (len(own) + len(next_own) - len(list_intersect(own, next_own))) END AS near_next
    FROM edits e JOIN wide ON e.doc_id = wide.doc_id
    """


ORACLE["op5_fingerprints"] = spot_sql()


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.licences import licence_report

    return licence_report(table(spark, sf_dir, "documents"))


@query("op11_centroid_clusters")
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.drift_clusters import cluster_report

    return cluster_report(table(spark, sf_dir, "embeddings"))


def cluster_sql(k: int = 16, rounds: int = 3) -> str:
    """Every round scans all centroids; sums are of whole numbers, divided towards minus infinity."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
          SELECT n, arg_min(c, struct_pack(d := d, c := c)) AS c, min(d) AS d
          FROM (SELECT v.n, z.c, list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - z.x[i]) * (v.x[i] - z.x[i])))::BIGINT AS d FROM v CROSS JOIN z{i} z)
          GROUP BY n)""")
        if i < rounds:
            steps.append(f"""
        s{i} AS (SELECT c, p, ((sum(x) - ((sum(x) % count(*) + count(*)) % count(*))) // count(*))::BIGINT AS m
          FROM (SELECT a.c, generate_subscripts(v.x, 1) AS p, unnest(v.x) AS x FROM v JOIN a{i} a USING (n)) GROUP BY c, p),
        z{i + 1} AS MATERIALIZED (SELECT z.c, coalesce(m.x, z.x) AS x FROM z{i} z LEFT JOIN (SELECT c, list(m ORDER BY p) AS x FROM s{i} GROUP BY c) m USING (c))""")
    return f"""
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
    ), z0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, x) - 1 AS c, x FROM v QUALIFY c < {k}
    ), {",".join(steps)},
    spread AS (SELECT c, sum(d)::BIGINT AS inertia FROM a{rounds} GROUP BY c)
    SELECT v.vec_id, a.c::INT AS cluster, a.d AS distance, s.inertia AS cluster_inertia, (SELECT sum(d)::BIGINT FROM a{rounds}) AS inertia,
           sha256(array_to_string(z.x, ',')) AS centroid_sha256
    FROM v JOIN a{rounds} a USING (n) JOIN spread s ON s.c = a.c JOIN z{rounds} z ON z.c = a.c
    """


ORACLE["op11_centroid_clusters"] = cluster_sql()


@query("op12_hard_negatives")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.hard_negatives import hard_negatives

    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings"), moved, F.col("vec_id") % 100 == 0)


ORACLE["op12_hard_negatives"] = """
WITH r AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), scored AS MATERIALIZED (
  SELECT a.n, a.vec_id AS anchor_id, b.n AS other, b.vec_id, a.label = b.label AS alike,
         list_sum(list_transform(range(1, 65), lambda i: a.x[i] * b.x[i]))::BIGINT AS score
  FROM r a JOIN r b ON a.n <> b.n WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT n, anchor_id, vec_id AS positive_id, other AS positive, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.n, p.positive ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.n = p.n AND NOT s.alike AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query("op13_sharding")
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.sharding import sharded

    return sharded(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
