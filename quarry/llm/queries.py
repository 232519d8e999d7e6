"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .decontam import decontaminate_report
from .divergence import source_divergences
from .line_runs import dedup_lines
from .mixing import mix
from .ngram_lm import interpolated_scores
from .quality_gbt import quality_scores
from .simhash import hex_column, simhash_components
from .sketch import as_string, fingerprint_report
from .token_cache import token_counts
from .toxicity import toxicity_scores
from .url_filter import Rule, judge_urls
from .warc import round_trip
from .whitening import whitened_rows

QueryFn = Callable[[SparkSession, str], DataFrame]

URL_RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
             Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]
TOKENIZER = "byte_bpe_50k.json"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the SQL ends sampling at the first document that exceeds what is left
    out = mix(read_table(spark, sf_dir, "documents"), descend=False)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), hex_column(F.col("fp")).alias("fingerprint"), "component_id")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint_report(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", as_string(F.col("sketch")).alias("fingerprint"),
                      as_string(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.withColumnRenamed("id", "doc_id")


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interpolated_scores(read_table(spark, sf_dir, "documents"))
    return out.withColumnRenamed("id", "doc_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return out.withColumnRenamed("id", "doc_id")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES, spellings=False).withColumnRenamed("id", "page_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergences(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_rows(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


SQL = {
    "op1_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
m AS (SELECT *, CASE WHEN size >= 50 THEN 2 ELSE 1 END AS measure, coalesce('s' || source, 'n') AS skey FROM d),
s0 AS (SELECT skey, any_value(source) AS source, sum(size)::DOUBLE AS source_size FROM m GROUP BY skey),
s1 AS (SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s0),
s2 AS (SELECT *, 2.0 * source_size / weight AS full_at FROM s1),
s3 AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER f, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0)) AS level
       FROM s2 WINDOW f AS (ORDER BY full_at, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT skey, source_size, least(2.0 * source_size, max(level) OVER () * weight) AS target FROM s3),
l0 AS (SELECT skey, measure, sum(size)::DOUBLE AS size FROM m GROUP BY ALL),
l1 AS (SELECT l0.*, target, source_size FROM l0 JOIN s4 USING (skey)),
l2 AS (SELECT *, target - coalesce(sum(2.0 * size) OVER f, 0) AS remaining,
              sum(size * measure) OVER (PARTITION BY skey) - coalesce(sum(size * measure) OVER f, 0) AS mass
       FROM l1 WINDOW f AS (PARTITION BY skey ORDER BY measure DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l3 AS (SELECT *, least(2.0, coalesce(max(CASE WHEN mass > 0 THEN remaining / mass END) OVER (PARTITION BY skey), 0.0) * measure) AS expected FROM l2),
p AS (SELECT skey, measure, size, source_size, target, floor(expected) AS whole, expected - floor(expected) AS p FROM l3),
r0 AS (SELECT skey, any_value(target) - sum(whole * size) AS remaining FROM p GROUP BY skey),
q AS (SELECT m.*, whole, source_size, target, p, remaining, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q
      FROM m JOIN p USING (skey, measure) JOIN r0 USING (skey)),
o AS (SELECT *, CASE WHEN q IS NOT NULL THEN sum(CASE WHEN q IS NOT NULL THEN size ELSE 0 END)
                OVER (PARTITION BY skey ORDER BY q NULLS LAST, doc_id NULLS FIRST, m_size ROWS UNBOUNDED PRECEDING) END AS upto
      FROM (SELECT *, size AS m_size FROM q)),
g1 AS (SELECT skey, any_value(remaining) - coalesce(max(CASE WHEN upto <= remaining THEN upto END), 0) AS gap FROM o WHERE q IS NOT NULL GROUP BY skey),
n1 AS (SELECT skey, arg_min(struct_pack(d := doc_id, z := size), row(abs(size - gap), q, upto)) AS one
       FROM o JOIN g1 USING (skey) WHERE upto > remaining AND abs(size - gap) < abs(gap) GROUP BY skey),
g2 AS (SELECT skey, gap - coalesce(one.z, 0) AS gap FROM g1 LEFT JOIN n1 USING (skey)),
n2 AS (SELECT skey, arg_min(struct_pack(d := doc_id, z := size), row(abs(size - gap), q, upto)) AS one
       FROM o JOIN g2 USING (skey) LEFT JOIN n1 USING (skey)
       WHERE upto > remaining AND abs(size - gap) < abs(gap) AND n1.one.d IS DISTINCT FROM doc_id GROUP BY skey)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       size * (whole + CASE WHEN upto <= remaining OR n1.one.d = doc_id OR n2.one.d = doc_id THEN 1 ELSE 0 END)::BIGINT AS taken
FROM o LEFT JOIN n1 USING (skey) LEFT JOIN n2 USING (skey)
""",
    "op4_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT html, count(*) AS many, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY html),
j AS (SELECT p.*, first_id, f.html IS NOT NULL AND many > 1 AND page_id IS DISTINCT FROM first_id AS again
      FROM p LEFT JOIN f ON p.html = f.html)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to
FROM j
""",
    "op5_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS rid FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 12], ' ') AS win, least(len(w), 13) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT rid, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
          FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT g.rid, g.i, g.n, win.item_id FROM grams g JOIN win USING (win, n)),
words AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS place FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS items_sha256
          FROM (SELECT DISTINCT rid, item_id::VARCHAR AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
""",
    "op8_url_filter": r"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\s[^>]*>')) AS tag
  FROM pages WHERE contains(url, '://')),
parts AS (
  SELECT url, lower(tag[2:5]) AS kind, lower(_ATTR(rel)) AS rel, lower(_ATTR(http-equiv)) AS equiv, _ATTR(href) AS href, _ATTR(content) AS content
  FROM tags),
found AS (
  SELECT url, href AS t FROM parts WHERE kind = 'link' AND list_contains(regexp_split_to_array(rel, '\s+'), 'canonical')
  UNION ALL
  SELECT url, trim(regexp_replace(regexp_extract(content, '(?is)^[^;,]*[;,]\s*(?:url\s*=)?\s*(.*)$', 1), '^[''"]|[''"]$', '', 'g'))
  FROM parts WHERE kind = 'meta' AND equiv = 'refresh'),
base AS (
  SELECT url, t, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS site,
         regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS page, regexp_replace(url, '(?s)#.*$', '') AS plain
  FROM found WHERE t <> ''),
named AS (
  SELECT url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN t LIKE '//%' THEN scheme || ':' || t
         WHEN t LIKE '/%' THEN site || t WHEN t LIKE '?%' THEN site || page || t WHEN t LIKE '#%' THEN plain || t
         ELSE site || CASE WHEN page LIKE '%/%' THEN regexp_extract(page, '(?s)^(.*/)', 1) ELSE '/' END || t END AS x
  FROM base),
steps AS (
  SELECT url, x, regexp_extract(x, '(?s)^(.*?://[^/?#]*)', 1) AS site, regexp_extract(x, '(?s)^.*?://[^/?#]*[^?#]*(.*)$', 1) AS rest,
         regexp_replace(regexp_extract(x, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/(\.\.?)$', '/\1/') AS path
  FROM named WHERE contains(x, '://')),
links AS (
  SELECT DISTINCT url AS a, CASE WHEN path = '' THEN x ELSE site || array_to_string(list_reduce(
           list_transform(string_split(path, '/'), lambda y: [y]),
           lambda d, y: CASE y[1] WHEN '.' THEN d WHEN '..' THEN d[1:greatest(len(d) - 1, 1)] ELSE d || y END), '/') || rest END AS b
  FROM steps),
urls AS (SELECT DISTINCT url FROM (SELECT url FROM pages UNION ALL SELECT a FROM links UNION ALL SELECT b FROM links) WHERE url IS NOT NULL),
cut AS (
  SELECT url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM urls),
rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                               ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT url, arg_max(r.host || r.path, row(length(r.host) + length(r.path), r.verdict = 'allow')) AS rule,
         arg_max(r.verdict, row(length(r.host) + length(r.path), r.verdict = 'allow')) AS verdict
  FROM cut JOIN rules r ON (cut.host = r.host OR ends_with(cut.host, '.' || r.host)) AND starts_with(cut.path, r.path) GROUP BY url),
known AS (
  SELECT cut.*, rule, verdict, CASE WHEN contains(url, '://') THEN url END AS node
  FROM cut LEFT JOIN best USING (url)),
edge AS (SELECT x.node AS u, y.node AS v FROM links JOIN known x ON a = x.url JOIN known y ON b = y.url),
reach AS (
  SELECT DISTINCT node, node AS other FROM known WHERE node IS NOT NULL
  UNION
  SELECT reach.node, e.v FROM reach JOIN (SELECT u, v FROM edge UNION ALL SELECT v, u FROM edge) e ON reach.other = e.u),
spread AS (
  SELECT reach.node, bool_or(verdict = 'allow') AS any_allow, bool_or(verdict = 'block') AS any_block
  FROM reach JOIN known ON reach.other = known.node AND verdict IS NOT NULL GROUP BY reach.node)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN verdict IS NOT NULL THEN verdict WHEN any_block AND NOT any_allow THEN 'block' ELSE 'allow' END AS verdict
FROM pages LEFT JOIN known USING (url) LEFT JOIN spread USING (node)
""",
    "op9_line_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT rid) >= 5),
j AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keeper AS gone FROM k LEFT JOIN c USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid
""",
    "op11_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL HAVING sum(docs) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
kc AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS all_n
       FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM kc GROUP BY ALL),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (t.total + 5 * v) AS p, 1 + (1000000000 * (all_n + 5)) // (v.total + 5 * v) AS q
      FROM kc JOIN t USING (lang, source) JOIN v USING (lang)),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
lists AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM lists)
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
""",
}
#: An attribute of an HTML tag, as the URL filter reads it.
_ATTR = r"""trim(replace(regexp_extract(tag, '(?is)\s{0}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1)
    || regexp_extract(tag, '(?is)\s{0}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2)
    || regexp_extract(tag, '(?is)\s{0}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3), '&amp;', '&'))"""
for _name in ("rel", "http-equiv", "href", "content"):
    SQL["op8_url_filter"] = SQL["op8_url_filter"].replace(f"_ATTR({_name})", _ATTR.replace("{0}", _name))

QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_mix_sources, op2_simhash_dedup, op3_fingerprints, op4_warc, op5_decontamination, op6_language_model,
    op7_token_counts, op8_url_filter, op9_line_dedup, op10_quality,
    op11_source_divergence, op12_whitening, op13_toxicity)}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return {k: v.strip() for k, v in SQL.items()}
