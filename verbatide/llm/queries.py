"""The operators over whole tables, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import functions as F

from verbatide.llm import language_id
from verbatide.llm.bpe_codec import encode_texts
from verbatide.llm.centroids import cluster_report, cluster_vectors
from verbatide.llm.common import crc_mod
from verbatide.llm.decontaminate import find_leaks
from verbatide.llm.fingerprint import fingerprints_with_edits
from verbatide.llm.lexical_search import search
from verbatide.llm.line_dedup import dedup_lines
from verbatide.llm.lm_score import score_texts
from verbatide.llm.ngram_jaccard import link_classes
from verbatide.llm.sharding import shard_texts
from verbatide.llm.suffix_dedup import remove_repeats
from verbatide.llm.token_counts import count_tokens
from verbatide.llm.url_filter import filter_urls
from workload.tables import Query, table

URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def _vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_ngram_jaccard(spark, d):
    return link_classes(table(spark, d, "documents", "doc_id", "text"), 3, Fraction(9, 10))


WORDS_SQL = """list_filter(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"""

OP1_SQL = f"""
WITH RECURSIVE cut AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
                          ELSE list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) END) AS s
    FROM cut)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY x, y),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 90 * (p.n + q.n - k)),
reach(x, y) AS (SELECT doc_id, doc_id FROM cut UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(y) FROM reach r WHERE r.x = c.doc_id) AS component_id
FROM cut c LEFT JOIN sizes USING (doc_id)"""


def op2_suffix_dedup(spark, d):
    return remove_repeats(table(spark, d, "documents", "doc_id", "text"), 400, keep_bytes=False)


def op3_language_id(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text", "lang")
    model = language_id.fit(docs.where(crc_mod(F.col("doc_id"), 5) != 0))
    named = language_id.identify(docs, model)
    return named.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op4_url_filter(spark, d):
    judged = filter_urls(table(spark, d, "pages", "page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _rule_rows() -> str:
    rows = []
    for verdict, rule in URL_RULES:
        host, slash, path = rule.partition("/")
        rows.append(f"('{host}', '{slash}{path}', '{verdict}')")
    return ", ".join(rows)


OP4_SQL = f"""
WITH cut AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(h, p, verdict) AS (VALUES {_rule_rows()}),
fits AS (
  SELECT page_id, h || p AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, length(h) DESC, verdict DESC) AS r
  FROM cut JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT c.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM cut c LEFT JOIN (SELECT * FROM fits WHERE r = 1) f USING (page_id)"""


def op5_token_counts(spark, d):
    return count_tokens(table(spark, d, "documents", "doc_id", "text"), _vocabulary(), 2048)


def op6_fingerprint(spark, d):
    return fingerprints_with_edits(table(spark, d, "documents", "doc_id", "text"))


def op7_lm_score(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text")
    scored = score_texts(docs, crc_mod(F.col("doc_id"), 7) != 2)
    held = (crc_mod(F.col("doc_id"), 7) == 2).alias("held_out")
    return scored.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_decontaminate(spark, d):
    docs, items = table(spark, d, "documents", "doc_id", "text"), table(spark, d, "benchmark", "item_id", "text")
    return find_leaks(docs, items)


OP8_SQL = f"""
WITH docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
items AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs),
iw AS (SELECT item_id, len(w) AS m, unnest(w) AS word, unnest(range(len(w))) AS j FROM items),
equal AS (SELECT doc_id, item_id, m, p - j AS start, j FROM dw JOIN iw USING (word)),
many AS (
  SELECT doc_id, item_id, m, start, list(j) AS js FROM equal GROUP BY ALL HAVING count(*) * 5 >= least(13, m) * 4),
begins AS (
  SELECT k.doc_id, item_id, m, start, js, unnest(range(greatest(0, -start), least(m, len(d.w) - start) - least(13, m) + 1)) AS b
  FROM many k JOIN docs d ON d.doc_id = k.doc_id),
counted AS (
  SELECT doc_id, item_id, least(13, m)::INT AS n_window, (start + b)::INT AS first_word,
         len(list_filter(js, lambda x: x >= b AND x < b + least(13, m)))::INT AS n_equal
  FROM begins),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, n_window DESC, first_word) AS r
  FROM counted WHERE n_equal * 5 >= n_window * 4 AND (m >= 8 OR n_equal = m))
SELECT doc_id, item_id, n_equal, n_window, first_word FROM ranked WHERE r = 1"""


def op9_line_dedup(spark, d):
    cut = dedup_lines(table(spark, d, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def op10_bpe_codec(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text")
    coded = encode_texts(docs, _vocabulary(), digests=True)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_lexical_search(spark, d):
    return search(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "benchmark", "item_id", "text"), 20)


TERMS_SQL = """regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP11_SQL = f"""
WITH dt AS (SELECT doc_id, unnest({TERMS_SQL}) AS term FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY doc_id, term),
weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total GROUP BY term, docs),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark)
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN n USING (doc_id), total
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scored WHERE score > 0)
SELECT item_id, r::INT AS rank, doc_id, score FROM ranked WHERE r <= 20"""


def op12_centroid_clustering(spark, d):
    vectors = table(spark, d, "embeddings", "vec_id", "embedding")
    return cluster_report(*cluster_vectors(vectors, clusters=16, rounds=3, scale=64, components=64, seed=1))


def _cluster_sql(rounds: int) -> str:
    """The rounds written out; components are rows, so that each step is a grouped sum."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS (
  SELECT vec_id, cluster, distance FROM (
    SELECT vec_id, cluster, sum((x - c) * (x - c))::BIGINT AS distance,
           row_number() OVER (PARTITION BY vec_id ORDER BY sum((x - c) * (x - c)), cluster) AS r
    FROM parts JOIN c{r} USING (i) GROUP BY vec_id, cluster)
  WHERE r = 1)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS (
  SELECT cluster, i, coalesce((s - ((s % n) + n) % n) // n, c) AS c
  FROM c{r} LEFT JOIN (
    SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM near{r} JOIN parts USING (vec_id) GROUP BY cluster, i) USING (cluster, i))""")
    return ",".join(steps)


OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS (SELECT vec_id, unnest(range(64)) AS i, unnest(v) AS x FROM kept),
begin AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM kept),
c0 AS (SELECT cluster, i, x AS c FROM begin JOIN parts USING (vec_id) WHERE cluster < 16),{_cluster_sql(3)},
facts AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM near3 GROUP BY cluster),
digests AS (SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY cluster)
SELECT vec_id, cluster::INT AS cluster, distance, cluster_inertia,
       (SELECT sum(distance)::BIGINT FROM near3) AS inertia, centroid_sha256
FROM near3 JOIN facts USING (cluster) JOIN digests USING (cluster)"""


def op13_sharding(spark, d):
    placed = shard_texts(table(spark, d, "documents"), 40, "rows")
    crc = F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    return placed.select("doc_id", "size", crc, F.lit("rows").alias("law"), "shard", "slot", "grown_shard")


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": Query(op1_ngram_jaccard, OP1_SQL),
    "op2_suffix_dedup": Query(op2_suffix_dedup),
    "op3_language_id": Query(op3_language_id),
    "op4_url_filter": Query(op4_url_filter, OP4_SQL),
    "op5_token_counts": Query(op5_token_counts),
    "op6_fingerprint": Query(op6_fingerprint),
    "op7_lm_score": Query(op7_lm_score),
    "op8_decontaminate": Query(op8_decontaminate, OP8_SQL),
    "op9_line_dedup": Query(op9_line_dedup, OP9_SQL),
    "op10_bpe_codec": Query(op10_bpe_codec),
    "op11_lexical_search": Query(op11_lexical_search, OP11_SQL),
    "op12_centroid_clustering": Query(op12_centroid_clustering, OP12_SQL),
    "op13_sharding": Query(op13_sharding),
}
