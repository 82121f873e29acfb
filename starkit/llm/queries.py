"""Queries of the corpus operators and their SQL.

Every query applies its operator, with production parameters, to its whole
table and derives the digest columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.llm import byte_bpe, exact_dedup, html_extract, lexical_search, lm_scoring, merkle, minhash_dedup, packing, quality_rules, substring_dedup, toxicity, url_filters, warc
from starkit.plans.tables import Tables

#: host, path, verdict of the rules of op1 (fixed values)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(Tables(spark, sf_dir).read("pages"), rules)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(Tables(spark, sf_dir).read("pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(Tables(spark, sf_dir).read("documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(Tables(spark, sf_dir).read("documents"), byte_bpe.rank_file(tokenizer("byte_bpe_50k.tiktoken")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(Tables(spark, sf_dir).read("documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(Tables(spark, sf_dir).read("documents"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_dedup(Tables(spark, sf_dir).read("documents"), shingle=2)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(Tables(spark, sf_dir).read("documents"), tokenizer("byte_bpe_50k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    return toxicity.score(tables.read("documents"), tables.read("labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(Tables(spark, sf_dir).read("documents")).withColumns(
        {c: F.round(c, 9) for c in ("char_distance", "word_distance")})


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.coalesce(F.crc32(F.encode(F.col("__row.doc_id").cast("string"), "utf-8")) % 7 == 0, F.lit(False))
    n_chars = F.col("__row.n_chars")
    return merkle.manifest(Tables(spark, sf_dir).read("documents"), tampered={"n_chars": F.when(chosen, n_chars + 1).otherwise(n_chars)})


def op12_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archived(Tables(spark, sf_dir).read("pages"), "page_id", "url", "html", date="2026-01-01T00:00:00Z")
    return out.select(F.col("id").cast("long").alias("page_id"), F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                      "record_type", F.col("refers_to_id").cast("long").alias("refers_to"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    return lexical_search.search(tables.read("documents"), tables.read("benchmark"), k=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filters, op2_html_extraction, op3_exact_dedup, op4_byte_bpe, op5_substring_dedup,
                            op6_lm_scoring, op7_minhash_dedup, op8_best_fit_packing, op9_toxicity, op10_quality_rules, op11_merkle_manifest, op12_warc_revisits,
                            op13_lexical_search)}

#: DuckDB SQL for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op1_url_filters": r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM parts
), rules(rhost, rpath, rverdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'allow'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
)
SELECT page_id, host, path,
       (SELECT rhost || rpath FROM rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
        ORDER BY length(rhost || rpath) DESC LIMIT 1) AS rule,
       coalesce((SELECT rverdict FROM rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
        ORDER BY length(rhost || rpath) DESC LIMIT 1), 'allow') AS verdict
FROM split
""",
    "op3_exact_dedup": r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM norm WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST)
""",
    "op5_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), starts AS (
  SELECT doc_id, p, md5(array_to_string(ws[p : p + 34], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS p FROM w)
), twice AS (SELECT h FROM starts GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT doc_id, list(DISTINCT q) AS qs
  FROM (SELECT doc_id, unnest(range(p, p + 35)) AS q FROM starts SEMI JOIN twice USING (h)) GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, len(ws) AS n, coalesce(len(qs), 0) AS r,
         list_filter(ws, lambda x, i: NOT list_contains(coalesce(qs, []), i)) AS k
  FROM w LEFT JOIN gone ON w.doc_id IS NOT DISTINCT FROM gone.doc_id
)
SELECT doc_id, n::BIGINT AS n_words, r::BIGINT AS n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
""",
    "op7_minhash_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN ws
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS s FROM w
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, least(doc_id, coalesce(m, doc_id)) = doc_id AS kept
FROM sets LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) ON a = doc_id
""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
), fields AS (
  SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n, n_chars,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS front,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS back,
         coalesce(xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0, false) AS tampered
  FROM documents, crc_table
), leaves AS (
  SELECT *, sha256(front || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || back) AS leaf,
         sha256(front || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || back) AS other
  FROM fields
), low(lang, level, pos, n, h) AS (
  SELECT lang, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY lang, level, pos // 2, n
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1
), high(level, pos, n, h) AS (
  SELECT 0, pos, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // 2, n
), up(lang, start, level, pos, n, h, proof) AS (
  SELECT lang, pos, 0, pos, n, CASE WHEN tampered THEN other ELSE leaf END, '' FROM leaves
  UNION ALL
  SELECT up.lang, start, up.level + 1, up.pos // 2, (up.n + 1) // 2,
         sha256(CASE WHEN up.pos % 2 = 0 THEN up.h || coalesce(low.h, '') ELSE low.h || up.h END), proof || coalesce(low.h, '')
  FROM up LEFT JOIN low ON up.lang IS NOT DISTINCT FROM low.lang AND up.level = low.level AND xor(up.pos, 1) = low.pos
  WHERE up.n > 1
), over(lang, start, level, pos, n, h, proof) AS (
  SELECT up.lang, start, 0, subroots.pos, subroots.n, up.h, proof FROM up JOIN subroots ON up.lang IS NOT DISTINCT FROM subroots.lang WHERE up.n = 1
  UNION ALL
  SELECT over.lang, start, over.level + 1, over.pos // 2, (over.n + 1) // 2,
         sha256(CASE WHEN over.pos % 2 = 0 THEN over.h || coalesce(high.h, '') ELSE high.h || over.h END), proof || coalesce(high.h, '')
  FROM over LEFT JOIN high ON over.level = high.level AND xor(over.pos, 1) = high.pos
  WHERE over.n > 1
)
SELECT leaves.doc_id, leaf, subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(proof) AS proof_sha256, over.h AS folded_root,
       over.h = (SELECT h FROM high WHERE n = 1) AS verified
FROM leaves JOIN over ON leaves.lang IS NOT DISTINCT FROM over.lang AND leaves.pos = over.start AND over.n = 1
JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang
""",
    "op12_warc_revisits": r"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, coalesce(html, '') AS html, unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits FROM pages
), ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS first_id FROM hashed WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST)
)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_reduce([0] || range(5),
         lambda v, i: 2 * v + (substr(bits, 5 * k + i + 1, 1) = '1')::INT), 1)), '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN first_id END AS refers_to
FROM ranked
""",
    "op13_lexical_search": r"""
WITH found AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), lengths AS (SELECT d, doc_id, len(ts) AS n FROM found WHERE len(ts) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
postings AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(ts) AS t FROM found) GROUP BY d, t),
items AS (
  SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t FROM benchmark
), weights AS (
  SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, total GROUP BY t
), scores AS (
  SELECT item_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM items JOIN postings USING (t) JOIN weights USING (t) JOIN lengths USING (d), total GROUP BY item_id, d
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scores JOIN lengths USING (d) WHERE score > 0
QUALIFY rank <= 50
""",
}
