"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partysieve.llm import (
    bbit_dedup,
    bit_slices,
    block_lstm,
    bpe_matrix,
    fingerprints,
    host_reputation,
    mixture,
    quality_trees,
    seed_extend,
    simhash_ring,
    suffix_dedup,
    token_counts,
    zfast_trie,
)
from partysieve.sources.stages import StageArea

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Statements for DuckDB; queries without one are tested against brute force.
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what the sparse suffix array removes of repeats of 50 words or more."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op9_seed_extend_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what seeds and their extension remove of repeats of 50 words or more."""
    return seed_extend.dedup(table(spark, sf_dir, "documents"))


_REPEATS = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM split WHERE len(w) >= 50)),
hits AS (
  SELECT doc_id, i FROM windows JOIN (SELECT h, min(doc_id) AS lead FROM windows GROUP BY h) USING (h)
  WHERE lead < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM hits),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM split),
marked AS (
  SELECT doc_id, word, j, gone.j IS NOT NULL AS out,
         coalesce(lag(gone.j) OVER (PARTITION BY doc_id ORDER BY j) IS NOT NULL, false) AS before
  FROM words LEFT JOIN gone USING (doc_id, j))
SELECT split.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_repeats, 0) AS BIGINT) AS n_repeats,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN (
  SELECT doc_id, count_if(out) AS n_removed, count_if(out AND NOT before) AS n_repeats,
         string_agg(word, ' ' ORDER BY j) FILTER (NOT out) AS kept
  FROM marked GROUP BY doc_id) USING (doc_id)
"""
SQL["op3_suffix_array_dedup"] = SQL["op9_seed_extend_dedup"] = _REPEATS


@query
def op5_bbit_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by 85 of 100 shingles or more."""
    return bbit_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


SQL["op5_bbit_minhash_dedup"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM split WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM grams AS x JOIN grams AS y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN sizes AS s ON s.doc_id = x.doc_id JOIN sizes AS t ON t.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, s.n, t.n HAVING 100 * count(*) >= 85 * (s.n + t.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)
"""


@query
def op7_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes of each document."""
    return mixture.taken(table(spark, sf_dir, "documents"), weights=(5, 2, 1), percent=150, epochs=2)


SQL["op7_source_mixture"] = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM docs GROUP BY source),
filled AS (
  SELECT *, ((SELECT sum(size) FROM docs) * 1.5::DOUBLE
             - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
aims AS (
  SELECT source, source_size, CASE WHEN level >= 2 * source_size / weight THEN CAST(2 * source_size AS DOUBLE)
         ELSE weight * max(CASE WHEN level < 2 * source_size / weight THEN level END) OVER () END AS target
  FROM filled),
stream AS (
  SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY epoch, md5(doc_id || ':' || epoch), doc_id
                                               ROWS UNBOUNDED PRECEDING) - size AS place
  FROM docs, (VALUES (0), (1)) AS e(epoch)),
blocks AS (
  SELECT source, CAST(floor(target) AS BIGINT) AS quota, (CAST(floor(target) AS BIGINT) + 1023) // 1024 AS n,
         CAST(sum((CAST(floor(target) AS BIGINT) + 1023) // 1024) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS high
  FROM aims),
points AS (
  SELECT t, total, least(total - 1, CAST(floor(CAST(CAST(t AS DECIMAL(19, 0)) * CAST('0.618033988749894848' AS DECIMAL(18, 18)) % 1 AS DOUBLE) * total) AS BIGINT)) AS place
  FROM (SELECT CAST(sum(n) AS BIGINT) AS total FROM blocks), unnest(range(total)) AS u(t)),
drawn AS (
  SELECT source, n, t, row_number() OVER (PARTITION BY source ORDER BY t) - 1 AS rank FROM points JOIN blocks ON place >= high - n AND place < high),
slots AS (
  SELECT source, t AS slot, rank FROM drawn WHERE rank < n
  UNION ALL
  SELECT source, (SELECT sum(n) FROM blocks) + high - n + r AS slot, r AS rank FROM blocks, unnest(range(n)) AS u(r)
  WHERE r >= (SELECT count(*) FROM drawn WHERE drawn.source IS NOT DISTINCT FROM blocks.source)),
cut AS (
  SELECT doc_id, size, stream.source, place, least(place + size, quota) AS till FROM stream JOIN blocks ON stream.source IS NOT DISTINCT FROM blocks.source),
taken AS (SELECT doc_id, size, source, CAST(sum(greatest(0, till - place)) AS BIGINT) AS taken FROM cut GROUP BY ALL),
firsts AS (
  SELECT doc_id, CAST(min(slot) AS BIGINT) AS first_slot
  FROM cut JOIN slots ON cut.source IS NOT DISTINCT FROM slots.source AND place < till AND rank BETWEEN place // 1024 AND (till - 1) // 1024
  GROUP BY doc_id)
SELECT doc_id, size, source_size, target, taken, first_slot
FROM taken JOIN aims ON taken.source IS NOT DISTINCT FROM aims.source LEFT JOIN firsts USING (doc_id)
"""


@query
def op1_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document and the verdict of the base rule and the boosted trees."""
    documents = table(spark, sf_dir, "documents")
    trees = quality_trees.train(documents, table(spark, sf_dir, "labels"))
    return quality_trees.judge(documents.select("doc_id", "text"), trees).drop("text", "score")


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.PATTERN, limit=512)


@query
def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of what they decode to."""
    return bpe_matrix.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN)


@query
def op6_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its text edited with the next document's."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))


@query
def op10_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each page by the rules, or by its host's reputation.

    The number at the end of a path is the document that the page shows; its labels are the page's outcome.
    """
    pages = table(spark, sf_dir, "pages")
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad")
    labels = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").groupBy("doc_id").agg(bad)
    shown = pages.select("url", F.expr(r"try_cast(regexp_extract(url, '^[^?#]*/([0-9]{1,18})(/|[.]html)?([?#]|$)', 1) AS BIGINT)").alias("doc_id"))
    return host_reputation.judge(pages, URL_RULES, labelled=shown.join(labels, "doc_id").select("url", "bad"))


SQL["op10_host_reputation"] = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(kind, rule) AS (VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'),
                             ('block', 'net/es/'), ('block', 'net/fr/')),
ruled AS (
  SELECT page_id, host, path, max_by(rule, len(rule)) AS rule, max_by(kind, len(rule)) AS kind
  FROM (SELECT DISTINCT page_id, host, path FROM split) LEFT JOIN rules
    ON ('.' || host) LIKE ('%.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, instr(rule, '/')))
  GROUP BY page_id, host, path),
outcomes AS (
  SELECT host, bad FROM split LEFT JOIN (
    SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id)
    ON doc_id = try_cast(regexp_extract(url, '^[^?#]*/([0-9]{1,18})(/|[.]html)?([?#]|$)', 1) AS BIGINT)),
hosts AS (
  SELECT host, regexp_replace(host, ':[0-9]*$', '') AS name, count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM outcomes GROUP BY host),
named AS (
  SELECT *, string_split(name, '.') AS l, regexp_full_match(name, '[0-9.]+') AS numeric,
         coalesce(len(l) > 2 AND len(l[-1]) = 2 AND l[-2] IN ('ac', 'co', 'com', 'edu', 'gob', 'gov', 'net', 'org'), false) AS two
  FROM hosts),
placed AS (
  SELECT host, n, bad,
         CASE WHEN numeric THEN name ELSE array_to_string(l[-(CASE WHEN two THEN 3 ELSE 2 END):], '.') END AS domain,
         CASE WHEN numeric THEN '' WHEN two THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix FROM named),
overall AS (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) AS mean, mean * (1 - mean) / (sum(n) + 2) AS variance FROM placed),
s1 AS (SELECT suffix, p.n, p.bad, mean, variance
       FROM (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM placed GROUP BY suffix) AS p, overall),
m1 AS (SELECT 1 / least(greatest(coalesce(sum(n * (bad / n - mean) ** 2 / (mean * (1 - mean)) - 1) / nullif(sum(n - 1), 0), 0.5), 0.02), 0.9) - 1 AS m
       FROM s1 WHERE n > 0 AND mean > 0 AND mean < 1),
p1 AS (SELECT suffix, (mean * m + bad) / (n + m) AS q, q * (1 - q) / (n + m + 1) + (m / (n + m)) ** 2 * variance AS v FROM s1, m1),
s2 AS (SELECT domain, sum(n) AS n, sum(bad) AS bad, any_value(q) AS mean, any_value(v) AS variance
       FROM placed JOIN p1 USING (suffix) GROUP BY domain),
m2 AS (SELECT 1 / least(greatest(coalesce(sum(n * (bad / n - mean) ** 2 / (mean * (1 - mean)) - 1) / nullif(sum(n - 1), 0), 0.5), 0.02), 0.9) - 1 AS m
       FROM s2 WHERE n > 0 AND mean > 0 AND mean < 1),
p2 AS (SELECT domain, (mean * m + bad) / (n + m) AS q, q * (1 - q) / (n + m + 1) + (m / (n + m)) ** 2 * variance AS v FROM s2, m2),
s3 AS (SELECT host, n, bad, q AS mean, v AS variance FROM placed JOIN p2 USING (domain)),
m3 AS (SELECT 1 / least(greatest(coalesce(sum(n * (bad / n - mean) ** 2 / (mean * (1 - mean)) - 1) / nullif(sum(n - 1), 0), 0.5), 0.02), 0.9) - 1 AS m
       FROM s3 WHERE n > 0 AND mean > 0 AND mean < 1),
judged AS (SELECT host, (mean * m + bad) / (n + m) AS q, q * (1 - q) / (n + m + 1) + (m / (n + m)) ** 2 * variance AS v FROM s3, m3)
SELECT page_id, host, path, rule,
       coalesce(kind, CASE WHEN q - 1.645 * sqrt(v) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(round(q * 1000000) AS BIGINT) AS mean_ppm, CAST(round((q - 1.645 * sqrt(v)) * 1000000) AS BIGINT) AS bound_ppm
FROM split JOIN ruled USING (page_id, host, path) JOIN judged USING (host)
"""


@query
def op2_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    pages = table(spark, sf_dir, "pages")
    return block_lstm.extract(pages, block_lstm.train(pages))


@query
def op11_simhash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose SimHash fingerprints differ in three bits or fewer."""
    return simhash_ring.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    documents, stages = table(spark, sf_dir, "documents"), StageArea(spark)
    return bit_slices.search(bit_slices.build(documents, stages), documents, table(spark, sf_dir, "benchmark"), stages, k=20)


SQL["op12_bit_sliced_search"] = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
sized AS (SELECT doc_id, t, CAST(len(t) AS BIGINT) AS n FROM split WHERE len(t) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
occurs AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM sized) GROUP BY ALL),
weighed AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM occurs GROUP BY term), totals),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms)))) AS score
  FROM asked JOIN weighed USING (term) JOIN occurs USING (term), totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""


@query
def op13_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefixes that rebuilt conversations share."""
    return zfast_trie.prefix_trie(table(spark, sf_dir, "conversations"))


SQL["op13_zfast_trie"] = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS turn,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || md5(coalesce(text, '')))) AS pos
  FROM conversations AS t WHERE conv_id IS NOT NULL),
crc AS (
  SELECT c, CAST(c AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM (SELECT DISTINCT c FROM turns)
  UNION ALL
  SELECT c, s, i + 1, xor(x >> 1, CASE WHEN x % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)
  FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(substr(s, i // 8 + 1, 1))) ELSE v END AS x FROM crc WHERE i < 8 * len(s))),
convs AS (
  SELECT c, xor(v, 4294967295) % 4 AS h, c - c % 20 AS donor, (SELECT count(*) FROM turns AS t WHERE t.c = crc.c - crc.c % 20) AS n
  FROM crc WHERE i = 8 * len(s)),
rebuilt AS (
  SELECT convs.c, pos AS d, turn, words FROM convs JOIN turns ON turns.c = donor AND pos <= h
  UNION ALL SELECT c, pos - h + least(h, n), turn, words FROM convs JOIN turns USING (c) WHERE pos > h),
keyed AS (
  SELECT c, d, words, md5(string_agg(turn, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
paths AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS ends FROM keyed),
nodes AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words, max(up) AS up,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
grown AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (d, k)),
below AS (SELECT DISTINCT a.d, a.k, b.d AS bd, b.k AS bk FROM paths AS a JOIN paths AS b ON a.c = b.c AND b.d >= a.d),
sums AS (
  SELECT below.d, below.k, count_if(n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM below JOIN grown ON grown.d = bd AND grown.k = bk GROUP BY below.d, below.k)
SELECT g.conv_id, CAST(g.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(g.n_convs AS BIGINT) AS n_convs,
       CAST(g.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, g.ends_sha256
FROM grown AS g JOIN sums USING (d, k) LEFT JOIN nodes AS p ON p.d = g.d - 1 AND p.k = g.up
"""
