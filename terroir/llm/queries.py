"""The registered queries of this subpackage, on whole tables with production parameters, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm import (
    bpe,
    contamination,
    extraction,
    fingerprints,
    languages,
    prefixes,
    quality,
    ranking,
    records,
    repeats,
    sharding,
    simhash,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op2_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return result.drop("text_hash")


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_report(table(spark, sf_dir, "documents"), length=400)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_text(table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, distance=4)


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return records.token_records(table(spark, sf_dir, "documents"), tokenizer, end_id=2, keep_ids=False).drop("ids")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, keep_ids=False).drop("ids")


#: The contract's rules.
URL_RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels belong to documents; the last number in a page's path names the page's document."""
    pages = table(spark, sf_dir, "pages")
    label = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow")
    labels = table(spark, sf_dir, "labels").select("doc_id", label.alias("label"))
    number = F.regexp_extract("url", r"^[^?#]*/(\d{1,18})[^/\d]*/?(?:[?#]|$)", 1)
    labelled = pages.select("url", number.alias("number")).selectExpr("url", "try_cast(number as bigint) as doc_id")
    return urls.judge(pages, labelled.join(labels, "doc_id"), URL_RULES)


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.rebuilt_trie(table(spark, sf_dir, "conversations")).drop("key", "parent_key")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(ranking.index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=10)


def queries() -> dict[str, Query]:
    # The pipeline's file stands beside the packages and imports them.
    import corpus_pipeline

    return {name: f for name, f in globals().items() if name.startswith("op")} | {"pipeline": corpus_pipeline.run}


#: Thai, Lao, Burmese, Khmer, kana and Han.
DENSE = r"\x{0e00}-\x{0eff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}" \
    r"\x{f900}-\x{faff}\x{20000}-\x{3ffff}"

#: Exact containment of at least four fifths of an item's shingles: of five words, of all its words if they are fewer.
DECONTAMINATION_SQL = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, lower(coalesce(text, '')) AS t FROM documents
  UNION ALL SELECT 'i', item_id, lower(coalesce(text, '')) FROM benchmark
), words AS (
  SELECT side, id, regexp_extract_all(t, '[\p{L}\p{N}_]+') AS w, regexp_matches(t, '[DENSE]') AS has,
         regexp_extract_all(regexp_replace(t, '([DENSE])', ' \1 ', 'g'), '[\p{L}\p{N}_]+') AS u
  FROM texts
), items AS (
  SELECT id, dense, f, least(len(f), 5) AS n
  FROM (SELECT id, len(w) < 5 AND has AS dense, CASE WHEN len(w) < 5 AND has THEN u ELSE w END AS f FROM words WHERE side = 'i')
  WHERE len(f) > 0
), cut AS (
  SELECT 'i' AS side, id, dense, n, f FROM items
  UNION ALL
  SELECT 'd', id, dense, n, CASE WHEN dense THEN u ELSE w END
  FROM words JOIN (SELECT DISTINCT dense, n FROM items) k ON has OR NOT dense WHERE side = 'd'
), shingles AS (
  SELECT DISTINCT side, id, dense, n, unnest(
    list_transform(range(1, len(f) - n + 2), lambda i: array_to_string(f[i:i + n - 1], ' '))) AS s
  FROM cut WHERE len(f) >= n
), sizes AS (
  SELECT id, count(*) AS size FROM shingles WHERE side = 'i' GROUP BY id
), found AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_found
  FROM shingles d JOIN shingles i ON d.s = i.s AND d.n = i.n AND d.dense = i.dense AND d.side = 'd' AND i.side = 'i' GROUP BY 1, 2
)
SELECT doc_id, item_id, size AS n_shingles, n_found, n_found / size AS containment
FROM found JOIN sizes ON id = item_id WHERE n_found * 5 >= size * 4
""".replace("DENSE", DENSE)


#: Every string of 400 bytes is digested; those that occur again are covered, and what is left is joined. Of a character
#: that a removed run cuts, what is left at the run's side isn't in the text.
REPEATS_SQL = """
WITH texts AS (
  SELECT doc_id, encode(coalesce(text, '')) AS bytes, hex(bytes) AS h FROM documents
), strings AS (
  SELECT doc_id, i, md5(array_slice(bytes, i + 1, i + 400)) AS m
  FROM (SELECT doc_id, bytes, unnest(range(0, greatest(length(h) // 2 - 399, 0))) AS i FROM texts)
), repeated AS (
  SELECT m FROM strings GROUP BY m HAVING count(*) > 1
), marked AS (
  SELECT doc_id, i, i > lag(i, 1, -401) OVER (PARTITION BY doc_id ORDER BY i) + 400 AS opens
  FROM strings SEMI JOIN repeated USING (m)
), runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS b
  FROM (SELECT doc_id, i, sum(opens::int) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
  GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, a, b, substr(h, 2 * lag(b, 1, 0) OVER w + 1, 2 * (a - lag(b, 1, 0) OVER w)) AS piece
  FROM runs JOIN texts USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY a)
), cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(piece, '' ORDER BY a) AS head,
         string_agg(regexp_replace(regexp_replace(piece, '^([89AB][0-9A-F])+', ''),
           '([C-F][0-9A-F]|[EF][0-9A-F][89AB][0-9A-F]|F[0-9A-F][89AB][0-9A-F][89AB][0-9A-F])$', ''), '' ORDER BY a) AS whole
  FROM gaps GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::bigint AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256,
       decode(unhex(coalesce(whole, '') || regexp_replace(substr(h, 2 * coalesce(last, 0) + 1), '^([89AB][0-9A-F])+', ''))) AS text
FROM texts LEFT JOIN cut USING (doc_id)
"""


#: Prefixes as digests of their turns' digests; each node is summed over the pairs of a node and one below it.
CONVERSATIONS_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, strlen(coalesce(text, '')) AS size,
         md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, digest, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, size) AS p FROM turns
), bytes AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, conv_id::varchar AS name, range(0, strlen(conv_id::varchar)) AS places
  FROM (SELECT DISTINCT conv_id FROM own)
), heads AS (
  SELECT conv_id, base, list_reduce(list_prepend(4294967295::bigint, list_transform(places, lambda i: ascii(name[i + 1])::bigint)),
    lambda c, b: list_reduce([xor(c, b), 0::bigint, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
      CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::bigint) ELSE x // 2 END)) AS state
  FROM bytes
), convs AS (
  SELECT conv_id, base, xor(state, 4294967295::bigint) % 9 AS h FROM heads
), rebuilt AS (
  SELECT c.conv_id, 0 AS side, p, digest, size FROM convs c JOIN own o ON o.conv_id = c.base AND p <= h
  UNION ALL
  SELECT c.conv_id, 1, p, digest, size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND p > h
), placed AS (
  SELECT conv_id, digest, size, row_number() OVER (PARTITION BY conv_id ORDER BY side, p) AS depth FROM rebuilt
), paths AS (
  SELECT conv_id, depth, size, md5(string_agg(digest, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS path FROM placed
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs
), lengths AS (
  SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id
), nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
         string_agg(CASE WHEN depth = length THEN conv_id END, ',' ORDER BY conv_id) AS ends,
         bool_and(depth = length) AS childless
  FROM paths JOIN lengths USING (conv_id) GROUP BY depth, path
), pairs AS (
  SELECT DISTINCT a.depth, a.path, b.depth AS lower_depth, b.path AS lower_path
  FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), below AS (
  SELECT p.depth, p.path, count(*) FILTER (lower_depth = p.depth + 1) AS n_children,
         count(*) FILTER (childless) AS n_leaves, sum((n_convs - 1) * size)::bigint AS saved_tokens
  FROM pairs p JOIN nodes n ON n.depth = lower_depth AND n.path = lower_path GROUP BY p.depth, p.path
), parents AS (
  SELECT DISTINCT lower_depth AS depth, lower_path AS path, n.conv_id AS parent_conv_id
  FROM pairs p JOIN nodes n ON n.depth = p.depth AND n.path = p.path WHERE lower_depth = p.depth + 1
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM nodes JOIN below USING (depth, path) LEFT JOIN parents USING (depth, path)
"""


#: Every document that shares a term with an item is scored.
RANKING_SQL = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS nr, text FROM documents
  UNION ALL SELECT 'i', item_id, 0, text FROM benchmark
), words AS (
  SELECT side, id, nr, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
), counted AS (
  SELECT id AS doc_id, nr, term, count(*) AS tf FROM words WHERE side = 'd' GROUP BY ALL
), lengths AS (
  SELECT nr, sum(tf)::bigint AS n FROM counted GROUP BY nr
), corpus AS (
  SELECT count(*) AS docs, sum(n)::bigint AS terms FROM lengths
), frequencies AS (
  SELECT term, count(*) AS df FROM counted GROUP BY term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint AS w FROM frequencies, corpus
), impacts AS (
  SELECT doc_id, nr, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))) AS impact
  FROM counted JOIN lengths USING (nr) JOIN weights USING (term), corpus
), items AS (
  SELECT DISTINCT id AS item_id, term FROM words WHERE side = 'i'
), scored AS (
  SELECT item_id, doc_id, nr, sum(impact)::bigint AS score FROM items JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, nr)::int AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_suffix_repeats": REPEATS_SQL,
        "op5_decontamination": DECONTAMINATION_SQL,
        "op12_prefix_trie": CONVERSATIONS_SQL,
        "op13_ranked_search": RANKING_SQL,
    }
