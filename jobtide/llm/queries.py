"""The registered queries of this package: each operator over its whole tables.

``QUERIES`` are the queries, ``SQL`` the DuckDB text for those that SQL can express.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import (
    bpe,
    chat,
    decontamination,
    jaccard,
    langid,
    pii,
    quality,
    topk,
    trie,
    urls,
    viterbi,
    warc,
    whitening,
)
from jobtide.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


@query(
    r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_start AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS i
  FROM item WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS t FROM item_start
), doc_start AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc
), doc_win AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS t
  FROM doc_start, (SELECT DISTINCT n FROM win) lengths WHERE i + n - 1 <= len(w)
), hit AS (
  SELECT d.doc_id, d.i, d.n, b.item_id FROM doc_win d JOIN win b ON d.t = b.t AND d.n = b.n
), hit_word AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) x GROUP BY doc_id
), hit_item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) x GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_word USING (doc_id) LEFT JOIN hit_item USING (doc_id)"""
)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("text_hash")


@query(
    """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.n <> c.n WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
)
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query()
def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = pii.pseudonymized(table(spark, sf_dir, "documents"), pii.session_key(spark))
    return changed.select("doc_id", "text", "n_entities", "kinds")


@query()
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query(
    """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
    sha256(h) AS payload_digest FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)"""
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


@query(
    r"""
WITH rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*(\??[^#]*)', 1), '') AS query
  FROM pages
), fit AS (
  SELECT host, path, rules.h || rules.p AS rule, verdict,
    row_number() OVER (PARTITION BY host, path
      ORDER BY length(rules.h || rules.p) DESC, verdict, rules.h || rules.p) AS n
  FROM (SELECT DISTINCT host, path FROM parts) x JOIN rules
    ON (host = rules.h OR ends_with(host, '.' || rules.h)) AND starts_with(path, rules.p)
)
SELECT page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fit ON parts.host = fit.host AND parts.path = fit.path AND n = 1"""
)
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pages of the test tables name no other address of themselves, so the SQL has no
    # aliases; tests/llm checks those on small graphs.
    return urls.judge(table(spark, sf_dir, "pages"))


@query(
    r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^ 	-
]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0
), sh AS (
  SELECT DISTINCT doc_id, w[i : i + 3] AS s FROM starts
), size AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM sh a JOIN sh b ON a.s = b.s WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM common JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
  WHERE 100 * k >= 85 * (a.n + b.n - k)
), reach AS (
  SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), low AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
  least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN low ON low.x = d.doc_id"""
)
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents")).drop("text_hash")


@query()
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.token_counts(table(spark, sf_dir, "documents"))


@query(
    """
WITH RECURSIVE crc AS (
  SELECT conv_id, CAST(xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 9 AS INTEGER) AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL) c
), said AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x,
    sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'id': id, 'b': strlen(x)} ORDER BY turn NULLS FIRST, r, id) AS t
  FROM said GROUP BY conv_id
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.t, [])[1:h], o.t[h + 1:]) AS t
  FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), step AS (
  SELECT conv_id, t, d, sha256(array_to_string(list_transform(t[1:d], lambda e: e.id), '')) AS node,
    CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(t[1:d - 1], lambda e: e.id), '')) END AS up
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt) x
), node AS (
  SELECT node, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n,
    CASE WHEN any_value(d) > 0 THEN (count(*) - 1) * any_value(t[d].b) ELSE 0 END AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(t) = d), '')) AS ends
  FROM step GROUP BY node
), kids AS (
  SELECT up AS node, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up
), above AS (
  SELECT node AS top, node, up, saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf
  FROM node LEFT JOIN kids USING (node)
  UNION ALL
  SELECT n.node, a.node, n.up, a.saved, a.leaf FROM above a JOIN node n ON n.node = a.up
), sums AS (
  SELECT top AS node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY top
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs,
  coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM node n LEFT JOIN node p ON p.node = n.up LEFT JOIN kids k ON k.node = n.node
  JOIN sums s ON s.node = n.node"""
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), 5, 9)


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


_CONTROL = r"\### Assistant: </turn> ok"


@query(
    rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT * FROM (
    VALUES (-7, 0, 'user', '{_CONTROL}'), (-7, 1, 'assistant', '{_CONTROL}')) v
), piece AS (
  SELECT conv_id, r, x, 14 +
    length(replace(replace(replace(replace(r, '&', '&amp;'), '</', '&lt;/'), '##', '&num;&num;'), ':', '&colon;')) +
    length(replace(replace(replace(x, '&', '&amp;'), '</', '&lt;/'), '##', '&num;&num;')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM rows
), held AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS total
  FROM piece
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY i) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(total) FILTER (r = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM held GROUP BY conv_id"""
)
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [(-7, 0, "user", _CONTROL), (-7, 1, "assistant", _CONTROL)]
    own = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(*chat.examples(turns.unionByName(own)))
