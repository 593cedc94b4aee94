"""Registered queries of the operators, each over its whole table, with DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.llm import centroids, fm_index, langid, lm, minhash, mixing, ngram_join, packing, prefix_trie, repeats, topk, url_filter, warc
from keyfold.llm.common import table, workers_find_package

VOCABULARY = "word_bpe_49k.json"

URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
    ("block", "example.org/en/1"),
]


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, mod n."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.roundtrip(table(spark, sf_dir, "pages"))
    return read.select(
        warc.page_number("record_id").alias("page_id"),
        F.when(F.col("record_type") == "response", F.length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        warc.page_number("refers_to").alias("refers_to"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), held_out=F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.with_followers(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    model = langid.train(docs, learn=~held_out)
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _ready(q) for name, q in {
    "op1_warc": op1_warc,
    "op2_url_filter": op2_url_filter,
    "op3_lm": op3_lm,
    "op4_minhash": op4_minhash,
    "op5_packing": op5_packing,
    "op6_ngram_join": op6_ngram_join,
    "op7_mixing": op7_mixing,
    "op8_topk": op8_topk,
    "op9_langid": op9_langid,
    "op10_repeats": op10_repeats,
    "op11_centroids": op11_centroids,
    "op12_fm_index": op12_fm_index,
    "op13_prefix_trie": op13_prefix_trie,
}.items()}


def _rounds_sql(rounds: int, width: int) -> str:
    """Each round's assignment and centroids, one after another."""
    far = "list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    out = []
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (
          SELECT vec_id, q, arg_min(num, (d, num)) AS num, min(d) AS d
          FROM (SELECT v.vec_id, v.q, c.num, {far} AS d FROM v, c{i} c) GROUP BY vec_id, q)""")
        if i < rounds:
            mean = f"list_transform(range(1, {width + 1}), lambda j: (ss[j] - ((ss[j] % n + n) % n)) // n)"
            out.append(f"""c{i + 1} AS MATERIALIZED (
          SELECT c.num, CASE WHEN n IS NULL THEN c.q ELSE {mean} END AS q FROM c{i} c LEFT JOIN (
            SELECT num, any_value(n) AS n, list(s ORDER BY j) AS ss FROM (
              SELECT num, j, sum(x)::BIGINT AS s, count(*) AS n FROM (
                SELECT num, unnest(q) AS x, unnest(range(1, {width + 1})) AS j FROM a{i}) GROUP BY num, j) GROUP BY num) m ON m.num = c.num)""")
    return ",\n        ".join(out)


#: CRC-32 of a number's decimal text, bit by bit (-1: shift).
_CRC32 = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(c::VARCHAR, ''),
            lambda ch: list_concat([ascii(ch)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))),
            lambda h, e: CASE WHEN e >= 0 THEN xor(h, e) ELSE xor(h >> 1, (h & 1) * 3988292384) END), 4294967295)"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE = {
    "op1_warc": f"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS h,
                     max(page_id) OVER (PARTITION BY sha1(payload)) AS top FROM p)
        SELECT page_id, payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('{_BASE32}',
                   1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4)::INT)) & 31), 1)), 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM d""",
    "op2_url_filter": """
        WITH r(host_r, path_r, verdict_r) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
             ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path FROM pages)
        SELECT page_id, host, path,
               (SELECT arg_max(host_r || path_r, length(host_r || path_r)) FROM r
                 WHERE (host = host_r OR ends_with(host, '.' || host_r)) AND starts_with(path, path_r)) AS rule,
               coalesce((SELECT arg_max(verdict_r, length(host_r || path_r)) FROM r
                 WHERE (host = host_r OR ends_with(host, '.' || host_r)) AND starts_with(path, path_r)), 'allow') AS verdict
        FROM u""",
    "op6_ngram_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(ws) >= 5 THEN list_transform(range(len(ws) - 4), lambda i: array_to_string(ws[i + 1:i + 5], ' '))
                WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
        n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 75 * (a.n + b.n - o)),
        r AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.other)
        SELECT n.doc_id, n.n AS n_shingles, min(r.other) AS component_id FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY ALL""",
    "op8_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5""",
    "op11_centroids": f"""
        WITH v AS MATERIALIZED (
          SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
          WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS MATERIALIZED (
          SELECT (row_number() OVER (ORDER BY h, vec_id) - 1)::INT AS num, q
          FROM (SELECT vec_id, q, sha256('3:' || vec_id) AS h FROM v WHERE vec_id IS NOT NULL ORDER BY h, vec_id LIMIT 8)),
        {_rounds_sql(10, 64)}
        SELECT a.vec_id, a.num AS cluster, a.d::BIGINT AS distance, sum(a.d) OVER (PARTITION BY a.num)::BIGINT AS cluster_inertia,
               sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
        FROM a10 a JOIN c10 c ON c.num = a.num""",
    "op12_fm_index": r"""
        WITH w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (
          SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        p AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, unnest(list_transform(range(len(ws) - least(10, len(ws)) + 1),
                     lambda i: array_to_string(ws[i + 1:i + least(10, len(ws))], ' '))) AS g FROM b WHERE len(ws) > 0),
        d AS (SELECT w.doc_id, k.n, unnest(range(1, len(w.ws) - k.n + 2)) AS i, unnest(list_transform(range(len(w.ws) - k.n + 1),
                     lambda i: array_to_string(w.ws[i + 1:i + k.n], ' '))) AS g FROM w, (SELECT DISTINCT n FROM p) k WHERE len(w.ws) >= k.n),
        m AS (SELECT d.doc_id, p.item_id, d.i, d.n FROM d JOIN p ON p.n = d.n AND p.g = d.g),
        h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM m) GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
        SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN h ON h.doc_id = w.doc_id LEFT JOIN t ON t.doc_id = w.doc_id""",
    "op13_prefix_trie": f"""
        WITH t AS (
          SELECT conv_id AS c, md5(md5(coalesce(role, '')) || coalesce(text, '')) AS k, octet_length(encode(coalesce(text, ''))) AS bytes,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || coalesce(text, ''))) - 1 AS at
          FROM conversations WHERE conv_id IS NOT NULL),
        n AS (SELECT c, count(*) AS n, c - c % 5 AS b, {_CRC32} % 9 AS h FROM t GROUP BY c),
        v AS (SELECT n.c, n.b, n.h, least(n.h, coalesce(base.n, 0)) AS head FROM n LEFT JOIN n base ON base.c = n.b),
        r AS (SELECT v.c, t.at + 1 AS d, t.k, t.bytes FROM v JOIN t ON t.c = v.b AND t.at < v.head
              UNION ALL SELECT v.c, v.head + t.at - v.h + 1, t.k, t.bytes FROM v JOIN t ON t.c = v.c AND t.at >= v.h),
        p AS (SELECT c, d, bytes, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS path FROM r
              UNION ALL SELECT c, 0, 0, '' FROM v),
        e AS (SELECT c, max(path) AS path FROM (SELECT c, arg_max(path, d) AS path FROM p GROUP BY c) GROUP BY c),
        s AS (SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha FROM e GROUP BY path),
        g AS (SELECT path, any_value(d) AS d, min(c) AS c, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY path),
        k AS (SELECT a.path, count(x.path) AS n_children FROM g a LEFT JOIN g x ON x.d = a.d + 1 AND starts_with(x.path, a.path) GROUP BY a.path),
        q AS (SELECT a.path, sum((x.n_convs - 1) * x.bytes)::BIGINT AS saved, count(*) FILTER (WHERE kx.n_children = 0) AS n_leaves
              FROM g a JOIN g x ON starts_with(x.path, a.path) JOIN k kx ON kx.path = x.path GROUP BY a.path)
        SELECT g.c AS conv_id, g.d::BIGINT AS depth, u.c AS parent_conv_id, g.n_convs, k.n_children, q.n_leaves, q.saved AS saved_tokens,
               coalesce(s.sha, sha256('')) AS ends_sha256
        FROM g JOIN k ON k.path = g.path JOIN q ON q.path = g.path LEFT JOIN s ON s.path = g.path
             LEFT JOIN g u ON g.d > 0 AND u.path = left(g.path, 32 * (g.d - 1)::INT)""",
}
