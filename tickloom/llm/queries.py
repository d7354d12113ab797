"""The operators as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    bwt_dedup,
    compression,
    divergence,
    langid,
    mask_search,
    mixing,
    prefix_trie,
    sentencepiece_bpe,
    simhash,
    substring_dedup,
    suffix_decontamination,
    topk,
    warc,
)

PIECES = "piece_bpe_32k.model"


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library where the driver does."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return sentencepiece_bpe.digests(docs, public_tokenizers.path(PIECES)).withColumnRenamed("id", "doc_id")


def op3_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, radius=2)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op5_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = compression.score(docs, compression.learn(docs, _table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("id").alias("doc_id"), compression.held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= compression.GOOD).cast("int").alias("predicted"),
    )


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)
    found = topk.top_k(vectors, F.col("id") % 20 == 0, 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(langid.training_sample(docs)))
    return found.select(F.col("id").alias("doc_id"), compression.held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "rejected")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.digests(_table(spark, sf_dir, "documents"))


def op11_presence_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_decontamination.digests(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_divergence": op1_divergence,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_seed_extend": op3_seed_extend,
    "op4_simhash": op4_simhash,
    "op5_compression": op5_compression,
    "op6_topk": op6_topk,
    "op7_langid": op7_langid,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_suffix": op10_suffix,
    "op11_presence_masks": op11_presence_masks,
    "op12_decontamination": op12_decontamination,
    "op13_prefix_trie": op13_prefix_trie,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op6_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
            FROM embeddings),
        s AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS "rank"
            FROM s)
        SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 20""",
    "op8_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d,
                max(page_id) OVER (PARTITION BY coalesce(html, '')) AS m
            FROM pages)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
            CASE WHEN n >= 1000 AND m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN n >= 1000 AND m <> page_id THEN m END AS refers_to, true AS intact
        FROM p""",
    "op9_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, md5('mix:' || CAST(doc_id AS VARCHAR)) AS mark,
                len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
            FROM d GROUP BY source),
        k AS (
            SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
                sum(w) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
                CAST(1.5 AS DOUBLE) * CAST((SELECT sum(source_size) FROM s) AS DOUBLE) AS budget
            FROM s),
        l AS (
            SELECT (budget - CAST(held AS DOUBLE)) / CAST(free AS DOUBLE) AS level FROM k
            WHERE NOT (budget - CAST(held AS DOUBLE)) / CAST(free AS DOUBLE) * w > 2 * source_size
            ORDER BY 2.0 * source_size / w, source NULLS LAST LIMIT 1),
        t AS (
            SELECT source, source_size, budget,
                CASE WHEN level * w > CAST(2 * source_size AS DOUBLE) THEN CAST(2 * source_size AS DOUBLE) ELSE level * w END AS target
            FROM k, l),
        f AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, t.budget, a.again,
                CAST(sum(d.size) OVER (PARTITION BY d.source, a.again ORDER BY d.mark, d.doc_id, d.size) + t.source_size * a.again AS DOUBLE)
                    / t.target AS finish
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source CROSS JOIN (VALUES (0), (1)) a(again)),
        g AS (SELECT *, sum(size) OVER (ORDER BY finish) <= budget AS within FROM f)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
            CAST(sum(CASE WHEN within THEN size ELSE 0 END) AS BIGINT) AS taken
        FROM g GROUP BY doc_id, size, source_size, target""",
    "op11_presence_masks": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
        i AS (
            SELECT row_number() OVER () AS i, item_id, {_WORDS} AS words FROM benchmark),
        q AS (
            SELECT i, item_id, word, count(*) AS times FROM (SELECT i, item_id, unnest(words) AS word FROM i) GROUP BY ALL),
        c AS (
            SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(words)) AS BIGINT) AS big_l FROM d WHERE len(words) > 0),
        p AS (
            SELECT r, doc_id, n, word, count(*) AS tf
            FROM (SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n, unnest(words) AS word FROM d) GROUP BY ALL),
        w AS (
            SELECT word, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM p, c GROUP BY word, big_n),
        s AS (
            SELECT i, item_id, r, doc_id, CAST(sum(times * w * (
                (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) AS BIGINT) AS score
            FROM q JOIN p USING (word) JOIN w USING (word), c GROUP BY ALL),
        k AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS "rank" FROM s WHERE score > 0)
        SELECT item_id, "rank", doc_id, score FROM k WHERE "rank" <= 10""",
    "op12_decontamination": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
        i AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, words, least(len(words), 10) AS n
            FROM (SELECT item_id, {_WORDS} AS words FROM benchmark) WHERE len(words) > 0),
        t AS (
            SELECT DISTINCT item, n, list_aggregate(words[k : k + n - 1], 'string_agg', ' ') AS w
            FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS k FROM i)),
        o AS (
            SELECT r, k, l.n, list_aggregate(words[k : k + l.n - 1], 'string_agg', ' ') AS w
            FROM (SELECT d.*, s.n, unnest(range(1, len(words) - s.n + 2)) AS k FROM d, (SELECT DISTINCT n FROM t) s) l),
        f AS (SELECT o.r, o.k, o.n, t.item FROM o JOIN t ON t.n = o.n AND t.w = o.w),
        h AS (
            SELECT r, CAST(count(DISTINCT x) AS BIGINT) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS x FROM f) GROUP BY r),
        m AS (
            SELECT r, CAST(count(*) AS BIGINT) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT r, item FROM f) GROUP BY r)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN h USING (r) LEFT JOIN m USING (r)""",
    # crc32 bit by bit: the characters of the number, each followed by eight shifts (-1).
    "op13_prefix_trie": """
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (SELECT c, count(*) AS n FROM t GROUP BY c),
        crc AS (
            SELECT c, n, xor(list_reduce(
                list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
                    lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a // 2, 3988292384 * (a % 2)) END), 4294967295) % 9 AS h
            FROM ids),
        k AS (
            SELECT crc.c, crc.n, h, least(h, coalesce(b.n, 0)) AS k FROM crc LEFT JOIN ids b ON b.c = crc.c - crc.c % 5),
        r AS (
            SELECT k.c, t.p, t.role, t.text FROM k JOIN t ON t.c = k.c - k.c % 5 AND t.p <= k.k
            UNION ALL SELECT k.c, t.p - h + k, t.role, t.text FROM k JOIN t ON t.c = k.c AND t.p > h),
        e AS (SELECT c, k + greatest(n - h, 0) AS depth FROM k),
        s AS (
            SELECT c, p AS depth, octet_length(encode(text)) AS bytes, sha256(string_agg(sha256(role) || sha256(text), '') OVER (
                PARTITION BY c ORDER BY p)) AS path
            FROM r
            UNION ALL SELECT c, 0, 0, '' FROM e),
        a AS (
            SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM s GROUP BY path, depth),
        m AS (SELECT s.c, a.* FROM s JOIN a USING (path, depth)),
        g AS (
            SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id
            FROM a LEFT JOIN m p ON p.c = a.conv_id AND p.depth = a.depth - 1),
        f AS (
            SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1, 2),
        o AS (
            SELECT a.*, coalesce(n_children, 0) AS n_children FROM a LEFT JOIN f USING (conv_id, depth)),
        u AS (
            SELECT m.path, m.depth, count(*) FILTER (o.n_children = 0) AS n_leaves, sum((o.n_convs - 1) * o.bytes) AS saved
            FROM o JOIN m ON m.c = o.conv_id AND m.depth <= o.depth GROUP BY 1, 2),
        z AS (
            SELECT m.path, m.depth, sha256(string_agg(CAST(e.c AS VARCHAR), ',' ORDER BY e.c)) AS ends
            FROM e JOIN m ON m.c = e.c AND m.depth = e.depth GROUP BY 1, 2)
        SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, g.parent_conv_id, o.n_convs, o.n_children, u.n_leaves,
            CAST(u.saved AS BIGINT) AS saved_tokens, coalesce(z.ends, sha256('')) AS ends_sha256
        FROM o JOIN g USING (conv_id, depth) JOIN u USING (path, depth) LEFT JOIN z USING (path, depth)""",
}
