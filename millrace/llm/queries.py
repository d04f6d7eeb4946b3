"""The registered query of each training-data operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat_format, decontaminate, exact_dedup, jaccard_join, ngram_lm, packing, sharding, suffix_dedup, token_count, toxicity


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(
        "SELECT -1L conv_id, 0L turn, 'user' role, '</s>[INST] ok [/INST]' text "
        "UNION ALL SELECT -1L, 1L, 'assistant', '</s>[INST] ok [/INST]'"
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.digest(chat_format.format_windows(turns, tokenizer_path("byte_bpe_50k.json")))


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


#: 5 regions of 2 racks of 4 shards, numbered 0 to 39.
SHARDS = sharding.ShardTree.balanced(5, 2, 4)


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARDS)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (F.pmod(toxicity.crc32_of_id(F.col("doc_id")), F.lit(5)) == 0).alias("held_out"),
        F.col("__tx_score").alias("score"),
        (F.col("__tx_score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(toxicity.crc32_of_id(F.col("doc_id")), F.lit(7)) == 2
    return ngram_lm.score_texts(_table(spark, sf_dir, "documents"), held_out)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("__dc_n_words").alias("n_words"),
        F.col("__dc_n_hit").alias("n_hit"),
        F.col("__dc_n_items").alias("n_items"),
        F.col("__dc_items_sha256").alias("items_sha256"),
        (F.col("__dc_n_hit") > 0).alias("contaminated"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")
    return found.select(
        "doc_id",
        F.col("__xd_keep_id").alias("keep_id"),
        F.col("__xd_group_size").alias("group_size"),
        F.col("__xd_kept").alias("kept"),
        F.col("__xd_text_sha256").alias("text_sha256"),
    )


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_token_count": op2_token_count,
    "op3_shard": op3_shard,
    "op4_toxicity": op4_toxicity,
    "op5_pack": op5_pack,
    "op6_ngram_lm": op6_ngram_lm,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_decontaminate": op9_decontaminate,
    "op10_exact_dedup": op10_exact_dedup,
}

ORACLE_SQL = {
    # A CRC is taken byte by byte from a table that eight shifts make; equal weights leave the draws of a level as they are.
    "op3_shard": r"""
        WITH bits AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
            FROM (SELECT unnest(range(256)) AS i)
        ), b AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
        ), d AS (
            SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, len(x) // 2 + 16 AS size,
                xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(x, '..'), lambda h: ('0x' || h)::BIGINT)),
                    lambda c, y: xor(c >> 8, crc[1 + (xor(c, y) & 255)]))) AS text_crc32
            FROM b, bits
        ), g AS (
            SELECT *, list_transform(range(6), lambda i: -ln((('0x' || md5(k || '|g' || i)[:13])::BIGINT + 0.5) / 4503599627370496) / CASE WHEN i = 5 THEN 1 ELSE 8 END) AS u FROM d
        ), r AS (
            SELECT *, list_position(u[:5], list_min(u[:5])) - 1 AS region, list_position(u, list_min(u)) = 6 AS moves FROM g
        ), q AS (
            SELECT *, list_transform(range(2), lambda i: -ln((('0x' || md5(k || '|r' || region || '.' || i)[:13])::BIGINT + 0.5) / 4503599627370496)) AS v FROM r
        ), a AS (SELECT *, list_position(v, list_min(v)) - 1 AS rack FROM q),
        z AS (
            SELECT *, list_transform(range(4), lambda i: -ln((('0x' || md5(k || '|s' || region || '.' || rack || '.' || i)[:13])::BIGINT + 0.5) / 4503599627370496)) AS w FROM a
        ), s AS (SELECT *, (region * 8 + rack * 4 + list_position(w, list_min(w)) - 1)::INTEGER AS shard FROM z)
        SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
            row_number() OVER (PARTITION BY shard ORDER BY ('0x' || md5(k || '|' || text_crc32 || '|' || size)[:13])::BIGINT, doc_id, text_crc32, size) - 1 AS slot,
            CASE WHEN moves THEN 40 ELSE shard END::INTEGER AS grown_shard
        FROM s
    """,
    # All strings of 100 bytes as hex digits, each with the first place that has it.
    "op7_suffix_dedup": r"""
        WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        w AS (SELECT doc_id, s, substr(x, 2 * s + 1, 200) AS k FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS s FROM d)),
        f AS (SELECT k, min(doc_id * 4294967296 + s) AS first, count(*) AS n FROM w GROUP BY k HAVING count(*) > 1),
        h AS (SELECT w.doc_id, w.s FROM w JOIN f ON w.k = f.k WHERE w.doc_id * 4294967296 + w.s > f.first),
        g AS (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS new FROM h),
        i AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM g),
        c AS (SELECT doc_id, island, min(s) AS a, max(s) + 100 AS b FROM i GROUP BY doc_id, island),
        q AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS e FROM c),
        r AS (SELECT q.doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last, string_agg(substr(x, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) AS head FROM q JOIN d ON d.doc_id = q.doc_id GROUP BY q.doc_id)
        SELECT d.doc_id, len(x) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans,
            sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN r ON r.doc_id = d.doc_id
    """,
    "op8_ngram_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS ws
            FROM documents
        ), s AS (
            SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []
                WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END)) AS g
            FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id
        ), l AS (
            SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
            WHERE 100 * p.both >= 85 * (x.n + y.n - p.both)
        ), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (
            SELECT doc_id AS v, doc_id AS c FROM documents
            UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.c
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(c) FROM r WHERE r.v = d.doc_id) AS component_id
        FROM documents d LEFT JOIN n USING (doc_id)
    """,
    "op9_decontaminate": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda w: w <> '') AS ws FROM documents
        ), b AS (
            SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda w: w <> '') AS ws FROM benchmark
        ), v AS (
            SELECT DISTINCT item_id, least(10, len(ws)) AS k, unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1), lambda i: array_to_string(ws[i:i+9], ' '))) AS w FROM b WHERE len(ws) > 0
        ), p AS (
            SELECT doc_id, k, unnest(range(1, len(ws) - k + 2)) AS i, ws FROM d, (SELECT DISTINCT k FROM v) WHERE len(ws) >= k
        ), o AS (
            SELECT p.doc_id, p.i, p.k, v.item_id FROM p JOIN v ON v.k = p.k AND v.w = array_to_string(p.ws[p.i:p.i+p.k-1], ' ')
        ), h AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM o) GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM o) GROUP BY doc_id)
        SELECT d.doc_id, len(d.ws) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
               coalesce(h.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
    """,
    "op10_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n
    """,
}
