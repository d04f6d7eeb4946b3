"""Queries on composition, splits and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.lexicon import FITNESS_TAGS
from ..operators import audit, compose, order, split
from ..operators.clean import kept, nest
from .cleaning import FLAT, cleaned
from .registry import big, hash_sql, hint_sql, norm_sql, query, table, text_list
from .scoring import DOCS, tagged

SEED = 42


# --- composition -------------------------------------------------------------------------

FITNESS_SOURCES = ["src3", "src11"]
BUCKETED = f"""{DOCS}, b AS MATERIALIZED (
    SELECT g.doc_id, CASE WHEN list_has_any(tags, {text_list(FITNESS_TAGS)}) OR source IN ('src3', 'src11') THEN 'fitness'
        WHEN list_contains(tags, 'emotional_support') THEN 'emotional' ELSE 'general' END AS bucket
    FROM g JOIN documents USING (doc_id))"""


def bucketed(spark, sf):
    tags = tagged(spark, sf).select("doc_id", "tags")
    df = table(spark, sf, "documents").select("doc_id", "source").join(tags, "doc_id")
    return df.select("doc_id", compose.bucket(F.col("tags"), F.col("source"), FITNESS_SOURCES).alias("bucket"))


@query(f"WITH {BUCKETED} SELECT doc_id, bucket FROM b")
def final_buckets(spark, sf):
    return bucketed(spark, sf)


SHARE = 0.10


@query(
    f"""WITH {BUCKETED}, n AS (SELECT count(*) FILTER (bucket = 'fitness') AS fit, count(*) FILTER (bucket = 'emotional') AS emo FROM b),
    r AS (SELECT doc_id, bucket, row_number() OVER (PARTITION BY bucket ORDER BY {hash_sql(SEED, 'doc_id')}, doc_id) AS pos FROM b)
    SELECT bucket, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM r, n
    WHERE bucket <> 'emotional' OR fit = 0 OR pos <= least(emo, floor(fit * ({SHARE}::DOUBLE / (1.0::DOUBLE - {SHARE}::DOUBLE)))) GROUP BY bucket"""
)
def final_emotional_cap(spark, sf):
    capped = compose.cap_emotional(bucketed(spark, sf), SEED, "doc_id", SHARE)
    return capped.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


@query(
    f"""WITH {DOCS} SELECT doc_id, source_id, CASE WHEN list_contains(tags, 'programming_offdomain') OR doc_id % 7 = 0 THEN 'off-domain'
        WHEN source_id IN ('src5', 'curated') THEN 'mental-health-adjacent'
        WHEN list_contains(tags, 'emotional_support') AND NOT list_has_any(tags, {text_list(FITNESS_TAGS)}) THEN 'mental-health-adjacent'
        ELSE 'fitness-coaching-adjacent' END AS domain
    FROM (SELECT g.doc_id, tags, CASE WHEN g.doc_id % 3 = 0 THEN source WHEN g.doc_id % 3 = 1 THEN 'given' ELSE 'curated' END AS source_id
          FROM g JOIN documents d ON d.doc_id = g.doc_id)"""
)
def final_domain_resolution(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "source").join(tagged(spark, sf).select("doc_id", "tags"), "doc_id")
    third = F.col("doc_id") % 3
    dataset = F.when(third == 0, F.col("source")).when(third == 1, F.lit("  "))
    given = F.when(third == 1, F.lit("given")).otherwise(F.lit(""))
    reasons = F.when(F.col("doc_id") % 7 == 0, F.array(F.lit("off_domain_other"))).otherwise(F.array(F.lit("low_quality_score")))
    df = df.withColumn("source_id", compose.source_id(dataset, given, F.lit("curated")))
    return df.select("doc_id", "source_id", compose.domain(F.col("tags"), reasons, F.col("source_id"), ["src5", "curated"]).alias("domain"))


RENDERED = f"""CASE WHEN systems > 0 THEN '' ELSE '{compose.START}system' || chr(10) || '{compose.DEFAULT_SYSTEM}' || '{compose.STOP}' || chr(10) END
    || (SELECT string_agg('{compose.START}' || f.role || chr(10) || f.c || '{compose.STOP}' || chr(10), '' ORDER BY f.rn) FROM flat f WHERE f.conv_id = conv.conv_id)"""


@query(
    f"""WITH {FLAT} SELECT 'org__src' || (conv_id % 4) || '::' || lpad(conv_id::VARCHAR, 6, '0') AS record_id, 'real' AS source_type, dataset_id AS source_id,
    hint AS language, sha256({RENDERED}) AS text_sha FROM conv WHERE reason IS NULL"""
)
def final_training_records(spark, sf):
    df = compose.training_records(kept(cleaned(spark, sf)), "real")
    return df.select("record_id", "source_type", "source_id", "language", F.sha2("text", 256).alias("text_sha"))


@query(
    f"""WITH u AS (SELECT 'real' AS source_type, doc_id::VARCHAR AS record_id, source AS dataset_id FROM documents
        UNION ALL SELECT 'synthetic', 'b' || item_id, NULL FROM benchmark)
    SELECT source_type, record_id, dataset_id FROM u ORDER BY {hash_sql(SEED, 'record_id')} LIMIT 50"""
)
def final_composition(spark, sf):
    real = table(spark, sf, "documents").select(F.lit("real").alias("source_type"), F.col("doc_id").cast("string").alias("record_id"), F.col("source").alias("dataset_id"))
    synthetic = table(spark, sf, "benchmark").select(F.lit("synthetic").alias("source_type"), F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("record_id"))
    return order.sample(compose.union_all(real, synthetic), 50, SEED, "record_id")


@query(
    """WITH c AS (SELECT conv_id, string_agg(upper(role) || ': ' || text, chr(10) || chr(10) ORDER BY turn) AS x FROM conversations GROUP BY conv_id)
    SELECT conv_id, sha256(x || chr(10) || chr(10) || 'ASSISTANT:') AS sha FROM c"""
)
def final_plain_render(spark, sf):
    m = nest(table(spark, sf, "conversations"))
    return m.select("conv_id", F.sha2(compose.render_plain(F.col("messages")), 256).alias("sha"))


# --- splits ------------------------------------------------------------------------------

LEAST = (100, 5, 5)


@query("SELECT n - v - t AS train, v AS validation, t AS test FROM (SELECT count(*) AS n, greatest(5, round_even(count(*) * 0.05::DOUBLE, 0)::BIGINT) AS v, "
       "greatest(5, round_even(count(*) * 0.05::DOUBLE, 0)::BIGINT) AS t FROM documents)")
def split_targets(spark, sf):
    n = table(spark, sf, "documents").count()
    to = split.targets(n, least=LEAST)
    return spark.createDataFrame([(to.train, to.validation, to.test)], "train bigint, validation bigint, test bigint")


# Groups of unequal size: language and the last digit of the source.
GROUP = "lang || right(source, 1)"


def allocation_sql(target: str, ratio: str, reserved: str) -> str:
    """The allocation step by step, from sizes ``s`` (k, n) with ``reserved`` rows taken."""
    return f"""
        a AS (SELECT k, n, greatest(n - {reserved}, 0) AS avail, n * {ratio}::DOUBLE AS raw FROM s),
        b AS (SELECT *, least(floor(raw)::BIGINT, avail) AS base FROM a),
        c AS (SELECT *, CASE WHEN avail > 0 THEN raw - base ELSE 0.0::DOUBLE END AS rem, avail - base AS room, {target} - (SELECT sum(base) FROM b) AS need FROM b),
        d AS (SELECT *, CASE WHEN room > 0 AND coalesce(sum(CASE WHEN room > 0 THEN 1 ELSE 0 END) OVER (ORDER BY rem DESC, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < need THEN 1 ELSE 0 END AS one FROM c),
        e AS (SELECT *, need - (SELECT sum(one) FROM d) AS left_over, room - one AS room2 FROM d),
        f AS (SELECT k, n, (base + one + least(room2, greatest(left_over - coalesce(sum(room2) OVER (ORDER BY n DESC, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)))::BIGINT AS allocated FROM e)
    """


@query(
    f"""WITH s AS (SELECT {GROUP} AS k, count(*) AS n FROM documents GROUP BY 1),
    {allocation_sql("(SELECT greatest(5, round_even(sum(n) * 0.05::DOUBLE, 0)::BIGINT) FROM s)", "0.05", "0")} SELECT k AS source_id, n, allocated FROM f"""
)
def split_allocation(spark, sf):
    df = table(spark, sf, "documents").select(F.expr(GROUP).alias("source_id"))
    sizes = df.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    return split.allocate(sizes, split.targets(df.count(), least=LEAST).validation, 0.05)


@query(
    f"""WITH s AS (SELECT source AS k, count(*) AS n FROM documents GROUP BY 1),
    {allocation_sql("(SELECT greatest(5, round_even(sum(n) * 0.05::DOUBLE, 0)::BIGINT) FROM s)", "0.05", "0")},
    r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {hash_sql(SEED, 'source', 'doc_id')}, doc_id) AS pos FROM documents)
    SELECT doc_id, source, CASE WHEN pos <= allocated THEN 'validation' WHEN pos <= 2 * allocated THEN 'test' ELSE 'train' END AS split FROM r JOIN f ON f.k = r.source"""
)
def split_stratified(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "source")
    to = split.targets(df.count(), least=LEAST)
    return split.stratified(df, to, (0.05, 0.05), SEED, "doc_id", "source").select("doc_id", "source", "split")


@query(
    f"""WITH {FLAT}, r AS (SELECT conv_id, {RENDERED} AS x FROM conv WHERE reason IS NULL),
    k AS (SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN x || '!' WHEN conv_id % 11 = 0 THEN ' ' ELSE x END AS x, x AS good FROM r
          ORDER BY {hash_sql(SEED + 101, "conv_id")}, conv_id LIMIT 20),
    m AS (SELECT CASE WHEN trim(x) = '' OR x <> good THEN 1 ELSE 0 END AS bad, len(list_filter(string_split_regex(x, '[\\s]+'), lambda w: w <> '')) AS n FROM k)
    SELECT count(*) AS sampled, sum(bad)::BIGINT AS malformed, count(*) FILTER (n > 300) AS over_length, round_even(avg(n), 2) AS avg_tokens, max(n) AS max_tokens,
           round_even(count(*) FILTER (n > 300)::DOUBLE / count(*), 4) AS truncation_rate, CASE WHEN sum(bad) > 0 OR count(*) FILTER (n > 300) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM m"""
)
def split_spot_check(spark, sf):
    df = kept(cleaned(spark, sf))
    x = compose.render(F.col("messages"))
    x = F.when(F.col("conv_id") % 5 == 0, F.concat(x, F.lit("!"))).when(F.col("conv_id") % 11 == 0, F.lit(" ")).otherwise(x)
    out = split.spot_check(df.withColumn("text", x), 20, 300, SEED, "conv_id", messages="messages")
    return out.withColumn("truncation_rate", F.bround("truncation_rate", 4))


@query(f"SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {hash_sql(7, 'source', 'doc_id')}, doc_id) AS pos FROM documents) WHERE pos <= 3")
def order_sample_per_source(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "source")
    return order.ranked(df, 7, "doc_id", ["source"]).filter("rank <= 3").select("doc_id", "source")


# --- audits ------------------------------------------------------------------------------

FINAL = f"""fin AS MATERIALIZED (SELECT doc_id, source AS source_id, {hint_sql('text')} AS language, sha256({norm_sql('text')}) AS h,
    CASE WHEN contains(text, 'icense') THEN 'off-domain' WHEN lang = 'es' THEN 'mental-health-adjacent' ELSE 'fitness-coaching-adjacent' END AS domain FROM documents)"""


def final(spark, sf):
    x = F.col("text")
    domain = F.when(F.contains(x, F.lit("icense")), "off-domain").when(F.col("lang") == "es", "mental-health-adjacent").otherwise("fitness-coaching-adjacent")
    return table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("source_id"), t.language_hint(x).alias("language"), F.sha2(t.normalize(x), 256).alias("normalized_sha256"), domain.alias("domain")
    )


@query(
    f"""WITH {FINAL}, l AS (SELECT 'language' AS dimension, language AS label FROM fin UNION ALL SELECT 'domain', domain FROM fin UNION ALL SELECT 'source', source_id FROM fin),
    c AS (SELECT dimension, label, count(*) AS count FROM l GROUP BY ALL)
    SELECT dimension, label, count, round_even(count / (SELECT count(*) FROM fin)::DOUBLE, 4) AS share, round_even(count / (SELECT count(*) FROM fin)::DOUBLE * 100, 2) AS percentage FROM c"""
)
def audit_distributions(spark, sf):
    df, out = final(spark, sf), None
    for name, col in (("language", "language"), ("domain", "domain"), ("source", "source_id")):
        one = audit.distribution(df, col).select(F.lit(name).alias("dimension"), "*")
        out = one if out is None else out.unionByName(one)
    return out


CHECKS = f"""{FINAL}, v AS (
        SELECT count(*) AS n, count(*) FILTER (language = 'mostly_ascii') AS a, count(*) FILTER (language = 'majority_non_ascii') AS b,
               count(*) FILTER (domain = 'mental-health-adjacent') AS m, count(*) FILTER (domain = 'off-domain') AS o, count(DISTINCT h) AS d,
               (SELECT max(k) FROM (SELECT count(*) AS k FROM fin GROUP BY source_id)) AS s FROM fin
    ), r AS (
        SELECT unnest(['mostly_ascii_share', 'majority_non_ascii_share', 'mental_health_share', 'off_domain_share', 'largest_source_share', 'exact_duplicate_rate']) AS "check",
               unnest([a, b, m, o, s, n - d]) / unnest([n, n, n, n, n, n])::DOUBLE AS value, unnest([0.6, 0.4, 0.35, 0.01, 0.7, 0.0])::DOUBLE AS threshold FROM v
    ), k AS (SELECT *, CASE WHEN "check" = 'mostly_ascii_share' THEN value >= threshold ELSE value <= threshold END AS ok FROM r)"""


@query(f"""WITH {CHECKS} SELECT "check", round_even(value, 6) AS value, threshold, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status FROM k""")
def audit_checks(spark, sf):
    c = audit.checks(final(spark, sf))
    return c.select("check", F.bround("value", 6).alias("value"), "threshold", "status")


@query(f"WITH {FINAL} SELECT count(*) AS n, count(DISTINCT h) AS \"distinct\", round_even((count(*) - count(DISTINCT h)) / count(*)::DOUBLE, 6) AS duplicate_rate FROM fin")
def audit_duplicate_rate(spark, sf):
    return audit.duplicate_rate(final(spark, sf), "normalized_sha256").withColumn("duplicate_rate", F.bround("duplicate_rate", 6))


@query("SELECT round_even(max(n) / sum(n)::DOUBLE, 6) AS share FROM (SELECT count(*) AS n FROM documents GROUP BY source)")
def audit_max_source(spark, sf):
    return audit.largest_source_share(table(spark, sf, "documents"), "source").select(F.bround("share", 6).alias("share"))


@query(f"""WITH {CHECKS} SELECT string_agg("check", '; ' ORDER BY "check") FILTER (NOT ok) AS blockers, count(*) FILTER (NOT ok) AS open_checks, 'PASS' AS spot_status,
    CASE WHEN count(*) FILTER (NOT ok) = 0 THEN 'GO' ELSE 'NO GO' END AS verdict FROM k""")
def audit_blockers(spark, sf):
    return audit.blockers(audit.checks(final(spark, sf)))


@query(
    """WITH a AS (SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang), p AS (SELECT 'en' AS label, 50 AS n UNION ALL SELECT 'de', 25 UNION ALL SELECT 'it', 25)
    SELECT label, coalesce(a.n, 0) AS actual, coalesce(p.n, 0)::BIGINT AS planned,
           round_even(abs(coalesce(a.n, 0) / (SELECT sum(n) FROM a)::DOUBLE - coalesce(p.n, 0) / 100.0::DOUBLE), 6) AS deviation FROM a FULL JOIN p USING (label)"""
)
def plan_distribution_deviation(spark, sf):
    actual = table(spark, sf, "documents").groupBy(F.col("lang").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    planned = spark.createDataFrame([("en", 50), ("de", 25), ("it", 25)], "label string, n bigint")
    return audit.deviation(actual, planned).withColumn("deviation", F.bround("deviation", 6))


# --- the helpers on larger tables ---------------------------------------------------------


@query("SELECT l_returnflag AS label, count(*) AS count, round_even(count(*) / (SELECT count(*) FROM lineitem)::DOUBLE, 4) AS share, "
       "round_even(count(*) / (SELECT count(*) FROM lineitem)::DOUBLE * 100, 2) AS percentage FROM lineitem GROUP BY 1")
def load_distribution_lineitem(spark, sf):
    return audit.distribution(table(spark, sf, "lineitem"), "l_returnflag")


@query("SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS latest, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def load_latest_order_per_customer(spark, sf):
    from ..operators.events import latest

    df = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("timestamp"))
    return latest(df, ["o_custkey"]).select("o_custkey", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("latest"), F.col("event_id").alias("o_orderkey"))


@query(
    f"""WITH s AS (SELECT c_mktsegment AS k, count(*) AS n FROM customer GROUP BY 1),
    {allocation_sql("(SELECT round_even(sum(n) * 0.1::DOUBLE, 0)::BIGINT FROM s)", "0.1", "0")} SELECT k AS source_id, n, allocated FROM f"""
)
def load_allocation_customers(spark, sf):
    df = table(spark, sf, "customer")
    sizes = df.groupBy(F.col("c_mktsegment").alias("source_id")).agg(F.count(F.lit(1)).alias("n"))
    return split.allocate(sizes, round(df.count() * 0.1), 0.1)


@query("SELECT doc_id, length(text)::BIGINT AS chars, len(list_filter(string_split_regex(text, '[\\s]+'), lambda w: w <> '')) AS tokens FROM documents")
def token_count_default(spark, sf):
    x = F.col("text")
    return table(spark, sf, "documents").select("doc_id", big(F.length(x)).alias("chars"), big(split.blank_tokens(x)).alias("tokens"))
