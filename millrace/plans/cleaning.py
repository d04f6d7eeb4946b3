"""Queries on cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.lexicon import ROLE_ALIASES
from ..operators import clean as c
from .registry import big, hint_sql, norm_sql, query, table

# Noise that the tables lack: tabs, runs of blanks, CR line ends, empty lines.
NOISY = "replace(replace(text, ', ', ',' || chr(9) || '  '), '.' || chr(10), '. ' || chr(13) || chr(10) || chr(10) || ' ' || chr(10) || chr(10) || chr(10))"


@query(f"SELECT doc_id, sha256({norm_sql(NOISY)}) AS text_sha, length({norm_sql(NOISY)})::BIGINT AS chars FROM documents")
def clean_normalize_documents(spark, sf):
    x = t.normalize(F.expr(NOISY))
    df = table(spark, sf, "documents").select("doc_id", x.alias("x"))
    return df.select("doc_id", F.sha2("x", 256).alias("text_sha"), big(F.length("x")).alias("chars"))


def dataset_of(conv):
    return F.concat(F.lit("org/src"), (conv % 4).cast("string"))


def cleaned(spark, sf):
    """All conversations through extraction, validation and projection."""
    m = c.nest(table(spark, sf, "conversations"))
    m = m.withColumn("messages", c.messages_or_null(F.col("messages")))
    m = m.withColumns({"dataset_id": dataset_of(F.col("conv_id")), "source_record_index": F.col("conv_id")})
    return c.clean(m)


FLAT = f"""
    flat AS (
        SELECT conv_id, turn, role, {norm_sql("text")} AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn
        FROM conversations
    ),
    talk AS (
        SELECT conv_id, rn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM flat WHERE role <> 'system'
    ),
    per AS (
        SELECT conv_id, count(*) AS n, count(*) FILTER (role = 'system') AS systems, min(rn) FILTER (role = 'system') AS system_at,
               count(*) FILTER (role = 'user') AS users, count(*) FILTER (role = 'assistant') AS assistants,
               arg_min(role, rn) FILTER (role <> 'system') AS first_role, arg_max(role, rn) FILTER (role <> 'system') AS last_role,
               max(length(c)) AS longest, sum(length(c))::BIGINT AS chars, string_agg(c, '' ORDER BY rn) AS content,
               string_agg(role || '::' || c, chr(10) ORDER BY rn) AS signature,
               bool_or(role NOT IN ('system', 'user', 'assistant') OR c = '') AS broken
        FROM flat GROUP BY conv_id
    ),
    conv AS (
        SELECT per.*, 'org/src' || (conv_id % 4) AS dataset_id,
            CASE WHEN broken THEN 'unable_to_extract_conversation' WHEN n < 2 THEN 'too_few_messages'
                 WHEN systems > 1 THEN 'multiple_system_messages' WHEN system_at > 1 THEN 'system_message_not_leading'
                 WHEN users + assistants = 0 THEN 'no_user_assistant_turns' WHEN first_role <> 'user' THEN 'conversation_must_start_with_user'
                 WHEN last_role <> 'assistant' THEN 'conversation_must_end_with_assistant'
                 WHEN EXISTS (SELECT 1 FROM talk WHERE talk.conv_id = per.conv_id AND role = before) THEN 'non_alternating_roles'
                 WHEN longest > 4000 THEN 'message_too_long' WHEN chars > 12000 THEN 'conversation_too_long' END AS reason,
            {hint_sql("content")} AS hint
        FROM per
    )
"""


@query(
    f"""WITH {FLAT}
    SELECT 'org__src' || (conv_id % 4) || '::' || lpad(conv_id::VARCHAR, 6, '0') AS conversation_id, n AS turn_count, users AS user_turns,
           assistants AS assistant_turns, systems > 0 AS has_system, chars, hint AS language_hint, sha256(signature) AS signature_sha
    FROM conv WHERE reason IS NULL"""
)
def clean_conversations_nested(spark, sf):
    df = c.kept(cleaned(spark, sf))
    return df.select(
        "conversation_id",
        big(F.col("turn_count")).alias("turn_count"),
        big(F.col("user_turn_count")).alias("user_turns"),
        big(F.col("assistant_turn_count")).alias("assistant_turns"),
        F.col("contains_system_message").alias("has_system"),
        big(F.col("conversation_characters")).alias("chars"),
        "language_hint",
        F.col("normalized_sha256").alias("signature_sha"),
    )


@query(f"WITH {FLAT} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM conv GROUP BY 1")
def clean_rejection_counts(spark, sf):
    df = cleaned(spark, sf).groupBy(F.coalesce("rejection_reason", F.lit("kept")).alias("reason"))
    return df.agg(F.count(F.lit(1)).alias("n"))


# The sequences that no conversation of the table has: one row for every code.
SEQUENCES = [
    ("too_few", "user"),
    ("two_systems", "system system user assistant"),
    ("late_system", "user system assistant"),
    ("only_system", "system"),
    ("system_alone_twice", "system system"),
    ("starts_wrong", "assistant user assistant"),
    ("ends_wrong", "user assistant user"),
    ("repeats", "user user assistant"),
    ("alias", "human bot"),
    ("unknown_role", "user narrator"),
    ("good", "developer client coach"),
]


@query(
    """SELECT * FROM (VALUES ('too_few', 'too_few_messages'), ('two_systems', 'multiple_system_messages'),
    ('late_system', 'system_message_not_leading'), ('only_system', 'too_few_messages'), ('system_alone_twice', 'multiple_system_messages'),
    ('starts_wrong', 'conversation_must_start_with_user'), ('ends_wrong', 'conversation_must_end_with_assistant'),
    ('repeats', 'non_alternating_roles'), ('alias', 'kept'), ('unknown_role', 'unable_to_extract_conversation'), ('good', 'kept')) t(name, reason)"""
)
def clean_sequence_codes(spark, sf):
    df = spark.createDataFrame(SEQUENCES, "name string, roles string")
    raw = F.transform(F.split("roles", " "), lambda r: F.struct(r.alias("role"), F.concat(F.lit(" says "), r).alias("content")))
    return df.select("name", F.coalesce(c.rejection(c.messages_or_null(raw)), F.lit("kept")).alias("reason"))


ALIASES = [*ROLE_ALIASES, " Human ", "narrator"]


@query(
    "SELECT conv_id, turn, CASE conv_id % 12 WHEN 0 THEN 'assistant' WHEN 1 THEN 'assistant' WHEN 2 THEN 'assistant' WHEN 3 THEN 'assistant' "
    "WHEN 4 THEN 'assistant' WHEN 5 THEN 'user' WHEN 6 THEN 'user' WHEN 7 THEN 'user' WHEN 8 THEN 'system' WHEN 9 THEN 'system' "
    "WHEN 10 THEN 'user' END AS role FROM conversations"
)
def clean_role_aliases(spark, sf):
    variant = F.element_at(F.array(*[F.lit(a.upper() if i % 2 else a) for i, a in enumerate(ALIASES)]), (F.col("conv_id") % 12 + 1).cast("int"))
    return table(spark, sf, "conversations").select("conv_id", "turn", c.normalize_role(variant).alias("role"))


HIGH = "regexp_replace(text, '[a-z]', '', 'g')"


@query(
    f"SELECT doc_id, {hint_sql('text')} AS hint, {hint_sql('CASE WHEN doc_id % 3 = 0 THEN ' + HIGH + ' ELSE text END')} AS hint_of_letters_dropped "
    "FROM documents"
)
def clean_language_hint(spark, sf):
    high = F.when(F.col("doc_id") % 3 == 0, F.regexp_replace("text", "[a-z]", "")).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", t.language_hint(F.col("text")).alias("hint"), t.language_hint(high).alias("hint_of_letters_dropped"))


def _pairs(spark, sf):
    """User and assistant text of each conversation's first exchange as question and answer."""
    turns = table(spark, sf, "conversations")
    pick = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    return turns.groupBy("conv_id").agg(pick("user").alias("u"), pick("assistant").alias("a"))


PAIRS = "pairs AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS u, arg_min(text, turn) FILTER (role = 'assistant') AS a FROM conversations GROUP BY conv_id)"
EXCHANGE = f"sha256('user::' || {norm_sql('q')} || chr(10) || 'assistant::' || {norm_sql('a')})"


@query(
    f"""WITH {PAIRS}, x AS (SELECT conv_id, a, CASE WHEN conv_id % 2 = 0 THEN {norm_sql('u')} || chr(10) || chr(10) || 'Context:' || chr(10) || 'extra ' || conv_id ELSE u END AS q FROM pairs)
    SELECT conv_id, u_or_null IS NOT NULL AS extracted, u_or_null AS signature_sha FROM (
        SELECT conv_id, CASE WHEN q IS NOT NULL AND a IS NOT NULL THEN {EXCHANGE} END AS u_or_null FROM x)"""
)
def clean_qa_pairs(spark, sf):
    record = F.map_from_arrays(
        F.array(F.lit("Question"), F.lit("ANSWER"), F.lit("input"), F.lit("other")),
        F.array(
            F.parse_json(F.to_json(F.array("u"))),
            F.parse_json(F.to_json(F.array("a"))),
            F.parse_json(F.to_json(F.array(F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("extra "), F.col("conv_id").cast("string")))))),
            F.parse_json(F.lit("[1]")),
        ),
    )
    df = _pairs(spark, sf).select("conv_id", F.transform_values(record, lambda k, v: F.variant_get(v, "$[0]", "variant")).alias("record"))
    df = c.extract(df)
    found = F.col("messages").isNotNull()
    return df.select("conv_id", found.alias("extracted"), F.when(found, F.sha2(c.signature(F.col("messages")), 256)).alias("signature_sha"))


@query(
    f"""WITH {PAIRS}, x AS (SELECT conv_id, u AS q, a FROM pairs)
    SELECT conv_id, CASE WHEN q IS NOT NULL AND a IS NOT NULL THEN sha256({norm_sql('q')}) END AS user_sha,
           CASE WHEN q IS NOT NULL AND a IS NOT NULL THEN sha256({norm_sql('a')}) END AS assistant_sha FROM x"""
)
def clean_instruct_parse(spark, sf):
    df = _pairs(spark, sf)
    blob = F.concat(F.when(F.col("conv_id") % 2 == 0, F.lit("<s> ")).otherwise(F.lit("")), F.lit("[inst] "), F.col("u"), F.lit(" [/INST] "), F.col("a"), F.lit("</s>"))
    user, assistant = c.instruct_parts(blob)
    return df.select("conv_id", F.sha2(user, 256).alias("user_sha"), F.sha2(assistant, 256).alias("assistant_sha"))


REPORT = """count(*) AS input_records, count(*) FILTER (reason IS NULL) AS kept_records, count(*) FILTER (reason IS NOT NULL) AS rejected_records,
    round_even(avg(n) FILTER (reason IS NULL), 4) AS avg_turns, round_even(avg(chars) FILTER (reason IS NULL), 4) AS avg_characters"""


@query(f"WITH {FLAT} SELECT dataset_id, {REPORT} FROM conv GROUP BY dataset_id")
def clean_report_by_dataset(spark, sf):
    r = c.report(cleaned(spark, sf)).filter("dataset_id IS NOT NULL")
    return r.withColumns({k: F.bround(k, 4) for k in ("avg_turns", "avg_characters")})


@query(f"WITH {FLAT} SELECT {REPORT} FROM conv")
def clean_report_totals(spark, sf):
    r = c.report(cleaned(spark, sf)).filter("dataset_id IS NULL").drop("dataset_id")
    return r.withColumns({k: F.bround(k, 4) for k in ("avg_turns", "avg_characters")})


@query(
    f"""WITH {FLAT}
    SELECT 'rejection_reason' AS counter, reason AS label, count(*) AS n FROM conv WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL SELECT 'language_hint', hint, count(*) FROM conv WHERE reason IS NULL GROUP BY hint
    UNION ALL SELECT 'quality_flag', 'contains_system_message', count(*) FROM conv WHERE reason IS NULL AND systems > 0 HAVING count(*) > 0
    UNION ALL SELECT 'quality_flag', 'majority_non_ascii', count(*) FROM conv WHERE reason IS NULL AND hint = 'majority_non_ascii' HAVING count(*) > 0"""
)
def clean_quality_flags(spark, sf):
    return c.counters(cleaned(spark, sf))


@query("SELECT doc_id, CASE WHEN length(text) > 12000 THEN 'conversation_too_long' ELSE 'within' END AS size_class, "
       "length(text) > 4000 AS message_too_long FROM documents")
def clean_length_caps(spark, sf):
    m = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    over = F.when(c.characters(m) > c.MAX_CONVERSATION, "conversation_too_long").otherwise("within")
    return table(spark, sf, "documents").select("doc_id", over.alias("size_class"), F.exists(m, lambda x: F.length(x["content"]) > c.MAX_MESSAGE).alias("message_too_long"))
