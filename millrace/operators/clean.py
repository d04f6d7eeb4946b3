"""Raw records to cleaned conversations, with a rejection code for every record that is not kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as t
from ..functions.plan import let, once
from ..functions.lexicon import ANSWER_KEYS, CONTENT_KEYS, CONVERSATION_KEYS, PROMPT_KEYS, ROLE_ALIASES, ROLE_KEYS

# Caps of the cleaning rules.
MIN_MESSAGES, MAX_MESSAGE, MAX_CONVERSATION = 2, 4000, 12000
MESSAGES = "array<struct<role:string,content:string>>"


def normalize_role(x: Column) -> Column:
    """One of three roles, or null for a name that is no alias of one."""
    pairs = [F.lit(v) for kv in ROLE_ALIASES.items() for v in kv]
    return F.try_element_at(F.create_map(*pairs), F.lower(t.normalize(x)))


def nest(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn to one row per conversation with ``messages`` in turn order."""
    row = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    listed = turns.groupBy(conv).agg(F.array_sort(F.collect_list(row)).alias("messages"))
    return listed.withColumn("messages", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))))


def messages_or_null(raw: Column) -> Column:
    """Normalised messages; null when any of them lacks a known role or content."""
    norm = F.transform(
        raw, lambda m: F.struct(normalize_role(m["role"]).alias("role"), F.nullif(t.normalize(m["content"]), F.lit("")).alias("content"))
    )
    return let(norm, lambda n: F.when(F.forall(n, lambda m: m["role"].isNotNull() & m["content"].isNotNull()), n))


# --- raw records -------------------------------------------------------------------------


def _value(record: Column, key: str) -> Column:
    """The value under a key in any case; the last of several wins."""
    found = F.filter(F.map_entries(record), lambda e: F.lower(e["key"]) == key)
    return F.try_element_at(found, F.lit(-1))["value"]


def _text_of(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    plain = F.try_variant_get(value, "$", "string")
    return F.nullif(t.normalize(F.when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.to_json(value)).otherwise(plain)), F.lit(""))


def first_text(record: Column, keys: list[str]) -> Column:
    """First text that is not blank after normalisation, by the keys' order."""
    return F.coalesce(*[_text_of(_value(record, k)) for k in keys])


def user_text(record: Column) -> Column:
    main, extra = first_text(record, PROMPT_KEYS), first_text(record, ["input"])
    return F.when(extra.isNotNull() & (extra != main), F.concat(main, F.lit("\n\nContext:\n"), extra)).otherwise(main)


def instruct_parts(blob: Column) -> tuple[Column, Column]:
    """User and assistant part of ``[INST] … [/INST] …``; null where there is none."""
    pattern = r"(?is)\A(?:<s>\s*)?\[INST\](.*?)\[/INST\](.*?)(?:</s>)?\z"
    part = lambda n: F.nullif(t.normalize(F.regexp_extract(blob, pattern, n)), F.lit(""))
    return part(1), part(2)


def extract(records: DataFrame, record: str = "record") -> DataFrame:
    """Add ``messages`` to rows that hold a ``map<string,variant>`` (null: not an object).

    The first conversation key whose value is a list decides; else a pair of
    prompt and answer; else an instruct text.
    """
    r = F.col(record)
    is_list = lambda v: F.schema_of_variant(v).startswith("ARRAY")
    lists = [F.when(is_list(_value(r, k)), _value(r, k)) for k in CONVERSATION_KEYS]
    maps = F.from_json(F.to_json(F.coalesce(*lists)), "array<map<string,variant>>")
    chat = F.transform(maps, lambda m: F.struct(normalize_role(first_text(m, ROLE_KEYS)).alias("role"), first_text(m, CONTENT_KEYS).alias("content")))
    chat = let(chat, lambda c: F.when(F.forall(c, lambda m: m["role"].isNotNull() & m["content"].isNotNull()), c))
    pair = lambda u, a: F.when(
        u.isNotNull() & a.isNotNull(),
        F.array(F.struct(F.lit("user").alias("role"), u.alias("content")), F.struct(F.lit("assistant").alias("role"), a.alias("content"))),
    )
    inst = instruct_parts(first_text(r, ["text"]))
    rest = F.coalesce(pair(user_text(r), first_text(r, ANSWER_KEYS)), pair(*inst))
    return records.withColumn("messages", F.when(F.coalesce(*lists).isNotNull(), chat).otherwise(rest).cast(MESSAGES))


# --- validation --------------------------------------------------------------------------


def count_role(messages: Column, role: str) -> Column:
    return F.size(F.filter(messages, lambda m: m["role"] == role))


def sequence_error(m: Column) -> Column:
    """First broken rule of turn order, or null."""
    systems = count_role(m, "system")
    talk = F.filter(m, lambda x: x["role"] != "system")
    n = F.size(talk)
    pairs = F.zip_with(
        F.slice(talk, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(talk, F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: a["role"] == b["role"],
    )
    return (
        F.when(F.size(m) < MIN_MESSAGES, "too_few_messages")
        .when(systems > 1, "multiple_system_messages")
        .when((systems == 1) & (m[0]["role"] != "system"), "system_message_not_leading")
        .when(n == 0, "no_user_assistant_turns")
        .when(talk[0]["role"] != "user", "conversation_must_start_with_user")
        .when(F.element_at(talk, -1)["role"] != "assistant", "conversation_must_end_with_assistant")
        .when(F.exists(pairs, lambda same: same), "non_alternating_roles")
    )


def characters(m: Column) -> Column:
    return F.aggregate(m, F.lit(0), lambda a, x: a + F.length(x["content"]))


def rejection(m: Column) -> Column:
    """First failing rule, or null for a record that is kept."""
    return F.coalesce(
        F.when(m.isNull(), "unable_to_extract_conversation"),
        sequence_error(m),
        F.when(F.exists(m, lambda x: F.length(x["content"]) > MAX_MESSAGE), "message_too_long"),
        F.when(characters(m) > MAX_CONVERSATION, "conversation_too_long"),
    )


def schema_error(m: Column) -> Column:
    """A last look at what is to be written: known roles, content that is not blank."""
    sound = F.forall(m, lambda x: x["role"].isin("system", "user", "assistant") & (t.strip(x["content"]) != ""))
    return F.when(~F.coalesce(sound, F.lit(False)), "schema_validation_failed")


def require_kept(totals: DataFrame) -> DataFrame:
    """The report's row over all; an error where it has input and nothing was kept."""
    wrong = F.raise_error(F.lit("no record was kept")).cast("bigint")
    return totals.withColumn("kept_records", F.when((F.col("input_records") > 0) & (F.col("kept_records") == 0), wrong).otherwise(F.col("kept_records")))


def signature(m: Column) -> Column:
    return F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit("::"), x["content"])), "\n")


def conversation_id(dataset: Column, index: Column) -> Column:
    return F.concat(F.replace(dataset, F.lit("/"), F.lit("__")), F.lit("::"), F.format_string("%06d", index))


def clean(records: DataFrame, dataset: str = "dataset_id", index: str = "source_record_index") -> DataFrame:
    """Add the cleaned record's columns and ``rejection_reason`` to rows with ``messages``; no shuffle.

    A column ``record`` that is null where the raw value is no object, or
    ``messages`` that break the schema, have codes of their own.
    """
    m = F.col("messages")
    records = once(records, messages=m)
    early = F.when(F.col("record").isNull(), "record_not_object") if "record" in records.columns else F.lit(None).cast("string")
    content = F.array_join(F.transform(m, lambda x: x["content"]), "")
    out = once(records, rejection_reason=F.coalesce(early, rejection(m), schema_error(m)))
    out = out.withColumns(
        {
            "conversation_id": conversation_id(F.col(dataset), F.col(index)),
            "turn_count": F.size(m),
            "user_turn_count": count_role(m, "user"),
            "assistant_turn_count": count_role(m, "assistant"),
            "contains_system_message": count_role(m, "system") > 0,
            "language_hint": t.language_hint(content),
            "conversation_characters": characters(m),
            "normalized_sha256": F.sha2(signature(m), 256),
        }
    )
    high = F.col("language_hint") == "majority_non_ascii"
    return out.withColumns(
        {
            "majority_non_ascii": high,
            "quality_flags": F.array_compact(
                F.array(F.when(high, "majority_non_ascii"), F.when(F.col("contains_system_message"), "contains_system_message"))
            ),
        }
    )


def kept(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter("rejection_reason IS NULL").drop("rejection_reason")


# --- reports -----------------------------------------------------------------------------


def report(cleaned: DataFrame, dataset: str = "dataset_id") -> DataFrame:
    """Counts and means by dataset, and over all (a null dataset), in one pass."""
    ok = F.col("rejection_reason").isNull()
    return cleaned.rollup(dataset).agg(
        F.count(F.lit(1)).alias("input_records"),
        F.count_if(ok).alias("kept_records"),
        F.count_if(~ok).alias("rejected_records"),
        F.avg(F.when(ok, F.col("turn_count"))).alias("avg_turns"),
        F.avg(F.when(ok, F.col("conversation_characters"))).alias("avg_characters"),
    )


def counters(cleaned: DataFrame) -> DataFrame:
    """Long form (counter, label, n) of rejection reasons, language hints and quality flags."""
    ok = F.col("rejection_reason").isNull()
    pairs = F.array_compact(
        F.concat(
            F.array(
                F.when(~ok, F.struct(F.lit("rejection_reason").alias("counter"), F.col("rejection_reason").alias("label"))),
                F.when(ok, F.struct(F.lit("language_hint").alias("counter"), F.col("language_hint").alias("label"))),
            ),
            F.when(ok, F.transform("quality_flags", lambda f: F.struct(F.lit("quality_flag").alias("counter"), f.alias("label")))).otherwise(
                F.array().cast("array<struct<counter:string,label:string>>")
            ),
        )
    )
    return cleaned.select(F.explode(pairs).alias("p")).groupBy("p.counter", "p.label").agg(F.count(F.lit(1)).alias("n"))
