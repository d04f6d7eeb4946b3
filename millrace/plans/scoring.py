"""Queries on scores, under the lexicon that the tables' invented prose reaches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring as s, text as t
from ..functions.lexicon import ACKNOWLEDGE, ADVISE, FIXTURE as LEX, STOCK
from ..operators import score as sc
from .cleaning import FLAT, cleaned
from .registry import any_sql, big, fold_sql, query, regex_sql, sentences_sql, strip_sql, table, text_list

# The last exchange of each conversation: the last assistant turn and the last user turn before it.
LAST = """
    turns AS (SELECT conv_id, turn, role, text FROM conversations),
    la AS (SELECT conv_id, max(turn) AS at FROM turns WHERE role = 'assistant' GROUP BY conv_id),
    lu AS (SELECT t.conv_id, max(t.turn) AS at FROM turns t JOIN la ON la.conv_id = t.conv_id AND t.turn < la.at WHERE t.role = 'user' GROUP BY t.conv_id),
    ex AS (
        SELECT d.conv_id, coalesce(u.text, '') AS u, coalesce(a.text, '') AS a FROM (SELECT DISTINCT conv_id FROM turns) d
        LEFT JOIN la ON la.conv_id = d.conv_id LEFT JOIN turns a ON a.conv_id = d.conv_id AND a.turn = la.at
        LEFT JOIN lu ON lu.conv_id = d.conv_id LEFT JOIN turns u ON u.conv_id = d.conv_id AND u.turn = lu.at
    )
"""


def exchanges(spark, sf):
    from ..operators.clean import nest

    u, a = sc.final_exchange(F.col("messages"))
    return nest(table(spark, sf, "conversations")).select("conv_id", u.alias("final_user"), a.alias("final_assistant"))


@query(f"WITH {LAST} SELECT conv_id, sha256(u) AS user_sha, sha256(a) AS assistant_sha FROM ex")
def score_final_exchange(spark, sf):
    df = exchanges(spark, sf)
    return df.select("conv_id", F.sha2("final_user", 256).alias("user_sha"), F.sha2("final_assistant", 256).alias("assistant_sha"))


def tags_sql(x: str, lex=LEX) -> str:
    """Sorted tags of folded text."""
    whens = ", ".join(f"CASE WHEN {any_sql(x, p)} THEN '{tag}' END" for tag, p in lex.topics.items())
    return f"list_sort(list_filter([{whens}], lambda q: q IS NOT NULL))"


def domain_sql(tags: str, x: str, lex=LEX) -> str:
    return (
        f"CASE WHEN list_contains({tags}, 'programming_offdomain') THEN 0.0::DOUBLE WHEN len({tags}) >= 2 THEN 1.0::DOUBLE "
        f"WHEN len({tags}) = 1 THEN 0.8::DOUBLE WHEN {any_sql(x, lex.fallback)} THEN 0.55::DOUBLE ELSE 0.2::DOUBLE END"
    )


DOCS = f"d AS MATERIALIZED (SELECT doc_id, text, {fold_sql('text')} AS f FROM documents), g AS MATERIALIZED (SELECT *, {tags_sql('f')} AS tags FROM d)"


def tagged(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "text", t.fold(F.col("text")).alias("f"))
    return df.withColumn("tags", s.topic_tags(F.col("f"), LEX))


@query(f"WITH {DOCS} SELECT doc_id, array_to_string(tags, ',') AS tags FROM g")
def score_topic_tags(spark, sf):
    return tagged(spark, sf).select("doc_id", F.array_join("tags", ",").alias("tags"))


@query(f"WITH {DOCS} SELECT label, count(*) AS n FROM (SELECT unnest(tags) AS label FROM g) GROUP BY label")
def score_tag_counts(spark, sf):
    return sc.label_counts(tagged(spark, sf), "tags")


@query(f"WITH {DOCS} SELECT doc_id, {domain_sql('tags', 'f')} AS domain_score, len(tags) = 0 AND NOT {any_sql('f', LEX.fallback)} AS weak FROM g")
def score_domain_relevance(spark, sf):
    df = tagged(spark, sf)
    return df.select(
        "doc_id",
        s.domain_relevance(F.col("tags"), F.col("f"), LEX).alias("domain_score"),
        s.weak_domain(F.col("tags"), F.col("f"), LEX).alias("weak"),
    )


def specific_sql(x: str, lex=LEX) -> str:
    return (
        f"least(CASE WHEN length({x}) >= 80 THEN 0.35::DOUBLE WHEN length({x}) >= 40 THEN 0.20::DOUBLE ELSE 0.0::DOUBLE END"
        f" + CASE WHEN regexp_matches({x}, '{regex_sql(lex.unit_regex, "i")}') THEN 0.35::DOUBLE ELSE 0.0::DOUBLE END"
        f" + CASE WHEN regexp_matches({x}, '{regex_sql(lex.list_regex, "m")}') THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END"
        f" + CASE WHEN len({sentences_sql(x)}) >= 2 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END, 1.0::DOUBLE)"
    )


def coach_sql(x: str, f: str, lex=LEX) -> str:
    part = lambda c, v: f"CASE WHEN {c} THEN {v}::DOUBLE ELSE 0.0::DOUBLE END"
    return (
        f"least({part(any_sql(f, lex.actions), 0.45)} + {part(any_sql(f, lex.collaborative), '0.20')}"
        f" + {part(any_sql(x, lex.questions), 0.15)} + {part(any_sql(f, lex.second_person), '0.20')}, 1.0::DOUBLE)"
    )


@query(f"WITH {LAST} SELECT conv_id, round_even({specific_sql('a')}, 4) AS specificity FROM ex")
def score_specificity(spark, sf):
    return exchanges(spark, sf).select("conv_id", F.bround(s.specificity(F.col("final_assistant"), LEX), 4).alias("specificity"))


@query(f"WITH {LAST}, x AS MATERIALIZED (SELECT conv_id, a, {fold_sql('a')} AS f FROM ex) SELECT conv_id, round_even({coach_sql('a', 'f')}, 4) AS coaching FROM x")
def score_coaching_signal(spark, sf):
    a = F.col("final_assistant")
    return exchanges(spark, sf).select("conv_id", F.bround(s.coaching_signal(a, t.fold(a), LEX), 4).alias("coaching"))


def cliche_sql(lex) -> str:
    return "CASE WHEN " + " OR ".join(f"starts_with(f, '{p}')" for p in lex.openers) + " THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END"


def safety_sql(lex) -> str:
    return f"CASE WHEN {any_sql('f', lex.absolutes)} THEN 0.20::DOUBLE ELSE 0.0::DOUBLE END"


CLICHE, SAFETY = cliche_sql(LEX), safety_sql(LEX)


def repeat_sql(x: str) -> str:
    return f"least(0.15::DOUBLE, 0.05::DOUBLE * (len({sentences_sql(x)}) - len(list_distinct({sentences_sql(x)}))))"


@query(f"WITH {DOCS} SELECT doc_id, {CLICHE} AS cliche, {SAFETY} AS safety, round_even({repeat_sql('text')}, 4) AS repetition FROM d")
def score_penalties(spark, sf):
    df = tagged(spark, sf)
    return df.select(
        "doc_id",
        s.cliche_penalty(F.col("f"), LEX).alias("cliche"),
        s.safety_penalty(F.col("f"), LEX).alias("safety"),
        F.bround(s.repetition_penalty(F.col("text")), 4).alias("repetition"),
    )


def _before(x: str, patterns) -> str:
    """Characters before the leftmost match of any pattern, null without one."""
    joined = "|".join(patterns).replace("'", "''")
    return f"CASE WHEN regexp_matches({x}, '(?i)(?:{joined})') THEN length(regexp_extract({x}, '(?is)^(.*?)(?:{joined})', 1)) END"


def ack_sql(f: str) -> str:
    head = f"array_to_string(string_split({f}, ' ')[1:50], ' ')"
    a, b = _before(head, ACKNOWLEDGE), _before(f, ADVISE)
    return f"CASE WHEN ({a}) IS NOT NULL AND (({b}) IS NULL OR ({a}) <= ({b})) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


# Acknowledgements and advice are rare in the prose, so some are put into half of the documents.
ADDED = "CASE doc_id % 8 WHEN 1 THEN 'I hear you. ' || text WHEN 3 THEN 'Try this. That is it. ' || text WHEN 5 THEN text || ' it makes sense' WHEN 7 THEN 'So tired, let''s use it ' || text ELSE text END"


@query(f"WITH d AS MATERIALIZED (SELECT doc_id, {fold_sql('x')} AS f FROM (SELECT doc_id, {ADDED} AS x FROM documents)) SELECT doc_id, {ack_sql('f')} AS ack FROM d")
def score_emotional_ack(spark, sf):
    return table(spark, sf, "documents").select("doc_id", s.acknowledgement(F.expr(ADDED.replace("let''s", "let\\'s"))).alias("ack"))


# Scores of all kept conversations, from the definition.
def scored_sql(pick: str, lex) -> str:
    """Scores of rows (conv_id, hint, u, a) of ``pick``."""
    return f"""{pick},
    folded AS MATERIALIZED (SELECT *, {fold_sql("a")} AS f, {fold_sql("u")} AS fu, {fold_sql("u || chr(10) || a")} AS ua FROM pick),
    tagged AS MATERIALIZED (SELECT *, {tags_sql("ua", lex)} AS tags FROM folded),
    parts AS MATERIALIZED (
        SELECT conv_id, tags, ua, {domain_sql("tags", "ua", lex)} AS dom, {coach_sql("a", "f", lex)} AS coach, {specific_sql("a", lex)} AS spec,
               CASE WHEN hint = 'mostly_ascii' AND {any_sql("fu", lex.emotions)} THEN {ack_sql("f")} END AS emo,
               {cliche_sql(lex)} AS cliche, {safety_sql(lex)} AS safety, {repeat_sql("a")} AS rep
        FROM tagged
    ),
    total AS MATERIALIZED (
        SELECT *, greatest(0.0::DOUBLE, least(CASE WHEN emo IS NULL
                THEN (dom * 0.40::DOUBLE + coach * 0.30::DOUBLE + spec * 0.30::DOUBLE) / (0.40::DOUBLE + 0.30::DOUBLE + 0.30::DOUBLE)
                ELSE (dom * 0.35::DOUBLE + coach * 0.25::DOUBLE + spec * 0.25::DOUBLE + emo * 0.15::DOUBLE) / (0.35::DOUBLE + 0.25::DOUBLE + 0.25::DOUBLE + 0.15::DOUBLE) END
                - (cliche + safety + rep), 1.0::DOUBLE)) AS overall
        FROM parts
    ),
    scored AS MATERIALIZED (
        SELECT *, list_filter([CASE WHEN list_contains(tags, 'programming_offdomain') THEN 'off_domain_programming' END,
                CASE WHEN len(tags) = 0 AND NOT {any_sql("ua", lex.fallback)} THEN 'weak_domain_signal' END,
                CASE WHEN dom < 0.5 AND NOT list_contains(tags, 'programming_offdomain') THEN 'low_domain_relevance' END,
                CASE WHEN overall < 0.55 THEN 'low_quality_score' END], lambda r: r IS NOT NULL) AS reasons
        FROM total
    )
"""


PICKED = f"""{FLAT},
    ok AS (SELECT conv_id, hint FROM conv WHERE reason IS NULL),
    lastrow AS (SELECT conv_id, max(rn) AS at FROM flat WHERE role = 'assistant' GROUP BY conv_id),
    userrow AS (SELECT f.conv_id, max(f.rn) AS at FROM flat f JOIN lastrow l ON l.conv_id = f.conv_id AND f.rn < l.at WHERE f.role = 'user' GROUP BY f.conv_id),
    pick AS (
        SELECT ok.conv_id, ok.hint, u.c AS u, a.c AS a FROM ok JOIN lastrow l ON l.conv_id = ok.conv_id JOIN flat a ON a.conv_id = ok.conv_id AND a.rn = l.at
        JOIN userrow r ON r.conv_id = ok.conv_id JOIN flat u ON u.conv_id = ok.conv_id AND u.rn = r.at
    )"""
SCORED = scored_sql(PICKED, LEX)


def scored(spark, sf):
    from ..operators.clean import kept

    return sc.score(kept(cleaned(spark, sf)), LEX)


@query(
    f"""WITH {SCORED} SELECT conv_id, array_to_string(tags, ',') AS tags, round_even(dom, 4) AS domain_score, round_even(coach, 4) AS coaching,
    round_even(spec, 4) AS specificity, round_even(emo, 4) AS emotional, round_even(overall, 4) AS overall, len(reasons) = 0 AS passes FROM scored"""
)
def score_records(spark, sf):
    return scored(spark, sf).select(
        "conv_id",
        F.array_join("topic_tags", ",").alias("tags"),
        F.col("domain_relevance_score").alias("domain_score"),
        F.col("coaching_signal_score").alias("coaching"),
        F.col("specificity_score").alias("specificity"),
        F.col("emotional_acknowledgment_score").alias("emotional"),
        F.col("overall_quality_score").alias("overall"),
        F.col("passes_training_filter").alias("passes"),
    )


@query(f"WITH {SCORED} SELECT label, count(*) AS n FROM (SELECT unnest(reasons) AS label FROM scored) GROUP BY label")
def score_exclusions(spark, sf):
    return sc.label_counts(scored(spark, sf), "exclusion_reasons")


@query(
    f"""WITH {SCORED} SELECT count(*) AS records, count(*) FILTER (len(reasons) = 0) AS passing, round_even(avg(round_even(dom, 4)), 4) AS avg_domain,
    round_even(avg(round_even(coach, 4)), 4) AS avg_coaching, round_even(avg(round_even(spec, 4)), 4) AS avg_specificity,
    round_even(avg(round_even(overall, 4)), 4) AS avg_overall, round_even(avg(round_even(emo, 4)), 4) AS avg_emotional, count(emo) AS emotional_records FROM scored"""
)
def score_report(spark, sf):
    r = sc.report(scored(spark, sf))
    names = {"avg_domain": "avg_domain_relevance_score", "avg_coaching": "avg_coaching_signal_score", "avg_specificity": "avg_specificity_score", "avg_overall": "avg_overall_quality_score", "avg_emotional": "avg_emotional"}
    return r.select("records", "passing", *[F.bround(v, 4).alias(k) for k, v in names.items()], "emotional_records")


# The stock lexicon's words are not those of the prose, so some are put into the exchanges: each conversation gets
# a few of these by its number, with what narrower patterns would miss (white space of Unicode, full-width digits,
# a number and its unit over a line end, a dash before a no-break space).
PROBES = [
    "1.\nOne", "-\u00a0a dash", "\uff13\u00a0sets", "3\nreps", "Keep 20 minutes", "* point", "12\u3000\u7ec4", "5 KG", "1)\ttab", "no list -here",
    "Strength and hypertrophy", "a marathon", "protein and carbs", "I feel anxious", "sleep", "knee pain", "plateau", "share equipment", "competition prep", "python code", "my goal",
    "Of course", "let's", "you", "recommend", "never", "What? Yes.", "That is hard. I hear you.", "\u5efa\u8bae \u4f60", "\u529b\u91cf\u8bad\u7ec3", "worried", "Great question, always",
]


def _probe(k: int) -> str:
    return f"{text_list(PROBES)}[1 + (conv_id * 7 + {k} * 11 + conv_id // 5) % {len(PROBES)}]"


STOCK_PICK = f"""{LAST}, pick AS (
        SELECT conv_id, CASE WHEN conv_id % 4 = 0 THEN 'majority_non_ascii' ELSE 'mostly_ascii' END AS hint, u || ' ' || {_probe(1)} AS u,
               CASE conv_id % 3 WHEN 0 THEN {_probe(2)} WHEN 1 THEN {_probe(3)} || chr(10) || {_probe(4)} ELSE {_probe(5)} || ' ' || a END AS a FROM ex)"""
STOCK_SCORED = scored_sql(STOCK_PICK, STOCK)


def stock_scored(spark, sf):
    pick = lambda k: F.element_at(F.array(*map(F.lit, PROBES)), F.expr(f"int(1 + (conv_id * 7 + {k} * 11 + conv_id div 5) % {len(PROBES)})"))
    third, a = F.col("conv_id") % 3, F.col("final_assistant")
    answer = F.when(third == 0, pick(2)).when(third == 1, F.concat(pick(3), F.lit("\n"), pick(4))).otherwise(F.concat(pick(5), F.lit(" "), a))
    hint = F.when(F.col("conv_id") % 4 == 0, "majority_non_ascii").otherwise("mostly_ascii")
    df = exchanges(spark, sf).select("conv_id", hint.alias("language_hint"), F.concat("final_user", F.lit(" "), pick(1)).alias("final_user"), answer.alias("final_assistant"))
    return sc.score_texts(df, STOCK)


SCORE_COLUMNS = """array_to_string(tags, ',') AS tags, round_even(dom, 4) AS domain_score, round_even(coach, 4) AS coaching, round_even(spec, 4) AS specificity,
    round_even(emo, 4) AS emotional, cliche, safety, round_even(rep, 4) AS repetition, round_even(overall, 4) AS overall, array_to_string(reasons, ',') AS reasons"""


@query(f"WITH {STOCK_SCORED} SELECT conv_id, {SCORE_COLUMNS} FROM scored")
def score_records_stock(spark, sf):
    return stock_scored(spark, sf).select(
        "conv_id",
        F.array_join("topic_tags", ",").alias("tags"),
        F.col("domain_relevance_score").alias("domain_score"),
        F.col("coaching_signal_score").alias("coaching"),
        F.col("specificity_score").alias("specificity"),
        F.col("emotional_acknowledgment_score").alias("emotional"),
        F.col("cliche_penalty").alias("cliche"),
        F.col("safety_penalty").alias("safety"),
        F.col("repetition_penalty").alias("repetition"),
        F.col("overall_quality_score").alias("overall"),
        F.array_join("exclusion_reasons", ",").alias("reasons"),
    )


@query(f"WITH {STOCK_SCORED} SELECT label, count(*) AS n FROM (SELECT unnest(tags) AS label FROM scored) GROUP BY label")
def score_tag_counts_stock(spark, sf):
    return sc.label_counts(stock_scored(spark, sf), "topic_tags")


@query("SELECT * FROM (VALUES (0, TRUE, 0.15::DOUBLE), (1, TRUE, 0.15::DOUBLE), (2, TRUE, 0.35::DOUBLE), (3, TRUE, 0.35::DOUBLE), (4, TRUE, 0.35::DOUBLE), (5, TRUE, 0.15::DOUBLE), "
       "(6, TRUE, 0.35::DOUBLE), (7, TRUE, 0.35::DOUBLE), (8, TRUE, 0.15::DOUBLE), (9, FALSE, 0.0::DOUBLE)) t(id, found, specificity)")
def score_specificity_probes(spark, sf):
    """The first ten probes under the stock patterns, with what each is worth."""
    df = spark.createDataFrame(list(enumerate(PROBES[:10])), "id int, x string")
    score = s.specificity(F.col("x"), STOCK)
    # Three of them are two sentences as well.
    plain = score - F.when(F.size(t.sentences(F.col("x"))) >= 2, F.lit(0.15)).otherwise(F.lit(0.0))
    return df.select("id", (plain > 0).alias("found"), F.bround(plain, 4).alias("specificity"))


MEMORY_GROUPS = [["the ", "das "], ["ción"], ["zzz"], ["ung", "ing"]]


@query(
    "WITH d AS MATERIALIZED (SELECT doc_id, " + fold_sql("text") + " AS f, lower(text) AS l FROM documents), n AS (SELECT doc_id, l, "
    + " + ".join(f"CASE WHEN {any_sql('f', g)} THEN 1 ELSE 0 END" for g in MEMORY_GROUPS)
    + " AS hits FROM d) SELECT doc_id, greatest(0.0::DOUBLE, least(hits / 4.0::DOUBLE - CASE WHEN contains(l, 'wher') THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END, 1.0::DOUBLE)) AS memory_usage, "
    "CASE WHEN hits >= 2 THEN 1.0::DOUBLE WHEN hits = 1 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS personalization FROM n"
)
def eval_memory_scores(spark, sf):
    groups = F.array(*[F.array(*map(F.lit, g)) for g in MEMORY_GROUPS])
    f = t.fold(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", s.memory_usage(f, F.col("text"), groups, ["wher"]).alias("memory_usage"), s.personalization(f, groups).alias("personalization")
    )


ACCEPTED, REJECTED = ["(?: |^)the ", "[a-z]+ung", " que[ ,.]"], [r"licen[cs]e", " 0[0-9]+"]


@query(
    f"""WITH d AS MATERIALIZED (SELECT doc_id, {fold_sql('text')} AS f FROM documents)
    SELECT doc_id, CASE WHEN len(list_filter({text_list(REJECTED)}, lambda p: regexp_matches(f, '(?i)' || p))) > 0 THEN 0.0::DOUBLE
    ELSE round_even(len(list_filter({text_list(ACCEPTED)}, lambda p: regexp_matches(f, '(?i)' || p))) / 3.0::DOUBLE, 4) END AS accuracy FROM d"""
)
def eval_scientific_accuracy(spark, sf):
    lit = lambda v: F.array(*map(F.lit, v))
    x = s.scientific_accuracy(t.fold(F.col("text")), lit(ACCEPTED), lit(REJECTED))
    return table(spark, sf, "documents").select("doc_id", F.bround(x, 4).alias("accuracy"))


@query(
    f"SELECT doc_id, len({sentences_sql('text')}) AS sentences, len({sentences_sql('text')}) - len(list_distinct({sentences_sql('text')})) AS repeated, "
    f"sha256(coalesce({sentences_sql(fold_sql('text'))}[1], '')) AS opening_sha, {strip_sql('text')} = text AS is_stripped FROM documents"
)
def text_sentences(spark, sf):
    from ..operators.dedup import opening

    x = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        big(F.size(t.sentences(x))).alias("sentences"),
        big(F.size(t.sentences(x)) - F.size(F.array_distinct(t.sentences(x)))).alias("repeated"),
        F.sha2(opening(x), 256).alias("opening_sha"),
        (t.strip(x) == x).alias("is_stripped"),
    )
