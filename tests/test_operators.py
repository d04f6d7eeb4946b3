"""Behaviour of the operators on small inputs: what each must do, case by case."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import scoring as s, text as t
from millrace.functions.lexicon import STOCK
from millrace.operators import audit, clean, compose, dedup, evaluate, events as ev, order, research as r, score as sc, split, training
from millrace.plans import planner, profile, rubric
from millrace.sources import dimensions as dim, readers, sinks
from millrace.streaming import ingest

MESSAGES = "array<struct<role:string,content:string>>"


def chat(*turns):
    return [(role, text) for role, text in turns]


# --- text --------------------------------------------------------------------------------


def py_normalize(x):
    import re

    x = x.replace("\r\n", "\n").replace("\r", "\n")
    x = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", x))
    return "\n".join(line.strip() for line in x.split("\n")).strip()


def test_normalize_and_fold_like_python(spark):
    import re

    blanks = "".join(chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, 0x2000, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
    texts = ["", " a\t\tb ", "a\r\nb\rc", "a\n\n\n\nb", "a\n \n \n\nb", f"x{blanks}y{blanks}", "  \n\n ", "​z﻿", "漢字 　 ok", "a\n\n \n\nb  "]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", t.normalize(F.col("x")), t.fold(F.col("x"))).collect()
    for x, norm, fold in rows:
        assert norm == py_normalize(x)
        assert fold == re.sub(r"\s+", " ", x.strip().lower())


def test_text_helpers(spark):
    df = spark.createDataFrame([("Qwen/Qwen2.5-1.5B", "<p>a &amp;lt; b</p> <b>c</b>", "One. Two! Three?")], "n string, h string, x string")
    row = df.select(
        t.storage_name(F.col("n")), t.slug(F.col("n")), t.strip_html(F.col("h")), t.first_sentences(F.col("x")), t.human_count(F.lit(1_540_000_000)), t.human_count(F.lit(None).cast("long")),
        t.shorten(F.lit("aaa bbb ccc ddd"), 12), t.section(F.lit("<h2>Intro</h2>x<h2>Conclusion</h2><p>Done &amp; dusted.</p><h2>Refs</h2>")), t.unescape(F.lit("&eacute;&amp;")),
    ).first()
    assert tuple(row) == ("Qwen__Qwen2.5-1.5B", "qwen__qwen2.5-1.5b", "a &lt; b c", "One. Two!", "1.54B", "n/a", "aaa bbb...", "Done & dusted.", "é&")


# --- sources -----------------------------------------------------------------------------


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_readers_and_extraction(spark, tmp_path):
    jsonl = write(tmp_path / "a.jsonl", '{"conversations":[{"from":"human","value":" hi "},{"FROM":"gpt","value":"yo"}]}\n\n[1]\n{"messages":"x","Prompt":"q","input":"more","output":2}\n')
    listed = write(tmp_path / "b.json", json.dumps([{"question": "Q", "answer": "A"}, 5]))
    data = write(tmp_path / "c.JSON", json.dumps({"data": [{"question": "Q2", "answer": None}]}))
    single = write(tmp_path / "d.json", json.dumps({"text": "<s>[INST] u [/INST] a</s>"}))
    csv = write(tmp_path / "e.csv", 'text\n"<s>[INST] multi\nline ""q"" [/INST] ok</s>"\nnothing\n')
    pq = str(tmp_path / "f.parquet")
    spark.createDataFrame([(chat(("user", "u"), ("assistant", "a")), None)], f"Chat {MESSAGES}, n double").coalesce(1).write.parquet(pq)
    df = clean.extract(readers.read_files(spark, [jsonl, listed, data, single, csv, pq]))
    got = {(r["source_file"].rsplit("/", 1)[-1][:1], r["source_record_index"]): r["messages"] and [tuple(m) for m in r["messages"]] for r in df.collect()}
    assert got["a", 0] == [("user", "hi"), ("assistant", "yo")]
    assert got["a", 1] is None
    assert got["a", 2] == [("user", "q\n\nContext:\nmore"), ("assistant", "2")]
    assert got["b", 0] == [("user", "Q"), ("assistant", "A")] and got["b", 1] is None
    assert got["c", 0] is None
    assert got["d", 0] == [("user", "u"), ("assistant", "a")]
    assert got["e", 0] == [("user", 'multi\nline "q"'), ("assistant", "ok")] and got["e", 1] is None
    assert [v for k, v in got.items() if k[0] == "p"] == [[("user", "u"), ("assistant", "a")]]
    with pytest.raises(readers.UnsupportedFormat):
        readers.read_files(spark, ["README.md"])
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        readers.read_jsonl(spark, write(tmp_path / "bad.jsonl", "{oops\n")).collect()


def test_rows_of_a_file_keep_their_order(spark, tmp_path):
    path = write(tmp_path / "long.jsonl", "".join(json.dumps({"prompt": f"p{i}", "output": "o" * 50}) + "\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = clean.extract(readers.read_jsonl(spark, path)).select("source_record_index", F.col("messages")[0]["content"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {i: c for i, c in rows} == {i: f"p{i}" for i in range(3000)}


def test_manifest(spark, tmp_path):
    data = write(tmp_path / "x.jsonl", '{"question":"q","answer":"a"}\n')
    manifest = write(tmp_path / "m.json", json.dumps({"datasets": [
        {"id": "org/a", "license": "mit", "files": [{"path": data}, {"path": "README.md"}]}, {"id": "org/b", "license": None, "files": [{"path": "x.txt"}]}]}))
    assert readers.read_manifest(spark, manifest, ["org/a"]).select("dataset_id", "source_license").collect() == [("org/a", "mit")]
    with pytest.raises(RuntimeError, match="org/b has no supported data files"):
        readers.read_manifest(spark, manifest)
    with pytest.raises(ValueError, match="no dataset"):
        readers.read_manifest(spark, manifest, ["org/zzz"])
    assert readers.read_optional(spark, str(tmp_path / "none"), "augmented").count() == 0


def test_atom(spark, tmp_path):
    entry = "<entry><id>{0}</id><title> A\n b </title><summary>s</summary><published>{1}-01-01</published><author><name>N</name></author></entry>"
    feed = '<feed xmlns="http://www.w3.org/2005/Atom">' + entry.format("i1", 2024) + entry.format("i2", 2020) + "</feed>"
    rows = readers.read_atom(spark, write(tmp_path / "f.xml", feed)).collect()
    assert [(r["id"], r["title"], r["authors"]) for r in rows] == [("i1", "A\n b", ["N"])]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, x string")
    assert sinks.fingerprint(df).first() == sinks.fingerprint(df.repartition(3)).first() != sinks.fingerprint(df.limit(1)).first()
    (tmp_path / "files").mkdir()
    write(tmp_path / "files" / "one.txt", "abc")
    files = sinks.file_manifest(spark, str(tmp_path / "files"))
    assert files.first()["sha256"].startswith("ba7816bf") and sinks.manifest_totals(files).first()["total_bytes"] == 3
    assert sinks.self_checked({"b": 1, "a": 2})["content_sha256"] == sinks.self_checked({"a": 2, "b": 1})["content_sha256"]
    assert "| k |" in sinks.markdown("R", {"S": [{"k": 1}], "E": []})


# --- cleaning and scoring ------------------------------------------------------------------


def score_one(spark, user, answer, lex=STOCK):
    df = spark.createDataFrame([(user, answer, "mostly_ascii")], "final_user string, final_assistant string, language_hint string")
    return sc.score_texts(df, lex).first()


def test_scores(spark):
    good = score_one(spark, "I'm frustrated and missed my workouts.", "That makes sense, and I hear you. Let's plan 3 sets of 8 reps for squat this week. You can track your sleep. What time suits you?")
    assert good["passes_training_filter"] and good["overall_quality_score"] >= 0.55 and good["emotional_acknowledgment_score"] == 1.0
    code = score_one(spark, "Fix my python code", "Use javascript instead.")
    assert "off_domain_programming" in code["exclusion_reasons"] and code["domain_relevance_score"] == 0.0 and "low_domain_relevance" not in code["exclusion_reasons"]
    felt = score_one(spark, "I feel lonely and anxious", "Talking to a therapist can help.")
    assert "emotional_support" in felt["topic_tags"] and felt["domain_relevance_score"] >= 0.8
    weak = score_one(spark, "Hello", "Nothing here.")
    assert {"weak_domain_signal", "low_domain_relevance"} <= set(weak["exclusion_reasons"])


@pytest.mark.parametrize("text,want", [
    ("That is hard. Try this.", 1.0), ("Try this. That is hard.", 0.0), ("", 0.0), ("frustrated", 0.0), ("I hear you", 1.0),
    ("word " * 50 + "I hear you", 0.0), ("Nothing", 0.0),
])
def test_acknowledgement(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(s.acknowledgement(F.col("x"))).first()[0] == want


def test_language_and_flags(spark):
    rows = [(1, "org/a", chat(("user", "你好"), ("assistant", "很好"))), (2, "org/a", chat(("system", "s"), ("user", "u"), ("assistant", "a" * 4001)))]
    df = clean.clean(spark.createDataFrame(rows, f"source_record_index int, dataset_id string, messages {MESSAGES}"))
    a, b = df.orderBy("source_record_index").collect()
    assert a["quality_flags"] == ["majority_non_ascii"] and a["conversation_id"] == "org__a::000001"
    assert b["rejection_reason"] == "message_too_long" and b["contains_system_message"]


# --- composition, splits, audits -------------------------------------------------------------


def test_cap_then_split(spark):
    rows = [(i, "fitness" if i < 8 else "emotional") for i in range(18)]
    out = compose.cap_emotional(spark.createDataFrame(rows, "id int, bucket string"), 42, "id")
    assert out.count() == 12 and out.filter("bucket = 'emotional'").count() == 4
    assert split.targets(12, 0.1, 0.1, (1, 2, 1)) == split.Targets(9, 2, 1)
    with pytest.raises(RuntimeError):
        split.targets(12, least=(10, 2, 1))


def test_stratified_sizes_and_determinism(spark):
    df = spark.createDataFrame([(f"r{i}", "a" if i < 60 else "b") for i in range(100)], "record_id string, source_id string")
    to = split.targets(100, 0.1, 0.1, (10, 5, 5))
    one = split.stratified(df, to, (0.1, 0.1), 42, "record_id")
    n = {(r["split"], r["source_id"]): r["count"] for r in one.groupBy("split", "source_id").count().collect()}
    assert n["validation", "a"] == n["test", "a"] == 6 and n["validation", "b"] == n["test", "b"] == 4
    two = split.stratified(df.repartition(7), to, (0.1, 0.1), 42, "record_id")
    other = split.stratified(df, to, (0.1, 0.1), 43, "record_id")
    rows = lambda d: set(d.select("record_id", "split").collect())
    assert rows(one) == rows(two) != rows(other)


def py_allocate(sizes, target, ratio, reserved):
    out, rem = {}, []
    for k, n in sizes.items():
        free = n - reserved.get(k, 0)
        out[k] = min(int(n * ratio), free) if free > 0 else 0
        rem.append((n * ratio - out[k] if free > 0 else 0.0, k))
    for _, k in sorted(rem, key=lambda x: (-x[0], x[1])):
        if sum(out.values()) < target and sizes[k] - reserved.get(k, 0) - out[k] > 0:
            out[k] += 1
    for k in sorted(sizes, key=lambda k: (-sizes[k], k)):
        while sum(out.values()) < target and sizes[k] - reserved.get(k, 0) - out[k] > 0:
            out[k] += 1
    return out


@pytest.mark.parametrize("sizes,target,ratio,reserved", [
    ({"a": 60, "b": 40}, 10, 0.1, {}), ({"a": 7, "b": 7, "c": 7}, 2, 0.1, {}), ({"a": 10, "b": 3, "c": 1}, 9, 0.1, {"a": 1, "b": 3}), ({"a": 5, "b": 5}, 8, 0.5, {"a": 2}),
])
def test_allocation(spark, sizes, target, ratio, reserved):
    df = spark.createDataFrame([(k, n, reserved.get(k, 0)) for k, n in sizes.items()], "source_id string, n bigint, used bigint")
    got = {r["source_id"]: r["allocated"] for r in split.allocate(df, target, ratio, reserved="used").collect()}
    assert got == py_allocate(sizes, target, ratio, reserved)


def test_allocation_out_of_reach(spark):
    with pytest.raises(Exception, match="cannot be allocated"):
        split.allocate(spark.createDataFrame([("a", 2)], "source_id string, n bigint"), 3, 0.1).collect()


def final_rows(spark, n_a, n_b, **other):
    row = {"language": "mostly_ascii", "domain": "fitness-coaching-adjacent"} | other
    rows = [(str(i), "a" if i < n_a else "b", row["language"], row["domain"], row.get("h") or f"h{i}") for i in range(n_a + n_b)]
    return spark.createDataFrame(rows, "record_id string, source_id string, language string, domain string, normalized_sha256 string")


@pytest.mark.parametrize("a,b,other,failed", [
    (4, 2, {}, set()), (4, 2, {"language": "majority_non_ascii"}, {"mostly_ascii_share", "majority_non_ascii_share"}), (8, 2, {}, {"largest_source_share"}),
    (4, 2, {"h": "same"}, {"exact_duplicate_rate"}), (4, 2, {"domain": "off-domain"}, {"off_domain_share"}),
])
def test_audit(spark, a, b, other, failed):
    c = audit.checks(final_rows(spark, a, b, **other))
    assert {r["check"] for r in c.collect() if r["status"] == "FAIL"} == failed
    verdict = audit.blockers(c).first()
    assert verdict["verdict"] == ("NO GO" if failed else "GO") and verdict["blockers"] == "; ".join(sorted(failed))


def test_audit_without_digests(spark):
    c = audit.checks(final_rows(spark, 4, 2).withColumn("normalized_sha256", F.lit(" ")))
    assert c.filter("check = 'exact_duplicate_rate'").first()["status"] == "UNVERIFIED"


def test_spot_check(spark):
    m = chat(("user", "u"), ("assistant", "a"))
    base = spark.createDataFrame([("good", m, 0), ("bad", m, 1), ("long", chat(("user", "u"), ("assistant", "w " * 30)), 0)], f"record_id string, conversations {MESSAGES}, k int")
    df = base.withColumn("text", F.concat(compose.render(F.col("conversations")), F.when(F.col("k") == 1, "drift").otherwise("")))
    out = split.spot_check(df, 50, 20).first()
    assert (out["malformed"], out["over_length"], out["status"]) == (1, 1, "FAIL") and out["truncation_rate"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("memory,status", [([50, 25, 25], "FAIL"), ([40, 30, 30], "PASS")])
def test_gates(spark, memory, status):
    stats = spark.createDataFrame([(1.0, 0.0, 0.0, 0.0)], "validator_pass_rate double, duplicate_rate double, persona_deviation double, scenario_deviation double")
    rows = audit.gates(stats, spark.createDataFrame([(str(i), n) for i, n in enumerate(memory)], "label string, n bigint")).collect()
    assert {r["gate"]: r["status"] for r in rows}["memory_share"] == status
    assert audit.max_deviation(spark.createDataFrame([("a", 3), ("b", 1)], "label string, n bigint"), spark.createDataFrame([("a", 1), ("c", 1)], "label string, n bigint")).first()[0] == 0.5


# --- events --------------------------------------------------------------------------------


def some_events(spark):
    rows = [("1", "u", "weight", "2024-01-01", '{"kg": 80}'), ("2", "u", "weight", "2024-01-03", '{"kg": 79}'), ("3", "u", "injury", "2024-01-02", '{"area": "Left Shoulder", "notes": null}'),
            ("4", "v", "injury", "2024-01-04", '{"area": "shoulder"}'), ("5", "u", "weight", "2024-01-03", '{"kg": 78}')]
    return spark.createDataFrame(rows, "event_id string, user_id string, event_type string, d string, payload_json string").withColumn("timestamp", F.col("d").cast("timestamp")).drop("d")


def test_events(spark):
    log = some_events(spark)
    ids = lambda df: [r["event_id"] for r in df.collect()]
    assert ids(ev.listing(log, user="u")) == ["5", "2", "3", "1"]
    assert ids(ev.latest(log.filter("user_id = 'u' AND event_type = 'weight'"), ["event_type"])) == ["5"]
    words = ev.payload_text(F.col("payload_json"))
    assert ids(ev.search(log, "Shoulder", words, user="u")) == ["3"]
    assert ids(ev.search(log, '"left shoulder"', words)) == ["3"] and ids(ev.search(log, "should*", words)) == ["4", "3"]
    with pytest.raises(ValueError):
        ev.search(log, "a OR", words)
    sup = spark.createDataFrame([("2", "5", 1), ("5", "9", 1), ("5", None, 0)], "event_id string, superseded_by string, at int")
    assert ids(ev.current_state(ev.with_superseded(log, sup).filter("user_id = 'u'"), ["event_type"]).orderBy("event_id")) == ["1", "3"]
    with pytest.raises(Exception, match="duplicate event_id"):
        ev.append(log, log.limit(1)).collect()
    nested = log.limit(1).select(ev.nested_payload_text(F.lit('{"a": {"b": [1, "x", null]}, "c": true}'))).first()[0]
    assert nested == "1 x True"


# --- deduplication ---------------------------------------------------------------------------


def test_dedup_kinds(spark):
    base = "the quick brown fox jumps over the lazy dog again and again until the evening comes"
    rows = [(1, "b", base), (2, "b", base + " today"), (3, "b", base), (4, "c", base + " now"), (5, "b", "Same. Same. Same."), (6, "b", None)]
    df = spark.createDataFrame(rows, "id long, bucket string, text string")
    digest = df.withColumn("h", F.sha2(t.fold(F.coalesce("text", F.lit(""))), 256))
    assert [r["id"] for r in dedup.exact(digest, "h", ["id"]).filter("is_exact_duplicate").collect()] == [3]
    assert [r["id"] for r in dedup.repetitive(df, "text").filter("is_repetitive").collect()] == [5]
    near = {r["id"]: r["near_key"] for r in dedup.near_sequence(df, "bucket", "text", "id").collect()}
    assert near == {1: None, 2: 1, 3: 1, 4: None, 5: None, 6: None}
    links = {r["id"]: (r["class_id"], r["links"]) for r in dedup.near_links(df, "bucket", "text", "id", 0.9).collect()}
    assert links == {1: (1, 2), 2: (2, 2), 3: (1, 2), 4: (4, 0), 5: (5, 0), 6: (6, 0)}
    over = lambda counts: [r["id"] for r in dedup.opening_cap(df.na.drop(), "text", ["id"], 1, counts).filter("over_cap").collect()]
    assert over(None) == [3] and over(F.col("id") != 1) == []


# --- evaluation, rubric, research ------------------------------------------------------------


def test_response_scores(spark):
    schema = "model string, category string, response string, groups array<array<string>>, accepted array<string>, rejected array<string>"
    rows = [
        ("m", "memory_usage", "At 82kg while cutting", [["82", "82kg"], ["cut"]], [], []),
        ("m", "memory_usage", "current_weight_kg: 82, cutting", [["82"], ["cut"]], [], []),
        ("m", "personalization_quality", "cutting", [["82"], ["cut"]], [], []),
        ("m", "scientific_accuracy", "a moderate deficit with protein", [], ["moderate deficit", "sleep"], ["starv"]),
        ("m", "scientific_accuracy", "starve yourself, moderate deficit", [], ["moderate deficit"], ["starv"]),
        ("m", "other", "x", [], [], []),
    ]
    got = [r["score"] for r in evaluate.score_responses(spark.createDataFrame(rows, schema)).collect()]
    assert got == [1.0, 0.5, 0.5, 0.5, 0.0, 0.0]


def rubric_row(spark, response, **change):
    row = dict(
        response=response, final_user="My knee pain is back", domain_score=1.0, facts=["knee stiffness", "two sessions"], constraints=["knee stiffness"], keywords=["pain", "modify", "range", "assessment"],
        references=[(["knee stiffness"], "use")], principles=2, follow_ups=2, required_follow_ups=1, scenario_follow_ups=2, no_emotional_objectives=False, has_adaptation_summary=True, stress="low",
        sleep_hours=7.0, must_use_memory=True, injury_domain=True, has_injury=True,
    ) | change
    schema = ("response string, final_user string, domain_score double, facts array<string>, constraints array<string>, keywords array<string>, references array<struct<facts:array<string>,mode:string>>, principles long, "
              "follow_ups long, required_follow_ups long, scenario_follow_ups long, no_emotional_objectives boolean, has_adaptation_summary boolean, stress string, sleep_hours double, must_use_memory boolean, injury_domain boolean, has_injury boolean")  # fmt: skip
    return rubric.rubric(rubric.validators(spark.createDataFrame([tuple(row.values())], schema), STOCK)).first()


def test_rubric(spark):
    good = rubric_row(spark, "That makes sense with your knee stiffness. Let's modify the range and keep two sessions of 3 sets this week. We can start an assessment when pain eases. How does it feel today? What time suits you?")
    assert good["passed"] and good["blockers"] == [] and good["overall_score"] > 0.75
    bad = rubric_row(spark, "I guarantee this will cure everything, always.", follow_ups=0, principles=0)
    failed = " ".join(bad["blockers"])
    assert not bad["passed"] and all(v in failed for v in ("scientific_consistency", "hallucination_detection", "follow_up_questioning"))


def test_research(spark):
    df = spark.createDataFrame([("EQ-Bench score: 63.5", "fitness and the AI of fitness plans to go"), ("eq bench 0.4", "x")], "a string, q string")
    assert [r[0] for r in df.select(r.eq_score(F.col("a"))).collect()] == [0.635, 0.4]
    assert df.select(r.query_terms(F.col("q"))).first()[0] == "all:fitness AND all:and AND all:the AND all:plans"
    payload = '{"results":{"leaderboard":{"inst_level_strict_acc,none":0.5},"leaderboard_bbh":{"acc_norm,none":0.25}}}'
    got = df.limit(1).select(*[v.alias(k) for k, v in r.leaderboard_metrics(F.lit(payload)).items()]).first()
    assert (got["ifeval_strict"], got["bbh"], got["gpqa"]) == (0.5, 0.25, None)
    assert df.limit(1).select(r.next_number(F.lit("## Decision 1: a\n## Decision 12: b\n"))).first()[0] == 13


# --- planning, training, streaming -----------------------------------------------------------


def test_plan(spark):
    plan = planner.candidate_plan(spark, 48, 20260710)
    assert plan.count() == 48 and plan.collect() == planner.candidate_plan(spark, 48, 20260710).collect()
    assert plan.groupBy("scenario_id").count().agg(F.min("count"), F.max("count")).first() == (4, 4)
    judged = planner.accept(planner.generate(plan), 48, F.lit(True))
    assert judged.filter("rejection IS NULL").count() > 0 and planner.rates(judged).first()["candidates"] == 48
    with pytest.raises(Exception, match="unknown persona_id"):
        dim.lookup(plan.withColumn("persona_id", F.lit("nobody")), dim.personas(spark), "persona_id").collect()
    with pytest.raises(ValueError):
        dim.require(dim.personas(spark), "persona_id", ["nobody"])


def test_staging_resumes(spark, tmp_path):
    path = str(tmp_path / "staged")
    first = planner.Staging(spark, path, 7, 20)
    assert first.run(batch_size=6, max_batches=2) == 12
    assert planner.Staging(spark, path, 7, 20).run(batch_size=6) == 20
    rows = spark.read.parquet(path)
    assert rows.count() == 20 and rows.select("slot").distinct().count() == 20
    with pytest.raises(ValueError, match="another seed"):
        planner.Staging(spark, path, 8, 20).next_slot()


def test_training(spark):
    m = chat(("user", "u"), ("assistant", "a"))
    base = spark.createDataFrame([(f"r{i}", "s", "mostly_ascii", "d", m) for i in range(6)], f"record_id string, source_id string, language string, domain string, conversations {MESSAGES}")
    df = base.withColumn("text", compose.render(F.col("conversations")))
    train, validation = training.load(df, None, 0.25, 42)
    assert (train.count(), validation.count()) == (4, 2)
    drift = df.withColumn("text", F.when(F.col("record_id") == "r1", "x").otherwise(F.col("text")))
    with pytest.raises(training.DatasetError, match="train.jsonl:r1"):
        training.validated(drift, F.concat(F.lit("train.jsonl:"), F.col("record_id")))
    with pytest.raises(Exception, match="text_differs_from_template"):
        training.failing_fast(drift).collect()
    with pytest.raises(ValueError):
        order.holdout(df.limit(1), 0.5, 1, "record_id")
    with pytest.raises(Exception, match="no tokens"):
        training.tokenize(df, F.array().cast("array<int>")).collect()


def test_streams_go_on_where_they_ended(spark, tmp_path):
    source, area = tmp_path / "in", tmp_path / "out"
    for k in range(2):
        spark.createDataFrame([(i, f"h{i % 3}") for i in range(4 * (k + 1))], "id long, h string").coalesce(1).write.mode("append").parquet(str(source))
        table = ingest.ingest_events(spark, str(source), "id long, h string", f"{area}/t", f"{area}/c")
    assert table.count() == 12
    ingest.run_available(ingest.dedup_stream(ingest.stream_files(spark, str(source), "id long, h string"), "h"), f"{area}/d", f"{area}/dc")
    assert spark.read.parquet(f"{area}/d").count() == 3


# --- rules of generated conversations --------------------------------------------------------


def test_profile_rules(spark):
    both = dim.personas(spark).crossJoin(dim.scenarios(spark))
    rows = {(r["persona_id"], r["scenario_id"]): r for r in profile.profiles(both).collect()}
    student = rows["student_beginner_exam_stress", "exam_stress_adjustment"]
    assert (student["goal_domain"], student["sleep_hours"], student["constraints"]) == ("adherence", 5.8, [profile.EXAMS, "stress", "sleep"])
    assert rows["retiree_general_fitness", "travel_continuity"]["equipment"] == profile.HOTEL
    assert rows[profile.RECOMPOSITION, "plateau_review"]["goal_domain"] == "body_recomposition"
    assert rows["competition_prep_advanced", "injury_recovery_adjustment"]["injuries"] == [profile.SCENARIO_INJURY]
    df = spark.createDataFrame([("sleep_pattern_changed",), ("goal_set",)], "e string")
    none = F.array().cast("array<string>")
    fact = profile.memory_fact(F.col("e"), F.lit("run"), none, none, F.lit(5.5))
    assert [r[0] for r in df.select(fact).collect()] == ["averaging 5.5 hours of sleep", "run"]
    with pytest.raises(Exception, match="no memory rule"):
        df.select(profile.memory_fact(F.lit("diet_changed"), F.lit(""), none, none, F.lit(1.0))).collect()
    assert df.limit(1).select(profile.rotated(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.lit(5), F.lit(2))).first()[0] == ["c", "a"]


@pytest.mark.parametrize("roles,memory,follow,want", [
    ("user", 1, 1, None), ("", 1, 1, "history_is_empty"), ("assistant user", 1, 1, "history_must_start_with_user"), ("user assistant", 1, 1, "history_must_end_with_user"),
    ("user user", 1, 1, "history_must_alternate"), ("user system user", 1, 1, "history_holds_system"), ("user", 0, 1, "memory_is_missing"), ("user", 1, 0, "too_few_follow_ups"),
])
def test_conversation_rules(spark, roles, memory, follow, want):
    df = spark.createDataFrame([([(x, "hi") for x in roles.split()], ["m"] * memory, ["q"] * follow)], f"h {MESSAGES}, m array<string>, f array<string>")
    error = profile.conversation_error(F.col("h"), F.lit("s"), F.lit("s"), F.lit(True), F.col("m"), F.col("f"), F.lit(1))
    assert df.select(error).first()[0] == want


def test_settings_and_estimates(spark):
    for bad in ({"train_ratio": 0.8}, {"holdout_ratio": 1.0}, {"fp16": True, "bf16": True}, {"eval_steps": 5}, {"patience": 0}):
        with pytest.raises(ValueError):
            profile.Settings(**bad)
    low, high = profile.runtime_hours(F.lit(24_463), F.lit(450.22))
    df = spark.range(1)
    assert tuple(df.select(low, high).first()) == (3.4, 5.1)
    made = planner.generate(planner.candidate_plan(spark, 12, 1))
    sizes = {r["scenario_id"]: len(r["messages"]) for r in made.collect()}
    # Three or five turns and the answer; an onboarding begins with the question alone.
    assert sizes.pop("beginner_onboarding") == 2 and set(sizes.values()) <= {4, 6}
    assert profile.pilot_statistics(made).first()["avg_messages"] == round((2 + sum(sizes.values())) / 12, 2)
    assert df.select(r.relevance(F.lit("event memory"), F.lit(""))).first()[0].startswith("continuity")


@pytest.mark.parametrize("bits", [1, 18])
def test_near_jaccard_shuffles_prefixes_alone_and_loses_no_pair(spark, monkeypatch, bits):
    """Whatever words share a cell of the counts, every pair is found."""
    import random

    monkeypatch.setattr(dedup, "CELL_BITS", bits)
    rng = random.Random(2)
    base = [{f"w{rng.randrange(80)}" for _ in range(rng.randrange(1, 40))} for _ in range(12)]
    sets = [s ^ {f"w{rng.randrange(80)}" for _ in range(rng.randrange(3))} or {"x"} for s in base for _ in range(6)]
    rows = [(i, f"g{i % 2}", sorted(s)) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "k long, g string, w array<string>")
    got = {(r["a"], r["b"]) for r in dedup.near_jaccard(df, "g", "w", "k", 0.8).collect()}
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and i % 2 == j % 2 and len(a & b) >= 0.8 * len(a | b)}
    assert want and got == want


def _word_sets():
    """Of long and short sets, near ones, far ones that share their rarest word, and copies."""
    import random

    rng = random.Random(5)
    common = [f"c{i}" for i in range(900)]
    texts = []
    for n in (1, 3, 30, 250, 262, 520):
        base = rng.sample(common, n - 1) + [f"rare{n}"]
        for _ in range(12):
            own = [w for w in base if w[0] == "r" or rng.random() > 0.03] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1 + n // 40))]
            texts.append(" ".join(own))
        texts += [" ".join(rng.sample(common, n - 1) + [f"rare{n}"]) for _ in range(4)] + texts[-2:]
    return texts


@pytest.mark.parametrize("tile", [1 << 17, 5])
def test_near_links_ships_no_words_and_counts_every_link(spark, monkeypatch, tile):
    """Same links however many tiles the pairs are dealt to; what is written and shuffled holds no words."""
    monkeypatch.setattr(dedup, "TILE", tile)
    texts = _word_sets()
    written = []
    keep = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, label: written.append(df.schema.simpleString()) or keep(df, label))
    df = spark.createDataFrame([(i, f"g{i % 2}", x) for i, x in enumerate(texts)], "id long, bucket string, text string")
    got = {r["id"]: (r["links"], r["nearest"]) for r in dedup.near_links(df, "bucket", "text", "id").collect()}
    sets = [set(x.split(" ")) for x in texts]
    want = {}
    for i, a in enumerate(sets):
        near = [x for j, b in enumerate(sets) if i != j and i % 2 == j % 2 and (x := len(a & b) / len(a | b)) >= dedup.NEAR]
        want[i] = (len(near), max(near, default=None))
    assert got == want and any(x and x < 1 for _, x in want.values())
    assert not any("array<string>" in x for x in written)
