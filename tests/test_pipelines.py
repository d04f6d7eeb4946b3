"""The stages end to end, from files to files."""

import json
import re

import pytest
from pyspark.sql import functions as F

import millrace
from millrace import cli
from millrace.functions import text as t
from millrace.functions.lexicon import STOCK
from millrace.operators import evaluate, training
from millrace.plans.catalog import ORACLE_SQL, QUERIES
from millrace.sources import corpora, sinks

ASK = "My knee pain is back and I feel worried about the plan for week {}."
TELL = "That makes sense, and I hear you. Let's keep {} sets of 8 reps and track protein; we can adjust the plan when your sleep gets better. How does it feel?"


def raw(root, n=260):
    """A manifest over JSON lines of sound and broken records, with an approved report beside it."""
    rows = [{"messages": [{"role": "user", "content": ASK.format(i)}, {"role": "assistant", "content": TELL.format(i)}]} for i in range(n)]
    rows += [{"messages": [{"role": "user", "content": "alone"}]}, ["no object"], {"instruction": "what?", "output": ""}]
    (root / "raw").mkdir()
    (root / "raw/part.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (root / "raw/notes.txt").write_text("x")
    entry = {"id": "org/coach", "license": "mit", "files": [{"path": f"{root}/raw/part.jsonl"}, {"path": f"{root}/raw/notes.txt"}]}
    (root / "raw.json").write_text(json.dumps({"datasets": [entry]}))
    return str(root / "raw.json")


def body(path):
    return json.loads(open(path).read())


def test_clean_score_final(spark, tmp_path):
    at = lambda x: str(tmp_path / x)
    cli.run(["clean", "--raw-manifest", raw(tmp_path), "--output-path", at("clean"), "--report-path", at("clean.json")], spark)
    report = body(at("clean.json"))
    assert report["totals"]["kept_records"] == 260 and report["totals"]["rejected_records"] == 3
    reasons = {c["label"]: c["n"] for c in report["counters"] if c["counter"] == "rejection_reason"}
    assert reasons == {"too_few_messages": 1, "record_not_object": 1, "unable_to_extract_conversation": 1}
    assert (report["files"][0]["processed_files"], report["files"][0]["skipped_files"]) == (1, 1)
    cli.run(["score", "--cleaned-dataset", at("clean"), "--output-path", at("scored"), "--report-path", at("score.json")], spark)
    assert body(at("score.json"))["report"]["passing"] == 260
    made = cli.run(["final", "--scored-dataset", at("scored"), "--root", at("final"), "--least", "100", "10", "12"], spark)
    sizes = {k: sinks.record_count(spark, made[k]) for k in ("dataset", "train", "val", "test")}
    assert sizes == {"dataset": 260, "train": 260 - 13 - 13, "val": 13, "test": 13}
    manifest = body(made["manifest"])
    assert manifest["splits"]["val"]["sample_count"] == 13 and re.fullmatch("[0-9a-f]{64}", manifest["final_dataset"]["sha256"])
    assert {c["check"] for c in body(made["audit"])["checks"]} >= {"off_domain_share", "exact_duplicate_rate"}
    assert "- Total records: 260" in open(made["card"]).read() and "verdict" in open(made["readiness"]).read()
    again = spark.read.json(made["dataset"])
    assert not training.record_error(again) is None and training.malformed(again).isEmpty()


def test_nothing_kept_is_an_error(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"messages": []}')
    (tmp_path / "m.json").write_text(json.dumps({"datasets": [{"id": "a", "license": None, "files": [{"path": f"{tmp_path}/x.jsonl"}]}]}))
    with pytest.raises(RuntimeError, match="no record was kept"):
        millrace.clean_corpus(spark, str(tmp_path / "m.json"), str(tmp_path / "out"), str(tmp_path / "r.json"))
    assert (tmp_path / "r.json").exists()


def test_production_corpus_stops_resumes_and_packages(spark, tmp_path):
    root = str(tmp_path / "corpus")
    first = cli.run(["synthetic", "--root", root, "--target-count", "12", "--batch-size", "5", "--max-batches", "1"], spark)
    assert set(first) == {"staging", "rejections"} and spark.read.parquet(first["staging"]).count() == 5
    made = cli.run(["synthetic", "--root", root, "--target-count", "12", "--batch-size", "5"], spark)
    rows = spark.read.json(made["train"])
    assert rows.count() == 12 and rows.select("record_id").distinct().count() == 12
    r = rows.orderBy("record_id").first()
    assert r["factory_metadata"]["target"] == 12 and r["synthetic_metadata"]["memory"][0]["fact"] and r["text"].startswith("<|im_start|>system")
    stats, manifest = body(made["statistics"]), body(made["manifest"])
    assert stats["sample_count"] == 12 and stats["validator_pass_rate"] == 1.0 and len(stats["content_sha256"]) == 64
    assert set(manifest["artifacts"]) == {"train", "statistics", "card", "report"} and len(manifest["distributions"]) == 8
    assert "Quality gates" in open(made["report"]).read()


def test_staging_that_lacks_rows_is_an_error(spark, tmp_path):
    from millrace.plans import planner

    path = str(tmp_path / "staged")
    staged = planner.Staging(spark, path, 5, 8)
    assert staged.counters()["accepted"] == 0
    staged.run(batch_size=3, max_batches=2)
    done = staged.counters()
    assert done["accepted"] == 6 and done["next_candidate"] == 6 + done["rejected"]
    rows = spark.read.parquet(path)
    rows.filter("slot <> 2").write.parquet(f"{path}-2")
    with pytest.raises(ValueError, match="slots"):
        planner.Staging(spark, f"{path}-2", 5, 8).next_slot()
    rows.withColumn("candidate", F.col("candidate") + 1).write.parquet(f"{path}-3")
    with pytest.raises(ValueError, match="candidates"):
        planner.Staging(spark, f"{path}-3", 5, 8).next_slot()


def test_a_failed_gate_stops_the_export(spark, tmp_path, monkeypatch):
    from millrace.operators import audit

    monkeypatch.setitem(audit.GATES, "memory_share", 0.0)
    with pytest.raises(RuntimeError, match="gates failed: .*memory_share"):
        millrace.generate(spark, str(tmp_path), 4, 3)
    assert (tmp_path / "report.md").exists() and not (tmp_path / "train").exists()


def test_pilot_and_arguments(spark, tmp_path):
    made = millrace.pilot(spark, str(tmp_path), 10)
    assert sinks.record_count(spark, made["dataset"]) == 10 and "avg_messages" in open(made["report"]).read()
    with pytest.raises(ValueError, match="batch controls"):
        cli.run(["synthetic", "--root", "x", "--pilot", "--batch-size", "3"], spark)


def test_download_statuses(spark, tmp_path):
    (tmp_path / "ok.json").write_text(json.dumps({"generated_at": "t", "approved": [{"id": "org/a", "license": "mit"}, {"id": "b", "license": "mit"}]}))
    args = ["download", "--approved-report", str(tmp_path / "ok.json"), "--raw-dir", str(tmp_path / "raw"), "--manifest", str(tmp_path / "m.json"), "--dataset-id", "b"]

    def fetch(dataset, directory, force):
        sinks.write_text(spark, f"{directory}/{dataset}.csv", "a\n1\n")

    for more, status in ((["--dry-run"], "planned"), ([], "downloaded"), ([], "reused_existing"), (["--force"], "downloaded")):
        cli.run([*args, *more], spark, fetch)
        (d,) = body(tmp_path / "m.json")["datasets"]
        assert (d["id"], d["status"], d["file_count"]) == ("b", status, int(status != "planned"))
    (tmp_path / "bad.json").write_text('{"approved": 3}')
    with pytest.raises(ValueError, match="malformed"):
        corpora.approved(spark, str(tmp_path / "bad.json"))


def test_fetching():
    class Reply:
        def __init__(self, text):
            self.text = text

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read(self):
            return self.text.encode()

    assert corpora.fetch_json("u", opener=lambda url, timeout: Reply('{"a": 1}')) == {"a": 1}
    with pytest.raises(corpora.FetchError):
        corpora.fetch_json("u", opener=lambda url, timeout: Reply("no json"))
    with pytest.raises(corpora.FetchError):
        corpora.fetch_text("u", opener=lambda url, timeout: 1 / 0)
    assert corpora.search_url("b", "AI and the memory", 5, phrase=False) == "b?search_query=all%3Aand%20AND%20all%3Athe%20AND%20all%3Amemory&start=0&max_results=5&sortBy=submittedDate&sortOrder=descending"
    assert corpora.quoted("org/a b") == "org/a%20b"


def test_base_model(spark, tmp_path):
    chosen, log = str(tmp_path / "c.json"), str(tmp_path / "d.md")
    assert millrace.base_model(spark, chosen, log, "default") == "default"
    (tmp_path / "d.md").write_text("Selected base model: `a/b`\nSelected base model: `c/d`\n")
    assert millrace.base_model(spark, chosen, log, "default") == "c/d"
    (tmp_path / "c.json").write_text('{"model_id": "e/f"}')
    assert millrace.base_model(spark, chosen, log, "default") == "e/f"


def test_evaluation_run_skips_failing_models(spark):
    schema = "category string, groups array<array<string>>, accepted array<string>, rejected array<string>"
    prompts = spark.createDataFrame([("memory_usage", [["82"]], [], []), ("scientific_accuracy", [], ["sleep"], [])], schema)

    def respond(model, rows):
        if model == "broken":
            return rows.withColumn("response", F.raise_error(F.lit("no answer")).cast("string"))
        return rows.withColumn("response", F.lit("82 kg and sleep" if model == "good" else "nothing"))

    ranked, failed = evaluate.run(["poor", "broken", "good"], prompts, respond)
    assert [r["model"] for r in ranked.collect()] == ["good", "poor"] and set(failed) == {"broken"}
    with pytest.raises(RuntimeError, match="no model"):
        evaluate.run(["broken"], prompts, respond)


def test_stock_patterns_equal_those_of_unicode_engines(spark):
    """The two patterns under Java's engine against Python's, on texts with white space and digits of Unicode."""
    import random

    rng = random.Random(6)
    alphabet = ["1", "\uff13", "\u0663", " ", "\u00a0", "\u3000", "\n", "\t", "\x1c", "kg", "KG", "reps", "g", "\u7ec4", "-", "*", ".", ")", "\u3001", "a"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(9))) for _ in range(3000)]
    from millrace.functions import text as t

    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = df.select("i", F.rlike("x", F.lit(t.unicode_regex(STOCK.unit_regex))).alias("u"), F.rlike("x", F.lit(t.unicode_regex(STOCK.list_regex, "md"))).alias("l"))
    unit, lists = re.compile(STOCK.unit_regex, re.I), re.compile(STOCK.list_regex, re.M)
    wrong = [(texts[r["i"]], r["u"], r["l"]) for r in got.collect() if (r["u"], r["l"]) != (bool(unit.search(texts[r["i"]])), bool(lists.search(texts[r["i"]])))]
    assert not wrong, wrong[:5]


def test_full_text_queries_equal_those_of_sqlite(spark):
    """The same queries in SQLite's full-text engine."""
    import random
    import sqlite3

    from millrace.operators import events

    rng = random.Random(3)
    words = "alpha beta gamma delta alphabet Gamm\u00e9 x1 beta".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 14)))) for i in range(150)]
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE t USING fts5(x)")
    db.executemany("INSERT INTO t(rowid, x) VALUES (?, ?)", rows)
    df = spark.createDataFrame(rows, "event_id long, x string").withColumn("w", events.tokens(F.col("x")))
    queries = [
        "alpha beta", "alpha OR x1", "alpha AND NOT_A", "alpha NOT beta", "alpha NOT beta NOT gamma", "alpha OR beta AND gamma", "(alpha OR beta) AND gamma", "(alpha OR x1) AND delta",
        '"alpha beta"', "alpha + beta", "alph*", '"beta alph"*', "gamme", "^beta", "^beta gamma", "NEAR(alpha gamma)", "NEAR(alpha gamma, 1)", 'NEAR("alpha beta" delta, 2)', "NEAR(alpha beta gamma, 3)",
        "x1 NOT (alpha OR beta)", "alpha beta NOT gamma", "delta AND beta NOT alpha OR x1",
    ]
    for q in queries:
        want = {r[0] for r in db.execute("SELECT rowid FROM t WHERE t MATCH ?", (q,))}
        got = {r["event_id"] for r in df.filter(events.matches(F.col("w"), q)).collect()}
        assert got == want, q
    for q in ("", "(alpha", "alpha )", "x:alpha", "OR alpha", "+"):
        with pytest.raises(ValueError):
            events.matches(F.col("w"), q)


def test_updates_of_a_stream_that_goes_on(spark, tmp_path):
    """Windows of two runs: late rows change what was written before, and the newest state counts."""
    from millrace.streaming import ingest

    def run(rows):
        spark.createDataFrame(rows, "ts timestamp, event_type string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = ingest.stream_files(spark, str(tmp_path / "in"), "ts timestamp, event_type string")
        ingest.run_updates(ingest.windowed_counts(stream, "ts"), str(tmp_path / "out"), str(tmp_path / "check"))
        found = ingest.newest(spark, str(tmp_path / "out"), ["window_start", "event_type"])
        return {(r["window_start"].day, r["event_type"]): r["n"] for r in found.collect()}

    from datetime import datetime as at

    assert run([(at(2024, 1, 1, 5), "a"), (at(2024, 1, 2, 5), "a")]) == {(1, "a"): 1, (2, "a"): 1}
    assert run([(at(2024, 1, 2, 6), "a"), (at(2024, 1, 2, 7), "b")]) == {(1, "a"): 1, (2, "a"): 2, (2, "b"): 1}


# --- tables of several files, larger logs, texts that two engines read in two ways -----------


def duck(name, **tables):
    """Rows of the query's SQL on the tables."""
    import duckdb

    con = duckdb.connect()
    for table, path in tables.items():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return sorted(con.execute(ORACLE_SQL[name]).fetchall())


def test_edges_of_words_are_those_of_the_sql(spark, tmp_path):
    texts = ["cias miódo it makes sense", "miodo it makes sense", "éfeel do", "feelé do", "do_ it feel", "kaffee", "", None]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(8 * i, x) for i, x in enumerate(texts)], "doc_id long, text string").write.parquet(path)
    got = sorted(map(tuple, QUERIES["score_emotional_ack"](spark, str(tmp_path)).collect()))
    assert got == duck("score_emotional_ack", documents=path)
    assert [a for _, a in got] == [0.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0]


def test_letters_of_two_cases_are_those_of_the_sql(spark, tmp_path):
    texts = ["\u0130 hear you", "\u0131 hear you", "I HEAR YOU", "ma\u212aes \u017fense", "u\u017fe it, feel", "\u017ftart feel", "feel \u017ftart", "\u0130'd feel", "\u039f\u03a3 feel"]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(8 * i, x) for i, x in enumerate(texts)], "doc_id long, text string").write.parquet(path)
    got = sorted(map(tuple, QUERIES["score_emotional_ack"](spark, str(tmp_path)).collect()))
    assert got == duck("score_emotional_ack", documents=path)
    assert [a for _, a in got] == [1.0, 0.0, 1.0, 1.0, 0.0, 1.0, 1.0, 0.0, 1.0]
    assert spark.range(1).select(t.fold(F.lit(" \u0130S \u039f\u03a3 "))).first()[0] == "is \u03bf\u03c3"


def test_leftmost_matches_are_those_of_the_sql(spark, tmp_path):
    words = ["feel", "that's", "that is", "I hear you", "\u017founds like", "sounds like", "do", "let's", "you \u017fhould", "\u017ftart", "x", "\u00e9", "\u0130", "\u212aeep", "_", "1"]
    joints = [" ", "", "\u00e9", "\u017f", "-", "_", "'", "\u00a0", "\U0001f926", "\u0301", "x " * 47, "x " * 49, "x " * 51]
    texts = [a + j + b + k for a in words for b in words for j in joints for k in ("", "\u017f", "x do")]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(8 * i, x) for i, x in enumerate(texts)], "doc_id long, text string").write.parquet(path)
    got = sorted(map(tuple, QUERIES["score_emotional_ack"](spark, str(tmp_path)).collect()))
    assert got == duck("score_emotional_ack", documents=path)
    assert 0 < sum(a for _, a in got) < len(texts)


def test_streams_read_a_table_that_is_a_folder(spark, sf, tmp_path):
    for name in ("events", "documents"):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("stream_dedup", "stream_event_ingest", "stream_windowed_counts"):
        assert sorted(QUERIES[name](spark, str(tmp_path)).collect()) == sorted(QUERIES[name](spark, sf).collect())


def test_entities_without_semicolon_stay_as_in_the_sql(spark, tmp_path):
    pages = ["a&amp<p>b</p> &amp; c", "x &lt;b&gt; &copy;&nbsp; y&middot", "&ampamp; &amp;amp; &#39;q&quot; &", "", None]
    path = f"{tmp_path}/pages.parquet"
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(path)
    got = sorted(map(tuple, QUERIES["research_strip_html"](spark, str(tmp_path)).collect()))
    assert got == duck("research_strip_html", pages=path)
    plain, closed = spark.range(1).select(t.strip_html(F.lit("a&amp b &eacute;")), t.strip_html(F.lit("a&amp b &eacute;"), closed=True)).first()
    assert (plain, closed) == ("a& b é", "a&amp b é")


def test_a_log_that_has_the_new_identifiers(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    path = f"{tmp_path}/events.parquet"
    events.union(events.filter("event_id < 30").withColumn("event_id", F.col("event_id") + 1_000_000)).write.parquet(path)
    got = [tuple(r) for r in QUERIES["events_append"](spark, str(tmp_path)).collect()]
    assert got == duck("events_append", events=path) == [(events.count() + 80, events.count() + 50)]
