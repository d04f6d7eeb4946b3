
import math
import random
from difflib import SequenceMatcher

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.functions import scoring as s
from millrace.operators import dedup
from millrace.plans import planner
from millrace.plans.catalog import QUERIES
from millrace.plans.studies import _names


def test_perplexity_is_clamped_and_null_safe(spark):
    losses = {0: 0.0, 1: 19.5, 2: 20.0, 3: 560.21, 4: None}
    df = spark.createDataFrame(list(losses.items()), "id int, loss double")
    got = {r["id"]: r["p"] for r in df.select("id", s.perplexity(F.col("loss")).alias("p")).collect()}
    assert got == {i: None if x is None else round(math.exp(min(x, 20.0)), 6) for i, x in losses.items()}


def test_perplexity_covers_every_event(spark, sf):
    """Within one unit of the sixth decimal, where engines differ near exp(20)."""
    sql = f"SELECT event_id, CASE WHEN value IS NOT NULL THEN round(exp(least(value, 20.0::DOUBLE)), 6) END FROM '{sf}/events.parquet'"
    want = dict(duckdb.execute(sql).fetchall())
    got = {r["event_id"]: r["p"] for r in spark.read.parquet(f"{sf}/events.parquet").select("event_id", s.perplexity(F.col("value")).alias("p")).collect()}
    assert {r["event_id"] for r in QUERIES["train_perplexity"](spark, sf).collect()} == set(want)
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 2e-6 for i in want)
    assert max(got.values()) == round(math.exp(20.0), 6)


def candidate(slot, text, persona="p", scenario="s"):
    return slot, persona, scenario, text, [("user", f"question {slot} {'abcdefghij'[slot % 10] * 9}"), ("assistant", text)]


def judged(spark, rows, target, passes):
    df = spark.createDataFrame(rows, "slot int, persona_id string, scenario_id string, response string, messages array<struct<role:string,content:string>>")
    return {r["slot"]: r["rejection"] for r in planner.accept(df, target, passes).collect()}


def test_acceptance_rejects_near_copies_of_accepted_ones(spark):
    base = "One short walk after lunch is a fair start for this week"
    rows = [
        candidate(0, f"{base}."),
        candidate(1, f"{base}!!"),
        candidate(2, f"{base}!!", scenario="other"),
        candidate(3, "Fully different words that nobody has said so far"),
        candidate(4, "Fully different words that nobody has said so fat"),
        candidate(5, "Same. Same. Same."),
        (6, *candidate(0, f"{base}.")[1:]),
    ]
    want = {0: None, 1: "near_duplicate", 2: None, 3: "validator_failure", 4: None, 5: "highly_repetitive_response", 6: "exact_duplicate"}
    assert judged(spark, rows, 100, F.col("slot") != 3) == want


def test_near_copies_come_before_the_opening_cap(spark):
    rows = [
        candidate(0, "Shared opening. Then we talk of sleep"),
        candidate(1, "Shared opening. Then we talk of sleeq"),
        candidate(2, "Shared opening. Quite another remark about food and 9 other things"),
    ]
    assert judged(spark, rows, 12, F.lit(True)) == {0: None, 1: "near_duplicate", 2: "highly_repetitive_opening"}


def test_plan_accepted_asks_the_rubric(spark):
    plan = planner.candidate_plan(spark, 6, 1)
    bad = planner.generate(plan).withColumn("response", F.when(F.col("slot") < 2, "I guarantee this will cure everything for you, so come along.").otherwise(F.col("response")))
    got = {r["slot"]: r["passed"] for r in planner.scored(bad).collect()}
    assert got == {i: i >= 2 for i in range(6)}


def test_staging_retries_and_holds_accepted_rows_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "staged")
    verdict, tried = planner.Acceptance.judge, []

    def judge(self, x):
        tried.append(x["candidate"])
        return "near_duplicate" if x["candidate"] in (2, 5, 6) else verdict(self, x)

    monkeypatch.setattr(planner.Acceptance, "judge", judge)
    assert planner.Staging(spark, path, 7, 6).run(batch_size=4, max_batches=1) == 4
    assert planner.Staging(spark, path, 7, 6).run(batch_size=4) == 6
    rows = {r["slot"]: r["candidate"] for r in spark.read.parquet(path).collect()}
    log = {(r["slot"], r["candidate"]) for r in spark.read.parquet(f"{path}-rejected").collect()}
    assert sorted(rows) == list(range(6)) and tried == list(range(max(tried) + 1))
    assert set(tried) == set(rows.values()) | {c for _, c in log} and {2, 5, 6} <= {c for _, c in log}


def test_staging_stops_at_its_attempts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(planner.Acceptance, "judge", lambda self, x: "near_duplicate")
    with pytest.raises(RuntimeError, match="20 candidates gave 0 of 1"):
        planner.Staging(spark, str(tmp_path / "staged"), 7, 1).run(batch_size=1)


def test_near_sequence_equals_brute_force(spark):
    """Also over multiples of 50 characters, and with the larger of two ratios."""
    rng = random.Random(5)
    rows = []
    for size in (0, 3, 30, 49, 98, 120, 195, 230, 700, 2500):
        base = "".join(rng.choice("etaoin shrdlu") for _ in range(size))
        for rate in (0, 0.01, 0.04, 0.07, 0.1, 0.2):
            pair = ["".join(c for x in base for c in rng.choice((x + "q", "z", "")) * (rng.random() < rate) or x) for _ in range(2)]
            rows.append((len(rows), "b", *pair))
    want, accepted = {}, []
    for k, _, *xs in rows:
        hit = lambda ys: max(SequenceMatcher(None, x, y).ratio() for x, y in zip(xs, ys, strict=True)) >= 0.92  # noqa: B023, E731
        want[k] = next((j for j, ys in accepted if hit(ys)), None)
        if want[k] is None:
            accepted.append((k, xs))
    df = spark.createDataFrame(rows, "k long, g string, x string, y string")
    got = {r["k"]: r["near_key"] for r in dedup.near_sequence(df, "g", ["x", "y"], "k").collect()}
    assert got == want and 10 < len(accepted) < len(rows) - 10


def test_near_sequence_in_blocks(spark, monkeypatch):
    """Chains of near copies, copies, null texts and blocks of a few rows: the same verdicts as one after the other."""
    monkeypatch.setattr(dedup, "BLOCK", 4)
    rng = random.Random(9)
    rows, text = [], "the quick brown fox jumps over the lazy dog until evening"
    for i in range(60):
        if i % 15 == 0:
            text = "".join(rng.choice("etaoin shrdlu") for _ in range(60))
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice("xyz") + text[at + 1 :]
        rows.append((i, rng.choice("ab"), text if i % 7 else rows[i // 2][2] if i else text))
    rows.append((60, "a", None))
    want, accepted = {}, []
    for k, g, x in rows:
        x = x or ""
        want[k] = next((j for j, h, y in accepted if h == g and SequenceMatcher(None, x, y).ratio() >= 0.92), None)
        if want[k] is None:
            accepted.append((k, g, x))
    df = spark.createDataFrame(rows, "k long, g string, x string")
    assert {r["k"]: r["near_key"] for r in dedup.near_sequence(df, "g", "x", "k").collect()} == want


@pytest.mark.parametrize("rest", [0, 100])
def test_near_sequence_in_rounds(spark, monkeypatch, rest):
    """Groups of near copies of long texts, judged in rounds of a pair a row, with and without a rest that is judged at once."""
    monkeypatch.setattr(dedup, "TRIES", 1)
    monkeypatch.setattr(dedup, "REST", rest)
    rng = random.Random(11)
    rows = []
    for _ in range(4):
        base = "".join(rng.choice("etaoin shrdlu" * 9 + "qzxj") for _ in range(420))
        for _ in range(7):
            at = rng.randrange(380)
            rows.append((len(rows), "b", base[:at] + "".join(rng.choice("qzxj") for _ in range(rng.randrange(9))) + base[at + rng.randrange(9) :]))
    rng.shuffle(rows)
    rows = [(k, g, x) for k, (_, g, x) in enumerate(rows)]
    want, accepted = {}, []
    for k, _, x in rows:
        want[k] = next((j for j, y in accepted if SequenceMatcher(None, x, y).ratio() >= 0.92), None)
        if want[k] is None:
            accepted.append((k, x))
    df = spark.createDataFrame(rows, "k long, g string, x string")
    assert {r["k"]: r["near_key"] for r in dedup.near_sequence(df, "g", "x", "k").collect()} == want and 4 <= len(accepted) < 26


def test_near_sequence_compares_few_pairs(spark, monkeypatch):
    """Long texts of a small vocabulary are told apart by their sketches, and near ones are not lost."""
    rng = random.Random(13)
    words = ["".join(rng.choice("etaoinsrhl") for _ in range(rng.randrange(2, 6))) + rng.choice(["", "", "k", "v", ","]) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(380, 440))) for _ in range(60)]
    texts += [x[:500] + "jq" + x[540:] for x in texts[:20]]
    df = spark.createDataFrame([(k, "b", x) for k, x in enumerate(texts)], "k long, g string, x string")
    found = {(r["a"], r["b"]) for r in dedup._candidates(df, "x", 0.92).collect()}
    assert {(k, 60 + k) for k in range(20)} <= found and len(found) < 60


def test_near_verdicts_are_those_of_difflib():
    """With frequent characters left out, runs of rare ones, and runs too long to look up."""
    rng = random.Random(17)
    for alphabet in ("etaoin shrdlu", "ab", "eeeeettttaaooonns       hrqzxjk", "".join(map(chr, range(0x4E00, 0x4F00)))):
        for size in (0, 1, 40, 199, 200, 700) * 6:
            y = "".join(rng.choice(alphabet) for _ in range(size))
            x = "".join(c if rng.random() > 0.03 else rng.choice(("", c + c, "z")) for c in y)
            x = x[size // 9 :] + x[: size // 9] if rng.random() < 0.2 else x
            for threshold in (0.5, 0.92, 0.97):
                assert dedup.reaches(x, y, threshold) == (SequenceMatcher(None, x, y).ratio() >= threshold)


def test_near_sequence_looks_at_every_document(spark, sf):
    docs = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in QUERIES["dedup_near_sequence"](spark, sf).collect()} == docs


def test_names_cover_every_part(spark, sf):
    """With sizes on both sides of a billion in either class of parts."""
    got = {r["p_partkey"]: r["size_text"] for r in QUERIES["research_names"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/part.parquet").count()
    assert (got[1], got[2], got[3], got[97], got[100]) == ("10.0M", "0.0M", "n/a", "970.0M", "1.00B")
    far = spark.createDataFrame([(999_002, "a", "b"), (1_000_001, "a", "b"), (1_000_002, "a", "b")], "p_partkey long, p_name string, p_brand string")
    assert [r["size_text"] for r in _names(far).orderBy("p_partkey").collect()] == ["1.00B", "1.00B", "n/a"]
