"""Planning of synthetic conversations: quotas, memory choices, generation and acceptance."""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from ..functions import scoring as s, text as t
from ..functions.lexicon import STOCK, Lexicon
from ..operators import dedup, order
from ..sources import dimensions as dim
from ..sources.store import exists
from . import profile, rubric as rb

# Fixed value: attempts for each slot of the target.
ATTEMPTS = 20
#: Slots that are brought to the driver and back at a time.
CHUNK = 50_000


def cross_product(spark: SparkSession, seed: int) -> DataFrame:
    """All persona and scenario pairs (120 of them) in hash order."""
    both = dim.personas(spark).select("persona_id").crossJoin(dim.scenarios(spark).select("scenario_id"))
    key = order.hash_key(seed, F.col("persona_id"), F.col("scenario_id"))
    w = Window.orderBy(key, "persona_id", "scenario_id")
    return both.withColumn("position", F.row_number().over(w) - 1)


def allowed_events(spark: SparkSession) -> DataFrame:
    """Scenario and the memory events it allows among those with a specification, in order; else goal_set."""
    known = [e for e, _, _ in dim.MEMORY]
    some = F.filter("allowed", lambda e: e.isin(known))
    return dim.scenarios(spark).select("scenario_id", F.when(F.size(some) > 0, some).otherwise(F.array(F.lit("goal_set"))).alias("events"))


def quotas(spark: SparkSession, total: int, seed: int) -> DataFrame:
    """Slots with persona, scenario and history length, each as even as can be."""
    lengths = spark.createDataFrame([("3",), ("5",)], "length string")
    parts = [(dim.personas(spark), "persona_id"), (dim.scenarios(spark), "scenario_id"), (lengths, "length")]
    out = None
    for k, (library, key) in enumerate(parts):
        seq = order.balanced_quota(library.select(key), total, seed + k, key).withColumnRenamed("value", key)
        out = seq if out is None else out.join(seq, "slot")
    return out


def candidate_plan(spark: SparkSession, total: int, seed: int) -> DataFrame:
    """Quotas plus, slot by slot, the allowed memory event whose category is used least so far, ties by name.

    That choice is a fold over slots, so it runs on the driver, slot after slot
    as they come; what it decides goes back in Arrow tables. A plan has as many
    rows as conversations are asked for.
    """
    category = {e: c for e, c, _ in dim.MEMORY}
    allowed = {r["scenario_id"]: r["events"] for r in allowed_events(spark).collect()}
    used: Counter = Counter()
    slots, events = [], []
    for r in quotas(spark, total, seed).select("slot", "scenario_id").orderBy("slot").toLocalIterator(prefetchPartitions=True):
        event = min(allowed[r["scenario_id"]], key=lambda e: (used[category[e]], e))
        used[category[event]] += 1
        slots.append(r["slot"])
        events.append(event)
    chosen = None
    for at in range(0, len(slots), CHUNK) or [0]:
        part = pa.table({"slot": pa.array(slots[at : at + CHUNK], pa.int32()), "memory_event": pa.array(events[at : at + CHUNK], pa.string())})
        part = spark.createDataFrame(part)
        chosen = part if chosen is None else chosen.unionByName(part)
    specs = dim.memory_specs(spark).select(F.col("event_type").alias("memory_event"), F.col("category").alias("memory_category"))
    plan = quotas(spark, total, seed).join(chosen, "slot").join(specs, "memory_event")
    return plan.select(F.col("slot").cast("int"), "persona_id", "scenario_id", "memory_event", "memory_category", F.col("length").cast("int").alias("history_length"))


def distributions(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Long form (dimension, label, n) in one pass."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("label")) for d in dims])
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.label").agg(F.count(F.lit(1)).alias("n"))


#: What is counted of a plan, and of what was accepted.
PLANNED = ["persona_id", "scenario_id", "memory_event", "memory_category", "history_length", "goal_domain", "lifestyle"]
ACCEPTED = [*PLANNED, "stress"]


def detailed(rows: DataFrame) -> DataFrame:
    """Slots with the columns of their persona and scenario and the profile these give."""
    spark = rows.sparkSession
    return profile.profiles(dim.lookup(dim.lookup(rows, dim.personas(spark), "persona_id"), dim.scenarios(spark), "scenario_id"))


PRINCIPLES = ["progressive overload", "steady recovery", "enough protein", "regular sleep"]


def generate(plan: DataFrame) -> DataFrame:
    """Messages and response text of each slot from the dimension tables, the profile rules and phrase tables.

    Phrases turn with ``candidate`` where the plan has it, so that another
    attempt at a slot has another text; else with the slot.
    """
    df = detailed(plan)
    by = F.col("candidate") if "candidate" in plan.columns else F.col("slot")
    pick = lambda phrases, by: F.element_at(F.array(*map(F.lit, phrases)), (by % len(phrases) + 1).cast("int"))
    spaced = lambda c: F.replace(c, F.lit("_"), F.lit(" "))
    said = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    acks = ["That makes sense", "I hear you", "It sounds like a lot", "I understand", "That is a fair thing to feel"]
    loads = ["on top of the week you describe", "with all else you carry", "at this point of the year", "after the days you have had"]
    steps = ["Let's start with two sessions of 3 sets this week", "Let's keep one session of 20 minutes on busy days", "Let's track three simple markers for 7 days", "Let's adjust the plan after 7 days",
             "Let's plan 2 easy days and 1 harder one", "Let's keep the first session to 5 reps a set", "Let's track how 8 hours in bed feel"]
    asks = ["What would make the first session easier?", "Which day is the safest for you?", "How does your body respond the day after?"]
    topic, lifestyle, diet, goal = spaced("scenario_id"), spaced("lifestyle"), spaced("diet"), spaced("goal_domain")
    event = F.col("memory_event")
    fact = F.coalesce(profile.memory_fact(event, goal, F.col("schedule"), F.col("injuries"), F.col("sleep_hours")), spaced("memory_event"))
    first, second = profile.two_constraints(F.col("constraints"))
    principles = profile.rotated(F.array(*map(F.lit, PRINCIPLES)), by, F.lit(2))
    df = df.withColumns({"memory_fact": fact, "used_principles": principles})
    injury = said("We modify the range around your ", F.col("injury"), " and pause when pain rises.")
    response = F.concat_ws(
        " ",
        said(pick(acks, by), ", ", topic, " as a ", lifestyle, " ", pick(loads, by), "."),
        said("You are ", F.col("experience"), ", eat ", diet, " and train for ", spaced("motivation"), "."),
        F.coalesce(injury, F.lit("Your body feels sound, so we can build on it.")),
        said("Since you told me of ", F.col("memory_fact"), ", we adapted to ", F.col("stress"), " stress."),
        F.when(first == second, said("The plan leaves room for ", first, ".")).otherwise(said("The plan leaves room for ", first, " and ", second, ".")),
        said(pick(steps, by), "."),
        said("Keep an eye on ", F.array_join(F.slice("keywords", 1, 4), ", "), "; this rests on ", F.array_join("used_principles", " and "), "."),
        pick(asks, by),
        pick(asks, by + 1),
    )
    user = F.concat(F.lit("I am working on "), topic, F.lit(" and my stress is "), F.col("stress"), F.lit("."))
    history = profile.history(F.col("history_length"), F.col("scenario_id"), F.col("lifestyle"), goal, user, F.col("slot"))
    answer = F.array(F.struct(F.lit("assistant").alias("role"), response.alias("content")))
    return df.withColumns({"response": response, "history": history, "messages": F.concat(history, answer), "final_user": user})


def assembled(made: DataFrame) -> DataFrame:
    """Generated rows as nested conversations: persona, profile, memory, scenario, history, response and what is asked of them."""
    part = lambda *names: F.struct(*names)
    n = F.col("candidate") if "candidate" in made.columns else F.col("slot")
    return made.select(
        "slot",
        F.concat(F.lit("synthetic::"), F.format_string("%06d", n)).alias("conversation_id"),
        part("persona_id", "age", "lifestyle", "experience", "motivation", "diet", "stress").alias("persona"),
        part("goal_domain", "equipment", "sleep_hours", "injuries", "schedule", "constraints").alias("profile"),
        F.array(part(F.col("memory_event").alias("event"), F.col("memory_category").alias("category"), F.col("memory_fact").alias("fact"), F.lit("use").alias("mode"))).alias("memory"),
        part("scenario_id", "domains", "follow_ups", "keywords").alias("scenario"),
        "history",
        "response",
        part(F.col("used_principles").alias("principles"), F.lit(True).alias("must_use_memory"), F.lit(1).alias("required_follow_ups")).alias("quality"),
    )


def last_user(history: Column) -> Column:
    """The last user message of a history."""
    return F.element_at(F.filter(history, lambda m: m["role"] == "user"), -1)["content"]


def with_response(history: Column, response: Column) -> Column:
    return F.concat(history, F.array(F.struct(F.lit("assistant").alias("role"), response.alias("content"))))


def demands(made: DataFrame, lex: Lexicon) -> DataFrame:
    """Generated rows with what the validators look at: what their plan demands of them."""
    r = F.col("response")
    folded = t.fold(r)
    both = t.fold(F.concat(F.col("final_user"), F.lit("\n"), r))
    spaced = lambda c: F.replace(c, F.lit("_"), F.lit(" "))
    memory = F.array("memory_fact")
    asked = F.length(r) - F.length(F.replace(r, F.lit("?"), F.lit("")))
    return made.withColumns(
        {
            "topic_tags": s.topic_tags(both, lex),
            "domain_score": s.domain_relevance(s.topic_tags(both, lex), folded, lex),
            "facts": rb.profile_facts(F.array_compact(F.array(spaced("lifestyle"), "experience", spaced("diet"), spaced("motivation"), "injury"))),
            "references": F.array(F.struct(memory.alias("facts"), F.lit("use").alias("mode"))),
            "principles": t.count_contained(folded, F.col("used_principles")),
            "follow_ups": asked,
            "required_follow_ups": F.lit(1),
            "scenario_follow_ups": F.col("follow_ups"),
            "no_emotional_objectives": F.lit(False),
            "has_adaptation_summary": F.contains(folded, F.lit("we adapted to")),
            "must_use_memory": F.lit(True),
            "injury_domain": F.array_contains("domains", "injury_recovery"),
            "has_injury": F.size("injuries") > 0,
        }
    )


def scored(made: DataFrame, lex: Lexicon = STOCK) -> DataFrame:
    """Generated rows with ``passed``, the rubric's verdict on them."""
    passed = rb.rubric(rb.validators(demands(made, lex), lex))
    return passed.select(*made.columns, "passed", "blockers")


class Acceptance:
    """Conversations accepted so far; judges candidates one after the other, as each verdict rests on those before."""

    def __init__(self, target: int):
        self.cap = dedup.cap_for(target)
        self.digests: set[str] = set()
        self.near: dict[str, list[tuple[str, str]]] = defaultdict(list)
        self.openings: Counter = Counter()

    @staticmethod
    def features(df: DataFrame, passes: Column, *keys: str) -> DataFrame:
        """What a verdict needs of each row."""
        talk = dedup.conversation(F.col("messages"))
        return dedup.repetitive(df, "response").select(
            *keys,
            F.concat_ws("::", "persona_id", "scenario_id").alias("bucket"),
            F.coalesce(talk, F.lit("")).alias("conversation"),
            F.coalesce(t.fold(F.col("response")), F.lit("")).alias("response"),
            dedup.opening(F.col("response")).alias("opening"),
            "is_repetitive",
            F.coalesce(passes, F.lit(False)).alias("passes"),
        )

    def add(self, x: Row) -> None:
        self.digests.add(x["conversation"])
        self.near[x["bucket"]].append((x["conversation"], x["response"]))
        self.openings[x["opening"]] += 1

    def judge(self, x: Row) -> str | None:
        """Why a candidate is rejected; one without a reason counts as accepted from here on."""
        if not x["passes"]:
            return "validator_failure"
        if x["conversation"] in self.digests:
            return "exact_duplicate"
        if x["is_repetitive"]:
            return "highly_repetitive_response"
        if any(dedup.is_near(x["conversation"], c) or dedup.is_near(x["response"], r) for c, r in self.near[x["bucket"]]):
            return "near_duplicate"
        if self.openings[x["opening"]] >= self.cap:
            return "highly_repetitive_opening"
        self.add(x)
        return None


def accept(candidates: DataFrame, target: int, passes, key: str = "slot") -> DataFrame:
    """Add ``rejection``: failed validation, exact duplicate, repetitive, near duplicate within persona and scenario,
    over the opening cap, or null; first reason wins.

    Candidates are judged in key order against the accepted ones before them.
    That is a fold, so it runs on the driver, candidate after candidate as they
    come; it holds what was accepted, which a target bounds.
    """
    judge = Acceptance(target).judge
    rows = Acceptance.features(candidates, passes, key).orderBy(key).toLocalIterator(prefetchPartitions=True)
    verdicts = candidates.sparkSession.createDataFrame([(x[key], judge(x)) for x in rows], f"{key} {candidates.schema[key].dataType.simpleString()}, rejection string")
    return candidates.join(verdicts, key)


def pilot(candidates: DataFrame, target: int, passes, key: str = "slot") -> DataFrame:
    """The first ``target`` candidates that pass; fewer are an error."""
    out = candidates.filter(passes).orderBy(key).limit(target)
    n = out.count()
    if n < target:
        raise RuntimeError(f"only {n} of {target} conversations passed")
    return out


def rates(judged: DataFrame, passed: Column | None = None) -> DataFrame:
    """Acceptance, validator and duplicate rates of judged candidates; ``passed``: the rubric's verdict on what is exported."""
    n, kept = F.count(F.lit(1)), F.col("rejection").isNull()
    share = lambda c: F.coalesce(F.count_if(c) / F.nullif(n, F.lit(0)), F.lit(0.0))
    out = [
        n.alias("candidates"),
        F.count_if(kept).alias("accepted"),
        share(kept).alias("acceptance_rate"),
        share(kept | (F.col("rejection") != "validator_failure")).alias("candidate_validator_pass_rate"),
        share(F.col("rejection") == "exact_duplicate").alias("duplicate_rate"),
    ]
    if passed is not None:
        out.append(F.coalesce(F.count_if(kept & passed) / F.nullif(F.count_if(kept), F.lit(0)), F.lit(0.0)).alias("validator_pass_rate"))
    return judged.agg(*out)


def export(judged: DataFrame, gate_rows: DataFrame, path: str) -> None:
    """Write accepted rows by slot; a gate that fails stops the export."""
    failed = [r["gate"] for r in gate_rows.filter("status <> 'PASS'").collect()]
    if failed:
        raise RuntimeError(f"gates failed: {failed}")
    judged.filter("rejection IS NULL").orderBy("slot").write.json(path)


class Staging:
    """Accepted rows on disk: a restart goes on after them if seed and target are the same.

    A slot is tried until a candidate is accepted; the candidate index never
    goes back. Rejected candidates are logged beside, in ``<path>-rejected``.
    """

    #: Rejections of a batch that one generation of candidates allows for.
    SPARE = 8

    def __init__(self, spark: SparkSession, path: str, seed: int, target: int):
        self.spark, self.path, self.seed, self.target = spark, path, seed, target

    def rows(self) -> DataFrame | None:
        if not exists(self.spark, self.path):
            return None
        df = self.spark.read.parquet(self.path)
        other = df.filter((F.col("seed") != self.seed) | (F.col("target") != self.target)).limit(1).count()
        if other:
            raise ValueError("the staging area belongs to another seed or target")
        return df

    def rejected(self) -> DataFrame:
        """The log of rejected candidates (slot, candidate, rejection); a batch that was begun again logs the same once more."""
        path = f"{self.path}-rejected"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], "slot int, candidate int, rejection string")
        return self.spark.read.parquet(path).select("slot", "candidate", "rejection").distinct()

    def counters(self) -> dict[str, int]:
        """Accepted and rejected candidates and the next one; slots or candidates that are missing or there twice are an error."""
        rows = self.rows()
        if rows is None:
            return {"accepted": 0, "rejected": 0, "next_candidate": 0}
        slots = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("m")).first()
        if slots["n"] != slots["d"] or slots["n"] != slots["m"] + 1:
            raise ValueError(f"the staging area holds {slots['d']} slots in {slots['n']} rows up to slot {slots['m']}")
        last = rows.agg(F.max("candidate")).first()[0]
        # A batch that was stopped may have logged rejections that no accepted row follows yet.
        log = self.rejected().filter(F.col("candidate") <= last)
        tried = rows.select("candidate").union(log.select("candidate")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("candidate").alias("d")).first()
        if tried["n"] != tried["d"] or tried["n"] != last + 1:
            raise ValueError(f"the staging area accounts for {tried['d']} of {last + 1} candidates in {tried['n']} rows")
        return {"accepted": slots["n"], "rejected": tried["n"] - slots["n"], "next_candidate": last + 1}

    def next_slot(self) -> int:
        return self.counters()["accepted"]

    def _candidates(self, plan: DataFrame, start: int, stop: int, at: int) -> dict:
        """Features of the candidates for slots from ``start``, with up to ``SPARE`` - 1 rejections before each, by (slot, candidate)."""
        rows = plan.filter((F.col("slot") >= start) & (F.col("slot") < stop))
        first = F.col("slot") - start + at
        rows = rows.withColumn("candidate", F.explode(F.sequence(first, first + self.SPARE - 1)))
        made = Acceptance.features(scored(generate(rows)), F.col("passed"), "slot", "candidate")
        return {(x["slot"], x["candidate"]): x for x in made.collect()}

    def _write(self, plan: DataFrame, taken: list[tuple], rejected: list[tuple]) -> None:
        own = {"seed": F.lit(self.seed), "target": F.lit(self.target)}
        if rejected:
            log = self.spark.createDataFrame(rejected, "slot int, candidate int, rejection string")
            log.withColumns(own).write.mode("append").parquet(f"{self.path}-rejected")
        if taken:
            rows = plan.join(self.spark.createDataFrame(taken, "slot int, candidate int"), "slot")
            generate(rows).withColumns(own).write.mode("append").parquet(self.path)

    def run(self, batch_size: int, max_batches: int | None = None) -> int:
        """Write batches of accepted slots until the target or ``max_batches``; returns the next slot."""
        plan = candidate_plan(self.spark, self.target, self.seed)
        slot, candidate, done = self.next_slot(), 0, 0
        state = Acceptance(self.target)
        if slot:
            candidate = self.counters()["next_candidate"]
            for x in Acceptance.features(self.rows(), F.lit(True), "slot").orderBy("slot").collect():
                state.add(x)
        while slot < self.target and (max_batches is None or done < max_batches):
            stop = min(slot + batch_size, self.target)
            taken, rejected, made = [], [], {}
            while slot < stop:
                if candidate >= self.target * ATTEMPTS:
                    self._write(plan, taken, rejected)
                    raise RuntimeError(f"{candidate} candidates gave {slot} of {self.target} conversations")
                if (slot, candidate) not in made:
                    made = self._candidates(plan, slot, stop, candidate)
                why = state.judge(made[slot, candidate])
                if why is None:
                    taken.append((slot, candidate))
                    slot += 1
                else:
                    rejected.append((slot, candidate, why))
                candidate += 1
            self._write(plan, taken, rejected)
            done += 1
        return slot
