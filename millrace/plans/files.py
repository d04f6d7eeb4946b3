"""Queries on sources and sinks: tables go out through a writer and come back through a reader."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, functions as F

from ..functions import text as t
from ..operators import audit, research as r, training
from ..sources import corpora, readers, sinks
from ..sources.store import shared_dir
from . import profile
from .registry import big, fold_sql, query, strip_sql, table
from .scoring import SCORED, scored


def _place(spark, name: str) -> str:
    return f"{shared_dir(spark)}/files/{uuid.uuid4().hex}/{name}"


def _field(name: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col("record")[name], "$", kind)


NULLS = "CASE WHEN doc_id % 5 <> 0 THEN lang END"


@query(f"SELECT doc_id, sha256(text) AS text_sha, {NULLS} AS lang FROM documents")
def source_jsonl(spark, sf):
    """ASCII lines out, records in."""
    path = _place(spark, "documents.jsonl")
    sinks.write_jsonl(table(spark, sf, "documents").selectExpr("doc_id", "text", f"{NULLS} AS lang"), path)
    df = readers.read_jsonl(spark, path)
    return df.select(_field("doc_id", "bigint").alias("doc_id"), F.sha2(_field("text"), 256).alias("text_sha"), _field("lang").alias("lang"))


@query("SELECT count(*) AS lines, 0::BIGINT AS beyond_ascii, count(*) AS with_every_field, count(*) AS ids FROM documents")
def sink_jsonl(spark, sf):
    """What the writer puts into its lines."""
    path = _place(spark, "documents.jsonl")
    sinks.write_jsonl(table(spark, sf, "documents").selectExpr("doc_id", "text", f"{NULLS} AS lang"), path)
    lines = spark.read.text(path)
    found = lines.agg(F.count_if(F.col("value").rlike(r"[^\x00-\x7F]")).alias("a"), F.count_if(F.contains("value", F.lit('"lang":'))).alias("b"), F.count_distinct(F.get_json_object("value", "$.doc_id")).alias("c"))
    return found.select(F.lit(sinks.record_count(spark, path)).cast("bigint").alias("lines"), F.col("a").alias("beyond_ascii"), F.col("b").alias("with_every_field"), F.col("c").alias("ids"))


@query("SELECT 2 * count(*) AS lines, 2 * count(*) AS in_order FROM nation")
def sink_append_jsonl(spark, sf):
    """Two appends, keys in order whatever the columns' order."""
    path = _place(spark, "nation.jsonl")
    df = table(spark, sf, "nation").select("n_name", "n_nationkey")
    sinks.append_jsonl(df, path)
    sinks.append_jsonl(df.select("n_nationkey", "n_name"), path)
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("value").rlike(r'^\{"n_name":.*"n_nationkey":')).alias("in_order"))


@query("SELECT o_orderkey, o_orderpriority, o_totalprice AS price FROM orders")
def source_parquet(spark, sf):
    df = readers.read_parquet(spark, f"{sf}/orders.parquet")
    return df.select(_field("o_orderkey", "bigint").alias("o_orderkey"), _field("o_orderpriority").alias("o_orderpriority"), _field("o_totalprice", "double").alias("price"))


@query("SELECT doc_id::VARCHAR AS doc_id, sha256(text) AS text_sha FROM documents")
def source_csv(spark, sf):
    """All strings; quotes, commas and line ends inside."""
    path = _place(spark, "documents.csv")
    table(spark, sf, "documents").select("doc_id", "text").write.csv(path, header=True, quote='"', escape='"', quoteAll=True)
    return readers.read_csv(spark, path).select(_field("doc_id").alias("doc_id"), F.sha2(_field("text"), 256).alias("text_sha"))


@query("SELECT 'list' AS form, n_nationkey, n_name FROM nation UNION ALL SELECT 'data', n_nationkey, n_name FROM nation "
       "UNION ALL SELECT 'one', n_nationkey, n_name FROM nation WHERE n_nationkey = 3")
def source_json(spark, sf):
    """A list, a list under ``data`` and a single object."""
    rows = [x.asDict() for x in table(spark, sf, "nation").select("n_nationkey", "n_name").collect()]  # 25 rows
    out = None
    for form, value in (("list", rows), ("data", {"data": rows}), ("one", next(x for x in rows if x["n_nationkey"] == 3))):
        path = sinks.write_text(spark, _place(spark, "nation.json"), json.dumps(value))
        one = readers.read_json(spark, path).select(F.lit(form).alias("form"), _field("n_nationkey", "bigint").alias("n_nationkey"), _field("n_name").alias("n_name"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT kind, count(*) AS n, count(DISTINCT n_nationkey) AS ids FROM nation, (VALUES ('jsonl'), ('csv'), ('parquet'), ('json')) k(kind) GROUP BY kind")
def source_by_suffix(spark, sf):
    """Files of four formats, told apart by their names."""
    df = table(spark, sf, "nation").select("n_nationkey", "n_name")
    paths = [_place(spark, f"nation.{k}") for k in ("JSONL", "csv", "parquet", "json")]
    sinks.write_jsonl(df, paths[0])
    df.write.csv(paths[1], header=True)
    df.write.parquet(paths[2])
    sinks.write_text(spark, paths[3], json.dumps([x.asDict() for x in df.collect()]))  # 25 rows
    found = readers.read_files(spark, paths)
    kind = F.lower(F.regexp_extract("source_file", r"nation\.([A-Za-z]+)", 1))
    return found.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(_field("n_nationkey", "bigint")).alias("ids"))


def _manifest(spark, sf) -> str:
    """A raw manifest of two datasets, one with a file that no reader takes."""
    root = _place(spark, "raw")
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    sinks.write_jsonl(docs.filter("lang = 'en'"), f"{root}/en/part.jsonl")
    docs.filter("lang <> 'en'").write.parquet(f"{root}/rest/part.parquet")
    sinks.write_text(spark, f"{root}/rest/notes.txt", "nothing to read")
    entry = lambda i, *files: {"id": f"org/{i}", "license": "mit", "local_dir": f"{root}/{i}", "files": [{"path": f"{root}/{i}/{f}"} for f in files]}
    body = {"datasets": [entry("en", "part.jsonl"), entry("rest", "part.parquet", "notes.txt")]}
    return sinks.write_text(spark, f"{root}/manifest.json", json.dumps(body))


@query("SELECT CASE WHEN lang = 'en' THEN 'org/en' ELSE 'org/rest' END AS dataset_id, 'mit' AS source_license, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM documents GROUP BY 1")
def source_manifest(spark, sf):
    df = readers.read_manifest(spark, _manifest(spark, sf))
    return df.groupBy("dataset_id", "source_license").agg(F.count(F.lit(1)).alias("n"), F.sum(_field("doc_id", "bigint")).alias("ids"))


@query("SELECT * FROM (VALUES ('org/en', 1::BIGINT, 0::BIGINT, ''), ('org/rest', 1, 1, 'notes.txt')) t(dataset_id, processed_files, skipped_files, skipped)")
def source_manifest_report(spark, sf):
    """Files read and skipped, by dataset."""
    found = readers.manifest_report(readers.manifest_files(spark, _manifest(spark, sf)))
    return found.withColumn("skipped", F.array_join(F.transform("skipped", lambda p: F.element_at(F.split(p, "/"), -1)), ","))


@query("SELECT 'augmented' AS source_type, count(*) AS n, 0::BIGINT AS absent FROM documents")
def source_optional(spark, sf):
    """JSON lines below a directory, and a directory that is not there."""
    path = _place(spark, "augmented")
    m = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    sinks.write_jsonl(table(spark, sf, "documents").select(m.alias("conversations")), f"{path}/deep/a")
    for f in spark.read.text(f"{path}/deep/a").inputFiles()[:1]:
        spark.read.text(f).limit(0).write.text(f"{path}/other")  # a folder without JSON lines beside it
    df = spark.read.text(f"{path}/deep/a")
    df.write.mode("overwrite").text(f"{path}/text")
    found = readers.read_optional(spark, _jsonl_named(spark, f"{path}/deep/a"), "augmented")
    absent = readers.read_optional(spark, f"{path}/missing", "augmented").count()
    return found.groupBy("source_type").agg(F.count(F.lit(1)).alias("n"), F.lit(absent).cast("bigint").alias("absent"))


def _jsonl_named(spark, path: str) -> str:
    """Part files of a folder under names that end in .jsonl."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(at):
        if f.getPath().getName().startswith("part-"):
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f.getPath().toString() + ".jsonl"))
    return path


@query(f"WITH {SCORED} SELECT count(*) AS passing, count(DISTINCT conv_id) AS ids FROM scored WHERE len(reasons) = 0")
def source_scored(spark, sf):
    """Scored records on disk, those that pass read back."""
    path = _place(spark, "scored")
    scored(spark, sf).select("conv_id", "passes_training_filter").write.parquet(path)
    return readers.read_passing(spark, path).agg(F.count(F.lit(1)).alias("passing"), F.count_distinct("conv_id").alias("ids"))


@query(
    f"""SELECT 'http://x.org/abs/' || item_id || 'v1' AS id, item_id || 'v1' AS arxiv_id, {strip_sql("left(text, 40)")} AS title, (2020 + item_id % 9) || '-05-01' AS published,
    'A B,C' AS authors, sha256({strip_sql('text')}) AS summary_sha, 'https://arxiv.org/pdf/' || item_id || 'v1.pdf' AS pdf_url, 'https://arxiv.org/abs/' || item_id || 'v1' AS abs_url
    FROM benchmark WHERE 2020 + item_id % 9 >= 2023"""
)
def source_atom(spark, sf):
    """A feed of benchmark items, a third of them too old."""
    esc = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    i = F.col("item_id").cast("string")
    entry = F.concat(
        F.lit("<entry><id>http://x.org/abs/"), i, F.lit("v1</id><title>  "), esc(F.substring("text", 1, 40)), F.lit("\n</title><published>"),
        (2020 + F.col("item_id") % 9).cast("string"), F.lit("-05-01</published><summary>"), esc(F.col("text")),
        F.lit("</summary><author><name> A B </name></author><author><name>C</name></author></entry>"),
    )
    rows = table(spark, sf, "benchmark").select(entry.alias("value")).coalesce(1)
    path = _place(spark, "feed")
    head = spark.createDataFrame([('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">',)], "value string")
    head.unionByName(rows).unionByName(spark.createDataFrame([("</feed>",)], "value string")).coalesce(1).write.text(path)
    df = readers.read_atom(spark, path)
    return df.select("id", "arxiv_id", "title", "published", F.array_join("authors", ",").alias("authors"), F.sha2("summary", 256).alias("summary_sha"), "pdf_url", "abs_url")


@query("SELECT 'en' AS name, count(*) AS sample_count, TRUE AS whole FROM documents WHERE lang = 'en' UNION ALL SELECT 'rest', count(*), TRUE FROM documents WHERE lang <> 'en'")
def sink_manifest(spark, sf):
    """A final manifest of two splits: counts, and digests that tell equal outputs from others."""
    root = _place(spark, "final")
    docs = table(spark, sf, "documents").select("doc_id", "lang").coalesce(1)
    sinks.write_jsonl(docs, f"{root}/all")
    sinks.write_jsonl(docs.filter("lang = 'en'"), f"{root}/en")
    sinks.write_jsonl(docs.filter("lang <> 'en'"), f"{root}/rest")
    made = [sinks.final_manifest(spark, root, f"{root}/all", {n: f"{root}/{n}" for n in ("en", "rest")}, f"{root}/audit.json", f"{root}/spot.json", "base") for _ in range(2)]
    digests = {made[0]["final_dataset"]["sha256"], *(s["sha256"] for s in made[0]["splits"].values())}
    same = made[0] == made[1] and len(digests) == 3 and made[0]["composition_audit"] == "audit.json"
    rows = [(n, s["sample_count"], same and s["size_bytes"] > 0) for n, s in made[0]["splits"].items()]
    return spark.createDataFrame(rows, "name string, sample_count bigint, whole boolean")


@query("SELECT count(*) AS files, sum(length(n_name) + 1)::BIGINT AS size_bytes, count(*) AS digests FROM nation")
def sink_file_manifest(spark, sf):
    """A file for each nation, one in a cache left out."""
    root = _place(spark, "files")
    names = [x["n_name"] for x in table(spark, sf, "nation").select("n_name").collect()]  # 25 rows
    for n in names:
        sinks.write_text(spark, f"{root}/{n}.txt", n + "\n")
    sinks.write_text(spark, f"{root}/.cache/x.txt", "left out")
    found = sinks.file_manifest(spark, root)
    return found.agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("size_bytes"), F.count_distinct("sha256").alias("digests"))


@query(
    "SELECT * FROM (VALUES ('planned', 0::BIGINT, 0::BIGINT), ('downloaded', 1, 12), ('reused_existing', 1, 12), ('forced', 1, 12), ('missing', 0, 0), ('unknown', 0, 0)) t(step, files, size_bytes)"
)
def source_approved(spark, sf):
    """An approved report, its snapshot planned, fetched, reused and fetched again; a missing report and an unknown id are errors."""
    root = _place(spark, "raw")
    report = sinks.write_text(spark, f"{root}/approved.json", json.dumps({"generated_at": "now", "approved": [{"id": "org/a b", "license": "mit", "queries": ["q"]}]}))
    fetched = []

    def fetch(dataset, at, force):
        fetched.append(force)
        sinks.write_text(spark, f"{at}/part.jsonl", '{"text":"x"}')

    steps = [("planned", {"dry_run": True}), ("downloaded", {}), ("reused_existing", {}), ("forced", {"force": True})]
    rows = []
    for name, how in steps:
        d = corpora.raw_manifest(spark, report, f"{root}/data", fetch, **how)["datasets"][0]
        as_said = d["status"] == (name if name != "forced" else "downloaded") and d["local_dir"].endswith("/org__a_b")
        rows.append((name if as_said else d["status"], d["file_count"], d["total_size_bytes"]))
    for name, args, kind in (("missing", (f"{root}/none.json",), FileNotFoundError), ("unknown", (report, ["org/z"]), ValueError)):
        try:
            corpora.wanted(corpora.approved(spark, args[0]), args[1] if len(args) > 1 else None)
        except kind:
            rows.append((name, 0, 0))
    assert fetched == [False, True]
    return spark.createDataFrame(rows, "step string, files bigint, size_bytes bigint")


_CHECKPOINT = "'checkpoint-' || CASE WHEN o_orderkey % 7 = 0 THEN 'x' || o_orderkey ELSE o_orderkey::VARCHAR END"


@query(
    f"""SELECT count(*) AS checkpoints, sha256(string_agg(n, ',' ORDER BY n)) AS names_sha, 'checkpoint-' || max(o_orderkey) FILTER (o_orderkey % 7 <> 0) AS latest_checkpoint,
    max(n) AS latest_name FROM (SELECT o_orderkey, {_CHECKPOINT} AS n FROM orders)"""
)
def train_checkpoints(spark, sf):
    """Names of checkpoints: how many, the largest number, the largest name."""
    k = F.col("o_orderkey")
    name = F.concat(F.lit("checkpoint-"), F.when(k % 7 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")))
    names = table(spark, sf, "orders").select(name.alias("name"))
    found = corpora.checkpoint_statistics(names, "name")
    return found.select(
        "checkpoints",
        F.sha2(F.array_join("names", ","), 256).alias("names_sha"),
        F.lit(corpora.latest_checkpoint(names, "name")).alias("latest_checkpoint"),
        F.lit(corpora.latest(names, "name", "checkpoint-", "")).alias("latest_name"),
    )


# --- research ------------------------------------------------------------------------------

_PAGE = "'<h1>Intro</h1><p>x</p><h2>Our Conclusions</h2><p>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p><h3>Refs</h3> y'"


@query(
    f"""WITH d AS MATERIALIZED (SELECT doc_id, {fold_sql('text').replace("lower(", "(", 1)} AS x FROM documents)
    SELECT doc_id, sha256(CASE WHEN length(x) <= 1400 THEN x ELSE regexp_replace(left(x, 1398), ' [^ ]*$', '') || '...' END) AS section_sha FROM d"""
)
def research_sections(spark, sf):
    """The conclusion of a page made of each document, shortened at a blank."""
    return table(spark, sf, "documents").select("doc_id", F.sha2(t.section(F.expr(_PAGE)), 256).alias("section_sha"))


@query(
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN (doc_id % 100) / 100.0::DOUBLE
    ELSE CASE WHEN doc_id % 130 <= 1 THEN (doc_id % 130)::DOUBLE ELSE least((doc_id % 130) / 100.0::DOUBLE, 1.0) END END AS score FROM documents"""
)
def research_eq_scores(spark, sf):
    """Scores in prose, as shares and as points up to 129; none in a quarter."""
    i, k = F.col("doc_id"), F.col("doc_id") % 4
    shown = F.when(k == 1, F.format_string("%.2f", (i % 100) / 100.0)).otherwise((i % 130).cast("string"))
    x = F.concat("lang", F.when(k == 0, " no bench").when(k == 2, " has EQ-bench").otherwise(" has EQBench"), F.lit(" of\n"), shown, F.lit(" points"))
    return table(spark, sf, "documents").select("doc_id", r.eq_score(x).alias("score"))


@query(
    """WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: length(x) >= 3) AS l FROM documents),
    u AS (SELECT doc_id, list_filter(l, lambda x, i: list_position(l, x) = i)[1:5] AS l FROM w)
    SELECT doc_id, array_to_string(list_transform(l, lambda x: 'all:' || x), ' AND ') AS terms FROM u"""
)
def research_query_terms(spark, sf):
    return table(spark, sf, "documents").select("doc_id", r.query_terms(F.col("text")).alias("terms"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'n/a' ELSE printf('%.3f', o_totalprice / 100000) END AS shown FROM orders"""
)
def research_format_metric(spark, sf):
    x = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice") / 100000)
    return table(spark, sf, "orders").select("o_orderkey", r.format_metric(x).alias("shown"))


@query(
    """WITH h AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS position, o_orderpriority AS tag FROM orders),
    f AS (SELECT o_custkey, arg_min(o_orderkey, position) AS model FROM h WHERE position = 0 OR tag = '1-URGENT' GROUP BY o_custkey)
    SELECT c_custkey AS requested_id, f.model IS NOT NULL AS found, coalesce(f.model, -1) AS resolved_id FROM customer LEFT JOIN f ON f.o_custkey = c_custkey"""
)
def research_resolve_models(spark, sf):
    """Customers as requested ids, their orders as hits: a third have a direct one, for others an urgent order stands for a text model."""
    from pyspark.sql import Window

    o = table(spark, sf, "orders")
    at = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - F.when(F.col("o_custkey") % 3 == 0, 1).otherwise(0)
    tag = F.when(F.col("o_orderpriority") == "1-URGENT", "text-generation").otherwise("other")
    hits = o.select(F.col("o_custkey").alias("requested_id"), at.alias("position"), F.col("o_orderkey").alias("model_id"), tag.alias("pipeline_tag"))
    found = r.resolve(table(spark, sf, "customer").select(F.col("c_custkey").alias("requested_id")), hits)
    return found.select("requested_id", "found", F.coalesce("resolved_id", F.lit(-1)).alias("resolved_id"))


@query(
    """SELECT c_custkey AS model_id, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS bbh, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 5 <> 0 THEN c_nationkey::DOUBLE END AS mmlu_pro,
    NULL::DOUBLE AS gpqa FROM customer"""
)
def research_benchmark_report(spark, sf):
    """Leaderboard results as JSON for half of the customers as models."""
    c = table(spark, sf, "customer")
    group = lambda name, x: F.concat(F.lit(f'"{name}":'), F.to_json(F.create_map(F.lit("acc_norm,none" if name == "leaderboard_bbh" else "acc,none"), x)))
    payload = F.concat(F.lit('{"results":{'), group("leaderboard_bbh", F.col("c_acctbal").cast("double")), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit(","), group("leaderboard_mmlu_pro", F.col("c_nationkey").cast("double")))).otherwise(F.lit("")), F.lit("}}"))
    rows = c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("model_id"), payload.alias("payload"))
    return r.benchmark_report(c.select(F.col("c_custkey").alias("model_id")), rows).select("model_id", "bbh", "mmlu_pro", "gpqa")


LICENSES = ["mit", "CC-BY-NC-4.0", None, "gpl-3.0", "apache-2.0", ""]
_LICENSE = "CASE p_partkey % 6 WHEN 0 THEN 'mit' WHEN 1 THEN 'CC-BY-NC-4.0' WHEN 3 THEN 'gpl-3.0' WHEN 4 THEN 'apache-2.0' WHEN 5 THEN '' END"


@query(
    """SELECT p_partkey % 6 IN (0, 4) AS approved, CASE p_partkey % 6 WHEN 0 THEN 'approved' WHEN 4 THEN 'approved' WHEN 1 THEN 'rejected:cc-by-nc-4.0' WHEN 3 THEN 'manual_review_needed:gpl-3.0' ELSE 'missing_license' END AS license_rationale,
    count(*) AS n FROM part GROUP BY 1, 2"""
)
def research_license_report(spark, sf):
    yes, no = r.license_report(table(spark, sf, "part").select("p_partkey", F.expr(_LICENSE).alias("license")))
    both = yes.withColumn("approved", F.lit(True)).unionByName(no.withColumn("approved", F.lit(False)))
    return both.groupBy("approved", "license_rationale").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH q AS (SELECT doc_id, 0 AS o, 'small models' AS query FROM documents UNION ALL SELECT doc_id, 1, 'event sourcing AI memory' FROM documents WHERE doc_id % 2 = 0),
    f AS (SELECT q.doc_id, o, query, text FROM q JOIN documents USING (doc_id) WHERE query = 'small models'
          OR len(list_filter(['convers', 'dialog', 'language model', 'llm', 'assistant', 'agent', 'user', 'retrieval'], lambda p: contains(lower(lang || ' ' || text), p))) > 0),
    m AS (SELECT doc_id, string_agg(query, '|' ORDER BY o) AS queries, any_value(text) AS text, arg_min(query, o) AS first_query FROM f GROUP BY doc_id)
    SELECT doc_id, queries, CASE WHEN contains(lower(first_query), 'memory') THEN 'continuity for the single user' WHEN contains(lower(text), 'coaching') THEN 'how to coach rather than only answer'
        ELSE 'model behavior or grounding' END AS relevance FROM m"""
)
def research_literature(spark, sf):
    """Documents as papers that one or two queries found."""
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("title"), F.col("text").alias("summary"), F.col("doc_id").cast("string").alias("published"))
    found = d.withColumns({"query": F.lit("small models"), "ordinal": F.lit(0)})
    found = found.unionByName(d.filter("doc_id % 2 = 0").withColumns({"query": F.lit("event sourcing AI memory"), "ordinal": F.lit(1)}))
    papers = r.literature(found, "doc_id")
    return papers.select("doc_id", F.array_join("queries", "|").alias("queries"), "relevance")


@query(
    """SELECT 'p' || doc_id AS id, row_number() OVER (ORDER BY lang DESC, 'p' || doc_id) AS position FROM documents"""
)
def research_paper_order(spark, sf):
    """Papers by date, newest first, equals by id; the language stands for the date."""
    from pyspark.sql import Window

    d = table(spark, sf, "documents").select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("id"), F.col("lang").alias("published"))
    return d.select("id", big(F.row_number().over(Window.orderBy(F.desc("published"), "id"))).alias("position"))


# --- training and planning -------------------------------------------------------------------


@query(
    """SELECT 'r' || doc_id AS at, CASE doc_id % 6 WHEN 0 THEN 'missing_language' WHEN 1 THEN 'last_is_not_assistant' WHEN 2 THEN 'blank_record_id' END AS error
    FROM documents WHERE doc_id % 6 < 2 UNION ALL SELECT '  ', 'blank_record_id' FROM documents WHERE doc_id % 6 = 2"""
)
def train_malformed(spark, sf):
    """Every place of a malformed record."""
    from ..operators import compose

    k = F.col("doc_id") % 6
    say = lambda role: F.struct(F.lit(role).alias("role"), F.col("text").alias("content"))
    df = table(spark, sf, "documents").select(
        F.when(k == 2, F.lit("  ")).otherwise(F.concat(F.lit("r"), F.col("doc_id").cast("string"))).alias("record_id"),
        F.col("source").alias("source_id"),
        F.when(k != 0, F.col("lang")).alias("language"),
        F.lit("x").alias("domain"),
        F.when(k == 1, F.array(say("user"))).otherwise(F.array(say("user"), say("assistant"))).alias("conversations"),
    )
    return training.malformed(df.withColumn("text", compose.render(F.col("conversations"))))


@query(
    "SELECT p_partkey, round_even(p_size * 100 * greatest(1.0::DOUBLE, p_retailprice) / 900.0::DOUBLE / 3600.0::DOUBLE, 1) AS low, "
    "round_even(p_size * 100 * greatest(1.0::DOUBLE, p_retailprice) / 600.0::DOUBLE / 3600.0::DOUBLE, 1) AS high FROM part"
)
def train_runtime(spark, sf):
    """Parts as corpora: their size in hundreds of samples of as many tokens as the price."""
    low, high = profile.runtime_hours(F.col("p_size") * 100, F.col("p_retailprice"))
    return table(spark, sf, "part").select("p_partkey", low.alias("low"), high.alias("high"))


@query("SELECT count(*) AS n, sum(length(text))::BIGINT AS characters FROM documents")
def sink_totals(spark, sf):
    """Totals of a manifest's files, a row of it for each document."""
    files = table(spark, sf, "documents").select(F.length("text").cast("bigint").alias("size_bytes"))
    out = sinks.manifest_totals(files)
    return out.select(F.col("files").alias("n"), F.col("total_bytes").alias("characters"))


@query(
    """SELECT conv_id, CASE WHEN n = 0 THEN 'history_is_empty' WHEN f <> 'user' THEN 'history_must_start_with_user' WHEN l <> 'user' THEN 'history_must_end_with_user'
    WHEN again THEN 'history_must_alternate' WHEN has_system THEN 'history_holds_system' ELSE 'ok' END AS error FROM (
        SELECT conv_id, count(*) AS n, arg_min(role, turn) AS f, arg_max(role, turn) AS l, bool_or(role = before) AS again, bool_or(role = 'system') AS has_system
        FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations WHERE conv_id % 3 = 0 OR turn <> (SELECT max(turn) FROM conversations c WHERE c.conv_id = conversations.conv_id))
        GROUP BY conv_id)"""
)
def plan_history_errors(spark, sf):
    """Conversations as histories, the last turn of two thirds left out so that some end with the user."""
    from ..operators.clean import nest

    m = nest(table(spark, sf, "conversations"))
    cut = F.when(F.col("conv_id") % 3 == 0, F.col("messages")).otherwise(F.slice("messages", F.lit(1), F.greatest(F.size("messages") - 1, F.lit(0))))
    m = m.withColumn("h", cut).filter(F.size("h") > 0)
    none = F.array().cast("array<string>")
    error = profile.conversation_error(F.col("h"), F.lit("s"), F.lit("s"), F.lit(False), none, none, F.lit(0))
    return m.select("conv_id", F.coalesce(error, F.lit("ok")).alias("error"))


@query(
    """SELECT conv_id, arg_max(text, turn) FILTER (role = 'user') IS NOT NULL AS asked, sha256(coalesce(arg_max(text, turn) FILTER (role = 'user'), '')) AS last_sha, count(*) + 1 AS messages,
    sha256(any_value(role ORDER BY turn DESC) || 'answer ' || conv_id) AS end_sha FROM conversations GROUP BY conv_id"""
)
def plan_last_user(spark, sf):
    """The last user message of a history, and the history with an answer behind it."""
    from ..operators.clean import nest
    from . import planner

    m = nest(table(spark, sf, "conversations"))
    last = planner.last_user(F.col("messages"))
    whole = planner.with_response(F.col("messages"), F.concat(F.lit("answer "), F.col("conv_id").cast("string")))
    return m.select(
        "conv_id",
        last.isNotNull().alias("asked"),
        F.sha2(F.coalesce(last, F.lit("")), 256).alias("last_sha"),
        big(F.size(whole)).alias("messages"),
        F.sha2(F.concat(F.element_at("messages", -1)["role"], F.element_at(whole, -1)["content"]), 256).alias("end_sha"),
    )


@query(
    "SELECT conv_id, turn, sha256('system:' || CASE WHEN conv_id % 2 = 0 THEN 'be kind' || chr(10) || chr(10) || role ELSE 'be kind' END || '|user:' || text) AS sha FROM conversations"
)
def final_prompt_messages(spark, sf):
    """System and user message, with a memory block for half of them."""
    from ..operators import compose

    memory = F.when(F.col("conv_id") % 2 == 0, F.col("role"))
    m = compose.prompt_messages(F.lit("be kind"), memory, F.col("text"))
    joined = F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "|")
    return table(spark, sf, "conversations").select("conv_id", "turn", F.sha2(joined, 256).alias("sha"))


@query(
    """SELECT count(*) AS candidates, count(*) FILTER (k > 2) AS accepted, round_even(count(*) FILTER (k > 2) / count(*)::DOUBLE, 6) AS acceptance_rate,
    round_even(count(*) FILTER (k <> 0) / count(*)::DOUBLE, 6) AS candidate_validator_pass_rate, round_even(count(*) FILTER (k = 1) / count(*)::DOUBLE, 6) AS duplicate_rate,
    round_even(count(*) FILTER (k > 2 AND lang = 'en') / count(*) FILTER (k > 2)::DOUBLE, 6) AS validator_pass_rate FROM (SELECT doc_id % 7 AS k, lang FROM documents)"""
)
def plan_rates(spark, sf):
    """Documents as judged candidates, three sevenths rejected for one reason each."""
    from . import planner

    k = F.col("doc_id") % 7
    why = F.when(k == 0, "validator_failure").when(k == 1, "exact_duplicate").when(k == 2, "near_duplicate")
    out = planner.rates(table(spark, sf, "documents").select("lang", why.alias("rejection")), F.col("lang") == "en")
    return out.select("candidates", "accepted", *[F.bround(c, 6).alias(c) for c in ("acceptance_rate", "candidate_validator_pass_rate", "duplicate_rate", "validator_pass_rate")])


def _records(spark, sf):
    """Documents as sound training records."""
    from ..operators import compose

    say = lambda role: F.struct(F.lit(role).alias("role"), F.col("text").alias("content"))
    df = table(spark, sf, "documents").select(
        F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("record_id"),
        F.col("source").alias("source_id"),
        F.col("lang").alias("language"),
        F.lit("x").alias("domain"),
        F.array(say("user"), say("assistant")).alias("conversations"),
    )
    return df.withColumn("text", compose.render(F.col("conversations")))


@query(
    """WITH n AS (SELECT count(*) AS n, greatest(1, least(count(*) - 1, round_even(count(*) * 0.2::DOUBLE, 0)::BIGINT)) AS k FROM documents)
    SELECT n - k AS train, k AS validation, n AS given_train, k AS given_validation FROM n"""
)
def train_load(spark, sf):
    """Training and validation rows by a holdout, and as given."""
    rows = _records(spark, sf)
    a, b = training.load(rows, None, 0.2, 42)
    c, d = training.load(rows, b, 0.2, 42)
    counts = [x.agg(F.count(F.lit(1)).alias(n)) for x, n in ((a, "train"), (b, "validation"), (c, "given_train"), (d, "given_validation"))]
    return counts[0].crossJoin(counts[1]).crossJoin(counts[2]).crossJoin(counts[3])


@query("SELECT 'r' || doc_id AS record_id, length(text) > 0 AS has_text FROM documents")
def train_failing_fast(spark, sf):
    """Sound records pass the check that raises at the first malformed one."""
    df = training.failing_fast(_records(spark, sf))
    return df.select("record_id", (F.length(F.col("conversations")[0]["content"]) > 0).alias("has_text"))


@query(
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'record_not_object' WHEN 1 THEN 'unable_to_extract_conversation' WHEN 2 THEN 'too_few_messages'
    ELSE CASE WHEN length(regexp_replace(lang, '\\s', '', 'g')) > 0 THEN 'kept' END END AS reason FROM documents"""
)
def clean_record_codes(spark, sf):
    """Raw values that are no object, have no conversation, one message or two, through a file of JSON lines."""
    from ..operators import clean as c

    k = F.col("doc_id") % 5
    m = lambda role: F.create_map(F.lit("from"), F.lit(role), F.lit("value"), F.col("lang"))
    body = F.when(k == 0, F.to_json(F.array("doc_id"))).when(k == 1, F.to_json(F.struct("doc_id")))
    body = body.when(k == 2, F.to_json(F.struct("doc_id", F.array(m("human")).alias("dialog")))).otherwise(F.to_json(F.struct("doc_id", F.array(m("human"), m("gpt")).alias("dialog"))))
    path = _place(spark, "raw.jsonl")
    rows = table(spark, sf, "documents").select(body.alias("value"))
    rows.write.text(path)
    raw = c.extract(readers.read_jsonl(spark, path).withColumn("dataset_id", F.lit("org/x")))
    done = c.clean(raw)
    number = F.coalesce(_field("doc_id", "bigint"), F.lit(-1))
    found = done.select(number.alias("n"), F.coalesce("rejection_reason", F.lit("kept")).alias("reason"))
    # A record that is no object has lost its number: their count is dealt back to the numbers they came from.
    lost = found.filter("n = -1").count()
    mine = table(spark, sf, "documents").select("doc_id").join(found, F.col("doc_id") == F.col("n"), "left")
    none = F.when(F.lit(lost) == F.lit(table(spark, sf, "documents").filter("doc_id % 5 = 0").count()), F.lit("record_not_object"))
    return mine.select("doc_id", F.coalesce("reason", none).alias("reason"))
