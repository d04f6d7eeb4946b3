"""A text of some ten megabytes among short ones, through every operator that reads documents."""

import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, exact_dedup, jaccard_join, ngram_lm, packing, queries, sharding, suffix_dedup, token_count

WORDS = 1_800_000
LONG = " ".join(f"w{i % 99_991}" for i in range(WORDS))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, LONG), (2, LONG.upper()), (3, "w1 w2 w3 w4 w5"), (4, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_sharding_and_exact_dedup(docs):
    size = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in sharding.assign_shards(docs, queries.SHARDS).collect()}
    assert size[1] == (len(LONG) + 16, zlib.crc32(LONG.encode())) and size[4] == (16, 0)
    kept = by_id(exact_dedup.exact_dedup(docs))
    assert (kept[2]["__xd_keep_id"], kept[2]["__xd_group_size"], kept[2]["__xd_kept"]) == (1, 2, False)


def test_counts_and_packing(docs):
    counts = by_id(token_count.count_tokens(docs.filter("doc_id <> 2"), queries.tokenizer_path("piece_bpe_32k.model")))
    assert counts[1]["n_tokens"] > WORDS and counts[4]["n_tokens"] == 0
    rows = packing.pack(docs.filter("doc_id <> 2"), queries.tokenizer_path("word_bpe_49k.json")).collect()
    mine = sorted((r["start"], r["length"]) for r in rows if r["doc_id"] == 1)
    assert sum(n for _, n in mine) == next(r["doc_tokens"] for r in rows if r["doc_id"] == 1)
    assert [s for s, _ in mine] == list(range(0, sum(n for _, n in mine), 2048))


def test_language_model(docs):
    rows = by_id(ngram_lm.score_texts(docs, F.col("doc_id") == 2))
    assert rows[1]["n_tokens"] == rows[2]["n_tokens"] == rows[2]["n_known"] == WORDS + 1
    # The held-out text is the one that was learned.
    assert rows[2]["score"] == pytest.approx(rows[1]["score"], rel=1e-9) and rows[2]["score"] > rows[2]["base_score"]


def test_joins(docs, spark):
    found = by_id(jaccard_join.jaccard_components(docs))
    assert found[1]["component_id"] == found[2]["component_id"] == 1 and found[3]["component_id"] == 3
    item = " ".join(f"w{i}" for i in range(99_980, 99_991)) + " w0 w1 w2"
    hits = by_id(decontaminate.decontaminate(docs, spark.createDataFrame([("i", item)], "item_id string, text string")))
    assert hits[1]["__dc_n_words"] == WORDS and hits[1]["__dc_n_hit"] == 14 * (WORDS // 99_991) and hits[3]["__dc_n_hit"] == 0


def test_suffix_dedup(docs):
    rows = by_id(suffix_dedup.remove_repeats(docs.filter("doc_id <> 2")))
    period = len(" ".join(f"w{i}" for i in range(99_991))) + 1
    # Every period but the first one repeats it; what wraps round from one to the next is new once.
    assert rows[1]["n_bytes"] == len(LONG) and rows[1]["n_removed"] == len(LONG) - period and rows[1]["n_spans"] == 1
