import math
import random
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import ngram_lm, queries
from millrace.llm.common import SPACE_WORDS


def tokens_of(text):
    return [*(text or "").encode().translate(SPACE_WORDS).split(), b" end"]


def truth(docs, order=3, priors=ngram_lm.PRIORS):
    """(doc_id, held, text) to exact results, the score with frequencies not quantised."""
    counts, after = Counter(), Counter()
    for _, held, text in docs:
        if not held:
            t = [b" start", *tokens_of(text)]
            for n in range(1, order + 1):
                for i in range(len(t) - n + 1):
                    gram = tuple(t[i : i + n])
                    if gram != (b" start",):
                        counts[gram] += 1
                        after[gram[:-1]] += 1
    uni = {g[0]: c for g, c in counts.items() if len(g) == 1}
    n, v = sum(uni.values()), len(uni)
    out = {}
    for i, held, text in docs:
        t, base, score = [b" start", *tokens_of(text)], 0.0, 0.0
        for j in range(1, len(t)):
            c = uni.get(t[j], 0)
            base += math.log10((c + 1) / (n + v + 1))
            p = (c + 1) / (n + v + 1)
            for k in range(2, order + 1):
                if j - k + 1 >= 0:
                    m, ctx = priors[min(k - 2, len(priors) - 1)], tuple(t[j - k + 1 : j])
                    p = (counts[(*ctx, t[j])] + m * p) / (after[ctx] + m)
            score += math.log10(p)
        out[i] = (held, len(t) - 1, sum(w in uni for w in t[1:]), n, base, score)
    return out


def compare(rows, want, loss):
    assert len(rows) == len(want)
    for r in rows:
        w = want[r["doc_id"]]
        assert tuple(r)[1:5] == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9)
        # Rounded down by the code book, never up.
        assert w[5] - loss * r["n_tokens"] <= r["score"] <= w[5] + 1e-6


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=200), st.integers(1, 4))
def test_elias_fano(values, scale):
    values = np.sort(np.array(values, np.int64) >> (10 * (scale - 1)))
    ngram_lm.CHUNK = 16
    try:
        ef = ngram_lm.EliasFano.encode(values)
        assert np.array_equal(np.concatenate([ef.chunk(k) for k in range(ef.samples.shape[1])]), values)
        assert np.array_equal(ef.get(np.arange(len(values))), values)
        distinct = np.unique(values)
        ef = ngram_lm.EliasFano.encode(distinct)
        keys = np.unique(np.append(distinct, distinct + 1))
        n = len(distinct)
        for first, stop in ((0, n), (n // 3, n - n // 4), (n // 2, n // 2)):
            found = ef.find(keys, np.full(len(keys), first), np.full(len(keys), stop))
            assert np.array_equal(found >= 0, np.isin(keys, distinct[first:stop]))
            assert np.array_equal(distinct[found[found >= 0]], keys[found >= 0])
    finally:
        ngram_lm.CHUNK = 4096


@settings(max_examples=150, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 12), st.integers(0, 30)), min_size=1), st.sets(st.tuples(st.integers(0, 13), st.integers(0, 40)), min_size=1))
def test_level_on_disk(held, asked):
    """Words of other contexts, or over a context's last one, are not found in it."""
    held, asked = sorted(held), sorted(asked)
    ngram_lm.CHUNK = 8
    try:
        with tempfile.TemporaryFile() as f:
            c, w = np.array(held).T
            ngram_lm.Level.build(c, w, (np.arange(len(held)) % 255 + 1).astype(np.uint8)).save(f)
            ctx, kinds = np.unique([a for a, _ in asked], return_counts=True)
            codes, place = ngram_lm.Level.open(f).query(ctx, kinds, np.array([b for _, b in asked]))
    finally:
        ngram_lm.CHUNK = 4096
    want = [held.index(x) if x in held else -1 for x in asked]
    assert place.tolist() == want
    assert codes.tolist() == [x % 255 + 1 if x >= 0 else 0 for x in want]


def test_codes_round_down():
    book = ngram_lm.CodeBook(1_000_000)
    share = np.append(10.0 ** -np.linspace(0.0001, 6, 999), [0.0, 0.5, 1.0])
    value = book.values[book.codes(share)]
    assert (value <= share).all() and (value[:999] > share[:999] / 10 ** (8.01 / 254)).all()


def test_table(spark, sf):
    t = pd.read_parquet(f"{sf}/documents.parquet")
    docs = [(i, zlib.crc32(str(i).encode()) % 7 == 2, x) for i, x in zip(t["doc_id"], t["text"], strict=True)]
    rows = queries.op6_ngram_lm(spark, sf).collect()
    compare(rows, truth(docs), 0.04)
    gain = sum(r["score"] - r["base_score"] for r in rows if r["held_out"])
    assert gain > 0


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_many_blocks_and_shards(spark, order):
    rng = random.Random(2)
    docs = [(i, i % 5 == 0, " ".join(rng.choice(["the", "The", "a", f"w{rng.randrange(300)}"]) for _ in range(rng.randrange(60)))) for i in range(300)]
    docs += [(300 + i, i % 2 == 0, "over and over the very same words " * 3) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, held boolean, text string")
    few = ngram_lm.score_texts(df, F.col("held"), order=order, block_tokens=400, shard_tokens=1500).collect()
    compare(few, truth(docs, order), 0.05)
    # Numbers of blocks and shards change nothing.
    one = {r["doc_id"]: r["score"] for r in ngram_lm.score_texts(df, F.col("held"), order=order).collect()}
    for r in few:
        assert r["score"] == pytest.approx(one[r["doc_id"]], rel=1e-9)


def test_repeated_texts_stand_out(spark, sf):
    """A held-out text with a copy in training scores far above those without one."""
    t = pd.read_parquet(f"{sf}/documents.parquet")
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in t["doc_id"]]
    seen = set(t["text"][[not h for h in held]])
    rows = {r["doc_id"]: r["score"] / r["n_tokens"] for r in queries.op6_ngram_lm(spark, sf).collect()}
    again = [rows[i] for i, x, h in zip(t["doc_id"], t["text"], held, strict=True) if h and x in seen]
    alone = [rows[i] for i, x, h in zip(t["doc_id"], t["text"], held, strict=True) if h and x not in seen]
    assert not again or np.median(again) > np.median(alone) + 0.5


def test_sizes_grow_with_the_square_root():
    """Rows of an exchange (blocks times shards) are at most the pairs by CELL, whatever the corpus."""
    for tokens in (10**6, 10**9, 10**11, 10**13):
        size = ngram_lm.block_size(tokens)
        rows = max(1, tokens / size) * max(1, tokens / (2 * size))
        assert rows <= 1.01 * max(tokens / ngram_lm.CELL, tokens / size)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = ngram_lm.score_texts(odd_docs, F.lit(None).cast("boolean")).collect()
    assert len(rows) == odd_docs.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 7)} == {1}
    assert ngram_lm.score_texts(no_docs, F.lit(False)).count() == 0
    none = ngram_lm.score_texts(odd_docs, F.lit(True)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in none} == {(0, 0, 0.0)}
