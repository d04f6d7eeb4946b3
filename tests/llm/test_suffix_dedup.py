import hashlib
import random

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import queries, suffix_dedup

from .test_simple_ops import same_rows


def truth(docs, length=100):
    """By a dictionary of every string's earliest start."""
    keyed = [(-(2**63) if i is None else i, (t or "").encode(), i) for i, t in docs]
    first = {}
    for d, b, _ in keyed:
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, (d, s)), (d, s))
    out = []
    for d, b, i in keyed:
        cut = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < (d, s):
                cut[s : s + length] = True
        spans = int((cut[1:] & ~cut[:-1]).sum() + cut[0])
        kept = bytes(x for x, c in zip(b, cut, strict=False) if not c)
        out.append((i, len(b), int(cut[: len(b)].sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60) | st.lists(st.sampled_from([0, 1, 97, 255]), max_size=80).map(bytes))
def test_suffix_array(data):
    want = sorted(range(len(data)), key=lambda i: data[i:])
    assert suffix_dedup.suffix_array(np.frombuffer(data, np.uint8), 88).tolist() == want or len(data) == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 97, 255]), min_size=1, max_size=80).map(bytes), st.integers(1, 40))
def test_common_prefixes(data, depth):
    text = np.frombuffer(data, np.uint8)
    sa = np.array(sorted(range(len(data)), key=lambda i: data[i:]))
    got = suffix_dedup.common_prefixes(sa, suffix_dedup._words(text), depth)
    padded = data + bytes(depth + 8)  # zeros after the end, as the words have them
    shared = lambda a, b: next((i for i in range(depth) if padded[a + i] != padded[b + i]), depth)
    assert got.tolist() == [0] + [shared(a, b) for a, b in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True)]


def test_repeats_against_brute_force(spark):
    rng = random.Random(9)
    line = "".join(rng.choice("ab ") for _ in range(130))
    passage = "".join(rng.choice("abcdefgh é") for _ in range(400))
    docs = []
    for i in range(60):
        own = "".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(50, 400)))
        a, b = sorted(rng.randrange(400) for _ in range(2))
        docs.append((rng.randrange(500), own[:40] + passage[a:b] + own[40:] + (line if i % 4 == 0 else "")))
    docs += [(600, "x" * 300), (601, "ab" * 120), (602, "y" * 100), (603, "y" * 99), (604, "y" * 101), (605, docs[0][1]), (605, docs[0][1])]
    docs += [(606, passage), (1, passage), (607, passage * 2), (None, "y" * 100), (None, None), (700, "é" * 80 + "z" * 120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(suffix_dedup.remove_repeats(df)) == truth(docs)
    assert got(suffix_dedup.remove_repeats(df, pool_bytes=2000)) == truth(docs)
    # Anchors whose stretches are not held: their windows meet by their bytes.
    assert got(suffix_dedup.remove_repeats(df, group_bytes=600)) == truth(docs)
    assert got(suffix_dedup.remove_repeats(df, group_bytes=1)) == truth(docs)


def test_chunks_of_a_long_text(spark, monkeypatch):
    rng = random.Random(1)
    part = "".join(rng.choice("abc") for _ in range(500))
    text = part + "".join(rng.choice("abc") for _ in range(900)) + part
    data = np.frombuffer(text.encode(), np.uint8)
    whole = suffix_dedup.anchors(data, 100)[0][1]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 128)
    assert np.array_equal(np.concatenate([p for _, p, _ in suffix_dedup.anchors(data, 100)]), whole)


def test_table(spark, sf):
    t = pd.read_parquet(f"{sf}/documents.parquet")
    want = truth(list(t[["doc_id", "text"]].itertuples(index=False, name=None)))
    assert sum(r[2] for r in want) > 0
    assert got(queries.op7_suffix_dedup(spark, sf)) == want
    same_rows(queries.op7_suffix_dedup(spark, sf), queries.ORACLE_SQL["op7_suffix_dedup"], {"documents": t})


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got(suffix_dedup.remove_repeats(odd_docs)) == truth(rows)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
