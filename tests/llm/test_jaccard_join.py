import random

import numpy as np
import pandas as pd
import pytest

from millrace.llm import jaccard_join, queries
from millrace.llm.common import SPACE_WORDS

from .test_simple_ops import same_rows


def sets_of(text):
    words = (text or "").encode().translate(SPACE_WORDS).split()
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def truth(docs):
    sets = [(i, sets_of(t)) for i, t in docs if i is not None]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            both = len(x & y)
            if x and y and 100 * both >= 85 * (len(x) + len(y) - both):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return sorted((i, len(sets_of(t)), None if i is None else find(i)) for i, t in docs if i is not None)


def got(df):
    return sorted(tuple(r) for r in df.collect() if r["doc_id"] is not None)


def mutated(rng, words, rate):
    return [w if rng.random() > rate else f"m{rng.randrange(10**6)}" for w in words]


def test_equals_brute_force_on_families(spark):
    rng = random.Random(3)
    docs, passage = [], [f"p{i}" for i in range(60)]
    for family in range(12):
        base = [f"f{family}w{rng.randrange(60)}" for _ in range(rng.choice([3, 8, 40, 150]))]
        for _ in range(rng.choice([1, 5, 30])):
            words = mutated(rng, base, rng.choice([0, 0.01, 0.02, 0.05]))
            docs.append(" ".join(words + passage * (rng.random() < 0.3)))
    docs += ["", " ", "one", "ONE", "one two three", "one two three ", "z " * 500, "z " * 4]
    rows = [(1000 - 3 * i, t) for i, t in enumerate(docs)] + [(5, None), (None, "one"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = truth(rows)
    assert len({c for _, n, c in want if n}) < len(want) - 40
    assert got(jaccard_join.jaccard_components(df)) == want


def test_lists_over_many_blocks(spark, monkeypatch):
    """Long lists of several components, cut into blocks of a few: nothing is lost."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 12)
    rng = random.Random(8)
    common = [f"c{i}" for i in range(30)]
    rows = []
    for family in range(5):
        base = common + [f"f{family}w{i}" for i in range(20)]
        rows += [(len(rows) + i, " ".join(mutated(rng, base, 0.012))) for i in range(40)]
    rows += [(i, None if i % 2 else "  ") for i in range(1000, 1100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = truth(rows)
    assert 5 < len({c for _, n, c in want if n}) < 190
    assert got(jaccard_join.jaccard_components(df)) == want


def test_live_lists_over_batches():
    """Groups with a neighbour of near size, wherever batches end."""
    import pyarrow as pa

    rng = random.Random(1)
    rows = sorted({(rng.randrange(12), rng.choice([5, 9, 10, 11, 40, 41]), rng.randrange(9)) for _ in range(120)})
    rows = [(t, 100 * n + g, n) for t, n, g in rows]
    want = []
    for i, r in enumerate(rows):
        near = lambda a, b: a[0] == b[0] and a[2] * 100 >= 85 * b[2]
        if (i and near(rows[i - 1], r)) or (i + 1 < len(rows) and near(r, rows[i + 1])):
            want.append(r)
    for size in (1, 2, 7, 500):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + size], strict=True)], names=["token", "gid", "n"]) for i in range(0, len(rows), size)]
        found = [tuple(r.values()) for b in jaccard_join._live_lists(85)(iter(batches)) for r in b.to_pylist()]
        assert found == want


@pytest.mark.parametrize("block", [1024, 40])
def test_large_group_stays_linear(spark, monkeypatch, block):
    """A group of near copies tries pairs in proportion to its size, also over many blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(300)]
    rows = [(i, " ".join(mutated(rng, base, 0.004))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tried = []
    verify = jaccard_join._verify
    jaccard_join._verify = lambda pairs, *a: tried.append(pairs.count()) or verify(pairs, *a)
    try:
        assert got(jaccard_join.jaccard_components(df)) == truth(rows)
    finally:
        jaccard_join._verify = verify
    assert sum(tried) < 400 * (10 if block > 400 else 40)


def test_equals_sql(spark, sf):
    tables = {"documents": pd.read_parquet(f"{sf}/documents.parquet")}
    same_rows(queries.op8_ngram_jaccard(spark, sf), queries.ORACLE_SQL["op8_ngram_jaccard"], tables)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = got(jaccard_join.jaccard_components(odd_docs))
    assert (3, 0, 3) in rows and (4, 0, 4) in rows and (2, 1, 1) in rows
    assert len(rows) == 10 and {r[2] for r in rows if r[0] in (5, 6)} == {5}
    assert jaccard_join.jaccard_components(no_docs).count() == 0


def test_whole_sequence_is_no_shingle_of_another_width():
    h = jaccard_join.WordHash()
    assert not np.intersect1d(jaccard_join.shingle_set("a b c", 4, h), jaccard_join.shingle_set("a b c d", 4, h)).size


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = np.unique(rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64))
        y = np.unique(np.append(x[rng.random(len(x)) < rng.random()], rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64)))
        real = len(np.setxor1d(x, y))
        assert jaccard_join.least_difference(jaccard_join.bitmap(x), jaccard_join.bitmap(y)) <= real


def test_versions_of_one_document_keep_their_links(spark):
    """An identifier with two texts, each with near copies of its own, also where it is not the least of a class."""
    text = lambda name, n, odd=None: " ".join([*(f"{name}{i}" for i in range(n)), *([odd] if odd else [])])
    rows = [(1, text("a", 100)), (1, text("b", 60)), (2, text("a", 100, "x")), (3, text("b", 60, "y")), (9, text("c", 80))]
    rows += [(4, text("d", 50)), (5, text("d", 50)), (5, text("e", 70)), (6, text("e", 70, "z")), (7, text("f", 90))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(df).collect()}
    assert {(i, c) for i, _, c in got} == {(1, 1), (2, 1), (3, 1), (9, 9), (4, 4), (5, 4), (6, 4), (7, 7)}
