import pandas as pd

import corpus_pipeline
from millrace.llm import common, decontaminate, queries

from .test_jaccard_join import SPACE_WORDS
from .test_simple_ops import pack_truth


def near_truth(docs):
    """Ids that stay: the smallest of each component at five words and 0.8."""
    sets = {}
    for i, t in docs.items():
        words = (t or "").encode().translate(SPACE_WORDS).split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    top = {i: i for i in docs}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(docs)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i for i in docs if find(i) == i}


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        frames.append(docs := common.materialize(stage(spark, docs, sf), name.replace(" ", "-")))
    assert all(f.columns == frames[0].columns for f in frames[:-1])
    texts = [dict(f.select("doc_id", "text").collect()) for f in frames[:-1]]
    labels = pd.read_parquet(f"{sf}/labels.parquet").set_index("doc_id")["toxic"]
    assert len(texts[0]) > 0.85 * 1000 and labels.reindex(list(texts[0])).fillna(0).mean() < 0.06

    last = {}
    for i, t in texts[0].items():
        key = t.encode().translate(common.LOWER_BYTES)
        last[key] = max(i, last.get(key, i))
    assert set(texts[1]) == set(last.values())
    assert set(texts[2]) == near_truth(texts[1])
    bench = pd.read_parquet(f"{sf}/benchmark.parquet")["text"]
    windows = {w for t in bench for w in decontaminate.windows_of(decontaminate.words_of(t), 10)}
    clean = set()
    for i, t in texts[2].items():
        words = decontaminate.words_of(t)
        if not any(tuple(words[s : s + len(w)]) == w for w in windows for s in [k for k, x in enumerate(words) if x == w[0]]):
            clean.add(i)
    assert set(texts[3]) == clean and len(clean) < len(texts[2])
    pack_truth(texts[3], queries.tokenizer_path("word_bpe_49k.json"), frames[-1].collect())


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(1, 1), (5, 0), (8, None)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "漢字 inst")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clash = odd_docs.selectExpr("*", "'a' __xd_kept", "'b' __tx_score", "'c' __dc_n_hit", "'d' __jj_id", "array('e') __dc_items", "1 component_id")
    for docs in (odd_docs, no_docs, clash):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, common.materialize(stage(spark, docs, str(tmp_path)), "stage")
            assert name == "packing" or docs.columns == before.columns
        assert docs.count() >= (n > 0)
