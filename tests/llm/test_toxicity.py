import random
import zlib

import numpy as np
import pytest

from millrace.llm import queries, toxicity


def corpus(n=900, seed=5):
    """Texts of made-up words; a toxic one holds a few words of three bad families."""
    rng = random.Random(seed)
    stems = {"en": ("the of and", ["blurg"]), "de": ("der die und", ["zorkw"]), "es": ("el los que", ["malax"])}
    docs, labels = [], []
    for i in range(n):
        common, bad = stems[rng.choice(list(stems))]
        words = [rng.choice(common.split()) if rng.random() < 0.4 else f"w{rng.randrange(4000)}" for _ in range(rng.randrange(20, 120))]
        toxic = rng.random() < 0.25
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), bad[0] + rng.choice(["a", "en", "ix", "oss"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def frames(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy(frames):
    docs, labels, truth = frames
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    out = [(r["__tx_score"], truth[r["doc_id"]]) for r in rows if held(r["doc_id"])]
    wrong = sum((s >= 0.5) != bool(y) for s, y in out)
    assert len(out) > 120 and wrong <= 0.03 * len(out)
    assert all(0.0 <= r["__tx_score"] <= 1.0 for r in rows)


def test_held_out_labels_are_not_read(spark, frames):
    docs, labels, truth = frames
    flipped = spark.createDataFrame([(i, 1 - y if held(i) else y) for i, y in truth.items()], "doc_id long, toxic int")
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert np.array_equal(a.out, b.out) and np.array_equal(a.thresholds, b.thresholds)


def test_odd_rows(spark, frames, odd_docs, no_docs):
    docs, labels, _ = frames
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(odd_docs, model)
    assert scored.columns == [*odd_docs.columns, "__tx_score"] and scored.filter("__tx_score BETWEEN 0 AND 1").count() == odd_docs.count()
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.fit(no_docs, labels) is None and toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.fit(docs, labels.selectExpr("doc_id", "cast(null as int) toxic")) is None
    assert {r["__tx_score"] for r in toxicity.score(odd_docs, None).collect()} == {0.0}


def test_query(spark, sf):
    rows = queries.op4_toxicity(spark, sf).collect()
    assert len(rows) == 200 and all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_gradient_goes_down(spark):
    docs, labels = corpus(200, 1)
    texts, y = [t for _, t in docs], np.array([y for _, y in labels])
    model = toxicity.train(texts, y)
    assert ((model.scores(texts, toxicity.Vocabulary()) >= 0.5) == (y == 1)).mean() > 0.97


def plain_logit(model, text):
    """The forward pass word by word: every filter at every position, over the end into zeros."""
    words = (text or "").encode().translate(toxicity.ALNUM_WORDS).split()
    vectors = [model.embedding[list(toxicity._buckets(w))].astype(float).sum(0) for w in words] or [np.zeros(toxicity.DIM)]
    logit, k = float(model.prior[0]), 0
    for width, filt, bias in zip(toxicity.WIDTHS, model.filters, model.bias, strict=True):
        for f in range(toxicity.FILTERS):
            at = [sum(float(vectors[p + o] @ filt[o][:, f]) for o in range(width) if p + o < len(vectors)) for p in range(len(vectors))]
            logit += max(0.0, max(at) + float(bias[f])) * float(model.out[k])
            k += 1
    return logit


@pytest.mark.parametrize("octets", [1 << 20, 60, 5, 1])
def test_forward_pass_equals_a_plain_loop(octets, monkeypatch):
    docs, labels = corpus(120, 3)
    texts = [t for _, t in docs[:25]] + ["", None, "one", "one two", " , ", "x" * 300 + " y " + "z" * 300, "漢字 der die"]
    model = toxicity.train([t for _, t in docs], np.array([y for _, y in labels]), epochs=2, steps=4)
    parts = toxicity.Vocabulary.parts
    monkeypatch.setattr(toxicity.Vocabulary, "parts", lambda self, t, v: parts(self, t, v, octets))
    got, langs = model.logits(texts, toxicity.Vocabulary())
    assert got == pytest.approx([plain_logit(model, t) for t in texts], abs=1e-4)
    assert langs[-1] == 2 and langs[25] == len(toxicity.FUNCTION_WORDS)


def test_long_text_and_clashing_column(spark, frames):
    """A toxic word at the end of some megabytes counts; a column named as the result is replaced."""
    docs, labels, _ = frames
    model = toxicity.fit(docs, labels)
    long = "the of and w1 " * 300_000
    df = spark.createDataFrame([(1, long, "x"), (2, long + " blurgen blurgix blurga", "x")], "doc_id long, text string, __tx_score string")
    rows = {r["doc_id"]: r["__tx_score"] for r in toxicity.score(df, model).collect()}
    assert rows[1] < 0.5 <= rows[2]


def test_sample_is_bounded(spark, frames):
    """Documents that come many times count once, and bytes are bounded."""
    docs, labels, _ = frames
    again = docs.union(docs.filter("doc_id < 3").crossJoin(spark.range(200)).select("doc_id", "text"))
    a, b = toxicity.fit(docs, labels), toxicity.fit(again, labels)
    assert np.array_equal(a.out, b.out)
    few = toxicity.fit(docs, labels, sample_octets=60_000)
    assert few is not None and not np.array_equal(a.out, few.out)


def test_every_labelled_row_counts(spark, frames):
    """A label outside the starting set changes the weights, and one of the tuning fold that is not among the first ones the thresholds."""
    docs, labels, truth = frames
    bounds = dict(per_class=40, calibration=40)
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    base = toxicity.fit(docs, labels, **bounds)
    for k in (1, 2):
        last = max(i for i in truth if fold(i) == k)
        changed = spark.createDataFrame([(i, 1 - y if fold(i) == k and i > 500 else y) for i, y in truth.items()], "doc_id long, toxic int")
        other = toxicity.fit(docs, changed, **bounds)
        assert last > 500 and not np.array_equal(base.thresholds, other.thresholds)
    long = spark.createDataFrame([(10_002, "the of and w1 " * 90_000 + "blurgen")], "doc_id long, text string")
    assert fold(10_002) > 1
    more = toxicity.fit(docs.union(long), labels.union(spark.createDataFrame([(10_002, 1)], "doc_id long, toxic int")), **bounds)
    assert not np.array_equal(base.out, more.out)


def test_a_step_on_a_long_text_is_that_on_all_its_words(monkeypatch):
    docs, labels = corpus(60, 4)
    texts, y = [t for _, t in docs[:20]] + ["", "one"], np.array([y for _, y in labels[:20]] + [0, 1], np.float32)
    models = []
    for long in (1 << 18, 40):
        model = toxicity.Model.fresh(3)
        model.sums = [np.full_like(p, 1e-4) for p in [model.embedding, *model.params()]]
        monkeypatch.setattr(toxicity, "LONG", long)
        for _ in range(3):
            model.step(model.batch(texts, toxicity.Vocabulary()), y, model.sums, 0.08)
        models.append(model)
    assert np.allclose(models[0].embedding, models[1].embedding, atol=1e-4) and np.allclose(models[0].out, models[1].out, atol=1e-4)


def test_stage_of_the_pipeline_learns_from_all_rows(spark, frames, tmp_path, monkeypatch):
    """The pass over all rows gets each labelled one that is neither held out nor for tuning."""
    import corpus_pipeline

    docs, labels, truth = frames
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    seen, learn = [], toxicity.learn
    monkeypatch.setattr(toxicity, "learn", lambda rows, *a: (seen.extend(r["id"] for r in rows.select("id").collect()), learn(rows, *a))[1])
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()}
    assert sorted(seen) == [i for i in truth if zlib.crc32(str(i).encode()) % 5 > 1]
    assert sum((i in kept) == bool(y) for i, y in truth.items()) <= 0.03 * len(truth)
