"""Toxicity: a convolutional text classifier trained here in numpy.

A word's embedding is the sum of the hashed embeddings of the word and of its
first four and five characters (insults come in families of one stem). Filters
of widths 1, 2 and 3 run over a whole text; each keeps its largest response, and
a linear layer on those gives the logit. As filters are linear before pooling,
each distinct word of a part is multiplied once and positions only add rows. A
long text is walked part by part, with the largest responses carried along.

It learns from every labelled row outside the held-out and the tuning fold, in
two steps. The driver finds a starting point on a bounded set of rows; from
there all rows are passed once, shard by shard over all tasks, and the shards'
changes are averaged (a bucket's vector over the shards that have its words).
Of a long text a step sees the windows with the largest responses, which are
all that its gradient depends on.

Thresholds are calibrated by language on all labelled rows of the tuning fold,
of which the weights have seen none. They come from counts of logits in steps of
1/1024. The language is told from function words of the text itself.
"""

from __future__ import annotations

import copy
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORDS, few, materialize, scratch, slices, trim
from .jaccard_join import _typed

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
#: Characters from which on a step sees a text's strongest windows alone; bytes of text in a shard; steps of a logit.
LONG, SHARD_OCTETS, FINE = 1 << 18, 8 << 20, 1024
#: Buckets in a block of the table when changes are added up.
BLOCK = 1024

# Common function words of the languages told apart.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was",
    "fr": "le la les et des du est une dans pour",
    "de": "der die das und ist den von mit zu ein",
    "es": "el los las que una y por del con para",
}
LANGUAGE = {w.encode(): i for i, ws in enumerate(FUNCTION_WORDS.values()) for w in ws.split()}


def crc32_of_id(col):
    return F.crc32(F.encode(col.cast("string"), "UTF-8"))


def _buckets(word: bytes) -> tuple[int, int, int]:
    text = word.decode("utf-8", "replace")
    parts = (b"w" + word, b"4" + text[:4].encode(), b"5" + text[:5].encode())
    return tuple(zlib.crc32(p) % (BUCKETS - 1) + 1 for p in parts)  # bucket 0 is padding


@dataclass
class Part:
    """Pieces of texts: words' buckets, positions as indices into them (0 is padding), where pieces begin, whose they are, which go on."""

    rows: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    owner: np.ndarray
    more: np.ndarray


class Vocabulary:
    """Words to buckets, kept up to a bound."""

    def __init__(self, bound: int = 100_000):
        self.seen: dict[bytes, tuple[int, int, int]] = {}
        self.bound = bound

    def buckets(self, words) -> np.ndarray:
        """A row for each word, after one for the padding."""
        seen, rows = self.seen, [(0, 0, 0)]
        if len(seen) > self.bound:
            seen.clear()
        for w in words:
            got = seen.get(w)
            if got is None:
                got = seen[w] = _buckets(w)
            rows.append(got)
        return np.array(rows, np.int32)

    def parts(self, texts: list[str | None], votes: np.ndarray, octets: int = 1 << 20):
        """``Part`` by ``Part`` of about so many bytes; adds up what words say of each text's language."""
        local, ids, starts, owner, more, size = {b"": 0}, [], [], [], [], 0
        for i, text in enumerate(texts):
            for words, before, goes_on in pieces(text, octets):
                starts.append(len(ids))
                owner.append(i)
                more.append(goes_on)
                for w in words:
                    votes[i, LANGUAGE.get(w, -1)] += 1
                ids += [local.setdefault(w, len(local)) for w in before + words] or [0]
                ids += [0, 0]
                size += sum(map(len, words)) + len(words)
                if size >= octets:
                    yield Part(self.buckets(list(local)[1:]), *map(np.array, (ids, starts, owner, more)))
                    local, ids, starts, owner, more, size = {b"": 0}, [], [], [], [], 0
        if ids:
            yield Part(self.buckets(list(local)[1:]), *map(np.array, (ids, starts, owner, more)))


def pieces(text: str | None, octets: int):
    """A text's words by pieces of about so many bytes: (words, the two words before them, whether more follow)."""
    raw = (text or "").encode("utf-8", "replace").translate(ALNUM_WORDS)
    at, before, held = 0, [], None
    while at < len(raw):
        stop = raw.find(b" ", at + octets)
        stop = len(raw) if stop < 0 else stop
        words = raw[at:stop].split()
        at = stop
        if words:
            if held:
                yield *held, True
            held = (words, before)
            before = (before + words)[-2:]
    yield *(held or ([], [])), False


def languages(votes: np.ndarray) -> np.ndarray:
    """Index of the language with most function words, the number of languages where there are none."""
    own = votes[:, :-1]
    return np.where(own.max(axis=1) > 0, own.argmax(axis=1), own.shape[1])


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    prior: np.ndarray
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(FUNCTION_WORDS) + 1))
    #: Adagrad's sums, while it learns.
    sums: list[np.ndarray] | None = None

    @staticmethod
    def fresh(seed: int) -> "Model":
        rng = np.random.default_rng(seed)
        e = (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
        e[0] = 0
        f = [(rng.standard_normal((w, DIM, FILTERS)) * 0.3 / w).astype(np.float32) for w in WIDTHS]
        out = (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32)
        return Model(e, f, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], out, np.zeros(1, np.float32))

    def responses(self, part: Part):
        """Word vectors, and by width the responses at each position and the largest in each piece.

        Filters reach over a text's end into padding. Where a piece goes on they
        don't: the next one has its last two words once more.
        """
        rows, ids, starts = part.rows, part.ids, part.starts
        vectors = self.embedding[rows].sum(1)
        n = len(ids)
        stop = np.append(starts[1:], n)
        pads = np.concatenate([stop - 1, stop - 2])
        every = []
        for w, filt in zip(WIDTHS, self.filters, strict=True):
            z = (vectors @ filt[0])[ids]
            for o in range(1, w):
                z[: n - o] += (vectors @ filt[o])[ids[o:]]
            z[pads] = -np.inf
            for o in range(1, w):
                over = (stop - 2 - o)[part.more]
                z[over[over >= starts[part.more]]] = -np.inf
            every.append((z, np.maximum.reduceat(z, starts, axis=0)))
        return vectors, every

    def logits(self, texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Logits and languages of whole texts, held a part at a time."""
        votes = np.zeros((len(texts), len(FUNCTION_WORDS) + 1), np.int64)
        pooled = np.full((len(texts), FILTERS * len(WIDTHS)), -np.inf, np.float32)
        for part in vocabulary.parts(texts, votes):
            _, every = self.responses(part)
            np.maximum.at(pooled, part.owner, np.concatenate([top for _, top in every], axis=1))
        return np.maximum(pooled + np.concatenate(self.bias), 0) @ self.out + self.prior[0], languages(votes)

    def scores(self, texts: list[str | None], vocabulary: Vocabulary) -> np.ndarray:
        x, langs = self.logits(texts, vocabulary)
        return 1 / (1 + np.exp(-np.clip(x - self.thresholds[langs], -30, 30)))

    def params(self) -> list[np.ndarray]:
        """All but the embedding."""
        return [self.out, self.prior] + [x for k in range(len(WIDTHS)) for x in (self.filters[k], self.bias[k])]

    def winners(self, text: str) -> list[tuple[list[bytes], bool]]:
        """Pieces (words, whether the text goes on) with the largest response of every filter; all their windows are the text's."""
        most = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
        found: dict[tuple[int, int], tuple[tuple[bytes, ...], bool]] = {}
        for words, before, goes_on in pieces(text, LONG):
            seq = before + words
            local = {b"": 0}
            ids = [local.setdefault(w, len(local)) for w in seq] or [0]
            part = Part(Vocabulary().buckets(list(local)[1:]), np.array([*ids, 0, 0]), np.array([0]), np.array([0]), np.array([goes_on]))
            for k, (z, top) in enumerate(self.responses(part)[1]):
                for f in np.flatnonzero(top[0] > most[k]):
                    most[k, f] = top[0, f]
                    at = int(z[:, f].argmax())
                    found[k, f] = tuple(seq[at : at + WIDTHS[k]]), at + WIDTHS[k] <= len(seq)
        return [(list(words), inside) for words, inside in dict.fromkeys(found.values())]

    def batch(self, texts: list[str | None], vocabulary: Vocabulary) -> Part:
        """What a step needs of some texts."""
        local, ids, starts, owner, more = {b"": 0}, [], [], [], []
        for i, text in enumerate(texts):
            text = text or ""
            whole = [(text.encode("utf-8", "replace").translate(ALNUM_WORDS).split(), False)] if len(text) <= LONG else self.winners(text)
            for words, goes_on in whole:
                starts.append(len(ids))
                owner.append(i)
                more.append(goes_on)
                ids += [local.setdefault(w, len(local)) for w in words] or [0]
                ids += [0, 0]
        return Part(vocabulary.buckets(list(local)[1:]), np.array(ids), np.array(starts), np.array(owner), np.array(more))

    def step(self, part: Part, y: np.ndarray, sums: list[np.ndarray], rate: float) -> None:
        """One Adagrad step on the logistic loss."""
        rows, ids, starts = part.rows, part.ids, part.starts
        vectors, every = self.responses(part)
        begins = np.flatnonzero(np.diff(part.owner, prepend=-1))
        every = [(z, np.maximum.reduceat(top, begins, axis=0)) for z, top in every]
        acts = [np.maximum(top + b, 0) for (_, top), b in zip(every, self.bias, strict=True)]
        pooled = np.concatenate(acts, axis=1)
        logit = pooled @ self.out + self.prior[0]
        err = ((1 / (1 + np.exp(-np.clip(logit, -30, 30)))) - y).astype(np.float32) / len(y)
        d_pooled = err[:, None] * self.out[None, :]
        d_vec = np.zeros_like(vectors)
        grads = [pooled.T @ err, np.array([err.sum()], np.float32)]
        lengths = np.diff(np.append(starts, len(ids)))
        text_of = np.repeat(part.owner, lengths)
        for k, (w, (z, top)) in enumerate(zip(WIDTHS, every, strict=True)):
            d = d_pooled[:, k * FILTERS : (k + 1) * FILTERS] * (acts[k] > 0)
            at, f = np.nonzero(z == top[text_of])
            _, first = np.unique(text_of[at] * FILTERS + f, return_index=True)
            at, f = at[first], f[first]
            g = d[text_of[at], f]
            d_filt = np.zeros_like(self.filters[k])
            for o in range(w):
                word = ids[at + o]
                np.add.at(d_filt[o].T, f, g[:, None] * vectors[word])
                np.add.at(d_vec, word, g[:, None] * self.filters[k][o].T[f])
            grads += [d_filt, d.sum(0)]
        for p, g, s in zip(self.params(), grads, sums[1:], strict=True):
            s += g * g
            p -= rate * g / (np.sqrt(s) + 1e-6)
        live = np.flatnonzero(np.abs(d_vec).sum(1))
        d_rows = np.zeros((len(live) * 3, DIM), np.float32)
        flat = rows[live].reshape(-1)
        d_rows[:] = np.repeat(d_vec[live], 3, axis=0)
        touched, inv = np.unique(flat, return_inverse=True)
        g = np.zeros((len(touched), DIM), np.float32)
        np.add.at(g, inv, d_rows)
        g[touched == 0] = 0
        sums[0][touched] += g * g
        self.embedding[touched] -= rate * g / (np.sqrt(sums[0][touched]) + 1e-6)


class Sample:
    """Texts as numbers of words, cut into words once for all epochs."""

    def __init__(self, texts: list[str]):
        local: dict[bytes, int] = {b"": 0}
        self.texts = []
        for text in texts:
            words = (text or "").encode("utf-8", "replace").translate(ALNUM_WORDS).split()
            self.texts.append(np.array([*([local.setdefault(w, len(local)) for w in words] or [0]), 0, 0], np.int32))
        self.rows = Vocabulary(len(local) + 1).buckets(list(local)[1:])

    def part(self, which) -> Part:
        some = [self.texts[i] for i in which]
        lengths = np.array([len(t) for t in some])
        words, ids = np.unique(np.concatenate(some), return_inverse=True)
        k = np.arange(len(some))
        return Part(self.rows[words], ids, np.cumsum(lengths) - lengths, k, np.zeros(len(some), bool))


def _loss(x: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y == 1, -x, x)).mean())


def train(texts: "list[str] | Sample", y: np.ndarray, tune: tuple[list[str], np.ndarray] | None = None, epochs: int = 8, steps: int = 500, rate: float = 0.08, seed: int = 11) -> Model:
    """At least so many epochs and, up to 60 epochs, so many steps: small samples are passed more often.

    It ends early where the loss on the rows of ``tune`` has not fallen by a
    fiftieth for two epochs, and takes the epoch with the least.
    """
    sample = texts if isinstance(texts, Sample) else Sample(texts)
    n = len(sample.texts)
    epochs = min(60, max(epochs, -(-steps * 64 // n)))
    model = Model.fresh(seed)
    sums = model.sums = [np.full_like(p, 1e-4) for p in [model.embedding, *model.params()]]
    rng, best, least, since = np.random.default_rng(seed), None, np.inf, 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 64):
            part = order[at : at + 64]
            model.step(sample.part(part), y[part].astype(np.float32), sums, rate)
        if tune is not None:
            loss = _loss(model.logits(tune[0], Vocabulary())[0], tune[1])
            since = 0 if loss < 0.98 * least else since + 1
            if loss < least:
                best, least = copy.deepcopy(model), loss
            if since == 2:
                break
    return best or model


def learn(rows: DataFrame, model: Model, shards: int, rate: float = 0.08) -> None:
    """Pass all ``rows`` (id, mix, text, y) once in so many shards, each from the same start, and average what they change."""
    shape = model.embedding.shape
    blocks = shape[0] // BLOCK

    def shard(key, batches):
        own, vocabulary, size = copy.deepcopy(model), Vocabulary(), 0
        table = pa.Table.from_batches(list(batches)).sort_by([("mix", "ascending"), ("id", "ascending")])
        some, y = [], []

        def go():
            own.step(own.batch(some, vocabulary), np.array(y, np.float32), own.sums, rate)
            some.clear(), y.clear()

        for batch in slices(table.to_batches(), 64):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                some.append(text)
                y.append(label)
                size += min(len(text), LONG)
                if len(some) == 64 or size >= 1 << 20:
                    go()
                    size = 0
        if some:
            go()
        change = own.embedding - model.embedding
        rest = np.concatenate([(a - b).ravel() for a, b in zip(own.params(), model.params(), strict=True)])
        out = [x.tobytes() for x in change.reshape(blocks, -1)] + [rest.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(range(blocks + 1), pa.int32()), pa.array([key[0].as_py()] * (blocks + 1), pa.int64()), pa.array(out, pa.binary())], names=["block", "shard", "x"])
        trim()

    def mean(key, batches):
        total = n = None
        for x in pa.Table.from_batches(list(batches)).sort_by("shard")["x"].to_pylist():
            x = np.frombuffer(x, np.float32).reshape(-1, DIM if key[0].as_py() < blocks else 1)
            # A bucket counts for the shards that have its words, any other parameter for all.
            moved = np.any(x != 0, axis=1) if key[0].as_py() < blocks else np.ones(len(x), bool)
            total, n = (x.astype(np.float64), moved.astype(np.int64)) if total is None else (total + x, n + moved)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([(total / np.maximum(n, 1)[:, None]).astype(np.float32).tobytes()])], names=["block", "x"])

    dealt = rows.select("id", "mix", "text", "y", F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(shards)).alias("shard"))
    changes = dealt.groupBy("shard").applyInArrow(_typed(shard), "block int, shard bigint, x binary")
    got = changes.groupBy("block").applyInArrow(_typed(mean), "block int, x binary")
    with scratch(rows.sparkSession):
        for r in materialize(got, "changes").collect():
            x = np.frombuffer(r["x"], np.float32)
            if r["block"] < blocks:
                model.embedding[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] += x.reshape(-1, DIM)
                continue
            at = 0
            for p in model.params():
                p += x[at : at + p.size].reshape(p.shape)
                at += p.size


def _threshold(x: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> float:
    """The cut with the best F1, in the middle of its gap: of ``n`` rows with logit ``x``, ``toxic`` are so."""
    order = np.argsort(-x, kind="stable")
    x, t, n = x[order], np.cumsum(toxic[order]), np.cumsum(n[order])
    f1 = 2 * t / (n + t[-1])
    best = int(np.flatnonzero(f1 >= f1.max() - 1e-12)[0])
    below = x[best + 1] if best + 1 < len(x) else x[best] - 2
    return float((x[best] + below) / 2)


def calibrate(model: Model, rows: DataFrame, least: int = 25) -> None:
    """Set the thresholds by language on all ``rows`` (text, y); a language with few labelled rows gets the common one."""

    def count(batches):
        vocabulary = Vocabulary()
        for batch in slices(batches):
            x, lang = model.logits(batch.column(0).to_pylist(), vocabulary)
            y = batch.column(1).to_numpy()
            cells, at = np.unique(np.stack([lang, np.rint(np.clip(x, -60, 60) * FINE).astype(np.int64)]), axis=1, return_inverse=True)
            at = at.ravel()
            cols = [*cells, np.bincount(at, weights=y).astype(np.int64), np.bincount(at)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["lang", "x", "toxic", "n"])

    counts = rows.select("text", "y").mapInArrow(count, "lang bigint, x bigint, toxic bigint, n bigint")
    counts = counts.groupBy("lang", "x").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).orderBy("lang", "x").toArrow()
    lang, x, toxic, n = (c.to_numpy() for c in counts.columns)
    x = x / FINE
    values, at = np.unique(x, return_inverse=True)
    common = _threshold(values, np.bincount(at, weights=toxic), np.bincount(at, weights=n))
    for i in range(len(model.thresholds)):
        own = lang == i
        enough = toxic[own].sum() >= least and (n - toxic)[own].sum() >= least
        model.thresholds[i] = _threshold(x[own], toxic[own], n[own]) if enough else common


def fit(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_out: int = 0,
    per_class: int = 3000,
    calibration: int = 6000,
    sample_octets: int = 96 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model | None:
    """Learn from all labelled rows that are not held out, and calibrate on all of the tuning fold.

    Only the starting point comes from a bounded set on the driver: at most
    ``per_class`` rows of either label, and ``calibration`` rows of the tuning
    fold (1500 at most) to tell when to stop, with ``sample_octets`` bytes
    together. They are taken in the order of a hash as long as they fit, texts of
    over a megabyte not among them. Of several texts of one document the least is taken. Rows whose
    ``crc32(id) % folds`` is ``held_out`` are never read for their labels. Null
    labels count as none; of several labels of one document the highest counts.
    Without both labels there is no model. A task holds a shard of some
    ``SHARD_OCTETS`` bytes and one text more.
    """
    fold = lambda x: F.pmod(crc32_of_id(x), F.lit(folds))
    tuning = (held_out + 1) % folds
    with scratch(docs.sparkSession):
        known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("id"))
        known = known.agg(F.max(label_col).cast("int").alias("y")).withColumn("fold", fold(F.col("id"))).filter(F.col("fold") != held_out)
        known = materialize(known, "labels")
        found = docs.filter(fold(F.col(id_col)) != held_out).select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
        found = found.join(few(known), "id").groupBy("id", "y", "fold").agg(F.min("text").alias("text"))
        found = found.withColumns({"mix": F.xxhash64("id", F.lit("sample")), "size": F.octet_length("text").cast("bigint")})
        found = materialize(found, "labelled")
        rest, tune = found.filter(F.col("fold") != tuning), found.filter(F.col("fold") == tuning)
        seen = {r["tune"]: r for r in found.groupBy((F.col("fold") == tuning).alias("tune")).agg(F.count_distinct("y").alias("labels"), F.sum("size").alias("size")).collect()}
        if False not in seen or seen[False]["labels"] < 2:
            return None
        apart = True in seen and seen[True]["labels"] == 2
        model = _start(found, tuning, per_class, calibration, sample_octets, apart)
        learn(rest, model, max(1, -(-seen[False]["size"] // SHARD_OCTETS)))
        model.sums = None
        calibrate(model, tune if apart else rest)
    return model


def _start(found: DataFrame, tuning: int, per_class: int, calibration: int, sample_octets: int, apart: bool) -> Model:
    """A model of a bounded set of rows, from which the pass over all of them starts; a fresh one where the set lacks a label."""
    short = found.filter(F.col("size") <= 1 << 20).select("id", "y", "fold", "mix", "size")
    wanted = short.filter(F.col("fold") == tuning).orderBy("mix", "id").limit(min(calibration, 1500))
    for label in (0, 1):
        mine = short.filter((F.col("fold") != tuning) & (F.col("y") == label))
        wanted = wanted.unionByName(mine.orderBy("mix", "id").limit(per_class))
    # The window is over the set's identifiers and sizes.
    before = Window.orderBy("mix", "id").rowsBetween(Window.unboundedPreceding, 0)
    taken = wanted.withColumn("sum", F.sum("size").over(before)).filter(F.col("sum") <= sample_octets).select("id")
    sample = found.join(F.broadcast(taken), "id", "left_semi").select("id", "text", "y", "fold").toArrow().sort_by([("id", "ascending")])
    tune = sample["fold"].to_numpy() == tuning
    y = sample["y"].to_numpy()
    texts = sample["text"].to_pylist()
    del sample
    if len(set(y[~tune])) < 2:
        model = Model.fresh(11)
        model.sums = [np.full_like(p, 1e-4) for p in [model.embedding, *model.params()]]
        return model
    others = [t for t, c in zip(texts, tune, strict=True) if c] if apart and len(set(y[tune])) == 2 else None
    # Texts to learn from are numbers from here on.
    learned = Sample([t for t, c in zip(texts, tune, strict=True) if not c])
    del texts
    trim()
    model = train(learned, y[~tune], None if others is None else (others, y[tune]))
    del learned, others
    trim()
    return model


def score(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "__tx_score") -> DataFrame:
    """``docs`` with the score of each whole text in ``out``; without a model every score is 0.

    Null texts are scored as empty ones; every row gets a score of its own; no
    rows give no rows; a column that is named as ``out`` is replaced. Long texts
    are walked by parts of a megabyte, with the same result as in one.
    """
    names = [c for c in docs.columns if c != out]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(out, T.DoubleType())])

    def run(batches):
        vocabulary = Vocabulary()
        for batch in slices(batches):
            texts = batch.column(text_col).to_pylist()
            got = np.zeros(len(texts)) if model is None else model.scores(texts, vocabulary)
            cols = [*(batch.column(c) for c in names), pa.array(got.astype(np.float64))]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, out])

    return docs.mapInArrow(run, schema)
