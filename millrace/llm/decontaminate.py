"""Benchmark decontamination by a prefix-filtered set join.

1. Items are cut into windows of ``size`` words (a shorter item is one window),
   a table with a row for each window of an item. To contain a window, a text
   must hold all of its shingles of ``shingle`` words, so one of them suffices as
   its prefix.
2. Shingles are ordered by rarity: one pass over the corpus counts those that
   windows have. Each window joins on its rarest one.
3. A second pass emits the places where a text has a prefix shingle, with the
   words around, and they are joined with the windows on the shingle's hash. The
   shingle's place fixes where the window would start: it must lie inside the
   text (length and position), and then all its words are compared.
4. Hits are added up by text; a text's digest is the key, so copies of one text
   are searched into one result.

Both passes skip shingles that no window has by a bitmap of two probes, the only
thing that travels to the workers. It has 64 bits for a shingle and 2^28 at most
(32 MB); a larger benchmark lets more places through to the join, which is
exact. Neither documents nor windows are held in memory or shuffled whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORDS, few, materialize, scratch, slices
from .jaccard_join import MIX, WordHash, _typed

MOST_BITS, SLICE_BITS = 28, 22
RESULT = ["__dc_n_words", "__dc_n_hit", "__dc_n_items", "__dc_items_sha256", "__dc_items"]


def words_of(text: str | bytes | None) -> list[bytes]:
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")
    return raw.translate(ALNUM_WORDS).split()


class Slice:
    """The words of some texts in one row: what numpy does for a slice costs little, for each text it costs more than the words."""

    def __init__(self, column: pa.Array, hashes: WordHash):
        self.texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
        self.words: list[bytes] = []
        ends = []
        for text in self.texts:
            self.words += words_of(text)
            ends.append(len(self.words))
        self.ends = np.array(ends, np.int64)
        self.owner = np.repeat(np.arange(len(ends)), np.diff(self.ends, prepend=0))
        self.hashed = _hashed(self.words, hashes)

    def found(self, bitmap: "Bitmap", width: int) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of ``width`` words that the bitmap has begin, none across two texts, and their hashes."""
        h = _hashes(self.hashed, width)
        at = bitmap.has(h)
        at = at[self.owner[at] == self.owner[at + width - 1]]
        return at, h[at]


def windows_of(words: list[bytes], size: int):
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def _windows(size: int):
    def run(batches):
        for batch in slices(batches):
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(item, b" ".join(w).decode(), len(w)) for w in set(windows_of(words_of(text), size))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int32()), strict=True)], names=["item", "w", "n"]
                )

    return run


def _hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` hashed words."""
    n = len(words) - width + 1
    x = np.full(max(0, n), width, np.uint64)
    for i in range(width if n > 0 else 0):
        x = (x ^ words[i : i + n]) * MIX
        x ^= x >> np.uint64(29)
    return x


def _hashed(words: list[bytes], hashes: WordHash) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def _shingles(k: int):
    def run(batches):
        hashes = WordHash()
        for batch in slices(batches, 4096):
            ws = batch.column(0).to_pylist()
            found = []
            for w in ws:
                words = _hashed(w.encode().split(b" "), hashes)
                found.append(_hashes(words, min(k, len(words))))
            counts = np.array([len(x) for x in found], np.int64)
            at = np.concatenate([np.arange(c) for c in counts])
            rows = np.repeat(np.arange(len(ws)), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(at.astype(np.int32)), pa.array(np.concatenate(found).view(np.int64))],
                names=["w", "n", "at", "h"],
            )

    return run


class Bitmap:
    """Which shingles may be there: two probes of a hash."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    @staticmethod
    def probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        return tuple((x >> np.uint64(64 - bits)).astype(np.int64) for x in (h * MIX, (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)))

    def has(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes that may be there."""
        a, b = self.probes(h, self.bits)
        at = np.flatnonzero(self.data[a >> 3] >> (a & 7).astype(np.uint8) & 1)
        b = b[at]
        return at[(self.data[b >> 3] >> (b & 7).astype(np.uint8) & 1).astype(bool)]

    @staticmethod
    def of(hashes: DataFrame) -> "Bitmap":
        """From a column of hashes, slice by slice; what comes to the driver is bounded by ``MOST_BITS``."""
        import zstandard

        bits = int(np.clip(np.ceil(np.log2(64 * max(1, hashes.count()))), 10, MOST_BITS))
        wide = 1 << max(0, min(bits, SLICE_BITS) - 3)

        def mark(batches):
            data = np.zeros(1 << (bits - 3), np.uint8)
            for batch in batches:
                for at in Bitmap.probes(batch.column(0).to_numpy().view(np.uint64), bits):
                    np.bitwise_or.at(data, at >> 3, (1 << (at & 7)).astype(np.uint8))
            z = zstandard.ZstdCompressor(level=1)
            for i, part in enumerate(data.reshape(-1, wide)):
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([z.compress(part.tobytes())])], names=["slice", "x"])

        def join(key, batches):
            z, out = zstandard.ZstdDecompressor(), np.zeros(wide, np.uint8)
            for batch in batches:
                for x in batch.column(1).to_pylist():
                    out |= np.frombuffer(z.decompress(x), np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([out.tobytes()])], names=["slice", "x"])

        schema = "slice int, x binary"
        data = np.zeros((1 << (bits - 3)) // wide * wide, np.uint8).reshape(-1, wide)
        for r in hashes.mapInArrow(mark, schema).groupBy("slice").applyInArrow(_typed(join), schema).collect():
            data[r["slice"]] = np.frombuffer(r["x"], np.uint8)
        return Bitmap(bits, data.reshape(-1))


def _count(bitmap: Bitmap, widths: list[int]):
    """How often each shingle that windows may have occurs."""

    def run(batches):
        hashes, held, n = WordHash(), [], 0

        def out():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

        for batch in slices(batches):
            part = Slice(batch.column(0), hashes)
            for width in widths:
                h = part.found(bitmap, width)[1]
                if len(h):
                    held.append(h)
                    n += len(h)
            if n > 200_000:
                yield out()
                held, n = [], 0
        if held:
            yield out()

    return run


def _key(text: bytes | None) -> bytes:
    return hashlib.blake2b(text or b"", digest_size=16).digest()


PLACE = "key binary, pos bigint, h bigint, around string, lead int"


def _places(bitmap: Bitmap, widths: list[int], size: int):
    """Where a text has a prefix shingle, and the words around."""

    def run(batches):
        hashes = WordHash()
        for batch in slices(batches):
            rows, part, keys = [], Slice(batch.column(0), hashes), {}
            for width in widths:
                at, h = part.found(bitmap, width)
                owner = part.owner[at]
                ends = part.ends[owner]
                begins = np.where(owner > 0, part.ends[owner - 1], 0)
                for i, x, j, a, b in zip(at.tolist(), h.view(np.int64).tolist(), owner.tolist(), begins.tolist(), ends.tolist(), strict=True):
                    if j not in keys:
                        keys[j] = _key(part.texts[j])
                    first = max(a, i - size + 1)
                    rows.append((keys[j], i - a, x, b" ".join(part.words[first : min(b, i + size)]).decode("utf-8", "replace"), i - first))
            if rows:
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "pos", "h", "around", "lead"]
                )

    return run


def _counted(text_col: str, names: list[str]):
    """Rows with their text's key and number of words."""

    def run(batches):
        for batch in slices(batches):
            texts = batch.column(text_col).cast(pa.binary()).to_pylist()
            cols = [pa.array([_key(t) for t in texts], pa.binary()), pa.array([len(words_of(t)) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *cols], names=[*names, "__dc_key", RESULT[0]])

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    shingle: int = 3,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with columns __dc_n_words, __dc_n_hit, __dc_n_items, __dc_items_sha256, __dc_items.

    A word is hit inside any occurrence of a window. Null and empty texts have
    no words and no hits; items without words have no windows; equal windows of
    several items count for each; items go by their id as a string, whatever it
    holds, an item without an id marks words, but is not counted or listed;
    repeated rows are judged each by itself. With an empty benchmark nothing is
    hit; no rows give no rows. Columns of ``docs`` stay as they are, but those
    that have a name of the result are replaced. A text is held whole by one
    task, its words some 60 bytes each.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in RESULT]
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    with scratch(spark) as keep:
        windows = materialize(rows.mapInArrow(_windows(size), "item string, w string, n int").distinct(), "windows")
        shingles = materialize(windows.select("w", "n").distinct().mapInArrow(_shingles(shingle), "w string, n int, at int, h bigint"), "shingles")
        widths = sorted({min(shingle, r["n"]) for r in shingles.select("n").distinct().collect()})  # ``size`` rows at most
        counts = texts.mapInArrow(_count(Bitmap.of(shingles.select("h").distinct()), widths), "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))
        ranked = shingles.join(counts, "h", "left").groupBy("w", "n")
        rarest = ranked.agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "at", "h")).alias("x"))
        prefix = materialize(rarest.select("w", "n", "x.at", "x.h"), "prefixes")
        places = texts.mapInArrow(_places(Bitmap.of(prefix.select("h").distinct()), widths, size), PLACE).dropDuplicates(["key", "pos", "h"])
        inside = F.slice(F.split("around", " "), F.col("lead") - F.col("at") + 1, F.col("n"))
        hits = places.join(few(prefix), "h").filter("lead >= at").filter(F.array_join(inside, " ") == F.col("w"))
        hits = materialize(hits.select("key", (F.col("pos") - F.col("at")).alias("s"), (F.col("pos") - F.col("at") + F.col("n")).alias("e"), "w"), "hits")
        union = F.aggregate(
            F.array_sort("spans"),
            F.struct(F.lit(0).cast("bigint").alias("e"), F.lit(0).cast("bigint").alias("n")),
            lambda a, x: F.struct(F.greatest(a["e"], x["e"]).alias("e"), (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["e"], x["s"]))).alias("n")),
            lambda a: a["n"],
        )
        spans = hits.groupBy("key").agg(F.collect_set(F.struct("s", "e")).alias("spans")).select("key", union.alias("n_hit"))
        named = windows.filter("item IS NOT NULL").select("w", "item")
        items = hits.select("key", "w").distinct().join(few(named), "w").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
        found = keep(materialize(spans.join(items, "key", "left").withColumnRenamed("key", "__dc_key"), "contaminated"))
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("__dc_key", T.BinaryType()), T.StructField(RESULT[0], T.LongType())])
    out = docs.mapInArrow(_counted(text_col, names), schema).join(few(found), "__dc_key", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        *[F.col(f"`{c}`") for c in names],
        RESULT[0],
        F.coalesce("n_hit", F.lit(0)).alias(RESULT[1]),
        F.size(items).cast("bigint").alias(RESULT[2]),
        F.sha2(F.encode(F.array_join(items, ","), "UTF-8"), 256).alias(RESULT[3]),
        items.alias(RESULT[4]),
    )
