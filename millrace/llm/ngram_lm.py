"""An n-gram language model in Elias-Fano tries of ``order`` levels, trained on and queried by the corpus.

Texts are taken in blocks of some million tokens; a block keeps its documents as
local word numbers and is written once. Then comes one exchange for each level
of the trie, of a block's distinct words or n-grams rather than of its tokens:

1. words: blocks send their distinct words, as bytes, with training counts to
   shards by hash. A shard numbers its words by frequency and answers totals and
   numbers,
2. each further level: blocks send their distinct (context, word) pairs to
   shards by context. The context is a node of the level above: a word number
   first, then the place that the level above gave to a pair. A context with a
   large part of all tokens is spread over several shards by its words. A shard
   builds its part of the level, answers from it the quantised probability and,
   for the next level, the pair's place and count,
3. at last blocks add the answers up by document.

A shard's level has its contexts, for each a pointer to where its words begin,
and the words. All three are Elias-Fano sequences in one file that is mapped
into memory; words grow along the level as each context's are counted on from
the last one before it. A pair is found by its context's pointers: only the
range from its pointer to the next is searched for the word, counted on from the
value before the range.

Smoothing is hierarchical with a prior count ``m`` for each level,
``p(w|context) = (c(context w) + m p(w|shorter)) / (c(context) + m)``, down to
single words, which have a prior count of one each, as one unknown word has. It needs no statistics of a shard, so scores do not depend on how many
there are. The first summand is stored in a byte, in even steps of its logarithm,
rounded down, so the sum over words stays at most 1; the second is exact.

Blocks and shards grow with the square root of the corpus where that is more than
their least size, so a block has at least some hundred pairs for a shard and the
rows of an exchange grow no faster than the corpus.
"""

from __future__ import annotations

import math
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import SPACE_WORDS, materialize, scratch, slices, trim
from .jaccard_join import _typed

#: The end of a text; words hold no line feed.
END = b"\n"
CHUNK = 4096
#: Prior counts of the levels from the second on; the last one holds for all further ones.
PRIORS = (1000.0, 10.0)
#: Pairs that a block should at least have for a shard.
CELL = 250


def _pack(a: np.ndarray, delta: bool = False) -> bytes:
    """Integers, compressed; ascending ones by their differences."""
    import zstandard

    a = np.asarray(a)
    if delta and len(a):
        a = np.diff(a, prepend=a.dtype.type(0))
    top = int(a.max()) if len(a) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    # Byte planes: the high ones are nearly constant.
    planes = a.astype(kind).view(np.uint8).reshape(len(a), np.dtype(kind).itemsize).T.tobytes()
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(b: bytes, delta: bool = False) -> np.ndarray:
    import zstandard

    width = b[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8)
    raw = raw.reshape(width, len(raw) // width)
    a = np.ascontiguousarray(raw.T).view(f"u{width}").reshape(-1).astype(np.int64)
    return np.cumsum(a) if delta else a


def _unique(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, where each is first and which one each element is; sorts keys and places as one number if they fit."""
    bits = max(1, len(key).bit_length())
    if not len(key) or int(key.max()) >> (62 - bits):
        return np.unique(key, return_index=True, return_inverse=True)
    both = np.sort((key << bits) | np.arange(len(key)))
    at, key = both & ((1 << bits) - 1), both >> bits
    new = np.append(True, key[1:] != key[:-1])
    inverse = np.empty(len(key), np.int64)
    inverse[at] = np.cumsum(new) - 1
    return key[new], at[new], inverse


class EliasFano:
    """A sequence that never falls: low bits side by side, high bits as unary steps."""

    def __init__(self, n: int, low: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.n, self.low, self.lows, self.highs, self.samples = n, low, lows, highs, samples

    @staticmethod
    def encode(values: np.ndarray) -> "EliasFano":
        v = np.asarray(values, np.int64)
        n = len(v)
        low = max(0, int(math.log2(max(1, int(v[-1]) // n)))) if n else 0
        lows, shifts = [], np.arange(low)
        for at in range(0, n if low else 0, CHUNK):  # chunks start on a byte: CHUNK is a multiple of 8
            lows.append(np.packbits(((v[at : at + CHUNK, None] >> shifts) & 1).astype(np.uint8).reshape(-1)))
        at = (v >> low) + np.arange(n)
        unary = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        unary[at] = 1
        # By chunk: its first value and the place of its first step.
        samples = np.stack([v[::CHUNK], at[::CHUNK]]) if n else np.zeros((2, 0), np.int64)
        return EliasFano(n, low, np.concatenate(lows) if lows else np.zeros(0, np.uint8), np.packbits(unary), samples)

    def chunk(self, k: int) -> np.ndarray:
        """Values ``k * CHUNK`` and on."""
        a, b = k * CHUNK, min(self.n, (k + 1) * CHUNK)
        if self.low:
            raw = np.unpackbits(self.lows[a * self.low // 8 : -(-b * self.low // 8)])[: (b - a) * self.low]
            low = raw.reshape(b - a, self.low).astype(np.int64) @ (1 << np.arange(self.low))
        else:
            low = np.zeros(b - a, np.int64)
        start = int(self.samples[1][k])
        stop = int(self.samples[1][k + 1]) if k + 1 < self.samples.shape[1] else len(self.highs) * 8
        ones = np.flatnonzero(np.unpackbits(self.highs[start // 8 : -(-stop // 8)])) + start // 8 * 8
        ones = ones[ones >= start][: b - a]
        return ((ones - np.arange(a, b)) << self.low) + low

    def _by_chunk(self, of: np.ndarray):
        cuts = np.flatnonzero(np.diff(of)) + 1
        for part in np.split(np.arange(len(of)), cuts):
            if len(part):
                yield int(of[part[0]]), part

    def get(self, at: np.ndarray) -> np.ndarray:
        """Values at ascending places."""
        out = np.zeros(len(at), np.int64)
        for k, part in self._by_chunk(np.asarray(at) // CHUNK):
            out[part] = self.chunk(k)[at[part] - k * CHUNK]
        return out

    def find(self, keys: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Places of keys, each searched in its own range of places only; -1 for those that are not there.

        Ranges ascend, and so do keys of one range.
        """
        out = np.full(len(keys), -1, np.int64)
        live = np.flatnonzero(stop > first)
        if not len(live):
            return out
        keys, first, stop = keys[live], first[live], stop[live]
        of = np.searchsorted(self.samples[0], keys, "right") - 1
        of = np.clip(of, first // CHUNK, (stop - 1) // CHUNK)
        for k, part in self._by_chunk(of):
            values = self.chunk(k)
            at = np.searchsorted(values, keys[part])
            hit = values[np.minimum(at, len(values) - 1)] == keys[part]
            at += k * CHUNK
            hit &= (at >= first[part]) & (at < stop[part])
            out[live[part]] = np.where(hit, at, -1)
        return out

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low], np.int64), self.lows, self.highs, self.samples.reshape(-1)]

    @staticmethod
    def of(arrays: list[np.ndarray]) -> "EliasFano":
        head, lows, highs, samples = arrays
        return EliasFano(int(head[0]), int(head[1]), lows, highs, samples.reshape(2, -1))


class CodeBook:
    """Shares of 1 in a byte: 255 even steps of the logarithm, the least below that of one in all tokens; 0 is none."""

    def __init__(self, tokens: int):
        self.reach = 1.0 + math.ceil(math.log10(max(10, tokens)))
        self.values = np.append(0.0, 10.0 ** (self.reach * (np.arange(255) / 254 - 1)))

    def codes(self, share: np.ndarray) -> np.ndarray:
        """Rounded down."""
        return (np.searchsorted(self.values, share, "right") - 1).astype(np.uint8)


class Level:
    """One level of a shard's trie: contexts, pointers, words and quantised probabilities, in a file mapped into memory."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, words: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.words, self.codes = contexts, pointers, words, codes

    @staticmethod
    def build(ctx: np.ndarray, word: np.ndarray, codes: np.ndarray) -> "Level":
        """Pairs sorted by context and word."""
        n = len(ctx)
        first = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1])) if n else np.zeros(0, np.int64)
        last = np.append(first[1:], n)[: len(first)] - 1
        # Each context's words are counted on from the last value of the context before.
        base = np.cumsum(word[last] + 1) - (word[last] + 1)
        return Level(
            EliasFano.encode(ctx[first]),
            EliasFano.encode(np.append(first, n)),
            EliasFano.encode(np.repeat(base, last + 1 - first) + word + 1),
            codes,
        )

    def save(self, file) -> None:
        parts = [a for s in (self.contexts, self.pointers, self.words) for a in s.arrays()] + [self.codes]
        for a in parts:
            raw = np.ascontiguousarray(a).tobytes()
            file.write(np.array([len(a), a.dtype.itemsize], np.int64).tobytes() + raw + b"\0" * (-len(raw) % 8))
        file.flush()

    @staticmethod
    def open(file) -> "Level":
        data, at, parts = np.memmap(file, np.uint8, "r"), 0, []
        while at < len(data):
            n, width = data[at : at + 16].view(np.int64).tolist()
            at += 16
            parts.append(data[at : at + n * width].view(np.uint8 if width == 1 else np.int64))
            at += -(-n * width // 8) * 8
        return Level(*(EliasFano.of(parts[i : i + 4]) for i in (0, 4, 8)), parts[12])

    def query(self, ctx: np.ndarray, kinds: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and places (-1: not there) of pairs: ascending contexts, how many words each, and these ascending in each."""
        n = np.full(len(ctx), self.contexts.n)
        at = self.contexts.find(ctx, np.zeros_like(n), n)
        first, stop, base = (np.zeros(len(ctx), np.int64) for _ in range(3))
        known = np.flatnonzero(at >= 0)
        first[known], stop[known] = self.pointers.get(at[known]), self.pointers.get(at[known] + 1)
        after = known[first[known] > 0]
        base[after] = self.words.get(first[after] - 1)
        wide = [np.repeat(x, kinds) for x in (base, first, stop)]
        place = self.words.find(wide[0] + word + 1, *wide[1:])
        return np.where(place >= 0, self.codes[np.maximum(place, 0)] if len(self.codes) else 0, 0).astype(np.uint8), place


class _Local(dict):
    """Numbers of a block's words, as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _blocks(block_tokens: int):
    from pyspark import TaskContext

    def run(batches):
        import zstandard

        names = ["block", "doc_ids", "held", "lengths", "vocabulary", "words", "train_tokens"]
        part, seq = TaskContext.get().partitionId(), 0
        local, docs, held, streams, n = _Local(), [], [], [], 0

        def block():
            nonlocal local, docs, held, streams, n, seq
            flat = np.concatenate(streams)
            # Common words get small numbers.
            known = list(local)
            order = np.argsort(-np.bincount(flat), kind="stable")
            number = np.empty(len(known), np.int64)
            number[order] = np.arange(len(known))
            vocabulary = b" ".join([known[i] for i in order.tolist()])
            lengths = np.array([len(s) for s in streams])
            row = [
                (part << 32) + seq,
                docs,
                held,
                _pack(lengths),
                zstandard.ZstdCompressor(level=3).compress(vocabulary),
                _pack(number[flat]),
                int(lengths[~np.array(held)].sum()),
            ]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            local, docs, held, streams, n = _Local(), [], [], [], 0
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

        for batch in slices(batches):
            for doc, out, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = (text or "").encode("utf-8", "replace").translate(SPACE_WORDS).split()
                words.append(END)
                streams.append(np.fromiter(map(local.__getitem__, words), np.int64, len(words)))
                docs.append(doc)
                held.append(bool(out))
                n += len(words)
                if n >= block_tokens:
                    yield block()
        if docs:
            yield block()

    return run


BLOCK = "block bigint, doc_ids array<bigint>, held array<boolean>, lengths binary, vocabulary binary, words binary, train_tokens bigint"


def _train_mask(batch, i: int):
    lengths = _unpack(batch.column("lengths")[i].as_py())
    held = np.array(batch.column("held")[i].as_py())
    return lengths, np.repeat(~held, lengths)


def _parts(of: np.ndarray):
    """Numbers of rows by shard, in order: (shard, rows)."""
    order = np.argsort(of.astype(np.uint16) if len(of) and of.max() < 1 << 16 else of, kind="stable")
    ranked = of[order]
    for part in np.split(order, np.flatnonzero(np.diff(ranked)) + 1):
        if len(part):
            yield int(of[part[0]]), part


def _rows(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


WORDS = {"shard": pa.int64(), "block": pa.int64(), "shards": pa.binary(), "words": pa.binary(), "counts": pa.binary()}


def _send_words(shards: int):
    def run(batches):
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                vocabulary = zstandard.ZstdDecompressor().decompress(batch.column("vocabulary")[i].as_py()).split(b" ")
                words = _unpack(batch.column("words")[i].as_py())
                _, train = _train_mask(batch, i)
                counts = np.bincount(words[train], minlength=len(vocabulary))
                shard = np.fromiter((xxhash.xxh64_intdigest(w) % shards for w in vocabulary), np.int64, len(vocabulary))
                rows = []
                # What a block's words went to, that it finds their answers again.
                everywhere = _pack(shard)
                for s, part in _parts(shard):
                    raw = z.compress(b"".join([vocabulary[j] + b" " for j in part.tolist()]))
                    rows.append((s, block, everywhere, raw, _pack(counts[part])))
                    everywhere = None
                yield _rows(rows, WORDS)

    return run


WORD_ANSWER = {"shard": pa.int64(), "block": pa.int64(), "shards": pa.binary(), "totals": pa.binary(), "ranks": pa.binary(), "known": pa.int64()}


def _answer_words(key, batches):
    """Totals and ranks by frequency (from 1; 0: never in training) of each block's words."""
    import zstandard

    rows = [r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(1, 5)), strict=True)]
    arrays, counts = [], []
    for _, _, words, count in rows:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(words), np.uint8)
        offsets = np.append(0, np.flatnonzero(raw == 32) + 1).astype(np.int64)
        arrays.append(pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]))
        counts.append(_unpack(count))
    cuts = np.cumsum([0, *map(len, arrays)])
    inverse = pa.concat_arrays(arrays).dictionary_encode().indices.to_numpy()
    del arrays
    total = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
    order = np.argsort(-total, kind="stable")
    rank = np.empty(len(total), np.int64)
    rank[order] = np.arange(1, len(total) + 1)
    rank[total == 0] = 0
    known = int((total > 0).sum())
    out = []
    for (block, shards, *_), a, b in zip(rows, cuts[:-1], cuts[1:], strict=True):
        mine = inverse[a:b]
        out.append((key[0].as_py(), block, shards, _pack(total[mine]), _pack(rank[mine]), known))
        known = 0  # so that a sum over rows counts each shard once
    yield _rows(out, WORD_ANSWER)


class _Known:
    """What is known of the whole corpus: tokens, vocabulary, documents and the numbers of shards."""

    def __init__(self, tokens: int, words: int, train_docs: int, word_shards: int, shards: int, priors):
        self.n, self.v, self.train_docs = tokens, words, train_docs
        self.word_shards, self.shards, self.priors = word_shards, shards, priors
        self.hot = max(1, tokens // (4 * shards))
        self.book = CodeBook(tokens)

    def prior(self, level: int) -> float:
        return float(self.priors[min(level - 2, len(self.priors) - 1)])

    def p1(self, c: np.ndarray) -> np.ndarray:
        """Probability of single words by their count, 0 for the unknown one: a prior count of one for each."""
        return (c + 1.0) / (self.n + self.v + 1.0)


class _Pairs:
    """A block's distinct pairs at one level, and their shards."""

    def __init__(self, ctx: np.ndarray, total: np.ndarray, words: np.ndarray, order: np.ndarray, numbers: np.ndarray, train: np.ndarray, known: _Known):
        """By token: its context's node and count, its local word; ``order``: rank of a local word by its number."""
        self.at = np.flatnonzero((total > 0) & (numbers[words] > 0))
        nodes, first, own = _unique(ctx[self.at])
        key = own * len(numbers) + order[words[self.at]]
        pairs, _, self.inverse = _unique(key)
        self.counts = np.bincount(self.inverse[train[self.at]], minlength=len(pairs))
        of, by_rank = pairs // len(numbers), np.empty(len(numbers), np.int64)
        by_rank[order] = numbers
        self.ctx, self.word, self.total = nodes[of], by_rank[pairs % len(numbers)], total[self.at][first][of]
        # A context with many tokens is spread by its words; any other goes to one shard.
        spread = 1 + self.total // known.hot
        mix = self.ctx.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (self.word % spread).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        mix = (mix ^ (mix >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        self.shard = ((mix >> np.uint64(33)) % np.uint64(known.shards)).astype(np.int64)


class _Block:
    """A block's tokens and what the levels answered so far."""

    def __init__(self, batch, i: int, known: _Known, level: int):
        """``level``: the one to ask for next, or one beyond the last."""
        self.known = known
        self.words = _unpack(batch.column("words")[i].as_py())
        self.lengths, self.train = _train_mask(batch, i)
        self.begins = np.cumsum(self.lengths) - self.lengths
        answers = sorted(batch.column("answers1")[i].as_py(), key=lambda a: a["shard"])
        shard = _unpack(next(a["shards"] for a in answers if a["shards"] is not None))
        totals, self.numbers = np.zeros(len(shard), np.int64), np.zeros(len(shard), np.int64)
        for (s, part), a in zip(_parts(shard), answers, strict=True):
            totals[part] = _unpack(a["totals"])
            rank = _unpack(a["ranks"])
            self.numbers[part] = np.where(rank > 0, (rank - 1) * known.word_shards + s + 2, 0)  # 1 is the start of a text
        self.order = np.empty(len(shard), np.int64)
        self.order[np.argsort(self.numbers, kind="stable")] = np.arange(len(shard))
        self.count = totals[self.words]
        self.node, self.total = self._after(self.numbers[self.words], self.count, 1, known.train_docs)
        p1 = known.p1(totals.astype(np.float64))
        self.p = p1[self.words]
        for k in range(2, level):
            self._take(k, batch.column(f"answers{k}")[i].as_py() or [])

    def _after(self, node, total, start: int, texts: int):
        """The contexts of tokens: what stands before them, at the start of a text what is given."""
        ctx, sums = np.empty_like(node), np.empty_like(total)
        ctx[1:], sums[1:] = node[:-1], total[:-1]
        ctx[self.begins], sums[self.begins] = start, texts
        return ctx, sums

    def pairs(self) -> _Pairs:
        return _Pairs(self.node, self.total, self.words, self.order, self.numbers, self.train, self.known)

    def _take(self, level: int, answers: list) -> None:
        pairs, by_shard = self.pairs(), {a["shard"]: a for a in answers}
        n = len(pairs.ctx)
        codes, place, counts = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for s, part in _parts(pairs.shard):
            a = by_shard[s]
            codes[part] = _unpack(a["codes"])
            if a["places"] is not None:
                found = part[codes[part] > 0]
                place[found] = _unpack(a["places"], delta=True) * self.known.shards + s + 1
                counts[found] = _unpack(a["counts"])
        m = self.known.prior(level)
        self.p *= m / (self.total + m)
        self.p[pairs.at] += self.known.book.values[codes][pairs.inverse]
        node, total = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.int64)
        node[pairs.at], total[pairs.at] = place[pairs.inverse], counts[pairs.inverse]
        # A text's first words have no longer context.
        self.node, self.total = self._after(node, total, 0, 0)


PAIR = {"shard": pa.int64(), "block": pa.int64()} | {c: pa.binary() for c in ("ctx", "kinds", "words", "counts", "totals")}


def _send_pairs(known: _Known, level: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                p, rows = _Block(batch, i, known, level).pairs(), []
                for shard, part in _parts(p.shard):
                    ctx = p.ctx[part]
                    begin = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1]))
                    kinds = np.diff(np.append(begin, len(part)))
                    row = (_pack(ctx[begin], delta=True), _pack(kinds), _pack(p.word[part]), _pack(p.counts[part]), _pack(p.total[part][begin]))
                    rows.append((shard, batch.column("block")[i].as_py(), *row))
                del p
                if rows:
                    yield _rows(rows, PAIR)
                trim(collect=False)

    return run


PAIR_ANSWER = {"shard": pa.int64(), "block": pa.int64()} | {c: pa.binary() for c in ("codes", "places", "counts")}


def _answer_pairs(known: _Known, level: int, last: bool):
    """Build a shard's level from what all blocks sent, then answer each from it."""

    def run(key, batches):
        rows = [r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(1, 7)), strict=True)]
        blocks, heads, kinds, words, counts, totals = [], [], [], [], [], []
        while rows:
            block, a, b, c, d, e = rows.pop()
            blocks.append(block)
            heads.append(_unpack(a, delta=True))
            kinds.append(_unpack(b))
            words.append(_unpack(c))
            counts.append(_unpack(d))
            totals.append(_unpack(e))
        cuts = np.cumsum([0, *map(len, words)])
        asked, first, own = _unique(np.concatenate(heads))
        total = np.concatenate(totals)[first]
        own = np.repeat(own, np.concatenate(kinds))
        del heads, kinds, totals
        words = np.concatenate(words)
        size = int(words.max()) + 1
        pairs, _, inverse = _unique(own * size + words)
        del own, words
        count = np.bincount(inverse, np.concatenate(counts), minlength=len(pairs)).astype(np.int64)
        del counts
        of, word = pairs // size, pairs % size
        del pairs
        seen = count > 0
        codes = known.book.codes(count[seen] / (total[of[seen]] + known.prior(level)))
        with tempfile.TemporaryFile() as file:
            Level.build(asked[of[seen]], word[seen], codes).save(file)
            # All blocks' questions at once, each level walked once from end to end.
            code, place = Level.open(file).query(asked, np.bincount(of, minlength=len(asked)), word)
        del of, word, seen, codes
        for block, a, b in zip(blocks, cuts[:-1], cuts[1:], strict=True):
            mine = inverse[a:b]
            found = mine[code[mine] > 0]
            more = (None, None) if last else (_pack(place[found], delta=True), _pack(count[found]))
            yield _rows([(key[0].as_py(), block, _pack(code[mine]), *more)], PAIR_ANSWER)
        trim(collect=False)

    return run


RESULT = {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}


def _score(known: _Known, order: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                b = _Block(batch, i, known, order + 1)
                sums = lambda x: np.add.reduceat(x, b.begins)
                base = np.log10((b.count + 1) / (known.n + known.v + 1))
                cols = [
                    batch.column("doc_ids")[i].as_py(),
                    batch.column("held")[i].as_py(),
                    b.lengths,
                    sums((b.count > 0).astype(np.int64)),
                    np.full(len(b.lengths), known.n, np.int64),
                    sums(base),
                    sums(np.log10(b.p)),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, RESULT.values(), strict=True)], names=list(RESULT))
                del b, base
                trim(collect=False)

    return run


def _ddl(kinds: dict) -> str:
    names = {pa.int64(): "bigint", pa.binary(): "binary", pa.bool_(): "boolean", pa.float64(): "double"}
    return ", ".join(f"{c} {names[k]}" for c, k in kinds.items())


def block_size(tokens: int, least: int = 1_000_000) -> int:
    """Tokens of a block, of which a shard takes twice as many: ``least``, or as many as leave ``CELL`` pairs for each shard."""
    return max(least, math.isqrt(CELL * tokens // 2))


def score_texts(
    docs: DataFrame,
    held_out,
    order: int = 3,
    block_tokens: int | None = None,
    shard_tokens: int | None = None,
    priors: tuple[float, ...] = PRIORS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` is a column expression; rows where it holds are scored, not
    learned from (null counts as false). Words are runs of anything but ASCII
    white space, A-Z lower-cased, and are compared byte by byte; each text ends in
    one end token, null counts as empty. Repeated rows count and are scored each.
    Other columns are not looked at; an empty table gives no rows. A very long
    text is a block of its own and held in one task, some 60 bytes a token.

    A text's first word has the start of a text as its context. After a context
    never seen in training the shorter one alone counts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text_col).alias("text"))
    if block_tokens is None:
        octets = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        block_tokens = block_size(octets // 6)
    shard_tokens = shard_tokens or 2 * block_tokens
    with scratch(spark) as keep:
        blocks = materialize(rows.mapInArrow(_blocks(block_tokens), BLOCK), "blocks")
        stats = blocks.agg(
            F.sum("train_tokens").alias("n"),
            F.sum(F.size("held") - F.aggregate("held", F.lit(0), lambda a, x: a + x.cast("int"))).alias("d"),
        ).first()
        tokens = stats["n"] or 0
        shards = max(1, -(-tokens // shard_tokens))
        word_shards = max(1, -(-tokens // (4 * shard_tokens)))
        sent = blocks.select("block", "held", "lengths", "vocabulary", "words").mapInArrow(_send_words(word_shards), _ddl(WORDS))
        words = materialize(sent.groupBy("shard").applyInArrow(_typed(_answer_words), _ddl(WORD_ANSWER)), "words")
        known = _Known(tokens, words.agg(F.sum("known")).first()[0] or 0, stats["d"] or 0, word_shards, shards, priors)
        answers = [words.select("block", F.struct("shard", "shards", "totals", "ranks").alias("a"))]

        def answered(*columns):
            out = blocks.select("block", "held", "lengths", "words", *columns)
            for k, given in enumerate(answers, 1):
                out = out.join(given.groupBy("block").agg(F.collect_list("a").alias(f"answers{k}")), "block", "left")
            return out

        for level in range(2, order + 1):
            sent = answered().mapInArrow(_send_pairs(known, level), _ddl(PAIR))
            found = sent.groupBy("shard").applyInArrow(_typed(_answer_pairs(known, level, level == order)), _ddl(PAIR_ANSWER))
            found = materialize(found, f"level{level}")
            answers.append(found.select("block", F.struct("shard", "codes", "places", "counts").alias("a")))
        return keep(materialize(answered("doc_ids").mapInArrow(_score(known, order), _ddl(RESULT)), "scores"))
