"""Packing into fixed-length sequences: first-fit decreasing in random groups.

Documents are tokenised in whole, cut into pieces of at most ``capacity`` ids
and dealt to groups at random, piece by piece: the hash takes in the piece's
start, its ids and its place in its partition, so neither the pieces of a giant
document nor rows that repeat one meet in one group. (The place is stable where
the documents come from files or a written table.) Each group packs its pieces
on its own, longest first, into the first bin with room, which a
tournament tree over the bins' free space finds in logarithmic time. Only the
pieces' addresses travel; ids stay where they were made.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


TAIL = b".,;:!?#$%&*|()"


def _ends_in_letter(core: bytes) -> bool:
    """A last letter of ASCII or Latin up to U+024F but U+0130, whose lower case ends in a mark."""
    if not core:
        return False
    if core[-1] < 128:
        return core[-1:].isalpha()
    last = core[-2:].decode("utf-8", "replace")[-1]
    return "\u00c0" <= last <= "\u024f" and last != "\u0130" and last.isalpha()


def _chunks(raw: bytes) -> list[bytes]:
    """Runs between ASCII white space, A-Z lower-cased where that changes nothing.

    Names of special tokens are told apart by case, so texts with one stay as
    they are, and so do chunks that are not ASCII in a text with combining marks
    of U+0300 to U+037F, the only ones that compose with ASCII letters.
    """
    if b"<|" in raw:
        return raw.split()
    if b"\xcc" in raw or b"\xcd" in raw:
        return [c.lower() if c.isascii() else c for c in raw.split()]
    return raw.lower().split()


class ChunkEncoder:
    """Token ids of a text as little-endian 32-bit words, by chunks between ASCII white space.

    The tokenizer drops white space and none of its rules reaches across it, so a
    text's ids are those of its chunks in a row. A-Z may be lower-cased beforehand
    but for what combining marks follow, as a capital may compose with one where
    the small letter does not, or the other way round. Marks behind a chunk are cut
    off where the last letter before them stays a letter by itself under NFC and
    lower-casing (``_ends_in_letter``). Runs of letters are encoded many at a time
    and told apart by their word-end ids. Chunks seen are kept, up to a bound;
    then the store starts anew.
    """

    def __init__(self, path: str, bound: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.seen: dict[bytes, bytes] = {}
        self.bound = bound
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")

    def _ids(self, texts: list[str]):
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[bytes]) -> None:
        """Store the ids of runs of letters, 64 to a text."""
        parts = [words[at : at + 64] for at in range(0, len(words), 64)]
        for at in range(0, len(parts), 256):
            some = parts[at : at + 256]
            for part, found in zip(some, self._ids([b" ".join(p).decode() for p in some]), strict=True):
                ids = np.array(found, np.uint32)
                cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
                if len(cuts) == len(part):
                    data = ids.tobytes()
                    self.seen.update(zip(part, [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True))
                else:
                    self._others(part)

    def _others(self, chunks: list[bytes]) -> None:
        for at in range(0, len(chunks), 10_000):
            part = chunks[at : at + 10_000]
            for c, ids in zip(part, self._ids([c.decode() for c in part]), strict=True):
                self.seen[c] = array("I", ids).tobytes()

    def _learn(self, chunks: set[bytes]) -> None:
        seen, letters, others, joined = self.seen, set(), set(), []
        for c in chunks:
            if c.isalpha():  # of ASCII
                letters.add(c)
                continue
            core = c.rstrip(TAIL)
            if len(core) < len(c) and _ends_in_letter(core):
                others.add(c[len(core) :])
                joined.append((c, core, c[len(core) :]))
            else:
                core = c
            (letters if core.decode().isalpha() else others).add(core)
        self._letters([w for w in letters if w not in seen])
        self._others([c for c in others if c not in seen])
        for c, core, tail in joined:
            seen[c] = seen[core] + seen[tail]

    def texts(self, texts: list[str]) -> list[bytes]:
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        chunks = [_chunks(r) for r in raw]
        wanted = {c for words in chunks for c in words}
        if len(self.seen) + len(wanted) > self.bound:
            self.seen = {}
        self._learn(wanted.difference(self.seen))
        get = self.seen.__getitem__
        return [b"".join(map(get, words)) for words in chunks]


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Every document's pieces: whole ``capacity`` ids as often as they go, then the rest."""
    end = array("I", [end_id]).tobytes()

    def pieces(batches):
        import os

        from pyspark import TaskContext

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        enc, at = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for part in slices(batches, 512):
            ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            rows = []
            for doc, data in zip(ids, enc.texts(texts), strict=True):
                data += end
                n = len(data) // 4
                at += 1
                for s in range(0, n, capacity):
                    piece = data[4 * s : 4 * (s + capacity)]
                    rows.append((doc, s, len(piece) // 4, zlib.crc32(piece), n, at))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"],
            )

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(pieces, PIECES + ", place bigint")


class Tournament:
    """First bin with room: a complete tree whose nodes hold the most free space below."""

    def __init__(self, capacity: int):
        self.capacity, self.leaves, self.used, self.tree = capacity, 1, 0, [0, 0]

    def place(self, size: int) -> tuple[int, int]:
        """Bin and offset of a piece; a new bin where none has room."""
        tree = self.tree
        if tree[1] < size:
            if self.used == self.leaves:
                self._grow()
                tree = self.tree
            node = self.leaves + self.used
            self.used += 1
            tree[node] = self.capacity
        else:
            node = 1
            while node < self.leaves:
                node *= 2
                if tree[node] < size:
                    node += 1
        offset = self.capacity - tree[node]
        found = node - self.leaves
        tree[node] -= size
        while node > 1:
            node //= 2
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left > right else right
        return found, offset

    def _grow(self) -> None:
        old = self.tree[self.leaves :]
        self.leaves *= 2
        self.tree = [0] * self.leaves + old + [0] * (self.leaves - len(old))
        for node in range(self.leaves - 1, 0, -1):
            self.tree[node] = max(self.tree[2 * node], self.tree[2 * node + 1])


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each piece, longest first; equal lengths in the order given."""
    tree, out = Tournament(capacity), [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        out[i] = tree.place(lengths[i])
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    group_rows: int = 4096,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone; a null identifier is one like any
    other. Groups hold about ``group_rows`` pieces; their number follows the rows
    of the table and what its plan estimates in bytes. Rows that repeat a document are packed each. A very
    long text is tokenised by one task, which holds its ids, and packed by many.
    Other columns are not looked at; no rows give no rows.
    """
    rows = docs.count()
    # The plan's own estimate of its bytes, some five an id; it is not read for it, and 64 pieces a row are the most it counts for.
    octets = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    groups = max(1, -(-(rows + min(octets // (5 * capacity), 64 * rows)) // group_rows))

    def packed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "start", "ids_crc32"], kind="stable")
        placed = first_fit_decreasing(part["length"].tolist(), capacity)
        part["sequence_id"] = [(int(key[0]) << 32) + b for b, _ in placed]
        part["offset"] = [o for _, o in placed]
        return part[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    dealt = cut(docs, tokenizer, capacity, end_id, id_col, text_col).withColumn(
        "deal", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "place", F.lit(seed)), F.lit(groups))
    )
    return dealt.groupBy("deal").applyInPandas(packed, PIECES + ", sequence_id bigint, offset bigint")
