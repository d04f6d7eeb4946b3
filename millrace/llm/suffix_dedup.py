"""Removal of repeated byte strings with suffix arrays sorted in two stages.

A byte goes when a string of ``length`` bytes covers it that also starts
earlier: in a smaller document, or earlier in the same one.

1. Of documents with equal texts only the first is searched; in later ones every
   such string has started earlier, so they go whole.
2. Anchors find where strings may repeat. Each window of ``length`` bytes picks
   the 32 bytes in it whose hash is least (the first of equals), a choice that
   depends on its bytes alone, so equal windows pick equal anchors. An anchor
   that occurs once rules out every window that picked it.
3. For the others the bytes of the windows that picked them travel, keyed by
   the anchor. Copies of one such stretch need no search, all but the first of
   them repeat whole. Different stretches are put behind each other and their
   suffixes sorted in two stages: only suffixes smaller than their successors
   are sorted directly; one scan over the buckets induces all others. Where the
   common prefixes of adjacent suffixes reach ``length`` bytes they hold equal
   strings, and all but the earliest are marked.
4. An anchor with more than ``group_bytes`` of different stretches (a licence line
   in very many contexts) is not held. Its windows go on, by 128-bit hashes of
   their bytes, to an aggregate that finds the earliest of each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import few, materialize, partitions, scratch, slices

ANCHOR = 32
CHUNK = 1 << 22


def anchors(data: np.ndarray, length: int):
    """Each window's anchor: a list of (first start, anchor positions by start, their hashes)."""
    n = len(data)
    out = []
    for at in range(0, max(0, n - length + 1), CHUNK):
        part = data[at : at + CHUNK + length - 1].astype(np.uint64)
        h = part
        step = 1
        while step < ANCHOR:
            h = (h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:]) * np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(31)
            step *= 2
        width = length - ANCHOR + 1
        m = len(h)
        key = (h & ~np.uint64(0xFFFFFF)) | np.arange(m, dtype=np.uint64)
        pad = -m % width
        full = np.append(key, np.full(pad, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
        ahead = np.minimum.accumulate(full, axis=1).reshape(-1)
        back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        starts = m - width + 1
        least = np.minimum(back[:starts], ahead[width - 1 : width - 1 + starts])
        pos = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        out.append((at, at + pos, h[pos]))
    return out


def stretches(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (anchor position, first byte, end) of the runs of windows that picked one anchor, and the anchors' hashes."""
    rows, hashes = [], []
    for at, pos, h in anchors(data, length):
        first = np.flatnonzero(np.append(True, pos[1:] != pos[:-1]))
        last = np.append(first[1:], len(pos)) - 1
        rows.append(np.stack([pos[first], at + first, at + last + length], axis=1))
        hashes.append(h[first])
    if not rows:
        return np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes (to which it is exact), by two-stage sorting."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    t = text.astype(np.int64)
    step = np.sign(np.append(t[1:], -1) - t)  # the end is less than any byte
    last = np.where(step != 0, np.arange(n), n - 1)
    last = np.minimum.accumulate(last[::-1])[::-1]
    small = step[last] > 0  # smaller than its successor
    words = _words(text)
    direct = _sort_by_bytes(np.flatnonzero(small), words, depth)
    count = np.bincount(text, minlength=256)
    ends = np.cumsum(count)
    heads = (ends - count).tolist()
    n_small = np.bincount(text[direct], minlength=256)
    order = np.full(n, -1, np.int64)
    place = np.concatenate([np.arange(e - k, e) for e, k in zip(ends, n_small, strict=True)]) if len(direct) else np.zeros(0, np.int64)
    order[place] = direct
    sa, letters, is_small = order.tolist(), text.tolist(), small.tolist()
    c = letters[n - 1]
    sa[heads[c]] = n - 1  # the suffix before the end, which sorts first of all
    heads[c] += 1
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not is_small[j]:
            c = letters[j]
            sa[heads[c]] = j
            heads[c] += 1
    return np.array(sa, np.int64)


def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each position on, big end first; zeros after the end."""
    padded = np.append(text, np.zeros(8, np.uint8)).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i : i + len(text)]
    return out


def _sort_by_bytes(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``at`` by the ``depth`` bytes from there on; only what is still tied is sorted further."""
    get = lambda p: np.where(p < len(words), words[np.minimum(p, len(words) - 1)], 0)
    key = get(at)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    rank = np.cumsum(np.append(0, key[1:] != key[:-1])) if len(at) else np.zeros(0, np.int64)
    for skip in range(8, depth, 8):
        same = rank[1:] == rank[:-1]
        tied = np.flatnonzero(np.append(False, same) | np.append(same, False))
        if not len(tied):
            break
        key = get(at[tied] + skip)
        order = np.lexsort((key, rank[tied]))
        at[tied] = at[tied][order]
        key = key[order]
        r = rank[tied]
        new = np.append(True, (r[1:] != r[:-1]) | (key[1:] != key[:-1]))
        full = np.append(True, rank[1:] != rank[:-1])
        full[tied] |= new
        rank = np.cumsum(full) - 1
    return at


def common_prefixes(sa: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """How many bytes each suffix shares with the one before it, up to ``depth``; the first shares none."""
    out = np.zeros(len(sa), np.int64)
    live = np.arange(1, len(sa))
    get = lambda p: np.where(p < len(words), words[np.minimum(p, len(words) - 1)], 0)
    for o in range(0, depth, 8):
        diff = get(sa[live] + o) ^ get(sa[live - 1] + o)
        ends = diff != 0
        at, diff = live[ends], diff[ends]
        out[at] = o
        for byte in range(7):  # each suffix comes here once
            out[at] += diff >> np.uint64(56 - 8 * byte) == 0
        live = live[~ends]
        if not len(live):
            break
    out[live] = depth
    return np.minimum(out, depth)


def repeats(pool: list[tuple[bytes, int, int]], length: int) -> list[np.ndarray]:
    """For each stretch (bytes, document, start): offsets of strings that start earlier in another stretch."""
    text = np.frombuffer(b"\x00".join(p[0] for p in pool), np.uint8)
    sizes = np.array([len(p[0]) for p in pool])
    begins = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(pool)), sizes + 1)[: len(text)]
    offset = np.arange(len(text)) - begins[owner]
    sa = suffix_array(text, length + 4)
    sa = sa[offset[sa] + length <= sizes[owner[sa]]]
    if not len(sa):
        return [np.zeros(0, np.int64)] * len(pool)
    run = np.cumsum(common_prefixes(sa, _words(text), length) < length) - 1
    doc = np.array([p[1] for p in pool])[owner[sa]]
    start = np.array([p[2] for p in pool])[owner[sa]] + offset[sa]
    order = np.lexsort((start, doc, run))
    r, d, s = run[order], doc[order], start[order]
    head = np.append(True, r[1:] != r[:-1])
    of = np.flatnonzero(head)[np.cumsum(head) - 1]
    later = (d != d[of]) | (s != s[of])
    hit = sa[order][later]
    by = [np.zeros(0, np.int64)] * len(pool)
    for k in np.unique(owner[hit]):
        by[k] = np.sort(offset[hit[owner[hit] == k]]) if len(pool) < 64 else by[k]
    if len(pool) >= 64 and len(hit):
        hit = np.sort(hit)
        own = owner[hit]
        cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
        for part in np.split(hit, cuts):
            by[owner[part[0]]] = offset[part]
    return by


def spans_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under strings of ``length`` bytes that start at ``starts`` (sorted)."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.append(0, gap + 1)].tolist(), (starts[np.append(gap, len(starts) - 1)] + length).tolist(), strict=True))


PLACE = "key bigint, rid bigint, pos bigint"
#: Kinds of places, in the bits over a position: alone in its batch, known to be live, a mark that an anchor is live.
ALONE, LIVE, MARK, KIND = 0, 1, 2, 60


def _places(h: np.ndarray, rid: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Places by anchor; of an anchor that a batch has several times one mark goes by its hash.

    Its places are live already and are dealt by a hash of their own, so a very
    common anchor does not send all of them to one task.
    """
    own, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    many = count[inverse] > 1
    spread = (rid.view(np.uint64) ^ pos.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    marks = own[count > 1]
    zeros = np.zeros(len(marks), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(np.where(many, spread, h), marks).view(np.int64)),
            pa.array(np.append(rid, zeros)),
            pa.array(np.append(pos + (many.astype(np.int64) << KIND), zeros + (MARK << KIND))),
        ],
        names=["key", "rid", "pos"],
    )


def _live(batches):
    """Places whose anchor occurs more than once; rows sorted by key."""
    names, held, before = ["rid", "pos"], None, None

    def out(rid, pos, which):
        return pa.RecordBatch.from_arrays([pa.array(rid[which]), pa.array(pos[which])], names=names)

    for batch in batches:
        key, rid, pos = (batch.column(i).to_numpy() for i in range(3))
        kind, pos = pos >> KIND, pos & ((1 << KIND) - 1)
        ready = kind == LIVE
        if ready.any():
            yield out(rid, pos, ready)
        key, kind, rid, pos = (x[~ready] for x in (key, kind, rid, pos))
        if held is not None:
            key, kind, rid, pos = (np.append(a, b) for a, b in zip(held, (key, kind, rid, pos), strict=True))
        if not len(key):
            continue
        same = key[1:] == key[:-1]
        hot = np.append(before is not None and key[0] == before, same) | np.append(same, False)
        before = key[-2] if len(key) > 1 else before
        held = tuple(x[-1:].copy() for x in (key, kind, rid, pos))
        hot = (hot & (kind == ALONE))[:-1]
        if hot.any():
            yield out(rid[:-1], pos[:-1], hot)
    if held is not None and before is not None and held[0][0] == before and held[1][0] == ALONE:
        yield out(held[2], held[3], np.ones(1, bool))


def _octets(text) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _anchor_rows(length: int):
    def run(batches):
        hs, rids, ps, n = [], [], [], 0
        for batch in slices(batches):
            for rid, text, first in zip(*(batch.column(c).to_pylist() for c in ("rid", "text", "first")), strict=True):
                data = np.frombuffer(_octets(text), np.uint8)
                if not first or len(data) < length:
                    continue
                found, h = stretches(data, length)
                at = found[:, 0]
                hs.append(h)
                rids.append(np.full(len(at), rid, np.int64))
                ps.append(at)
                n += len(at)
                if n > 200_000:
                    yield _places(*map(np.concatenate, (hs, rids, ps)))
                    hs, rids, ps, n = [], [], [], 0
        if hs:
            yield _places(*map(np.concatenate, (hs, rids, ps)))

    return run


STRETCH = "h bigint, x binary, did bigint, start bigint, rid bigint"
#: Repeated spans, or (with a key) windows of an anchor that is not held.
SPAN = "rid bigint, did bigint, s bigint, e bigint, key binary"


def _stretch_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Stretches by anchor; of equal ones in a batch the earliest goes by its anchor.

    The others repeat whole, whatever comes: they go by a hash of their own, with
    their length in four bytes (a stretch is longer) in place of their bytes.
    """
    keys = np.array([r[0] for r in rows])
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    least: dict[tuple, tuple] = {}
    several = np.flatnonzero(count[inverse] > 1).tolist()
    for i in several:
        key, x, did, start, _ = rows[i]
        at = (did, start)
        if least.setdefault((key, x), at) > at:
            least[key, x] = at
    for i in several:
        key, x, did, start, rid = rows[i]
        if (did, start) > least[key, x]:
            mixed = ((rid ^ start) * 0x9E3779B97F4A7C15) & (2**63 - 1)
            rows[i] = (mixed, len(x).to_bytes(4, "little"), did, start, rid)
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["h", "x", "did", "start", "rid"]
    )


def _stretch_rows(length: int):
    def run(batches):
        rows = []
        for batch in slices(batches):
            cols = (batch.column(c).to_pylist() for c in ("rid", "did", "text", "first", "live"))
            for rid, did, text, first, live in zip(*cols, strict=True):
                raw = _octets(text)
                if not first or not live or len(raw) < length:
                    continue
                found, h = stretches(np.frombuffer(raw, np.uint8), length)
                wanted = np.isin(found[:, 0], live)
                keys = h[wanted].view(np.int64).tolist()
                rows += [(key, raw[a:b], did, a, rid) for key, (_, a, b) in zip(keys, found[wanted].tolist(), strict=True)]
                if len(rows) > 50_000:
                    yield _stretch_batch(rows)
                    rows = []
        if rows:
            yield _stretch_batch(rows)

    return run


def _repeat_rows(length: int, pool_bytes: int, group_bytes: int):
    """Repeated spans; rows sorted by anchor, stretch, document and start."""

    def run(batches):
        names, kinds = ["rid", "did", "s", "e", "key"], [pa.int64()] * 4 + [pa.binary()]
        out: list[tuple] = []
        pool: list[tuple[bytes, int, int, int]] = []
        group: list[tuple[bytes, int, int, int]] = []
        pooled, held, key, last = 0, 0, None, None

        def flush_group():
            nonlocal group, pooled, held
            if len(group) > 1:
                pool.extend(group)
                pooled += held
            group, held = [], 0

        def flush_pool():
            nonlocal pool, pooled
            if pool:
                for (_, did, start, rid), at in zip(pool, repeats([p[:3] for p in pool], length), strict=True):
                    out.extend((rid, did, start + s, start + e, None) for s, e in spans_of(at, length))
            pool, pooled = [], 0

        def windows(x, did, start, rid):
            for i in range(len(x) - length + 1):
                out.append((rid, did, start + i, start + i + length, hashlib.blake2b(x[i : i + length], digest_size=16).digest()))

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for h, x, did, start, rid in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if len(x) == 4:
                    out.append((rid, did, start, start + int.from_bytes(x, "little"), None))
                    continue
                if h != key:
                    flush_group()
                    if pooled > pool_bytes:
                        flush_pool()
                    key, last, large = h, None, False
                if last is not None and last[0] == x:
                    if (did, start) != last[1:]:
                        out.append((rid, did, start, start + len(x), None))
                    continue
                last = (x, did, start)
                if large:
                    windows(x, did, start, rid)
                else:
                    group.append((x, did, start, rid))
                    held += len(x)
                    if held > group_bytes:
                        large = True
                        for g in group:
                            windows(*g)
                        group, held = [], 0
                if len(out) > 20_000:
                    yield batch_of()
                    out = []
            if len(out) > 20_000:
                yield batch_of()
                out = []
        flush_group()
        flush_pool()
        if out:
            yield batch_of()

    return run


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _removed(length: int):
    def run(batches):
        for batch in slices(batches):
            rows = []
            cols = (batch.column(c).to_pylist() for c in ("doc_id", "text", "first", "spans"))
            for doc, text, first, spans in zip(*cols, strict=True):
                raw = _octets(text)
                cut = sorted((s["s"], s["e"]) for s in spans or ())
                if not first and len(raw) >= length:
                    cut = [(0, len(raw))]
                kept, end, n_spans, removed = hashlib.sha256(), 0, 0, 0
                for s, e in cut:
                    e = min(e, len(raw))
                    if s > end or not n_spans:
                        n_spans += 1
                        kept.update(raw[end:s])
                        removed += e - s
                        end = e
                    elif e > end:
                        removed += e - end
                        end = e
                kept.update(raw[end:])
                rows.append((doc, len(raw), removed, n_spans, kept.hexdigest()))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string()]
                names = [f.split()[0] for f in RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def remove_repeats(
    docs: DataFrame,
    length: int = 100,
    pool_bytes: int = 1 << 19,
    group_bytes: int = 1 << 22,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null counts as empty; a null identifier comes before all others. Rows that
    repeat an identifier and a text are one document twice: neither starts
    earlier, both get the same result. Strings are judged on the input, not on
    what is left, and never cross documents. Other columns are not looked at; no
    rows give no rows. A text is held whole by one task, some 40 bytes for each
    of its bytes in parts of four megabytes.
    """
    if length < ANCHOR + 8:
        raise ValueError(f"length must be at least {ANCHOR + 8}")
    with scratch(docs.sparkSession) as keep:
        return keep(materialize(_removed_from(docs, length, pool_bytes, group_bytes, id_col, text_col), "removed"))


def _removed_from(docs: DataFrame, length: int, pool_bytes: int, group_bytes: int, id_col: str, text_col: str) -> DataFrame:
    parts = partitions(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    did = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63)))
    # With the id the row's own key: repeated rows share it and rows of one id with other texts do not.
    rid = F.xxhash64(did, text)
    digests = docs.select(did.alias("did"), rid.alias("rid"), F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("sha"))
    digests = materialize(digests, "digests")
    lead = digests.groupBy("sha").agg(F.min("did").alias("lead"), F.max("did").alias("end")).filter("lead < end")
    lead = materialize(lead.select("sha", "lead"), "lead")
    later = digests.join(few(lead), "sha").filter("did > lead").select("rid", "did").distinct()
    later = few(materialize(later, "later").withColumn("later", F.lit(True)))
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), did.alias("did"), rid.alias("rid"), text.alias("text"))
    base = base.join(later, ["rid", "did"], "left")
    base = base.select("rid", "doc_id", "did", "text", F.col("later").isNull().alias("first"))
    heads = base.filter("first").select("rid", "did", "text", "first")

    places = heads.mapInArrow(_anchor_rows(length), PLACE)
    places = places.repartition(parts, "key").sortWithinPartitions("key")
    live = places.mapInArrow(_live, "rid bigint, pos bigint").groupBy("rid").agg(F.collect_set("pos").alias("live"))
    live = materialize(live, "live")
    found = heads.join(live, "rid").mapInArrow(_stretch_rows(length), STRETCH)
    found = found.repartition(parts, "h").sortWithinPartitions("h", "x", "did", "start")
    spans = materialize(found.mapInArrow(_repeat_rows(length, pool_bytes, group_bytes), SPAN), "spans")
    windows = spans.filter("key IS NOT NULL")
    earliest = windows.groupBy("key").agg(F.min(F.struct("did", "s")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    again = windows.join(earliest, "key").filter(F.struct("did", "s") > F.col("first")).select("rid", "did", "s", "e")
    spans = spans.filter("key IS NULL").select("rid", "did", "s", "e").union(again)
    spans = spans.groupBy("rid", "did").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    return base.join(spans, ["rid", "did"], "left").mapInArrow(_removed(length), RESULT)
