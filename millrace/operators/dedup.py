"""Deduplication of generated conversations: exact, repetitive, near, repeated openings.

The first reason wins, in that order. Exact duplicates, repetition and openings
are windows on hashed keys; near duplicates compare within a bucket.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scoring as s, text as t
from ..sources.store import discard, few, materialize, scratch

# Fixed values.
NEAR, OPENING_SHARE, REPETITIVE = 0.92, 0.08, 0.10
#: Length from which difflib leaves out frequent characters, and the longest run of others that is looked up.
LONG, RUN = 200, 16


def conversation(m: Column) -> Column:
    """Folded ``role: content`` lines."""
    return t.fold(F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit(": "), x["content"])), "\n"))


def signature(m: Column) -> Column:
    """SHA-256 of the conversation (not the signature of cleaning)."""
    return F.sha2(conversation(m), 256)


def is_near(x: str, y: str, threshold: float = NEAR) -> bool:
    """Whether the ratio of ``difflib.SequenceMatcher`` (candidate first) reaches the threshold."""
    from difflib import SequenceMatcher

    m = SequenceMatcher(None, x, y)
    return m.real_quick_ratio() >= threshold and m.quick_ratio() >= threshold and m.ratio() >= threshold


def _alike(x: str, i: int, y: str, j: int, most: int, step: int) -> int:
    """Characters, at most ``most``, that are the same from ``x[i]`` and ``y[j]`` on; with a step of -1 those before them, backwards."""
    n, wide = 0, 64
    part = lambda s, at, k: s[at + n : at + n + k] if step > 0 else s[at - n - k : at - n]
    while wide:
        if n + wide <= most and part(x, i, wide) == part(y, j, wide):
            n += wide
        else:
            wide //= 2
    return n


def reaches(x: str, y: str, threshold: float = NEAR) -> bool:
    """``is_near`` for texts that are much alike: the blocks of ``difflib``, until the verdict is certain.

    Only characters that difflib starts a match at are looked at; frequent ones
    of a long ``y`` come in as a match is extended, as there. A block starts from
    the longest run of such characters, which are few: runs of each length are
    looked up, longest first. Where they are long, difflib itself is asked.
    """
    total = len(x) + len(y)
    if not total or x == y:
        return 1.0 >= threshold
    most = len(y) // 100 + 1 if len(y) >= LONG else len(y)
    rare = {c for c, n in Counter(y).items() if n <= most}
    levels: list[tuple[list[int], dict[str, list[int]]]] = []
    starts, others = ([i for i, c in enumerate(s) if c in rare] for s in (x, y))
    while starts and others:
        size, where = len(levels) + 1, {}
        if size > RUN:
            return is_near(x, y, threshold)
        for j in others:
            where.setdefault(y[j : j + size], []).append(j)
        starts = [i for i in starts if x[i : i + size] in where]
        levels.append((starts, where))
        # A run that starts here is longer by one where a run starts at the next character.
        starts, others = ([i for i, after in zip(s, s[1:]) if after == i + 1] for s in (starts, others))  # noqa: B905
    regions, matched, room = [(0, len(x), 0, len(y))], 0, min(len(x), len(y))
    while 2.0 * matched / total < threshold:
        if 2.0 * (matched + room) / total < threshold or not regions:
            return False
        alo, ahi, blo, bhi = regions.pop()
        room -= min(ahi - alo, bhi - blo)
        i, j, size = alo, blo, 0
        for k in range(len(levels), 0, -1):
            starts, where = levels[k - 1]
            for p in starts[bisect_left(starts, alo) : bisect_right(starts, ahi - k)]:
                at = where[x[p : p + k]]
                q = bisect_left(at, blo)
                if q < len(at) and at[q] <= bhi - k:
                    i, j, size = p, at[q], k
                    break
            if size:
                break
        back = _alike(x, i, y, j, min(i - alo, j - blo), -1)
        i, j, size = i - back, j - back, size + back
        size += _alike(x, i + size, y, j + size, min(ahi - i, bhi - j) - size, 1)
        if size:
            matched += size
            for part in ((alo, i, blo, j), (i + size, ahi, j + size, bhi)):
                if part[0] < part[1] and part[2] < part[3]:
                    regions.append(part)
                    room += min(part[1] - part[0], part[3] - part[2])
    return True


def exact(df: DataFrame, digest: str, order: list[str]) -> DataFrame:
    """Add ``is_exact_duplicate``: an earlier row has the digest.

    The first of each digest comes from an aggregate with map-side combine, so
    that a digest of very many rows does not meet in one task.
    """
    key = F.struct(*order)
    first = df.groupBy(digest).agg(F.min(key).alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    joined = df.join(first, digest, "left")
    return joined.withColumn("is_exact_duplicate", F.col("__first").isNotNull() & (F.struct(*order) > F.col("__first"))).drop("__first")


def repetitive(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("is_repetitive", s.repetition_penalty(F.col(text)) >= F.lit(REPETITIVE))


def opening(text: Column) -> Column:
    """First sentence, folded."""
    return F.coalesce(F.try_element_at(t.sentences(t.fold(text)), F.lit(1)), F.lit(""))


def opening_cap(df: DataFrame, text: str, order: list[str], cap: int, counts: Column | None = None) -> DataFrame:
    """Add ``over_cap``: rows beyond the first ``cap`` of one opening; ``order`` identifies a row.

    Only rows for which ``counts`` holds take a place (those not rejected for
    another reason); others are never over the cap.

    Only the first rows are ranked: Spark keeps ``cap`` rows of an opening in
    each partition before the shuffle, so a common opening stays small there.
    """
    w = Window.partitionBy("__opening").orderBy(*order)
    counted = df if counts is None else df.filter(counts)
    first = counted.select(*order, opening(F.col(text)).alias("__opening")).withColumn("__rank", F.row_number().over(w))
    first = first.filter(F.col("__rank") <= cap).select(*order, F.lit(True).alias("__within"))
    return df.join(first, order, "left").withColumn("over_cap", F.col("__within").isNull() & (F.lit(True) if counts is None else F.coalesce(counts, F.lit(False)))).drop("__within")


def cap_for(target: int, share: float = OPENING_SHARE) -> int:
    return max(1, int(target * share))


def near_links(df: DataFrame, bucket: str, text: str, key: str, threshold: float = NEAR) -> DataFrame:
    """A row per row: key, class_id (least key of the bucket with the same words), links and nearest.

    ``links`` counts the other rows of the bucket whose sets of words reach the
    threshold, ``nearest`` is the largest similarity among them (null: none).
    Copies are one class, so they are counted and not paired. Sets are written
    once, as hashes of 64 bits of bucket and word; a class is told by its words.
    """
    with scratch(df.sparkSession) as keep:
        rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(bucket).cast("string"), F.lit("")).alias("g"), t.fold(F.coalesce(text, F.lit(""))).alias("x"))
        rows = rows.select("k", "g", F.sort_array(F.array_distinct(F.split("x", " "))).alias("w"))
        rows = materialize(rows.select("k", "g", F.unhex(F.sha2(F.array_join("w", " "), 256)).alias("s"), _hashes("g", "w")), "sets")
        classes = rows.groupBy("g", "s").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("size"))
        classes = materialize(classes.withColumn("i", F.monotonically_increasing_id()), "classes")
        links = _near(rows, classes, ["g", "s", "k"], threshold, _links, "i bigint, others bigint, far double")
        links = links.groupBy("i").agg(F.sum("others").alias("others"), F.max("far").alias("far"))
        nearest = F.when(F.col("size") > 1, F.lit(1.0)).otherwise(F.col("far"))
        found = classes.join(links, "i", "left")
        found = found.select("g", "s", F.col("k").alias("class_id"), (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"), nearest.alias("nearest"))
        return keep(materialize(rows.select("k", "g", "s").join(found, ["g", "s"]).select(F.col("k").alias(key), "class_id", "links", "nearest"), "near"))


def near_jaccard(sets: DataFrame, bucket: str, words: str, key: str, threshold: float = NEAR) -> DataFrame:
    """Pairs (bucket, a, b, similarity) of different sets of words in a bucket that reach the threshold, by hashes of the words."""
    with scratch(sets.sparkSession) as keep:
        rows = materialize(sets.select(F.col(key).alias("k"), F.col(bucket).alias("g"), _hashes(F.col(bucket), words)), "sets")
        ids = materialize(rows.select("g", "k").distinct().withColumns({"i": F.monotonically_increasing_id(), "size": F.lit(1).cast("bigint")}), "ids")
        pairs = _near(rows, ids, ["g", "k"], threshold, _pairs, "a bigint, b bigint, similarity double")
        one, two = ids.select(F.col("i").alias("a"), "g", F.col("k").alias("x")), ids.select(F.col("i").alias("b"), F.col("k").alias("y"))
        pairs = pairs.join(one, "a").join(two, "b").select("g", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")
        return keep(materialize(pairs, "pairs"))


#: Cells of the table of counts of words, as a power of two: what comes to the driver has a row for each at most.
CELL_BITS = 18
#: Cells of the sketch that goes with each word of a prefix, and pairs or words that are looked at together.
PARITIES, TOGETHER = 256, 1 << 19
#: Pairs of sets with the same least hash beyond which they are dealt to several tiles.
TILE = 1 << 17
#: Bits that tell which sets are still needed, as a power of two: what comes to the driver is so much at most.
NEED_BITS = 25


def _hashes(bucket, words: str) -> Column:
    return F.sort_array(F.transform(words, lambda x: F.xxhash64(bucket, x))).alias("h")


def _prefixes(table: np.ndarray, threshold: float):
    """The rarest words of a set, of which it shares one with every set that reaches the threshold, and their places; words of one set alone are left out.

    With them comes a sketch with a cell for a word at least, for each cell whether
    an odd number of words is in it, the same folded to ``PARITIES`` cells, and the
    least hash, which sets that are near mostly share.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            h = batch.column(batch.num_columns - 1)
            ends = np.asarray(h.offsets)
            values, found, places, sketches = h.values.to_numpy(), [], [], []
            sizes = np.diff(ends)
            values = values[ends[0] : ends[-1]]
            ends = ends - ends[0]
            for i, n in enumerate(sizes.tolist()):
                own = values[ends[i] : ends[i + 1]]
                f = table[own & (len(table) - 1)]
                first = np.lexsort((own, f))[: n - int(np.ceil(threshold * n - 1e-9)) + 1]
                place = np.flatnonzero(f[first] > 1)
                found.append(own[first[place]])
                places.append(place.astype(np.int32))
                cells = max(PARITIES, 1 << (n - 1).bit_length())
                sketches.append(np.packbits(np.bincount((own >> 32) & (cells - 1), minlength=cells) & 1))
            odd = [np.bitwise_xor.reduce(x.reshape(-1, PARITIES // 8)) for x in sketches]
            at = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x) if x else [], kind)) for x, kind in ((found, pa.int64()), (places, pa.int32()))]
            cells = [pa.array([x.tobytes() for x in y], pa.binary()) for y in (odd, sketches)]
            cols = [pa.array(sizes, pa.int32()), *lists, *cells, pa.array(values[ends[:-1]], pa.int64())]
            names = [*batch.schema.names[:-1], "n", "x", "p", "odd", "sketch", "least"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=names)

    return run


def _meetings(threshold: float):
    """Of the entries (word, set) of a partition: pairs of sets that share a word and that lengths, places and sketches do not rule out.

    The first word that two sets share, in the order of all words, has so many
    words after it, itself included, in both that enough can be shared; another
    word that is shared need not say so. A cell that is odd in one sketch only
    stands for a word that is not shared. A row is a set and others with it.
    """

    def run(batches):
        import pyarrow as pa

        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        entries = pa.Table.from_batches(batches)
        x, ids, n, p = (entries.column(c).to_numpy() for c in ("x", "i", "n", "p"))
        odd = np.frombuffer(b"".join(entries.column("odd").to_pylist()), np.uint64).reshape(len(x), -1)
        order = np.lexsort((ids, n, x))
        x, ids, odd, n, p = x[order], ids[order], odd[order], n[order].astype(np.int64), p[order].astype(np.int64)
        word = np.cumsum(np.concatenate([[0], x[1:] != x[:-1]]).astype(np.int64)) << 32
        after = np.searchsorted(word + n, word + ((n + 1e-9) / threshold).astype(np.int64), "right")
        counts = np.maximum(0, after - np.arange(len(x)) - 1)
        names, ids = np.unique(ids, return_inverse=True)
        sums, begin, found = np.concatenate([[0], np.cumsum(counts)]), 0, np.zeros(0, np.int64)
        while begin < len(x):
            end = max(begin + 1, int(np.searchsorted(sums, sums[begin] + TOGETHER, "right")) - 1)
            left = np.repeat(np.arange(begin, end), counts[begin:end])
            right = left + 1 + np.arange(len(left)) - (sums[left] - sums[begin])
            both = n[left] + n[right]
            fits = np.minimum(n[left] - p[left], n[right] - p[right]) >= threshold / (1 + threshold) * both - 1e-9
            left, right, both = left[fits], right[fits], both[fits]
            apart = np.zeros(len(left), np.int64)
            for c in range(odd.shape[1]):
                apart += np.bitwise_count(odd[left, c] ^ odd[right, c])
            fits = (apart <= (1 - threshold) / (1 + threshold) * both + 1e-9) & (ids[left] != ids[right])
            one, two = ids[left[fits]], ids[right[fits]]
            found = np.union1d(found, np.minimum(one, two) * len(names) + np.maximum(one, two))
            begin = end
        one, two = found // len(names), found % len(names)
        starts = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]])) if len(one) else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array([*starts, len(one)], pa.int32()), pa.array(names[two], pa.int64()))
        yield from pa.table({"a": pa.array(names[one[starts]], pa.int64()), "b": lists}).to_batches(max_chunksize=1024)

    return run


def _left(threshold: float):
    """Of a tile, the lists without the sets that whole sketches rule out; the longer of two sketches is folded to the other's cells."""

    def run(lists, sides):
        import pyarrow as pa

        at, n = {i: j for j, i in enumerate(sides.column("i").to_pylist())}, sides.column("n").to_numpy().astype(np.int64)
        bits = [np.frombuffer(x, np.uint64) for x in sides.column("sketch").to_pylist()]
        wide = np.array([len(x) for x in bits])
        kept, ends, heads = [np.zeros(0, np.int64)], [0], []
        for one, names in zip(lists.column("a").to_pylist(), lists.column("b").to_pylist(), strict=True):
            a, names = at[one], np.array(names)
            others = np.array([at[b] for b in names.tolist()])
            fits = np.zeros(len(others), bool)
            for w in np.unique(wide[others]):
                same = np.flatnonzero(wide[others] == w)
                cells = min(w, wide[a])
                own = np.bitwise_xor.reduce(bits[a].reshape(-1, cells))
                for part in np.array_split(same, len(same) * w // TOGETHER + 1):
                    if len(part):
                        theirs = np.bitwise_xor.reduce(np.concatenate([bits[b] for b in others[part].tolist()]).reshape(len(part), -1, cells), axis=1)
                        apart = np.bitwise_count(theirs ^ own).sum(axis=1, dtype=np.int64)
                        fits[part] = apart <= (1 - threshold) / (1 + threshold) * (n[a] + n[others[part]]) + 1e-9
            if fits.any():
                heads.append(one)
                kept.append(names[fits])
                ends.append(ends[-1] + len(kept[-1]))
        tile = pa.array([lists.column("tile")[0].as_py()] * len(heads), pa.int64())
        left = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(kept), pa.int64()))
        return pa.table({"tile": tile, "a": pa.array(heads, pa.int64()), "b": left})

    return run


def _needed(rows: DataFrame, some: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose keys may be among those of ``some``, told by bits, so that a join need not shuffle all others."""
    cell = F.pmod(F.xxhash64(*on), F.lit(1 << NEED_BITS))
    found = some.select(cell.alias("c")).groupBy(F.shiftright("c", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(c & 63 AS int)))").alias("bits"))
    found, table = found.toArrow(), np.zeros(1 << (NEED_BITS - 6), np.int64)
    table[found["at"].to_numpy()] = found["bits"].to_numpy()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            c = batch.column(batch.num_columns - 1).to_numpy()
            yield batch.filter(pa.array(((table[c >> 6] >> (c & 63)) & 1).astype(bool)))

    dealt = rows.withColumn("c", cell.cast("bigint"))
    return dealt.mapInArrow(run, dealt.schema).drop("c")


def _shared(lists, sets, threshold: float):
    """Of a tile, for each set with others: its place, theirs that reach the threshold, and the similarities."""
    h = sets.column("h").combine_chunks()
    ends = np.asarray(h.offsets)
    words, flat = np.unique(h.values.to_numpy()[ends[0] : ends[-1]], return_inverse=True)
    ends = ends - ends[0]
    sizes, at = np.diff(ends), {i: j for j, i in enumerate(sets.column("i").to_pylist())}
    mark = np.zeros(len(words), bool)
    for a, others in zip(lists.column("a").to_pylist(), lists.column("b").to_pylist(), strict=True):
        a, others = at[a], np.array([at[b] for b in others])
        own = flat[ends[a] : ends[a + 1]]
        mark[own] = True
        # Some at a time, so that few words are copied.
        for part in np.array_split(others, sizes[others].sum() // TOGETHER + 1):
            if len(part):
                rows = np.concatenate([flat[ends[b] : ends[b + 1]] for b in part.tolist()])
                both = np.add.reduceat(mark[rows], np.cumsum(sizes[part]) - sizes[part], dtype=np.int64)
                similarity = both / (sizes[a] + sizes[part] - both)
                near = similarity >= threshold
                yield a, part[near], similarity[near]
        mark[own] = False


def _links(threshold: float):
    """Of a tile, for each set: rows whose sets reach the threshold, and the largest similarity."""

    def run(lists, sets):
        import pyarrow as pa

        size = sets.column("size").to_numpy()
        others, far = np.zeros(len(size), np.int64), np.zeros(len(size))
        for a, near, similarity in _shared(lists, sets, threshold):
            if len(near):
                others[a] += size[near].sum()
                others[near] += size[a]
                far[a] = max(far[a], similarity.max())
                far[near] = np.maximum(far[near], similarity)
        some = np.flatnonzero(others)
        return pa.table({"i": pa.array(sets.column("i").to_numpy()[some]), "others": pa.array(others[some]), "far": pa.array(far[some])})

    return run


def _pairs(threshold: float):
    def run(lists, sets):
        import pyarrow as pa

        i, a, b, sim = sets.column("i").to_numpy(), [], [], []
        for one, near, similarity in _shared(lists, sets, threshold):
            a.append(np.full(len(near), i[one]))
            b.append(i[near])
            sim.append(similarity)
        one, two, sim = (np.concatenate([np.zeros(0, kind), *x]) for x, kind in ((a, np.int64), (b, np.int64), (sim, np.float64)))
        return pa.table({"a": pa.array(one), "b": pa.array(two), "similarity": pa.array(sim)})

    return run


def _near(rows: DataFrame, ids: DataFrame, on: list[str], threshold: float, form, schema: str) -> DataFrame:
    """What ``form`` makes of the pairs of sets that reach the threshold, each pair looked at in one tile; ``rows`` and ``ids`` are written tables.

    Words are joined, rarest first, on the prefix that the threshold demands,
    so that sets that share only common words never meet. Any fixed order of
    the words will do, so rarity is that of a word's cell in a table of counts
    and each set finds its prefix by itself. Pairs travel as lists: sets with the
    same least hash go to a tile with what they are compared with, to several
    tiles where they have many pairs. Their sketches go there first, and the sets
    themselves only for what these leave.
    """
    spark = rows.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cell = F.col("x").bitwiseAND(F.lit((1 << CELL_BITS) - 1))
    counts = rows.select(F.explode("h").alias("x")).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("f")).toArrow()
    table = np.zeros(1 << CELL_BITS, np.int64)
    table[counts["cell"].to_numpy()] = counts["f"].to_numpy()
    keyed = rows.select(*on, "h").filter(F.size("h") > 0)
    made = keyed.select(*on, F.lit(0).alias("n"), F.col("h").alias("x"), F.array(F.lit(0)).alias("p"), F.lit(b"").alias("odd"), F.lit(b"").alias("sketch"), F.lit(0).cast("bigint").alias("least")).schema
    prefixes = keyed.mapInArrow(_prefixes(table, threshold), made).filter(F.size("x") > 0)
    heads = materialize(prefixes.join(ids.select(*on, "i"), on).drop(*on).dropDuplicates(["i"]), "prefixes")
    entries = heads.select("i", "n", "odd", F.explode(F.arrays_zip("x", "p")).alias("e")).select("e.x", "i", "n", "e.p", "odd")
    met = entries.repartition(spread, "x").mapInArrow(_meetings(threshold), "a bigint, b array<bigint>")
    lists = met.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("b"))).alias("b"))
    lists = materialize(lists.join(heads.select(F.col("i").alias("a"), "least"), "a"), "lists")
    # Tiles: a part of all least hashes, or of one that has many pairs those of some sets with some others.
    many = lists.groupBy("least").agg(F.sum(F.size("b")).alias("pairs")).filter(F.col("pairs") > TILE)
    many = materialize(many.select("least", F.ceil(F.sqrt(F.col("pairs") / TILE)).cast("int").alias("parts")), "many")
    lists = lists.join(few(many), "least", "left")
    part = lambda c: F.pmod(F.xxhash64(c), F.col("parts"))
    one = lists.filter("parts IS NULL").select(F.pmod(F.xxhash64("least"), F.lit(4 * spread)).alias("tile"), "a", "b")
    cut = lists.filter("parts IS NOT NULL").withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cut = cut.select(F.xxhash64("least", part("a"), "q").alias("tile"), "a", F.filter("b", lambda y: part(y) == F.col("q")).alias("b")).filter(F.size("b") > 0)
    tiles = materialize(one.union(cut), "tiles")
    members = lambda x: x.groupBy("tile").agg(F.array_distinct(F.concat(F.collect_list("a"), F.flatten(F.collect_list("b")))).alias("i")).select("tile", F.explode("i").alias("i"))
    sides = materialize(members(tiles), "members").join(heads.select("i", "n", "sketch"), "i")
    left = tiles.groupBy("tile").cogroup(sides.groupBy("tile")).applyInArrow(_left(threshold), tiles.schema)
    tiles = materialize(left, "tiles")
    sides = materialize(members(tiles).join(ids, "i"), "sides")
    sets = _needed(rows.select(*on, "h"), sides, on).join(sides, on).select("tile", "i", "size", "h")
    return tiles.groupBy("tile").cogroup(sets.groupBy("tile")).applyInArrow(form(threshold), schema)


#: Cells of a sketch for a character.
CELLS = 4
#: Rows of a bucket and band of lengths that are compared with as many others at a time.
BLOCK = 8192
#: Open pairs that a row compares in a round, and open pairs that are all compared at once, their rows judged on the driver.
TRIES, REST = 16, 100_000


def _width(threshold: float) -> float:
    """Logarithm of the ratio between the ends of a band of lengths: near texts are at most one band apart."""
    return float(np.log((2 - threshold) / threshold)) + 1e-9


def _shape(band: int, threshold: float) -> tuple[int, int]:
    """Length of the grams and cells of the sketches of pairs whose shorter text is in the band."""
    low = np.exp(band * _width(threshold))
    return 4 if low < LONG else 6, 512 * int(np.ceil(CELLS * low * (2 - threshold) / threshold / 512))


def _grams(c: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of 32 bits of the 4-grams and 6-grams of code points."""
    c = c * np.uint64(0x9E3779B97F4A7C15)
    c ^= c >> np.uint64(29)
    two = c[:-1] * np.uint64(0xBF58476D1CE4E5B9) + c[1:]
    two ^= two >> np.uint64(31)
    four = two[:-2] * np.uint64(0x94D049BB133111EB) + two[2:]
    six = four[:-2] * np.uint64(0xD6E8FEB86659FD93) + two[4:]
    mixed = lambda h: ((h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return {4: mixed(four), 6: mixed(six)}


def _bits(h: np.ndarray, cells: int) -> bytes:
    """Cells of the grams, a bit each; the second gram of a cell and those after it have cells of their own."""
    counts = np.bincount(((h * np.uint64(cells)) >> np.uint64(32)).astype(np.int64), minlength=cells)
    more = np.flatnonzero(counts > 1)
    times = counts[more] - 1
    ends = np.cumsum(times)
    nth = np.arange(1, (ends[-1] if len(ends) else 0) + 1) - np.repeat(ends - times, times)
    counts[(np.repeat(more, times) + nth * 0x9E3779B1) % cells] = 1
    return np.packbits(counts > 0).tobytes()


def _sketches(threshold: float):
    """Length, characters that difflib may start a match at, and sketches for pairs with the own band and the next, and with the one before."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            size, starts, own, down = [], [], [], []
            for x, band in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                c = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32)
                counts = np.unique(c, return_counts=True)[1]
                size.append(len(c))
                starts.append(len(c) if len(c) < LONG else int(counts[counts <= len(c) // 100 + 1].sum()))
                grams = _grams(c.astype(np.uint64)) if len(c) > 5 else dict.fromkeys((4, 6), np.zeros(0, np.uint64))
                if len(c) in (4, 5):
                    grams[4] = _grams(np.append(c, np.zeros(2, np.uint32)).astype(np.uint64))[4][: len(c) - 3]
                for to, at in ((own, band), (down, max(0, band - 1))):
                    q, cells = _shape(at, threshold)
                    to.append(_bits(grams[q], cells))
            cols = [batch.column(0), batch.column(1), batch.column(3), pa.array(size, pa.int64()), pa.array(starts, pa.int64()), pa.array(own, pa.binary()), pa.array(down, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["g", "k", "band", "size", "starts", "same", "down"])

    return run


def _common(some: np.ndarray, one: np.ndarray, words: int = 1 << 15) -> np.ndarray:
    """Bits that each row of ``some`` shares with ``one``: counts of eight words are added at once, in four lanes of 16 bits."""
    even, out, wide = np.uint64(0x00FF00FF00FF00FF), np.zeros((len(some), 4), np.int64), 8 * 500
    step = max(1, words // min(wide, some.shape[1]))
    for first in range(0, some.shape[1], wide):
        for at in range(0, len(some), step):
            eight = np.bitwise_count(some[at : at + step, first : first + wide] & one[first : first + wide]).view(np.uint64)
            lanes = (eight & even).sum(axis=1) + ((eight >> np.uint64(8)) & even).sum(axis=1)
            out[at : at + step] += lanes.view(np.uint16).reshape(-1, 4)
    return out.sum(axis=1)


def _reach(threshold: float):
    """Pairs (a, b) of a group's rows, a the smaller key, that their lengths and grams do not rule out.

    Of texts with m characters in matching blocks, all grams are shared but those
    that hold or span an unmatched character: m less q - 1 for each block. Between
    blocks is an unmatched character, and every block but one at the very start
    holds a character that difflib has not left out as frequent in the earlier
    text, so there are few blocks. A cell of one text that the other lacks stands
    for a gram that is not shared, so a pair is left out only for certain. Rows
    of one side are compared with the other's, or with their own where the
    group is a block with itself.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "k"], ignore_index=True)
        q = _shape(int(pdf["lo"].iloc[0]) // 2, threshold)[0]
        keys, left, sizes, starts = (pdf[c].to_numpy() for c in ("k", "left", "size", "starts"))
        bits = np.frombuffer(b"".join(pdf["sketch"]), np.uint64).reshape(len(pdf), -1)
        # Cells less grams: how many fewer there are as grams meet in a cell.
        lost = np.bitwise_count(bits).sum(axis=1, dtype=np.int64) - np.maximum(0, sizes - q + 1)
        alone = left.all()
        right = np.arange(len(pdf)) if alone else np.flatnonzero(~left)
        keys_, sizes_, starts_, bits_, lost_ = keys[right], sizes[right], starts[right], bits[right], lost[right]
        ratio, a, b = (2 - threshold) / threshold, [], []
        for i in np.flatnonzero(left):
            begin = i + 1 if alone else np.searchsorted(sizes_, sizes[i] / ratio - 1)
            part = slice(begin, np.searchsorted(sizes_, sizes[i] * ratio + 1, "right"))
            both = sizes_[part] + sizes[i]
            matched = np.ceil(threshold * both / 2 - 1e-9).astype(np.int64)
            blocks = 1 + np.minimum(both - 2 * matched, np.where(keys_[part] < keys[i], starts_[part], starts[i]))
            need = matched - (q - 1) * blocks + np.maximum(lost_[part], lost[i])
            fits = (_common(bits_[part], bits[i]) >= need) & (matched <= np.minimum(sizes_[part], sizes[i]))
            other = keys_[part][fits]
            a.append(np.minimum(other, keys[i]))
            b.append(np.maximum(other, keys[i]))
        none = [np.zeros(0, np.int64)]
        return pd.DataFrame({"a": np.concatenate(a or none), "b": np.concatenate(b or none)})

    return run


def _candidates(rows: DataFrame, x: str, threshold: float) -> DataFrame:
    """Pairs (a, b) of a bucket that ``x`` may be near in.

    Lengths of near texts differ by a bounded ratio, so a row only meets its own
    band of lengths and the next. A band is cut into blocks, and each pair of
    blocks is a group of its own, to which sketches of the texts are dealt.
    """
    band = F.floor(F.ln(F.greatest(F.length(x), F.lit(1)) + F.lit(0.0)) / F.lit(_width(threshold))).cast("int")
    schema = "g string, k bigint, band int, size bigint, starts bigint, same binary, down binary"
    rows = materialize(rows.select("g", "k", F.col(x).alias("x"), band.alias("band")).mapInArrow(_sketches(threshold), schema), "sketches")
    blocks = materialize(rows.groupBy("g", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("n")), "blocks")
    higher = blocks.select("g", (F.col("band") - 1).alias("band"), F.col("n").alias("up"))
    lower = blocks.select("g", (F.col("band") + 1).alias("band"), F.col("n").alias("under"))
    bands = materialize(blocks.join(higher, ["g", "band"], "left").join(lower, ["g", "band"], "left"), "bands")
    rows = rows.join(few(bands), ["g", "band"])
    own = F.pmod(F.xxhash64("k"), F.col("n")).cast("int")
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    group = lambda lo, p, q, left: F.struct(lo.alias("lo"), p.alias("p"), q.alias("q"), left.alias("left"))
    rows = rows.withColumn("own", own)
    same = F.transform(upto("n"), lambda q: group(F.col("band") * 2, F.least(q, F.col("own")), F.greatest(q, F.col("own")), F.col("own") <= q))
    up = F.transform(upto("up"), lambda q: group(F.col("band") * 2 + 1, F.col("own"), q, F.lit(True)))
    down = F.transform(upto("under"), lambda p: group((F.col("band") - 1) * 2 + 1, p, F.col("own"), F.lit(False)))
    dealt = rows.select("g", "k", "size", "starts", "same", "down", F.explode(F.concat(same, up, down)).alias("to"))
    lower_band = (F.col("to.lo") % 2 == 1) & ~F.col("to.left")
    dealt = dealt.select("g", "k", "size", "starts", F.when(lower_band, F.col("down")).otherwise(F.col("same")).alias("sketch"), "to.*")
    return dealt.groupBy("g", "lo", "p", "q").applyInPandas(_reach(threshold), "a bigint, b bigint")


def near_sequence(df: DataFrame, bucket: str, text: str | list[str], key: str, threshold: float = NEAR) -> DataFrame:
    """Rows with the earlier accepted row of their bucket that they are near to, if any: key, near_key, is_near_duplicate.

    Rows are judged in key order; one that is near to an accepted one before it
    is not accepted itself. Similarity is the ratio of
    ``difflib.SequenceMatcher`` (candidate first), as no built-in has it; of
    several texts the largest ratio. Equal rows are judged once. Of the pairs that
    lengths and 4-grams leave open, each row compares its first ``TRIES`` in a
    round, over all tasks; then rows with no pair left before them are accepted,
    those near to one are gone, and so are the pairs of what is gone. So a large
    group of near copies costs pairs in proportion to its size. The search for
    open pairs is quadratic in a bucket's band of lengths, a block of rows against
    a block in each task.
    """
    texts = [text] if isinstance(text, str) else list(text)
    names = [f"x{i}" for i in range(len(texts))]
    side = [F.coalesce(F.col(x), F.lit("")).alias(n) for x, n in zip(texts, names, strict=True)]

    def verify(batches):
        for pdf in batches:
            pdf["near"] = [
                any(reaches(row[f"b{n}"], row[f"a{n}"], threshold) for n in names)
                for row in pdf[[f"{s}{n}" for s in "ab" for n in names]].to_dict("records")
            ]
            yield pdf[["a", "b", "near"]]

    with scratch(df.sparkSession) as keep:
        rows = df.select(F.coalesce(F.col(bucket).cast("string"), F.lit("")).alias("g"), F.col(key).cast("bigint").alias("k"), *side)
        rows = materialize(rows.withColumn("same", F.sha2(F.to_json(F.struct("g", *names)), 256)), "texts")
        heads = materialize(rows.groupBy("same", "g", *names).agg(F.min("k").alias("k")), "heads")
        texts_, rows = rows, materialize(rows.select("same", "k"), "rows")
        discard(df.sparkSession, texts_)
        # Pairs left, whether they are near (null: not yet compared), and the rows that are gone with the least accepted one they are near to.
        with scratch(df.sparkSession) as keep_open:
            open_ = None
            for n in names:
                found = _candidates(heads, n, threshold)
                open_ = found if open_ is None else open_.union(found)
            open_ = keep_open(materialize(open_.distinct().withColumn("near", F.lit(None).cast("boolean")), "open"))
        gone = df.sparkSession.createDataFrame([], "b bigint, least bigint")
        spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        whole = lambda s: heads.select(F.col("k").alias(s), *[F.col(n).alias(f"{s}{n}") for n in names])
        # Each row's pairs come to a task with its text, which many tasks share without another shuffle of texts.
        compared = lambda now: now.join(whole("a"), "a").repartition(spread, "b").join(whole("b"), "b").mapInPandas(verify, "a bigint, b bigint, near boolean")
        while left := open_.count():
            if left <= REST:
                checked = compared(open_.filter("near IS NULL").select("a", "b")).union(open_.select("a", "b", "near")).filter("near")
                least: dict[int, int] = {}
                for b, a in sorted(zip(*checked.select("b", "a").toArrow().to_pydict().values(), strict=True)):
                    if a not in least:
                        least.setdefault(b, a)
                last = df.sparkSession.createDataFrame(list(least.items()), gone.schema)
                gone = materialize(gone.union(last).groupBy("b").agg(F.min("least").alias("least")), "gone")
                break
            unknown = open_.filter("near IS NULL").withColumn("at", F.row_number().over(Window.partitionBy("b").orderBy("a")))
            checked = compared(unknown.filter(F.col("at") <= TRIES).select("a", "b")).filter("near")
            later = unknown.filter(F.col("at") > TRIES).select("a", "b", "near")
            pairs = materialize(open_.filter("near").union(later).union(checked), "pairs")
            # Rows with no pair before them, of those that are not gone.
            undecided = pairs.join(gone.select("b"), "b", "left_anti").select(F.col("b").alias("a")).distinct()
            lost = gone.select(F.col("b").alias("a"))
            first = pairs.select("a").distinct().join(undecided, "a", "left_anti").join(lost, "a", "left_anti")
            first = materialize(first, "accepted")
            hit = pairs.filter("near").join(first, "a", "left_semi").groupBy("b").agg(F.min("a").alias("least"))
            gone = materialize(gone.union(hit).groupBy("b").agg(F.min("least").alias("least")), "gone")
            rest = pairs.join(first.withColumn("done", F.lit(True)), "a", "left").filter("done IS NULL OR near IS NULL").drop("done")
            rest = rest.join(gone.select(F.col("b").alias("a")), "a", "left_anti")
            # A row that is gone may still be near to an earlier one that is accepted later.
            rest = rest.join(gone, "b", "left").filter("least IS NULL OR a < least").select("a", "b", "near")
            open_ = materialize(rest, "open")
        head = rows.select("same", "k").join(heads.select("same", F.col("k").alias("h")), "same")
        out = head.join(gone.withColumnRenamed("b", "h"), "h", "left")
        # Copies of a row are near to what it is near to, or to it.
        near_key = F.coalesce("least", F.when(F.col("k") > F.col("h"), F.col("h")))
        out = out.select(F.col("k").alias(key), near_key.alias("near_key"), near_key.isNotNull().alias("is_near_duplicate"))
        return keep(materialize(out, "near"))
