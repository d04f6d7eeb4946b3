"""N-gram Jaccard self-join by a prefix join with grouped posting lists, and its components.

1. Documents with equal shingle sets are one class; their links need no join.
2. Shingles are ordered by rarity, so that widely shared ones come last. A table
   of hashed frequencies gives the order; it has a byte for every sixteen shingles
   of the corpus, 64 MB at most (beyond, rarity blurs, which costs time, not
   links). A set's prefix is as long as the threshold demands: two sets that
   reach it share a shingle of their prefixes.
3. Classes of one size and one prefix are one group; posting lists of prefix
   shingles are made of groups, and a group without a neighbour of near size in
   a list leaves it. What is left is expanded to classes in each list, before
   pairing: no pairs of groups are formed.
4. A list of up to ``SHORT`` classes tries all pairs. A longer one is dealt to
   blocks of about ``BLOCK`` by a hash, twice and each time anew, and each member
   tries the nearest of the 1,024 before it in its block. Members that link so are in one component and
   need no more pairs among themselves. What is left is tried in full: in lists
   that hold several components, all pairs over different ones, each pair of
   blocks in a task of its own. So a large group of near copies costs pairs in
   proportion to its size, no list meets in one task, and no link between
   components is lost, whatever these sizes are.
5. Candidates are pairs of classes. Each class has a bitmap of the parities of
   its hashed shingles, a 32nd of the set's size; the bits in which two of them
   differ are a lower bound of the sets' difference, which rules out most
   candidates for certain. The others are verified on their whole sets.

The result is components only. Step 4 skips pairs inside a component, so neither
the links nor their number can be had from here. Shingles are compared by 64-bit
hashes of their words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .common import SPACE_WORDS, discard, materialize, partitions, scratch, slices

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Least and most bits of a bucket's number in the frequency table (a byte each on every worker).
LEAST_BITS, MOST_BITS, SLICES = 16, 26, 64
#: Classes of a posting list that are tried against each other in one task.
BLOCK = 1024
#: Up to so many identifiers are broadcast to fetch their texts; beyond that both sides are shuffled.
FEW_IDS = 1_000_000


class WordHash(dict):
    """64-bit hashes of words, kept up to a bound."""

    bound = 150_000

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) >= self.bound:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


def shingle_set(text: str | None, k: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles; of fewer words the whole sequence."""
    words = (text or "").encode("utf-8", "replace").translate(SPACE_WORDS).split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(k, n)
    x = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        x = (x ^ w[i : n - width + 1 + i]) * MIX
        x ^= x >> np.uint64(29)
    return np.unique(x)


def bitmap(s: np.ndarray) -> bytes:
    """Parities of the set's elements by hash bucket, in at least two buckets an element."""
    bits = max(6, int(2 * len(s) - 1).bit_length())
    at = ((s * MIX) >> np.uint64(64 - bits)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=1 << bits) & 1 == 1).tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their bitmaps."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) != len(b):
        # Buckets are high bits of one hash: a smaller table's parity is that of neighbours together.
        a, b = np.unpackbits(a), np.unpackbits(b)
        while len(a) > len(b):
            a = a[::2] ^ a[1::2]
        while len(b) > len(a):
            b = b[::2] ^ b[1::2]
        return int((a ^ b).sum())
    return int(np.bitwise_count(a ^ b).sum())


def _table_bits(docs: DataFrame, text_col: str) -> int:
    """A bucket for every sixteen words, taken as six bytes each, within the bounds."""
    octets = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return min(MOST_BITS, max(LEAST_BITS, (octets // 96).bit_length()))


def _frequency_table(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """Documents by hash bucket of their shingles, in steps of an eighth of a doubling."""
    import zstandard

    bits = _table_bits(docs, text_col)
    size = 1 << bits
    shift = np.uint64(64 - bits)

    def count(batches):
        hashes, total, held, n = WordHash(), np.zeros(size, np.uint16), [], 0

        def add_up():
            at, c = np.unique((np.concatenate(held) >> shift).astype(np.int64), return_counts=True)
            total[at] = np.minimum(total[at] + c, 2**16 - 1)

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                s = shingle_set(text, k, hashes)
                held.append(s)
                n += len(s)
                if n > 1_000_000:
                    add_up()
                    held, n = [], 0
        if held:
            add_up()
        z = zstandard.ZstdCompressor(level=1)
        for i, part in enumerate(total.reshape(SLICES, -1)):
            packed = z.compress(part.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed], pa.binary())], names=["slice", "counts"])

    def add(key: tuple, batches):
        z = zstandard.ZstdDecompressor()
        total = np.zeros(size // SLICES, np.int64)
        for batch in batches:
            for b in batch.column(1).to_pylist():
                total += np.frombuffer(z.decompress(b), np.uint16)
        steps = np.minimum(np.round(8 * np.log2(1 + total)), 255).astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([steps], pa.binary())], names=["slice", "counts"])

    schema = "slice int, counts binary"
    rows = docs.select(text_col).mapInArrow(count, schema).groupBy("slice").applyInArrow(_typed(add), schema).collect()
    table = np.zeros((SLICES, size // SLICES), np.uint8)
    for r in rows:
        table[r["slice"]] = np.frombuffer(r["counts"], np.uint8)
    return table.reshape(-1)


def _typed(f):
    from collections.abc import Iterator

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(key, batches)

    run.__annotations__ = {
        "key": tuple[pa.Scalar, ...],
        "batches": Iterator[pa.RecordBatch],
        "return": Iterator[pa.RecordBatch],
    }
    return run


def _signatures(docs: DataFrame, table: np.ndarray, k: int, percent: int) -> DataFrame:
    shift = np.uint64(64 - (len(table).bit_length() - 1))

    def sign(batches):
        hashes = WordHash()
        for part in slices(batches):
            ns, keys, groups, prefixes, maps = [], [], [], [], []
            for text in part.column(1).to_pylist():
                s = shingle_set(text, k, hashes)
                n = len(s)
                p = n - (percent * n + 99) // 100 + 1 if n else 0
                first = s[np.lexsort((s, table[s >> shift]))[:p]] if n else s
                ns.append(n)
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                groups.append(hashlib.blake2b(first.tobytes(), digest_size=16).digest())
                prefixes.append(first.view(np.int64))
                maps.append(bitmap(s) if n else b"")
            offsets = np.cumsum([0, *map(len, prefixes)])
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(ns, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(groups, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    pa.array(maps, pa.binary()),
                ],
                names=["doc_id", "n", "set_key", "prefix_key", "prefix", "bits"],
            )

    return docs.mapInArrow(sign, "doc_id bigint, n bigint, set_key binary, prefix_key binary, prefix array<bigint>, bits binary")


def _live_lists(percent: int):
    """Posting lists' groups with another of a size within reach; rows sorted by token, size and group. Holds one row."""

    def run(batches):
        held = None  # the last row, and whether it reaches the one before it
        for batch in batches:
            token, gid, n = (batch.column(i).to_numpy() for i in range(3))
            reached = np.zeros(len(token) + (held is not None), bool)
            if held is not None:
                token, gid, n = (np.append(a, b) for a, b in zip(held[:3], (token, gid, n), strict=True))
                reached[0] = held[3]
            if not len(token):
                continue
            new = np.append(True, (token[1:] != token[:-1]) | (gid[1:] != gid[:-1]))
            token, gid, n, reached = token[new], gid[new], n[new], reached[new]
            near = (token[1:] == token[:-1]) & (n[:-1] * 100 >= percent * n[1:])
            reached[1:] = near
            keep = (reached[:-1] | near).nonzero()[0]
            held = (token[-1:].copy(), gid[-1:].copy(), n[-1:].copy(), bool(reached[-1]))
            if len(keep):
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, gid, n)], names=["token", "gid", "n"])
        if held is not None and held[3]:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[:3]], names=["token", "gid", "n"])

    return run


def _fold(bits: np.ndarray) -> np.ndarray:
    """A bitmap of half as many buckets."""
    x = np.unpackbits(bits)
    return np.packbits(x[::2] ^ x[1::2])


class _List:
    """A posting list's classes by size, with their bitmaps."""

    def __init__(self, rows: list[tuple], percent: int):
        self.percent = percent
        self.sid, self.n = (np.array([r[i] for r in rows]) for i in (1, 2))
        self.maps = [np.frombuffer(r[3], np.uint8)[8:] for r in rows]
        wide = np.array([len(m) for m in self.maps])
        starts = np.flatnonzero(np.append(True, wide[1:] != wide[:-1]))
        self.runs = [(a, b, np.stack(self.maps[a:b])) for a, b in zip(starts, np.append(starts[1:], len(rows)), strict=True)]

    def slack(self, i: int, others: np.ndarray) -> np.ndarray:
        """How far bitmaps and sizes are from ruling out links of ``i``: negative where they do, else 0 to 1."""
        apart = np.zeros(len(others), np.int64)
        for start, stop, rows in self.runs:
            here = (others >= start) & (others < stop)
            if here.any():
                own, rows = self.maps[i], rows[others[here] - start]
                while len(own) > rows.shape[1]:
                    own = _fold(own)
                while len(own) < rows.shape[1]:
                    rows = np.stack([_fold(r) for r in rows])
                apart[here] = np.bitwise_count(rows ^ own).sum(axis=1, dtype=np.int64)
        p, n = self.percent, self.n
        most = (100 - p) * (n[others] + n[i])
        out = (most - (100 + p) * apart) / most
        small, large = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
        return np.where(100 * small >= p * large, out, -1.0)

    def pairs(self, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.minimum(self.sid[others], self.sid[i]), np.maximum(self.sid[others], self.sid[i])


#: Lists of so many members or fewer try all pairs at once.
SHORT = 8


def _lists(percent: int, emit):
    """Run ``emit(list, rows)``, which yields index arrays (i, others), on every posting list; rows come sorted."""

    def run(batches):
        group, token, out, held = [], None, [], 0

        def batch_of():
            a, b = (np.concatenate(x) for x in zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        def flush():
            n = 0
            if len(group) > 1:
                members = _List(group, percent)
                for i, others in emit(members, group):
                    out.append(members.pairs(i, others))
                    n += len(others)
            return n

        for batch in slices(batches, 2048):
            for r in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                if r[0] != token:
                    held += flush()
                    group, token = [], r[0]
                    if held > 20_000:
                        yield batch_of()
                        out, held = [], 0
                group.append(r)
        held += flush()
        if held:
            yield batch_of()

    return run


def _nearest_pairs(members: _List, rows):
    """All pairs of a short list; in a longer one each member with the nearest of those before it.

    By size the members before are the next smaller ones, a thousand of them at
    most. Where near copies link to their nearest, one such pair each joins them
    all to one component.
    """
    k = len(members.n)
    for i in range(1, k):
        others = np.arange(max(0, i - 1024), i)
        slack = members.slack(i, others)
        others = others[slack >= 0] if k <= SHORT else others[[int(slack.argmax())]] if slack.max() >= 0 else others[:0]
        if len(others):
            yield i, others


def _cross_pairs(members: _List, rows):
    """Pairs of a list over different components; of a list of two blocks, pairs over these."""
    comp, side = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
    if len(np.unique(comp)) < 2:
        return
    for i in range(1, len(comp)):
        low = int(np.searchsorted(members.n[:i], (members.percent * members.n[i] + 99) // 100))
        others = comp[low:i] != comp[i]
        if side[i]:
            others &= side[low:i] != side[i]
        others = low + np.flatnonzero(others)
        others = others[members.slack(i, others) >= 0]
        if len(others):
            yield i, others


def _sides(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with the value of either side as xa and xb."""
    for side in ("b", "a"):
        pairs = pairs.join(values.select(F.col("sid").alias(side), F.col(column).alias(f"x{side}")), side)
    return pairs.select("a", "b", "xa", "xb")


def _verify(pairs: DataFrame, rows: DataFrame, k: int, percent: int, named: DataFrame | None = None) -> DataFrame:
    """Pairs of classes whose whole sets reach the threshold.

    A class goes by its least identifier, or as ``named`` (vid, doc_id, set_key) says.
    """

    keyed = named is not None

    def whole(batches):
        hashes = WordHash()
        for batch in slices(batches):
            sets = [shingle_set(t, k, hashes).tobytes() for t in batch.column(1).to_pylist()]
            columns, names = [batch.column(0), pa.array(sets, pa.binary())], ["sid", "x"]
            if keyed:
                keys = [hashlib.blake2b(x, digest_size=16).digest() for x in sets]
                columns, names = [*columns, pa.array(keys, pa.binary())], [*names, "set_key"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def check(batches):
        for batch in slices(batches, 512):
            keep = []
            for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    if keyed:
        own = named.select("vid", F.col("doc_id").alias("own"))
        ids = ids.withColumnRenamed("doc_id", "vid").join(own, "vid", "left")
        ids = ids.select(F.coalesce("own", "vid").alias("doc_id")).distinct()
    ids = materialize(ids, "ids")
    wanted = rows.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, "doc_id", "left_semi")
    schema = "sid bigint, x binary" + ", set_key binary" * keyed
    sets = wanted.select("doc_id", "text").mapInArrow(whole, schema)
    if keyed:
        sets = sets.join(named.withColumnRenamed("doc_id", "sid"), ["sid", "set_key"], "left")
        sets = sets.select(F.coalesce("vid", "sid").alias("sid"), "x")
    sets = materialize(sets, "sets")
    return _sides(pairs, sets, "x").mapInArrow(check, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(v, c): each linked vertex and the smallest one it reaches; by least labels and pointer jumps."""
    both = materialize(links.union(links.select("b", "a")).toDF("v", "u").distinct(), "links")
    labels = materialize(both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("c")), "labels")
    while True:
        near = both.join(labels.toDF("u", "cu"), "u").groupBy("v").agg(F.min("cu").alias("cu"))
        nxt = labels.join(near, "v").select("v", "c", F.least("c", "cu").alias("d"))
        jump = labels.select(F.col("v").alias("d"), F.col("c").alias("cd"))
        nxt = nxt.join(jump, "d", "left").select("v", F.least("d", "cd").alias("c"), (F.least("d", "cd") < F.col("c")).alias("moved"))
        nxt = materialize(nxt, "labels")
        labels = nxt.select("v", "c")
        if nxt.filter("moved").isEmpty():
            labels._path = nxt._path
            return labels


def _versions(linked: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of documents with several texts."""
    again = linked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("doc_id")
    own = linked.select("doc_id", "set_key").join(again, "doc_id", "left_semi").distinct()
    own = own.join(classes.select("set_key", "vid"), "set_key").select("doc_id", "vid")
    least = own.groupBy("doc_id").agg(F.min("vid").alias("a"))
    return own.join(least, "doc_id").filter("a < vid").select("a", F.col("vid").alias("b")).distinct()


def jaccard_components(
    docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Texts
    without words have no shingles and are linked with nothing, nor is a row
    without an identifier (its component is null). Rows that repeat an
    identifier count as versions of one document: their links are its links.
    An empty table gives no rows; other columns are not looked at. A text is
    held whole by one task, its words some 60 bytes each.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(materialize(_components_of(docs, k, percent, id_col, text_col), "components"))


def _components_of(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    parts = partitions(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(_signatures(rows, _frequency_table(rows, "text", k), k, percent), "signatures")
    sigs = materialize(signed.select("doc_id", "n", "set_key"), "rows")
    linked = signed.filter("n > 0 and doc_id is not null").select("doc_id", "n", "set_key", "prefix_key")
    classes = linked.groupBy("set_key", "n", "prefix_key").agg(F.min("doc_id").alias("sid"))
    classes = materialize(classes, "classes")
    # An identifier that is the least of several classes can't name them: those go by a hash of their sets.
    shared = materialize(classes.groupBy("sid").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("sid"), "shared")
    named = None
    if shared.isEmpty():
        classes = classes.withColumn("vid", F.col("sid"))
    else:
        vid = F.when(F.col("many"), F.xxhash64("set_key")).otherwise(F.col("sid"))
        classes = classes.join(shared.withColumn("many", F.lit(True)), "sid", "left").withColumn("vid", vid)
        classes = materialize(classes, "classes")
        named = classes.filter("many").select("vid", F.col("sid").alias("doc_id"), "set_key")
        classes = classes.drop("many")
    versions = materialize(_versions(linked, classes), "versions")
    groups = classes.groupBy("n", "prefix_key").agg(F.min(F.struct("vid", "sid")).alias("head"))
    groups = groups.select("n", "prefix_key", F.col("head.vid").alias("gid"), F.col("head.sid").alias("head"))
    members = classes.join(groups.select("n", "prefix_key", "gid"), ["n", "prefix_key"])
    heads = signed.filter("n > 0 and doc_id is not null").select("doc_id", "n", "prefix_key", "prefix").join(
        groups.withColumnRenamed("head", "doc_id"), ["doc_id", "n", "prefix_key"]
    )
    posts = heads.select(F.explode("prefix").alias("token"), "gid", "n")
    posts = posts.repartition(parts, "token").sortWithinPartitions("token", "n", "gid")
    live = materialize(posts.mapInArrow(_live_lists(percent), "token bigint, gid bigint, n bigint"), "postings")
    # Classes of groups that share a prefix shingle with another or hold several classes.
    several = classes.groupBy("n", "prefix_key").agg(F.min("vid").alias("gid"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    alive = live.select("gid").union(several.select("gid")).distinct()
    size = F.unhex(F.lpad(F.hex("n"), 16, "0"))
    bits = signed.select(F.col("doc_id").alias("sid"), "set_key", F.concat(size, "bits").alias("bits"))
    nodes = members.join(alive, "gid", "left_semi").join(bits, ["sid", "set_key"]).select("gid", F.col("vid").alias("sid"), "n", "bits")
    nodes = materialize(nodes.dropDuplicates(["sid", "gid"]), "nodes")
    several = materialize(several, "several")
    # Prefixes and bitmaps are not needed any more, of all tables the largest.
    discard(spark, signed)

    spread = live.select("token", "gid").join(nodes, "gid").select("token", "sid", "n", "bits")
    inside = several.join(nodes.drop("n"), "gid").select(F.col("gid").alias("token"), "sid", "n", "bits")
    spread = spread.union(inside)
    # Long lists and their blocks; a member's block is a hash of it.
    long = spread.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > SHORT)
    long = materialize(long.select("token", F.ceil(F.col("m") / F.lit(BLOCK)).cast("int").alias("blocks")), "long")
    own = lambda k: F.pmod(F.xxhash64("sid", F.lit(k)), F.col("blocks")).cast("int")
    pair = "a bigint, b bigint"
    # Two ways to deal a list to blocks: a block of one way meets all of the other, so near copies of a list come together.
    dealt = spread.join(long, "token", "left")
    ways = F.array(*[F.xxhash64("token", F.lit(k), own(k)) for k in (1, 2)])
    dealt = dealt.withColumn("token", F.explode(F.when(F.col("blocks") > 1, ways).otherwise(F.array("token"))))
    dealt = dealt.select("token", "sid", "n", "bits").repartition(parts, "token").sortWithinPartitions("token", "n", "sid")
    tried = materialize(dealt.mapInArrow(_lists(percent, _nearest_pairs), pair).distinct(), "pairs")
    with scratch(spark) as keep:
        links = keep(materialize(_verify(tried, rows, k, percent, named).union(versions), "links"))
    with scratch(spark) as keep:
        labels = keep(components(links))

    # Lists that hold several components, in pairs of blocks.
    where = spread.select("token", "sid").join(long, "token").join(labels.toDF("sid", "c"), "sid", "left")
    mixed = where.groupBy("token", "blocks").agg(F.min(F.coalesce("c", "sid")).alias("x"), F.max(F.coalesce("c", "sid")).alias("y"))
    mixed = materialize(mixed.filter("x < y").select("token", "blocks"), "mixed")
    dealt = spread.join(mixed, "token").join(labels.toDF("sid", "c"), "sid", "left").withColumn("own", own(1))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select("token", "sid", "n", "bits", F.coalesce("c", "sid").alias("c"), "own", other.alias("other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    dealt = dealt.select(F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")).alias("token"), "sid", "n", "bits", "c", side.alias("side"))
    dealt = dealt.repartition(parts, "token").sortWithinPartitions("token", "n", "sid")
    cross = dealt.mapInArrow(_lists(percent, _cross_pairs), pair).distinct()
    rest = materialize(cross.join(tried, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        with scratch(spark) as keep:
            more = keep(materialize(_verify(rest, rows, k, percent, named), "links"))
        if not more.isEmpty():
            labels = components(links.union(more))

    if named is not None:  # labels are hashes in part: take the least identifier
        own = labels.toDF("vid", "c").join(classes.select("vid", "sid"), "vid")
        labels = own.join(own.groupBy("c").agg(F.min("sid").alias("least")), "c").select("vid", "least")
    called = classes.join(labels.toDF("vid", "c"), "vid", "left").select("set_key", F.coalesce("c", "sid").alias("c"))
    # Rows without words or identifier are a component each; they are many of one key and join with nothing.
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    out = sigs.filter(~alone).select("doc_id", "n", "set_key").join(called, "set_key", "left").select("doc_id", "n", "c")
    out = out.union(sigs.filter(alone).select("doc_id", "n", F.col("doc_id").alias("c")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("c").alias("component_id"))
