import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import chat_format, decontaminate, exact_dedup, packing, queries, sharding, token_count


def docs_of(sf):
    return pd.read_parquet(f"{sf}/documents.parquet").set_index("doc_id")["text"].to_dict()


# --- op1 ---------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*chat_format.CONTROL, "\\", "<", "[", "s>", "/s>", "|end|>", "INST]", "a", "\n"]), max_size=12))
def test_escape_is_reversible_and_leaves_no_control(parts):
    text = "".join(parts)
    escaped = chat_format.escape(text)
    assert chat_format.unescape(escaped) == text
    assert not any(c in escaped for c in chat_format.CONTROL)
    assert chat_format.parse(chat_format.render("user", text) * 2) == [("user", text)] * 2


def chat_truth(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        all_ = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(all_), len(loss), sha(loss))
    return out


def test_op1_reads_back(spark, sf):
    t = pd.read_parquet(f"{sf}/conversations.parquet")
    rows = list(t[["conv_id", "turn", "role", "text"]].itertuples(index=False, name=None))
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r[0]: tuple(r[1:5]) for r in queries.op1_chat_format(spark, sf).collect()}
    assert got == chat_truth(rows)


def test_op1_windows_hold_the_budget(spark, sf):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = chat_format.format_windows(turns, path, budget=700, history=2, history_budget=200).collect()
    assert any(r["window"] > 0 for r in rows) and any(r["n_history"] for r in rows)
    for r in rows:
        assert r["oversize"] == (r["n_tokens"] > 700)
        assert not r["oversize"] or r["n_span"] == 1 and not r["n_history"]
        if r["n_system"]:
            assert chat_format.parse(r["text"])[0][0] == "system"


def test_op1_long_system_turn_and_long_conversation(spark):
    """A system turn that leaves too little room makes windows of single turns, marked; a conversation of half of all turns comes back whole."""
    path = queries.tokenizer_path("byte_bpe_50k.json")
    rows = [(1, 0, "system", "rule " * 90)] + [(1, i, "user" if i % 2 else "assistant", f"turn {i} " * 8) for i in range(1, 9)]
    rows += [(2, i, "user" if i % 2 else "assistant", f"said {i}") for i in range(3000)]
    rows += [(3, 0, "user", "long " * 400_000), (3, 1, "assistant", "short")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat_format.format_windows(df, path, budget=110)
    for r in windows.filter("conv_id = 1 AND window > 0").collect():
        assert r["n_system"] == 1 and (not r["oversize"] or (r["n_span"] == 1 and r["n_history"] == 0))
    got = {r[0]: tuple(r[1:5]) for r in chat_format.digest(windows).collect()}
    assert got == chat_truth(rows)


def test_op1_odd_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, None), (1, 2, "assistant", "x" * 9000),
        (None, 0, "assistant", "<|end|>"), (2, None, "system", ""), (2, 0, "assistant", ""), (3, 0, "assistant\n", "q"),
    ]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, window int")
    path = queries.tokenizer_path("byte_bpe_50k.json")
    got = {r[0]: tuple(r[1:5]) for r in chat_format.digest(chat_format.format_windows(df, path, budget=64)).collect()}
    assert got == chat_truth(rows)
    assert chat_format.digest(chat_format.format_windows(df.limit(0), path)).count() == 0


# --- op2 ---------------------------------------------------------------------------------


def unigram(path):
    from tokenizers import Tokenizer, models, normalizers

    vocabulary = token_count.piece_vocabulary(path)
    t = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], unk_id=0, byte_fallback=False))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return t


def test_op2_equals_the_library(spark, sf):
    t = unigram(queries.tokenizer_path("piece_bpe_32k.model"))
    texts = docs_of(sf)
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op2_token_count(spark, sf).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in texts.items()}


def test_op2_is_near_the_encoder_of_the_file(spark, sf):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    want = sum(len(own.encode(t)) for t in docs_of(sf).values())
    got = sum(r["n_tokens"] for r in queries.op2_token_count(spark, sf).collect())
    assert abs(got - want) < 0.02 * want


def test_op2_long_texts(spark):
    """Some megabytes of text, and one word of 200,000 characters."""
    path = queries.tokenizer_path("piece_bpe_32k.model")
    counter = token_count.Counter(token_count.piece_vocabulary(path))
    one = counter.text("some words here ")[1] - counter.text(" ")[1] + 1
    df = spark.createDataFrame([(1, "some words here " * 300_000), (2, "ab" * 100_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_count.count_tokens(df, path).collect()}
    assert abs(got[1] - 300_000 * counter.text("some words here")[1]) <= 1 and one > 0
    assert got[2] == counter.walk(token_count.MARK + "ab" * 100_000)[1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc é\n漢 ▁", max_size=30))
def test_op2_ties_and_unknowns(text):
    from tokenizers import Tokenizer, models, normalizers

    vocabulary = [("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -5.0), ("ba", -4.0), ("▁▁", -6.0), ("aba", -6.0)]
    t = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], unk_id=0, byte_fallback=False))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    want = len(t.encode(text, add_special_tokens=False).ids)
    counter = token_count.Counter(vocabulary)
    assert counter.by_word and counter.text(text)[1] == want
    counter.by_word = False
    assert counter.text(text)[1] == want


def test_op2_odd_rows(spark, odd_docs, no_docs):
    path = queries.tokenizer_path("piece_bpe_32k.model")
    rows = token_count.count_tokens(odd_docs, path).collect()
    assert len(rows) == odd_docs.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4)} == {0}
    assert token_count.count_tokens(no_docs, path).count() == 0


# --- op3 ---------------------------------------------------------------------------------


def test_op3_shards(spark, sf):
    rows = queries.op3_shard(spark, sf).collect()
    texts = docs_of(sf)
    assert {r["doc_id"] for r in rows} == set(texts)
    slots = defaultdict(list)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 16, zlib.crc32(data), "key")
        assert r["grown_shard"] in (r["shard"], 40) and 0 <= r["shard"] < 40
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    plan = queries.op3_shard(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_op3_weights(spark):
    from pyspark.sql import functions as F

    base = sharding.ShardTree((((1.0, 3.0), (2.0,)), ((2.0,),)))
    more = base.with_weight(0, 1, 0, 6.0)
    df = spark.range(20_000)
    for name, tree in (("a", base), ("b", more), ("c", base.with_new_shard(2.0))):
        df = sharding.with_shard(df, F.col("id"), tree, name)
    rows = df.collect()
    n = Counter(r["a"] for r in rows)
    assert [round(n[i] / 20_000, 1) for i in range(4)] == [0.1, 0.4, 0.2, 0.2] or abs(n[1] / 20_000 - 0.375) < 0.02
    both = sharding.with_shard(spark.range(20_000), F.col("id"), base, "a", "c", 2.0).collect()
    assert {(r["id"], r["a"], r["c"]) for r in both} == {(r["id"], r["a"], r["c"]) for r in rows}
    moved = [(r["a"], r["b"]) for r in rows if r["a"] != r["b"]]
    # The weights of region 0 and of its second rack rose: rows move into that region, or inside it into that rack.
    assert moved and all(b < 3 and (a == 3 or b == 2) for a, b in moved)
    assert {r["c"] for r in rows if r["a"] != r["c"]} == {4}


def test_op3_odd_rows(spark, odd_docs, no_docs):
    rows = sharding.assign_shards(odd_docs, queries.SHARDS, cell_rows=1).collect()
    assert len(rows) == odd_docs.count()
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {16}
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(no_docs, queries.SHARDS).count() == 0


def test_op3_equals_sql(spark, sf):
    same_rows(queries.op3_shard(spark, sf), queries.ORACLE_SQL["op3_shard"], {"documents": pd.read_parquet(f"{sf}/documents.parquet")})


def test_op3_one_row_many_times(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 7)
    df = spark.createDataFrame([(1, "same")] * 500 + [(2, f"text {i}") for i in range(500)], "doc_id long, text string")
    rows = sharding.assign_shards(df, queries.SHARDS, cell_rows=3).collect()
    assert len(rows) == 1000
    for i in (1, 2):
        shards = {r["shard"] for r in rows if r["doc_id"] == i}
        assert len(shards) == 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# --- op5 ---------------------------------------------------------------------------------


def pack_truth(texts, path, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        data = b"".join(x.to_bytes(4, "little") for x in part)
        assert (len(part), zlib.crc32(data), len(ids[r["doc_id"]])) == (r["length"], r["ids_crc32"], r["doc_tokens"])
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for i, parts in by_doc.items():
        end = 0
        for s, n in sorted(parts):
            assert s == end
            end += n
        assert end == len(ids[i])
    for parts in by_seq.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 2048
    return by_seq


def test_op5_pieces(spark, sf):
    by_seq = pack_truth(docs_of(sf), queries.tokenizer_path("word_bpe_49k.json"), queries.op5_pack(spark, sf).collect())
    used = sum(n for parts in by_seq.values() for _, n in parts)
    assert len(by_seq) <= -(-used // 2048) + 2


def test_op5_chunks_equal_whole_texts():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    t, enc = Tokenizer.from_file(path), packing.ChunkEncoder(path, bound=50)
    rng = random.Random(5)
    alphabet = ["a", "B", "'s", "'", "é", "é", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "12", "漢", "<|endoftext|>", "İ", "Σ", "́", "$%", "𝔸"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(25)))
        want = t.encode(text, add_special_tokens=False).ids
        assert enc.texts([text])[0] == b"".join(x.to_bytes(4, "little") for x in want), text


def test_op5_marks_after_every_letter_that_changes():
    """Every character that NFC or lower-casing changes, and capitals before combining marks, beside each mark."""
    import unicodedata

    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    t, enc = Tokenizer.from_file(path), packing.ChunkEncoder(path)
    odd = [c for c in map(chr, range(128, 0x110000)) if unicodedata.category(c) not in ("Cs", "Cn", "Co") and (unicodedata.normalize("NFC", c) != c or c.lower() != c or unicodedata.combining(c))]
    marks = [chr(b) for b in packing.TAIL] + ["!?", "'s", "'"]
    texts = [f"al{c}{m} {m}{c} {c}{m}x Q{c}" for i, c in enumerate(odd) for m in (marks[i % len(marks)], marks[(i + 7) % len(marks)])]
    texts += [f"AL{c}{m} {m}{c}" for c in "İıſẞΣςÅKfiﬁǅ" for m in marks]
    texts += [f"{a}{c}{m}" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in map(chr, range(0x300, 0x340)) for m in ".!"]
    want = [b"".join(x.to_bytes(4, "little") for x in e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]
    wrong = [x for x, a, b in zip(texts, enc.texts(texts), want, strict=True) if a != b]
    assert not wrong, wrong[:5]


def test_op5_one_identifier_is_spread(spark):
    """Rows of one identifier and the pieces of a giant text are dealt to many groups, and every id is packed once."""
    path = queries.tokenizer_path("word_bpe_49k.json")
    rows = [(None, "the same")] * 300 + [(7, f"text {i}") for i in range(300)] + [(8, "word " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(df, path, group_rows=40).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r["doc_id"]].add(r["sequence_id"] >> 32)
    assert all(len(g) > 5 for g in groups.values())
    assert sum(r["length"] for r in got if r["doc_id"] == 8) == 60_001
    used = Counter()
    for r in got:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048


@given(st.lists(st.integers(1, 50), max_size=60))
def test_op5_first_fit(lengths):
    got = packing.first_fit_decreasing(lengths, 50)
    bins, want = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, used in enumerate(bins) if used + lengths[i] <= 50), len(bins))
        if b == len(bins):
            bins.append(0)
        want[i] = (b, bins[b])
        bins[b] += lengths[i]
    assert got == want


def test_op5_odd_rows(spark, odd_docs, no_docs):
    path = queries.tokenizer_path("word_bpe_49k.json")
    rows = packing.pack(odd_docs, path).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] in (3, 4, 7)) == 3
    assert sum(1 for r in rows if r["doc_id"] == 2) == 2
    assert packing.pack(no_docs, path).count() == 0


# --- op9 ---------------------------------------------------------------------------------


def hits_truth(texts, items, size=10):
    windows = defaultdict(set)
    for i, t in items:
        for w in decontaminate.windows_of(decontaminate.words_of(t), size):
            windows[w].add(str(i))
    lengths = {len(w) for w in windows}
    out = Counter()
    for i, t in texts:
        words, hit, its = decontaminate.words_of(t), set(), set()
        for s in range(len(words)):
            for n in lengths:
                found = windows.get(tuple(words[s : s + n])) if s + n <= len(words) else None
                if found:
                    hit.update(range(s, s + n))
                    its |= found
        out[i, len(words), len(hit), len(its), hashlib.sha256(",".join(sorted(its)).encode()).hexdigest()] += 1
    return out


def got_hits(df):
    return Counter((r["doc_id"], r["__dc_n_words"], r["__dc_n_hit"], r["__dc_n_items"], r["__dc_items_sha256"]) for r in df.collect())


def test_op9_equals_brute_force(spark, sf):
    items = list(pd.read_parquet(f"{sf}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False, name=None))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = hits_truth(list(docs_of(sf).items()), items)
    assert sum(k[2] > 0 for k in want) > 0
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert got_hits(decontaminate.decontaminate(docs, bench)) == want


def test_op9_equals_sql(spark, sf):
    tables = {t: pd.read_parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark")}
    same_rows(queries.op9_decontaminate(spark, sf), queries.ORACLE_SQL["op9_decontaminate"], tables)


def test_op9_more_shingles_than_bits(spark, sf, monkeypatch):
    """A bitmap that lets everything through, and joins without a broadcast, change nothing."""
    items = list(pd.read_parquet(f"{sf}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False, name=None))
    monkeypatch.setattr(decontaminate, "MOST_BITS", 10)
    monkeypatch.setattr("millrace.sources.store.FEW", -1)
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    assert got_hits(decontaminate.decontaminate(docs, bench)) == hits_truth(list(docs_of(sf).items()), items)


def test_op9_item_names_and_overlaps(spark):
    """Names with line feeds and commas, the empty name, clashing columns, a window in half of all rows."""
    items = [("a\nb", "one two three four"), ("", "two three"), ("c,d", "two three"), ("e", "five"), ("f", "x y z x y z x y z x y z")]
    rows = [(i, "ONE two, three four five") for i in range(60)] + [(i, f"{i} x y z x y z x y z x y z x y z") for i in range(60, 90)] + [(90, "clean")]
    df = spark.createDataFrame([(*r, "q", 5) for r in rows], "doc_id long, text string, __dc_items string, __dc_n_hit long")
    got = decontaminate.decontaminate(df, spark.createDataFrame(items, "item_id string, text string"))
    assert got.columns[:2] == ["doc_id", "text"] and len(set(got.columns)) == len(got.columns)
    assert got_hits(got) == hits_truth(rows, items)
    assert got.filter("doc_id = 3").first()["__dc_items"] == ["", "a\nb", "c,d", "e"]


def test_op9_slices_do_not_join_texts():
    """The words of many texts lie in one row; a run of words never crosses from one to the next."""
    import pyarrow as pa

    texts = ["a b", "c d e", None, "", "a b c", "d", "é_b c"]
    all_ = decontaminate.Bitmap(10, np.full(128, 255, np.uint8))
    part = decontaminate.Slice(pa.array(texts), decontaminate.WordHash())
    for width in (1, 2, 3):
        got = [(int(part.owner[i]), tuple(part.words[i : i + width])) for i in part.found(all_, width)[0]]
        each = [decontaminate.words_of(t) for t in texts]
        assert got == [(j, tuple(ws[i : i + width])) for j, ws in enumerate(each) for i in range(len(ws) - width + 1)]


def test_op9_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "same TEXT"), (2, "same, text!"), (3, None), (4, ""), (None, "w1 w2 w3"), (5, " ".join(f"w{i}" for i in range(100, 112)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = decontaminate.decontaminate(odd_docs, bench)
    assert got.columns[: len(odd_docs.columns)] == odd_docs.columns
    named = [(i, t) for i, t in items if i is not None]
    by_named = decontaminate.decontaminate(odd_docs, bench.filter("item_id is not null"))
    assert got_hits(by_named) == hits_truth(rows, named)
    assert got.filter("__dc_n_hit > 0").count() >= 4
    assert decontaminate.decontaminate(no_docs, bench).count() == 0
    assert decontaminate.decontaminate(odd_docs, bench.limit(0)).filter("__dc_n_hit > 0").count() == 0


# --- op10 --------------------------------------------------------------------------------


def same_rows(spark_df, sql, tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df)
    want = con.execute(sql).df()
    got = spark_df.toPandas()[list(want.columns)]
    order = list(want.columns)
    key = lambda d: d.astype(object).where(d.notna(), None).astype(str).sort_values(order).reset_index(drop=True)
    pd.testing.assert_frame_equal(key(got), key(want))


def test_op10_equals_sql(spark, sf):
    tables = {"documents": pd.read_parquet(f"{sf}/documents.parquet")}
    same_rows(queries.op10_exact_dedup(spark, sf), queries.ORACLE_SQL["op10_exact_dedup"], tables)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_op10_groups_over_partitions(spark, keep):
    rows = [(i, "Copy" if i % 3 else f"own {i}") for i in range(900)] + [(900, "COPY"), (900, "copy"), (901, None), (902, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_dedup.exact_dedup(df, keep=keep).toPandas()
    copies = got[got["__xd_group_size"] > 2]
    assert len(copies) == 602 and set(copies["__xd_group_size"]) == {602}
    want = 900 if keep == "largest" else 1
    assert set(copies["__xd_keep_id"]) == {want}
    assert copies["__xd_kept"].sum() == 1 and set(copies[copies["__xd_kept"]]["doc_id"]) == {want}
    empty = got[got["doc_id"].isin([901, 902])]
    assert set(empty["__xd_group_size"]) == {2} and got["__xd_kept"].sum() == 302


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_op10_common_beginnings(spark, keep):
    """Texts that share their beginning and large groups among them, cut over partitions in the middle of it."""
    start = "the very same beginning of all of these "
    rng = random.Random(4)
    rows = [(i, start + (f"own {i}" if i % 4 else f"group {rng.choice('aaabc')}" + "x" * 50)) for i in range(2000)]
    rows += [(i, start) for i in range(2000, 2300)] + [(None, start + "own 1"), (None, "alone"), (None, "alone")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, __xd_kept string").repartition(9)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = exact_dedup.exact_dedup(df, keep=keep, carry=["doc_id", "text", "__xd_kept"]).toPandas()
        short = exact_dedup.exact_dedup(df, keep=keep, sizes=False).filter("__xd_kept").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    by = defaultdict(list)
    for i, t in rows:
        by[t].append(i)
    best = max if keep == "largest" else min
    want = {t: (best([i for i in ids if i is not None], default=None), len(ids)) for t, ids in by.items()}
    for r in got.to_dict("records"):
        k, n = want[r["text"]]
        assert (None if pd.isna(r["__xd_keep_id"]) else r["__xd_keep_id"], r["__xd_group_size"]) == (k, n)
    kept = got[got["__xd_kept"]]
    assert len(kept) == len(by) == short
    assert all(pd.isna(i) if want[t][0] is None else i == want[t][0] for i, t in zip(kept["doc_id"], kept["text"], strict=True))


def test_op10_odd_rows(spark, odd_docs, no_docs):
    got = exact_dedup.exact_dedup(odd_docs, carry=odd_docs.columns).toPandas()
    assert len(got) == odd_docs.count() and got.columns[:8].tolist() == odd_docs.columns
    assert got["__xd_kept"].sum() == odd_docs.selectExpr("lower(coalesce(text, ''))").distinct().count()
    assert exact_dedup.exact_dedup(no_docs).count() == 0
