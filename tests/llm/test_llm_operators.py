"""Each operator against a brute-force version, and on awkward rows."""

import collections
import hashlib
import json
import os
import random
import sys
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

import corpus_pipeline as pipeline
from clickpath.llm import (catalog, common, components, decontaminate, language, packing, quality, sharding, simhash, suffix_dedup,
                           token_files, tokens, tool_calls, weighted_minhash)

SF = "/root/testdata/sf0.001"
BASE = " ".join(f"word{i * 37 % 101} item{i}" for i in range(120))

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()),
    ("score", T.StringType()), ("h", T.StringType()), ("shard", T.StringType()), ("ranges", T.StringType()))])


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "src", None if text is None else len(text), "s", "h", "x", "r")


AWKWARD = [row(1, BASE), row(2, BASE), row(2, BASE), row(3, None, None), row(4, ""), row(5, " \n\t"), row(None, "a lone text"), row(6, "é日本 ß" * 40),
           row(7, BASE[:900] + " changed " + BASE[909:]), row(7, "another text of the same id"), row(8, "x" * 3000), row(9, "one two"),
           row(10, (BASE + "\n") * 30), row(11, "???"), row(12, "<|endoftext|> don't  stop")]


@pytest.fixture(scope="module")
def docs(spark):
    common.configure(spark)
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


TEXTS = [(r[0], r[1] or "") for r in AWKWARD]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_encoder_equals_the_library():
    t = tokens.Tokenizer.from_file(tokens.default_tokenizer())
    t.encode_special_tokens = True
    enc = tokens.Encoder(tokens.default_tokenizer())
    texts = [x for _, x in TEXTS] + ["  a  b\n\n\nc ", "٥٣²Ⅷ 'll x\r\n", "a" * 300, " " * 70 + "x"]
    for _ in range(2):
        assert [np.frombuffer(enc.encode(x), "<u4").tolist() for x in texts] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_pieces_equal_the_librarys_on_any_white_space_and_quotes(monkeypatch):
    plain, enc = tokens.Tokenizer.from_file(tokens.default_tokenizer()), tokens.encoder(tokens.default_tokenizer())
    rng, parts = random.Random(3), [" ", " ", "\n", "\t", "a", "B", ".", "'s", "'", "ll", "re", "ü", "9", "漢", "\x1c", "\xa0", "\u3000", "\r", "<|endoftext|>", "foo", "\u0301", "  ", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    want = [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode_all(texts)] == want
    monkeypatch.setattr(tokens, "CHARS_AT_ONCE", 40)  # texts of several stretches
    for k in range(0, len(texts), 40):
        whole = "".join(texts[k:k + 40])
        assert np.frombuffer(enc.encode(whole), "<u4").tolist() == plain.encode(whole, add_special_tokens=False).ids


def test_added_tokens_have_their_ids(spark, tmp_path):
    path = tokens.default_tokenizer()
    plain, enc = tokens.Tokenizer.from_file(path), tokens.encoder(path)
    texts = [x for _, x in TEXTS] + ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>'s\n\n <|endoftext|", "<|endoftext|>\n  y"]
    want = [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert [np.frombuffer(enc.encode(x), "<u4").tolist() for x in texts] == want and want[-4] == [64, 220, 50256, 275]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_files.write(common.configure(spark) and df, str(tmp_path / "ids"))
    rows = token_files.read(spark, str(tmp_path / "ids")).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == {i: [*x, token_files.END_ID] for i, x in enumerate(want)}
    assert {r.doc_id: r.doc_tokens for r in packing.pack(df).collect()} == {i: len(x) + 1 for i, x in enumerate(want)}


def test_encoder_cache_generations(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 5)
    enc, whole = tokens.Encoder(tokens.default_tokenizer()), tokens.Encoder(tokens.default_tokenizer())
    for x in ["a b c d e f g", "h i j k a b", BASE, "a b c"] * 2:
        monkeypatch.setattr(tokens, "CACHE_PIECES", 5)
        got = enc.encode(x)
        monkeypatch.setattr(tokens, "CACHE_PIECES", 10 ** 9)
        assert got == whole.encode(x)


def test_pieces_are_looked_up_together(monkeypatch):
    plain, enc = tokens.Tokenizer.from_file(tokens.default_tokenizer()), tokens.Encoder(tokens.default_tokenizer(), added_tokens=True)
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcdefghü漢") for _ in range(7)) for _ in range(3000))
    want, calls = plain.encode(text, add_special_tokens=False).ids, []
    for _ in range(2):  # unknown pieces, then known ones
        sys.setprofile(lambda frame, event, arg: calls.append(frame.f_code.co_name) if event == "call" else None)
        try:
            got = enc.encode(text)
        finally:
            sys.setprofile(None)
        assert np.frombuffer(got, "<u4").tolist() == want and len(calls) < 200
    asked, ask = [], enc._pieces._ask
    monkeypatch.setattr(enc._pieces, "_ask", lambda pieces: asked.extend(pieces) or ask(pieces))
    monkeypatch.setattr(tokens, "CACHE_PIECES", 10)
    assert enc.encode(text) == got and asked == []  # they are the older generation now
    long = "x" * tokens.CACHE_PIECE_BYTES
    for _ in range(2):
        enc.encode(f"{long} {long}")
    assert asked == [long.encode(), b" " + long.encode(), b" " + long.encode()]


def test_packing(docs, nothing):
    rows = packing.pack(docs).collect()
    enc = tokens.encoder(tokens.default_tokenizer())
    want = collections.Counter()
    for doc_id, text in TEXTS:
        ids = enc.encode(text) + packing.END_ID.to_bytes(4, "little")
        at = 0
        for n in packing.piece_lengths(len(ids) // 4, packing.SEQUENCE_TOKENS):
            want[(doc_id, at, n, ids[4 * at:4 * (at + n)], len(ids) // 4)] += 1
            at += n
        assert 4 * at == len(ids)
    assert collections.Counter((r.doc_id, r.start, r.length, bytes(r.ids), r.doc_tokens) for r in rows) == want
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    by_length = collections.defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.offset == 0
        by_length[r.length].append(r.sequence_id)
    assert all(max(x) - min(x) + 1 == len(x) for x in by_length.values())
    assert packing.pack(nothing).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, longest=1000)


@pytest.mark.parametrize("ids", [[], [7], [5] * 1024, list(range(3000)), [1] * 2000 + [2 ** 32 - 1], np.random.default_rng(0).integers(0, 50257, 5000)])
def test_blocks_round_trip(ids):
    a = np.asarray(ids, np.uint32)
    blocks = token_files.encode_blocks(a)
    starts = np.cumsum([0, *map(len, blocks)])
    assert (token_files.decode_blocks(b"".join(blocks), starts, len(a)) == a).all()


def test_block_widths_are_bits_and_rare_ids_exceptions():
    ids = np.arange(token_files.BLOCK, dtype=np.uint32) % 700
    ids[::50] = 50_000
    block, = token_files.encode_blocks(ids)
    _, width, exceptions = token_files.BLOCK_HEADER.unpack_from(block)
    assert (width, exceptions) == (10, len(ids[::50])) and len(block) == token_files.BLOCK_HEADER.size + 128 * width + 6 * exceptions
    assert (token_files.decode_blocks(block, np.array([0, len(block)]), len(ids)) == ids).all()


def test_token_files(spark, docs, nothing, tmp_path, monkeypatch):
    token_files.write(docs, str(tmp_path / "ids"))
    rows = sorted(token_files.read(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    enc = tokens.encoder(tokens.default_tokenizer())
    want = collections.Counter((i, enc.encode(x) + token_files.END_ID.to_bytes(4, "little")) for i, x in TEXTS)
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in rows) == want
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(bytes(r.ids)))
        at += r.n_tokens
    assert [r.doc_id for r in rows] == [None, *sorted(i for i, _ in TEXTS if i is not None)]
    token_files.write(nothing, str(tmp_path / "none"))
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0


def plain_simhash(text, k):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] or ([" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("tile", [simhash.TILE, 2])
def test_simhash(spark, docs, nothing, tile):
    more = TEXTS + [(20 + i, " ".join(BASE.split()[: 60 + i])) for i in range(30)]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(more[len(TEXTS):], "doc_id long, text string"))
    rows = simhash.near_duplicates(df, tile=tile).collect()
    fps = [plain_simhash(x, 4) for _, x in more]
    root = list(range(len(more)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(more)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {r: min((more[i][0] for i in range(len(more)) if find(i) == r and more[i][0] is not None), default=None) for r in map(find, range(len(more)))}
    want = collections.Counter((i, f"{f:016x}", least[find(k)]) for k, ((i, _), f) in enumerate(zip(more, fps)))
    assert collections.Counter(tuple(r) for r in rows) == want
    assert simhash.near_duplicates(nothing, tile=tile).count() == 0


def test_representatives_keep_one_row_of_each_component(docs):
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    found = {(r.doc_id, r.text) for r in kept.collect()}
    assert kept.count() == len(found)
    assert [i for i, x in found if x == BASE] == [1] and (None, "a lone text") in found
    # null, empty and white space share fingerprint zero
    assert sum(not (x or "").strip() for _, x in found) == 1


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(tuple(r) for r in components.connected_components(spark.createDataFrame(path, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def repeated_by_hand(texts, length):
    count = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    return [[count[t[i:i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]


def test_sorting_finds_repeated_windows():
    rng = np.random.default_rng(3)
    for _ in range(6):
        length = int(rng.integers(128, 200))
        base = bytes(rng.integers(97, 100, 2000).astype(np.uint8))
        texts = []
        for _ in range(20):
            a = int(rng.integers(0, 1500))
            x = bytearray(base[a:a + int(rng.integers(0, 500))])
            if len(x) > 50:
                x[int(rng.integers(0, len(x)))] = 120
            texts.append(bytes(x))
        assert [m.tolist() for m in suffix_dedup.repeated_windows(texts, length)] == repeated_by_hand(texts, length)


@pytest.mark.parametrize("bucket_runs", [suffix_dedup.BUCKET_RUNS, 1])
def test_suffix_dedup(docs, nothing, bucket_runs, monkeypatch):
    monkeypatch.setattr(suffix_dedup.repeated_ranges, "__defaults__", (400, bucket_runs))
    rows = suffix_dedup.dedup(docs).collect()
    raw = [x.encode() for _, x in TEXTS]
    want = collections.Counter()
    for (doc_id, _), t, marks in zip(TEXTS, raw, repeated_by_hand(raw, 400)):
        gone = np.zeros(len(t), bool)
        for i in np.flatnonzero(marks):
            gone[i:i + 400] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[(doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)] += 1
    assert collections.Counter((*tuple(r)[:5], bytes(r.kept)) for r in rows) == want
    assert suffix_dedup.dedup(nothing).count() == 0


def test_a_bucket_of_many_bytes_is_not_sorted_in_one_task(spark, monkeypatch):
    texts = ["ab" * (300 + 450 * i) + f" end {i}" for i in range(8)] + ["x" * 900 + BASE, "y" + "x" * 1300, BASE[:700]]
    df = common.configure(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {}
    for i, (t, marks) in enumerate(zip(texts, repeated_by_hand(texts, 400))):
        gone = np.zeros(len(t), bool)
        for k in np.flatnonzero(marks):
            gone[k:k + 400] = True
        want[i] = "".join(c for c, g in zip(t, gone) if not g).encode()
    sort = suffix_dedup._sorted_buckets

    def bounded(length):
        inner = sort(length)

        def run(batches):
            def checked():
                size = {}
                for b in batches:
                    for key, x in zip(b.column("key").to_pylist(), b.column("snippet").to_pylist()):
                        size[key] = size.get(key, 0) + len(x)
                    assert max(size.values(), default=0) <= 2000
                    yield b
            return inner(checked())
        return run
    monkeypatch.setattr(suffix_dedup, "_sorted_buckets", bounded)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 2000, raising=False)
    assert {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup(df).collect()} == want


def test_cleaned_keeps_rows_and_columns(docs):
    out = suffix_dedup.cleaned(docs)
    assert out.columns == docs.columns and out.count() == len(AWKWARD)
    texts = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert texts[(1, "")] == 1 and texts[(2, "")] == 2 and texts[(3, None)] == 1 and texts[(9, "one two")] == 1


def test_decontaminate(spark, docs, nothing):
    ws = BASE.split()
    items = [(1, " ".join(ws[20:60])), (2, " ".join(ws[30:40]) + " zzz yyy"), (3, " ".join(ws[30:34]) + " zzz"), (4, "ONE, two!"), (5, None), (6, "  "),
             (1, " ".join(ws[20:60])), (7, "never seen in any text of these documents at all"), (8, "another text of the same id")]
    table = spark.createDataFrame(items, "item_id long, text string")

    def words(x):
        return re.findall(r"[^\W_]+", x.lower())

    def shingles(w, k):
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    want = {}
    for item, x in items:
        w = words(x or "")
        k = min(5, len(w))
        for doc_id, text in TEXTS if k else ():
            need = shingles(w, k)
            share = len(need & shingles(words(text), k)) / len(need)
            if share >= 0.8:
                want[(doc_id, item)] = max(share, want.get((doc_id, item), 0))
    got = {(r.doc_id, r.item_id): r.containment for r in decontaminate.find(docs, table).collect()}
    assert got == want and (9, 4) in got and (7, 8) in got
    assert decontaminate.find(nothing, table).count() == 0 and decontaminate.find(docs, table.limit(0)).count() == 0
    kept = decontaminate.clean(docs, table)
    assert kept.columns == docs.columns
    bad = {i for i, _ in want}
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(i for i, _ in TEXTS if i not in bad)


def plain_tree(rows, shards):
    groups = {}
    for doc_id, text, lang, source in rows:
        g = groups.setdefault(hashlib.md5(text.encode()).hexdigest(), [0, len(text.encode()) + 1, [], [], []])
        g[0] += g[1]
        g[2].append(zlib.crc32((source or "").encode()))
        g[3].append(zlib.crc32((lang or "").encode()))
        g[4] += [] if doc_id is None else [doc_id]
    items = [(k, v[0], (v[1], min(v[2]), min(v[3]), min(v[4], default=-1)), int(k[:15], 16)) for k, v in groups.items()]
    span = lambda of, j: max(x[2][j] for x in of) - min(x[2][j] for x in of)
    whole = [span(items, j) or 1 for j in range(4)]
    leaves = []

    def split(of, k):
        if k == 1 or not of:
            leaves.extend([of] + [[]] * (k - 1))
            return
        wide = [span(of, j) / whole[j] for j in range(4)]
        j = wide.index(max(wide))
        of, total, cum, cut = sorted(of, key=lambda x: (x[2][j], x[3])), sum(x[1] for x in of), 0, 0
        for n, x in enumerate(of):
            cum += x[1]
            if (2 * cum - x[1]) * k <= 2 * total * (k // 2):
                cut = n + 1
        split(of[:cut], k // 2)
        split(of[cut:], k - k // 2)
    split(items, shards)
    return {x[0]: i for i, leaf in enumerate(leaves) for x in leaf}


@pytest.mark.parametrize("finished, bins", [(sharding.FINISHED, sharding.BINS), (1, 2)])
def test_sharding(docs, nothing, finished, bins, monkeypatch):
    monkeypatch.setattr(sharding, "FINISHED", finished)
    monkeypatch.setattr(sharding, "BINS", bins)
    rows = sharding.shard(docs, shards=4, alone=False).collect()
    tree = plain_tree([(r[0], r[1] or "", r[2], r[3]) for r in AWKWARD], 4)
    want = collections.Counter((i, len(x.encode()) + 1, zlib.crc32(x.encode()), tree[hashlib.md5(x.encode()).hexdigest()]) for i, x in TEXTS)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in rows) == want
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert sharding.shard(nothing, shards=4).count() == 0


def test_a_hot_group_leaves_the_other_shards_even(spark, tmp_path):
    rows = [(i, hashlib.md5(str(i).encode()).hexdigest() * 3, "en", f"s{i % 7}") for i in range(1000)]
    rows += [(1000 + i, "the same text " * 35, "en", "hot") for i in range(97 * 500 // 491)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    size, hot = collections.Counter(), set()
    for r in catalog.op5_sharding(spark, str(tmp_path)).collect():
        size[r.shard] += r.size
        if r.doc_id >= 1000:
            hot.add(r.shard)
    total = sum(size.values())
    assert 0.3 < sum(len(x[1]) + 1 for x in rows[1000:]) / total < 0.36 and sorted(size) == list(range(8)) and len(hot) == 1
    rest = [size[s] for s in range(8) if s not in hot]
    assert size[hot.pop()] == sum(len(x[1]) + 1 for x in rows[1000:]) and max(rest) - min(rest) <= 0.05 * total / 8


def test_thousands_of_leaves(spark):
    rows = [(i, f"text {i} " + "x" * (i * 7 % 90)) for i in range(6000)]
    docs = common.configure(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    size = collections.Counter()
    for r in sharding.shard(docs, shards=5000).collect():
        size[r.shard] += r.size
    assert set(size) <= set(range(5000)) and len(size) > 4000 and sum(size.values()) == sum(len(t) + 1 for _, t in rows)


def test_sharding_stores_rows_and_groups_only(spark, monkeypatch):
    names, store = [], common.materialise
    monkeypatch.setattr(common, "materialise", lambda df, name: names.append(name) or store(df, name))
    docs = common.configure(spark).createDataFrame([(i, f"text {i}" * (i % 9)) for i in range(300)], "doc_id long, text string")
    slots = collections.defaultdict(list)
    for r in sharding.shard(docs, shards=8).collect():
        slots[r.shard].append(r.slot)
    assert names == ["shard-rows", "shard-groups"]
    assert sum(map(len, slots.values())) == 300 and all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_groups_alone_use_up_the_shards(spark, docs, nothing):
    assert sharding.shard(nothing, shards=4, alone=True).count() == 0
    few = spark.createDataFrame([(i, str(i) * (10 ** i)) for i in range(4)] * 2, "doc_id long, text string")
    for shards in (1, 2, 4, 6):
        of = collections.defaultdict(set)
        for r in sharding.shard(few, shards=shards, alone=True).collect():
            of[r.doc_id].add(r.shard)
        assert all(len(x) == 1 for x in of.values()) and len(set.union(*of.values())) == min(shards, 4)
        assert set.union(*of.values()) <= set(range(shards))


def test_target_bytes_choose_the_number_of_shards(docs):
    total = sum(len(x.encode()) + 1 for _, x in TEXTS)
    assert sharding.shard(docs, target_bytes=total).select("shard").distinct().count() == 1
    assert sharding.shard(docs, target_bytes=total // 3).agg({"shard": "max"}).first()[0] <= 3


def test_fingerprints(docs, nothing):
    rows = weighted_minhash.fingerprints(docs).collect()
    key = lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64_intdigest(r[1].encode(), 42) - (1 << 64 if xxhash.xxh64_intdigest(r[1].encode(), 42) >> 63 else 0))
    order = sorted(set(TEXTS), key=key)
    copies, want = collections.Counter(TEXTS), collections.Counter()
    for k, (i, t) in enumerate(order):
        after, m = order[(k + 1) % len(order)][1], len(t) // 3
        want[(i, len(t), hashlib.sha256((t[:len(t) - m] + after[:m]).encode()).hexdigest())] += copies[(i, t)]
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert weighted_minhash.fingerprints(nothing).count() == 0


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    common.configure(spark)
    a, b = {"x": 6, "y": 2, "z": 1, "u": 3}, {"x": 2, "y": 5, "v": 4, "u": 3}
    texts = [" ".join(w for w, n in c.items() for _ in range(n)) for c in (a, b)]
    df = spark.createDataFrame([(2, texts[0]), (1, texts[1])], "doc_id long, text string")
    near = [r.near_next for r in weighted_minhash.fingerprints(df, samples=2048).collect()]
    want = sum(min(a.get(w, 0), b.get(w, 0)) for w in {*a, *b}) / sum(max(a.get(w, 0), b.get(w, 0)) for w in {*a, *b})
    assert near[0] == near[1] and abs(near[0] - want) < 0.04


def test_likeness_at_the_samples_in_use(spark):
    """32 samples: the error of a likeness stays near its standard error, without bias."""
    rng, texts = random.Random(4), []
    for _ in range(60):
        texts.append(" ".join(f"w{rng.randrange(120)}" for _ in range(rng.randint(60, 200))))
    df = common.configure(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    off = []
    for r in weighted_minhash.fingerprints(df).collect():
        a, b = (collections.Counter(texts[i].split()) for i in (r.doc_id, (r.doc_id - 1) % len(texts)))
        off.append(r.near_next - sum((a & b).values()) / sum((a | b).values()))
    assert np.sqrt(np.mean(np.square(off))) < 0.11 and abs(np.mean(off)) < 0.04


def test_quality_accuracy_and_awkward_rows(spark, docs, nothing):
    labels = common.read(spark, SF.replace("0.001", "0.01"), "labels")
    corpus = common.read(spark, SF.replace("0.001", "0.01"), "documents")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.classify(corpus, labels).filter("held_out").collect()
    told = [r.predicted == truth[r.doc_id] for r in rows if r.doc_id in truth]
    assert sum(told) / len(told) > 0.93
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    out = quality.classify(docs, labels.limit(0))
    assert set(docs.columns) | {"held_out", "predicted"} == set(out.columns)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.collect())
    assert quality.classify(nothing, labels).count() == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = quality.Network.new(rng)
    cut = [quality.chunks(bytes(rng.integers(0, 256, n).astype(np.uint8))) for n in (10, 700, 300)]
    y = np.array([1, 0, 1], np.float32)

    def loss():
        total = 0.0
        for c, label in zip(cut, y):
            h = quality._pooled(net, c)
            z = float(np.hstack([h.mean(axis=0), h.max(axis=0)]) @ net.out + net.out_bias[0])
            total += np.log1p(np.exp(-z)) if label else np.log1p(np.exp(z))
        return total / len(y)
    for array, gradient in zip(net.arrays(), quality._gradients(net, cut, y)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        was = array[at]
        array[at] = was + 2e-3
        up = loss()
        array[at] = was - 2e-3
        down = loss()
        array[at] = was
        assert abs((up - down) / 4e-3 - gradient[at]) < 0.05 * abs(gradient[at]) + 1e-3


def test_language_accuracy_and_awkward_rows(spark, docs, nothing):
    corpus = common.read(spark, SF.replace("0.001", "0.01"), "documents")
    model = language.fit(corpus)
    rows = language.identify(corpus, model).filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    out = language.identify(docs, model).collect()
    for r in out:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not has_letter) and 0 <= r.score <= 1
    assert {r.lang_pred for r in language.identify(docs, model, reject=True).collect() if r.rejected} == {"und"}
    assert language.identify(nothing, language.fit(nothing)).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.fit(nothing)).collect()} == {"und"}


def test_long_text_counts_are_those_of_the_whole(monkeypatch):
    texts = ["Straße été naïve " * 50, "  12 a", "x" * 200, "ab " * 63 + "...." * 40 + "c", "é\u0301İΣ ς" * 30]
    whole = [language.counts(t) for t in texts]
    for chars in (1, 2, 3, 64):
        monkeypatch.setattr(language, "CHARS", chars)
        assert all((language.counts(t) == w).all() for t, w in zip(texts, whole))
    assert language.counts(None) is None and language.counts("12 ?!") is None


def test_any_number_of_languages(spark):
    letters = [chr(0x4E00 + k) for k in range(300)]
    rows = [(3 * k + j, f"{c} {c}{c} {c}{j}", f"lang{k}") for k, c in enumerate(letters) for j in range(3)]
    docs = common.configure(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert len(set(model.languages)) > 250
    known = [r for r in language.identify(docs, model).collect() if r.lang in model.languages]
    assert sum(r.lang_pred == r.lang for r in known) / len(known) > 0.9  # hashed n-grams may collide


def test_a_language_of_most_rows_gives_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_TEXTS", 20)
    rows = [(k if k % 3 else None, f"a b c {k}", "en" if k % 10 else "de") for k in range(600)]
    docs = common.configure(spark).createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = collections.Counter(r.lang for r in language._sample(docs).collect())
    assert got == {"en": 20, "de": 20}


def test_tool_calls(spark):
    calls = [(1, 0, "a", "answer", '{"query":"q","limit":3}', None), (1, 0, "b", "rewrite", '{"text":"t", "style":"s"}', ["a"]),
             (1, 0, "c", "rewrite", '{"text":"t"}', ["b", "a"]), (1, 2, "d", "answer", '{"limit":"3"}', ["c", "zzz"]), (1, 3, "e", "browse", "{}", None),
             (1, 4, "f", "answer", "[1]", None), (1, 4, "g", "answer", "{nope", None), (1, 4, "h", "answer", '{"query":"q","limit":1,"x":{"b":1,"a":[ 1, null ]}}', None),
             (1, 5, "i", "rewrite", '{"text":"t"}', ["i"]), (1, 5, "j", "rewrite", '{"text":"t"}', ["k"]), (1, 6, "k", "rewrite", '{"text":"t"}', None),
             (1, 7, "a", "rewrite", '{"text":"again"}', None), (1, 8, None, "rewrite", '{"text":"t"}', None), (None, 0, "a", "rewrite", '{"text":"t"}', None),
             (2, 5, "late", "rewrite", '{"text":"t"}', None)]
    results = [(1, 1, "a", 'line "one"\n'), (1, 2, "a", "second"), (1, 1, "b", "B"), (1, 1, "c", None), (1, 9, "gone", "G"), (2, 4, "late", "L"), (None, 1, "a", "N"), (1, 9, "k", "K")]
    c = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, tool string, arguments string, after array<string>")
    r = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    got = {(x.conv_id, x.call_id, x.turn): x for x in tool_calls.link(c, r, tool_calls.SCHEMAS).collect()}
    status = {k: v.status for k, v in got.items()}
    assert status == {(1, "a", 0): "ok", (1, "b", 0): "ok", (1, "c", 0): "ok", (1, "d", 2): "invalid arguments", (1, "e", 3): "invalid arguments",
                      (1, "f", 4): "invalid arguments", (1, "g", 4): "invalid arguments", (1, "h", 4): "invalid arguments", (1, "i", 5): "out of order",
                      (1, "j", 5): "out of order", (1, "k", 6): "ok", (1, "a", 7): "duplicate id", (1, None, 8): "no id", (None, "a", 0): "ok",
                      (2, "late", 5): "early result", (1, "gone", None): "orphan result"}
    assert [got[(1, k, 0)].level for k in "abc"] == [0, 1, 2]
    assert got[(1, "d", 2)].errors == "limit is not integer; missing query" and got[(1, "h", 4)].errors == "unexpected x"
    assert got[(1, "f", 4)].errors == got[(1, "g", 4)].errors == "arguments are not an object" and got[(1, "e", 3)].errors == "unknown tool"
    assert got[(1, "a", 0)].n_results == 2 and got[(1, "a", 0)].n_calls == 2
    for x in got.values():
        parsed = json.loads(x.line)
        assert json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == x.line
    assert json.loads(got[(1, "a", 0)].line)["content"] == 'line "one"\n' and json.loads(got[(1, "g", 4)].line)["arguments"] == "{nope"
    assert tool_calls.link(c.limit(0), r.limit(0), tool_calls.SCHEMAS).count() == 0


def test_calls_are_ordered_across_turns(spark):
    waits = {("A", 1): ["B"], ("B", 1): ["A"], ("C", 3): ["A"], ("D", 4): ["C", "r"], ("r", 0): None, ("s", 2): ["r"], ("t", 4): ["s", "r"],
             ("early", 5): ["last"], ("last", 9): ["t"], ("beside", 5): ["early", "r"], ("after", 10): ["early"]}
    waits |= {(f"n{i}", 20 + i): [f"n{i - 1}"] if i else ["t", "s"] for i in range(40)}
    c = spark.createDataFrame([(1, t, k, "rewrite", '{"text":"t"}', a) for (k, t), a in waits.items()],
                              "conv_id long, turn long, call_id string, tool string, arguments string, after array<string>")
    r = spark.createDataFrame([(1, 99, k, "R") for k, _ in waits], "conv_id long, turn long, call_id string, content string")
    got = {x.call_id: (x.level, x.status) for x in tool_calls.link(c, r, tool_calls.SCHEMAS).collect()}
    late, never = "out of order", (None, "out of order")
    assert got == {"A": never, "B": never, "C": never, "D": never, "r": (0, "ok"), "s": (1, "ok"), "t": (2, "ok"), "last": (3, "ok"), "early": (4, late),
                   "beside": (5, late), "after": (5, "ok"), **{f"n{i}": (3 + i, "ok") for i in range(40)}}


def test_a_ladder_of_calls_takes_few_rounds(spark, monkeypatch):
    """Each call waits for the three before it; the frames stored grow with the logarithm of the length only."""
    stored, keep = [], common.materialise
    monkeypatch.setattr(common, "materialise", lambda df, name: stored.append(name) or keep(df, name))
    frames = []
    for n in (16, 256):
        stored.clear()
        rows = [(f"c{i:04d}", i, [f"c{j:04d}" for j in range(max(0, i - 3), i)]) for i in range(n)] + [("x", 5, ["y"]), ("y", 6, ["x", "c0001"]), ("z", 7, ["x", "y"])]
        got = {r.key: (r.level, r.late) for r in tool_calls.levels(spark.createDataFrame(rows, "key string, turn long, after array<string>")).collect()}
        assert got == {f"c{i:04d}": (i, False) for i in range(n)}
        frames.append(len(stored))
    assert frames[1] <= frames[0] + 6


def test_needless_waits_change_no_level(spark):
    rng = random.Random(7)
    for _ in range(3):
        n = 24
        waits = {i: [j for j in rng.sample(range(n), rng.randrange(4)) if j < i or rng.random() < 0.1] for i in range(n)}
        level = {}
        for _ in range(n + 1):
            level |= {i: max((level[j] + 1 for j in w), default=0) for i, w in waits.items() if i not in level and all(j in level for j in w)}
        rows = [(f"k{i:02d}", i, [f"k{j:02d}" for j in w]) for i, w in waits.items()]
        got = {int(r.key[1:]): r.level for r in tool_calls.levels(spark.createDataFrame(rows, "key string, turn long, after array<string>")).collect()}
        assert got == level


def test_columns_of_clashing_names(spark):
    common.configure(spark)
    docs = spark.createDataFrame([(1, BASE, 5, 6, 7, 8, 9), (2, BASE + " x", 5, 6, 7, 8, 9)], "doc_id long, text string, fp long, cell long, tile long, root long, component_id long")
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} <= {1, 2}
    assert simhash.representatives(docs).columns == docs.columns
    c = spark.createDataFrame([(1, 0, "a", "rewrite", '{"text":"t"}', ["b"], "k", 1, "e"), (1, 0, "b", "rewrite", '{"text":"t"}', None, "k", 1, "e")],
                              "conv_id long, turn long, call_id string, tool string, arguments string, after array<string>, key string, level int, errors string")
    r = spark.createDataFrame([(1, 1, "a", "x", "k", 4)], "conv_id long, turn long, call_id string, content string, key string, n_results int")
    assert {x.call_id: (x.level, x.status, x.n_results) for x in tool_calls.link(c, r, tool_calls.SCHEMAS).collect()} == {"a": (1, "ok", 1), "b": (0, "no result", 0)}


def test_one_text_of_three_million_characters(spark, tmp_path, monkeypatch):
    rng = random.Random(11)
    shared = "".join(rng.choice("abcdef ghij") for _ in range(600))
    long = "".join(rng.choice(["wo", "é", " ", "rd ", "漢", ".\n", "x1 "]) for _ in range(1_900_000))
    long = f"{long[:1000]}<{shared}>{long[1000:2_000_000]}({shared}){long[2_000_000:]}"  # matches end at the brackets
    assert len(long) > 3_000_000
    rows = [(1, long, "en"), (2, f"short [{shared}", "en"), (3, "zwei Wörter", "de")]
    df = common.configure(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    plain = tokens.Tokenizer.from_file(tokens.default_tokenizer())
    ids = {i: plain.encode(t, add_special_tokens=False).ids for i, t, _ in rows}
    token_files.write(df, str(tmp_path / "ids"))
    got = {r.doc_id: r.ids for r in token_files.read(spark, str(tmp_path / "ids")).collect()}
    assert {i: np.frombuffer(x, "<u4").tolist() for i, x in got.items()} == {i: [*x, token_files.END_ID] for i, x in ids.items()}
    pieces = sorted((r.doc_id, r.start, bytes(r.ids)) for r in packing.pack(df).collect())
    assert {i: b"".join(x for d, _, x in pieces if d == i) for i in ids} == {i: np.array([*x, packing.END_ID], "<u4").tobytes() for i, x in ids.items()}
    cut = {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup(df).collect()}
    assert cut == {i: t.replace(shared, "").encode() for i, t, _ in rows}
    net = quality.Network.new(np.random.default_rng(0))
    assert {r.doc_id: round(r.score, 6) for r in quality.scored(df, net).collect()} == {i: round(float(quality.score(net, [t.encode()])[0]), 6) for i, t, _ in rows}
    model = language.fit(df)
    found = {r.doc_id: (r.lang_pred, round(r.score, 5)) for r in language.identify(df, model).collect()}
    monkeypatch.setattr(language, "CHARS", 1 << 30)
    assert found == {i: (model.nearest(t)[0], round(model.nearest(t)[1], 5)) for i, t, _ in rows}


def test_passages_of_51_words_are_cut_and_shorter_ones_are_not(spark):
    rng = random.Random(9)

    def words(n, least=3):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(least, 5))) for _ in range(n))
    passages = {n: words(n) for n in (30, 45, 50, 51, 55, 60)}
    assert all(200 <= len(passages[n]) < 400 for n in (51, 55, 60))
    rows = []
    for n, p in passages.items():
        for k in range(3):
            rows.append((n * 10 + k, f"{words(80)} {p} {words(80)}", 0))
    clean = [(5000 + k, words(150), 0) for k in range(20)]
    df = common.configure(spark).createDataFrame(rows + clean + [(None, None, 0), (1, "", 0)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in pipeline.repeated_passages(spark, df, "").collect()}
    for i, t, _ in rows:
        n = i // 10
        assert (passages[n] in out[i].text) == (n <= 50) and out[i].n_chars == len(out[i].text)
        assert out[i].text == t or len(t) - len(out[i].text) - len(passages[n]) <= 4  # a blank or an equal letter at the edges
    assert all(out[i].text == t for i, t, _ in clean) and out[None].text is None and out[1].text == ""


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]
    for name, rows in (("full", AWKWARD), ("empty", [])):
        d = str(tmp_path / name)
        df = spark.createDataFrame(rows, SCHEMA)
        df.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(i, 1, 0) for i, _ in TEXTS][:len(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(1, "a lone text")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        docs = spark.read.parquet(f"{d}/documents.parquet")
        for n, stage in pipeline.STAGES[:-1]:
            docs = common.materialise(stage(spark, docs, d), "stage")
            assert docs.columns == df.columns, n
        if rows:
            assert None not in {r.doc_id for r in docs.collect()}  # held the item
        assert (pipeline.STAGES[-1][1](spark, docs, d).count() > 0) == bool(rows)


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_queries_match_their_sql(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in catalog.ORACLE_SQL.items():
        cur = con.execute(sql)
        cols = [c[0] for c in cur.description]
        got, want = (collections.Counter(map(tuple, rows)) for rows in (catalog.QUERIES[name](spark, SF).select(*cols).collect(), cur.fetchall()))
        assert got == want, name
