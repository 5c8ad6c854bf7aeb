"""WARC archives, the conversation trie and the filter audit, against brute force and on awkward rows."""
import base64
import collections
import gzip
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from clickpath.llm import common, filter_audit, prefix_trie, simhash, warc

PAGES = [(1, "http://a.example/x?q=1", "<html>é</html>"), (2, None, None), (3, "http://b.example/", ""), (4, "http://c.example/ space\r\nX: y", "<html>é</html>"),
         (4, "http://c.example/again", "<html>é</html>"), (None, "u", "<html>é</html>"), (5, "http://[bad", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n"),
         (6, "x", "WARC/1.1\r\n"), (7, "y", "long " * 200_000), (None, None, "alone"), (8, "z", "\x00\x01 WARC/1."), (3, "http://b.example/", "")]
PAGE_SCHEMA = "page_id long, url string, html string, digest string, value string, type string"


def page_frame(spark, pages):
    return common.configure(spark).createDataFrame([(*p, "d", "v", "t") for p in pages], PAGE_SCHEMA).repartition(3)


def plain_captures(pages):
    same = collections.defaultdict(list)
    for page_id, _, html in pages:
        same[html or ""].append(page_id)
    out = []
    for page_id, _, html in pages:
        raw = (html or "").encode()
        last = max((i for i in same[html or ""] if i is not None), default=None)
        again = last is not None and page_id != last
        out.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", last if again else None))
    return collections.Counter(out)


def test_warc_round_trip(spark, tmp_path):
    warc.write(page_frame(spark, PAGES), str(tmp_path / "w"))
    records = common.materialise(warc.read(spark, str(tmp_path / "w")), "t-records")
    got = collections.Counter(map(tuple, warc.captures(records).collect()))
    assert got == plain_captures(PAGES)
    nested = warc.assemble(records).collect()
    assert len(nested) == len(PAGES) and all(r.n_requests == r.n_metadata == 1 and r.whole for r in nested)
    wanted = {(page_id, (html or "").encode()) for page_id, _, html in PAGES}
    for r in nested:
        page_id = r.metadata.fields.get("page-id")
        assert r.request.payload is not None and r.request.target_uri == r.target_uri == r.metadata.target_uri
        if r.type == "response":
            assert (None if page_id is None else int(page_id), bytes(r.payload)) in wanted and r.payload_digest == r.header_digest
    ids = [r.record_id for r in records.collect()]
    assert len(set(ids)) == len(ids)
    warc.write(page_frame(spark, PAGES).limit(0), str(tmp_path / "none"))
    assert warc.captures(warc.read(spark, str(tmp_path / "none"))).count() == 0


def test_warc_files_are_plain_warc(spark, tmp_path):
    warc.write(page_frame(spark, PAGES[:1]).coalesce(1), str(tmp_path / "w"), date="2024-01-01T00:00:00Z")
    data = b"".join(gzip.open(f).read() for f in sorted((tmp_path / "w").glob("*.gz")))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and data.endswith(b"page-id: 1\r\n\r\n\r\n")
    assert data.count(b"WARC-Date: 2024-01-01T00:00:00Z\r\n") == 4
    at = data.index(b"WARC-Type: response")
    head, _, block = data[at:].partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    assert block[:size].endswith("<html>é</html>".encode()) and block[size:size + 4] == b"\r\n\r\n"


def test_warc_reads_other_archives(spark, tmp_path):
    def record(kind, record_id, to=(), block=b"", length=None, version="1.0"):
        named = "".join(f"warc-concurrent-to: <urn:uuid:{x}>\r\n" for x in to)
        return (f"WARC/{version}\r\nwarc-type: {kind}\r\nWARC-Record-ID: <urn:uuid:{record_id}>\r\n{named}"
                f"Content-Type: text/plain\r\nContent-Length: {len(block) if length is None else length}\r\n\r\n").encode() + block + b"\r\n\r\n"

    (tmp_path / "w").mkdir()
    # Links the other way round, by way of the request, to nobody; two requests; a record cut short that seems to cover another.
    one = [record("response", "r1", ["q1"], b"one"), record("request", "q1"), record("metadata", "m1", ["q1"], b"m"), record("metadata", "m9", ["nobody"]),
           record("response", "r2", [], b"two\r\n\r\nWARC/1.0\r\n"), record("request", "q3", ["r2"]), record("request", "q2", ["r2"])]
    two = [b"junk before\r\n", record("response", "r3", [], b"abc", length=1000), record("response", "r4", [], b"\xff\xfe")]
    with gzip.open(tmp_path / "w" / "one.warc.gz", "wb") as f:
        f.write(b"".join(one))
    (tmp_path / "w" / "two.warc.gz").write_bytes(b"".join(map(gzip.compress, two)))  # a member for each record
    records = common.materialise(warc.read(spark, str(tmp_path / "w")), "t-records")
    rows = {r.record_id: r for r in records.collect()}
    assert set(rows) == {"r1", "q1", "m1", "m9", "r2", "q3", "q2", "r3", "r4"}
    assert bytes(rows["r2"].payload) == b"two\r\n\r\nWARC/1.0\r\n" and bytes(rows["r4"].payload) == b"\xff\xfe"
    assert not rows["r3"].whole and all(r.whole for k, r in rows.items() if k != "r3")
    got = {r.record_id: (r.request and r.request.record_id, r.metadata and r.metadata.record_id, r.n_requests, r.n_metadata) for r in warc.assemble(records).collect()}
    assert got == {"r1": ("q1", "m1", 1, 1), "r2": ("q2", None, 2, 0), "r3": (None, None, 0, 0), "r4": (None, None, 0, 0)}


TURNS = ([(20, t, "user", f"hello there {t}") for t in range(5)] + [(21, t, "user", f"own {t}") for t in range(2)] + [(22, None, None, None), (22, 3, "user", "x y  z")]
         + [(23, 0, "user", "hello there 0"), (23, 1, "a", " \t")] + [(k, t, "user", "same words here") for k in (40, 41, 45, 47) for t in range(6)]
         + [(None, 0, "user", "nobody")] + [(63, 1, "r", "p"), (63, 1, "r", "p"), (63, 1, "r", "q")] + [(65, 0, "user", "only one")] + [(-21, 0, "u", "minus")]
         + [(80, t, "user", f"deep {t}") for t in range(40)] + [(k, t, "user", f"deep {t}") for k in (81, 82, 83) for t in range(38)] + [(84, t, "u", "w " * 5000) for t in range(3)])
TURN_SCHEMA = "conv_id long, turn long, role string, text string, base string, h string, k string"


def plain_trie(turns):
    def words(x):
        return len(re.findall(r"[^\x20\x09-\x0D]+", x))
    own = collections.defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((t is not None, t or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    seq = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        seq[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = collections.defaultdict(list)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    out = collections.Counter()
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        saved = sum((len(members[q]) - 1) * words(q[-1][1]) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in m if len(seq[c]) == len(p))))
        out[min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], sum(not children[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("segment", [prefix_trie.SEGMENT, 3, 1])
def test_prefix_trie(spark, segment):
    df = common.configure(spark).createDataFrame([(*t, "b", "h", "k") for t in TURNS], TURN_SCHEMA).repartition(5)
    turns, ids = prefix_trie.rebuilt(df)
    got = collections.Counter(map(tuple, prefix_trie.trie(turns, ids, segment).collect()))
    assert got == plain_trie(TURNS)
    nothing = df.limit(0)
    assert prefix_trie.shared_prefixes(nothing).count() == 0


def test_one_conversation_holds_most_rows(spark):
    turns = [(7, t, "user", f"turn {t}") for t in range(900)] + [(c, t, "user", f"turn {t}") for c in (27, 47) for t in range(300)]
    df = common.configure(spark).createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    placed = prefix_trie.ranked(prefix_trie.turns_of(df)).collect()
    of = collections.defaultdict(list)
    for r in placed:
        of[r.conv_id].append(r.k)
    assert {c: sorted(v) for c, v in of.items()} == {7: list(range(900)), 27: list(range(300)), 47: list(range(300))}
    assert collections.Counter(map(tuple, prefix_trie.shared_prefixes(df).collect())) == plain_trie(turns)


def test_extents_are_member_intervals():
    rng = random.Random(5)
    for n in (1, 2, 7, 64, 65):
        rows = sorted([tuple(rng.randrange(2) for _ in range(rng.randrange(6))) for _ in range(n)])
        sizes = np.array([len(r) for r in rows])
        lcp = prefix_trie.common_prefixes([b""] * n, np.array([x for r in rows for x in r], np.int64), sizes)
        assert lcp.tolist() == [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(rows, rows[1:])]
        at = [(i, d) for i, r in enumerate(rows) for d in range(1, len(r) + 1)]
        if at:
            row, depth = (np.array(x) for x in zip(*at))
            left, right = prefix_trie.extents(lcp, row, depth)
            for i, d, a, b in zip(row, depth, left, right):
                assert [k for k, r in enumerate(rows) if r[:d] == rows[i][:d]] == list(range(a, b + 1))
            values = np.array([rng.randrange(100) for _ in rows])
            assert prefix_trie.range_minima(values, left, right).tolist() == [values[a:b + 1].min() for a, b in zip(left, right)]


LONG = "word%d " * 300 % tuple(range(300))
DOCS = [(5, LONG, "s"), (3, LONG, "t"), (9, LONG, "s"), (9, LONG, "t"), (3, LONG, "t"), (None, LONG, "s"), (1, None, None), (2, "", "s"), (4, "", "t"), (6, "A B C", "s"),
        (7, "same " * 400, "s"), (8, "a # b " * 150, None), (10, "ÀÉ ß" * 3, ""), (11, "Z" * 3, "t"), (12, "x\x0by\x0cz\x1cw", "t"), (13, LONG + "#", "s"), (14, "漢字 " * 250, "s"), (None, "lone", "t")]
LABELS = [(5, 1, 0), (3, 0, 1), (9, 1, 1), (9, 0, 0), (6, None, 1), (None, 1, 1), (99, 1, 1), (7, 1, None)]
DOC_SCHEMA = "doc_id long, text string, source string, part string, flags string, key string, n_chars long"


def plain_audit(docs, labels):
    def mask(text):
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        return ((len(ws) < 200), 100 * len(set(ws)) < 50 * len(ws), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text)))
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    rows = [(s or "", dict(zip("ABCDE", (*mask(t or ""), i is not None and least[t or ""] < i))), i in good, i in toxic) for i, t, s in docs]
    out = set()
    for part in {r[0] for r in rows}:
        of = [r[1:] for r in rows if r[0] == part]
        table, shapley = {}, collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(of)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                earlier = sum(r[0][f] and any(r[0][x] for x in order[:step - 1]) for r in of)
                table["".join(order), step] = (len(left), len(gone), earlier, sum(r[0][f] and sum(r[0].values()) == 1 for r in of), sum(r[1] for r in gone), sum(r[2] for r in gone))
                shapley[f] += len(gone)
        out |= {(part, o, s, *v, shapley[o[s - 1]]) for (o, s), v in table.items()}
    return out


def doc_frame(spark, docs):
    return common.configure(spark).createDataFrame([(*d, "p", "f", "k", 0) for d in docs], DOC_SCHEMA)


def label_frame(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("order", [1, -1])
def test_filter_audit_over_several_batches(spark, tmp_path, order):
    """Each document in a file of its own, so smaller ids come both before and after larger ones."""
    path = str(tmp_path / "documents.parquet")
    for d in DOCS[::order]:
        doc_frame(spark, [d]).coalesce(1).write.mode("append").parquet(path)
    got = filter_audit.audit(spark, path, label_frame(spark), micro_batches=5, texts_per_key=2).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == plain_audit(DOCS, LABELS)


def test_filter_audit_takes_in_later_files(spark, tmp_path):
    path, work = str(tmp_path / "documents.parquet"), str(tmp_path / "work")
    for docs in (DOCS[2:], DOCS[:2]):  # the smallest ids come last
        doc_frame(spark, docs).repartition(2).write.mode("append").parquet(path)
        filter_audit.follow(spark, path, label_frame(spark), work, 4, 1)
    assert set(map(tuple, filter_audit.report(filter_audit.counters(spark, work)).collect())) == plain_audit(DOCS, LABELS)


def test_filter_audit_of_nothing(spark, tmp_path):
    doc_frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert filter_audit.audit(spark, str(tmp_path / "documents.parquet"), label_frame(spark)).count() == 0


def test_changes_do_not_depend_on_order():
    rng = random.Random(2)
    rows = [(bytes([rng.randrange(3)]), rng.choice("st"), rng.randrange(4), rng.randrange(6)) for _ in range(200)]
    sums = set()
    for _ in range(5):
        rng.shuffle(rows)
        held, total = {}, collections.Counter()
        for k in range(0, len(rows), 17):
            for change, n in filter_audit.changes(held, [(key, p, f, 1, i, 1, 0) for key, p, f, i in rows[k:k + 17]]).items():
                total[change] += n
        sums.add(tuple(sorted((k, n) for k, n in total.items() if n)))
    assert len(sums) == 1


def test_crc_in_duckdb():
    """The SQL's crc32 is zlib's."""
    sql = prefix_trie.oracle_sql()
    at = sql.index("(xor(4294967295")
    expression = sql[at + 1:sql.index(f" % {prefix_trie.OPENINGS})::BIGINT", at)]
    for n in (0, 7, 123456789, -5):
        assert duckdb.sql(f"SELECT {expression} FROM (SELECT {n} AS conv_id)").fetchall() == [(zlib.crc32(str(n).encode()),)]


def test_simhash_tiles_deal_less_than_all_pairs(spark):
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    near = fps[:200] ^ np.uint64(5)
    every = np.unique(np.concatenate([fps, near]))
    df = common.configure(spark).createDataFrame([(int(x),) for x in every.view(np.int64)], "fp long")
    want = set()
    for k, x in enumerate(every):
        for j in np.flatnonzero(np.bitwise_count(every[k + 1:] ^ x) <= 4):
            want.add((k, k + 1 + int(j)))
    at = {int(x): k for k, x in enumerate(every.view(np.int64))}
    for tile, group in ((64, 4), (1 << 13, 64), (1, 3)):
        found, size = simhash.comparisons(df if tile > 1 else df.limit(100), 4, tile, group)
        rows = found.collect()
        if tile == 1:
            continue
        links = {tuple(sorted((at[r.a], at[r.b]))) for r in rows if r.a is not None}
        assert links <= want and components_of(links) == components_of(want)
        compared = sum(r.compared for r in rows if r.a is None)
        assert size["groups"] == 1 or size["dealt"] <= size["tiles"] * (size["groups"] + 1)
        if tile == 64:
            assert size["groups"] > 1 and size["tiles"] > 40 and compared < 0.75 * len(every) ** 2 / 2


def components_of(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        root[find(a)] = find(b)
    return {frozenset(x for x in root if find(x) == find(y)) for y in root}
