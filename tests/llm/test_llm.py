"""The ten operators and the pipeline against brute force, round trips and held-out labels."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR, same
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mereflow.llm import bitsliced, bpe, decontaminate, langid, quality, queries, simhash, suffixes, toxicity, urls, warc
from mereflow.llm.xxh import xxh64


def rows_of(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def docs_frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = ("lang", "source", "fp", "spans", "ids", "h", "d", "key", "at", "q", "n")
    return df.withColumns({c: F.lit("x") for c in clash}) if extra else df


ODD = ["", None, " ", "\x00", "a", "é" * 300, "word " * 400, "x" * 3000, "\u65e5\u672c\u8a9e \uff11\uff12", "a\x1cb  c", "\U0001f600 \U0001f468\u200d\U0001f469 hi", "'s don't I'LL 12 \u00bd \u00b2", "   \n\n b\t", "A B C D E F"]


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=400), st.lists(st.tuples(st.integers(0, 400), st.integers(0, 400)), max_size=20))
def test_xxh64(data, spans):
    import xxhash

    at = [(min(a, z, len(data)), min(max(a, z), len(data))) for a, z in spans]
    got = xxh64(data, np.array([a for a, _ in at], np.int64), np.array([z for _, z in at], np.int64))
    assert [int(x) for x in got] == [xxhash.xxh64_intdigest(data[a:z], 42) for a, z in at]


def fingerprint(text):
    import xxhash

    low = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(low))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(s, 42) for s in ([b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)])]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def linked(fps, bits=4):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in fps}


def test_simhash(spark):
    rows = [(r["doc_id"], r["text"]) for r in rows_of("documents")][:150] + [(1000 + i, t) for i, t in enumerate(ODD)]
    fps = {i: fingerprint(t) for i, t in rows}
    want = linked(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.groups(docs_frame(spark, rows)).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert simhash.groups(docs_frame(spark, rows[:0] or spark.createDataFrame([], "doc_id long, text string").collect())).count() == 0
    kept = simhash.dedup(docs_frame(spark, [*rows, rows[0]]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and "lang" in kept.columns


def test_simhash_dense_groups_keep_all_links(spark):
    """For every distance, with keys joined and with all of them crowded; nodes of one distance meet those of that one only."""
    from mereflow.operators.components import connected_components

    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(5))) for _ in range(60)} | {rng.getrandbits(64) for _ in range(30)}
    fps |= {f ^ (1 << 7) for f in list(fps)[:20]}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    sets = lambda of: {frozenset(x for x in signed if of(x) == r) for r in {of(x) for x in signed}}
    for dense, hubs in ((1024, False), (2, False), (2, True)):
        edges = None
        for bits in range(5):
            df = spark.createDataFrame([((bits, f), f) for f in signed], "node struct<bits: int, f: long>, fp long")
            part = simhash.links(df, bits, dense, hubs)
            edges = part if edges is None else edges.union(part)
        got = {(r.node.bits, r.node.f): r.root.f for r in connected_components(edges).collect()}
        for bits in range(5):
            want = linked({f: f % (1 << 64) for f in signed}, bits)
            assert sets(lambda x: got.get((bits, x), x)) == sets(lambda x: want[x]), (dense, bits)  # noqa: B023


def test_simhash_of_repeated_ids_and_long_texts(spark):
    long = " ".join(f"w{k % 5000} x{k}" for k in range(300_000))  # over a chunk of 2 MB
    rows = [(3, "one two three four five"), (3, "other words stand here instead of them"), (1, long), (2, long), (None, "one two three four five"), (None, "alone without any id at all"), (None, "alone without any id at all")]
    got = sorted((r.doc_id or 0, r.fingerprint, r.component_id or 0) for r in simhash.groups(docs_frame(spark, rows)).collect())
    own = [f"{fingerprint(t):016x}" for _, t in rows]
    assert got == sorted([(3, own[0], 3), (3, own[1], 3), (1, own[2], 1), (2, own[2], 1), (0, own[0], 3), (0, own[5], 0), (0, own[5], 0)])
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.dedup(docs_frame(spark, rows)).collect())
    assert kept == sorted([(3, rows[0][1]), (3, rows[1][1]), (1, long), (0, rows[5][1])])
    assert simhash.dedup(docs_frame(spark, [])).count() == 0


def similar_pairs(rows, least=0.8):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))))
        sets[i] = frozenset(b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}


def test_similar_texts(spark):
    """All links are true ones and none is missed, also in a large group of near copies and where shingles are crowded."""
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnp"]
    text = lambda n: [rng.choice(words) + str(rng.randrange(40)) for _ in range(n)]
    rows, own = [], 0
    for n in (60, 130, 250, 500):
        for _ in range(8):
            base = text(n)
            for edits in (0, 1, max(1, n // 60), max(1, n // 50)):
                t = list(base)
                for k in rng.sample(range(n), edits):
                    t[k] = "new" + str(rng.randrange(10**6))
                rows.append((own, " ".join(t)))
                own += 1
    base = text(200)
    group = range(own, own + 150)
    for i in group:
        t = list(base)
        for k in rng.sample(range(200), 3):
            t[k] = "other" + str(rng.randrange(10**6))
        rows.append((i, " ".join(t)))
    own = 1000
    for _ in range(6):  # the same words in other orders share all fingerprints
        words_of = text(120)
        for _ in range(8):
            rng.shuffle(words_of)
            rows += [(own, " ".join(words_of)), (own + 1, " ".join([*words_of[:-2], words_of[-1], words_of[-2]]))]
            own += 2
    passage, chain = text(90), text(60)
    for k in range(40):  # a passage that many texts share, and a chain of texts of which each is like the next only
        rows.append((own, " ".join([*text(30), *passage, *text(30)])))
        chain[k] = f"link{k}"
        rows.append((own + 1, " ".join(chain)))
        own += 2
    rows += [(5000, " ".join(base)), (5001, ""), (5002, None), (5003, " \n"), (5004, "two words"), (5005, "TWO  words"), (5006, "two other"), (None, " ".join(base))]
    chained = {}
    for a, b in sorted(similar_pairs([r for r in rows if r[0] is not None])):
        chained.setdefault(a, set()).add(b)
        chained.setdefault(b, set()).add(a)
    want = {}
    for i in sorted(r[0] for r in rows if r[0] is not None):
        seen, todo = {i}, [i]
        while todo and i not in want:
            new = chained.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        want |= {k: i for k in seen if k not in want}
    for crowd, listed in ((simhash.CROWD, simhash.LISTED), (4, 0)):
        signs, rooted = simhash.similar(docs_frame(spark, rows), crowd=crowd, listed=listed)
        root = {r.sig: r.root.doc_id for r in rooted.collect()}
        got = {r.doc_id: root[r.sig] for r in signs.collect() if r.doc_id is not None}
        assert got == want, (crowd, listed)
    assert got[5001] == got[5002] == got[5003] == 5001 and got[5004] == got[5005] == 5004 != got[5006]
    kept = [r.doc_id for r in simhash.dedup_similar(docs_frame(spark, rows)).collect()]
    assert sorted(kept, key=str) == sorted(set(got.values()), key=str)
    assert simhash.dedup_similar(docs_frame(spark, [])).count() == 0


def test_shingles_by_rarity(spark):
    """Crowded shingles last by their counts, others by hash; the broadcast and the joined way agree."""
    rng = random.Random(4)
    own = {k: sorted(rng.sample(range(-60, 60), rng.randrange(1, 50))) for k in range(30)} | {99: []}
    counts = {t: c for t in range(-60, 60) if (c := sum(t in x for x in own.values())) > 9}
    sets = spark.createDataFrame(list(own.items()), "sig long, hashes array<long>")
    crowds = spark.createDataFrame(list(counts.items()), "token long, c long")
    want = {}
    for k, x in own.items():
        first = sorted(x, key=lambda t: (counts.get(t, 0), t))[: len(x) - -(-4 * len(x) // 5) + 1 if x else 0]
        want[k] = (len(x), [t for t in first if t not in counts], [t for t in first if t in counts])
    for listed in (1000, 0):
        got = {r.sig: (r.n, r.low, r.deep) for r in simhash._by_rarity(sets, crowds, 0.8, listed).collect()}
        assert {k: got.get(k, (0, [], [])) for k in want} == want, listed


def test_suffixes(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh \u00e9\u00df") for _ in range(2000))
    rows = [(1, "a" * 500), (2, "ab" * 200), (5, base), (6, base[100:900] + "zz" + base[1000:1500]), (7, base[50:149]), (8, base[50:150]), (9, base[:120] * 4), (10, "x" + base[5:300]), (12, "y" + base[5:105]), (13, "a" * 99), (15, ("q" * 37 + "r") * 30)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(2000 + r["doc_id"], r["text"]) for r in rows_of("documents")[:60]]
    seen, want = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                gone[p : p + 100] = True
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        want[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    frame = docs_frame(spark, rows)
    assert {r[0]: tuple(r[1:]) for r in suffixes.digests(frame).collect()} == want
    whole = suffixes.repeated_spans
    apart = {r.doc: {(x.s, x.e) for x in r.spans} for r in whole(frame, small=1).collect()}
    within = {r.doc: {(x.s, x.e) for x in r.spans} for r in whole(frame).collect()}
    cover = lambda spans: {p for s, e in spans for p in range(s, e)}
    assert {k: cover(v) for k, v in apart.items()} == {k: cover(v) for k, v in within.items()}
    left = suffixes.remove(docs_frame(spark, [(1, base), (2, base[:300]), (3, None)]))
    assert {r.doc_id: r.text for r in left.collect()} == {1: base, 2: "", 3: None}
    assert suffixes.digests(docs_frame(spark, [])).count() == 0 and suffixes.remove(docs_frame(spark, [])).count() == 0


def test_suffixes_of_repeated_ids_and_long_texts(spark):
    """Rows that share an id leave each other alone; each is judged by rows of smaller ids and by itself."""
    rng = random.Random(12)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    long = "".join(rng.choice("klmnopqr") for _ in range(1000)) * 2200  # over a piece of 2 MB
    rows = [(1, "abc " * 30), (1, "abc " * 30), (1, "other text here now yes"), (2, base), (2, base), (2, base[:400] + "z" + base[400:700]), (2, base[600:800] * 2), (3, base[100:350]), (3, base[500:620] + "abc " * 26), (None, base[:200]), (9, long)]
    key = lambda i: -1 if i is None else i
    want = []
    for i, t in rows:
        before = {b[p : p + 100] for b in {x for j, x in rows if key(j) < key(i)} if len(b) < 10_000 for p in range(len(b) - 99)}
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 99):
            if t[p : p + 100] in before:
                gone[p : p + 100] = True
            before.add(t[p : p + 100])
        kept = "".join(x for x, g in zip(t, gone) if not g)
        want.append((key(i), len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum()), hashlib.sha256(kept.encode()).hexdigest()))
    got = [(key(r[0]), *r[1:]) for r in map(tuple, suffixes.digests(docs_frame(spark, rows)).collect())]
    assert sorted(got) == sorted(want)
    assert sorted(len(r.text) for r in suffixes.remove(docs_frame(spark, rows)).collect()) == sorted(w[1] - w[2] for w in want)


def test_suffixes_with_a_common_passage(spark):
    rng = random.Random(8)
    passage = "".join(rng.choice("klmnopqrs tuv") for _ in range(90))
    ends = ["".join(rng.choice("abcdefg") for _ in range(30)) for _ in range(300)]
    rows = [(i, rng.choice(ends) + passage + rng.choice(ends)) for i in range(2000)]
    frame = docs_frame(spark, rows)
    seen, want = set(), {}
    for i, t in rows:
        for p in range(len(t) - 99):
            if t[p : p + 100] in seen:
                want.setdefault(i, set()).update(range(p, p + 100))
            seen.add(t[p : p + 100])
    own = frame.select(frame.doc_id.alias("doc"), F.lit(0).cast("long").alias("h"), "text").mapInArrow(suffixes._sample(100), suffixes._KINDS)
    assert suffixes._crowded(own, 16) is not None and suffixes._crowded(own, 10_000) is None
    for small in (16, 10_000):
        got = {r.doc: {p for x in r.spans for p in range(x.s, x.e)} for r in suffixes.repeated_spans(frame, small=small).collect()}
        assert got == want


def test_decontamination(spark, duck):
    own = decontaminate.contamination(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    same(own, duck, decontaminate.ORACLE)
    docs = docs_frame(spark, [(1, "a b c"), (1, "a b c"), (2, None), (None, "x a b y"), (4, ""), (5, "q r s t"), (6, "one"), (7, "A-b! one")])
    items = spark.createDataFrame([(1, "a b"), (2, "one"), (3, None), (4, "r s t"), (5, ""), (1, "a b")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(docs, items).collect())
    assert got == [(0, 4, 2, 1), (1, 3, 2, 1), (1, 3, 2, 1), (2, 0, 0, 0), (4, 0, 0, 0), (5, 4, 3, 1), (6, 1, 1, 1), (7, 3, 3, 2)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()) == [2, 4]
    assert decontaminate.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    limit, decontaminate.BROADCAST_BYTES = decontaminate.BROADCAST_BYTES, 0
    try:
        again = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(docs, items).collect())
    finally:
        decontaminate.BROADCAST_BYTES = limit
    assert again == got


def test_bpe(spark):
    import tiktoken

    ranks, pattern = queries.vocabulary()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = [(r["doc_id"], r["text"]) for r in rows_of("documents")][:60] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(1, "twice"), (1, "twice"), (None, "no id")]
    frame = docs_frame(spark, rows)
    want = sorted((i if i is not None else -1, enc.encode_ordinary(t or "")) for i, t in rows)
    ids = bpe.encode(frame, ranks, pattern)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in ids.collect()) == want
    texts = sorted((i if i is not None else -1, (t or "").encode()) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.bytes)) for r in bpe.decode(ids, ranks).collect()) == texts
    d = bpe.digests(docs_frame(spark, rows[:1]), ranks, pattern).first()
    assert d.ids_sha256 == hashlib.sha256(",".join(map(str, enc.encode_ordinary(rows[0][1]))).encode()).hexdigest()


def test_bpe_of_texts_over_a_block(spark):
    import tiktoken

    ranks, pattern = queries.vocabulary()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = [r["text"] or "" for r in rows_of("documents")]
    long = " ".join(texts)
    rows = [(1, long * (1 + (17 << 20) // len(long))), (2, long), (3, ""), (3, None)]
    want = sorted((i, enc.encode_ordinary(t or "")) for i, t in rows)
    got = bpe.encode(docs_frame(spark, rows), ranks, pattern)
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == want
    assert bpe.digests(docs_frame(spark, []), ranks, pattern).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=1, max_size=300))
def test_long_and_short_merges_agree(word):
    ranks, _ = queries.vocabulary()
    if word not in ranks:
        short = bpe.merge(word[:128], ranks)
        assert short == (bpe._merge_long(word[:128], ranks) if word[:128] not in ranks else short)
        assert b"".join({v: k for k, v in ranks.items()}[i] for i in bpe.merge(word, ranks)) == word


def test_fast_pattern_is_the_pattern(spark):
    import regex

    _, pattern = queries.vocabulary()
    slow = regex.compile(pattern)
    rng = random.Random(1)
    letters = [chr(c) for c in range(0x250) if not bpe.UNUSUAL.search(chr(c))]
    for _ in range(300):
        t = "".join(rng.choice(letters) for _ in range(40))
        assert bpe.FAST.findall(t) == slow.findall(t)


def test_topk(spark, duck):
    v = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    same(bitsliced.top_k(v, v.where("vec_id % 50 = 0")), duck, bitsliced.ORACLE)
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-3, 3) for _ in range(5)]) for i in range(300)] + [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(40)]
    rows += [(2000, None), (2001, [float("nan")] * 5), (2002, [None, 1.0, 1.0, 1.0, 1.0]), (2003, [float("inf")] * 5), (2004, []), (2005, [1.0]), (None, [1.0] * 5), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("q", F.lit(1)).repartition(3)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in bitsliced.top_k(df, df.where("vec_id % 50 = 0")).collect())
    ints = {i: [int(np.floor(256 * x)) for x in e] for i, e in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e)}
    want = []
    for a in sorted(i for i in ints if i % 50 == 0):
        s = sorted((-sum(x * y for x, y in zip(ints[a], ints[b])), b) for b in ints if b != a and len(ints[b]) == len(ints[a]))[:5]
        want += [(a, k + 1, b, -v) for k, (v, b) in enumerate(s)]
    assert got == sorted(want)
    assert bitsliced.top_k(df.limit(0), df.limit(0)).count() == 0


def test_topk_of_repeated_rows(spark):
    rng = random.Random(4)
    rows = [(50, [1.0, 0.0])] + [(7, [2.0, 0.0])] * 7 + [(8, [2.0, 0.0]), (9, [2.0, 0.0]), (10, [1.0, 1.0]), (11, [1.0, 0.5]), (12, [0.5, 0.0])]
    rows += [(100, [2.0, 0.0])] * 9 + [(100, [3.0, rng.uniform(0, 1)]) for _ in range(8)] + [(150, [0.0, 1.0]), (150, [0.0, 1.0]), (150, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [(i, tuple(int(np.floor(256 * x)) for x in e)) for i, e in rows]
    want = []
    for a in (50, 100, 150):
        s = sorted((-sum(x * y for x, y in zip(q, v)), b) for q in {v for i, v in ints if i == a} for b, v in ints if b != a)[:5]
        want += [(a, k + 1, b, -v) for k, (v, b) in enumerate(s)]
    for parts in (1, 3):
        own = df.repartition(parts)
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in bitsliced.top_k(own, own.where("vec_id % 50 = 0")).collect())
        assert got == sorted(want)


def test_topk_of_huge_components_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(bitsliced, "BLOCK_ROWS", 8)
    monkeypatch.setattr(bitsliced, "STRIPE_BLOCKS", 3)
    rng = random.Random(9)
    rows = [(i, [rng.choice([1e300, -1e300, 1e15, -1e15, 3.5, 0.0, -2.0]), rng.uniform(-4, 4), rng.uniform(-1e17, 1e17)]) for i in range(120)]
    rows += [(200 + i, [rng.uniform(-2, 2) for _ in range(3)]) for i in range(120)]
    low, high = -(1 << 63), (1 << 63) - 1
    ints = {i: [min(max(math.floor(256 * x) if abs(x) < 1e290 else int(x), low), high) for x in e] for i, e in rows}
    want = []
    for a in (i for i in ints if i % 50 == 0):
        s = sorted((-sum(x * y for x, y in zip(ints[a], ints[b])), b) for b in ints if b != a)[:5]
        want += [(a, k + 1, b, min(max(-v, -high), high)) for k, (v, b) in enumerate(s)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in bitsliced.top_k(df, df.where("vec_id % 50 = 0")).collect()]
    assert sorted(got) == sorted(want)


def test_warc(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in rows_of("pages")]
    rows += [(1001, "http://a.B.com/x y\n?q", "<p>\u00e9"), (1002, None, None), (1003, "no host", ""), (None, "http://a.b.com/", "<p>\u00e9"), (1005, "http://a.b.com", "zz"), (1005, "http://a.b.com", "zz"), (1004, "https://\u00fc.de/%20%zz#f", "zz")]
    rows += [(6000 + i, f"http://e.org/{i}", None) for i in range(150)]  # one payload for many
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    want = []
    for p, _, h in rows:
        b, f = (h or "").encode(), first.get(h or "")
        again = f is not None and f != p
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", f if again else None))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"first": F.lit(0), "sha": F.lit(0)}).repartition(3)
    assert sorted(map(repr, map(tuple, warc.round_trip(df).collect()))) == sorted(map(repr, want))
    assert warc.round_trip(df.limit(0)).count() == 0


def test_join_of_hot_keys(spark):
    from mereflow.llm.common import join_hot

    left = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 7, id) as k")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    want = left.join(right.drop("n"), "k")
    assert sorted(map(tuple, join_hot(left, right, "k", "n").select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert join_hot(left.limit(0), right.limit(0), "k", "n").count() == 0


def test_warc_lookup_returns_payloads(spark):
    from mereflow import scratch

    rows = [(i, f"http://h{i % 7}.example.org/p/{i}", f"<p>{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch.new_path(spark, "warc-test")
    capture = warc.build_index(warc.write(df, folder), lines=10)
    asked = df.where("page_id % 40 = 3").select(warc.sort_key(F.col("url"), F.col("page_id")).alias("key"))
    got = {r.page_id: (r.url, bytes(r.payload).decode()) for r in warc.read(warc.look_up(capture, asked), folder).collect()}
    assert got == {i: (u, h) for i, u, h in rows if i % 40 == 3}


def test_warc_of_many_equal_keys(spark):
    """Rows without an id and with one url share a key over many blocks and pages of the index."""
    from mereflow import scratch

    rows = [(None, "http://a.example.org/p", f"<p>{i}") for i in range(90)] + [(i, f"http://{c}.example.org/{i}", f"<b>{i}") for i, c in enumerate("ab" * 20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = scratch.new_path(spark, "warc-test")
    capture = warc.build_index(warc.write(df, folder), lines=4, page=3)
    key = warc.sort_key(F.col("url"), F.col("page_id"))
    for which in ("page_id is null", "page_id % 7 = 1", "true"):
        got = warc.read(warc.look_up(capture, df.where(which).select(key.alias("key"))), folder).collect()
        assert sorted(bytes(r.payload).decode() for r in got) == sorted(r.html for r in df.where(which).collect())


def test_urls(spark):
    rows = [(r["page_id"], r["url"]) for r in rows_of("pages")] + [(900, None), (901, ""), (902, "HTTP://EXAMPLE.com/en/77?x"), (903, "x://a.net/de/"), (None, "ftp://org/es/1/2/3/4/5/6/7"), (903, "x://a.net/de/"), (904, "://")]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = []
    for i, u in rows:
        host = path = ""
        if "://" in (u or ""):
            rest = u.split("://", 1)[1]
            m = re.match(r"[^/?#]*", rest)
            host, path = m[0].translate(low), re.match(r"[^?#]*", rest[m.end() :])[0]
        fits = [k for k in queries.URL_RULES if (host == k.split("/", 1)[0] or host.endswith("." + k.split("/", 1)[0])) and path.startswith("/" + k.split("/", 1)[1])]
        want.append((i, host, path, max(fits, key=len) if fits else None))
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "template": F.lit(1)})
    got = urls.judge(df, queries.URL_RULES).collect()
    assert sorted(map(repr, ((r.page_id, r.host, r.path, r.rule) for r in got))) == sorted(map(repr, want))
    assert all(r.verdict == queries.URL_RULES[r.rule] for r in got if r.rule) and {r.verdict for r in got} <= {"allow", "block"}
    spam = spark.createDataFrame([(i, f"http://h.com/ads/{i}") for i in range(40)] + [(100 + i, f"http://h.com/news/{i}") for i in range(40)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 2)] + [(100 + i, 0) for i in range(0, 40, 2)], "page_id long, bad int")
    verdicts = {r.page_id: r.verdict for r in urls.judge(spam, {}, labels).collect()}
    assert all(v == ("block" if i < 100 else "allow") for i, v in verdicts.items())


def plain_templates(pages):
    """{(host, path): (template, purity)} from (host, path, bad, good), by dictionaries."""
    seen = {}
    for h, p, b, g in pages:
        n, x, y = seen.get((h, p), (0, 0, 0))
        seen[h, p] = (n + 1, x + b, y + g)
    segs = lambda p: [re.sub("[0-9]+", "#", x) for x in re.sub("^/", "", p).split("/")]
    at, whole, level = {k: "" for k in seen}, dict.fromkeys(seen, False), 0
    while True:
        nodes = {}
        for (h, p), t in at.items():
            if not whole[h, p] and level < len(segs(p)):
                node = nodes.setdefault((h, t), {}).setdefault(segs(p)[level], [0, 0, 0, 0])
                for k, v in enumerate((1, *seen[h, p])):
                    node[k] += v
        if not nodes:
            break
        names, alone = {}, {}
        for key, kids in nodes.items():
            alone[key] = sum(v[0] for v in kids.values()) == 1
            if len(kids) >= 8 and sum(v[1] for v in kids.values()) < 4 * len(kids):
                names |= {(*key, s): "*" for s in kids}
                continue
            if len(kids) == 1:
                names |= {(*key, s): s for s in kids}
                continue
            names |= {(*key, s): "~?" for s, v in kids.items() if v[2] + v[3] < 5}
            told = sorted((v[2] / (v[2] + v[3]), s, v[2], v[2] + v[3]) for s, v in kids.items() if v[2] + v[3] >= 5)
            runs = []
            for k in told:
                if runs:
                    _, _, b, n = runs[-1][-1]
                    p = (b + k[2]) / (n + k[3])
                    z = abs(k[0] - b / n) / (max(p * (1 - p), 1e-4) * (1 / n + 1 / k[3])) ** 0.5
                if runs and z <= 1.96:
                    runs[-1].append(k)
                else:
                    runs.append([k])
            names |= {(*key, k[1]): k[1] if len(r) == 1 else f"~{i}" for i, r in enumerate(runs) for k in r}
        for (h, p), t in list(at.items()):
            if whole[h, p] or level >= len(segs(p)):
                whole[h, p] = True
                continue
            one = alone[h, t]
            at[h, p] = t + "/" + ("/".join(segs(p)[level:]) if one else names[h, t, segs(p)[level]])
            whole[h, p] = one
        level += 1
    sums = {}
    for (h, p), t in at.items():
        b, g = sums.get((h, t), (0, 0))
        sums[h, t] = (b + seen[h, p][1], g + seen[h, p][2])
    return {(h, p): (t, (sums[h, t][0] + 5) / (sum(sums[h, t]) + 10)) for (h, p), t in at.items()}


def test_url_templates_against_plain_ones(spark):
    rng = random.Random(3)
    pages = []
    for h in ("a.com", "b.org"):
        for _ in range(400):
            p = "/" + "/".join(rng.choice(["ads", "news", f"u{rng.randrange(30)}", "x", f"id{rng.randrange(4)}q", "blog"]) for _ in range(rng.randrange(1, 5)))
            bad = "ads" in p or rng.random() < 0.1
            known = rng.random() < 0.5
            pages.append((h, p, int(known and bad), int(known and not bad)))
    pages += [("c.net", "", 0, 0), ("c.net", "/", 1, 0), ("", "", 0, 1)]
    pages += [("d.io", f"/{k}/{i}", int(i < share), int(i >= share)) for k, share in (("p", 18), ("q", 17), ("r", 2), ("s", 1), ("t", 10)) for i in range(20)]
    want = plain_templates(pages)
    got = {(r.host, r.path): (r.template, r.purity) for r in urls.templates(spark.createDataFrame(pages, "host string, path string, bad int, good int")).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-12 for k in want)
    assert len({want["d.io", f"/{k}/1"][0].split("/")[1] for k in "pqrst"}) == 3


@pytest.mark.parametrize("name", ["op2_simhash", "op4_url_filter", "op7_warc", "op8_suffix_dedup"])
def test_queries_against_sql(spark, duck, name):
    same(queries.QUERIES[name](spark, SF_DIR), duck, queries.ORACLE[name])


def test_url_verdicts_against_plain_ones(spark):
    """The whole query: verdicts that no rule gives are the tree's, whose labels are the pages that rules decide."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = urls.judge(df, queries.URL_RULES).collect()
    block = {r for r, v in queries.URL_RULES.items() if v == "block"}
    want = plain_templates([(r.host, r.path, int(r.rule in block), int(r.rule is not None and r.rule not in block)) for r in rows])
    for r in rows:
        template, purity = want[r.host, r.path]
        assert (r.template, round(r.purity, 12)) == (template, round(purity, 12))
        assert r.verdict == (queries.URL_RULES[r.rule] if r.rule else "block" if purity > 0.5 else "allow")
    assert urls.judge(df.limit(0), queries.URL_RULES).count() == 0


def fold(i, n):
    return zlib.crc32(("null" if i is None else str(i)).encode()) % n


def test_quality(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in quality.predictions(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (fold(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in got.items())
    held = [i for i in truth if got[i].held_out]
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.9
    odd = docs_frame(spark, list(enumerate(ODD)))
    assert quality.predictions(odd, labels).count() == len(ODD)
    assert quality.predictions(odd, labels.limit(0)).where("score = 0.5").count() == len(ODD)
    assert "lang" in quality.keep_good(odd, labels).columns


def test_quality_scores_against_plain_ones(spark):
    """Every score again from the model's dictionaries: four compressed sizes a text, their differences, and the calibration."""
    import zstandard

    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels)
    some = docs_frame(spark, [(r["doc_id"], r["text"]) for r in rows_of("documents")[:40]] + [(1000 + i, t) for i, t in enumerate(ODD)])
    kind = lambda b: "a" if b >= 128 or 97 <= b < 123 else "A" if 65 <= b < 91 else "0" if 48 <= b < 58 else chr(b)
    texts = {r.doc_id: r.text or "" for r in some.collect()}
    for r in quality.score(some, model).collect():
        raw = texts[r.doc_id].encode()
        x = []
        for view, (good, bad) in ((raw, model["dictionaries"][:2]), ("".join(map(kind, raw)).encode("latin-1"), model["dictionaries"][2:])):
            g, b = (len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d)).compress(view)) for d in (good, bad))
            x += [(b - g) / max(g, b), (b - g) / len(view), math.log(min(g, b) / len(view))] if view else [0, 0, 0]
        z = [min(max((v - m) / d, -6), 6) for v, m, d in zip(x, model["mean"], model["sd"])]
        score = 1 / (1 + math.exp(-sum(a * w for a, w in zip([1, *z, *(v * v for v in z)], model["w"]))))
        assert abs(score - r.score) < 1e-9
    assert quality.predictions(docs.limit(0), labels).count() == 0


def test_toxicity(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = labels.where("doc_id % 5 = 0")
    model = toxicity.fit(docs, labels.where("doc_id % 5 <> 0"))
    got = toxicity.score(docs.join(held.select("doc_id"), "doc_id", "left_semi"), model).join(held, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.97
    odd = docs_frame(spark, list(enumerate(ODD)))
    assert toxicity.score(odd, model).where("predicted = 0").count() == len(ODD)
    assert toxicity.score(odd, toxicity.fit(docs, labels.limit(0))).count() == len(ODD)


def test_toxicity_chain_against_plain_one(spark):
    """Three kinds of bad words in two languages: every link by plain loops, fed by the links before it."""
    rng = random.Random(6)
    kinds = [["grumf", "blarg", "snork"], ["zwitz", "krach", "dumpf"], ["pifpaf", "chouine", "merdouille"]]
    plain = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    rows, tags = [], []
    for i in range(600):
        bad = i % 2
        own = rng.sample(plain, 12) + (rng.sample(kinds[i // 2 % 3], 2) if bad else [])
        rng.shuffle(own)
        rows.append((i, " ".join(own)))
        tags.append((i, bad))
    docs, labels = docs_frame(spark, rows), spark.createDataFrame(tags, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for i, t in rows:
        features = {f for w in t.split() for f in (w, *(w[:n] + "-" for n in (4, 5, 6) if len(w) >= n))}
        slots = sorted({int(model["slot"][zlib.crc32(f.encode()) % toxicity.WIDTH]) for f in features} - {-1})
        before = []
        for w in model["links"]:
            z = w[-1] + sum(w[k] for k in slots) + sum(a * b for a, b in zip(w[len(w) - 1 - len(before) : -1], before))
            before.append(min(max(z, -30), 30))
        p = [1 / (1 + np.exp(-z)) for z in before]
        assert np.allclose(p, [got[i].kind_1, got[i].kind_2, got[i].kind_3, got[i].score], atol=1e-6)
    assert all(r.predicted == tags[i][1] for i, r in got.items())
    by_kind = {tuple(sorted({int(np.argmax([got[i].kind_1, got[i].kind_2, got[i].kind_3])) for i, _ in rows if i % 2 and i // 2 % 3 == k})) for k in range(3)}
    assert sorted(by_kind) == [(0,), (1,), (2,)]
    assert toxicity.score(docs_frame(spark, []), model).count() == 0


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in langid.predictions(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert all(r.held_out == (fold(i, 3) == 1) and 0 <= r.score <= 1 for i, r in got.items())
    assert np.mean([got[i].lang_pred == truth[i] for i in truth if got[i].held_out]) > 0.98
    model = langid.fit(docs)
    odd = {r.doc_id: r.lang_pred for r in langid.predict(docs_frame(spark, list(enumerate(ODD))), model).collect()}
    assert [odd[i] == "und" for i in range(len(ODD))] == [not langid.has_letter(t) for t in ODD]
    assert langid.predict(docs_frame(spark, [(1, "\u65e5\u672c\u8a9e\u3067\u3059")]), model, reject=0.01).first().lang_pred == "und"
    assert langid.predict(docs, langid.fit(docs.limit(0))).where("lang_pred <> 'und'").count() == 0


def plain_kneser_ney(texts):
    """Chances of a character after up to three others, from dictionaries; texts are spelled as the operator spells them."""
    runs = {}
    for t in texts:
        words = "   " + " ".join(re.findall(r"[^\W\d_]+", t.lower())) + " "
        for i in range(len(words) - 3):
            runs[words[i : i + 4]] = runs.get(words[i : i + 4], 0) + 1
    counts = {4: runs}
    for o in (3, 2, 1):
        counts[o] = {}
        for k in counts[o + 1]:
            counts[o][k[1:]] = counts[o].get(k[1:], 0) + 1
    letters = len(counts[1]) + 1

    def chance(key):
        if not key:
            return 1 / letters
        own = counts[len(key)]
        once, twice = (sum(c == n for c in own.values()) for n in (1, 2))
        d = once / (once + 2 * twice) if once and twice else 0.5
        same = [c for k, c in own.items() if k[:-1] == key[:-1]]
        low = chance(key[1:])
        return low if not same else max(own.get(key, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * low

    return counts, chance


def test_language_models_against_plain_ones(spark):
    texts = ["the cat sat on the mat", "a cat and a hat", "the rat", "that hat sat"]
    counts, chance = plain_kneser_ney(texts)
    docs = spark.createDataFrame([(i, "x", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    model = langid.fit(docs)
    asked = [a + b + c + e for a in " at" for b in "ah" for c in " cxt" for e in "tah z"] + list(counts[4])
    number = lambda k: sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(k))
    frame = spark.createDataFrame([(number(k),) for k in set(asked)], "run long")
    got = {r.run: np.exp(r.lp[0]) for r in langid.log_probabilities(frame, model).collect()}
    assert all(abs(got[number(k)] - chance(k)) < 1e-9 for k in asked)
    for context in {k[:3] for k in counts[4]}:
        assert abs(sum(chance(context + c) for c in counts[1]) + chance("~") - 1) < 0.1


def test_languages_by_broadcast_and_by_join_agree(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.fit(docs)
    odd = docs_frame(spark, list(enumerate(ODD)) + [(1, "twice the same"), (1, "twice the same"), (None, "kein id")]).select("doc_id", "text")
    both = docs.select("doc_id", "text").union(odd)
    rows = lambda most: sorted((r.doc_id if r.doc_id is not None else -1, r.lang_pred, round(r.score, 6)) for r in langid.predict(both, model, most=most).collect())
    assert rows(langid.BROADCAST_BYTES) == rows(0)
    assert langid.predictions(docs.limit(0)).count() == 0


def plain_removal(rows):
    """{id: text without characters that earlier strings of 100 bytes cover whole}."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(raw[p : p + 100])
        at, kept = 0, []
        for c in t or "":
            n = len(c.encode())
            if not gone[at : at + n].all():
                kept.append(c)
            at += n
        out[i] = None if t is None else "".join(kept)
    return out


def test_pipeline_against_plain_stages(spark):
    """Every stage by brute force on what its predecessor kept."""
    import corpus_pipeline
    import tiktoken

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "passage_dedup", "decontamination", "tokens"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = {r.doc_id for r in quality.predictions(docs, labels).where("predicted = 1").collect()}
    before, now = {r.doc_id: r for r in docs.collect()}, docs
    for name in list(stages)[:-1]:
        now = stages[name](spark, now, SF_DIR).cache()
        assert list(now.columns) == list(corpus_pipeline.COLUMNS)
        got = {r.doc_id: r for r in now.collect()}
        rows = [(i, r.text) for i, r in before.items()]
        if name == "quality":
            want = {i: t for i, t in rows if i in good}
        elif name == "near_dedup":
            near, root = {}, {i: i for i, _ in rows}
            for a, b in similar_pairs(rows):
                near.setdefault(a, set()).add(b)
                near.setdefault(b, set()).add(a)
            for i in sorted(near):
                seen, todo = {i}, [i]
                while todo:
                    new = near[todo.pop()] - seen
                    seen |= new
                    todo += new
                root[i] = min(seen)
            want = {i: t for i, t in rows if root[i] == i}
        elif name == "passage_dedup":
            want = plain_removal(rows)
        else:
            split = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
            windows = {tuple(w[k : k + 10]) for w in (split(r["text"]) for r in rows_of("benchmark")) if w for k in range(max(1, len(w) - 9))}
            sizes = {len(w) for w in windows}
            held = lambda w: any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))
            want = {i: t for i, t in rows if not held(split(t))}
        assert {i: r.text for i, r in got.items()} == want, name
        assert all(r.n_chars == len(r.text or "") for r in got.values() if name == "passage_dedup")
        before = got
    ranks, pattern = queries.vocabulary()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = {i: enc.encode_ordinary(r.text or "") for i, r in before.items()}
    want = sorted((i, len(x), sha(",".join(map(str, x)).encode()), sha((before[i].text or "").encode())) for i, x in ids.items())
    assert sorted(map(tuple, stages["tokens"](spark, now, SF_DIR).collect())) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == want and len(want) > 0.5 * docs.count()


def test_pipeline_of_odd_tables(spark, tmp_path):
    """No rows; and rows with nulls, repeats, empty and long texts and clashing columns: every stage keeps its columns and runs."""
    import corpus_pipeline

    names = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(i, t, None, None, None) for i, t in enumerate(ODD)] + [(None, "no id", None, None, 1), (1, "twice", "x", "y", 5), (1, "twice", "x", "y", 5), (1, "other", None, "", 0), (7, "word " * 30_000, "a", "b", 3)]
    for rows in ([], odd):
        now = spark.createDataFrame(rows, names).withColumns({"__kept": F.lit(1), "sig": F.lit("x"), "spans": F.lit(2.0), "h": F.lit(3)})
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF_DIR)
            got = now.collect()
            assert bool(got) == bool(rows) or name != "tokens", name


def test_deep_paths_part(spark):
    """Pages that differ only below the fourth segment, and one path that goes on alone."""
    rows = [("h", f"/a/b/c/d/e/{kind}/{k}/x{k}", int(kind == "bad"), int(kind == "good")) for kind in ("bad", "good") for k in range(10)]
    got = urls.templates(spark.createDataFrame([*rows, ("i", "/" + "/".join(f"s{k}" for k in range(40)), 0, 0), ("j", "", 0, 0)], "host string, path string, bad int, good int")).collect()
    assert {r.template for r in got if "/bad/" in r.path} == {"/a/b/c/d/e/bad/#/x#"} and all(r.purity > 0.5 for r in got if "/bad/" in r.path)
    assert all(r.purity < 0.5 for r in got if "/good/" in r.path)
    assert len(got) == 22 and "/s#" * 40 in {r.template for r in got}
