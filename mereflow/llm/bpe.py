"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

A task splits its texts into pre-tokens and keeps, per block of about 8 MB of text, each distinct
word once plus every text's positions as indices into them. A row per word and block would weigh
more than the texts, so a block's words are packed by lots, which are dealt by a hash of the word. All
blocks' copies of a word meet in its lot, which merges each distinct word once. The ids are joined back
to their blocks and every text is put together again by position. A block is a good part of an input split,
so there are few more packets than a shuffle has pieces.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mereflow.llm.common import arrow_rows

#: Same splits as the vocabulary's pattern for texts of the letters below U+0250, where ``re`` and
#: ``regex`` agree about letters, digits and space; other texts take the pattern itself.
FAST = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")
UNUSUAL = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe]|[^\x00-ɏ]")
BLOCK_BYTES = 8 << 20
#: A block: its documents with their numbers of pre-tokens, all pre-tokens as indices into its distinct words, the lot of each
#: distinct word, and the words by lot. Numbers and words are packed.
_BLOCK = pa.struct([("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("at", pa.binary()), ("lots", pa.binary()), ("words", pa.list_(pa.struct([("lot", pa.int32()), ("words", pa.binary())])))])
_BLOCK_DDL = "block long, data struct<docs: array<bigint>, sizes: array<int>, at: binary, lots: binary, words: array<struct<lot: int, words: binary>>>"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank merges first, the leftmost of equals."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > 128:
        return _merge_long(word, ranks)
    none = 1 << 40
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs and (low := min(pairs)) != none:
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges from a heap, for very long pre-tokens."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n))  # of the part that starts at i: its end, the start of the part before it
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not alive[i] or mid >= n or end[mid] != stop:
            continue
        alive[mid], end[i] = False, stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane, which compresses well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _whole(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _pack(numbers: np.ndarray, rest: bytes = b"") -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(len(numbers).to_bytes(8, "little") + _planes(numbers) + rest)


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    end = 8 + 4 * int.from_bytes(raw[:8], "little")
    return _whole(raw[8:end]), raw[end:]


def _blocks(pattern: str, fast: bool, deal: int):
    """Batches of documents to blocks: words dealt into ``deal`` lots, and texts as indices into them."""
    slow = regex.compile(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[np.ndarray] = []
        seen: dict[str, int] = {}
        held = 0

        def close() -> pa.RecordBatch:
            words, at = list(seen), np.concatenate(texts)
            order = sorted(range(len(words)), key=words.__getitem__)
            order = np.array(order, np.int64)[np.argsort(-np.bincount(at, minlength=len(words))[order], kind="stable")]
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            words = [words[i].encode("utf-8", "surrogatepass") for i in order]
            lot = np.fromiter((zlib.crc32(w) % deal for w in words), np.uint32, len(words))
            by_lot = np.argsort(lot, kind="stable")
            cuts = np.searchsorted(lot[by_lot], np.arange(deal + 1))
            dealt = []
            for k in range(deal):
                if own := [words[i] for i in by_lot[cuts[k] : cuts[k + 1]]]:
                    dealt.append({"lot": k, "words": _pack(np.fromiter(map(len, own), np.uint32, len(own)), b"".join(own))})
            data = {"docs": ids, "sizes": [len(t) for t in texts], "at": _pack(rank[at]), "lots": _pack(lot), "words": dealt}
            return pa.RecordBatch.from_arrays([pa.array([serial], pa.int64()), pa.array([data], _BLOCK)], names=["block", "data"])

        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                found = (FAST if fast and not UNUSUAL.search(text) else slow).findall(text)
                texts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in found), np.int32, len(found)))
                ids.append(d)
                held += len(text) + 64
                if held >= BLOCK_BYTES:
                    yield close()
                    ids, texts, seen, held = [], [], {}, 0
                    serial += 1
        if ids:
            yield close()

    return run


def _deal_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks to rows (block, lot, words)."""
    for batch in batches:
        packets = batch.column("data").field("words")
        n = packets.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = packets.flatten()
        yield pa.RecordBatch.from_arrays([batch.column("block").take(pa.array(np.repeat(np.arange(len(n)), n))), flat.field("lot"), flat.field("words")], names=["block", "lot", "words"])


def _encode_words(ranks):
    """Rows (block, lot, words) in the order of lots to (block, lot, ids: the number of ids of each word, and all ids end to end).

    A lot's distinct words are remembered while it lasts, so each is merged once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known, now = ranks.value, {}, None
        for batch in batches:
            packed = []
            for lot, blob in zip(batch.column("lot").to_pylist(), batch.column("words").to_pylist()):
                if lot != now:
                    known, now = {}, lot
                sizes, data = _unpack(blob)
                out: list[int] = []
                each, at = [], 0
                for n in sizes.tolist():
                    w = data[at : at + n]
                    at += n
                    if (got := known.get(w)) is None:
                        got = known[w] = merge(w, table)
                    out += got
                    each.append(len(got))
                packed.append(_pack(np.array(each, np.uint32), _planes(np.array(out, np.uint32))))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("lot"), pa.array(packed, pa.binary())], names=["block", "lot", "ids"])

    return run


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (data, parts) of whole blocks to a row per text with its ids in order."""
    none = np.empty(0, np.uint32)
    for batch in batches:
        for docs, parts in zip(batch.column("data").to_pylist(), batch.column("parts").to_pylist()):
            got = [_unpack(p["ids"]) for p in sorted(parts or [], key=lambda p: p["lot"])]
            flat = np.concatenate([_whole(g[1]) for g in got] or [none])
            place = np.argsort(_unpack(docs["lots"])[0], kind="stable")
            size, start = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
            size[place] = by_lot = np.concatenate([g[0] for g in got] or [none]).astype(np.int64)
            start[place] = np.cumsum(by_lot) - by_lot
            at, cuts = _unpack(docs["at"])[0], np.array(docs["sizes"], np.int64)
            n = size[at]
            total = np.cumsum(n)
            ids = flat[np.repeat(start[at] - (total - n), n) + np.arange(int(n.sum()))].astype(np.int32)
            ends = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(cuts)])]
            for a in range(0, len(cuts), 256):
                z = min(a + 256, len(cuts))
                lists = pa.ListArray.from_arrays(pa.array(ends[a : z + 1] - ends[a], pa.int32()), pa.array(ids[ends[a] : ends[z]], pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(docs["docs"][a:z], pa.int64()), lists], names=["doc_id", "ids"])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", fast: bool | None = None) -> DataFrame:
    """(doc_id, ids) with the token ids of every whole text, without special tokens.

    ``fast`` says that :data:`FAST` splits like ``pattern``; by default, if it is the public
    tokenizers' pattern. Null and empty texts give no ids; rows are handled one by one, so repeated
    rows and null ids stay as they are. Other columns are left out.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    fast = pattern == FAST.pattern.replace(r"[^\W\d_]", r"\p{L}").replace(r"\d", r"\p{N}").replace(r"(?:[^\s\w]|_)", r"[^\s\p{L}\p{N}]") if fast is None else fast
    deal = max(16, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # a block is one column, so that both uses below read the same shuffle
    blocks = texts.mapInArrow(_blocks(pattern, fast, deal), _BLOCK_DDL).repartition("block")
    shared = spark.sparkContext.broadcast(ranks)
    words = blocks.mapInArrow(_deal_words, "block long, lot int, words binary")
    ids = words.repartition("lot").sortWithinPartitions("lot").mapInArrow(_encode_words(shared), "block long, lot int, ids binary")
    parts = ids.groupBy("block").agg(F.collect_list(F.struct("lot", "ids")).alias("parts"))
    return blocks.join(parts, "block", "left").select("data", "parts").mapInArrow(_assemble, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, bytes, *keep): the token-byte table joined to every id, put together by position.

    The join is a broadcast one: the table has a row per vocabulary entry, which bounds it, and its keys are
    0, 1, 2 and so on, so a row is found by its place. A shuffle of a row per token would weigh several
    times the texts. Null ids give empty bytes; an id outside the table fails the job.
    """
    spark = tokens.sparkSession
    arrow_rows(spark)
    rows: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        rows[rank] = token
    shared = spark.sparkContext.broadcast(rows)
    kept = tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), pa.scalar([], pa.list_(pa.int32())))
            flat = table.take(lists.flatten())
            if flat.null_count:
                raise ValueError("an id that the token-byte table lacks")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            # the tokens lie end to end in the buffer, so a text is a slice of it
            cuts = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset :][ends]
            raw = flat.buffers()[2].to_pybytes() if flat.buffers()[2] else b""
            out = [raw[a:z] for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary()), *(batch.column(k) for k in keep)], names=["doc_id", "bytes", *keep])

    types = dict(kept.dtypes)
    return kept.mapInArrow(run, ", ".join(["doc_id long", "bytes binary", *(f"`{k}` {types[k]}" for k in keep)]))


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): a round trip of every text as digests."""
    ids = encode(docs, ranks, pattern)
    told = ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"))
    back = decode(told, ranks, keep=("n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))
