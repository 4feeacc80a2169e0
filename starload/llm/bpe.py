"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Texts are split into pre-tokens, and each word of the corpus is encoded once:

1. A task numbers the distinct words of a block of documents and writes each
   document as its sequence of numbers, that is the words' positions. The
   block's words are dealt into shards by a hash. One shuffle takes sequences
   to their block's partition and words to their shard's.
2. A shard's task has all blocks' words with one hash: it encodes each distinct
   word once and answers every block.
3. The answers meet the block's documents, which are put together by
   position: a gather of ids by word number.

Rows carry packed arrays, so the shuffles move a few bytes per occurrence and
never more rows than a row per word and block. A frequent word comes once from
each block, so it is no hot key. Decoding looks ids up in the token-byte
table, which is bounded by the vocabulary and so travels to every task.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import gives_back, per_row, shuffle_partitions, slices, text_or_empty

#: Occurrences of a block, at least; the last of a task may be smaller.
BLOCK_TOKENS = 3_000_000
#: Longer texts are matched one by one, so that no list of all matches stands in memory.
LONG_TEXT = 1 << 22


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 and rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _pack(array) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def pack_sequence(numbers: np.ndarray) -> bytes:
    """Word numbers, small ones frequent, as compressed byte planes."""
    n = numbers.astype(np.uint32)
    planes = [(n >> np.uint32(s)).astype(np.uint8) for s in (0, 8, 16, 24)]
    return _pack(np.concatenate(planes))


def unpack_sequence(data: bytes) -> np.ndarray:
    planes = _unpack(data, np.uint8).reshape(4, -1).astype(np.uint32)
    return planes[0] | planes[1] << 8 | planes[2] << 16 | planes[3] << 24


def pack_words(words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), np.uint32, len(words))
    return zstandard.ZstdCompressor(level=3).compress(
        np.uint32(len(words)).tobytes() + lengths.tobytes() + b"".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64) + 4 + 4 * n
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends[:-1].tolist()], ends.tolist())]


class _Block:
    """Documents of one task and the numbers of their distinct words."""

    def __init__(self, pattern: str, shards: int):
        self.split, self.shards = regex.compile(pattern), shards
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.ids, self.sequences, self.size = [], [], 0

    def add(self, doc_id, text: str) -> None:
        words = self.split.findall(text) if len(text) <= LONG_TEXT else (m[0] for m in self.split.finditer(text))
        sequence = np.fromiter(map(self.numbers.__getitem__, words), np.uint32)
        self.ids.append(doc_id)
        self.sequences.append(sequence)
        self.size += len(sequence) + 1

    def rows(self, block: int) -> Iterator[tuple]:
        """(key, block, doc_id, words, numbers): a shard's words have the key
        -1 - shard, documents that of their block. Words are numbered by
        falling frequency, then by their bytes."""
        counts = np.bincount(np.concatenate(self.sequences), minlength=len(self.numbers))
        words = [w.encode("utf-8") for w in self.numbers]
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        dealt: dict[int, list[int]] = defaultdict(list)
        for i in order:
            dealt[xxhash.xxh32_intdigest(words[i]) % self.shards].append(i)
        for shard, members in dealt.items():
            steps = np.diff(rank[members].astype(np.int64), prepend=0).astype(np.uint32)
            yield -1 - shard, block, None, pack_words([words[i] for i in members]), _pack(steps)
        for doc_id, sequence in zip(self.ids, self.sequences):
            yield block, block, doc_id, None, pack_sequence(rank[sequence])


BLOCKS = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()),
                    ("words", pa.binary()), ("numbers", pa.binary())])
BLOCKS_SQL = "key long, block long, doc_id long, words binary, numbers binary"


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def blocks(docs: DataFrame, pattern: str, shards: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Step 1: shard rows and document rows of every block."""
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        block, made = _Block(pattern, shards), 0
        for batch in batches:
            for part in slices(batch, 8 << 20):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    block.add(doc_id, text)
                    if block.size >= block_tokens:
                        yield from _batches(block.rows((task << 32) + made), BLOCKS, 1024)
                        block.clear()
                        made += 1
        if block.ids:
            yield from _batches(block.rows((task << 32) + made), BLOCKS, 1024)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, BLOCKS_SQL)


_ENCODERS: dict[str, tiktoken.Encoding] = {}


def _encoder(name: str, ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """One encoder per worker; its pattern takes a pre-token as a whole."""
    if name not in _ENCODERS:
        _ENCODERS[name] = tiktoken.Encoding(name, pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[name]


def answers(rows: DataFrame, ranks) -> DataFrame:
    """Step 2: for every block's share of a shard, the ids of its words.
    ``ranks`` is a broadcast of the vocabulary."""
    schema = pa.schema([("key", pa.int64()), ("numbers", pa.binary()), ("ids", pa.binary())])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(f"ranks{len(ranks.value)}-{hash(frozenset(ranks.value))}", ranks.value).encode_ordinary
        known: dict[bytes, bytes] = {}

        def coded():
            for batch in batches:
                batch = batch.filter(pc.field("words").is_valid())
                for part in slices(batch, 4 << 20):
                    for block, words, numbers in zip(*(part.column(c).to_pylist() for c in
                                                       ("block", "words", "numbers"))):
                        ids = []
                        for w in unpack_words(words):
                            found = known.get(w)
                            if found is None:
                                found = known[w] = np.array(encode(w.decode("utf-8")), "<u4").tobytes()
                            ids.append(found)
                        lengths = np.fromiter(map(len, ids), np.uint32, len(ids)) // 4
                        yield block, numbers, zstandard.ZstdCompressor(level=1).compress(
                            np.uint32(len(ids)).tobytes() + lengths.tobytes() + b"".join(ids))

        yield from _batches(coded(), schema, 64)

    return rows.mapInArrow(run, "key long, numbers binary, ids binary")


class _Words:
    """Ids of a block's words by word number."""

    def __init__(self):
        self.numbers, self.lengths, self.ids, self.table = [], [], [], None

    def add(self, numbers: bytes, packed: bytes) -> None:
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n = int(np.frombuffer(raw, np.uint32, 1)[0])
        self.numbers.append(np.cumsum(_unpack(numbers, np.uint32), dtype=np.int64))
        self.lengths.append(np.frombuffer(raw, np.uint32, n, 4).astype(np.int64))
        self.ids.append(np.frombuffer(raw, np.uint32, -1, 4 + 4 * n))

    def ready(self) -> None:
        """Lays the ids out by shard; starts and lengths by word number."""
        numbers, lengths = np.concatenate(self.numbers), np.concatenate(self.lengths)
        starts = np.cumsum(lengths) - lengths
        self.start, self.length = np.empty_like(starts), np.empty_like(lengths)
        self.start[numbers], self.length[numbers] = starts, lengths
        self.table = np.concatenate(self.ids)
        self.numbers = self.lengths = self.ids = None

    def encode(self, sequence: np.ndarray) -> bytes:
        if not len(sequence):
            return b""
        if self.table is None:
            self.ready()
        length = self.length[sequence]
        ends = np.cumsum(length)
        at = np.arange(ends[-1]) + np.repeat(self.start[sequence] - (ends - length), length)
        return self.table[at].tobytes()


def _block_ids(rows: pa.Table, coded: pa.Table) -> tuple[pa.ChunkedArray, list[bytes]]:
    """Step 3: doc_ids and ids of one block's documents, from the answers to its words."""
    words = _Words()
    for numbers, ids in zip(coded["numbers"].to_pylist(), coded["ids"].to_pylist()):
        words.add(numbers, ids)
    rows = rows.filter(pc.field("words").is_null())
    return rows["doc_id"], [words.encode(unpack_sequence(numbers)) for numbers in rows["numbers"].to_pylist()]


def _met(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_tokens: int):
    """Cogroups of a block's documents and the answers to its words."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    rows = blocks(docs, pattern, 2 * n, block_tokens).repartition(n, "key")  # one shuffle that both steps read
    return rows.groupBy("key").cogroup(answers(rows, spark.sparkContext.broadcast(ranks)).groupBy("key"))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token ids of documents (doc_id, text): (doc_id, ids) per input row, ids
    as little-endian unsigned 32-bit integers.

    ``ranks`` and ``pattern`` as for tiktoken; special tokens are not used. A
    null or empty text has no ids. Rows that repeat a doc_id are encoded each.
    ``docs`` should be a table that a rerun task reads in the same order.
    """
    def assembled(rows: pa.Table, coded: pa.Table) -> pa.Table:
        doc_ids, ids = _block_ids(rows, coded)
        return pa.table({"doc_id": doc_ids, "ids": pa.array(ids, pa.binary())})

    return _met(docs, ranks, pattern, block_tokens).applyInArrow(assembled, "doc_id long, ids binary")


def token_table(ranks: dict[bytes, int]) -> list[bytes | None]:
    """Bytes by token id."""
    table: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for b, i in ranks.items():
        table[i] = b
    return table


def decoded(ids: bytes | None, tokens: list[bytes | None]) -> bytes:
    try:
        return b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
    except (IndexError, TypeError) as e:
        raise ValueError("an id is not in the vocabulary") from e


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``, to (doc_id, ids): the token-byte
    table is joined in every task, in Arrow batches. An id that the
    vocabulary lacks is an error; null ids decode to nothing."""
    shared = encoded.sparkSession.sparkContext.broadcast(token_table(ranks))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids", F.col("ids").alias("again"))
    return rows.mapInArrow(per_row(lambda ids, again: (ids, decoded(again, shared.value)), ["doc_id", "ids", "again"],
                                   schema, 2 << 20), "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``decode(encode(docs))`` in one pass over each block: the ids are
    decoded where they are put together, so no second Python worker stands by."""
    shared = docs.sparkSession.sparkContext.broadcast(token_table(ranks))

    def both(rows: pa.Table, coded: pa.Table) -> pa.Table:
        doc_ids, ids = _block_ids(rows, coded)
        return pa.table({"doc_id": doc_ids, "ids": pa.array(ids, pa.binary()),
                         "decoded": pa.array([decoded(x, shared.value) for x in ids], pa.binary())})

    return _met(docs, ranks, pattern, block_tokens).applyInArrow(both, "doc_id long, ids binary, decoded binary")
