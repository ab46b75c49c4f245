"""Token sequences written in training order, as flat files of fixed-size records.

Documents are encoded and laid end to end, each closed by an end token, and cut
into sequences of one length. A keyed Feistel network permutes the sequence
numbers (walking its cycles to stay below their count), so each sequence has a
slot of its own in a shuffled order that nobody has to store or sort. Pieces of
sequences are range-partitioned by shard and written by slot: slot ``s`` is
record ``s % shard_records`` of shard ``s // shard_records``, at a multiple of
the record length. A reader that stopped at a slot goes on there.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import stage, staging_root
from .words import Remembered, mixed

SEQUENCE_TOKENS = 2_048
SHARD_RECORDS = 1_024
KEY = 0x5EED
# Writing tasks at most; beyond that a task writes several shards.
MOST_TASKS = 10_000
ROUNDS = 6

# Ids are unsigned 16-bit, little-endian; each record ends with one line end, which
# readers skip: records are found by their length and may hold any byte.
_ID = np.dtype("<u2")
_END = b"\n"


class ByteTokenizer:
    """Ids of texts by a ranks file, with a memory of the pieces between spaces.

    A single space always begins a piece of the pattern, so the pieces between
    spaces are encoded one by one; texts with runs of spaces are encoded whole.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        if len(ranks) >= 2**16:
            raise ValueError("ids have to fit 16 bits, and leave one for the end token")
        self.end = len(ranks)
        self._encode = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._piece = Remembered(self._packed, bound=100_000, longest=32)
        self._spaced = Remembered(lambda x: self._packed(" " + x), bound=600_000, longest=32)

    def _packed(self, text: str) -> bytes:
        ids = self._encode(text)
        return struct.pack(f"<{len(ids)}H", *ids)

    def packed(self, text: str | None) -> bytes:
        """Ids of a text and the end token."""
        end = np.array([self.end], _ID).tobytes()
        if not text:
            return end
        if "  " in text or text[0] == " ":
            return self._packed(text) + end
        first, *others = text.split(" ")
        return b"".join([self._piece[first], *map(self._spaced.__getitem__, others), end])


@cache
def _tokenizer(path: str, pattern: str) -> ByteTokenizer:
    return ByteTokenizer(path, pattern)


class Permutation:
    """A keyed permutation of the numbers below ``size``."""

    def __init__(self, size: int, key: int = KEY, rounds: int = ROUNDS):
        self.size = size
        self._half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
        self._mask = np.uint64((1 << int(self._half)) - 1)
        self._keys = mixed(np.arange(1, rounds + 1, dtype=np.uint64) + np.uint64(key << 8))

    def _round(self, half: np.ndarray, key: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(half + key) & self._mask

    def _network(self, values: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        left, right = values >> self._half, values & self._mask
        for key in keys:
            if back:
                left, right = right ^ self._round(left, key), left
            else:
                left, right = right, left ^ self._round(right, key)
        return (left << self._half) | right

    def _walk(self, values: np.ndarray, back: bool) -> np.ndarray:
        keys = self._keys[::-1] if back else self._keys
        out = self._network(values.astype(np.uint64), keys, back)
        while (outside := out >= self.size).any():
            out[outside] = self._network(out[outside], keys, back)
        return out.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


def token_table(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``part, start, ids``: the ids of each text, and where they begin in what a task wrote.

    Stored: the order of the sequences is that of this table.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = _tokenizer(path, pattern).packed
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            starts, ids = [], []
            for text in batch.column(0):
                data = packed(text.as_py())
                starts.append(at)
                ids.append(data)
                at += len(data) // _ID.itemsize
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["part", "start", "ids"],
            )

    narrow = docs.select(F.col(text_col))
    found = narrow.mapInArrow(encode, "part int, start bigint, ids binary")
    return stage(found, "tokens", level=9)


def write_shards(
    docs: DataFrame,
    path: str,
    pattern: str,
    folder: str,
    text_col: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS,
    shard_records: int = SHARD_RECORDS,
    key: int = KEY,
) -> int:
    """Write the shards of ``docs`` to a new ``folder``; returns the number of sequences.

    NULL and empty texts are an end token alone; repeated rows are written
    repeatedly; the last sequence is filled up with end tokens. Without rows there
    are no records. Other columns are not read. Files come from Spark's own
    writer, so a lost executor leaves no half-written shard behind.
    """
    end = _tokenizer(path, pattern).end
    tokens = token_table(docs, path, pattern, text_col)
    parts = tokens.groupBy("part").agg(
        F.sum(F.octet_length("ids") / _ID.itemsize).cast("bigint").alias("n")
    )
    # One row per task that wrote the table.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(
        parts.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
        "token_parts",
    )
    total = bases.agg(F.sum("n")).first()[0] or 0
    count = -(-total // sequence_tokens)
    if count == 0:
        docs.sparkSession.createDataFrame([], "record string").write.text(folder)
        return 0
    permutation = Permutation(count, key)
    shards = -(-count // shard_records)
    tasks = min(shards, MOST_TASKS)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Shuffled ids take a fifth less room this way than by Spark's codec alone;
        # higher levels take hardly less for pieces of this size.
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            numbers, at, data = [], [], []
            for begin, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids.as_py()
                used, n = 0, len(ids) // _ID.itemsize
                while used < n:
                    number, inside = divmod(begin + used, sequence_tokens)
                    take = min(sequence_tokens - inside, n - used)
                    numbers.append(number)
                    at.append(inside)
                    own = ids[used * _ID.itemsize : (used + take) * _ID.itemsize]
                    data.append(compress(own))
                    used += take
            slots = permutation.slots(np.array(numbers, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    # Tasks take ranges of shards, of equal length but for one.
                    pa.array(slots // shard_records * tasks // shards, pa.int32()),
                    pa.array(slots, pa.int64()),
                    pa.array(at, pa.int32()),
                    pa.array(data, pa.binary()),
                ],
                ["task", "slot", "at", "ids"],
            )

    filler = np.array([end], _ID).tobytes()
    length = sequence_tokens * _ID.itemsize

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, open_ = None, []
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            done = []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != slot and open_:
                    done.append(_filled(open_, length, filler))
                    open_ = []
                slot = own
                open_.append(decompress(ids.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["record"])
        if open_:
            last = pa.array([_filled(open_, length, filler)], pa.binary())
            yield pa.RecordBatch.from_arrays([last], ["record"])

    placed = tokens.join(bases.select("part", "base"), "part").select(
        (F.col("base") + F.col("start")).alias("begin"), "ids"
    )
    # Ranges of shards have one size, so their bounds are known without sampling.
    in_order = (
        placed.mapInArrow(pieces, "task int, slot bigint, at int, ids binary")
        .repartitionById(tasks, "task")
        .sortWithinPartitions("slot", "at")
        .select("slot", "ids")
    )
    # A partition holds whole shards in order, so its files are cut between shards.
    (
        in_order.mapInArrow(join, "record binary")
        .select(F.col("record").cast("string"))
        .write.option("maxRecordsPerFile", shard_records)
        .option("lineSep", _END.decode())
        .option("compression", "none")
        .text(folder)
    )
    return count


def _filled(parts: list[bytes], length: int, filler: bytes) -> bytes:
    data = b"".join(parts)
    return data + filler * ((length - len(data)) // len(filler))


def shard_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the shards, by their number: writers number range partitions and files in order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    names = [r.path for r in files.filter("length > 0").select("path").collect()]

    def place(name: str) -> tuple[int, int]:
        found = re.search(r"part-(\d+)-.*-c(\d+)", name)
        return int(found[1]), int(found[2])

    return sorted(names, key=place)


def read_slots(
    spark: SparkSession,
    folder: str,
    begin: int = 0,
    end: int | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    shard_records: int = SHARD_RECORDS,
) -> DataFrame:
    """``shard, slot, ids`` (packed) of the slots from ``begin`` to before ``end``.

    Only the shards in that range are opened.
    """

    def packed(slots: list[int], records: list[bytes]) -> list[pa.Array]:
        return [pa.array(slots, pa.int64()), pa.array(records, pa.binary())]

    return _records(
        spark, folder, packed, "slot bigint, ids binary", begin, end, sequence_tokens, shard_records
    )


def _records(
    spark: SparkSession,
    folder: str,
    columns: Callable[[list[int], list[bytes]], list[pa.Array]],
    schema: str,
    begin: int = 0,
    end: int | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    shard_records: int = SHARD_RECORDS,
) -> DataFrame:
    """``shard`` and what ``columns`` makes of the records of some slots, in one pass over the files."""
    stride = sequence_tokens * _ID.itemsize + len(_END)
    last = None if end is None else -(-end // shard_records)
    chosen = shard_files(spark, folder)[begin // shard_records : last]
    schema = f"shard bigint, {schema}"
    if not chosen:
        return spark.createDataFrame([], schema)
    number_of = {p.rpartition("/")[2]: begin // shard_records + i for i, p in enumerate(chosen)}
    names = [field.split()[0] for field in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard, data = number_of[path.rpartition("/")[2]], content.as_py()
                first = shard * shard_records
                least = max(begin - first, 0)
                most = len(data) // stride if end is None else min(len(data) // stride, end - first)
                places = range(least, most)
                records = [data[i * stride : (i + 1) * stride - len(_END)] for i in places]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(records), pa.int64()),
                        *columns([first + i for i in places], records),
                    ],
                    names,
                )

    files = spark.read.format("binaryFile").load(chosen).select("path", "content")
    return files.mapInArrow(cut, schema)


def materialised(
    docs: DataFrame, path: str, pattern: str, folder: str | None = None
) -> DataFrame:
    """``shard, slot, sequence, n_tokens, ids_sha256`` of every record, read back from the files."""
    spark = docs.sparkSession
    folder = folder or f"{staging_root(spark)}/shards-{uuid.uuid4().hex}"
    count = write_shards(docs, path, pattern, folder)
    permutation = Permutation(max(count, 1))

    def digest(slots: list[int], records: list[bytes]) -> list[pa.Array]:
        numbers = permutation.numbers(np.array(slots, np.int64))
        return [
            pa.array(slots, pa.int64()),
            pa.array(numbers, pa.int64()),
            pa.array([len(r) // _ID.itemsize for r in records], pa.int64()),
            pa.array([hashlib.sha256(r).hexdigest() for r in records], pa.string()),
        ]

    schema = "slot bigint, sequence bigint, n_tokens bigint, ids_sha256 string"
    return _records(spark, folder, digest, schema)
