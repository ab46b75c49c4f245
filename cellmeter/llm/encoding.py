"""Texts to token ids and back, with the prefix encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import WordEndTokenizer, word_end_tokenizer

# Texts whose ids a worker holds at once.
_ROWS = 500


def token_ids(text: Column, path: str) -> Column:
    """Ids of each whole text as an array; empty for NULL and empty texts."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        encode = word_end_tokenizer(path).encode
        return pa.array([encode(x.as_py()) for x in texts], pa.list_(pa.int32()))

    return encoded(text.cast("binary"))


def decoded_text(ids: Column, path: str) -> Column:
    """The string the ids stand for; NULL for NULL."""

    @F.arrow_udf("string")
    def decoded(arrays: pa.Array) -> pa.Array:
        decode = word_end_tokenizer(path).decode
        return pa.array(
            [None if (ids := x.as_py()) is None else decode(ids) for x in arrays], pa.string()
        )

    return decoded(ids)


def encoded(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded_sha256`` of every row.

    Encodes each whole text, decodes the ids again, and gives the digests of
    both. NULL texts count as empty, a NULL id stays NULL, repeated rows stay
    repeated; other columns are not read. Without ``with_ids`` the ids stay in
    the task.
    """

    def round_trips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What earlier tasks of this worker have freed goes back before the tables are built.
        pa.default_memory_pool().release_unused()
        tokenizer = word_end_tokenizer(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                some = batch.slice(begin, _ROWS)
                columns = _round_trip(tokenizer, some.column(1), with_ids)
                yield pa.RecordBatch.from_arrays([some.column(0), *columns], names)

    names = ["doc_id", *(["ids"] if with_ids else []), "n_tokens", "ids_sha256", "decoded_sha256"]
    id_type = docs.schema[id_col].dataType.simpleString()
    types = ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    fields = [f"doc_id {id_type}", *(["ids array<int>"] if with_ids else []), *types]
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(round_trips, ", ".join(fields))


def _round_trip(tokenizer: WordEndTokenizer, texts: pa.Array, with_ids: bool) -> list[pa.Array]:
    """Ids (if wanted), their number, and the digests of ids and decoded text."""
    # The ids of all texts, end to end, as they lie in the Arrow list.
    flat, sizes, digests, decoded = bytearray(), [], [], []
    for x in texts:
        ids = tokenizer.encode_bytes(x.as_py())
        sizes.append(len(ids) // 4)
        digests.append(hashlib.sha256(ids).hexdigest())
        string = tokenizer.decode(np.frombuffer(ids, "<u4").tolist())
        decoded.append(hashlib.sha256(string.encode()).hexdigest())
        if with_ids:
            flat += ids
    columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
    if with_ids:
        ends = np.cumsum([0, *sizes]).astype(np.int32)
        values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(flat)])
        columns.insert(0, pa.ListArray.from_arrays(pa.array(ends), values))
    return columns
