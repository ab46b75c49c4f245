"""Exact token counts of texts and of every prefix of them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import piece_tokenizer

CONTEXT_TOKENS = 4_096


def token_measures(text: Column, model_path: str, limit: int = CONTEXT_TOKENS) -> Column:
    """``n_tokens`` of each whole text and ``n_chars_within``, the characters of the longest
    prefix that has ``limit`` tokens at most; 0 for NULL and empty texts.

    Both are read off the token counts of the prefixes of the text's words.
    """

    @F.arrow_udf("struct<n_tokens: bigint, n_chars_within: bigint>")
    def measured(texts: pa.Array) -> pa.Array:
        measure = piece_tokenizer(model_path).measure
        found = [measure(x.as_py(), limit) for x in texts]
        columns = [pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], []))]
        return pa.StructArray.from_arrays(columns, names=["n_tokens", "n_chars_within"])

    return measured(text.cast("binary"))


def prefix_token_counts(text: Column, model_path: str) -> Column:
    """Array of the token counts of every prefix, by its length in characters; NULL for NULL."""

    @F.arrow_udf("array<int>")
    def counted(texts: pa.Array) -> pa.Array:
        counts = piece_tokenizer(model_path).prefix_counts
        return pa.array(
            [None if (t := x.as_py()) is None else counts(t) for x in texts], pa.list_(pa.int32())
        )

    return counted(text)


def truncated_text(text: Column, model_path: str, budget: int = CONTEXT_TOKENS) -> Column:
    """The longest prefix of each text that has at most ``budget`` tokens; NULL for NULL."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array) -> pa.Array:
        truncated = piece_tokenizer(model_path).truncated
        return pa.array(
            [None if (t := x.as_py()) is None else truncated(t, budget) for x in texts],
            pa.string(),
        )

    return cut(text)


def token_counts(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = CONTEXT_TOKENS,
    with_cut: bool = False,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``with_cut`` adds ``n_chars_within``, how many characters of the text fit
    ``limit`` tokens: all of them where it isn't over. Repeated rows stay repeated. A NULL text counts
    as empty, a NULL id stays NULL; other columns are not read.
    """
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("bigint").alias("n_bytes"),
        token_measures(F.col(text_col), model_path, limit).alias("found"),
    )
    return found.select(
        "doc_id",
        "n_bytes",
        "found.n_tokens",
        (F.col("found.n_tokens") > limit).alias("over_limit"),
        *(["found.n_chars_within"] if with_cut else []),
    )
