"""Quality rules with compression bands.

A text is compressed whole and in fixed chunks, of which the last ends with the
text and may overlap the one before. Repetitive text compresses too
well, noise (random strings, encoded data) not well enough; what is normal
depends on the length, so the limits do too.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import run_hashes, word_hashes

# Least and largest share of its bytes that a compressed text keeps, by the
# text's length in bytes. Short texts gain little from compression, and no
# lower limit holds for the shortest.
BANDS = (
    (256, 0.0, 1.5),
    (512, 0.32, 0.90),
    (1_024, 0.32, 0.80),
    (4_096, 0.30, 0.72),
    (16_384, 0.28, 0.66),
    (None, 0.25, 0.64),
)
CHUNK_BYTES = 4_096
LEVEL = 3

SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"

MEASURES = pa.struct(
    [
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("ratio", pa.float64()),
        ("least_chunk_ratio", pa.float64()),
        ("largest_chunk_ratio", pa.float64()),
        ("kept", pa.bool_()),
    ]
)
_SQL_TYPE = (
    "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint,"
    " n_repeat_words: bigint, base_failed: boolean, ratio: double,"
    " least_chunk_ratio: double, largest_chunk_ratio: double, kept: boolean>"
)


@cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


def compressed_share(data: bytes) -> float:
    """Bytes after compression over bytes before; 1 for an empty text."""
    return len(_compressor().compress(data)) / len(data) if data else 1.0


def limits(length: int, bands=BANDS) -> tuple[float, float]:
    """Least and largest share for a text of so many bytes."""
    return next((low, high) for upto, low, high in bands if upto is None or length <= upto)


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of so many words found twice or more in the text."""
    runs = run_hashes(word_hashes(words), window)
    if len(runs) < 2:
        return 0
    _, which, count = np.unique(runs, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[which] > 1)
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[starts + i] = True
    return int(covered.sum())


def measure(data: bytes | None, bands=BANDS, chunk_bytes: int = CHUNK_BYTES) -> dict:
    """All measures and the verdict of one text, given as UTF-8 bytes."""
    data = data or b""
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    letters = data.translate(None, _SPACES)
    repeated = repeated_words(words)
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)

    ratio = compressed_share(data)
    # Chunks have one length, so that they compare; the last one ends with the text.
    last = len(data) - chunk_bytes
    begins = [*range(0, last, chunk_bytes), last] if last >= 0 else []
    shares = [compressed_share(data[i : i + chunk_bytes]) for i in begins] or [ratio]
    low, high = limits(len(data), bands)
    normal = low <= ratio <= high
    if len(data) >= chunk_bytes:
        low, high = limits(chunk_bytes, bands)
        normal = normal and low <= min(shares) and max(shares) <= high
    return {
        "n_words": len(words),
        # Bytes that don't continue a character of UTF-8.
        "word_chars": len(letters) - _continuing(letters),
        "n_symbols": len(data) - len(data.translate(None, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
        "base_failed": failed,
        "ratio": ratio,
        "least_chunk_ratio": min(shares),
        "largest_chunk_ratio": max(shares),
        "kept": normal and not failed,
    }


def _continuing(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


def quality_measures(text: Column) -> Column:
    """The measures of each text as a struct.

    A NULL text is an empty one: it has no words, so it fails the base rules.
    Texts of any length are measured whole.
    """

    @F.arrow_udf(_SQL_TYPE)
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([measure(x.as_py()) for x in texts], MEASURES)

    return measured(text.cast("binary"))


def keep_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text passes, with all their columns; copies of a row fare alike."""

    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        return pa.array([measure(x.as_py())["kept"] for x in texts], pa.bool_())

    return docs.filter(kept(F.col(text_col).cast("binary")))
