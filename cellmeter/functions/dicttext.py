"""Dict-text lines (Python literal notation) to structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CORRUPT = "_corrupt"

# A quoted string of either kind with its escapes, or what lies between two.
_PIECE = (
    r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]++|['"]"""
)


def json_words(line: Column) -> Column:
    """Spell the bare words True, False and None as JSON does; strings stay as they are."""

    def spell(text: Column) -> Column:
        text = F.regexp_replace(text, r"\bTrue\b", "true")
        text = F.regexp_replace(text, r"\bFalse\b", "false")
        return F.regexp_replace(text, r"\bNone\b", "null")

    pieces = F.transform(
        F.regexp_extract_all(line, F.lit(_PIECE), F.lit(0)),
        lambda piece: F.when(piece.rlike("^['\"]"), piece).otherwise(spell(piece)),
    )
    return F.array_join(pieces, "")


def parse_dict_text(line: Column, schema: str) -> Column:
    """Struct of ``schema`` plus ``_corrupt``, which holds a line that failed."""
    return F.from_json(
        json_words(line),
        f"{schema}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
