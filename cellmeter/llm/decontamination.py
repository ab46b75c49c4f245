"""Which words of documents stand in benchmark items: a prefix-filtered containment join.

An item is the set of its windows of 10 words, and a window the set of its
shingles of 5 words, with their places (a shorter item is one window; one of less
than 5 words is one shingle). A document contains a window only if it has all of
its shingles, so the prefix that has to be joined is one shingle: the rarest of
the window, by its count over all documents. Where it is found, its place bounds
the window inside the document, and the window is compared word by word.

The documents are read once. A bit filter of fixed size, made of the shingles of
all items, passes every shingle that an item has (and some others, which the
counts and comparisons sort out). Consecutive places that pass are stored as
stretches of words; counts, join and comparison work on these.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .bit_filter import filter_bits, passed
from .words import mixed, run_hashes

WINDOW_WORDS = 10
SHINGLE_WORDS = 5

# Bytes of text that are hashed at once; a longer text is hashed alone.
_PIECE_BYTES = 1 << 20

# Letters that words are made of, lower-cased; others are 0.
_LETTER = np.array(
    [
        b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0
        for b in range(256)
    ],
    np.uint8,
)
_LETTER_CODE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1))
_POWER = np.uint64(0xD6E8FEB86659FD93)

_FOUND = (
    "row bigint, doc_id {id_type}, n_words bigint, "
    "stretches array<struct<size: int, begin: bigint, words: string>>"
)


class Words:
    """The words of some texts, laid end to end: lower-cased letters, places and hashes."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null(b"") if texts.null_count else texts
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[
            texts.offset : texts.offset + len(texts) + 1
        ].astype(np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        # One byte between texts, so that no word goes over the end of its text.
        lengths = np.diff(offsets)
        ends = np.cumsum(lengths + 1)
        letters = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        inside = np.ones(len(letters), bool)
        inside[ends - 1] = False
        letters[inside] = _LETTER[raw[offsets[0] : offsets[-1]]]
        self.letters = letters
        edge = np.flatnonzero(np.diff((letters != 0).view(np.int8), prepend=0, append=0))
        self.begin, self.end = edge[::2], edge[1::2]
        self.text = np.searchsorted(ends, self.begin, side="right")
        self.count = np.bincount(self.text, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count

    def hashes(self) -> np.ndarray:
        if not len(self.begin):
            return np.empty(0, np.uint64)
        sizes = self.end - self.begin
        used = self.letters[self.letters != 0]
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(used)) - np.repeat(starts, sizes)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(sizes.max()), _POWER))
            return mixed(np.add.reduceat(_LETTER_CODE[used] * powers[place], starts))

    def joined(self, begin: int, end: int) -> str:
        """Words ``begin`` to ``end - 1`` with single spaces."""
        return b" ".join(
            self.letters[b:e].tobytes() for b, e in zip(self.begin[begin:end], self.end[begin:end])
        ).decode("utf-8", "replace")


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; other sizes never give the same on purpose."""
    return mixed(run_hashes(hashes, size) ^ np.uint64(size))


def _pieces(texts: pa.Array) -> Iterator[tuple[int, Words]]:
    """The words of consecutive texts, a few at a time, with the number of the first."""
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1])
    begin = 0
    while begin < len(texts):
        upto = np.cumsum(sizes[begin:], dtype=np.int64)
        count = max(1, int(np.searchsorted(upto, _PIECE_BYTES, side="right")))
        yield begin, Words(texts.slice(begin, count))
        begin += count


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, size, words``: the windows of every item, ``words`` with single spaces.

    Items without words, and those without an id, have none.
    """
    item_type = items.schema[item_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words in _pieces(batch.column("text")):
                rows = []
                for i, (begin, count) in enumerate(zip(words.first.tolist(), words.count.tolist())):
                    size = min(count, WINDOW_WORDS)
                    for at in range(begin, begin + count - size + 1 if count else begin):
                        rows.append((first + i, size, words.joined(at, at + size)))
                if rows:
                    which, sizes, texts = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("item_id").take(pa.array(which)), pa.array(sizes, pa.int32()), pa.array(texts)],
                        ["item_id", "size", "words"],
                    )

    rows = items.filter(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("item_id"), F.col(text_col).cast("binary").alias("text")
    )
    return rows.mapInArrow(cut, f"item_id {item_type}, size int, words string")


def _shingle_rows(rows: DataFrame, size_col: str, context: bool) -> DataFrame:
    """The shingles of ``words``, of ``size_col`` words each: ``shingle, place``, and the row.

    With ``context`` instead of all words those that a window around the shingle can have,
    and how many of them come before the shingle.
    """
    others = [f for f in rows.schema.fields if f.name not in ("words", size_col)]
    names = [f.name for f in others]
    before = WINDOW_WORDS - SHINGLE_WORDS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("words").cast(pa.binary())
            sizes = batch.column(size_col).to_numpy()
            for first, words in _pieces(texts):
                hashes = words.hashes()
                which, found, places, lefts, contexts = [], [], [], [], []
                for i, (begin, count) in enumerate(zip(words.first.tolist(), words.count.tolist())):
                    size = int(sizes[first + i])
                    own = shingles(hashes[begin : begin + count], size)
                    which += [first + i] * len(own)
                    found.append(own)
                    places += range(len(own))
                    if context:
                        wider = before if size == SHINGLE_WORDS else 0
                        for at in range(len(own)):
                            left = min(at, wider)
                            lefts.append(left)
                            end = min(count, at + size + wider)
                            contexts.append(words.joined(begin + at - left, begin + end))
                if not which:
                    continue
                arrays = [batch.column(n).take(pa.array(which)) for n in names]
                arrays += [
                    pa.array(np.concatenate(found).view(np.int64)), pa.array(places, pa.int64())
                ]
                if context:
                    arrays += [pa.array(lefts, pa.int32()), pa.array(contexts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, out)

    out = [*names, "shingle", "place", *(["before", "around"] if context else [])]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in others]
    fields += ["shingle bigint", "place bigint"]
    fields += ["before int", "around string"] if context else []
    return rows.mapInArrow(cut, ", ".join(fields))


def _stretches(docs: DataFrame, sizes: list[int], bits, id_type: str) -> DataFrame:
    """Every document with its words' number and the stretches that pass the filter."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            counts, found = [], [[] for _ in range(len(texts))]
            for first, words in _pieces(texts):
                counts.append(words.count)
                hashes = words.hashes()
                for size in sizes:
                    if len(hashes) < size:
                        continue
                    inside = words.text[size - 1 :] == words.text[: len(hashes) - size + 1]
                    hits = np.flatnonzero(inside & passed(bits.value, shingles(hashes, size)))
                    if not len(hits):
                        continue
                    cut = np.diff(words.text[hits]) != 0
                    # Windows of one short shingle don't go on from it.
                    cut |= True if size < SHINGLE_WORDS else np.diff(hits) != 1
                    edges = np.r_[0, np.flatnonzero(cut) + 1, len(hits)]
                    for begin, end in zip(hits[edges[:-1]].tolist(), (hits[edges[1:] - 1] + size).tolist()):
                        text = int(words.text[begin])
                        found[first + text].append(
                            {"size": size, "begin": begin - int(words.first[text]), "words": words.joined(begin, end)}
                        )
            count = np.concatenate(counts) if counts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(found, stretch)],
                ["row", "doc_id", "n_words", "stretches"],
            )

    stretch = pa.list_(pa.struct([("size", pa.int32()), ("begin", pa.int64()), ("words", pa.string())]))
    return docs.mapInArrow(scan, _FOUND.format(id_type=id_type))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """What each row of ``docs`` has of the items of ``benchmark``.

    ``doc_id, n_words, n_hit`` (words inside an occurrence of a window),
    ``n_items`` (items with such a window), ``items_sha256`` (of their ids, sorted
    as strings and joined by commas) and ``contaminated`` (whether any word is hit).

    A word is a run of digits, letters and bytes beyond ASCII, with A-Z as a-z.
    NULL texts have no words, an item with a NULL id is none, rows of one item id
    are one item, a NULL document id stays NULL and repeated rows stay repeated.
    Other columns are not read. The ids of one document's items are put together
    in one task, as their digest asks for; nothing else is collected by key.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    of_items = stage(item_windows(benchmark, item_col, item_text_col).distinct(), "item_windows")
    numbered = of_items.select("size", "words").distinct()
    windows = stage(numbered.withColumn("window", F.monotonically_increasing_id()), "windows")
    shingle_size = F.least("size", F.lit(SHINGLE_WORDS)).alias("shingle_size")
    keyed = windows.select("window", "size", shingle_size, "words")
    window_shingles = stage(_shingle_rows(keyed, "shingle_size", False), "window_shingles")
    sizes = sorted(r[0] for r in keyed.select("shingle_size").distinct().collect())
    bits = spark.sparkContext.broadcast(filter_bits(window_shingles.select("shingle")))

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("binary").alias("text"),
    )
    found = stage(_stretches(rows, sizes, bits, id_type), "found")
    stretches = (
        found.filter(F.size("stretches") > 0)
        .select("row", F.inline("stretches"))
        .select("row", F.col("size").alias("shingle_size"), "begin", "words")
    )
    candidates = stage(_shingle_rows(stretches, "shingle_size", True), "candidates")

    # The rarest shingle of each window; a window with one that no document has occurs nowhere.
    counts = candidates.groupBy("shingle").agg(F.count("*").alias("n"))
    rarest = (
        window_shingles.join(counts, "shingle", "left")
        .groupBy("window")
        .agg(
            F.min(F.coalesce("n", F.lit(0))).alias("n"),
            F.min_by(F.struct("shingle", "place"), F.struct(F.coalesce("n", F.lit(0)), "place")).alias("key"),
        )
        .filter("n > 0")
        .join(windows, "window")
        .select("window", "size", "words", F.col("key.shingle").alias("shingle"), F.col("key.place").alias("offset"))
    )
    around = F.split("around", " ")
    placed = candidates.join(rarest, "shingle").filter(
        (F.col("before") >= F.col("offset"))
        & (F.size(around) - F.col("before") + F.col("offset") >= F.col("size"))
    )
    here = F.slice(around, (F.col("before") - F.col("offset") + 1).cast("int"), F.col("size"))
    occurrences = stage(
        placed.filter(F.array_join(here, " ") == F.col("words")).select(
            "row", "window", (F.col("begin") + F.col("place") - F.col("offset")).alias("begin"), "size"
        ),
        "occurrences",
    )

    hit = _covered(occurrences.select("row", "begin", (F.col("begin") + F.col("size")).alias("end")).distinct())
    items = (
        occurrences.select("row", "window").distinct()
        .join(windows, "window")
        .join(of_items, ["size", "words"])
        .groupBy("row")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    joined = reduce(lambda a, b: a.join(b, "row", "left"), [found.drop("stretches"), hit, items])
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def _covered(spans: DataFrame) -> DataFrame:
    """``row, n_hit``: how many words the spans of each document cover together."""
    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    new = F.greatest(F.col("end") - F.greatest("begin", reached), F.lit(0))
    return spans.withColumn("new", new).groupBy("row").agg(F.sum("new").alias("n_hit"))
