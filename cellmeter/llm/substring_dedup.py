"""Passages that repeat across documents.

Two kinds of paragraphs are compared. Lines, runs of shorter lines and whole
blocks of lines up to an empty one, if they have ``LINE_WORDS`` words or more,
are banded by MinHash, whatever their line ends; colliding ones are joined, their
Jaccard similarity is verified, and near copies form components. A passage may also lie anywhere
inside longer lines, or go over several: so windows of ``WINDOW_WORDS`` words
are taken where the text itself marks a place (a shingle whose hash is the least
of ``MARK_WORDS`` in a row), which are the same places in every copy; equal
windows are copies. Any passage of ``WINDOW_WORDS + MARK_WORDS - 1`` = 51 words or more
contains such a window in each of its copies.

Of all copies of a paragraph, those in the document of least id stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage, temporary_stages
from .bit_filter import filter_bits, only_passed, passed
from .components import components
from .jaccard_join import (
    BLOCK_ITEMS,
    SIMILARITY,
    _with_text,
    set_print,
    similar_items,
    text_key,
)
from .words import SHINGLE_WORDS, distinct, hashed_texts, mixed, run_hashes, word_hashes

LINE_WORDS = 50
WINDOW_WORDS = 40
MARK_WORDS = 12

# Two lines of similarity 0.8 collide in one band of 4 values with probability
# 0.41, and in none of 14 with 0.0006.
BANDS = 14
BAND_ROWS = 4

_DOC = ["doc_id", "text_key"]


def _odd(count: int, salt: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(salt << 32)) | np.uint64(1)


_SIGNATURE_FACTORS = _odd(BANDS * BAND_ROWS, 3)
_BAND_FACTORS = _odd(BAND_ROWS, 4)


def _sliding(values: np.ndarray, length: int, extreme: np.ufunc) -> np.ndarray:
    """Least or largest of each ``length`` values in a row, by doubling the runs."""
    run, known = values, 1
    while 2 * known <= length:
        run, known = extreme(run[:-known], run[known:]), 2 * known
    rest = length - known
    return extreme(run[:-rest], run[rest:]) if rest else run


def window_starts(marks: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows of texts, and which text each is in.

    The texts' words are one after another, and end at ``ends``; ``marks`` are
    the shingles of all these words. A window begins at a shingle that is least
    among some MARK_WORDS in a row of its text.
    """
    if len(marks) < MARK_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    least = _sliding(marks, MARK_WORDS, np.minimum)
    # Shingles in a row that go over the end of a text have no least one.
    over = (ends[:, None] - np.arange(1, MARK_WORDS + SHINGLE_WORDS - 1)).ravel()
    least[over[(over >= 0) & (over < len(least))]] = 0
    outside = np.zeros(MARK_WORDS - 1, np.uint64)
    highest = _sliding(np.concatenate([outside, least, outside]), MARK_WORDS, np.maximum)
    starts = np.flatnonzero(highest == marks)
    which = np.searchsorted(ends, starts, "right")
    inside = starts + WINDOW_WORDS <= ends[which]
    return starts[inside], which[inside]


def marked_windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the windows of a text and two hashes of each."""
    marks = run_hashes(word_hashes(words), SHINGLE_WORDS)
    first, second, starts, _ = _windows_of(marks, np.array([len(words)]))
    return starts, first, second


_PARTS = np.arange(0, WINDOW_WORDS, SHINGLE_WORDS)
_WINDOW_FACTORS = (_odd(len(_PARTS), 1), _odd(len(_PARTS), 2))


_NO_WINDOWS = (np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32))


def _windows_of(marks: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Two hashes, of 64 and 32 bits, first word and number of windows of texts, as ``window_starts`` has them.

    A window is hashed as a row of shingles, which are its words.
    """
    starts, which = window_starts(marks, ends)
    inside = marks[starts[:, None] + _PARTS]
    with np.errstate(over="ignore"):
        first, second = (mixed((inside * f).sum(axis=1, dtype=np.uint64)) for f in _WINDOW_FACTORS)
    begins = np.concatenate([[0], ends[:-1]])
    return (
        first.view(np.int64),
        second.astype(np.uint32).view(np.int32),
        (starts - begins[which]).astype(np.int32),
        np.bincount(which, minlength=len(ends)),
    )


def _lists(ends: np.ndarray, columns: list[np.ndarray]) -> list[pa.Array]:
    """Columns of lists that end at the same places."""
    offsets = pa.array(ends, pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in columns]


# Shingles that are multiplied by all factors at once.
_MULTIPLIED = 1 << 10


def band_hashes(runs: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """One bucket per band and span, out of the MinHash signatures of spans of ``runs``.

    ``spans`` has begin and end of each; none is empty. They may overlap: each
    run counts once to the least of its part, between two ends of spans, and
    parts to spans.
    """
    if not len(spans):
        return np.empty((0, BANDS), np.uint64)
    begin, end = int(spans.min()), int(spans.max())
    blocks = np.arange(begin, end, _MULTIPLIED)
    parts = np.unique(np.concatenate([spans.ravel(), blocks, [end]]))
    edges = np.searchsorted(parts, [*blocks, end])
    with np.errstate(over="ignore"):
        # A last part of nothing, so that spans may end where the runs do.
        least = np.zeros((len(_SIGNATURE_FACTORS), len(parts)), np.uint64)
        for at, lo, hi in zip(blocks.tolist(), edges, edges[1:]):
            products = runs[at : min(at + _MULTIPLIED, end)] * _SIGNATURE_FACTORS[:, None]
            least[:, lo:hi] = np.minimum.reduceat(products, parts[lo:hi] - at, axis=1)
        sides = np.searchsorted(parts, spans).ravel()
        rows = np.minimum.reduceat(least, sides, axis=1)[:, ::2].T
        rows = rows.reshape(len(spans), BANDS, BAND_ROWS)
        values = (rows * _BAND_FACTORS).sum(axis=2, dtype=np.uint64)
        return mixed(values + np.arange(1, BANDS + 1, dtype=np.uint64))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        text_key(F.col(text_col)).alias("text_key"),
        F.col(text_col).cast("binary").alias("text"),
    )


# Documents that a worker describes at once.
_DESCRIBED_ROWS = 2_000


def _smaller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, max(batch.num_rows, 1), _DESCRIBED_ROWS):
            yield batch.slice(begin, _DESCRIBED_ROWS)


def _described(docs: DataFrame, line_words: int) -> DataFrame:
    """``doc_id, text_key, h1, h2, starts, lines`` of each document; stored.

    ``h1, h2, starts`` are arrays of the hashes and first words of its windows,
    ``lines`` its paragraphs of enough words with what is needed to compare
    them; ``several`` says that one has several lines.
    """
    schema = (
        "doc_id bigint, text_key binary, h1 array<bigint>, h2 array<int>, starts array<int>,"
        " lines array<struct<item: binary,"
        " line_key: binary, start: int, n_words: int, size: int, print: binary, several: boolean,"
        " buckets: array<bigint>>>"
    )
    kinds = [
        ("item", pa.binary()), ("line_key", pa.binary()), ("start", pa.int32()),
        ("n_words", pa.int32()), ("size", pa.int32()), ("print", pa.binary()), ("several", pa.bool_()),
        ("buckets", pa.list_(pa.int64())),
    ]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _smaller(batches):
            windows, n_windows, line_ends = [_NO_WINDOWS], [[0]], [0]
            columns = [[], [], [], [], [], [], [], [np.empty((0, BANDS), np.uint64)]]
            for texts, hashes, ends in hashed_texts(t.as_py() or b"" for t in batch.column(2)):
                runs = run_hashes(hashes, SHINGLE_WORDS)
                *found_windows, counts = _windows_of(runs, ends)
                windows.append(found_windows)
                n_windows.append(counts)
                spans = []
                begin = 0
                for data, end in zip(texts, ends.tolist()):
                    found = _paragraphs(data, end - begin, line_words)
                    line_ends.append(line_ends[-1] + len(found))
                    for start, count, line in found:
                        at = begin + start
                        spans.append((at, at + count - SHINGLE_WORDS + 1))
                        shingles = distinct(runs[slice(*spans[-1])])
                        columns[0].append(hashlib.blake2b(shingles, digest_size=16).digest())
                        columns[1].append(hashlib.md5(line).digest())
                        columns[2].append(start)
                        columns[3].append(count)
                        columns[4].append(len(shingles))
                        columns[5].append(set_print(shingles))
                        columns[6].append(b"\n" in line)
                    begin = end
                columns[7].append(band_hashes(runs, np.array(spans, np.int64).reshape(-1, 2)))
            window_ends = np.cumsum(np.concatenate(n_windows))
            buckets = pa.array(np.concatenate(columns.pop()).ravel().view(np.int64))
            offsets = pa.array(np.arange(0, len(buckets) + 1, BANDS), pa.int32())
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, kinds)]
            arrays.append(pa.ListArray.from_arrays(offsets, buckets))
            lines = pa.StructArray.from_arrays(arrays, names=[n for n, _ in kinds])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *_lists(window_ends, [np.concatenate(c) for c in zip(*windows)]),
                    pa.ListArray.from_arrays(pa.array(line_ends, pa.int32()), lines),
                ],
                ["doc_id", "text_key", "h1", "h2", "starts", "lines"],
            )

    return stage(docs.mapInArrow(describe, schema), "described")


def _paragraphs(data: bytes, n_words: int, line_words: int) -> list[tuple[int, int, bytes]]:
    """First word, number of words and text of each paragraph of enough words.

    These are the long lines, the runs of shorter lines, and the blocks up to an
    empty line; the same lines are one paragraph.
    """
    found: dict[tuple[int, int], bytes] = {}
    if n_words < line_words:
        return []

    def add(start: int, lines: list[bytes], count: int) -> None:
        if count >= line_words:
            found.setdefault((start, count), b"\n".join(lines))

    start = 0
    block, block_words = [], 0
    run, run_words = [], 0
    for line in [*data.split(b"\n"), b""]:
        count = len(line.split())
        if run and not 0 < count < line_words:
            add(start - run_words, run, run_words)
            run, run_words = [], 0
        if count == 0:
            add(start - block_words, block, block_words)
            block, block_words = [], 0
            continue
        if count >= line_words:
            add(start, [line], count)
        else:
            run.append(line)
            run_words += count
        block.append(line)
        block_words += count
        start += count
    return [(start, count, text) for (start, count), text in found.items()]


def _paragraph_texts(docs: DataFrame, line_words: int) -> DataFrame:
    """``doc_id, text`` of each paragraph of enough words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                data = text.as_py() or b""
                found = [x for _, _, x in _paragraphs(data, len(data.split()), line_words)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc.as_py()] * len(found), pa.int64()), pa.array(found, pa.binary())],
                    ["doc_id", "text"],
                )

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id bigint, text binary")


def common_lines(data: bytes, start: int, count: int, other: bytes) -> tuple[int, int]:
    """First word and number of words of a paragraph without outer lines of which ``other`` has nothing."""
    own = run_hashes(word_hashes(data.split())[start : start + count], SHINGLE_WORDS)
    there = run_hashes(word_hashes(other.split()), SHINGLE_WORDS)
    shared = np.zeros(count, bool)
    places = np.flatnonzero(np.isin(own, there))
    for i in range(SHINGLE_WORDS):
        shared[places + i] = True
    sizes = [len(line.split()) for line in data.split(b"\n")]
    ends = np.cumsum(sizes) - start
    spans = [(e - n, e) for e, n in zip(ends.tolist(), sizes) if n and n <= e <= count]
    kept = [(b, e) for b, e in spans if shared[b:e].any()]
    if not kept:
        return start, count
    return start + kept[0][0], kept[-1][1] - kept[0][0]


def _windows(described: DataFrame, often: DataFrame) -> DataFrame:
    """``doc_id, text_key, h1, h2, start``: the windows whose ``h1`` may be in ``often``."""
    bits = described.sparkSession.sparkContext.broadcast(filter_bits(often))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2, start = (batch.column(i).flatten().to_numpy() for i in (2, 3, 4))
            kept = np.flatnonzero(passed(bits.value, h1.view(np.uint64)))
            if not len(kept):
                continue
            doc = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths().to_numpy())
            which = pa.array(doc[kept])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), batch.column(1).take(which)]
                + [pa.array(c[kept]) for c in (h1, h2, start)],
                [*_DOC, "h1", "h2", "start"],
            )

    schema = "doc_id bigint, text_key binary, h1 bigint, h2 int, start int"
    return described.select(*_DOC, "h1", "h2", "starts").mapInArrow(cut, schema)


def _bucket_rows(items: DataFrame, often: DataFrame) -> DataFrame:
    """``item, bucket``: the items' buckets that may be in ``often``; others are left out before the shuffle."""
    bits = items.sparkSession.sparkContext.broadcast(filter_bits(often.select("bucket")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = batch.column(1).flatten().to_numpy()
            kept = np.flatnonzero(passed(bits.value, bucket.view(np.uint64)))
            item = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(item[kept])), pa.array(bucket[kept])],
                ["item", "bucket"],
            )

    return items.select("item", "buckets").mapInArrow(cut, "item binary, bucket bigint")


def repeated_windows(described: DataFrame) -> DataFrame:
    """``doc_id, text_key, start, n_words, first, n`` of windows that several documents have.

    Windows whose first hash one document alone has are left out before anything
    but these hashes is shuffled.
    """
    marks = described.select(F.explode(F.array_distinct("h1")).alias("h1"))
    often = marks.groupBy("h1").agg(F.count("*").alias("n")).filter("n > 1").select("h1")
    # Stored, so that the join below may split the partitions of a hot window.
    shared = stage(_windows(described, stage(often, "often")), "windows")
    firsts = (
        shared.groupBy("h1", "h2")
        .agg(
            F.min(F.struct(*_DOC)).alias("first"),
            F.max(F.struct(*_DOC)).alias("_last"),
            F.count("*").alias("n"),
        )
        .filter(~F.col("first").eqNullSafe(F.col("_last")))
        .drop("_last")
    )
    return shared.join(stage(firsts, "firsts"), ["h1", "h2"]).select(
        *_DOC, "start", F.lit(WINDOW_WORDS).alias("n_words"), "first", "n"
    )


def similar_lines(
    docs: DataFrame,
    described: DataFrame,
    similarity: float = SIMILARITY,
    line_words: int = LINE_WORDS,
) -> DataFrame:
    """``doc_id, text_key, start, n_words, first, n`` of paragraphs with copies or near copies elsewhere.

    Outer lines of a paragraph stay out of it if the first document has nothing
    of them.
    """
    lines = described.select(*_DOC, F.explode("lines").alias("l")).select(*_DOC, "l.*")
    items = stage(
        lines.groupBy("item").agg(
            F.min(F.struct("doc_id", F.col("line_key").alias("text_key"))).alias("holder"),
            F.min(F.struct(*_DOC)).alias("first"),
            F.max(F.struct(*_DOC)).alias("last"),
            F.count("*").alias("copies"),
            F.first("size").alias("size"),
            F.first("print").alias("print"),
            F.first("buckets").alias("buckets"),
        ),
        "line_items",
    )
    rows = items.select(F.explode("buckets").alias("bucket"))
    often = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    often = stage(often, "often_buckets")
    shared = _bucket_rows(items, often).join(often, "bucket")
    buckets = stage(shared.select("bucket", "item", "n"), "line_buckets")
    # Only paragraphs that there is something to compare with are brought.
    held = buckets.select("item").distinct().join(items, "item")
    holders = stage(held.select("holder.doc_id", "holder.text_key").distinct(), "holders")
    texts = _paragraph_texts(_only(docs, holders.select("doc_id").distinct()), line_words)
    texts = _agreeing(texts.withColumn("text_key", text_key(F.col("text"))), holders)
    texts = stage(texts, "line_texts")
    links = stage(similar_items(buckets, items, texts, similarity, BLOCK_ITEMS), "line_links")
    roots = components(links.select(F.col("item").alias("a"), F.col("head").alias("b")))
    members = (
        items.select("item", "first", "last")
        .join(roots.withColumnRenamed("node", "item"), "item", "left")
        .withColumn("root", F.coalesce("root", "item"))
    )
    classes = (
        members.groupBy("root")
        .agg(F.min("first").alias("first"), F.max("last").alias("_last"))
        .filter(~F.col("first").eqNullSafe(F.col("_last")))
        .drop("_last")
    )
    per_item = members.select("item", "root").join(classes, "root")
    # A line and its block may be in one class; they are one copy.
    outer_first = Window.partitionBy("root", *_DOC).orderBy("start", F.desc("n_words"))
    end = F.col("start") + F.col("n_words")
    reached = F.max(end).over(outer_first.rowsBetween(Window.unboundedPreceding, -1))
    found = stage(
        lines.select(*_DOC, "item", "start", "n_words", "several")
        .join(per_item, "item")
        .distinct()
        .withColumn("_outer", F.coalesce(reached < end, F.lit(True)))
        .filter("_outer")
        .drop("_outer"),
        "line_classes",
    )
    counts = stage(found.groupBy("root").agg(F.count("*").alias("n")), "line_counts")
    counted = found.join(counts, "root").drop("root")
    # Paragraphs with the shingles of the first document's have all lines of it.
    same = counted.filter(~_removed()).select("item", F.lit(True).alias("_same")).distinct()
    marked = counted.join(same, "item", "left").withColumn(
        "_trim", F.col("several") & _removed() & F.col("_same").isNull()
    )
    marked = stage(marked.drop("item", "several", "_same"), "similar_lines")
    whole = marked.filter(~F.col("_trim")).drop("_trim")
    return whole.unionByName(_trimmed(marked.filter("_trim").drop("_trim"), docs))


def _only(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` that agree with a row of ``wanted``, a stored table, in all its columns.

    Those that may do are stored first, so that no task has two Python workers.
    """
    key = F.xxhash64(*wanted.columns)
    return _agreeing(stage(only_passed(docs, key, wanted.select(key.alias("h"))), "passed"), wanted)


def _agreeing(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    keys = wanted.select(*[F.col(c).alias(f"_wanted_{c}") for c in wanted.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_wanted_{c}")) for c in wanted.columns]
    return rows.join(keys, reduce(Column.__and__, same), "left_semi")


def _trimmed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` with the part of their paragraphs that ``common_lines`` gives."""
    wanted = rows.select(*_DOC).union(rows.select("first.*")).distinct()
    docs = stage(_only(docs, stage(wanted, "wanted")).distinct(), "wanted_texts")
    own = _with_text(rows.withColumn("holder", F.struct(*_DOC)), docs)
    both = _with_text(
        own.withColumnRenamed("text", "own").withColumn("holder", F.col("first")), docs
    )

    @F.arrow_udf("struct<start: int, n_words: int>")
    def common(own: pa.Array, start: pa.Array, count: pa.Array, first: pa.Array) -> pa.Array:
        spans = [
            common_lines(d.as_py(), s.as_py(), n.as_py(), f.as_py())
            for d, s, n, f in zip(own, start, count, first)
        ]
        return pa.array(
            [{"start": s, "n_words": n} for s, n in spans],
            pa.struct([("start", pa.int32()), ("n_words", pa.int32())]),
        )

    return both.withColumn("_span", common("own", "start", "n_words", "text")).select(
        *_DOC, "_span.start", "_span.n_words", "first", "n"
    )


def _of_paragraphs(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    line_words: int,
    result: Callable[[DataFrame], DataFrame],
    name: str,
) -> DataFrame:
    """What ``result`` makes of the repeated paragraphs, some of which may come repeatedly; stored."""
    spark = docs.sparkSession
    narrow = _narrow(docs, id_col, text_col)
    with temporary_stages(spark) as keep:
        described = _described(narrow, line_words)
        with temporary_stages(spark) as keep_lines:
            lines = similar_lines(narrow, described, line_words=line_words)
            lines = keep_lines(lines, "repeated_lines")
        return keep(result(repeated_windows(described).unionByName(lines)), name)


def repeated_paragraphs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    line_words: int = LINE_WORDS,
) -> DataFrame:
    """``doc_id, text_key, start, n_words, first, n``: paragraphs that several documents have; stored.

    ``start`` is the number of the first word in the text, ``first`` the document
    whose copy stays, ``n`` the number of copies.
    """
    return _of_paragraphs(docs, id_col, text_col, line_words, DataFrame.distinct, "repeated")


def _removed() -> Column:
    return ~F.struct(*_DOC).eqNullSafe(F.col("first"))


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    line_words: int = LINE_WORDS,
) -> DataFrame:
    """``doc_id, begin_word, n_words, class_id, n_copies, removed`` of each repeated passage.

    A passage is what overlapping or adjoining repeated paragraphs of a document
    cover. ``class_id`` is the least id among the documents that keep one of
    them, ``n_copies`` the largest number of copies, and ``removed`` says whether
    a part of it goes. Rows that are equal in id and text are one document; a
    NULL id is one like others, and first of all. NULL and empty texts have no
    passages, nor have texts that no other document shares 40 words with.
    ``line_words`` is the least length of a paragraph that is compared as one.
    """
    return _of_paragraphs(docs, id_col, text_col, line_words, _passages, "passages")


def _passages(paragraphs: DataFrame) -> DataFrame:
    """The passages of ``repeated_passages``, out of paragraphs that may be there repeatedly."""
    # Only what is needed of them is shuffled.
    paragraphs = paragraphs.select(
        *_DOC,
        "start",
        (F.col("start") + F.col("n_words")).alias("end"),
        F.col("first.doc_id").alias("class_id"),
        "n",
        _removed().alias("removed"),
    )
    # One document's paragraphs are no more than its words.
    in_order = Window.partitionBy(*_DOC).orderBy("start")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begun = paragraphs.withColumn(
        "_new", F.when(F.col("start") > F.coalesce(reached, F.lit(-1)), 1).otherwise(0)
    ).withColumn("_passage", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        begun.groupBy(*_DOC, "_passage")
        .agg(
            F.min("start").cast("bigint").alias("begin_word"),
            (F.max("end") - F.min("start")).cast("bigint").alias("n_words"),
            F.min("class_id").alias("class_id"),
            F.max("n").cast("bigint").alias("n_copies"),
            F.max("removed").alias("removed"),
        )
        .drop("text_key", "_passage")
    )


def _removals(paragraphs: DataFrame) -> DataFrame:
    """``doc_id, text_key, spans``: first words of removed paragraphs, and those behind them."""
    span = F.struct(F.col("start").alias("begin"), (F.col("start") + F.col("n_words")).alias("end"))
    return paragraphs.filter(_removed()).groupBy(*_DOC).agg(F.collect_set(span).alias("spans"))


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def without_words(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the words from ``begin`` to before ``end`` of each span.

    What was on two sides of a gap stays on two lines if a line ended there.
    """
    places = [m.span() for m in _WORD.finditer(data)]
    keep = np.ones(len(places) + 1, bool)
    for begin, end in spans:
        keep[begin:end] = False
    out, at, gap = [], 0, False
    for i, (begin, end) in enumerate(places):
        if not keep[i]:
            gap = True
            continue
        space = data[at:begin]
        if gap:
            space = b"\n" if b"\n" in data[at:begin] and out else b" " if out else b""
        out.append(space + data[begin:end])
        at, gap = end, False
    if not gap:
        out.append(data[at:])
    return b"".join(out)


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
) -> DataFrame:
    """``docs`` with the later copies of repeated passages cut out of the texts.

    Documents that lose nothing stay as they are; those that have no word left
    go. ``length_col``, if there is one, gets the new length in characters.
    """
    spans = _of_paragraphs(docs, id_col, text_col, LINE_WORDS, _removals, "removals")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, removals: pa.Array) -> pa.Array:
        return pa.array(
            [
                None
                if (data := t.as_py()) is None
                else without_words(data, [(s["begin"], s["end"]) for s in r.as_py()]).decode()
                for t, r in zip(texts, removals)
            ],
            pa.string(),
        )

    # Otherwise the filter on the new text below would have texts cut twice, by two workers of a task.
    cut = cut.asNondeterministic()
    doc, no_doc, key, removals = (f"_cut_{c}" for c in ("doc", "no_doc", "key", "spans"))
    marked = docs.withColumns(
        {
            doc: F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)),
            no_doc: F.col(id_col).isNull(),
            key: text_key(F.col(text_col)),
        }
    )
    wanted = spans.select(
        F.coalesce("doc_id", F.lit(0)).alias(doc),
        F.col("doc_id").isNull().alias(no_doc),
        F.col("text_key").alias(key),
        F.col("spans").alias(removals),
    )
    both = marked.join(wanted, [doc, no_doc, key], "left")
    touched = F.col(removals).isNotNull()
    whole = F.when(touched, F.col(text_col).cast("binary"))
    text = F.when(touched, cut(whole, F.col(removals))).otherwise(F.col(text_col))
    changed = both.withColumn(text_col, text)
    if length_col is not None:
        kind = docs.schema[length_col].dataType
        length = F.when(touched, F.length(F.col(text_col)).cast(kind))
        changed = changed.withColumn(length_col, length.otherwise(F.col(length_col)))
    some_word = F.col(text_col).rlike("[^\\x20\\x09-\\x0D]")
    return changed.filter(~touched | some_word).select(*docs.columns)
