"""Jaccard self-join of texts on word shingles, by chosen paths.

Texts with the same set of shingles are one item. In each of several runs an
item goes to a bucket for each of a few of its shingles, sampled by a hash that
all items share: similar sets choose the same ones. Buckets that are too large
are split again by further chosen shingles, unless they hardly fall apart; small
ones are compared pair by pair. What a run misses, the next ones find.

A pair that meets in several buckets belongs to the one of least number, and is
verified there, on the whole texts. Pairs are never rows: a bucket returns the
number of links of each item and the head of its part of the bucket. A bucket
that stays large is a group of near copies; it is cut into blocks, and pairs of
blocks are compared by different tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import stage, temporary_stages
from .bit_filter import only_passed
from .components import components
from .groups import by_group
from .words import SHINGLE_WORDS, mixed, shingle_set, shingle_sets, word_hashes

SIMILARITY = 0.8
# A set chooses CHOSEN of its shingles in a run, on average. Two sets of similarity
# 0.8 have 8/9 of them in common, so a run misses them with probability
# exp(-16/9) = 0.17 where buckets are small, and 0.25 after three levels.
RUNS = 7
CHOSEN = 2.0
DEPTH = 3
BUCKET_ITEMS = 200
BLOCK_ITEMS = 512

_KEY = ["doc_id", "text_key"]


def text_key(text: Column) -> Column:
    """Digest of a text, to find it again."""
    return F.unhex(F.md5(text.cast("binary")))


def _threshold(size: int) -> np.uint64:
    return np.uint64(min(CHOSEN / max(size, 1), 1.0) * (2**64 - 1025))


def _children(shingles: np.ndarray, path: np.uint64, threshold: np.uint64) -> np.ndarray:
    """Buckets below ``path`` that a set goes to."""
    factor = mixed(np.array([path], np.uint64))[0] | np.uint64(1)
    with np.errstate(over="ignore"):
        places = shingles * factor
    return mixed(places[places <= threshold] ^ path)


def chosen_paths(shingles: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """Distinct buckets of a set below all of ``paths``."""
    threshold = _threshold(len(shingles))
    found = [_children(shingles, p, threshold) for p in paths]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def _roots(runs: int) -> np.ndarray:
    return mixed(np.arange(1, runs + 1, dtype=np.uint64))


def text_shingles(data: bytes | None) -> np.ndarray:
    return shingle_set(word_hashes((data or b"").split()), SHINGLE_WORDS)


def set_print(shingles: np.ndarray) -> bytes:
    """Bits of a set, two or more for each member; sets of about one size have as many or twice as many."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    marks = np.zeros(bits, bool)
    marks[shingles & np.uint64(bits - 1)] = True
    return np.packbits(marks).tobytes()


# Marks of prints that are held at once.
_MARKS = 1 << 22


def similar_prints(prints: list[bytes], size: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs that may have the similarity by their prints, and at most twice the size; none that has is left out.

    The union of two sets is at least as large as the union of their prints.
    """
    n = len(prints)
    out = np.zeros((n, n), bool)
    length = np.array([len(p) for p in prints])
    for width in np.unique(length).tolist():
        own, wider = np.flatnonzero(length == width), np.flatnonzero(length == 2 * width)
        both = np.concatenate([own, wider])
        # A print folds into one of half the bits: its two halves laid over each other.
        narrow = [np.frombuffer(prints[i], np.uint8) for i in own]
        narrow += [np.bitwise_or(*np.frombuffer(prints[i], np.uint8).reshape(2, width)) for i in wider]
        grid = np.stack(narrow)
        shared = np.zeros((len(own), len(both)))
        count = np.zeros(len(both))
        step = max(1, _MARKS // (8 * len(both)))
        for begin in range(0, width, step):
            marks = np.unpackbits(grid[:, begin : begin + step], axis=1).astype(np.float32)
            shared += marks[: len(own)] @ marks.T
            count += marks.sum(axis=1)
        union = count[: len(own), None] + count[None, :] - shared
        fits = size[own][:, None] + size[both][None, :] >= (1 + similarity) * union - 1e-6
        out[np.ix_(own, both)] |= fits
        out[np.ix_(both, own)] |= fits.T
    return out


def _signed(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


def described(docs: DataFrame, runs: int = RUNS) -> DataFrame:
    """``doc_id, text_key, item, size, print, buckets`` of every row with ``doc_id, text``.

    ``item`` is a digest of the set of shingles; NULL where there are no words.
    """
    schema = (
        "doc_id bigint, text_key binary, item binary, size int, print binary, buckets array<bigint>"
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        roots = _roots(runs)
        for batch in batches:
            items, sizes, prints, buckets = [], [], [], []
            for text in batch.column(2):
                shingles = text_shingles(text.as_py())
                sizes.append(len(shingles))
                prints.append(set_print(shingles))
                items.append(
                    hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                    if len(shingles)
                    else None
                )
                buckets.append(_signed(chosen_paths(shingles, roots)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(items, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(prints, pa.binary()),
                    pa.array(buckets, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "item", "size", "print", "buckets"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint"),
        text_key(F.col("text")).alias("text_key"),
        F.col("text").cast("binary").alias("text"),
    ).mapInArrow(describe, schema)


def _with_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds the text of each row's holder, a document of the item; ``rows`` are stored.

    Only documents that may be holders are shuffled. They are stored first, so that
    no task has the filter's Python worker and that of the next step at once.
    """
    key_hash = F.xxhash64(F.coalesce(F.col("holder.text_key"), F.lit(b"")))
    wanted_keys = rows.select(key_hash.alias("h"))
    own_hash = F.xxhash64(F.coalesce(text_key(F.col("text")), F.lit(b"")))
    held = stage(only_passed(docs.select("doc_id", "text"), own_hash, wanted_keys), "held_texts")
    texts = held.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("_doc"),
        F.col("doc_id").isNull().alias("_no_doc"),
        text_key(F.col("text")).alias("_key"),
        F.col("text").cast("binary").alias("text"),
    )
    wanted = rows.withColumns(
        {
            "_doc": F.coalesce("holder.doc_id", F.lit(0)),
            "_no_doc": F.col("holder.doc_id").isNull(),
            "_key": F.col("holder.text_key"),
        }
    )
    return wanted.join(texts, ["_doc", "_no_doc", "_key"]).drop("_doc", "_no_doc", "_key", "holder")


def _split(large: DataFrame, items: DataFrame, docs: DataFrame) -> DataFrame:
    """``item, parent, bucket``: the buckets below those of ``large``; stored."""
    schema = "item binary, below array<struct<parent: bigint, bucket: bigint>>"
    entry = pa.list_(pa.struct([("parent", pa.int64()), ("bucket", pa.int64())]))

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, below = [], []
            item_at, paths_at, text_at = (
                batch.column(batch.schema.get_field_index(c)) for c in ("item", "paths", "text")
            )
            for item, paths, text in zip(item_at, paths_at, text_at):
                shingles = text_shingles(text.as_py())
                ids.append(item.as_py())
                below.append(
                    [
                        {"parent": path, "bucket": bucket}
                        for path in paths.as_py()
                        for bucket in _signed(
                            chosen_paths(shingles, np.array([path], np.int64).view(np.uint64))
                        )
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(below, entry)], ["item", "below"]
            )

    # An item is in a few buckets of each run, whatever their size.
    paths = large.groupBy("item").agg(F.collect_set("bucket").alias("paths"))
    wanted = stage(paths.join(items.select("item", "holder"), "item"), "split")
    found = _with_text(wanted, docs).select("item", "paths", "text").mapInArrow(descend, schema)
    return stage(found.select("item", F.inline("below")).distinct(), "children")


def _dense(large: DataFrame, children: DataFrame) -> DataFrame:
    """``bucket`` of those that are still half there in one bucket below; stored.

    Their items are alike, and splitting would only repeat them.
    """
    sizes = children.groupBy("parent", "bucket").agg(F.count("*").alias("below"))
    most = sizes.groupBy(F.col("parent").alias("bucket")).agg(F.max("below").alias("most"))
    whole = large.groupBy("bucket").agg(F.first("n").alias("n"))
    return stage(whole.join(most, "bucket").filter("2 * most > n").select("bucket"), "dense")


def leaves(items: DataFrame, docs: DataFrame, depth: int, bucket_items: int) -> DataFrame:
    """``bucket, item, n``: the buckets to compare, of two items or more.

    Large buckets are split up to ``depth`` levels, but for those of near copies.
    """
    rows = items.select("item", F.explode("buckets").alias("bucket"))
    found = []
    for level in range(1, depth + 1):
        counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        shared = stage(rows.join(counts, "bucket").select("bucket", "item", "n"), "buckets")
        large = shared.filter(F.col("n") > bucket_items)
        if level == depth or large.isEmpty():
            found.append(shared)
            break
        children = _split(large, items, docs)
        dense = _dense(large, children)
        found.append(shared.filter(F.col("n") <= bucket_items))
        found.append(large.join(dense, "bucket", "left_semi"))
        rows = children.join(
            dense.withColumnRenamed("bucket", "parent"), "parent", "left_anti"
        ).select("item", "bucket")
    return reduce(DataFrame.unionByName, found)


def _blocks(rows: DataFrame, block_items: int) -> DataFrame:
    """Each row once for every pair of blocks that its own block is part of."""
    blocks = F.ceil(F.col("n") / F.lit(block_items)).cast("int")
    own = rows.withColumn(
        "block", F.pmod(F.xxhash64("item", "bucket"), blocks).cast("int")
    ).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return own.withColumns(
        {"first": F.least("block", "_other"), "second": F.greatest("block", "_other")}
    ).drop("_other", "n")


def _belongs(numbers: list[list[int]], bucket: int) -> np.ndarray:
    """Which pairs have no bucket of a lesser number in common."""
    pairs = np.ones((len(numbers), len(numbers)), bool)
    members = defaultdict(list)
    for i, own in enumerate(numbers):
        for b in own:
            if b < bucket:
                members[b].append(i)
    for together in members.values():
        if len(together) > 1:
            pairs[np.ix_(together, together)] = False
    return pairs


def candidates(group: pa.Table, similarity: float) -> np.ndarray:
    """Pairs of a group that are its own and whose sizes allow the similarity; above the diagonal."""
    block = group.column("block").to_numpy()
    size = group.column("size").to_numpy().astype(np.float64)
    pairs = _belongs(group.column("numbers").to_pylist(), group.column("bucket")[0].as_py())
    pairs &= np.minimum.outer(size, size) >= similarity * np.maximum.outer(size, size)
    if group.column("first")[0].as_py() != group.column("second")[0].as_py():
        pairs &= block[:, None] != block[None, :]
    return np.triu(pairs, 1)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def candidate_pairs(batch: pa.RecordBatch, at: np.ndarray, similarity: float) -> np.ndarray:
    """First rows of those groups of two rows that are a pair for ``candidates``.

    Most buckets hold two items; this is the same without matrices.
    """
    size, block, first, second = (
        _column(batch, c).to_numpy() for c in ("size", "block", "first", "second")
    )
    size = size.astype(np.float64)
    one, two = size[at], size[at + 1]
    fits = np.minimum(one, two) >= similarity * np.maximum(one, two)
    fits &= (first[at] == second[at]) | (block[at] != block[at + 1])
    lists = _column(batch, "numbers")
    ends, numbers = lists.offsets.to_numpy().tolist(), lists.values.to_numpy()
    bucket = _column(batch, "bucket").to_numpy()
    out = []
    for i in at[fits].tolist():
        one, two = numbers[ends[i] : ends[i + 1]], numbers[ends[i + 1] : ends[i + 2]]
        if len(one) == 1 or len(two) == 1:  # the bucket itself
            out.append(i)
        elif not any(b < bucket[i] for b in set(one.tolist()).intersection(two.tolist())):
            out.append(i)
    return np.array(out, np.int64)


def _prints_agree(one: bytes, two: bytes, total: int, similarity: float) -> bool:
    """What ``similar_prints`` says of two sets of ``total`` members."""
    one, two = sorted((one, two), key=len)
    if len(two) not in (len(one), 2 * len(one)):
        return False
    narrow = int.from_bytes(one)
    # A print folds into one of half the bits, as in ``similar_prints``.
    for begin in range(0, len(two), len(one)):
        narrow |= int.from_bytes(two[begin : begin + len(one)])
    return total >= (1 + similarity) * narrow.bit_count() - 1e-6


def promising_pairs(batch: pa.RecordBatch, at: np.ndarray, similarity: float) -> np.ndarray:
    """First rows of those groups of two rows that are a pair for ``candidates`` and ``similar_prints``."""
    at = candidate_pairs(batch, at, similarity)
    size, prints = _column(batch, "size").to_numpy(), _column(batch, "print")
    totals = (size[at].astype(np.int64) + size[at + 1]).tolist()
    sides = (prints.take(pa.array(x)).to_pylist() for x in (at, at + 1))
    kept = [_prints_agree(a, b, n, similarity) for a, b, n in zip(*sides, totals)]
    return at[np.array(kept, bool)]


def promising_pair(group: pa.Table, similarity: float) -> bool:
    """Whether the two rows of a group are a pair, as ``promising_pairs`` has it."""
    batch = group.combine_chunks().to_batches()[0]
    return len(promising_pairs(batch, np.array([0]), similarity)) > 0


def _common_of_two(one: np.ndarray, two: np.ndarray) -> int:
    both = np.concatenate([one, two])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def common_counts(sets: list[np.ndarray], columns: int = 4_096) -> np.ndarray:
    """Size of the intersection of each two sets of distinct numbers."""
    n = len(sets)
    if n == 2:  # as most are
        return np.full((2, 2), float(_common_of_two(*sets)))
    values = np.concatenate(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    _, which, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[which] > 1
    rows, which = rows[shared], np.unique(which[shared], return_inverse=True)[1]
    total = np.zeros((n, n), np.float64)
    order = np.argsort(which, kind="stable")
    rows, which = rows[order], which[order]
    for begin in range(0, int(which[-1]) + 1 if len(which) else 0, columns):
        lo, hi = np.searchsorted(which, [begin, begin + columns])
        marks = np.zeros((n, min(columns, which[hi - 1] + 1 - begin)), np.float32)
        marks[rows[lo:hi], which[lo:hi] - begin] = 1.0
        total += marks @ marks.T
    return total


def linked(sets: list[np.ndarray], pairs: np.ndarray, similarity: float) -> np.ndarray:
    """Those of ``pairs`` whose sets have the similarity, exactly."""
    size = np.array([len(s) for s in sets], np.float64)
    common = common_counts(sets)
    together = size[:, None] + size[None, :] - common
    return pairs & (common >= similarity * together - 1e-9)


def _heads(links: np.ndarray) -> np.ndarray:
    """The least member of each one's part, along the links."""
    head = np.arange(len(links))
    for i, j in zip(*np.nonzero(links)):
        a, b = i, j
        while head[a] != a:
            head[a] = a = head[head[a]]
        while head[b] != b:
            head[b] = b = head[head[b]]
        if a != b:
            head[max(a, b)] = min(a, b)
    for i in range(len(head)):
        head[i] = head[head[i]]
    return head


def similar_items(
    found: DataFrame,
    items: DataFrame,
    docs: DataFrame,
    similarity: float = SIMILARITY,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``item, links, head`` per bucket that gives an item links: documents it is linked to.

    ``found`` has ``bucket, item, n``, stored; ``items`` has ``item, size, print, copies,
    holder``, the last a document (id and text key) of ``docs``.
    """
    numbers = found.groupBy("item").agg(F.collect_set("bucket").alias("numbers"))
    known = stage(
        numbers.join(items.select("item", "size", "print", "copies", "holder"), "item"), "known_items"
    )
    rows = _blocks(found, block_items).join(known, "item")
    keys = ["bucket", "first", "second"]
    entry = "bucket bigint, first int, second int, block int, item binary"

    def promising(group: pa.Table) -> Iterator[pa.RecordBatch]:
        if group.num_rows == 2:
            if promising_pair(group, similarity):
                yield from group.select([*keys, "block", "item"]).combine_chunks().to_batches()
            return
        pairs = candidates(group, similarity)
        some = np.flatnonzero(pairs.any(0) | pairs.any(1))
        if len(some):
            size = group.column("size").to_numpy().astype(np.float64)
            prints = group.column("print").to_pylist()
            near = similar_prints([prints[i] for i in some], size[some], similarity)
            pairs = pairs[np.ix_(some, some)] & near
            some = some[pairs.any(0) | pairs.any(1)]
        if len(some):
            yield from group.select([*keys, "block", "item"]).take(some).combine_chunks().to_batches()

    def promising_two(batch: pa.RecordBatch, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = promising_pairs(batch, at, similarity)
        if len(at):
            both = pa.array(np.stack([at, at + 1], axis=1).ravel())
            yield batch.select([*keys, "block", "item"]).take(both)

    # Numbers and prints first: only items with a pair to verify bring their text.
    narrow = rows.select(*keys, "block", "item", "size", "print", "numbers")
    chosen = stage(by_group(narrow, keys, promising, entry, promising_two), "candidates")
    full = _with_text(stage(chosen.join(known.drop("print"), "item"), "promising"), docs).select(
        *keys, "block", "item", "size", "copies", "numbers", "text"
    )

    def verify(group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = group.column("item").to_pylist()
        first = {}
        for i, item in enumerate(ids):  # a holder's row may be there repeatedly
            first.setdefault(item, i)
        if len(first) < len(ids):
            group, ids = group.take(list(first.values())), list(first)
        pairs = candidates(group, similarity)
        if not pairs.any():
            return
        sets = list(shingle_sets(t.as_py() or b"" for t in group.column("text")))
        links = linked(sets, pairs, similarity)
        copies = group.column("copies").to_numpy()
        counts = (links | links.T) @ copies
        head = _heads(links)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[i] for i in some], pa.binary()),
                pa.array(counts[some], pa.int64()),
                pa.array([ids[head[i]] for i in some], pa.binary()),
            ],
            ["item", "links", "head"],
        )

    def verify_two(batch: pa.RecordBatch, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        item, text = _column(batch, "item"), _column(batch, "text")
        at = candidate_pairs(batch, at, similarity)
        # A holder's row may be there repeatedly.
        at = [i for i in at.tolist() if item[i] != item[i + 1]]
        sets = shingle_sets(text[j].as_py() or b"" for i in at for j in (i, i + 1))
        found = []
        for i in at:
            one, two = next(sets), next(sets)
            common = _common_of_two(one, two)
            if common >= similarity * (len(one) + len(two) - common) - 1e-9:
                found.append(i)
        if found:
            found = np.array(found)
            both = np.stack([found, found + 1], axis=1)
            copies = _column(batch, "copies").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    item.take(pa.array(both.ravel())),
                    pa.array(copies[both[:, ::-1]].ravel(), pa.int64()),
                    item.take(pa.array(np.repeat(found, 2))),
                ],
                ["item", "links", "head"],
            )

    schema = "item binary, links bigint, head binary"
    return by_group(full, keys, verify, schema, verify_two)


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    runs: int = RUNS,
    depth: int = DEPTH,
    bucket_items: int = BUCKET_ITEMS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``doc_id, text_key, class_id, n_links, n_shingles`` of every row of ``docs``.

    ``n_links`` is the number of other rows whose set of five-word shingles has
    Jaccard similarity ``similarity`` or more with the row's own, copies counted
    one by one. ``class_id`` is the least id among all rows that links connect
    with it. A text of one to four words is one shingle; NULL texts and texts
    without words have no links and are their own class. Repeated rows are
    copies of each other. Ids are integers; a NULL id is the class only if all
    ids of the class are. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    with temporary_stages(spark) as keep:
        base = keep(described(docs, runs), "described")
        items = stage(
            base.filter("item is not null")
            .groupBy("item")
            .agg(
                F.min(F.struct(*_KEY)).alias("holder"),
                F.min("doc_id").alias("least_id"),
                F.count("*").alias("copies"),
                F.first("size").alias("size"),
                F.first("print").alias("print"),
                F.first("buckets").alias("buckets"),
            ),
            "items",
        )
        with temporary_stages(spark) as keep_links:
            found = stage(leaves(items, docs, depth, bucket_items), "leaves")
            similar = keep_links(
                similar_items(found, items, docs, similarity, block_items), "similar"
            )
        with temporary_stages(spark) as keep_roots:
            edges = similar.select(F.col("item").alias("a"), F.col("head").alias("b"))
            roots = keep_roots(components(edges), "roots")
        links = similar.groupBy("item").agg(F.sum("links").alias("links"))
        # A head has rows of its own, so it is a node as well.
        known = (
            items.select("item", "least_id", "copies")
            .join(roots.withColumnRenamed("node", "item"), "item", "left")
            .join(links, "item", "left")
            .withColumn("root", F.coalesce("root", "item"))
        )
        known = stage(known, "known")
        classes = known.groupBy("root").agg(F.min("least_id").alias("class_id"))
        per_item = keep(
            known.join(classes, "root").select(
                "item",
                "class_id",
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            ),
            "classes",
        )
    return base.join(per_item, "item", "left").select(
        "doc_id",
        "text_key",
        F.when(F.col("item").isNull(), F.col("doc_id"))
        .otherwise(F.col("class_id"))
        .alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.col("size").cast("bigint").alias("n_shingles"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row of least id and text key.

    Of rows equal in id and text one stays, and all others without words do.
    """
    joined = stage(jaccard_join(docs, id_col, text_col), "joined")
    worded = joined.filter("n_shingles > 0")
    # A class of NULL ids only is told apart by nothing but its text.
    class_key = [F.col("class_id"), F.when(F.col("class_id").isNull(), F.col("text_key"))]
    stays = worded.groupBy(*[c.alias(f"_c{i}") for i, c in enumerate(class_key)]).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_doc"), *_KEY)).alias("row"),
    )
    empty = joined.filter("n_shingles = 0").select(*_KEY).distinct()
    stays = stage(
        stays.select("row.doc_id", "row.text_key").union(empty), "stays"
    )
    names = [f"_kept_{c}" for c in ("doc", "no_doc", "key")]
    marked = docs.withColumns(
        {
            names[0]: F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)),
            names[1]: F.col(id_col).isNull(),
            names[2]: F.coalesce(text_key(F.col(text_col)), F.lit(b"")),
        }
    )
    wanted = stays.select(
        F.coalesce("doc_id", F.lit(0)).alias(names[0]),
        F.col("doc_id").isNull().alias(names[1]),
        F.coalesce("text_key", F.lit(b"")).alias(names[2]),
    )
    kept = marked.join(wanted, names, "left_semi")
    repeated = joined.groupBy(*_KEY).agg(F.count("*").alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(names)
    return kept.drop(*names)
