"""Toxicity by two Kneser-Ney models, learned from labelled rows.

What both models fall back to is counted over the whole corpus. The class counts
come from at most ``MODEL_ROWS`` labelled rows of each class, and the scale of
the score from at most ``SCALE_ROWS`` others; rows are chosen by a hash of their
id. So the model that goes to the executors has a bound that does not grow.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .kneser_ney import (
    LONGEST_WORD,
    ORDER,
    SHARED_ORDER,
    WORD_LETTERS,
    ClassModels,
    grams,
    read_words,
)

MODEL_ROWS = 4_000
SCALE_ROWS = 6_000
TOXIC_SCORE = 0.7
# A word that favours toxic text by less than this says nothing.
MARGIN = 1.0

_GRAMS = "kind int, gram string, n bigint"


def remainder(doc_id: Column) -> Column:
    """Part of an id, 0 to 2; -1 for NULL."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(-1)).cast("int")


def evidence(models: ClassModels, data: bytes | None) -> float:
    """Length-normalised log-likelihood ratio over the words that favour toxic text.

    Other words count in the length only: ordinary words don't excuse an insult,
    and how ordinary they are says nothing. A long word is as many words as its
    letters make, and its ordinary stretches don't excuse the others either.
    """
    words = read_words(data)
    if not words:
        return 0.0
    long = [w for w in words if len(w) > LONGEST_WORD]
    if not long:
        return float(np.maximum(models.log_ratios(words) - MARGIN, 0.0).sum()) / len(words)
    short = [w for w in words if len(w) <= LONGEST_WORD]
    total = float(np.maximum(models.log_ratios(short) - MARGIN, 0.0).sum())
    for word in long:
        total += sum(max(x - MARGIN, 0.0) for x in models.stretches(word))
    letters = (len(w.decode("utf-8", "replace")) for w in long)
    return total / (len(short) + sum(-(-n // WORD_LETTERS) for n in letters))


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """``kind, gram, n`` out of ``kind, text``: letter runs of every whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            words: Counter = Counter()
            for kind, text in zip(*map(pa.Array.to_pylist, batch.columns)):
                words.update((kind, w) for w in read_words(text))
            for (kind, word), n in words.items():
                for gram in grams(word, order):
                    found[kind, gram] += n
        yield pa.RecordBatch.from_pydict(
            {
                "kind": pa.array([k for k, _ in found], pa.int32()),
                "gram": pa.array([g for _, g in found], pa.string()),
                "n": pa.array(found.values(), pa.int64()),
            }
        )

    narrow = texts.select("kind", F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(count, _GRAMS).groupBy("kind", "gram").agg(F.sum("n").alias("n"))


def _chosen(rows: DataFrame, most: int) -> DataFrame:
    """Ids of at most ``most`` rows, by hash."""
    return rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    model_rows: int = MODEL_ROWS,
    scale_rows: int = SCALE_ROWS,
) -> tuple[ClassModels, tuple[float, float]]:
    """Models and the two numbers that turn evidence into a score.

    ``docs`` has ``doc_id, text`` and ``labels`` has ``doc_id, toxic``. Ids whose
    remainder is 1 are held out; of the others, remainder 0 is for the models and
    2 for the scale. Ids that are NULL or labelled both ways are not used.
    """
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("kind"), F.max("toxic").alias("_other"))
        .filter("kind = _other")
        .select("doc_id", "kind", remainder(F.col("doc_id")).alias("part"))
        .filter("part != 1")
    )
    of_model = known.filter("part = 0")
    picked = [
        _chosen(of_model.filter(f"kind = {kind}"), model_rows).select(
            "doc_id", F.lit(kind).alias("kind"), F.lit(0).alias("part")
        )
        for kind in (0, 1)
    ]
    scale = known.filter("part = 2")
    picked.append(
        scale.join(_chosen(scale, scale_rows), "doc_id").select("doc_id", "kind", "part")
    )
    sample = stage(picked[0].union(picked[1]).union(picked[2]), "toxic_sample")
    texts = stage(
        docs.select("doc_id", "text").join(sample, "doc_id").select("kind", "part", "text"),
        "toxic_texts",
    )
    counts: list[dict[str, int]] = [{}, {}, {}]
    shared = gram_counts(docs.select(F.lit(2).alias("kind"), "text"), SHARED_ORDER)
    own = gram_counts(texts.filter("part = 0"), ORDER)
    # Bounded: pairs of letters, and the runs of so many labelled rows.
    for kind, gram, n in shared.union(own).collect():
        counts[kind][gram] = n
    models = ClassModels(counts[2], counts[1], counts[0])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, text = batch.columns
            x = [evidence(models, t.as_py()) for t in text]
            yield pa.RecordBatch.from_arrays([kind, pa.array(x, pa.float64())], ["kind", "x"])

    weighed = (
        texts.filter("part = 2")
        .select("kind", F.col("text").cast("binary"))
        .mapInArrow(weigh, "kind int, x double")
        .collect()
    )
    return models, logistic(np.array([r.x for r in weighed]), np.array([r.kind for r in weighed]))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic regression, with a weak pull towards no slope."""
    if len(x) == 0:
        return 0.0, 0.0
    design = np.stack([x, np.ones(len(x))], axis=1)
    pull = np.diag([1e-4, 1e-4])
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        curve = (design * (p * (1 - p))[:, None]).T @ design + pull
        beta = beta + np.linalg.solve(curve, design.T @ (y - p) - pull @ beta)
        beta = np.clip(beta, -1e3, 1e3)
    return float(beta[0]), float(beta[1])


def score(text: Column, models: ClassModels, scale: tuple[float, float]) -> Column:
    """Score of each whole text, from 0 to 1."""
    slope, offset = scale

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        x = np.array([evidence(models, t.as_py()) for t in texts])
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(slope * x + offset, -700, 700))), pa.float64())

    return scored(text.cast("binary"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    A NULL or empty text has no evidence; a NULL id is not held out. Repeated
    rows stay repeated. Without labels every score is one half. Columns other
    than ``doc_id, text`` and ``doc_id, toxic`` are not read.
    """
    models, scale = fit(docs, labels)
    scored = docs.select(
        "doc_id",
        (remainder(F.col("doc_id")) == 1).alias("held_out"),
        score(F.col("text"), models, scale).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_SCORE).cast("int"))
