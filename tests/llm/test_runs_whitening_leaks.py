"""Periodic runs, whitening and benchmark decontamination against plain definitions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellmeter.llm import bidiagonal, decontamination, periodic_runs, queries, whitening
from cellmeter.llm.suffix_tree import CommonPrefixes, SuffixTree

# --- periodic runs -------------------------------------------------------------------


def plain_runs(words):
    """Every stretch by its period: maximal, long enough, and with no smaller period."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[i : i + length]
                smaller = (d for d in range(1, q) if part[d:] == part[:-d])
                if next(smaller, None) is None:
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def test_common_prefixes_of_all_pairs():
    rng = random.Random(2)
    for size in (1, 2, 7, 40, 130):
        text = [rng.randrange(1, 4) for _ in range(size)] + [0]
        common = CommonPrefixes(*SuffixTree(text, 4).tour())
        pairs = [(i, j) for i in range(size) for j in range(i + 1, size + 1)]
        got = common(*(np.array(side) for side in zip(*pairs)))
        for (i, j), length in zip(pairs, got.tolist()):
            assert text[i : i + length] == text[j : j + length]
            assert text[i + length] != text[j + length]


def test_runs_of_random_texts_equal_the_definition():
    rng = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = [b"%d" % rng.randint(0, rng.choice([0, 1, 2])) for _ in range(rng.choice([0, 1, 5, 6, 8, 20, 60]))]
            if rng.random() < 0.6:
                words = periodic_runs.with_repeated_tail(words, 10 * rng.randint(0, 1000))
            texts.append(words + words[: rng.randint(0, len(words))] * rng.randint(0, 1))
        assert periodic_runs.runs_of_texts(texts) == [plain_runs(words) for words in texts]


def test_a_text_longer_than_a_batch_is_one_text():
    unit = [b"w%d" % i for i in range(20_000)]
    words = [b"x"] + unit * 4 + unit[:7] + [b"y", b"z"] * 3
    runs = periodic_runs.runs_of_texts([[b"a"] * 9, words, []])
    assert runs == [[(0, 9, 1)], [(1, 80_007, 20_000)], []]  # three times two words are too few


def test_query_runs_equal_the_definition_on_the_whole_table(spark, sf_dir):
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, sf_dir).collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    # Period by period is quadratic, so long texts are compared where they are not periodic only.
    want = {r.doc_id: plain_row(r.doc_id, r.text) for r in docs if len(r.text or "") < 20_000}
    assert len(got) == len(docs)
    assert [g for g in got if g[0] in want] == [want[g[0]] for g in got if g[0] in want]
    assert sum(g[1] > 0 for g in got) > 10


def test_runs_of_nulls_ties_repeats_and_extra_columns(spark):
    texts = [None, "", " \n ", "a " * 5, "a " * 6, "a b " * 4 + "c " * 8, "a b  " * 6]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "b b b b b b", None, None)]
    schema = "doc_id bigint, text string, runs string, found int"
    df = spark.createDataFrame(rows + rows[5:6], schema)
    got = periodic_runs.periodic_runs(df).collect()
    assert len(got) == len(rows) + 1
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].n_runs == 0 and by_id[0].start is None and by_id[0].collapsed == ""
    assert by_id[3].n_runs == 0 and by_id[3].collapsed == "a a a a a"
    assert by_id[4].collapsed == "a" and by_id[4].exponent_milli == 6000
    # Eight times one word is stronger than four times two.
    assert (by_id[5].start, by_id[5].length, by_id[5].period) == (8, 8, 1)
    assert by_id[5].collapsed == "a b c"
    assert by_id[6].collapsed == "a b " and by_id[None].n_runs == 1
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


# --- whitening -----------------------------------------------------------------------


def triangle_of(values, rng):
    size = len(values)
    left, right = (np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(2))
    return np.linalg.qr(left @ np.diag(values) @ right)[1]


@pytest.mark.parametrize(
    "name,values",
    [
        ("spread", np.linspace(1, 9, 40)),
        ("equal", np.ones(24)),
        ("one", [5.0] + [0.0] * 11),
        ("ties", [5.0] * 4 + list(np.linspace(1, 2, 20))),
        ("near ties", [5.0, 5 * (1 - 1e-9), 5 * (1 - 1e-7), 4.9] + list(np.linspace(1, 2, 20))),
        ("graded", 10.0 ** -np.linspace(0, 12, 24)),
        ("zero", [0.0] * 5),
        ("single", [3.0]),
    ],
)
def test_singular_values_and_vectors(name, values):
    matrix = triangle_of(np.array(values), np.random.default_rng(4))
    found, vectors = bidiagonal.right_singular(matrix)
    want = np.linalg.svd(matrix, compute_uv=False)
    largest = max(want[0], 1e-300)
    assert np.abs(found - want).max() <= 1e-13 * largest
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-11
    assert np.abs(matrix.T @ matrix @ vectors - vectors * found**2).max() <= 1e-12 * largest**2


def test_small_singular_values_keep_their_digits():
    """dqds: relative accuracy, where the eigenvalues of the product have none."""
    diagonal, above = 10.0 ** -np.arange(12.0), 0.3 * 10.0 ** -np.arange(11.0)
    got = bidiagonal.singular_values(diagonal, above)
    # The product of all is the determinant, exactly known.
    assert np.log10(got).sum() == pytest.approx(-66, abs=1e-11)


def plain_whitening(vectors):
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    return x, n, sums, e, v


def test_query_whitening_equals_numpy(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = source.collect()
    x, n, sums, e, v = plain_whitening([r.embedding for r in rows])
    got = queries.op12_whitening(spark, sf_dir).collect()
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n}
    by_key = {(r.vec_id, r.component): r for r in got}
    want = (n * x - sums) / n @ v[:, :4] / np.sqrt(e[:4])
    for c in range(4):
        found = np.array([by_key[r.vec_id, c + 1].whitened for r in rows])
        sign = np.sign(found @ want[:, c])
        assert np.abs(sign * found - want[:, c]).max() < 1e-9
        assert by_key[rows[0].vec_id, c + 1].explained == pytest.approx(e[c] / e.sum(), rel=1e-9)
    off = n * x - sums
    assert [by_key[r.vec_id, 1].deviation for r in rows] == (off * off).sum(axis=1).tolist()
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_triangles_of_many_partitions_meet_in_rounds(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        whitening.whole_vector(F.col("embedding")).alias("x")
    )
    few = whitening.fit_whitening(source.distinct().coalesce(1))
    many = whitening.fit_whitening(source.distinct().repartition(40))
    assert many.variances == pytest.approx(few.variances, rel=1e-12)
    assert np.abs(np.abs((many.directions * few.directions).sum(axis=0)) - 1).max() < 1e-10


def test_whitening_of_nulls_repeats_lengths_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], "a"), (2, [0.0, 1.0], "b"), (3, [3.0, 3.0], None), (3, [3.0, 3.0], None),
        (4, None, "c"), (5, [1.0, None], "c"), (6, [nan, 1.0], "c"), (7, [1.0, inf], "c"),
        (8, [1.0, 2.0, 3.0], "c"), (None, [-0.001, 0.001], "d"), (9, [], "e"),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, x string")
    got = whitening.whitened(df).collect()
    assert sorted({r.vec_id for r in got}, key=str) == [1, 2, 3, None]
    # One distinct vector counts once, each of its rows comes out.
    assert {r.n for r in got} == {4} and sum(r.vec_id == 3 for r in got) == 4
    x = np.array([[256, 0], [0, 256], [768, 768], [-1, 0]])
    want = ((4 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()
    by_id = {r.vec_id: r.deviation for r in got}
    assert [by_id[1], by_id[2], by_id[3], by_id[None]] == want

    schema = whitening.whitened(df).schema
    for nothing in (df.limit(0), df.filter("vec_id in (4, 5)"), df.filter("vec_id = 3")):
        empty = whitening.whitened(nothing)
        assert empty.schema == schema and empty.count() == 0
    # Vectors on a line have one direction with variance.
    line = spark.createDataFrame([(i, [i * 1.0, i * 2.0, 0.0]) for i in range(9)], "vec_id bigint, embedding array<double>")
    assert {r.component for r in whitening.whitened(line).collect()} == {1}
    huge = spark.createDataFrame([(i, [i * 1e15, 1.0]) for i in range(3)], "vec_id bigint, embedding array<double>")
    assert [r.deviation for r in whitening.whitened(huge).orderBy("vec_id").collect()][0] is None


# --- benchmark decontamination -------------------------------------------------------


def leak_words(text):
    raw = (text or "").encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_leaks(docs, items):
    windows = {}
    for item_id, text in items:
        words = leak_words(text)
        size = min(len(words), 10)
        for i in range(len(words) - size + 1 if size and item_id is not None else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item_id))
    out = []
    for doc_id, text in docs:
        words, hit, found = leak_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                ids = windows.get(tuple(words[i : i + size]))
                if ids:
                    found |= ids
                    hit.update(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def leaks(spark, docs, items):
    docs = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id bigint, text string, row int, words string")
    items = spark.createDataFrame([(*i, 2) for i in items], "item_id bigint, text string, window int")
    return sorted(map(tuple, decontamination.contamination(docs, items).collect()), key=str)


def test_leaks_of_random_texts_equal_the_definition(spark):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.choice([1, 3, 4, 5, 6, 9, 10, 11, 25])))) for i in range(25)]
    items += [(7, "a b c d a b c d a b c"), (30, None), (31, ""), (None, "a"), (32, "Déjà-vu; 7x")]
    docs = []
    for i in range(60):
        words = [rng.choice("abcde") for _ in range(rng.choice([0, 1, 4, 12, 60]))]
        if rng.random() < 0.5:
            cut = rng.randrange(len(words) + 1)
            words[cut:cut] = (rng.choice(items)[1] or "").split()
        docs.append((i, rng.choice([" ", "\n", "--"]).join(words).upper()))
    docs += [(100, None), (101, ""), (None, "déjà VU 7X"), (5, docs[5][1]), (102, "DÉJÀ-vu 7x")]
    got = leaks(spark, docs, items)
    assert got == plain_leaks(docs, items)
    assert 20 < sum(r[5] for r in got) < len(docs)


def test_leaks_in_long_texts_and_long_words(spark):
    rng = random.Random(1)
    noise = lambda n: " ".join("n%d" % rng.randrange(10**6) for _ in range(n))
    item = " ".join("k%d" % i for i in range(30))
    docs = [
        (1, f"{noise(200_000)} {item} {noise(3)}"),
        (2, f"{'x' * 300_000} {' '.join(item.split()[:10])} {'y' * 70_000}"),
        (3, " ".join(item.split()[:9])),
        (4, item.replace("k9 ", "q ")),
    ]
    items = [(1, item), (2, "y" * 70_000)]
    got = leaks(spark, docs, items)
    assert got == plain_leaks(docs, items)
    assert [r[2] for r in got] == [30, 11, 0, 20]


def test_leaks_of_empty_tables(spark):
    assert leaks(spark, [], [(1, "a b")]) == []
    assert leaks(spark, [(1, "a b")], []) == plain_leaks([(1, "a b")], [])


def test_query_leaks_equal_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = con.execute(queries.ORACLES["op13_decontamination"]).fetchall()
    got = queries.op13_decontamination(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r[5] for r in want)
