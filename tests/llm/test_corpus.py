"""Mixing, toxicity, near copies, repeated passages, shards, neighbours and the pipeline."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellmeter.llm import (
    hilbert_ann,
    jaccard_join,
    kneser_ney,
    mixing,
    quality,
    queries,
    substring_dedup,
    token_shards,
    toxicity,
)
from cellmeter.llm.bpe import WordEndTokenizer
from cellmeter.llm.components import components
from cellmeter.llm.groups import by_group
from cellmeter.llm.words import run_hashes, shingle_set, shingle_sets, word_hashes

DOCS = "doc_id bigint, text string, lang string, source string, n_chars int"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words_of(text):
    return (text or "").encode().split()


def shingles(text):
    found = words_of(text)
    if 0 < len(found) < 5:
        return {tuple(found)}
    return set(zip(*(found[i:] for i in range(5))))


# --- mixing --------------------------------------------------------------------------


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, limited = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in limited]
        left = budget - sum(2 * sizes[s] for s in limited)
        total = sum(weight[s] for s in rest)
        over = {s for s in rest if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in limited else left * weight[s] / total for s in names}
        limited |= over


def test_mix_equals_sql_and_uses_no_python(spark, sf_dir):
    df = queries.op2_mix_sources(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(queries.ORACLES["op2_mix_sources"]).fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_mix_of_odd_rows(spark):
    rng = random.Random(1)
    rows = [
        (i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 60))), s)
        for i, s in enumerate(rng.choice(["a", "a", "a", "b", "é", "B", None]) for _ in range(3_000))
    ]
    rows += [(None, None, "empty"), (None, "", "empty"), (7, "x y", "twice"), (7, "x y", "twice"), (None, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    docs = docs.withColumn("_key", F.lit("clash")).withColumn("size", F.lit(-1)).withColumn("target", F.lit(0))
    got = mixing.mixed_rows(docs).collect()
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(words_of(text))
    want = plain_targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.taken == r.size * r.copies <= 2 * r.size
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12)
        taken[r.source] += r.taken
    assert len(got) == len(rows)
    longest = max(len(words_of(t)) for _, t, _ in rows)
    assert all(abs(taken[s] - want[s]) <= longest for s in sizes)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert sorted(map(str, mixing.mixed_rows(docs).collect())) == sorted(map(str, got))
    assert mixing.mixed_rows(docs.limit(0)).collect() == [] == mixing.mixed_documents(docs.limit(0)).collect()


# --- toxicity ------------------------------------------------------------------------


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(got) == docs.count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    held = [i for i in labels if got[i].held_out]
    caught = sum(got[i].predicted for i in held if labels[i])
    wrong = sum(got[i].predicted for i in held if not labels[i])
    # Nearly half of the toxic labels of this table are on texts without any insult.
    assert caught >= 0.5 * sum(labels[i] for i in held) and wrong <= 0.02 * len(held)


def test_toxicity_of_odd_rows(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        text = [rng.choice("the cat sat on a mat with some other cats".split()) for _ in range(30)]
        if i % 5 == 0:
            text[rng.randrange(30)] = rng.choice(["idiot", "moron"])
        rows.append((i, " ".join(text)))
    labels = spark.createDataFrame(
        [(i, int(i % 5 == 0)) for i in range(600)] + [(None, 1), (3, 1), (4, None), (4, 0), (4, 0)],
        "doc_id bigint, toxic int",
    ).withColumn("text", F.lit("clash"))
    odd = [(None, None), (None, ""), (5_000, "what an idiot " * 9), (5_000, "what an idiot " * 9), (5_001, "a b " * 90_000)]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string").withColumn("score", F.lit(1))
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    odd_rows = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 5_000}
    assert odd_rows[5_000].predicted == 1 and odd_rows[5_001].predicted == 0
    assert odd_rows[None].predicted == 0 and not odd_rows[None].held_out
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize(
    "between,words,insults",
    [
        (" ", "the cat sat on a mat with some other cats", ["idiot", "moron"]),
        ("", "今日 天気 公園 散歩 友達 電車 本屋 料理", ["馬鹿野郎"]),
    ],
)
def test_toxicity_reads_long_words_to_their_end(spark, between, words, insults):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        text = [rng.choice(words.split()) for _ in range(40)]
        if i % 5 == 0:
            text[rng.randrange(25, 40)] = rng.choice(insults)
        rows.append((i, between.join(text)))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    plain = [rng.choice(words.split()) for _ in range(30)]
    joined = [(1_000 + i, c.join([*plain, *insults])) for i, c in enumerate("_/,\u00a0")]
    joined += [(2_000 + i, c.join(plain)) for i, c in enumerate("_/,\u00a0")]
    docs = spark.createDataFrame(rows + joined, "doc_id bigint, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    if between:
        assert [got[i].predicted for i, _ in joined] == [1] * 4 + [0] * 4
    held = [i for i, _ in rows if got[i].held_out]
    caught = sum(got[i].predicted for i in held if i % 5 == 0)
    wrong = sum(got[i].predicted for i in held if i % 5)
    assert caught >= 0.8 * sum(i % 5 == 0 for i in held) and wrong <= 0.05 * len(held)


def test_no_letter_of_a_word_is_left_out():
    for word in ("日" * 100 + "x", "a-" * 60 + "idiot", "กำลังเดิน" * 30, "_" * 90):
        found = kneser_ney.parts(word.encode())
        read = "".join(g[-1] for x in found for g in kneser_ney.grams(x, 4)).replace(" ", "")
        assert read == (word.replace("-", "") if "a" in word else word)
    assert kneser_ney.parts(("กำลังเดิน" * 30).encode()) == [("กำลังเดิน" * 30).encode()]
    assert kneser_ney.read_words(b"a,b " + b"c,,\xc2\xa0" * 20) == [b"a,b", *[b"c"] * 20]
    assert kneser_ney.read_words(None) == []


# --- near copies -----------------------------------------------------------------------


def plain_classes(rows):
    """Class and links of each row, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    links, head = [0] * len(rows), list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            a, b = head[i], head[j]
            head = [a if h == b else h for h in head]
    ids = collections.defaultdict(list)
    for (i, _), h in zip(rows, head):
        if i is not None:
            ids[h].append(i)
    return collections.Counter(
        (i, min(ids[h], default=None) if s else i, n) for (i, _), h, n, s in zip(rows, head, links, sets)
    )


def near_copies(rng, groups, copies, length=60):
    vocabulary = [f"w{i}" for i in range(900)]
    rows = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            if rng.random() < 0.8:
                text[rng.randrange(length)] = rng.choice(vocabulary)
            rows.append(" ".join(text))
    return rows


@pytest.mark.parametrize("bucket_items,block_items", [(200, 256), (3, 2)])
def test_jaccard_join_equals_all_pairs(spark, bucket_items, block_items):
    rng = random.Random(8)
    texts = near_copies(rng, 12, 6) + near_copies(rng, 1, 30) + ["one two", "one two", "a b c d e", "", " \n", None]
    texts += [f"common words at the start of all {' '.join(str(rng.random()) for _ in range(30))}" for _ in range(40)]
    rows = [(i + 1, t) for i, t in enumerate(texts)]
    rows += [rows[0], (None, rows[1][1]), (None, None), (None, "only here once"), (99_999, "x y z " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs = docs.withColumn("item", F.lit(1)).withColumn("bucket", F.lit(2)).withColumn("size", F.lit("s"))
    got = jaccard_join.jaccard_join(docs, bucket_items=bucket_items, block_items=block_items)
    assert collections.Counter((r.doc_id, r.class_id, r.n_links) for r in got.collect()) == plain_classes(rows)

    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    seen = collections.Counter(kept.select("doc_id", "text").toPandas().itertuples(index=False, name=None))
    assert max(seen.values()) == 1
    worded = [c for c in plain_classes(rows) if c[1] is not None and c[0] == c[1]]
    ids = [i for i, _ in seen if i is not None and not math.isnan(i)]
    assert sorted(ids) == sorted({c[0] for c in worded})


def test_jaccard_join_of_few_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard_join.jaccard_join(none).collect() == []
    assert jaccard_join.one_of_each(none).collect() == []


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1, 1), (500, 501), (None, 3)]
    edges += [(600, 600 + i) for i in range(1, 60)] + [(700 + i, 701 + i) for i in range(60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    head = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    assert set(got) == set(head)
    for a, b in edges:
        if a in head and b in head:
            old, new = head[a], head[b]
            head = {n: new if h == old else h for n, h in head.items()}
    assert len(set(zip((got[n] for n in head), head.values()))) == len(set(head.values())) == len(set(got.values()))


# --- repeated passages -----------------------------------------------------------------


def corpus_with_passages(rng):
    vocabulary = [f"v{i}" for i in range(4_000)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, planted = [], []
    for k, length in enumerate([51, 52, 55, 60, 80, 120, 51, 70]):
        passage, holders = draw(length), []
        for _ in range(2 + k % 3):
            text, at = draw(120), rng.randrange(121)
            end = "\n" if k % 2 else " "
            holders.append(len(rows))
            rows.append((len(rows), " ".join(text[:at]) + end + " ".join(passage) + end + " ".join(text[at:])))
        planted.append((holders, " ".join(passage)))
    line = draw(100)
    near = [len(rows), len(rows) + 1]
    rows.append((near[0], "some head\n" + " ".join(line)))
    rows.append((near[1], " ".join(line[:50] + ["changed"] + line[51:]) + "\nsome tail"))
    clean = range(len(rows), len(rows) + 30)
    rows += [(i, "a short line that all have\n" + " ".join(draw(200))) for i in clean]
    return rows, planted, near, clean


def test_repeated_passages_are_found_and_cut(spark):
    rows, planted, near, clean = corpus_with_passages(random.Random(6))
    odd = [(None, None), (None, ""), (9_000, "a " * 90_000), (9_001, rows[0][1]), (9_001, rows[0][1])]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string")
    docs = docs.withColumn("start", F.lit(1)).withColumn("n", F.lit(2)).withColumn("first", F.lit("f"))
    found = collections.defaultdict(list)
    for r in substring_dedup.repeated_passages(docs).collect():
        found[r.doc_id].append(r)
    for holders, _ in planted:
        assert all(any(r.class_id == holders[0] for r in found[i]) for i in holders)
        assert not any(r.removed for r in found[holders[0]])
    assert [r.removed for i in near for r in found[i]] == [False, True]
    assert not set(clean) & set(found) and 9_000 not in found and None not in found
    # Passages cover what is planted but for less than a window's step at each end.
    for holders, passage in planted:
        assert any(abs(r.n_words - len(passage.split())) <= 2 * substring_dedup.MARK_WORDS for r in found[holders[1]])

    cut = substring_dedup.without_repeats(docs)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    for holders, passage in planted:
        assert [i for i in holders if passage in " ".join(texts[i].split())] == holders[:1]
    assert texts[near[1]] == "some tail" and texts[near[0]] == rows[near[0]][1]
    assert all(texts[i] == dict(rows)[i] for i in clean) and 9_001 not in texts and None in texts
    assert substring_dedup.repeated_passages(docs.limit(0)).collect() == []
    assert substring_dedup.without_repeats(docs.limit(0)).collect() == []


def wrapped(found, *widths):
    """Words in lines of the given widths, in turn."""
    lines, at = [], 0
    for width in itertools.cycle(widths):
        if at >= len(found):
            return "\n".join(lines)
        lines.append(" ".join(found[at : at + width]))
        at += width


def test_near_copies_in_other_lines_are_found(spark):
    rng = random.Random(12)
    draw = lambda n: [f"x{rng.randrange(10_000)}" for _ in range(n)]
    rows, near, edges = [], [], []
    for widths, others in [((20,), (25,)), ((10,), (100,)), ((60, 40), (34,)), ((60, 40), (60, 40)), ((49,), (7, 12))]:
        base = draw(100)
        changed = [("y" if i in (33, 66) else w) for i, w in enumerate(base)]
        head, tail = " ".join(draw(60)), " ".join(draw(60))
        near.append((len(rows), len(rows) + 1))
        rows.append((len(rows), f"{head}\n\n{wrapped(base, *widths)}\n\n{tail}"))
        edges.append((" ".join(draw(55)), " ".join(draw(56))))
        rows.append((len(rows), f"{edges[-1][0]}\n\n{wrapped(changed, *others)}\n \n{edges[-1][1]}"))
    # Without empty lines around, a run of shorter lines between long ones.
    base = draw(100)
    changed = [("y" if i in (33, 66) else w) for i, w in enumerate(base)]
    near.append((len(rows), len(rows) + 1))
    rows.append((len(rows), f"{' '.join(draw(70))}\n{wrapped(base, 20)}\n{' '.join(draw(70))}"))
    edges.append((" ".join(draw(70)), " ".join(draw(70))))
    rows.append((len(rows), f"{edges[-1][0]}\n{wrapped(changed, 25)}\n{edges[-1][1]}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = collections.defaultdict(list)
    for r in substring_dedup.repeated_passages(docs).collect():
        found[r.doc_id].append((r.class_id, r.n_copies, r.removed))
    assert found == {i: [(a, 2, i != a)] for a, b in near for i in (a, b)}
    texts = {r.doc_id: r.text for r in substring_dedup.without_repeats(docs).collect()}
    assert all(texts[a] == rows[a][1] for a, _ in near)
    assert [[x for x in texts[b].split("\n") if x.strip()] for _, b in near] == list(map(list, edges))


def test_paragraphs_of_10_to_200_words_are_found_as_by_brute_force(spark):
    """With a least length of 10 words: all pairs of similarity 0.8, whatever their length."""
    rng = random.Random(12)
    fresh = lambda n: ["w%x" % rng.getrandbits(40) for _ in range(n)]
    rows, similar = [], []
    for length in range(10, 201, 5):
        for changes in range(4):
            one = fresh(length)
            two = list(one)
            for place in rng.sample(range(length), changes):
                two[place] = "changed%x" % rng.getrandbits(30)
            a, b = shingles(" ".join(one)), shingles(" ".join(two))
            if len(a & b) >= 0.8 * len(a | b):
                similar.append((len(rows), len(rows) + 1))
            for words in (one, two):
                rows.append((len(rows), "\n\n".join(" ".join(x) for x in (fresh(4), words, fresh(4)))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.class_id for r in substring_dedup.repeated_passages(docs, line_words=10).collect()}
    met = [found.get(a) == a and found.get(b) == a for a, b in similar]
    assert len(similar) > 80 and sum(met) >= 0.98 * len(met)
    # Without the parameter the shorter ones are no paragraphs; windows need 40 words.
    fewer = {r.doc_id for r in substring_dedup.repeated_passages(docs).collect()}
    assert fewer < set(found)


def test_prints_leave_out_no_similar_pair():
    rng = np.random.default_rng(3)
    number = lambda n: substring_dedup.mixed(rng.integers(0, 2**62, n).astype(np.uint64))
    sets = []
    for _ in range(60):
        base = number(int(rng.integers(1, 700)))
        sets.append(np.unique(base))
        for _ in range(2):
            share = rng.random() * 0.4
            kept = base[rng.random(len(base)) > share]
            changed = np.unique(np.concatenate([kept, number(int(len(base) * share * rng.random()))]))
            sets += [changed] if len(changed) else []
    size = np.array([len(x) for x in sets], float)
    near = jaccard_join.similar_prints([jaccard_join.set_print(x) for x in sets], size, 0.8)
    common = jaccard_join.common_counts(sets)
    similar = common >= 0.8 * (size[:, None] + size[None, :] - common) - 1e-9
    assert not (similar & ~near).any() and similar.sum() > len(sets)
    assert near.sum() < 0.1 * len(sets) ** 2


def test_buckets_of_two_are_compared_as_larger_ones():
    rng = np.random.default_rng(8)
    number = lambda n: substring_dedup.mixed(rng.integers(0, 2**62, n).astype(np.uint64))
    seen = collections.Counter()
    for _ in range(600):
        base = number(int(rng.integers(1, 300)))
        other = np.unique(np.concatenate([base[rng.random(len(base)) > rng.random() * 0.3], number(int(rng.integers(1, 40)))]))
        base = np.unique(base)
        sets, first = [base, other], int(rng.integers(2))
        group = pa.table(
            {
                "bucket": [5, 5], "first": [first] * 2, "second": [1] * 2, "block": rng.integers(0, 2, 2),
                "size": [len(x) for x in sets], "print": [jaccard_join.set_print(x) for x in sets],
                "numbers": [[5, *rng.integers(3, 9, 2).tolist()] for _ in sets],
            }
        )
        prints, size = group.column("print").to_pylist(), group.column("size").to_numpy().astype(float)
        near = jaccard_join.similar_prints(prints, size, 0.8)
        expected = bool((jaccard_join.candidates(group, 0.8) & near).any())
        assert jaccard_join.promising_pair(group, 0.8) == expected
        seen[expected] += 1
        common = jaccard_join.common_counts(sets)
        assert common[0, 1] == common[1, 0] == len(set(base.tolist()) & set(other.tolist()))
    assert min(seen[True], seen[False]) > 50


def test_groups_of_two_are_worked_on_together(spark):
    rows = [(k, v) for k in range(3_000) for v in range(2)] + [(-1, 0), (5_000, 0), (5_000, 1), (5_000, 2)]

    def work(group):
        yield pa.RecordBatch.from_pydict({"k": group.column("k")[:1].combine_chunks(), "n": [group.num_rows]})

    def pairs(batch, at):
        assert len(at)
        found = batch.column(0).take(pa.array(at))
        yield pa.RecordBatch.from_arrays([found, pa.array([-2] * len(at))], ["k", "n"])

    one = spark.createDataFrame(rows, "k bigint, v int").coalesce(1)
    found = by_group(one, ["k"], work, "k bigint, n bigint", pairs).collect()
    sizes = {r.k: r.n for r in found}
    assert len(found) == len(sizes) == 3_002 and sizes[-1] == 1 and sizes[5_000] == 3
    # Only groups at the ends of batches go to ``work``.
    assert {abs(sizes[k]) for k in range(3_000)} == {2}
    assert sum(sizes[k] == 2 for k in range(3_000)) < 50


def test_pairs_of_a_batch_are_those_of_each_group():
    rng = np.random.default_rng(5)
    number = lambda n: substring_dedup.mixed(rng.integers(0, 2**62, n).astype(np.uint64))
    rows = []
    for bucket in range(400):
        base = number(int(rng.integers(1, 200)))
        other = np.concatenate([base[rng.random(len(base)) > rng.random() * 0.3], number(int(rng.integers(1, 9)))])
        first = int(rng.integers(2))
        for x in (base, other):
            numbers = [bucket, *rng.integers(max(bucket - 3, 0), bucket + 3, int(rng.integers(0, 3))).tolist()]
            rows.append((bucket, first, 1, int(rng.integers(2)), len(x), jaccard_join.set_print(x), numbers))
    names = ["bucket", "first", "second", "block", "size", "print", "numbers"]
    table = pa.table(dict(zip(names, map(list, zip(*rows)))))
    at = np.arange(0, len(rows), 2)
    # As part of a larger batch, so that its lists don't begin at the first value.
    batch = pa.concat_tables([table.slice(0, 7), table]).combine_chunks().to_batches()[0].slice(7)
    groups = [table.slice(i, 2).combine_chunks() for i in at]
    own = [i for i, g in zip(at, groups) if jaccard_join.candidates(g, 0.8).any()]
    assert jaccard_join.candidate_pairs(batch, at, 0.8).tolist() == own
    near = [i for i, g in zip(at, groups) if jaccard_join.promising_pair(g, 0.8)]
    assert jaccard_join.promising_pairs(batch, at, 0.8).tolist() == near
    assert 50 < len(near) < len(own) < len(at)


def test_windows_of_texts_together_are_those_of_each():
    rng = random.Random(9)
    texts = [[f"{rng.randrange(60)}".encode() for _ in range(n)] for n in [0, 3, 15, 16, 40, 39, 300, 44, 0, 700, 1]]
    marks = run_hashes(word_hashes([w for t in texts for w in t]), 5)
    ends = np.cumsum([len(t) for t in texts])
    first, second, starts, counts = substring_dedup._windows_of(marks, ends)
    alone = [substring_dedup.marked_windows(t) for t in texts]
    assert counts.tolist() == [len(a[0]) for a in alone] and sum(counts) > 100
    for together, i in ((starts, 0), (first, 1), (second, 2)):
        assert together.tolist() == np.concatenate([a[i] for a in alone]).tolist()
    sets = list(shingle_sets(b" ".join(t) for t in texts))
    assert all(x.tolist() == shingle_set(word_hashes(t)).tolist() for x, t in zip(sets, texts, strict=True))
    # A window begins where a shingle is least of 12 in a row.
    for text, (begins, _, _) in zip(texts, alone):
        own = run_hashes(word_hashes(text), 5)
        least = {i + int(np.argmin(own[i : i + 12])) for i in range(len(own) - 11)}
        assert {i for i in least if i + 40 <= len(text)} <= set(begins.tolist())
        assert all(own[i] in {own[j] for j in least} for i in begins)


def test_bands_of_spans_that_overlap():
    runs = substring_dedup.mixed(np.arange(1, 5_001, dtype=np.uint64))
    spans = np.array([(0, 1), (0, 5_000), (7, 3_000), (7, 46), (46, 1_024), (2_048, 4_096), (4_999, 5_000), (10, 12)])
    found = substring_dedup.band_hashes(runs, spans)
    for (begin, end), own in zip(spans, found):
        least = np.array([(runs[begin:end] * f).min() for f in substring_dedup._SIGNATURE_FACTORS])
        values = (least.reshape(substring_dedup.BANDS, -1) * substring_dedup._BAND_FACTORS).sum(axis=1, dtype=np.uint64)
        assert (substring_dedup.mixed(values + np.arange(1, len(values) + 1, dtype=np.uint64)) == own).all()
    assert substring_dedup.band_hashes(runs, spans[:0]).shape == (0, substring_dedup.BANDS)


def test_buckets_of_one_item_are_not_shuffled(spark):
    items = spark.createDataFrame(
        [(bytes([i]), [i, 1_000 + i // 2, -5 if i % 50 else 7_000_000 + i]) for i in range(200)],
        "item binary, buckets array<bigint>",
    )
    often = spark.createDataFrame([(1_000 + i, 2) for i in range(100)] + [(-5, 196)], "bucket bigint, n bigint")
    rows = [(r.item[0], r.bucket) for r in substring_dedup._bucket_rows(items, often).collect()]
    wanted = {(i, 1_000 + i // 2) for i in range(200)} | {(i, -5) for i in range(200) if i % 50}
    assert wanted <= set(rows) and len(rows) == len(set(rows)) < len(wanted) + 10


def test_paragraphs_are_shuffled_once_for_their_passages(spark):
    rows = [(None, b"k", 0, 40, (1, b"a"), 3), (None, b"k", 0, 40, (1, b"a"), 3), (None, b"k", 40, 40, (None, b"k"), 2)]
    rows += [(2, b"k", 90, 50, (1, b"a"), 2), (2, b"k", 0, 60, (2, b"k"), 5), (2, b"k", 30, 59, (1, b"a"), 2)]
    found = substring_dedup._passages(
        spark.createDataFrame(
            rows,
            "doc_id bigint, text_key binary, start int, n_words int,"
            " first struct<doc_id: bigint, text_key: binary>, n bigint",
        )
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, found.collect()), key=str) == [
        (2, 0, 89, 1, 5, True), (2, 90, 50, 1, 2, True), (None, 0, 80, 1, 3, True)
    ]


def test_texts_are_cut_once_by_one_worker_of_a_task(spark):
    rows = [(1, "w " * 60), (2, "w " * 60 + "end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.length("text"))
    cut = substring_dedup.without_repeats(docs, length_col="n_chars")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("ArrowEvalPython .*cut", plan)) == 1
    assert all(len(r.text) == r.n_chars for r in cut.collect())


def test_outer_lines_of_their_own_stay():
    own = b"own words here now and then\na b c d e f\nnew\ng h i j k\nlast own words of it all"
    assert substring_dedup.common_lines(own, 0, 24, b"z a b c d e f g h i j k z") == (6, 12)
    assert substring_dedup.common_lines(own, 0, 24, b"nothing") == (0, 24)


def test_any_passage_of_51_words_holds_a_common_window():
    rng = random.Random(7)
    for _ in range(300):
        passage = [f"{rng.randrange(50)}".encode() for _ in range(51)]
        sides = [[f"{rng.random()}".encode() for _ in range(rng.randrange(40))] for _ in range(4)]
        one = substring_dedup.marked_windows(sides[0] + passage + sides[1])[1]
        two = substring_dedup.marked_windows(sides[2] + passage + sides[3])[1]
        assert set(one) & set(two)


def test_cutting_words():
    cut = substring_dedup.without_words
    assert cut(b"a b c d", [(1, 3)]) == b"a d"
    assert cut(b" a b\n c d ", [(0, 2)]) == b"c d "
    assert cut(b"a b\nc d", [(1, 3)]) == b"a\nd"
    assert cut(b"a b", [(0, 2)]) == b"" and cut(b" a  b ", []) == b" a  b "


# --- shards -----------------------------------------------------------------------------


def test_permutation():
    for n in (1, 2, 3, 5, 64, 1_000, 4_097):
        permutation = token_shards.Permutation(n)
        slots = permutation.slots(np.arange(n))
        assert sorted(slots) == list(range(n))
        assert (permutation.numbers(slots) == np.arange(n)).all()
    assert list(token_shards.Permutation(99, 1).slots(np.arange(99))) != list(
        token_shards.Permutation(99, 2).slots(np.arange(99))
    )


def test_shards_hold_every_text_once(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    odd = [(None,), ("",), ("a  b \n c " * 20_000,), ("twice",), ("twice",)]
    docs = docs.unionByName(spark.createDataFrame(odd, "text string")).withColumn("ids", F.lit(1))
    tokenizer = token_shards.ByteTokenizer(RANKS, public_tokenizers.PATTERN)
    size = {"sequence_tokens": 64, "shard_records": 50}
    folder = str(tmp_path / "out")
    count = token_shards.write_shards(docs, RANKS, public_tokenizers.PATTERN, folder, **size)
    rows = token_shards.read_slots(spark, folder, **size).collect()
    assert sorted(r.slot for r in rows) == list(range(count))
    assert all(r.shard == r.slot // 50 and len(r.ids) == 128 for r in rows)
    numbers = token_shards.Permutation(count).numbers(np.array([r.slot for r in rows]))
    line = b"".join(bytes(rows[i].ids) for i in np.argsort(numbers))
    ids = np.frombuffer(line, "<u2")
    texts = np.split(ids, np.flatnonzero(ids == tokenizer.end) + 1)
    got = collections.Counter(t.tobytes() for t in texts if len(t) > 1)
    packed = (tokenizer.packed(r.text) for r in docs.collect())
    assert got == collections.Counter(p for p in packed if len(p) > 2)
    part = token_shards.read_slots(spark, folder, 70, 130, **size).collect()
    by_slot = {r.slot: r.ids for r in rows}
    assert {r.slot: r.ids for r in part} == {s: by_slot[s] for s in range(70, 130)}
    assert token_shards.materialised(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_pieces_between_spaces_are_encoded_as_whole_texts():
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    whole = tiktoken.Encoding("w", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokenizer, rng = token_shards.ByteTokenizer(RANKS, public_tokenizers.PATTERN), random.Random(3)
    for _ in range(3_000):
        text = "".join(rng.choice(" \n\tab'sé1.　") for _ in range(rng.randrange(30)))
        assert np.frombuffer(tokenizer.packed(text), "<u2")[:-1].tolist() == whole.encode_ordinary(text)


# --- neighbours ---------------------------------------------------------------------------


def test_hilbert_keys_visit_neighbours():
    for d, bits in ((2, 4), (3, 2), (4, 2), (6, 1)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        keys = hilbert_ann.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def plain_nearest(rows, most=20):
    fine = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 16:
            fine[i] = np.array(v, np.float64)
    ids = np.array(sorted(fine))
    vectors = np.stack([fine[i] for i in ids])
    out = {}
    for i in ids[ids % 20 == 0]:
        score = np.zeros(len(ids))
        for k in range(16):
            score += vectors[:, k] * fine[i][k]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:most]
        out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_neighbours_of_a_small_table_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[20][1]) for i in range(50)]  # copies of one vector
    rows += [(None, rows[0][1]), (1_000, None), (1_020, []), (1_040, [0.0] * 16), (1_060, [1.0] * 3),
             (1_080, [float("nan")] * 16), (1_100, [None] * 16), (1_120, [float("inf")] * 16), rows[40]]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    frame = frame.withColumn("rep", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("vector", F.lit("v"))
    got = collections.defaultdict(list)
    for r in hilbert_ann.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    want = plain_nearest(rows)
    assert {q: [(i, s) for _, i, s in sorted(x)] for q, x in got.items()} == want
    assert all([r for r, _, _ in sorted(x)] == list(range(1, 21)) for x in got.values())
    assert hilbert_ann.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_recall_over_the_benchmark_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.collect()
    vectors = np.array([r.embedding for r in rows], np.float64)
    ids = np.array([r.vec_id for r in rows])
    got = collections.defaultdict(set)
    for r in hilbert_ann.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        best = set(ids[np.argsort(-score)[:20]].tolist())
        hits, total = hits + len(best & got[int(ids[q])]), total + len(best)
    assert hits >= 0.9 * total


# --- pipeline -----------------------------------------------------------------------------


def test_pipeline_equals_plain_stages(spark, tmp_path):
    """Each stage against brute force on what the stage before has left."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("aeinrstldou") for _ in range(rng.randrange(2, 9))) for _ in range(3_000)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60, 160))) for _ in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    for i in (3, 9, 20):
        texts[i] += " " + passage
    texts += [texts[5], texts[5].replace(" ", "  ", 1), "too short", "spam spam spam " * 60, "", None]
    rows = [(i, t, "en", ["s", "t", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    steps = []
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        steps.append(docs.collect())
    for rows_ in steps[:4]:
        assert all(set(r.asDict()) == {"doc_id", "text", "lang", "source", "n_chars"} for r in rows_)
    passed, single, cut, mixed, encoded = steps

    want = [i for i, t, *_ in rows if quality.measure((t or "").encode())["kept"]]
    assert sorted(r.doc_id for r in passed) == want and len(want) > 50
    classes = plain_classes([(r.doc_id, r.text) for r in passed])
    assert sorted(r.doc_id for r in single) == sorted(i for i, c, _ in classes if i == c)
    assert [r.doc_id for r in cut if passage in r.text] == [3]
    shorter = {r.doc_id for r in cut if r.text != texts[r.doc_id]}
    assert shorter == {9, 20} and all(r.n_chars == len(r.text) for r in cut if r.doc_id in shorter)
    sizes = collections.Counter()
    for r in cut:
        sizes[r.source] += len(r.text.split())
    taken, longest = collections.Counter(), max(len(r.text.split()) for r in cut)
    for r in mixed:
        taken[r.source] += len(r.text.split())
    targets = plain_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= longest for s in sizes)
    assert max(collections.Counter(r.doc_id for r in mixed).values()) <= 2
    tokenizer = WordEndTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in encoded) == collections.Counter(
        (r.doc_id, tuple(tokenizer.encode(r.text.encode()))) for r in mixed
    )
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, encoded))


def test_stages_take_odd_rows_extra_columns_and_empty_tables(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join("w%d" % rng.randrange(4_000) for _ in range(n))
    long = prose(60_000)
    rows = [
        (1, prose(120), "en", "s", 700), (None, prose(90), None, None, None), (2, None, "en", "s", None),
        (3, "", "en", None, 0), (4, long, "en", "s", len(long)), (1, prose(80), "de", "t", 1),
        (5, " \n ", None, "t", 3),
    ]
    rows.append(rows[0])
    odd = spark.createDataFrame(rows, DOCS)
    names = ["item", "spans", "found", "bucket", "start", "size", "taken"]
    odd = odd.select("*", *[F.lit(i).alias(name) for i, name in enumerate(names)])
    for name, step in corpus_pipeline.STAGES:
        kept = step(spark, odd, "")
        found = kept.collect()
        if "ids" not in kept.columns:
            assert set(kept.columns) == set(odd.columns), name
            assert all([r[c] for c in names] == list(range(len(names))) for r in found)
            assert {r.doc_id for r in found} >= {1, 4, None}, name
            assert max(len(r.text or "") for r in found) > 100_000, name
        else:
            assert len(found) == len(rows)
            assert sorted(r.n_tokens for r in found)[:3] == [0, 0, 0]
        assert step(spark, odd.limit(0), "").count() == 0, name
