"""Nearest neighbours, language-model scores and benchmark passages against plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tellerflow.llm import ann, decontamination, edits, lm


def plain_distance(a, b, anywhere=False):
    row = [0] * (len(b) + 1) if anywhere else list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row) if anywhere else row[-1]


def test_bit_parallel_distance_equals_the_matrix():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randint(0, 4) for _ in range(rng.randint(1, 70))]
        b = [rng.randint(0, 4) for _ in range(rng.randint(0, 90))]
        for anywhere in (False, True):
            assert edits.distance(edits.masks_of(a), len(a), b, anywhere)[0] == plain_distance(a, b, anywhere)


def edited(words, k, rng):
    words = list(words)
    for _ in range(k):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        words[at : at + 1] = [["zz"], [words[at], "zz"], []][kind]
    return words


def test_benchmark_passages(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([8, 12, 20, 33, 50, 90, 200])]
    items += [(90, None), (91, ""), (92, "two words"), (93, items[3][1]), (None, items[4][1])]
    noise = lambda n: " ".join(word() for _ in range(n))
    docs, truth = [(1000, None), (1001, ""), (1002, "two words only"), (1003, noise(3000))], set()
    for i, content in items[:7]:
        for k in (0, 1, len(content.split()) // 10, len(content.split()) // 5):
            passage = " ".join(edited(content.split(), k, rng)).upper().replace(" ", ", ")
            docs.append((len(docs), f"{noise(rng.randint(0, 40))} {passage} {noise(rng.randint(0, 40))}"))
    docs += [(2000, docs[5][1]), (2000, docs[5][1]), (None, docs[6][1]), (3000, " ".join(items[5][1].split()[:30]))]
    d = spark.createDataFrame([(*x, "c") for x in docs], "doc_id long, text string, item_id string").repartition(3)
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    norm = lambda t: "".join(c for c in (t or "").lower() if c.isalnum() or c.isspace()).split()
    for i, t in docs:
        for j, c in items:
            own = norm(c)
            if len(own) >= decontamination.LEAST and (n := plain_distance(own, norm(t), True)) * 100 <= len(own) * decontamination.EDITS:
                truth.add((i, j, n))
    got = Counter((r.doc_id, r.item_id, r.edits) for r in decontamination.contaminated(d, b).collect())
    assert got[2000, 0, 1] in (0, 2) and set(got) <= truth
    exact = {t for t in truth if t[2] <= 1}
    assert exact <= set(got) and len(set(got)) >= 0.95 * len(truth)
    clean = {r.doc_id for r in decontamination.decontaminate(d, b).collect()}
    assert clean == {i for i, _ in docs} - {i for i, _, _ in got} and {1000, 1001, 1002, 1003, 3000} <= clean
    assert decontamination.contaminated(d, b.limit(0)).count() == 0 == decontamination.contaminated(d.limit(0), b).count()
    assert decontamination.decontaminate(d, b.limit(0)).count() == len(docs)


def test_windows_of_one_item_meet_under_edits():
    words = pa.array([" ".join(f"w{i}" for i in range(40))])
    block = decontamination.Items([1], [decontamination.word_hashes(words)[0]], 20, 0.97)
    assert [e.size for e, *_ in block.sizes] == [decontamination.window_of(40)] == [8]


def test_language_model_scores(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab cé") for _ in range(rng.randint(0, 30))), i % 4 == 0) for i in range(40)]
    rows += [(100, None, True), (None, "ab ab zz Q", True), (101, "AB ab\tc", False), (102, "", False), (101, "AB ab\tc", False)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, h boolean, block int, key string").repartition(3)
    model, counts = lm.AdaptiveTrie(), Counter()
    tokens = lambda t: [*(t or "").lower().split(), None]
    for _, t, held in rows:
        if not held:
            counts.update(tokens(t))
            for step in lm.symbols_of(t or ""):
                model.learn(*step)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (i or -1, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 9),
         round(sum(model.log10(*s) for s in lm.symbols_of(t or "")), 9)) for i, t, _ in rows
    )
    got = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9), round(r.score, 9)) for r in lm.scores(df, F.col("h")).collect())
    assert [g[:4] for g in got] == [w[:4] for w in want] and np.allclose([g[4:] for g in got], [w[4:] for w in want], atol=1e-8)
    assert lm.scores(df.limit(0), F.col("h")).count() == 0
    unknown = lm.scores(df.where("doc_id = 101").limit(1), F.lit(True)).first()
    assert unknown.n_known == 0 and math.isclose(unknown.score, -8 * math.log10(lm.SYMBOLS)) and unknown.base_score == 0


def test_adaptive_scores_learn_within_a_text(spark):
    df = spark.createDataFrame([(1, "ab" * 200), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in lm.adaptive_scores(df).collect()}
    assert got[1].n_symbols == 401 and got[1].score > -60
    assert math.isclose(got[2].score, -math.log10(lm.SYMBOLS)) and got[3].score == got[2].score


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    x = [[float(c) for c in rng.normal(size=8)] for _ in range(900)]
    rows = [(i, v) for i, v in enumerate(x)]
    rows += [(1000, None), (1050, [0.0] * 8), (1100, [float("nan")] + [1.0] * 7), (1150, [None] + [1.0] * 7), (1200, [float("inf")] * 8), (1250, [1.0]), (None, x[3])]
    rows += [(2000 + i, x[50]) for i in range(300)] + [(3000, [c * 1e200 for c in x[100]]), (3050, [c * 1e-200 for c in x[100]])]
    df = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "vec_id long, embedding array<double>, score double, leaf int").repartition(4)
    got = ann.nearest(df, F.col("vec_id") % 50 == 0)
    found: dict[int, list] = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ok = [(i, np.array(v) / np.abs(v).max()) for i, v in rows if i is not None and v and len(v) == 8 and not any(c is None or not np.isfinite(c) for c in v) and any(v)]
    unit = {i: v / np.sqrt((v * v).sum()) for i, v in ok}
    assert set(found) == {i for i, _ in ok if i % 50 == 0}
    hits = total = 0
    for q, rowsq in found.items():
        best = sorted(((-float(unit[q] @ v), i) for i, v in unit.items() if i != q))[:5]
        hits += len({i for _, i in best} & {i for _, i, _ in rowsq})
        total += 5
        assert [r for r, _, _ in rowsq] == [1, 2, 3, 4, 5] and all(math.isclose(s, float(unit[q] @ unit[i]), abs_tol=1e-12) for _, i, s in rowsq)
        assert rowsq == [(n, *r) for n, r in enumerate(((i, s) for _, i, s in sorted(rowsq, key=lambda r: (-r[2], r[1]))), 1)]
    assert hits >= 0.9 * total
    assert [i for _, i, _ in found[50]] == [2000, 2001, 2002, 2003, 2004]  # ties to the smaller id
    few = ann.nearest(df.where("vec_id < 3 or vec_id = 1000"), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r["rank"]) for r in few] == [(0, 1), (0, 2)]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_answers_are_found_where_slots_collide():
    rng = np.random.default_rng(5)
    inverse = pow(0x9E3779B97F4A7C15, -1, 2**64)
    same = np.array([k for k in (i * inverse % 2**64 for i in range(1, 60)) if k < 2**63], np.int64)  # all hash to the first slot
    last = np.array([k for k in ((2**64 - i) * inverse % 2**64 for i in range(1, 40)) if k < 2**63], np.int64)  # all to the last one
    for keys in (same, np.concatenate([same, last]), np.unique(rng.integers(0, 2**63 - 1, 5000)), np.array([0, int(lm._END)], np.int64), np.zeros(0, np.int64)):
        keys = rng.permutation(keys)
        values = rng.random(len(keys))
        asked = rng.integers(0, max(len(keys), 1), 3 * len(keys))
        found = lm.Answers(keys, values)
        assert found(keys[asked]).tolist() == values[asked].tolist()
        with pytest.raises(KeyError):
            found(np.array([12345], np.int64))
