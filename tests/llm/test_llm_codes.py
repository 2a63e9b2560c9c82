"""Vector codes against plain loops over whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerflow.llm import codes
from tellerflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, code string, v int, error int"


def whole(x: float) -> int:
    return math.floor(x * 4096) if abs(x) < 1e300 else int(x) * 4096


def plain(rows) -> list[tuple]:
    kept = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    width = max(1, -(-max([len(r[1]) for r in kept], default=0) // 8))
    vectors = [[whole(c) for c in r[1]] + [0] * (8 * width - len(r[1])) for r in kept]
    parts = [[v[p * width : (p + 1) * width] for p in range(8)] for v in vectors]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:16]
    books = [[parts[i][p] for i in first] for p in range(8)]

    def assign(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            own = {}
            for x in parts:
                own.setdefault(assign(x[p], books[p])[1], []).append(x[p])
            for n, members in own.items():
                books[p][n] = [sum(c) // len(members) for c in zip(*members)]
    found = [[assign(x[p], books[p]) for p in range(8)] for x in parts]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    out = []
    for r, f, e in zip(kept, found, errors):
        total = sum(x for q, x in zip(kept, errors) if q[2] == r[2])
        fits = lambda n: n if n < 2**63 else None
        if any(fits(x) is None for q, x in zip(kept, errors) if q[2] == r[2]):
            total = 2**63
        out.append((r[0], "".join(f"{n:02x}" for _, n in f), fits(e), fits(total), digest))
    return sorted(out, key=str)


def found(spark, tmp_path, rows, schema=SCHEMA) -> list[tuple]:
    spark.createDataFrame([(*r, "c", 1, 2) for r in rows], schema).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted([tuple(r) for r in QUERIES["op13_vector_codes"](spark, str(tmp_path)).collect()], key=str)


def vectors(n: int, width: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(20)]
    return [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 4, 8, 32])
def test_transform_is_in_sequency_order_and_keeps_distances(n):
    rows = codes.walsh_hadamard(np.eye(n, dtype=np.int64)).T  # of the matrix
    assert [int((r[1:] != r[:-1]).sum()) for r in rows] == list(range(n))
    rng = np.random.default_rng(n)
    a, b = rng.integers(-1000, 1000, (2, 5, max(1, n - 1)))
    assert ((codes.walsh_hadamard(a) - codes.walsh_hadamard(b)) ** 2).sum(1).tolist() == (((a - b) ** 2).sum(1) * codes.walsh_hadamard(a).shape[1]).tolist()


@pytest.mark.parametrize("kind", [np.int64, object])
def test_nearest_equals_all_distances_with_ties(kind):
    rng = np.random.default_rng(7)
    for width in (1, 3, 8, 12):
        parts, book = rng.integers(-3, 4, (300, width)).astype(kind), rng.integers(-3, 4, (16, width)).astype(kind)
        entry, distance = codes.nearest(parts, book)
        all_ = ((parts[:, None] - book[None]) ** 2).sum(2)
        assert entry.tolist() == [row.index(min(row)) for row in all_.tolist()]
        assert distance.tolist() == [min(row) for row in all_.tolist()]


def test_equals_plain_loops(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(codes, "_NUMBERS", 24 * 50)  # several pieces a batch
    rows = vectors(150, 24, 1) + [(1000 + i, [0.5] * 24, 3) for i in range(40)]
    assert found(spark, tmp_path, rows) == plain(rows)


def test_odd_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = vectors(30, 16, 2) + [(1, None, 1), (2, [None] * 16, 1), (3, [nan] + [0.0] * 15, 1), (4, [0.0] * 15 + [-inf], 2)]
    rows += [(5, [], 1), (6, [0.25] * 5, None), (7, [1.0] * 19, 2), (None, [0.1] * 16, 1), (3, [0.2] * 16, None), (3, [0.1] * 16, None), (3, [0.1] * 16, None)]
    assert found(spark, tmp_path, rows) == plain(rows)


def test_components_beyond_sixty_four_bits(spark, tmp_path):
    rows = vectors(20, 8, 3) + [(50 + i, [x * (-1) ** i] * 8, 9 + i % 2) for i, x in enumerate([3e9, 1e17, 1e30, 1e300, 20_000.0])]
    got = found(spark, tmp_path, rows)
    assert got == plain(rows)


def test_fewer_vectors_than_entries_and_none(spark, tmp_path):
    rows = [(9, [0.5] * 8, 1), (3, [-0.5] * 8, None), (4, [0.1] * 8, None)]
    assert found(spark, f"{tmp_path}/few", rows) == plain(rows)
    assert found(spark, f"{tmp_path}/none", []) == []


def test_floats_and_other_names(spark):
    rows = spark.createDataFrame([(i, [float(i)] * 8, "x") for i in range(20)], "id int, vec array<float>, kind string")
    out = codes.quantise(rows, vector="vec", vec_id="id", label="kind")
    assert out.rows.agg(F.sum("error")).first()[0] is not None and len(out.books[0]) == 16
