"""The Merkle manifest against a plain tree built in memory."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tellerflow.llm import manifest
from tellerflow.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, h string, g int, leaf string"


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row) -> str:
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree: list[list[str]], place: int) -> list[tuple[list[str], list[str]]]:
    steps = []
    for nodes in tree[:-1]:
        run = place // 3 * 3
        steps.append((nodes[run:place], nodes[place + 1 : run + 3]))
        place //= 3
    return steps


def plain_manifest(rows) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[g] = levels([plain_leaf(r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for n, g in enumerate(order):
        for place, row in enumerate(groups[g]):
            proof = siblings(trees[g], place) + siblings(top, n)
            changed = row[4]
            if row[0] is not None and changed is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                changed = changed.replace("\n", "")
            folded = plain_leaf((*row[:4], changed))
            for left, right in proof:
                folded = H(*left, folded, *right)
            seen = H(*[d for left, right in proof for d in left + right])
            out.append((row[0], trees[g][0][place], trees[g][-1][0], top[-1][0], seen, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def rows_of(sizes: dict, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            n += 1
            text = rng.choice([None, "", "a\nb", f"text {n}\n", "é" * n])
            rows.append((n, source, rng.choice([None, "en", "dé"]), rng.choice([None, n]), text, "x", 1, "y"))
    rng.shuffle(rows)
    return rows


def found(spark, tmp_path, rows) -> list[tuple]:
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted([tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()], key=str)


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_equals_a_plain_tree(spark, tmp_path, monkeypatch, digits):
    monkeypatch.setattr(manifest, "DIGITS", digits)
    monkeypatch.setattr(manifest, "BLOCK", 3**digits)
    # Groups of one to five tiers; more sources than a block of two digits holds; a NULL and an empty source.
    sizes = {None: 4, "": 1, "ä": 27, "z": 28, "hot": 90, "Z": 3, **{f"s{i}": 1 + i % 2 for i in range(10)}}
    rows = rows_of(sizes)
    assert found(spark, tmp_path, rows) == plain_manifest(rows)


def test_repeated_rows_null_ids_and_a_very_long_text(spark, tmp_path):
    rows = [(7, "a", "en", 3, "one", "x", 1, "y")] * 9 + [(None, "a", None, None, None, "x", 1, "y")] * 2
    rows += [(7, "a", "en", 3, "other\n", "x", 1, "y"), (8, "a", "en", 3, "line\n" * 400_000, "x", 1, "y"), (None, None, "", 0, "\n", "x", 1, "y")]
    assert found(spark, tmp_path, rows) == plain_manifest(rows)


def test_one_row_and_no_rows(spark, tmp_path):
    row = (5, "only", "en", 1, "t\n", "x", 1, "y")
    got = found(spark, f"{tmp_path}/one", [row])
    assert got == plain_manifest([row])
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == H()
    assert found(spark, f"{tmp_path}/none", []) == []


def test_proofs_fold_to_the_root_and_other_columns_may_be_the_group(spark):
    rows = rows_of({"a": 40, "b": 2})
    docs = spark.createDataFrame(rows, SCHEMA)
    out = manifest.manifest(docs, fields=("text", "lang"), group="lang", carry={"source": F.upper("source")})
    back = out.select((manifest.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("fits"), "source")
    assert [r.fits for r in back.collect()] == [True] * 42
    assert {r.source for r in back.collect()} == {"A", "B"}
