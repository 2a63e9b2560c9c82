"""SimHash fingerprints and their components against plain versions."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tellerflow.llm import simhash
from tellerflow.llm.queries import QUERIES


def plain_fingerprint(text) -> int:
    letters = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", letters)
    shingles = [" ".join(found[i : i + 3]) for i in range(max(len(found) - 2, min(len(found), 1)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_components(fps: list[int]) -> list[int]:
    """The smallest position reachable over pairs at distance three or less."""
    values = np.array(fps, np.uint64)
    label = np.arange(len(fps))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= 3) for v in values]
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label.tolist()
        label = new


def test_fingerprints_of_all_kinds_of_texts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_AT_ONCE", 7)
    rng = random.Random(1)
    texts = [None, "", " \t\n", "Word", "two WORDS", "a b c", "ÄÖ É ß", "x\x1cy z w v", "same " * 50, "long " + "w" * 5000]
    texts += [" ".join(rng.choice(["Ab", "cd", "\n", "ÉE", "x" * 40]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    offsets = np.cumsum([0, *[len((t or "").encode()) for t in texts]])
    data = np.frombuffer("".join(t or "" for t in texts).encode(), np.uint8)
    assert simhash.fingerprint_bits(data, offsets).tolist() == [plain_fingerprint(t) for t in texts]
    spark_hash = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first().h  # the same function and seed
    assert spark_hash % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def components_of(spark, fps: list[int]) -> dict:
    classes = spark.createDataFrame([(simhash._long(f), i) for i, f in enumerate(fps)], "fp long, least_id long")
    labels = {r.node: r.label for r in simhash.components(simhash._links(classes)).collect()}
    label = [labels.get(simhash._long(f), simhash._long(f)) for f in fps]
    first = {}
    for i, x in enumerate(label):
        first.setdefault(x, i)
    return [first[x] for x in label]


@pytest.mark.parametrize("members", [2, 32])
def test_components_equal_all_pairs(spark, monkeypatch, members):
    """Clusters whose signatures are large and hold several components, chains and pairs at distances 1 to 5."""
    monkeypatch.setattr(simhash, "MEMBERS", members)
    rng = random.Random(4)
    fps = {0}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            flips = rng.sample(range(64) if rng.random() < 0.5 else range(32), rng.choice([1, 2, 3, 4, 5, 6]))
            fps.add(base ^ sum(1 << i for i in flips))
    chain = rng.getrandbits(64)
    for _ in range(30):
        for i in rng.sample(range(64), 3):
            chain ^= 1 << i
        fps.add(chain)
    for _ in range(60):  # one half shared by many, so that large signatures hold distant fingerprints
        half = 0xABCD1234 << 32 | rng.getrandbits(32)
        fps |= {half, half ^ sum(1 << i for i in rng.sample(range(32), 3)), half ^ sum(1 << i for i in rng.sample(range(64), 3))}
    fps = sorted(fps, key=lambda f: xxhash.xxh64_intdigest(str(f)))
    assert components_of(spark, fps) == plain_components(fps)


def test_whole_query_with_copies_and_odd_rows(spark, tmp_path):
    rng = random.Random(9)
    vocabulary = ["w%d" % i for i in range(400)]
    rows = [(50, None), (7, ""), (9, " \n"), (None, "one two three four"), (None, None), (3, "one two three four"), (3, "one two three four")]
    for n in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([2, 40, 400, 6000]))]
        for _ in range(8):
            changed = list(words)
            changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((1000 - len(rows), " ".join(changed)))
    docs = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], "doc_id long, text string, fp int, component_id string, key int").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted([tuple(r) for r in QUERIES["op12_simhash_duplicates"](spark, str(tmp_path)).collect()], key=str)
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(fps)
    least = {}
    for x, (doc_id, _) in zip(label, rows):
        least[x] = min([i for i in (least.get(x), doc_id) if i is not None], default=None)
    assert got == sorted([(d, f"{f:016x}", least[x]) for (d, _), f, x in zip(rows, fps, label)], key=str)


def test_no_rows(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
