"""History: the life of one small dimension, random snapshots against a plain model, and interrupted writes."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tellerflow.operators import buckets, sinks
from tellerflow.operators import history as H
from tellerflow.operators.history import Dimension

SPEC = Dimension("dim_entity", ("entity_id",), ("entity_name",), "entity_sk")
SOURCE = "entity_id BIGINT, entity_name STRING, last_updated TIMESTAMP_NTZ"
OPEN = dt.date(9999, 12, 31)


def day(n):
    return dt.date(2025, 12, 31) + dt.timedelta(days=n)


def snap(spark, *rows, at=0):
    stamp = dt.datetime(2026, 1, 1) + dt.timedelta(hours=at)
    return spark.createDataFrame([(k, v, stamp) for k, v in rows], SOURCE)


def rows(df):
    return in_order((r.entity_id, r.entity_name, r.effective_from, r.effective_to, r.is_current, r.entity_sk) for r in df.collect())


def in_order(versions):
    return sorted(versions, key=lambda v: (v[0], v[2], v[3]))


def sk(key, d):
    return hashlib.sha256(f"{key}|{d.isoformat()}".encode()).hexdigest()


def test_life_of_a_dimension(spark):
    base = snap(spark, (1, "Alice"), (2, "Bob"))
    h = sinks.durable(H.open_versions(base, SPEC, day(0)), "t")
    assert len(rows(h)) == 2
    again = sinks.durable(H.apply_snapshot(h, base, SPEC, day(0)), "t")
    assert rows(again) == rows(h)  # rerun of the first day

    second = snap(spark, (1, "Alice Prime"), (2, "Bob"), at=5)
    h = sinks.durable(H.apply_snapshot(h, second, SPEC, day(1)), "t")
    assert [(r[0], r[1], r[4]) for r in rows(h)] == [(1, "Alice", 0), (1, "Alice Prime", 1), (2, "Bob", 1)]
    assert rows(h)[0][3] == day(0)

    # a run that appended its version and stopped before closing the one before
    crashed = h.unionByName(H.open_versions(snap(spark, (1, "Alice Broken")), SPEC, day(2)))
    assert crashed.where("entity_id = 1 AND is_current = 1").count() == 2
    third = snap(spark, (1, "Alice Recovered"), (2, "Bob"))
    h = sinks.durable(H.apply_snapshot(crashed, third, SPEC, day(2)), "t")
    assert [(r[1], r[4]) for r in rows(h) if r[0] == 1] == [("Alice", 0), ("Alice Prime", 0), ("Alice Recovered", 1)]
    H.guard_history(h, SPEC, third)

    fourth = snap(spark, (1, "Alice Recovered"))
    h = sinks.durable(H.apply_snapshot(h, fourth, SPEC, day(3)), "t")
    assert not [r for r in rows(h) if r[0] == 2 and r[4] == 1]

    with pytest.raises(ValueError, match="duplicate business key"):
        H.guard_source(snap(spark, (1, "a"), (1, "b")), SPEC)
    with pytest.raises(ValueError, match="null business key"):
        H.guard_source(spark.createDataFrame([(None, "a", None)], SOURCE), SPEC)
    with pytest.raises(ValueError, match="earlier than existing"):
        H.guard_backdated(h, SPEC, day(0))


def test_text_that_looks_like_null_is_a_change(spark):
    h = sinks.durable(H.open_versions(snap(spark, (1, None)), SPEC, day(0)), "t")
    assert len(rows(H.apply_snapshot(h, snap(spark, (1, "__NULL__")), SPEC, day(1)))) == 2


def model(versions, snapshot, d):
    """Plain restatement: versions are lists [key, value, from, to]."""
    out = [list(v) for v in versions]
    current = {v[0]: v for v in out if v[3] == OPEN}
    for key, v in current.items():
        if snapshot.get(key, object()) != v[1]:
            v[3] = d - dt.timedelta(days=1)
    for key, value in snapshot.items():
        if key not in current or current[key][3] != OPEN:
            out.append([key, value, d, OPEN])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_snapshots(spark, seed):
    rnd = random.Random(seed)
    state = {k: rnd.choice("abc") for k in range(8)}
    h = sinks.durable(H.open_versions(snap(spark, *state.items()), SPEC, day(0)), "t")
    want = [[k, v, day(0), OPEN] for k, v in state.items()]
    for n in range(1, 5):
        state = {k: (rnd.choice(["a", "b", "c", None]) if rnd.random() < 0.5 else v) for k, v in state.items() if rnd.random() > 0.15}
        state |= {k: "new" for k in range(8) if k not in state and rnd.random() < 0.3}
        source = snap(spark, *state.items(), at=n)
        before = want
        h = sinks.durable(H.apply_snapshot(h, source, SPEC, day(n)), "t")
        want = model(before, state, day(n))
        assert rows(h) == in_order((k, v, a, b, int(b == OPEN), sk(k, a)) for k, v, a, b in want)
        H.guard_history(h, SPEC, source)
    assert rows(H.apply_snapshot(h, source, SPEC, day(4))) == rows(h)  # the last day again


def test_key_deleted_by_an_earlier_attempt_is_not_reopened(spark):
    h = sinks.durable(H.open_versions(snap(spark, (1, "a"), (2, "b")), SPEC, day(0)), "t")
    without = sinks.durable(H.apply_snapshot(h, snap(spark, (1, "a")), SPEC, day(1)), "t")
    rerun = rows(H.apply_snapshot(without, snap(spark, (1, "a"), (2, "b")), SPEC, day(1)))
    assert [(r[2], r[3]) for r in rerun if r[0] == 2] == [(day(0), day(0)), (day(1), OPEN)]


def files(path) -> dict:
    return {p.relative_to(path).parts[:-1]: p.name for p in path.rglob("*.parquet")}


def test_stored_history_survives_a_stop_between_its_two_writes(spark, tmp_path):
    path = str(tmp_path / "dim")
    first, second = snap(spark, (1, "a"), (2, "b"), (3, "c")), snap(spark, (1, "A"), (2, "b"), (4, "d"))
    buckets.save_history(H.open_versions(first, SPEC, day(0)), path, SPEC.keys)
    after = H.apply_snapshot(buckets.read(spark, path), second, SPEC, day(1))
    want = rows(after)
    # only the closed partition was written
    closed = sinks.durable(buckets._placed(after.where(F.col("effective_to") == F.lit(day(0))), SPEC.keys), "t")
    sinks.overwrite_partitions(closed, path, ["effective_to", "key_bucket"])
    assert buckets.read(spark, path).count() == 5
    buckets.save_history_day(path, second, SPEC, day(1))
    assert rows(buckets.read(spark, path)) == want
    # and a rerun that takes the change back empties the closed partition again
    buckets.save_history_day(path, snap(spark, (1, "a"), (2, "b"), (4, "d")), SPEC, day(1))
    got = [(r[0], r[1], r[4]) for r in rows(buckets.read(spark, path))]
    assert got == [(1, "a", 1), (2, "b", 1), (3, "c", 0), (4, "d", 1)]


def test_a_change_of_one_key_rewrites_one_bucket(spark, tmp_path):
    path = tmp_path / "dim"
    base = {n: "a" for n in range(300)}
    shot = lambda **changes: snap(spark, *{**base, **{int(k[1:]): v for k, v in changes.items()}}.items())
    buckets.save_history(H.open_versions(shot(), SPEC, day(0)), str(path), SPEC.keys)
    old = files(path)
    assert len(old) == buckets.BUCKETS
    written = buckets.save_history_day(str(path), shot(k7="b"), SPEC, day(1))
    new = files(path)
    opened = ("effective_to=9999-12-31", f"key_bucket={written[0]}")
    assert len(written) == 1 and {k for k in new if new[k] != old.get(k)} == {opened, (f"effective_to={day(0)}", "key_bucket=0")}
    assert rows(buckets.read(spark, str(path))) == rows(H.apply_snapshot(H.open_versions(shot(), SPEC, day(0)), shot(k7="b"), SPEC, day(1)))
    # the same day again changes nothing; taking it back restores the bucket and empties the closed partition
    assert buckets.save_history_day(str(path), shot(k7="b"), SPEC, day(1)) == [] and files(path) == new
    # the day again with another key: the first key's closing goes, or stays, with its own bucket
    both = buckets.save_history_day(str(path), shot(k7="b", k8="c"), SPEC, day(1))
    assert len(both) == 1 and buckets.read(spark, str(path)).where("is_current = 0").count() == 2
    # a bucket that loses its only keys goes
    lone = min(n for n in base if n != 7)
    buckets.save_history_day(str(path), snap(spark, (lone, "a")), SPEC, day(2))
    left = {k[1] for k in files(path) if k[0] == "effective_to=9999-12-31"}
    assert len(left) == 1 and buckets.read(spark, str(path)).where("is_current = 1").count() == 1


def test_current_state_rewrites_changed_buckets(spark, tmp_path):
    path = tmp_path / "cards"
    rows_ = lambda **c: spark.createDataFrame([(n, c.get(f"k{n}", "x")) for n in range(200)], "k BIGINT, v STRING")
    buckets.save_current(str(path), rows_(), ["k"])
    old = files(path)
    assert len(buckets.save_current(str(path), rows_(k5="y").where("k < 100"), ["k"])) == 1
    new = files(path)
    assert sum(new[k] != old[k] for k in new) == 1 and len(new) == len(old)
    assert {tuple(r) for r in buckets.read(spark, str(path)).collect()} == {(n, "y" if n == 5 else "x") for n in range(200)}
    assert buckets.save_current(str(path), rows_(k5="y"), ["k"]) == []


def test_violations_are_counted(spark):
    h = spark.createDataFrame(
        [
            (1, "a", day(0), day(5), 0, "k1"), (1, "b", day(3), OPEN, 1, "k2"), (1, "c", day(3), OPEN, 1, "k2"),
            (2, "d", day(4), day(1), 0, "k3"), (3, "e", day(0), day(1), 1, None), (4, "f", day(0), OPEN, 2, "k5"),
        ],
        "entity_id BIGINT, entity_name STRING, effective_from DATE, effective_to DATE, is_current INT, entity_sk STRING",
    )
    found = H.history_violations(h, SPEC).first().asDict()
    assert found == {
        "null_metadata": 1, "invalid_flag": 1, "inverted_range": 1, "sentinel_mismatch": 1, "duplicate_sk": 1,
        "multiple_current": 1, "overlapping_ranges": 2,
    }
    with pytest.raises(RuntimeError, match="overlapping_ranges"):
        H.guard_history(h, SPEC)


def test_specs_are_validated():
    with pytest.raises(ValueError):
        Dimension("d", ("k",), (), "sk").validate()
    with pytest.raises(ValueError):
        Dimension("d", ("k",), ("k",), "sk").validate()
    with pytest.raises(ValueError, match="full snapshot"):
        Dimension("d", ("k",), ("v",), "sk", full_snapshot=False).validate()
    for spec in H.DIMENSIONS.values():
        assert "last_updated" not in spec.validate().tracked
