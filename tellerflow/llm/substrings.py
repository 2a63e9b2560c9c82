"""Repeated passages by collinear chaining of shared seeds.

1. Seeds: of every ``WINDOW`` successive k-mers of ``K`` words the one with the
   smallest hash, so any stretch of K + WINDOW - 1 words that two texts share
   gives both the same seed. A text has each seed at all its places.
2. Anchors: each place of a seed is matched with the first place in the smallest
   and in the largest text that has it, and that may be the own text. That is two
   anchors an occurrence, however many texts share the seed. Runs of successive
   shared seeds that span ``_SPAN`` or ``LEAST - K`` words are matched alike: a
   passage whose sentences also stand elsewhere, one here and one there, still
   meets a text that holds it longer.
3. Chains: a pair's anchors are chained in order in both texts; a chain is worth
   its anchors less a cost per word of gap, and the best predecessor comes from a
   Fenwick tree of prefix maxima over the partner's places.
4. Alignment: the words between anchors are aligned exactly, both ends are
   extended while the words are mostly alike, and a passage is reported when it has at least
   ``least`` words in both texts and at most ``edits`` edits per hundred of them.

Words are lower-cased (ASCII) and separated by white space. Texts, not rows, are
compared: equal texts share one 64-bit hash and all their work. Their whole text
is a passage repeated among themselves, if long enough.

Defined cases: NULL, empty and short texts have no passages; rows with a NULL
doc_id are reported as such, and stand for a partner only where no other row of
that text has an id; a repeated row is reported as often as it occurs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from tellerflow.llm.edits import distance, masks_of
from tellerflow.llm.registry import documents, query
from tellerflow.llm.text import LOWER, column_bytes, hash_spans, mix, powers, slices, words
from tellerflow.llm.workers import map_arrow
from tellerflow.operators.sinks import durable

K, WINDOW = 8, 12
LEAST, EDITS = 50, 20
GAP = 0.1  # cost of a word of gap, where a seed is worth K
FARTHEST = 40  # words of gap within one passage
_SPAN = LEAST - 2 * (WINDOW - 1) - K  # what the anchors of an unedited passage of LEAST words span at least


def seeds(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, seed) of every row's seeds."""
    counts = np.maximum(np.diff(at) - K + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    if not len(row):
        return row, row, np.zeros(0, np.uint64)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = at[row] + place
    up, down = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    value = mix((sums[start + K] - sums[start]) * down[start])
    last = np.repeat(counts, counts) - place  # k-mers from here to the row's end
    least, width = value.copy(), 1
    while width < WINDOW:  # minima of ever wider windows
        step = min(width, WINDOW - width)
        least[:-step] = np.minimum(least[:-step], least[step:])
        width += step
    whole = last >= WINDOW
    chosen = np.zeros(len(row), bool)
    for d in range(WINDOW):
        chosen[d:] |= whole[: len(row) - d] & (least[: len(row) - d] == value[d:])
    first = np.cumsum(counts)[counts > 0] - counts[counts > 0]
    short = np.repeat(np.minimum.reduceat(value, first), counts[counts > 0])  # rows of less than one window
    chosen |= (np.repeat(counts, counts) < WINDOW) & (value == short)
    row, place, value = row[chosen], place[chosen], value[chosen]
    return row, place, value


def _again(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which values, in order of their places, stood in the same row before."""
    order = np.lexsort((value, row))
    out = np.zeros(len(row), bool)
    out[order[1:]] = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
    return out


def chains(x: np.ndarray, y: np.ndarray) -> list[list[int]]:
    """Best chains of the anchors (x, y), each anchor in one chain at most, as lists of anchor numbers in order."""
    order = np.lexsort((y, x))
    xs, ys = x[order].tolist(), y[order].tolist()
    ranks = (np.searchsorted(np.unique(y), y[order]) + 1).tolist()
    n, size = len(xs), max(ranks)
    best: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)  # Fenwick tree: prefix maxima of (score + cost so far, anchor)
    score, before = [0.0] * n, [-1] * n
    i = 0
    while i < n:
        j = i
        while j < n and xs[j] == xs[i]:  # anchors of one x do not chain with each other
            top, r = (-1e18, -1), ranks[j] - 1
            while r > 0:
                top = max(top, best[r])
                r &= r - 1
            gain = top[0] - GAP * (xs[j] + ys[j])
            score[j], before[j] = (K + gain, top[1]) if gain > 0 else (float(K), -1)
            j += 1
        for m in range(i, j):
            mine, r = (score[m] + GAP * (xs[m] + ys[m]), m), ranks[m]
            while r <= size:
                best[r] = max(best[r], mine)
                r += r & -r
        i = j
    used, out = [False] * n, []
    for end in sorted(range(n), key=lambda m: -score[m]):
        chain, m = [], end
        while m >= 0 and not used[m]:
            used[m] = True
            chain.append(m)
            m = before[m]
        if not chain:
            continue
        part: list[int] = []
        for m in reversed(chain):  # cut where the gap is too wide for one passage
            if part and max(xs[m] - xs[part[-1]], ys[m] - ys[part[-1]]) > FARTHEST + K:
                out.append(part)
                part = []
            part.append(m)
        out.append(part)
    return [[int(order[m]) for m in part] for part in out]


def _outward(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """How far two word lists stay alike from their start: words of each, and edits. An edit costs what two equal
    words bring, and the search ends when it has lost six words' worth."""
    i = j = edits = score = 0
    best, top = (0, 0, 0), 0
    while i < len(a) and j < len(b) and score >= top - 6:
        if a[i] == b[j]:
            i, j, score = i + 1, j + 1, score + 1
            if score > top:
                best, top = (i, j, edits), score
        else:
            edits, score = edits + 1, score - 2
            if a[i + 1 : i + 2] == b[j : j + 1]:
                i += 1
            elif a[i : i + 1] == b[j + 1 : j + 2]:
                j += 1
            else:
                i, j = i + 1, j + 1
    return best


def aligned(a: list[int], b: list[int], x: list[int], y: list[int]) -> tuple[int, int, int, int, int]:
    """Align two word lists along a chain: (start and end in a, start and end in b, edits)."""
    back_a, back_b, edits = _outward(a[x[0] - 1 :: -1] if x[0] else [], b[y[0] - 1 :: -1] if y[0] else [])
    ex, ey = x[0] + K, y[0] + K
    for px, py in zip(x[1:], y[1:]):
        if px < ex or py < ey:  # overlaps what is aligned
            if px - ex != py - ey:
                continue  # on another diagonal: leave it to the next anchor
        elif a[ex:px] != b[ey:py]:
            gap = a[ex:px]
            edits += distance(masks_of(gap), len(gap), b[ey:py])[0]
        ex, ey = max(ex, px + K), max(ey, py + K)
    on_a, on_b, more = _outward(a[ex:], b[ey:])
    return x[0] - back_a, ex + on_a, y[0] - back_b, ey + on_b, edits + more


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    content = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(content).alias("t"), content.alias("text")).where("text is not null")


def _shared(keys: DataFrame) -> DataFrame:
    """Rows (key, t, at, to, again) of keys with two places or more, with the first place in the smallest text, t0, and in the
    largest, t1. ``again`` marks the later places of a key in its text."""
    first = F.when(~F.col("again"), F.col("t"))  # plain values, so that they are hashed and not sorted
    ends = keys.groupBy("key").agg(
        F.min("t").alias("t0"), F.max("t").alias("t1"), F.max("again").alias("repeats"), F.min_by("at", first).alias("at0"), F.max_by("at", first).alias("at1"),
        F.min_by("to", first).alias("to0"), F.max_by("to", first).alias("to1"),
    ).where("t0 <> t1 or repeats").drop("repeats")
    return keys.join(ends, "key")


def _stars(shared: DataFrame) -> DataFrame:
    """(lo, hi, x, y): both ends of each row's place, beside those in t0 and in t1."""
    def anchor(lo, hi, x, y):
        return F.struct(F.col(lo).alias("lo"), F.col(hi).alias("hi"), F.col(x).alias("x"), F.col(y).alias("y"))

    least = [anchor("t0", "t", f"{e}0", e) for e in ("at", "to")]
    greatest = [F.when(F.col("t") < F.col("t1"), anchor("t", "t1", e, f"{e}1")).otherwise(anchor("t1", "t", f"{e}1", e)) for e in ("at", "to")]
    return shared.select(F.explode(F.array_distinct(F.array(*least, *greatest))).alias("a")).select("a.*")


def _runs(shared: DataFrame) -> DataFrame:
    """(key, t, at, to, again) of the runs of shared seeds, from each seed to the first one far enough; an unedited passage has no gap of more than WINDOW."""
    schema = StructType([StructField("key", LongType()), StructField("t", LongType()), StructField("at", IntegerType()), StructField("to", IntegerType()), StructField("again", BooleanType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, places, values in zip(*(batch.column(n) for n in ("t", "ats", "seeds"))):
                at, value = (np.asarray(c.values) for c in (places, values))
                order = np.argsort(at, kind="stable")
                at, value = at[order], mix(value[order].view(np.uint64))
                up, down = powers(len(at) + 1)
                sums = np.zeros(len(at) + 1, np.uint64)
                np.cumsum(value * up[: len(at)], out=sums[1:])
                breaks = np.concatenate([[0], np.cumsum(np.diff(at) > WINDOW)])
                for span in (_SPAN, LEAST - K):
                    i = np.arange(len(at))
                    j = np.searchsorted(at, at + span)
                    i, j = i[j < len(at)], j[j < len(at)]
                    i, j = i[breaks[i] == breaks[j]], j[breaks[i] == breaks[j]]
                    key = mix((sums[j + 1] - sums[i]) * down[i] + np.uint64(span))
                    owner = pa.array(np.full(len(i), t.as_py(), np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), owner, pa.array(at[i].astype(np.int32)), pa.array(at[j].astype(np.int32)), pa.array(_again(np.zeros(len(i)), key))], names=schema.names)

    # A set, as equal texts have equal places.
    per_text = shared.groupBy("t").agg(F.collect_set(F.struct("at", "key")).alias("s")).where(F.size("s") > 1)
    return map_arrow(per_text.select("t", F.col("s.at").alias("ats"), F.col("s.key").alias("seeds")), work, schema)


def anchors(rows: DataFrame) -> DataFrame:
    """(lo, hi, x, y): the places where texts lo <= hi share a seed, as two arrays per pair; for lo = hi, y is ``LEAST`` words on at least."""
    schema = StructType([StructField("seed", LongType()), StructField("t", LongType()), StructField("at", IntegerType()), StructField("again", BooleanType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text", 2 << 20)):
            data, offsets = column_bytes(batch.column("text"))
            data = LOWER[data]
            starts, ends, at = words(data, offsets)
            row, place, seed = seeds(hash_spans(data, starts, ends), at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed.view(np.int64)), batch.column("t").take(pa.array(row, pa.int64())), pa.array(place.astype(np.int32)), pa.array(_again(row, seed))], names=schema.names
            )

    found = map_arrow(rows.select("t", "text"), work, schema)
    shared = durable(_shared(found.withColumnRenamed("seed", "key").withColumn("to", F.col("at"))), "shared-seeds")
    pairs = _stars(shared).union(_stars(_shared(_runs(shared)))).where((F.col("lo") != F.col("hi")) | (F.col("y") - F.col("x") >= LEAST))
    # A set, as equal texts give equal anchors; a place of either text is in it twice at most.
    per_pair = pairs.groupBy("lo", "hi").agg(
        F.collect_set(F.struct("x", "y")).alias("a"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    )
    wide = per_pair.where((F.col("x1") - F.col("x0") >= _SPAN) & (F.col("y1") - F.col("y0") >= _SPAN))
    return wide.select("lo", "hi", F.col("a.x").alias("x"), F.col("a.y").alias("y"))


_CHAIN = StructType([StructField(n, LongType()) for n in ("lo", "hi")] + [StructField(n, ArrayType(IntegerType())) for n in ("x", "y")])


def chained(pairs: DataFrame) -> DataFrame:
    """The pairs' chains that span enough, as rows of the same columns."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for lo, hi, x, y in zip(*(batch.column(n).to_pylist() for n in _CHAIN.names)):
                for part in chains(np.array(x), np.array(y)):
                    px, py = [x[m] for m in part], [y[m] for m in part]
                    if px[-1] - px[0] >= _SPAN and py[-1] - py[0] >= _SPAN:
                        out.append((lo, hi, px, py))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=_CHAIN.names)

    return map_arrow(pairs, work, _CHAIN)


def _cut(regions: DataFrame) -> DataFrame:
    """Rows (id, side, t, from, to, text) to (id, side, first, words): the words of a region, 32 bits each. A text of many
    regions is cut once a batch, and the join on t brings its rows together."""
    schema = StructType([StructField("id", LongType()), StructField("side", IntegerType()), StructField("first", LongType()), StructField("words", BinaryType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, first, number = np.unique(np.asarray(batch.column("t")), return_index=True, return_inverse=True)
            texts = pa.RecordBatch.from_arrays([batch.column("text").take(pa.array(first))], names=["text"])
            order = np.argsort(number, kind="stable")
            rows = batch.select(["id", "side", "from", "to"]).take(pa.array(order))
            ends, done = np.cumsum(np.bincount(number, minlength=len(first))), 0
            for part in slices(texts, "text", 2 << 20):
                data, offsets = column_bytes(part.column("text"))
                data = LOWER[data]
                starts, stops, at = words(data, offsets)
                hashes = (hash_spans(data, starts, stops) >> np.uint64(32)).astype(np.uint32)
                low_row, high_row = ends[done - 1] if done else 0, ends[done + len(at) - 2]
                mine = rows.slice(low_row, high_row - low_row)
                text = number[order[low_row:high_row]] - done
                done += len(at) - 1
                low = np.maximum(np.asarray(mine.column("from")), 0)
                high = np.minimum(np.asarray(mine.column("to")), np.diff(at)[text])
                own = [hashes[a + i : a + j].tobytes() for a, i, j in zip(at[text], low, high)]
                yield pa.RecordBatch.from_arrays([mine.column("id"), mine.column("side"), pa.array(low, pa.int64()), pa.array(own, pa.binary())], names=schema.names)

    return map_arrow(regions, work, schema)


def passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, edits: int = EDITS) -> DataFrame:
    """(doc_id, start_word, end_word, partner_id, partner_start, partner_end, edits): each document's repeated passages.

    A passage is reported for every document that has it, with a partner that has
    it too: the smallest doc_id of the partner's text.
    """
    rows = _texts(docs, text, doc_id)
    n_words = F.size(F.filter(F.split("text", "[\\x09-\\x0D\\x20]+"), lambda w: w != ""))
    known = durable(rows.select("doc_id", "t", n_words.alias("n_words")), "passage-texts")
    # The id makes a chain's two sides meet again; it is written once, so that it never changes.
    found = durable(chained(anchors(rows)).withColumn("id", F.monotonically_increasing_id()), "passage-chains")

    # The aligned ends can move beyond the seeds by no more than an unseeded stretch, but agree as far as the texts do.
    side = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("lo").alias("t"), F.element_at("x", 1).alias("a"), F.element_at("x", -1).alias("b")),
        F.struct(F.lit(1).alias("side"), F.col("hi").alias("t"), F.element_at("y", 1).alias("a"), F.element_at("y", -1).alias("b")),
    ))
    regions = found.select("id", side.alias("s")).select("id", "s.*")
    regions = regions.select("id", "side", "t", (F.col("a") - 2 * LEAST).cast("long").alias("from"), (F.col("b") + K + 2 * LEAST).cast("long").alias("to"))
    wanted = regions.select("t").distinct()
    one_each = known.join(wanted, "t").groupBy("t").agg(F.min("doc_id").alias("doc_id"))
    held = rows.join(one_each.withColumnRenamed("doc_id", "_id"), "t").where(F.col("doc_id").eqNullSafe(F.col("_id"))).select("t", "text")
    cut = _cut(regions.join(held, "t").select("id", "side", "t", "from", "to", "text"))
    # Both sides of a chain meet in one shuffle; a repeated row of a text gives the same words again.
    ends = [F.max(F.when(F.col("side") == side, F.col(column))).alias(name) for side, column, name in ((0, "first", "fa"), (0, "words", "a"), (1, "first", "fb"), (1, "words", "b"))]
    sides = cut.groupBy("id").agg(*ends)
    both = found.join(sides, "id").select("lo", "hi", "x", "y", "fa", "a", "fb", "b")

    names = ("lo", "hi", "start", "end", "other_start", "other_end", "edits")
    schema = StructType([StructField(n, LongType()) for n in names])

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lo, hi, x, y, fa, a, fb, b in zip(*(c.to_pylist() for c in batch.columns)):
                wa, wb = np.frombuffer(a, np.uint32).tolist(), np.frombuffer(b, np.uint32).tolist()
                ax, ex, by, ey, n = aligned(wa, wb, [i - fa for i in x], [i - fb for i in y])
                if min(ex - ax, ey - by) >= least and n * 100 <= edits * max(ex - ax, ey - by):
                    out.append((lo, hi, ax + fa, ex + fa, by + fb, ey + fb, n))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(7)], names=list(names))

    pairs = durable(map_arrow(both, align, schema), "passage-pairs")
    mirrored = pairs.select(F.col("hi").alias("t"), F.col("lo").alias("p"), "other_start", "other_end", "start", "end", "edits")
    per_text = pairs.select(F.col("lo").alias("t"), F.col("hi").alias("p"), "start", "end", "other_start", "other_end", "edits").union(mirrored).distinct()
    # Of equal texts the smallest id stands for a partner; among themselves each one's partner is the smallest, whose own is the next.
    ids = known.groupBy("t").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.max("n_words").alias("n_words"))
    copied = known.join(ids.where((F.col("copies") > 1) & (F.col("n_words") >= least)).select("t", "first_id"), "t")
    second = copied.where("doc_id <> first_id").groupBy("t").agg(F.min("doc_id").alias("second_id"))
    copied = copied.join(second, "t", "left").withColumn("partner_id", F.when(F.col("doc_id") == F.col("first_id"), F.coalesce("second_id", "first_id")).otherwise(F.col("first_id")))
    n = F.col("n_words").cast("long")
    zero = F.lit(0).cast("long")
    whole = copied.select("doc_id", zero.alias("start_word"), n.alias("end_word"), "partner_id", zero.alias("partner_start"), n.alias("partner_end"), zero.alias("edits"))
    parts = known.select("doc_id", "t").join(per_text, "t").join(ids.select(F.col("t").alias("p"), F.col("first_id").alias("partner_id")), "p")
    parts = parts.select("doc_id", F.col("start").alias("start_word"), F.col("end").alias("end_word"), "partner_id", F.col("other_start").alias("partner_start"),
                         F.col("other_end").alias("partner_end"), "edits")
    return parts.union(whole)


@query("op4_repeated_passages")
def op4(spark, folder):
    return passages(documents(spark, folder))
