"""Benchmark decontamination: find passages of documents within a small edit distance of a benchmark item.

Texts are compared as words: ASCII letters lower-cased, ASCII punctuation
dropped. An item of n words is found in a document if some passage differs from
it by at most ``edits`` per hundred of n word insertions, deletions and
substitutions.

Windows sized by the item (the power of two between n/6 and n/3 words, halved
where the recall below asks for it) are embedded by random walks: a walk reads the window's current word at every step
and moves on or stays by a random bit of (step, word), for two steps per word,
with a padding word after the end. Walks over two windows at a small edit
distance fall into step again after each edit, so the embedded strings differ in
few places. A bucket key samples ``SAMPLED`` places of an embedded string; items
are indexed at every word, documents probed at a stride of a quarter window.
Walks are repeated until edited copies of the benchmark's own items, at the
largest distance allowed, are retrieved with ``recall``. Every retrieved place
is then verified by its exact edit distance.

Documents are never shuffled: the benchmark travels to them, in blocks of
``BLOCK_WORDS`` words, each a pass of its own.

Defined cases: NULL, empty and wordless texts match nothing, as items or as
documents; items of fewer than ``least`` words match nothing, as so short a
passage is no evidence; repeated items are found under each of their ids, and a
repeated document row is reported as often as it occurs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tellerflow.llm.edits import distance, masks_of
from tellerflow.llm.registry import documents, query
from tellerflow.llm.text import LOWER, column_bytes, hash_spans, mix, slices, words
from tellerflow.llm.workers import map_arrow

EDITS, LEAST, RECALL = 20, 5, 0.98
SAMPLED, MOST_WALKS, TRIALS = 6, 6, 300
BLOCK_WORDS = 2_000_000
_PAD = np.uint64(0x5851F42D4C957F2D)

_DROPPED = np.zeros(256, bool)
_DROPPED[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the column's normalised words, and the row offsets into them."""
    data, offsets = column_bytes(column)
    keep = ~_DROPPED[data]
    before = np.concatenate([[0], np.cumsum(keep)])
    data = LOWER[data[keep]]
    starts, ends, at = words(data, before[offsets])
    return hash_spans(data, starts, ends), at


def window_of(n: int) -> int:
    """Words in a window for items of n words."""
    return 1 << max(0, (n // 3).bit_length() - 1)


class Embedding:
    """Bucket keys of windows of ``size`` words: one key per walk."""

    def __init__(self, size: int, walks: int):
        self.size, self.steps = size, 2 * size
        rng = np.random.default_rng(size)
        self.stride = max(1, size // 4)
        count = min(SAMPLED, self.steps)
        self.walks = [(np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15 >> 8), set(rng.choice(self.steps, count, replace=False).tolist())) for k in range(walks)]

    def keys(self, hashes: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """For each walk the keys of the windows that begin at ``starts``; a window lies within the hashes."""
        ends, last = starts + self.size, len(hashes) - 1
        for salt, sampled in self.walks:
            here, key = starts.copy(), np.full(len(starts), salt, np.uint64)
            for block in range(0, self.steps, 64):  # 64 coin flips per word and walk at a time
                coins = mix(hashes ^ (salt + np.uint64(block)))
                for j in range(block, min(block + 64, self.steps)):
                    if j > max(sampled):
                        break
                    inside = here < ends if j >= self.size else None  # a walk cannot have left the window earlier
                    at = here if inside is None else np.minimum(here, last)
                    if j in sampled:
                        word = hashes[at] if inside is None else np.where(inside, hashes[at], _PAD)
                        key = (key ^ word) * np.uint64(0xA0761D6478BD642F)
                        key ^= key >> np.uint64(29)
                    step = ((coins[at] >> np.uint64(j - block)) & np.uint64(1)).astype(here.dtype)
                    here += step if inside is None else step * inside
            yield mix(key)


class Items:
    """A block of benchmark items and, per window size, where each bucket key lies in them."""

    def __init__(self, ids: list, item_words: list[np.ndarray], edits: int, recall: float):
        self.ids, self.words, self.edits = ids, item_words, edits
        by_size = defaultdict(list)
        for k, w in enumerate(item_words):
            by_size[window_of(len(w))].append(k)
        self.sizes = []
        for size, members in sorted(by_size.items()):
            while not (walks := self._walks(size, members, recall)):
                size //= 2
            embedding = Embedding(size, walks)
            text = np.concatenate([item_words[k] for k in members])
            at = np.concatenate([[0], np.cumsum([len(item_words[k]) for k in members])])
            owner = np.repeat(np.arange(len(members)), np.diff(at))
            starts = np.arange(len(text))
            starts = starts[starts + size <= at[owner + 1]]
            place = starts - at[owner[starts]]
            keys = list(embedding.keys(text, starts))
            key, item, place = np.concatenate(keys), np.tile(np.array(members)[owner[starts]], walks), np.tile(place, walks)
            order = np.argsort(key, kind="stable")
            key = key[order]
            there = np.zeros(1 << 20, bool)
            there[(key >> np.uint64(44)).astype(np.int64)] = True
            self.sizes.append((embedding, key, item[order], place[order], there))
        self.masks: dict[int, dict[int, int]] = {}

    def _walks(self, size: int, members: list[int], recall: float) -> int:
        """Walks that retrieve ``recall`` of edited copies at the largest distance; 0 if that takes too many, and there
        are shorter windows. Measured on ``TRIALS`` edited items."""
        rng = np.random.default_rng(7)
        embedding, found = Embedding(size, MOST_WALKS), np.zeros(MOST_WALKS)
        for k in rng.choice(members, TRIALS):
            own = self.words[k]
            copy = list(own)
            for _ in range(len(own) * self.edits // 100):
                at, kind, new = int(rng.integers(len(copy))), rng.integers(3), np.uint64(rng.integers(1 << 62))
                copy[at : at + 1] = [[new], [copy[at], new], []][kind] if len(copy) > 1 else [new]
            copy = np.concatenate([rng.integers(1 << 62, size=int(rng.integers(embedding.stride))).astype(np.uint64), np.array(copy, np.uint64)])
            probes = np.arange(0, max(len(copy) - size + 1, 0), embedding.stride)
            for i, (a, b) in enumerate(zip(embedding.keys(own, np.arange(len(own) - size + 1)), embedding.keys(copy, probes))):
                if np.isin(b, a).any():
                    found[i:] += 1
                    break
        good = np.flatnonzero(found >= recall * TRIALS)
        return int(good[0]) + 1 if len(good) else 0 if size > 1 else MOST_WALKS

    def distance(self, item: int, text: np.ndarray) -> tuple[int, int]:
        """The least edit distance of the item to any passage of the text, and where the first such passage ends."""
        masks = self.masks.get(item)
        if masks is None:
            masks = self.masks[item] = masks_of(self.words[item].tolist())
        return distance(masks, len(self.words[item]), text.tolist(), anywhere=True)

    def matches(self, hashes: np.ndarray, at: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
        """(row, item) -> (edits, last word's position + 1) of the nearest passage within the allowed distance."""
        tried: set[tuple[int, int, int]] = set()
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for embedding, known, items, places, there in self.sizes:
            counts = np.maximum((np.diff(at) - embedding.size) // embedding.stride + 1, 0)
            row = np.repeat(np.arange(len(counts)), counts)
            if not len(row):
                continue
            starts = at[row] + (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * embedding.stride
            for keys in embedding.keys(hashes, starts):
                hit = np.flatnonzero(there[(keys >> np.uint64(44)).astype(np.int64)])
                low, high = np.searchsorted(known, keys[hit], "left"), np.searchsorted(known, keys[hit], "right")
                for h, a, b in zip(hit[high > low], low[high > low], high[high > low]):
                    r = int(row[h])
                    for item, place in zip(items[a:b].tolist(), places[a:b].tolist()):
                        begin = int(starts[h]) - place
                        if (r, item, begin) in tried:
                            continue
                        tried.add((r, item, begin))
                        n = len(self.words[item])
                        slack = n * self.edits // 100
                        low_, high_ = max(begin - slack, int(at[r])), min(begin + n + slack, int(at[r + 1]))
                        edits, end = self.distance(item, hashes[low_:high_])
                        if edits <= slack and (edits, low_ + end) < found.get((r, item), (n, 0)):
                            found[r, item] = edits, low_ + end
        return {k: (e, end - int(at[k[0]])) for k, (e, end) in found.items()}


def blocks(benchmark: DataFrame, text: str, item_id: str, edits: int, least: int, recall: float) -> Iterator[Items]:
    """The benchmark's items in blocks of bounded size, brought to the driver one after the other."""
    ids, held, total = [], [], 0
    rows = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    for r in rows.toLocalIterator():
        own, _ = word_hashes(pa.array([r.text], pa.string()))
        if len(own) >= least:
            ids.append(r.id)
            held.append(own)
            total += len(own)
        if total >= BLOCK_WORDS:
            yield Items(ids, held, edits, recall)
            ids, held, total = [], [], 0
    if ids:
        yield Items(ids, held, edits, recall)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
                 edits: int = EDITS, least: int = LEAST, recall: float = RECALL) -> DataFrame:
    """(doc_id, item_id, item_words, edits, end_word) for every document and item found in it: its nearest passage's
    edit distance, and the position of the word after it."""
    names = ("doc_id", "item_id", "item_words", "edits", "end_word")
    schema = StructType([StructField(n, LongType()) for n in names])
    picked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, item_text, item_id, edits, least, recall):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def work(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in (s for b in batches for s in slices(b, "text", 4 << 20)):
                found = items.matches(*word_hashes(batch.column("text")))
                ids = batch.column("doc_id").take(pa.array([r for r, _ in found], pa.int64()))
                rest = [(items.ids[i], len(items.words[i]), e, end) for (_, i), (e, end) in found.items()]
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([x[k] for x in rest], pa.int64()) for k in range(4))], names=list(names))

        out = out.union(map_arrow(picked, work, schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
                  edits: int = EDITS, least: int = LEAST, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text holds no benchmark item."""
    for block in blocks(benchmark, item_text, item_id, edits, least, recall):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def work(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in (s for b in batches for s in slices(b, text, 4 << 20)):
                found = shared.value.matches(*word_hashes(batch.column(text)))
                clean = np.ones(batch.num_rows, bool)
                clean[[r for r, _ in found]] = False
                yield batch.filter(pa.array(clean))

        docs = map_arrow(docs, work, docs.schema)
    return docs


@query("op1_decontamination")
def op1(spark, folder):
    return contaminated(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
