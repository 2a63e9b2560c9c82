"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams (one to three
letters, words padded by one space), best first; ties go to the smaller gram. A
document's own list is compared with each profile by the out-of-place distance:
the sum over its grams of how far the rank differs, with the full profile length
for a gram the profile lacks. The nearest profile wins, ties to the smaller name.

Profiles are counted over all training rows. Counts are summed per task before
the shuffle; only ``size`` grams per language reach the driver.

Defined cases: a text that is NULL, empty or without letters is ``und`` with
score 0. Rows with a NULL label or text teach nothing. Without any profile every
text is ``und``. Every input row gives one row; extra columns are carried by
``keep``, and give way to a result column of the same name.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tellerflow.llm.registry import documents, query
from tellerflow.llm.text import slices
from tellerflow.llm.workers import map_arrow

PROFILE = 400  # grams per profile
MAX_LANGUAGES = 2_000  # labels that may be learned; bounds what is collected to MAX_LANGUAGES * PROFILE rows
UNKNOWN = "und"
SLICE = 1 << 19  # text bytes in work at once; the arrays made of them take some hundred times as much
_GAP = 0x20


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    table = np.full(sys.maxunicode + 1, _GAP, np.int64)
    for code in range(sys.maxunicode + 1):
        if unicodedata.category(chr(code))[0] == "L":
            table[code] = ord(chr(code).lower()[0])
    return table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the texts as (row, gram) arrays in row order per gram length; runs of other characters are one space."""
    joined = " " + " ".join(texts) + " "
    x = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    row = np.repeat(np.arange(len(texts) + 1), [1, *(len(t) + 1 for t in texts)]) - 1
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != _GAP) | (x[:-1] != _GAP)
    x, row = x[keep], row[keep]
    letter = x != _GAP
    pair = (x[:-1] << 21) | x[1:]
    pair_row = np.where(letter[:-1], row[:-1], row[1:])
    inner = np.flatnonzero(letter[1:-1])
    parts = (
        (row[letter], x[letter]),
        (pair_row[letter[:-1] | letter[1:]], pair[letter[:-1] | letter[1:]]),
        (row[inner + 1], (pair[inner] << 21) | x[inner + 2]),
    )
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def train(labelled: DataFrame, text: str = "text", label: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """The profile of every label: its ``size`` most frequent grams, best first."""
    rows = labelled.select(F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where("label is not null and text is not null")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in (s for b in batches for s in slices(b, "text", SLICE)):
            labels = np.array(batch.column("label").to_pylist(), object)
            texts = np.array(batch.column("text").to_pylist(), object)
            for name in set(labels):
                found, n = np.unique(grams(list(texts[labels == name]))[1], return_counts=True)
                if name in totals:  # merge what this task has so far
                    found, at = np.unique(np.concatenate([totals[name][0], found]), return_inverse=True)
                    n = np.bincount(at, np.concatenate([totals[name][1], n])).astype(np.int64)
                totals[name] = found, n
        for name, (found, n) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["label", "gram", "n"]
            )

    schema = StructType([StructField("label", StringType()), StructField("gram", LongType()), StructField("n", LongType())])
    counts = map_arrow(rows, count, schema).groupBy("label", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("place", place).where(F.col("place") <= size)
    found = best.limit(size * (MAX_LANGUAGES + 1)).collect()
    profiles: dict[str, list[int]] = {}
    for r in sorted(found, key=lambda r: (r.label, r.place)):
        profiles.setdefault(r.label, []).append(r.gram)
    if len(profiles) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the labels")
    return profiles


class Profiles:
    """All profiles side by side: a sorted array of grams and each one's rank per language."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = sorted(profiles), size
        self.grams = np.unique(np.concatenate([np.asarray(profiles[n], np.int64) for n in self.names])) if profiles else np.zeros(0, np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, profiles[name]), k] = np.arange(len(profiles[name]))

    def nearest(self, gram: np.ndarray) -> tuple[str, float]:
        """Language and score of a text with these grams: 1 less its distance as a share of the largest possible one."""
        if not len(gram) or not self.names:
            return UNKNOWN, 0.0
        found, n = np.unique(gram, return_counts=True)
        own = found[np.argsort(-n, kind="stable")[: self.size]]
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        ranks = self.ranks[np.where(self.grams[at] == own, at, len(self.grams))]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(0)
        best = int(np.argmin(away))
        return self.names[best], float(1 - away[best] / (self.size * len(own)))


def predict(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = PROFILE,
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns with the language and the score (0 to 1) of every whole text, under ``names``. Profiles are at most
    MAX_LANGUAGES * size numbers and travel with the task."""
    keep = tuple(c for c in keep if c.lower() not in {n.lower() for n in names})
    ranks = Profiles(profiles, size)
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text"))
    schema = StructType([*[docs.schema[c] for c in keep], StructField(names[0], StringType()), StructField(names[1], DoubleType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "_text", SLICE)):
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            row, gram = grams(texts)
            order = np.argsort(row, kind="stable")
            gram, at = gram[order], np.searchsorted(row[order], np.arange(len(texts) + 1))
            done = [ranks.nearest(gram[a:b]) for a, b in zip(at, at[1:])]
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_arrow(picked, work, schema)


def held_out(doc_id: str = "doc_id"):
    """The fifth of the documents that profiles never learn from; a NULL id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")) % 5 == 0


def identified(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Learn from the documents that are not held out, predict all."""
    return predict(docs, train(docs.where(~held_out())), keep=keep, names=names)


@query("op7_language_id")
def op7(spark, folder):
    return identified(documents(spark, folder)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
