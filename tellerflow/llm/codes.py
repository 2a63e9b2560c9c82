"""Vector codes by product quantisation in whole numbers.

A component x becomes floor(SCALE * x); a vector is cut into ``PARTS`` equal
consecutive parts, and each position has a codebook of ``ENTRIES`` parts. The
codebooks start as those of the vectors with the smallest ids. A round assigns
every part to its nearest entry (squared Euclidean distance, ties to the lower
index) and replaces an entry by the componentwise floor of its parts' mean; an
entry without parts stays. After ``ROUNDS`` rounds parts are assigned again.

The nearest entry is found in the Walsh-Hadamard domain: parts and entries are
padded with zeros to a power of two and transformed in whole numbers, which
multiplies squared distances by the padded width. Squared differences add up in
sequency order, in which smooth parts differ early; an entry whose partial sum
passes the distance of an entry known in full is out, one that equals it is not.
So the scaled distances that remain are exact, and a division without remainder
gives the distance. There is no floating point after the floor.

Each round is one pass over the stored whole numbers: a task adds up its parts
per entry, Spark adds up the tasks, and PARTS x ENTRIES rows reach the driver.
Batches whose numbers could pass 64 bits are worked out in Python's integers.

Defined cases: rows whose vector is NULL or holds a NULL or non-finite component
are left out. A vector shorter than the longest, or whose length PARTS does not
divide, is filled up with zeros at its end, which changes no distance. Vectors
with equal ids start codebooks in the order of their components; a NULL id comes
after all others. Fewer than ENTRIES vectors make fewer entries. A NULL label is
a label. A sum of errors beyond 64 bits is NULL. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tellerflow.llm.registry import query
from tellerflow.llm.workers import map_arrow
from tellerflow.operators.sinks import durable

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
_ROWS = 4096  # vectors worked on at once
_NUMBERS = 1 << 20  # components worked on at once
_LIMB = 40  # sums travel in pieces of so many bits, so that no number of tasks overflows them


@dataclass(frozen=True)
class Codes:
    """(vec_id, label, code, error) of every coded row, and the final codebooks: part, entry, component."""

    rows: DataFrame
    books: list[list[list[int]]]


def sequency_order(n: int) -> list[int]:
    """Rows of the n x n Walsh-Hadamard matrix by their number of sign changes."""
    bits = n.bit_length() - 1
    gray = [i ^ (i >> 1) for i in range(n)]
    return [sum((g >> b & 1) << (bits - 1 - b) for b in range(bits)) for g in gray]


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of each row, filled up with zeros to a power of two, in whole numbers; sequency order."""
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), n), x.dtype)
    y[:, : x.shape[1]] = x
    half = 1
    while half < n:
        pairs = y.reshape(len(x), n // (2 * half), 2, half)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), n)
        half *= 2
    return y[:, sequency_order(n)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each part's nearest entry, ties to the lower index."""
    own, book = walsh_hadamard(parts), walsh_hadamard(entries)
    n = own.shape[1]
    scaled = (own[:, :1] - book[None, :, 0]) ** 2
    guess = np.argmin(scaled, 1)
    bound = ((own - book[guess]) ** 2).sum(1)  # of one entry in full
    row, entry = np.nonzero(scaled <= bound[:, None])
    scaled = scaled[row, entry]
    for c in range(1, n):
        scaled = scaled + (own[row, c] - book[entry, c]) ** 2
        keep = scaled <= bound[row]
        row, entry, scaled = row[keep], entry[keep], scaled[keep]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))  # every row keeps an entry
    least = np.minimum.reduceat(scaled, first)
    best = np.flatnonzero(scaled == least[row])
    best = best[np.unique(row[best], return_index=True)[1]]
    return entry[best], least // n


def _floored(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as 64-bit numbers where squared distances fit, otherwise as Python's integers."""
    values = values.astype(np.float64)
    if not values.size or np.abs(values).max() < (1 << 26) / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    exact = [int(np.floor(x * SCALE)) if abs(x) < 1e15 else int(x) * SCALE for x in values.ravel()]
    return np.array(exact, object).reshape(values.shape)


def _parts(column: pa.Array, width: int) -> np.ndarray:
    """(rows, PARTS, width) whole numbers; short vectors end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    full = np.zeros((len(column), PARTS * width), np.float64)
    full[np.arange(PARTS * width)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return _floored(full).reshape(len(column), PARTS, width)


def _pieces(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, _NUMBERS // (PARTS * width))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _assigned(parts: np.ndarray, books: np.ndarray, position: int) -> tuple[np.ndarray, np.ndarray]:
    own, book = parts[:, position], books[position]
    # A scaled distance is at most (2 * largest * padded width) squared.
    wide = len(own) and 2 * max(abs(own).max(), abs(book).max()) * 2 * own.shape[1] >= 1 << 31
    kind = object if wide else np.int64
    return nearest(own.astype(kind), book.astype(kind))


def _sums(rows: DataFrame, books: list, width: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """How many parts each (position, entry) has, and their componentwise sum."""
    fields = ["part", "entry", "component", "limb"]
    schema = StructType([*[StructField(f, IntegerType()) for f in fields], StructField("value", LongType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = np.array(books, object)
        total = np.zeros((PARTS, book.shape[1], width + 1), object)  # the last one counts
        for piece in _pieces(batches, width):
            parts = _parts(piece.column("v"), width)
            for p in range(PARTS):
                entry, _ = _assigned(parts, book, p)
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                total[p, used, :width] += np.add.reduceat(parts[order, p], first, axis=0)
                total[p, used, width] += np.diff([*first, len(order)])
        out = [[] for _ in schema.names]
        for p, e, c in np.argwhere(total != 0).tolist():
            rest, limb = int(total[p, e, c]), 0
            while rest:
                low = rest if -(1 << _LIMB) < rest < 1 << _LIMB else rest & ((1 << _LIMB) - 1)
                for column, value in zip(out, (p, e, c, limb, low)):
                    column.append(value)
                rest, limb = (rest - low) >> _LIMB, limb + 1
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int32() if i < 4 else pa.int64()) for i, o in enumerate(out)], names=schema.names)

    found: dict = {}
    for r in map_arrow(rows.select("v"), work, schema).groupBy(*fields).agg(F.sum("value").alias("value")).collect():  # of the codebooks' size
        count = found.setdefault((r.part, r.entry), [0] * (width + 1))
        count[r.component] += r.value << (_LIMB * r.limb)
    return {at: (values[width], values[:width]) for at, values in found.items()}


def quantise(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label") -> Codes:
    """Learn the codebooks over all rows and code them."""
    spark = vectors.sparkSession
    v = F.col("v")
    kind = vectors.schema[vector].dataType.simpleString()
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"),
        F.col(f"`{vector}`").cast(kind if kind in ("array<float>", "array<double>") else "array<double>").alias("v"),
    )
    rows = rows.where(v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    seen = Observation()
    rows = durable(rows.observe(seen, F.max(F.size("v")).alias("longest")), "code-vectors")
    width = max(1, -(-(seen.get["longest"] or 0) // PARTS))

    first = rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).toArrow().column("v").combine_chunks()
    books = _parts(first, width).transpose(1, 0, 2).tolist()
    for _ in range(ROUNDS if len(first) else 0):
        for (part, entry), (count, sums) in _sums(rows, books, width).items():
            books[part][entry] = [s // count for s in sums]

    schema = StructType([StructField("vec_id", LongType()), rows.schema["label"], StructField("code", StringType()), StructField("error", LongType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = np.array(books, object)
        for piece in _pieces(batches, width):
            parts = _parts(piece.column("v"), width)
            found = [_assigned(parts, book, p) for p in range(PARTS)]
            digits = np.stack([entry for entry, _ in found], 1).astype(np.uint8).tobytes().hex()
            code = [digits[i : i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)]
            error = sum(distance.astype(object) for _, distance in found)
            fits = pa.array([int(e) if e < 1 << 63 else None for e in error], pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column("vec_id"), piece.column("label"), pa.array(code, pa.string()), fits], names=schema.names)

    return Codes(durable(map_arrow(rows, work, schema), "codes") if len(first) else spark.createDataFrame([], schema), books)


def books_digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for part in books for entry in part for x in entry).encode()).hexdigest()


def with_label_errors(rows: DataFrame) -> DataFrame:
    """Add label_error, the sum of error over the rows of a label."""
    whole = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = rows.groupBy("label").agg(whole.try_cast("bigint").alias("label_error")).withColumnRenamed("label", "_label")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def _sql() -> str:
    square = "(x[i] - e[i]) * (x[i] - e[i])"

    def assigned(book: str) -> str:
        each = f"select vec_id, part, any_value(x) as x, min([d, entry::hugeint]) as best from (select vec_id, p.part, x, entry, list_sum([{square} for i in range(1, len(x) + 1)])::hugeint as d from parts p join {book} b on p.part = b.part) group by vec_id, part"
        return f"select vec_id, part, x, best[1] as d, best[2]::int as entry from ({each})"

    rounds = ""
    for r in range(1, ROUNDS + 1):
        rounds += f"""
a{r} as materialized ({assigned(f'b{r - 1}')}),
m{r} as (select part, entry, list((s - ((s % n) + n) % n) // n order by i) as e from
        (select part, entry, i, sum(x[i])::hugeint as s, count(*)::hugeint as n from (select part, entry, x, unnest(range(1, len(x) + 1)) as i from a{r}) group by part, entry, i) group by part, entry),
b{r} as materialized (select b.part, b.entry, coalesce(m.e, b.e) as e from b{r - 1} b left join m{r} m on b.part = m.part and b.entry = m.entry),"""
    return f"""
with kept as (select vec_id, label, [floor({SCALE} * c::double)::bigint::hugeint for c in embedding] as v from embeddings
              where embedding is not null and len([1 for c in embedding if c is null or not isfinite(c)]) = 0),
parts as materialized (select vec_id, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] as x from kept, range({PARTS}) t(part)),
b0 as materialized (select part, dense_rank() over (order by vec_id) - 1 as entry, x as e from parts where vec_id in (select vec_id from kept order by vec_id limit {ENTRIES})),
{rounds}
last as ({assigned(f'b{ROUNDS}')}),
coded as (select vec_id, string_agg(lpad(format('{{:x}}', entry), 2, '0'), '' order by part) as code, sum(d)::bigint as error from last group by vec_id),
book as (select sha256(string_agg(array_to_string(e, ','), ',' order by part, entry)) as codebooks_sha256 from b{ROUNDS})
select k.vec_id, c.code, c.error, (sum(c.error) over (partition by k.label))::bigint as label_error, book.codebooks_sha256
from kept k join coded c on k.vec_id = c.vec_id cross join book
"""


@query("op13_vector_codes", _sql())
def op13(spark, folder):
    found = quantise(spark.read.parquet(f"{folder}/embeddings.parquet"))
    rows = with_label_errors(found.rows).select("vec_id", "code", "error", "label_error")
    return rows.withColumn("codebooks_sha256", F.lit(books_digest(found.books)))
