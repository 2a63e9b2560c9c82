"""Near-duplicate documents: fast similarity sketches, banding and exact verification.

A document is its set of distinct five-word shingles. Documents with equal sets
are one class and need no link. Each set gets a sketch of ``COORDINATES``
values, filled in rounds: in round j every element goes to one hashed coordinate
with a value between j and j + 1, and a coordinate keeps its smallest; once as
many rounds have passed as there are coordinates, round j feeds coordinate
j - COORDINATES only, so every coordinate fills. Two sets agree on a coordinate
with a probability equal to their similarity s, with concentration as if the
coordinates were independent. BANDS bands of ROWS coordinates are bucket keys:
at s = 0.85 two sets share none with probability (1 - 0.85**5)**25 < 5e-7, at
s = 0.8 with (1 - 0.8**5)**25 < 5e-5.

Links come from full sets, never from sketches:

1. Every bucket has a pivot, the class that meets the most others over all its
   buckets; a class and all classes of buckets it is the pivot of are its star.
   Every member of a star is compared with its pivot: as many pairs as members,
   however large the star.
2. Components of those links are found. In a group of copies most members are now
   in one.
3. A star that is still in several components is compared as a whole, as copies
   may be linked with each other and not with the pivot. It is dealt into blocks
   of bounded size, and each pair of blocks is one cell: a matrix product counts
   all shared shingles, and no more links leave it than join its components.

Defined cases: NULL and empty texts and texts without words have no shingles, no
links and their own id as component. Rows with a NULL doc_id take part; a
component's id is the smallest non-NULL one, and such a row is kept only if the
component has none. Repeated rows are copies with one id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tellerflow.llm.components import components
from tellerflow.llm.registry import documents, query
from tellerflow.llm.text import LOWER, column_bytes, hash_spans, mix, shingles, slices, words
from tellerflow.llm.workers import map_arrow, ship
from tellerflow.operators.sinks import durable

WORDS, PERCENT = 5, 85
ROWS, BANDS = 5, 25
COORDINATES = ROWS * BANDS
BLOCK_MEMBERS, BLOCK_SHINGLES = 512, 1_000_000
SLICE = 256 << 10  # bytes of text at a time; the arrays made of them take some thirty times as much
_FREE = np.uint64(2**64 - 1)


def sketch(values: np.ndarray, at: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """A row of t values per set; ``values[at[i]:at[i + 1]]`` is set i. An empty set's row stays free."""
    rows = len(at) - 1
    out = np.full(rows * t, _FREE, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(at))
    for j in range(2 * t):
        if not len(row):
            break
        h = mix(values ^ mix(np.full(1, j + 1, np.uint64)))
        value = (np.uint64(j) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        place = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if j < t else j - t
        np.minimum.at(out, row * t + place, value)
        if j < 2 * t - 1:
            open_ = (out.reshape(rows, t) == _FREE).any(1)
            keep = open_[row]
            row, values = row[keep], values[keep]
    return out.reshape(rows, t)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and row; different bands never share a key on purpose."""
    parts = sketches.reshape(len(sketches), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key * np.uint64(0xA0761D6478BD642F) + parts[:, :, i])
    return key


def _shingled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = column_bytes(batch.column("text"))
    data = LOWER[data]
    starts, ends, at = words(data, offsets)
    return shingles(hash_spans(data, starts, ends), at, WORDS)


def _fingerprints(values: np.ndarray, at: np.ndarray) -> list[bytes]:
    """128 bits of each set: two sums over its mixed elements."""
    sums = []
    for salt in (1, 2):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)), out=total[1:])
        sums.append(mix(total[at[1:]] - total[at[:-1]]))
    return [x.tobytes() for x in np.stack(sums, 1).astype(">u8")]


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, n_shingles, keys) of every row of (doc_id, text_hash, text)."""
    schema = StructType([
        StructField("doc_id", LongType()), StructField("text_hash", LongType()), StructField("node", BinaryType()),
        StructField("n_shingles", LongType()), StructField("keys", ArrayType(LongType())),
    ])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text", SLICE)):
            values, at = _shingled(batch)
            keys = band_keys(sketch(values, at)).astype(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(len(at), dtype=np.int32) * BANDS, keys.ravel())
            arrays = [batch.column("doc_id"), batch.column("text_hash"), pa.array(_fingerprints(values, at), pa.binary()), pa.array(np.diff(at)), lists]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_arrow(docs, work, schema)


def _sets(docs: DataFrame) -> DataFrame:
    """(node, shingles) of every row of (node, text)."""
    schema = StructType([StructField("node", BinaryType()), StructField("shingles", ArrayType(LongType()))])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text", SLICE)):
            values, at = _shingled(batch)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(at.astype(np.int32), values.view(np.int64))], names=schema.names)

    return map_arrow(docs, work, schema)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) with shared and total, the sizes of their full sets' intersection and union."""
    # The pivot first: rows are still small where one u has very many v.
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    both = pairs.select("u", "v").join(a, "u").join(b, "v")
    shared = F.size(F.array_intersect("su", "sv"))
    return both.select("u", "v", shared.alias("shared"), (F.size("su") + F.size("sv") - shared).alias("total"))


def _within_stars(stars: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that join different components of one star, found by comparing all its members block by block."""
    label = F.coalesce("label", "node").alias("label")
    rows = stars.join(labels, "node", "left").select("pivot", "node", "n", label)
    # Mixed stars have two members or more outside the pivot's component; one alone has been compared with all there is.
    hub = labels.select(F.col("node").alias("pivot"), F.col("label").alias("hub"))
    rows = rows.join(hub, "pivot", "left").withColumn("apart", (F.col("label") != F.coalesce("hub", "pivot")).cast("int"))
    sizes = rows.groupBy("pivot").agg(F.count("*").alias("members"), F.sum("apart").alias("apart"), F.sum("n").alias("shingles"))
    sizes = sizes.where("apart > 0 and members > 1").withColumn(
        "blocks", F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    )
    sizes = durable(sizes.select("pivot", "blocks", "shingles"), "mixed-stars")
    small = sizes.where("blocks = 1").agg(F.sum("shingles")).first()[0] or 0  # stars of one block share cells
    dealt = rows.join(sizes, "pivot").withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.select("pivot", "node", "label", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), "blocks")
    cell = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("pivot"), F.lit(small // BLOCK_SHINGLES + 1))).otherwise(
        F.xxhash64("pivot", F.least("i", "j"), F.greatest("i", "j")))
    part = F.when(F.col("blocks") == 1, 0).otherwise(F.least("i", "j") * (1 << 16) + F.greatest("i", "j"))
    dealt = dealt.select(cell.alias("cell"), part.alias("part"), "pivot", "node", "label").join(sets, "node")
    return dealt.groupBy("cell").applyInArrow(lambda cell: _joining_links(cell, percent), "u binary, v binary")


def _joining_links(cell: pa.Table, percent: int) -> pa.Table:
    """Links that join the components of each star in a cell, no more than its members."""
    groups: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(cell.column("pivot").to_pylist(), cell.column("part").to_pylist())):
        groups.setdefault(key, []).append(i)
    nodes, labels = cell.column("node").to_pylist(), cell.column("label").to_pylist()
    lists = cell.column("shingles").combine_chunks()
    values, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    out: list[tuple[bytes, bytes]] = []
    for rows in groups.values():
        if len({labels[r] for r in rows}) < 2:
            continue
        own = [values[at[r] : at[r + 1]] for r in rows]
        size = np.array([len(o) for o in own])
        shared = _shared_counts(own)
        linked = shared * 100 >= (size[:, None] + size[None, :] - shared) * percent
        parent = {labels[r]: labels[r] for r in rows}

        def top(x: bytes) -> bytes:
            while parent[x] != x:
                x = parent[x]
            return x

        number = {name: k for k, name in enumerate(parent)}
        code = np.array([number[labels[r]] for r in rows])
        for a, b in np.argwhere(np.triu(linked & (code[:, None] != code[None, :]), 1)).tolist():
            x, y = top(labels[rows[a]]), top(labels[rows[b]])
            if x != y:
                parent[x] = y
                out.append((nodes[rows[a]], nodes[rows[b]]))
    return pa.table({"u": pa.array([o[0] for o in out], pa.binary()), "v": pa.array([o[1] for o in out], pa.binary())})


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections: products of the sets' incidence matrix, some elements at a time."""
    element = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    total = np.zeros((len(sets), len(sets)), np.int64)
    step = max(1, (8 << 20) // len(sets))
    for low in range(0, int(element[-1]) + 1 if len(element) else 0, step):
        a, b = np.searchsorted(element, [low, low + step])
        part = np.zeros((len(sets), step), np.float32)  # counts below 2**24 are exact
        part[owner[a:b], element[a:b] - low] = 1
        total += (part @ part.T).astype(np.int64)
    return total


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; copies linked through any chain share a component.

    Two documents are linked if they share at least ``percent`` per hundred of their shingles' union."""
    ship(docs.sparkSession)
    content = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(content).alias("text_hash"), content.alias("text"))
    known = durable(sketches(rows), "sketches")
    classes = durable(
        known.where("n_shingles > 0").groupBy("node")
        .agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash")).alias("from"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")),
        "classes",
    )
    members = classes.select("node", "n", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = durable(members.join(shared, "key"), "bucket-members")
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    # Degree first; among equals the order is that of a hash.
    rank = F.shiftleft(F.least("degree", F.lit(1 << 40)), 22).bitwiseOR(F.xxhash64("node").bitwiseAND(F.lit((1 << 22) - 1)))
    pivots = members.join(degrees, "node").groupBy("key").agg(F.max(F.struct(rank, "node")).alias("best")).select("key", F.col("best.node").alias("pivot"))
    stars = durable(members.select("key", "node", "n").join(pivots, "key").where("node <> pivot").select("pivot", "node", "n").distinct(), "stars")

    wanted = stars.select("node").union(stars.select("pivot")).distinct()
    wanted = wanted.join(classes.select("node", "from.*"), "node").select("node", F.col("doc_id").alias("want_id"), F.col("text_hash").alias("want_hash"))
    texts = rows.join(wanted, (F.col("text_hash") == F.col("want_hash")) & F.col("doc_id").eqNullSafe(F.col("want_id")))
    sets = durable(_sets(texts.select("node", "text")).dropDuplicates(["node"]), "shingle-sets")

    first = _verified(stars.select(F.col("pivot").alias("u"), F.col("node").alias("v")), sets)
    links = durable(first.where(F.col("shared") * 100 >= F.col("total") * percent).select("u", "v"), "pivot-links")
    labels = components(links)
    labels = components(links.union(_within_stars(stars, labels, sets, percent)))

    ids = classes.select("node", "least_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = ids.groupBy("label").agg(F.min("least_id").alias("component_id"))
    ids = ids.join(smallest, "label").select("node", "component_id")
    found = known.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = f"""
with recursive cut as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}'), '[^\\x20\\x09-\\x0D]+') as w from {{docs}}),
piece as (select doc_id, case when len(w) = 0 then [] when len(w) < {WORDS} then [array_to_string(w, ' ')]
                         else list_distinct([array_to_string(w[i:i + {WORDS - 1}], ' ') for i in range(1, len(w) - {WORDS - 2})]) end as s from cut),
shingle as (select doc_id, len(s) as n, unnest(s) as sh from piece),
link as (select a.doc_id as x, b.doc_id as y from shingle a join shingle b on a.sh = b.sh and a.doc_id <> b.doc_id
         group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reach(x, y) as (select doc_id, doc_id from piece union select r.x, l.y from reach r join link l on r.y = l.x),
near as (select p.doc_id, len(p.s) as n_shingles, min(r.y) as component_id, p.doc_id = min(r.y) as kept
         from piece p join reach r on p.doc_id = r.x group by p.doc_id, len(p.s))
"""


@query("op5_near_duplicates", SQL.format(docs="documents") + "select * from near")
def op5(spark, folder):
    return near_duplicates(documents(spark, folder))
