"""Near-duplicate documents by SimHash fingerprints and deletion-variant signatures.

A document's fingerprint has bit i set if over half the XXH64 hashes (seed 42) of
its word shingles, repeats included, have it set. Two fingerprints are linked if
they differ in ``DISTANCE`` = 3 bits at most.

The 64 bits are cut into DISTANCE // 2 + 1 = 2 segments, fewer than it takes for
an equal one: of any linked pair one segment differs in one bit at most. A
fingerprint is indexed under each segment as it is and, for every bit of the
segment, under the segment with that bit as a wildcard. So every linked pair meets
in a signature, either an equal segment or one whose wildcard bit differs, and
pairs are joined on signatures and verified on all 64 bits. Equal fingerprints are
one class and are indexed once, however many documents have them.

A signature of more than ``MEMBERS`` fingerprints is not paired. Its pairs are
found by points that both ends meet in, as many rows as ends and no more:

* Fingerprints within one bit of the same point differ in two bits at most, so all
  of them link with the smallest. Every pair at distance two has such a point.
* A pair at distance three has a point two bits from the one and one bit from the
  other. Where a large signature still holds several components, the fingerprints
  outside its largest one go to the points two bits away that the signature leaves
  open, and link with the smallest fingerprint one bit from there.

Both are exact: every pair within a component's reach is found through links
between fingerprints of the corpus, and none is longer than DISTANCE.

Defined cases: NULL and empty texts and texts without words have fingerprint zero,
linked like any other; a text with fewer words than a shingle is one shingle. Rows
with a NULL doc_id take part; a component's id is its smallest non-NULL one. Repeated rows are
rows of one class. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tellerflow.llm.components import components
from tellerflow.llm.registry import documents, query
from tellerflow.llm.text import LOWER, SPACE, column_bytes, slices, words
from tellerflow.llm.workers import map_arrow
from tellerflow.operators.sinks import durable, partitions_for

WORDS, SEED, DISTANCE = 3, 42, 3
BITS = 64
SEGMENTS = DISTANCE // 2 + 1
WIDTH = BITS // SEGMENTS
MEMBERS = 32
_KINDS = WIDTH + 1  # signatures of a segment: one for each wildcard bit, and the whole
_AT_ONCE = 1 << 17  # shingles whose bits are counted at once
_DEALT_BYTES = 1 << 20  # of classes whose signatures one task makes


def _shingle_spans(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of every shingle, and for each row boundary the shingles before it."""
    counts = np.diff(at)
    each = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    to = np.concatenate([[0], np.cumsum(each)])
    first = np.arange(to[-1]) + np.repeat(at[:-1] - to[:-1], each)
    return first, first + np.repeat(np.minimum(counts, WORDS), each) - 1, to


def fingerprint_bits(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprints, as unsigned numbers, of texts given as one byte array with row offsets."""
    data = LOWER[data]
    starts, ends, at = words(data, offsets)
    length = ends - starts
    begin = np.cumsum(length + 1) - length - 1  # of each word where words are joined by one space
    joined = np.full(int((length + 1).sum()), 0x20, np.uint8)
    letters = np.ones(len(joined), bool)
    letters[begin + length] = False
    joined[letters] = data[~SPACE[data]]
    buffer = joined.tobytes()
    first, last, to = _shingle_spans(at)
    low, high = begin[first], begin[last] + length[last]
    sums = np.zeros((len(at) - 1, BITS), np.int64)
    for a in range(0, len(low), _AT_ONCE):
        b = min(a + _AT_ONCE, len(low))
        hashes = np.array([xxhash.xxh64_intdigest(buffer[s:e], SEED) for s, e in zip(low[a:b].tolist(), high[a:b].tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows = np.arange(np.searchsorted(to, a, "right") - 1, np.searchsorted(to, b, "left"))
        rows = rows[to[rows + 1] > to[rows]]  # with shingles in this part
        sums[rows] += np.add.reduceat(bits, np.maximum(to[rows] - a, 0), axis=0, dtype=np.int64)
    over = sums * 2 > np.diff(to)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp) of every row; fp holds the fingerprint's 64 bits in a signed number."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = StructType([StructField("doc_id", LongType()), StructField("fp", LongType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text", 4 << 20)):
            found = fingerprint_bits(*column_bytes(batch.column("text"))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=schema.names)

    return map_arrow(rows, work, schema)


def _long(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _bit(i: int) -> int:
    return _long(1 << i)


def _signatures(fp: Column) -> Column:
    """(key, bit) of every signature: the key names segment, wildcard and remaining bits; bit is what the wildcard hides."""
    out = []
    for segment in range(SEGMENTS):
        part = F.shiftrightunsigned(fp, segment * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))
        for wild in range(_KINDS):
            seen = part if wild == WIDTH else part.bitwiseAND(F.lit((1 << WIDTH) - 1 - (1 << wild)))
            hidden = F.lit(0) if wild == WIDTH else F.shiftright(part, wild).bitwiseAND(F.lit(1)).cast("int")
            key = seen.bitwiseOR(F.lit((segment * _KINDS + wild) << WIDTH))
            out.append(F.struct(key.alias("key"), hidden.alias("bit")))
    return F.array(*out)


def _kind(key: Column) -> Column:
    return F.shiftright(key, WIDTH).cast("int")


def _whole(key: Column) -> Column:
    return _kind(key) % _KINDS == WIDTH


def _open_points() -> list[list[int]]:
    """For each kind of signature the flips of two bits that lead from one end of a pair at distance three, met in that
    signature, to a point one bit from the other end: two bits of the other segment, or the wildcard and one of those."""
    out = []
    for segment in range(SEGMENTS):
        others = [i for i in range(BITS) if i // WIDTH != segment]
        out += [[_long(1 << (segment * WIDTH + wild) | 1 << i) for i in others] for wild in range(WIDTH)]
        out.append([_long(1 << i | 1 << j) for i in others for j in others if i < j])
    return out


def _linked(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def _near_points(fps: DataFrame) -> DataFrame:
    """(x, fp): every fingerprint with itself and the points one bit away."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_bit(i)).cast("long") for i in range(BITS)])
    return fps.select(F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("x"), "fp")


def _large_links(large: DataFrame, small_links: DataFrame) -> DataFrame:
    """Links that complete the components of the fingerprints in ``large``, the members (key, fp) of large signatures."""
    near = _near_points(large.select("fp").distinct())
    least = near.groupBy("x").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1").select("x", "v")
    two = near.join(least, "x").select(F.col("fp").alias("u"), "v").where("u <> v").distinct()
    links = durable(small_links.union(two), "simhash-links")

    labels = components(links)
    labelled = large.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("label", "fp").alias("label"))
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    ranked = labelled.join(sizes, "label", "left").withColumn("rank", F.struct(F.coalesce("size", F.lit(1)).alias("size"), "label"))
    mixed = ranked.groupBy("key").agg(F.max("rank").alias("most"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = durable(mixed.where("low <> high").select("key", F.col("most.label").alias("largest")), "simhash-mixed")
    members = durable(labelled.join(mixed, "key"), "simhash-apart")
    masks = F.element_at(F.lit(_open_points()), _kind(F.col("key")) + 1)
    far = members.where("label <> largest").select("fp", F.explode(masks).alias("m")).select(F.col("fp").bitwiseXOR(F.col("m")).alias("x"), "fp").distinct()
    least = _near_points(members.select("fp").distinct()).groupBy("x").agg(F.min("fp").alias("v"))
    three = far.join(least, "x").select(F.col("fp").alias("u"), "v").where(_linked(F.col("u"), F.col("v")))
    return links.union(three)


def _links(classes: DataFrame) -> DataFrame:
    """Links (u, v) between different fingerprints that give the components of all pairs at DISTANCE or less."""
    # A class becomes many signatures, so its few bytes are dealt to more tasks first.
    dealt = classes.repartition(partitions_for(classes, _DEALT_BYTES), "fp")
    signed = dealt.select("fp", F.inline(_signatures(F.col("fp"))))
    met = signed.groupBy("key").agg(F.count("*").alias("n"), F.sum("bit").alias("ones"), F.min("fp").alias("u"), F.max("fp").alias("v"))
    met = met.where((F.col("n") > 1) & (_whole(F.col("key")) | ((F.col("ones") > 0) & (F.col("ones") < F.col("n")))))
    met = durable(met, "simhash-signatures")
    twos = met.where((F.col("n") == 2) & _linked(F.col("u"), F.col("v"))).select("u", "v")
    members = durable(signed.join(met.where("n > 2").select("key", "n"), "key"), "simhash-members")
    small = members.where(F.col("n") <= MEMBERS)
    other = small.select("key", F.col("fp").alias("v"), F.col("bit").alias("_bit"))
    apart = _whole(F.col("key")) | (F.col("bit") != F.col("_bit"))
    pairs = small.join(other, "key").where((F.col("fp") < F.col("v")) & apart & _linked(F.col("fp"), F.col("v")))
    small_links = twos.union(pairs.select(F.col("fp").alias("u"), "v"))
    return _large_links(members.where(F.col("n") > MEMBERS).select("key", "fp"), small_links)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, component_id) of every row; documents linked through any chain share a component."""
    known = durable(fingerprints(docs, text, doc_id), "simhash")
    classes = durable(known.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    labels = components(_links(classes)).withColumnRenamed("node", "fp")
    ids = classes.join(labels, "fp", "left").select("fp", "least_id", F.coalesce("label", "fp").alias("label"))
    smallest = ids.groupBy("label").agg(F.min("least_id").alias("component_id"))
    ids = ids.join(smallest, "label").select("fp", "component_id")
    return known.join(ids, "fp").select("doc_id", "fp", "component_id")


@query("op12_simhash_duplicates")
def op12(spark, folder):
    found = near_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
