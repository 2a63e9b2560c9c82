"""Exact NTILE over a whole table without bringing the table into one task."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, NumericType, TimestampNTZType, TimestampType
from pyspark.sql.window import Window

from tellerflow.operators.sinks import durable, partitions_for

_MARGIN, _ACCURACY = 0.001, 10_000  # share of the values on either side of a cut in its bracket; one over the sketch's error
_ROW_BITS = 33  # monotonically_increasing_id keeps the row position below this bit


def tile_starts(rows: int, tiles: int) -> list[int | None]:
    """Zero-based rank at which tile 2, 3, ... begins; None where there are too few rows for the tile."""
    size, extra = divmod(rows, tiles)
    starts = [tile * size + min(tile, extra) for tile in range(1, tiles)]
    return [s if s < rows else None for s in starts]


def ntile_cuts(rows: DataFrame, row_id: str, orders: Mapping[str, Column], tiles: int = 5) -> dict[str, list[tuple | None]]:
    """First (value, id) of tiles 2..n for each named ascending order, NULL first, for all orders at once.

    One aggregate sketches quantiles on both sides of every cut, the next one counts
    exactly how many rows lie before and inside such a bracket, and only rows inside
    one are sorted, by (value, id) in their own types. What comes to the driver is
    two quantiles and two counts per cut, one count per partition and the cut rows. The sketch only chooses brackets: where the
    counts show that a cut is elsewhere, or a type has no quantiles, the whole
    order is one bracket. The unique id keeps equal values apart: a value held by
    a third of the rows is still split evenly.
    """
    values = [f"v{i}" for i in range(len(orders))]
    keyed = rows.select(F.col(row_id).alias("id"), *[order.alias(v) for v, order in zip(values, orders.values())])
    held = keyed.agg(F.count("*").alias("n"), *[F.count(v).alias(v) for v in values]).first()
    starts = tile_starts(held["n"], tiles)
    ranks = sorted({start for start in starts if start is not None})
    if not ranks:
        return {name: [None] * (tiles - 1) for name in orders}

    kinds = {v: keyed.schema[v].dataType for v in values}
    shares = {v: _shares(ranks, held["n"] - held[v], held["n"]) for v in values}
    sketched = [v for v in values if shares[v] and _has_quantiles(kinds[v])]
    sketch = keyed.agg(*[F.percentile_approx(v, shares[v], _ACCURACY).alias(v) for v in sketched]).first() if sketched else {}
    brackets = {v: _brackets(v, kinds[v], sketch[v] if v in sketched else None, ranks, held["n"] - held[v], held["n"]) for v in values}
    counts = [F.count_if(c).alias(f"{v}_{part}_{i}") for v in values for i, b in enumerate(brackets[v]) for part, c in (("before", b.before), ("inside", b.inside))]
    counted = keyed.agg(*counts).first()
    place: dict[tuple[str, int], int] = {}  # of a cut among all rows that are sorted
    chosen: dict[str, Column] = {}
    total = 0
    for v in values:
        found = [(b, counted[f"{v}_before_{i}"], counted[f"{v}_inside_{i}"]) for i, b in enumerate(brackets[v])]
        if any(not before <= rank < before + inside for b, before, inside in found for rank in b.ranks):
            found = [(Bracket(ranks, F.lit(False), F.lit(True)), 0, held["n"])]
        for b, before, inside in found:
            place.update({(v, rank): total + rank - before for rank in b.ranks})
            total += inside
        chosen[v] = reduce(or_, [b.inside for b, _, _ in found])

    def entry(number: int, mine: str) -> Column:
        others = [(F.col(v) if v == mine else F.lit(None).cast(kinds[v])).alias(v) for v in values]
        return F.when(chosen[mine], F.struct(F.lit(number).alias("order"), *others, F.col("id").alias("id")))

    inside = keyed.select(F.explode(F.array(*[entry(i, v) for i, v in enumerate(values)])).alias("s")).where("s is not null").select("s.*")
    placed = in_order(inside, ["order", *values, "id"])
    sizes = {r["part"]: r["n"] for r in _sizes(placed).collect()}  # one row per partition
    if sum(sizes.values()) != total:
        raise ValueError("rows changed while their tiles were cut")
    wanted = {key: _position(sizes, at) for key, at in place.items()}
    rows_at = {r["pos"]: r for r in placed.where(F.col("pos").isin(*set(wanted.values()))).collect()}  # tiles - 1 rows per order
    cut = {key: (rows_at[at][key[0]], rows_at[at]["id"]) for key, at in wanted.items()}
    return {name: [None if start is None else cut[v, start] for start in starts] for name, v in zip(orders, values)}


class Bracket(NamedTuple):
    """Rows of an order that hold the given ranks, and the rows before them."""

    ranks: list[int]
    before: Column
    inside: Column


def _has_quantiles(kind: DataType) -> bool:
    """Types that ``percentile_approx`` takes; wider decimals are sorted whole."""
    return kind.precision <= 18 if isinstance(kind, DecimalType) else isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType))


def _shares(ranks: list[int], nulls: int, rows: int) -> list[float]:
    """Below and above each rank that is not a NULL's, as shares of the values."""
    at = [(rank - nulls) / (rows - nulls) for rank in ranks if rank >= nulls]
    return [min(max(share, 0.0), 1.0) for p in at for share in (p - _MARGIN, p + _MARGIN)]


def _brackets(v: str, kind: DataType, quantiles: list | None, ranks: list[int], nulls: int, rows: int) -> list[Bracket]:
    """Disjoint brackets in ascending order, by the quantiles of ``_shares``."""
    value = F.col(v)
    out = [Bracket([r for r in ranks if r < nulls], F.lit(False), value.isNull())]
    ranks_left = [r for r in ranks if r >= nulls]
    if ranks_left and (not quantiles or any(q is None or q != q for q in quantiles)):  # no quantiles, or NaN among them
        return [Bracket(ranks, F.lit(False), F.lit(True))]
    spans: list[list] = []  # [low, high, ranks]
    for rank, low, high in zip(ranks_left, (quantiles or [])[::2], (quantiles or [])[1::2]):
        if spans and low <= spans[-1][1]:
            spans[-1][1:] = [max(high, spans[-1][1]), [*spans[-1][2], rank]]
        else:
            spans.append([low, high, [rank]])
    for low, high, mine in spans:
        low, high = F.lit(low).cast(kind), F.lit(high).cast(kind)
        out.append(Bracket(mine, value.isNull() | (value < low), (value >= low) & (value <= high)))
    return [b for b in out if b.ranks]


def in_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in total order over range partitions, with ``pos`` = (partition, place in it).

    Written out before use: the sampled range bounds differ between two
    evaluations, the written positions do not. Keys must be unique together.
    """
    placed = rows.repartitionByRange(partitions_for(rows), *keys).sortWithinPartitions(*keys)
    return durable(placed.withColumn("pos", F.monotonically_increasing_id()), "ordered")


def _sizes(placed: DataFrame) -> DataFrame:
    return placed.groupBy(F.shiftright("pos", _ROW_BITS).alias("part")).agg(F.count("*").alias("n"))


def _position(sizes: Mapping[int, int], rank: int) -> int:
    """The ``pos`` value of a zero-based global rank."""
    for part in sorted(sizes):
        if rank < sizes[part]:
            return (part << _ROW_BITS) + rank
        rank -= sizes[part]
    raise ValueError("rank beyond the last row")


def dense_ids(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number all rows 1..n in key order; equal to ROW_NUMBER() OVER (ORDER BY keys), without one task sorting all."""
    placed = in_order(rows, keys)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    offsets = _sizes(placed).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = placed.withColumn("part", F.shiftright("pos", _ROW_BITS))
    place = F.col("pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(offsets, "part").withColumn(name, F.col("offset") + place + 1).drop("part", "pos", "offset")


def tile_of(value: Column, row_id: Column, cuts: list[tuple | None], kind: DataType) -> Column:
    """The tile of a row: one plus the number of cuts at or below it, NULL first. A narrow expression."""
    tile = F.lit(1)
    for cut in cuts:
        if cut is not None:
            v, i = F.lit(cut[0]).cast(kind), F.lit(cut[1])
            after = value.isNotNull() if cut[0] is None else F.coalesce(value > v, F.lit(False))
            tile = tile + (after | (value.eqNullSafe(v) & (row_id >= i))).cast("int")
    return tile


def ntile(rows: DataFrame, row_id: str, orders: Mapping[str, Column], tiles: int = 5) -> DataFrame:
    """Add one tile column per named order; equal to NTILE(tiles) OVER (ORDER BY value, id)."""
    cuts = ntile_cuts(rows, row_id, orders, tiles)
    kinds = rows.select(*[order.alias(name) for name, order in orders.items()]).schema
    return rows.withColumns({name: tile_of(order, F.col(row_id), cuts[name], kinds[name].dataType) for name, order in orders.items()})
