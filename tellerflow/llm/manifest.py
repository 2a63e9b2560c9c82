"""A Merkle manifest of a dataset: a hash tree per group, one over all groups, and a proof for every row.

A leaf is the SHA-256 of a row's fields. Leaves of a group stand in the order of
their ids; every ``ARITY`` neighbours become the hash of their digests, until one
node is left: the group's subroot. Subroots, in the order of their groups, become
the root in the same way.

The tree is built by grouping, not by joining. A row's rank in its group is
written in base ``ARITY``; its lowest ``DIGITS`` digits are columns, the rest
names its block. Grouping the digits away one after the other nests the child
structs of a block in one row, which holds ``ARITY ** DIGITS`` leaves at most, and
needs one shuffle by block. Roots of blocks are the leaves of the next tier,
until a group has one block. On the way down a block meets the proof of its own
root by grouping both under its name; one transform of the nested structs then
gives each leaf its siblings, and an explode the rows.

Ranks come from a range-partitioned order of (group, id): places inside a
partition, plus what the group has in earlier partitions, so that a group with a
third of all rows is no task of its own. Nothing of the data reaches the driver
but the largest group's size.

Defined cases: a NULL field is ``-``; a NULL group is a group, before all others;
rows with a NULL id come first in theirs. Rows with equal ids are leaves each, in
the order of their digests; repeated rows have the same leaf, at places of their
own. A lone leaf is its group's subroot, a lone subroot the root, and the proof of
both is empty. No rows give no rows. Texts of any length are hashed whole. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerflow.llm.registry import documents, query
from tellerflow.operators.ranking import in_order
from tellerflow.operators.sinks import durable

ARITY, DIGITS = 3, 6
BLOCK = ARITY**DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_ROW_BITS = 33  # of ``pos`` in a ranked order: the place in its partition
_STEPS = "array<struct<left:string,right:string>>"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def field_text(value: Column) -> Column:
    """A field as it enters its row's leaf: ``-``, or its length in bytes, a colon and the field."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(F.concat(*[field_text(f) for f in fields]))


def fold(leaf_digest: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof give."""
    return F.aggregate(proof, leaf_digest, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def proof_digest(proof: Column) -> Column:
    """The hash of all siblings of a proof, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""))


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add r, the place of a row in its group g from 0, and n, the group's size. ``order`` is unique within a group."""
    placed = in_order(rows, ["g", *order]).withColumn("part", F.shiftright("pos", _ROW_BITS))
    runs = placed.groupBy("part", "g").agg(F.min("pos").alias("first"), F.count("*").alias("size"))
    group = Window.partitionBy("g")  # a row per partition that holds some of the group
    earlier = F.sum("size").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        F.col("part").alias("_part"), F.col("g").alias("_g"), "first", F.coalesce(earlier, F.lit(0)).alias("earlier"), F.sum("size").over(group).alias("n")
    )
    both = placed.join(runs, (F.col("part") == F.col("_part")) & F.col("g").eqNullSafe(F.col("_g")))
    return both.withColumn("r", F.col("earlier") + F.col("pos") - F.col("first"))


def _blocks(items: DataFrame) -> DataFrame:
    """(g, block, n, kids, h): items (g, r, n, h, own) nested by the digits of r; h is the block's root."""
    digits = {f"d{j}": F.pmod(F.floor(F.col("r") / ARITY**j), F.lit(ARITY)).cast("tinyint") for j in range(DIGITS)}
    rows = items.select("g", F.floor(F.col("r") / BLOCK).alias("block"), "n", "h", "own", *[c.alias(k) for k, c in digits.items()])
    rows = rows.repartition("g", "block")
    inner = "own"
    for j in range(DIGITS):
        upper = [f"d{k}" for k in range(j + 1, DIGITS)]
        kids = F.array_sort(F.collect_list(F.struct(F.col(f"d{j}").alias("d"), "h", inner)))  # ARITY of them at most
        rows = rows.groupBy("g", "block", "n", *upper).agg(kids.alias("kids"))
        joined = digest(F.array_join(F.transform("kids", lambda c: c["h"]), ""))
        # Where a group has one node left, it is the root already.
        rows = rows.withColumn("h", F.when(F.col("n") > ARITY**j, joined).otherwise(F.col("kids")[0]["h"]))
        inner = "kids"
    return durable(rows, "manifest-blocks")


def _tiers(items: DataFrame, largest: int) -> list[DataFrame]:
    """Blocks of items, blocks of their roots and so on; a group ends in the tier in which it has one block."""
    tiers = [_blocks(items)]
    while largest > BLOCK:
        largest = -(-largest // BLOCK)
        n = F.ceil(F.col("n") / BLOCK)
        roots = tiers[-1].where(F.col("n") > BLOCK)
        tiers.append(_blocks(roots.select("g", F.col("block").alias("r"), n.alias("n"), "h", F.struct(F.col("block").alias("r")).alias("own"))))
    return tiers


def _leaves(blocks: DataFrame) -> DataFrame:
    """(g, own, h, up) of every leaf of blocks (g, n, kids, up), its proof within the block put before that of ``up``."""

    def step(kids: Column, child: Column) -> Column:
        beside = lambda test: F.array_join(F.transform(F.filter(kids, test), lambda c: c["h"]), "")
        return F.struct(beside(lambda c: c["d"] < child["d"]).alias("left"), beside(lambda c: c["d"] > child["d"]).alias("right"))

    def opened(level: int):
        inner = "kids" if level else "own"

        def children(node: Column) -> Column:
            def proof(child: Column) -> Column:
                longer = F.concat(F.array(step(node["kids"], child)), node["proof"])
                return F.when(F.col("n") > ARITY**level, longer).otherwise(node["proof"])

            return F.transform(node["kids"], lambda c: F.struct(c[inner].alias(inner), c["h"].alias("h"), proof(c).alias("proof")))

        return children

    nodes = F.array(F.struct("kids", F.col("up.proof").alias("proof")))
    for level in reversed(range(DIGITS)):
        nodes = F.flatten(F.transform(nodes, opened(level)))
    found = blocks.select("g", "up", F.explode(nodes).alias("leaf"))
    up = F.col("up").withField("proof", F.col("leaf.proof"))
    return found.select("g", F.col("leaf.own").alias("own"), F.col("leaf.h").alias("h"), up.alias("up"))


def _down(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Leaves of the first tier with their proofs; tops (g, tier, up) are what is known above each group's root."""
    found = None
    for tier in reversed(range(len(tiers))):
        above = tops.where(F.col("tier") == tier).select("g", F.lit(0).cast("long").alias("block"), "up")
        if found is not None:
            above = above.unionByName(found.select("g", F.col("own.r").alias("block"), "up"))
        rows = tiers[tier].drop("h").unionByName(above, allowMissingColumns=True)
        rows = rows.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "up")])  # two rows each
        found = _leaves(rows)
    return found


def _tops(tiers: list[DataFrame]) -> DataFrame:
    """(g, tier, h): every group's root and the tier it is in."""
    roots = [rows.where(F.col("n") <= BLOCK).select("g", F.lit(tier).alias("tier"), "h") for tier, rows in enumerate(tiers)]
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return out


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", doc_id: str = "doc_id", carry: Mapping[str, Column] | None = None
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, and the carried columns) of every row.

    ``proof`` lists from the leaf to the root the digests left and right of the
    row's node, each level's joined; ``fold`` and ``proof_digest`` read it.
    ``carry`` names columns over ``docs`` that are worked out in the same scan.
    """
    own = F.struct(F.col(f"`{doc_id}`").alias("doc_id"), *[c.alias(name) for name, c in (carry or {}).items()])
    rows = docs.select(
        F.col(f"`{group}`").cast("string").alias("g"), F.col(f"`{doc_id}`").alias("_id"), leaf([F.col(f"`{f}`") for f in fields]).alias("h"), own.alias("own")
    )
    # Hashed once: ordering by range reads its input twice. The row number keeps repeated rows in several tasks.
    rows = durable(rows.withColumn("_row", F.monotonically_increasing_id()), "manifest-leaves")
    ranked = _ranked(rows, ["_id", "h", "_row"]).select("g", "r", "n", "h", "own")
    largest = rows.groupBy("g").count().agg(F.max("count")).first()[0] or 0
    tiers = _tiers(ranked, largest)

    subroots = durable(_tops(tiers).select(F.lit(None).cast("string").alias("g"), F.col("g").alias("_id"), "h", F.struct(F.col("g").alias("of"), "tier").alias("own")), "manifest-subroots")
    above = _tiers(_ranked(subroots, ["_id"]).select("g", "r", "n", "h", "own"), subroots.count())
    root = F.struct(F.array().cast(_STEPS).alias("proof"), F.col("h").alias("root"))
    tops = _down(above, _tops(above).select("g", "tier", root.alias("up")))
    tops = tops.select(F.col("own.of").alias("g"), F.col("own.tier").alias("tier"), F.col("up").withField("subroot", F.col("h")).alias("up"))
    found = _down(tiers, tops)
    return found.select("own.doc_id", F.col("h").alias("leaf"), "up.subroot", "up.root", "up.proof", *[f"own.{name}" for name in carry or {}])


def _sql() -> str:
    text = lambda c: f"case when {c} is null then '-' else octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar end"
    whole = lambda body: " || ".join(text(c) if c != "text" else text(body) for c in FIELDS)
    bit = "case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end"
    sides = """select g, lvl, pos, coalesce(string_agg(h, '') over (partition by g, lvl, pos // 3 order by pos rows between unbounded preceding and 1 preceding), '') as l,
       coalesce(string_agg(h, '') over (partition by g, lvl, pos // 3 order by pos rows between 1 following and unbounded following), '') as r"""
    return f"""
with recursive crc(i, v, k) as (select i, i::bigint, 0 from range(256) t(i) union all select i, {bit}, k + 1 from crc where k < 8),
steps as (select list(v order by i) as t from crc where k = 8),
checked as (select d.*, xor(list_reduce(list_prepend(4294967295::bigint, [ascii(c)::bigint for c in string_split(doc_id::varchar, '')]),
            lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as crc from documents d, steps),
leaves as (select doc_id, source, sha256({whole('text')}) as h,
           sha256(case when crc % 2 = 0 then {whole("replace(text, chr(10), '')")} else {whole('text')} end) as t from checked),
placed as (select *, row_number() over (partition by source order by doc_id) - 1 as pos, count(*) over (partition by source) as n from leaves),
up(g, lvl, pos, h, n) as (select source, 0, pos, h, n from placed union all
   select g, lvl + 1, pos // 3, sha256(string_agg(h, '' order by pos)), (n + 2) // 3 from up where n > 1 group by g, lvl, pos // 3, n),
sides as ({sides} from up where n > 1),
subs as (select g, h, row_number() over (order by g nulls first) - 1 as pos, count(*) over () as n from up where n = 1),
top(lvl, pos, h, n) as (select 0, pos, h, n from subs union all
   select lvl + 1, pos // 3, sha256(string_agg(h, '' order by pos)), (n + 2) // 3 from top where n > 1 group by lvl, pos // 3, n),
tops as ({sides} from (select 1 as g, * from top) where n > 1),
walk(doc_id, g, lvl, pos, folded, seen) as (select doc_id, source, 0, pos, t, '' from placed union all
   select w.doc_id, w.g, w.lvl + 1, w.pos // 3, sha256(l || folded || r), seen || l || r from walk w join sides s on w.g is not distinct from s.g and w.lvl = s.lvl and w.pos = s.pos),
ended as (select * from walk qualify row_number() over (partition by doc_id order by lvl desc) = 1),
climb(doc_id, lvl, pos, folded, seen) as (select doc_id, 0, s.pos, folded, seen from ended e join subs s on e.g is not distinct from s.g union all
   select c.doc_id, c.lvl + 1, c.pos // 3, sha256(l || folded || r), seen || l || r from climb c join tops s on c.lvl = s.lvl and c.pos = s.pos),
done as (select * from climb qualify row_number() over (partition by doc_id order by lvl desc) = 1)
select p.doc_id, p.h as leaf, s.h as subroot, root.h as root, sha256(seen) as proof_sha256, folded as folded_root, folded = root.h as verified
from placed p join subs s on p.source is not distinct from s.g join done d on p.doc_id = d.doc_id cross join (select h from top where n = 1) root
"""


@query("op11_merkle_manifest", _sql())
def op11(spark, folder):
    docs = documents(spark, folder)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    changed = leaf([text if f == "text" else F.col(f) for f in FIELDS])
    folded = fold(F.col("changed"), F.col("proof"))
    rows = manifest(docs, carry={"changed": changed})
    out = rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
