"""Language-model scores by prediction by partial matching (PPM) over bytes.

A text is its UTF-8 bytes after ``ORDER`` start marks, then an end mark; a mark
is symbol 0, a byte b is symbol b + 1. The context trie holds, for every context
of up to ORDER symbols, how often each symbol followed it in the training texts.
A symbol's probability is sought from the longest context down:

* in a context where symbols were seen n times in all, q different ones, a seen
  symbol with count c has c / (n + q), and the escape has q / (n + q);
* after an escape, symbols seen in the longer context are excluded from the
  shorter one's counts (its sums lose what the longer context's symbols count
  there). Where that leaves nothing, the escape is certain;
* an unseen context is skipped; below the empty context, symbols not seen at all
  share the rest evenly.

``score`` is the log10 probability of a text, end mark included, under the
pretrained trie. ``adaptive_scores`` gives the same for a trie that starts empty
with each text and learns every symbol after coding it.

The trie is a set of tables and never as a whole in one place. Texts are dealt
into blocks of about ``BLOCK_BYTES``; a block asks for the distinct grams and
words it holds, the answers are joined on the key, and meet the block's texts
again in one task. So a task holds one block's part of the model whatever the
size of the corpus, and the rows of a frequent gram are one per block. Texts
travel compressed.

Defined cases: NULL counts as an empty text (the end mark only); rows with a
NULL doc_id are dealt like others (as the text ``null``); repeated rows count
and are scored as often as they occur; with no training text every word is
unknown and symbols are equally likely.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StructField, StructType

from tellerflow.llm.registry import documents, query
from tellerflow.llm.text import LOWER, column_bytes, hash_spans, slices, words
from tellerflow.llm.workers import map_arrow, ship
from tellerflow.operators.sinks import durable

ORDER, SYMBOLS = 5, 257
BLOCK_BYTES = 32 << 20
_BITS, _TAG = 9, 56
_WORD = np.int64(1 << 62)  # word keys have this bit, grams are below it
_END = np.int64((1 << 63) - 1)


def _mask(symbols: int) -> int:
    return (1 << (_BITS * symbols)) - 1


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER + 1 symbols up to each symbol of each text, end mark included, packed; and the row offsets into them."""
    rows, sizes = len(offsets) - 1, np.diff(offsets)
    at = np.concatenate([[0], np.cumsum(sizes + ORDER + 1)])
    symbols = np.zeros(at[-1], np.int64)
    row = np.repeat(np.arange(rows), sizes)
    symbols[np.arange(len(data)) + row * (ORDER + 1) + ORDER] = data.astype(np.int64) + 1
    packed = np.zeros(len(symbols), np.int64)
    for back in range(ORDER, -1, -1):
        packed <<= _BITS
        packed[back:] |= symbols[: len(symbols) - back]
    own = np.ones(len(symbols), bool)
    own[(at[:-1, None] + np.arange(ORDER)).ravel()] = False
    return packed[own], offsets + np.arange(rows + 1)


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each text's words and its end token, and the row offsets into them."""
    data = LOWER[data]
    starts, ends, at = words(data, offsets)
    keys = (hash_spans(data, starts, ends) >> np.uint64(2)).astype(np.int64) | _WORD
    to = at + np.arange(len(at))
    out = np.full(to[-1], _END, np.int64)
    out[np.arange(len(keys)) + np.repeat(np.arange(len(at) - 1), np.diff(at))] = keys
    return out, to


def _sum_by_key(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


_TEXTS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.string())])


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's rows (block, doc_id, held_out, text) as one compressed row (block, rows) per block."""
    for batch in batches:
        blocks = np.asarray(batch.column("block"), np.int64)
        names, out = np.unique(blocks), []
        for name in names:
            sink = pa.BufferOutputStream()
            own = pa.Table.from_batches([batch.select(_TEXTS.names)]).take(pa.array(np.flatnonzero(blocks == name))).cast(_TEXTS)
            with pa.ipc.new_stream(sink, _TEXTS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(own)
            out.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(out, pa.binary())], names=["block", "rows"])


def _unpacked(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for rows in table.column("rows"):
        for batch in pa.ipc.open_stream(rows.as_buffer()):
            yield from slices(batch, "text", 1 << 20)  # the arrays made of a slice take some sixty times as much


def _asked(table: pa.Table) -> pa.Table:
    """The distinct keys of one block's texts, and how often each occurs in its training texts."""
    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in _unpacked(table):
        data, offsets = column_bytes(batch.column("text"))
        learn = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        for found, at in (grams(data, offsets), word_keys(data, offsets)):
            own = np.repeat(learn, np.diff(at))
            known, times = np.unique(found[own], return_counts=True)
            other = np.unique(found[~own])
            waiting += [(known, times), (other, np.zeros(len(other), np.int64))]
        if sum(len(w[0]) for w in waiting) > len(keys) + (1 << 20):
            keys, n = _sum_by_key(np.concatenate([keys, *(w[0] for w in waiting)]), np.concatenate([n, *(w[1] for w in waiting)]))
            waiting = []
    keys, n = _sum_by_key(np.concatenate([keys, *(w[0] for w in waiting)]), np.concatenate([n, *(w[1] for w in waiting)]))
    return pa.table({"block": pa.array(np.full(len(keys), table.column("block")[0].as_py(), np.int64)), "key": keys, "n": n})


class Answers:
    """Values by key, in a hash of slots that are a third free at least: a lookup costs a step or two, where a search costs one per bit.

    Keys are not negative.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (len(keys) + len(keys) // 2).bit_length())
        self.shift, self.last, self.values = np.uint64(64 - bits), (1 << bits) - 1, values
        self.at, self.keys = np.zeros(1 << bits, np.int32), np.full(1 << bits, -1, np.int64)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            self.at[slot[free]], self.keys[slot[free]] = left[free], keys[left[free]]
            lost = self.keys[slot] != keys[left]  # of several for one free slot, the last has it
            left, slot = left[lost], (slot[lost] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        slot = self._slot(asked)
        on = np.flatnonzero(self.keys[slot] != asked)
        while len(on):
            here = slot[on]
            if (self.keys[here] < 0).any():
                raise KeyError("a key without an answer")
            slot[on] = (here + 1) & self.last
            on = on[self.keys[slot[on]] != asked[on]]
        return self.values[self.at[slot]]


def _scored(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Each text's sums over the answers to its words and grams."""
    answer = Answers(answers.column("key").to_numpy(), answers.column("value").to_numpy())
    out = [_SCORED.empty_table()]
    for batch in _unpacked(docs):
        data, offsets = column_bytes(batch.column("text"))
        sums = []
        for asked, at in (grams(data, offsets), word_keys(data, offsets)):
            value = answer(asked)
            sums += [np.add.reduceat(value, at[:-1]), np.add.reduceat((value > 0).astype(np.int64), at[:-1]), np.diff(at)]
        out.append(pa.table({
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": pa.array(sums[5]),
            "n_known": pa.array(sums[4]), "word_score": pa.array(sums[3]), "score": pa.array(sums[0]), "n_symbols": pa.array(sums[2]),
        }))
    return pa.concat_tables(out)


_FIELDS = [("doc_id", LongType()), ("held_out", BooleanType()), ("n_tokens", LongType()), ("n_known", LongType()),
           ("word_score", DoubleType()), ("score", DoubleType()), ("n_symbols", LongType())]
_ARROW = {LongType: pa.int64(), BooleanType: pa.bool_(), DoubleType: pa.float64()}
_SCORED = pa.schema([(name, _ARROW[type(kind)]) for name, kind in _FIELDS])


def _tagged(gram, symbols: int):
    """A trie node's key: its last ``symbols`` symbols and their number."""
    return gram.bitwiseAND(F.lit(_mask(symbols))).bitwiseOR(F.lit(symbols << _TAG))


def _shorter(node: str):
    """The node without its first symbol."""
    length = F.shiftright(node, _TAG)
    rest = F.col(node).bitwiseAND(F.expr(f"shiftleft(1L, cast({_BITS} * (shiftright({node}, {_TAG}) - 1) as int)) - 1"))
    return rest.bitwiseOR(F.shiftleft(length - 1, _TAG))


def _context(node: str):
    """The node's context: without its last symbol."""
    symbols = F.col(node).bitwiseAND(F.lit((1 << _TAG) - 1))
    return F.shiftright(symbols, _BITS).bitwiseOR(F.shiftleft(F.shiftright(node, _TAG) - 1, _TAG))


def trie(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, n) and contexts (context, n, q, low_n, low_q) from the training counts (key, n) of whole grams.

    low_n and low_q are what the next shorter context's sums come to without the symbols seen in this one.
    """
    lengths = F.explode(F.array(*[_tagged(F.col("key"), k) for k in range(1, ORDER + 2)])).alias("node")
    nodes = durable(counted.where("n > 0").select(lengths, "n").groupBy("node").agg(F.sum("n").alias("n")), "trie-nodes")
    below = nodes.select(F.col("node").alias("shorter"), F.col("n").alias("shorter_n"))
    children = nodes.withColumn("shorter", _shorter("node")).join(below, "shorter", "left")
    contexts = children.withColumn("context", _context("node")).groupBy("context").agg(
        F.sum("n").alias("n"), F.count("*").alias("q"), F.sum("shorter_n").alias("seen_below")
    )
    contexts = durable(contexts, "trie-sums")
    lower = contexts.select(F.col("context").alias("shorter"), F.col("n").alias("next_n"), F.col("q").alias("next_q"))
    joined = contexts.withColumn("shorter", F.when(F.col("context") > 0, _shorter("context"))).join(lower, "shorter", "left")
    empty = F.col("context") == 0  # below it: every symbol once
    low_n = F.when(empty, SYMBOLS - F.col("q")).otherwise(F.col("next_n") - F.col("seen_below"))
    low_q = F.when(empty, 0).otherwise(F.col("next_q") - F.col("q"))
    return nodes, joined.select("context", "n", "q", low_n.alias("low_n"), low_q.alias("low_q"))


def gram_scores(counted: DataFrame) -> DataFrame:
    """(key, value): the log10 probability of the last symbol of every gram in ``counted`` (key, n) after the others."""
    nodes, contexts = trie(counted)
    contexts = durable(contexts, "trie-contexts")
    longest = _context("node").alias("context")
    seen = counted.where("n > 0").select("key", F.col("n").alias("c"), _tagged(F.col("key"), ORDER + 1).alias("node")).select("key", "c", longest)
    seen = seen.join(contexts, "context").select("key", F.log10(F.col("c") / (F.col("n") + F.col("q"))).alias("value"))

    unseen = counted.where("n = 0").select("key", F.explode(F.array(*[F.lit(k) for k in range(ORDER + 1)])).alias("k"))
    tag = F.array(*[_tagged(F.col("key"), k + 1) for k in range(ORDER + 1)])
    steps = unseen.withColumn("node", F.get(tag, F.col("k"))).withColumn("context", _context("node"))
    steps = steps.join(nodes.withColumnRenamed("n", "c"), "node", "left").join(contexts, "context", "left")
    fields = ("c", "n", "q", "low_n", "low_q")
    wide = steps.groupBy("key").agg(*[F.max(F.when(F.col("k") == k, F.col(x))).alias(f"{x}{k}") for k in range(ORDER + 1) for x in fields])
    value = F.when(F.col("q0").isNull(), -math.log10(SYMBOLS)).otherwise(-F.log10(F.col("low_n0")))  # below the empty context
    for k in range(ORDER + 1):  # from the shortest context up
        after = F.col(f"n{k + 1}").isNotNull() if k < ORDER else F.lit(False)  # escaped from a longer context
        novel = F.when(after, F.col(f"low_q{min(k + 1, ORDER)}")).otherwise(F.col(f"q{k}"))
        total = F.when(after, F.col(f"low_n{min(k + 1, ORDER)}")).otherwise(F.col(f"n{k}")) + novel
        escaped = value + F.when(novel > 0, F.log10(novel / total)).otherwise(0.0)
        value = F.when(F.col(f"n{k}").isNull(), value).when(F.col(f"c{k}") > 0, F.log10(F.col(f"c{k}") / total)).otherwise(escaped)
    return seen.union(wide.select("key", value.alias("value")))


def scores(docs: DataFrame, held_out, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row's word statistics and PPM score; the model learns from rows where the column ``held_out`` is false.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_symbols); base_score is an add-one
    unigram model over lower-cased words and the end token.
    """
    spark = docs.sparkSession
    ship(spark)
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), content.alias("text"), held_out.alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // BLOCK_BYTES + 1))
    packed = StructType([StructField("block", LongType()), StructField("rows", BinaryType())])
    dealt = map_arrow(rows.select(block.alias("block"), "doc_id", "held_out", "text"), _packed, packed)

    request = StructType([StructField(n, LongType()) for n in ("block", "key", "n")])
    # A key has one row per block at most, so the window's groups do not grow with a key's frequency.
    same = Window.partitionBy("key")
    asked = dealt.groupBy("block").applyInArrow(_asked, request)
    asked = asked.select("block", "key", F.sum("n").over(same).alias("n"), (F.min("block").over(same) == F.col("block")).alias("head"))
    asked = durable(asked, "lm-asked")
    word = F.col("key") >= F.lit(int(_WORD))
    total = asked.where(word & F.col("head")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    trie_scores = durable(gram_scores(asked.where(~word & F.col("head")).select("key", "n")), "lm-grams")
    replies = asked.where(word).select("block", "key", F.log10(F.col("n") + 1.0).alias("value"))
    replies = replies.union(asked.where(~word).select("block", "key").join(trie_scores, "key").select("block", "key", "value"))

    schema = StructType([StructField(n, k) for n, k in _FIELDS])
    found = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_scored, schema)
    base = F.col("word_score") - F.col("n_tokens") * F.lit(math.log10(total.n + total.v + 1))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total.n)).alias("train_tokens"), base.alias("base_score"), "score", "n_symbols")


class AdaptiveTrie:
    """A PPM model of one text, updated symbol by symbol; the plain form of the rules above."""

    def __init__(self, order: int = ORDER):
        self.order, self.counts = order, defaultdict(lambda: defaultdict(int))

    def log10(self, history: tuple[int, ...], symbol: int) -> float:
        total, excluded = 0.0, set()
        for k in range(min(self.order, len(history)), -1, -1):
            seen = self.counts.get(history[len(history) - k :])
            if not seen:
                continue
            n = sum(c for s, c in seen.items() if s not in excluded)
            q = sum(s not in excluded for s in seen)
            if symbol in seen:  # not excluded, or a longer context had coded it
                return total + math.log10(seen[symbol] / (n + q))
            if q:
                total += math.log10(q / (n + q))
            excluded |= set(seen)
        return total - math.log10(SYMBOLS - len(excluded))

    def learn(self, history: tuple[int, ...], symbol: int) -> None:
        for k in range(self.order + 1):
            self.counts[history[len(history) - k :]][symbol] += 1


def symbols_of(text: str) -> Iterator[tuple[tuple[int, ...], int]]:
    """The (history, symbol) steps of a text."""
    history = (0,) * ORDER
    for symbol in [*(b + 1 for b in text.encode()), 0]:
        yield history, symbol
        history = (*history[1:], symbol)


def adaptive_scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score, n_symbols) with a trie of each text's own; one pass per text, memory within its length."""
    schema = StructType([StructField("doc_id", LongType()), StructField("score", DoubleType()), StructField("n_symbols", LongType())])
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def one(content: str) -> tuple[float, int]:
        model, total, n = AdaptiveTrie(), 0.0, 0
        for history, symbol in symbols_of(content):
            total += model.log10(history, symbol)
            model.learn(history, symbol)
            n += 1
        return total, n

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [one(t or "") for t in batch.column("text").to_pylist()]
            arrays = [batch.column("doc_id"), pa.array([d[0] for d in done], pa.float64()), pa.array([d[1] for d in done], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_arrow(rows, work, schema)


@query("op3_lm_scores")
def op3(spark, folder):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % 7 == 2
    return scores(documents(spark, folder), held_out)
