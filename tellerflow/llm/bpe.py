"""Byte-pair encodings from a public merge list: token counts, encoding and decoding.

Both operators cut a text into special tokens and pieces exactly as the
tokenizers library does for a byte-level file, and differ in what they do with a
piece:

* ``token_counts`` keeps the piece's symbols in a linked list and its adjacent
  pairs in a heap, and repeatedly pops the lowest rank. It only counts merges.
* ``encode`` reads a text window by window. A piece's tokens leave once no later
  character can change the cut (``Vocabulary.stream``) and, inside a long piece,
  once no later byte can change the token (``Transducer``); with digests nothing
  but the unfinished end is held. ``decode`` runs a byte-to-text state machine
  over the tokens' bytes.

NULL text counts as empty: no tokens. Every row gives one row, whatever its
doc_id (NULL and repeated ones too); extra columns are passed through by
``keep``, and give way to a result column of the same name.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tellerflow.llm.registry import documents, query
from tellerflow.llm.text import slices
from tellerflow.llm.workers import map_arrow

COUNTED, REMEMBERED = 200_000, 200_000  # pieces whose count or encoding a worker remembers; forgotten ones are merged again
WINDOW = 1 << 16  # characters of a text that are cut into pieces at once
LONG = 1 << 12  # characters from which a piece is encoded part by part


def _char_class(wanted: str, last: int) -> str:
    """The ranges of all characters up to ``last`` of a general category."""
    ranges, start = [], None
    for code in range(last + 2):
        inside = code <= last and unicodedata.category(chr(code))[0] == wanted
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(ranges)


# Unicode's White_Space property, and the contractions the byte-level splitter cuts off.
WHITE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


@lru_cache(2)
def piece_pattern(last: int) -> re.Pattern:
    """The splitter for texts without characters after ``last``; Python looks up sets within two-byte characters in a
    table, and goes through the ranges of larger ones one by one."""
    letter, number = _char_class("L", last), _char_class("N", last)
    return re.compile(
        f"{CONTRACTIONS}| ?[{letter}]+| ?[{number}]+| ?[^{WHITE}{letter}{number}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
    )


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the others follow at 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _whole(raw: bytes) -> str | None:
    """The text of a token of whole characters: the state machine is at its start before and after it."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


class Vocabulary:
    """Merge ranks and token bytes of a byte-level BPE file in the tokenizers library's format."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, splitter = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and splitter.get("type") == "ByteLevel" and not splitter.get("add_prefix_space")
                 and not spec.get("normalizer") and not model.get("dropout") and not model.get("ignore_merges")
                 and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]))
        if not plain:
            raise ValueError("only byte-level BPE without normaliser, dropout or stripping special tokens is supported")
        ids, letters = model["vocab"], _byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.first = [ids[c] for c in letters]  # id of each byte
        self.rank: dict[int, int] = {}  # left id << 20 | right id -> rank
        self.merged: list[int] = []  # rank -> id
        self.left_bytes: list[int] = []  # rank -> bytes of the left part
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(ids[left] << 20 | ids[right], rank)
            self.merged.append(ids[left + right])
            self.left_bytes.append(len(left))
        self.bytes = {i: bytes(of_letter[c] for c in token) for token, i in ids.items()}
        self.texts = {i: _whole(raw) for i, raw in self.bytes.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: content.encode() for content, i in self.special.items()}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.short, self.wide = piece_pattern(0xFFFF), piece_pattern(sys.maxunicode)
        self.lengths: dict[str, int] = {}
        self.encoded: dict[str, str] = {}  # ids of pieces that decode to themselves
        self.widest = max(map(len, self.special), default=1)
        self.lookahead = self._lookahead()
        self.reader = TextReader()

    def pieces(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """The text in order: pieces, each run followed by the id of the special token that ends it, or None at the end."""
        at, piece = 0, self.short if len(text.encode("utf-16-le")) == 2 * len(text) else self.wide
        for found in self.cut.finditer(text) if self.cut else ():
            yield self.special[found[0]], piece.findall(text, at, found.start()) if found.start() > at else []
            at = found.end()
        yield None, piece.findall(text[at:] if at else text)

    def stream(self, chunks: Iterable[str]) -> Iterator[tuple[int | None, list[str]]]:
        """As ``pieces``, for a text that comes in chunks: what is yielded holds for every continuation.

        A special token is sure once the longest one would fit behind its start.
        Before it, the splitter looks at most at the end of what it was given:
        that can change a contraction's two pieces or the last run, so the last
        three pieces wait. A piece beyond all windows is cut anew only when what
        is held has doubled.
        """
        held, due = "", 1
        for chunk in chunks:
            if len(held) >= due:
                at, sure = 0, len(held) - self.widest + 1
                piece = self.short if len(held.encode("utf-16-le")) == 2 * len(held) else self.wide
                for found in self.cut.finditer(held) if self.cut else ():
                    if found.start() >= sure:
                        break
                    yield self.special[found[0]], piece.findall(held, at, found.start()) if found.start() > at else []
                    at = found.end()
                if at < sure:
                    ready = piece.findall(held, at, sure)[:-3]
                    yield None, ready
                    at += sum(map(len, ready))
                held = held[at:]
                due = 2 * len(held)
            held += chunk
        yield from self.pieces(held)

    def merge(self, piece: bytes) -> tuple[list[int], int]:
        """The piece's symbols after all merges, dead ones as -1, and the number of merges.

        The live symbols form a doubly linked list. The heap holds (rank,
        position) of adjacent pairs; an entry whose pair has changed since is
        skipped when popped, and equal ranks pop leftmost first.
        """
        first, find, merged, push, pop = self.first, self.rank.get, self.merged, heapq.heappush, heapq.heappop
        symbols = [first[b] for b in piece]
        n = len(symbols)
        if n == 1:
            return symbols, 0
        now = [find(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:])]  # rank of the pair that begins here
        now.append(-1)
        heap = [r << 32 | i for i, r in enumerate(now) if r >= 0]
        heapq.heapify(heap)
        after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            lowest = pop(heap)
            r, i = lowest >> 32, lowest & 0xFFFFFFFF
            if now[i] != r:
                continue
            j = after[i]
            k = after[i] = after[j]
            symbol = symbols[i] = merged[r]
            symbols[j] = now[j] = -1
            merges += 1
            if k < n:
                before[k] = i
                r = now[i] = find(symbol << 20 | symbols[k], -1)
                if r >= 0:
                    push(heap, r << 32 | i)
            else:
                now[i] = -1
            h = before[i]
            if h >= 0:
                r = now[h] = find(symbols[h] << 20 | symbol, -1)
                if r >= 0:
                    push(heap, r << 32 | h)
        return symbols, merges

    def count(self, text: str) -> int:
        """Tokens of the text: initial symbols minus merges, special tokens one each."""
        known, total = self.lengths, 0
        for special, pieces in self.pieces(text):
            total += special is not None
            for piece in pieces:
                n = known.get(piece)
                if n is None:
                    raw = piece.encode()
                    n = len(raw) - self.merge(raw)[1]
                    if len(piece) <= 64:
                        if len(known) >= COUNTED:
                            known.clear()
                        known[piece] = n
                total += n
        return total

    def _lookahead(self) -> int | None:
        """Bytes after which no continuation can change a token; None if the merge list gives no such bound.

        Run the merge list rule by rule in rank order on a text and on the same
        text continued. Both agree on all symbols of the shorter one at first,
        and agreed symbols merge alike; only the last agreed one may merge with
        what follows in one run alone, and then equals that rule's left part. So
        the agreed prefix loses symbols one after the other, by rules of rising
        rank. What follows the agreed prefix starts, in both runs, with the
        symbol lost before, which may have grown to the right since. A loss by
        ``a + b`` therefore comes first of all, or after the loss of a symbol
        that ``b`` begins with in its derivation. The dearest such chain of
        losses, in bytes, is the bound.

        The argument needs rules whose parts are made by earlier rules only, as
        training makes them, so that merging by lowest rank goes in rank order.
        """
        begins: dict[int, set[int]] = {i: {i} for i in self.first}  # symbol -> those its derivation begins with
        lost: dict[int, int] = {}  # symbol -> bytes of the dearest chain that ends with its loss
        for pair, rank in sorted(self.rank.items(), key=lambda rule: rule[1]):
            left, right, made = pair >> 20, pair & 0xFFFFF, self.merged[rank]
            if left not in begins or right not in begins or made in begins:
                return None
            chain = self.left_bytes[rank] + max(lost.get(symbol, 0) for symbol in begins[right])
            lost[left] = max(lost.get(left, 0), chain)
            begins[made] = {made} | begins[left]
        return max(lost.values(), default=0)

    def encode_piece(self, piece: str) -> tuple[str, str]:
        """(ids joined by commas, text decoded from those ids) of one piece."""
        tokens = [s for s in self.merge(piece.encode())[0] if s >= 0]
        parts = [self.texts[t] for t in tokens]
        if None in parts:  # a token ends within a character
            parts = [*(self.reader.feed(self.bytes[t]) for t in tokens), self.reader.finish()]
        back = "".join(parts)
        ids = ",".join(map(str, tokens))
        if len(piece) <= 64 and back == piece:
            if len(self.encoded) >= REMEMBERED:
                self.encoded.clear()
            self.encoded[piece] = ids
        return ids, back

    def encode_long(self, piece: str) -> Iterator[tuple[str, str]]:
        """``encode_piece`` part by part, streamed through the transducer."""
        machine, reader = Transducer(self), TextReader()
        for at in range(0, len(piece), LONG):
            tokens = machine.feed(piece[at : at + LONG].encode())
            if tokens:
                yield ",".join(map(str, tokens)), "".join(reader.feed(self.bytes[t]) for t in tokens)
        tokens = machine.finish()
        yield ",".join(map(str, tokens)), "".join(reader.feed(self.bytes[t]) for t in tokens) + reader.finish()


class Transducer:
    """Encodes a stream of bytes of one piece with constant memory: what is fed, ``step`` and the lookahead are held.

    A boundary further than the lookahead from the end of what was read holds
    for every continuation, and what follows it is encoded on its own. So the
    tokens before the last such boundary are emitted and forgotten. Without a
    lookahead all tokens wait for the end.
    """

    def __init__(self, vocabulary: Vocabulary, step: int | None = None, lookahead: int | None = None):
        self.vocabulary = vocabulary
        self.lookahead = vocabulary.lookahead if lookahead is None else lookahead
        self.step = step or 4 * max(self.lookahead or 0, 1)
        self.held = bytearray()

    def feed(self, more: bytes) -> list[int]:
        self.held += more
        if self.lookahead is None or len(self.held) < self.step + self.lookahead:
            return []
        stable, end, out = len(self.held) - self.lookahead, 0, []
        for token in self._merged():
            size = len(self.vocabulary.bytes[token])
            if end + size > stable:
                break
            end += size
            out.append(token)
        del self.held[:end]
        return out

    def finish(self) -> list[int]:
        out = self._merged() if self.held else []
        self.held = bytearray()
        return out

    def _merged(self) -> list[int]:
        return [s for s in self.vocabulary.merge(self.held)[0] if s >= 0]


class TextReader:
    """Bytes to text, one token at a time: a UTF-8 state machine that holds an unfinished character of at most three bytes."""

    def __init__(self):
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.feed = machine.decode
        self.finish = lambda: machine.decode(b"", True)  # back at its start


_LOADED: dict[str, Vocabulary] = {}


def load(source: str, digest: str) -> Vocabulary:
    """A worker parses a vocabulary once and keeps its remembered pieces, a bounded number, from task to task."""
    if digest not in _LOADED:
        _LOADED.clear()
        _LOADED[digest] = Vocabulary(source)
    return _LOADED[digest]


def _shared(docs: DataFrame, path: str):
    """The vocabulary file, read by the driver and broadcast: a file of a few megabytes, so executors need no copy."""
    with open(path, encoding="utf-8") as file:
        source = file.read()
    return docs.sparkSession.sparkContext.broadcast(source), hashlib.sha256(source.encode()).hexdigest()


def _mapped(docs: DataFrame, text: str, keep: list[str], fields: list[StructField], rows) -> DataFrame:
    """Columns ``keep`` of every row, but for those named like a field, followed by ``fields``, which ``rows(texts)`` gives as lists."""
    made = {f.name.lower() for f in fields}
    keep = [c for c in keep if c.lower() not in made]
    schema = StructType([*[docs.schema[c] for c in keep], *fields])
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "_text")):
            columns = rows([t or "" for t in batch.column("_text").to_pylist()])
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(c, t) for c, t in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_arrow(picked, work, schema)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_bytes, n_tokens and over_limit of every text, by heap-and-linked-list merging; no ids are made."""
    shared, digest = _shared(docs, vocabulary)

    def rows(texts: list[str]):
        known = load(shared.value, digest)
        counts = [known.count(t) for t in texts]
        return [([len(t.encode()) for t in texts], pa.int64()), (counts, pa.int64()), ([n > limit for n in counts], pa.bool_())]

    fields = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    return _mapped(docs, text, list(keep), fields, rows)


class _Digests:
    """Number of tokens, SHA-256 of the ids and of the decoded text, from parts in order that are not kept."""

    def __init__(self):
        self.n, self.ids, self.back = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: list[str], back: list[str]) -> None:
        if ids:
            joined = ",".join(ids)
            self.ids.update((f",{joined}" if self.n else joined).encode())
            self.n += joined.count(",") + 1
            self.back.update("".join(back).encode())

    def result(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.back.hexdigest()


class _Whole:
    """Number of tokens, the ids and the decoded text."""

    def __init__(self):
        self.ids, self.back = [], []

    def add(self, ids: list[str], back: list[str]) -> None:
        self.ids += ids
        self.back += back

    def result(self) -> tuple[int, str, str]:
        joined = ",".join(self.ids)
        return joined.count(",") + 1 if joined else 0, joined, "".join(self.back)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), digests: bool = False) -> DataFrame:
    """``keep`` columns with each text's ids and the text decoded from them.

    The result has n_tokens, ids (decimal, joined by commas) and decoded; with
    ``digests`` it has their SHA-256 in hex instead, built piece by piece.
    """
    shared, digest = _shared(docs, vocabulary)

    def one(known: Vocabulary, content: str) -> tuple[int, str, str]:
        made = _Digests() if digests else _Whole()
        for special, pieces in known.stream(content[at : at + WINDOW] for at in range(0, len(content), WINDOW)):
            ids, back = [], []
            for piece in pieces:
                own = known.encoded.get(piece)
                if own:
                    ids.append(own)
                    back.append(piece)
                elif len(piece) < LONG:
                    own, decoded = known.encode_piece(piece)
                    ids.append(own)
                    back.append(decoded)
                else:
                    made.add(ids, back)
                    for own, decoded in known.encode_long(piece):
                        made.add([own], [decoded])
                    ids, back = [], []
            if special is not None:
                ids.append(str(special))
                back.append(known.bytes[special].decode())
            made.add(ids, back)
        return made.result()

    def rows(texts: list[str]):
        known = load(shared.value, digest)
        done = [one(known, t) for t in texts]
        return [([d[i] for d in done], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]

    names = ("n_tokens", "ids_sha256", "decoded_sha256") if digests else ("n_tokens", "ids", "decoded")
    fields = [StructField(names[0], LongType()), *[StructField(x, StringType()) for x in names[1:]]]
    return _mapped(docs, text, list(keep), fields, rows)


def decode(coded: DataFrame, vocabulary: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the text of each row's ids (decimal, joined by commas; NULL and empty give an empty text)."""
    shared, digest = _shared(coded, vocabulary)

    def one(known: Vocabulary, row: str) -> str:
        reader = TextReader()
        return "".join(reader.feed(known.bytes[int(i)]) for i in row.split(",") if i) + reader.finish()

    def rows(texts: list[str]):
        known = load(shared.value, digest)
        return [([one(known, t) for t in texts], pa.string())]

    return _mapped(coded, ids, list(keep), [StructField("text", StringType())], rows)


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op6_token_counts")
def op6(spark, folder):
    return token_counts(documents(spark, folder), byte_vocabulary())


@query("op10_bpe")
def op10(spark, folder):
    return encode(documents(spark, folder), byte_vocabulary(), digests=True)
