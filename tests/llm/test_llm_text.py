"""Token counts, encoding, language identification and the helpers they share."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tellerflow.llm import bpe, langid, text

ROWS = [
    (1, "Plain words, and 12's numbers don't I'LL", "en"), (2, None, None), (3, "", "en"), (4, "  \n\t ", None), (None, "no id", "en"),
    (5, "a<|endoftext|> b<|endoftext|><|endoftext|>", "en"), (6, "日本語 テキスト😀🏽 é ²½Ⅷ \x1c\x85z ", None), (7, "x" * 30_000, "en"), (7, "x" * 30_000, "en"),
    (8, "ſ 's ʼs �\x00 \U0001e900\U0001d7d8", "xx"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame([(*r, "extra", -1) for r in ROWS], "doc_id long, text string, lang string, n_tokens string, score int")
    return rows.repartition(3)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.byte_vocabulary())


def test_counts_equal_the_library(docs, library):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in bpe.token_counts(docs, bpe.byte_vocabulary(), keep=("doc_id", "n_tokens")).collect())
    want = [(i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in ROWS]
    assert got == sorted((*w, w[2] > 512) for w in want)


def test_encoding_and_decoding_equal_the_library(docs, library):
    coded = bpe.encode(docs, bpe.byte_vocabulary(), keep=("doc_id", "score"))
    got = {(r.doc_id, r.n_tokens, r.ids, r.decoded) for r in coded.collect()}
    want = set()
    for i, t, _ in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(ids), ",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)))
    assert got == want and coded.count() == len(ROWS)
    back = bpe.decode(coded, bpe.byte_vocabulary())
    assert {(r.doc_id, r.text) for r in back.collect()} == {(i, t or "") for i, t, _ in ROWS}
    digests = {(r.doc_id, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(docs, bpe.byte_vocabulary(), digests=True).collect()}
    assert digests == {(i, hashlib.sha256(a.encode()).hexdigest(), hashlib.sha256(d.encode()).hexdigest()) for i, _, a, d in want}


def test_empty_table(spark, docs):
    none = docs.limit(0)
    assert bpe.token_counts(none, bpe.byte_vocabulary()).count() == bpe.encode(none, bpe.byte_vocabulary()).count() == 0
    assert langid.identified(none).count() == 0


def test_stream_with_sufficient_lookahead_equals_the_whole():
    vocabulary = bpe.Vocabulary(open(bpe.byte_vocabulary(), encoding="utf-8").read())
    rng = random.Random(5)
    # A short merge list, so that many tokens hang on bytes far to the right.
    few = dict(list(vocabulary.rank.items())[:60])
    vocabulary.rank, vocabulary.left_bytes = few, vocabulary.left_bytes[:60]
    lookahead = vocabulary._lookahead()
    for _ in range(200):
        raw = bytes(rng.choice(b" theanrois") for _ in range(rng.randint(1, 3 * lookahead)))
        machine = bpe.Transducer(vocabulary, step=rng.randint(1, 9), lookahead=lookahead)
        got = [t for i in range(0, len(raw), 5) for t in machine.feed(raw[i : i + 5])]
        assert len(machine.held) <= machine.step + lookahead + 5
        assert got + machine.finish() == [s for s in vocabulary.merge(raw)[0] if s >= 0]


def test_lookahead_is_that_of_the_merge_list(library):
    vocabulary = bpe.Vocabulary(open(bpe.byte_vocabulary(), encoding="utf-8").read())
    assert 0 < vocabulary.lookahead < 1000 < sum(vocabulary.left_bytes)
    rng, parts = random.Random(6), [v for v in vocabulary.texts.values() if v and v.isascii() and v.isalpha()]
    hard = [lambda: "".join(rng.choice(parts) for _ in range(400)), lambda: "a" * rng.randint(1000, 3000), lambda: "".join(rng.choice("aeh") * rng.randint(1, 90) for _ in range(60)),
            lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(3000))]
    for make in hard * 15:
        piece = make()
        machine = bpe.Transducer(vocabulary, step=rng.randint(1, 40))
        early = [t for i in range(0, len(piece), 37) for t in machine.feed(piece[i : i + 37].encode())]
        assert len(machine.held) <= machine.step + vocabulary.lookahead + 37 and early
        assert early + machine.finish() == library.encode(piece, add_special_tokens=False).ids
    # An odd merge list, in which a symbol is made twice, has no bound: all tokens wait for the end.
    vocabulary.merged[1] = vocabulary.merged[0]
    assert vocabulary._lookahead() is None


def test_long_piece_streams_in_bounded_memory(library):
    vocabulary = bpe.Vocabulary(open(bpe.byte_vocabulary(), encoding="utf-8").read())
    rng = random.Random(1)
    piece = "".join(rng.choice("etaoinshrdlué") for _ in range(50_000))
    parts = list(vocabulary.encode_long(piece))
    assert len(parts) > 5 and max(len(back) for _, back in parts) < 3 * bpe.LONG
    assert ",".join(i for i, _ in parts) == ",".join(map(str, library.encode(piece, add_special_tokens=False).ids)) and "".join(b for _, b in parts) == piece


def test_chunks_of_a_text_are_cut_like_the_whole(spark):
    from conftest import DATA

    vocabulary = bpe.Vocabulary(open(bpe.byte_vocabulary(), encoding="utf-8").read())
    rng, special = random.Random(2), sorted(vocabulary.special)[:1]
    odd = ["".join(rng.choice([" ", "  ", "\n", "'re", "'ll", "'", "l", "ab", "12", "!?", "é", "😀", "\u2003", *special]) for _ in range(300)) for _ in range(60)]
    texts = odd + ["", "x", "y" * 5000] + [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect() if r.text]
    flat = lambda parts: [x for special, pieces in parts for x in [*pieces, *([special] if special is not None else [])]]
    early = total = 0
    for text in texts:
        got = list(vocabulary.stream(text[i : i + 64] for i in range(0, len(text), 64)))
        whole = flat(vocabulary.pieces(text))
        assert flat(got) == whole
        total += len(whole)
        early += len(flat(got[:-1]))
    assert early > total / 2  # most pieces leave before the text has ended


def test_text_reader_holds_unfinished_characters():
    reader = bpe.TextReader()
    assert "".join([*(reader.feed(bytes([b])) for b in "é😀x".encode()), reader.finish()]) == "é😀x"
    assert reader.feed("é".encode()[:1]) + reader.finish() == "�"


def test_words_and_hashes_do_not_cross_rows():
    column = pa.array(["ab  c", None, "", "\tab", "c\n", "AB c"])
    data, offsets = text.column_bytes(column)
    starts, ends, at = text.words(text.LOWER[data], offsets)
    h = text.hash_spans(text.LOWER[data], starts, ends)
    assert np.diff(at).tolist() == [2, 0, 0, 1, 1, 2]
    assert h[0] == h[2] == h[4] and h[1] == h[3] == h[5] and h[0] != h[1]
    sliced = column.slice(3, 2)
    assert np.diff(text.words(*text.column_bytes(sliced))[2]).tolist() == [1, 1]


def test_shingles_are_distinct_sets_per_row():
    column = pa.array(["a b c d e f", "a b", None, "a a a a a a a", "a b c d e f"])
    data, offsets = text.column_bytes(column)
    starts, ends, at = text.words(data, offsets)
    values, to = text.shingles(text.hash_spans(data, starts, ends), at, 5)
    assert np.diff(to).tolist() == [2, 1, 0, 1, 2] and values[0:2].tolist() == values[to[4] : to[5]].tolist()


def test_language_of_edge_cases(docs):
    got = {(r.doc_id, r.lang_pred, r.score) for r in langid.identified(docs, keep=("doc_id", "score")).collect() if r.doc_id in (2, 3, 4)}
    assert got == {(i, "und", 0.0) for i in (2, 3, 4)}


def test_profiles_equal_a_plain_count(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("ab ab c", "x"), ("Zz zz", "y"), ("ab.", "x"), (None, "x"), ("q", None)])]
    got = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), size=5)
    counts: dict[str, dict[tuple, int]] = {}
    for _, t, lang in rows:
        if t and lang:
            padded = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in t).split()) + " "
            for n in (1, 2, 3):
                for i in range(len(padded) - n + 1):
                    g = padded[i : i + n]
                    if g.strip() and not (n == 3 and g[1] == " "):
                        code = 0
                        for c in g:
                            code = code << 21 | ord(c)
                        counts.setdefault(lang, {}).setdefault(code, 0)
                        counts[lang][code] += 1
    assert got == {k: sorted(v, key=lambda g: (-v[g], g))[:5] for k, v in counts.items()}


def test_held_out_accuracy(spark):
    from conftest import DATA

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    both = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out() & F.col("lang").isNotNull())
    right, total = both.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.95 * total
