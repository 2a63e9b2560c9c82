"""License scans: which license notices a document holds, in DataFrame operations only.

Texts are words (lower case, split at ASCII characters that are no letter or
digit) and compared as shingles of five words; a notice of fewer words is one
shingle of all of them. A document holds a notice if a window of as many shingles
as the notice has contains at least ``percent`` per hundred of its distinct
shingles.

Retrieval: a notice of s shingles is indexed by its windows of c shingles, the
power of two between s/4 and s/2 (one at least), and documents are probed by all
their windows of c shingles. A window's MinHash has two values, the least and the
greatest hash of its shingles (the greatest is the least in reverse order, so
both are min-wise), each a band of its own. Windows with a similarity of 0.8
share a band with probability 1 - 0.2**2 = 0.96, equal windows always; as c <= s/2,
a notice has s/2 overlapping windows or more, of which most miss nothing. A
shared band proposes a place, where the containment is then counted exactly.

The index is as large as the notices, and is written as a table before the join,
so that Spark sees its size and broadcasts it only below its own threshold.

Defined cases: NULL and empty texts hold nothing; notices without words are
never found; a notice given twice is found under both names; rows that repeat a
doc_id and its text are reported once, rows with a NULL doc_id as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.llm.registry import documents, query
from tellerflow.operators.sinks import durable

SHINGLE, PERCENT = 5, 80
BREAK = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

# Short public notices.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
}


def _words(text):
    """The text's words; breaks at its ends leave empty ones there, which are cut off."""
    def inner(w):
        head, tail = (F.element_at(w, 1) == "").cast("int"), (F.element_at(w, -1) == "").cast("int")
        return F.slice(w, 1 + head, F.greatest(F.size(w) - head - tail, F.lit(0)))

    # A lambda's argument is evaluated once, where a repeated column would be evaluated again at each use.
    return F.element_at(F.transform(F.array(F.split(F.lower(text), BREAK)), inner), 1)


def _pairwise(a: str, b: str, offset: int, f):
    """f(a[i], b[i + offset]) for all i that have both."""
    other = F.slice(b, offset + 1, F.greatest(F.size(b) - offset, F.lit(0)))
    return F.zip_with(F.slice(a, 1, F.size(other)), other, lambda x, y: f(x, y))


def _shingled(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Columns s1 to s5, the hashes of all shingles of so many words: longer ones are hashes of two shorter ones."""
    rows = rows.withColumn("s1", F.transform("words", lambda w: F.xxhash64(w)))
    for k, (a, b) in {2: ("s1", "s1"), 3: ("s2", "s1"), 4: ("s2", "s2"), 5: ("s2", "s3")}.items():
        if k in lengths or (k == 2 and max(lengths) > 1) or (k == 3 and 5 in lengths):
            rows = rows.withColumn(f"s{k}", _pairwise(a, b, int(a[1]), F.xxhash64))
    return rows


def _keys(rows: DataFrame, classes: list[tuple[int, int]], *keep: str) -> DataFrame:
    """(keep, class, window, key) for every band of every window of the rows' shingle arrays."""
    entries = []
    for k in sorted({k for k, _ in classes}):
        low = high = f"s{k}"
        width, widest = 1, max(c for j, c in classes if j == k)
        while True:
            if (k, width) in classes:
                number = classes.index((k, width))
                entries.append(F.struct(F.lit(number).alias("class"), F.lit(0).alias("band"), F.col(low).alias("v")))
                if width > 1:  # a window of one shingle has one value
                    entries.append(F.struct(F.lit(number).alias("class"), F.lit(1).alias("band"), F.col(high).alias("v")))
            if width >= widest:
                break
            # Windows twice as wide are two neighbouring ones.
            rows = rows.withColumn(f"low{k}_{2 * width}", _pairwise(low, low, width, F.least))
            rows = rows.withColumn(f"high{k}_{2 * width}", _pairwise(high, high, width, F.greatest))
            width *= 2
            low, high = f"low{k}_{width}", f"high{k}_{width}"
    rows = rows.select(*keep, F.explode(F.array(*entries)).alias("a")).select(*keep, "a.class", "a.band", F.posexplode("a.v").alias("window", "value"))
    return rows.select(*keep, "class", "window", F.xxhash64("value", F.col("class") * 2 + F.col("band")).alias("key"))


def _classes(notices: DataFrame) -> list[tuple[int, int]]:
    """The (shingle length, window size) pairs that the notices need: few, as sizes are powers of two."""
    return sorted((r.k, r.c) for r in notices.select("k", "c").distinct().collect())


def prepared(notices: DataFrame, text: str = "text", name: str = "license") -> DataFrame:
    """(license, words, k, n, c, shingles) of the notices that have words."""
    rows = notices.select(F.col(f"`{name}`").alias("license"), _words(F.col(f"`{text}`").cast("string")).alias("words")).where(F.size("words") > 0)
    rows = rows.withColumn("k", F.least(F.size("words"), F.lit(SHINGLE)))
    by_length = F.expr("case k " + " ".join(f"when {k} then s{k}" for k in range(1, SHINGLE + 1)) + " end")
    rows = _shingled(rows, list(range(1, SHINGLE + 1)))
    rows = rows.withColumn("n", F.size("words") - F.col("k") + 1)
    c = F.pow(F.lit(2), F.floor(F.log2(F.greatest(F.col("n") / 2, F.lit(1))))).cast("int")
    return rows.withColumn("shingles", F.array_distinct(by_length)).withColumn("c", c)


def found(docs: DataFrame, notices: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """(doc_id, license, at_word, matched, of): the notices of each document, with the best window's first word and the
    number of the notice's distinct shingles it contains."""
    known = durable(prepared(notices), "notices")
    classes = _classes(known)
    content = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(content).alias("text_hash"), content.alias("text")).where("text is not null")
    if not classes:
        classes = [(SHINGLE, 1)]
    lengths = sorted({k for k, _ in classes})

    number = F.lit(-1)
    for n, (k, c) in enumerate(classes):
        number = F.when((F.col("k") == k) & (F.col("c") == c), n).otherwise(number)
    index = _keys(known.withColumn("own", number), classes, "license", "own").where("class = own")
    index = durable(index.select("license", F.col("window").alias("offset"), "key").distinct(), "notice-index")

    def shingled(r: DataFrame, *keep: str) -> DataFrame:
        return _shingled(r.select(*keep, _words(F.col("text")).alias("words")), lengths)

    probes = _keys(shingled(rows, "doc_id", "text_hash"), classes, "doc_id", "text_hash")
    places = probes.join(index, "key").select("doc_id", "text_hash", "license", (F.col("window") - F.col("offset")).alias("at")).distinct()
    places = places.join(known.select("license", "k", "n", F.col("shingles").alias("wanted")), "license")
    places = durable(places.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("license", "at", "k", "n", "wanted")).alias("places")), "notice-places")

    same = (F.col("d.text_hash") == F.col("p.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
    held = rows.alias("d").join(places.alias("p"), same).select("d.doc_id", "d.text", "p.places")
    held = shingled(held, "doc_id", "places").select("doc_id", *[f"s{k}" for k in lengths], F.explode("places").alias("p"))
    own = F.expr("case p.k " + " ".join(f"when {k} then s{k}" for k in lengths) + " end")
    matched = F.size(F.array_intersect(F.slice(own, F.greatest(F.col("p.at"), F.lit(0)) + 1, F.col("p.n")), F.col("p.wanted")))
    held = held.select("doc_id", "p.license", F.greatest(F.col("p.at"), F.lit(0)).alias("at"), matched.alias("matched"), F.size("p.wanted").alias("of"))
    held = held.where(F.col("matched") * 100 >= F.col("of") * percent)
    best = held.groupBy("doc_id", "license", "of").agg(F.max(F.struct("matched", (-F.col("at")).alias("back"))).alias("b"))
    return best.select("doc_id", "license", (-F.col("b.back")).alias("at_word"), F.col("b.matched").alias("matched"), "of")


def notice_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES.items()), "license string, text string")


_VALUES = ", ".join("('{}', '{}')".format(*pair) for pair in NOTICES.items())
_SPLIT = f"list_filter(string_split_regex(lower({{}}), '{BREAK}'), lambda x: x <> '')"
SQL = f"""
with notice(license, words) as (select a, {_SPLIT.format("b")} from (values {_VALUES}) as v(a, b)),
sized as (select license, words, least(len(words), {SHINGLE}) as k, len(words) - least(len(words), {SHINGLE}) + 1 as n from notice),
wanted as (select *, list_distinct([array_to_string(words[i:i + k - 1], ' ') for i in range(1, n + 1)]) as s from sized),
doc as (select doc_id, {_SPLIT.format("text")} as w from documents where text is not null),
shingle as (select doc_id, k, [array_to_string(w[i:i + k - 1], ' ') for i in range(1, greatest(len(w) - k + 2, 1))] as h
            from doc, (select distinct k from wanted)),
start as (select doc_id, license, unnest(range(1, len(h) + 1)) as i, h, n, s from shingle join wanted using (k)
          where len(list_intersect(h, s)) * 100 >= len(s) * {PERCENT}),
counted as (select doc_id, license, i - 1 as at_word, len(list_intersect(list_distinct(h[i:i + n - 1]), s)) as matched, len(s) as of_ from start)
select doc_id, license, arg_min(at_word, at_word - matched * 1000000000) as at_word, max(matched) as matched, of_ as "of"
from counted where matched * 100 >= of_ * {PERCENT} group by doc_id, license, of_
"""


@query("op2_license_scan", SQL)
def op2(spark, folder):
    return found(documents(spark, folder), notice_table(spark))
