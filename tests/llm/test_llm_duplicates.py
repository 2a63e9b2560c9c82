"""Near duplicates, lines, passages, licenses and the pipeline, against SQL or plain versions."""

import random
from collections import defaultdict

import duckdb
import pytest
from compare import TABLES, differences, oracle
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline
from tellerflow.llm import components, licenses, lines, neardup, substrings
from tellerflow.llm.queries import ORACLES, QUERIES

rng = random.Random(8)
VOCABULARY = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]


def noise(n: int) -> list[str]:
    return [rng.choice(VOCABULARY) for _ in range(n)]


def changed(words: list[str], k: int) -> list[str]:
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
    return words


def connected(tmp_path, rows: list[tuple], columns: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute(f"create table documents ({columns})")
    if rows:
        con.executemany(f"insert into documents values ({', '.join('?' * len(rows[0]))})", rows)
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    assert differences(QUERIES[name](spark, DATA), oracle(DATA), ORACLES[name]) is None


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    found = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), **dict.fromkeys(range(200, 203), 200)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_equal_all_pairs(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One TWO"), (6, "one two three"), (7, "x " * 300)]
    base = noise(150)
    for i in range(120):  # few are linked with each other, many through others
        rows.append((100 + i, " ".join(changed(base, rng.choice([0, 1, 1, 2, 3, 4, 6])))))
    chain = noise(300)
    for i in range(30):
        chain = changed(chain, 2)
        rows.append((400 - i, " ".join(chain)))
    rows += [(500 + i, " ".join(base)) for i in range(20)] + [(600 + i, " ".join(noise(60))) for i in range(40)]
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, node string, key int").repartition(4)
    con = connected(tmp_path, rows, "doc_id bigint, text varchar")
    assert differences(neardup.near_duplicates(docs), con, ORACLES["op5_near_duplicates"]) is None
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_blocks_of_a_large_star_find_every_joining_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 16)
    base = noise(150)
    rows = [(i, " ".join(changed(base, rng.choice([2, 3, 4, 5, 7])))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = connected(None, rows, "doc_id bigint, text varchar")
    assert differences(neardup.near_duplicates(docs), con, ORACLES["op5_near_duplicates"]) is None


def test_near_duplicates_at_eighty_per_hundred(spark, monkeypatch):
    base = noise(100)  # 96 shingles; a changed word costs up to 5, so two copies share 86 / 106 = 0.81 and four 0.66
    rows = [(1, " ".join(base)), (2, " ".join([*base[:30], "qqq", *base[31:60], "rrr", *base[61:]])),
            (3, " ".join(base[:20] + ["q1"] + base[21:40] + ["q2"] + base[41:60] + ["q3"] + base[61:80] + ["q4"] + base[81:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in neardup.near_duplicates(docs).where("kept").collect()} == {1, 2, 3}
    assert {r.doc_id for r in neardup.near_duplicates(docs, percent=80).where("kept").collect()} == {1, 3}
    # The blockwise comparison of stars goes by the same figure.
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 16)
    many = [(i, " ".join(changed(base, rng.choice([1, 1, 2])))) for i in range(60)]
    con = connected(None, many, "doc_id bigint, text varchar")
    got = neardup.near_duplicates(spark.createDataFrame(many, "doc_id long, text string"), percent=80)
    assert differences(got, con, ORACLES["op5_near_duplicates"].replace("100 * count(*) >= 85", "100 * count(*) >= 80")) is None


def test_pipeline_drops_one_of_two_documents_at_eighty_two(spark):
    base = noise(104)  # 100 shingles; two changed words take 10 of them: 90 / 110 = 0.82
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join([*base[:30], "qqq", *base[31:60], "rrr", *base[61:]]))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect()] == [1]


def test_near_duplicates_without_ids(spark):
    text = " ".join(noise(50))
    got = neardup.near_duplicates(spark.createDataFrame([(None, text), (9, text), (9, text), (None, "alone here"), (None, None)], "doc_id long, text string"))
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got.collect()), key=str) == sorted(
        [(None, 9, False), (9, 9, True), (9, 9, True), (None, None, True), (None, None, True)], key=str)


def test_lines_equal_sql_on_hard_cases(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "a b c d")]
    for i in range(40):
        own = [" ".join(noise(12)) for _ in range(4)]
        own.insert(rng.randrange(5), f"Page {i} of the report was printed on day {i * 7}")
        own.insert(rng.randrange(6), f"a note posted by {VOCABULARY[i]} in the general forum about news")
        own.insert(rng.randrange(6), "the very same line everywhere")
        rows.append((100 - i, "\n".join(own)))
    rows += [(200 + i, rows[10][1]) for i in range(30)]  # copies are no evidence
    rows += [(300 + i, f"{' '.join(noise(3))}\nonly here and there so far\n{' '.join(noise(3))}") for i in range(5)]
    plain = [(*r, "en", "s", 1) for r in rows]
    docs = spark.createDataFrame([(*r, "x", 3) for r in plain], "doc_id long, text string, lang string, source string, n_chars long, line string, n_lines int")
    con = connected(None, plain, "doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint")
    got = lines.drop_lines(docs)
    assert differences(got.drop("line"), con, ORACLES["op8_line_dedup"]) is None
    templates = {r.template for r in lines.recurring(docs).collect()}
    assert templates == {"page # of the report was printed on day #", "a note posted by <*> in the general forum about news", "the very same line everywhere"}
    assert lines.drop_lines(docs.limit(0)).count() == 0
    bare = lines.drop_lines(spark.createDataFrame([(None, "a b c d e"), (None, None)], "doc_id long, text string")).collect()
    assert sorted((str(r.text), r.n_lines, r.n_dropped) for r in bare) == [("None", 0, 0), ("a b c d e", 1, 0)]


def test_every_line_of_a_block_recurs_by_its_documents(spark):
    block = ["all content on this site is provided as is", "see our terms of use for the details", "copyright by the owners of this site"]
    head = ["welcome to the pages of our site", "please read the following text with care"]
    rows = [(i, "\n".join([*head, *(" ".join(noise(12)) for _ in range(3)), *block])) for i in range(12)]
    rows += [(100 + i, "\n".join(["only one document says this line twelve times", " ".join(noise(12))])) for i in range(3)]
    rows += [(200 + i, "\n".join(" ".join(w) for w in [VOCABULARY[:8], VOCABULARY[8:16], VOCABULARY[16:24]])) for i in range(20)]  # equal texts are one
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.template for r in lines.recurring(docs, documents=True).collect()} == {*block, *head}
    left = {r.doc_id: r.text.split("\n") for r in corpus_pipeline.lines(spark, docs.withColumn("n_chars", F.length("text").cast("long")), "").collect()}
    text = dict(rows)
    assert all(left[i] == text[i].split("\n")[2:5] for i in range(1, 12)) and all("\n".join(left[i]) == text[i] for i in left if not 0 < i < 12)


def test_query_drops_every_line_of_a_footer(spark, tmp_path):
    footer = ["terms of use apply to every page of this site", "see the notice for the details of it", "All rights reserved.", "Top"]
    rows = [(i, "\n".join([*(" ".join(noise(12)) for _ in range(3)), *footer]), "en", "s", 1) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op8_line_dedup"](spark, str(tmp_path))
    assert {(r.doc_id > 0, r.n_dropped) for r in got.select("doc_id", "n_dropped").collect()} == {(True, 4), (False, 0)}
    con = connected(None, rows, "doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint")
    assert differences(got, con, ORACLES["op8_line_dedup"]) is None


def test_short_lines_recur_as_fixed_templates(spark):
    rows = [(i, "\n".join([" ".join(noise(12)), "All rights reserved.", "", " ".join(noise(12)), "Top", f"tag {VOCABULARY[i]}", " \t", "Page %d" % i, " ".join(noise(12))])) for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    left = {r.doc_id: r.text.split("\n") for r in corpus_pipeline.lines(spark, docs, "").collect()}
    text = dict(rows)
    assert all(left[i] == [line for k, line in enumerate(text[i].split("\n")) if k not in (1, 4, 7)] for i in range(1, 15)) and "\n".join(left[0]) == text[0]


def test_licenses_equal_sql_on_hard_cases(spark):
    notice = licenses.NOTICES["GPL-3.0"]
    rows = [(1, None), (2, ""), (3, "!!"), (4, "All rights"), (5, "ALL RIGHTS RESERVED"), (6, f"x. {notice}!"), (7, notice.replace("version 3", "version 2")),
            (8, " ".join([*noise(500), notice, *noise(500), notice])), (9, notice.replace("GNU", "great")), (8, notice), (8, notice)]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, words string, k int")
    con = connected(None, rows[:9], "doc_id bigint, text varchar")
    known = licenses.notice_table(spark)
    assert differences(licenses.found(docs.where("doc_id <> 8 or length(text) > 1000"), known), con, ORACLES["op2_license_scan"]) is None
    assert sorted((r.doc_id, r.at_word) for r in licenses.found(docs.where("doc_id = 8"), known).collect() if r.license == "GPL-3.0") == [(8, 0)]
    long = " ".join(noise(170))
    mine = spark.createDataFrame([("a", long), ("b", long), ("none", None), ("blank", " . ")], "license string, text string")
    texts = [(1, " ".join([*noise(33), *changed(long.split(), 3), *noise(9)])), (2, " ".join(long.split()[:100])), (None, long)]
    got = licenses.found(spark.createDataFrame(texts, "doc_id long, text string"), mine).collect()
    assert {(r.doc_id, r.license, r.at_word) for r in got} == {(1, "a", 33), (1, "b", 33), (None, "a", 0), (None, "b", 0)}
    assert licenses.found(docs.limit(0), known).count() == licenses.found(docs, mine.where("license = 'none'")).count() == 0


def test_fenwick_chains_equal_quadratic_ones():
    for _ in range(60):
        n = rng.randint(1, 25)
        anchors = sorted({(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(n)})
        best = []
        for x, y in anchors:
            before = [f - substrings.GAP * (x - a + y - b) for f, (a, b) in zip(best, anchors) if a < x and b < y]
            best.append(substrings.K + max([0.0, *before]))
        x, y = zip(*anchors)
        import numpy as np

        found = substrings.chains(np.array(x), np.array(y))
        assert sorted(m for part in found for m in part) == list(range(len(anchors)))
        for part in found:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(part, part[1:]))
        first, score = found[0], float(substrings.K)
        for a, b in zip(first, first[1:]):
            score += substrings.K - substrings.GAP * (x[b] - x[a] + y[b] - y[a])
        wide = any(max(x[b] - x[a], y[b] - y[a]) > substrings.FARTHEST + substrings.K for a, b in zip(range(n), range(1, n)) if b < len(x))
        assert wide or len(found[0]) < 2 or abs(score - max(best)) < 1e-9 or len(found) > 1


def test_repeated_passages(spark):
    passage, short = noise(70), noise(30)
    rows = [(1, None), (2, ""), (3, " ".join(noise(200)))]
    carriers = []
    for i in range(25):
        own = changed(passage, 3) if i % 5 == 4 else passage
        rows.append((10 + i, " ".join([*noise(rng.randint(0, 80)), *own, *noise(rng.randint(0, 80)), *short])))
        carriers.append(10 + i)
    rows += [(60 + i, " ".join([*noise(90), *short])) for i in range(6)]
    copy = " ".join(noise(120))
    rows += [(70, copy), (71, copy.upper()), (72, copy), (72, copy), (None, copy), (80, " ".join(noise(20))), (81, "too short to matter"), (82, "too short to matter")]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, seed string, t int").repartition(4)
    got = substrings.passages(docs).collect()
    spans = defaultdict(list)
    for r in got:
        spans[r.doc_id].append((r.start_word, r.end_word, r.partner_id))
        assert r.end_word - r.start_word >= substrings.LEAST and r.edits * 100 <= substrings.EDITS * max(r.end_word - r.start_word, r.partner_end - r.partner_start)
    assert set(spans) == {*carriers, 70, 71, 72, None}
    for i, t in rows:
        if i in carriers:
            w = t.split()
            at = next(k for k in range(len(w)) if sum(a == b for a, b in zip(w[k : k + 70], passage)) >= 60)
            assert any(a <= at + 9 and b >= at + 61 for a, b, _ in spans[i])
    assert all(p is not None and (p != i or i == 72) for i in (70, 71, 72) for _, _, p in spans[i])
    assert substrings.passages(docs.limit(0)).count() == 0


def test_passages_that_stand_twice_in_a_text(spark):
    notice, own = noise(60), noise(60)
    head_and_foot = [*notice, *noise(300), *notice]
    rows = [(1, head_and_foot), (2, [*noise(100), *notice]), (3, [*noise(50), *own, *noise(200), *own]), (4, noise(300)), (5, ["same"] * 400)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    spans = defaultdict(set)
    for r in substrings.passages(docs).collect():
        spans[r.doc_id].add((r.start_word, r.end_word, r.partner_id))
    assert {(a, b) for a, b, _ in spans[1]} >= {(0, 60), (360, 420)} and (100, 160) in {(a, b) for a, b, _ in spans[2]}
    assert spans[3] == {(50, 110, 3), (310, 370, 3)} and 4 not in spans


def test_passages_of_sentences_that_stand_elsewhere_one_by_one(spark):
    rows = []
    for k in range(10):
        sentences = [noise(20) for _ in range(3)]
        rows += [(1000 * k + i, [*noise(30), *sentences[0], *sentences[1], *sentences[2], *noise(30)]) for i in range(2)]
        rows += [(1000 * k + 10 + 3 * i + j, [*noise(30), *s, *noise(30)]) for i in range(20) for j, s in enumerate(sentences)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    spans = {(r.doc_id, r.start_word, r.end_word, r.partner_id) for r in substrings.passages(docs).collect()}
    assert spans == {(1000 * k + i, 30, 90, 1000 * k + 1 - i) for k in range(10) for i in range(2)}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with the stages' tables: the given ones, and rows that are hard to bear."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = [(None, "Nobody knows this one by any number", "en", "s", 35), (900001, None, "en", "s", 0), (900002, "", None, None, 0), (900003, "12 34 !!", "en", "s", 8),
           (900004, "same row again and again and again", "en", "s", 34), (900004, "same row again and again and again", "en", "s", 34)]
    docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("n_tokens", F.lit("mine")).withColumn("score", F.lit(5)).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    con = duckdb.connect()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        path = f"{small}/out-{name}"
        out.write.parquet(path)
        after = spark.read.parquet(path)
        con.execute(f"create or replace view documents as select * from read_parquet('{small}/{'documents.parquet' if name == 'language' else before}/*.parquet')")
        rows = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
        left = {(r.doc_id, r.text) for r in after.select("doc_id", "text").collect()}
        if name != "encoding":
            assert after.columns == docs.columns
        if name == "language":
            assert rows - left == {(900001, None), (900002, ""), (900003, "12 34 !!")} and left < rows
        if name == "lines":
            want = {(i, t) for i, t, n in con.execute(f"select doc_id, text, n_dropped from ({ORACLES['op8_line_dedup']})").fetchall() if not n or t.strip()}
            assert left == want and after.where("n_chars <> length(text)").count() == docs.where("n_chars <> length(text)").count()
        if name == "near_duplicates":
            sql = ORACLES["op5_near_duplicates"].replace("100 * count(*) >= 85", "100 * count(*) >= 80")
            assert sql != ORACLES["op5_near_duplicates"]
            kept = {i for i, k in con.execute(f"select doc_id, kept from ({sql}) where doc_id is not null").fetchall() if k}
            assert {i for i, _ in left if i is not None} == kept and any(i is None for i, _ in left)
        if name == "decontamination":
            norm = lambda t: " ".join("".join(c for c in t.lower() if c not in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").split())
            items = [norm(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
            holds = {(i, t) for i, t in rows if any(f" {x} " in f" {norm(t)} " for x in items)}
            assert holds and holds <= rows - left and len(rows - left) <= len(holds) + 0.02 * len(rows)
        if name == "encoding":
            import hashlib

            assert after.count() == docs.count() and all(r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for r in after.collect())
        docs, before = after, f"out-{name}"


def test_pipeline_on_empty_tables(spark, tmp_path):
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{DATA}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_everything_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert set(TABLES) >= {"documents", "embeddings", "benchmark"} and set(ORACLES) <= set(QUERIES)


def test_sketches_hold_a_small_part_of_a_batch(spark):
    """Work arrays follow the bytes of a slice, not those of a batch, and slices do not change a document's keys."""
    import tracemalloc

    import pyarrow as pa

    texts = [" ".join(f"w{(i * 7919 + j) % 5003}" for j in range(400)) for i in range(1500)]  # about 3 MB
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    parts = [neardup.band_keys(neardup.sketch(*neardup._shingled(s))) for s in neardup.slices(batch, "text", neardup.SLICE)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = neardup.band_keys(neardup.sketch(*neardup._shingled(batch)))
    assert sum(map(len, parts)) == 1500 and [r for p in parts for r in p.tolist()] == whole.tolist()
    assert peak < 40 << 20
