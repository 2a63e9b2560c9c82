"""Line dedup by a log-template tree, in DataFrame operations only.

The tree has a fixed depth: a line goes by its number of tokens and by its first
``depth`` tokens, digits masked, to a leaf. In a leaf, a token that fewer than
``least`` contexts show at its position is a variable field and becomes ``<*>``;
what remains is the line's template. A template with at least ``constant`` fixed
tokens per hundred is recurring if ``least`` contexts show it, and recurring
templates are dropped, but for their first line.

A context is the pair of neighbouring lines. Inside a block of several lines the
neighbours are the block itself, so a footer in any number of documents shows one
context; therefore a leaf, token or template also counts as shown if ``least``
distinct texts have it, whatever stands beside it. Neither counts rows: exact copies
of a document count once, as they are the concern of near-duplicate removal, and
their own lines are not boilerplate. Near copies count as different texts.
``documents=False`` keeps to contexts alone.

A line's fate depends on its text's content alone: equal texts are treated
alike, whatever their ids. The first line kept of a template is the one with the
smallest doc_id (NULL last), then text hash, then position; texts equal to that
text keep it too.

Defined cases: NULL text stays NULL with 0 lines; an empty text is one empty
line; lines without a token or with fewer than ``tokens`` are never dropped (up to
three tokens, ``constant`` demands that all are fixed); a text whose lines are all dropped becomes empty. Every row gives one row, and extra columns
stay as they are, but for ones named n_lines or n_dropped, which the result's
replace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow.llm.registry import documents, query
from tellerflow.operators.sinks import durable

LEAST, DEPTH, TOKENS, CONSTANT = 10, 3, 1, 70

# The white space that separates tokens.
WHITE, BLANKS = "[\\x09-\\x0D\\x20]+", "\t\n\x0b\x0c\r "


def _shown(rows: DataFrame, keys: list[str], least: int, documents: bool) -> DataFrame:
    """The keys that ``least`` contexts show, or with ``documents`` as many distinct texts."""
    kinds = [F.struct(F.lit(0).alias("kind"), F.col("context").alias("v"))]
    if documents:
        kinds.append(F.struct(F.lit(1).alias("kind"), F.col("text_hash").alias("v")))
    seen = rows.select(*keys, F.explode(F.array(*kinds)).alias("e")).select(*keys, "e.*") if documents else rows.select(*keys, F.lit(0).alias("kind"), F.col("context").alias("v"))
    often = seen.distinct().groupBy(*keys, "kind").count().where(F.col("count") >= least).select(*keys)
    return often.distinct() if documents else often


def _lines(docs: DataFrame, text: str, doc_id: str, depth: int) -> DataFrame:
    """One row per line: its text's hash, position, leaf, context, and the masked tokens."""
    t = F.col(f"`{text}`").cast("string")
    masked = F.split(F.lower(F.regexp_replace(t, "[0-9]+", "#")), "\n")
    rows = docs.where(t.isNotNull()).select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(t).alias("text_hash"), masked.alias("lines")
    )

    def entry(line, i):
        near = F.xxhash64(F.get("lines", i - 1), F.lit("|"), F.get("lines", i + 1))
        return F.struct(i.alias("pos"), near.alias("context"), F.split(F.btrim(line, F.lit(BLANKS)), WHITE).alias("tokens"))

    # Made before the explode, so that filters on tokens don't cut the line up once more.
    rows = rows.select("doc_id", "text_hash", F.explode(F.transform("lines", entry)).alias("e")).select("doc_id", "text_hash", "e.*")
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth))
    return rows.withColumn("leaf", leaf)


def recurring(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, depth: int = DEPTH,
              tokens: int = TOKENS, constant: int = CONSTANT, documents: bool = True) -> DataFrame:
    """The lines to drop: (text_hash, pos, template), one row per distinct text and line."""
    lines = _lines(docs, text, doc_id, depth).where((F.size("tokens") >= tokens) & (F.element_at("tokens", 1) != ""))
    leaves = _shown(lines, ["leaf"], least, documents)
    # Written, so that Spark plans the next join by the leaves' true size.
    leaves = durable(leaves, "line-leaves")
    busy = lines.join(leaves, "leaf")
    busy = durable(
        busy.groupBy("text_hash", "pos").agg(F.min(F.coalesce("doc_id", F.lit(2**63 - 1))).alias("doc_id"), *[F.first(c).alias(c) for c in ("context", "leaf", "tokens")]),
        "line-candidates",
    )
    fields = busy.select("text_hash", "pos", "leaf", "context", F.posexplode("tokens").alias("place", "token"))
    fixed = _shown(fields, ["leaf", "place", "token"], least, documents).withColumn("fixed", F.lit(1))
    parts = fields.join(fixed, ["leaf", "place", "token"], "left")
    whole = parts.groupBy("text_hash", "pos").agg(
        F.sort_array(F.collect_list(F.struct("place", F.when(F.col("fixed") == 1, F.col("token")).otherwise("<*>").alias("token")))).alias("parts"),
        F.count("fixed").alias("fixed"), F.count("*").alias("n"),
    )
    template = F.concat_ws(" ", F.col("parts.token"))
    found = whole.where(F.col("fixed") * 100 >= F.col("n") * constant).select("text_hash", "pos", template.alias("template"))
    found = found.join(busy.select("text_hash", "pos", "context", "doc_id"), ["text_hash", "pos"])
    first = F.struct("doc_id", "text_hash", "pos")
    often = found.groupBy("template").agg(F.min(first).alias("first")).join(_shown(found, ["template"], least, documents), "template")
    dropped = found.join(often, "template").where(~((F.col("first.text_hash") == F.col("text_hash")) & (F.col("first.pos") == F.col("pos"))))
    return dropped.select("text_hash", "pos", "template")


def drop_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options: int | bool) -> DataFrame:
    """Every row with its text rid of recurring lines, and n_lines, n_dropped."""
    gone = recurring(docs, text, doc_id, **options).groupBy("text_hash").agg(F.collect_list("pos").alias("_line_drops"))
    gone = durable(gone, "line-drops")
    t = F.col(f"`{text}`")
    # Few texts lose lines, but their number grows with the corpus: the join is planned alike at every size.
    joined = docs.withColumn("_line_text_hash", F.xxhash64(t.cast("string"))).join(gone.withColumnRenamed("text_hash", "_line_text_hash").hint("merge"), "_line_text_hash", "left")
    lines = F.split(t.cast("string"), "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("_line_drops", i)), "\n")
    n_lines = F.coalesce(F.size(F.when(t.isNotNull(), lines)), F.lit(0))
    return joined.select(
        *[F.when(F.col("_line_drops").isNull(), t).otherwise(kept).alias(c) if c == text else F.col(f"`{c}`")
          for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")],
        F.when(t.isNull(), 0).otherwise(n_lines).alias("n_lines"),
        F.when(t.isNull() | F.col("_line_drops").isNull(), 0).otherwise(F.size("_line_drops")).alias("n_dropped"),
    )


_OFTEN = f"(count(distinct context) >= {LEAST} or count(distinct text) >= {LEAST})"

# The same definition over strings in place of hashes.
SQL = f"""
with texts as (select text, min(coalesce(doc_id, 9223372036854775807)) as doc_id from {{docs}} where text is not null group by text),
split as (select text, doc_id, string_split(text, chr(10)) as raw, string_split(lower(regexp_replace(text, '[0-9]+', '#', 'g')), chr(10)) as lines from texts),
line as (select text, doc_id, pos, lines[pos] as line, [lines[pos - 1], lines[pos + 1], (pos = 1)::varchar] as context
         from split, unnest(range(1, len(lines) + 1)) as u(pos)),
cut as (select * , string_split_regex(regexp_replace(regexp_replace(line, '^{WHITE}', ''), '{WHITE}$', ''), '{WHITE}') as tokens from line),
leafed as (select *, [len(tokens)::varchar, tokens[1], tokens[2], tokens[3]] as leaf from cut where len(tokens) >= {TOKENS} and tokens[1] <> ''),
busy as (select * from leafed where leaf in (select leaf from leafed group by leaf having {_OFTEN})),
field as (select text, pos, leaf, context, place, tokens[place] as token from busy, unnest(range(1, len(tokens) + 1)) as u(place)),
fixed as (select leaf, place, token from field group by all having {_OFTEN}),
whole as (select f.text, f.pos, string_agg(case when x.token is null then '<*>' else f.token end, ' ' order by f.place) as template,
                 count(x.token) as fixed, count(*) as n
          from field f left join fixed x on f.leaf = x.leaf and f.place = x.place and f.token = x.token group by f.text, f.pos),
found as (select w.text, w.pos, w.template, b.context, b.doc_id from whole w join busy b on w.text = b.text and w.pos = b.pos
          where w.fixed * 100 >= w.n * {CONSTANT}),
often as (select template, min([doc_id, pos]) as first from found group by template having {_OFTEN}),
gone as (select f.text, list(f.pos) as gone from found f join often o on f.template = o.template
         where [f.doc_id, f.pos] <> o.first group by f.text)
"""


@query(
    "op8_line_dedup",
    SQL.format(docs="documents") + """
select d.doc_id, d.lang, d.source, d.n_chars,
       case when g.gone is null then d.text
            else array_to_string(list_filter(string_split(d.text, chr(10)), lambda x, i: not list_contains(g.gone, i)), chr(10)) end as text,
       case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as n_lines,
       coalesce(len(g.gone), 0) as n_dropped
from documents d left join gone g on d.text = g.text""",
)
def op8(spark, folder):
    return drop_lines(documents(spark, folder))
