"""Benchmark decontamination by a prefix-filtered set join, with built-in functions only.

Texts are cut into words once; the words are written and every later step reads them.

A window of an item occurs in a document exactly if all its shingles do, one after the other.
For such full containment one shingle of the window is a necessary prefix: the one that is rarest in the
documents. Documents are joined on that shingle alone, and a candidate must have room for
the window before and after it before the words are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import stored, table

WINDOW = 10
#: Prefix shingles up to this number are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII characters that stand in no word: all but letters and digits.
_BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def words_of(text: Column) -> Column:
    """Words of a text after lower-casing A-Z, runs of ASCII letters and digits and of all other characters; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _BETWEEN, _LOWER + " " * len(_BETWEEN))
    # A blank as pattern is split without a regular expression.
    return F.array_remove(F.split(plain, " "), "")


def item_windows(items: DataFrame, id: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (``wid``, ``words``) and which items hold them (``wid``, ``item``).

    An item with fewer than ``window`` words, but not none, is one window.
    """
    words = items.select(F.col(id).cast("string").alias("item"), words_of(F.col(text)).alias("ws"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - (window - 1), F.lit(1)))
    cut = (
        words.where(F.size("ws") > 0)
        .select("item", "ws", F.explode(starts).alias("at"))
        .select("item", F.slice("ws", F.col("at"), F.lit(window)).alias("words"))
        # Words hold no blanks, so the joined text stands for the window.
        .withColumn("wid", F.array_join("words", " "))
        .distinct()
    )
    cut = stored(cut, "item-windows")
    return cut.select("wid", "words").distinct(), cut.select("wid", "item").distinct()


def _near(small: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def _cut(docs: DataFrame, text: str) -> DataFrame:
    """The rows as ``rest``, with ``text_key`` and the words ``ws`` of each text, written."""
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if docs.columns else F.struct(F.lit(1))
    rows = docs.select(
        columns.alias("rest"), text_key(F.col(f"`{text}`")).alias("text_key"), words_of(F.col(f"`{text}`")).alias("ws")
    )
    return stored(rows, "text-words")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """What each text that holds a window shares with the items: ``text_key``, ``n_hit``, ``n_items``, ``items_sha256``.

    ``text_key`` is :func:`text_key` of the text; join it back to rows. Hits of equal texts are
    one row, so a hot group of copies is one. A word is hit if it lies inside any occurrence of a
    window. Null and empty texts have no words and are clean; items without words match nothing;
    an item with a null id counts for hit words and is not listed; repeated items count once; ids
    are listed sorted as strings. Empty tables give an empty or an all-clean result. Very
    long texts are one row each; what is kept of a text while joining is its words.
    """
    return _contamination(_cut(docs.select(text), text), items, item_id, item_text, window)


def _contamination(texts: DataFrame, items: DataFrame, item_id: str, item_text: str, window: int) -> DataFrame:
    windows, holders = item_windows(items, item_id, item_text, window)
    vocabulary = stored(windows.select(F.explode("words").alias("word")).distinct(), "item-words")
    n_vocabulary = vocabulary.count()
    # Rarity counts all documents.
    counts = stored(
        texts.select(F.explode("ws").alias("word"))
        .join(_near(vocabulary, n_vocabulary), "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n")),
        "item-word-counts",
    )
    rarest = Window.partitionBy("wid").orderBy("n", "word", "off")
    prefixes = (
        windows.select("wid", "words", F.posexplode("words").alias("off", "word"))
        .join(counts, "word", "left")
        # A window with a word that no document has cannot occur.
        .withColumn("absent", F.max(F.col("n").isNull()).over(Window.partitionBy("wid")))
        .where(~F.col("absent"))
        .withColumn("rank", F.row_number().over(rarest))
        .where("rank = 1")
        .select("wid", "words", "off", "word")
    )
    prefixes = stored(prefixes, "window-prefixes")
    found = _occurrences(texts, prefixes, prefixes.count())
    found = stored(found, "window-hits")
    hit = (
        found.select(
            "text_key", F.explode(F.sequence("start", F.expr("start + length - 1"))).alias("pos")
        )
        .distinct()
        .groupBy("text_key")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    listed = (
        found.select("text_key", "wid")
        .distinct()
        .join(holders, "wid")
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set("item")).alias("ids"))
    )
    found_in = hit.join(listed, "text_key", "left").select(
        "text_key",
        "n_hit",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("ids", F.array().cast("array<string>")), ","), 256).alias("items_sha256"),
    )
    # Written, so that the join to rows reads plain exchanges and a hot text can be split.
    return stored(found_in, "contaminated-texts")


def _occurrences(texts: DataFrame, prefixes: DataFrame, rows: int) -> DataFrame:
    """Where windows occur: ``text_key``, ``wid``, ``start``, ``length``, each once.

    Few prefixes are brought to the texts, whose words are at hand then. Many are shuffled with narrow rows of
    single words; only texts with a candidate are fetched again, each once, to compare all words.
    """
    start = F.col("pos") - F.col("off")
    room = (start >= 0) & (start + F.size("words") <= F.col("n"))
    same = F.slice("ws", F.col("start") + 1, F.size("words")) == F.col("words")
    hit = ("text_key", "wid", "start", F.size("words").alias("length"))
    n = F.size("ws").alias("n")
    if rows <= BROADCAST_ROWS:
        words = texts.select("text_key", "ws", n, F.posexplode("ws").alias("pos", "word"))
        near = words.join(F.broadcast(prefixes), "word").where(room).withColumn("start", start)
        return near.where(same).select(*hit).distinct()
    words = texts.select("text_key", n, F.posexplode("ws").alias("pos", "word"))
    near = words.join(prefixes, "word").where(room)
    near = stored(near.select("text_key", "wid", start.alias("start")).distinct(), "window-candidates")
    # Copies are combined before the shuffle.
    held = texts.join(near.select("text_key").distinct(), "text_key", "left_semi")
    held = held.groupBy("text_key").agg(F.first("ws").alias("ws"))
    wanted = near.join(prefixes.select("wid", "words"), "wid")
    return wanted.join(held, "text_key").where(same).select(*hit)


def text_key(text: Column) -> Column:
    """A 160-bit key of a text; null counts as empty."""
    return F.sha1(F.coalesce(text, F.lit("")).cast("binary"))


def flagged(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    Columns of these names are replaced, all others stay, whatever their names; see :func:`contamination` for the
    cases. Rows are written once with their words; only the short results are joined to them.
    """
    added = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    rows = _cut(docs.drop(*added), text)
    hits = _contamination(rows, items, item_id, item_text, window)
    joined = rows.select("rest", "text_key", F.size("ws").cast("long").alias("n_words")).join(hits, "text_key", "left")
    return joined.select(
        "rest.*",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op6_prefix_containment(spark, sf_dir):
    """What every document shares with the benchmark items, over windows of ten words."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return flagged(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


_SQL_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

QUERIES = {"op6_prefix_containment": op6_prefix_containment}
ORACLES = {
    "op6_prefix_containment": f"""
with d as (select doc_id, {_SQL_WORDS} as ws from documents),
i as (select cast(item_id as varchar) as item, {_SQL_WORDS} as ws from benchmark),
w as (select distinct item, array_to_string(ws[s:s + 9], ' ') as win, least(len(ws), 10) as n
      from (select item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as s from i where len(ws) > 0)),
p as (select doc_id, ws, unnest(range(1, len(ws) + 1)) as s from d),
h as (select distinct p.doc_id, p.s, w.n, w.item
      from p cross join (select distinct n from w) k
      join w on w.n = k.n and w.win = array_to_string(p.ws[p.s:p.s + k.n - 1], ' ')
      where p.s + k.n - 1 <= len(p.ws)),
n as (select doc_id, count(distinct q) as n_hit
      from (select doc_id, unnest(range(s, s + n)) as q from h) group by doc_id),
l as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
      from (select distinct doc_id, item from h) group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join l using (doc_id)""",
}
