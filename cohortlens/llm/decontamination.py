"""Benchmark decontamination with a distributed positional inverted index.

SQL functions only. ``build`` stores the postings of every word of every document: a row of the index holds a
stretch of ``STRETCH`` words of one document (and ``margin`` words on either side) as its posting lists, that
is (word, place) sorted by word, each in one number: 52 bits of the word's XXH64 and 12 of the place. So no
posting is shuffled, a document of any length makes rows of bounded size, and a word that stands in a third
of all documents has its list in as many pieces as there are stretches.

``matches`` asks for windows of words. The postings of their words are counted in the index; a window's lists
are taken from its rarest word on. The rarest one meets the index by a join, in blocks of ``WINDOWS`` windows;
its list, less the word's offset in the window, gives the candidate starts, and a candidate is kept as long as
the next list, less its own offset, holds it too, so most end at the second list. With ``slop`` the
lists intersect within that many words: a proximity match, where every word of the window stands at most
``slop`` words from its place beside the rarest one. ``slop`` 0 gives the exact phrases.

A word of two different texts of one 52-bit hash would count as the same; a window of several words would
have to meet that in all of its places.

Defined results: a NULL or empty text has no words, is not contaminated, and as an item has no windows; an item
of fewer words than a window is one window; an item without an id hits words, but is not counted or listed;
rows of one item id are one item; repeated documents are judged one by one, also where their id is NULL;
empty tables give an empty table or clean documents; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WINDOW = 10
STRETCH = 2048          # words of a document in one index row
MARGIN = 16             # words of its neighbours on either side: the longest window and the slop fit in
WINDOWS = 50_000        # windows that are sent to all tasks at a time
TERMS = 1_000_000       # words up to which the table of asked words is broadcast
PLACE = (1 << 12) - 1   # bits of a posting that hold the place
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text in order: A-Z in lower case, cut at ASCII that is neither letter nor digit."""
    t = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(t) == F.char_length(t)
    lowered = F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(lowered, NO_WORD, -1), "")


def terms(text: Column) -> Column:
    """The words of a text as numbers whose last 12 bits are zero."""
    return F.transform(words(text), lambda w: F.xxhash64(w).bitwiseAND(F.lit(~PLACE)))


def _term(posting: Column) -> Column:
    return posting.bitwiseAND(F.lit(~PLACE))


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: int = MARGIN) -> DataFrame:
    """The index (row, doc_id, n_words, part, first, postings), written to the shared folder.

    ``row`` numbers the rows of ``docs``, ``part`` the stretches of one, ``first`` is the place of the first word of
    its postings. Part 0 is there for every document.
    """
    if STRETCH + 3 * margin > PLACE:
        raise ValueError(f"a margin of {margin} words is too wide for the places of a posting")
    t = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                    terms(F.col(text_col)).alias("terms"))
    n = F.size("terms")
    last = F.greatest(F.lit(0), F.floor((n - 1) / F.lit(STRETCH)).cast("int"))
    t = t.select("*", n.cast("long").alias("n_words"), F.explode(F.sequence(F.lit(0), last)).alias("part"))
    first = F.greatest(F.lit(0), F.col("part") * STRETCH - margin)
    here = F.slice("terms", first + 1, (F.col("part") + 1) * STRETCH + margin - first)
    postings = F.sort_array(F.transform(here, lambda w, i: w.bitwiseOR(i.cast("long"))))
    return materialize(t.select("row", "doc_id", "n_words", "part", first.alias("first"), postings.alias("postings")),
                       "positional-index")


def windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, win): the windows of ``size`` consecutive words of every item, as arrays of word numbers."""
    i = items.select(F.col(id_col).cast("string").alias("item_id"), terms(F.col(text_col)).alias("terms"))
    n = F.size("terms")
    m = F.least(n, F.lit(size))
    i = i.filter(n > 0).select("item_id", "terms", m.alias("m"), F.explode(F.sequence(F.lit(1), n - m + 1)).alias("s"))
    return i.select("item_id", F.slice("terms", F.col("s"), F.col("m")).alias("win")).distinct()


def by_rarity(index: DataFrame, asked: DataFrame) -> DataFrame:
    """(win_id, lists): a window's words as (n, term, at), the one of the fewest postings first; windows with a
    word that the index does not hold are left out."""
    word = asked.select("win_id", F.size("win").alias("m"), F.posexplode("win").alias("at", "term"))
    vocabulary = materialize(word.select("term").distinct(), "asked-words")
    small = F.broadcast(vocabulary) if vocabulary.count() <= TERMS else vocabulary
    n = index.select(F.explode("postings").alias("p")).select(_term(F.col("p")).alias("term")).join(small, "term") \
        .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    lists = word.join(materialize(n, "word-counts"), "term").groupBy("win_id", "m").agg(
        F.sort_array(F.collect_list(F.struct("n", "term", "at"))).alias("lists"))  # at most ``size`` rows
    return lists.filter(F.size("lists") == F.col("m")).select("win_id", "lists")


def _all_meet(lists: Column, start: Column, slop: int) -> Column:
    """Whether every list, less its offset, holds the start (within ``slop``); ends at the first that does not."""
    def holds(x: Column, by: Column) -> Column:
        place = start + x.at + by
        posting = x.term.bitwiseOR(place.cast("long"))
        return place.between(0, PLACE) & F.array_contains("postings", posting)

    if slop == 0:
        return F.forall(lists, lambda x: holds(x, F.lit(0)))
    by = F.array(*[F.lit(d) for d in sorted(range(-slop, slop + 1), key=abs)])
    return F.forall(lists, lambda x: F.exists(by, lambda d: holds(x, d)))


def matches(index: DataFrame, asked: DataFrame, slop: int = 0, margin: int = MARGIN, block: int = WINDOWS) -> DataFrame:
    """(row, win_id, size, start) of every place in a document where a window of ``asked`` (win_id, win) stands:
    exactly, or with ``slop`` within as many words. A table in the shared folder for each block of windows."""
    longest = asked.agg(F.max(F.size("win"))).first()[0] or 0
    if longest + slop > margin:
        raise ValueError(f"windows of {longest} words and a slop of {slop} exceed the index margin of {margin}")
    lists = materialize(by_rarity(index, asked), "window-lists")
    blocks = max(1, -(-lists.count() // block))
    rarest = F.element_at("lists", 1)
    out = []
    for b in range(blocks):
        some = lists.filter(F.pmod(F.xxhash64("win_id"), F.lit(blocks)) == b).select(
            "win_id", F.size("lists").alias("size"), F.slice("lists", 2, 1 << 20).alias("lists"),
            rarest["term"].alias("term"), rarest["at"].alias("at"))
        each = index.select("row", "part", "first", "postings", F.explode("postings").alias("p")) \
            .withColumn("term", _term(F.col("p"))).join(F.broadcast(some), "term")  # about ``block`` windows
        each = each.withColumn("s", F.col("p").bitwiseAND(F.lit(PLACE)).cast("int") - F.col("at"))
        start = F.col("first") + F.col("s")
        # A place in the margin of a stretch belongs to the stretch beside it.
        own = F.floor(F.greatest(start, F.lit(0)) / F.lit(STRETCH)) == F.col("part")
        # As a generator, not a filter: as a condition of the join it would be run, and the postings copied, for
        # every posting of the index instead of the candidates.
        met = each.filter(own).select("row", "win_id", "size", F.explode(F.when(
            _all_meet(F.col("lists"), F.col("s"), slop), F.array(start)).otherwise(F.array().cast("array<long>"))).alias("start"))
        out.append(materialize(met, "matches"))
    return reduce(DataFrame.unionByName, out)


def search(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index of ``docs``, the windows of ``items`` (item_id, win_id) and their ``matches``."""
    margin = max(MARGIN, size + slop)
    index = build(docs, id_col, text_col, margin)
    wins = materialize(windows(items, size, item_col, item_text), "windows")
    distinct = materialize(wins.select("win").distinct().withColumn("win_id", F.monotonically_increasing_id()), "distinct-windows")
    of = wins.join(distinct, "win").select("item_id", "win_id")
    return index, of, matches(index, distinct, slop, margin)


def covered(found: DataFrame) -> DataFrame:
    """(row, n_hit): words of a document inside at least one match."""
    end = F.col("start") + F.col("size")
    before = Window.partitionBy("row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = found.select("row", "start", "size").distinct().withColumn("before", F.max(end).over(before))
    new = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("before", "start")))
    return d.groupBy("row").agg(F.sum(new).cast("long").alias("n_hit"))


def summary(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its words, those in windows of ``items``, and which items these are."""
    index, of, found = search(docs, items)
    met = found.select("row", "win_id").distinct().join(of, "win_id").filter(F.col("item_id").isNotNull()) \
        .select("row", "item_id").distinct()
    listed = met.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(
        F.sort_array(F.collect_list("item_id")), ",").alias("items"))  # the listed items of one document
    out = index.filter("part = 0").select("row", "doc_id", "n_words").join(covered(found), "row", "left").join(listed, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))


_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
i2 AS (SELECT item_id, w, least(len(w), {WINDOW}) AS m FROM i WHERE len(w) > 0),
i3 AS (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM i2),
q AS (SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS phrase FROM i3),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS s FROM d),
g AS (SELECT r, s, m, array_to_string(w[s:s + m - 1], ' ') AS phrase FROM p, (SELECT DISTINCT m FROM q)
      WHERE s + m - 1 <= len(w)),
h AS (SELECT g.r, g.s, g.m, q.item_id FROM g JOIN q ON g.phrase = q.phrase AND g.m = q.m),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(s, s + m)) AS place FROM h) GROUP BY r),
item AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
         FROM (SELECT DISTINCT r, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)
"""
