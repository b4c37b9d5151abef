"""Benchmark decontamination as a prefix-filtered set join (DataFrame
functions only).

A benchmark item's windows are its runs of ``WINDOW`` consecutive words (a
shorter item is one window). A window can only occur where all its words do,
so joining on any one of them is enough, and the rarest has the fewest
matches: words are ordered by their frequency in all documents, and each
window joins by its rarest word (the necessary prefix of an exact containment).
The place of that word in the window bounds where the window can start; the
words there are then compared exactly.

The documents are exploded word by word and joined in the same stage, so only
candidate places are ever written. The windows are broadcast only while their
counted number is below ``BROADCAST_ROWS``; beyond it the planner joins them by
shuffle, each place with its next words only, and AQE splits frequent words.

The documents are read three times: for the word frequencies, the occurrences and
the result; windows and occurrences are written tables.

Defined cases: null and empty texts have no words and no hits; an item without
words has no window; rows without doc_id are searched like others, rows of one
doc_id each by their own text; repeated rows are reported alike, repeated items have
one id; an empty benchmark contaminates nothing; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.exchange import stored

WINDOW = 10
BROADCAST_ROWS = 200_000
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that as long as no other upper or
    title case letter is there, which one scan tells."""
    return F.when(text.rlike(r"[\p{IsUppercase}\p{IsTitlecase}&&[^A-Z]]"), F.translate(text, _UPPER, _UPPER.lower())).otherwise(
        F.lower(text))


def split_words(text: Column) -> Column:
    """Words with, possibly, an empty string at either end."""
    return F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS, -1)


def count_words(words: Column) -> Column:
    n = F.size(words)
    first = F.when(F.element_at(words, 1) == "", 1).otherwise(0)
    last = F.when((n > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
    return (n - first - last).cast("long")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, words`` per distinct window of each item."""
    words = F.filter(split_words(F.col("text")), lambda w: w != "")
    own = items.select(F.col("item_id").cast("string").alias("item_id"), words.alias("all")).where("size(all) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - size + 1))
    return own.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("all", i, size))).alias("words")).distinct()


def _small(df: DataFrame) -> DataFrame:
    """Broadcast after a count has proved the size."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def prefixes(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """``word, back, n, item_id, words``: every window under its rarest word,
    which stands ``back`` words after the window's start."""
    vocabulary = wins.select(F.explode("words").alias("word")).distinct()
    seen = docs.select(F.explode(split_words(F.col("text"))).alias("word")).join(_small(vocabulary), "word")
    rarity = seen.groupBy("word").agg(F.count("*").alias("df"))
    placed = wins.select("item_id", "words", F.posexplode("words").alias("back", "word")).join(rarity, "word", "left")
    best = placed.groupBy("item_id", "words").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "word", "back")).alias("p"))
    return best.where("p.df > 0").select("p.word", "p.back", F.size("words").alias("n"), "item_id", "words")


def occurrences(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, text_key, start, n, item_id`` of every window occurrence
    (``text_key``, the text's hash, tells rows of one doc_id apart)."""
    keys = stored(prefixes(docs, windows(items, size)).select("word", "back", "n", "item_id", F.col("words").alias("window")), "windows")
    words = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), split_words(F.col("text")).alias("words"))
    each = words.select("doc_id", "text_key", "words", F.posexplode("words").alias("at", "word")).withColumn("skip", F.lit(0))
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    else:  # a shuffled row carries the words that a window through its place can have
        skip = F.greatest(F.col("at") - (size - 1), F.lit(0))
        each = each.select("doc_id", "text_key", F.slice("words", skip + 1, F.lit(2 * size - 1)).alias("words"), "at", "word",
                           skip.alias("skip"))
    start = F.col("at") - F.col("back")
    place = start - F.col("skip")
    return each.join(keys, "word").where(
        (start >= 0) & (place + F.col("n") <= F.size("words"))
        & (F.slice("words", F.greatest(place, F.lit(0)) + 1, F.col("n")) == F.col("window"))
    ).select("doc_id", "text_key", start.alias("start"), "n", "item_id")


def with_found(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with rows of ``found`` for the same doc_id and text."""
    return docs.join(found, (F.xxhash64(docs["text"]) == found["text_key"])
                     & docs["doc_id"].cast("long").eqNullSafe(found["doc_id"]), how)


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated``."""
    found = stored(occurrences(docs, items, size).distinct(), "occurrences")
    key = ["doc_id", "text_key"]
    hit = found.select(*key, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("at")).distinct().groupBy(
        *key).agg(F.count("*").alias("n_hit"))
    ids = found.select(*key, "item_id").distinct().groupBy(*key).agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    both = hit.join(ids.withColumnsRenamed({"doc_id": "id"}), (hit["text_key"] == ids["text_key"]) & hit["doc_id"].eqNullSafe(F.col("id"))).select(
        hit["doc_id"], hit["text_key"], "n_hit", "ids")
    # ids, keys and counts only: no text is shuffled
    rows = docs.select(F.col("doc_id").cast("long").alias("row_id"), F.xxhash64("text").alias("row_key"),
                       count_words(split_words(F.col("text"))).alias("n_words"))
    every = rows.join(both, (rows["row_key"] == both["text_key"]) & rows["row_id"].eqNullSafe(both["doc_id"]), "left")
    return every.select(
        F.col("row_id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))
