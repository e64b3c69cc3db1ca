"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A benchmark text is cut into windows of ``width`` consecutive words. A window must be found whole, so one of its words is
a sufficient prefix: its rarest word in the corpus. The join goes over that word alone; the place
of the word in the window and the length of the document bound what may follow, and the words of the document at
that place are then compared with all of the window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewatch.llm.words import word_array
from linewatch.session import materialise

#: A window table below this size goes to every executor; a larger one is joined by shuffles.
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Windows:
    """``windows``: words, text. ``items``: text, item_id, a row for each item that has the window."""

    windows: DataFrame
    items: DataFrame
    small: bool


def item_windows(items: DataFrame, width: int = 13, small_bytes: int = BROADCAST_BYTES) -> Windows:
    """All windows of the benchmark. Items without words have none; an item of fewer than ``width`` words is one. The text of
    a window names it, as words hold no blanks. A null ``item_id`` counts as the id ``null``."""
    spark = items.sparkSession
    cut = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        word_array(F.col("text")).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    cut = cut.select("item_id", "words", F.explode(starts).alias("at"))
    cut = cut.select("item_id", F.slice("words", F.col("at") + 1, width).alias("words"))
    found = materialise(
        spark, cut.select("item_id", "words", F.concat_ws(" ", "words").alias("window")).distinct(), "item-windows"
    )
    windows = found.groupBy("window").agg(F.first("words").alias("window_words"))
    # Twice the text and 16 bytes a word are what a hashed row takes, about.
    size = found.agg(F.sum(3 * F.octet_length("window") + 24 * F.size("words"))).first()[0] or 0
    return Windows(windows, found.select("window", "item_id"), size <= small_bytes)


def _documents(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, words; rows equal in id and text are one document, as all that follows is grouped by the two."""
    text = F.col("text")
    return documents.select(
        "doc_id",
        F.xxhash64(text).alias("text_hash"),
        F.coalesce(word_array(text), F.array().cast("array<string>")).alias("words"),
    )


def rarest_words(documents: DataFrame, cut: Windows) -> DataFrame:
    """Each window with the word that all documents hold least often, and its place in the window."""
    spark = documents.sparkSession
    vocabulary = cut.windows.select(F.explode("window_words").alias("word")).distinct()
    vocabulary = F.broadcast(vocabulary) if cut.small else vocabulary
    counts = (
        _documents(documents)
        .select(F.explode("words").alias("word"))
        .join(vocabulary, "word", "left_semi")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = materialise(spark, counts, "word-counts")
    counts = F.broadcast(counts) if cut.small else counts
    placed = cut.windows.select("window", F.posexplode("window_words").alias("place", "word"))
    best = (
        placed.join(counts, "word", "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("best"))
    )
    return (
        cut.windows.join(best, "window")
        .where(F.col("best.n") > 0)
        .select(F.col("best.word").alias("word"), F.col("best.place").alias("place"), "window", "window_words")
    )


def _fits() -> Column:
    """Length and position: the window lies within the document."""
    return (F.col("start") >= 0) & (F.col("start") + F.size("window_words") <= F.size("words"))


def _equal() -> Column:
    return F.slice("words", F.col("start") + 1, F.size("window_words")) == F.col("window_words")


def occurrences(documents: DataFrame, cut: Windows) -> DataFrame:
    """doc_id, text_hash, n_words, start, length, window: one row for each place where a window
    occurs, and one with a null window for each document."""
    prefixes = materialise(documents.sparkSession, rarest_words(documents, cut), "prefixes")
    docs = _documents(documents)
    exploded = docs.select("*", F.posexplode_outer("words").alias("at", "word"))
    shown = ["doc_id", "text_hash", F.size("words").alias("n_words")]
    nothing = [F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("length"), F.lit(None).cast("string").alias("window")]
    if cut.small:
        # The words stay beside each probe only as a reference within one stage.
        hit = F.col("window").isNotNull() & _fits() & _equal()
        probed = exploded.join(F.broadcast(prefixes), "word", "left").withColumn("start", F.col("at") - F.col("place"))
        probed = probed.withColumn("hit", F.coalesce(hit, F.lit(False)))
        # The first word stands for the document, and may be a hit of several windows besides.
        kept = probed.where(F.col("hit") | (F.coalesce("at", F.lit(0)) == 0))
        return kept.select(
            *shown,
            F.when(F.col("hit"), F.col("start")).alias("start"),
            F.when(F.col("hit"), F.size("window_words")).alias("length"),
            F.when(F.col("hit"), F.col("window")).alias("window"),
        )
    places = (
        exploded.select("doc_id", "text_hash", "at", "word")
        .join(prefixes, "word")
        .select("doc_id", "text_hash", (F.col("at") - F.col("place")).alias("start"), "window", "window_words")
        .where(F.col("start") >= 0)
        .withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"})
        .distinct()
    )
    same = docs["doc_id"].eqNullSafe(places["own_id"]) & docs["text_hash"].eqNullSafe(places["own_hash"])
    checked = docs.join(places, same).where(_fits() & _equal())
    return checked.select(*shown, "start", F.size("window_words").alias("length"), "window").unionByName(
        docs.select(*shown, *nothing)
    )


def decontaminate(documents: DataFrame, items: DataFrame, width: int = 13, small_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, item_ids, contaminated.

    A word is hit that lies in any occurrence of a window; a document is contaminated from a
    twentieth of its words. Null, empty and wordless texts have no words and are clean; rows equal in id and text are one document;
    other columns of either table are not looked at. Two rows of one id with different texts are two documents."""
    cut = item_windows(items, width, small_bytes)
    found = materialise(documents.sparkSession, occurrences(documents, cut), "occurrences")
    keys = ["doc_id", "text_hash"]
    places = found.where("window is not null").select(*keys, "start", "length").distinct()
    end = F.col("start") + F.col("length")
    before = Window.partitionBy(*keys).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    fresh = F.greatest(end - F.greatest(F.col("start"), reached), F.lit(0))
    hits = places.select(*keys, fresh.alias("fresh")).groupBy(*keys).agg(F.sum("fresh").alias("n_hit"))
    of_items = (
        found.where("window is not null")
        .select(*keys, "window")
        .distinct()
        .join(F.broadcast(cut.items) if cut.small else cut.items, "window")
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    per_doc = found.groupBy(*keys).agg(F.max("n_words").cast("bigint").alias("n_words"))
    for part in (hits, of_items):
        part = part.withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"})
        same = per_doc["doc_id"].eqNullSafe(part["own_id"]) & per_doc["text_hash"].eqNullSafe(part["own_hash"])
        per_doc = per_doc.join(part, same, "left").drop("own_id", "own_hash")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return per_doc.select(
        *keys,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(item_ids).cast("bigint").alias("n_items"),
        item_ids.alias("item_ids"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
