"""Operator 2: benchmark decontamination as a prefix-filtered join, in SQL expressions only.

A window is ``width`` consecutive words of an item (a shorter item is one
window). Containment must be total, so the necessary prefix of a window is one
token: its rarest word, by the number of times each benchmark word stands in
all documents (ties by the word). A document word equal to a window's prefix
token fixes where the window would lie; the length bound (it must fit into the
document) and the positional bounds (its first and last word must be in place)
come before the exact comparison of all its words.

Texts are read where they lie: words are exploded in the scan's own stage,
joined to the prefix tokens, and only verified occurrences and one marker row a
document are shuffled. The prefix table is broadcast if its measured size is
below ``BROADCAST_BYTES``; a larger benchmark takes a shuffled join from
word positions to windows, with the same result.

Defined cases: NULL and empty texts have no words and are never contaminated;
NULL and empty items have no windows; an empty benchmark marks nothing; NULL
ids in ``items`` are left out; documents with equal ``doc_id`` and text are
judged once and returned as often as they come; texts of any length are read
whole; an empty table gives an empty table; other columns are ignored
(:func:`clean_documents` returns them as they are).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import BROADCAST_BYTES, ascii_lower, materialise, text_hash, without

# Fixed value: what separates words once A-Z are in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Marks the row that stands for a document itself; no word holds a space.
MARK = " "


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for NULL."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def windows(benchmark: DataFrame, width: int) -> DataFrame:
    """``item, words`` for each distinct window of each item."""
    own = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("all"))
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - (width - 1), F.lit(1))))
    return (own.where(F.size("all") > 0).withColumn("start", start)
            .select("item", F.expr(f"slice(all, start, {width})").alias("words")).distinct())


def rarity(words: DataFrame, vocabulary: DataFrame, small: bool) -> DataFrame:
    """``word, n``: how often each word of the vocabulary stands in all documents."""
    each = words.select(F.explode("words").alias("word"))
    if small:
        each = each.join(F.broadcast(vocabulary), "word", "left_semi")
        return each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(vocabulary, "word", "left_semi")


def prefixes(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``token, spots``: per prefix token, the distinct windows it stands for with its place in each."""
    ids = found.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    each = (ids.select("words", "items", F.posexplode("words").alias("at", "word")).join(counts, "word", "left")
            .withColumn("n", F.coalesce("n", F.lit(0))))
    rarest = F.min_by(F.struct("word", "at", "items"), F.struct("n", "word", "at"))
    return (each.groupBy("words").agg(rarest.alias("p"))
            .select(F.col("p.word").alias("token"), F.col("p.at").alias("at"), F.col("p.items").alias("items"),
                    F.col("words").alias("window"), F.size("words").alias("len"),
                    F.element_at("words", 1).alias("head"), F.element_at("words", -1).alias("tail")))


def occurrences(docs: DataFrame, benchmark: DataFrame, width: int = 13,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A marker row for each document (``items`` NULL) and a row for each verified occurrence of a window.

    Columns ``doc_id, text_hash, n_words, start, len, items``.
    """
    found = materialise(windows(benchmark, width), "windows")
    size = found.agg(F.sum(F.octet_length(F.concat_ws(" ", "words")) + F.octet_length(F.coalesce("item", F.lit(""))) + 64)).first()[0] or 0
    small = size <= broadcast_bytes
    vocabulary = found.select(F.explode("words").alias("word")).distinct()
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"),
                      words_of(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    tokens = prefixes(found, rarity(own, vocabulary, small))
    marker = tokens.sparkSession.range(1).select(
        F.lit(MARK).alias("token"), F.lit(0).alias("at"), F.lit(None).cast("array<string>").alias("items"),
        F.lit(None).cast("array<string>").alias("window"), F.lit(0).alias("len"), F.lit(None).cast("string").alias("head"),
        F.lit(None).cast("string").alias("tail"))
    tokens = materialise(tokens.unionByName(marker), "prefixes")
    place = F.col("pos") - F.col("at")  # zero-based start of the window in the document
    fits = (place >= 0) & (place + F.col("len") <= F.col("n_words"))
    mark = F.col("token") == MARK
    if small:
        each = own.select("doc_id", "text_hash", "n_words", "words",
                          F.posexplode(F.concat("words", F.array(F.lit(MARK)))).alias("pos", "word"))
        hit = each.join(F.broadcast(tokens), F.col("word") == F.col("token"))
        first = F.get("words", place)
        last = F.get("words", place + F.col("len") - 1)
        exact = F.slice("words", F.greatest(place, F.lit(0)) + 1, F.col("len")) == F.col("window")
        hit = hit.where(mark | (fits & (first == F.col("head")) & (last == F.col("tail")) & exact))
    else:
        each = own.select("doc_id", "text_hash", "n_words",
                          F.posexplode(F.concat("words", F.array(F.lit(MARK)))).alias("pos", "word"))
        near = each.join(tokens, F.col("word") == F.col("token")).where(mark | fits)
        marks = near.where(mark)
        asked = (near.where(~mark).withColumn("start", place).drop("pos", "word", "token", "at")
                 .select("*", F.posexplode("window").alias("i", "expected")))
        there = each.where(F.col("word") != MARK).distinct().select(
            F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("pos").alias("p"), F.col("word").alias("w"))
        fields = ["doc_id", "text_hash", "n_words", "start", "len", "items", "window"]
        whole = (asked.dropDuplicates([*fields, "i"])
                 .join(there, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
                       & (F.col("start") + F.col("i") == F.col("p")) & (F.col("expected") == F.col("w")))
                 .groupBy(*fields).agg(F.count(F.lit(1)).alias("same")).where("same = len"))
        return (marks.withColumn("start", F.lit(0)).select("doc_id", "text_hash", "n_words", "start", "len", "items")
                .unionByName(whole.select("doc_id", "text_hash", "n_words", "start", "len", "items")))
    return hit.select("doc_id", "text_hash", "n_words", F.when(mark, 0).otherwise(place).alias("start"), "len", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: words, hit words, items with occurring windows, verdict.

    Contaminated: some word is hit, and ``share`` times the hit words are at
    least all words. ``text_hash`` tells documents of one ``doc_id`` apart.
    """
    rows = occurrences(docs, benchmark, width, broadcast_bytes)
    # The words covered by a document's occurrences, from the starts of each length in order:
    # an occurrence adds what lies beyond the furthest end before it.
    spans = F.array_sort(F.collect_set(F.when(F.col("len") > 0, F.struct("start", F.col("len").alias("n")))))
    per = rows.groupBy("doc_id", "text_hash", "n_words").agg(
        F.sum((F.col("len") == 0).cast("long")).alias("copies"), spans.alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["upto"], x["start"] + x["n"]).alias("upto"),
            (s["n"] + F.greatest(x["start"] + x["n"] - F.greatest(s["upto"], x["start"]), F.lit(0))).alias("n")))["n"]
    per = per.withColumn("n_hit", covered.cast("long")).withColumn("items", F.array_sort("items"))
    # Copies (equal doc_id and text) were counted as often as they came.
    per = per.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    hits = F.filter("items", lambda i: i.isNotNull())
    return per.select(
        "doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), "n_hit", F.size(hits).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", hits), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20) -> DataFrame:
    """The documents that aren't contaminated, with all their columns."""
    return without(docs, contamination(docs, benchmark, width, share).where("contaminated"))
