"""Benchmark decontamination: a prefix-filtered containment join.

A window is ``size`` consecutive words of an item (a shorter item is one
window).  A document holds a window if it holds all its words in order, so a
window's set of word shingles must be contained whole: with the shingles ordered
by rarity, the prefix that has to be joined is the single rarest one.

1. One pass finds where documents have a shingle (three words; two or one where
   an item has no more) of any window, and counts them.  A window with a shingle
   that no document has cannot occur and goes.
2. Those places are joined with the rarest shingle of each window.
3. The shingle's place in the window gives the window's place in the document;
   positions outside the document (length and positional bounds) go.
4. What is left is verified word by word on the text.

Only built-in functions run.  Shingles are exploded as hashes, without their
text, and meet only the small set that windows have; that set is broadcast when
its counted size allows, otherwise both sides are shuffled.  Texts are read again only for
documents with candidates.

A-Z are lower-cased, other letters stay; the joins use a full lower-casing,
which is coarser, and verification is exact.

Defined cases: a null or empty text has no words and is clean; a row is known by
a hash of its id and text, so repeated rows and null ids are each reported; an
item without words has no window; a null item id marks words as hit but is not
listed; an empty table gives no rows (documents) or nothing hit (benchmark);
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, documents, fresh, lookup, materialize, without

WINDOW = 13
SHINGLE = 3
MIN_PERCENT = 5
# Runs of these bytes separate words: ASCII other than digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text in order, as they stand."""
    return F.array_remove(F.split(text, SEPARATORS), "")


def item_windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """(window, length, items): each distinct window as blank-joined words, with
    the ids of the items that hold it."""
    own = items.select(F.col(id_col).alias("item_id"),
                       words(ascii_lower(F.coalesce(F.col(text_col), F.lit("")))).alias("w"))
    cut = F.when(F.size("w") < size, F.array("w")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))),
                    lambda i: F.slice("w", i, size)))
    return (own.where(F.size("w") > 0).select("item_id", F.explode(cut).alias("w"))
            .groupBy(F.array_join("w", " ").alias("window"))
            .agg(F.collect_set("item_id").alias("items"))
            .withColumn("length", F.size(F.split("window", " "))))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("row_key", F.xxhash64("doc_id", "text"))


def _shingles(w: Column, size: Column) -> Column:
    """Hashes of the shingles of ``size`` words that begin at each word; the
    last ones are shorter and are no window's, or fail the verification."""
    return F.transform(w, lambda x, i: F.xxhash64(
        size, x, F.when(size > 1, F.get(w, i + 1)), F.when(size > 2, F.get(w, i + 2))))


def _document_shingles(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(row_key, n, at, shingle) of every text, for each size."""
    own = docs.select("row_key", words(F.lower("text")).alias("w"))
    parts = [own.select("row_key", F.size("w").alias("n"),
                        F.posexplode(_shingles(F.col("w"), F.lit(k))).alias("at", "shingle"))
             for k in sizes]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _window_shingles(windows: DataFrame) -> DataFrame:
    """(window, place, shingle) of every window."""
    w, k = F.split(F.lower("window"), " "), F.least("length", F.lit(SHINGLE))
    parts = windows.select("window", k.alias("k"), "length",
                           F.posexplode(_shingles(w, k)).alias("place", "shingle"))
    return parts.where(F.col("place") + F.col("k") <= F.col("length")).select(
        "window", "place", "shingle")


def _prefixes(windows: DataFrame, parts: DataFrame, seen: DataFrame) -> DataFrame:
    """The windows that can occur, with their rarest shingle and its place."""
    counts = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    rarest = parts.join(counts, "shingle", "left").groupBy("window").agg(
        F.count("n").alias("known"), F.count(F.lit(1)).alias("all"),
        F.min_by(F.struct("shingle", "place"), F.struct("n", "place")).alias("rare"))
    return (rarest.where(F.col("known") == F.col("all"))
            .select("window", "rare.shingle", "rare.place").join(windows, "window"))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW,
                  min_percent: int = MIN_PERCENT, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, row_key, n_words, n_hit (words inside an
    occurrence of a window), n_items, items_sha256 and contaminated (n_hit is
    at least ``min_percent`` percent of the words)."""
    docs = _keyed(documents(docs, id_col, text_col))
    windows = materialize(item_windows(items, size), "windows")
    sizes = sorted(r[0] for r in windows.select(
        F.least("length", F.lit(SHINGLE))).distinct().collect()) or [SHINGLE]
    parts = materialize(_window_shingles(windows), "window-shingles")
    vocabulary = materialize(parts.select("shingle").distinct(), "vocabulary")
    seen = materialize(lookup(_document_shingles(docs, sizes), vocabulary, "shingle"),
                       "shingle-places")
    prefix = materialize(_prefixes(windows, parts, seen), "prefixes")

    start = F.col("at") - F.col("place")
    found = materialize(
        seen.join(prefix, "shingle").withColumn("start", start)
        .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n")))
        .groupBy("row_key")
        .agg(F.collect_set(F.struct("start", "length", "window", "items")).alias("found")),
        "candidates")

    text = lookup(docs.select("row_key", "text"), found.select("row_key"), "row_key")
    exact = F.filter("found", lambda c: ascii_lower(
        F.array_join(F.slice("w", c["start"] + 1, c["length"]), " ")) == c["window"])
    covered = F.array_distinct(F.flatten(F.transform(
        "found", lambda c: F.sequence(c["start"], c["start"] + c["length"] - 1))))
    listed = F.filter(F.array_distinct(F.flatten(F.transform("found", lambda c: c["items"]))),
                      lambda i: i.isNotNull())
    hit = (text.dropDuplicates(["row_key"]).join(found, "row_key")
           .withColumn("w", words(F.col("text"))).withColumn("found", exact)
           .where(F.size("found") > 0)
           .select("row_key", F.size(covered).cast("long").alias("n_hit"),
                   listed.alias("items")))

    n_words = F.size(words(F.col("text"))).cast("long")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce(F.array_join(F.array_sort(F.transform(
        "items", lambda i: i.cast("string"))), ","), F.lit(""))
    return (docs.select("doc_id", "row_key", n_words.alias("n_words"))
            .join(hit, "row_key", "left")
            .select("doc_id", "row_key", "n_words", n_hit.alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(ids, 256).alias("items_sha256"),
                    ((n_hit > 0) & (100 * n_hit >= min_percent * F.col("n_words")))
                    .alias("contaminated")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = materialize(contamination(docs, items, id_col=id_col, text_col=text_col)
                      .where("contaminated").select("row_key").distinct(), "contaminated")
    key = F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    name = fresh(docs, "row_key")
    return without(docs.withColumn(name, key), bad.withColumnRenamed("row_key", name),
                   name).drop(name)
