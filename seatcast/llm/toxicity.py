"""Toxicity by noisy-channel deobfuscation.

1. A character trigram model is counted over every document.
2. Tokens that may be obfuscated (letters mixed with look-alikes, stretched
   letters, letters with blanks or marks between them) become lattices; Viterbi
   decoding under the character model restores the likeliest word
   (``chars.Restorer``).
3. Words and word beginnings of the restored text are counted in toxic and
   other labelled documents.  A feature's weight is the lower end of the 95 %
   Wilson interval of its share of toxic documents.
4. A document's score is the chance that one of its features is right; without
   any it is low, the lower the longer the text.

All labelled training rows and all features of enough weight are used.  What
reaches the driver is bounded: 64**3 trigram counts, and the features if they are
at most ``MAX_FEATURES``; more features stay a table, which is joined to the
documents' words.  Only texts are read for a score, never labels, ids, languages or
sources.

Defined cases: a null or empty text has no words and gets the lowest score;
repeated rows get equal rows; repeated labels of an id count once (the larger);
a null id is not held out; without labels every score is low; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chars
from .common import documents, materialize, small, text_slices

FOLDS = 5
MIN_SUPPORT = 4
# Features that are sent to the tasks at most.
MAX_FEATURES = 200_000
MIN_WEIGHT = 0.6
PREFIXES = (4, 5, 6, 7, 8)
Z = 1.96


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by the number of folds."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(code, n) over all texts; a task sends at most one row per code."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(chars.TRIGRAMS, "i8")
        for (texts,) in text_slices(batches, ["text"]):
            total += np.bincount(chars.codes("\n".join(texts)), minlength=chars.TRIGRAMS)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code.astype("i4")), pa.array(total[code])],
                                         names=["code", "n"])

    return (docs.select("text").mapInArrow(run, "code int, n long")
            .groupBy("code").agg(F.sum("n").alias("n")))


def features(word: str) -> list[str]:
    """The word as a whole, and its beginnings."""
    return ["=" + word, *(word[:k] for k in PREFIXES if len(word) > k)]


def _counts(labelled: DataFrame, model: np.ndarray, wanted: dict | None) -> DataFrame:
    """(feature, n): documents that have each feature, pre-aggregated by task;
    only ``wanted`` features if given."""
    key = zlib.crc32(model.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, counts = chars.restorer(key, model), Counter()

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["feature", "n"])
            counts.clear()
            return rows

        for (texts,) in text_slices(batches, ["text"]):
            for t in texts:
                own = {f for w in restorer.words(t) for f in features(w)}
                counts.update(own if wanted is None else own & wanted.keys())
            if len(counts) > 500_000:
                yield flush()
        yield flush()

    return (labelled.select("text").mapInArrow(run, "feature string, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")))


def wilson_low(hits: Column, total: Column) -> Column:
    """Lower end of the Wilson interval of a share."""
    p = hits / total
    mid = p + Z * Z / (2 * total)
    return (mid - Z * F.sqrt(p * (1 - p) / total + Z * Z / (4 * total * total))) / (
        1 + Z * Z / total)


def collected(df: DataFrame) -> dict | None:
    """``df`` of two columns as a dict; None if it has over ``MAX_FEATURES`` rows."""
    rows = df.limit(MAX_FEATURES + 1).collect()
    return dict(map(tuple, rows)) if len(rows) <= MAX_FEATURES else None


def learn(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, DataFrame]:
    """The character model over all documents, and (feature, weight) from the
    labelled rows outside the held-out fold."""
    counts = np.zeros(chars.TRIGRAMS, "i8")
    for code, n in trigram_counts(docs).collect():  # at most 64**3 rows
        counts[code] = n
    model = chars.log_model(counts)

    train = (labels.where("toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    # the labelled texts are written once, as they are read twice;
    # and copies of a text count once, or their rarest words would look toxic
    labelled = materialize(
        docs.join(small(train), "doc_id").withColumn("same", F.xxhash64("text"))
        .dropDuplicates(["same", "toxic"]).select("text", "toxic"), "labelled")
    toxic = materialize(_counts(labelled.where("toxic = 1"), model, None)
                        .where(F.col("n") >= MIN_SUPPORT), "toxic-features")
    # few enough features spare the tasks the counts of all others
    other = _counts(labelled.where("toxic <> 1"), model, collected(toxic))
    n = F.col("n").cast("double")
    total = n + F.coalesce("others", F.lit(0))
    weights = (toxic.join(other.withColumnRenamed("n", "others"), "feature", "left")
               .select("feature", wilson_low(n, total).alias("weight"))
               .where(F.col("weight") >= MIN_WEIGHT))
    return model, materialize(weights, "feature-weights")


def word_weight(word: str, weights: dict[str, float]) -> float:
    """The weight of the word's best feature; 0 without any."""
    return max((weights[f] for f in features(word) if f in weights), default=0.0)


def document_score(word_weights: Iterable[float], n_chars: int) -> float:
    """One less the chance that every word's best feature is wrong."""
    doubt = 1.0
    for w in word_weights:
        doubt *= 1 - w
    if doubt < 1.0:
        return 1 - doubt
    return 0.05 / (1 + n_chars / 10_000)


def score(docs: DataFrame, model: np.ndarray, weights: dict[str, float]) -> DataFrame:
    """(doc_id, score) of every row: a narrow map."""
    key = zlib.crc32(model.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, known = chars.restorer(key, model), {}
        for ids, texts in text_slices(batches, ["doc_id", "text"]):
            out = []
            for t in texts:
                words = restorer.words(t)
                for w in words:
                    if w not in known:
                        known[w] = word_weight(w, weights)
                # in the order of the words, so that the product is the same anywhere
                out.append(document_score([known[w] for w in sorted(
                    w for w in words if known[w])], len(t)))
                if len(known) > 500_000:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(out, pa.float64())],
                names=["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")


def score_by_joins(docs: DataFrame, model: np.ndarray, weights: DataFrame) -> DataFrame:
    """``score`` with a table of weights of any size: the distinct words of the
    documents meet it."""
    key = zlib.crc32(model.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = chars.restorer(key, model)
        for keys, texts in text_slices(batches, ["row_key", "text"]):
            found = [(k, w) for k, t in zip(keys, texts, strict=True) for w in restorer.words(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.int64()),
                 pa.array([w for _, w in found], pa.string())], names=["row_key", "word"])

    def own(word: Column) -> Column:
        return F.array(F.concat(F.lit("="), word), *(
            F.when(F.length(word) > k, F.substring(word, 1, k)) for k in PREFIXES))

    docs = docs.withColumn("row_key", F.xxhash64("text"))
    texts = docs.select("row_key", "text").dropDuplicates(["row_key"])
    words = materialize(texts.mapInArrow(run, "row_key long, word string"), "document-words")
    best = materialize(
        words.select("word").distinct()
        .select("word", F.explode(own(F.col("word"))).alias("feature"))
        .join(weights, "feature").groupBy("word").agg(F.max("weight").alias("weight")),
        "word-weights")
    # in the order of the words, as above; an entry is one known word of one text
    doubts = (words.join(best, "word").groupBy("row_key")
              .agg(F.array_sort(F.collect_list(F.struct("word", "weight"))).alias("known"))
              .select("row_key", F.aggregate("known", F.lit(1.0),
                                             lambda a, x: a * (1 - x["weight"])).alias("doubt")))
    low = 0.05 / (1 + F.length("text") / 10_000)
    return docs.join(doubts, "row_key", "left").select(
        "doc_id", F.when(F.col("doubt") < 1, 1 - F.col("doubt")).otherwise(low).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    docs = documents(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    model, weights = learn(docs, labels.select("doc_id", "toxic"))
    known = collected(weights)
    scored = (score_by_joins(docs, model, weights) if known is None
              else score(docs, model, known))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
