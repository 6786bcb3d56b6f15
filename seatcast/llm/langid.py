"""Language of web pages by Bayesian evidence fusion.

The evidence of a page:

* its visible text, under one character trigram model per language; the models
  are counted over all labelled documents, every language that has a letter of text.
  Trigrams are of letters of any script, hashed to ``CELLS`` cells;
* the language its markup declares;
* the suffix of its address;
* its host.

How declarations and suffixes go with languages, and which languages a host
serves, is estimated from the pages themselves: the text-only posteriors are
summed by grouped aggregation.  Host priors are smoothed hierarchically: a host
leans on its domain, the domain on all pages; a page's own share is taken out
of every sum it is judged by.  The posterior adds the logs of all parts.

Grouped sums are pre-aggregated before the shuffle and are sums of whole
millionths, so their order does not matter.  A host with very many pages is a
skewed join key, which adaptive execution splits; small tables of sums are
broadcast after their rows are counted, against a bound in bytes.  The counts
are a table; driver and tasks hold the models of ``BLOCK`` languages at a time,
and pages pass once for each such block.  Pages are parsed in one pass.

Defined cases: a null or empty page has no text evidence and goes by the rest;
a null or odd address has empty host and suffix; repeated rows each get their
result; null ids stay; without labelled documents that have a letter the language is null and the
confidence 0; markup that is not closed hides nothing; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize, ship_package, small, text_slices, unescape

# Languages whose models (4 bytes a cell) a task holds at a time, and whose counts
# the driver fetches at a time.
BLOCK, FETCH = 48, 8
# Trigrams of a page that are looked up at a time.
STEP = 1 << 16
# Cells of the trigram counts.
CELLS = 1 << 18
# Trigrams' worth of the average of all languages in a model.
SMOOTHING = 1000.0
# Trigrams are not independent: they count as this many pieces of evidence at
# most, and one in ``TEMPER`` below that.
MAX_EVIDENCE, TEMPER = 60.0, 4.0
# Pseudo-pages that a declared language, a suffix, a host and a domain bring.
TABLE_SMOOTHING, HOST_SMOOTHING = 1.0, 3.0
MICRO = 1_000_000

_MARK = re.compile(r"<(?:(!--)|(script|style|noscript|template|nav)\b)?", re.I)
_HTML = re.compile(r"<html\b[^>]*", re.I)
_DECLARED = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)
_HOST = re.compile(r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


@functools.cache
def _closing(kind: str) -> re.Pattern:
    return re.compile({"!--": "-->", "": ">"}.get(kind, rf"</{kind}\s*>"), re.I)


def visible_text(page: str) -> str:
    """Text outside tags, comments, scripts, styles and navigation.  What has no end
    is looked for once a page: an element without one is a tag, a tag without one text."""
    out, at, endless = [], 0, set()
    while mark := _MARK.search(page, at):
        out.append(page[at:mark.start()])
        for kind in ((mark[1] or mark[2] or "").lower(), ""):
            if kind not in endless:
                if end := _closing(kind).search(page, mark.end()):
                    out.append(" ")
                    at = end.end()
                    break
                endless.add(kind)
        else:
            out.append(mark[0])
            at = mark.end()
    return unescape("".join(out) + page[at:])


def declared_language(page: str) -> str:
    for tag in _HTML.finditer(page):
        if m := _DECLARED.search(tag[0]):
            return m[1].lower()
    return ""


def address_parts(url: str) -> tuple[str, str, str]:
    """(host, domain, suffix): the domain is the host without its first label
    if two or more remain."""
    m = _HOST.match(url)
    host = m[1].lower().strip(".") if m else ""
    labels = host.split(".") if host else []
    domain = ".".join(labels[1:]) if len(labels) > 2 else host
    return host, domain, labels[-1] if len(labels) > 1 else ""


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter or a mark."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(sys.maxunicode + 1)])


def trigrams(text: str) -> np.ndarray:
    """Cells of the trigrams of a text, lower-cased; all but letters is one
    symbol, runs of it count once, and the text is framed by it."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    s = np.where(_letters()[points], points, 0).astype("u8")
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] > 0) | (s[:-1] > 0)
    s = s[keep]
    x = ((s[:-2] << np.uint64(42)) | (s[1:-1] << np.uint64(21)) | s[2:]) + np.uint64(1)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(46)).astype("i8")


def shares(counts: np.ndarray) -> np.ndarray:
    """The sum over languages of each cell's share of the language's trigrams."""
    return sum((c / max(c.sum(), 1) for c in counts), np.zeros(CELLS))


def log_models(counts: np.ndarray, average: np.ndarray) -> np.ndarray:
    """Log probability of each cell in each language, leaning on the average of
    all languages; a cell that no language has says nothing."""
    base = SMOOTHING * (0.9 * average + 0.1 / CELLS)
    return np.stack([np.where(average > 0, np.log((c + base) / (c.sum() + SMOOTHING)), 0)
                     .astype("f4") for c in counts])


def language_counts(docs: DataFrame) -> DataFrame:
    """(lang, code, n): trigrams of the documents of each language.  A task holds
    the counts of about ``BLOCK`` languages and sends them on when there are more."""
    def rows(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in total.items():
            code = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(code), pa.string()), pa.array(code.astype("i4")),
                 pa.array(n[code])], names=["lang", "code", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for langs, texts in text_slices(batches, ["lang", "text"]):
            groups: dict[str, list[str]] = {}
            for lang, t in zip(langs, texts, strict=True):
                groups.setdefault(lang, []).append(t)
            for lang, own in groups.items():
                if lang not in total:
                    if len(total) >= BLOCK:
                        yield from rows(total)
                        total = {}
                    total[lang] = np.zeros(CELLS, "i8")
                total[lang] += np.bincount(np.concatenate([trigrams(t) for t in own]),
                                           minlength=CELLS)
        yield from rows(total)

    return (docs.mapInArrow(run, "lang string, code int, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))


def language_models(docs: DataFrame, lang_col: str = "lang",
                    text_col: str = "text") -> tuple[list[str], Iterator[np.ndarray]]:
    """Languages of labelled documents in order, and their log models (languages x
    CELLS) in blocks.  The driver holds the names, one block and one vector."""
    rows = docs.select(F.lower(F.trim(F.col(lang_col))).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = materialize(language_counts(rows.where("lang <> ''")), "language-counts")
    langs = sorted(r["lang"] for r in table.select("lang").distinct().collect())

    def counts(block: list[str]) -> np.ndarray:
        out = np.zeros((len(block), CELLS), "i8")
        for k in range(0, len(block), FETCH):
            names = F.array(*map(F.lit, block[k:k + FETCH]))
            part = table.select((F.array_position(names, F.col("lang")) - 1).cast("int").alias("i"),
                                "code", "n").where("i >= 0").toPandas()
            out[k + part["i"].to_numpy(), part["code"].to_numpy()] = part["n"].to_numpy()
        return out

    blocks = [langs[k:k + BLOCK] for k in range(0, len(langs), BLOCK)]

    def models() -> Iterator[np.ndarray]:
        if len(blocks) == 1:
            one = counts(langs)
            yield log_models(one, shares(one) / len(langs))
            return
        average = sum(shares(counts(block)) for block in blocks) / len(langs)
        for block in blocks:
            yield log_models(counts(block), average)

    return langs, models()


PARSED = "page_id long, host string, domain string, suffix string, declared string, cells binary"
EVIDENCE = PARSED + ", log array<double>"


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: address parts, declared language and the cells of its text."""
    for ids, urls, pages in text_slices(batches, ["page_id", "url", "html"], "html"):
        rows = [(i, *address_parts(url), declared_language(page),
                 trigrams(visible_text(page)).astype("<u4").tobytes())
                for i, url, page in zip(ids, urls, pages, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                pa.int64(), *[pa.string()] * 4, pa.binary()), strict=True)],
            names=[f.split()[0] for f in PARSED.split(", ")])


def _evidence(pages: DataFrame, blocks: Iterator[np.ndarray]) -> DataFrame:
    """Per page: address parts, declared language, tempered log likelihoods and
    the text-only posterior in millionths."""
    names = [f.split()[0] for f in EVIDENCE.split(", ")]

    def judge(models: np.ndarray, first: bool):
        def log(cells: np.ndarray) -> list[float]:
            parts = [models[:, cells[k:k + STEP]].sum(axis=1, dtype="f8")
                     for k in range(0, len(cells), STEP)]
            return sum(parts, np.zeros(len(models))).tolist()

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parse(batches) if first else batches:
                logs = [log(np.frombuffer(c, "<u4")) for c in batch.column("cells").to_pylist()]
                if not first:
                    logs = [a + b for a, b in zip(batch.column("log").to_pylist(), logs,
                                                  strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n) for n in names[:-1]],
                     pa.array(logs, pa.list_(pa.float64()))], names=names)
        return run

    seen = None
    for models in blocks:
        if seen is None:
            seen = pages.mapInArrow(judge(models, True), EVIDENCE)
        else:
            seen = materialize(seen, "page-cells").mapInArrow(judge(models, False), EVIDENCE)
    n = F.greatest(F.octet_length("cells") / 4, F.lit(1.0))
    weight = F.least(n / TEMPER, F.lit(MAX_EVIDENCE)) / n
    top, mass = F.array_max("log"), F.aggregate("odds", F.lit(0.0), lambda a, x: a + x)
    return (seen.withColumn("weight", weight).withColumn("top", top)
            .withColumn("text_log", F.transform("log", lambda x: (x - F.col("top"))
                                                * F.col("weight")))
            .withColumn("odds", F.transform("text_log", F.exp)).withColumn("mass", mass)
            .select("page_id", "host", "domain", "suffix", "declared", "text_log",
                    F.transform("odds", lambda x: F.round(x / F.col("mass") * MICRO)
                                .cast("long")).alias("share")))


def _sums(pages: DataFrame, key: str, n: int) -> DataFrame:
    """(key, key_sum): the pages' summed shares per language."""
    parts = [F.sum(F.col("share")[k]).alias(f"s{k}") for k in range(n)]
    return (pages.groupBy(key).agg(*parts)
            .select(key, F.array(*[f"s{k}" for k in range(n)]).alias(f"{key}_sum")))


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, lang, confidence, text_lang (by the text
    alone), declared, suffix, host."""
    ship_package(pages.sparkSession)
    langs, blocks = language_models(docs)
    empty = F.lit("")
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"),
                         F.coalesce(F.col(url_col), empty).alias("url"),
                         F.coalesce(F.col(html_col), empty).alias("html"))
    if not langs:
        none = F.lit(None).cast("string")
        return pages.select("page_id", none.alias("lang"), F.lit(0.0).alias("confidence"),
                            none.alias("text_lang"), none.alias("declared"),
                            none.alias("suffix"), none.alias("host"))
    n = len(langs)
    seen = materialize(_evidence(pages, blocks), "page-evidence")
    total = list(seen.agg(*[F.coalesce(F.sum(F.col("share")[k]), F.lit(0)) for k in range(n)])
                 .first())
    whole = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    joined = seen.withColumn("own", whole("share"))
    keys = ("declared", "suffix", "domain", "host")
    for key in keys:
        sums = materialize(_sums(seen, key, n), f"{key}-sums")
        # an array of n longs a row, so that all four tables stay below 256 MB
        joined = (joined.join(small(sums, min(BROADCAST_ROWS, (64 << 20) // (8 * n + 64))), key)
                  .withColumn(f"{key}_rest", whole(f"{key}_sum") - F.col("own")))
    totals = F.array(*map(F.lit, total))
    joined = joined.withColumn("by_lang", F.arrays_zip(
        F.col("text_log"), F.col("share"), totals.alias("total"),
        *[F.col(f"{key}_sum") for key in keys]))

    def log_ratio(key: str, x):
        """log P(value | language), the page's own share left out, smoothed
        towards the value's share of all pages."""
        everything = F.greatest(F.lit(sum(total) - MICRO), F.lit(MICRO))
        base = ((F.col(f"{key}_rest") + TABLE_SMOOTHING * MICRO)
                / (everything + TABLE_SMOOTHING * MICRO))
        return F.log((x[f"{key}_sum"] - x["share"] + TABLE_SMOOTHING * MICRO * base)
                     / (x["total"] - x["share"] + TABLE_SMOOTHING * MICRO))

    def prior(x):
        """The host's share of a language, leaning on domain and all pages."""
        def lean(key: str, parent):
            return ((x[f"{key}_sum"] - x["share"] + HOST_SMOOTHING * MICRO * parent)
                    / (F.col(f"{key}_rest") + HOST_SMOOTHING * MICRO))

        everything = (x["total"] - x["share"] + MICRO) / F.lit(
            float(sum(total) - MICRO + n * MICRO))
        return lean("host", lean("domain", everything))

    scores = F.transform("by_lang", lambda x: x["text_log"] + log_ratio("declared", x)
                         + log_ratio("suffix", x) + F.log(prior(x)))
    top = F.array_max("scores")
    chance = 1 / F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    names = F.array(*map(F.lit, langs))
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return joined.withColumn("scores", scores).select(
        "page_id", best(F.col("scores")).alias("lang"),
        F.round(chance, 6).alias("confidence"), best(F.col("share")).alias("text_lang"),
        "declared", "suffix", "host")
