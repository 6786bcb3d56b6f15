"""Line dedup by log-template tree.

Lines are parsed by a tree of fixed depth: the first level is the number of
tokens, the next ones the leading tokens, with tokens that hold a digit taken
as variable.  Within a leaf, a token that enough documents have at a place is
constant there and any other is a variable field; the constants and the places
of the fields are the line's template.  Templates that recur across documents
are dropped from every document but the first that has them (smallest id, then
line).

Recurrence counts documents that differ: exact copies of a text count once, so
a group of copies does not make its own text a template.  Documents that differ
in anything, if only in a number or a short line, count one by one.

Leaves of any size are handled by grouped counts over (leaf, place, token),
pre-aggregated before the shuffle; no leaf is gathered anywhere.

Defined cases: lines of fewer than ``min_tokens`` tokens, blank ones too, always
stay; a null or empty text is one blank line; a row is known by a hash of its id
and text, so repeated rows get the same lines; null ids sort first; an empty
table gives no rows; extra columns are kept by ``drop_templates``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (documents, fresh, lookup, materialize, ship_package, text_slices,
                     without, tidy)

DEPTH = 3
MIN_DOCS = 5
MIN_TOKENS = 3
# Share of a line's tokens that must be constant for its template to count.
SIMILARITY = 0.5

LINES = "row_key long, doc_id long, line int, leaf long, exact long, doc_class long"


def masked_tokens(line: str) -> list[str]:
    """Tokens of a line; one that holds a digit becomes a variable field."""
    if re.search("[0-9]", line):
        line = re.sub(r"[^ \t\r\f\v]*[0-9][^ \t\r\f\v]*", "<*>", line)
    return line.split()


def parse(text: str, depth: int, min_tokens: int) -> list[tuple[int, list[str], int, int]]:
    """(line number, tokens, leaf, exact) of the lines that can recur."""
    import xxhash

    out = []
    for i, line in enumerate(text.split("\n")):
        tokens = masked_tokens(line)
        if len(tokens) >= min_tokens:
            path = "\0".join([str(len(tokens)), *tokens[:depth]])
            out.append((i, tokens, xxhash.xxh64_intdigest(path),
                        xxhash.xxh64_intdigest("\0".join(tokens))))
    return out


def document_class(text: str) -> int:
    """The same for exact copies of a text only."""
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, "u8").view("i8"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents(docs, id_col, text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.xxhash64(F.col("doc_id"), "text").alias("row_key"))


def _lines(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, texts in text_slices(batches, ["row_key", "doc_id", "text"]):
            cols: list[list] = [[] for _ in range(6)]
            for key, doc, text in zip(keys, ids, texts, strict=True):
                rows = parse(text, depth, min_tokens)
                own = document_class(text)
                for i, _, leaf, exact in rows:
                    for c, v in zip(cols, (key, doc, i, leaf, exact, own), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int32()), *map(_signed, cols[3:])],
                names=["row_key", "doc_id", "line", "leaf", "exact", "doc_class"])

    return docs.mapInArrow(tidy(run), LINES)


def _tokens(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """(leaf, exact, tokens) of the lines of ``docs``: token hashes in order."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for (texts,) in text_slices(batches, ["text"]):
            found = {r[3]: (r[1], r[2]) for t in texts for r in parse(t, depth, min_tokens)}
            ends = np.cumsum([0, *(len(words) for words, _ in found.values())])
            token = _signed([xxhash.xxh64_intdigest(w) for words, _ in found.values()
                             for w in words])
            yield pa.RecordBatch.from_arrays(
                [_signed([leaf for _, leaf in found.values()]), _signed(list(found)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), token)],
                names=["leaf", "exact", "tokens"])

    return docs.select("text").mapInArrow(tidy(run), "leaf long, exact long, tokens array<long>")


def _recurring(lines: DataFrame, key: str, min_docs: int) -> DataFrame:
    """The values of ``key`` that at least ``min_docs`` document classes have."""
    return (lines.select(key, "doc_class").distinct().groupBy(key)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select(key))


def templates(docs: DataFrame, lines: DataFrame, min_docs: int, depth: int,
              min_tokens: int) -> DataFrame:
    """(exact, template) of the lines whose template recurs."""
    plain = materialize(_recurring(lines, "exact", min_docs), "recurring-lines")
    leaves = materialize(_recurring(lines, "leaf", min_docs), "recurring-leaves")
    rest = materialize(lines.join(leaves, "leaf", "left_semi")
                       .join(plain, "exact", "left_anti"), "open-lines")

    sources = materialize(rest.select("row_key").distinct(), "open-rows")
    exacts = materialize(rest.select("exact").distinct(), "open-exacts")
    lists = lookup(_tokens(lookup(docs, sources, "row_key"), depth, min_tokens), exacts, "exact")
    tokens = materialize(lists.dropDuplicates(["exact"]), "open-tokens").select(
        "leaf", "exact", F.posexplode("tokens").alias("place", "token"))
    # a line's own classes count for each of its tokens
    classes = rest.select("exact", "doc_class").distinct()
    constant = (tokens.join(classes, "exact").select("leaf", "place", "token", "doc_class")
                .distinct().groupBy("leaf", "place", "token")
                .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
                .select("leaf", "place", "token", F.lit(True).alias("constant")))
    shape = F.xxhash64("place", F.when(F.col("constant"), F.col("token")))
    general = (tokens.join(constant, ["leaf", "place", "token"], "left")
               .groupBy("leaf", "exact")
               .agg(F.sum(shape.cast("decimal(38,0)")).alias("shape"),
                    F.count("constant").alias("fixed"), F.count(F.lit(1)).alias("size"))
               .where(F.col("fixed") >= SIMILARITY * F.col("size"))
               .select("exact", F.xxhash64("leaf", "shape").alias("template")))
    general = materialize(general, "templates")
    again = _recurring(rest.join(general, "exact"), "template", min_docs)
    return plain.select("exact", F.col("exact").alias("template")).unionByName(
        general.join(again, "template", "left_semi"))


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH,
                   min_tokens: int = MIN_TOKENS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(row_key, dropped): the numbers of the lines to drop, per row that has
    any."""
    docs = _keyed(docs, id_col, text_col)
    lines = materialize(_lines(docs, depth, min_tokens), "lines")
    known = materialize(templates(docs, lines, min_docs, depth, min_tokens), "line-templates")
    hits = materialize(lines.join(known, "exact")
                       .select("row_key", "doc_id", "line", "template"), "template-lines")
    first = hits.groupBy("template").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    place = F.struct("doc_id", "line")
    return (hits.join(first, "template").where(~place.eqNullSafe(F.col("first")))
            .groupBy("row_key").agg(F.collect_set("line").alias("dropped")))


def _without_lines(rows: DataFrame, text_col: str, gone: str) -> DataFrame:
    """``rows`` with the line numbers in ``gone`` taken out of their text."""
    schema = rows.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = schema.names.index(text_col)
            done = 0
            for texts, dropped in text_slices([batch], [text_col, gone], text=text_col):
                left = []
                for text, numbers in zip(texts, dropped, strict=True):
                    numbers = set(numbers)
                    left.append("\n".join(line for i, line in enumerate(text.split("\n"))
                                          if i not in numbers))
                part = batch.slice(done, len(texts))
                done += len(texts)
                yield part.set_column(at, text_col, pa.array(left, pa.string()))

    return rows.mapInArrow(tidy(run), schema)


def drop_templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **how) -> DataFrame:
    """``docs`` with all its columns and the recurring lines taken out of the
    text, plus n_lines and n_dropped (replacing columns of that name).  Only rows
    that lose lines meet their numbers in a shuffle; the rest pass by."""
    ship_package(docs.sparkSession)
    drops = materialize(repeated_lines(docs, id_col=id_col, text_col=text_col, **how), "drops")
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    key, gone = fresh(docs, "row_key"), fresh(docs, "dropped")
    lines, lost = fresh(docs, "lines_before"), fresh(docs, "lines_lost")
    keyed = docs.select(*names, F.xxhash64(F.col(id_col).cast("long"), text).alias(key),
                        F.size(F.split(text, "\n")).cast("long").alias(lines))
    drops = drops.select(F.col("row_key").alias(key), F.col("dropped").alias(gone))
    ids = drops.select(key)
    # a merge join at every size, so that a small table shows the shuffle of a large one
    cut = lookup(keyed, ids, key).join(drops.hint("merge"), key)
    cut = cut.withColumn(lost, F.size(gone).cast("long"))
    cut = _without_lines(cut.select(*names, lines, lost, gone), text_col, gone)
    whole = without(keyed, ids, key).withColumn(lost, F.lit(0).cast("long"))
    both = cut.select(*names, lines, lost).unionByName(whole.select(*names, lines, lost))
    return both.select(*names, F.col(lines).alias("n_lines"), F.col(lost).alias("n_dropped"))
