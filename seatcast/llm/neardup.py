"""Near-duplicate documents by HyperMinHash.

1. Each text becomes its set of five-word shingles (64-bit hashes) and a sketch
   of 128 registers: leading zeros plus ten mantissa bits of each bucket's
   minimum, 256 bytes.
2. Equal sets are one class, represented by its smallest id, so exact copies
   cost one row each from here on.
3. The compressed registers are banded, four at a time.  At the threshold of
   0.85 two sets share none of the 32 bands with a chance of about 6e-11.
4. In each band key, every member is compared with one centre: the member that
   shares the most band keys with others.  A group of n near copies gives n
   pairs, not n * n.
5. The collision-corrected Jaccard estimate drops hopeless pairs; the rest are
   verified on the full sets, read again from the texts.
6. Connected components.  Keys whose members still lie in different components
   are opened: in small keys, pairs of different components with promising
   registers are verified like the centre's.  Of large keys, a member stays only
   if members of other components hold enough of its shingles, all together, for
   a link: one pass over the shingles, which no link can fail.  What is left of a
   large key is cut into blocks of bounded size, and every two blocks meet with
   their full sets: products of 0/1 matrices give all intersections, and only the
   links that join components leave the block.  So a link that the centres do not
   see is found as well.

Linked means 100 * intersection >= 85 * union.  Documents without words are
linked with nothing.

Defined cases: a null or empty text has no shingles and is its own component;
repeated rows (same id and text) are one document and each row is reported; a
null id is never linked: its component is null and it is kept; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import documents, lookup, materialize, text_slices, tidy
from .graph import components

PERCENT = 85
# Keys of more members are compared on full sets, block by block.
SMALL_KEY = 16
# Members of a block, and bytes of shingle hashes, at most (a single set may be
# larger).
BLOCK = 512
BLOCK_BYTES = 16 << 20

SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, sig binary"


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sig): set_a and set_b are two
    order-free hashes of the whole set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_slices(batches, ["doc_id", "text"]):
            n, a, b, sig = [], [], [], []
            for t in texts:
                h = shingles.shingle_set(t)
                n.append(len(h))
                a.append(shingles.mix(h).sum(dtype="u8"))
                b.append(np.bitwise_xor.reduce(shingles.mix(~h), initial=np.uint64(0)))
                sig.append(shingles.registers(h).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(np.array(a, "u8").view("i8")), pa.array(np.array(b, "u8").view("i8")),
                 pa.array(sig, pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       "text").mapInArrow(tidy(run), SKETCH)


def _band_rows(reps: DataFrame) -> DataFrame:
    """(key, rep): one row per band that is not empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                if not part.num_rows:
                    continue
                keys = [shingles.band_keys(np.frombuffer(s.as_py(), "u2"))
                        for s in part.column("sig")]
                reps = np.repeat(part.column("rep").to_numpy(), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view("i8")), pa.array(reps)],
                    names=["key", "rep"])

    return reps.select("rep", "sig").mapInArrow(tidy(run), "key long, rep long")


def _promising(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose corrected estimate may reach the threshold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "u2")
                    .reshape(-1, shingles.BUCKETS) for c in ("sig_a", "sig_b"))
            used = ((x != shingles.EMPTY) | (y != shingles.EMPTY)).sum(axis=1)
            equal = ((x == y) & (x != shingles.EMPTY)).sum(axis=1)
            n_a, n_b = (batch.column(c).to_numpy().astype("f8") for c in ("n_a", "n_b"))
            good = shingles.may_reach(equal, used, n_a, n_b, percent / 100)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    side = [reps.select(F.col("rep").alias(c), F.col("n_shingles").alias(f"n_{c}"),
                        F.col("sig").alias(f"sig_{c}")) for c in ("a", "b")]
    return pairs.join(side[0], "a").join(side[1], "b").select(
        "a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(tidy(run), "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar on their full shingle sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # centres come again and again
        for a, b, ta, tb in text_slices(batches, ["a", "b", "text_a", "text_b"], "text_a"):
            good = []
            for i in range(len(a)):
                if b[i] not in held:
                    if len(held) >= 64:
                        held.clear()
                    held[b[i]] = shingles.shingle_set(tb[i])
                good.append(shingles.similar(shingles.shingle_set(ta[i]), held[b[i]], percent))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, g in zip(c, good, strict=True) if g], pa.int64())
                 for c in (a, b)], names=["a", "b"])

    ids = materialize(pairs.select("a").union(pairs.select("b")).distinct()
                      .withColumnRenamed("a", "doc_id"), "linked-ids")
    texts = materialize(lookup(docs, ids, "doc_id").dropDuplicates(["doc_id"]), "linked-texts")
    side = [texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
            for c in ("a", "b")]
    return (pairs.join(side[0], "a").join(side[1], "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(tidy(run), "a long, b long"))


def _small_keys(members: DataFrame, percent: int) -> DataFrame:
    """Promising pairs (a, b) with different labels within keys of at most
    ``SMALL_KEY`` members (key, rep, label, n_shingles, sig).  Keys are dealt over
    groups of a few thousand rows."""
    rows = members.count()
    dealt = members.withColumn("grp", F.pmod(F.xxhash64("key"), F.lit(max(1, -(-rows // 4096)))))

    def run(table):
        table = table.sort_by("key")
        key, rep, label, n = (table.column(c).to_numpy() for c in
                              ("key", "rep", "label", "n_shingles"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "u2").reshape(
            -1, shingles.BUCKETS)
        # pairs at every distance within a key
        first, second = [np.zeros(0, "i8")], [np.zeros(0, "i8")]
        for step in range(1, len(key)):
            i = np.flatnonzero(key[:-step] == key[step:])
            if not len(i):
                break
            i = i[label[i] != label[i + step]]
            first.append(i)
            second.append(i + step)
        i, j = np.concatenate(first), np.concatenate(second)
        x, y = sig[i], sig[j]
        used = ((x != shingles.EMPTY) | (y != shingles.EMPTY)).sum(axis=1)
        equal = ((x == y) & (x != shingles.EMPTY)).sum(axis=1)
        good = shingles.may_reach(equal, used, n[i].astype("f8"), n[j].astype("f8"),
                                  percent / 100)
        a, b = rep[i[good]], rep[j[good]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return dealt.groupBy("grp").applyInArrow(run, "a long, b long").distinct()


def _forest(i: np.ndarray, j: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[int]:
    """Positions of links (i, j) between labels (x, y) that form a forest."""
    parent: dict[int, int] = {}

    def find(v):
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v

    keep = []
    pairs = np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1)
    _, first = np.unique(pairs, axis=0, return_index=True)
    for k in first.tolist():
        a, b = find(int(x[k])), find(int(y[k]))
        if a != b:
            parent[a] = b
            keep.append(k)
    return keep


def _meetings(members: DataFrame) -> DataFrame:
    """(grp, few, rep, label): which members (key, rep, label, n_shingles) of large keys
    meet.  Members of a key's most frequent label need not meet each other, so
    only blocks of its other members (``few``) meet all blocks: with m of these among n,
    some 2 * m * n / BLOCK rows, and n for a few strangers among near copies."""
    by_label = members.groupBy("key", "label").agg(
        (8 * F.sum("n_shingles")).alias("bytes"), F.count(F.lit(1)).alias("n"))
    most = lambda c: F.max_by(c, F.struct("n", "label"))
    blocks = lambda n, b: F.ceil(F.greatest(n / BLOCK, b / BLOCK_BYTES)).cast("int")
    n, size = F.sum("n"), F.sum("bytes")
    keys = by_label.groupBy("key").agg(
        most("label").alias("most"), blocks(n, size).alias("blocks"),
        blocks(n - F.max("n"), size - most("bytes")).alias("few_blocks"))
    deal = lambda salt, among: F.pmod(F.xxhash64("rep", F.lit(salt)), among).cast("int")
    upto = lambda among: F.sequence(F.lit(0), among - 1)
    own, few_own = deal(0, F.col("blocks")), deal(1, F.col("few_blocks"))
    among_all = F.transform(upto(F.col("few_blocks")), lambda k: F.struct(
        F.lit(False).alias("few"), k.alias("few_block"), own.alias("block")))
    among_few = F.transform(upto(F.col("blocks")), lambda k: F.struct(
        F.lit(True).alias("few"), few_own.alias("few_block"), k.alias("block")))
    places = F.when(F.col("label") == F.col("most"), among_all).otherwise(
        F.concat(among_few, among_all))
    return (members.join(keys, "key").withColumn("p", F.explode(places))
            .select(F.xxhash64("key", "p.few_block", "p.block").alias("grp"),
                    F.col("p.few").alias("few"), "rep", "label"))


def _backed(members: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The reps of members (rep, label, n_shingles) that may have a link to another
    label, by their full sets (rep, hashes).  Linked sets share ``percent`` of a hundred
    shingles of each, so members of other labels hold that many, all together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n = pc.binary_length(part.column("hashes")).to_numpy() // 8
                raw = b"".join(part.column("hashes").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(raw, "i8")),
                     *(pa.array(np.repeat(part.column(c).to_numpy(), n))
                       for c in ("rep", "label", "n_shingles"))],
                    names=["hash", "rep", "label", "n_shingles"])

    held = full.join(members.select("rep", "label", "n_shingles").distinct(), "rep").select(
        "rep", "label", "n_shingles", "hashes").mapInArrow(
            tidy(run), "hash long, rep long, label long, n_shingles long")
    several = held.groupBy("hash").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return (held.join(several.where("lo <> hi").select("hash"), "hash", "left_semi")
            .groupBy("rep", "n_shingles").agg(F.count(F.lit(1)).alias("n"))
            .where(100 * F.col("n") >= percent * F.col("n_shingles")).select("rep"))


def _large_keys(members: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between labels within large keys (key, rep, label,
    n_shingles, n), on full sets; from each two blocks at most a forest."""
    ids = materialize(members.select(F.col("rep").alias("doc_id")).distinct(), "open-ids")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_slices(batches, ["doc_id", "text"]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()),
                 pa.array([shingles.shingle_set(t).tobytes() for t in texts], pa.binary())],
                names=["rep", "hashes"])

    full = materialize(lookup(docs, ids, "doc_id").dropDuplicates(["doc_id"])
                       .select("doc_id", "text").mapInArrow(tidy(sets), "rep long, hashes binary"),
                       "open-sets")
    backed = materialize(_backed(members, full, percent), "open-backed")
    meet = _meetings(_mixed(lookup(members, backed, "rep"))).join(full, "rep")

    def run(table):
        few, rep, label = (table.column(c).to_numpy() for c in ("few", "rep", "label"))
        held = [np.frombuffer(h, "u8") for h in table.column("hashes").to_pylist()]
        i, j = np.flatnonzero(few), np.flatnonzero(~few)
        if not len(i) or not len(j):
            return pa.table({"a": rep[:0], "b": rep[:0]})
        both = shingles.intersections([held[k] for k in i], [held[k] for k in j])
        n = np.array([len(h) for h in held])
        union = n[i][:, None] + n[j][None, :] - both
        p, q = np.nonzero((100 * both >= percent * union)
                          & (label[i][:, None] != label[j][None, :]))
        a, b = i[p], j[q]
        keep = _forest(a, b, label[a], label[b])
        return pa.table({"a": rep[a[keep]], "b": rep[b[keep]]})

    return meet.groupBy("grp").applyInArrow(run, "a long, b long").distinct()


def _mixed(members: DataFrame) -> DataFrame:
    """The members of keys whose members have more than one label."""
    many = members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return members.join(many.where("lo <> hi").select("key"), "key")


def _open_keys(shared: DataFrame, labels: DataFrame, size) -> DataFrame:
    """(key, rep, n, label) of keys, of a size that ``size`` accepts, whose
    members have more than one label."""
    placed = (shared.where(size).join(labels.withColumnRenamed("node", "rep"), "rep", "left")
              .select("key", "rep", "n", F.coalesce("label", "rep").alias("label")))
    return _mixed(placed)


def _open_small(docs, reps, shared, labels, tried, percent) -> DataFrame | None:
    """Verified links within small open keys, or None."""
    size = (F.col("n") > 2) & (F.col("n") <= SMALL_KEY)
    members = materialize(_open_keys(shared, labels, size).join(
        reps.select("rep", "n_shingles", "sig"), "rep"), "open-small")
    if members.isEmpty():
        return None
    pairs = materialize(_small_keys(members, percent).join(tried, ["a", "b"], "left_anti"),
                        "small-pairs")
    return None if pairs.isEmpty() else materialize(_verified(pairs, docs, percent), "links")


def _open_large(docs, reps, shared, labels, tried, percent) -> DataFrame | None:
    """Links within large open keys, or None."""
    members = materialize(_open_keys(shared, labels, F.col("n") > SMALL_KEY).join(
        reps.select("rep", "n_shingles"), "rep"), "open-large")
    return None if members.isEmpty() else materialize(
        _large_keys(members, docs, percent), "links")


def link(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
         text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, labels).  rows: doc_id, n_shingles, rep of every
    input row (rep null without shingles or id).  classes: the distinct sets.
    labels: (node, label) of every class that has a link."""
    docs = documents(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    drawn = materialize(sketches(docs), "sketches")
    same = ["n_shingles", "set_a", "set_b"]
    reps = materialize(
        drawn.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same)
        .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "classes")

    keys = _band_rows(reps)
    crowd = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(keys.join(crowd, "key"), "bands")
    score = shared.groupBy("rep").agg(F.sum("n").alias("score"))
    centre = shared.join(score, "rep").groupBy("key").agg(
        F.max_by("rep", F.struct("score", -F.col("rep"))).alias("centre"))
    star = (shared.join(centre, "key").where("rep <> centre")
            .select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
            .distinct())
    pairs = materialize(_promising(star, reps, percent), "star")
    edges = materialize(_verified(pairs, docs, percent), "links")
    labels = components(edges)

    for open_ in (_open_small, _open_large):
        more = open_(docs, reps, shared, labels, pairs, percent)
        if more is not None:
            edges = edges.unionByName(more)
            labels = components(edges)

    rows = (drawn.join(reps.select(*same, "rep"), same, "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")))
    return rows, reps, labels


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id that links reach, itself
    included) and kept (the document is that id) for every row of ``docs``."""
    rows, _, labels = link(docs, percent, id_col, text_col)
    component = F.coalesce("label", "rep", "doc_id")
    return (rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    (component.eqNullSafe(F.col("doc_id"))).alias("kept")))
