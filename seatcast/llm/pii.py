"""Personal data: rules, then bootstrapped contextual extraction.

Rules find e-mail addresses, IPv4 addresses, card and phone numbers; they are
the base and the seeds.  The method then learns where such entities stand:

1. Every mention, seeds and other identifier-like tokens alike, has lexical
   patterns: the two words before it, and the words on both sides, each with
   the mention's coarse shape.
2. Patterns and instances (mention texts) form a bipartite graph.  Iteratively,
   a pattern's score for a kind is the mean confidence of its distinct
   instances, smoothed so that few instances count for little; an instance's
   confidence is the chance that one of its good patterns is right.
3. Mentions that are no seed, stand in a high-confidence pattern and reach a
   high confidence themselves are added as spans of that kind.

Only built-in functions run; the text is read once, everything after works on
the mentions.  A very common context is pre-aggregated before the shuffle and
its join back is a skewed join key that adaptive execution splits.

The words of a pattern are looked for within ``CONTEXT_CHARS`` characters of the
mention; other tokens count as identifier-like from ``MIN_TOKEN_CHARS`` on.  A
text with very many identifiers costs in proportion to its length.

Spans are in code points, end exclusive; base spans are leftmost and do not
overlap within a kind; added spans overlap no base span.

Defined cases: a null or empty text has no span; a row is known by a hash of
its id and text, so repeated rows and null ids each get their result; equal
mentions are one instance; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, materialize

KINDS = ["email", "ip", "card", "phone"]

# The base patterns.  Possessive repeats and a look-behind make a run of word
# characters cost one attempt rather than one per character; \G lets a match
# begin where the last one ended.  What they match is the plain form's match.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# Other identifier-like tokens: runs that hold a digit or an at sign.
_RUN = "A-Za-z0-9._@%+-"
TOKEN = rf"(?<![{_RUN}])[A-Za-z._%+-]*+[0-9@][{_RUN}]*+"

ROUNDS = 3
# Pseudo-instances of confidence 0 added to every pattern.
SMOOTHING = 2.0
GOOD_PATTERN = 0.6
GOOD_INSTANCE = 0.6
CONTEXT_CHARS = 60
MIN_TOKEN_CHARS = 5
# Matches whose places are summed up together, and code points of a text that
# are kept together: a text costs in proportion to its length.
CHUNK, BLOCK = 128, 1024

SPAN = "struct<start:int,kind:int,end:int>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: an expression named
    inside a lambda is otherwise computed again for every element."""
    return F.transform(F.array(value), body)[0]


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, text>> of the matches, in code points: the pieces
    between matches give each match its place.  Places are summed up in chunks,
    so that no long list is copied for every match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.transform(
        F.arrays_zip(F.split(text, pattern).alias("gap"), found.alias("hit")),
        lambda p: F.struct(F.length(p["gap"]).alias("gap"), p["hit"].alias("hit")))

    def extent(p):
        return p["gap"] + F.coalesce(F.length(p["hit"]), F.lit(0))

    def walk(chunk, begin):
        """The matches of one chunk, whose text begins at ``begin``."""
        empty = F.lit([]).cast("array<struct<start:int,text:string>>")
        walked = F.aggregate(
            chunk, F.struct(begin.alias("at"), empty.alias("out")),
            lambda a, p: F.struct(
                (a["at"] + extent(p)).alias("at"),
                F.when(p["hit"].isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(F.struct(
                    (a["at"] + p["gap"]).alias("start"), p["hit"].alias("text")))))
                .alias("out")))
        return walked["out"]

    def place(chunks):
        begins = F.aggregate(
            chunks, F.array(F.lit(0)),
            lambda a, c: F.concat(a, F.array(F.element_at(a, -1) + F.aggregate(
                c, F.lit(0), lambda t, p: t + extent(p)))))
        return _let(begins, lambda at: F.flatten(F.transform(
            chunks, lambda c, j: walk(c, at[j]))))

    return _let(pairs, lambda ps: _let(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(ps) - 1) / CHUNK).cast("int")),
        lambda j: F.slice(ps, j * CHUNK + 1, CHUNK)), place))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _ip_ok(c: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(c, r"\."), lambda p: F.when(
        F.length(part(p)) <= 3, F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255)
        .otherwise(False))


def luhn_ok(digits: Column) -> Column:
    """Luhn's check on a string of digits."""
    def step(total, i):
        d = F.substring(digits, -i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _card_ok(c: Column) -> Column:
    d = _digits(c)
    return F.when(F.length(d).between(12, 19), luhn_ok(d)).otherwise(False)


def _phone_ok(c: Column) -> Column:
    return F.length(_digits(c)).between(9, 15)


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of the rules' spans, by start and kind."""
    rules = [(EMAIL, lambda c: F.lit(True), F.contains(text, F.lit("@"))),
             (IP, _ip_ok, text.rlike(r"[0-9]\.[0-9]")),
             (CARD, _card_ok, text.rlike("[0-9][ -]?[0-9]")),
             (PHONE, _phone_ok, F.contains(text, F.lit("+")))]
    empty = F.lit([]).cast(f"array<{SPAN}>")

    def spans_of(kind: int, pattern: str, ok) -> Column:
        good = F.filter(_matches(text, pattern), lambda m: ok(m["text"]))
        return F.transform(good, lambda m: F.struct(
            m["start"].alias("start"), F.lit(kind).alias("kind"),
            (m["start"] + F.length(m["text"])).alias("end")))

    parts = [F.when(may, spans_of(kind, pattern, ok)).otherwise(empty)
             for kind, (pattern, ok, may) in enumerate(rules)]
    return F.array_sort(F.concat(*parts))


def render(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def _overlaps_none(base: Column) -> Callable[[Column, Column], Column]:
    """A test of (start, end) against the sorted ``base`` spans, by binary search:
    the spans of a kind do not overlap, so only the last one that begins before
    ``end`` can reach past ``start``."""
    def free(spans, steps, start, end):
        before = F.aggregate(steps, F.lit(0), lambda at, s: at + F.when(
            (at + s <= F.size(spans)) & (F.get(spans, at + s - 1)["start"] < end), s).otherwise(0))
        return (before == 0) | (F.get(spans, before - 1)["end"] <= start)

    def test(start, end):
        return F.forall(base, lambda k: free(k["spans"], k["steps"], start, end))

    return test


def _by_kind(base: Column) -> Column:
    """The spans of each kind that has any, with the steps of a binary search."""
    def one(kind):
        spans = F.filter(base, lambda s: s["kind"] == kind)
        return _let(spans, lambda own: F.struct(own.alias("spans"), F.transform(
            F.sequence(F.floor(F.log2(F.size(own) + F.lit(1))).cast("int"), F.lit(0)),
            lambda i: F.pow(F.lit(2), i).cast("int")).alias("steps")))

    kinds = F.array(*[one(F.lit(k)) for k in range(len(KINDS))])
    return F.filter(kinds, lambda k: F.size(k["spans"]) > 0)


def _cut(blocks: Column, begin: Column, n: Column) -> Column:
    """``n`` code points from ``begin`` of a text in blocks of BLOCK: what lies
    before them is not walked through."""
    parts = F.slice(blocks, F.floor(begin / BLOCK).cast("int") + 1,
                    F.floor((begin % BLOCK + n) / BLOCK).cast("int") + 1)
    return F.substring(F.array_join(parts, ""), begin % BLOCK + 1, n)


def _mentions(keyed: DataFrame) -> DataFrame:
    """doc_id, row_key, base, and mentions: array of (start, end, kind, -1 for
    no seed, instance, and the words around)."""
    text, empty = F.col("text"), F.lit([]).cast(f"array<{SPAN}>")
    near = _let(_by_kind(F.col("base")), lambda base: F.filter(
        _matches(text, TOKEN), lambda m: (F.length(m["text"]) >= MIN_TOKEN_CHARS)
        & _overlaps_none(base)(m["start"], m["start"] + F.length(m["text"]))))
    other = F.transform(near, lambda m: F.struct(
        m["start"].alias("start"), F.lit(-1).alias("kind"),
        (m["start"] + F.length(m["text"])).alias("end")))
    spans = F.concat("base", F.when(text.rlike("[0-9@]"), other).otherwise(empty))
    flat = lambda c: F.lower(F.regexp_replace(c, "[0-9]+", "0"))

    def mention(blocks, s):
        begin = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
        own = _cut(blocks, s["start"], s["end"] - s["start"])
        left = flat(_cut(blocks, begin, s["start"] - begin))
        right = flat(_cut(blocks, s["end"], F.lit(CONTEXT_CHARS)))
        shape = F.regexp_replace(F.regexp_replace(own, "[0-9]+", "0"), "[A-Za-z]+", "a")
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
            F.lower(own).alias("instance"), shape.alias("shape"),
            F.regexp_extract(left, r"(\S+\s+\S+\s*)$", 1).alias("before"),
            F.regexp_extract(left, r"(\S+\s*)$", 1).alias("last"),
            F.regexp_extract(right, r"^(\s*\S+)", 1).alias("next"))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    mentions = F.when(F.size("spans") == 0, F.transform("spans", lambda s: mention(
        F.array(F.lit("")), s))).otherwise(_let(blocks, lambda b: F.transform(
            "spans", lambda s: mention(b, s))))
    return (keyed.withColumn("base", base_spans(text)).withColumn("spans", spans)
            .select("doc_id", "row_key", "base", mentions.alias("mentions")))


def _patterns(m: DataFrame) -> DataFrame:
    """One row per mention and pattern that has any words."""
    both = F.array(F.struct(F.lit("L").alias("side"), F.col("before").alias("words")),
                   F.struct(F.lit("B").alias("side"), F.concat_ws("\u0001", "last", "next")
                            .alias("words")))
    return (m.withColumn("p", F.explode(both)).where("p.words <> '' AND p.words <> '\u0001'")
            .withColumn("pattern", F.xxhash64("p.side", "p.words", "shape")).drop("p"))


def discover(mentions: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(row_key, start, kind, end) of the added spans.  ``mentions`` has a row
    per mention: row_key, start, end, kind, instance, shape, before, last, next."""
    linked = materialize(_patterns(mentions), "pattern-mentions")
    edges = materialize(linked.select("pattern", "instance").distinct(), "pattern-graph")
    size = materialize(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")),
                       "pattern-sizes")
    seeds = materialize(mentions.where("kind >= 0").select("instance", "kind").distinct(), "seeds")
    confidence = seeds.withColumn("confidence", F.lit(1.0))
    good = None
    for _ in range(rounds):
        # sums of whole millionths do not depend on the order of addition
        part = F.round(F.col("confidence") * 1_000_000).cast("long")
        score = (edges.join(confidence, "instance").groupBy("pattern", "kind")
                 .agg(F.sum(part).alias("mass")).join(size, "pattern")
                 .withColumn("score", F.col("mass") / 1_000_000 / (F.col("n") + SMOOTHING)))
        good = materialize(score.where(F.col("score") >= GOOD_PATTERN)
                           .select("pattern", "kind", "score"), "good-patterns")
        doubt = F.round(F.log(F.greatest(1 - F.col("score"), F.lit(1e-6))) * 1_000_000)
        found = (edges.join(good, "pattern").groupBy("instance", "kind")
                 .agg((1 - F.exp(F.sum(doubt.cast("long")) / 1_000_000)).alias("confidence")))
        confidence = materialize(
            found.join(seeds, ["instance", "kind"], "left_anti")
            .unionByName(seeds.withColumn("confidence", F.lit(1.0))), "instances")
    sure = confidence.where(F.col("confidence") >= GOOD_INSTANCE)
    hits = (linked.where("kind = -1").drop("kind").join(good, "pattern")
            .join(sure, ["instance", "kind"]))
    return hits.groupBy("row_key", "start", "end").agg(
        F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, base and spans (arrays of start, kind, end;
    spans holds the base and what the method adds, in order)."""
    keyed = documents(docs, id_col, text_col).withColumn("row_key", F.xxhash64("doc_id", "text"))
    found = materialize(_mentions(keyed), "mentions")
    flat = found.select("row_key", F.explode("mentions").alias("m")).select("row_key", "m.*")
    added = (discover(flat).groupBy("row_key")
             .agg(F.collect_set(F.struct("start", "kind", "end")).alias("added")))
    more = F.coalesce("added", F.lit([]).cast(f"array<{SPAN}>"))
    return (found.select("doc_id", "row_key", "base").join(added, "row_key", "left")
            .select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans")))
