"""Case-insensitive "contains pattern" lookups as equi-joins.

An artist rule matches a row when ``artist ILIKE '%' || pattern || '%'``,
where ``%`` and ``_`` inside the pattern are wildcards and there is no escape
character.  Evaluating that predicate for every (rule, row) pair is a nested
loop join; here it becomes two equi-joins:

1. Equal patterns become one, and rows one order key per distinct text
   (the first in the requested order), partially aggregated map-side.
2. Every distinct text is indexed by its grams: all substrings of length
   1..Q of its lower-case form; only grams some pattern needs are kept (a
   left-semi join against the patterns' grams).
3. Every pattern lists the grams its literal pieces (the runs between
   wildcards) force a matching text to contain: the Q-grams of each piece,
   or the whole piece when it is shorter than Q.  A text can only match if it
   contains all of them, so one suffices as a join key; the rarest one (by
   number of texts containing it) is chosen, so a gram held by a large share
   of the texts is avoided whenever the pattern has a rarer one.
4. Candidates (pattern, text) sharing that gram are verified with the real
   ILIKE predicate, so the result is exact.

Patterns without any literal character (only wildcards) constrain the text
length alone: ``'%' || pattern || '%'`` matches every text at least as long
as its number of ``_``.  Those are answered from a table keyed by that
minimum length, whose size is bounded by the longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Q = 3


def text_grams(text: Column, q: int = Q) -> Column:
    """Distinct substrings of length 1..q of ``text`` (array<string>)."""
    def of_length(n):
        # one-parameter lambda: transform() reads a second parameter as the index
        return lambda i: F.substring(text, i, n)

    parts = []
    for n in range(1, q + 1):
        last = F.greatest(F.length(text) - F.lit(n - 1), F.lit(0))
        parts.append(F.transform(F.sequence(F.lit(1), last), of_length(n)))
    grams = F.flatten(F.array(*parts))
    # sequence(1, 0) counts down to [1, 0]; drop the empty / short pieces
    return F.array_distinct(F.filter(grams, lambda g: F.length(g) > 0))


def pattern_grams(pattern: Column, q: int = Q) -> Column:
    """Grams every text matching ``%pattern%`` must contain (array<string>),
    empty when the pattern has no literal character."""
    pieces = F.filter(F.split(pattern, "[%_]"), lambda p: F.length(p) > 0)

    def piece_grams(p):
        long_piece = F.transform(F.sequence(F.lit(1), F.greatest(F.length(p) - F.lit(q - 1),
                                                                 F.lit(1))),
                                 lambda i: F.substring(p, i, q))
        return F.when(F.length(p) >= q, long_piece).otherwise(F.array(p))

    return F.array_distinct(F.flatten(F.transform(pieces, piece_grams)))


def like_contains(text: Column, pattern: Column) -> Column:
    """``lower(text) LIKE '%' || lower(pattern) || '%'``; backslashes in the
    pattern are literal."""
    lit_pattern = F.regexp_replace(F.lower(pattern), r"\\", r"\\\\")
    return F.like(F.lower(text), F.concat(F.lit("%"), lit_pattern, F.lit("%")))


def cheapest_per_pattern(rows: DataFrame, text_col: str, patterns: DataFrame,
                         pattern_col: str, pattern_key: str, order: list[str],
                         q: int = Q) -> DataFrame:
    """For every pattern, the first row (by ``order`` ascending) among
    ``rows`` whose ``text_col`` contains the pattern.

    Never enumerates all (pattern, row) pairs: equal patterns are answered
    once, rows are reduced to the first order key per distinct text, and only
    texts and order keys travel through the gram index.  The winning rows are
    joined back at the end and fanned out to the patterns that asked."""
    text, lp = F.col(text_col), F.lower(F.col(pattern_col))
    okey = F.struct(*[F.col(c) for c in order])
    texts = (rows.filter(text.isNotNull()).groupBy(text.alias("_text"))
             .agg(F.min(okey).alias("_key")))
    asked = patterns.select(lp.alias("_p")).distinct().select("_p", pattern_grams(F.col("_p"), q)
                                                              .alias("_gs"))
    need_grams = asked.filter(F.size("_gs") > 0).select("_p", F.explode("_gs").alias("_g"))

    index = (texts.select(F.explode(text_grams(F.lower("_text"), q)).alias("_g"), "_text", "_key")
             .join(need_grams.select("_g").distinct(), "_g", "left_semi"))
    freq = index.groupBy("_g").agg(F.count(F.lit(1)).alias("_f"))
    # a pattern goes by its rarest gram; a gram that no text has rules it out
    chosen = (need_grams.join(freq, "_g", "left").groupBy("_p")
              .agg(F.min_by("_g", F.struct(F.coalesce("_f", F.lit(0)), F.col("_g"))).alias("_g")))
    literal = (chosen.join(index, "_g").filter(like_contains(F.col("_text"), F.col("_p")))
               .groupBy("_p").agg(F.min(F.struct("_key", "_text")).alias("_best")))

    # wildcards only: the first row among texts with at least that many
    # characters.  One row per length, joined with the few distinct needs
    # through a running minimum over the lengths.
    by_len = texts.groupBy(F.length("_text").alias("_len")).agg(
        F.min(F.struct("_key", "_text")).alias("_best"))
    at_least = (by_len.select(F.explode(F.sequence(F.lit(0), F.col("_len"))).alias("_need"),
                              "_best").groupBy("_need").agg(F.min("_best").alias("_best")))
    need = F.length(F.regexp_replace("_p", "[^_]", "")).cast("int")
    wild = (asked.filter(F.size("_gs") == 0).select("_p", need.alias("_need"))
            .join(at_least, "_need").select("_p", "_best"))

    best = literal.unionByName(wild).select(
        F.col("_p").alias("_asked"), F.col("_best._text").alias("_won"),
        *[F.col(f"_best._key.{c}").alias(f"_k{i}") for i, c in enumerate(order)])
    row = F.struct(*[F.col(c) for c in rows.columns])
    same = text == F.col("_won")
    for i, c in enumerate(order):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    won = (best.join(rows, same).groupBy("_asked").agg(F.min(row).alias("_row")))
    return (patterns.select(pattern_key, lp.alias("_asked")).join(won, "_asked")
            .select(pattern_key, "_row.*"))
