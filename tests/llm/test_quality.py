"""Compression bands: the plain counts by brute force, verdicts on clear cases."""

import random

from seatcast.llm import quality

from . import brute

SYLLABLES = "an be con di en fa go hi in jo ka lo mi nu or pa qui re su ta".split()


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 4))) for _ in range(n))


def noise(seed, n):
    import base64
    return "\n".join(base64.b64encode(random.Random(seed + i).randbytes(50)).decode()
                     for i in range(n))


ROWS = [(1, prose(1, 400)), (2, prose(2, 5000)), (3, prose(3, 60) + "\n" + noise(3, 200)),
        (4, ("the same line again and again\n") * 80), (5, None), (6, ""), (7, "a b c"),
        (8, "x\ty\x0bz\x1cw v #*$%&|<>\n\n \nx\nx\n" * 3), (9, prose(9, 49)),
        (10, prose(10, 50)), (11, "un café noir " * 30), (12, "a" * 30000), (13, prose(13, 800) * 4)]


def test_base_by_brute_force(spark, docs_df):
    got = quality.compression_bands(docs_df(ROWS)).collect()
    want = brute.quality_base(ROWS)
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                       r.base_failed) for r in got} == want


def test_verdicts(spark, docs_df):
    kept = {r.doc_id: r.kept for r in quality.compression_bands(docs_df(ROWS)).collect()}
    assert [d for d, k in kept.items() if k] == [1, 2, 10]
    rows = quality.keep_passing(docs_df(ROWS))
    assert rows.columns == docs_df(ROWS).columns
    assert sorted(r.doc_id for r in rows.collect()) == [1, 2, 10]


def test_repeats_nulls_and_no_rows(spark, docs_df):
    got = quality.compression_bands(docs_df([(None, prose(1, 99))] * 2)).collect()
    assert len(got) == 2 and got[0] == got[1] and got[0].doc_id is None
    assert quality.compression_bands(docs_df([])).collect() == []


def test_limits_fall_with_the_length():
    lows = [quality.limits(n)[0] for n in (500, 2000, 9000, 60000, 10 ** 7)]
    assert lows == sorted(lows, reverse=True)
