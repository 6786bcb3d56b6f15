"""Repeated substrings against marking every window."""

import random

import numpy as np

from seatcast.llm import substrings, suffixes

from . import brute


def corpus(seed):
    rnd = random.Random(seed)
    letters = "ab é\n"
    parts = ["".join(rnd.choices("abcdefghij klmnö", k=rnd.choice([40, 99, 100, 101, 180, 700])))
             for _ in range(8)]
    rows = []
    for _ in range(50):
        text = "".join(rnd.choice(parts)[rnd.randint(0, 9):] +
                       "".join(rnd.choices("uvwxyz ", k=rnd.randint(0, 30)))
                       for _ in range(rnd.randint(1, 4)))
        rows.append(text)
    rows += [None, "", "a" * 99, "a" * 100, "a" * 101, "ab" * 300, "ab" * 301, parts[-1] * 3,
             "".join(rnd.choices(letters, k=400))]
    rnd.shuffle(rows)
    return list(zip(rnd.sample(range(-50, 500), len(rows)), rows))


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_removed_bytes_by_brute_force(spark, docs_df):
    for seed in (1, 2, 3):
        rows = corpus(seed)
        assert result(substrings.remove_repeats(docs_df(rows))) == brute.removed_bytes(rows)


def test_crowded_grams_give_the_same(spark, docs_df):
    # every gram with more than two different runs goes string by string
    rows = corpus(4)
    assert result(substrings.remove_repeats(docs_df(rows), crowd=2)) == brute.removed_bytes(rows)


def test_other_sizes_nulls_repeats_and_no_rows(spark, docs_df):
    rows = corpus(5)
    assert result(substrings.remove_repeats(docs_df(rows), size=60)) == \
        brute.removed_bytes(rows, 60)
    text = "0123456789" * 12
    got = substrings.remove_repeats(docs_df([(None, text), (4, text), (4, text), (9, "x")]),
                                    keep_text=True).collect()
    first = {r.doc_id: (r.n_removed, r.text) for r in got}
    assert len(got) == 4 and first[None][0] > 0 and first[4] == (120, "") and first[9] == (0, "x")
    assert substrings.remove_repeats(docs_df([])).collect() == []


def test_suffix_sort_orders_and_extends():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 257):
        chars = rnd.integers(0, 3, (n, 12)).astype("u2")
        group = np.sort(rnd.integers(0, 4, n))
        order, shared = suffixes.suffix_sort(group, chars)
        rows = [(group[i], *chars[i]) for i in order]
        assert rows == sorted(rows)
        for k in range(1, n):
            a, b = rows[k - 1], rows[k]
            want = -1 if a[0] != b[0] else next(
                (j for j in range(12) if a[1 + j] != b[1 + j]), 12)
            assert shared[k] == want


def test_lying_hashes_are_caught(monkeypatch):
    rnd = np.random.default_rng(2)
    chars = rnd.integers(0, 3, (60, 9)).astype("u2")
    monkeypatch.setattr(suffixes, "_extensions", lambda c: np.zeros((len(c), 10), "u8"))
    order, _ = suffixes.suffix_sort(np.zeros(60, "i8"), chars)
    rows = [tuple(chars[i]) for i in order]
    assert rows == sorted(rows)
