"""Runs of words against brute force; Lyndon arrays against their definition."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from seatcast.llm import periods, queries

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lyndon_lengths(s):
    """From each place on: up to the next smaller suffix."""
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i
            for i in range(len(s))]


def runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        same = [words[k] == words[k + q] for k in range(n - q)]
        k = 0
        while k < n - q:
            start = k
            while k < n - q and same[k]:
                k += 1
            end = k + q
            if end - start >= max(6, 4 * q) and not any(
                    all(words[t] == words[t + r] for t in range(start, end - r))
                    for r in range(1, q)):
                out.append((start, end - start, q))
            k += k == start or k < n - q
    return sorted(out)


def collapsed(words, found):
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def planted(doc_id, text):
    words = BLANK.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def random_words(rnd):
    out = []
    for _ in range(rnd.randint(0, 5)):
        if rnd.random() < 0.4:
            out += [rnd.randint(0, 9) for _ in range(rnd.randint(0, 8))]
        else:
            u = [rnd.randint(0, 2) for _ in range(rnd.randint(1, 6))]
            out += (u * 40)[:rnd.randint(1, 8 * len(u) + 3)]
    return out


def test_lyndon_array_by_definition():
    rnd = random.Random(1)
    for _ in range(1500):
        s = [rnd.randint(0, rnd.choice([0, 1, 2, 6])) for _ in range(rnd.randint(1, 30))]
        rank = np.unique(s, return_inverse=True)[1]
        assert periods.lyndon_array(rank).tolist() == lyndon_lengths(rank.tolist()), s
    assert len(periods.lyndon_array(np.array([], "i8"))) == 0


def test_runs_by_brute_force():
    rnd, total = random.Random(2), 0
    for _ in range(600):
        texts = [random_words(rnd) for _ in range(rnd.randint(0, 5))]
        want = [runs(t) for t in texts]
        assert periods.runs_of_texts(texts) == want, texts
        total += sum(map(len, want))
    assert total > 1000


@pytest.mark.parametrize("lie", [lambda x: np.zeros(len(x), "u8"),
                                 lambda x: (x % 2).astype("u8")])
def test_lying_hashes_change_nothing(lie):
    """Hashes that take all values, or half of them, for equal."""
    rnd = random.Random(3)
    for _ in range(300):
        words = random_words(rnd)
        if words:
            x = np.array(words, "i8")
            assert [tuple(r) for r in periods.runs_of(x, lie(x)).tolist()] == runs(words)


def test_long_texts_take_linear_time():
    n = 200_000
    fib, other = [0, 1], [0]
    while len(fib) < n:
        other, fib = fib, fib + other
    thue = [bin(i).count("1") % 2 for i in range(n)]
    for words in ([0] * n, [0, 1] * (n // 2), list(range(1000)) * (n // 1000), fib[:n], thue,
                  ([0] * 99 + [1]) * (n // 100)):
        t = time.time()
        found = periods.runs_of_texts([words])[0]
        assert time.time() - t < 20
        assert all(words[s:s + k - q] == words[s + q:s + k] for s, k, q in found[:50])
    assert periods.runs_of_texts([[0] * n]) == [[(0, n, 1)]]
    assert (0, n, 1000) in periods.runs_of_texts([list(range(1000)) * (n // 1000)])[0]


ROWS = [(1, "a b " * 9), (2, "x " * 6 + "y " * 5), (3, None), (4, ""), (5, " \n\t\x0b\x0c\r "),
        (6, "a\x1cb\x85c a\x1cb\x85c" * 8), (7, "é ü " * 4 + "end"), (8, "a b c " * 3 + "a b"),
        (9, "a b c " * 4), (10, "p " * 7 + "q r s " * 5 + "q")]


def test_documents_nulls_repeats_and_no_rows(spark, docs_df):
    got = periods.periodic_runs(docs_df(ROWS + ROWS[:1] + [(None, "z " * 9)])).collect()
    want = {}
    for d, t in [*ROWS, (None, "z " * 9)]:
        words = BLANK.findall(t or "")
        want[d] = (len(words), runs(words), collapsed(words, runs(words)))
    assert {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got} == want
    assert len(got) == len(ROWS) + 2
    assert periods.periodic_runs(docs_df([])).collect() == []


def test_query_by_brute_force(spark):
    got = {r.doc_id: r for r in queries.op11_periodic_runs(
        spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(rows)
    seen = 0
    for d in rows:
        words = planted(d.doc_id, d.text)[:3000]
        r = got[d.doc_id]
        if len(words) == 3000:  # too long for brute force
            continue
        found = runs(words)
        seen += len(found)
        top = max(found, key=lambda f: (f[1], -f[0], -f[2]), default=None)
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period, r.exponent_milli) == (
            (*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r.collapsed_sha256 == sha(collapsed(words, found))
    assert seen > 5
