"""Personal data: rules by brute force, discovery on planted contexts."""

import random
import re
import time

from pyspark.sql import functions as F

from seatcast.llm import pii

from . import brute

BITS = ["a@b.c", "x.y@z-1.co.uk", "@", "a@", "@b.c", "..a@b.c._q@r.s", "1.2.3.4", "1.2.3.4.5.6.7.8",
        "256.1.1.1", "001.002.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "12 34",
        "+1 (437) 555-0689", "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "1", "22", " ", "  ", "\n",
        "é", "🙂", "word", "-", ".", ",", "+", "(", "5500005555555559", "9" * 30, "a1b2c3"]


def texts(seed, n):
    rnd = random.Random(seed)
    return [(i, "".join(rnd.choices(BITS, k=rnd.randint(0, 12)))) for i in range(n)]


def test_rules_by_brute_force(spark, docs_df):
    rows = texts(1, 1500) + [(9000, None), (9001, ""), (9002, "a" * 5000 + "@"),
                             (9003, "1.2.3.4 " * 300), (9004, "a@b." + "c." * 2000 + "d")]
    got = pii.personal_data(docs_df(rows))
    got = got.select("doc_id", pii.render("base").alias("b"), pii.render("spans").alias("s"))
    want = brute.pii_base(rows)
    for r in got.collect():
        assert r.b == want[r.doc_id][5], dict(rows)[r.doc_id]
        assert set(filter(None, r.b.split(","))) <= set(r.s.split(","))


def test_contexts_of_seeds_discover_more(spark, docs_df):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choices("abcdefgh", k=6))
    rows = []
    for i in range(40):
        rows.append((i, f"{word()} {word()} my phone: +1 (2{i:02d}) 555-{1000 + i} {word()}"))
    # same words before, same shape, but too few digits for the rule
    rows.append((100, f"{word()} {word()} my phone: +1 (25) 55-10 {word()}"))
    # same shape in other company
    rows.append((101, f"{word()} {word()} part no: 55-1012345 {word()}"))
    for i in range(40):
        rows.append((200 + i, f"{word()} server at host 10.0.{i}.7 now {word()}"))
    rows.append((300, f"{word()} server at host 10.0.999.7 now {word()}"))     # no address
    rows.append((301, f"{word()} the build 10.0.999.8 is {word()}"))
    found = pii.personal_data(docs_df(rows)).select("doc_id", pii.render("spans").alias("s"),
                                                    pii.render("base").alias("b")).collect()
    more = {r.doc_id: set(r.s.split(",")) - set(r.b.split(",")) for r in found}
    assert {d for d, m in more.items() if m} == {300}
    (span,) = more[300]
    kind, start, end = span.split(":")
    assert kind == "ip" and dict(rows)[300][int(start):int(end)] == "10.0.999.7"


def test_long_texts_cost_in_proportion(spark, docs_df):
    rnd = random.Random(4)
    made = [lambda: f"id{rnd.randrange(10**6)}x", lambda: f"u{rnd.randrange(999)}@h.org",
            lambda: f"10.{rnd.randrange(300)}.0.1", lambda: "é🙂" * rnd.randrange(4)]
    long = " ".join(rnd.choice(made)() for _ in range(30_000))
    rows = [(1, long), (2, long[:400]), (3, "q7" * 3000 + " " + "w " * 2000 + "a@b.c")]
    keyed = pii.documents(docs_df(rows)).withColumn("row_key", F.xxhash64("doc_id", "text"))
    began = time.monotonic()
    got = {r.doc_id: r for r in pii._mentions(keyed).collect()}
    assert time.monotonic() - began < 20
    want = brute.pii_base(rows)
    for doc, text in rows:
        spans = [(s.start, s.end) for s in got[doc].base]
        assert ",".join(f"{pii.KINDS[s.kind]}:{s.start}:{s.end}" for s in got[doc].base) == want[doc][5]
        others = [m.span() for m in re.finditer(r"(?<![\w.@%+-])[A-Za-z._%+-]*[0-9@][\w.@%+-]*", text, re.A)]
        ends = {}  # by a plain walk over the characters that base spans cover
        for a, b in spans:
            ends.update(dict.fromkeys(range(a, b)))
        others = [(a, b) for a, b in others if b - a >= 5 and not any(i in ends for i in range(a, b))]
        found = [m for m in got[doc].mentions if m.kind == -1]
        assert [(m.start, m.end) for m in found] == others
        for m in got[doc].mentions:
            assert m.instance == text[m.start:m.end].lower()
            left = re.sub("[0-9]+", "0", text[max(m.start - 60, 0):m.start]).lower()
            assert (re.search(r"\S+\s*$", left, re.A) or [""])[0] == m["last"]


def test_repeats_null_ids_and_no_rows(spark, docs_df):
    rows = [(1, "x a@b.c"), (1, "x a@b.c"), (None, "y 1.2.3.4"), (None, None)]
    got = pii.personal_data(docs_df(rows)).collect()
    assert sorted((str(r.doc_id), len(r.base)) for r in got) == [
        ("1", 1), ("1", 1), ("None", 0), ("None", 1)]
    assert pii.personal_data(docs_df([])).collect() == []


def test_no_python_in_the_plans(spark, docs_df):
    text = pii.personal_data(docs_df(texts(3, 20)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
