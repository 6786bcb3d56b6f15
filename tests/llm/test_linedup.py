"""Line templates: small cases, and the rule by brute force."""

import random

from seatcast.llm import linedup


def prose(rnd, n=8):
    return " ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(n))


def left(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_recurring_lines_stay_once(spark, docs_df):
    rnd = random.Random(1)
    own = [[prose(rnd) for _ in range(4)] for _ in range(12)]
    notice = "all rights reserved by the owner"
    rows = [(i, "\n".join(o[:2] + ([notice] if i >= 3 else []) + o[2:]))
            for i, o in enumerate(own)]
    got = linedup.drop_templates(docs_df(rows), min_docs=5)
    assert left(got) == {i: "\n".join(o[:2] + ([notice] if i == 3 else []) + o[2:])
                         for i, o in enumerate(own)}
    assert {r.doc_id: (r.n_lines, r.n_dropped) for r in got.collect()} == {
        i: (4 + (i >= 3), int(i > 3)) for i in range(12)}
    # one document class less than asked for: nothing recurs
    assert left(linedup.drop_templates(docs_df(rows), min_docs=10)) == dict(rows)


def test_variable_fields_are_generalised(spark, docs_df):
    rnd = random.Random(2)
    # numbers are variable at once; names become so because they differ
    rows = [(i, f"{prose(rnd)}\nserved by node {i} in {10 * i} ms\n"
                f"posted in the forum by {prose(rnd, 1)} on the last day of the week")
            for i in range(9)]
    got = {r.doc_id: r.n_dropped for r in linedup.drop_templates(docs_df(rows)).collect()}
    assert got == {i: 0 if i == 0 else 2 for i in range(9)}
    # lines of a leaf that share less than half of their tokens are no template
    rows = [(i, "so it was " + prose(rnd, 9) + "\n" + prose(rnd)) for i in range(9)]
    assert left(linedup.drop_templates(docs_df(rows))) == dict(rows)


def test_copies_of_a_document_are_no_templates(spark, docs_df):
    rnd = random.Random(3)
    text = "\n".join(prose(rnd) for _ in range(6))
    rows = [(i, text) for i in range(30)] + [(99, prose(rnd))]
    assert left(linedup.drop_templates(docs_df(rows))) == dict(rows)


def test_short_and_blank_lines_nulls_and_no_rows(spark, docs_df):
    rnd = random.Random(4)
    rows = [(i, f"\nyes\nno way\n\n{prose(rnd)}") for i in range(20)]
    rows += [(50, None), (51, ""), (None, "alone here again\nx"), (None, None)]
    got = linedup.drop_templates(docs_df(rows))
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == sorted(map(str, rows))
    assert set(got.columns) == {"doc_id", "text", "n_words", "kept", "row_key", "label",
                                "n_lines", "n_dropped"}
    assert linedup.drop_templates(docs_df([])).collect() == []


def test_exact_lines_by_brute_force(spark, docs_df):
    rnd = random.Random(5)
    pool = [prose(rnd, 5) for _ in range(12)]
    rows = []
    for i in range(60):
        lines = [prose(rnd, 7) for _ in range(3)] + rnd.sample(pool, rnd.randint(0, 4))
        rnd.shuffle(lines)
        rows.append((rnd.randint(-10 ** 6, 10 ** 6), "\n".join(lines)))
    rows = list(dict(rows).items())
    holders = {p: [d for d, t in rows if p in t.split("\n")] for p in pool}
    gone = {(d, p) for p, ds in holders.items() if len(ds) >= 5 for d in ds if d != min(ds)}
    want = {d: "\n".join(x for x in t.split("\n") if (d, x) not in gone) for d, t in rows}
    assert left(linedup.drop_templates(docs_df(rows))) == want


def test_documents_that_share_their_long_lines_count_one_by_one(spark, docs_df):
    rnd = random.Random(6)
    # nothing but numeric log lines: equal once their numbers are masked
    rows = [(i, f"served by node {i} in {10 * i} ms\nclosed port {i} at noon") for i in range(9)]
    # a shared header over short lines of their own
    head = "all rights reserved by the owner"
    rows += [(100 + i, f"{head}\n{prose(rnd, 2)}\n{prose(rnd, 1)}") for i in range(9)]
    # exact copies still count once
    rows += [(200 + i, "some other line of text\nyes") for i in range(9)]
    got = {r.doc_id: r.n_dropped for r in linedup.drop_templates(docs_df(rows)).collect()}
    assert got == {**{i: 2 * (i > 0) for i in range(9)}, **{100 + i: int(i > 0) for i in range(9)},
                   **{200 + i: 0 for i in range(9)}}
