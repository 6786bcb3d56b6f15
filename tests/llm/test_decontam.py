"""Prefix-filtered decontamination against looking at every window."""

import random

from seatcast.llm import decontam

from . import brute


def corpus(seed):
    rnd = random.Random(seed)
    words = ["the", "of", "Ünder", "éa", "x1", "İst", "it's"] + \
        ["".join(rnd.choices("abcdefg", k=5)) for _ in range(150)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([1, 3, 12, 13, 14, 40]))))
             for i in range(25)]
    items += [(100, None), (101, "..."), (None, "a nameless item of few words"),
              (102, items[3][1]), (103, "the " * 20)]
    texts = []
    for _ in range(80):
        parts = rnd.choices(words, k=rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 2)):
            w = (rnd.choice(items)[1] or "").split()
            a = rnd.randint(0, max(0, len(w) - 13))
            at = rnd.randint(0, len(parts))
            parts[at:at] = w[a:a + rnd.choice([12, 13, 20])]
        sep = rnd.choice([" ", "\n", ", ", "-"])
        texts.append(sep.join(parts).upper() if rnd.random() < 0.2 else sep.join(parts))
    texts += [None, "", "...", "the " * 200, "a nameless item, of few words"]
    return list(enumerate(texts)), items


def test_hits_by_brute_force(spark, docs_df):
    for seed in (1, 2):
        docs, items = corpus(seed)
        bench = spark.createDataFrame(items, "item_id long, text string")
        got = decontam.contamination(docs_df(docs), bench).collect()
        want = brute.contaminated(docs, items)
        assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                for r in got} == want
        assert any(v[4] for v in want.values())
        left = decontam.drop_contaminated(docs_df(docs), bench)
        assert left.columns == docs_df(docs).columns
        assert sorted(r.doc_id for r in left.collect()) == sorted(
            d for d, v in want.items() if not v[4])


def test_repeats_null_ids_and_no_rows(spark, docs_df):
    bench = spark.createDataFrame([(1, "some secret question")], "item_id long, text string")
    rows = [(1, "some secret question")] * 2 + [(None, "Some SECRET question!"), (None, "clean")]
    got = decontam.contamination(docs_df(rows), bench).collect()
    assert sorted((str(r.doc_id), r.n_hit) for r in got) == [
        ("1", 3), ("1", 3), ("None", 0), ("None", 3)]
    assert decontam.contamination(docs_df([]), bench).collect() == []
    none = decontam.contamination(docs_df(rows), bench.limit(0)).collect()
    assert [r.n_hit for r in none] == [0] * 4


def test_no_python_in_the_plans(spark, docs_df):
    docs, items = corpus(1)
    df = decontam.contamination(docs_df(docs), spark.createDataFrame(
        items, "item_id long, text string"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
