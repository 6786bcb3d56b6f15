"""Deobfuscation, learning and held-out accuracy on planted words."""

import random
import zlib

import numpy as np

from seatcast.llm import chars, toxicity

BAD = ["grobnik", "snurfle", "waxelot"]
SYLLABLES = "an be con di en fa go hi in jo ka lo mi nu or pa qui re su ta".split()


def word(rnd):
    return "".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 4)))


def disguise(rnd, w):
    how = rnd.randrange(5)
    if how == 1:
        return w.replace("o", "0").replace("e", "3").replace("i", "1")
    if how == 2:
        i = rnd.randrange(len(w))
        return w[:i] + w[i] * 4 + w[i:]
    if how == 3:
        return " ".join(w)
    if how == 4:
        return w.upper() + "!!!"
    return w


def corpus(n=900):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = [word(rnd) for _ in range(rnd.randint(20, 80))]
        toxic = i % 6 == 0
        if toxic:
            words[rnd.randrange(len(words))] = disguise(rnd, rnd.choice(BAD))
        rows.append((i, " ".join(words)))
        if i % 8:
            labels.append((i, int(toxic)))
    # the model needs to see the plain words too
    rows += [(n + i, " ".join([*BAD, word(rnd)])) for i in range(20)]
    return rows, labels


def test_held_out_accuracy(spark, docs_df):
    rows, labels = corpus()
    got = toxicity.toxicity(docs_df(rows), spark.createDataFrame(
        labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    own = dict(labels)
    held = [(own[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in own]
    right = sum(a == b for a, b in held)
    assert right >= 0.95 * len(held) and sum(a for a, _ in held) >= 15


def test_labels_of_the_held_out_fold_do_not_matter(spark, docs_df):
    rows, labels = corpus(300)
    turned = [(d, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, t in labels]
    scores = [sorted((r.doc_id, r.score) for r in toxicity.toxicity(
        docs_df(rows), spark.createDataFrame(own, "doc_id long, toxic int")).collect())
        for own in (labels, turned)]
    assert scores[0] == scores[1]


def test_restoring():
    text = " ".join(["idiot scum hello there little bottle"] * 50)
    counts = np.bincount(chars.codes(text), minlength=chars.TRIGRAMS)
    r = chars.Restorer(chars.log_model(counts))
    for seen in ("idiot", "1d10t", "1d!ot", "i.d.i.o.t", "idiooooot", "IDIOT!!", "idiot***",
                 "$cum", "s.c.u.m"):
        assert r.word(seen.lower()) in ("idiot", "scum"), (seen, r.word(seen.lower()))
    assert r.words("you i d i o t now") >= {"you", "idiot", "now"}
    assert r.word("little") == "little" and r.word("2024") == "" and r.word("") == ""


def test_more_features_than_the_driver_takes(spark, docs_df, monkeypatch):
    rows, labels = corpus(300)
    # many common words that toxic and other documents share come before the rare toxic ones
    rows = [(d, "common usual plain " + t) for d, t in rows] + [(900, None), (901, "")]
    rows += rows[:3]
    own = spark.createDataFrame(labels, "doc_id long, toxic int")
    scores = []
    for most in (200_000, 3):
        monkeypatch.setattr(toxicity, "MAX_FEATURES", most)
        got = toxicity.toxicity(docs_df(rows), own).collect()
        assert len(got) == len(rows) and any(r.predicted for r in got)
        scores.append(sorted((r.doc_id, r.score, r.predicted) for r in got))
    assert scores[0] == scores[1]


def test_words_of_joined_and_long_tokens():
    counts = np.bincount(chars.codes("idiot scum you hello little bottle " * 50),
                         minlength=chars.TRIGRAMS)
    r = chars.Restorer(chars.log_model(counts))
    filler = "hello-little-bottle-hello-little-bottle-hello"
    for token, want in ((filler + "-1d10t", {"hello", "little", "idiot"}),
                        ("https://little.example/bottle/hello_you/idiot,scum", {"idiot", "scum"}),
                        ("/".join(["hello"] * 9) + "/i.d.i.o.t", {"idiot"}),
                        ("*" * 50 + "idiot" + "*" * 50, {"idiot"}),
                        ("hello!idiot" * 6, {"idiothello", "hello"}),
                        ("you-idiot", {"you", "idiot", "youidiot"}), ("hello!idiot", {"idiot"}),
                        ("id-iot", {"idiot"}), ("дурак," * 9 + "идиот1", {"дурак"})):
        assert r.words(token) >= want, (token, r.words(token))
    assert any(w.startswith("идиот") for w in r.words("дурак," * 9 + "идиот1"))
    # a token of any length takes time in proportion to it
    assert r.words("l1ttle" * 20_000)


def test_without_labels_nulls_repeats_and_no_rows(spark, docs_df):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(docs_df([(1, "a b"), (1, "a b"), (None, None), (2, "")]), none).collect()
    assert len(got) == 4 and all(r.predicted == 0 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert toxicity.toxicity(docs_df([]), none).collect() == []
