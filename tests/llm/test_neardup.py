"""HyperMinHash near duplicates against comparing all documents."""

import random

import numpy as np

from seatcast.llm import neardup, shingles
from seatcast.llm.graph import components

from . import brute


def word(rnd):
    return "".join(rnd.choices("abcdefgh", k=4))


def corpus(seed):
    """Bases, edited copies of many strengths, chains, exact copies, oddities."""
    rnd = random.Random(seed)
    rows, base = [], []
    for _ in range(12):
        base.append([word(rnd) for _ in range(rnd.choice([6, 12, 60, 200]))])
    for b in base:
        rows.append(" ".join(b))
        rows.append(" ".join(b).upper())
        for _ in range(12):
            w = list(b)
            for _ in range(rnd.randint(0, max(1, len(w) // 30))):
                w[rnd.randrange(len(w))] = word(rnd)
            rows.append(" ".join(w))
        chain = list(b)
        for _ in range(6):
            chain[rnd.randrange(len(chain))] = word(rnd)
            rows.append("\n".join(chain))
    rows += [None, "", " \n", "one", "ONE", "one two", "one two three four five"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_components_by_brute_force(spark, docs_df):
    for seed in (1, 2):
        rows = corpus(seed)
        got = neardup.near_duplicates(docs_df(rows)).collect()
        want = brute.near(rows)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_links_beside_the_centre_are_found(spark, docs_df, monkeypatch):
    # tiny blocks: members of one key that lie in different components meet
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "SMALL_KEY", 4)
    rnd = random.Random(5)
    base = [word(rnd) for _ in range(300)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(4 + i % 5):
            w[rnd.randrange(300)] = word(rnd)
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicates(docs_df(rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: v[1] for d, v in brute.near(rows).items()}


def test_a_stranger_among_many_near_copies_sends_each_once(spark, docs_df):
    n = 20_000
    rows = [(7, i, 3 if i > 2 else i, 100) for i in range(n)]
    rows += [(8, i, i % 2, 100) for i in range(2000)]
    members = spark.createDataFrame(rows, "key long, rep long, label long, n_shingles long")
    met = neardup._meetings(members)
    near = met.where("rep >= 2000").count()
    assert near == n - 2000
    # with labels of equal size each block of one meets all blocks, once
    assert met.count() <= 21_000 + 2000 * 2 + 1000 * 4 + 3 * 40
    groups = {}
    for r in met.where("rep < 2000").collect():
        groups.setdefault(r.grp, ([], []))[not r.few].append(r)
    pairs = {(a.rep, b.rep) for few, all_ in groups.values() for a in few[:9] for b in all_}
    assert {(1, 0), (0, 1), (2, 0), (2, 1)} <= pairs


def test_members_that_no_other_label_can_link_with_do_not_meet(spark, docs_df, monkeypatch):
    # copies whose own words take more than 15 % of their shingles share keys only
    monkeypatch.setattr(neardup, "SMALL_KEY", 4)
    met = []
    meetings = neardup._meetings
    monkeypatch.setattr(neardup, "_meetings",
                        lambda members: met.append(members.localCheckpoint()) or meetings(met[-1]))
    rnd = random.Random(8)
    base = [word(rnd) for _ in range(300)]
    rows = []
    for i in range(80):
        w = list(base)
        for k in rnd.sample(range(0, 300, 6), 14 if i % 4 else 2):
            w[k] = f"own{i}x{k}"
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicates(docs_df(rows)).collect()
    want = brute.near(rows)
    assert {r.doc_id: r.component_id for r in got} == {d: v[1] for d, v in want.items()}
    assert sum(v[1] == d for d, v in want.items()) == 61  # the 60, and one for the others
    assert not met[0].count()


def test_backed_members(spark):
    def row(rep, label, hashes):
        return rep, label, len(hashes), np.array(hashes, "u8").tobytes()

    rows = [row(1, 1, range(20)), row(2, 1, range(20)), row(3, 3, range(3, 20)),
            row(4, 4, [*range(17), 31, 32, 33]), row(5, 5, [*range(16), 41, 42, 43, 44]),
            row(6, 6, [51, 52]), row(7, 6, [51, 52])]
    df = spark.createDataFrame(rows, "rep long, label long, n_shingles long, hashes binary")
    members = df.select("rep", "label", "n_shingles").crossJoin(
        spark.range(3).withColumnRenamed("id", "key"))
    got = neardup._backed(members, df.select("rep", "hashes"), 85).collect()
    assert sorted(r.rep for r in got) == [1, 2, 3, 4]


def test_matrix_products_count_intersections():
    rnd = np.random.default_rng(6)
    sets = [np.unique(rnd.integers(0, 9000, n).astype("u8")) for n in (0, 1, 50, 6000, 6000, 9)]
    got = shingles.intersections(sets[:4], sets[2:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:4]]


def test_nulls_repeats_and_no_rows(spark, docs_df):
    text = "a b c d e f g h"
    got = neardup.near_duplicates(docs_df([(5, text)] * 2 + [(None, text), (2, text)])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("2", "2", True), ("5", "2", False), ("5", "2", False), ("None", "None", True)]
    assert neardup.near_duplicates(docs_df([])).collect() == []


def test_estimates_are_corrected_and_close():
    rnd = np.random.default_rng(3)
    for share in (0.0, 0.5, 0.9):
        errors = []
        for _ in range(30):
            both = rnd.integers(0, 2 ** 63, int(4000 * share), dtype="u8")
            own = [rnd.integers(0, 2 ** 63, 4000 - len(both), dtype="u8") for _ in "ab"]
            a, b = (np.unique(shingles.mix(np.concatenate([both, o]))) for o in own)
            x, y = shingles.registers(a), shingles.registers(b)
            est = shingles.estimate(np.array([(x == y).sum()]), np.array([128]),
                                    np.array([float(len(a))]), np.array([float(len(b))]))[0]
            true = len(both) / (len(a) + len(b) - len(both))
            errors.append(est - true)
        assert abs(np.mean(errors)) < 0.03


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + \
        [(7, 7), (1, 0), (200, 150), (None, 3), (5, None)]
    got = {r.node: r.label for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | \
        {150: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_the_filter_loses_no_more_than_some_e_10_at_the_threshold():
    from math import comb
    used, size = np.full(129, 128), np.full(129, 1e4)
    for share, most in ((0.85, 5e-10), (0.8, 1e-10)):
        lost = ~shingles.may_reach(np.arange(129), used, size, size, share)
        chance = sum(comb(128, k) * share ** k * (1 - share) ** (128 - k)
                     for k in np.flatnonzero(lost).tolist())
        assert chance < most
