"""Packing: brute-force pieces, valid sequences, local search against best fit."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa

from seatcast.llm import common, packing

from . import brute

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def valid(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


def test_pieces_and_sequences(spark, docs_df):
    rnd = random.Random(1)
    words = "alpha beta gamma delta's 12 ünder <|endoftext|>".split()
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 60)))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "x " * 500), (903, "word " * 64)]
    got = packing.pack(docs_df(rows), BYTE, end_id=2, capacity=64, group=32, keep_ids=True)
    got = got.collect()
    want = brute.pieces(rows, capacity=64)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    n = valid(got, 64)
    least = -(-sum(r.length for r in got) // 64)
    assert least <= n <= 1.05 * least + 2          # groups of 32 pieces, merged by rounds


def test_sequences_join_their_pieces(spark, docs_df):
    packed = packing.pack(docs_df([(1, "a b c"), (2, "d e"), (3, "f " * 30)]), BYTE, end_id=2,
                          capacity=16, keep_ids=True)
    whole = packing.sequences(packed).collect()
    assert all(len(r.ids) == 4 * r.length <= 64 for r in whole)
    assert sum(r.length for r in whole) == sum(r.length for r in packed.collect())


def test_repeated_rows_null_ids_and_no_rows(spark, docs_df):
    rows = [(1, "same text")] * 3 + [(None, "no id"), (None, None)]
    got = packing.pack(docs_df(rows), BYTE, end_id=2).collect()
    assert len(got) == 5 and valid(got, 1024) == 1
    assert sum(r.doc_id is None for r in got) == 2
    assert packing.pack(docs_df([]), BYTE, end_id=2).collect() == []


def test_local_search_saves_bins_and_loses_nothing():
    saved = 0
    for seed in range(4):
        rnd = random.Random(seed)
        lengths = [rnd.randint(200, 700) for _ in range(600)] + [1, 1024, 1023]
        first = packing.best_fit(lengths, 1024)
        last = packing.local_search([list(b) for b in first], lengths, 1024)
        for bins in (first, last):
            assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
            assert max(sum(lengths[i] for i in b) for b in bins) <= 1024
        squares = [sum(np.square([sum(lengths[i] for i in b) for b in bins]))
                   for bins in (first, last)]
        assert squares[1] >= squares[0]
        saved += len(first) - len(last)
    assert saved > 0


def test_pieces_that_fit_with_nothing_end_the_rounds(spark, docs_df):
    # 300 pieces of 37 ids and 6 of 25: one of a group of 32 can be filled to 98 % nowhere
    rows = [(i, "word " * 36) for i in range(300)] + [(900 + i, "word " * 24) for i in range(6)]
    got = packing.pack(docs_df(rows), BYTE, end_id=2, capacity=64, group=32).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in rows)
    lengths = sorted({r.length for r in got})
    assert len(lengths) == 2 and 2 * lengths[1] > 64 >= sum(lengths)
    # what is left over of all groups still meets
    assert 300 <= valid(got, 64) <= 301


def test_a_round_takes_the_emptiest_bins():
    assert packing.emptiest({600: 900}, 750) == (0, 0)
    assert packing.emptiest({900: 800, 300: 4, 700: 100}, 750) == (700, 104)
    assert packing.emptiest({}, 10) == (0, 0)


def test_small_slices_and_batches_give_the_same_pieces(spark, docs_df):
    rows = [(i, f"word{i % 7} " * (i % 300)) for i in range(400)]
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    want = sorted(map(tuple, packing.pieces(docs_df(rows), BYTE, end_id=2).select(*own).collect()))
    with common.small_batches(spark, 4096):
        got = packing.pieces(docs_df(rows), BYTE, end_id=2, slice_bytes=500).select(*own).collect()
        most = docs_df(rows).coalesce(1).mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0]
    assert sorted(map(tuple, got)) == want
    assert most < 20_000 < sum(len(t) for _, t in rows)
    assert spark.conf.get(key, None) == before
