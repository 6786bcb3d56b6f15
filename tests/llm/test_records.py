"""Binary records: round trip, damage, shuffled reads."""

import io
import os
import tempfile

import public_tokenizers
import pytest

from seatcast.llm import records

from . import brute

WORD = public_tokenizers.path("word_bpe_49k.json")
ROWS = [(i, f"Some text {i} " * (i % 7)) for i in range(60)] + [(-5, None), (77, "Ünïcode 'll")]


def folder():
    return os.path.join(tempfile.mkdtemp(prefix="records-"), "out")


def test_round_trip(spark, docs_df):
    path = folder()
    manifest = records.write_records(docs_df(ROWS), path, WORD, end_id=2)
    assert sum(r.n_docs for r in manifest.collect()) == len(ROWS)
    got = records.read_records(spark, path, keep_ids=True).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == brute.records(ROWS)
    assert [r.doc_id for r in got] == sorted(r[0] for r in ROWS)


def test_shuffled_reads_see_every_record_once(spark, docs_df):
    path = folder()
    records.write_records(docs_df(ROWS), path, WORD, end_id=2, wide=True)
    plain = {r.doc_id: (r.start, r.ids) for r in
             records.read_records(spark, path, keep_ids=True).collect()}
    orders = []
    for seed in (1, 2):
        rows = records.read_shuffled(spark, path, seed).collect()
        assert {r.doc_id: (r.start, r.ids) for r in rows} == plain
        orders.append([r.doc_id for r in rows])
    assert orders[0] != orders[1]


def test_repeated_ids_null_ids_and_no_rows(spark, docs_df):
    path = folder()
    records.write_records(docs_df([(3, "b"), (None, "x"), (3, "a"), (3, "a")]), path, WORD,
                          end_id=2)
    assert [r.doc_id for r in records.read_records(spark, path).collect()] == [None, 3, 3, 3]
    empty = folder()
    records.write_records(docs_df([]), empty, WORD, end_id=2)
    assert records.read_records(spark, empty).collect() == []


def test_damage_is_found():
    good = records.frame(b"payload")
    assert records.read_frame(io.BytesIO(good)) == b"payload"
    for i in range(len(good)):
        bad = bytearray(good)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(bytes(bad)))
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(good[:-1]))


def test_a_large_id_needs_four_bytes(spark, docs_df):
    with pytest.raises(Exception, match="wide"):
        records.write_records(docs_df([(1, "a")]), folder(), WORD, end_id=70_000)
