"""The pipeline's stages on a small corpus, each against its rule."""

import os
import random
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from seatcast.llm import linedup, quality, stages  # noqa: E402

from . import brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "an be con di en fa go hi in jo ka lo mi nu or pa qui re su ta".split()


@pytest.fixture(scope="module")
def sf_dir(spark):
    rnd = random.Random(1)
    line = lambda n: " ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 4)))
                              for _ in range(n))
    items = [(i, line(30)) for i in range(6)]
    rows = []
    for i in range(60):
        text = [line(rnd.randint(8, 30)) for _ in range(rnd.randint(4, 9))]
        if i % 3 == 0:
            text.insert(2, "please subscribe to our weekly letter")
        if i % 20 == 0:
            text.insert(1, items[i // 20][1])
        rows.append("\n".join(text))
    rows += rows[:4] + [rows[5] + " and more", rows[6].replace(" ", "  ", 1)]    # copies
    rows += ["spam " * 300, "", "short text", None]
    table = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(rows)]
    path = tempfile.mkdtemp(prefix="pipeline-")
    spark.createDataFrame(table, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return path


def test_stages(spark, sf_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontaminate", "pack"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    import zstandard
    compressor = zstandard.ZstdCompressor(level=quality.LEVEL)
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        if name != "pack":
            assert out.columns == docs.columns and out.schema == docs.schema
            after = {r.doc_id: r.text for r in rows}
            assert after.keys() <= before.keys() and len(rows) == len(after)
        if name == "quality":
            assert after.keys() == {d for d, t in before.items()
                                    if quality.measure(t or "", compressor)[6]}
        elif name == "line_dedup":
            assert sum("weekly letter" in t for t in before.values()) > 10
            assert sum("weekly letter" in t for t in after.values()) == 1
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "near_dedup":
            near = brute.near(list(before.items()))
            assert after.keys() == {d for d, v in near.items() if v[1] == d}
            assert len(after) < len(before)
        elif name == "decontaminate":
            hit = brute.contaminated(list(before.items()), items)
            assert after.keys() == {d for d, v in hit.items() if not v[4]}
            assert len(after) < len(before)
        else:
            assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == \
                brute.pieces(list(before.items()))
        if name != "pack":
            docs = spark.createDataFrame(rows, docs.schema)
    assert linedup.MIN_DOCS == 5


def test_near_dedup_takes_pairs_from_80_percent_on(spark):
    # 96 shingles of 100 words; copies with 20 and with 28 words more
    words = [f"w{i}" for i in range(128)]
    rows = [(1, " ".join(words[:100])), (2, " ".join(words[:120])),
            (3, " ".join(f"x{w}" for w in words[:100])), (4, " ".join(f"x{w}" for w in words))]
    near = brute.near(rows, 80)
    assert near[2][1] == 1 != brute.near(rows, 85)[2][1] and near[4][1] == 4
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = stages.near_dedup(spark, docs, "").collect()
    assert {r.doc_id for r in got} == {1, 3, 4}


def test_run_applies_all_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    key = ["doc_id", "piece", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select(key).collect())) == \
        sorted(map(tuple, docs.select(key).collect()))


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.collect() == []


def test_every_query_is_registered():
    names = E.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
