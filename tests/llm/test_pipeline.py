"""The registered queries and the pipeline on the smallest tables."""

import hashlib
import zlib

import pytest

import __spark_entry__ as entries
import corpus_pipeline
from parlance.llm import packing
from parlance.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_all_are_registered():
    assert set(QUERIES) <= set(entries.queries())
    assert [f"op{n}_" for n in range(1, 14)] == [q.split("_")[0] + "_" for q in QUERIES if q.startswith("op")]


def test_stages_keep_the_columns(spark, docs):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    rows, counts = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, FOLDER)
        assert rows.columns == docs.columns
        counts.append(rows.count())
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > 0.8 * counts[0]
    before = {r.doc_id: r.text for r in docs.collect()}
    assert all(before[r.doc_id] == r.text for r in rows.collect())


def test_run_packs_the_mix(spark, docs):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    tokenizer = packing.load_tokenizer(packing.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for r in got[:50]:
        ids = packing.np.append(packing.encode(tokenizer, texts[r.doc_id]), packing.np.array([0], "<u4"))
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    copies = {}
    for r in got:
        copies[r.doc_id, r.piece] = copies.get((r.doc_id, r.piece), 0) + 1
    assert set(copies.values()) <= {1, 2}


def test_stages_take_empty_and_null_rows(spark, docs):
    extra = spark.createDataFrame([(None, None, None, None, None), (-5, "", None, "s", 0), (-5, "", "en", None, 0)], docs.schema)
    for rows in (docs.where("false"), extra):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, FOLDER).count() <= 2 * rows.count()


def test_reply_trees_query(spark):
    from checks.compare import compare, connect

    ok, note = compare(spark, connect(FOLDER), FOLDER, "chat_reply_trees")
    assert ok, note


def test_chat_query(spark):
    got = {r.conv_id: r for r in QUERIES["op8_chat"](spark, FOLDER).collect()}
    said = "</s>[INST] ok [/INST]"
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (got[-1].n_turns, got[-1].loss_chars) == (2, len(said))
