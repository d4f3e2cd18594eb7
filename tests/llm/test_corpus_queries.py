"""The registered corpus queries over whole small tables."""

from __future__ import annotations

import hashlib
import os
from collections import Counter
from pathlib import Path

import corpus
import corpus_pipeline
import oracle_compare
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillflow.llm.catalogue import ORACLE, QUERIES

SF_DIR = os.environ.get("TILLFLOW_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_there_is_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    con = oracle_compare.connect(SF_DIR)
    for table in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    assert oracle_compare.differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


def test_op1(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = set()
    for doc_id, row in docs.items():
        ids = library.encode(row.text)
        expected.add((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert {tuple(r) for r in QUERIES["op1_sentencepiece"](spark, SF_DIR).collect()} == expected


def test_op3(spark, docs):
    found = QUERIES["op3_quality_classifier"](spark, SF_DIR).collect()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert {r.doc_id for r in found} == set(docs)
    clean = [r.kept for r in found if r.doc_id in labels and labels[r.doc_id].quality and not labels[r.doc_id].toxic]
    junk = [r.kept for r in found if r.doc_id in labels and not labels[r.doc_id].quality]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.4 * len(junk)


def test_op4(spark, docs):
    keys = sorted(docs)
    sets = [corpus.shingle_set(docs[k].text) for k in keys]
    roots = corpus.classes(len(keys), corpus.shingle_links(sets))
    expected = {(k, len(s), keys[r]) for k, s, r in zip(keys, sets, roots)}
    assert {tuple(r) for r in QUERIES["op4_ngram_jaccard_join"](spark, SF_DIR).collect()} == expected


def test_op5(spark, docs):
    found = QUERIES["op5_sharding"](spark, SF_DIR).collect()
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((k, len(r.text.encode()) + 8) for k, r in docs.items())
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    per, most = Counter(), max(r["size"] for r in found)
    for r in found:
        per[r.shard] += r["size"]
    mean = sum(per.values()) / 24
    # Of rows in one order, a shard misses the mean by one row at most.
    assert all(abs(per[s] - mean) <= most + 0.01 * mean for s in range(24))


def test_op6(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    count = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    expected = {(k, len(r.text.encode()), n := count(r.text), n > 2048) for k, r in docs.items()}
    assert {tuple(r) for r in QUERIES["op6_token_counts"](spark, SF_DIR).collect()} == expected


def test_op7(spark, docs):
    found = QUERIES["op7_mixing"](spark, SF_DIR).collect()
    taken, target = Counter(), {}
    for r in found:
        source = docs[r.doc_id].source
        taken[source] += r.taken
        target[source] = r.target
        assert r.taken <= 3 * r["size"]
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in found))
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())


def test_op8(spark, docs):
    found = QUERIES["op8_token_output"](spark, SF_DIR).collect()
    assert sorted(r.slot for r in found) == list(range(len(found)))
    assert {k for r in found for k in r.doc_ids} == set(docs)


def test_op9(spark, docs):
    found = QUERIES["op9_language_id"](spark, SF_DIR).collect()
    held = [r.lang_pred == docs[r.doc_id].lang for r in found if r.held_out]
    assert len(found) == len(docs) and sum(held) >= 0.9 * len(held)


def test_pipeline_stages_take_effect(spark, docs):
    kept, columns = spark.read.parquet(f"{SF_DIR}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SF_DIR).checkpoint()
        rows = kept.collect()
        if name in ("quality_classifier", "exact_dedup", "ngram_jaccard_join"):
            assert kept.columns == before.columns
            assert not kept.exceptAll(before).head(1)
        if name == "exact_dedup":
            assert len({r.text for r in rows}) == len(rows) == before.select("text").distinct().count()
        if name == "ngram_jaccard_join":
            assert not list(corpus.shingle_links([corpus.shingle_set(r.text) for r in rows]))
        if name == "mixing":
            assert max(Counter(r.doc_id for r in rows).values()) <= 3
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in rows:
        assert list(r.ids) == library.encode(docs[r.doc_id].text) and r.text == library.decode(list(r.ids))
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(rows)
