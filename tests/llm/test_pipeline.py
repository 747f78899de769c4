"""The pipeline and the registered queries."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plotloom.llm import quality
from plotloom.llm.queries import QUERIES
from plotloom.session import BATCH_ROWS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COMMON = "the of and to in is that for it as with be by on are".split()


def sentence(draw, words):
    own = [draw.choice(COMMON) if draw.random() < 0.35 else "".join(draw.choices("abcdefghilmnorst", k=draw.randrange(3, 9))) for _ in range(words)]
    return " ".join(own) + "."


def text_of(draw, lines):
    return "\n".join(sentence(draw, draw.randrange(8, 16)) for _ in range(lines))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(11)
    texts = {i: text_of(draw, draw.randrange(4, 20)) for i in range(120)}
    item = sentence(draw, 30)
    shared = text_of(draw, 3)
    texts[200] = texts[5]
    texts[201] = texts[6].replace("the", "a", 1)
    texts[202] = text_of(draw, 3) + "\n" + shared + "\n" + text_of(draw, 3)
    texts[203] = text_of(draw, 4) + "\n" + shared
    texts[204] = text_of(draw, 3) + "\n" + item + "\n" + text_of(draw, 2)
    texts[205] = " ".join(w.upper() + "!!" for w in sentence(draw, 60).split())
    texts[206] = "word " * 120
    texts[207] = None
    texts[208] = ""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()] + [(None, text_of(draw, 5), None, None, None)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, shared, item


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]


def test_decisions_take_effect(spark, folder, tmp_path):
    path, texts, shared, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == columns
        result.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append({r.doc_id: r for r in docs.collect()})
    good, lined, single, clean, tokens = seen
    assert not {205, 206, 207, 208} & set(good) and {*range(120), None} <= set(good)
    assert shared in lined[202].text and shared not in lined[203].text
    assert lined[203].n_chars == len(lined[203].text) and lined[200].text == ""
    # An exact copy has lost all its lines to the first one; of a near copy the least stays.
    assert 201 not in single or not single[201].text or 6 in single
    assert 204 in single and 204 not in clean and set(single) - set(clean) == {204}
    assert {i: r.decoded for i, r in tokens.items()} == {i: r.text or "" for i, r in clean.items()}
    assert all(r.n_tokens == len(r.ids) for r in tokens.values())
    whole = {r.doc_id: r.decoded for r in corpus_pipeline.run(spark, path).collect()}
    assert whole == {i: r.decoded for i, r in tokens.items()}


def test_near_dedup_stage_keeps_one_of_each_group(spark, folder):
    path, texts, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, path).collect()}
    assert {5, 6} <= kept and not {200, 201, 208} & kept
    assert set(range(120)) <= kept and None in kept and 207 in kept


def test_empty_documents(spark, folder, tmp_path):
    path, *_ = folder
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no driver tables")
@pytest.mark.parametrize("name", ["op5_quality", "op7_fingerprints", "op8_near_dedup", "op9_lm_scoring", "op10_secret_scan", "op13_license_scan"])
def test_one_row_per_document(spark, name):
    folder = "/root/testdata/sf0.001"
    ids = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id")
    found = QUERIES[name](spark, folder).select("doc_id")
    assert found.exceptAll(ids).count() == 0 and ids.exceptAll(found).count() == 0


def test_quality_stage_passes_all_columns(spark, folder):
    path, *_ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("score", F.lit("own"))
    kept = corpus_pipeline.keep_good_quality(spark, docs.drop("score"), path)
    assert kept.columns == docs.columns[:-1]


def plan_of(frame, capsys):
    capsys.readouterr()
    frame.explain()
    return capsys.readouterr().out


def test_encoding_and_decoding_are_separate_steps(spark, folder, capsys):
    path, *_ = folder
    plan = plan_of(corpus_pipeline.encode_and_decode(spark, spark.read.parquet(f"{path}/documents.parquet"), path), capsys)
    # One Python worker a task: ids are decoded from what is materialised.
    assert plan.count("MapInArrow") == 1 and "CoGroup" not in plan


def test_decontamination_takes_no_other_python_workers(spark, folder, capsys):
    path, *_ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    plan = plan_of(corpus_pipeline.drop_contaminated(spark, docs, path), capsys)
    assert plan.count("MapInArrow") == 1 and "ExistingRDD" not in plan


def test_the_scorer_is_trained_on_short_batches(spark, folder, monkeypatch):
    path, *_ = folder
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, votes_of = spark.conf.get(name), [], quality.vote_counts

    def counted(docs):
        seen.append(spark.conf.get(name))
        return votes_of(docs)

    monkeypatch.setattr(quality, "vote_counts", counted)
    quality.train(spark.read.parquet(f"{path}/documents.parquet"))
    assert seen == [str(BATCH_ROWS)] and spark.conf.get(name) == before
