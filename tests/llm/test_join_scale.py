"""What keeps the near-duplicate join's disk in proportion: texts stay, few files of few links."""

import time

import corpus_pipeline
import pytest
from shredloom.llm import ngram_join
from shredloom.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def dealt_out(spark):
    """As many small shuffle partitions as are asked for."""
    held = {"spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    for name, value in held.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def document(k, word=None):
    text = " ".join(f"w{k}x{i}" for i in range(12))
    return (k, text if word is None else f"{text} {word}", "en", "web", len(text))


def test_few_links_leave_few_files(spark, dealt_out):
    links = spark.createDataFrame([(10 * k, 10 * k + 1) for k in range(60)], "a long, b long")
    parts = connected_components(links)
    assert len(parts.inputFiles()) == 1
    assert sorted(map(tuple, parts.collect())) == sorted(
        (10 * k + side, 10 * k) for k in range(60) for side in (0, 1))


def test_texts_stay_where_they_lie(spark, monkeypatch):
    """More documents are kept than may be broadcast, but fewer go."""
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 20)
    copies = [(100 + k, document(k)[1], "en", "web", 1) for k in range(5)]
    docs = spark.createDataFrame([document(k) for k in range(60)] + copies, SCHEMA)
    left = corpus_pipeline.near_stage(spark, docs, "")
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r.doc_id for r in left.collect()) == list(range(60))


def test_a_task_signs_copies_once(spark):
    docs = spark.createDataFrame([document(k % 3) for k in range(90)], SCHEMA).coalesce(1)
    got = ngram_join.read_signatures(docs, "text", 5, 80, 0)
    assert got.select("node").distinct().count() == 3
    assert got.count() == got.distinct().count()


def test_sets_with_the_same_bits_are_told_apart(spark, monkeypatch):
    right = ngram_join.node_of
    monkeypatch.setattr(ngram_join, "node_of", lambda key, seed: right(key, seed) if seed else 1)
    docs = spark.createDataFrame([document(k % 4) for k in range(8)], SCHEMA)
    found = ngram_join.similar_documents(docs)
    assert found.where("component_id != doc_id").count() == 0
    assert found.select("component_id").distinct().count() == 4


def shuffles_on_disk(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllFiles().mkString(",").split(",")
    return {name.rpartition("/")[2].split("_")[1] for name in names if "/shuffle_" in name}


def test_signatures_leave_no_shuffle_files(spark, monkeypatch):
    """In several rounds, with the same signatures found as in one."""
    texts = [document(k % 40, f"end{k}") for k in range(80)]
    docs = spark.createDataFrame(texts, SCHEMA).repartition(3).localCheckpoint()
    sets = ngram_join.read_rows(docs, "doc_id", "text", 5, 0).select("node", "n").localCheckpoint()
    whole = ngram_join.shared_signatures(docs, sets, "text", 5, 80, 0)
    assert len({name.split("/")[-2] for name in whole.inputFiles()}) == 1
    monkeypatch.setattr(ngram_join, "ROUND_FEATURES", 1)
    before = shuffles_on_disk(spark)
    dealt = ngram_join.shared_signatures(docs, sets, "text", 5, 80, 0)
    assert len({name.split("/")[-2] for name in dealt.inputFiles()}) == ngram_join.ROUNDS
    until = time.time() + 30
    # What is left is the sum of features, one row of each task.
    while len(left := shuffles_on_disk(spark) - before) > 1 and time.time() < until:
        time.sleep(0.2)
    assert len(left) <= 1
    found = sorted(map(tuple, dealt.collect()))
    assert found and found == sorted(map(tuple, whole.collect()))


def test_many_that_go_do_not_sort_texts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 5)
    docs = spark.createDataFrame([document(k % 9)[1:] for k in range(90)],
                                 SCHEMA.partition(", ")[2]).selectExpr(
        "monotonically_increasing_id() AS doc_id", "*").localCheckpoint()
    left = corpus_pipeline.near_stage(spark, docs, "")
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert left.count() == 9
