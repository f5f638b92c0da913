"""The pipeline: one Python worker per task, which holds few texts at once."""

import numpy as np
import pyarrow as pa

from tallymark.llm import features, near_dedup, toxicity


def test_a_task_of_the_sample_has_one_python_worker(spark):
    """Copies are told in a step of their own, before a function of the sample's rows runs."""
    rows = [(k, f"some words of text {k // 2}", k % 2) for k in range(8)]
    sample = toxicity.distinct_sample(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    counted = sample.mapInPandas(lambda batches: batches, sample.schema)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "ArrowEvalPython" not in plan
    assert counted.count() == 8


def test_texts_are_taken_a_few_at_a_time():
    batches = [pa.record_batch({"k": range(1000)}), pa.record_batch({"k": range(0)}), pa.record_batch({"k": range(1000, 1003)})]
    batches = [b.cast(pa.schema({"k": pa.int64()})) for b in batches]
    parts = list(features.in_parts(iter(batches)))
    assert max(map(len, parts)) <= features.PART_ROWS < 1000
    assert [k for part in parts for k in part["k"].to_pylist()] == list(range(1003))


def test_no_step_makes_a_whole_batch_pandas(spark):
    """Texts of near duplicates and of scores come in Arrow, which is sliced."""
    docs = spark.createDataFrame([(k, f"some words of text {k}") for k in range(600)], "doc_id long, text string")
    prints = near_dedup.fingerprints(docs)
    plan = prints._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
    assert {(r.doc_id, r.n_shingles, len(r.bands)) for r in prints.collect()} == {(k, 1, near_dedup.BANDS) for k in range(600)}
    weights = np.random.default_rng(0).normal(size=toxicity.VOTERS + toxicity.BUCKETS)
    model = toxicity.Toxicity({}, weights=weights)
    scored = {r.doc_id: r._score for r in toxicity._scored(docs, model, ["doc_id"]).collect()}
    assert [scored[k] for k in range(600)] == model.score([f"some words of text {k}" for k in range(600)]).tolist()


def test_large_ids_stay_beside_null_ids(spark):
    """In pandas, ids with a NULL among them are floats, which tell no numbers beyond 2 ** 53 apart."""
    docs = spark.createDataFrame([(2**53 + 1, "a b c"), (None, "x y")], "doc_id long, text string").coalesce(1)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {(2**53 + 1, 1, 2**53 + 1, True), (None, 1, None, True)}
