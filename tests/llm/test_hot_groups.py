"""One key on a third of all rows: groups of equal texts and of rows that repeat an id and a text."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark.llm import exact_dedup, mixing

HOT = 300


@pytest.fixture(scope="module")
def docs(spark):
    """A third of the rows have neither id nor text of their own; columns are named as helpers inside the operators are."""
    rows = [(None, "a b c", "hot", 1)] * HOT + [(i, f"w{i} " * (i % 7 + 1), "cold" if i % 2 else None, 2) for i in range(2 * HOT)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, _rows int").repartition(5)


def test_repeated_rows_share_their_copies(docs, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 7)
    taken = Counter()
    for row in mixing.mix(docs).select("doc_id", "copies").collect():
        taken[row.doc_id] += row.copies
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = Counter(row.doc_id for row in mixed.collect())
    assert got == Counter({k: n for k, n in taken.items() if n}) and got[None] > HOT // 10


def test_numbers_are_dense(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 7)
    rows = spark.range(100).select(F.lit("").alias("_id"), (F.col("id") % 2).alias("_hash"), F.lit(50).cast("long").alias("_rows"), F.col("id").alias("_row"))
    got = mixing.numbered(rows).groupBy("_hash").agg(F.sort_array(F.collect_list("_number")).alias("n")).collect()
    assert [row.n for row in got] == [list(range(1, 51))] * 2


def test_rates_that_do_not_settle_are_an_error(docs, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    with pytest.raises(RuntimeError, match="settle"):
        mixing.mix(docs)


def test_hot_text_is_split(spark, docs, conf):
    """The join that tells rows their group has its exchange right below the sort on both sides, as splitting needs."""
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    found = exact_dedup.exact_dedup(docs)
    lines = [line.strip(" +-:*()0123456789") for line in found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()]
    joins = [k for k, line in enumerate(lines) if line.startswith("SortMergeJoin")]
    sorts = [k for k, line in enumerate(lines) if line.startswith("Sort [")]
    assert joins and len(sorts) == 2 and all(lines[k + 1].startswith("Exchange hashpartitioning") for k in sorts)
    groups = {(row.keep_id, row.group_size) for row in found.collect() if row.doc_id is None}
    assert groups == {(None, HOT)}
