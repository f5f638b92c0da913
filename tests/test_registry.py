"""Every registered query against its SQL, and the row counts known from the test tables."""

import pytest

import __spark_entry__ as registry
from compare import connect, differences
from tallymark.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, name) is None


@pytest.mark.parametrize(
    "name",
    "export_pmc stats_pmc export_pmc_merchant_id export_mpos stats_mpos_grouped export_trx stats_trx matched_ids "
    "unmatched_key_date match_reference".split(),
)
def test_query_equals_sql_without_broadcast(spark, con, name, no_broadcast):
    assert differences(spark, con, SF_DIR, name) is None


@pytest.mark.parametrize("name", "export_pmc stats_pmc export_mpos stats_mpos_grouped export_trx_merchant_id".split())
def test_query_equals_sql_with_narrowed_ledger(spark, con, name, large_ledger):
    assert differences(spark, con, SF_DIR, name) is None


def metrics(df):
    return [(r["metric"], r["value"]) for r in df.collect()]


def test_known_counts(spark):
    q = registry.queries()
    assert registry.entry(spark).count() == 2014
    assert q["export_mpos"](spark, SF_DIR).count() == 2554
    assert q["export_trx"](spark, SF_DIR).count() == 5943
    assert q["matched_ids"](spark, SF_DIR).count() == 1123
    assert q["dedup_key_date"](spark, SF_DIR).count() == 1066
    assert metrics(q["stats_pmc"](spark, SF_DIR)) == [
        ("input", 799),
        ("output_declared", 799),
        ("not_found", 552),
        ("output_rows", 2014),
    ]
    assert metrics(q["stats_trx"](spark, SF_DIR)) == [
        ("input", 6000),
        ("output_declared", 6000),
        ("not_found", 4877),
        ("output_rows", 5943),
    ]
    groups = [v for m, v in metrics(q["stats_mpos_grouped"](spark, SF_DIR)) if m == "not_found"]
    assert (len(groups), sum(groups)) == (435, 4744)  # each merchant's orders are its acquirer links
