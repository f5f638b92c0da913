"""A run's outputs appear together, and its tables go."""

from pathlib import Path

import pytest
from conftest import authorization
from pyspark.errors import StreamingQueryException
from test_sources import line, write

from tallymark.plans import pmc
from tallymark.plans.run import reconcile, run
from tallymark.sinks.publish import manifest
from tallymark.sources import scratch
from tallymark.sources.layouts import PMC
from tallymark.sources.scratch import run_scratch, scratch_path, write_through
from tallymark.streaming import drop_folder


@pytest.fixture
def shared(tmp_path, monkeypatch):
    (tmp_path / "shared").mkdir()
    monkeypatch.setattr(scratch, "scratch_folder", lambda _: str(tmp_path / "shared"))
    return tmp_path / "shared"


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def refuse(*_):
    raise RuntimeError("no statistics today")


def test_a_run_leaves_its_outputs_and_no_tables(spark, tmp_path, make_ledger, shared):
    file = write(tmp_path / "a_pmc.csv", PMC, line(PMC, nro_orden="k"), line(PMC, nro_orden="x"))
    out = tmp_path / "out"
    assert run(spark, file, make_ledger(autorizacion=[authorization(1, "k")]), str(out)).lines == 2
    assert names(out) == ["EST_a_pmc.csv.log", "OUT_a_pmc.csv"]
    assert names(shared) == []
    told = manifest(spark, str(out), "OUT_a_pmc.csv")
    assert (told["layout"], told["lines"], told["rejected"], told["outputs"]) == (PMC.name, 2, 0, names(out))
    assert manifest(spark, str(out), "OUT_other") is None
    assert spark.read.option("header", True).csv(str(out / "OUT_a_pmc.csv")).count() == 2


def test_a_failed_statistic_leaves_no_export(spark, tmp_path, make_ledger, shared, monkeypatch):
    file = write(tmp_path / "a_pmc.csv", PMC, line(PMC, nro_orden="k"))
    monkeypatch.setattr(pmc, "statistics", refuse)
    with pytest.raises(RuntimeError, match="today"):
        reconcile(spark, file, make_ledger(), str(tmp_path / "out"))
    assert names(tmp_path / "out") == [] and names(shared) == []


def test_a_failed_run_keeps_the_outputs_before_it(spark, tmp_path, make_ledger, shared, monkeypatch):
    file, out = write(tmp_path / "a_pmc.csv", PMC, line(PMC, nro_orden="k")), tmp_path / "out"
    reconcile(spark, file, make_ledger(), str(out))
    before = manifest(spark, str(out), "OUT_a_pmc.csv")
    monkeypatch.setattr(pmc, "statistics", refuse)
    with pytest.raises(RuntimeError, match="today"):
        reconcile(spark, file, make_ledger(), str(out))
    assert manifest(spark, str(out), "OUT_a_pmc.csv") == before and names(out) == before["outputs"]


def test_what_an_earlier_run_rejected_goes_with_it(spark, tmp_path, make_ledger, shared):
    out = tmp_path / "out"
    file = write(tmp_path / "a_pmc.csv", PMC, line(PMC, nro_orden="k") + ",one,more")
    assert run(spark, file, make_ledger(), str(out)).rejected == 1
    assert names(out) == ["EST_a_pmc.csv.log", "OUT_a_pmc.csv", "REJ_a_pmc.csv"]
    write(tmp_path / "a_pmc.csv", PMC, line(PMC, nro_orden="k"))
    assert run(spark, file, make_ledger(), str(out)).rejected == 0
    assert names(out) == ["EST_a_pmc.csv.log", "OUT_a_pmc.csv"]


def test_scratch_of_runs_inside_runs(spark, shared):
    with run_scratch(spark) as outer:
        with run_scratch(spark) as inner:
            assert inner.startswith(outer + "/") and write_through(spark.range(3), "t").count() == 3
        assert scratch_path(spark, "t").startswith(outer + "/t-") and names(Path(outer)) == []
    assert names(shared) == [] and not scratch_path(spark, "t").startswith(outer)


def test_an_error_that_is_not_the_files_is_tried_again(spark, tmp_path, make_ledger, monkeypatch):
    """The other files of the batch are done all the same, and the next call takes the batch once more."""
    (tmp_path / "in").mkdir()
    for name in ("a", "b", "c"):
        write(tmp_path / "in" / f"{name}_pmc.csv", PMC, line(PMC, nro_orden="k"))
    out, lost = tmp_path / "out", [True]

    def sometimes(session, path, *args, **options):
        if path.endswith("/b_pmc.csv") and lost:
            lost.clear()
            raise ConnectionError("the cluster is gone")
        return reconcile(session, path, *args, **options)

    def together(*_, **__):
        raise ConnectionError("the cluster is gone")

    monkeypatch.setattr(drop_folder, "reconcile", sometimes)
    monkeypatch.setattr(drop_folder, "run_files", together)

    def arrivals():
        drop_folder.reconcile_arrivals(spark, str(tmp_path / "in"), make_ledger(), str(out), str(tmp_path / "state")).awaitTermination()
        return [n for n in names(out) if n.startswith(("OUT_", "FAILED_"))]

    with pytest.raises(StreamingQueryException, match="the cluster is gone"):
        arrivals()
    assert [n for n in names(out) if n.startswith("OUT_")] == ["OUT_a_pmc.csv", "OUT_c_pmc.csv"]
    assert arrivals() == ["OUT_a_pmc.csv", "OUT_b_pmc.csv", "OUT_c_pmc.csv"]
