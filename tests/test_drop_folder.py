from conftest import authorization
from test_sources import line, write

from tallymark.sources.layouts import MPOS, PMC
from tallymark.streaming.drop_folder import reconcile_arrivals


def test_every_file_is_reconciled_once(spark, tmp_path, make_ledger):
    ledger = make_ledger(autorizacion=[authorization(1, "k")])
    (tmp_path / "in").mkdir()
    out = tmp_path / "out"

    def arrivals():
        query = reconcile_arrivals(spark, str(tmp_path / "in"), ledger, str(out), str(tmp_path / "state"))
        query.awaitTermination()
        return sorted(p.name for p in out.iterdir())

    write(tmp_path / "in" / "a_pmc.csv", PMC, line(PMC, nro_orden="k"))
    write(tmp_path / "in" / "other.csv", PMC, line(PMC, nro_orden="k"))
    first = ["EST_a_pmc.csv.log", "OUT_a_pmc.csv"]
    assert arrivals() == first
    written = (out / "OUT_a_pmc.csv" / "_SUCCESS").stat().st_mtime
    write(tmp_path / "in" / "b_mpos.csv", MPOS, line(MPOS, id_operacion="k"))
    assert arrivals() == sorted([*first, "EST_b_mpos.csv.log", "OUT_b_mpos.csv"])
    assert (out / "OUT_a_pmc.csv" / "_SUCCESS").stat().st_mtime == written


def test_a_bad_file_does_not_stop_the_others(spark, tmp_path, make_ledger):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "good_pmc.csv", PMC, line(PMC, nro_orden="k"))
    write(tmp_path / "in" / "bad_mpos.csv", MPOS, line(MPOS, RUC='"open', id_operacion="k"))
    out = tmp_path / "out"
    query = reconcile_arrivals(spark, str(tmp_path / "in"), make_ledger(), str(out), str(tmp_path / "state"), strict=True)
    query.awaitTermination()
    assert (out / "OUT_good_pmc.csv" / "_SUCCESS").exists()
    failed = spark.read.json(str(out / "FAILED_0")).collect()
    assert [(r["path"].rsplit("/", 1)[-1], r["error"]) for r in failed] == [("bad_mpos.csv", "BrokenStatement")]
