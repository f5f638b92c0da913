"""The part of the ledger that a statement needs: read once, by codes and days, and wide rows moved last."""

import datetime as dt
import random
import re

import pytest
from conftest import authorization, local_frame, transaction
from pyspark.sql import functions as F
from test_sources import line, write

from tallymark.operators import code_filter, match
from tallymark.operators.profile import day_ranges, profile, within_days
from tallymark.operators.reduce import Reduced
from tallymark.plans import mpos, pmc, transacciones
from tallymark.plans.run import reconcile
from tallymark.sources.layouts import MPOS, PMC, STATE, TRANSACCIONES
from tallymark.sources.ledger import Ledger

LAYOUTS = (PMC, MPOS, TRANSACCIONES)
PLANS = {PMC.name: pmc, MPOS.name: mpos, TRANSACCIONES.name: transacciones}


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def executions(spark):
    """What this application has run, in order, from the driver's own list."""
    return spark._jsparkSession.sharedState().statusStore().executionsList()


def scans(spark, folder, since):
    """Scans of a folder's files, each as its plan describes it, in the plans that ran from the execution ``since`` on."""
    found, run = [], executions(spark)
    for k in range(since, run.size()):
        plan = run.apply(k).physicalPlanDescription()
        tree = plan.split("\n\n")[0].split("== Initial Plan ==")[0]
        for number in re.findall(r"Scan parquet *\((\d+)\)", tree):
            told = re.search(rf"\({number}\) Scan parquet(.*?)\n\n", plan, re.DOTALL)[1]
            found += [told] if f"{folder}]" in told else []
    return found


@pytest.fixture
def stored_ledger(spark, tmp_path, make_ledger):
    tables = dict(
        autorizacion=[authorization(i, f"k{i % 40}", ref_id=f"r{i % 3}", exitosa=i % 2) for i in range(120)],
        transaccion=[transaction(i, history=1 + i % 3) for i in range(0, 120, 2)],
    )
    for name, df in vars(make_ledger(**tables)).items():
        if not name.startswith("_") and hasattr(df, "write"):
            df.write.parquet(str(tmp_path / "ledger" / name))
    return Ledger.from_parquet(spark, str(tmp_path / "ledger"))


@pytest.mark.parametrize("layout", LAYOUTS, ids=lambda layout: layout.name)
def test_a_run_reads_the_authorizations_once(spark, tmp_path, stored_ledger, layout):
    """One scan for export and statistics together, with the columns they need and no others, and the code's filter pushed."""
    rows = [line(layout, **{layout.key: f"k{i}", **({"trx_date": "2024-05-01", "id": "x"} if layout.day else {})}) for i in range(0, 60, 3)]
    file = write(tmp_path / f"a_{layout.name.lower()}.csv", layout, *rows)
    before = executions(spark).size()
    assert reconcile(spark, file, stored_ledger, str(tmp_path / "out")) is layout
    (scan,) = scans(spark, "/ledger/autorizacion", before)
    assert f"IsNotNull({layout.ledger_key})" in scan
    if layout.day:
        assert "GreaterThanOrEqual(fecha_hora_creacion,2024-05-01" in scan


@pytest.mark.parametrize("layout", LAYOUTS, ids=lambda layout: layout.name)
def test_shared_and_own_ledger_give_the_same(make_ledger, make_lines, layout):
    rng = random.Random(layout.name)
    ledger = make_ledger(
        autorizacion=[authorization(i, rng.choice(["", "a", "b", "c", "d"]), ref_id=rng.choice(["r", "s"])) for i in range(30)],
        transaccion=[transaction(i, history=rng.choice([1, 2, 3])) for i in range(0, 30, 2)],
    )
    lines = make_lines(layout, *({layout.key: rng.choice(["a", "b", "x", ""]), **({"trx_date": "2024-05-01", "id": rng.choice("pq")} if layout.day else {})} for _ in range(20)))
    plan = PLANS[layout.name]
    found = plan.reduced(lines, ledger, shared=True)
    for output in (plan.export, plan.statistics):
        assert sorted(map(str, output(lines, ledger, found).collect())) == sorted(map(str, output(lines, ledger).collect()))


@pytest.mark.parametrize("limits", [(128 << 20, 128 << 20), (-1, 128 << 20), (-1, -1)], ids=["broadcast", "filter", "neither"])
@pytest.mark.parametrize("layout", LAYOUTS, ids=lambda layout: layout.name)
def test_every_way_to_reduce_the_ledger(make_ledger, make_lines, monkeypatch, layout, limits):
    monkeypatch.setattr(match, "MAX_BROADCAST_BYTES", limits[0])
    monkeypatch.setattr(code_filter, "MAX_FILTER_BYTES", limits[1])
    ledger = make_ledger(autorizacion=[authorization(i, f"k{i}") for i in range(300)], transaccion=[transaction(i) for i in range(300)])
    day = {"trx_date": "2024-05-01", "id": "x"} if layout.day else {}
    lines = make_lines(layout, *({layout.key: f"k{i}", **day} for i in range(0, 600, 20)), {layout.key: ""}, {layout.key: None})
    found = PLANS[layout.name].reduced(lines, ledger)
    assert (found.small, found.filtered) == (limits[0] > 0, limits[0] < 0 < limits[1])
    assert found.matching.count() == 15 if found.small else found.matching.count() < (40 if found.filtered else 301)
    got = {r[layout.key]: r[STATE] for r in PLANS[layout.name].export(lines, ledger).collect()}
    assert {k: v for k, v in got.items() if k} == {f"k{i}": "Pagado" if i < 300 else "" for i in range(0, 600, 20)}
    assert [r["value"] for r in PLANS[layout.name].statistics(lines, ledger).collect()][0] == 32


def test_wide_authorizations_are_shuffled_three_times_at_most(make_ledger, make_lines, no_broadcast, conf):
    """For their group, for what was looked up by id, and for the lines; without any broadcast but that of the filter."""
    conf(spark__sql__adaptive__enabled="false")
    ledger = make_ledger(autorizacion=[authorization(i, f"k{i}") for i in range(50)], transaccion=[transaction(i) for i in range(50)])
    for layout in (PMC, MPOS):
        lines = make_lines(layout, *({layout.key: f"k{i}"} for i in range(9)))
        assert Reduced(lines, ledger, layout).filtered
        exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning", formatted(PLANS[layout.name].export(lines, ledger)))
        wide = [e for e in exchanges if "hash_tarjeta" in e]
        assert 1 <= len(wide) <= 3


def test_the_filter_loses_no_code(spark):
    """One row in a hundred of others gets through; the size is known from the number of codes."""
    codes = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") * 7).alias("_key"))
    found = code_filter.code_filter(codes, 20_000).cache()
    assert found.count() <= code_filter._blocks(20_000) == 8
    rows = spark.range(140_000).select(F.concat(F.lit("k"), "id").alias("code"), (F.col("id") % 7 == 0).alias("known"))
    passed = {r["known"]: r["n"] for r in code_filter.may_match(rows, [F.col("code")], found, 20_000).groupBy("known").agg(F.count("*").alias("n")).collect()}
    assert passed[True] == 20_000 and passed[False] < 0.02 * 120_000
    assert code_filter.filter_fits(89_000_000) and not code_filter.filter_fits(90_000_000)


def test_a_filter_of_codes_and_days(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(30)]
    keys = local_frame(spark, [{"_key": f"k{k}", "_day": days[k]} for k in range(30)], [("_key", "string"), ("_day", "date32")])
    found = code_filter.code_filter(keys, 30)
    assert code_filter.may_match(keys, [F.col("_key"), F.col("_day")], found, 30).count() == 30
    others = keys.withColumn("_day", F.date_add("_day", 1))
    assert code_filter.may_match(others, [F.col("_key"), F.col("_day")], found, 30).count() < 3


def ranges(spark, days, **most):
    return day_ranges(local_frame(spark, [{"_day": d} for d in days], [("_day", "date32")]), **most)


def test_days_are_ranges_cut_at_the_widest_gaps(spark):
    d = lambda text: dt.date.fromisoformat(text)
    days = [d("2024-05-01"), d("2024-05-02"), d("2024-05-04"), d("0001-01-01"), d("9999-12-31"), d("2024-05-02"), None]
    assert ranges(spark, days) == (("0001-01-01", "0001-01-01"), ("2024-05-01", "2024-05-02"), ("2024-05-04", "2024-05-04"), ("9999-12-31", "9999-12-31"))
    assert ranges(spark, days, most=3) == (("0001-01-01", "0001-01-01"), ("2024-05-01", "2024-05-04"), ("9999-12-31", "9999-12-31"))
    assert ranges(spark, days, most=1) == (("0001-01-01", "9999-12-31"),)
    assert ranges(spark, [None]) == () and ranges(spark, []) == ()


def test_random_days(spark):
    rng = random.Random(4)
    for most in (1, 4, 32):
        days = {dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(400)) for _ in range(60)}
        got = ranges(spark, days, most=most)
        assert len(got) <= most and all(any(a <= str(x) <= b for a, b in got) for x in days)
        ends = {str(x) for x in days}
        assert all(a in ends and b in ends for a, b in got)


def test_a_wrong_day_opens_only_itself(spark, make_ledger, make_lines):
    """Authorizations between the statement's days and an outlier are not read."""
    many = [authorization(i, "a", fecha_hora_creacion=dt.datetime(2000 + i, 1, 1)) for i in range(20)]
    ledger = make_ledger(autorizacion=[*many, authorization(99, "a")])
    lines = make_lines(TRANSACCIONES, *({"id_procesador": "a", "id": str(k), "trx_date": d} for k, d in enumerate(["2024-05-01", "0001-01-01", "9999-12-31"])))
    found = transacciones.reduced(lines, ledger)
    assert len(found.profile.days) == 3
    assert ledger.autorizacion.filter(within_days(F.col("fecha_hora_creacion"), found.profile.days)).count() == 1
    export = transacciones.export(lines, ledger)
    assert sorted((r["trx_date"], r["codigo_unico_adq"]) for r in export.collect()) == [("0001-01-01", ""), ("2024-05-01", "a"), ("9999-12-31", "")]


def test_lines_are_read_once_for_the_statistics(spark, tmp_path, make_ledger):
    """Counts, codes, extent and the unmatched all come from the narrow table."""
    for layout in LAYOUTS:
        plan = PLANS[layout.name]
        folder = str(tmp_path / layout.name)
        columns = ", ".join(f"cast(id as string) as {c}" for c in layout.columns)
        spark.sql(f"select {columns}, id as {layout.line_id + '_'} from range(20)").withColumnRenamed(layout.line_id + "_", layout.line_id).write.parquet(folder)
        lines, before = spark.read.parquet(folder), executions(spark).size()
        plan.statistics(lines, make_ledger(autorizacion=[authorization(3, "3")])).collect()
        (scan,) = scans(spark, folder, before)
        assert len(re.search(r"ReadSchema: struct<(.*)>", scan)[1].split(",")) == (4 if layout.day else 1)


def test_wide_lines_are_fetched_last(make_ledger, make_lines, conf, monkeypatch):
    """Lines are not shuffled; where the narrow rows are too many to broadcast, matching ones are for the ledger's columns, and
    where their numbers are too, all are once."""
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    ledger = make_ledger(autorizacion=[authorization(i, f"k{i}") for i in range(20)])
    lines = make_lines(TRANSACCIONES, *({"id_procesador": f"k{i}", "id": "x", "trx_date": "2024-05-01"} for i in range(60)))
    wide = r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*ruc#.*)\]\nArguments: (.*?)\]?, ENSURE"
    found = transacciones.reduced(lines, ledger, shared=True)
    assert re.findall(wide, formatted(transacciones.export(lines, ledger, found))) == []
    monkeypatch.setattr(match, "MAX_BROADCAST_BYTES", 3000)
    found = transacciones.reduced(lines, ledger, shared=True)
    assert found.small
    exchanges = re.findall(wide, formatted(transacciones.export(lines, ledger, found)))
    assert len(exchanges) == 1 and "id_procesador" in exchanges[0][1]
    monkeypatch.setattr(match, "MAX_BROADCAST_BYTES", 600)
    found = transacciones.reduced(lines, ledger, shared=True)
    assert not found.small
    plan = formatted(transacciones.export(lines, ledger, found))
    arguments = [a for _, a in re.findall(wide, plan)]
    assert sum("id_culqi" in a for a in arguments) + plan.count("ReusedExchange [ruc") <= 2 and sum("id_procesador" in a for a in arguments) == 1
    export = transacciones.export(lines, ledger, found)
    assert export.count() == 60 and export.filter("codigo_unico_adq <> ''").count() == 20


def test_a_profile_of_hot_and_missing_codes(spark, make_lines):
    lines = make_lines(PMC, *({"nro_orden": "hot"} for _ in range(30)), {"nro_orden": ""}, {"nro_orden": None}, {"nro_orden": "x"})
    got = profile(lines, PMC)
    assert {r["_key"]: r["_lines"] for r in got.rows.collect()} == {"hot": 30, "": 1, None: 1, "x": 1}
    assert (got.lines, got.codes) == (33, 3) and got.keyed.count() == 2 and got.keys.count() == 3
