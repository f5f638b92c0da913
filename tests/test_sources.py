"""Routing, file loading, numbering and outputs."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallymark.operators.prepare import assign_row_id, drop_empty_key, nonempty
from tallymark.plans.run import reconcile
from tallymark.sinks.export import export_name, statistics_name, write_export, write_lines, write_statistics
from tallymark.sources.layouts import LAYOUTS, MPOS, PMC, TRANSACCIONES, layout_for
from tallymark.sources.ledger import Ledger, jdbc_options
from tallymark.sources.scratch import scratch_folder
from tallymark.functions.columns import text_date
from tallymark.sources.statement import BrokenStatement, broken_lines, read_statement, route_layout, stage_statement


def write(path, layout, *lines, end="\n"):
    text = end.join([layout.delimiter.join(layout.columns), *lines, ""])
    path.write_bytes(text.encode("latin-1"))
    return str(path)


def line(layout, **values):
    return layout.delimiter.join(values.get(c, "") for c in layout.columns)


NAMES = {
    "x_pmc_MPOS.csv": "PMC",
    "Mpos_transacciones.txt": "MPOS",
    "transacciones-1.csv": "TRANSACCIONES",
    "foo.csv": "none",
}


def test_routing_takes_the_first_word_found(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    routed = {r["name"]: r["layout"] for r in df.select("name", route_layout(F.col("name")).alias("layout")).collect()}
    assert routed == NAMES
    for name, layout in NAMES.items():
        found = layout_for(name)
        assert (found.name if found else "none") == layout


def test_layout_widths():
    assert [len(layout.columns) for layout in LAYOUTS] == [14, 28, 32]
    assert [len(layout.header) for layout in LAYOUTS] == [27, 42, 46]


@pytest.mark.parametrize("layout", LAYOUTS, ids=lambda layout: layout.name)
def test_crlf_leaves_no_carriage_return(spark, tmp_path, layout):
    path = write(tmp_path / "f.csv", layout, line(layout, **{layout.key: "1", layout.columns[-1]: "last"}), end="\r\n")
    rows = read_statement(spark, path, layout).collect()
    assert [r[layout.columns[-1]] for r in rows] == ["last"]


def test_character_set_quotes_null_and_empty(spark, tmp_path):
    path = write(
        tmp_path / "pmc.csv",
        PMC,
        line(PMC, nro_orden="1", comercio='"Caf\xe9, S.A."', marca='"say \\"hi\\""', monto="\\N", abonado='""'),
    )
    row = read_statement(spark, path, PMC).first()
    assert (row["comercio"], row["marca"]) == ("Café, S.A.", 'say "hi"')
    assert (row["monto"], row["abonado"], row["dc"]) == (None, "", "")


def test_doubled_quotes_by_option(spark, tmp_path):
    path = write(tmp_path / "pmc.csv", PMC, line(PMC, nro_orden="1", marca='"a ""b"""'))
    assert read_statement(spark, path, PMC, escape='"').first()["marca"] == 'a "b"'


def test_short_and_long_rows(spark, tmp_path):
    path = write(tmp_path / "pmc.csv", PMC, "d1,1,s", line(PMC, fecha_hora="d2", nro_orden="2") + ",surplus,more")
    rows = {r["nro_orden"]: r for r in read_statement(spark, path, PMC).collect()}
    assert rows["1"]["status_adquiriente"] == "" and rows["1"]["seccode"] == "s"
    assert rows["2"]["status_adquiriente"] == ""


def test_empty_keys_go_before_numbering_and_null_keys_stay(spark, tmp_path):
    keys = ["a", "", "\\N", "b", ""]
    path = write(tmp_path / "pmc.csv", PMC, *(line(PMC, fecha_hora=str(i), nro_orden=k) for i, k in enumerate(keys)))
    staged = stage_statement(spark, path, PMC)
    assert [(r["id"], r["nro_orden"]) for r in staged.orderBy("id").collect()] == [(1, "a"), (2, None), (3, "b")]
    assert staged.filter(nonempty(PMC.key)).count() == 2
    assert drop_empty_key(staged, PMC.key).count() == 3


def test_rows_are_numbered_in_file_order_over_many_splits(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="0")
    n = 700
    for part in range(3):
        write(tmp_path / f"mpos{part}.csv", MPOS, *(line(MPOS, RUC=str(part * n + i)) for i in range(n)))
    raw = read_statement(spark, str(tmp_path), MPOS)
    assert raw.select("_file", "_block").distinct().count() > 6
    staged = stage_statement(spark, str(tmp_path), MPOS)
    assert [(r["id"], r["RUC"]) for r in staged.orderBy("id").collect()] == [(i + 1, str(i)) for i in range(3 * n)]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_numbers_follow_an_order(spark, limit, monkeypatch):
    from tallymark.operators import prepare

    monkeypatch.setattr(prepare, "MAX_BROADCAST_SEGMENTS", limit)
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    numbered = assign_row_id(df, "n", order_by=["k"])
    assert numbered.filter("n != k + 1").count() == 0 and numbered.count() == 5000


def session_with(master, **conf):
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: conf.get("folder", default)))


def test_scratch_folder_is_the_shared_one():
    assert scratch_folder(session_with("yarn", folder="hdfs:///shared/")) == "hdfs:///shared/app-1"
    assert "app-1" in scratch_folder(session_with("local[2]"))
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_folder(session_with(master))


def test_export_quotes_every_value(spark, tmp_path):
    df = spark.createDataFrame([('a "b"', None, "")], "x string, y string, z string").coalesce(1)
    write_export(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text == '"x","y","z"\n"a ""b""","",""\n'
    write_lines(df.select("x", "z"), str(tmp_path / "lines"))
    assert "".join(p.read_text() for p in (tmp_path / "lines").glob("part-*")) == '"a "b"",""\n'
    write_lines(df, str(tmp_path / "nulls"))
    assert "".join(p.read_text() for p in (tmp_path / "nulls").glob("part-*")) == "NULL\n"


def test_empty_export_has_a_header(spark, tmp_path):
    write_export(spark.createDataFrame([], "x string, y string"), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text.replace('"', "") == "x,y\n"


def test_statistics_log_has_the_labelled_lines(spark, tmp_path):
    df = spark.createDataFrame([("input", "Input: ", 3), ("output_rows", None, 4)], "metric string, label string, value long")
    write_statistics(df, str(tmp_path / "log"))
    assert "".join(p.read_text() for p in (tmp_path / "log").glob("part-*")) == "Input: \t3\n"


def test_jdbc_options_per_table():
    partitioning = {"autorizacion": {"partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}}
    got = jdbc_options("autorizacion", {"url": "jdbc:x"}, "s", partitioning)
    assert got == {"url": "jdbc:x", "dbtable": "s.autorizacion", **partitioning["autorizacion"]}
    assert jdbc_options("comercio", {"url": "jdbc:x"}) == {"url": "jdbc:x", "dbtable": "comercio"}


def test_a_run_from_file_to_outputs(spark, tmp_path, make_ledger):
    from conftest import authorization, transaction

    ledger = make_ledger(autorizacion=[authorization(1, "k1")], transaccion=[transaction(1)])
    for name, table in vars(ledger).items():
        if not name.startswith("_") and hasattr(table, "write"):
            table.write.parquet(str(tmp_path / "ledger" / name))
    ledger = Ledger.from_parquet(spark, str(tmp_path / "ledger"))
    file = write(tmp_path / "my_pmc_1.csv", PMC, line(PMC, nro_orden="k1"), line(PMC, nro_orden="k2"), line(PMC))
    assert reconcile(spark, file, ledger, str(tmp_path / "out")) is PMC
    out = spark.read.option("header", True).csv(str(tmp_path / "out" / export_name("my_pmc_1.csv")))
    assert out.columns == PMC.header
    assert sorted((r["id"], r["nombre_comercio"], r["tipo_bln"]) for r in out.collect()) == [
        ("1", "Tienda", "T+n (Core)"),
        ("2", None, "T+n (Core)"),
    ]
    log = spark.read.text(str(tmp_path / "out" / statistics_name("my_pmc_1.csv")))
    assert sorted(r["value"] for r in log.collect()) == ["Input: \t2", "No Encontrados: \t1", "Output: \t2"]
    assert reconcile(spark, str(tmp_path / "foo.csv"), ledger, str(tmp_path / "out")) is None


def test_transacciones_uses_semicolons(spark, tmp_path):
    path = write(tmp_path / "t.csv", TRANSACCIONES, line(TRANSACCIONES, id_procesador="9", brandActionCode="00"))
    row = stage_statement(spark, path, TRANSACCIONES).first()
    assert (row["id_procesador"], row["brandActionCode"], row[TRANSACCIONES.line_id]) == ("9", "00", 1)


def test_blank_lines_are_rows(spark, tmp_path):
    for end in ("\n", "\r\n"):
        path = write(tmp_path / f"mpos{len(end)}.csv", MPOS, line(MPOS, id_operacion="a"), "", line(MPOS, id_operacion="b"), "", end=end)
        rows = sorted((r["id"], r["id_operacion"]) for r in stage_statement(spark, path, MPOS).collect())
        assert rows == [(1, "a"), (2, ""), (3, "b"), (4, "")]
        assert stage_statement(spark, path, MPOS, keep_blank_lines=False).count() == 2
    path = write(tmp_path / "pmc.csv", PMC, line(PMC, nro_orden="a"), "")
    assert stage_statement(spark, path, PMC).count() == 1  # the empty key of a blank line is dropped here


def test_values_with_line_ends(spark, tmp_path):
    path = write(tmp_path / "mpos.csv", MPOS, line(MPOS, RUC='"x\ny"', id_operacion="a"), line(MPOS, id_operacion="b"))
    assert broken_lines(spark, path) == 2
    with pytest.raises(BrokenStatement):
        stage_statement(spark, path, MPOS, strict=True)
    rows = stage_statement(spark, path, MPOS, strict=True, multi_line=True).collect()
    assert sorted((r["RUC"], r["id_operacion"]) for r in rows) == [("", "b"), ("x\ny", "a")]


def test_days_in_several_spellings(spark):
    texts = ["2024-05-01 10:30:00", "2024-5-1", "2024/05/01", "2024/5/1 10:30", "20240501", "2024-13-01", "n/a", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    days = [str(r[0]) for r in df.select(text_date(F.col("t"))).collect()]
    assert days == ["2024-05-01"] * 5 + ["None"] * 4


def test_names_with_pattern_characters(spark, tmp_path, make_ledger):
    path = write(tmp_path / "PMC[1].csv", PMC, line(PMC, nro_orden="k"))
    assert reconcile(spark, path, make_ledger(), str(tmp_path / "out")) is PMC
    assert (tmp_path / "out" / "OUT_PMC[1].csv" / "_SUCCESS").exists()


def test_amounts_are_shown_as_stored(spark, make_ledger):
    tables = {name: getattr(make_ledger(), name) for name in Ledger.__dataclass_fields__}
    row = spark.sql("select 1L as id, cast('10.1256' as decimal(20,4)) as monto_autorizado")
    stored = tables["autorizacion"].drop("id", "monto_autorizado").join(row, how="right")
    shown = Ledger.of({**tables, "autorizacion": stored}).autorizacion.select("monto_autorizado").first()[0]
    assert str(shown) == "10.1256"
    snapshot = make_ledger().snapshot()
    assert snapshot.comercio.count() == 1 and snapshot.comercio.inputFiles()
