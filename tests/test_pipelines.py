"""The pipelines on hand-made edge cases."""

from datetime import datetime

import pytest
from conftest import authorization, transaction

from tallymark.operators.prepare import collate_keys
from tallymark.plans import mpos, pmc, transacciones
from tallymark.sources.layouts import MERCHANT_ID_V4, MPOS, PMC, STATE, TIER, TRANSACCIONES

CORE, LEDGER, EVOLUTION = "T+n (Core)", "Ledger", "t0 (Evolution)"


def table(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def values(df):
    return [(r["metric"], r["value"]) for r in df.collect()]


def trx(code, id="x", day="2024-05-01 10:30:00", **more):
    return {"id_procesador": code, "id": id, "trx_date": day, **more}


def test_two_references_make_two_rows(make_ledger, make_lines):
    a = [authorization(1, "k", ref_id="r1"), authorization(2, "k", ref_id="r2"), authorization(3, "k", ref_id="r2")]
    ledger = make_ledger(autorizacion=a, transaccion=[transaction(i) for i in (1, 2, 3)])
    lines = make_lines(PMC, {"nro_orden": "k"})
    assert table(pmc.export(lines, ledger), "id", "ref_id", STATE) == [(1, "r1", "Pagado"), (1, "r2", "Pagado")]
    assert values(pmc.statistics(lines, ledger))[3] == ("output_rows", 2)


def test_the_least_authorization_and_transaction_are_shown(make_ledger, make_lines):
    a = [authorization(2, "k", monto_autorizado="2.00"), authorization(1, "k", monto_autorizado="1.00")]
    ledger = make_ledger(autorizacion=a, transaccion=[transaction(1, history=2), transaction(1), transaction(2)])
    got = table(pmc.export(make_lines(PMC, {"nro_orden": "k"}), ledger), "monto_autorizado", STATE)
    assert got == [("1.00", "Pagado")]


def test_acquirer_links_multiply_statistics_only(make_ledger, make_lines):
    links = [{"id": i, "comercio_id": 1, "comercio_contrato_id": 1, "adquiriente_id": 4} for i in (1, 2, 3)]
    ledger = make_ledger(
        autorizacion=[authorization(1, "k")], transaccion=[transaction(1, history=2)], comercio_adquiriente=links
    )
    lines = make_lines(MPOS, {"id_operacion": "k"})
    assert mpos.export(lines, ledger).count() == 1
    assert values(mpos.statistics(lines, ledger)) == [("input", 1), ("output_declared", 1), ("not_found", 3)]


def test_links_of_a_merchant_that_does_not_exist_do_not_count(make_ledger, make_lines):
    links = [{"id": i, "comercio_id": 9} for i in (1, 2)]
    ledger = make_ledger(
        autorizacion=[authorization(1, "k")],
        transaccion=[transaction(1, history=2, merchant=9)],
        comercio_adquiriente=links,
    )
    assert values(mpos.statistics(make_lines(MPOS, {"id_operacion": "k"}), ledger))[2:] == [("not_found", 1)]


@pytest.mark.parametrize(("layout", "plan", "tier"), [(PMC, pmc, CORE), (MPOS, mpos, CORE), (TRANSACCIONES, transacciones, "")])
def test_tier_of_an_unmatched_line(make_ledger, make_lines, layout, plan, tier):
    export = plan.export(make_lines(layout, {layout.key: "k"}), make_ledger())
    assert export.columns == layout.header
    assert table(export, layout.line_id, TIER, STATE) == [(1, tier, "")]


def test_tiers_of_merchants(make_ledger, make_lines):
    merchants = [{"id": i, "nombre_comercial": f"m{i}", "codigo_comercio": f"c{i}"} for i in (1, 2, 3, 4)]
    ledger = make_ledger(
        autorizacion=[authorization(i, "k", ref_id=f"r{i}") for i in (1, 2, 3, 4)],
        transaccion=[transaction(i, merchant=i) for i in (1, 2, 3, 4)],
        comercio=merchants,
        whitemarches=[
            {"codigo_comercio": "c1", "migration_date": datetime(2020, 1, 1)},
            {"codigo_comercio": "c2", "migration_date": None},
            {"codigo_comercio": "c3", "migration_date": None},
        ],
        comercio_configuracion=[
            {"id": 1, "comercio_id": 1, "configuracion_id": 11},
            {"id": 2, "comercio_id": 2, "configuracion_id": 11},
            {"id": 3, "comercio_id": 2, "configuracion_id": 11},
            {"id": 4, "comercio_id": 3, "configuracion_id": 12},
        ],
    )
    got = table(pmc.export(make_lines(PMC, {"nro_orden": "k"}), ledger), "nombre_comercio", TIER)
    assert got == [("m1", EVOLUTION), ("m2", LEDGER), ("m3", CORE), ("m4", CORE)]


def test_signature_of_failed_authorizations_only(make_ledger, make_lines):
    ledger = make_ledger(
        autorizacion=[authorization(1, "ok"), authorization(2, "ko", exitosa=0)],
        adq_vdp_v3_authorization=[{"autorizacion_id": i, "signature": s} for i, s in ((1, "s"), (2, "t"), (2, "s"))],
    )
    got = table(transacciones.export(make_lines(TRANSACCIONES, trx("ok"), trx("ko")), ledger), "id_procesador", "signature")
    assert got == [("ko", "s"), ("ok", "")]


def test_day_acquirer_and_contract_decide_a_match(make_ledger, make_lines):
    ledger = make_ledger(
        autorizacion=[
            authorization(1, "a"),
            authorization(2, "b", comercio_procesador_terminal_id=2),
            authorization(3, "c", comercio_procesador_terminal_id=3),
            authorization(4, "", ref_id="empty"),
        ],
        comercio_procesador_terminal=[{"id": i, "comercio_adquiriente_id": i} for i in (1, 2, 3)],
        comercio_adquiriente=[
            {"id": 1, "comercio_contrato_id": 1, "adquiriente_id": 4},
            {"id": 2, "comercio_contrato_id": 1, "adquiriente_id": 5},
            {"id": 3, "comercio_contrato_id": 2, "adquiriente_id": 4},
        ],
        comercio_contrato=[{"id": 1, "tipo_contrato_id": 1}, {"id": 2, "tipo_contrato_id": 2}],
    )
    lines = make_lines(
        TRANSACCIONES,
        trx("a"),
        trx("a", id="y", day="2024-05-02 00:00:00"),
        trx("a", id="z", day="01/05/2024"),
        trx("a", id="n", day=None),
        trx("b"),
        trx("c"),
        trx(""),
        trx(None),
    )
    export = transacciones.export(lines, ledger)
    matched = [i for i, code in table(export, TRANSACCIONES.line_id, "codigo_unico_adq") if code]
    assert matched == [1] and export.count() == 8
    assert values(transacciones.statistics(lines, ledger)) == [
        ("input", 8),
        ("output_declared", 8),
        ("not_found", 7),
        ("output_rows", 8),
    ]


def test_matched_duplicates_collapse_and_are_not_unmatched(make_ledger, make_lines):
    ledger = make_ledger(autorizacion=[authorization(1, "a"), authorization(2, "a", ref_id="r2")])
    lines = make_lines(TRANSACCIONES, trx("a"), trx("a"), trx("a", id="y"), trx("b"), trx("b"))
    export = transacciones.export(lines, ledger)
    assert table(export, TRANSACCIONES.line_id, "ref_id") == [(1, "r1"), (3, "r1"), (4, ""), (5, "")]
    assert transacciones.export(lines, ledger, keep_duplicates=True).count() == 5
    assert values(transacciones.statistics(lines, ledger))[2:] == [("not_found", 2), ("output_rows", 4)]


def test_nothing_missing(make_ledger, make_lines):
    ledger = make_ledger(autorizacion=[authorization(1, "k")], transaccion=[transaction(1)])
    assert values(mpos.statistics(make_lines(MPOS, {"id_operacion": "k"}), ledger)) == [("input", 1), ("output_declared", 1)]
    assert values(pmc.statistics(make_lines(PMC, {"nro_orden": "k"}), ledger))[2] == ("not_found", 0)
    assert values(transacciones.statistics(make_lines(TRANSACCIONES, trx("k")), ledger))[2] == ("not_found", 0)


def test_no_lines(make_ledger, make_lines):
    ledger = make_ledger(autorizacion=[authorization(1, "k")])
    for layout, plan, n in ((PMC, pmc, 4), (MPOS, mpos, 2), (TRANSACCIONES, transacciones, 4)):
        lines = make_lines(layout, {layout.key: "k"}).filter("false")
        assert plan.export(lines, ledger).count() == 0
        assert [v for _, v in values(plan.statistics(lines, ledger))] == [0] * n


def test_empty_state_counts_even_for_an_empty_key(make_ledger, make_lines):
    ledger = make_ledger(
        autorizacion=[authorization(1, ""), authorization(2, "", ref_id="r2"), authorization(3, "k", ref_id="r3")],
        transaccion=[transaction(1, history=2), transaction(3, history=2)],
    )
    lines = make_lines(MPOS, {"id_operacion": ""}, {"id_operacion": "k"}, {"id_operacion": "u"}, {"id_operacion": None})
    got = sorted(v for m, v in values(mpos.statistics(lines, ledger)) if m == "not_found")
    assert got == [1, 1, 1]  # the empty key's empty state, the key's empty state, and the line without authorization


def test_an_authorization_without_group_columns_is_not_the_unmatched_group(make_ledger, make_lines):
    ledger = make_ledger(autorizacion=[authorization(1, "k", codigo_referencia=None, ref_id=None)])
    lines = make_lines(MPOS, {"id_operacion": "k"}, {"id_operacion": "u"}, {"id_operacion": "v"})
    assert sorted(v for m, v in values(mpos.statistics(lines, ledger)) if m == "not_found") == [1, 2]
    assert mpos.export(lines, ledger).count() == 3


def test_dash_for_a_null_discount(make_ledger, make_lines):
    lines = make_lines(MPOS, {"id_operacion": "k", "Importe_descontado": None}, {"id_operacion": "l"})
    assert table(mpos.export(lines, make_ledger()), "id", "Importe_descontado") == [(1, "-"), (2, "")]


def test_merchant_id_collapses_identical_lines(make_ledger, make_lines):
    ledger = make_ledger(
        autorizacion=[authorization(1, "k"), authorization(2, "n")], transaccion=[transaction(1)]
    )
    same, other = {"nro_orden": "k"}, {"nro_orden": "k", "monto": "1"}
    lines = make_lines(PMC, same, same, other, {"nro_orden": "n"}, {"nro_orden": "u"}, {"nro_orden": "u"})
    got = table(pmc.export_merchant_id(lines, ledger), "nro_orden", "monto", "id")
    assert got == [("k", "", "1"), ("k", "1", "1"), ("n", "", ""), ("u", "", "")]


def test_merchant_id_beside_the_line_number(make_ledger, make_lines):
    ledger = make_ledger(autorizacion=[authorization(1, "a")], transaccion=[transaction(1)])
    export = transacciones.export_merchant_id(make_lines(TRANSACCIONES, trx("a"), trx("b")), ledger)
    assert table(export, TRANSACCIONES.line_id, MERCHANT_ID_V4) == [(1, "1"), (2, "")]


def test_null_file_values_stay_null_in_the_export(make_ledger, make_lines):
    lines = make_lines(PMC, {"nro_orden": "k", "marca": None})
    assert pmc.export(lines, make_ledger()).first()["marca"] is None


@pytest.mark.parametrize(("layout", "plan"), [(PMC, pmc), (MPOS, mpos), (TRANSACCIONES, transacciones)])
def test_collation_of_codes(make_ledger, make_lines, layout, plan):
    ledger = make_ledger(autorizacion=[authorization(1, "Ab "), authorization(2, "aB")], transaccion=[transaction(1)])
    lines = make_lines(layout, {layout.key: "AB", "trx_date": "2024-05-01"}, {layout.key: "x"})
    assert plan.export(lines, ledger).filter(f"{STATE} <> ''").count() == 0
    lines, ledger = collate_keys(lines, ledger, layout, "UTF8_LCASE_RTRIM")
    assert table(plan.export(lines, ledger), layout.line_id, STATE) == [(1, "Pagado"), (2, "")]
    assert values(plan.statistics(lines, ledger))[2] == ("not_found", 1)


def test_last_day_of_the_calendar(make_ledger, make_lines):
    a = [authorization(1, "a", fecha_hora_creacion=datetime(9999, 12, 31, 23)), authorization(2, "b")]
    lines = make_lines(TRANSACCIONES, trx("a", day="9999-12-31"), trx("b"), trx("b", id="y", day="0001-01-01"))
    export = transacciones.export(lines, make_ledger(autorizacion=a))
    assert table(export, TRANSACCIONES.line_id, "codigo_unico_adq") == [(1, "a"), (2, "b"), (3, "")]


def test_statement_without_any_date(make_ledger, make_lines):
    ledger = make_ledger(autorizacion=[authorization(1, "a")])
    lines = make_lines(TRANSACCIONES, trx("a", day="?"))
    assert table(transacciones.export(lines, ledger), TRANSACCIONES.line_id, "codigo_unico_adq") == [(1, "")]
    assert values(transacciones.statistics(lines, ledger))[2] == ("not_found", 1)


def test_references_do_not_count_in_the_not_found_figure(make_ledger, make_lines):
    """Two authorizations that differ in their reference alone, without a transaction: one row not found, two rows shown."""
    a = [authorization(1, "k", ref_id="r1"), authorization(2, "k", ref_id="r2"), authorization(3, "k", ref_id="r3", exitosa=0)]
    lines = make_lines(PMC, {"nro_orden": "k"}, {"nro_orden": "k"})
    got = dict(values(pmc.statistics(lines, make_ledger(autorizacion=a[:2]))))
    assert (got["not_found"], got["output_rows"]) == (2, 4)  # per line 1 and 2
    got = dict(values(pmc.statistics(lines, make_ledger(autorizacion=a))))
    assert (got["not_found"], got["output_rows"]) == (4, 6)
    assert pmc.export(lines, make_ledger(autorizacion=a)).count() == 6
