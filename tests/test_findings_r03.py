"""Work that has to grow no faster than the input."""

from __future__ import annotations

import random
import re

import pytest

from tallymark.sources import records, statement
from tallymark.sources.layouts import LAYOUTS

COMPILED_BYTES = 8000  # Java compiles no method with more bytecode, and runs it some ten times slower


def method_bytes(df, capsys) -> int:
    capsys.readouterr()
    df.explain(mode="codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)))


@pytest.mark.parametrize("layout", LAYOUTS, ids=lambda layout: layout.name)
def test_parsing_a_statement_is_compiled(spark, layout, capsys):
    from pyspark.sql import functions as F

    schema = ", ".join([*(f"`{c}` string" for c in layout.columns), "_wrong string"])
    parsed = spark.range(3).select(F.from_csv(F.col("id").cast("string"), schema, {"sep": layout.delimiter}).alias("_csv"))
    rows = statement._texts(parsed, layout, lambda c: F.col("_csv").getField(c), ("\\N",), F.col("_csv._wrong").isNotNull().alias("_fields"))
    assert method_bytes(rows, capsys) < COMPILED_BYTES


def fold(text: str, inside: bool, delimiter: str, quote: str, escape: str) -> bool:
    """Field after field: one opens a value if its first character is its only quote, and any quote closes an open one."""
    if quote not in text:
        return inside
    plain = text.replace(escape * 2, "") if escape != quote else text
    for field in plain.replace(escape + quote, "").split(delimiter):
        inside = quote not in field if inside else field.startswith(quote) and quote not in field[1:]
    return inside


@pytest.mark.parametrize("escape", ["\\", '"'])
@pytest.mark.parametrize("delimiter", [",", ";"])
def test_state_after_a_line(spark, delimiter, escape):
    from pyspark.sql import functions as F

    rng = random.Random(delimiter + escape)
    texts = ["", '"', "\x01", *("".join(rng.choice([delimiter, '"', '"', "\\", "a", "\x01", "é"]) for _ in range(rng.randrange(12))) for _ in range(3000))]
    lines = spark.createDataFrame([(text,) for text in texts], "text string")
    plain = records._plain(F.col("text"), '"', escape)
    told = lines.select("text", *(records._state_after(plain, inside, delimiter, '"') for inside in (False, True))).collect()
    assert [tuple(r) for r in told] == [(t, fold(t, False, delimiter, '"', escape), fold(t, True, delimiter, '"', escape)) for t in texts]


def test_numbers_as_bits(spark):
    from pyspark.sql import functions as F

    from tallymark.operators.code_filter import BLOCK_BITS, number_set, with_membership

    held = [0, 1, 63, 64, BLOCK_BITS - 1, BLOCK_BITS, 5 * BLOCK_BITS + 7, -1, -BLOCK_BITS, (1 << 62) + 5, *range(200_000, 240_000)]
    asked = [None, *{k + d for k in held[:10] for d in (-1, 0, 1)}, *range(199_000, 241_000)]
    numbers = spark.createDataFrame([(k,) for k in [*held, 0, None]], "n long")
    told = with_membership(spark.createDataFrame([(k,) for k in asked], "n long"), F.col("n"), number_set(numbers), "found").collect()
    assert sorted(map(tuple, told), key=str) == sorted(((k, k in set(held)) for k in asked), key=str)


def test_a_filter_without_all_words(spark):
    """Blocks that miss words are filled up with zeros, full ones are taken as they are; both hold all their bits."""
    from pyspark.sql import functions as F

    from tallymark.operators.code_filter import WORD, WORDS, number_set

    few, all_ = [5, 64 * 7], [32768 + WORD * k + k % WORD for k in range(WORDS)]
    rows = {r["_block"]: r["_words"] for r in number_set(spark.createDataFrame([(k,) for k in few + all_], "n long").repartition(3)).collect()}
    assert rows[0] == [1 << 5, *[0] * 6, 1, *[0] * (WORDS - 8)]
    assert [w % (1 << WORD) for w in rows[1]] == [1 << k % WORD for k in range(WORDS)]


def test_many_codes_walk_the_lookups_by_id(spark, make_ledger, make_lines, monkeypatch):
    from conftest import authorization, transaction

    from tallymark.operators import reduce
    from tallymark.plans import mpos
    from tallymark.sources.layouts import MPOS

    ledger = make_ledger(autorizacion=[authorization(i % 20, f"k{i}") for i in range(40)], transaccion=[transaction(i) for i in range(0, 20, 3)])
    lines = make_lines(MPOS, *({"id_operacion": f"k{i % 60}"} for i in range(90)))
    plain = sorted(map(str, mpos.export(lines, ledger).collect()))
    monkeypatch.setattr(reduce, "MANY_BYTES", -1)
    found = mpos.reduced(lines, ledger)
    assert found.small and "_found" in found.shown._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, mpos.export(lines, ledger).collect())) == plain


def test_wide_lines_are_shuffled_only_to_meet_the_ledger(spark, make_ledger, make_lines, monkeypatch, conf):
    """Beyond what can be broadcast line by line, bits of the numbers still tell which lines match and stay."""
    from conftest import authorization

    from tallymark.operators import match
    from tallymark.plans import transacciones
    from tallymark.sources.layouts import TRANSACCIONES

    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    ledger = make_ledger(autorizacion=[authorization(i, f"k{i}") for i in range(40)])
    lines = make_lines(TRANSACCIONES, *({"id_procesador": f"k{i % 60}", "trx_date": "2024-05-01", "id": f"{i % 2}"} for i in range(200)))
    plain = sorted(map(str, transacciones.export(lines, ledger).collect()))
    monkeypatch.setattr(match, "MAX_BROADCAST_BYTES", 2 * 4096)
    export = transacciones.export(lines, ledger)
    wide = re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning", export._sc._jvm.PythonSQLUtils.explainString(export._jdf.queryExecution(), "formatted"))
    assert sum("authorization_message" in columns for columns in wide) == 1
    assert sorted(map(str, export.collect())) == plain


def test_a_step_begun_drops_what_another_remembered(monkeypatch):
    from tallymark.llm import features

    monkeypatch.setattr(features, "LEFT_BEHIND", 50)
    before, now = features.Remembered(len), features.Remembered(len)
    assert [before[str(k)] for k in range(100)] == [len(str(k)) for k in range(100)] and len(before) == 100
    assert now["a"] == 1 and not before
    assert [before[str(k)] for k in range(60)] and len(now) == 1  # little is not worth it
