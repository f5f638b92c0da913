"""Filter audit: against plain Python over the orders, and odd tables."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tallymark.llm import common, filter_audit

SCHEMA = "doc_id long, text string, lang string"


def brute(docs, labels, filters="ABCDE"):
    """All rows of the audit, document by document."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": i is not None and i > least[text],
        }
        of = [(q, t) for k, q, t in labels if k == i and i is not None]
        rows.append((lang or "", fails, any(q == 1 for q, _ in of), any(t == 1 for _, t in of)))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys(filters, 0)
        for order in permutations(filters):
            there = mine
            for k, f in enumerate(order):
                here = [r for r in there if r[1][f]]
                left = [r for r in there if not r[1][f]]
                shapley[f] += len(here)
                out[part, "".join(order), k + 1] = [
                    len(left), len(here), sum(r[1][f] for r in mine) - len(here), sum(r[1][f] and sum(r[1].values()) == 1 for r in mine), sum(r[2] for r in here), sum(r[3] for r in here),
                ]
                there = left
        for (p, order, k), row in out.items():
            if p == part:
                row.append(shapley[order[k - 1]])
    return out


LONG = " ".join(f"w{k}" for k in range(250))
DOCS = [
    (1, LONG, "en"), (2, LONG, "en"), (2, LONG, "en"), (None, LONG, "en"), (3, None, "en"), (4, "", None), (5, "", ""), (6, "A# b", "de"), (7, "a b c d " * 100, "de"),
    (8, "Ä ö " * 300, "de"), (9, "X" * 100_000, "de"), (10, "x | y", None), (11, f"{LONG}\t\v{LONG}\n", "fr"), (12, LONG.upper(), "fr"), (13, " \t\r ", "fr"), (14, "\U0001f600 & \x85", "fr"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, 1), (None, 1, 1), (12, 1, 1), (99, 1, 1)]


def frames(spark, docs, labels):
    extra = {c: F.lit("x") for c in ("A", "E", "part", "mask", "good", "toxic", "digest", "least", "labelled", "n")}
    return spark.createDataFrame(docs, SCHEMA).withColumns(extra), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[m] for m in (*filter_audit.MEASURES, "shapley")] for r in df.collect()}


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, -1])
def test_odd_documents(spark, monkeypatch, limit):
    monkeypatch.setattr(filter_audit, "bounded", lambda df, row_bytes: common.bounded(df, row_bytes, limit))
    df = filter_audit.filter_audit(*frames(spark, DOCS, LABELS))
    got = audited(df)
    assert got == brute(DOCS, LABELS) and len(got) == 4 * 600 == df.count()


def test_empty_tables(spark):
    assert filter_audit.filter_audit(*frames(spark, [], LABELS)).count() == 0
    assert audited(filter_audit.filter_audit(*frames(spark, DOCS[:6], []))) == brute(DOCS[:6], [])


def test_a_hot_text_and_part(spark):
    docs = [(k, "same" if k % 3 == 0 else f"text {k} $", "en" if k % 3 else "xx") for k in range(3000)]
    labels = [(k, k % 2, k % 5 == 0) for k in range(0, 3000, 7)]
    labels = [(k, q, int(t)) for k, q, t in labels]
    assert audited(filter_audit.filter_audit(*frames(spark, docs, labels))) == brute(docs, labels)


def test_other_filters(spark):
    """Any named filters: three of them make six orders of three steps."""
    rows = spark.createDataFrame([("p", True, False, True, True, False), ("p", False, False, True, False, True), ("q", False, False, False, True, True)], "part string, x boolean, y boolean, z boolean, good boolean, toxic boolean")
    got = audited(filter_audit.audit(rows, ("x", "y", "z")))
    assert len(got) == 2 * 6 * 3
    assert got["p", "xyz", 1] == [1, 1, 0, 0, 1, 0, 3] and got["p", "xyz", 3] == [0, 1, 1, 1, 0, 1, 9] and got["q", "zyx", 3] == [1, 0, 0, 0, 0, 0, 0]


def test_what_orders_fold_over_is_a_few_cells(spark):
    rows = spark.range(5000).select(F.lit("p").alias("part"), *((F.col("id") % k == 0).alias(f) for f, k in zip("ABCDE", (2, 3, 5, 7, 11))), F.lit(True).alias("good"), F.lit(False).alias("toxic"))
    assert filter_audit.mask_cells(rows, filter_audit.FILTERS).count() == 32
