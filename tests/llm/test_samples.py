"""What classifiers learn from: bounded by rows, whole pieces, and copies that are copies."""

import pytest
from pyspark.sql import functions as F

from tallymark.llm import toxicity
from tallymark.llm.common import held_out
from tallymark.llm.features import labelled_sample, shape


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def ids(spark):
    """Ids outside the held-out fold."""
    return [r["id"] for r in spark.range(40).where(~held_out(F.col("id"))).collect()]


def test_a_sample_is_bounded_by_rows(spark, ids):
    """One id holds most rows, of many texts and of one; the sample has no more rows than it may."""
    hot, other, *rest = ids
    docs = frame(spark, [(hot, f"text {k}") for k in range(300)] + [(other, "same")] * 300 + [(i, None) for i in rest], "doc_id long, text string")
    labels = frame(spark, [(i, 1, 0) for i in ids] + [(hot, 0, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    for bound in (1, 7, 1000):
        got = labelled_sample(docs, labels, "toxic", bound).collect()
        assert len(got) == min(bound, 300 + 1 + len(rest)) == len({(r["doc_id"], r["text"]) for r in got}) and all(r["label"] == 1 for r in got)
        again = labelled_sample(docs.repartition(5, "text"), labels, "toxic", bound).collect()
        assert sorted(map(str, got)) == sorted(map(str, again))


def test_a_sample_of_nothing(spark, ids):
    docs, labels = frame(spark, [], "doc_id long, text string"), frame(spark, [], "doc_id long, toxic int")
    assert labelled_sample(docs, labels, "toxic", 5).count() == 0
    assert labelled_sample(frame(spark, [(ids[0], "a")], docs.schema), labels, "toxic", 5).count() == 0
    assert labelled_sample(docs, frame(spark, [(ids[0], 1)], labels.schema), "toxic", 5).count() == 0


def test_the_shape_of_a_long_piece_is_that_of_all_of_it():
    assert shape("x" * 40 + "7") != shape("x" * 40 + "#") and shape("1" * 50 + "Q") == "00A"
    assert shape("word" + "!." * 9) != shape("word" + "!." * 8)
    assert (shape("abc"), shape("Abc,"), shape("ABcd12"), shape("")) == ("aa", "Aaa,", "AAaa00", "")


def test_only_copies_are_dropped(spark):
    """Texts that share their sketch are copies only if they share most of their words."""
    words = [f"w{k}" for k in range(400)]
    text = " ".join(words)
    least = sorted({p for p in toxicity.word_pairs(text)}, key=lambda p: toxicity.bucket(p, 1 << 32))[: toxicity.SKETCH]
    near = text + " and some more"
    part = " ".join(" ".join([p]) for p in least)
    assert toxicity.alike(text, near) and not toxicity.alike(text, part) and toxicity.alike("", None)
    rows = [(1, text, 1), (2, near, 1), (3, text, 0), (4, "", 1), (5, None, 1), (6, "one", 1)]
    got = toxicity.distinct_sample(frame(spark, rows, "doc_id long, text string, label int")).collect()
    same = [near] if toxicity.sketch(near) != toxicity.sketch(text) else []
    assert sorted((r["text"], r["label"]) for r in got) == sorted([(text, 1), (text, 0), ("", 1), ("one", 1), *((t, 1) for t in same)])


def test_unlike_texts_of_one_sketch_both_stay(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SKETCH", 0)
    sample = frame(spark, [(1, "a b c d", 1), (2, "e f g h", 1), (3, "a b c d", 1)], "doc_id long, text string, label int")
    assert sorted(r["text"] for r in toxicity.distinct_sample(sample).collect()) == ["a b c d", "e f g h"]
