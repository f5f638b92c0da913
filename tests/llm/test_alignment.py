"""Alignment of two tokenizers: against whole texts encoded by the libraries and cut token by token."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.llm import alignment, common
from tallymark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(*alignment.tokenizer_files())


def encoded(pair, text):
    """Ids of the whole text by the libraries themselves, or nothing."""
    a, b = pair.a.encode(" " + (text or ""), add_special_tokens=False).ids, pair.b.encode(text or "")
    want = (" " + (text or "")).encode()
    a_bytes, b_bytes = (b"".join(of[k] for k in ids) for of, ids in ((pair.a_bytes, a), (pair.b_bytes, b)))
    return (a, b) if text and a_bytes == want == b_bytes else ([], [])


def places(ids, of):
    ends, at = [], 0
    for k in ids:
        ends.append((at, at := at + len(of[k])))
    return ends


def brute(pair, rows):
    """The result of all rows (doc_id, text), by lists and loops."""
    links, told, total = [], [], Counter()
    for _, text in rows:
        a, b = encoded(pair, text)
        a_at, b_at = places(a, pair.a_bytes), places(b, pair.b_bytes)
        both = {e for _, e in a_at} & {e for _, e in b_at}
        groups, held = [], ([], [])
        for end in sorted({e for _, e in [*a_at, *b_at]}):
            for ids, at, into in ((a, a_at, held[0]), (b, b_at, held[1])):
                into += [str(k) for k, (_, e) in zip(ids, at) if e == end]
            if end in both:
                groups.append("|".join(map(",".join, held)))
                held = ([], [])
        here, j0 = [], 0
        for k, (s, e) in zip(a, a_at):
            while b_at[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(b) and b_at[j][0] < e:
                here.append((k, b[j]))
                j += 1
        links.append(here)
        total.update(here)
        told.append([len(a), len(b), len(groups), len(here), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""])
    most = {}
    for (_, b), n in total.items():
        most[b] = max(n, most.get(b, 0))
    out = [(i, *t[:4], sum(total[x] == most[x[1]] for x in here), sum(total[x] for x in here), t[4]) for (i, _), t, here in zip(rows, told, links)]
    return sorted(out, key=str)


TEXTS = [
    None, "", " ", "  two  blanks ", "tab\tand\nline \n end", "It's <|endoftext|> in <s> plain </s> <unk> <0x41>text", "a▁b", "good ▁ bad", "日本語のテキスト と 한국어", "é é ﬁ ½  x y",
    "\U0001f600\U0001f468‍\U0001f469 emoji", "x" * 5000, "word " * 3000, "nul\x00byte \x1c sep \x85 nel", "'s 've don't we'll", "123456789 3.14 1,000", "a" + " " * 40 + "b", "▁", "end ",
]
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "pair", "times", "count", "best", "n_a", "b")})
    df = alignment.token_alignment(docs)
    assert tuple(df.columns) == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, -1])
def test_odd_texts(spark, pair, monkeypatch, limit):
    monkeypatch.setattr(alignment, "bounded", lambda df, row_bytes: common.bounded(df, row_bytes, limit))
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (3, "another text"), (None, "no id"), (None, None)]
    assert got(spark, rows) == brute(pair, rows)


def test_pairs_of_a_long_text_come_in_several_rows(spark, pair, monkeypatch):
    """Whatever the bounds are: texts aligned together, pairs in a row, values searched for together."""
    rows = [(k, " ".join(f"{w}{k}" for w in ("alpha", "Beta", "gamma-delta", "ε")) + "." * k) for k in range(40)]
    for name, value in (("PAIRS_IN_ROW", 7), ("CHARACTERS_AT_ONCE", 100), ("GALLOP", 3)):
        monkeypatch.setattr(alignment, name, value)
    pa_rows = list(alignment._rest(alignment.pa.array([5]), np.array([7]), np.array([20])))
    assert [(int(a[0]), int(b[0])) for a, b, _ in pa_rows] == [(7, 14), (14, 20)]
    long_ = Counter(alignment.together(["x" * 60, "y" * 60, None, "z"]))
    assert long_ == {(0, 1): 1, (1, 4): 1}
    assert got(spark, rows) == brute(pair, rows)


def test_query_equals_brute_force(spark, pair):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in common.table(spark, folder, "documents").select("doc_id", "text").collect()]
    assert sorted((tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_alignment"](spark, folder).collect()), key=str) == brute(pair, rows)


def test_empty_table(spark):
    assert got(spark, []) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab A▁éß日  \t\n.,'<>|0\U0001f600\x1c"), max_size=40), max_size=4))
def test_pieces_are_what_whole_texts_are(pair, texts):
    whole = [encoded(pair, text) for text in texts]
    assert [tuple(np.frombuffer(x, "<u4").tolist() for x in e) for e in pair.encode(texts)] == whole


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 3000)), st.integers(1, 9))
def test_galloping_finds_what_both_hold(a, b, together):
    before, alignment.GALLOP = alignment.GALLOP, together
    try:
        x, y = (np.array(sorted(s), np.int64) for s in (a, b))
        for left, right in ((x, y), (y, x)):
            i, j = alignment.galloping_intersection(left, right)
            assert left[i].tolist() == right[j].tolist() == sorted(a & b)
    finally:
        alignment.GALLOP = before
