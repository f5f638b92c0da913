"""Registered queries against SQL, brute force, exact round trips or held-out labels, on whole test tables."""

import hashlib
import html
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from tallymark.llm import decontamination, near_dedup, substring_dedup, tokens
from tallymark.llm.common import table
from tallymark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
LEARNING_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages", "embeddings"):
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("select doc_id, text from documents order by doc_id").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(result.fetchall())


def test_decontamination_without_broadcast(spark):
    docs, items = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "benchmark")
    small, shuffled = (decontamination.contamination(docs, items, **limit) for limit in ({}, {"broadcast_bytes": -1}))
    assert sorted(small.collect()) == sorted(shuffled.collect())


def brute_spans(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def passes(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    order = list(kinds)
    found = [(m.start(), order.index(k), f"{k}:{m.start()}:{m.end()}") for k, p in kinds.items() for m in re.finditer(p, text) if passes(k, m[0])]
    return [s for _, _, s in sorted(found)]


def test_personal_data(spark, texts):
    for row in QUERIES["op5_pii"](spark, SF_DIR).collect():
        want = brute_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s.startswith(k) for s in want) for k in ("email", "ip", "card", "phone")]
        assert set(want) <= set(row.spans.split(","))


def test_token_files_hold_the_ids_of_the_library(spark, texts):
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    rows = sorted(QUERIES["op8_token_ids"](spark, SF_DIR).collect())
    assert [r.doc_id for r in rows] == sorted(texts)
    for row in rows:
        ids = [*tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids, tokens.END_ID]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_repeated_passages(spark, texts):
    """Every run of sentences is listed by brute force; of equal ones the first by id and place stays."""
    places, sentences = {}, {}
    for doc_id, text in sorted(texts.items()):
        starts = substring_dedup.sentence_starts(text)
        sentences[doc_id] = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]
        words = [s.lower().split() for s in sentences[doc_id]]
        runs, n = set(), len(words)
        long_enough = lambda x, y: y - x >= 2 and sum(map(len, words[x:y])) >= 20
        for x in range(n):
            runs |= {next(((x, y) for y in range(x + 1, n + 1) if long_enough(x, y)), None), next(((y, x + 1) for y in range(x, -1, -1) if long_enough(y, x + 1)), None)}
        for x, y in sorted(runs - {None}):
            places.setdefault(tuple(map(tuple, words[x:y])), []).append((doc_id, x, y))
    gone = {(d, k) for found in places.values() for d, x, y in sorted(found)[1:] for k in range(x, y)}
    assert gone
    for row in QUERIES["op4_substring_dedup"](spark, SF_DIR).collect():
        kept = [s for k, s in enumerate(sentences[row.doc_id]) if (row.doc_id, k) not in gone]
        assert row.text == "".join(kept)
        assert (row.n_sentences, row.n_removed) == (len(sentences[row.doc_id]), len(sentences[row.doc_id]) - len(kept))


def poured(sizes):
    """Targets by repeated resharing, step by step."""
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes))}
    target, left, open_sources = dict.fromkeys(sizes, 0.0), 1.5 * sum(sizes.values()), set(sizes)
    while left > 1e-6 and open_sources:
        share = left / sum(weights[s] for s in open_sources)
        left = 0.0
        for s in sorted(open_sources):
            target[s] += share * weights[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_sources.discard(s)
    return target


def test_mix_meets_its_targets(spark, con):
    of = dict(con.execute("select doc_id, source from documents").fetchall())
    rows = QUERIES["op10_mixing"](spark, SF_DIR).collect()
    assert sorted(rows) == sorted(QUERIES["op10_mixing"](spark, SF_DIR).collect())
    sizes, taken = {}, {}
    for row in rows:
        sizes[of[row.doc_id]] = sizes.get(of[row.doc_id], 0) + row.size
        taken[of[row.doc_id]] = taken.get(of[row.doc_id], 0) + row.taken
        assert row.taken in (0, row.size, 2 * row.size)
    want = poured(sizes)
    for row in rows:
        assert row.source_size == sizes[of[row.doc_id]]
        assert row.target == pytest.approx(want[of[row.doc_id]])
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(30, 0.03 * target), source


def test_classifiers_on_held_out_labels(spark):
    labels = {r.doc_id: r for r in table(spark, LEARNING_DIR, "labels").collect()}
    for name, label, least in (("op3_quality", "quality", 0.9), ("op6_toxicity", "toxic", 0.9)):
        rows = QUERIES[name](spark, LEARNING_DIR).collect()
        assert len(rows) == 1000
        assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
        told = [(r.predicted, labels[r.doc_id][label]) for r in rows if r.held_out and r.doc_id in labels]
        assert sum(p == y for p, y in told) >= least * len(told)


def test_main_texts(spark, con):
    pages = dict(con.execute("select page_id, html from pages").fetchall())
    for row in QUERIES["op7_html_text"](spark, SF_DIR).collect():
        inner = re.search("<article>(.*)</article>", pages[row.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", "\n", inner))).split())
        assert (row.text, row.n_chars) == (want, len(want))


def test_pipeline_stages(spark, con, texts):
    """Each stage is held against what it says on its own input."""
    docs = table(spark, SF_DIR, "documents").cache()
    columns = docs.columns
    toxic = {i for (i,) in con.execute("select doc_id from labels where toxic = 1").fetchall()}
    ids = lambda df: [r.doc_id for r in df.select("doc_id").collect()]
    civil = corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR).cache()
    assert civil.columns == columns and len(set(texts) - set(ids(civil)) - toxic) <= 0.02 * len(texts)
    distinct = corpus_pipeline.STAGES[1][1](spark, civil, SF_DIR).cache()
    assert sorted(ids(distinct)) == sorted(r.doc_id for r in near_dedup.near_duplicates(civil).where("kept").collect())
    clean = corpus_pipeline.STAGES[2][1](spark, distinct, SF_DIR).cache()
    hit = {r.doc_id for r in decontamination.contamination(distinct, table(spark, SF_DIR, "benchmark")).where("contaminated").collect()}
    assert sorted(ids(clean)) == sorted(set(ids(distinct)) - hit)
    mixed = corpus_pipeline.STAGES[3][1](spark, clean, SF_DIR).cache()
    assert mixed.columns == columns and set(ids(mixed)) <= set(ids(clean))
    assert max(np.unique(ids(mixed), return_counts=True)[1]) <= 2
    encoded = corpus_pipeline.STAGES[4][1](spark, mixed, SF_DIR)
    assert sorted(ids(encoded)) == sorted(ids(mixed))
