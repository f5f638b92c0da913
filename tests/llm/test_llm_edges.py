"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing columns; and the parts of the operators."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from tallymark.llm import common, decontamination, exact_dedup, html_text, mixing, near_dedup, pii, quality, substring_dedup, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = [
    "The quick brown fox jumps over the lazy dog near the old river bank today. It did not look back at all, as far as anybody could see from the bridge.",
    "Nothing in the whole town was as quiet as the library on a long winter evening. People came for the warmth and stayed for the books they found there.",
]
EXTRA = [c for c in "score predicted hash words size rank _id _hash copies a b node component kept cuts bytes key target".split()]


def documents(spark, *rows, extra=True):
    df = spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in EXTRA}) if extra else df


@pytest.fixture(scope="module")
def odd(spark):
    """A NULL and an empty text, a NULL id and source, a repeated row, one long word, one long text."""
    return documents(
        spark, (1, None, "s"), (2, "", "s"), (3, PROSE[0], "s"), (3, PROSE[0], "s"), (4, PROSE[0], None), (None, PROSE[1], "t"),
        (5, "x" * 200_000, "t"), (6, " ".join(f"w{k % 7919}" for k in range(60_000)), "t"), (7, " \t\n ", "s"), (8, "one two", "s"),
    ).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, extra=False)


def by_id(df, *columns):
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=str)


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_exact_dedup(spark, odd, empty):
    got = by_id(exact_dedup.exact_dedup(odd), "keep_id", "group_size", "kept")
    assert (3, 3, 3, True) in got and (4, 3, 3, False) in got and got.count((3, 3, 3, True)) == 2
    assert [g for g in got if g[0] in (1, 2, 7)] == [(1, 7, 3, False), (2, 7, 3, False), (7, 7, 3, True)]  # white space only counts for length
    assert (None, None, 1, True) in got
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_colliding_hashes_do_not_join_texts(spark):
    docs = documents(spark, *[(i, t, "s") for i, t in enumerate(["ab", "a b", "cd", "xyz", "x y z", "abc"])])
    want = by_id(exact_dedup.exact_dedup(docs), "keep_id", "group_size")
    weak = exact_dedup.exact_dedup(docs, digest=lambda text: F.length(text).cast("string"))
    assert by_id(weak, "keep_id", "group_size") == want == [(0, 1, 2), (1, 1, 2), (2, 2, 1), (3, 4, 2), (4, 4, 2), (5, 5, 1)]


def test_decontamination(spark, odd, empty):
    bench = items(spark, (1, PROSE[0]), (2, "ONE two"), (2, "two"), (3, None), (4, ""), (None, "library on"), (9, PROSE[0]))
    got = {g[0]: g[1:] for g in by_id(decontamination.contamination(odd, bench), "n_words", "n_hit", "n_items")}
    assert got[1] == got[2] == got[7] == (0, 0, 0) and got[5] == (1, 0, 0)
    assert got[3] == (31, 31, 2) and got[8] == (2, 2, 1)  # items 1 and 9 share all windows; item 2 has two windows
    assert got[None] == (29, 2, 0)  # the window of an item without an id hits, but names none
    assert by_id(decontamination.clean_documents(odd, bench)) == [(1,), (2,), (5,), (6,), (7,)]
    assert decontamination.clean_documents(odd, bench).columns == odd.columns
    assert decontamination.contamination(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontamination.contamination(odd, items(spark)).collect())


def test_overlapping_windows_count_words_once(spark):
    text = " ".join(f"a{k}" for k in range(25))
    docs = documents(spark, (1, f"x {text} y {text}", "s"), (2, " ".join(f"a{k}" for k in range(9)), "s"), (3, "A0 " * 40, "s"))
    got = by_id(decontamination.contamination(docs, items(spark, (1, text), (2, "a0 " * 12))), "n_hit", "n_items")
    assert got == [(1, 50, 1), (2, 0, 0), (3, 40, 1)]


def test_personal_data(spark, odd, empty):
    assert all(not r.found for r in pii.personal_data(odd).collect() if r.doc_id != 6)
    assert pii.personal_data(empty).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a@b.c@d.e", ["email:0:5"]),
        ("a@b.c_d@e.f", ["email:0:5", "email:5:11"]),
        ("1.2.3.4.5.6.7.256 999.1.1.1", ["ip:0:7"]),
        ("4111 1111 1111 1111 and 4111-1111-1111-1112", ["card:0:19"]),
        ("é call +49 (30) 123-4567 ()", ["phone:7:24"]),
        ("account GB82 WEST 1234 5698 7654 32, not GB83 WEST 1234 5698 7654 32", ["iban:8:35"]),
        ("phone 555-123-4567", ["local_phone:6:18"]),
        ("order 555-123-4567", []),
        ("@" * 1000 + "9" * 5000, []),
    ],
)
def test_spans(text, want):
    assert [f"{s.kind}:{s.start}:{s.end}" for s in pii.find_spans(text)] == want


def brute_removed(text):
    """Units of one text inside a span whose words stood earlier in it: by slices, one run at a time."""
    starts = substring_dedup.sentence_starts(text)
    words = [text[a:b].lower().split() for a, b in zip(starts, [*starts[1:], len(text)])]
    long_enough = lambda x, y: y - x >= 2 and sum(map(len, words[x:y])) >= 20
    n, runs, seen, gone = len(words), set(), set(), set()
    for x in range(n):
        runs |= {next(((x, y) for y in range(x + 1, n + 1) if long_enough(x, y)), None), next(((y, x + 1) for y in range(x, -1, -1) if long_enough(y, x + 1)), None)}
    for x, y in sorted(runs - {None}):
        run = tuple(map(tuple, words[x:y]))
        gone |= set(range(x, y)) if run in seen else set()
        seen.add(run)
    return len(gone)


def test_substring_dedup(spark, odd, empty):
    rows = substring_dedup.substring_dedup(odd).collect()
    got = {r.doc_id: r for r in rows if r.doc_id != 3}
    assert got[1].text is None and got[2].text == "" and got[5].n_removed == 0
    # Document 6 says its first 7,919 words again and again: one sentence, but many units.
    assert got[6].n_removed == brute_removed(odd.where("doc_id = 6").first().text) > 0
    assert (got[4].text, got[4].n_sentences, got[4].n_removed) == ("", 2, 2)  # doc 3 has it first
    assert got[None].text == PROSE[1]
    assert substring_dedup.substring_dedup(empty).count() == 0
    docs = documents(spark, (1, f"Start here now. {PROSE[0]} End.", "s"), (2, f"{PROSE[1]} {PROSE[0]} Own end!\nLast line", "s"), (3, f"{PROSE[1]} {PROSE[1]}", "s"))
    got = {r.doc_id: r.text for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == {1: f"Start here now. {PROSE[0]} End.", 2: f"{PROSE[1]} Own end!\nLast line", 3: ""}


def brute_components(texts):
    sets = {i: set(near_dedup.shingles(t).tolist()) for i, t in texts.items()}
    top = {i: i for i in texts}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in texts:
        for j in texts:
            shared = len(sets[i] & sets[j])
            if i < j and shared and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    """Versions of one text that are similar to some others only; blocks are small, so most pairs meet across blocks."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(80)]
    texts = {}
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(80)] = f"v{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    texts |= {200 + i: texts[i] for i in range(10)} | {300 + i: " ".join(f"u{i}x{k}" for k in range(50)) for i in range(5)}
    monkeypatch.setattr(near_dedup, "BLOCK_DOCUMENTS", 16)
    docs = documents(spark, *[(i, t, "s") for i, t in texts.items()])
    assert dict(by_id(near_dedup.near_duplicates(docs), "component_id")) == brute_components(texts)
    monkeypatch.setattr(near_dedup, "bounded", lambda df, *_: df)
    assert dict(by_id(near_dedup.near_duplicates(docs), "component_id")) == brute_components(texts)


def test_near_duplicates(spark, odd, empty):
    got = by_id(near_dedup.near_duplicates(odd), "n_shingles", "component_id", "kept")
    assert (1, 0, 1, True) in got and (2, 0, 2, True) in got and (7, 0, 7, True) in got
    assert (4, 27, 3, False) in got and (8, 1, 8, True) in got and (None, 25, None, True) in got
    assert by_id(near_dedup.distinct_documents(odd)) == [(1,), (2,), (3,), (3,), (5,), (6,), (7,), (8,), (None,)]
    assert near_dedup.distinct_documents(odd).columns == odd.columns
    assert near_dedup.near_duplicates(empty).count() == 0


def test_few_equal_places_are_given_up_by_the_posterior():
    for places in (30, 120, 240):
        least = near_dedup.least_agreement(places)
        tail = lambda m: sum(math.comb(places + 1, k) * 0.75**k * 0.25 ** (places + 1 - k) for k in range(m + 1))
        assert tail(least) >= near_dedup.MISS > tail(least - 1)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(150)] + [(500, 500 + i) for i in range(1, 40)] + [(rng.randint(900, 1100), rng.randint(900, 1100)) for _ in range(120)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*edges, (7, 7), (None, 1), (1, 0)], "a long, b long")
    want = {x: find(x) for x in top if any(x in e and e[0] != e[1] for e in edges)}
    assert {r["node"]: r["component"] for r in common.components(df, "test").collect()} == want


def test_mixing(spark, odd, empty):
    got = by_id(mixing.mix(odd), "size", "source_size", "target", "taken")
    assert len(got) == 10 and all(g[4] <= 2 * g[1] for g in got) and {g[1] for g in got if g[0] in (1, 2, 7)} == {0}
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns
    taken = sum(g[4] for g in got)
    sizes = sum(r.n for r in mixing.mixed_documents(odd).select(mixing.token_size(F.col("text")).alias("n")).collect())
    assert sizes == taken  # repeated rows are separate documents


def test_equal_documents_share_a_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 7)
    docs = documents(spark, *[(i, "a b c", "hot") for i in range(100)], *[(200 + i, "a b c d", "cold") for i in range(10)])
    got = by_id(mixing.mix(docs, weights=(1, 9)), "target", "taken")
    for ids, words in (((0, 100), 3), ((200, 210), 4)):
        own = [g for g in got if ids[0] <= g[0] < ids[1]]
        assert abs(sum(g[2] for g in own) - own[0][1]) <= words


def test_token_files(spark, odd, empty):
    got = by_id(tokens.token_digest(odd), "start", "n_tokens")
    assert len(got) == 10 and sum(g[2] == 1 for g in got) == 3
    assert sorted(g[1] for g in got)[0] == 0
    assert tokens.token_digest(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=700))
def test_elias_fano(gaps):
    values = np.cumsum(gaps)
    ef = tokens.EliasFano.of(values)
    assert ef.values().tolist() == values.tolist()
    assert [ef.select(i) for i in range(0, len(values), 37)] == values[::37].tolist()
    assert 8 * (len(ef.low) + len(ef.upper)) <= len(values) * (3 + max(0, math.log2((values[-1] + 1) / len(values)))) + 32


def test_a_shard_gives_back_single_documents():
    ids = np.arange(1000, dtype="<u2")
    shard = tokens.Shard(tokens.pack_shard(ids, [0, 10, 10, 400, 1000]))
    assert len(shard) == 4 and shard.offsets().tolist() == [0, 10, 10, 400, 1000]
    assert [len(shard[i]) for i in range(4)] == [10, 0, 390, 600] and shard[3][0] == 400
    with pytest.raises(ValueError, match="not a shard"):
        tokens.Shard(bytes(64))


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aBc éßÅ.,'’!?%$0 9\n\t́ \x1cİΣσ日K<|endoftext|>"), max_size=25))
def test_pieces_have_the_ids_of_the_whole(text):
    encode = tokens.encoder(tokens.tokenizer_definition())
    whole = encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode.encode([text])[0], encode.dtype).tolist() == [*whole, tokens.END_ID]


def test_tokenizer_path():
    assert tokens.tokenizer_definition(public_tokenizers.path("word_bpe_49k.json")) == tokens.tokenizer_definition()


def test_classifiers(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (8, None, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        machine, model = quality.fit(odd, some), toxicity.fit(odd, some)
        for df in (quality.quality(odd, machine), toxicity.toxicity(odd, model)):
            scores = {r.doc_id: r.score for r in df.collect()}
            assert len(scores) == 9 and all(0 <= s <= 1 for s in scores.values()) and scores[1] == scores[2]
        assert quality.quality(empty, machine).count() == toxicity.toxicity(empty, model).count() == 0
    assert toxicity.civil_documents(odd, model).columns == odd.columns
    assert toxicity.fit(empty, labels).score(["you idiot", ""]).shape == (2,)


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["good", "fine"] if i % 2 else ["%%%", "$$$"]) for _ in range(30)), "s") for i in range(200)]
    docs = documents(spark, *rows)
    fold = {r[0] for r in spark.range(200).where(common.held_out(F.col("id"))).collect()}
    labels = [(i, i % 2, 0) for i, _, _ in rows]
    flipped = [(i, 1 - q if i in fold else q, t) for i, q, t in labels]
    scores = [by_id(quality.quality(docs, quality.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"))), "score") for x in (labels, flipped)]
    assert scores[0] == scores[1]
    assert all((s > 0.5) == (i % 2 == 1) for i, s in scores[0])


def test_pairs_of_the_machine_in_linear_time():
    rng = np.random.default_rng(0)
    machine = quality.FactorisationMachine(np.zeros((1, 1)), 0.3, rng.normal(size=20), rng.normal(size=(20, 4)))
    index, x = np.array([1, 5, 7, 19]), rng.normal(size=4)
    pairs = sum(machine.factors[index[a]] @ machine.factors[index[b]] * x[a] * x[b] for a in range(4) for b in range(a))
    want = 1 / (1 + np.exp(-(0.3 + machine.weights[index] @ x + pairs)))
    assert machine.score([(index, x)])[0] == pytest.approx(want)


def test_the_label_model_finds_accurate_and_repeated_voters():
    rng = np.random.default_rng(1)
    toxic = rng.random(20_000) < 0.1
    votes = np.zeros((20_000, toxicity.VOTERS), bool)
    votes[:, 0] = np.where(toxic, rng.random(20_000) < 0.8, rng.random(20_000) < 0.01)
    votes[:, 1] = votes[:, 0]  # repeats the first
    votes[:, 2] = np.where(toxic, rng.random(20_000) < 0.7, rng.random(20_000) < 0.02)
    votes[:, toxicity.NEGATIVE] = ~votes.any(1)
    patterns, counts = np.unique((votes << np.arange(toxicity.VOTERS)).sum(1), return_counts=True)
    posterior, accuracies, correlations = toxicity.label_model(patterns, counts.astype(float), 0.1)
    assert correlations[0, 1] > 0.9 and abs(correlations[0, 2]) < 0.4
    assert posterior[0b111] > 0.9 and posterior[1 << toxicity.NEGATIVE] < 0.1
    assert accuracies[0] > 0.9


def brute_content(model, page):
    """Marginals by adding up all labellings."""
    found, n = html_text.features(page), len(page.nodes)
    unary = [sum(model.weights.get(f, 0.0) for f in names) for names in found]
    total, content = 0.0, [0.0] * n
    for labelling in range(1 << n):
        y = [labelling >> k & 1 for k in range(n)]
        score = sum(u for u, v in zip(unary, y) if v)
        for k in range(1, n):
            node = page.nodes[k]
            score += model.pairs["block" if node.tag in html_text.BLOCK else "inline"][y[node.parent]][y[k]]
        weight = math.exp(score)
        total += weight
        content = [c + weight * v for c, v in zip(content, y)]
    return [c / total for c in content]


def test_messages_give_the_marginals():
    model = html_text.TreeModel(dict(html_text.PRIOR), html_text.PAIRS)
    page = html_text.parse("<body><nav><a>x</a></nav><div class=post><p>A long text, with marks.<b>b</b></p><ul><li>i</ul></div><footer>f</footer>")
    got, _ = model.marginals(page, html_text.features(page))
    assert got == pytest.approx(brute_content(model, page))


def test_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>" * 3000 + "deep"), (None, "u", "<script>var a = '<p>';</script"), (4, "u", "<a b='" * 500)]
    page = "<html><body><nav><a href='/x'>Menu</a></nav><article><h1>T &amp;\n t</h1><p>One<b> two</b>.<p>Three,<br>four.</article><footer>F</footer>"
    pages = spark.createDataFrame([*rows, *[(10, "u", page)] * 2], "page_id long, url string, html string").withColumn("text", F.lit("x"))
    model = html_text.fit(pages)
    got = {(r.page_id, r.text) for r in html_text.main_texts(pages, model).collect()}
    assert (10, "T & t One two. Three, four.") in got and (1, "") in got and (2, "") in got
    assert html_text.main_texts(pages.limit(0), html_text.fit(pages.limit(0))).count() == 0


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    spark.createDataFrame([(3, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items(spark, (1, "library on a long winter evening")).write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, docs in (("odd", odd), ("empty", empty)):
        for _, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(spark, docs, str(tmp_path)).cache()
            assert stage is corpus_pipeline.STAGES[-1][1] or docs.columns == columns
        assert name == "odd" or docs.count() == 0
