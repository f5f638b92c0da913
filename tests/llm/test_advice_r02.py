"""Passages, copies, marks and accounts that were missed once."""

import random

import pytest

from tallymark.llm import substring_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA)


def prose(seed, n, blank=" "):
    rng = random.Random(seed)
    return blank.join(rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(n))


@pytest.mark.parametrize("before", [0, 1, 3, 9, 30])
@pytest.mark.parametrize("middle", [prose(1, 52), prose(1, 16) + ". " + prose(2, 18) + "! " + prose(3, 18), prose(1, 30) + "\n" + prose(2, 22)])
def test_a_repeated_passage_holds_a_span_wherever_it_begins(before, middle):
    first = f"{prose(4, 40)} {middle} {prose(5, 40)}"
    later = f"{prose(6, before)} {middle} {prose(7, 30 - before)}".strip()
    found = [{tuple(s[2:]) for s in substring_dedup.spans(text).tolist()} for text in (first, later)]
    assert found[0] & found[1]


def test_passages_that_are_not_whole_sentences(spark):
    one, hindi = prose(1, 60), " ".join(f"{prose(k, 9)}।" for k in range(10, 16))
    han = "".join(chr(0x4E00 + random.Random(8).randrange(5000) * 3 % 20000 + k) for k in range(80))
    tags = " ".join("#" + w for w in prose(2, 60).split())
    rows = [(1, one), (2, one), (3, f"{prose(3, 33)} {tags} {prose(4, 8)}"), (4, f"{prose(5, 20)} {tags}"), (5, hindi), (6, f"Own. {hindi}"), (7, han), (8, han)]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(documents(spark, *rows)).collect()}
    assert all(got[i].n_removed == 0 and got[i].text == dict(rows)[i] for i in (1, 3, 5, 7))
    assert got[2].text == got[8].text == "" and got[6].text == "Own. "
    assert got[4].text.startswith(prose(5, 20)) and len(got[4].text.split()) <= 20 + 16


def test_units_are_short_and_begin_with_words():
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choice(["word", "Ab", " ", " ", " ", "x" * 3, ". ", "!\n", "\n", "।", "語", "é", "İ", "Σ", "\x1c"]) for _ in range(rng.randrange(150)))
        starts = substring_dedup.sentence_starts(text)
        assert starts == sorted(set(starts)) and (not text or starts[0] == 0)
        pieces = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]
        assert all(len(p.replace("語", " 語 ").split()) <= substring_dedup.LONGEST for p in pieces)
        assert [p for p in pieces if p[:1].isspace()] in ([], [pieces[0]] if pieces else [])


def test_only_copies_are_dropped_from_the_lexicon_sample_however_it_is_dealt(spark):
    common = min((f"{a} {b}" for a in "abcdefgh" for b in "abcdefgh"), key=lambda pair: toxicity.bucket(pair, 1 << 32))
    texts = [f"{common} {prose(k, 3)}" for k in range(60)]
    rows = [(k, t, int(k % 3 == 0)) for k, t in enumerate(texts)] + [(100 + k, texts[0], k % 2) for k in range(40)] + [(200, None, 0), (201, "", 0)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int")
    found = [sorted(map(tuple, toxicity.distinct_sample(sample.repartition(n)).collect()), key=str) for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) == 60 + 1 + 1
    lexicons = [toxicity.mined_lexicon(sample.repartition(n)) for n in (1, 7)]
    assert lexicons[0] == lexicons[1]
