"""The whole pipeline against plain Python, stage after stage on what the stage before it should have kept."""

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from tallymark.llm import tokens, toxicity
from tallymark.llm.common import table

FOLDER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(name):
    return pq.read_table(f"{FOLDER}/{name}.parquet").to_pylist()


def runs(words, n):
    """All runs of ``n`` words; of fewer words, but not of none, the whole."""
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def first_of_copies(texts):
    """The least id of each component of links by 5-word shingles, every pair that shares one compared."""
    sets = {i: runs(re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER)), 5) for i, text in texts.items()}
    holders = {}
    for i, found in sets.items():
        for shingle in found:
            holders.setdefault(shingle, []).append(i)
    shared = Counter(pair for ids in holders.values() for pair in combinations(sorted(ids), 2))
    first = {i: i for i in texts}
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    for _ in links:  # as often as the longest chain could need
        moved = dict(first)
        for a, b in links:
            moved[a] = moved[b] = min(moved[a], moved[b])
        if moved == first:
            break
        first = moved
    return {i for i in texts if first[i] == i}


def holding_no_item(texts):
    split = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    windows = set().union(*(runs(split(row["text"]), 10) for row in rows_of("benchmark")))
    lengths = {len(w) for w in windows}
    clean = set()
    for i, text in texts.items():
        words = split(text)
        if not any(tuple(words[k : k + n]) in windows for n in lengths for k in range(len(words) - n + 1)):
            clean.add(i)
    return clean


def shared_out(sizes):
    """Target of each source: shares by weight, those above twice their size set to it, one after the other."""
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes))}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        level = left / max(1, sum(weight[s] for s in sizes if s not in full))
        over = {s for s in sizes if s not in full and level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in sizes}
        full |= over


def test_run(spark):
    docs = {row["doc_id"]: row for row in rows_of("documents")}
    texts = {i: row["text"] or "" for i, row in docs.items()}
    model = toxicity.fit(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    scores = dict(zip(texts, model.score(list(texts.values()))))
    civil = {i: text for i, text in texts.items() if scores[i] < toxicity.THRESHOLD}
    distinct = {i: civil[i] for i in first_of_copies(civil)}
    clean = {i: distinct[i] for i in holding_no_item(distinct)}
    assert len(texts) > len(civil) > len(distinct) > len(clean) > 0.5 * len(texts)

    got = sorted(corpus_pipeline.run(spark, FOLDER).collect(), key=lambda row: row.start)
    copies = Counter(row.doc_id for row in got)
    assert set(copies) <= set(clean) and max(copies.values()) <= 2
    assert [row.doc_id for row in got] == sorted(row.doc_id for row in got)

    sizes, taken = Counter(), Counter()
    for i, text in clean.items():
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        sizes[docs[i]["source"]] += size
        taken[docs[i]["source"]] += size * copies[i]
    for source, target in shared_out(sizes).items():
        assert abs(taken[source] - target) <= max(30, 0.03 * target), source

    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for row in got:
        ids = [*tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids, tokens.END_ID]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
