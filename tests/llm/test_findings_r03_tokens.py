"""Token ids: every piece is encoded once for all texts that are taken at once, and nothing of them stays."""

import gc

import numpy as np
import pyarrow as pa

from tallymark.llm import tokens
from tallymark.llm.features import Memory

ODD = [None, "", " ", "\n \n", "École!? ÉCOLE école", "İstanbul I i̇", "J̌A J̌", "word,word. word.,: don't", "ΣΑΣ σας", "a<|endoftext|>.B <|ENDOFTEXT|>", "ſtraße ẞ Ⱥ Ⱦ", "x\x0b\x0cy\tz\x85q\x00"]


def test_texts_taken_at_once_have_the_ids_of_the_library():
    encode = tokens.encoder(tokens.tokenizer_definition())
    ids, bounds = encode.encode_all(pa.array(ODD * 3))
    assert bounds[0] == 0 and bounds[-1] == len(ids) and len(bounds) == 3 * len(ODD) + 1
    for text, a, b in zip(ODD * 3, bounds, bounds[1:]):
        assert ids[a:b].tolist() == [*encode.tokenizer.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]
    assert [np.frombuffer(p, encode.dtype).tolist() for p in encode.encode(ODD)] == [ids[a:b].tolist() for a, b in zip(bounds[: len(ODD)], bounds[1:])]


def test_encoding_remembers_no_pieces():
    """A worker's memory does not grow with the words it has seen."""
    gc.collect()
    before = sum(len(r() or ()) for r in Memory._all)
    encode = tokens.encoder(tokens.tokenizer_definition())
    encode.encode([" ".join(f"unheard{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(600))])
    assert sum(len(r() or ()) for r in Memory._all) <= before


def test_runs_of_texts_hold_every_row(monkeypatch):
    monkeypatch.setattr(tokens, "TEXT_BYTES", 10)
    texts = pa.array(["é" * 3, None, "", "x" * 50, "y", None, "z" * 9, ""])
    runs = list(tokens.runs_of_texts(pa.array(range(8)), texts))
    assert [k for keys, _ in runs for k in keys.to_pylist()] == list(range(8)) and len(runs) > 2
    assert [t for _, part in runs for t in part.to_pylist()] == texts.to_pylist()
    assert not list(tokens.runs_of_texts(pa.array([], pa.int64()), pa.array([], pa.string())))
