import numpy as np
import pytest

from tallymark.llm import tokens


@pytest.mark.parametrize("text", ["a <|EndOfText|> b", "A <|ENDOFTEXT|>", "a <|endoftext|> B", "É<|Endoftext|>x <| Y", "<|StartOfText|> <|startoftext|>"])
def test_markers_in_other_letters_are_ordinary_text(text):
    encode = tokens.encoder(tokens.tokenizer_definition())
    whole = encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode.encode([text])[0], encode.dtype).tolist() == [*whole, tokens.END_ID]
