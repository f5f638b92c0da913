import random

import pytest

from tallymark.llm import pii


@pytest.mark.parametrize("text", ["account BE68 5390 0754 7034 AND", "account BE68 5390 0754 7034 CARD", "account XY13 BE68 5390 0754 7034 OK NO"])
def test_a_word_behind_an_account_is_not_part_of_it(text):
    at = text.index("BE68")
    assert [f"{s.kind}:{s.start}:{s.end}" for s in pii.find_spans(text) if s.kind == "iban"] == [f"iban:{at}:{at + 19}"]


def test_an_account_whose_digits_pass_as_a_card_stays():
    rng = random.Random(2)
    for _ in range(100_000):
        digits = "".join(rng.choice("0123456789") for _ in range(14))
        account = next(a for k in range(2, 99) if pii.mod_97(a := f"GB{k:02}WEST{digits}"))
        if pii.luhn(digits):
            break
    assert [s.kind for s in pii.find_spans(f"account {account} here")] == ["iban", "card"]
