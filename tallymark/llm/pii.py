"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import ship, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id", "local_phone")

# Every pattern starts only where a run of its first characters starts, so long runs are read once.
HINT = re.compile("[0-9@]")  # no kind does without
LOCAL = "[A-Za-z0-9._%+-]"
LOCAL_PART = re.compile(f"{LOCAL}+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[ ./-][0-9]{3,4}[ ./-]?[0-9]{3,4}(?![0-9])")

# Words that speak for a kind when they stand shortly before a span, and words that speak for something else.
CONTEXT = {
    "email": "email mail e-mail contact write correo courriel kontakt",
    "ip": "ip address host server client login logged adresse",
    "card": "card credit debit visa mastercard payment karte tarjeta carte",
    "phone": "phone tel telephone call mobile cell fax whatsapp telefon teléfono téléphone anruf",
    "iban": "iban account bank transfer konto cuenta compte",
    "national_id": "ssn social security national identity passport",
    "local_phone": "phone tel telephone call mobile cell fax whatsapp telefon teléfono téléphone anruf",
}
AGAINST = "version release isbn order invoice page serial build chapter"
BEFORE = 40  # code points searched for such words
# Score of a span without context: what the checksum, or the form alone, is worth.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "national_id": 0.4, "local_phone": 0.3}
FOR, CONTRA = 0.3, -0.3
LEAST_SCORE = 0.6  # added spans only; base spans stay whatever their score
_FOR = {kind: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, text.split())) + r")(?!\w)", re.I) for kind, text in CONTEXT.items()}
_AGAINST = re.compile(r"(?<!\w)(?:" + "|".join(AGAINST.split()) + r")(?!\w)", re.I)


class Span(NamedTuple):
    start: int
    kind: str
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Every second digit from the right is doubled; the sum of all digits is a multiple of ten."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def mod_97(account: str) -> bool:
    """Country and check digits moved to the end, letters as 10 to 35: the number leaves 1 when divided by 97."""
    compact = account.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each ``@``: local characters back to the last match at most, and a domain of two labels or more."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL_PART.match(text, start - 1, start):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in emails(text):
        yield "email", start, end
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 2 * 19 and 12 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield "phone", m.start(), m.end()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest run of groups from each possible start that mod 97 confirms; a word behind the account is not part of it."""
    m = IBAN.search(text)
    while m:
        ends = [m.end(), *(k for k in range(m.end() - 1, m.start(), -1) if text[k] == " ")]
        end = next((end for end in ends if mod_97(text[m.start() : end])), None)
        if end:
            yield m.start(), end
        m = IBAN.search(text, end or m.start() + 4)


def further_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in ibans(text):
        yield "iban", start, end
    for m in NATIONAL_ID.finditer(text):
        if not m[0].startswith(("000", "666", "9")):
            yield "national_id", m.start(), m.end()
    for m in LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m[0])) <= 12:
            yield "local_phone", m.start(), m.end()


def scored(text: str, kind: str, start: int, end: int) -> Span:
    near = text[max(0, start - BEFORE) : start]
    score = PRIOR[kind] + FOR * bool(_FOR[kind].search(near)) + CONTRA * bool(_AGAINST.search(near))
    return Span(start, kind, end, round(min(1.0, max(0.0, score)), 3))


def find_spans(text: str | None) -> list[Span]:
    """All spans of ``text`` by start, then kind as listed. An added span that overlaps a base one is left out, but an account
    that contains a card stays: its digits pass both checks."""
    if not text or not HINT.search(text):
        return []
    spans = [scored(text, *found) for found in base_spans(text)]
    base, taken = list(spans), bytearray(len(text))
    for s in spans:
        taken[s.start : s.end] = b"\1" * (s.end - s.start)
    for found in further_spans(text):
        span = scored(text, *found)
        if span.score < LEAST_SCORE:
            continue
        over = [s for s in base if s.start < span.end and span.start < s.end] if any(taken[span.start : span.end]) else []
        if all(span.kind == "iban" and s.kind == "card" and span.start <= s.start and s.end <= span.end for s in over):
            spans.append(span)
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``found``, an array of (start, kind, end, score).

    Positions are code points, ends exclusive. Base kinds (email, ip, card, phone) always stay; accounts confirmed by
    mod 97, national ids and local phone numbers are added if form and context words together reach ``LEAST_SCORE``.
    NULL and empty texts have no spans; repeated rows, NULL ids and other columns change nothing. Nothing is shuffled.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[s._asdict() for s in find_spans(text)] for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "found": pd.Series(found, dtype=object, index=batch.index)})

    ship(docs.sparkSession)
    narrow = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInPandas(scan, f"doc_id {kind}, found array<struct<start:int,kind:string,end:int,score:double>>")


def joined(spans: Column) -> Column:
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(texts, ",")


def of_kinds(*kinds: str) -> Column:
    return F.filter("found", lambda s: s["kind"].isin(*kinds))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(of_kinds(*BASE_KINDS)), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
