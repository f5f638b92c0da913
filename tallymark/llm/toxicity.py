"""Toxicity by weak supervision: voters, a generative model of their votes, a linear classifier on its posteriors."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import held_out, ship, table
from tallymark.sources.scratch import write_through
from tallymark.llm.features import EDGES, Remembered, bucket, in_parts, labelled_sample, logistic, rows_of, uncollected

MAX_MINED = 16_000  # labelled rows that lexicons are mined from, on the executors
MAX_LABELLED = 6_000  # labelled rows whose features the classifier is trained on, on the driver
SKETCH = 4  # least hashes by which labelled rows are looked for that may be copies
COPY = 0.75  # similarity of copies
LEAST_DOCUMENTS = 6  # labelled toxic documents a mined term stands in
LEAST_LOG_ODDS = 4.0
MOST_OTHERS = 0.02  # other documents with a mined term, as a share of the toxic ones
WORD_VOTERS, PREFIX_VOTERS = 5, 3
BUCKETS = 1 << 17
EPOCHS, BATCH, RATE = 10, 128, 0.2
THRESHOLD = 0.5

# Common insults of four languages, and phrases that threaten or address somebody.
INSULTS = frozenset(
    """idiot moron stupid dumb scum loser pathetic worthless trash clown disgusting fool bastard bitch asshole retard jerk
    dummkopf arschloch trottel depp blödmann abschaum versager wichser hurensohn schlampe
    connard imbécile abruti salaud crétin débile ordure pourriture
    imbécil estúpido gilipollas cabrón basura escoria inútil asqueroso""".split()
)
THREAT = re.compile(r"\b(?:kill|hurt|beat|destroy|shoot|hang) (?:you|them|him|her|yourself)\b|\bgo (?:and )?die\b|\bshut up\b|\bi hate (?:you|them)\b", re.I)
ADDRESSED = re.compile(r"\b(?:you(?: are|'re)?(?: an?| such an?)?|this|that|du(?: bist)?|tu es|eres) (\w+)", re.I)
THREAT_WORDS = frozenset("kill hurt beat destroy shoot hang die shut hate".split())  # without one of them no threat is looked for
MASKED = re.compile(r"[a-z]{1,3}[*@#$!]{2,}[a-z]{1,4}$", re.I)
# Positive voters, then the one that speaks against toxicity.
VOTERS = WORD_VOTERS + PREFIX_VOTERS + 4
SEEDS, PATTERNS, MASKS, NEGATIVE = range(VOTERS - 4, VOTERS)


def _terms(piece: str) -> tuple[str, ...]:
    """A word without marks at its ends, in lower case, and its prefixes of 4 and 5 letters, marked as such."""
    word = piece.strip(EDGES).lower()
    if len(word) > 5:
        return word, word[:4] + "~", word[:5] + "~"
    return (word, word[:4] + "~") if len(word) > 4 else (word,) if word else ()


TERMS = Remembered(_terms)
_COLUMNS = Remembered(lambda piece: tuple(VOTERS + bucket(term, BUCKETS) for term in _terms(piece)))


def terms_of(text: str | None) -> set[str]:
    return {term for piece in set((text or "").split()) for term in TERMS[piece]}


@dataclass
class Toxicity:
    """Mined terms with the voter each belongs to, the label model's table of posteriors by votes, the linear classifier."""

    lexicon: dict[str, int]
    posterior: np.ndarray | None = None
    accuracies: np.ndarray | None = None
    correlations: np.ndarray | None = None
    bias: float = 0.0
    weights: np.ndarray | None = None

    def votes(self, text: str | None, pieces: set[str] | None = None) -> int:
        """One bit per voter. The negative voter speaks if no other does."""
        text = text or ""
        return self._votes(text, map(_memory(self).bits.__getitem__, set(text.split()) if pieces is None else pieces))

    def _votes(self, text: str, spoken: Iterable[int]) -> int:
        bits = 0
        for more in set(spoken):
            bits |= more
        threat, bits = bits >> VOTERS, bits & (1 << VOTERS) - 1
        if bits and any(m[1].lower() in INSULTS or m[1].lower() in self.lexicon for m in ADDRESSED.finditer(text)):
            bits |= 1 << PATTERNS
        if threat and THREAT.search(text):
            bits |= 1 << PATTERNS
        return bits or 1 << NEGATIVE

    def bits_of(self, piece: str, terms: tuple[str, ...] | None = None) -> int:
        """Bits of the voters that know the piece; one more bit for words of threats."""
        bits = 1 << MASKS if MASKED.match(piece) else 0
        for term in _terms(piece) if terms is None else terms:
            if term in self.lexicon:
                bits |= 1 << self.lexicon[term]
            if term in INSULTS:
                bits |= 1 << SEEDS
            if term in THREAT_WORDS:
                bits |= 1 << VOTERS
        return bits

    def columns(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The votes, and the hashed terms of the distinct pieces of a text with their numbers over the root of all pieces."""
        pieces = set((text or "").split())
        votes = self.votes(text, pieces)
        voted = [j for j in range(VOTERS) if votes >> j & 1]
        terms, numbers = np.unique(np.fromiter(chain.from_iterable(map(_COLUMNS.__getitem__, pieces)), np.int64), return_counts=True)
        return np.concatenate([np.array(voted, np.int64), terms]), np.concatenate([np.ones(len(voted)), numbers / np.sqrt(max(1, len(pieces)))])

    @uncollected
    def score(self, texts: list[str | None]) -> np.ndarray:
        """As the sum over ``columns``, piece by piece: a piece always adds the same, so that is remembered."""
        memory, found = _memory(self), []
        for text in texts:
            text = text or ""
            known = list(map(memory.scored.__getitem__, set(text.split())))
            votes = self._votes(text, map(itemgetter(0), known))
            voted = sum(memory.weights[j] for j in range(VOTERS) if votes >> j & 1)
            found.append(self.bias + voted + math.fsum(map(itemgetter(1), known)) / math.sqrt(max(1, len(known))))
        return logistic(np.array(found))


class _Memory:
    """What a model says of single pieces; ``fsum`` makes their sum independent of the order."""

    def __init__(self, model: Toxicity):
        self.model, self.bits, self.scored = model, Remembered(model.bits_of), Remembered(self._score)
        self.weights = [] if model.weights is None else model.weights.tolist()

    def _score(self, piece: str) -> tuple[int, float]:
        terms = _terms(piece)
        return self.model.bits_of(piece, terms), sum([self.weights[VOTERS + bucket(term, BUCKETS)] for term in terms])


_MEMORY: list[_Memory] = []


def _memory(model: Toxicity) -> _Memory:
    if not _MEMORY or _MEMORY[0].model is not model or len(_MEMORY[0].weights) != (0 if model.weights is None else len(model.weights)):
        _MEMORY[:] = [_Memory(model)]
    return _MEMORY[0]


def word_pairs(text: str | None) -> set[str]:
    """Two neighbouring words each; of a single word the word."""
    pieces = (text or "").split()
    return {f"{a} {b}" for a, b in zip(pieces, pieces[1:])} or set(pieces)


def sketch(text: str | None) -> str:
    """The ``SKETCH`` least hashes of word pairs; of documents with fewer, all."""
    return ",".join(map(str, sorted({bucket(pair, 1 << 32) for pair in word_pairs(text)})[:SKETCH]))


def alike(text: str | None, other: str | None) -> bool:
    """Whether word pairs are shared as between copies; texts without words are."""
    a, b = word_pairs(text), word_pairs(other)
    return len(a & b) >= COPY * len(a | b)


def distinct_sample(sample: DataFrame) -> DataFrame:
    """``text, label`` of the rows that are no copies: of those with one label and one sketch the least by id and text, and
    all others that are not :func:`alike` to it. The sketch proposes copies, and whole texts confirm them."""
    sketched = F.pandas_udf(lambda texts: texts.map(sketch), "string")
    copies = F.pandas_udf(lambda texts, others: pd.Series([alike(*pair) for pair in zip(texts, others)], dtype=bool), "boolean")
    told = write_through(sample.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label").withColumn("sketch", sketched("text")), "toxic-sketches")
    first = told.groupBy("sketch", "label").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    pairs = told.join(first, ["sketch", "label"])
    others = pairs.where(F.struct("doc_id", "text") != F.col("first")).where(~copies("text", "first.text"))
    others = write_through(others.select("text", "label"), "toxic-others")  # in one task with a second function it would hold two Python workers
    return first.select("first.text", "label").unionByName(others)


def mined_lexicon(sample: DataFrame) -> dict[str, int]:
    """Terms far more frequent in toxic than in other labelled documents, dealt to voters by hash.

    Copies of a document would turn all of its words into signs of its label, so they are dropped before anything is counted,
    see :func:`distinct_sample`. All terms that are strong enough are kept; the sample bounds how many there can be.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        documents = Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                counts[int(label)].update(terms_of(text))
                documents[int(label)] += 1
        yield pd.DataFrame({"term": [""], "toxic": [documents[1]], "other": [documents[0]]})  # no term is empty
        terms = pd.Series([*counts[1], *(t for t in counts[0] if t not in counts[1])], dtype=object)
        yield pd.DataFrame({"term": terms, "toxic": terms.map(counts[1]).astype(int), "other": terms.map(counts[0]).astype(int)})

    sample = distinct_sample(sample)
    counted = sample.mapInPandas(count, "term string, toxic long, other long").groupBy("term")
    summed = write_through(counted.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where(f"term = '' or toxic >= {LEAST_DOCUMENTS}"), "toxic-terms")
    totals = summed.where("term = ''").first()
    if totals is None or not totals["toxic"]:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (totals["toxic"] + 1)) - F.log((F.col("other") + 0.5) / (totals["other"] + 1))
    strong = summed.where("term <> ''").withColumn("odds", odds).where((F.col("toxic") >= LEAST_DOCUMENTS) & (F.col("odds") >= LEAST_LOG_ODDS) & (F.col("other") <= MOST_OTHERS * F.col("toxic")))
    terms = [row["term"] for row in strong.orderBy("term").collect()]
    return {t: WORD_VOTERS + bucket(t, PREFIX_VOTERS) if t.endswith("~") else bucket(t, WORD_VOTERS) for t in terms}


def label_model(patterns: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of toxicity for every set of votes, the voters' accuracies and their correlations.

    Expectation and maximisation over counted sets of votes give how often each voter speaks in either class. What two
    voters still share within the classes is their correlation; a voter's evidence is divided by one plus its
    correlations, so voters that repeat each other do not count twice.
    """
    votes = (patterns[:, None] >> np.arange(VOTERS) & 1).astype(float)
    speak = np.where(np.arange(VOTERS) == NEGATIVE, np.array([[0.95], [0.1]]), np.array([[0.02], [0.4]]))  # class, voter
    trust, share = np.ones(VOTERS), prior
    correlations = np.zeros((VOTERS, VOTERS))

    def evidence(votes: np.ndarray) -> np.ndarray:
        per_vote = np.log(speak[1] / speak[0]), np.log((1 - speak[1]) / (1 - speak[0]))
        # Silence says little of a voter that hardly ever speaks; it counts like a vote does, by the voter's trust.
        return np.log(share / (1 - share)) + (votes * trust * per_vote[0] + (1 - votes) * trust * per_vote[1]).sum(1)

    total = max(1.0, counts.sum())
    for _ in range(rounds):
        toxic = logistic(evidence(votes))
        for k, weight in enumerate((counts * (1 - toxic), counts * toxic)):
            # Ten imagined documents keep a voter near its start until data speak.
            speak[k] = (weight @ votes + 10 * speak[k]) / (weight.sum() + 10)
        speak = np.clip(speak, 1e-6, 1 - 1e-6)
        share = float(np.clip((counts @ toxic) / total, 1e-4, 0.5))
        within = np.zeros((VOTERS, VOTERS))
        for k, weight in enumerate((counts * (1 - toxic), counts * toxic)):
            centred = votes - speak[k]
            within += (centred * weight[:, None]).T @ centred
        spread = np.sqrt(np.maximum(np.diag(within), 1e-9))
        correlations = within / spread / spread[:, None]
        trust = 1 / (1 + np.clip(correlations - np.eye(VOTERS), 0, 1).sum(0))
    every = (np.arange(1 << VOTERS)[:, None] >> np.arange(VOTERS) & 1).astype(float)
    right = share * speak[1] + (1 - share) * (1 - speak[0])
    right[NEGATIVE] = 1 - right[NEGATIVE]
    return logistic(evidence(every)), right, correlations


def fit(docs: DataFrame, labels: DataFrame, max_mined: int = MAX_MINED, max_labelled: int = MAX_LABELLED) -> Toxicity:
    """Mine lexicons from at most ``max_mined`` labelled rows, count votes over all of ``docs``, fit the label model to the counts, and train the
    classifier on the posteriors of at most ``max_labelled`` rows. Voters are few, so sets of votes are at most 2 ** VOTERS."""
    spark = docs.sparkSession
    ship(spark)
    sample = write_through(labelled_sample(docs, labels, "toxic", max_mined), "toxic-sample")
    model = Toxicity(mined_lexicon(sample))
    shared = spark.sparkContext.broadcast(model)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = Counter(shared.value.votes(text) for part in in_parts(batches) for text in part["text"].to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(counted, pa.int32()), pa.array(counted.values(), pa.int64())], ["votes", "documents"])

    counted = docs.select("text").mapInArrow(vote, "votes int, documents long").groupBy("votes").agg(F.sum("documents").alias("documents")).toPandas().sort_values("votes")
    prior = sample.agg(F.avg("label")).first()[0]
    model.posterior, model.accuracies, model.correlations = label_model(
        counted["votes"].to_numpy(np.int64), counted["documents"].to_numpy(float), min(0.5, max(0.01, prior if prior is not None else 0.1))
    )

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [shared.value.columns(text) for text in batch["text"]]
            votes = [shared.value.votes(text) for text in batch["text"]]
            packed = [(c.astype(np.int32).tobytes(), x.astype(np.float32).tobytes()) for c, x in rows]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "votes": votes, "columns": [c for c, _ in packed], "x": [x for _, x in packed]})

    taught = labelled_sample(docs, labels, "toxic", max_labelled).select("doc_id", "text")
    found = taught.mapInPandas(extract, "doc_id long, votes int, columns binary, x binary").toPandas().sort_values(["doc_id", "columns"])
    rows = [(np.frombuffer(c, np.int32), np.frombuffer(x, np.float32)) for c, x in zip(found["columns"], found["x"])]
    model.bias, model.weights = linear(rows, model.posterior[found["votes"].to_numpy(np.int64)] if len(found) else np.zeros(0))
    return model


def linear(rows: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, seed: int = 7) -> tuple[float, np.ndarray]:
    """Logistic regression on soft labels. It starts as the negative voter would decide, so it is defined without rows too."""
    weights = np.zeros(VOTERS + BUCKETS)
    grown = np.full(VOTERS + BUCKETS, 1e-2)
    bias, grown_bias, rng = -2.0, 1e-2, np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            taken = order[at : at + BATCH]
            index, starts = rows_of(rows[i][0] for i in taken)
            x, _ = rows_of(rows[i][1] for i in taken)
            row = np.repeat(np.arange(len(taken)), np.diff([*starts, len(index)]))
            error = logistic(bias + np.add.reduceat(weights[index] * x, starts)) - targets[taken]
            unique, place = np.unique(index, return_inverse=True)
            slope = np.bincount(place, error[row] * x) / len(taken) + 1e-6 * weights[unique]
            grown[unique] += slope**2
            grown_bias += error.mean() ** 2
            weights[unique] -= RATE * slope / np.sqrt(grown[unique])
            bias -= float(RATE * error.mean() / np.sqrt(grown_bias))
    return bias, weights


def _scored(docs: DataFrame, model: Toxicity, kept: list[str]) -> DataFrame:
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [shared.value.score(part.to_pylist()) for part in in_parts([texts])]
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return docs.select(*kept, score("text").alias("_score"))


def toxicity(docs: DataFrame, model: Toxicity) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    The score is the probability of toxicity 1, and ``predicted`` is 1 from ``THRESHOLD`` on. NULL texts count as empty, on
    which only the negative voter speaks; repeated rows get equal scores; NULL ids are not held out; other columns are not
    read. Nothing is shuffled.
    """
    scored = _scored(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def civil_documents(docs: DataFrame, model: Toxicity) -> DataFrame:
    """The rows of ``docs`` with a score under ``THRESHOLD``, with the columns of ``docs``."""
    return _scored(docs, model, docs.columns).where(F.col("_score") < THRESHOLD).select(*docs.columns)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
