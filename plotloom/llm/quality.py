"""Quality classifier: heuristic labellers, a weak-label model, and a hashed linear scorer.

Seven labellers each call a text good, bad, or abstain.  How often every combination of votes
occurs is counted over all documents (at most 3^7 combinations reach the driver), and
expectation-maximisation fits the share of good texts and of kinds of bad ones, and every labeller's
accuracy on each, taking labellers as independent given the kind.  Each combination then
has a posterior probability of good.

That posterior is the label on which a linear scorer is trained, on a bounded sample of
documents (``SAMPLE_DOCS`` are expected, chosen by hash).  Its features are hashed 4-grams of
character classes and word-repetition marks, so it also judges texts on which the labellers abstain or disagree.
Every text is scored whole.  No column but the text is used.

Defined results: a text without words (null, empty, blanks) has score 0 and is rejected.  Repeated
rows get equal results.  An empty table gives an empty result.  Columns ``score`` and ``keep`` are
replaced, further columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.llm.arrow_text import text_slices
from plotloom.session import short_batches

LABELLERS = ("symbols", "capitals", "echoes", "variety", "sentences", "bare_symbols", "common_words")
GOOD, BAD, ABSTAIN = "g", "b", "-"
BUCKETS = 1024
FEATURES = BUCKETS + 2 + 3 * len(LABELLERS)
FULL_LENGTH = 400
SAMPLE_DOCS = 3000
EM_ROUNDS = 200
THRESHOLD = 0.5

# Frequent short words of English, German, French and Spanish.
COMMON = frozenset(
    w.encode()
    for w in (
        "the of and to in is that for it as was with be by on are from this at or an which not"
        " der die das und ist von mit den dem nicht zu ein eine auf für als auch"
        " le la les des et en un une du dans que pour est par sur au avec"
        " de el los las y por con para una es se del su al lo no"
    ).split()
)

# Classes of bytes: letters, digits, blanks, sentence marks, single symbols, bytes beyond ASCII.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[32, 9, 13]] = 4
_CLASS[10] = 5
_CLASS[[ord(c) for c in ",;:"]] = 6
_CLASS[[ord(c) for c in ".?"]] = 7
_CLASS[ord("!")] = 8
_CLASS[[ord(c) for c in "'-\"()"]] = 9
_CLASS[ord("|")] = 10
_CLASS[[ord(c) for c in "#*%&$"]] = 11
_CLASS[[ord(c) for c in "<>{}[]=/\\"]] = 12
_CLASS[128:] = 1


def _vote(good: bool, bad: bool) -> str:
    return GOOD if good else BAD if bad else ABSTAIN


def votes(text: bytes) -> str:
    """One letter per labeller."""
    words = text.split()
    if not words:
        return ABSTAIN * len(LABELLERS)
    classes = np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=13)
    inked = max(int(classes.sum() - classes[4] - classes[5]), 1)
    symbols = float(classes[[0, 8, 10, 11, 12]].sum()) / inked
    letters = int(classes[1] + classes[2])
    capitals = float(classes[2]) / max(letters, 1)
    n = len(words)
    echoes = sum(a == b for a, b in zip(words, words[1:])) / max(n - 1, 1)
    variety = len(set(words)) / n
    ends = sum(w.endswith((b".", b"?", b"!")) for w in words) / n
    letterless = sum(not w.strip(b"|#*%&$!<>{}[]=/\\~^+_-") for w in words) / n
    common = sum(w in COMMON for w in words) / n
    many = n >= 30
    return "".join(
        (
            _vote(symbols < 0.02, symbols > 0.06),
            _vote(letters >= 20 and capitals < 0.15, letters >= 20 and capitals > 0.4),
            _vote(n >= 5 and echoes < 0.02, n >= 5 and echoes > 0.08),
            _vote(many and variety > 0.35 + 5 / n, many and variety < 0.2),
            _vote(many and 0.01 < ends < 0.5, many and (ends < 0.004 or ends > 0.7)),
            _vote(letterless < 0.01, letterless > 0.05),
            _vote(many and common > 0.1, many and common < 0.03),
        )
    )


def fit_labellers(patterns: dict[str, int]) -> dict[str, float]:
    """Posterior probability of good for each combination of votes.

    Expectation-maximisation over good texts and one kind of bad ones per labeller: junk comes in
    kinds, and most labellers find nothing wrong with a kind that is not theirs.  Every kind starts
    where its own labeller says bad, and good where none does; shares and rates are then estimated.
    An abstention says nothing about the kind.
    """
    if not patterns:
        return {}
    names = sorted(patterns)
    amount = np.array([patterns[p] for p in names], dtype=float)
    choice = np.array([["gb-".index(v) for v in p] for p in names])
    kinds = 1 + len(LABELLERS)
    share = np.array([0.8] + [0.2 / len(LABELLERS)] * len(LABELLERS))
    # rates[kind, labeller, vote]; kind 0 is good; the third vote is none and has weight 1.
    rates = np.ones((kinds, len(LABELLERS), 3))
    rates[:, :, :2] = 0.75, 0.25
    rates[0, :, :2] = 0.97, 0.03
    for j in range(len(LABELLERS)):
        rates[1 + j, j, :2] = 0.1, 0.9
    labeller = np.arange(len(LABELLERS))
    posterior = np.empty((kinds, len(names)))
    for _ in range(EM_ROUNDS):
        logs = np.log(rates[:, labeller, choice]).sum(axis=2) + np.log(share)[:, None]
        posterior = np.exp(logs - logs.max(axis=0))
        posterior /= posterior.sum(axis=0)
        weight = amount * posterior
        before = rates.copy()
        share = (weight.sum(axis=1) + 0.1) / (amount.sum() + 0.1 * kinds)
        for vote in range(2):
            rates[:, :, vote] = weight @ (choice == vote) + 0.1
        rates[:, :, :2] /= rates[:, :, :2].sum(axis=2, keepdims=True)
        if np.abs(rates - before).max() < 1e-9:
            break
    return dict(zip(names, posterior[0].tolist()))


def features(text: bytes, pattern: str) -> np.ndarray:
    """Hashed character-class 4-grams, repetition of words, and the votes.

    Gram counts are divided by at least ``FULL_LENGTH``, so that a short text, about which they tell
    little, is judged by the rest.
    """
    out = np.zeros(FEATURES, dtype=np.float32)
    words = text.split()
    if not words:
        return out
    c = _CLASS[np.frombuffer(text, dtype=np.uint8)]
    if len(c) >= 4:
        code = ((c[:-3] * 13 + c[1:-2]) * 13 + c[2:-1]) * 13 + c[3:]
        counts = np.bincount((code * 2654435761 >> 7) % BUCKETS, minlength=BUCKETS)
        out[:BUCKETS] = np.sqrt(counts / max(len(code), FULL_LENGTH))
    out[BUCKETS] = np.sqrt(sum(a == b for a, b in zip(words, words[1:])) / len(words))
    out[BUCKETS + 1] = np.sqrt(1 - len(set(words)) / len(words))
    for j, vote in enumerate(pattern):
        out[BUCKETS + 2 + 3 * j + "gb-".index(vote)] = 1
    return out


def train_scorer(x: np.ndarray, label: np.ndarray, rounds: int = 300, rate: float = 0.1, ridge: float = 1e-4) -> np.ndarray:
    """Weights and intercept of a logistic scorer for soft labels, by gradient steps."""
    z = np.column_stack((x, np.ones(len(x), dtype=np.float32)))
    w = np.zeros(z.shape[1], dtype=np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ ((p - label) / len(label)).astype(np.float32) + ridge * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w.astype(np.float64)


def vote_counts(docs: DataFrame) -> DataFrame:
    """(votes, n) over all documents; each task adds up its own first."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        for _, texts in text_slices(batches):
            for text in texts:
                pattern = votes(text)
                found[pattern] = found.get(pattern, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["votes", "n"]
        )

    return docs.select("text").mapInArrow(count, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, size: int = SAMPLE_DOCS) -> np.ndarray | None:
    """The scorer for a table of documents; None if it has none."""
    with short_batches(docs.sparkSession):
        patterns = {row["votes"]: row["n"] for row in vote_counts(docs).collect()}
    posterior = fit_labellers(patterns)
    if not patterns:
        return None
    place = F.shiftrightunsigned(F.xxhash64("text", F.lit("quality")), 11) / float(1 << 53)

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches):
            patterns = [votes(t) for t in texts]
            rows = [features(t, p).tobytes() for t, p in zip(texts, patterns)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(patterns)], ["x", "votes"])

    # One of each text, and a share of the different texts: copies would not add anything, could go beyond
    # the bound, and however many there are, few texts are all taken.
    different = docs.select(F.xxhash64("text").alias("h")).distinct().count()
    chosen = docs.select("text").where(place < min(1.0, size / different)).dropDuplicates(["text"])
    with short_batches(docs.sparkSession):
        sample = chosen.mapInArrow(describe, "x binary, votes string").toArrow()
    if not len(sample):
        return None
    # Summed in a fixed order, whatever order the rows came in.
    rows = sorted(zip(sample.column("x").to_pylist(), sample.column("votes").to_pylist()))
    x = np.frombuffer(b"".join(r[0] for r in rows), dtype=np.float32).reshape(len(rows), -1)
    return train_scorer(x, np.array([posterior[r[1]] for r in rows]))


def judge(docs: DataFrame, scorer: np.ndarray | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with ``score`` (0 to 1, higher is better) and ``keep``."""
    others = [f for f in docs.schema.fields if f.name.lower() not in ("score", "keep")]
    schema = docs.select(*[F.col(f"`{f.name}`") for f in others]).schema.add("score", "double").add("keep", "boolean")
    names = [f.name for f in others]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            x = np.array([features(t, votes(t)) for t in texts])
            value = np.zeros(len(texts))
            if scorer is not None:
                value = 1 / (1 + np.exp(-np.clip(x @ scorer[:-1] + scorer[-1], -30, 30)))
            value[[not t.strip() for t in texts]] = 0.0
            columns = [part.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(value), pa.array(value >= threshold)], [*names, "score", "keep"]
            )

    return docs.select(*[F.col(f"`{name}`") for name in names]).mapInArrow(score, schema)


def classify(docs: DataFrame) -> DataFrame:
    """Weak-label model and scorer from these documents, applied to all of them."""
    return judge(docs, train(docs))
