"""Toxicity by class-conditional Kneser-Ney models of characters within words.

Two models, of toxic and of ordinary text, give the probability of every byte after the five
before it in the word.  Lower orders use continuation counts.  All orders but the highest are
counted over both classes together, and the highest one backs off to them with ``SHARED``
pseudo-counts besides the discount; so where a class has seen little, both models say the same
and rare words move a text to neither side.

A word's value is its log-likelihood under the toxic model less that under the ordinary one.  A
text's score comes from length-normalised figures of its words' values: the mean, the mean excess over
``EXCESS`` and its logarithm, and the mean of the three greatest, together with the logarithm of
the length.  A logistic function of them, fitted on labelled documents that the counts have not seen,
gives the probability of label 1.

The models are fitted on a bounded sample of labelled documents (``SAMPLE_DOCS`` per class
are expected, chosen by hash), so their size is bounded as well: some hundred thousand n-grams, which
are broadcast.  Every text is scored whole.

Defined results: words are cut at ASCII blanks and lower-cased (A to Z).  Null and empty texts and
texts of blanks get the share of label 1 as score.  Labels other than 0 and 1 are ignored; of several labels of one document
the greatest counts.  Repeated rows get equal results.  Without labels of both
classes the score is that share, or 0.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.llm.arrow_text import text_slices
from plotloom.operators.sizing import broadcast_if_small, cut_lineage

ORDER = 6
DISCOUNT = 0.75
# Pseudo-counts with which the highest order of a class leans on the shared model.
SHARED = 50.0
EXCESS = 2.0
# Expected labelled documents per class from which the models are fitted.
SAMPLE_DOCS = 4000
# Share of the sample that is left to the logistic function.
CALIBRATION = 1 / 3
# Words whose values a task remembers; beyond it the memory is emptied.
REMEMBERED = 500_000
THRESHOLD = 0.3
FEATURES = 5


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key, word): the six bytes up to each byte of each word and up to the blank after it."""
    lead = b" " * (ORDER - 1)
    data = np.frombuffer(b"".join(lead + w + b" " for w in words), dtype=np.uint8).astype(np.uint64)
    lengths = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
    keys = np.zeros(max(len(data) - ORDER + 1, 0), dtype=np.uint64)
    for j in range(ORDER):
        keys = (keys << np.uint64(8)) | data[j : j + len(keys)]
    owner = np.repeat(np.arange(len(words)), lengths)
    # Word i begins after i leads and all earlier words.
    return keys[np.arange(len(owner)) + owner * (ORDER - 1)], owner


def _tail(keys: np.ndarray, n: int) -> np.ndarray:
    return keys & np.uint64((1 << (8 * n)) - 1)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


@dataclass
class Model:
    """Sorted keys with counts, per order; ``ratios`` has the finished values of known six-grams."""

    keys: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    types: list[np.ndarray]
    top: np.ndarray
    top_totals: np.ndarray
    top_types: np.ndarray
    ratios: np.ndarray = field(default_factory=lambda: np.empty(0))

    def _ratio(self, keys: np.ndarray) -> np.ndarray:
        shared = np.full(len(keys), 1 / 256)
        for n in range(1, ORDER + 1):
            own = _tail(keys, n)
            place, hit = _find(self.keys[n], own)
            count = np.where(hit, self.counts[n][place], 0) if len(hit) and len(self.keys[n]) else np.zeros(len(own))
            place, hit = _find(self.contexts[n], own >> np.uint64(8))
            if len(self.contexts[n]):
                total = np.where(hit, self.totals[n][place], 0)
                types = np.where(hit, self.types[n][place], 0)
                backed = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * types * shared) / np.maximum(total, 1)
                shared = np.where(total > 0, backed, shared)
        place, hit = _find(self.keys[ORDER], keys)
        ctx, ctx_hit = _find(self.contexts[ORDER], keys >> np.uint64(8))
        logs = []
        for j in (0, 1):
            if not len(self.keys[ORDER]):
                return np.zeros(len(keys))
            count = np.where(hit, self.top[place, j], 0)
            total = np.where(ctx_hit, self.top_totals[ctx, j], 0)
            types = np.where(ctx_hit, self.top_types[ctx, j], 0)
            logs.append(
                np.log((np.maximum(count - DISCOUNT, 0) + (SHARED + DISCOUNT * types) * shared) / (total + SHARED))
            )
        return logs[1] - logs[0]

    def finish(self) -> Model:
        self.ratios = self._ratio(self.keys[ORDER])
        return self

    def word_values(self, words: list[bytes]) -> np.ndarray:
        keys, owner = grams(words)
        place, hit = _find(self.keys[ORDER], keys)
        value = np.where(hit, self.ratios[place], 0.0) if len(self.ratios) else np.zeros(len(keys))
        if not hit.all():
            value[~hit] = self._ratio(keys[~hit])
        return np.bincount(owner, value, minlength=len(words))


def build_model(keys: np.ndarray, counts: np.ndarray) -> Model:
    """From the distinct six-grams, sorted, and their counts by class, (n, 2)."""
    empty = np.empty(0)
    all_keys: list[np.ndarray] = [empty] * (ORDER + 1)
    all_counts: list[np.ndarray] = [empty] * (ORDER + 1)
    contexts: list[np.ndarray] = [empty] * (ORDER + 1)
    totals: list[np.ndarray] = [empty] * (ORDER + 1)
    types: list[np.ndarray] = [empty] * (ORDER + 1)
    all_keys[ORDER], all_counts[ORDER] = keys, counts.sum(axis=1)
    for n in range(ORDER - 1, 0, -1):
        # How many different bytes precede the n-gram.
        all_keys[n], all_counts[n] = np.unique(_tail(all_keys[n + 1], n), return_counts=True)
    for n in range(1, ORDER + 1):
        contexts[n], place = np.unique(all_keys[n] >> np.uint64(8), return_inverse=True)
        totals[n] = np.bincount(place, all_counts[n], minlength=len(contexts[n]))
        types[n] = np.bincount(place, minlength=len(contexts[n]))
    place = np.searchsorted(contexts[ORDER], keys >> np.uint64(8))
    size = len(contexts[ORDER])
    top_totals = np.column_stack([np.bincount(place, counts[:, j], minlength=size) for j in (0, 1)])
    top_types = np.column_stack([np.bincount(place, counts[:, j] > 0, minlength=size) for j in (0, 1)])
    model = Model(all_keys, all_counts, contexts, totals, types, counts, top_totals, top_types)
    return model.finish()


def count_grams(sample: DataFrame) -> DataFrame:
    """(label, key, n) of the six-grams of texts with a label; summed per task before the shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            labels = part.column(1).to_pylist()
            for label in (0, 1):
                number: dict[bytes, int] = {}
                for text, own in zip(texts, labels):
                    if own == label:
                        for word in text.lower().split():
                            number[word] = number.get(word, 0) + 1
                if not number:
                    continue
                keys, owner = grams(list(number))
                weights = np.fromiter(number.values(), dtype=np.float64, count=len(number))[owner]
                known, place = np.unique(keys, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(known), label, dtype=np.int32)),
                        pa.array(known.astype(np.int64)),
                        pa.array(np.bincount(place, weights).astype(np.int64)),
                    ],
                    ["label", "key", "n"],
                )

    rows = sample.select("text", "label").mapInArrow(count, "label int, key long, n long")
    return rows.groupBy("label", "key").agg(F.sum("n").alias("n"))


class Scorer:
    """Features of texts; remembers the values of words between batches."""

    def __init__(self, model: Model):
        self.model = model
        self.numbers: dict[bytes, int] = {}
        self.values = np.empty(0)

    def features(self, texts: list[bytes]) -> np.ndarray:
        if len(self.numbers) > REMEMBERED:
            self.numbers, self.values = {}, np.empty(0)
        words = [text.lower().split() for text in texts]
        new = dict.fromkeys(w for own in words for w in own if w not in self.numbers)
        if new:
            first = len(self.numbers)
            self.numbers.update(zip(new, range(first, first + len(new))))
            self.values = np.concatenate((self.values, self.model.word_values(list(new))))
        out = np.zeros((len(texts), FEATURES))
        for i, own in enumerate(words):
            if own:
                v = self.values[np.fromiter(map(self.numbers.__getitem__, own), dtype=np.int64, count=len(own))]
                excess = np.maximum(v - EXCESS, 0).mean()
                high = np.partition(v, len(v) - 3)[-3:] if len(v) > 3 else v
                out[i] = v.mean(), excess, np.log(excess + 1e-3), high.mean(), np.log(len(v))
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, scales, weights) by Newton's method with a small ridge."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (weight * (p - y)) + 0.1 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def probability(x: np.ndarray, fitted: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    mean, scale, w = fitted
    return 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of about ``size`` documents per class, and how many rows each class has."""
    known = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    totals = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("toxicity")), 11) / float(1 << 53)
    share = F.lit(1.0)
    for label, total in totals.items():
        share = F.when(F.col("label") == label, min(1.0, size / total)).otherwise(share)
    chosen = broadcast_if_small(known.where(place < share).select(F.col("doc_id").alias("_id"), "label"))
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id"))
    return cut_lineage(texts.select("doc_id", "text", "label")), totals


def score(docs: DataFrame, labels: DataFrame, size: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, score, predicted) of every row; ``labels`` has doc_id and label, training rows only."""
    spark = docs.sparkSession
    sample, totals = labelled_sample(docs, labels, size)
    prior = totals.get(1, 0) / max(sum(totals.values()), 1)
    fitted = None
    scorer_of = None
    if len(totals) == 2:
        place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("calibration")), 11) / float(1 << 53)
        table = count_grams(sample.where(place >= CALIBRATION)).toArrow()
        label, key, n = (np.asarray(table.column(c).combine_chunks()) for c in ("label", "key", "n"))
        keys = np.unique(key.astype(np.uint64))
        counts = np.zeros((len(keys), 2))
        counts[np.searchsorted(keys, key.astype(np.uint64)), label] = n
        scorer_of = spark.sparkContext.broadcast(build_model(keys, counts))

        def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(scorer_of.value)
            for part, texts in text_slices(batches):
                found = scorer.features(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), *[pa.array(found[:, j]) for j in range(FEATURES)]],
                    ["label", *[f"f{j}" for j in range(FEATURES)]],
                )

        names = [f"f{j}" for j in range(FEATURES)]
        rest = sample.where(place < CALIBRATION).select("text", F.col("label").cast("int").alias("label"))
        found = rest.mapInArrow(describe, "label int, " + ", ".join(f"{c} double" for c in names)).toArrow()
        y = np.asarray(found.column("label").combine_chunks()).astype(float)
        x = np.column_stack([np.asarray(found.column(c).combine_chunks()) for c in names])
        if 0 < y.sum() < len(y):
            # Each class as often as among all labels.
            weight = np.where(y == 1, prior * len(y) / y.sum(), (1 - prior) * len(y) / (len(y) - y.sum()))
            fitted = fit_logistic(x, y, weight)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(scorer_of.value) if fitted is not None else None
        for part, texts in text_slices(batches):
            value = np.full(len(texts), prior)
            if scorer is not None:
                full = np.array([bool(t.strip()) for t in texts])
                value = np.where(full, probability(scorer.features(texts), fitted), prior)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return docs.select("doc_id", "text").mapInArrow(judge, "doc_id long, score double, predicted int")
