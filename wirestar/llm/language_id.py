"""Language identification from averaged hashed subword embeddings.

A text's subwords are its character sequences of ``SIZES`` letters inside words, with the word
ends, hashed into ``BUCKETS``. Their embeddings are averaged and a linear softmax reads the
mean. Both are trained together by stochastic gradient descent in numpy. As the mean and the
softmax are linear up to the last step, scoring looks up per subword how it moves each
language's logit, and averages that.

A temperature is fitted on a part of the sample that training does not see, and there also the
rejection threshold: the confidence that all but ``REJECTED`` of the right predictions reach.

Learning uses a bounded sample: at most ``PER_LANGUAGE`` documents of each language, least
hashed ids first, and ``SAMPLE`` in all, one of each language after another, from rows that are
not held out; of each only its bucket counts travel. More than ``SAMPLE`` languages are not all
learned. Of an id with several texts in a language the least one teaches.

Nulls: texts that are null or have no letter get ``und`` with score 0 and are rejected. Rows
with a null language teach nothing; without any language everything is ``und``. Repeated rows
are predicted each. Extra columns are ignored. An empty table gives an empty result. A very long
text is read whole and adds the counts of at most ``BUCKETS`` subwords to the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wirestar.llm.common import id_remainder, text_or_empty
from wirestar.sources.staging import Staging

SIZES = (2, 4)
BUCKETS = 1 << 15
DIMENSIONS = 12
PER_LANGUAGE, SAMPLE = 500, 20_000
FOLDS, HELD_OUT = 5, 0
EPOCHS, RATE = 12, 1.0
CALIBRATION = 5
REJECTED = 0.01
UNKNOWN = "und"

_PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """``effect``: (buckets, languages), how each subword moves the logits. ``least``: the
    confidence below which a prediction is rejected."""

    languages: tuple[str, ...]
    effect: np.ndarray
    bias: np.ndarray
    least: float


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of all texts, and the number of subwords of each text.

    All texts are one array of code points; every character that is no letter is a word end.
    A sequence counts if it holds a letter and no word end inside.
    """
    lower = [t.lower() for t in texts]
    points = np.frombuffer("\0".join(["", *lower, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters(points)
    points = np.where(letter, points, 0).astype(np.uint64)
    owner = np.repeat(np.arange(len(lower)), [len(t) + 1 for t in lower])
    found, owners = [], []
    for n in SIZES:
        starts = len(points) - n + 1
        inside = letter[1 : starts + 1].copy()  # the second place holds a letter
        for i in range(2, n - 1):
            inside &= letter[i : i + len(inside)]
        hashed = np.full(len(inside), np.uint64(n))
        for i in range(n):
            hashed = (hashed ^ points[i : i + len(inside)]) * _PRIME
            hashed ^= hashed >> np.uint64(29)
        found.append((hashed[inside] >> np.uint64(20)).astype(np.int64) % BUCKETS)
        owners.append(owner[: len(inside)][inside])
    counts = [np.bincount(o, minlength=len(texts)) for o in owners]
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(found)[order], sum(counts)


_LETTER_TABLE: np.ndarray | None = None


def _letters(points: np.ndarray) -> np.ndarray:
    global _LETTER_TABLE
    if _LETTER_TABLE is None:
        _LETTER_TABLE = np.array([chr(i).isalpha() for i in range(0x30000)])
    known = points < len(_LETTER_TABLE)
    return _LETTER_TABLE[np.where(known, points, 0)] & known


# --- learning -------------------------------------------------------------------------------


def learning_sample(docs: DataFrame, staging: Staging, most: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, lang, buckets, counts): the bucket counts of at most ``most`` documents of each
    language. The ids are picked before any text is read; the least hashed ones of each task
    are picked first, so no language meets in one task."""
    known = docs.where("lang is not null and doc_id is not null")
    known = known.where(id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    known = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    slot = F.pmod("h", F.lit(256))
    spread = Window.partitionBy("lang", slot).orderBy("h", "doc_id")
    share = -(-most // 64)  # of 256 slots each: four times what is needed
    picked = known.withColumn("n", F.row_number().over(spread)).where(F.col("n") <= share)
    whole = Window.partitionBy("lang").orderBy("n", "h", "doc_id")
    picked = picked.withColumn("m", F.row_number().over(whole)).where(F.col("m") <= most)
    picked = picked.orderBy("m", "lang", "doc_id").limit(SAMPLE)
    picked = staging.write(picked.select("doc_id", "lang"), "picked").df

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, counts = [], []
            for text in batch["text"]:
                found, n = np.unique(subwords([text.as_py()])[0], return_counts=True)
                buckets.append(found)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["lang"], pa.array(buckets, pa.list_(pa.int64())),
                 pa.array(counts, pa.list_(pa.int64()))],
                names=["doc_id", "lang", "buckets", "counts"],
            )

    texts = docs.select("doc_id", text_or_empty().alias("text"))
    rows = texts.join(F.broadcast(picked), "doc_id")  # at most SAMPLE ids
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    schema = "doc_id long, lang string, buckets array<bigint>, counts array<bigint>"
    return rows.mapInArrow(count, schema)


def learn(docs: DataFrame, staging: Staging) -> Model:
    rows = sorted(learning_sample(docs, staging).collect(), key=lambda r: (r.lang, r.doc_id))
    rows = [r for r in rows if r.buckets]
    languages = tuple(sorted({r.lang for r in rows}))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 0.0)
    texts = [(np.array(r.buckets), np.array(r.counts, dtype=np.float64)) for r in rows]
    labels = np.array([languages.index(r.lang) for r in rows])
    return train(texts, labels, languages)


def train(texts, labels: np.ndarray, languages: tuple[str, ...], seed: int = 5) -> Model:
    """Embeddings and softmax by SGD, one text a step, with a falling rate."""
    random = np.random.default_rng(seed)
    order = random.permutation(len(texts))
    unseen = order[: len(texts) // CALIBRATION]
    seen = order[len(unseen) :]
    embedding = random.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    softmax, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    softmax += random.normal(0, 0.1, softmax.shape)
    steps, done = EPOCHS * len(seen), 0
    for _ in range(EPOCHS):
        for i in random.permutation(seen):
            rate = RATE * (1 - done / steps)
            buckets, counts = texts[i]
            share = counts / counts.sum()
            mean = share @ embedding[buckets]
            error = _softmax(mean @ softmax + bias)
            error[labels[i]] -= 1
            pull = softmax @ error
            softmax -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            embedding[buckets] -= rate * np.outer(share * len(share) ** 0.5, pull)
            done += 1
    effect = embedding @ softmax
    logits = np.array([_logits(effect, bias, texts[i]) for i in unseen]).reshape(-1, len(languages))
    temperature = _temperature(logits, labels[unseen])
    effect, bias = effect / temperature, bias / temperature
    least = 0.0
    if len(unseen):
        chances = _softmax(logits / temperature)
        right = chances.argmax(axis=1) == labels[unseen]
        if right.any():
            least = float(np.quantile(chances.max(axis=1)[right], REJECTED))
    return Model(languages, effect.astype(np.float32), bias, least)


def _logits(effect: np.ndarray, bias: np.ndarray, text) -> np.ndarray:
    buckets, counts = text
    return counts @ effect[buckets] / counts.sum() + bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, from a fixed grid."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.1, 10, 61)
    each = np.arange(len(labels))
    loss = [-np.log(_softmax(logits / t)[each, labels] + 1e-9).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


# --- prediction -----------------------------------------------------------------------------


def predict(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and confidence of each text."""
    scores = np.zeros(len(texts))
    if not model.languages:
        return [UNKNOWN] * len(texts), scores
    buckets, counts = subwords(texts)
    moved = np.zeros((len(texts), len(model.languages)))
    filled = np.flatnonzero(counts)
    if len(filled):
        begins = (np.cumsum(counts) - counts)[filled]
        moved[filled] = np.add.reduceat(model.effect[buckets], begins, axis=0, dtype=np.float64)
        moved[filled] /= counts[filled, None]
    chances = _softmax(moved + model.bias)
    best = chances.argmax(axis=1)
    lettered = np.array([has_letter(t) for t in texts], dtype=bool)
    languages = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
    scores = np.where(lettered, chances[np.arange(len(texts)), best], 0.0)
    return languages, scores


def identify(docs: DataFrame, staging: Staging) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected."""
    model = learn(docs, staging)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from wirestar.llm.byte_bpe import in_pieces

        for batch in batches:
            languages, scores = [], []
            for texts in in_pieces(batch["text"].to_pylist(), 1 << 18):
                found, sure = predict(texts, model)
                languages += found
                scores += sure.tolist()
            rejected = [x == UNKNOWN or s < model.least for x, s in zip(languages, scores)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(languages, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    texts = docs.select("doc_id", text_or_empty().alias("text"))
    schema = "doc_id long, lang_pred string, score double, rejected boolean"
    held_out = F.coalesce(id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return texts.mapInArrow(label, schema).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )
