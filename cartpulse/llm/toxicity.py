"""Toxicity by a chain of classifiers over categories.

The categories are predicted one after the other by linear models over n-grams. Each
model also gets the probabilities of the categories before it. For fitting, those come
from models that have not seen the text (out-of-fold), so that a later model learns how
far the earlier ones can be trusted on new texts.

The tables label a text as toxic or not. The categories before that last one are labels
derived from it and from seed words: a toxic text that holds one of the words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartpulse.llm.bpe import STEP_BYTES
from cartpulse.llm.frames import free_name, pieces, strings, written
from cartpulse.llm.ngrams import folded, hashed, slices

# Seed words of the categories that come before "toxic" in the chain.
SEEDS = {
    "insult": ["clown", "idiot", "loser", "moron", "stupid"],
    "contempt": ["disgusting", "pathetic", "scum", "trash", "worthless"],
}
CATEGORIES = (*SEEDS, "toxic")
N_GRAM = 5
BITS = 20
#: Labelled texts that the models are fitted on: about so many of each label at most.
PER_LABEL = 8_000
#: n-grams that the models know at most.
FEATURES = 4_096
FOLDS = 5


class Model(NamedTuple):
    buckets: np.ndarray   # known n-gram hashes, ascending
    weights: np.ndarray   # categories x (n-grams + earlier categories)
    bias: np.ndarray      # of each category


def active(texts: list[str], buckets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, n-gram) of every different n-gram in every text; with ``buckets`` only
    the known ones, by their number."""
    data, bounds = folded(texts)
    grams = hashed(data, N_GRAM, BITS)
    spans = slices(bounds, N_GRAM)
    if buckets is None:
        found = [np.unique(grams[a:b]) for a, b in spans]
        return np.repeat(np.arange(len(texts)), [len(f) for f in found]), \
            np.concatenate([np.zeros(0, np.uint32), *found]).astype(np.int64)
    number = np.full(1 << BITS, -1, dtype=np.int32)
    number[buckets] = np.arange(len(buckets))
    known = number[grams]
    at = np.flatnonzero(known >= 0)
    owner = np.searchsorted(bounds[1:], at, side="right")
    inside = at + N_GRAM <= bounds[1:][owner] + 1
    pairs = np.unique(owner[inside] * np.int64(1 << 32) + known[at[inside]])
    return pairs >> 32, pairs & 0xFFFFFFFF


def _odds(rows: np.ndarray, columns: np.ndarray, extra: np.ndarray, weights: np.ndarray,
          bias: float, n: int) -> np.ndarray:
    first = len(weights) - extra.shape[1]
    score = np.bincount(rows, weights[:first][columns], minlength=n) + bias
    return 1 / (1 + np.exp(-np.clip(score + extra @ weights[first:], -30, 30)))


def _logistic(rows, columns, extra, target, n_features, steps=200, decay=1e-4):
    """Weights and bias of one category's model, by gradient steps scaled per weight."""
    n = len(target)
    weights, bias = np.zeros(n_features + extra.shape[1]), 0.0
    size, size_bias = np.full(len(weights), 1e-8), 1e-8
    share = target.mean() if n else 0.5
    each = np.where(target > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) / max(n, 1)
    for _ in range(steps):
        miss = (_odds(rows, columns, extra, weights, bias, n) - target) * each
        slope = np.concatenate([np.bincount(columns, miss[rows], minlength=n_features),
                                extra.T @ miss]) + decay * weights
        size += slope ** 2
        size_bias += miss.sum() ** 2
        weights = weights - 0.5 * slope / np.sqrt(size)
        bias -= 0.5 * miss.sum() / np.sqrt(size_bias)
    return weights, bias


def fit(rows: np.ndarray, columns: np.ndarray, targets: np.ndarray, fold: np.ndarray,
        buckets: np.ndarray) -> Model:
    """The chain over the columns of ``targets``; ``fold`` says which texts are left
    out together when a category's probabilities are made for the next ones."""
    n, width = targets.shape
    earlier = np.zeros((n, 0))
    weights, biases = np.zeros((width, len(buckets) + width)), np.zeros(width)
    for c in range(width):
        w, b = _logistic(rows, columns, earlier, targets[:, c], len(buckets))
        weights[c, :len(w)], biases[c] = w, b
        unseen = np.zeros(n)
        for k in np.unique(fold):
            out = fold == k
            place = np.cumsum(~out) - 1
            stays = ~out[rows]
            w, b = _logistic(place[rows[stays]], columns[stays], earlier[~out],
                             targets[~out, c], len(buckets))
            unseen[out] = _odds(rows, columns, earlier, w, b, n)[out]
        earlier = np.column_stack([earlier, unseen])
    return Model(buckets, weights, biases)


def probabilities(model: Model, texts: list[str]) -> np.ndarray:
    """Texts x categories, each category given those before it."""
    rows, columns = active(texts, model.buckets)
    known, found = len(model.buckets), np.zeros((len(texts), 0))
    for c in range(len(model.bias)):
        weights = model.weights[c, :known + c]
        found = np.column_stack(
            [found, _odds(rows, columns, found, weights, model.bias[c], len(texts))])
    return found


def sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """Labelled texts, about ``per_label`` of each label at most, chosen by a hash of
    the key. Contradicting labels of a key count as toxic."""
    labelled = labels.where("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    counts = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, per_label / counts.get(1, 1)) \
        .otherwise(per_label / counts.get(0, 1))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    # at most about 2 * per_label rows of two numbers
    chosen = F.broadcast(labelled.where(part < share))
    return written(docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(chosen, "doc_id"), "toxicity-sample")


def _known_buckets(labelled: DataFrame, most: int) -> np.ndarray:
    """The n-grams that tell toxic texts from others best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES):
                toxic = np.array(part.column("toxic").to_pylist())
                rows, grams = active(strings(part, "text"))
                for label in (0, 1):
                    counts[label] += np.bincount(grams[toxic[rows] == label],
                                                 minlength=1 << BITS)
        seen = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(counts[0, seen]), pa.array(counts[1, seen])],
            ["bucket", "clean", "toxic"])

    sizes = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    clean, toxic = F.col("clean") / sizes.get(0, 1), F.col("toxic") / sizes.get(1, 1)
    lift = F.log2((toxic + 1e-4) / (clean + 1e-4))
    best = (labelled.mapInArrow(run, "bucket long, clean long, toxic long")
            .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            .where(F.col("toxic") >= 3).where(lift >= 2)
            .orderBy((toxic * lift).desc(), "bucket").limit(most).collect())
    return np.array(sorted(r.bucket for r in best), dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL,
          most_features: int = FEATURES) -> Model:
    """The chain fitted on a bounded sample of the labelled documents.

    Without a labelled text of either kind the models know nothing and call nothing toxic.
    """
    labelled = sample(docs, labels, per_label)
    buckets = _known_buckets(labelled, most_features)
    seeds = {c: re.compile(rf"\b(?:{'|'.join(words)})\b", re.I) for c, words in SEEDS.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES):
                texts = strings(part, "text")
                rows, columns = active(texts, buckets)
                bounds = np.searchsorted(rows, np.arange(len(texts) + 1))
                held = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(columns))
                said = [[c for c, r in enumerate(seeds.values()) if r.search(t)] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic"),
                     held, pa.array(said, pa.list_(pa.int32()))],
                    ["doc_id", "toxic", "grams", "said"])

    rows = labelled.select("doc_id", "toxic", "text").mapInArrow(
        run, "doc_id long, toxic int, grams array<long>, said array<int>").toArrow() \
        .sort_by([("doc_id", "ascending")])
    toxic = np.array(rows.column("toxic").to_pylist(), dtype=float)
    if not (toxic > 0).any() or (toxic > 0).all() or not len(buckets):
        n = len(CATEGORIES)
        return Model(np.zeros(0, np.int64), np.zeros((n, n)), np.full(n, -30.0))
    grams, said = rows.column("grams").to_pylist(), rows.column("said").to_pylist()
    targets = np.zeros((len(rows), len(CATEGORIES)))
    for i, words in enumerate(said):
        targets[i, words] = toxic[i]
    targets[:, -1] = toxic
    ids = np.array(rows.column("doc_id").to_pylist(), dtype=np.uint64)
    fold = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(FOLDS)
    return fit(np.repeat(np.arange(len(rows)), [len(g) for g in grams]),
               np.array([g for held in grams for g in held], dtype=np.int64),
               targets, fold, buckets)


def scored(docs: DataFrame, model: Model, text: str = "text",
           names: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with a probability per category, called ``names`` or
    ``_p_<category>``.

    A null or empty text has no n-gram and gets the models' base rate. Whole texts are read.
    """
    names = names or [f"_p_{c}" for c in CATEGORIES]
    schema = T.StructType([*docs.schema.fields,
                           *(T.StructField(n, T.DoubleType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, STEP_BYTES):
                found = probabilities(model, strings(part, text))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(found[:, c]) for c in range(found.shape[1]))],
                    [*part.schema.names, *names])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, p_insult, p_contempt, p_toxic and toxic of every row of ``docs``.

    Null and empty texts are not toxic. Repeated rows give repeated results; other
    columns play no part; an empty table gives no rows; without usable labels nothing
    is toxic.
    """
    model = train(docs, labels)
    rows = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return rows.select("doc_id", *(F.col(f"_p_{c}").alias(f"p_{c}") for c in CATEGORIES),
                       _is_toxic(threshold).alias("toxic"))


def _is_toxic(threshold: float, probability: str = "_p_toxic"):
    return F.coalesce(F.length("text") > 0, F.lit(False)) & (F.col(probability) >= threshold)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that are not toxic, with their columns, whatever these are called."""
    names = [free_name(f"_p_{c}", docs) for c in CATEGORIES]
    rows = scored(docs, train(docs, labels), names=names)
    return rows.where(~_is_toxic(threshold, names[-1])).select(
        *[F.col(f"`{c}`") for c in docs.columns])
