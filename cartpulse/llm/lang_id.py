"""Language of texts by error-correcting output codes.

Every language has a codeword. One binary classifier per bit says from n-gram
frequencies which half of the languages a text belongs to, and the codeword nearest
to all answers wins, where each bit counts by the loss of its margin and by how well
its classifier does. A wrong bit is thus put right by the others. When two codewords are
about as near, the answer is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartpulse.llm.bpe import STEP_BYTES
from cartpulse.llm.frames import free_name, pieces, strings
from cartpulse.llm.ngrams import folded, hashed, slices

UNKNOWN = "und"
ORDERS = (2, 3, 4)
BITS = 12
#: Labelled texts that the classifiers are fitted on: about so many of each language,
#: and so many bytes of a text's features per order, whatever the table's size.
PER_LANGUAGE = 600
#: Languages that a model knows at most: the most frequent ones.
MOST_LANGUAGES = 200
#: Difference of two codewords' losses, per bit, below which an answer is ambiguous.
MARGIN = 0.02
_TEXTS_AT_ONCE = 1000


class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray      # languages x bits, of -1 and 1
    weights: np.ndarray   # features x bits
    bias: np.ndarray
    trust: np.ndarray     # of each bit, adding up to 1


def features(texts: list[str], orders: tuple[int, ...] = ORDERS, bits: int = BITS) -> np.ndarray:
    """Square roots of n-gram frequencies: one row of length 1 per text."""
    data, bounds = folded(texts)
    found = np.zeros((len(texts), 1 << bits), dtype=np.float32)
    for n in orders:
        grams = hashed(data, n, bits)
        for row, (a, b) in enumerate(slices(bounds, n)):
            found[row] += np.bincount(grams[a:b], minlength=1 << bits)
    found /= np.maximum(found.sum(axis=1, keepdims=True), 1)
    return np.sqrt(found, out=found)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A code of ``n`` words of -1 and 1. Up to 7 words all distinct splits are used;
    beyond, of some random codes that with the largest least distance."""
    if n <= 7:
        splits = range(1, 1 << max(n - 1, 0))
        return np.array([[1 if s >> (n - 1 - w) & 1 else -1 for s in splits]
                         for w in range(n)], dtype=np.float32).reshape(n, len(splits))
    rng = np.random.default_rng(seed)
    length = int(np.ceil(10 * np.log2(n)))
    tries = [rng.choice([-1.0, 1.0], (n, length)).astype(np.float32) for _ in range(200)]

    def least(code: np.ndarray) -> float:
        apart = (length - code @ code.T) / 2 + length * np.eye(n)
        mixed = np.abs(code.sum(axis=0)) < n  # a bit must split the languages
        return apart.min() if mixed.all() else -1

    return max(tries, key=least)


def fit(x: np.ndarray, languages: np.ndarray, steps: int = 150, decay: float = 1e-5) -> Model:
    """Logistic regressions for all bits at once, by accelerated gradient steps."""
    names = sorted(set(languages.tolist()))
    code = codewords(len(names))
    target = code[np.searchsorted(names, languages)]
    size = np.bincount(np.searchsorted(names, languages), minlength=len(names))
    row = (1 / size[np.searchsorted(names, languages)] / len(names)).astype(np.float32)[:, None]
    weights = np.zeros((x.shape[1], code.shape[1]), dtype=np.float32)
    bias = np.zeros(code.shape[1], dtype=np.float32)
    ahead, ahead_bias, step = weights, bias, np.float32(2.0)
    for k in range(steps if code.shape[1] else 0):
        margin = target * (x @ ahead + ahead_bias)
        slope = -target * row / (1 + np.exp(np.clip(margin, -30, 30)))
        new = ahead - step * (x.T @ slope + decay * ahead)
        new_bias = ahead_bias - step * slope.sum(axis=0)
        pull = np.float32(k / (k + 3))
        ahead, ahead_bias = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias = new, new_bias
    loss = (row * np.log1p(np.exp(-np.clip(target * (x @ weights + bias), -30, 30)))).sum(axis=0)
    trust = 1 / (loss + 1e-3)
    return Model(names, code, weights, bias, (trust / max(trust.sum(), 1e-9)).astype(np.float32))


def losses(model: Model, x: np.ndarray) -> np.ndarray:
    """Texts x languages: how badly the classifiers' margins fit each codeword."""
    margin = np.clip(x @ model.weights + model.bias, -30, 30)
    fits = np.log1p(np.exp(-margin)), np.log1p(np.exp(margin))
    is_set = (model.code > 0).astype(np.float32) * model.trust
    is_clear = (model.code < 0).astype(np.float32) * model.trust
    return fits[0] @ is_set.T + fits[1] @ is_clear.T


def decide(model: Model, texts: list[str], margin: float = MARGIN):
    """Of every text the language, a score from 0 to 1, and whether it is ambiguous."""
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    spoken = np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool)
    if not model.languages:
        return names[np.zeros(len(texts), dtype=int)], np.zeros(len(texts)), ~spoken | True
    best = np.zeros(len(texts), dtype=int)
    score, gap = np.zeros(len(texts)), np.zeros(len(texts))
    for at in range(0, len(texts), _TEXTS_AT_ONCE):
        part = slice(at, at + _TEXTS_AT_ONCE)
        lost = losses(model, features(texts[part])).astype(np.float64)
        best[part] = lost.argmin(axis=1)
        likely = np.exp(-8 * (lost - lost.min(axis=1, keepdims=True)))
        score[part] = 1 / likely.sum(axis=1)
        ranked = np.sort(lost, axis=1)
        gap[part] = ranked[:, 1] - ranked[:, 0] if lost.shape[1] > 1 else np.inf
    best[~spoken], score[~spoken] = len(names) - 1, 0.0
    return names[best], score, ~spoken | (gap < margin)


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """About ``per_language`` labelled rows of each language, chosen by a hash of the key."""
    labelled = docs.where("text is not null and lang is not null and doc_id is not null") \
        .where("pmod(crc32(cast(doc_id as string)), 5) <> 0")
    counts = (labelled.groupBy("lang").count()
              .orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect())
    share = [v for r in counts for v in (F.lit(r.lang), F.lit(per_language / r["count"]))]
    if not share:
        return labelled.select("doc_id", "text", "lang")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return labelled.where(part < F.create_map(*share)[F.col("lang")]) \
        .select("doc_id", "text", "lang")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model from a bounded sample of ``docs`` (doc_id, text, lang); every fifth
    document, by the CRC of its id, is held out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES):
                texts = strings(part, "text")
                for at in range(0, len(texts), _TEXTS_AT_ONCE):
                    found = features(texts[at:at + _TEXTS_AT_ONCE]).astype(np.float16)
                    cut = part.slice(at, len(found))
                    yield pa.RecordBatch.from_arrays(
                        [cut.column("doc_id"), cut.column("lang"),
                         pa.array([r.tobytes() for r in found], pa.binary())],
                        ["doc_id", "lang", "x"])

    rows = sample(docs, per_language).mapInArrow(run, "doc_id long, lang string, x binary") \
        .toArrow().sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float16)
    x = x.reshape(len(rows), 1 << BITS).astype(np.float32)
    return fit(x, np.array(rows.column("lang").to_pylist(), dtype=object))


FIELDS = ("_lang_pred", "_lang_score", "_lang_ambiguous")


def identify(docs: DataFrame, model: Model, text: str = "text",
             fields: tuple[str, str, str] = FIELDS) -> DataFrame:
    """All rows of ``docs`` with language, score and ambiguity under the names ``fields``.

    A text that is null or has no letter is ``und`` with score 0, and ambiguous; if
    the model has no language, so is every text. Whole texts are read.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(fields[0], T.StringType()),
                           T.StructField(fields[1], T.DoubleType()),
                           T.StructField(fields[2], T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, STEP_BYTES):
                names, score, unclear = decide(model, strings(part, text))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names.tolist(), pa.string()), pa.array(score),
                     pa.array(unclear)], [*part.schema.names, *fields])

    return docs.mapInArrow(run, schema)


def languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every row of ``docs``.

    Learns from text and lang of rows that are not held out; predicts from text alone.
    A null doc_id is neither learned from nor held out. Repeated rows give repeated
    results; other columns play no part; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = train(rows, per_language)
    held = F.coalesce(F.expr("pmod(crc32(cast(doc_id as string)), 5) = 0"), F.lit(False))
    return identify(rows.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), F.col("_lang_pred").alias("lang_pred"),
        F.col("_lang_score").alias("score"), F.col("_lang_ambiguous").alias("ambiguous"))


def known_language(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents in a learned language, with their columns, whatever these are called.
    Texts without a letter go, and so do those whose two nearest codewords are equally near."""
    model = train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"),
                  per_language)
    fields = tuple(free_name(f, docs) for f in FIELDS)
    return identify(docs, model, fields=fields).where(
        (F.col(fields[0]) != UNKNOWN) & ~F.col(fields[2])).select(
        *[F.col(f"`{c}`") for c in docs.columns])
