"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed bigrams and trigrams of lower-cased text per language, on the executors; the table of log
probabilities (``BUCKETS`` x languages, a fixed size) goes to the tasks as a broadcast.  Scoring looks up the rows of a
batch's n-grams and adds them up per document in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 1 << 15
ORDERS = (2, 3)
MAX_TRAINING_DOCS = 60_000  # the bound of the training sample, met in expectation
MAX_LANGUAGES = 200
BLOCK = 1 << 19  # characters looked at together
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """The bucket of every n-gram of the code points."""
    if len(codes) < order:
        return np.empty(0, np.int64)
    value = np.zeros(len(codes) - order + 1, np.uint64)
    for k in range(order):
        value = (value + codes[k : k + len(value)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return (value >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of code points with the number of the text each belongs to; long texts come in overlapping slices."""
    codes, owners, held = [], [], 0
    for number, text in enumerate(texts):
        own = _codes(text) if text else np.empty(0, np.uint32)
        step = BLOCK - max(ORDERS) + 1
        for at in range(0, len(own), step):
            # A slice starts with the last characters of the one before, so no trigram is lost; the few bigrams of the
            # overlap count twice, in training and prediction alike.
            piece = own[max(0, at - max(ORDERS) + 1) : at + step]
            if held + len(piece) > BLOCK and held:
                yield np.concatenate(codes), np.concatenate(owners)
                codes, owners, held = [], [], 0
            codes.append(piece)
            owners.append(np.full(len(piece), number))
            held += len(piece)
    if held:
        yield np.concatenate(codes), np.concatenate(owners)


def _inside(codes: np.ndarray, owners: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and owners of the n-grams that lie in one text."""
    grams = _grams(codes, order)
    if not len(grams):
        return grams, owners[:0]
    whole = owners[: len(grams)] == owners[order - 1 :]
    return grams[whole], owners[: len(grams)][whole]


@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray  # BUCKETS x languages
    prior: np.ndarray


def quota(sizes: dict[str, int], max_docs: int) -> float:
    """The number of rows up to which a language is used in full, so that all languages together use ``max_docs``."""
    room, left = max_docs, len(sizes)
    for size in sorted(sizes.values()):
        if size * left > room:
            return room / left
        room, left = room - size, left - 1
    return float(max(sizes.values()))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", max_docs: int = MAX_TRAINING_DOCS, doc_id: str = "doc_id") -> Model:
    """Fit on rows with a text and a language.

    Up to ``max_docs`` rows (in expectation) are used: languages of few rows in full, the others up to the same number of
    rows each.  A hash of the id and of the text's length and beginning decides, so the same rows are taken however the
    table is laid out, and copies under different ids are sampled one by one.  The prior is that of all rows.  More than
    ``MAX_LANGUAGES`` languages are refused.
    """
    rows = labelled.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    most, chosen = quota(sizes, max_docs), rows
    if cut := {name: most / n for name, n in sizes.items() if n > most}:
        shares = F.create_map(*[F.lit(x) for pair in cut.items() for x in pair])
        drawn = F.pmod(F.xxhash64("doc_id", F.length("text"), F.substring("text", 1, 200)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        chosen = rows.filter(drawn < F.coalesce(F.element_at(shares, F.col("lang")), F.lit(1.0)))
    chosen = chosen.select("text", "lang")
    number = {name: k for k, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            labels = np.array([number[x] for x in batch.column("lang").to_pylist()])
            for codes, owners in _pieces(batch.column("text").to_pylist()):
                for order in ORDERS:
                    grams, own = _inside(codes, owners, order)
                    counts += np.bincount(labels[own] * BUCKETS + grams, minlength=counts.size).reshape(counts.shape)
        which, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(which.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[which, bucket])],
            names=["which", "bucket", "n"],
        )

    totals = chosen.mapInArrow(count, "which int, bucket int, n long").groupBy("which", "bucket").agg(F.sum("n").alias("n"))
    found = totals.toPandas()  # at most BUCKETS x languages rows
    counts = np.zeros((BUCKETS, len(languages)))
    counts[found["bucket"].to_numpy(np.int64), found["which"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    smooth = counts + 0.1
    prior = np.log(np.array([sizes[x] for x in languages], float) / sum(sizes.values()))
    return Model(languages, np.log(smooth / smooth.sum(axis=0)).astype(np.float32), prior)


def _predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    total = np.tile(model.prior, (len(texts), 1))
    lettered = np.zeros(len(texts), bool)
    letters = _is_letter()
    for codes, owners in _pieces(texts):
        lettered[owners[letters[codes]]] = True
        for order in ORDERS:
            grams, own = _inside(codes, owners, order)
            if len(grams):
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                total[own[first]] += np.add.reduceat(model.log_prob[grams], first, axis=0, dtype=np.float64)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = total.argmax(axis=1)
    score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
    return names, np.where(lettered, score, 0.0)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a column ``prediction`` (lang_pred, score); nothing but the text decides.

    A null text or one without a letter gets ``und`` with score 0; so does every text if nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, score = _predict(batch.tolist(), shared.value)
            yield pd.DataFrame({"lang_pred": names, "score": score})

    return docs.withColumn("prediction", classify(F.col(text)))


def held_out(doc_id: Column) -> Column:
    """Every fourth document by its id's checksum is left for testing; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
