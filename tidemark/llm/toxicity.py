"""Toxicity by a classifier chain of linear models.

Categories are predicted in turn; the model of each category sees the text's features and the probabilities of all
earlier categories. In training those probabilities are out of fold (each row's come from a model fitted without its
fold), so later models learn from the same kind of guess that they get in use.

Features are a text's distinct words and the beginnings of their first four and five bytes, hashed to ``PLACES``
places. The chain is fitted on at most about ``FIT_ROWS`` labelled rows, taken by a hash of their doc_id; each model
(one per fold and one for use) is a logistic regression fitted by a task of its own on that bounded sample. Scoring
reads whole texts of all documents.

Defined results: null or empty text has no features and gets each model's base rate; rows with a null label or doc_id
are not fitted on; with no labelled row all probabilities are 0; repeated rows give repeated results; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytetext import Words, span_hashes, text_steps
from tidemark.sources.tables import staged

FIT_ROWS = 20_000
FOLDS = 3
PLACE_BITS = 18
PLACES = 1 << PLACE_BITS
THRESHOLD = 0.5
#: A place enters a model only if its chi-square statistic against the label is at least this, over the fitted rows.
MIN_CHI2 = 20.0
#: Strength of the pull of weights towards 0, and steps of the fit.
RIDGE = 1e-4
STEPS = 120
RATE = 0.1


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, place) of each distinct feature, sorted by text."""
    words = Words(texts)
    owner, size = words.text_of(), words.ends - words.starts
    keys = []
    for salt, length in ((0, None), (1, 4), (2, 5)):
        on = np.arange(len(size)) if length is None else np.flatnonzero(size >= length)
        ends = words.ends[on] if length is None else words.starts[on] + length
        h = span_hashes(words.buf, words.starts[on], ends) * np.uint64(2 * salt + 1)
        keys.append((owner[on] << PLACE_BITS) | (h >> np.uint64(64 - PLACE_BITS)).astype(np.int64))
    both = np.concatenate(keys)
    both.sort()
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return both >> PLACE_BITS, both & (PLACES - 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(owner: np.ndarray, place: np.ndarray, extra: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of places, then of the extra columns, then the bias; full-batch Adam on the ridge logistic loss.

    Words that few rows hold would only let the model learn rows by heart; the chi-square test keeps them out.
    """
    rows, k = len(y), extra.shape[1]
    n = np.bincount(place, minlength=PLACES).astype(float)
    hits = np.bincount(place, y[owner], PLACES)
    share = y.mean()
    expected = n * share * (1 - share) * (1 - n / rows)
    chi2 = np.divide((hits - n * share) ** 2, expected, out=np.zeros(PLACES), where=expected > 0)
    telling = chi2[place] >= MIN_CHI2
    owner, place = owner[telling], place[telling]
    used, place = np.unique(place, return_inverse=True)
    w = np.zeros(len(used) + k + 1)
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(base / (1 - base))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        z = np.bincount(owner, w[place], rows) + extra @ w[len(used) : len(used) + k] + w[-1]
        r = (_sigmoid(z) - y) / rows
        g = np.concatenate([np.bincount(place, r[owner], len(used)), r @ extra, [r.sum()]])
        g[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    full = np.zeros(PLACES + k + 1)
    full[used] = w[: len(used)]
    full[PLACES:] = w[len(used) :]
    return full


def _unpack(blobs: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(b, np.int32) for b in blobs]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return owner, (np.concatenate(parts) if parts else np.empty(0, np.int32)).astype(np.int64)


def _apply(weights: np.ndarray, owner: np.ndarray, place: np.ndarray, earlier: list[np.ndarray], rows: int) -> np.ndarray:
    z = np.bincount(owner, weights[place], rows) + weights[-1]
    for j, p in enumerate(earlier):
        z = z + weights[PLACES + j] * p
    return _sigmoid(z)


def _fit_data(labelled: DataFrame, categories: Sequence[str], folds: int) -> DataFrame:
    """fold, y (array of labels), places (binary), earlier (array of probabilities so far: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_steps(batch, "text"):
                owner, place = features(texts)
                cut = np.searchsorted(owner, np.arange(hi - lo + 1))
                blobs = [place[cut[d] : cut[d + 1]].astype(np.int32).tobytes() for d in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column("fold").slice(lo, hi - lo), batch.column("y").slice(lo, hi - lo), pa.array(blobs, pa.binary())], ["fold", "y", "places"])

    known = labelled.where("doc_id IS NOT NULL AND " + " AND ".join(f"`{c}` IS NOT NULL" for c in categories))
    slim = known.select(
        F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(folds)).cast("int").alias("fold"), F.array(*[F.col(c).cast("double") for c in categories]).alias("y"), "text"
    )
    return staged(slim.mapInArrow(run, "fold int, y array<double>, places binary").withColumn("earlier", F.array().cast("array<double>")), "toxic-fit")


def _fitter(category: int):
    """Task that fits the model of one category on its group of rows."""

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        owner, place = _unpack(group["places"].tolist())
        extra = np.array(group["earlier"].tolist(), float).reshape(len(group), -1)
        y = np.array([v[category] for v in group["y"]])
        return pd.DataFrame({"model": [int(group["model"].iloc[0])], "w": [fit_linear(owner, place, extra, y).tobytes()]})

    return fit


def _guesser(fitted: dict[int, np.ndarray], folds: int):
    """Adds each row's probability by the model that was fitted without its fold."""

    def guess(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups:
            owner, place = _unpack(g["places"].tolist())
            before = np.array(g["earlier"].tolist(), float).reshape(len(g), -1)
            p = np.zeros(len(g))
            for k in g["fold"].unique():
                own = _apply(fitted.get(k, fitted[folds]), owner, place, list(before.T), len(g))
                p = np.where(g["fold"] == k, own, p)
            yield g.assign(earlier=[[*b, x] for b, x in zip(before.tolist(), p.tolist())])

    return guess


def fit_chain(labelled: DataFrame, categories: Sequence[str], folds: int = FOLDS) -> list[np.ndarray]:
    """One weight vector per category, in order. ``labelled``: doc_id, text and a 0/1 column per category; a bounded sample."""
    data = _fit_data(labelled, categories, folds)
    chain: list[np.ndarray] = []
    for c in range(len(categories)):
        fit = _fitter(c)
        last = c + 1 == len(categories)
        models = [F.lit(folds)] if last else [F.lit(folds), *[F.when(F.col("fold") != k, F.lit(k)) for k in range(folds)]]
        tasks = data.withColumn("model", F.explode(F.array_compact(F.array(*models))))
        fitted = {r["model"]: np.frombuffer(r["w"]) for r in tasks.groupBy("model").applyInPandas(fit, "model int, w binary").collect()}
        if folds not in fitted:
            return []
        chain.append(fitted[folds])
        if not last:
            data = staged(data.mapInPandas(_guesser(fitted, folds), data.schema), "toxic-oof")
    return chain


def score(docs: DataFrame, chain: list[np.ndarray], categories: Sequence[str]) -> DataFrame:
    """doc_id and ``p_<category>`` for every category; the chain is a bounded broadcast (2 MB a category)."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            for lo, hi, texts in text_steps(batch, "text"):
                owner, place = features(texts)
                p: list[np.ndarray] = []
                for w in models:
                    p.append(_apply(w, owner, place, p, hi - lo))
                p = p or [np.zeros(hi - lo) for _ in names]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *map(pa.array, p)], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names))


def labelled_sample(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, text, low_quality, toxic of at most about ``fit_rows`` labelled documents."""
    known = labels.where("quality IS NOT NULL AND toxic IS NOT NULL AND doc_id IS NOT NULL")
    share = min(1.0, fit_rows / max(known.count(), 1))
    picked = known.where(F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    picked = picked.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # about fit_rows rows


def judge_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, p_low_quality, p_toxic, toxic."""
    categories = ["low_quality", "toxic"]
    chain = fit_chain(labelled_sample(docs, labels, fit_rows), categories, folds)
    return score(docs, chain, categories).withColumn("toxic", F.col("p_toxic") >= threshold)
