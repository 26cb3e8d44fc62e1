"""Toxicity by a character n-gram linear classifier on naive Bayes log-count ratios.

Features are the character 4- to 6-grams a text has, in lower case with white space collapsed, hashed
to ``DIMENSIONS``. For every feature, the log ratio of its smoothed document shares in toxic and other
texts scales its column; a logistic regression with an L2 penalty is fitted on the scaled columns.
Features of fewer than ``LEAST_TEXTS`` learning texts, and those whose ratio is under ``LEAST_RATIO`` or
under ``LEAST_SURPRISE`` of its standard errors, say nothing and are left out.

The classifier is fitted on at most about ``sample`` labelled texts, drawn by a hash of their id; that
is the documented bound of the fit and of the labels that are broadcast. Its weights are a vector of
``DIMENSIONS`` numbers. Scoring covers every whole text, in one narrow pass.

Defined cases: NULL and empty text score as a text without features; a document with several labels
counts as toxic if one says so; NULL labels are not learnt from; without both kinds of label every
score is next to 0 or 1 (one half without any label); a labelled text that is repeated under its id is learnt
once; other columns change nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .language import held_out
from .text import map_arrow, slices

DIMENSIONS = 1 << 20
SIZES = (4, 5, 6)
LEAST_TEXTS, LEAST_RATIO, LEAST_SURPRISE, SMOOTHING = 4, 1.0, 3.0, 0.5
CUT = 0.3
_BLANK = re.compile(r"\s+")


class Model(NamedTuple):
    weights: np.ndarray  # by feature, the ratio multiplied in
    bias: float


def grams(text: str | None) -> np.ndarray:
    """Hashed n-grams of a text, with repetitions."""
    text = " " + _BLANK.sub(" ", (text or "").lower()).strip() + " "
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out, rolled = [], codes
    for n in range(2, max(SIZES) + 1):
        rolled = rolled[:-1] * np.uint32(0x01000193) + codes[n - 1:]
        if n in SIZES:
            x = rolled ^ np.uint32(0x9E3779B9 * n & 0xFFFFFFFF)
            x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
            out.append((x >> np.uint32(12)).astype(np.int32))
        if len(rolled) < 2:
            break
    return np.concatenate(out) if out else np.empty(0, np.int32)


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other texts of the task have each feature."""
    seen = {0: np.zeros(DIMENSIONS, np.int32), 1: np.zeros(DIMENSIONS, np.int32)}
    for batch in slices(batches, "text"):
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            seen[toxic][np.unique(grams(text))] += 1
    used = np.flatnonzero(seen[0] + seen[1])
    for first in range(0, len(used), 100_000):
        some = used[first:first + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(seen[1][some]), pa.array(seen[0][some])], names=["feature", "toxic", "other"])


def _present(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = shared.value
        for batch in slices(batches, "text"):
            lists = []
            for text in batch.column("text").to_pylist():
                own = grams(text)
                lists.append(np.unique(own[kept[own]]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(lists, pa.binary())], names=["toxic", "features"])

    return run


def logistic(lists: list[np.ndarray], toxic: np.ndarray, ratios: np.ndarray, penalty: float = 1.0,
             rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights of the scaled columns by accelerated gradient descent, and the bias."""
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    column = np.concatenate(lists).astype(np.int64)
    used, column = np.unique(column, return_inverse=True)
    value = ratios[used][column]
    times = lambda w, b: np.bincount(row, value * w[column], len(lists)) + b
    back = lambda e: np.bincount(column, value * e[row], len(used))
    probe, largest = np.ones(len(used)), 1.0
    for _ in range(20):  # the largest curvature, by power iteration
        probe = back(times(probe, 0.0))
        largest = np.linalg.norm(probe)
        probe = probe / max(largest, 1e-12)
    step = 1 / (0.25 * (largest + len(lists)) + penalty)
    w, b = np.zeros(len(used)), float(np.log(toxic.mean() / (1 - toxic.mean())))
    v, vb, lead = w, b, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(times(v, vb), -30, 30))) - toxic
        new, new_b = v - step * (back(error) + penalty * v), vb - step * error.sum()
        after = (1 + np.sqrt(1 + 4 * lead * lead)) / 2
        v, vb = new + (lead - 1) / after * (new - w), new_b + (lead - 1) / after * (new_b - b)
        w, b, lead = new, new_b, after
    out = np.zeros(len(ratios))
    out[used] = w * ratios[used]
    return out, b


def fit(docs: DataFrame, labels: DataFrame, sample: int = 16_000) -> Model:
    """The classifier learnt from ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``."""
    spark = docs.sparkSession
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("__id"))
             .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")))
    size = known.count()
    share = min(1.0, sample / max(1, size))
    drawn = known.filter(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage(texts.join(F.broadcast(drawn), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "toxic").distinct().drop("doc_id"), "labelled")
    counts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total, bad = sum(counts.values()), counts.get(1, 0)
    if not bad or bad == total:
        return Model(np.zeros(DIMENSIONS, np.float32), 0.0 if not total else 30.0 if bad else -30.0)
    spread = F.sqrt(1 / (F.col("toxic") + SMOOTHING) + 1 / (F.col("other") + SMOOTHING))
    ratio = F.log((F.col("toxic") + SMOOTHING) / (bad + 2 * SMOOTHING)) - F.log((F.col("other") + SMOOTHING) / (total - bad + 2 * SMOOTHING))
    kept = (map_arrow(rows, _presence, "feature int, toxic int, other int").groupBy("feature")
            .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
            .filter(F.col("toxic") + F.col("other") >= LEAST_TEXTS)
            .select("feature", ratio.alias("ratio"), spread.alias("spread"))
            .filter(F.abs("ratio") >= F.greatest(F.lit(LEAST_RATIO), LEAST_SURPRISE * F.col("spread"))).toPandas())  # at most DIMENSIONS rows
    ratios = np.zeros(DIMENSIONS)
    ratios[kept["feature"].to_numpy()] = kept["ratio"].to_numpy()
    present = map_arrow(rows, _present(spark.sparkContext.broadcast(ratios != 0)), "toxic int, features binary")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["toxic", "features"])  # the same sum in any order of arrival
        lists = [np.frombuffer(x, np.int32) for x in group["features"]]
        weights, bias = logistic(lists, group["toxic"].to_numpy(float), ratios)
        used = np.flatnonzero(weights)
        return pd.DataFrame({"feature": np.append(used, -1), "weight": np.append(weights[used], bias)})

    fitted = present.groupBy().applyInPandas(learn, "feature long, weight double").toPandas()
    weights = np.zeros(DIMENSIONS, np.float32)
    inner = fitted[fitted["feature"] >= 0]
    weights[inner["feature"].to_numpy()] = inner["weight"].to_numpy()
    return Model(weights, float(fitted.loc[fitted["feature"] < 0, "weight"].iloc[0]))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        known = model.weights != 0
        for batch in slices(batches, "text"):
            sums = []
            for text in batch.column("text").to_pylist():
                own = grams(text)
                sums.append(model.weights[np.unique(own[known[own]])].sum(dtype=np.float64) + model.bias)
            scores = 1 / (1 + np.exp(-np.clip(np.array(sums), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row: the probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS numbers
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _score(shared), "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The contract's columns; labels of held-out documents are not read."""
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))), **options)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"))
