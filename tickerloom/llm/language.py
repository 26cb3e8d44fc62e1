"""Language identification by nearest centroid.

A text becomes counts of its lower-cased character 1- to 3-grams, hashed to ``DIMENSIONS`` features,
damped to 1 + log(count), weighted by inverse document frequency and scaled to length one. Document
frequencies are counted over all learning rows. Every language is described by several centroids,
clustered from about ``sample`` of its learning rows (a documented bound on the fit; rows are drawn by
a hash of their id). A text takes the language of the centroid with the largest cosine.

Rejection is by distance. Cosines grow with what a text holds, so texts are put in classes by how many
different features they have, a class per doubling. Each half of a language's drawn rows is measured
against centroids of the other half; ``SHARE`` of the lowest percentile a class reaches is the least a
text of that class may have to the language it is nearest to. A class of under ``LEAST_ROWS`` drawn rows
takes the next smaller one's bound, and ``reject_below`` holds for all. So single words of a known
language, at 0.2, stay, and texts of a sentence or more in other languages, at 0.13 to 0.18, go. Shorter
texts of other languages in the same script, and texts of close relatives of a known one, may stay.

The model holds ``languages x clusters x DIMENSIONS`` numbers, whatever the corpus; learning rows reach
it as sums. Defined cases: NULL text, or a text without a letter, is ``und`` with score 0 and rejected;
rows without language are not learnt from; ties go to the first centroid by language and number; no
learnable row at all makes every text ``und``; a repeated row is drawn once and counts each time in the
document frequencies; other columns change nothing. Of more than ``languages`` different labels, a bound
on the model, the most frequent are learnt.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .text import map_arrow, slices

DIMENSIONS = 1 << 13
CHUNK = 1 << 10  # features in one row of partial sums
UNKNOWN = "und"
REJECT_BELOW = 0.08
SHARE = 1 / 3  # of the lowest percentile of a language's own rows
LEAST_ROWS = 10  # drawn rows of a class that bound it
CLASSES = DIMENSIONS.bit_length()


class Model(NamedTuple):
    languages: list[str]      # of each centroid
    centroids: np.ndarray     # centroid x feature, unit length
    weights: np.ndarray       # inverse document frequencies
    least: np.ndarray         # centroid x class of text: the least cosine that is not rejected


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text; what stands between letters counts as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    alpha = _letters()[codes]
    kept = alpha.copy()
    kept[1:] |= alpha[:-1]
    return np.where(alpha, codes, np.uint32(32))[kept]


def features(codes: np.ndarray) -> np.ndarray:
    """Hashed character 1- to 3-grams."""
    pairs = codes[:-1] * np.uint32(0x01000193) + codes[1:]
    triples = pairs[:-1] * np.uint32(0x01000193) + codes[2:]
    grams = np.concatenate([codes, pairs ^ np.uint32(0x5BD1E995), triples ^ np.uint32(0x7FEB352D)])
    grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (grams >> np.uint32(32 - DIMENSIONS.bit_length() + 1)).astype(np.int64)


def counts(column: pa.Array) -> np.ndarray:
    """Damped feature counts, a row per text."""
    table = np.zeros((len(column), DIMENSIONS), np.float32)
    for row, text in zip(table, column.to_pylist()):
        codes = letters_of(text or "")
        if len(codes):
            row[:] = np.bincount(features(codes), minlength=DIMENSIONS)
    return np.log1p(table, out=table)


def _scaled(table: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", table, table))
    return table / np.where(norms > 0, norms, 1)[:, None]


def _rows(batches: Iterator[pa.RecordBatch], at_most: int = 128) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        for first in range(0, batch.num_rows, at_most):
            yield batch.slice(first, at_most)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(DIMENSIONS, np.int64), 0
    for batch in _rows(batches):
        total += (counts(batch.column("text")) > 0).sum(axis=0)
        rows += batch.num_rows
    if rows:
        chunks = [total[i:i + CHUNK].tobytes() for i in range(0, DIMENSIONS, CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int32()), pa.array([rows] * len(chunks), pa.int64()), pa.array(chunks, pa.binary())], names=["chunk", "n", "sums"])


def add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up equal chunks as they stream by; a task holds each chunk once."""
    held: dict[int, list] = {}
    for batch in batches:
        for chunk, n, sums in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = held.setdefault(chunk, [0, 0])
            own[0] += n
            own[1] = own[1] + np.frombuffer(sums, np.int64)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1].tobytes() for v in held.values()], pa.binary())], names=["chunk", "n", "sums"])


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Over all rows of ``texts``: partial sums by task, then by chunk; the driver gets one vector."""
    schema = "chunk int, n long, sums binary"
    partial = map_arrow(texts, _frequencies, schema).repartition("chunk")
    total = np.zeros(DIMENSIONS, np.int64)
    rows = 0
    for chunk, n, sums in partial.mapInArrow(add_chunks, schema).collect():
        total[chunk * CHUNK:(chunk + 1) * CHUNK] += np.frombuffer(sums, np.int64)
        rows = max(rows, n)
    return rows, total


def _cluster(points: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; seeds are the means of equal groups by cosine to the whole mean."""
    middle = _scaled(points.mean(axis=0, keepdims=True))
    ranked = np.argsort(points @ middle[0], kind="stable")
    centres = _scaled(np.array([points[g].mean(axis=0) for g in np.array_split(ranked, min(clusters, len(points)))]))
    for _ in range(rounds):
        own = (points @ centres.T).argmax(axis=1)
        present = np.unique(own)
        centres = _scaled(np.array([points[own == k].mean(axis=0) for k in present]))
    return centres


def classes_of(table: np.ndarray) -> np.ndarray:
    """The class of each row of counts: the power of two in its number of different features."""
    return np.maximum(np.frexp(np.count_nonzero(table, axis=1).astype(np.float64))[1] - 1, 0)


def _least(points: np.ndarray, clusters: int) -> np.ndarray:
    """For every class, the least cosine of a language with the scaled rows ``points``."""
    own, least = np.zeros(len(points)), np.zeros(CLASSES)
    if len(points) < 2:
        return least
    for h in (0, 1):
        own[h::2] = (points[h::2] @ _cluster(points[1 - h::2], clusters).T).max(axis=1)
    classes = classes_of(points)
    for k in range(CLASSES):
        reached = own[classes == k]
        least[k] = SHARE * np.quantile(reached, 0.01) if len(reached) >= LEAST_ROWS else least[k - 1] if k else 0
    return least


def _fit(weights: np.ndarray, clusters: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        texts = group.sort_values(["order", "text"])["text"]
        points = np.vstack([_scaled(counts(pa.array(texts.iloc[i:i + 64])) * weights) for i in range(0, len(texts), 64)])
        centres = _cluster(points, clusters)
        return pd.DataFrame({"lang": key[0], "cluster": range(len(centres)),
                             "centre": [c.astype(np.float32).tobytes() for c in centres],
                             "least": [_least(points, clusters).tobytes()] * len(centres)})

    return run


def fit(learn: DataFrame, clusters: int = 3, sample: int = 400, languages: int = 1000) -> Model | None:
    """The model of ``learn (key, text, lang)``: rows with a text and a language."""
    learn = learn.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("key", "text", "lang")
    rows, seen = document_frequencies(learn)
    if not rows:
        return None
    weights = (np.log((1 + rows) / (1 + seen)) + 1).astype(np.float32)
    sizes = learn.groupBy("lang").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "lang").limit(languages)
    order = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30))
    drawn = (learn.join(F.broadcast(sizes), "lang")  # at most a row per learnt language
             .withColumn("order", order).filter(F.col("order") < F.lit(float(sample << 30)) / F.col("size")))
    fitted = drawn.select("lang", "order", "text").distinct().groupBy("lang").applyInPandas(
        _fit(weights, clusters), "lang string, cluster int, centre binary, least binary")
    found = sorted(fitted.collect(), key=lambda r: (r.lang, r.cluster))
    if not found:
        return None
    centres = np.array([np.frombuffer(r.centre, np.float32) for r in found])
    return Model([r.lang for r in found], centres, weights, np.array([np.frombuffer(r.least) for r in found]))


def _predict(model, reject_below: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model | None = model.value
        for batch in _rows(batches):
            langs, scores, rejected = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            seen = counts(batch.column("text"))
            known = seen.any(axis=1)
            if fitted and known.any():
                near = _scaled(seen[known] * fitted.weights) @ fitted.centroids.T
                best = near.argmax(axis=1)
                score = near[np.arange(len(best)), best]
                for i, k in zip(np.flatnonzero(known), best):
                    langs[i] = fitted.languages[k]
                scores[known] = np.clip(score, 0, 1)
                rejected[known] = score < np.maximum(reject_below, fitted.least[best, classes_of(seen[known])])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected)], names=["row", "lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model | None, row: Column, row_type: str, reject_below: float = REJECT_BELOW) -> DataFrame:
    """``row, lang_pred, score, rejected`` for every row of ``docs``, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x clusters x DIMENSIONS numbers
    texts = docs.select(row.alias("row"), "text")
    return map_arrow(texts, _predict(shared, reject_below), f"row {row_type}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learning_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("key"), "text", "lang")


def identify(docs: DataFrame, **options) -> DataFrame:
    """Every document's language, learnt from the documents that are not held out."""
    model = fit(learning_rows(docs), **options)
    return predict(docs, model, F.col("doc_id").cast("long"), "long").select(
        F.col("row").alias("doc_id"), held_out(F.col("row")).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose language is rejected; all columns as they were."""
    model = fit(learning_rows(docs), **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _predict(shared, REJECT_BELOW)
        for batch in _rows(batches):
            probe = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column("text")], names=["row", "text"])
            lost = np.concatenate([b.column("rejected").to_numpy(zero_copy_only=False) for b in judge(iter([probe]))])
            yield batch.filter(pa.array(~lost))

    return map_arrow(docs.select(*columns), run, docs.schema)
