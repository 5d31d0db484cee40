"""Quality classifier: regularised quadratic discriminant over document statistics.

``features`` reads every whole text once and writes a thin table of transformed statistics
(logarithms of sizes, log-odds-like transforms of shares). ``fit`` gathers the class moments of
the labelled rows as sums that combine in the tasks (one record per class and pair of statistics
reaches the driver) and shrinks each class covariance:

    S_k = (1 - POOL) * C_k + POOL * C_pooled, then (1 - RIDGE) * S_k + RIDGE * diag(C_pooled)

Only the Cholesky factors' inverses, the means and the log-determinants are kept; a score is
the logistic function of the log prior odds plus the difference of the two log densities, each a
Mahalanobis distance computed with its cached factor.

Learning uses ``labels`` rows whose crc32 of the id as text is not 1 modulo 3; labels, language,
source and id are no inputs of a score. All such rows are used; nothing is sampled.

Defined results: a null text counts as empty; an empty text has the statistics of no characters
and a score like any other; a label that is null is not used; an id labelled twice counts twice;
without labels of both classes every score is the share of label 1 (0.5 without any); other
columns are ignored; rows that repeat are scored row by row.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .textkit import blocks, lower_ascii, non_space, shingle_hashes, word_hashes, spans, prefix_sums, span_hashes

POOL = 0.05
RIDGE = 0.01
SMOOTH = 0.005

#: Byte classes counted per document.
CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": [32, 9, 11, 12],
    "newline": [10, 13], "stop": [46, 63], "bang": [33], "comma": [44, 58, 59],
    "symbol": [35, 36, 37, 38, 42, 64, 94, 126, 124, 60, 62, 61, 43, 95, 92, 96],
    "bracket": [40, 41, 91, 93, 123, 125], "quote": [34, 39], "wide": range(128, 256),
}
NAMES = (["log_bytes", "log_words", "word_length", "words_per_line", "words_per_stop"] + list(CLASSES)
         + ["symbol_words", "upper_words", "short_words", "long_words", "distinct_words", "distinct_pairs", "distinct_lines"])


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct hashes of each row: one sort of the row number over 44 bits of hash."""
    row = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    key = np.unique((row << np.uint64(44)) | (hashes >> np.uint64(20)))
    return np.bincount((key >> np.uint64(44)).astype(np.int64), minlength=len(first) - 1)


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Transformed statistics of each row of a block (rows of a matrix, in ``NAMES`` order)."""
    n = len(off) - 1
    size = np.diff(off).astype(float)

    def per_row(mask, at=off):
        return np.diff(np.concatenate(([0], np.cumsum(mask)))[at]).astype(float)

    keep = non_space()
    words, starts, ends, first = word_hashes(data, off, keep, lower_ascii())
    count = np.diff(first).astype(float)
    length = ends - starts

    def share(part, whole):
        # Log-odds with a small constant: finite at 0 and 1, near linear in between.
        p = np.divide(part, whole, out=np.zeros(n), where=whole > 0)
        return np.log((p + SMOOTH) / (1 - p + SMOOTH))

    # The classes are disjoint: one count over (row, class).
    table = np.full(256, len(CLASSES), np.int64)
    for k, members in enumerate(CLASSES.values()):
        table[list(members)] = k
    width = len(CLASSES) + 1
    cells = np.bincount(np.repeat(np.arange(n) * width, np.diff(off)) + table[data], minlength=n * width)
    counts = dict(zip(CLASSES, cells.reshape(n, width).T.astype(float)))
    symbol = np.zeros(256, bool)
    symbol[list(CLASSES["symbol"]) + list(CLASSES["bang"])] = True
    upper = np.zeros(256, bool)
    upper[65:91] = True
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    second = data[np.minimum(starts + 1, ends - 1)] if len(ends) else last
    pairs, begin = shingle_hashes(words, first, 2)
    line_keep = np.ones(256, bool)
    line_keep[[10, 13]] = False
    line_start, line_end = spans(data, off, line_keep)
    lines = span_hashes(prefix_sums(data), line_start, line_end)
    line_first = np.searchsorted(line_start, off)
    n_lines = np.diff(line_first).astype(float)
    columns = [
        np.log1p(size), np.log1p(count), np.log1p(np.divide(size, count, out=np.zeros(n), where=count > 0)),
        np.log1p(np.divide(count, n_lines, out=np.zeros(n), where=n_lines > 0)),
        np.log1p(count / (1 + counts["stop"])),
        *(share(counts[name], size) for name in CLASSES),
        share(per_row(symbol[last], first), count), share(per_row(upper[second], first), count),
        share(per_row(length <= 3, first), count), share(per_row(length > 12, first), count),
        share(_distinct(words, first).astype(float), count),
        share(_distinct(pairs, begin).astype(float), np.diff(begin).astype(float)),
        share(_distinct(lines, line_first).astype(float), n_lines),
    ]
    return np.column_stack(columns) if n else np.zeros((0, len(NAMES)))


def _features(batches):
    for batch in batches:
        for row, data, off in blocks(batch.column(1)):
            x = statistics(data, off)
            flat = pa.array(x.ravel())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row, len(x)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), flat)], ["doc_id", "x"])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The statistics of every document: id, x (array of doubles in ``NAMES`` order)."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        _features, f"doc_id {kind}, x array<double>").withColumnRenamed("doc_id", id_col)


def held_out(id_col: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def _moments(batches):
    """Sums of each task: per class the count, each statistic and each product of two."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        x = np.array(batch.column(1).to_pylist()).reshape(len(label), -1)
        x = np.column_stack([np.ones(len(x)), x])
        for k in np.unique(label).tolist():
            own = x[label == k]
            total[k] = total.get(k, 0) + own.T @ own
    rows = [(k, i, j, m[i, j]) for k, m in total.items() for i in range(len(m)) for j in range(i + 1)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.float64()))],
        ["label", "i", "j", "value"])


def fit(x: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        pool: float = POOL, ridge: float = RIDGE) -> dict:
    """The model as plain arrays, from the statistics of labelled rows that are not held out."""
    marked = labels.where(~held_out(F.col(id_col)) & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    sums = (x.join(marked, F.col(id_col) == F.col("_id")).select("_label", "x")
            .mapInArrow(_moments, "label int, i int, j int, value double")
            .groupBy("label", "i", "j").agg(F.sum("value").alias("value")).collect())
    size = len(NAMES) + 1
    moments = {k: np.zeros((size, size)) for k in (0, 1)}
    for r in sums:
        moments[r["label"]][r["i"], r["j"]] = moments[r["label"]][r["j"], r["i"]] = r["value"]
    n = {k: m[0, 0] for k, m in moments.items()}
    if min(n.values()) < 2:
        return {"share": n[1] / sum(n.values()) if sum(n.values()) else 0.5}
    mean = {k: m[0, 1:] / n[k] for k, m in moments.items()}
    cov = {k: m[1:, 1:] / n[k] - np.outer(mean[k], mean[k]) for k, m in moments.items()}
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
    floor = np.diag(np.maximum(np.diag(pooled), 1e-6))
    model = {"odds": float(np.log(n[1] / n[0])), "mean": [], "factor": [], "log_det": []}
    for k in (0, 1):
        s = (1 - ridge) * ((1 - pool) * cov[k] + pool * pooled) + ridge * floor
        factor = np.linalg.cholesky(s)
        model["mean"].append(mean[k])
        model["factor"].append(np.linalg.inv(factor))
        model["log_det"].append(float(2 * np.log(np.diag(factor)).sum()))
    return model


def score(x: np.ndarray, model: dict) -> np.ndarray:
    if "share" in model:
        return np.full(len(x), model["share"])
    density = []
    for k in (0, 1):
        z = (x - model["mean"][k]) @ model["factor"][k].T
        density.append(-0.5 * ((z * z).sum(axis=1) + model["log_det"][k]))
    odds = np.clip(model["odds"] + density[1] - density[0], -700, 700)
    return 1 / (1 + np.exp(-odds))


def _score(batches, model: dict):
    for batch in batches:
        x = np.array(batch.column(1).to_pylist()).reshape(batch.num_rows, -1)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(x, model))], ["doc_id", "score"])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``held_out``, ``score`` (higher: label 1 likelier), ``predicted``."""
    x = written(features(docs, id_col, text_col), "quality-features")
    model = fit(x, labels, id_col)
    kind = docs.schema[id_col].dataType.simpleString()
    scored = x.mapInArrow(partial(_score, model=model), f"doc_id {kind}, score double").withColumnRenamed("doc_id", id_col)
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _keep(batches, model: dict, at: int):
    for batch in batches:
        for row, data, off in blocks(batch.column(at)):
            keep = score(statistics(data, off), model) >= 0.5
            yield batch.slice(row, len(keep)).filter(pa.array(keep))


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose score is at least 0.5, with their columns. The statistics are computed
    again next to the text, so no text is shuffled."""
    model = fit(written(features(docs, id_col, text_col), "quality-features"), labels, id_col)
    return docs.mapInArrow(partial(_keep, model=model, at=docs.columns.index(text_col)), docs.schema)
