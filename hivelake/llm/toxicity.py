"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct character n-grams of its words, with a mark at either end of a word, and
the whole marked words; letters A-Z are lower-cased and every character that is no letter or digit is a mark.
Each n-gram is worth its log-count ratio, the logarithm of how much likelier a toxic text holds it; logistic
regression with a penalty weighs these values.

Ratios and weights are learnt from at most ``TRAIN_ROWS`` labelled texts, those with the smallest hashes of
their ids, read whole.  The n-grams that tell most are kept, so that the model is a small table for each task;
which tell most is judged by different texts, so many copies of one text can't take all places with its n-grams.

Cases: null and empty texts have the score of a text without n-grams.  A row of labels without a label is left
out; labels that repeat an id count once, as toxic if one of them says so.  Repeated texts are scored each,
also those without an id.  Without labelled texts of both kinds every score is the share of toxic labels, or 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._sample import from_the_top, smallest_hashes
from ._scratch import remove, written
from ._text import LOWER, SLICE_BYTES, powers, slices, text_bytes

#: Characters of the n-grams, with the marks.
SIZES = (3, 4, 5, 6, 7)
#: Bits of an n-gram's hash.
BITS = 20
#: Labelled texts to learn from, at most.
TRAIN_ROWS = 8192
#: N-grams kept, and texts that must hold one.
KEPT, LEAST_TEXTS = 20_000, 4
PENALTY = 3.0


def labelled_for_training(id_: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether labels of this id may be learnt from."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds != fold


def _characters(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points, each row between two marks (0), and the rows' offsets in them."""
    points = np.frombuffer(LOWER[raw].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
    letters = ((points >= 97) & (points <= 122)) | ((points >= 48) & (points <= 57)) | (points >= 0xC0)
    letters &= (points != 0xD7) & (points != 0xF7) & ~((points >= 0x2000) & (points < 0x3040))
    n = len(offsets) - 1
    out = np.zeros(len(points) + n + 1, np.uint32)
    rows = np.repeat(np.arange(n), np.diff(before))
    out[np.arange(len(points)) + rows + 1] = np.where(letters, points, 0)
    return out, before + np.arange(n + 1)


def _grams(points: np.ndarray, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every n-gram and marked word; only of those that ``wanted`` marks, if it is given."""
    m = len(points)
    up, down = powers(m)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:m], dtype=np.uint64)])
    marks = np.concatenate([[0], np.cumsum(points == 0)])
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def code(value: np.ndarray, size: int) -> np.ndarray:
        return ((value * np.uint64(2 * size * 0x632BE5AB + 0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)

    for size in SIZES:
        if m < size:
            continue
        h = code((sums[size:] - sums[:-size]) * down[: m - size + 1], size)
        at = np.flatnonzero(wanted[h]) if wanted is not None else np.arange(len(h))
        at = at[marks[at + size - 1] == marks[at + 1]]  # no mark but at its ends
        found.append((h[at], at))
    edges = np.flatnonzero(points == 0)
    words = np.flatnonzero(np.diff(edges) > 1)
    start, end = edges[words], edges[words + 1] + 1
    h = code((sums[end] - sums[start]) * down[start], 0)
    keep = np.arange(len(h)) if wanted is None else np.flatnonzero(wanted[h])
    found.append((h[keep], start[keep]))
    return np.concatenate([h for h, _ in found]), np.concatenate([at for _, at in found])


def features(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, row, feature)`` of slices of a text column; each feature once a row."""
    raw, offsets = text_bytes(column)
    for a, b in slices(offsets, SLICE_BYTES if wanted is not None else SLICE_BYTES // 2):  # all n-grams take more room
        points, at = _characters(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        h, place = _grams(points, wanted)
        row = np.searchsorted(at[1:], place, "right")
        pairs = np.unique(row.astype(np.int64) << BITS | h)
        yield a, b, pairs >> BITS, pairs & ((1 << BITS) - 1)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with each n-gram by label, and different texts with it by label."""
    counts = np.zeros((4, 1 << BITS), np.int64)
    for batch in batches:
        y, copies = (batch.column(i).to_numpy(zero_copy_only=False).astype(int) for i in (0, 2))
        for a, b, row, h in features(batch.column(1)):
            for toxic in (0, 1):
                at = y[a:b][row] == toxic
                counts[toxic] += np.bincount(h[at], copies[a:b][row[at]], 1 << BITS).astype(np.int64)
                counts[2 + toxic] += np.bincount(h[at], minlength=1 << BITS)
    seen = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), *(pa.array(counts[i][seen]) for i in (1, 0, 3, 2))], names=["feature", "toxic", "clean", "toxic_texts", "clean_texts"])


def _sparse_rows(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, row, h in features(batch.column(1), wanted):
            ends = np.searchsorted(row, np.arange(b - a + 1))
            held = pa.array([h[s:e].astype(np.int32).tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), held], names=["toxic", "copies", "features"])


def logistic(rows: np.ndarray, columns: np.ndarray, value: np.ndarray, y: np.ndarray, times: np.ndarray | float = 1.0, *, penalty: float = PENALTY, steps: int = 80) -> tuple[np.ndarray, float]:
    """Weights and intercept of penalised logistic regression over sparse rows, each as often as ``times`` says, by L-BFGS."""
    n, k = len(y), len(value)
    times = np.broadcast_to(times, n)
    x = value[columns]

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(rows, x * w[columns], n) + w[k]
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        cost = times @ np.logaddexp(0, -np.where(y == 1, z, -z)) + 0.5 * penalty * (w[:k] @ w[:k])
        off = times * (p - y)
        slope = np.append(np.bincount(columns, off[rows] * x, k) + penalty * w[:k], off.sum())
        return cost, slope

    w = np.zeros(k + 1)
    w[k] = np.log((times @ y + 0.5) / (times @ (1 - y) + 0.5))
    cost, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, used = -slope, []
        for s, g in reversed(past):
            used.append((s @ d) / (s @ g))
            d = d - used[-1] * g
        if past:
            s, g = past[-1]
            d = d * ((s @ g) / (g @ g))
        for (s, g), a in zip(past, reversed(used), strict=True):
            d = d + (a - (g @ d) / (s @ g)) * s
        step = 1.0 if past else 1 / max(1.0, np.abs(slope).sum())
        while True:
            new, to = loss(w + step * d)
            if new <= cost + 1e-4 * step * (slope @ d) or step < 1e-10:
                break
            step /= 2
        if cost - new < 1e-7 * max(1.0, cost):
            break
        moved, turned = step * d, to - slope
        if moved @ turned > 1e-12:
            past = [*past[-9:], (moved, turned)]
        w, cost, slope = w + moved, new, to
    return w[:k], float(w[k])


@dataclass
class ToxicityModel:
    weights: np.ndarray  # of each n-gram's hash; 0 where it is not kept
    intercept: float


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, train_rows: int = TRAIN_ROWS, kept: int = KEPT) -> ToxicityModel:
    """Learn from the labelled rows whose fold is for training."""
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & labelled_for_training(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    chosen = written(smallest_hashes(known, "id", train_rows), "labelled")
    texts = docs.join(F.broadcast(chosen), docs[id_col] == chosen["id"]).select("toxic", F.col(text_col).alias("text"))
    texts = texts.groupBy("toxic", "text").agg(F.count(F.lit(1)).alias("copies"))
    texts = written(texts.repartition(8), "train")
    n_by = {r["toxic"]: (r["n"], r["texts"]) for r in texts.groupBy("toxic").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("texts")).collect()}
    (p, p_texts), (q, q_texts) = n_by.get(1, (0, 0)), n_by.get(0, (0, 0))
    weights = np.zeros(1 << BITS, np.float32)
    if not p or not q:
        return ToxicityModel(weights, 35.0 if p else -35.0)

    names = ("toxic", "clean", "toxic_texts", "clean_texts")
    counts = texts.mapInArrow(_gram_counts, "feature int, " + ", ".join(f"{c} long" for c in names)).groupBy("feature").agg(*(F.sum(c).alias(c) for c in names))
    share = (F.col("toxic_texts") + F.col("clean_texts")) / F.lit(float(p_texts + q_texts))
    surprise = F.abs(F.col("toxic_texts") - share * p_texts) / F.sqrt(share * (1 - share) * (p_texts * q_texts / (p_texts + q_texts)) + 1e-9)
    counts = written(counts.where(F.col("toxic") + F.col("clean") >= LEAST_TEXTS), "grams")
    best = from_the_top(counts, F.floor(surprise * 256).cast("int"), kept, surprise.desc(), F.col("feature")).toPandas().sort_values("feature")
    chosen_h = best["feature"].to_numpy()
    ratio = np.log((best["toxic"].to_numpy() + 1) / (p + 2)) - np.log((best["clean"].to_numpy() + 1) / (q + 2))
    wanted = np.zeros(1 << BITS, bool)
    wanted[chosen_h] = True
    shared = spark.sparkContext.broadcast(wanted)
    sparse = texts.mapInArrow(lambda it: _sparse_rows(it, shared.value), "toxic int, copies long, features binary").collect()
    held = [np.frombuffer(r["features"], np.int32) for r in sparse]
    rows = np.repeat(np.arange(len(held)), [len(x) for x in held])
    columns = np.searchsorted(chosen_h, np.concatenate(held))
    w, intercept = logistic(rows, columns, ratio, np.array([r["toxic"] for r in sparse], float), np.array([r["copies"] for r in sparse], float))
    weights[chosen_h] = w * ratio
    remove(texts, chosen, counts)
    return ToxicityModel(weights, intercept)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", *, into: str = "score") -> DataFrame:
    """``docs`` with the score of each text, from 0 to 1, in the column ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, intercept = shared.value.weights, shared.value.intercept
        wanted = weights != 0
        for column in batches:
            z = np.full(len(column), intercept)
            for a, b, row, h in features(column, wanted):
                z[a:b] += np.bincount(row, weights[h], b - a)
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))

    return docs.withColumn(into, scores(F.col(text_col)))


def score_all(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options: int) -> DataFrame:
    """``(id, held_out, score, predicted)`` for every row."""
    model = fit(docs, labels, id_col, text_col, label_col, **options)
    rows = score(docs.select(F.col(id_col), F.col(text_col).alias("__text")), model, "__text", into="__score")
    return rows.select(id_col, (~labelled_for_training(F.col(id_col))).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))
