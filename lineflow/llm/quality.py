"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of a whole text are standardised and mapped to random Fourier features, which
approximate a Gaussian kernel. Each task sums its part of the normal equations; Spark
adds the parts up row by row; the driver solves the one small system. The isotonic curve
is fitted to counts by bin of the ridge score, over a fifth of the labelled rows that the
ridge was not fitted on; with fewer than FOLD rows in either part both use all of them.

A model is fitted on LABELS labelled rows at most, about: of more a sample by a hash of
the id is taken, so that what is gathered for fitting doesn't grow. Scores cover all rows.

Results in odd cases: null texts count as empty, and empty texts get a score like any
other; ids with a null label are not learned from, and of several labels of an id the
highest counts; with no labels the score is 0.5, with labels of one kind near that kind;
repeated rows each count; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineflow.llm.common import held_out, release, released

#: Random Fourier features.
FEATURES = 384
#: Width of the Gaussian kernel, in standardised units.
WIDTH = 4.0
#: Ridge penalty for each row.
RIDGE = 1e-4
#: Labelled rows that a model is fitted on, about at most, and those that a task sums up.
LABELS, TASK_ROWS = 100_000, 5_000
#: Rows that the ridge and the curve need each, or else they share all rows.
FOLD = 100
#: Bins of the ridge score for calibration, over LOW to HIGH.
BINS, LOW, HIGH = 2000, -0.5, 1.5
#: Rows with a score under this are predicted to be of quality 0.
THRESHOLD = 0.3

_KINDS = np.zeros(256, np.uint8)  # 0 other bytes, mostly parts of letters beyond ASCII
_KINDS[ord("a") : ord("z") + 1] = 1
_KINDS[ord("A") : ord("Z") + 1] = 2
_KINDS[ord("0") : ord("9") + 1] = 3
_KINDS[[9, 10, 11, 12, 13, 32]] = 4
_KINDS[list(b".,;:'\"-")] = 5
_KINDS[list(b"!?")] = 6
_KINDS[list(b"|<>{}[]()/\\_=~^`")] = 7
_KINDS[list(b"#$%&*@+")] = 8

N_STATS = 24


def statistics(text: bytes | None) -> list[float]:
    """N_STATS numbers about a whole text."""
    text = text or b""
    size = max(len(text), 1)
    kinds = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=9) / size
    words = text.split()
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    codes = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    _, count = np.unique(codes, return_counts=True)
    lines = text.split(b"\n")
    filled = [x for x in lines if x.strip()]
    n_lines = max(len(filled), 1)
    pairs = codes[1:] * 31 + codes[:-1]
    n_pairs = max(len(pairs), 1)
    return [
        np.log1p(len(text)), np.log1p(len(words)), *kinds[:9].tolist(),
        lengths.mean(), lengths.std(), (lengths <= 3).mean(), (lengths > 20).mean(),
        len(count) / n, count.max() / n, (codes[1:] == codes[:-1]).sum() / n, len(np.unique(pairs)) / n_pairs if len(pairs) else 1.0,
        len(set(filled)) / n_lines, np.log1p(len(text) / n_lines), np.log1p(n / n_lines),
        kinds[2] / max(kinds[0] + kinds[1] + kinds[2], 1e-9), sum(w[-1] > 32 and _KINDS[w[-1]] >= 5 for w in words) / n,
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats array<float>) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(t.as_py()) for t in batch.column(1)], np.float32).reshape(-1, N_STATS)
            offsets = pa.array(np.arange(0, rows.size + 1, N_STATS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))], ["doc_id", "stats"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(released(run), "doc_id long, stats array<float>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the Fourier features and the constant
    at: np.ndarray  # ridge scores, ascending
    value: np.ndarray  # their calibrated scores

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng(11)
        turn = draw.normal(0, 1 / WIDTH, (N_STATS, FEATURES))
        shift = draw.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ turn + shift), np.ones((len(stats), 1))])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated; a thousandth of the score keeps the order within the curve's steps."""
        raw = self.ridge(stats)
        return 0.999 * np.interp(raw, self.at, self.value) + 0.001 / (1 + np.exp(-np.clip(4 * raw - 2, -30, 30)))


def pool(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to value in weighted squares (pool adjacent violators)."""
    means: list[float] = []
    weights: list[float] = []
    counts: list[int] = []
    for v, w in zip(value, weight):
        means.append(float(v)), weights.append(float(w)), counts.append(1)
        while len(means) > 1 and means[-2] >= means[-1]:
            m, w2, c = means.pop(), weights.pop(), counts.pop()
            means[-1] = (means[-1] * weights[-1] + m * w2) / (weights[-1] + w2)
            weights[-1] += w2
            counts[-1] += c
    return np.repeat(means, counts)


def _matrix(stats: pa.ListArray) -> np.ndarray:
    return stats.flatten().to_numpy().reshape(-1, N_STATS).astype(float)


def sampled_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", most: int = LABELS) -> DataFrame:
    """(doc_id, y): one row for each id with a label, or a sample of some `most` by a hash of the id; marked for broadcast."""
    kinds = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("double").alias("y"))
    n = kinds.count()
    return F.broadcast(kinds.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(n)) < most) if n > most else kinds)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model | None:
    """stats as of features(); labels with id_col and a 0/1 label_col. None without labels."""
    kinds = sampled_labels(labels, id_col, label_col)
    rows = stats.join(kinds, "doc_id").select("stats", "y", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("apart"))
    rows = rows.repartition(-(-LABELS // TASK_ROWS)).persist()
    try:
        moments = rows.select(F.count("*").alias("n"), F.count_if("apart").alias("apart"), *(f(F.col("stats")[i].cast("double")).alias(f"{f.__name__}{i}") for i in range(N_STATS) for f in (F.avg, F.stddev_pop))).first()
        if not moments["n"]:
            return None
        mean = np.array([moments[f"avg{i}"] for i in range(N_STATS)])
        scale = np.array([moments[f"stddev_pop{i}"] for i in range(N_STATS)])
        enough = min(moments["apart"], moments["n"] - moments["apart"]) >= FOLD
        ridge_rows, curve_rows = (rows.where(~F.col("apart")), rows.where("apart")) if enough else (rows, rows)
        model = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
        start = rows.sparkSession.sparkContext.broadcast(model)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((FEATURES + 1, FEATURES + 2))
            for batch in batches:
                z = start.value.fourier(_matrix(batch.column(0)))
                total += z.T @ np.hstack([z, batch.column(1).to_numpy()[:, None]])
            if total[-1, -2]:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1, dtype=np.int32)), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "part"])

        def add(parts: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"i": parts["i"].iloc[:1], "part": [sum(np.frombuffer(p) for p in parts["part"]).tobytes()]})

        sums = ridge_rows.mapInArrow(partial, "i int, part binary").groupBy("i").applyInPandas(add, "i int, part binary").collect()
        system = np.array([np.frombuffer(r.part) for r in sorted(sums, key=lambda r: r.i)])
        n_ridge = moments["n"] - moments["apart"] if enough else moments["n"]
        model.weights = np.linalg.solve(system[:, :-1] + RIDGE * n_ridge * np.diag([*[1.0] * FEATURES, 0.0]) + 1e-9 * np.eye(FEATURES + 1), system[:, -1])
        fitted = rows.sparkSession.sparkContext.broadcast(model)

        def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, ones = np.zeros(BINS), np.zeros(BINS)
            for batch in batches:
                raw = fitted.value.ridge(_matrix(batch.column(0)))
                at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)
                n += np.bincount(at, minlength=BINS)
                ones += np.bincount(at, batch.column(1).to_numpy(), minlength=BINS)
            full = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(n[full]), pa.array(ones[full])], ["bin", "n", "ones"])

        found = curve_rows.mapInArrow(bins, "bin int, n double, ones double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).toPandas().sort_values("bin")
        model.at = LOW + (found["bin"].to_numpy() + 0.5) * (HIGH - LOW) / BINS
        model.value = pool((found["ones"] / found["n"]).to_numpy(), found["n"].to_numpy())
        return model
    finally:
        rows.unpersist()


def learn(docs: DataFrame, labels: DataFrame, stats: DataFrame | None = None) -> Model | None:
    """Fits on the labelled documents that aren't held out; statistics, where there are none yet, are made of these only."""
    known = labels.where(~held_out(F.col("doc_id")))
    if stats is None:
        stats = features(docs.select("doc_id", "text").join(sampled_labels(known).select("doc_id"), "doc_id", "left_semi"))
    return fit(stats, known)


def scored(stats: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) from features()."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = shared.value
            score = np.full(batch.num_rows, 0.5) if m is None else m.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(released(run), "doc_id long, score double")


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> Column:
    """The score of docs' text as a column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(text: pd.Series) -> pd.Series:
        if shared.value is None:
            return pd.Series(np.full(len(text), 0.5))
        scores = shared.value.score(np.array([statistics(t) for t in text]).reshape(-1, N_STATS))
        release()
        return pd.Series(scores)

    return run(F.col(text_col).cast("binary"))
