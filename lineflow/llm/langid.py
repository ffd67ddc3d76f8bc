"""Language ID: multinomial naive Bayes over hashed character n-grams.

Tasks count hashed 1- to 3-grams by language; Spark adds the counts up; the driver gets
at most languages x BUCKETS sums and turns them into a log-probability matrix, which is
broadcast. Scoring hashes a slice of texts at once and sums the matrix's rows by text.

The language is the one of the highest sum over all n-grams of the text plus the prior.
Its score, which is to say how far a text can be trusted, is the posterior of the mean
n-gram counted EVIDENCE times at most, as sums over long texts always end at 0 or 1.

Results in odd cases: null texts and texts without a letter are `und` with score 0; rows
with a null language are not learned from but are predicted; with nothing to learn from
every text is `und`; equal scores go to the alphabetically first language; repeated rows
each count; an empty table gives no rows; other columns are not looked at; more than
LANGUAGES different languages are an error.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineflow.llm.common import release

#: Hash buckets of the n-grams.
BUCKETS = 1 << 15
#: Code points that are hashed at a time; longer texts are cut, with overlap, and summed.
SLICE = 1 << 19
#: Lengths of the n-grams.
ORDERS = (1, 2, 3)
#: Additive smoothing of the counts.
SMOOTHING = 0.5
#: In its score a text counts as so many n-grams at most, so that the score of a long one can be under 1.
EVIDENCE = 60.0
#: Languages, at most: the matrix has a row of BUCKETS numbers for each, in every task.
LANGUAGES = 256
UNDETERMINED = "und"


@functools.cache
def _letters() -> np.ndarray:
    """For each code point: itself where it is a letter, else a space."""
    points = np.arange(0x110000, dtype=np.uint32)
    return np.where([0xD800 > p or p > 0xDFFF and chr(p).isalpha() if p > 0xD7FF else chr(p).isalpha() for p in range(0x110000)], points, 32).astype(np.uint32)


def _slices(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-gram buckets, number of their text), a slice of code points at a time."""
    held: list[np.ndarray] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        for at in range(0, len(text or ""), SLICE):
            piece = text[max(0, at - max(ORDERS) + 1) : at + SLICE].lower()
            held.append(np.frombuffer(f" {piece} ".encode("utf-32-le", "replace"), "<u4"))
            owner.append(i)
            if sum(map(len, held)) >= SLICE:
                yield _grams(held, owner)
                held, owner = [], []
    if held:
        yield _grams(held, owner)


def _grams(held: list[np.ndarray], owner: list[int]) -> tuple[np.ndarray, np.ndarray]:
    points = _letters()[np.concatenate(held)]
    of = np.repeat(np.array(owner), [len(x) for x in held])
    buckets, whose = [], []
    for n in ORDERS:
        size = len(points) - n + 1
        code = np.zeros(size, np.uint64)
        blank = np.ones(size, bool)
        for k in range(n):
            part = points[k : k + size]
            code = code * np.uint64(0x100000001B3) + part
            blank &= part == 32
        code = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)
        keep = ~blank & (of[:size] == of[n - 1 :])
        buckets.append(code[keep].astype(np.int64))
        whose.append(of[:size][keep])
    return np.concatenate(buckets), np.concatenate(whose)


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang") -> tuple[list[str], np.ndarray] | None:
    """(languages, log probabilities (languages, BUCKETS + 1), the last being the prior); None if nothing to learn from."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        total = np.zeros((0, BUCKETS + 1), np.int64)
        for batch in batches:
            label = np.array([names.setdefault(x, len(names)) for x in batch.column(1).to_pylist()], int)
            if len(names) > len(total):
                total = np.vstack([total, np.zeros((len(names) - len(total), BUCKETS + 1), np.int64)])
            for bucket, whose in _slices(batch.column(0).to_pylist()):
                key = label[whose] * (BUCKETS + 1) + bucket
                total += np.bincount(key, minlength=total.size).reshape(total.shape)
            total[:, BUCKETS] += np.bincount(label, minlength=len(total))
        lang, bucket = np.nonzero(total)
        spelled = np.array([*names, ""], object)[lang]
        for at in range(0, len(lang), 10_000):
            part = slice(at, at + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(spelled[part], pa.string()), pa.array(bucket[part].astype(np.int32)), pa.array(total[lang[part], bucket[part]])], ["lang", "bucket", "n"])

    known = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("lang"))
    n_langs = known.select("lang").distinct().limit(LANGUAGES + 1).count()
    if n_langs > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    sums = known.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if sums.empty:
        return None
    langs = sorted(sums["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS + 1))
    counts[np.searchsorted(np.array(langs, object), sums["lang"].to_numpy(object)), sums["bucket"]] = sums["n"]
    grams, priors = counts[:, :BUCKETS] + SMOOTHING, counts[:, BUCKETS:]
    return langs, np.hstack([np.log(grams / grams.sum(axis=1, keepdims=True)), np.log(priors / priors.sum())])


def score_texts(texts: list[str | None], model: tuple[list[str], np.ndarray] | None, evidence: float = EVIDENCE) -> tuple[list[str], np.ndarray]:
    """The language of each text, by all its n-grams, and the posterior of its mean n-gram, taken `evidence` times at most."""
    n, langs, logp = len(texts), *(model or ([UNDETERMINED], np.zeros((1, BUCKETS + 1))))
    sums, size = np.zeros((len(langs), n)), np.zeros(n)
    for bucket, whose in _slices(texts):
        size += np.bincount(whose, minlength=n)
        if len(whose):
            order = np.argsort(whose, kind="stable")
            bucket, whose = bucket[order], whose[order]
            starts = np.flatnonzero(np.r_[True, whose[1:] != whose[:-1]])
            for k in range(len(langs)):
                sums[k, whose[starts]] += np.add.reduceat(logp[k][bucket], starts)
    mean = sums / np.maximum(size, 1) * np.minimum(size, evidence) + logp[:, BUCKETS:]
    share = np.exp(mean - mean.max(axis=0))
    share /= share.sum(axis=0)
    best = (sums + logp[:, BUCKETS:]).argmax(axis=0)
    known = (size > 0) & (model is not None)
    return [langs[b] if k else UNDETERMINED for b, k in zip(best, known)], np.where(known, share[best, np.arange(n)], 0.0)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray] | None, text_col: str = "text", evidence: float = EVIDENCE) -> Column:
    """A struct column (lang_pred string, score double) of docs' text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def score(text: pd.Series) -> pd.DataFrame:
        langs, scores = score_texts([None if pd.isna(t) else t for t in text], shared.value, evidence)
        release()
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    return score(F.col(text_col))


def keep_identified(docs: DataFrame, learn: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs whose language is determined with a posterior, of all n-grams, of at least `least`."""
    model = fit(learn)
    found = predict(docs, model, evidence=np.inf)
    return docs.where((found["lang_pred"] != UNDETERMINED) & (found["score"] >= least))
