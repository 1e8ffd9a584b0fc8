"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text give the non-negative unbiased risk

    prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])

(logistic loss l), minimised by full-batch Adam steps; while the second part is negative, its
gradient is followed the other way. The model is additive: each style feature of a whole text
falls in one of the quantile bins of the training sample (at most ``BINS``, fewer for few positives), and f is the sum of the bins' weights. The class
prior is estimated from the same data: a first classifier of positives against unlabelled
text ranks both, and the prior is the least ratio of unlabelled to positive mass over its
upper regions (with a margin for sampling error), because there the negatives are absent.

The fit uses a bounded sample: at most about ``FIT_ROWS`` positives and ``FIT_ROWS`` unlabelled rows chosen by
a hash of the id. Features and scores are computed for every whole text.

Edge cases: null and empty texts have all-zero features and are scored like any text; without
positives or without unlabelled rows the score is the prior (0.5); repeated rows get equal scores;
output columns replace input columns of the same names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import linear
from .tables import bounded_sample, documents, fold, materialize, read
from .textvec import SPACE, mix, occurrences, pieces, prefix, ranges, raw, shingles, words

FIT_ROWS, BINS, ROUNDS, RATE, L2 = 20000, 40, 300, 0.05, 1e-2
STYLE = ("symbols", "exclaims", "pipes", "upper", "other_marks", "distinct_words", "top_repeat", "neighbour_repeat",
         "window_repeat", "dup_lines", "marked_ends")


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[off[1:]] - total[off[:-1]]).astype(float)


def _by(owner: np.ndarray, n: int, weight=None) -> np.ndarray:
    return np.bincount(owner, weights=weight, minlength=n).astype(float)


def style(batch: pa.RecordBatch, text: str) -> np.ndarray:
    """One row of STYLE values per text, computed on the bytes of all texts at once."""
    buf, off = raw(batch.column(text))
    n = batch.num_rows
    doc, start, end = words(buf, off)
    n_words = _by(doc, n)
    per_word = np.maximum(n_words, 1)
    sums = prefix(buf)
    h = ranges(sums, start, end)
    upper, lower = (buf >= 65) & (buf <= 90), (buf >= 97) & (buf <= 122)
    plain = upper | lower | ((buf >= 48) & (buf <= 57)) | (buf >= 128) | SPACE[buf]
    symbol = np.isin(buf, np.frombuffer(b"#*$%&<>", dtype=np.uint8))
    mark = ~(plain | symbol)
    seen = occurrences(h, doc)
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    wide, woff = shingles(h, doc, n, 5)
    wdoc = np.repeat(np.arange(n), np.diff(woff))
    repeats = occurrences(wide, wdoc) > 0
    breaks = buf == 10
    # lines: from each document start or line break to the next
    first = np.unique(np.concatenate((off[:-1], np.flatnonzero(breaks) + 1)))
    first = first[first < len(buf)] if len(buf) else first[:0]
    line_doc = np.searchsorted(off, first, side="right") - 1
    last = np.concatenate((first[1:], [len(buf)])) if len(first) else first
    line = mix(ranges(sums, first, np.minimum(last, off[line_doc + 1] if len(first) else last)) + np.uint64(1))
    long_line = (last - first) > 2
    lines = np.maximum(_by(line_doc[long_line], n), 1)
    dup_line = occurrences(line[long_line], line_doc[long_line]) > 0
    tail = buf[end - 1] if len(end) else buf[:0]
    marked = np.isin(tail, np.frombuffer(b"#*$%&<>!|", dtype=np.uint8))
    top = np.zeros(n)
    np.maximum.at(top, doc, seen + 1.0)
    letters = np.maximum(_sums(upper | lower, off), 1)
    return np.column_stack([
        _sums(symbol, off) / per_word, _sums(buf == 33, off) / per_word, _sums(buf == 124, off) / per_word,
        _sums(upper, off) / letters, _sums(mark, off) / per_word, _by(doc, n, seen == 0) / per_word, top / per_word,
        _by(doc, n, same) / per_word, _by(wdoc, n, repeats) / np.maximum(np.diff(woff), 1),
        _by(line_doc[long_line], n, dup_line) / lines, _by(doc, n, marked) / per_word])


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """Replaces ``text`` by the array ``style``."""
    keep = [f for f in df.schema.fields if f.name not in (text, "style")]
    schema = T.StructType([*keep, T.StructField("style", T.ArrayType(T.FloatType(), False))])

    def run(batches):
        for whole in batches:
            for b in pieces(whole, text):
                x = style(b, text).astype(np.float32)
                at = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in keep], pa.ListArray.from_arrays(at, pa.array(x.ravel()))],
                                                 names=schema.names)

    return df.mapInArrow(run, schema)


def _matrix(df: DataFrame) -> np.ndarray:
    got = df.select("style").toArrow().column("style").combine_chunks()
    got = got.chunk(0) if isinstance(got, pa.ChunkedArray) else got
    return got.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STYLE)).astype(float)


class Additive:
    """Sum of one weight per feature bin."""

    def __init__(self, cuts: list[np.ndarray]):
        self.cuts = cuts
        self.base = np.concatenate(([0], np.cumsum([len(c) + 1 for c in cuts])))
        self.weight, self.bias = np.zeros(self.base[-1]), 0.0

    def index(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([self.base[j] + np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)]).ravel()

    def f(self, index: np.ndarray) -> np.ndarray:
        return self.weight[index].reshape(-1, len(self.cuts)).sum(axis=1) + self.bias


def _grad(model: Additive, index: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    wide = np.bincount(index, weights=np.repeat(per_row, len(model.cuts)), minlength=len(model.weight))
    return np.append(wide, per_row.sum())


def _train(model: Additive, p: np.ndarray, u: np.ndarray, prior: float | None) -> None:
    """``prior`` None: positives against unlabelled rows; else the non-negative unbiased risk."""
    n_p, n_u = len(p) // len(model.cuts), len(u) // len(model.cuts)
    opt = linear.Adam(len(model.weight) + 1, RATE)
    for _ in range(ROUNDS):
        fp, fu = model.f(p), model.f(u)
        up, down_p, down_u = linear.sigmoid(-fp), linear.sigmoid(fp), linear.sigmoid(fu)
        if prior is None:
            grad = _grad(model, p, -up / n_p) + _grad(model, u, down_u / n_u)
        else:
            loss = lambda z: np.logaddexp(0, -z)
            negative = loss(-fu).mean() - prior * loss(-fp).mean()
            away = _grad(model, u, down_u / n_u) + _grad(model, p, -prior * down_p / n_p)
            grad = _grad(model, p, -prior * up / n_p) + away if negative >= 0 else -away
        x = np.append(model.weight, model.bias)
        x = opt.step(x, grad + L2 * np.append(model.weight, 0))
        model.weight, model.bias = x[:-1], x[-1]


def class_prior(fp: np.ndarray, fu: np.ndarray) -> float:
    """Least ratio of unlabelled to positive mass above a score, with a one-sided sampling margin."""
    cuts = np.quantile(fp, np.linspace(0, 0.7, 71))
    above = lambda x: 1 - np.searchsorted(np.sort(x), cuts, side="left") / len(x)
    a_p, a_u = above(fp), above(fu)
    slack = 2 * (np.sqrt(a_u * (1 - a_u) / len(fu)) + np.sqrt(a_p * (1 - a_p) / len(fp)))
    ratio = (a_u + slack) / np.maximum(a_p, 1e-9)
    return float(np.clip(ratio[a_p >= 0.25].min(), 0.05, 0.98))


def fit(positive: DataFrame, unlabelled: DataFrame) -> tuple[Additive | None, float]:
    """Model and class prior from two tables with ``style`` features."""
    p = _matrix(bounded_sample(positive, FIT_ROWS))
    u = _matrix(bounded_sample(unlabelled, FIT_ROWS))
    if not len(p) or not len(u):
        return None, 0.5
    both = np.concatenate((p, u))
    bins = int(np.clip(np.sqrt(len(p)) / 1.5, 8, BINS))
    cuts = [np.unique(np.quantile(both[:, j], np.linspace(0, 1, bins + 1)[1:])) for j in range(len(STYLE))]
    first = Additive(cuts)
    ip, iu = first.index(p), first.index(u)
    _train(first, ip, iu, None)
    prior = class_prior(first.f(ip), first.f(iu))
    model = Additive(cuts)
    model.bias = float(np.log(prior / (1 - prior)))
    _train(model, ip, iu, prior)
    return model, prior


def score(df: DataFrame, model: Additive | None, prior: float) -> DataFrame:
    """Replaces ``style`` by score (probability of the positive class) and predicted."""
    keep = [f for f in df.schema.fields if f.name not in ("style", "score", "predicted")]
    schema = T.StructType([*keep, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for b in batches:
            x = b.column("style").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STYLE)).astype(float)
            s = np.full(b.num_rows, prior) if model is None else linear.sigmoid(model.f(model.index(x)))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in keep], pa.array(s, pa.float64()),
                                              pa.array((s >= 0.5).astype(np.int32))], names=schema.names)

    return df.mapInArrow(run, schema)


def pu_quality(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of documents (doc_id, text), with the columns ``carry``; trusted positives are the
    rows that ``labels`` marks 1, outside the held-out third, and the unlabelled text is that of all
    other rows outside it."""
    rows = materialize(features(docs.select("doc_id", "text", *carry, (fold("doc_id", 3) == 1).alias("held_out"))), "style")
    learn = rows.filter(~F.col("held_out"))
    marked = learn.join(labels.filter("quality = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    model, prior = fit(marked, learn)
    return score(rows, model, prior)


def op3_pu_quality(spark, sf_dir: str) -> DataFrame:
    return pu_quality(documents(spark, sf_dir), read(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")
