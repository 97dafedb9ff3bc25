"""Quality classifier by Bradley-Terry pairwise ranking.

Every text gets features of its bytes and words. From preference pairs -- a row labelled good over one labelled bad --
weights are learnt by logistic loss on the features' differences, so a document's score is its worth in the
Bradley-Terry model. The threshold is a quantile of the scores of all labelled training rows: as large a share of them
as is labelled bad lies below it. A score is given as sigmoid(worth - threshold + logit(0.7)), so that 0.7 is the
threshold.

Texts are read once; their features (a few hundred bytes a text) are written to the shared folder. The pairs come from
a bounded sample of labelled rows (SAMPLE of each label, those whose ids and features hash lowest; rows equal in both
are one); the threshold comes from all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, list_array, record_batch, save, text_buffers, text_groups, window_mask, windows

#: Labelled rows of each label that pairs are made of; pairs; weight of the L2 penalty; score at the threshold.
SAMPLE, PAIRS, PENALTY, CUT = 5_000, 100_000, 1e-3, 0.7
#: Texts that features are made of at a time, in bytes: the arrays take some 30 bytes for each, beside other workers' and the JVM's.
GROUP = 1 << 19


def _byte_kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)  # 0: other letters
    kind[97:123], kind[65:91], kind[48:58] = 1, 2, 3
    for i, group in enumerate((b" \t\r\x0b\x0c", b"\n", b".,;:", b"!?", b"'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~")):
        kind[list(group)] = 4 + i
    kind[:9] = kind[14:32] = 10
    return kind


def features(data: np.ndarray, bounds: np.ndarray, hasher: WordHasher, kinds: np.ndarray) -> np.ndarray:
    """A row of ratios for each text."""
    n, size = len(bounds) - 1, np.diff(bounds)
    text = np.repeat(np.arange(n), size)
    count = np.bincount(text * 11 + kinds[data], minlength=11 * n).reshape(n, 11).astype(float)
    h, woff = hasher(data, bounds)
    words = np.diff(woff).astype(float)
    of = np.repeat(np.arange(n), np.diff(woff))

    def distinct(keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different keys of each text, and the uses of its most frequent one."""
        back, own = pd.factorize(keys ^ (of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        first = np.empty(len(own), np.int64)
        first[back] = of
        most = np.zeros(n)
        np.maximum.at(most, first, np.bincount(back, minlength=len(own)))
        return np.bincount(first, minlength=n).astype(float), most

    different, most = distinct(h, of)
    ok = window_mask(woff, 3)
    three, most_three = distinct(windows(h, 3)[ok], of[:len(ok)][ok])
    threes = np.maximum(words - 2, 0)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    repeats = np.bincount(of, weights=same, minlength=n)
    solid = np.maximum(size - count[:, 4] - count[:, 5], 1)
    letters = np.maximum(count[:, 0] + count[:, 1] + count[:, 2], 1)
    w = np.maximum(words, 1)
    ratios = np.stack([
        count[:, 2] / letters, count[:, 3] / solid, count[:, 6] / w, count[:, 7] / w, count[:, 8] / w, count[:, 9] / solid, count[:, 10] / solid,
        count[:, 5] / w, count[:, 0] / letters, 1 - different / w, most / w, 1 - three / np.maximum(threes, 1) * (threes > 0) - (threes == 0),
        most_three / np.maximum(threes, 1), repeats / w], axis=1)
    ratios = np.clip(ratios, 0, None)
    length = np.stack([np.log1p(words) / 10, solid / w / 10], axis=1)
    return np.concatenate([ratios, np.sqrt(ratios), np.minimum(ratios, 0.05) * 20, np.minimum(ratios, 0.3), length, length ** 2, (words == 0)[:, None]], axis=1)


def _features():
    schema = pa.schema([("id", pa.int64()), ("f", pa.list_(pa.float64()))])

    def run(batches):
        hasher, kinds = WordHasher(lower=True), _byte_kinds()
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            for i, j in text_groups(bounds, GROUP):
                f = features(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], hasher, kinds)
                yield record_batch(schema, [batch.column(0)[i:j], list_array(list(f), pa.float64())])
    return run


def bradley_terry(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, penalty: float = PENALTY, rounds: int = 25) -> np.ndarray:
    """Weights by Newton's method for P(good over bad) = sigmoid(w . (good - bad)), over random pairs."""
    rng = np.random.default_rng(0)
    x = good[rng.integers(0, len(good), pairs)] - bad[rng.integers(0, len(bad), pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))  # probability of the pair's other order
        gradient = -(x * p[:, None]).mean(axis=0) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / pairs + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """worth(f) = weights . f + offset, where 0 is the threshold; constant 1 if ``weights`` is None."""

    def __init__(self, weights: np.ndarray | None, offset: float = 0.0):
        self.weights, self.offset = weights, offset

    def scores(self, f: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(f))
        # summed row by row, so that equal texts get equal scores wherever they are
        worth = (f * self.weights).sum(axis=1) + self.offset
        return 1 / (1 + np.exp(-np.clip(worth + np.log(CUT / (1 - CUT)), -700, 700)))


def _scored(model: Model):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            f = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            yield record_batch(schema, [batch.column(0), batch.column(1), model.scores(f)])
    return run


def _accepted(model: Model, at: int):
    def run(batches):
        hasher, kinds = WordHasher(lower=True), _byte_kinds()
        for batch in batches:
            data, bounds = text_buffers(batch.column(at))
            for i, j in text_groups(bounds, GROUP):  # sent back as they are judged, never a second copy of the whole batch
                keep = model.scores(features(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], hasher, kinds)) >= CUT
                if keep.any():
                    yield batch.slice(i, j - i).filter(pa.array(keep))
    return run


def _text_features(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return save(own.mapInArrow(_features(), "id long, f array<double>").withColumn("held_out", held_out), "features", texts=True)


def fit(feats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    marks = labels.where("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").alias("quality"))
    train = feats.where("not held_out").join(marks, "id")
    number = dict(train.groupBy("quality").agg(F.count_distinct(F.xxhash64("id", "f"))).collect())
    drawn = train.withColumn("h", F.pmod(F.xxhash64("id", "f", F.lit(11)), F.lit(1 << 40)))
    rows = []
    for q in (1, 0):  # half as many again as are wanted, by the hash alone; the lowest of them are taken
        share = min(1.0, 1.5 * sample / max(number.get(q, 0), 1))
        some = drawn.where((F.col("quality") == q) & (F.col("h") <= int(share * (1 << 40)))).select("h", "id", "f").distinct().collect()
        rows.append(np.array([r.f for r in sorted(some, key=lambda r: (r.h, r.id, r.f))[:sample]]))
    if not all(map(len, rows)):
        return Model(None)
    both = np.concatenate(rows)
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-6)
    weights = bradley_terry(*((x - mean) / scale for x in rows)) / scale
    model = Model(weights, -float(mean @ weights))
    known = train.select("id", "held_out", "f").mapInArrow(_scored(model), "doc_id long, held_out boolean, score double").withColumnRenamed("doc_id", "id").join(marks, "id")
    share = train.agg(F.avg(1 - F.col("quality"))).first()[0]
    cut = known.agg(F.percentile_approx("score", F.lit(float(share)), F.lit(10_000))).first()[0]
    cut = min(max(cut, 1e-300), 1 - 1e-16)
    return Model(weights, model.offset - float(np.log(cut / (1 - cut)) - np.log(CUT / (1 - CUT))))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; ``held_out`` is a condition on a column id.

    ``labels`` has doc_id and quality (1 good, 0 bad, others and null ignored; of several labels of an id the lowest
    counts); only rows where ``held_out`` is false are learnt from. Scores come from the text alone. Null, empty and
    white-space texts are scored by features that are 0 but for a mark of emptiness. Repeated rows and null ids are
    kept, the latter unlabelled. Without a label of either kind nothing is known against a text: scores are 1. Other
    columns are ignored; an empty table gives no rows.
    """
    feats = _text_features(docs, held_out, id_col, text_col)
    scored = feats.select("id", "held_out", "f").mapInArrow(_scored(fit(feats, labels, sample)), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all their columns unchanged, that quality_scores() predicts to be good. Each row is
    judged where it is read: nothing is joined to the texts."""
    model = fit(_text_features(docs, held_out, id_col, text_col), labels, sample)
    return docs.mapInArrow(_accepted(model, docs.columns.index(text_col)), docs.schema)
