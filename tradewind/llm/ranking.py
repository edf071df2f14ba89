"""Document quality by pairwise ranking (Bradley-Terry).

Scores are learned from preferences alone: a document labelled good is preferred to one labelled bad, and the
probability of that preference is the logistic function of the difference of their scores, which are linear in the
features. The cut is a quantile of the training scores, the share of bad documents among them, and comes out as ``CUT``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import map_texts
from tradewind.llm.quality_rules import Traits, traits

CUT = 0.7
#: labelled rows that the fit uses at most, those with the smallest hash of the doc_id; about 5 MB of features
TRAIN_ROWS = 20_000
#: preference pairs drawn for each of them
PAIRS = 8
#: a score is one of this many labels: crc32 of the doc_id modulo FOLDS; HELD_OUT is never learned from
FOLDS, HELD_OUT = 4, 2


def features(text: str | None) -> np.ndarray:
    """What a score may depend on: shares of the whole text, and steps in them."""
    t: Traits = traits(text)
    n, lines, letters = max(t.n_words, 1), max(t.n_lines, 1), max(t.letters, 1)
    text = text or ""
    shares = np.array([t.n_symbols / n, t.n_shouts / n, t.capitals / letters, t.n_dup_lines / lines, t.n_repeat_words / n,
                       t.n_marks / n, t.n_stop / n, t.n_distinct / n])
    length = t.word_chars / n
    size = np.log1p(t.n_words)
    steps = [t.n_symbols > 0.2 * n, t.n_symbols > 0.02 * n, t.n_shouts > 0.25 * n, t.capitals > 0.3 * letters,
             t.n_repeat_words > 0.2 * n, t.n_repeat_words > 0.03 * n, t.n_dup_lines > 0.3 * lines, t.n_stop < 0.01 * n, t.n_stop < 0.05 * n,
             t.n_distinct < 0.3 * n, t.n_distinct < 0.15 * n, t.n_words < 10, t.n_words < 20,
             t.n_marks < 0.02 * n, length > 8, length < 3.5]
    return np.array([*np.minimum(shares, 3), *np.sqrt(np.minimum(shares, 3)), length if length < 20 else 20, abs(length - 5) if length < 20 else 15,
                     size, shares[7] * size, *steps], float)


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1 for rows of features; ``CUT`` at the cut."""
        # each row is summed for itself: a product with the whole batch rounds a row by its place in it
        raw = ((x - self.mean) / self.scale * self.weights).sum(1) - self.cut
        return 1 / (1 + np.exp(-np.clip(raw + np.log(CUT / (1 - CUT)), -30, 30)))


def learn(x: np.ndarray, good: np.ndarray, rounds: int = 30, ridge: float = 3.0) -> Ranking | None:
    """Newton steps on the logistic loss of feature differences; None if one label is missing."""
    if good.all() or not good.any():
        return None
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    draw = np.random.default_rng(9)
    many = PAIRS * len(x)
    d = z[up[draw.integers(0, len(up), many)]] - z[down[draw.integers(0, len(down), many)]]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # of the preference being the other way round
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w)), d.T @ p - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Ranking(mean, scale, w, float(np.quantile(z @ w, (~good).mean())))


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Ranking | None:
    """Learn from at most ``rows`` labelled documents outside the held-out fold."""
    chosen = (labels.select("doc_id", "quality").where("doc_id is not null and quality is not null")
              .where(~held_out(F.col("doc_id"))).distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows).withColumnRenamed("doc_id", "_labelled"))
    # the limit bounds what is broadcast
    texts = (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled"))
             .select("_labelled", "quality", F.coalesce("text", F.lit("")).alias("text")).withColumn("_hash", F.xxhash64("text")))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("_labelled", "quality", "_hash")),
             pa.array([features(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))],
            ["_labelled", "quality", "_hash", "x"])

    kind = labels.schema["quality"].dataType.simpleString()
    found = map_texts(texts, "text", f"_labelled {chosen.schema['_labelled'].dataType.simpleString()}, quality {kind}, _hash long, x array<double>", work)
    # rows may repeat a doc_id; the text with the smallest hash stands for it, so that the limit holds for what is collected
    got = found.groupBy("_labelled", "quality").agg(F.min_by("x", "_hash").alias("x")).select("quality", "x").toArrow()
    if not got.num_rows:
        return None
    x = np.array(got.column("x").to_pylist())
    good = got.column("quality").to_numpy() >= 1
    order = np.lexsort((*x.T, good))  # the same model whatever the order in which rows arrive
    return learn(x[order], good[order])


def rank(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs`` (doc_id, text), from ``labels`` (doc_id, quality).

    Null and empty texts are scored as texts without words; repeated rows get equal scores; a row without doc_id
    is in no fold (held_out false). Without labels of both kinds all scores are 0.5 and predicted is 0. Other columns,
    such as lang, source or labels, are never read.
    """
    model = fit(docs, labels, rows)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([features(t) for t in batch.column("text").to_pylist()])
        score = model.score(x) if model else np.full(len(x), 0.5)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()),
                                           pa.array((score >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_texts(docs.select("doc_id", "text"), "text", f"doc_id {kind}, score double, predicted int", work)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
