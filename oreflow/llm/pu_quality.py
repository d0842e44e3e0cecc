"""A quality classifier learned from trusted positives and unlabelled text.

Training minimises the non-negative risk of positive-unlabelled learning: with class prior p,
p * loss(positives as 1) + max(0, loss(unlabelled as 0) - p * loss(positives as 0)).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import column, fresh, slices
from oreflow.session import written

# Rows of each kind that the model is fitted on at most; everything else covers all rows.
FITTED_ROWS = 3000
THRESHOLD = 0.3

# Classes of bytes: lower case, upper case, digit, blank, line end, bytes above 127, other controls,
# and each punctuation mark or symbol by itself.
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = 7 + len(PUNCTUATION)
# Besides the pairs of classes: shares of words by length, of words that repeat an earlier one or the one
# before, and of repeated lines.
LENGTHS = 16
FEATURES = CLASSES * CLASSES + LENGTHS + 3
TEXT_AT_ONCE = 1 << 18
ROWS_AT_ONCE = 512


def class_table() -> np.ndarray:
    table = np.full(256, 6, np.uint16)
    table[128:] = 5
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[ord(" ")] = 3
    table[ord("\n")] = 4
    for i, mark in enumerate(PUNCTUATION):
        table[mark] = 7 + i
    return table


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text, each group of shares under a square root; an empty text has zeros only."""
    table = class_table()
    out = np.zeros((len(texts), FEATURES), np.float32)
    pairs = CLASSES * CLASSES
    for i, text in enumerate(texts):
        if not text:
            continue
        counts = np.zeros(pairs, np.int64)
        for at in range(0, len(text), TEXT_AT_ONCE):
            # A byte before the cut joins the next piece, so that no pair is missed.
            codes = table[np.frombuffer(text, np.uint8, min(TEXT_AT_ONCE + 1, len(text) - at), at)]
            counts += np.bincount(codes[:-1] * CLASSES + codes[1:], minlength=pairs)
        out[i, :pairs] = counts / max(1, len(text) - 1)
        words = text.split()
        if words:
            lengths = np.minimum(np.fromiter(map(len, words), np.int64, len(words)), LENGTHS) - 1
            out[i, pairs : pairs + LENGTHS] = np.bincount(lengths, minlength=LENGTHS) / len(words)
            out[i, -3] = 1 - len(set(words)) / len(words)
            out[i, -2] = sum(map(eq, words, words[1:])) / len(words)
        lines = text.split(b"\n")
        out[i, -1] = 1 - len(set(lines)) / len(lines)
    return np.sqrt(out)


@dataclass
class Model:
    """A linear score over features set to mean 0 and deviation 1."""

    mean: list[float]
    scale: list[float]
    weights: list[float]
    bias: float
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        z = (rows - np.array(self.mean)) / np.array(self.scale) @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def to_json(self) -> str:
        return json.dumps(asdict(self))


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int, ridge: float):
    """Adam on the non-negative risk; without a prior, plain logistic regression of positive against unlabelled."""
    # Single precision throughout, or every step would copy the rows.
    weights, bias = np.zeros(positive.shape[1], np.float32), np.float32(0)
    first, second = np.zeros(len(weights) + 1, np.float32), np.zeros(len(weights) + 1, np.float32)
    for step in range(1, steps + 1):
        zp, zu = positive @ weights + bias, unlabelled @ weights + bias
        sp, su = 1 / (1 + np.exp(-np.clip(zp, -30, 30))), 1 / (1 + np.exp(-np.clip(zu, -30, 30)))
        # Derivatives by z of the logistic loss: s - 1 for label 1, s for label 0.
        if prior is None:
            gp, gu = (sp - 1) / len(sp), su / len(su)
        else:
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative >= 0:
                gp, gu = prior * (sp - 1 - sp) / len(sp), su / len(su)
            else:
                # The estimate of the negatives' loss has gone below zero: step back out of it.
                gp, gu = prior * sp / len(sp), -su / len(su)
        gp, gu = gp.astype(np.float32), gu.astype(np.float32)
        gradient = np.append(gp @ positive + gu @ unlabelled + np.float32(ridge) * weights, gp.sum() + gu.sum())
        first = np.float32(0.9) * first + np.float32(0.1) * gradient
        second = np.float32(0.999) * second + np.float32(0.001) * gradient**2
        move = (0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, bias


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.05) -> float:
    """Share of positives among the unlabelled, from scores of both that were not fitted on.

    Whatever set of texts one takes, the unlabelled hold at least p times the positives' share of it; the top
    scores hold few else, so the least ratio over all score thresholds estimates p.  Thresholds with few
    positives above them are left to a margin for chance.
    """
    edges = np.sort(positive)
    above_p = 1 - np.arange(len(edges)) / len(edges)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), edges, side="left") / max(1, len(unlabelled))
    margin = np.sqrt(np.log(40) / 2 * (1 / len(positive) + 1 / max(1, len(unlabelled))))
    keep = above_p > margin
    best = np.argmin((above_u[keep] + margin) / (above_p[keep] - margin)) if keep.any() else None
    return 1.0 if best is None else float(np.clip(above_u[keep][best] / above_p[keep][best], least, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 250, ridge: float = 1e-3) -> Model:
    """Fit on rows of features; half of them choose the prior, all of them the model."""
    if not len(positive) or not len(unlabelled):
        return Model([0.0] * FEATURES, [1.0] * FEATURES, [0.0] * FEATURES, 0.0, 0.5)
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), np.float32(1e-3))
    both = (both - mean) / scale
    positive, unlabelled = both[: len(positive)], both[len(positive) :]
    weights, bias = _descend(positive[::2], unlabelled[::2], None, steps, ridge)
    held = [rows[1::2] if len(rows) > 1 else rows for rows in (positive, unlabelled)]
    prior = class_prior(*(rows @ weights + bias for rows in held))
    weights, bias = _descend(positive, unlabelled, prior, steps, ridge)
    return Model(mean.tolist(), scale.tolist(), weights.tolist(), float(bias), prior)


def _to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch, "text"):
            for at in range(0, len(texts), ROWS_AT_ONCE):
                rows = [row.tobytes() for row in features(texts[at : at + ROWS_AT_ONCE])]
                kinds = part.column(0).slice(at, len(rows))
                yield pa.RecordBatch.from_arrays([kinds, pa.array(rows, pa.binary())], names=["kind", "row"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    rows: int = FITTED_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> Model:
    """Fit on at most ``rows`` texts labelled 1 and ``rows`` texts taken without a look at labels.

    Both samples are the rows with the least hash of (id, text) among the labelled, or all.  ``learn_from`` is a
    condition on the id that a label must meet to be used.  Without positives the model scores 0.5 throughout.
    """
    known = (
        labels.select(column(id_column).cast("long").alias("id"), column(label_column).alias("label"))
        .where(F.col("label") == 1)
        .where(F.col("id").isNotNull())
        .withColumn("ok", learn_from)
        .where("ok")
        .select("id")
        .distinct()
    )
    texts = docs.select(column(id_column).cast("long").alias("id"), column(text_column).cast("string").alias("text"))
    ranked = lambda df: df.orderBy(F.xxhash64(F.lit(11), *df.columns), *df.columns).limit(rows)
    # Bounded lists of ids, so a broadcast is safe; a second limit bounds rows that share an id.
    positives = F.broadcast(written(ranked(known)))
    taken = F.broadcast(written(ranked(texts.select("id").where("id IS NOT NULL"))).distinct())
    pick = lambda ids, kind: texts.join(ids, "id", "left_semi").select(
        F.lit(kind).alias("kind"), "text"
    )
    chosen = pick(positives, 1).unionByName(pick(taken, 0))
    made = written(chosen.mapInArrow(_to_features, "kind int, row binary"))

    def sample(kind: int) -> np.ndarray:
        held = made.where(F.col("kind") == kind).select("row").orderBy(F.xxhash64("row"), "row").limit(rows).collect()
        return np.frombuffer(b"".join(r.row for r in held), np.float32).reshape(-1, FEATURES)

    return fit(sample(1), sample(0))


def scored(docs: DataFrame, model: Model, score: str, text_column: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``score`` in 0 to 1; a null text is scored as an empty one."""
    packed = json.loads(model.to_json())

    @F.pandas_udf("double")
    def score_of(texts):
        import pandas as pd

        model = Model(**packed)
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], names=["text"])
        parts = [
            model.scores(features(held[at : at + ROWS_AT_ONCE]))
            for _, held in slices(batch, "text")
            for at in range(0, len(held), ROWS_AT_ONCE)
        ]
        return pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return docs.withColumn(score, score_of(column(text_column).cast("string")))


def held_out(id_column: Column) -> Column:
    """Whether a row is kept away from training: crc32 of its id as text leaves remainder 0 by 5."""
    return F.coalesce(F.crc32(F.encode(id_column.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = FITTED_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    Labels of held-out ids are not learned from; the score is a function of the text alone.  A null text counts
    as empty, and an empty one is scored like any other; a null id is not held out; rows of one id are scored
    one by one; an empty table gives an empty result; other columns are not read.
    """
    model = train(docs, labels, ~held_out(F.col("id")), rows, id_column, text_column)
    rows_ = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).alias("text"))
    return scored(rows_, model, "score").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    model = train(docs, labels, ~held_out(F.col("id")), FITTED_ROWS, id_column, text_column)
    (score,) = fresh(docs, "score")
    return scored(docs, model, score, text_column).where(F.col(score) >= threshold).drop(score)
