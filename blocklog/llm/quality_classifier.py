"""Quality classifier: supervised subword embeddings, averaged per document, with a softmax output (operator 8).

Vectors of hashed words, pairs of words and byte n-grams are learned together with the output layer by stochastic
gradient descent in numpy. As the output is linear in the averaged vectors, each bucket is worth one number when
documents are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklog.llm.features import Features, sample_features
from blocklog.llm.sampling import labelled_sample
from blocklog.llm.text import remainder

#: Labelled documents that the vectors are fitted on, at most.
SAMPLE_ROWS = 2400
FEATURES = Features(orders=(3, 4, 5), bits=13, words=True)
WIDTH = 8
THRESHOLD = 0.3


@dataclass
class Classifier:
    vectors: np.ndarray  # (buckets, width)
    output: np.ndarray  # (width, 2)
    bias: np.ndarray  # (2)

    def score(self, texts: list[str | None]) -> np.ndarray:
        value = (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32)[:, None]
        margin = FEATURES.dot([t or "" for t in texts], value)[:, 0] + self.bias[1] - self.bias[0]
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def _train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, epochs: int = 15, rate: float = 40.0) -> Classifier:
    """Stochastic gradient descent; the rate falls to zero in a line."""
    random = np.random.default_rng(3)
    vectors = random.normal(0, 0.1, (FEATURES.buckets, WIDTH))
    output, bias = random.normal(0, 0.1, (WIDTH, 2)), np.zeros(2)
    total, step = max(epochs * len(rows), 1), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            now = 1 - step / total
            step += 1
            place, value = rows[i]
            hidden = value @ vectors[place]
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max())
            error = -p / p.sum()
            error[labels[i]] += 1
            back = output @ error
            output += 0.5 * now * np.outer(hidden, error)
            bias += 0.05 * now * error
            vectors[place] += rate * now * value[:, None] * back
    return Classifier(vectors, output, bias)


def fit_quality(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> Classifier:
    """Fit on at most `rows` labelled documents whose crc32(id) modulo 5 is not 0, as many of each label as there are.

    The bias is then moved to the share of label 1 among all labelled documents outside the held-out fold.
    """
    known = labels.where((remainder(F.col("doc_id"), 5) != 0) & F.col(label_col).isNotNull())
    share = known.agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    got = sample_features(docs, labelled_sample(labels, label_col, rows), FEATURES, id_col=id_col, text_col=text_col)
    marks = np.array([int(float(label)) for label, *_ in got], int)
    model = _train([(p, v) for _, p, v in got], marks)
    if len(marks) and 0 < marks.mean() < 1 and share is not None and 0 < share < 1:
        model.bias[1] += np.log(share / (1 - share)) - np.log(marks.mean() / (1 - marks.mean()))
    return model


def score_quality(docs: DataFrame, model: Classifier, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for each row: probability of label 1 for the whole text, and 1 from `threshold` on.

    A null text counts as empty and gets the score of no features; a null id stays null; repeated rows are scored
    alike; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, score double, predicted int")
