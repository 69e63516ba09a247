"""Language identification: family first, then one-versus-one linear SVMs within the family (operator 1).

Languages are put into families by the likeness of their mean features, about the square root of their number.
Linear SVMs tell each family from the others; within one, an SVM for each pair of its languages votes with its
margin. All of them are columns of one weight table, so a text is read once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklog.llm.features import Features, sample_features
from blocklog.llm.sampling import labelled_sample

#: Labelled documents that the SVMs are fitted on, at most.
SAMPLE_ROWS = 2000
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def letters(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased and ASCII that is no letter turned into spaces."""
    return text.encode().translate(_TABLE)


FEATURES = Features(orders=(2, 3, 4), bits=13, prepare=letters)


@dataclass
class Languages:
    families: list[list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray  # (buckets, families + pairs)
    bias: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        margins = FEATURES.dot([t or "" for t in texts], self.weights) + self.bias
        labels, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            if not text or not self.families or not _LETTER.search(text):
                labels.append(UNDETERMINED)
                continue
            of_family = margins[i, : len(self.families)]
            f = int(np.argmax(of_family))
            score = 1.0 if len(self.families) == 1 else float(_sigmoid(of_family[f] - np.max(np.delete(of_family, f))))
            votes = dict.fromkeys(self.families[f], 0.0)
            won = dict.fromkeys(self.families[f], 1.0)
            for k, (a, b) in enumerate(self.pairs):
                if a in votes:
                    p = float(_sigmoid(2 * margins[i, len(self.families) + k]))
                    votes[a], votes[b] = votes[a] + p, votes[b] + 1 - p
                    won[a], won[b] = min(won[a], p), min(won[b], 1 - p)
            best = max(sorted(votes), key=votes.get)
            labels.append(best)
            scores[i] = score * won[best]
        return labels, scores


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _svm(rows: list[tuple[np.ndarray, np.ndarray]], sides: np.ndarray, buckets: int, *, epochs: int = 12, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """A linear SVM by stochastic subgradients on rows of unit length; both sides weigh the same."""
    random = np.random.default_rng(5)
    weight, scale, bias, step = np.zeros(buckets), 1.0, 0.0, 0
    heavier = {s: len(sides) / (2 * max((sides == s).sum(), 1)) for s in (-1, 1)}
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            step += 1
            rate = 1 / (penalty * (step + 1000))
            place, value = rows[i]
            margin = sides[i] * (scale * (weight[place] @ value) + bias)
            scale *= 1 - rate * penalty
            if margin < 1:
                weight[place] += rate * heavier[sides[i]] * sides[i] * value / scale
                bias += 0.01 * heavier[sides[i]] * sides[i]
    return weight * scale, bias


def _families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages joined by the likeness of their means until about the square root of their number is left."""
    families = [[label] for label in sorted(means)]
    unit = {label: np.sqrt(m) / max(np.linalg.norm(np.sqrt(m)), 1e-12) for label, m in means.items()}

    def likeness(a: list[str], b: list[str]) -> float:
        return float(np.mean([unit[x] @ unit[y] for x in a for y in b]))

    while len(families) > max(1, round(len(means) ** 0.5)):
        i, j = max(combinations(range(len(families)), 2), key=lambda p: likeness(families[p[0]], families[p[1]]))
        families[i] = sorted(families[i] + families.pop(j))
    return families


def fit_languages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> Languages:
    """Fit on at most `rows` documents with a language whose crc32(id) modulo 5 is not 0."""
    sample = labelled_sample(docs, lang_col, rows, id_col=id_col)
    got = sample_features(docs, sample, FEATURES, id_col=id_col, text_col=text_col)
    got = [(label, p, v / (n := np.linalg.norm(v)), n) for label, p, v in got if len(p)]
    means: dict[str, np.ndarray] = {}
    for label, place, value, norm in got:
        means.setdefault(label, np.zeros(FEATURES.buckets))[place] += value * norm
    families = _families(means)
    length = float(np.mean([n for *_, n in got])) if got else 1.0
    columns, pairs = [], []

    def column(one: set[str], two: set[str]) -> None:
        chosen = [(p, v, 1 if label in one else -1) for label, p, v, _ in got if label in one or label in two]
        columns.append(_svm([(p, v) for p, v, _ in chosen], np.array([s for *_, s in chosen]), FEATURES.buckets))

    for family in families:
        column(set(family), set(means) - set(family))
    for family in families:
        for a, b in combinations(family, 2):
            pairs.append((a, b))
            column({a}, {b})
    # Texts are scored on means as they are; the usual length of a row takes the place of its own.
    weights = np.stack([w / length for w, _ in columns], 1) if columns else np.zeros((FEATURES.buckets, 0))
    return Languages(families, pairs, weights.astype(np.float32), np.array([b for _, b in columns]))


def identify_languages(docs: DataFrame, model: Languages, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for each row: the language of the whole text, and a confidence from 0 to 1.

    `und` and 0 for a null text or one without a letter, and when nothing could be learned; a null id stays null;
    repeated rows are judged alike; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, lang_pred string, score double")
