"""Scoring with a log-bilinear model trained by noise-contrastive estimation (operator 9).

Counts of all words of the training documents are gathered by Spark. The most frequent words are the classes of
the neural model, together with one class for all others; within that class a word has its share of the counts
less a discount, and what the discounts leave is the share of words not seen. So the probabilities of a token
sum to one over the vocabulary and one unseen word.

The model adds the vectors of the two preceding classes, each scaled by a vector for its position, and scores a
class by the product with its own vector. Each task trains on all of its own tokens from a common start; the
parameters are averaged by tokens, in steps of bounded fan-in. As contexts are pairs of classes, one batched
matrix product gives the normaliser of every context there can be.

Scoring splits the tokens: words among the `heavy` most frequent are looked up where the text is read, so no
frequent word crosses the network; the others are joined with the counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklog.llm.text import held_out, lower_words, remainder
from blocklog.session import Staging

#: Words with a class of their own in the neural model.
CLASSES = 511
#: Length of the word vectors.
WIDTH = 16
#: Words that are looked up in the tasks, each of LONGEST bytes at most: the size of what is broadcast is bounded.
HEAVY = 300_000
LONGEST = 64
NOISE = 32
RATE = 0.1
MINIBATCH = 4096
#: The token after the last word; no word is empty.
END = b""
#: Different words that a task counts before it passes the counts on.
COUNTED = 400_000
FAN_IN = 16


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        got = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])
        counts.clear()
        return got

    for batch in batches:
        for text in batch.column(0):
            counts.update(lower_words(text.as_py()))
            if len(counts) > COUNTED:
                yield flush()
        counts[END] += batch.num_rows
    yield flush()


@dataclass
class Model:
    """Parameters; classes 0..k-1 are words, k stands for all others, k + 1 (contexts only) for the text's start."""

    context: np.ndarray  # (k + 2, width)
    position: np.ndarray  # (2, width)
    target: np.ndarray  # (k + 1, width)
    bias: np.ndarray  # (k + 1)

    @classmethod
    def start(cls, shares: np.ndarray, width: int = WIDTH) -> Model:
        random = np.random.default_rng(7)
        k = len(shares) - 1
        return cls(random.normal(0, 0.1, (k + 2, width)), np.ones((2, width)), random.normal(0, 0.1, (k + 1, width)), np.log(shares))

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.position, self.target, self.bias]

    def pack(self) -> bytes:
        return np.concatenate([a.ravel() for a in self.arrays()]).astype(np.float32).tobytes()

    def unpack(self, flat: np.ndarray) -> Model:
        ends = np.cumsum([a.size for a in self.arrays()])
        return Model(*[p.reshape(a.shape).astype(float) for p, a in zip(np.split(flat, ends[:-1]), self.arrays(), strict=True)])

    def predict(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.position[0] * self.context[before] + self.position[1] * self.context[last]

    def normalisers(self, block: int = 16384) -> np.ndarray:
        """Natural log of the sum over classes, for context number before * (k + 2) + last."""
        k2 = len(self.context)
        out = np.empty(k2 * k2)
        for at in range(0, k2 * k2, block):
            c = np.arange(at, min(at + block, k2 * k2))
            s = (self.predict(c // k2, c % k2) @ self.target.T + self.bias).astype(np.float32)
            top = s.max(1)
            out[c] = top + np.log(np.exp(s - top[:, None]).sum(1))
        return out


def _add_rows(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    return np.stack([np.bincount(index, column, rows) for column in values.T], 1)


class _Trainer:
    """Stochastic gradient steps (scaled by past gradients) on the noise-contrastive loss."""

    def __init__(self, model: Model, shares: np.ndarray):
        self.model, self.random = model, np.random.default_rng(11)
        self.log_noise = np.log(NOISE * shares)
        self.cumulative = np.cumsum(shares)
        self.past = [np.full(a.shape, 1e-2) for a in model.arrays()]

    def learn(self, before: np.ndarray, last: np.ndarray, word: np.ndarray) -> None:
        k1, k2 = len(self.model.bias), len(self.model.context)
        number, times = np.unique((before * k2 + last) * k1 + word, return_counts=True)
        order = self.random.permutation(len(number))
        for at in range(0, len(order), MINIBATCH):
            part = order[at : at + MINIBATCH]
            self._step(number[part] // k1 // k2, number[part] // k1 % k2, number[part] % k1, times[part].astype(float))

    def _step(self, before, last, word, weight) -> None:
        m = self.model
        vector = m.predict(before, last)
        noise = np.minimum(np.searchsorted(self.cumulative, self.random.random(NOISE)), len(m.bias) - 1)
        own = 1 / (1 + np.exp((vector * m.target[word]).sum(1) + m.bias[word] - self.log_noise[word]))
        other = -1 / (1 + np.exp(self.log_noise[noise] - vector @ m.target[noise].T - m.bias[noise]))
        own, other = own * weight, other * weight[:, None]
        to_vector = own[:, None] * m.target[word] + other @ m.target[noise]
        rows, contexts = len(m.bias), len(m.context)
        gradients = [
            _add_rows(before, to_vector * m.position[0], contexts) + _add_rows(last, to_vector * m.position[1], contexts),
            np.stack([(to_vector * m.context[before]).sum(0), (to_vector * m.context[last]).sum(0)]),
            _add_rows(word, own[:, None] * vector, rows) + _add_rows(noise, other.T @ vector, rows),
            np.bincount(word, own, rows) + np.bincount(noise, other.sum(0), rows),
        ]
        for array, past, g in zip(m.arrays(), self.past, gradients, strict=True):
            g /= weight.sum()
            past += g * g
            array += RATE * g / np.sqrt(past)


def _classes(tokens: list[bytes], number: dict[bytes, int], other: int) -> np.ndarray:
    return np.fromiter(map(number.get, tokens, repeat(other)), np.int64, len(tokens))


def _contexts(classes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    start = np.full(2, k + 1)
    shifted = np.concatenate([start, classes])
    return shifted[: len(classes)], shifted[1 : len(classes) + 1]


def _train_batches(number: dict[bytes, int], shares: np.ndarray, gathered: int = 1_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = _Trainer(Model.start(shares), shares)
        k, tokens = len(shares) - 1, 0
        held: list[np.ndarray] = []
        size = 0

        def learn() -> None:
            pairs = [_contexts(c, k) for c in held]
            trainer.learn(np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]), np.concatenate(held))
            held.clear()

        for batch in batches:
            for text in batch.column(0):
                held.append(_classes([*lower_words(text.as_py()), END], number, k))
                size += len(held[-1])
                if size >= gathered:
                    learn()
                    tokens, size = tokens + size, 0
        if held:
            learn()
        tokens += size
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([float(tokens)]), pa.array([trainer.model.pack()], pa.binary())], ["part", "weight", "params"]
            )

    return run


def _average(parts: pd.DataFrame) -> pd.DataFrame:
    weight = parts["weight"].sum()
    total = sum(w * np.frombuffer(p, np.float32).astype(float) for w, p in zip(parts["weight"], parts["params"], strict=True))
    return pd.DataFrame({"part": [parts["part"].min() // FAN_IN], "weight": [weight], "params": [(total / weight).astype(np.float32).tobytes()]})


def _most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words that occur at least so often that `most` of them are not exceeded, most frequent first.

    A histogram of bounded size (eighths of powers of two) gives the count; only the words above it are read.
    """
    known = counts.where(F.length("word") <= LONGEST)
    bin_of = F.floor(F.log2("c") * 8).cast("int")
    sizes = {r.bin: r["count"] for r in known.select(bin_of.alias("bin")).groupBy("bin").count().collect()}
    total, least = 0, None
    for b in sorted(sizes, reverse=True):
        total += sizes[b]
        if total > most:
            break
        least = b
    if least is None:
        return []
    got = known.where(bin_of >= least).select("word", "c").toArrow()
    return sorted(zip(got.column("word").to_pylist(), got.column("c").to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))


@dataclass
class Fitted:
    counts: DataFrame  # word binary, c bigint
    heavy: list[tuple[bytes, int]]  # most frequent first; the first are the model's classes
    classes: int
    tokens: int
    words: int
    discount: float
    model: Model

    def others(self) -> tuple[int, int]:
        """Tokens and different words outside the classes."""
        return self.tokens - sum(c for _, c in self.heavy[: self.classes]), self.words - self.classes


def fit(docs: DataFrame, stage: Staging, *, classes: int = CLASSES, heavy: int = HEAVY) -> Fitted:
    """Counts and neural model of all tokens of `docs` (one column, text)."""
    counts = stage.table(docs.mapInArrow(_count_batches, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c")).where("c > 0"), "counts")
    total = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice")
    ).first()
    discount = min(max(total.once / max(total.once + 2 * total.twice, 1), 0.1), 0.9)
    top = _most_frequent(counts, heavy)
    k = min(classes, len(top))
    inside = np.array([c for _, c in top[:k]] + [max(total.n - sum(c for _, c in top[:k]), 0) + 1], float)
    shares = inside / inside.sum()
    number = {w: i for i, (w, _) in enumerate(top[:k])}
    schema = "part bigint, weight double, params binary"
    parts = stage.table(docs.mapInArrow(_train_batches(number, shares), schema), "parameters")
    while (n := parts.count()) > FAN_IN:
        parts = stage.table(parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("g")).applyInPandas(_average, schema), f"averages-{n}")
    start = Model.start(shares)
    last = pd.DataFrame([r.asDict() for r in parts.orderBy("part").collect()])
    model = start.unpack(np.frombuffer(_average(last)["params"][0], np.float32)) if len(last) else start
    return Fitted(counts, top, k, total.n, total.v, discount, model)


def _score_batches(fitted_heavy: list[tuple[bytes, int]], k: int, discount: float, model: Model):
    number = {w: i for i, (w, _) in enumerate(fitted_heavy)}
    counts = np.array([c for _, c in fitted_heavy], float)
    log_counts = np.append(np.log10(counts + 1), 0.0)
    log_discounted = np.append(np.log10(counts - discount), 0.0)
    normalisers = model.normalisers()
    fields = [("k", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("others", pa.int64()), ("base", pa.float64()), ("neural", pa.float64()), ("rare", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        contexts = len(model.context)
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = [*lower_words(text.as_py()), END]
                ids = _classes(tokens, number, len(fitted_heavy))
                c = np.minimum(ids, k)
                before, last = _contexts(c, k)
                logs = (model.predict(before, last) * model.target[c]).sum(1) + model.bias[c] - normalisers[before * contexts + last]
                unknown = np.flatnonzero(ids == len(fitted_heavy))
                rare = Counter(map(tokens.__getitem__, unknown.tolist()))
                inside = c == k
                row = (
                    key, doc_id, held_out(doc_id, 7, 2), len(tokens), len(tokens) - len(unknown), int(inside.sum()),
                    float(log_counts[ids].sum()), float(logs.sum()) / np.log(10) + float(log_discounted[ids[inside]].sum()), [{"word": w, "n": n} for w, n in rare.items()],
                )
                key += 1
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return run


_SCORES = "k bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, others bigint, base double, neural double, rare array<struct<word: binary, n: bigint>>"


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, heavy: int = HEAVY) -> DataFrame:
    """One row per row of `docs`: tokens, known tokens, training tokens, smoothed unigram and model log10 probability.

    The model learns from rows whose crc32(id) modulo 7 is not 2. A null text counts as empty (one token, the end);
    a null id is taken as empty text for the hold-out and stays null; repeated rows count and are scored once each;
    an empty table gives no rows; other columns are not read.
    """
    stage = Staging(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fitted = fit(texts.where(remainder(F.col("doc_id"), 7) != 2).select("text"), stage, classes=classes, heavy=heavy)
    run = _score_batches(fitted.heavy, fitted.classes, fitted.discount, fitted.model)
    scored = stage.table(texts.mapInArrow(run, _SCORES), "scored")
    found = (
        scored.select("k", F.inline("rare"))
        .join(fitted.counts, "word")
        .groupBy("k")
        .agg(
            F.sum("n").alias("rare_known"),
            F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_logs"),
            F.sum(F.col("n") * F.log10(F.col("c") - F.lit(fitted.discount))).alias("rare_discounted"),
        )
    )
    tokens, words = fitted.others()
    known_share = float(np.log10(max(tokens, 1)))
    unseen_share = float(np.log10(fitted.discount * words / tokens)) if words > 0 else 0.0
    all_tokens = float(np.log10(fitted.tokens + fitted.words + 1))
    known = F.col("known") + F.coalesce("rare_known", F.lit(0))
    unseen = F.col("n_tokens") - known
    return scored.drop("rare").join(found, "k", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        known.alias("n_known"),
        F.lit(fitted.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * all_tokens).alias("base_score"),
        (F.col("neural") + F.coalesce("rare_discounted", F.lit(0.0)) - (F.col("others") - unseen) * known_share + unseen * unseen_share).alias("score"),
    )
