"""Hashed n-gram features of whole texts, in numpy, for linear scoring and for fitting.

Each group of features (an order of byte n-grams, words, pairs of words) has its own buckets and counts as the mean
over its occurrences in the text, so long texts and long groups do not outweigh others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklog.llm.text import BASE, Rolling, mix

#: Bytes of text that are handled together; a longer text is handled alone.
CHUNK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Features:
    """What to read off a text: byte n-grams of `orders`, and with `words` words, pairs of words and repeats."""

    orders: tuple[int, ...]
    bits: int  # of the buckets of one group
    words: bool = False
    prepare: Callable[[str], bytes] = str.encode

    @property
    def groups(self) -> int:
        return len(self.orders) + 2 * self.words

    @property
    def buckets(self) -> int:
        return self.groups << self.bits

    def _place(self, hashes: np.ndarray, group: int) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64) + (group << self.bits)

    def of(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each group: bucket of each occurrence, and where those of each text start and end."""
        data = [self.prepare(t) for t in texts]
        ends = np.cumsum([len(d) for d in data])
        starts = ends - [len(d) for d in data]
        symbols = np.frombuffer(b"".join(data), np.uint8)
        for group, n in enumerate(self.orders):
            packed = np.zeros(len(symbols), np.uint64)
            for k in range(min(n, len(symbols))):
                packed[: len(symbols) - k] |= symbols[k:].astype(np.uint64) << np.uint64(8 * k)
            yield self._place(packed * np.uint64(BASE), group), starts, np.maximum(starts, ends - n + 1)
        if self.words:
            yield from self._words(symbols, starts, ends)

    def _words(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        inside = ~_SPACE[symbols]
        before = np.concatenate([[False], inside[:-1]])
        before[starts[starts < len(symbols)]] = False
        after = np.concatenate([inside[1:], [False]])
        after[ends[ends > 0] - 1] = False
        first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        hashes = Rolling(symbols).of(first, last)
        low, high = np.searchsorted(first, starts), np.searchsorted(first, ends)
        group = len(self.orders)
        yield self._place(hashes, group), low, high
        pairs = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
        pairs[hashes[:-1] == hashes[1:]] = np.uint64(BASE)  # a word that follows itself, whatever the word
        low = np.minimum(low, len(pairs))
        yield self._place(pairs, group + 1), low, np.maximum(low, high - 1)

    def chunks(self, texts: list[str]) -> Iterator[tuple[int, int]]:
        at, size = 0, 0
        for k, text in enumerate(texts):
            if k > at and size + len(text) > CHUNK:
                yield at, k
                at, size = k, 0
            size += len(text)
        if texts:
            yield at, len(texts)

    def dot(self, texts: list[str], weights: np.ndarray) -> np.ndarray:
        """Rows of feature means times `weights` (buckets, columns)."""
        out = np.zeros((len(texts), weights.shape[1]))
        columns = [np.ascontiguousarray(c) for c in weights.T]
        for a, b in self.chunks(texts):
            for place, start, end in self.of(texts[a:b]):
                size = np.maximum(end - start, 1)
                for k, column in enumerate(columns):
                    sums = np.concatenate([[0.0], np.cumsum(column[place], dtype=np.float64)])
                    out[a:b, k] += (sums[end] - sums[start]) / size
        return out / self.groups

    def sparse(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and values of one text."""
        places, values = [], []
        for place, start, end in self.of([text]):
            bucket, times = np.unique(place[start[0] : end[0]], return_counts=True)
            places.append(bucket)
            values.append(times / (max(end[0] - start[0], 1) * self.groups))
        return np.concatenate(places), np.concatenate(values)


def sample_features(docs: DataFrame, sample: DataFrame, features: Features, *, id_col: str, text_col: str) -> list[tuple[object, np.ndarray, np.ndarray]]:
    """(label, buckets, values) of the sampled documents, in the order of a hash of their ids.

    The sample is bounded, so its ids are broadcast and its features, of bounded size each, come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features.sparse(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([g[0].astype("<u4").tobytes() for g in got], pa.binary()), pa.array([g[1].astype("<f4").tobytes() for g in got], pa.binary())],
                ["o", "label", "buckets", "values"],
            )

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chosen = texts.join(F.broadcast(sample), "doc_id").select(F.xxhash64("doc_id").alias("o"), F.col("label").cast("string").alias("label"), "text")
    rows = chosen.mapInArrow(run, "o bigint, label string, buckets binary, values binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["o"], r["label"], r["buckets"]))
    return [(r["label"], np.frombuffer(r["buckets"], "<u4").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(float)) for r in rows]
