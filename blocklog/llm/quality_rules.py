"""Quality rules: document statistics, fixed base rules and boosted trees over the statistics (operator 7)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklog.llm.boosting import Trees, fit
from blocklog.llm.sampling import labelled_sample

_SPACE = b"\t\n\x0b\x0c\r "
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_DIGITS = b"0123456789"
_STOPS = b".,;:"
_SHOUT = b"!?"

#: Column of the trees -> how the verdict may move with it.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 1,
    "top_word_share": -1,
    "upper_share": -1,
    "digit_share": 0,
    "shout_per_word": -1,
    "stops_per_word": 0,
    "words_per_line": 0,
    "longest_word": 0,
    "other_share": 0,
}
#: Labelled rows that the trees are fitted on, at most.
SAMPLE_ROWS = 8000
#: The verdict keeps documents whose probability of label 1 is at least this.
THRESHOLD = 0.5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


def repeat_words(tokens: list[bytes]) -> int:
    """Words that lie in a window of three words which occurs twice or more."""
    windows = list(zip(tokens, tokens[1:], tokens[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total, covered = 0, 0  # words before `covered` are counted
    for k, window in enumerate(windows):
        if times[window] > 1:
            total += k + 3 - max(k, covered)
            covered = k + 3
    return total


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base columns, and the values of FEATURES, of one whole text; null counts as empty."""
    text = text or ""
    data = text.encode()
    tokens = data.split()
    n = len(tokens)
    lines = [line for line in data.split(b"\n") if line.strip()]
    chars = len(text) - _count(data, _SPACE)
    base = (n, chars, _count(data, _SYMBOLS), len(lines) - len(set(lines)), repeat_words(tokens))
    times = Counter(tokens)
    per_word, per_byte = 1 / max(n, 1), 1 / max(len(data), 1)
    upper, lower, digits, stops, shout = (_count(data, x) for x in (_UPPER, _LOWER, _DIGITS, _STOPS, _SHOUT))
    other = len(data) - upper - lower - digits - stops - shout - _count(data, _SPACE)
    features = (
        np.log1p(n), chars * per_word, base[2] * per_word, base[3] / max(len(lines), 1), base[4] * per_word,
        len(times) / max(n, 1) ** 0.9, max(times.values(), default=0) * per_word, upper / max(upper + lower, 1), digits * per_byte,
        shout * per_word, stops * per_word, n / max(len(lines), 1), min(max(map(len, times), default=0), 1000), other * per_byte,
    )
    return base, features


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [list(map(float, statistics(t.as_py())[1])) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "x"])


def fit_rules(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> Trees:
    """Trees fitted on at most `rows` labelled documents whose crc32(id) modulo 5 is not 0.

    The ids are a bounded sample and are broadcast; the statistics of the whole texts come back, not the texts.
    """
    sample = labelled_sample(labels, label_col, rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id").select(F.col("doc_id").cast("bigint"), F.col("label").cast("double"), "text")
    got = sorted(joined.mapInArrow(_features, "doc_id bigint, label double, x array<double>").collect())
    x = np.array([r.x for r in got], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.label for r in got], float), np.array(list(FEATURES.values())))


def quality_rules(
    docs: DataFrame,
    model: Trees,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    repeat_percent: int = 50,
    threshold: float = THRESHOLD,
    keep_columns: bool = False,
) -> DataFrame:
    """Statistics and verdict of every document: one row per row of `docs`, or with `keep_columns` the kept rows as they are.

    `base_failed`: fewer than `min_words` words, or more than `repeat_percent` percent of them in repeated windows of
    three. `kept` is false for those, else the trees' verdict; `score` is the trees' probability.

    A null text has no words and fails; a null id stays null; repeated rows are judged each alike; an empty table gives
    no rows; other columns are not read (or, with `keep_columns`, passed through whatever their names).
    """
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", *BASE)] + [("score", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def judge(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = [statistics(t.as_py()) for t in texts]
        base = np.array([b for b, _ in got], np.int64).reshape(-1, len(BASE))
        score = model.probability(np.array([f for _, f in got], float).reshape(-1, len(FEATURES)))
        failed = (base[:, 0] < min_words) | (100 * base[:, 4] > repeat_percent * base[:, 0])
        return base, score, failed

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, score, failed = judge(batch.column(1))
            columns = [batch.column(0), *(pa.array(c) for c in base.T), pa.array(score), pa.array(failed), pa.array(~failed & (score >= threshold))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, score, failed = judge(batch.column(batch.schema.get_field_index(text_col)))
            yield batch.filter(pa.array(~failed & (score >= threshold)))

    if keep_columns:
        return docs.mapInArrow(kept, docs.schema)
    counts = ", ".join(f"{c} bigint" for c in BASE)
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(report, f"doc_id bigint, {counts}, score double, base_failed boolean, kept boolean")
