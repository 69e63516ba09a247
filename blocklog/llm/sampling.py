"""Bounded samples of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklog.llm.text import remainder


def labelled_sample(
    labels: DataFrame, label_col: str, rows: int, *, id_col: str = "doc_id", held_out: tuple[int, int] | None = (5, 0)
) -> DataFrame:
    """(doc_id, label) of about `rows` rows at most, as many of each label as there are, by a hash of the id.

    `held_out` (parts, rest) leaves out ids whose crc32 has that remainder. Rows with a null id or label are left
    out; of an id with several labels the smallest counts. The bound is exact: a limit that a sample of the
    expected size does not reach stands behind the hash filter.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).dropna()
    if held_out:
        known = known.where(remainder(F.col("doc_id"), held_out[0]) != held_out[1])
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = rows // max(1, len(counts))
    spread = F.xxhash64("doc_id").bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
    chosen = F.lit(False)
    for label, n in sorted(counts.items()):
        fraction = 1.0 if n <= share else 0.95 * share / n
        chosen = chosen | ((F.col("label") == F.lit(label)) & (spread <= F.lit(min(int(fraction * 2**63), 2**63 - 1))))
    return known.where(chosen).limit(rows)
