"""N-gram Jaccard self-join with adaptive multi-match prefixes (operator 6).

Documents with equal shingle sets are one class from the start. Shingles have one global order: first those that
few documents have, in the order of their hash, then those of unknown frequency, then frequent ones. A class
with n shingles must share a shingle with each partner within its first n - ceil(t n) + 1, and l of them within
l - 1 more. Each class takes the l whose estimated number of candidates is worth it; a pair is verified when it
shares as many as the smaller l of both.

Groups of near copies make long lists of classes under one shingle. A list of over `SHORT` classes is not paired
out. Its members are compared with one of them, the centre, and then joined again by what they differ in:
two members that both link with the centre are in one component already, and any other linked pair shares
differences to the centre, enough for a prefix of these (see `_differences`). So the work in a group of copies
follows its size and not its square, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklog.llm.bitmap import bitmap, in_map
from blocklog.llm.components import connected_components
from blocklog.llm.text import hashed_words, mix
from blocklog.session import Staging

SHINGLE = 3
PERCENT = 90
#: Most shared shingles that a class asks for.
MATCHES = 3
#: Lists up to this length are paired out.
SHORT = 64
#: Candidates that a class takes with one or two matches before it asks for one more.
CHEAP = (4, 12)
#: Shingles whose hash lies in this part of all are counted.
COUNTED = 0.25
#: A shingle in so many documents is ordered last; the most frequent FREQUENT of them are told to all tasks.
OFTEN = 8
FREQUENT = 1 << 19


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles; fewer words than `size` are one shingle, none give none."""
    for got in hashed_words(texts, lower=True):
        runs = _runs(got.hashes, size)
        for start, end in zip(got.bounds[:-1].tolist(), got.bounds[1:].tolist(), strict=True):
            n = min(size, end - start)
            if not n:
                yield np.empty(0, np.uint64)
            elif n < size:
                yield _runs(got.hashes[start:end], n)
            else:
                some = np.sort(runs[start : end - size + 1])
                yield some[np.concatenate([[True], some[1:] != some[:-1]])]


def _runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    count = max(len(hashes) - n + 1, 0)
    total = np.full(count, n, np.uint64)
    for k in range(n):
        total = mix(total + hashes[k : count + k])
    return total


def _least_overlap(n: np.ndarray | int, percent: int):
    return -(-(percent * n) // 100)


def _count_batches(size: int, counted: float):
    limit = np.uint64(int(counted * 2**64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(0).to_pylist(), size))
            low = [s[: np.searchsorted(s, limit)] for s in sets]
            token, times = np.unique(np.concatenate(low) if low else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(times)], ["token", "times"])

    return run


def _ordered(tokens: np.ndarray, frequent: np.ndarray, counted: float) -> np.ndarray:
    """The global order: rare, unknown, frequent, each by hash. `tokens` and `frequent` are sorted."""
    low = np.searchsorted(tokens, np.uint64(int(counted * 2**64)))
    at = np.searchsorted(frequent, tokens[:low])
    often = (at < len(frequent)) & (frequent[np.minimum(at, len(frequent) - 1)] == tokens[:low]) if len(frequent) else np.zeros(low, bool)
    return np.concatenate([tokens[:low][~often], tokens[low:], tokens[:low][often]])


def _prefix_batches(size: int, percent: int, matches: int, frequent: np.ndarray, counted: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, prefixes = [], [], []
            for s in shingle_sets(batch.column(1).to_pylist(), size):
                n = len(s)
                sizes.append(n)
                keys.append(blake2b(s.tobytes(), digest_size=16).digest())
                longest = n - int(_least_overlap(n, percent)) + matches if n else 0
                prefixes.append(_ordered(s, frequent, counted)[:longest].view(np.int64))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "key", "prefix"])

    return run


def _set_batches(size: int, wanted):
    """Sets of the documents whose ids the map may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_map(batch.column(0).to_numpy(), wanted.value)))
            sets = [s.tobytes() for s in shingle_sets(batch.column(1).to_pylist(), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["rep", "tokens"])

    return run


def _sorted_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of `a` are in `b`; both are sorted and distinct."""
    if not len(b):
        return np.zeros(len(a), bool)
    at = np.searchsorted(b, a)
    return b[np.minimum(at, len(b) - 1)] == a


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = int(_sorted_overlap(a, b).sum())
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            kept = batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, ["a", "b"])

    return run




def _differences(percent: int, frequent: np.ndarray, counted: float):
    """For rows (x, c, tokens of x, tokens of c): the link with c, and the keys under which x meets others of c's group.

    Let d(x) be the number of shingles that just one of x and c has. x and y link only if they differ in at most
    D = (n(x) + n(y)) (100 - percent) / (100 + percent) shingles, so their differences share at least
    (d(x) + d(y) - D) / 2. A pair to be found has one member that does not link with c, d > (n + n(c)) q. Hence

    - any pair shares at least d(x) - D(x, largest possible y), as d(y) >= d(x) - D: `long` prefix;
    - each member's `half` prefix allows in addition for d(y) just over the bound of a link: at least
      (d(x) + (n(c) - n(x)) q) / 2 shared; a member without a link is met under it by its like, and under its `long`
      prefix by members with a link;
    - a pair that shares none has d(x) + d(y) <= D, so y is within (n(y) - n(c)) q + 1 of c: key `near`.

    A key's role is U (no link with c), L (link), N (so near to c) or G (meets N).
    """
    q = (100 - percent) / (100 + percent)
    most = 100 / percent  # size of the largest partner
    schema = pa.schema([("x", pa.int64()), ("c", pa.int64()), ("n", pa.int64()), ("d", pa.int64()), ("linked", pa.bool_()), ("half", pa.list_(pa.int64())), ("long", pa.list_(pa.int64())), ("near", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for x_id, c_id, x, c in zip(*(batch.column(k) for k in range(4)), strict=True):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(c.as_py(), np.uint64)
                in_c, in_x = _sorted_overlap(a, b), _sorted_overlap(b, a)
                both = int(in_c.sum())
                n, m = len(a), len(b)
                d = n + m - 2 * both
                linked = 100 * both >= percent * (n + m - both)
                order = np.concatenate([_ordered(a[~in_c], frequent, counted), b[~in_x]]).view(np.int64)
                long = d - max(1, d - int(n * (1 + most) * q + 1e-9)) + 1
                half = min(long, d - max(1, int(np.ceil((d + (m - n) * q) / 2 - 1e-9))) + 1)
                near = d <= (n - m) * q + 1 + 1e-9
                row = (x_id.as_py(), c_id.as_py(), n, d, linked, order[: max(half, 0)], [] if linked else order[: max(long, 0)], near)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return run


_DIFFERENCE_SCHEMA = "x bigint, c bigint, n bigint, d bigint, linked boolean, half array<bigint>, long array<bigint>, near boolean"


def jaccard_components(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    matches: int = MATCHES,
    short: int = SHORT,
    counted: float = COUNTED,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: documents link when their sets' Jaccard index reaches `percent`.

    Words are lower-cased in A-Z and split at ASCII white space; the component is the least id reachable by links.
    A null or empty text has no shingles and links with nothing. A row with a null id takes part in no link and has a
    null component. Rows with one id count as one document. Exact copies link. An empty table gives no rows; other
    columns are not read. Sets are compared by 64-bit hashes of their shingles.
    """
    spark = docs.sparkSession
    stage = Staging(spark)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    counts = texts.select("text").mapInArrow(_count_batches(shingle, counted), "token bigint, times bigint")
    often = counts.groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") >= OFTEN)
    rows = often.orderBy(F.desc("times"), "token").limit(FREQUENT).select("token").toArrow()
    frequent = np.sort(rows.column("token").to_numpy().astype(np.int64).view(np.uint64))

    prefixes = texts.mapInArrow(_prefix_batches(shingle, percent, matches, frequent, counted), "doc_id bigint, n bigint, key binary, prefix array<bigint>")
    every = stage.table(prefixes, "prefixes")
    linkable = every.where("doc_id is not null and n > 0")
    reps = linkable.groupBy("key").agg(F.min("doc_id").alias("rep"))
    classes = stage.table(
        linkable.join(reps, "key").where("doc_id = rep").select("rep", "n", "key", "prefix").dropDuplicates(["key"]).drop("key"), "classes"
    )
    plain = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("bigint") + 1
    postings = classes.select("rep", "n", plain.alias("p"), F.posexplode("prefix").alias("pos", "token"))
    lists = stage.table(postings.groupBy("token").agg(F.count("*").alias("size")).where("size > 1"), "lists")
    listed = stage.table(postings.join(lists, "token"), "postings")

    # The estimated candidates of a class by the number of matches it asks for; its rank as a centre is how few
    # shingles of its prefix are its own.
    at_level = [F.sum(F.when(F.col("pos") < F.col("p") + k, F.least("size", F.lit(1 << 20)) - 1).otherwise(0)) for k in range(matches)]
    level = F.lit(matches)
    for k in reversed(range(matches - 1)):
        level = F.when(at_level[k] / (k + 1) <= CHEAP[min(k, len(CHEAP) - 1)], k + 1).otherwise(level)
    chosen = stage.table(listed.groupBy("rep").agg(level.alias("level"), (F.max("p") - F.count("*")).alias("own")), "levels")

    small = listed.where(F.col("size") <= short).join(chosen, "rep").select("token", "rep", "n", "p", "pos", "level")
    a, b = small.alias("a"), small.alias("b")
    both = F.least("a.level", "b.level")
    fits = (
        (F.col("a.rep") < F.col("b.rep"))
        & (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent)
        & (F.col("a.pos") < F.col("a.p") + both - 1)
        & (F.col("b.pos") < F.col("b.p") + both - 1)
    )
    left = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))  # shared ones from here on, at most
    shared = a.join(b, (F.col("a.token") == F.col("b.token")) & fits).select(
        F.col("a.rep").alias("a"), F.col("b.rep").alias("b"), both.alias("level"),
        (left * (100 + percent) >= (F.col("a.n") + F.col("b.n")) * percent).alias("possible"),
    )
    pairs = stage.table(
        shared.groupBy("a", "b").agg(F.count("*").alias("k"), F.max("level").alias("level"), F.max("possible").alias("possible")).where("k >= level and (possible or level > 1)").select("a", "b"),
        "pairs",
    )

    large = listed.where(F.col("size") > short).join(chosen, "rep").select("token", "rep", "own")
    centres = large.groupBy("token").agg(F.min(F.struct("own", "rep")).alias("c")).select("token", F.col("c.rep").alias("c"))
    centres = stage.table(centres, "centres")  # staged, so that the rows of a long list can be split in the join
    around = stage.table(large.join(centres, "token").select(F.col("rep").alias("x"), "c").distinct(), "around")

    needed = pairs.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(around.select(F.explode(F.array("x", "c")).alias("rep"))).distinct()
    needed = stage.table(needed, "needed")
    wanted = spark.sparkContext.broadcast(bitmap(needed.select(F.col("rep").alias("key"))))
    found = texts.where("doc_id is not null").mapInArrow(_set_batches(shingle, wanted), "rep bigint, tokens binary")
    sets = stage.table(found.join(needed, "rep", "left_semi").distinct(), "sets")

    def with_sets(two: DataFrame, a: str, b: str) -> DataFrame:
        first = two.join(sets.select(F.col("rep").alias(a), F.col("tokens").alias("tokens_a")), a)
        return first.join(sets.select(F.col("rep").alias(b), F.col("tokens").alias("tokens_b")), b).select(a, b, "tokens_a", "tokens_b")

    differences = stage.table(with_sets(around, "x", "c").mapInArrow(_differences(percent, frequent, counted), _DIFFERENCE_SCHEMA), "differences")
    more = stage.table(_across(differences, percent), "pairs-across")
    links = (
        with_sets(pairs.unionByName(more).distinct(), "a", "b").mapInArrow(_verify(percent), "a bigint, b bigint")
        .unionByName(differences.where("linked and x <> c").select(F.col("x").alias("a"), F.col("c").alias("b")))
    )
    parts = stage.table(connected_components(links, stage), "components")

    of_key = reps.join(parts, reps["rep"] == parts["node"], "left").select("key", F.coalesce("component", "rep").alias("component"))
    of_key = stage.table(of_key, "class-components")
    joined = every.join(of_key, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).alias("component"))
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _across(differences: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one centre's group, not both linked with it, that their differences leave possible."""
    q = (100 - percent) / (100 + percent)

    def side(rows: DataFrame, prefix: str, name: str) -> DataFrame:
        spread = rows.select("c", "x", "n", "d", F.posexplode(prefix).alias("pos", "key"))
        return spread.select(*[F.col(k).alias(f"{name}_{k}") for k in spread.columns])

    def possible(a: str, b: str):
        n, d = F.col(f"{a}_n") + F.col(f"{b}_n"), F.col(f"{a}_d") + F.col(f"{b}_d")
        left = F.least(F.col(f"{a}_d") - F.col(f"{a}_pos"), F.col(f"{b}_d") - F.col(f"{b}_pos"))
        sizes = F.least(f"{a}_n", f"{b}_n") * 100 >= F.greatest(f"{a}_n", f"{b}_n") * percent
        return sizes & (d - 2 * left <= n * q + 1e-9) & (F.abs(F.col(f"{a}_d") - F.col(f"{b}_d")) <= n * q + 1e-9)

    def meet(a: DataFrame, b: DataFrame, once: bool) -> DataFrame:
        key = (F.col("a_c") == F.col("b_c")) & (F.col("a_key") == F.col("b_key")) & possible("a", "b")
        key = key & (F.col("a_x") < F.col("b_x")) if once else key
        return a.join(b, key).select(F.least("a_x", "b_x").alias("a"), F.greatest("a_x", "b_x").alias("b"))

    apart, with_link = differences.where("not linked"), differences.where("linked")
    near = differences.where("near").select(*[F.col(k).alias(f"b_{k}") for k in ("c", "x", "n", "d")])
    grey = apart.where(F.col("d") <= F.col("n") * (1 + 100 / percent) * q + 1e-9).select(*[F.col(k).alias(f"a_{k}") for k in ("c", "x", "n", "d")])
    close = (F.col("a_c") == F.col("b_c")) & (F.col("a_x") != F.col("b_x")) & (F.col("a_d") + F.col("b_d") <= (F.col("a_n") + F.col("b_n")) * q + 1e-9)
    alone = grey.join(near, close).select(F.least("a_x", "b_x").alias("a"), F.greatest("a_x", "b_x").alias("b"))
    return (
        meet(side(apart, "half", "a"), side(apart, "half", "b"), True)
        .unionByName(meet(side(with_link, "half", "a"), side(apart, "long", "b"), False))
        .unionByName(alone)
        .distinct()
    )
