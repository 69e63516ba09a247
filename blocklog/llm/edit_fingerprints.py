"""Document fingerprints by a randomised edit embedding (operator 12).

A walk goes over the characters of a text: at step s it is at character i and moves on to i + 1 if a shared random
function of s (modulo `PERIOD`) and the character says so, else it stays. The embedding of the text is the character at
each step, so a common part of two texts that both walks enter at one step is embedded alike, and after an edit the walks
meet again by chance: a small edit distance becomes a small Hamming distance. Of the embedding's characters, hashed to
bits, a fingerprint keeps those at multiples of a power of two, so that at most `BITS` are left; texts of other lengths
keep bits that can be thinned to the same places. Each of `WALKS` walks gives its own bits and the best of them counts.

Near texts are found from fingerprints alone: bands of sampled bits propose pairs and the likeness of the fingerprints
verifies them (`near_groups`). The width and the number of bands follow from the number of different fingerprints.

The edited texts need each document's successor in descending order of ids. Documents are dealt into ranges of that
order, and the first document of a range is sent to the range before it as well, so texts are shuffled once and each
task reads its range in order with one document of look-ahead.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blocklog.llm.bitmap import bitmap, in_map
from blocklog.llm.components import connected_components
from blocklog.llm.text import mix
from blocklog.session import Staging

WALKS = 2
PERIOD = 1 << 12
#: Bits of a walk's fingerprint at most; a longer one has more than half of that.
BITS = 256
#: A step of an embedding has so many bits, all of which short texts keep.
STEP_BITS = 8
#: Characters that are walked over at once.
_CELLS = 1 << 22
#: Fewer texts than this are walked one by one.
_SIDE_BY_SIDE = 24

LIKENESS = 0.9
#: Share of pairs just at the wanted likeness that bands must propose.
RECALL = 0.95
#: A list of more members meets its centre and is split by further bits.
SHORT = 8
#: Members of a block of a list whose members are in several groups.
BLOCK = 1024


def _walk_tables() -> list[np.ndarray]:
    """For each walk, steps spent at a character of each of 256 kinds when it is entered at a step modulo PERIOD."""
    tables = []
    for walk in range(WALKS):
        cells = np.arange(2 * PERIOD * 256, dtype=np.uint64) % np.uint64(PERIOD * 256)
        moves = (mix(cells + np.uint64((walk + 1) << 40)) >> np.uint64(63)).astype(bool).reshape(2 * PERIOD, 256)
        steps = np.full((2 * PERIOD, 256), 255, np.uint8)
        for s in range(2 * PERIOD - 2, -1, -1):
            steps[s] = np.where(moves[s], 1, np.minimum(steps[s + 1], 254) + 1)
        tables.append(steps[:PERIOD].copy())
    return tables


class Walker:
    """Fingerprints of texts. Build one in each task; the tables take a megabyte a walk."""

    def __init__(self):
        self._tables = _walk_tables()
        self._flat = [t.tobytes() for t in self._tables]

    def _entered(self, kinds: list[np.ndarray], walk: int) -> list[np.ndarray]:
        """The step at which each character is entered, and the number of steps in all.

        Character by character over all texts at once, longest first, so those that go on are always the first ones;
        the last few go on alone.
        """
        order = sorted(range(len(kinds)), key=lambda k: -len(kinds[k]))
        sizes = np.array([len(kinds[k]) for k in order], np.int64)
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        flat = np.concatenate([x for k in order for x in (kinds[k], np.zeros(1, np.uint8))])
        entered = np.zeros(len(flat), np.int64)
        table, now = self._tables[walk].reshape(-1), np.zeros(len(order), np.int64)
        common = int(sizes[_SIDE_BY_SIDE - 1]) if len(order) >= _SIDE_BY_SIDE else 0
        left = np.searchsorted(-sizes, -np.arange(common), side="left")  # texts longer than each number of characters
        for i, n in enumerate(left.tolist()):
            at = starts[:n] + i
            now[:n] += table[((now[:n] & (PERIOD - 1)) << 8) | flat[at]]
            entered[at + 1] = now[:n]
        cells, mask = self._flat[walk], PERIOD - 1
        for k in range(int(np.searchsorted(-sizes, -common, side="left"))):
            step, steps = int(now[k]), []
            for kind in flat[starts[k] + common : starts[k] + sizes[k]].tobytes():
                step += cells[(step & mask) << 8 | kind]
                steps.append(step)
            entered[starts[k] + common + 1 : starts[k] + sizes[k] + 1] = steps
        out: list[np.ndarray] = [entered] * len(kinds)
        for k, start, size in zip(order, starts.tolist(), sizes.tolist(), strict=True):
            out[k] = entered[start : start + size + 1]
        return out

    def prints(self, texts: list[str]) -> list[str]:
        """For each walk its number of steps and its bits, in hexadecimal."""
        points = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
        kinds = [(mix(p) >> np.uint64(56)).astype(np.uint8) for p in points]
        parts: list[list[str]] = [[] for _ in texts]
        for walk in range(WALKS):
            for k, entered in enumerate(self._entered(kinds, walk)):
                parts[k].append(f"{entered[-1]:x}-{_bits(points[k], entered, walk).tobytes().hex()}")
        return [".".join(p) for p in parts]


def level(steps: int) -> int:
    """Multiples of two to this power are kept of the bits of so many steps."""
    return max(0, (max(1, -(-steps * STEP_BITS // BITS)) - 1).bit_length())


def _bits(points: np.ndarray, entered: np.ndarray, walk: int) -> np.ndarray:
    kept = np.arange(0, int(entered[-1]) * STEP_BITS, 1 << level(int(entered[-1])))
    step = kept // STEP_BITS
    symbol = points[np.searchsorted(entered, step, side="right") - 1].astype(np.uint64) if len(kept) else np.empty(0, np.uint64)
    hashes = mix(symbol * np.uint64(0x9E3779B97F4A7C15) + mix(step.astype(np.uint64) + np.uint64((walk + 1) << 48)))
    return np.packbits((hashes >> (kept % STEP_BITS).astype(np.uint64)).astype(np.uint8) & np.uint8(1))


def _parsed(fingerprint: str) -> list[tuple[int, np.ndarray]]:
    out = []
    for part in fingerprint.split("."):
        steps, bits = part.split("-")
        n = int(steps, 16)
        count = -(-n * STEP_BITS >> level(n))
        out.append((n, np.unpackbits(np.frombuffer(bytes.fromhex(bits), np.uint8))[: -(-n * STEP_BITS // (1 << level(n)))] if count else np.empty(0, np.uint8)))
    return out


def likeness(a: str, b: str) -> float:
    """Estimated share of equal steps of two embeddings, of the longer one's steps; the best walk counts.

    Unequal characters share half of their bits, so twice the surplus over that is taken, and 0 at least.
    """
    if a == b:
        return 1.0
    best = 0.0
    for (n, x), (m, y) in zip(_parsed(a), _parsed(b), strict=True):
        if n > m:
            n, x, m, y = m, y, n, x
        x = x[:: 1 << (level(m) - level(n))]
        equal = int((x == y[: len(x)]).sum())
        best = max(best, (2 * equal - len(x)) / len(y) if len(y) else 1.0)
    return best


# --- documents and their successors


def edited(text: str, following: str) -> str:
    """The last half of the text, rounded down, replaced by as many characters of the following one or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_DEALT = pa.schema([("part", pa.int32()), ("extra", pa.bool_()), ("doc_id", pa.int64()), ("print", pa.int64()), ("text", pa.string()), ("copies", pa.int64())])
_DEALT_DDL = "part int, extra boolean, doc_id bigint, print bigint, text string, copies bigint"
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
     ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_OUT_DDL = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _key(doc_id, print_) -> tuple:
    return (doc_id is not None, doc_id or 0, print_)


def _deal(firsts: list[tuple]):
    """Each document to its range, and the first of a range to the range before; `firsts` is ascending."""
    last = len(firsts) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple, list[int]] = {}
            for k, key in enumerate(map(_key, batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                rows.setdefault(key, [k, 0])[1] += 1  # equal rows of a batch go out once
            of, part, extra, copies = [], [], [], []
            for key, (k, times) in rows.items():
                at = bisect_left(firsts, key)
                of.append(k), part.append(last - at), extra.append(False), copies.append(times)
                if firsts[at] == key:
                    of.append(k), part.append((last - at - 1) % len(firsts)), extra.append(True), copies.append(times)
            taken = [batch.column(c).take(pa.array(of, pa.int64())) for c in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(extra), *taken, pa.array(copies, pa.int64())], schema=_DEALT)

    return run


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    walker = Walker()
    rows: list[list] = []  # part, extra, doc_id, print, text, copies
    size = 0

    def finished() -> pa.RecordBatch:
        """All rows but the last, which is only looked at."""
        nonlocal rows, size
        prints = walker.prints([r[4] for r in rows])
        keep = [k for k in range(len(rows) - 1) if not rows[k][1]]  # an extra row ends its range
        changed = [edited(rows[k][4], rows[k + 1][4]) for k in keep]
        out = []
        for k, text, other in zip(keep, changed, walker.prints(changed), strict=True):
            row = (rows[k][2], len(rows[k][4]), hashlib.sha256(text.encode()).hexdigest(), prints[k], other, likeness(prints[k], other), likeness(prints[k], prints[k + 1]))
            out += [row] * rows[k][5]
        rows, size = rows[-1:], 0
        columns = list(zip(*out)) or [()] * len(_OUT)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT)

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                if rows and list(row[:4]) == rows[-1][:4]:
                    rows[-1][5] += row[5]
                    continue
                rows.append(list(row))
                size += len(row[4])
                if size > _CELLS and len(rows) > 2:
                    # A row's copies are known when the next row has come, so the newest row is kept out.
                    newest = rows.pop()
                    yield finished()
                    rows.append(newest)
    if rows:
        yield finished()


def edit_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like the text the edited and the next document are.

    The next document is the next in descending order of ids, after the last the first. A null text is empty; a null id
    comes after all others; of different texts with one id the one with the greater hash comes first; rows with equal id and
    text are one document in that order, and each of them is returned. A document without another is its own next. An
    empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("print").desc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = keyed.select("doc_id", "print").distinct().repartitionByRange(parts, *order).select(F.spark_partition_id().alias("part"), "doc_id", "print")
    first = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "print")).alias("first")
    firsts = sorted(_key(r.first.doc_id, r.first["print"]) for r in ranges.groupBy("part").agg(first).collect())  # a row for each range
    if not firsts:
        return spark.createDataFrame([], _OUT_DDL)
    dealt = keyed.mapInArrow(_deal(firsts), _DEALT_DDL).repartitionById(len(firsts), "part")
    return dealt.sortWithinPartitions("part", "extra", *order).mapInArrow(_read_ranges, _OUT_DDL)


# --- near texts by bands


def band_plan(classes: int, wanted: float, recall: float) -> tuple[int, int]:
    """Bits of a band and number of bands: lists of unlike texts stay short, pairs just as like as `wanted` share one band."""
    width = max(16, math.ceil(math.log2(max(2, classes)) / 0.85) + 6)
    shared = ((1 + wanted) / 2) ** width
    return width, max(2, math.ceil(math.log(1 - recall) / math.log(1 - shared)))


def _bands(width: int, bands: int, repeated=None):
    """(key, finer key, fingerprint) of each band whose key the map `repeated` may hold; without the map, the keys only.

    The finer key has as many bits again.

    Texts on either side of a level have too few bits in common, so a text so long that a near one may be on the next
    level gives keys at that level too. Texts that have all their bits meet those with as many.
    """
    names = ["key", "finer", "fingerprint"]
    rng = np.random.default_rng(7)
    places = [rng.integers(0, BITS // 4, (bands, 2 * width)), rng.integers(0, BITS // 2, (bands, 2 * width))]
    numbers = [np.arange(walk, bands, WALKS) for walk in range(WALKS)]
    # Two sums with random odd weights tell bands of any width apart.
    weights = mix(np.arange(2 * width, dtype=np.uint64) + np.uint64(5)).reshape(width, 2) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, finers, of = [], [], []
            for k, fingerprint in enumerate(batch.column(0).to_pylist()):
                for walk, (steps, bits) in enumerate(_parsed(fingerprint)):
                    mine = numbers[walk]
                    own, short = level(steps), len(bits) <= BITS // 2
                    for up in range(1 if short or len(bits) < 0.85 * BITS else 2):
                        if short:  # all bits there are; an empty text has none
                            chosen = np.append(bits, 0)[places[0][mine] % max(1, len(bits))]
                        else:
                            chosen = bits[:: 1 << up][places[1 - up][mine]]
                        weighed = chosen.reshape(len(mine), 2, width).astype(np.uint64) @ weights
                        tag = mix(mine.astype(np.uint64) * np.uint64(1 << 20) + np.uint64((own + up) * 512 + (len(bits) if short else 0)))
                        key = mix(mix(tag + weighed[:, 0, 0]) + weighed[:, 0, 1])
                        keys.append(key), finers.append(mix(mix(key + weighed[:, 1, 0]) + weighed[:, 1, 1])), of.append(np.full(len(mine), k))
            if not of:
                continue
            key, finer, row = np.concatenate(keys).view(np.int64), np.concatenate(finers).view(np.int64), np.concatenate(of)
            if repeated is None:
                yield pa.RecordBatch.from_arrays([pa.array(key)], names[:1])
                continue
            hit = in_map(key, repeated.value)
            yield pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array(finer[hit]), batch.column(0).take(pa.array(row[hit]))], names)

    return run


def _verify(wanted: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [likeness(x, y) >= wanted for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield batch.filter(pa.array(near, pa.bool_()))

    return run


def _proposed(rows: DataFrame, key: str, stage: Staging, short: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of the lists under a key: all of a short list, each with the centre of a long one; and the long lists' rows."""
    lists = stage.table(rows.groupBy(key).agg(F.count("*").alias("size"), F.min("fingerprint").alias("centre")).where("size > 1"), "lists-" + key)
    listed = rows.join(lists, key)
    small = listed.where(F.col("size") <= short).select(key, "fingerprint")
    pairs = small.select(key, F.col("fingerprint").alias("a")).join(small.select(key, F.col("fingerprint").alias("b")), key).where("a < b").select("a", "b")
    long = listed.where(F.col("size") > short)
    return pairs.unionByName(long.where("centre <> fingerprint").select(F.col("centre").alias("a"), F.col("fingerprint").alias("b"))), long.select(rows.columns)


def _across(long: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b) of one long list whose groups (of_a, of_b) differ; pairs within a group can add nothing to it.

    The members outside the group with most members meet all others. A list goes in blocks, so no task holds all of it.
    """
    known = parts.select(F.col("node").alias("fingerprint"), F.col("component").alias("of"))
    member = long.join(known, "fingerprint", "left").select("key", "fingerprint", F.coalesce("of", "fingerprint").alias("of"))
    counted = member.groupBy("key", "of").agg(F.count("*").alias("n")).groupBy("key")
    mixed = counted.agg(F.max_by("of", "n").alias("most"), F.ceil(F.sum("n") / BLOCK).alias("blocks"), F.count("*").alias("groups")).where("groups > 1")
    member = member.join(mixed.drop("groups"), "key")
    some = member.where("of <> most").select("key", F.col("fingerprint").alias("a"), F.col("of").alias("of_a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    all_ = member.select("key", F.col("fingerprint").alias("b"), F.col("of").alias("of_b"), "most", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).alias("block"))
    return some.join(all_, ["key", "block"]).where("of_a <> of_b and (of_b = most or a < b)").select("a", "b", "of_a", "of_b")


def near_groups(prints: DataFrame, *, wanted: float = LIKENESS, recall: float = RECALL, short: int = SHORT) -> DataFrame:
    """(fingerprint, group) of the fingerprints that are near others; `prints` has the columns doc_id and fingerprint.

    Documents with one fingerprint are one class from the start. Pairs come from bands, so a pair just at the wanted
    likeness is found with probability `recall`, closer ones with a higher one; nothing unlike is linked. A list of over
    `short` members is not paired out: its members meet a centre, and once more, with another centre, those that share
    as many bits again; then those of its members that are in different groups meet each other, so that the groups are
    those of all its pairs. The group is the least document id of what is linked, transitively; null ids count as greatest.
    """
    stage = Staging(prints.sparkSession)
    classes = stage.table(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    width, bands = band_plan(classes.count(), wanted, recall)
    keys = classes.select("fingerprint").mapInArrow(_bands(width, bands), "key bigint")
    again = keys.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    repeated = prints.sparkSession.sparkContext.broadcast(bitmap(again.select("key")))  # most keys come once and need no row
    rows = classes.select("fingerprint").mapInArrow(_bands(width, bands, repeated), "key bigint, finer bigint, fingerprint string")
    pairs, long = _proposed(stage.table(rows, "bands"), "key", stage, short)
    finer, _ = _proposed(long.select("finer", "fingerprint"), "finer", stage, short)
    links = pairs.unionByName(finer).distinct().mapInArrow(_verify(wanted), "a string, b string")
    parts = stage.table(connected_components(links, stage), "parts")
    across = _across(long.select("key", "fingerprint"), parts).mapInArrow(_verify(wanted), "a string, b string, of_a string, of_b string")
    merged = connected_components(across.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")), stage)
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("into"))
    # A member that was in no group is one of its own.
    parts = parts.unionByName(merged.select(F.col("component").alias("node"), "component")).distinct()
    parts = parts.join(merged, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    least = parts.join(classes, parts["node"] == classes["fingerprint"]).groupBy("component").agg(F.min("doc_id").alias("group_id"))
    return parts.join(least, "component").select(F.col("node").alias("fingerprint"), "group_id")


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", wanted: float = LIKENESS) -> DataFrame:
    """`edit_fingerprints` with one more column, group_id: the least id of the documents that are near by their fingerprints.

    A document without near ones has its own id; one with a null id has the group of its copies, null if they all are null.
    """
    stage = Staging(docs.sparkSession)
    done = stage.table(edit_fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprinted")
    groups = near_groups(done.select("doc_id", "fingerprint"), wanted=wanted)
    copies = done.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")).where("copies > 1").select("fingerprint", "least")
    heads = stage.table(copies.join(groups, "fingerprint", "full").select("fingerprint", F.coalesce("group_id", "least").alias("head")), "heads")
    return done.join(heads, "fingerprint", "left").select(*done.columns, F.coalesce("head", "doc_id").alias("group_id"))
