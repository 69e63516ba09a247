"""Prefix trie of rebuilt conversations from composable fingerprints (operator 13).

Conversation c is rebuilt as the first h turns of its family's base followed by its own turns after the first h. No
rebuilt text is ever made:

1. A turn becomes a reference, the SHA-256 of its role and text, in the scan. Texts are never shuffled.
2. Turns are range-sorted and each task scans its range for positions and fingerprints of prefixes. A fingerprint is
   an element of a monoid: the pair (length n, sum of T_m R^m modulo a prime), in four lanes; the product of two is
   (n + n', s + R^n s'). A conversation that crosses ranges gets the product of the ranges before, so one
   conversation may hold any share of the rows.
3. A rebuilt prefix is the product of a base head and a stretch of own turns: arithmetic on four columns.
4. Rebuilt prefixes with one depth and fingerprint are a node. A group is verified by induction: all its members must
   have one parent group and one turn reference; if not, the fingerprints collided and another R is taken.
5. Sums over subtrees double the distance each round, over nodes with two members or more only: below a node with one
   member there is one leaf and nothing saved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blocklog.session import Staging

PRIME = (1 << 31) - 1
LANES = 4
_LOW = (1 << 31) - 1
FAMILY = 5
#: Head lengths are below this, so the head of a conversation is an array of few turns.
HEADS = 9
#: Turns of one conversation that meet its one row of facts in the same join bucket.
BLOCK = 1 << 12
#: Collisions end after so many different R with a probability that is none in practice.
TRIES = 5
#: Characters of ids that are joined before they go to a digest.
CHUNK = 1 << 16

_REFERENCE = [f"s{k}" for k in range(4)]
_TURNS = pa.schema(
    [("part", pa.int32()), ("conv_id", pa.int64()), ("i", pa.int64()), ("bytes", pa.int64())]
    + [(name, pa.int64()) for name in (*_REFERENCE, "a", "b", "pa", "pb")]
)
_KEY = ["d", "a", "b"]


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'string' if f.type == pa.string() else 'bigint'}" for f in schema)


def points(seed: int) -> list[int]:
    """R of each lane."""
    return [2 + int(hashlib.sha256(f"{seed} {k}".encode()).hexdigest(), 16) % (PRIME - 3) for k in range(LANES)]


def _power(base: int, exponent: np.ndarray) -> np.ndarray:
    out, square, left = np.ones(len(exponent), np.uint64), base, exponent.astype(np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), out * np.uint64(square) % np.uint64(PRIME), out)
        square, left = square * square % PRIME, left >> np.uint64(1)
    return out


def _pack(lanes: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    return tuple(pa.array(((lanes[k] << np.uint64(31)) | lanes[k + 1]).view(np.int64)) for k in (0, 2))


def _scan(rs: list[int]):
    """Positions and inclusive and exclusive prefix fingerprints of the turns of a range, counted from its start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count, sums = None, 0, [0] * LANES
        for batch in batches:
            if batch.num_rows == 0:
                continue
            conv = batch.column(1).to_numpy()
            words = np.frombuffer(b"".join(batch.column(2).to_pylist()), ">u4").reshape(-1, 8)
            new = np.concatenate([[True], conv[1:] != conv[:-1]])
            start = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            going_on = conv[0] == last
            position = np.arange(len(conv)) - start[group] + 1 + np.where(group == 0, count if going_on else 0, 0)
            inside, before = [], []
            for lane, r in enumerate(rs):
                term = words[:, lane].astype(np.uint64) % np.uint64(PRIME) * _power(r, position) % np.uint64(PRIME)
                total = np.cumsum(term)
                base = (total - term)[start[group]]
                carry = np.where(group == 0, sums[lane] if going_on else 0, 0).astype(np.uint64)
                inside.append((total - base + carry) % np.uint64(PRIME))
                before.append((total - term - base + carry) % np.uint64(PRIME))
            last, count, sums = conv[-1], int(position[-1]), [int(x[-1]) for x in inside]
            references = np.ascontiguousarray(words).view(">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(position), batch.column(3), *(pa.array(references[:, k]) for k in range(4)), *_pack(inside), *_pack(before)],
                schema=_TURNS,
            )

    return run


def _lanes(a: Column | str, b: Column | str) -> list[Column]:
    a, b = F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b
    return [F.shiftright(a, 31), a.bitwiseAND(F.lit(_LOW)), F.shiftright(b, 31), b.bitwiseAND(F.lit(_LOW))]


def _packed(lanes: list[Column]) -> tuple[Column, Column]:
    return tuple(F.shiftleft(lanes[k], 31).bitwiseOR(lanes[k + 1]) for k in (0, 2))


def _positions(conversations: DataFrame, stage: Staging, rs: list[int], names: tuple[str, str, str, str]) -> DataFrame:
    """(conv_id, i, bytes, reference, fingerprints up to and before the turn); i counts from 1."""
    spark = conversations.sparkSession
    conv, turn, role, text = (F.col(c) for c in names)
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    reference = F.sha2(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256)
    rows = conversations.where(conv.isNotNull()).select(
        conv.cast("bigint").alias("conv_id"), turn.alias("turn"), reference.alias("reference"), F.octet_length(text).cast("bigint").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "reference", "row"]  # the row number only deals equal rows over ranges
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranges = dealt.select(F.spark_partition_id().alias("part"), "conv_id", F.unhex("reference").alias("reference"), "bytes")
    turns = stage.table(ranges.mapInArrow(_scan(rs), _ddl(_TURNS)), "turns")

    ends = sorted((r.part, r.low, r.high) for r in turns.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high")).collect())
    crossing = sorted({low for (_, _, high), (_, low, _) in zip(ends, ends[1:], strict=False) if high == low})
    if not crossing:
        return turns.drop("part")
    whole = turns.where(F.col("conv_id").isin(crossing)).groupBy("part", "conv_id").agg(F.max(F.struct("i", "a", "b")).alias("end"))
    carries, now = [], {}
    for r in sorted(whole.collect(), key=lambda r: r.part):  # two rows for each range at most
        n, sums = now.get(r.conv_id, (0, [0] * LANES))
        shifts = [pow(x, n, PRIME) for x in rs]
        carries.append((r.part, r.conv_id, n, *shifts, *sums))
        own = [r.end.a >> 31, r.end.a & _LOW, r.end.b >> 31, r.end.b & _LOW]
        now[r.conv_id] = n + r.end.i, [(s + f * g) % PRIME for s, f, g in zip(sums, shifts, own, strict=True)]
    shift, add = [f"f{k}" for k in range(LANES)], [f"g{k}" for k in range(LANES)]
    carry = spark.createDataFrame(carries, f"part int, conv_id bigint, n0 bigint, {', '.join(c + ' bigint' for c in shift + add)}")
    joined = turns.join(F.broadcast(carry), ["part", "conv_id"], "left")  # two rows for each range at most

    def moved(a: str, b: str) -> tuple[Column, Column]:
        lanes = [F.pmod(F.col(g) + F.col(f) * x, F.lit(PRIME)) for f, g, x in zip(shift, add, _lanes(a, b), strict=True)]
        return tuple(F.when(F.col("n0").isNull(), F.col(c)).otherwise(p).alias(c) for c, p in zip((a, b), _packed(lanes), strict=True))

    return joined.select("conv_id", (F.col("i") + F.coalesce("n0", F.lit(0))).alias("i"), "bytes", *_REFERENCE, *moved("a", "b"), *moved("pa", "pb"))


def _rebuilt(turns: DataFrame, stage: Staging, family: int, heads: int) -> DataFrame:
    """A row for each conversation: its base's head, lengths and the fingerprints at the seam."""
    head = F.when(F.col("i") < heads, F.struct("i", "bytes", *_REFERENCE, "a", "b", "pa", "pb"))
    facts = turns.groupBy("conv_id").agg(F.max("i").alias("len"), F.sort_array(F.collect_list(head)).alias("head"))
    h = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")), F.lit(heads)).cast("int")
    facts = stage.table(facts.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % family), "conversations")
    bases = facts.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    none = F.slice("head", 1, 0)
    both = facts.join(bases, "base", "left").withColumn("base_head", F.coalesce(F.slice("base_head", F.lit(1), F.col("h")), none)).withColumn("k", F.size("base_head"))
    own = F.get("head", F.least(F.col("h").cast("bigint"), F.col("len")).cast("int") - 1)
    seam = F.get("base_head", F.col("k") - 1)
    zero = F.lit(0).cast("bigint")
    return stage.table(
        both.select(
            "conv_id", "h", "k", "len", "base_head", (F.col("k") + F.greatest(F.col("len") - F.col("h"), zero)).alias("depth"),
            *(F.coalesce(at.getField(c), zero).alias(name + c) for at, name in ((seam, "base_"), (own, "own_")) for c in "ab"),
        ),
        "rebuilt",
    )


def _members(turns: DataFrame, rebuilt: DataFrame, rs: list[int]) -> DataFrame:
    """A row for each conversation and depth from 1: key, parent's key, turn reference, whether the conversation ends."""
    heads = rebuilt.select("conv_id", "depth", F.posexplode("base_head").alias("p", "turn")).select(
        "conv_id", (F.col("p") + 1).cast("bigint").alias("d"), "turn.*", (F.col("p") + 1 == F.col("depth")).alias("ends")
    )
    block = F.floor(F.col("i") / BLOCK)
    facts = rebuilt.where("len > h").drop("base_head").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("len") / BLOCK))))
    own = turns.withColumn("block", block).join(facts, ["conv_id", "block"]).where("i > h")
    back = F.col("h") - F.col("k")  # the own turns stand so many places further to the front
    at_seam, at_own = _lanes("base_a", "base_b"), _lanes("own_a", "own_b")

    def product(a: str, b: str) -> tuple[Column, Column]:
        lanes = []
        for x, seam, skipped, r in zip(_lanes(a, b), at_seam, at_own, rs, strict=True):
            inverse = pow(r, -1, PRIME)
            shift = F.get(F.array(*(F.lit(pow(inverse, n, PRIME)).cast("bigint") for n in range(HEADS + 1))), back)
            lanes.append(F.pmod(seam + shift * F.pmod(x - skipped, F.lit(PRIME)), F.lit(PRIME)))
        return tuple(c.alias(n) for c, n in zip(_packed(lanes), (a, b), strict=True))

    d = F.col("k") + F.col("i") - F.col("h")
    own = own.select("conv_id", d.alias("d"), "bytes", *_REFERENCE, *product("a", "b"), *product("pa", "pb"), (d == F.col("depth")).alias("ends"))
    return heads.select(own.columns).unionByName(own)


def _subtree_sums(shared: DataFrame, stage: Staging) -> DataFrame:
    """(key, leaves, saved) added up over what lies below each node; `shared` has key, parent's key and both values.

    In round k a node's sums cover what is less than 2^k below it and `u` is its ancestor 2^k above; only nodes that
    have one take part.
    """
    deepest = shared.agg(F.max("d")).first()[0]
    active = shared.where("d > 0").select(*_KEY, (F.col("d") - 1).alias("ud"), F.col("pa").alias("ua"), F.col("pb").alias("ub"), "leaves", "saved")
    up, parts, step = ["ud", "ua", "ub"], [shared.select(*_KEY, "leaves", "saved")], 1
    while deepest is not None and step <= deepest:
        added = active.groupBy(*up).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).toDF(*_KEY, "leaves", "saved")
        added = stage.table(added, f"added-{step}")
        parts.append(added)
        if 2 * step > deepest:
            break
        more = added.select(*_KEY, F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        above = active.where(F.col("d") >= step).select(*(F.col(c).alias(u) for c, u in zip(_KEY, up, strict=True)), *(F.col(u).alias("next_" + u) for u in up))
        moved = active.where(F.col("d") >= 2 * step).join(above, up).join(more, _KEY, "left")
        active = moved.select(
            *_KEY, *(F.col("next_" + u).alias(u) for u in up),
            *((F.col(c) + F.coalesce("more_" + c, F.lit(0))).alias(c) for c in ("leaves", "saved")),
        )
        step *= 2
        active = stage.table(active, f"active-{step}")
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return everything.groupBy(*_KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to (key, first conv_id, comma-joined ids) of CHUNK characters or so."""
    key, first, ids, size = None, None, [], 0
    for batch in batches:
        out = []
        for *now, conv in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if now != key or size > CHUNK:
                if ids:
                    out.append((*key, first, ",".join(ids)))
                key, first, ids, size = now, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield _run_batch(out)
    yield _run_batch([(*key, first, ",".join(ids))] if ids else [])


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()], strict=True)], [*_KEY, "conv_id", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs to one digest for each key; holds one run."""
    key, digest = None, None
    for batch in batches:
        out = []
        for k in range(batch.num_rows):
            now, ids = [batch.column(c)[k].as_py() for c in range(3)], batch.column(4)[k].as_py()
            if now != key:
                if key is not None:
                    out.append((*key, 0, digest.hexdigest()))
                key, digest = now, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _run_batch(out)
    yield _run_batch([(*key, 0, digest.hexdigest())] if key is not None else [])


def _ends(members: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where a conversation ends.

    Ids are sorted and joined to runs over ranges of equal size first, so the task that digests a large group reads a
    row for thousands of ids.
    """
    zero = F.lit(0).cast("bigint")
    turnless = rebuilt.where("depth = 0").select(*(zero.alias(c) for c in _KEY), "conv_id")
    order = [*_KEY, "conv_id"]
    ends = members.where("ends").select(*order).unionByName(turnless)
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_runs, "d bigint, a bigint, b bigint, conv_id bigint, ids string")
    dealt = runs.repartition(*_KEY).sortWithinPartitions(*order)
    return dealt.mapInArrow(_digests, "d bigint, a bigint, b bigint, conv_id bigint, ids string").select(*_KEY, F.col("ids").alias("ends_sha256"))


def prefix_trie(
    conversations: DataFrame,
    *,
    columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
    family: int = FAMILY,
    heads: int = HEADS,
    seed: int = 0,
) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by `turn`, null first; turns with one number (repeated rows too, which all count) by the SHA-256 of
    role and text. Null roles and texts are empty. Rows with a null conversation id belong to none and are left out. A
    table without conversations has no root and gives no rows. Other columns are ignored, whatever their names.
    """
    if not 1 <= heads <= HEADS:
        raise ValueError(f"heads must be from 1 to {HEADS}")
    stage = Staging(conversations.sparkSession)
    for attempt in range(seed, seed + TRIES):
        rs = points(attempt)
        turns = _positions(conversations, stage, rs, columns)
        rebuilt = _rebuilt(turns, stage, family, heads)
        members = stage.table(_members(turns, rebuilt, rs), "members")
        same = ["pa", "pb", *_REFERENCE]
        checked = [x for c in same for x in (F.min(c).alias(c), F.max(c).alias("max_" + c))]
        nodes = stage.table(
            members.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), *checked), "nodes"
        )
        if nodes.where(" or ".join(f"{c} <> max_{c}" for c in same)).isEmpty():
            break
    else:
        raise RuntimeError("fingerprints of prefixes collide")

    zero = F.lit(0).cast("bigint")
    top = rebuilt.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = top.first()
    names = [*_KEY, "conv_id", "n_convs", "bytes", "pa", "pb"]
    root_row = top.select(*(zero.alias(c) for c in _KEY), "conv_id", "n_convs", *(zero.alias(c) for c in ("bytes", "pa", "pb")))
    nodes = nodes.select(names).unionByName(root_row)

    kids = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    kids = kids.agg(F.count("*").alias("n_children"), F.sum(F.when(F.col("n_convs") == 1, 1).otherwise(0)).alias("singles"))
    nodes = stage.table(nodes.join(kids, _KEY, "left").fillna(0, ["n_children", "singles"]), "nodes-and-children")
    shared = nodes.where("n_convs > 1").select(
        *_KEY, "pa", "pb", (F.col("singles") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    sums = _subtree_sums(shared, stage)
    parents = nodes.where("n_children > 0 and d > 0").select((F.col("d") + 1).alias("d"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent"))
    # The root's children, the most that a node is likely to have, need no join.
    above = F.when(F.col("d") == 1, F.lit(root.conv_id if root else None).cast("bigint")).otherwise(F.col("parent"))
    deep = nodes.where("d > 1").join(parents, ["d", "pa", "pb"], "left").select(*nodes.columns, "parent")
    shallow = nodes.where("d <= 1").withColumn("parent", F.lit(None).cast("bigint"))
    out = deep.unionByName(shallow).join(sums, _KEY, "left").join(_ends(members, rebuilt), _KEY, "left")
    return out.select(
        "conv_id", F.col("d").alias("depth"), above.alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).cast("bigint").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
