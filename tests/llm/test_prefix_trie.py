"""The trie of rebuilt conversations against a plain version that builds every conversation."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from blocklog.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows: list[tuple]) -> list[tuple]:
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            reference = sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, reference, role, text))
    own = {c: [(role, text) for *_, role, text in sorted(t)] for c, t in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - c % 5
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, seq in sorted(built.items()):
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) if children[p] else 1
        mine = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = mine + sum(saved[q] for q in children[p])
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in cs if len(built[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out.append((cs[0], len(p), parent, len(cs), len(children[p]), leaves[p], saved[p], sha256(ends.encode()).hexdigest()))
    return sorted(out)


def got(spark, rows, parts=3, **named):
    return sorted(tuple(r) for r in pt.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(parts), **named).collect())


def _random(seed: int, convs: int) -> list[tuple]:
    r = random.Random(seed)
    texts = ["", None, "a", "é👍", "hello there", "x" * 50]
    rows = []
    for c in range(convs):
        for t in range(r.choice([1, 1, 2, 3, 5, 9, 12])):
            rows.append((c if c % 7 else c + 1000, r.choice([None, t, t, t]), r.choice(["user", "bot", None, ""]), r.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain(spark, seed):
    rows = _random(seed, 120)
    assert got(spark, rows) == plain(rows)


def test_long_conversation_over_many_ranges_and_long_copies(spark):
    long = [(10, t, "u", f"turn {t % 3}") for t in range(1500)] + [(11, t, "u", f"turn {t % 3}") for t in range(1500)]
    long += [(c, t, "u", f"turn {t % 3}") for c in (500, 502, 504) for t in range(40 + c % 5)]
    rows = long + _random(9, 40)
    assert got(spark, rows, 5) == plain(rows)


def test_same_texts_with_other_borders_are_different(spark):
    rows = [(0, 0, "a", "bc"), (1, 0, "ab", "c"), (2, 0, "", "abc"), (3, 0, "abc", None), (100, 0, "x", "a"), (100, 1, "x", "b"), (105, 0, "x", "ab")]
    assert got(spark, rows) == plain(rows)


def test_hard_rows(spark):
    rows = [(None, 1, "u", "lost"), (5, None, None, None), (5, None, None, None), (5, 1, "u", "tie b"), (5, 1, "u", "tie a"), (6, 9, "u", "z" * 100_000)]
    assert got(spark, rows) == plain(rows)
    extra = spark.createDataFrame([(1, 0, "u", "t", 1, 2, 3)], SCHEMA + ", d bigint, a bigint, parent bigint")
    assert len(pt.prefix_trie(extra).collect()) == len(plain([(1, 0, "u", "t")]))
    assert got(spark, []) == [] == plain([])
    copies = [(c, t, "u", "same") for c in range(400) for t in range(3)]
    assert got(spark, copies) == plain(copies)


def test_a_collision_takes_another_point(spark, monkeypatch):
    rows = _random(4, 30)
    real = pt.points
    monkeypatch.setattr(pt, "points", lambda seed: [1] * 4 if seed == 0 else real(seed))  # R = 1 forgets the order
    rows += [(2000, 0, "u", "p"), (2000, 1, "u", "q"), (2005, 0, "u", "q"), (2005, 1, "u", "p")]
    assert got(spark, rows) == plain(rows)


def test_fingerprints_are_a_monoid():
    r = random.Random(1)
    rs = pt.points(0)

    def of(seq):
        return len(seq), [sum(t * pow(x, m, pt.PRIME) for m, t in enumerate(seq, 1)) % pt.PRIME for x in rs]

    for _ in range(50):
        a, b = ([r.randrange(pt.PRIME) for _ in range(r.randint(0, 6))] for _ in "ab")
        (n, s), (m, t) = of(a), of(b)
        assert of(a + b) == (n + m, [(p + pow(x, n, pt.PRIME) * q) % pt.PRIME for p, x, q in zip(s, rs, t, strict=True)])
