"""Edit fingerprints against a plain walk, successors against a plain order, bands against all pairs."""

from __future__ import annotations

import random
from hashlib import sha256
from itertools import combinations

import numpy as np
import pytest

from blocklog.llm import edit_fingerprints as ef
from blocklog.llm.queries import op12_edit_fingerprints
from blocklog.llm.text import mix
from tests.llm.data import SCHEMA, changed, hard_documents, prose


def plain_print(text: str) -> str:
    """The walk step by step, by the tables' definition: a character is left when its random move says so."""
    parts = []
    for walk in range(ef.WALKS):
        embedded = []
        for c in map(ord, text):
            kind = int(mix(np.array([c], np.uint64))[0]) >> 56
            while True:
                cell = len(embedded) % ef.PERIOD * 256 + kind
                embedded.append(c)
                if int(mix(np.array([cell + ((walk + 1) << 40)], np.uint64))[0]) >> 63:
                    break
        stride = 1
        while -(-len(embedded) * 8 // stride) > ef.BITS:
            stride *= 2
        bits = []
        for t in range(0, len(embedded) * 8, stride):
            step = int(mix(np.array([t // 8 + ((walk + 1) << 48)], np.uint64))[0])
            value = (embedded[t // 8] * 0x9E3779B97F4A7C15 + step) % 2**64
            bits.append(int(mix(np.array([value], np.uint64))[0]) >> (t % 8) & 1)
        parts.append(f"{len(embedded):x}-{np.packbits(np.array(bits, np.uint8)).tobytes().hex()}")
    return ".".join(parts)


def plain_rows(rows: list[tuple]) -> dict:
    """(doc_id, n_chars, edited text, next text) by text; ids are distinct."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        out[i] = (len(text), ef.edited(text, after), text, after)
    return out


def test_walks_equal_plain():
    texts = ["", "a", "é👍", prose(1, 3), "aaaaaaaaaaaaaaaaaaaaaaaa", prose(2, 60)] + [prose(k, k) for k in range(40)]
    assert ef.Walker().prints(texts) == [plain_print(t) for t in texts]


@pytest.mark.parametrize("parts", [1, 6])
def test_successors_equal_plain(spark, parts):
    rows = [(d[0] * 3 - 50, d[1]) for d in hard_documents()] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    want = plain_rows(rows)
    got = {r.doc_id: r for r in ef.edit_fingerprints(docs).collect()}
    assert got.keys() == want.keys()
    texts = sorted({t for w in want.values() for t in w[1:]})
    prints = dict(zip(texts, ef.Walker().prints(texts), strict=True))
    for i, (n, edited, text, after) in want.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (prints[text], prints[edited])
        assert (r.near_edited, r.near_next) == (ef.likeness(prints[text], prints[edited]), ef.likeness(prints[text], prints[after]))


def test_likeness_follows_the_edits():
    w, r, close = ef.Walker(), random.Random(3), []
    for seed in range(20):
        text = prose(seed, 300)
        few, many, other = changed(text, seed, 3), changed(text, seed, 120), prose(seed + 500, 300)
        a, b, c, d = w.prints([text, few, many, other])
        close.append(ef.likeness(a, b))
        assert ef.likeness(a, a) == 1.0 and ef.likeness(a, b) > max(0.3, ef.likeness(a, c)) and ef.likeness(a, d) < 0.45
        assert all(0 <= ef.likeness(x, y) == ef.likeness(y, x) <= 1 for x, y in combinations((a, b, c, d), 2))
        half = ef.edited(text, other)
        x, y = w.prints([text[: r.randint(1, 40)], half])
        assert ef.likeness(a, y) > ef.likeness(a, d) and ef.likeness(a, x) < 0.3
    assert sum(close) / len(close) > 0.75 and sorted(close)[2] > 0.5
    empty, one = w.prints(["", "x"])
    assert ef.likeness(empty, empty) == 1.0 and ef.likeness(empty, one) == 0.0


def test_hard_rows(spark):
    rows = [(None, "a b", 1), (None, None, 2), (5, "same", 3), (5, "same", 4), (5, "another", 5), (6, None, 6), (7, "z" * 400_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int")
    got = ef.fingerprint_documents(docs).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == [(-1, 0), (-1, 3), (5, 4), (5, 4), (5, 7), (6, 0), (7, 400_000)]
    assert len({r.fingerprint for r in got if r.doc_id == 5 and r.n_chars == 4}) == 1
    assert ef.fingerprint_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    one = ef.edit_fingerprints(spark.createDataFrame([(1, "alone here")], "doc_id bigint, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == sha256(ef.edited("alone here", "alone here").encode()).hexdigest()
    many = spark.range(4000).selectExpr("3L as doc_id", "repeat('copied text ', 20) as text").repartition(5)
    assert ef.edit_fingerprints(many).groupBy("doc_id", "near_next").count().collect()[0]["count"] == 4000


def test_bands_find_near_texts(spark):
    r, rows = random.Random(8), [(k, prose(k, 20 + k * 3)) for k in range(150)]
    for k in range(150, 400):
        rows.append((k, changed(r.choice(rows)[1], k, r.randint(0, 1))))
    base = prose(900, 200)
    rows += [(1000 + k, changed(base, k, 1)) for k in range(60)]  # long lists
    prints = ef.Walker().prints([t for _, t in rows])
    near = [(a, b) for a, b in combinations(range(len(rows)), 2) if prints[a] != prints[b] and ef.likeness(prints[a], prints[b]) >= ef.LIKENESS]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in [*near, *((a, b) for a, b in combinations(range(len(rows)), 2) if prints[a] == prints[b])]:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {x.doc_id: x.group_id for x in ef.fingerprint_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    ids = [i for i, _ in rows]
    linked = [(a, b) for a, b in near if got[ids[a]] == got[ids[b]]]
    assert len(near) > 300 and len(linked) >= 0.95 * len(near)
    for k, i in enumerate(ids):  # nothing is linked that comparing all pairs would not link
        assert find(ids.index(got[i])) == find(k)


def test_bands_follow_the_number_of_texts():
    for n in (10, 10**5, 10**9):
        width, bands = ef.band_plan(n, 0.9, 0.95)
        assert 1 - (1 - 0.95**width) ** bands >= 0.95 and n * 0.55**width < 1


def test_query(spark, sf_dir):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = plain_rows(docs)
    got = op12_edit_fingerprints(spark, sf_dir).collect()
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in got} == {(i, n, sha256(e.encode()).hexdigest()) for i, (n, e, *_) in want.items()}
    prints = {r.doc_id: r.fingerprint for r in got}
    by_text = {}
    for i, (_, _, text, _) in want.items():
        assert by_text.setdefault(text, prints[i]) == prints[i]
    assert sum(r.near_edited > r.near_next for r in got) > 0.97 * len(got)


def test_long_lists_lose_no_link_of_members_that_are_far_from_their_centre(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(240))]
    while len(texts) < 150:  # each is some edits away from one before it
        chars = list(rng.choice(texts))
        for _ in range(3):
            chars[rng.randrange(180, 240)] = rng.choice("xyz")
        texts.append("".join(chars))
    prints = ef.Walker().prints(texts)
    rows = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fingerprint string")
    groups = [sorted(map(tuple, ef.near_groups(rows, short=n).collect())) for n in (1, 10**6)]
    assert groups[0] == groups[1]
