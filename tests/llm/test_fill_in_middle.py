"""Fill-in-middle against a plain version, with texts of every kind and sentinels across pieces."""

from __future__ import annotations

import random
from hashlib import sha256

import pytest

from blocklog.llm import fill_in_middle as fim
from blocklog.llm.queries import op11_fill_in_middle
from tests.llm.data import SCHEMA, hard_documents


def plain(doc_id, text) -> tuple:
    text = text or ""
    n = len(text)
    h = sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    whole = sha256(text.encode()).hexdigest()
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, whole, whole, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    form, out = ("spm", f"<S>{suf}<P>{pre}<M>{mid}") if h4 % 100 < 20 else ("psm", f"<P>{pre}<S>{suf}<M>{mid}")
    return doc_id, n, form, len(pre), len(mid), sha256(out.encode()).hexdigest(), whole, out


def _rows() -> list[tuple]:
    r = random.Random(5)
    pieces = ["<", "P", ">", "S", "M", "<<", "<P", "S>", "é", "👍", "é", " ", "\n", "ab"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 40))) for _ in range(300)]
    texts += ["<" * k for k in range(12)] + ["x<P>y", "<M>", "👍" * 50, "ab" * 30_000]
    return list(enumerate(texts)) + [(d[0] + 1000, d[1]) for d in hard_documents()]


@pytest.mark.parametrize("units", [1, 2, 5, fim.UNITS])
def test_equals_plain(spark, units):
    rows = [(i, t if units > 2 else (t or "")[:200]) for i, t in _rows()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: tuple(r) for r in fim.fill_in_middle(docs, units=units).collect()}
    assert got == {i: plain(i, t) for i, t in rows}
    forms = [g[2] for g in got.values()]
    assert {"plain", "psm", "spm"} == set(forms)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, "some text here", 1, "x"), (None, None, 2, "x"), (7, "twice", 3, "x"), (7, "twice", 4, "y"), (7, "another", 5, "z"), (8, None, 6, None), (8, "", 7, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n bigint, form string")
    for parts in (1, 4):
        got = sorted(map(str, (tuple(r) for r in fim.fill_in_middle(docs.repartition(parts)).collect())))
        assert got == sorted(str(plain(i, t)) for i, t, *_ in rows)


def test_empty_table_and_many_copies(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
    many = spark.range(5000).selectExpr("3L as doc_id", "repeat('copied text ', 20) as text").repartition(7)
    assert fim.infill_pieces(many).count() < 100
    got = fim.fill_in_middle(many).groupBy("doc_id", "output", "restored_sha256").count().collect()
    assert [(r.doc_id, r.output, r["count"]) for r in got] == [(3, plain(3, "copied text " * 20)[7], 5000)]


def test_one_shuffle(spark, sf_dir):
    plan = op11_fill_in_middle(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan


def test_query_equals_plain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in op11_fill_in_middle(spark, sf_dir).collect()}
    assert got == {d.doc_id: plain(d.doc_id, d.text)[:7] for d in docs}
