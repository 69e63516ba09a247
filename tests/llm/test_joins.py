"""Decontamination, line dedup and the Jaccard join against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blocklog.llm import decontamination, line_dedup, ngram_join
from tests.llm import plain
from tests.llm.data import SCHEMA, WORDS, changed, hard_documents, prose

ITEMS = [(1, prose(200, 80)[:300]), (2, "one two"), (3, None), (4, ""), (5, prose(5, 14)), (6, prose(5, 14)), (None, "one"), (7, " ".join(prose(1, 6000).split()[3000:3012]))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(hard_documents(), SCHEMA).repartition(5).cache()


def test_decontamination_equals_plain(spark, docs):
    items = [i for i in ITEMS if i[0] is not None]
    got = decontamination.decontaminate_report(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = plain.contamination([(d[0], d[1]) for d in hard_documents()], items)
    assert sorted(map(tuple, got)) == sorted(want)


def test_decontamination_hard_rows(spark):
    rows = [(None, "x one two y"), (None, "nothing"), (3, "one two"), (3, "one two"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"item_id": F.lit(1), "words": F.lit("w"), "pos": F.lit(0)})
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("doc_id", F.lit(9))
    got = {(r.doc_id, r.n_hit, r.n_items) for r in decontamination.decontaminate_report(docs, bench).collect()}
    assert got == {(None, 2, 2), (None, 0, 0), (3, 2, 2), (4, 0, 0)}
    left = decontamination.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.text or "" for r in left.collect()) == ["", "nothing"]
    assert decontamination.decontaminate_report(docs.limit(0), bench).count() == 0
    assert decontamination.decontaminate_report(docs, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_runs_no_python(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    plan = decontamination.decontaminate_report(docs.select("doc_id", "text"), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("short", [1, 3, 16])
def test_jaccard_equals_plain(docs, short):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, short=short).collect()}
    rows = hard_documents()
    components = plain.jaccard_components([(d[0], d[1]) for d in rows])
    assert got == {d[0]: (len(plain.shingles(d[1])), components[d[0]]) for d in rows}


@pytest.mark.parametrize("seed", range(2))
def test_jaccard_of_chains_of_copies(spark, seed):
    r = random.Random(seed)
    rows = [(0, prose(seed, 90))]
    for k in range(1, 90):
        rows.append((k, changed(r.choice(rows)[1], seed * 1000 + k, r.randint(0, 3))))
    got = {x.doc_id: x.component_id for x in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), short=2).collect()}
    assert got == plain.jaccard_components(rows)


def test_jaccard_hard_rows(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (2, "a  b C d"), (2, "a b c d"), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"key": F.lit(1), "n": F.lit(2), "rep": F.lit(0)})
    got = sorted(map(tuple, ngram_join.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(None, 2, None), (5, 2, 2), (2, 2, 2), (2, 2, 2), (7, 0, 7), (8, 0, 8)], key=str)
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0


def test_edit_distance():
    r = random.Random(1)
    for _ in range(3000):
        a = [r.randint(0, 3) for _ in range(r.randint(0, 9))]
        b = changed(" ".join(map(str, a)), r.randint(0, 99), r.randint(0, min(3, len(a) - 1))).split() if a else []
        b = [hash(x) % 5 if not x.isdigit() else int(x) for x in b]
        most = r.randint(0, 4)
        assert line_dedup.edit_distance(np.array(a, int), np.array(b, int), most) == min(plain.edits(a, b), most + 1)


@pytest.mark.parametrize("short", [1, 8])
def test_line_dedup_equals_plain(docs, short):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs, short=short).collect()}
    rows = hard_documents()
    gone = plain.removed_lines([(d[0], d[1]) for d in rows])
    assert {i: list(r.removed_lines) for i, r in got.items()} == gone
    for i, text, *_ in rows:
        kept = None if text is None else "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone[i])
        assert got[i].text == kept


def test_line_dedup_moved_and_edited_words(spark):
    r = random.Random(4)
    base = [r.choice(WORDS) + str(k) for k in range(24)]
    rows = [(0, " ".join(base))]
    for k in range(1, 60):
        w = base[:]
        for _ in range(r.randint(1, 4)):
            a = r.randrange(len(w))
            word = w.pop(a)
            if r.random() < 0.7:
                w.insert(r.randrange(len(w)), word if r.random() < 0.5 else f"x{r.randint(0, 3)}")
        rows.append((k, " ".join(w)))
    got = {x.doc_id: list(x.removed_lines) for x in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), short=2).collect()}
    assert got == plain.removed_lines(rows)


def test_lines_of_one_group_are_not_compared_across_their_centres(spark, monkeypatch):
    first = [f"w{k}" for k in range(80)]
    second = [f"v{k}" if k < 40 and k % 4 == 0 else w for k, w in enumerate(first)]  # too far from the first, with half of its segments
    rows, sizes, across = [], [], line_dedup._across
    for k in range(36):
        w = (first if k < 18 else second)[:]
        w[41 + k] = "x"
        rows.append((k, " ".join(w)))

    def counted(*args):
        pairs = across(*args)
        sizes.append(pairs.count())
        return pairs

    monkeypatch.setattr(line_dedup, "_across", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {x.doc_id: list(x.removed_lines) for x in line_dedup.dedup_lines(docs, most=None, short=2).collect()}
    assert got == plain.removed_lines(rows, most=99) and sizes[0] < 36  # the second group has 153 pairs


def test_lines_around_a_common_passage_are_not_paired_out(spark, monkeypatch):
    passage = [f"p{k}" for k in range(60)]
    rows, sizes, across = [], [], line_dedup._across
    for k in range(30):  # far from each other: all lack the words that the centre has beside the passage
        rows.append((k, " ".join([f"w{k}x{i}" for i in range(12)] + passage)))
    rows += [(100 + k, rows[k][1].replace("p30", f"q{k}")) for k in range(0, 30, 5)]

    def counted(*args):
        pairs = across(*args)
        sizes.append(pairs.count())
        return pairs

    monkeypatch.setattr(line_dedup, "_across", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {x.doc_id: list(x.removed_lines) for x in line_dedup.dedup_lines(docs, most=None, short=2).collect()}
    assert got == plain.removed_lines(rows, most=99) and sizes[0] < 36  # 435 pairs of lines that are far from each other


def test_documents_without_hits_are_not_shuffled(spark, docs):
    bench = spark.createDataFrame(ITEMS[:2], "item_id bigint, text string")
    left = decontamination.drop_contaminated(docs, bench)
    plan = left._jdf.queryExecution().executedPlan().toString()
    kept = {d[0] for d in hard_documents()} - {r.doc_id for r in decontamination.decontaminate_report(docs, bench).where("contaminated").collect()}
    assert plan.count("InMemoryTableScan") == 2 and "Union" in plan and {r.doc_id for r in left.collect()} == kept


def test_line_dedup_hard_rows(spark):
    line = "a line of six plain words"
    rows = [(None, line), (1, line + "\nshort"), (1, line + "\nshort"), (2, line), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"removed_lines": F.lit("x"), "k1": F.lit(1), "line": F.lit(2)})
    got = line_dedup.dedup_lines(docs)
    assert sorted((str(r.doc_id), r.text, tuple(r.removed_lines)) for r in got.select("doc_id", "text", "removed_lines").collect() if r.text is not None) == [
        ("1", line + "\nshort", ()), ("1", line + "\nshort", ()), ("2", "", (0,)), ("4", "", ()), ("None", "", (0,)),
    ]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
