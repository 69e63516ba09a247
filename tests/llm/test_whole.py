"""Jobs that must be done whole, against brute force: near copies of the pipeline, long and short lines, copied pages."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as cp
from blocklog.llm import html_text, line_dedup, ngram_join
from blocklog.llm.queries import op2_line_dedup
from tests.llm import plain
from tests.llm.data import SCHEMA, changed, hard_documents, prose


def _components(docs: list[tuple], size: int, percent: int) -> dict:
    sets, groups = [(i, plain.shingles(t, size)) for i, t in docs], plain.Groups()
    for k, (i, a) in enumerate(sets):
        groups.find(i)
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                groups.join(i, j)
    return {i: groups.find(i) for i, _ in docs}


def test_near_copies_of_five_words_at_80_percent_go(spark):
    rows = [(d[0], d[1], d[2], d[3], d[4]) for d in hard_documents()]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = {i for i, c in _components([r[:2] for r in rows], 5, 80).items() if i == c}
    at_90 = {i for i, c in _components([r[:2] for r in rows], 3, 90).items() if i == c}
    assert want != at_90
    assert {r.doc_id for r in cp.keep_one_of_each_group(spark, docs, "").collect()} == want


@pytest.mark.parametrize("short", [1, 4, 64])
def test_jaccard_at_80_percent_equals_brute_force(spark, short):
    r = random.Random(short)
    rows = [(0, prose(7, 120))]
    for k in range(1, 110):
        rows.append((k, changed(r.choice(rows)[1], k, r.randint(0, 5))))
    rows += [(200 + k, prose(900, 80) + " " + prose(k, 10 + k % 20)) for k in range(40)] + [(300 + k, prose(9, k)) for k in range(1, 12)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=5, percent=80, short=short)
    assert {x.doc_id: x.component_id for x in got.collect()} == _components(rows, 5, 80)


def _long_lines(seed: int) -> list[tuple]:
    r = random.Random(seed)
    rows = [(0, prose(seed, 100)), (1, prose(seed + 1, 34)), (2, prose(seed + 2, 29)), (3, "same again\n" + prose(seed + 3, 12))]
    for k in range(4, 70):
        rows.append((k, changed(r.choice([t for _, t in rows if len(t) > 150]), seed * 100 + k, r.randint(0, 12))))
    phrase = prose(seed + 4, 40)  # a long list of lines that are not alike as wholes
    rows += [(100 + k, phrase + " " + prose(k, 45)) for k in range(12)] + [(200 + k, text) for k, text in enumerate(("same again", "}", "}", "one"))]
    return rows


@pytest.mark.parametrize("seed, short", [(11, 1), (12, 3), (13, 8)])
def test_edits_grow_with_the_line_and_short_copies_go(spark, seed, short):
    rows = _long_lines(seed)
    want = plain.removed_lines(rows, least=1, most=10**9)
    assert want != plain.removed_lines(rows)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), most=None, least=1, short=short)
    assert {x.doc_id: list(x.removed_lines) for x in got.collect()} == want


def test_stage_and_query_take_long_lines_whole(spark, tmp_path):
    rows = [(i, t, "en", "s", len(t)) for i, t in _long_lines(14)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    gone = plain.removed_lines([r[:2] for r in rows], least=1, most=10**9)
    assert {r.doc_id: list(r.removed_lines) for r in op2_line_dedup(spark, str(tmp_path)).collect()} == gone
    left = {i: "\n".join(line for k, line in enumerate(t.split("\n")) if k not in gone[i]) for i, t, *_ in rows}
    assert {r.doc_id: r.text for r in cp.drop_repeated_lines(spark, docs, "").collect()} == {i: t for i, t in left.items() if plain.spaced(t)}


def test_copies_of_a_page_without_landmarks_keep_their_text(spark):
    page = "<body><div class=top><p>Site name</p></div><div class=story><p>{}</p><p>{}</p></div></body>"
    rows = [(k, f"http://d.org/{k}", page.format("copied story", "copied end")) for k in range(12)]
    rows += [(k, f"http://d.org/{k}", page.format(f"story {k} " + "word " * k, f"end {k}")) for k in range(12, 17)]
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {got[k] for k in range(12)} == {"copied story copied end"}
    assert all(got[k].endswith(f"end {k}") and "Site name" not in got[k] for k in range(12, 17))
