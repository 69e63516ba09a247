"""Packing, quality rules, scoring and classification."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blocklog.llm import boosting, language_id, language_model, packing, quality_classifier, quality_rules
from blocklog.llm.queries import tokenizer_path
from blocklog.session import Staging
from tests.llm import plain
from tests.llm.data import SCHEMA, hard_documents, prose


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(hard_documents(), SCHEMA).withColumns({"tier": F.lit(1), "label": F.lit("x"), "score": F.lit(2)}).repartition(3).cache()


def test_encoder_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    want, encode, r = Tokenizer.from_file(tokenizer_path()), packing.Encoder(tokenizer_path()), random.Random(5)
    letters = " \n\t\x1c\x85\u3000ab's.1é!<|漢字"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(2000)] + ["a <|endoftext|> b", " " * 5000 + "x", "ab" * 5000]
    for text in texts:
        assert encode(text) == np.array(want.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


@pytest.mark.parametrize("block", [300, 2_000_000])
def test_packing_round_trip(docs, block):
    encode = packing.Encoder(tokenizer_path())
    texts = {d[0]: encode(d[1] or "") + b"\0\0\0\0" for d in hard_documents()}
    got = packing.pack_documents(docs, tokenizer_path(), block_tokens=block).collect()
    by_doc, by_sequence, by_step = {}, {}, {}
    for p in got:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_step.setdefault(p.step_group, set()).add((p.tier, p.sequence_id))
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            ids = texts[doc][4 * at : 4 * (at + p.length)]
            assert (p.start, p.ids_crc32, p.doc_tokens) == (at, zlib.crc32(ids), len(texts[doc]) // 4)
            at += p.length
        assert at == len(texts[doc]) // 4
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == pieces[0].tier <= 1024 and at & (at - 1) == 0
    for sequences in by_step.values():
        assert len({t for t, _ in sequences}) == 1 and sum(t for t, _ in sequences) <= max(packing.STEP_TOKENS, 1024)


def test_packing_nulls_and_empty(spark):
    rows = [(None, "a"), (1, None), (1, None)]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), tokenizer_path()).collect()
    assert Counter((p.doc_id, p.doc_tokens) for p in got if p.start == 0) == {(None, 2): 1, (1, 1): 2}
    assert packing.pack_documents(spark.createDataFrame([], "doc_id bigint, text string"), tokenizer_path()).count() == 0


def test_base_statistics():
    extra = ["a b c a b c d", "x x x x", "l\nl\n \n\nl\r\nl", "a|b <c> #$%", "é漢 \u00a0 \x0b\x0c"]
    for text in [d[1] for d in hard_documents()] + extra:
        assert quality_rules.statistics(text)[0] == plain.base_statistics(text)


def test_quality_rules_learn_and_judge(spark):
    r = random.Random(2)
    rows = [(k, prose(k, 80) if k % 3 else " ".join([r.choice("AB")] * 40 + [prose(k, 40).upper() + "!!"])) for k in range(300)]
    rows += [(None, prose(1, 90)), (900, None), (901, ""), (1, prose(1, 80))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"label": F.lit(7), "kept": F.lit(1)})
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(300)] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    model = quality_rules.fit_rules(docs, labels)
    got = quality_rules.quality_rules(docs, model).collect()
    assert len(got) == len(rows)
    for x in got:
        if x.doc_id is not None and x.doc_id < 300:
            assert x.kept == (x.doc_id % 3 > 0)
        assert not (x.kept and x.base_failed)
    assert {x.doc_id: x.base_failed for x in got}[900] and {x.doc_id: x.base_failed for x in got}[901]
    kept = quality_rules.quality_rules(docs, model, keep_columns=True)
    assert kept.columns == docs.columns and kept.count() == sum(x.kept for x in got)
    none = quality_rules.fit_rules(docs, labels.limit(0))
    assert quality_rules.quality_rules(docs.limit(0), none).count() == 0
    assert quality_rules.quality_rules(docs, none).where("kept").count() > 0


def test_trees_keep_the_monotone_order():
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + r.normal(0, 0.7, 600) > 0.3).astype(float)
    trees = boosting.fit(x, y, np.array([1, 0, -1]), trees=40)
    at = r.normal(size=(200, 3))
    for column, sign in ((0, 1), (2, -1)):
        scores = []
        for v in np.linspace(-3, 3, 25):
            moved = at.copy()
            moved[:, column] = v
            scores.append(trees.margin(moved))
        assert (sign * np.diff(np.array(scores), axis=0) >= -1e-12).all()
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.75


def test_language_model_base_and_normalisation(spark, docs):
    rows = hard_documents()
    counts = Counter()
    for i, text, *_ in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(plain.spaced(plain.lower(text)) + [""])
    n, v = sum(counts.values()), len(counts)
    for heavy in (5, 1000):
        got = {r.doc_id: r for r in language_model.score_documents(docs, classes=4, heavy=heavy).collect()}
        for i, text, *_ in rows:
            tokens = plain.spaced(plain.lower(text)) + [""]
            base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
            r = got[i]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
            assert r.base_score == pytest.approx(base, rel=1e-9)
            assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
    # The probabilities of all one-word texts, an unseen word and no word add up to one with those of longer texts cut off.
    stage = Staging(spark)
    fitted = language_model.fit(docs.select("text"), stage, classes=4, heavy=1000)
    m = fitted.model
    for before, last in ((5, 5), (5, 0), (4, 2)):
        logits = m.predict(np.array([before]), np.array([last])) @ m.target.T + m.bias
        p = np.exp(logits[0] - m.normalisers()[before * len(m.context) + last])
        assert p.sum() == pytest.approx(1, abs=1e-5)
    tokens, words = fitted.others()
    inside = sum(r.c - fitted.discount for r in fitted.counts.collect()) - sum(c - fitted.discount for _, c in fitted.heavy[: fitted.classes])
    assert (inside + fitted.discount * words) / tokens == pytest.approx(1)


def test_language_model_learns_order(spark):
    rows = [(k, " ".join(random.Random(k).choice(("red wine", "blue sky", "old oak")) for _ in range(60))) for k in range(140)]
    rows += [(None, "red wine"), (500, None)]
    got = language_model.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), classes=10).collect()
    out = [r for r in got if r.held_out and r.n_tokens > 10]
    assert out and all(r.score > r.base_score for r in out)
    assert language_model.score_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def _language(lang: str, seed: int) -> str:
    stems = {"aa": "ta to ti ke ko", "ab": "ta tu ti ke ki", "ba": "sch pf ung ach", "bb": "sch pf eit och"}[lang].split()
    r = random.Random(seed)
    return " ".join("".join(r.choice(stems) for _ in range(r.randint(1, 3))) for _ in range(60))


def test_language_id_held_out(spark):
    rows = [(k, _language(lang := ("aa", "ab", "ba", "bb")[k % 4], k), None if k % 17 == 0 else lang) for k in range(400)]
    rows += [(None, "ta to", "aa"), (900, None, None), (901, "12 ..", "aa"), (902, "", "bb")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumns({"label": F.lit(1), "score": F.lit(2)})
    model = language_id.fit_languages(docs)
    assert sorted(model.families) == [["aa", "ab"], ["ba", "bb"]] and sorted(model.pairs) == [("aa", "ab"), ("ba", "bb")]
    got = {r.doc_id: r for r in language_id.identify_languages(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(got[k].lang_pred == ("aa", "ab", "ba", "bb")[k % 4] for k in held) >= 0.95 * len(held)
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3
    none = language_id.fit_languages(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify_languages(docs, none).collect()} == {"und"}


def test_quality_classifier_held_out(spark):
    rows = [(k, prose(k, 70) if k % 3 else prose(k, 30) + " buy now now now $$$") for k in range(300)] + [(None, "x"), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"label": F.lit(1), "quality": F.lit(2)})
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(300)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality_classifier.score_quality(docs, quality_classifier.fit_quality(docs, labels)).collect()}
    held = [k for k in range(300) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(got[k].predicted == int(k % 3 > 0) for k in held) >= 0.95 * len(held)
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values()) and got[900].score == got[901].score
    none = quality_classifier.fit_quality(docs, labels.limit(0))
    assert quality_classifier.score_quality(docs.limit(0), none).count() == 0
