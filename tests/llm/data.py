"""Small tables with hard cases."""

from __future__ import annotations

import random

WORDS = "the of and onre tion blely wher éan ß ñas heand inth ority quent morad silent café naïve über".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 60)) for _ in range(words))


def changed(text: str, seed: int, times: int) -> str:
    r, w = random.Random(seed), text.split(" ")
    for _ in range(times):
        k = r.randrange(len(w))
        w[k : k + 1] = r.choice(([], [f"new{r.randint(0, 9)}"], [w[k], "more"]))
    return " ".join(w)


def hard_documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, copies, near copies of many kinds."""
    texts = [None, "", " \n\t ", "one", "one two", "One  two", "\x00\u2028 x", "a\n\nb\n", prose(1, 6000)]
    texts += [prose(k, 40 + k) for k in range(12)]
    base = prose(100, 150)
    texts += [base] * 4 + [changed(base, s, s % 7) for s in range(60)]
    texts += [prose(200, 80) + "\n" + prose(201, 30) + "\n" + prose(k, 25) for k in range(300, 312)]
    texts += [changed(prose(200, 80), s, 1 + s % 3) + "\n" + prose(400 + s, 20) for s in range(25)]
    return [(k, t, "en" if k % 3 else None, None if k % 5 else "src", None if t is None else len(t)) for k, t in enumerate(texts)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
