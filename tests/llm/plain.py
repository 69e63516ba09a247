"""Plain single-process versions of the text operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from hashlib import sha256

_SPACED = re.compile(r"[^\x20\x09-\x0D]+")
_ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text: str | None) -> list[str]:
    return _SPACED.findall(text or "")


def benchmark_words(text: str | None) -> list[str]:
    return _ALNUM.findall(lower(text))


def contamination(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    out = []
    for doc_id, text in docs:
        w = benchmark_words(text)
        hit, found = set(), set()
        for item_id, item in items:
            iw = benchmark_words(item)
            m = min(window, len(iw))
            for s in range(len(iw) - m + 1) if m else ():
                for p in range(len(w) - m + 1):
                    if w[p : p + m] == iw[s : s + m]:
                        hit.update(range(p, p + m))
                        found.add(item_id)
        names = ",".join(sorted(str(i) for i in found))
        out.append((doc_id, len(w), len(hit), len(found), sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def shingles(text: str | None, size: int = 3) -> frozenset:
    w = spaced(lower(text))
    return frozenset(tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)) if w else frozenset()


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def jaccard_components(docs: list[tuple], size: int = 3, percent: int = 90) -> dict:
    sets = [(i, shingles(t, size)) for i, t in docs]
    groups = Groups()
    for k, (i, a) in enumerate(sets):
        groups.find(i)
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                groups.join(i, j)
    return {i: groups.find(i) for i, _ in docs}


def edits(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def removed_lines(docs: list[tuple], least: int = 5, most: int = 2, per: int = 10) -> dict:
    """Line numbers that go, by document; ids are distinct and not null."""
    where = defaultdict(list)
    for i, text in sorted(docs):
        for k, line in enumerate((text or "").split("\n")):
            if len(w := tuple(spaced(line))) >= least:
                where[w].append((i, k))
    groups, lines = Groups(), sorted(where, key=lambda w: where[w][0])
    name = {w: where[w][0] for w in lines}
    for k, a in enumerate(lines):
        groups.find(name[a])
        for b in lines[:k]:
            if edits(a, b) <= min(min(len(a), len(b)) // per, most):
                groups.join(name[a], name[b])
    gone = {i: [] for i, _ in docs}
    for w, places in where.items():
        for place in places:
            if place != groups.find(name[w]):
                gone[place[0]].append(place[1])
    return {i: sorted(v) for i, v in gone.items()}


def repeat_words(w: list[str]) -> int:
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    return len({i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)})


def base_statistics(text: str | None) -> tuple:
    w = spaced(text)
    lines = [line for line in (text or "").split("\n") if spaced(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    dup = sum(line in lines[:k] for k, line in enumerate(lines))
    return len(w), sum(map(len, w)), symbols, dup, repeat_words(w)


def url_templates(leaves: dict, fan_out: int, share: float, unlike: float, prior: float, usual: float) -> dict:
    """(host, shape) to (template, purity) for leaves of (n, block, allow), one host and one node after the other."""
    import xxhash

    def differ(a, b):
        a, b = zip(*[(x, y) for x, y in zip(a, b) if x + y > 0]) if any(a) and any(b) else ((), ())
        if len(a) < 2:
            return 0.0
        a, b = [x + 0.5 for x in a], [y + 0.5 for y in b]
        total, chi = sum(a) + sum(b), 0.0
        for row in (a, b):
            for k, x in enumerate(row):
                expected = sum(row) * (a[k] + b[k]) / total
                chi += (x - expected) ** 2 / expected
        return (chi - (len(a) - 1)) / (2 * (len(a) - 1)) ** 0.5

    out, purity = {}, {}

    def node(host, rows, level, template, above):
        block, known = sum(r[2] for r in rows), sum(r[2] + r[3] for r in rows)
        here = (block + prior * above) / (known + prior)
        if len(rows) == 1 and level < len(rows[0][0]):
            parts, _, b, a, shape = rows[0]
            for seg in parts[level:]:
                template, here = (*template, seg), (b + prior * here) / (a + b + prior)
            out[host, shape] = template, here
            return
        for r in rows:
            if len(r[0]) <= level:
                out[host, r[4]] = template, here
        rows = [r for r in rows if len(r[0]) > level]
        counts = Counter()
        for r in rows:
            counts[r[0][level]] += r[1]
        total = sum(counts.values())
        named = {s: "*" if len(counts) > fan_out and n < share * total else s for s, n in counts.items()}
        branches = defaultdict(lambda: [0, [0, 0], [0] * 32])
        for parts, n, b, a, _ in rows:
            branch = branches[named[parts[level]]]
            following = parts[level + 1] if len(parts) > level + 1 else "/"
            branch[0] += n
            branch[1][0] += b
            branch[1][1] += a
            branch[2][xxhash.xxh64_intdigest(following.encode(), seed=42) % 32] += n  # 2**64 is a multiple of 32
        groups = []
        for seg in sorted(branches, key=lambda s: (-branches[s][0], s)):
            _, labels, follows = branches[seg]
            for names, ls, fs in groups:
                if seg != "*" and names != ["*"] and differ(labels, ls) <= unlike and differ(follows, fs) <= unlike:
                    names.append(seg)
                    ls[:], fs[:] = [x + y for x, y in zip(ls, labels)], [x + y for x, y in zip(fs, follows)]
                    break
            else:
                groups.append(([seg], list(labels), list(follows)))
        for names, *_ in groups:
            below = [r for r in rows if named[r[0][level]] in names]
            node(host, below, level + 1, (*template, "|".join(sorted(names))), here)

    for host in {h for h, _ in leaves}:
        rows = [(shape.removeprefix("/").split("/"), *counts, shape) for (h, shape), counts in leaves.items() if h == host]
        node(host, rows, 0, (), usual)
    return out
