"""Plain sequential versions of the ordered operators, to check the distributed ones against."""


def gate(rows, tip=None):
    """rows: (seq, height, hash, prev_hash, error); tip: (out_seq, height, hash) or None."""
    out = []
    for seq, height, hash_, prev, error in rows:
        if error is not None:
            out.append((seq, "CORRUPT", None, tip))
            continue
        before = tip
        if tip is not None and height <= tip[1]:
            label = "LOW_HEIGHT"
        elif tip is not None and prev != tip[2]:
            label = "HASH_MISMATCH"
        else:
            label = "ACCEPTED"
            tip = ((tip[0] if tip else 0) + 1, height, hash_)
        out.append((seq, label, tip[0] if label == "ACCEPTED" else None, before))
    return out


def strict_sequence(seqs, start, strict):
    last, out = start - 1, []
    first = True
    for s in seqs:
        keep = s == last + 1 or (first and not strict)
        if keep:
            last, first = s, False
        out.append(keep)
    return out


def wrong_runs(flags):
    run, out = 0, []
    for wrong in flags:
        run = run + 1 if wrong else 0
        out.append(run)
    return out


def compare(a, b, mode, skip):
    """The merge of two decoded sides until the first finding that is not skipped.

    a, b: lists of (seq, height, hash, prev_hash, key). Returns (findings, halted).
    """
    findings = []
    sides = {"A": list(a), "B": list(b)}
    at = {"A": 0, "B": 0}
    cur = {"A": None, "B": None}

    def fetch(name):
        prev = cur[name]
        if at[name] >= len(sides[name]):
            return "end"
        row = sides[name][at[name]]
        at[name] += 1
        fatal = False
        if prev is not None:
            kind = None
            if row[1] < prev[1]:
                kind = "DOWNJUMP"
            elif row[1] == prev[1]:
                kind = "DUPLICATE" if row[4] == prev[4] else "UNEQUALDUPLICATE"
            elif row[1] > prev[1] + 1 and (mode == "flat" or row[3] != prev[2]):
                kind = "GAP"
            if kind:
                findings.append((name, kind, prev[0], row[0]))
                ok = skip[kind] and (kind != "UNEQUALDUPLICATE" or skip["DUPLICATE"])
                fatal = not ok
        cur[name] = row
        return "fatal" if fatal else "ok"

    while True:
        x, y = cur["A"], cur["B"]
        if x is None or y is None:
            name = "A" if x is None else "B"
        else:
            name = "A" if x[1] <= y[1] else "B"
            if x[1] == y[1] and x[4] != y[4]:
                findings.append(("AB", "DISCREPANCY", x[0], y[0]))
                if not skip["DISCREPANCY"]:
                    return findings, True
        state = fetch(name)
        if state == "fatal":
            return findings, True
        if state == "end":
            return findings, False


def absent(stored, start, end):
    out, cur = [], start
    for s in sorted(x for x in stored if start <= x < end):
        if s > cur:
            out.append((cur, s - 1))
        cur = s + 1
    if cur < end:
        out.append((cur, end - 1))
    return out
