"""A plain-Python statement of what inspection must give, for small inputs."""

import re
import unicodedata
from collections import Counter

LEAD = set(" \t\n\r.,;:，。；：、)]】）　")
TRAIL = set(" \t\n\r.,;:，。；：、([【（　")


def norm(t):
    t = re.sub("[​-‏‪-‮⁠﻿]", "", t.strip())
    t = " ".join(t.split())
    while t and t[0] in LEAD:
        t = t[1:]
    while t and t[-1] in TRAIL:
        t = t[:-1]
    return t


def noisy(t):
    n = norm(t)
    return n in ("", "无") or not any(unicodedata.category(c)[0] in "LN" for c in n)


def pieces(cell):
    cell = (cell or "").strip()
    return [] if cell.lower() == "nan" else [p.strip() for p in cell.split("|") if p.strip()]


def usable(code):
    return "ERROR" not in code and code.lower() not in ("none", "nan")


def top(counter, first):
    return max(counter, key=lambda k: (counter[k], [-x for x in first[k]]))


def inspect(rows, n_cols):
    """rows: list of (record_id, [(term_cell, code_cell)] * n_cols) in order."""
    flags, count, first, spell, spell_first = [], {}, {}, {}, {}
    for rid, cells in rows:
        for j, (tc, cc) in enumerate(cells[:n_cols]):
            terms, codes, col = pieces(tc), pieces(cc), f"diagnosis{j + 1}"
            if not terms and not codes:
                continue
            if not terms:
                flags.append((rid, col, "MISSING_TERM", "", "|".join(codes), None, None))
                continue
            if len(terms) != len(codes):
                for t in terms:
                    if noisy(t):
                        flags.append((rid, col, "NOISE_TERM", t, "", "", 0))
                terms = [t for t in terms if not noisy(t)]
                if not codes:
                    if terms:
                        flags.append((rid, col, "MISSING_CODE", "|".join(terms), "", None, None))
                    continue
                if len(terms) != len(codes):
                    flags.append((rid, col, "TERM_CODE_LENGTH_MISMATCH", "|".join(terms), "|".join(codes), None, None))
                    continue
            for k, (t, c) in enumerate(zip(terms, codes)):
                n, at = norm(t), (rid, j, k)
                if noisy(t):
                    flags.append((rid, col, "NOISE_TERM", t, c, "", 0))
                    continue
                if usable(c):
                    count.setdefault(n, Counter())[c] += 1
                    first.setdefault(n, {}).setdefault(c, at)
                    spell.setdefault(n, Counter())[t] += 1
                    spell_first.setdefault(n, {}).setdefault(t, at)
                    continue
                best, times = "", 0
                if n in count:
                    best = top(count[n], first[n])
                    times = count[n][best]
                kind = "ERROR_CODE" if "ERROR" in c else "EMPTY_OR_NONE_CODE"
                flags.append((rid, col, kind, t, c, best, times))
    for n in sorted(count, key=lambda n: min(first[n].values())):
        if len(count[n]) > 1:
            best = top(count[n], first[n])
            shown = top(spell[n], spell_first[n])
            for c in sorted(count[n], key=lambda c: first[n][c]):
                if c != best:
                    flags.append((None, "ALL", "TERM_MULTI_CODE", shown, c, best, count[n][best]))
    return flags, count
