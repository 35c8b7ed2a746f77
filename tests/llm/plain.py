"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def suffix_dedup(rows, n=200):
    count = Counter(b[k : k + n] for _, x in rows for b in [(x or "").encode()] for k in range(len(b) - n + 1))
    out = []
    for i, x in rows:
        b = (x or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if count[b[k : k + n]] > 1:
                gone[k : k + n] = b"\1" * n
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def passages(rows, k=20):
    """(id, words, removed, kept words); rows in the order that decides which comes first."""
    seen, out = set(), []
    for i, x in rows:
        w = WORD.findall(x or "")
        gone = [False] * len(w)
        for s in range(len(w) - k + 1):
            t = tuple(w[s : s + k])
            if t in seen:
                gone[s : s + k] = [True] * k
            seen.add(t)
        out.append((i, len(w), sum(gone), [a for a, g in zip(w, gone) if not g]))
    return out


def jaccard(rows, percent=90, words=3):
    """(id, set size, component) for rows with different ids."""
    sets = {}
    for i, x in rows:
        w = WORD.findall((x or "").translate(LOWER))
        sets[i] = {tuple(w[a : a + words]) for a in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(rows, items, size=13):
    out = []
    for i, x in rows:
        w, hit, found = item_words(x), set(), set()
        for item, text in items:
            q = item_words(text)
            for s in range(max(1, len(q) - size + 1) if q else 0):
                g = q[s : s + size]
                for a in range(len(w) - len(g) + 1):
                    if w[a : a + len(g)] == g:
                        hit.update(range(a, a + len(g)))
                        found.add(str(item))
        names = ",".join(sorted(found))
        out.append((i, len(w), len(hit), len(found), sha(names), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def damaged(turns):
    """{conv: rows (turn, role, text)} from (conv, turn, role, text), by the contract's hash."""
    out = {}
    for conv, turn, role, text in turns:
        rows = out.setdefault(conv, [])
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) by trying all edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.strip(" \t\n\v\f\r")
        fault = "" if said and said[-1] in ".!?" else "t"
        faults.append("b" if not said else "d" if (role, text) in seen else fault)
        seen.add((role, text))
    fits = lambda s: re.fullmatch("s?(ua)*u?", s) is not None
    # Of the roles so far only the last matters; no more than two turns are added in one place.

    def put(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value

    def adding(table):
        for _ in range(3):
            for s, (c, a, r) in list(table.items()):
                for role in ("user", "assistant"):
                    if fits(("s" if s == "s" else {"": "", "u": "u", "a": "ua"}[s]) + role[0]):
                        put(table, role[0], (c + 5, a + "I", [*r, f"{role}:"]))
        return table

    state = adding({"": (0, "", [])})
    for (_, role, text), f in zip(rows, faults):
        then = {}
        for s, (c, a, r) in state.items():
            put(then, s, (c + 2, a + "D", r))
            if f in "bd" and f:
                continue
            for new, cost, edit in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                before = "s" if s == "s" else {"": "", "u": "u", "a": "ua"}[s]
                if new[:1] and fits(before + new[0]):
                    put(then, new[0], (c + cost + (5 if f else 0), a + edit, [*r, f"{new}:{text}"]))
        state = adding(then)
    cost, audit, lines = min((state[s] for s in ("", "a") if s in state), key=lambda x: x[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    count = [faults.count(f) for f in "bdt"]
    return (gaps, *count, illegal, cost, audit, sha("\n".join(lines)))
