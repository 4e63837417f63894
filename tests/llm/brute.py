"""Plain Python versions of the operators' rules, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def grams(text):
    w = WORD.findall(lower(text))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def rules(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def line_dedup(texts, least=10):
    """Texts without the lines whose key ``least`` of them hold."""
    held = Counter(k for t in texts for k in {line_key(x) for x in (t or "").split("\n")} if k)
    return ["\n".join(x for x in (t or "").split("\n") if held[line_key(x)] < least) for t in texts]


def components(texts):
    """The class of each text, a number; None for texts without words."""
    sets = [grams(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    pairs = {(i, j) for h in holders.values() for i in h for j in h if i < j}
    for i, j in pairs:
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) if s else None for i, s in enumerate(sets)]


def contained(texts, items):
    """(text number, item number, shared, size) at three quarters or more."""
    wanted = [grams(t) for t in items]
    out = []
    for i, t in enumerate(texts):
        own = grams(t)
        out += [(i, j, len(own & w), len(w)) for j, w in enumerate(wanted) if w and 4 * len(own & w) >= 3 * len(w)]
    return out


def without_repeats(rows, length=100):
    """(doc_id, bytes, removed, spans, digest of the rest) of (doc_id, text) rows."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        body = (text or "").encode()
        gone = [False] * len(body)
        for i in range(len(body) - length + 1):
            window = body[i:i + length]
            if window in seen:
                gone[i:i + length] = [True] * length
            seen.add(window)
        rest = bytes(b for b, g in zip(body, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(body), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out
