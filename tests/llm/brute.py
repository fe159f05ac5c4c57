"""Plain versions of the operators' contracts, on lists of (id, text)."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

SPACE = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
NON_SPACE = re.compile("[^ \t-\r]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, size=10):
    windows = defaultdict(set)
    for i, text in items:
        w = ALNUM.findall((text or "").translate(LOW))
        for at in range(max(len(w) - size, 0) + 1):
            if w:
                windows[tuple(w[at:at + size])].add(str(i))
    out = []
    for i, text in docs:
        w = ALNUM.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if (g := tuple(w[at:at + n])) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[g]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def line_dedup(docs, least=10, last=2 ** 63):
    key = lambda line: line.strip(SPACE).translate(LOW)
    owner, holders = {}, defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            i_ = last if i is None else i
            holders[key(line)].add(i_)
            owner[key(line)] = min(owner.get(key(line), i_), i_)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        i_ = last if i is None else i
        kept = [x for x in lines if len(key(x)) < least or len(holders[key(x)]) < 2 or owner[key(x)] == i_]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def components(docs, percent=80, size=5):
    """(id, size of set, component); ids are distinct."""
    sets = {}
    for i, text in docs:
        w = NON_SPACE.findall((text or "").translate(LOW))
        sets[i] = ({tuple(w[a:a + size]) for a in range(len(w) - size + 1)} or {tuple(w)}) if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return [(i, len(sets[i]), find(i)) for i in sets]


def quality(text):
    text = text or ""
    w = NON_SPACE.findall(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeat = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat))
