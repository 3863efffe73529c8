"""Slow versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict


class Groups:
    """Union-find; the root of a group is its least member."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def shingles(text, size):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]
    n = min(size, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def near_duplicates(rows, size, num=80, den=100):
    """doc_id -> (set size, least linked doc_id); all pairs of distinct sets are compared."""
    sets = {i: frozenset(shingles(t, size)) for i, t in rows}
    groups, ids = Groups(), defaultdict(list)
    for i, s in sets.items():
        groups.root(i)
        if s:
            ids[s].append(i)
    distinct = list(ids)
    for s in distinct:
        for i in ids[s][1:]:
            groups.join(ids[s][0], i)
    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if min(len(a), len(b)) * den < max(len(a), len(b)) * num:
                continue
            common = len(a & b)
            if common * den >= (len(a) + len(b) - common) * num:
                groups.join(ids[a][0], ids[b][0])
    return {i: (len(s), groups.root(i)) for i, s in sets.items()}


def repeats(texts, length=100):
    """Of each text, in the order given, the flags of bytes that an earlier string covers."""
    seen, found = set(), []
    for raw in texts:
        flags = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            piece = raw[at : at + length]
            if piece in seen:
                flags[at : at + length] = b"\x01" * length
            seen.add(piece)
        found.append(flags)
    return found


def runs(flags):
    return [m.span() for m in re.finditer(b"\x01+", bytes(flags))]


def whole_characters(raw, spans):
    """The spans without characters that they hold only a part of."""
    kept = []
    starts = [k for k, b in enumerate(raw) if b & 0xC0 != 0x80] + [len(raw)]
    for begin, end in spans:
        inside = [s for s in starts if begin <= s <= end]
        if len(inside) > 1:
            kept.append((inside[0], inside[-1]))
    return kept


def cut(raw, spans):
    out, at = b"", 0
    for begin, end in spans:
        out += raw[at:begin]
        at = end
    return out + raw[at:]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contamination(text, items, size=13):
    """(n_words, n_hit, sorted item ids as strings)."""
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        theirs = words(item_text)
        n = min(size, len(theirs))
        for k in range(len(theirs) - n + 1 if n else 0):
            window = theirs[k : k + n]
            for at in range(len(own) - n + 1):
                if own[at : at + n] == window:
                    hit.update(range(at, at + n))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)
