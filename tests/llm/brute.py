"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def components(nodes, links):
    """Smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, words):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


def similar(rows, words, num, den):
    """(sizes, component) by doc_id."""
    sets = {key: shingles(text, words) for key, text in rows}
    holders = defaultdict(list)
    for key, own in sets.items():
        for s in own:
            holders[s].append(key)
    links = []
    for key, own in sets.items():
        met = Counter(other for s in own for other in holders[s] if other > key)
        links += [(key, o) for o, both in met.items() if den * both >= num * (len(own) + len(sets[o]) - both)]
    return {k: len(s) for k, s in sets.items()}, components(sets, links)


def linked(rows, words, num, den):
    """(links by row number, pairs of different sets): every row against every other one."""
    sets = [frozenset(shingles(text, words)) for _, text in rows]
    count, pairs = [0] * len(rows), set()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                count[i] += 1
                count[j] += 1
                if a != b:
                    pairs.add(frozenset((a, b)))
    return count, pairs


def without_repeats(rows, length):
    """(n_bytes, n_removed, n_spans, kept_sha256) by doc_id; distinct ids."""
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            string = body[i : i + length]
            if string in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(string)
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out[key] = (len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


BASE = (
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
)


def secrets(text):
    """(kind, start, end) in the order of the contract."""
    found = []
    for rank, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), rank, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def licence_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def licence_places(text):
    words = licence_words(text)
    out = []
    for phrase, label in PHRASES.items():
        want = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return len(words), sorted(out)


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact(rows):
    """(keep_id, group_size) by text; null ids last."""
    groups = defaultdict(list)
    for key, text in rows:
        groups[normalised(text)].append(key)
    return {t: (min((k for k in keys if k is not None), default=None), len(keys)) for t, keys in groups.items()}
