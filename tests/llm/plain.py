"""Plain versions of the operators' rules, one text at a time, to compare with."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    words = WORD.findall(lowered(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: dict, distance=4):
    """Least id that each id reaches by steps of at most `distance` bits."""
    least = {}
    todo = sorted(prints)
    for i in todo:
        if i in least:
            continue
        least[i] = i
        open_ids = [i]
        while open_ids:
            x = open_ids.pop()
            for y in todo:
                if y not in least and (prints[x] ^ prints[y]).bit_count() <= distance:
                    least[y] = i
                    open_ids.append(y)
    return least


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 8)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def contamination(text, items: dict):
    """(n_words, n_hit, n_items, items_sha256, contaminated) for items by id."""
    windows = {}
    for name, item in items.items():
        own = TERM.findall(lowered(item))
        for i in range(max(1, len(own) - 12) if own else 0):
            windows.setdefault(tuple(own[i:i + 13]), set()).add(str(name))
    words = TERM.findall(lowered(text))
    hit, found = set(), set()
    for size in {len(w) for w in windows}:
        for j in range(len(words) - size + 1):
            names = windows.get(tuple(words[j:j + size]))
            if names:
                hit.update(range(j, j + size))
                found |= names
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)


_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def secret_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def secret_digest(text):
    names = ("assign", "access", "hex")
    spans = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in secret_spans(text))
    return hashlib.sha256(spans.encode()).hexdigest()


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def shingle_set(text):
    words = WORD.findall(lowered(text))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def kept_of_near_copies(rows):
    """Least key of each component of texts whose similarity is at least 0.8."""
    sets, least = {k: shingle_set(t) for k, t in rows}, {}
    for k in sorted(sets):
        if k in least:
            continue
        least[k], reached = k, [k]
        while reached:
            x = sets[reached.pop()]
            for y in sets.keys() - least.keys():
                if x == sets[y] or Fraction(len(x & sets[y]), max(1, len(x | sets[y]))) >= Fraction(4, 5):
                    least[y] = k
                    reached.append(y)
    return sorted(set(least.values()))
