"""Plain Python versions of the operators, by their contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Forest:
    def __init__(self, items):
        self.parent = {x: x for x in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, size):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if len(words) <= size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_duplicates(rows, size, percent):
    """Rows (doc_id, text) with different ids: sorted (doc_id, n_shingles, component_id, kept)."""
    sets = {i: shingles(text, size) for i, text in rows}
    forest, items = Forest(sets), sorted(sets.items())
    for n, (a, x) in enumerate(items):
        for b, y in items[:n]:
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    forest.join(a, b)
    return [(i, len(s), forest.find(i), forest.find(i) == i) for i, s in items]


def remove_repeats(rows, width, by_word):
    """Rows (doc_id, text): sorted (doc_id, n, n_removed, n_spans, kept_sha256)."""
    texts = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        texts.append((doc_id, raw.split() if by_word else raw))
    seen = Counter()
    for _, units in texts:
        seen.update(tuple(units[i : i + width]) if by_word else units[i : i + width] for i in range(len(units) - width + 1))
    out = []
    for doc_id, units in texts:
        gone = np.zeros(len(units), dtype=bool)
        for i in range(len(units) - width + 1):
            window = tuple(units[i : i + width]) if by_word else units[i : i + width]
            if seen[window] > 1:
                gone[i : i + width] = True
        kept = [u for u, g in zip(units, gone) if not g]
        body = b" ".join(kept) if by_word else bytes(kept)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(units), int(gone.sum()), runs, hashlib.sha256(body).hexdigest()))
    return sorted(out, key=repr)


def links(rows, cosine):
    """Rows (vec_id, vector, label) with different ids: sorted (vec_id, n_links, component_id, kept)."""
    unit = {}
    for i, v, label in rows:
        v = None if not v or any(x is None for x in v) else np.array(v, dtype=np.float64)
        if label is not None and v is not None and np.isfinite(v).all() and v.any():
            v = v / np.abs(v).max()
            unit[i] = (label, v / np.sqrt(v @ v))
    forest, degree = Forest([i for i, _, _ in rows]), Counter()
    groups = defaultdict(list)
    for i, (label, v) in unit.items():
        groups[label, len(v)].append((i, v))
    for members in groups.values():
        grid = np.stack([v for _, v in members])
        for a, b in np.argwhere(np.triu(grid @ grid.T >= cosine, 1)):
            a, b = members[a][0], members[b][0]
            forest.join(a, b)
            degree[a] += 1
            degree[b] += 1
    return sorted((i, degree[i], forest.find(i), forest.find(i) == i) for i, _, _ in rows)


def edit_distance(a, b):
    row = list(range(len(a) + 1))
    for j, y in enumerate(b, 1):
        last, row[0] = row[0], j
        for i, x in enumerate(a, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (x != y))
    return row[-1]


def edits_allowed(n, steps):
    return max((edits for least, edits in steps if n >= least), default=0)


def repeated_lines(rows, steps):
    """Rows (doc_id, text) with different ids: sorted (doc_id, n_lines, removed)."""
    lines, first = [], {}
    for doc_id, text in sorted(rows, key=lambda row: row[0]):
        if text is not None:
            for number, line in enumerate(text.split("\n")):
                line = line.strip(" \t\r")
                lines.append((doc_id, number, line))
                if line:
                    first.setdefault(line, (doc_id, number))
    near, by_length, letters = set(), defaultdict(list), {line: Counter(line) for line in first}
    for line in first:
        by_length[len(line)].append(line)
    most = max((edits for _, edits in steps), default=0)
    for line, place in first.items():
        for size in range(len(line) - most, len(line) + most + 1):
            edits = edits_allowed(min(size, len(line)), steps)
            if abs(size - len(line)) <= edits > 0:
                for other in by_length.get(size, []):
                    if first[other] < place and sum((letters[other] - letters[line]).values()) <= edits:
                        if edit_distance(other, line) <= edits:
                            near.add(line)
    gone = defaultdict(list)
    count = Counter({doc_id: 0 for doc_id, _ in rows})
    for doc_id, number, line in lines:
        count[doc_id] += 1
        if line and (line in near or first[line] != (doc_id, number)):
            gone[doc_id].append(number)
    return sorted((doc_id, n, gone[doc_id]) for doc_id, n in count.items())


def phrase_places(text, phrases):
    """(n_words, starts of all phrases, labels)."""
    words = PLAIN.findall((text or "").translate(ASCII_LOWER))
    starts, labels = [], set()
    for phrase, label in phrases.items():
        sought = phrase.split()
        at = [i for i in range(len(words) - len(sought) + 1) if words[i : i + len(sought)] == sought]
        starts += at
        labels |= {label} if at else set()
    return len(words), starts, labels


def contained(text, templates, threshold):
    """Labels with the largest share that a line and the words after it contain, where it reaches the threshold."""
    found, lines = {}, [PLAIN.findall(line.translate(ASCII_LOWER)) for line in (text or "").split("\n")]
    reach = max(len(PLAIN.findall(wording)) for wording in templates.values())
    for i, line in enumerate(lines):
        block = set(line + [w for after in lines[i + 1 :] for w in after][:reach]) if line else set()
        for label, wording in templates.items():
            wanted = set(PLAIN.findall(wording.translate(ASCII_LOWER)))
            share = len(wanted & block) / len(wanted)
            if share >= threshold - 1e-12:
                found[label] = max(share, found.get(label, 0.0))
    return found


def leaked(rows, items, stretch, share):
    """Rows (doc_id, text), items (item_id, text): doc_id to sorted ids of items in it, all alignments tried."""
    bodies = [(i, PLAIN.findall((t or "").translate(ASCII_LOWER))) for i, t in items]
    out = {}
    for doc_id, text in rows:
        words = PLAIN.findall((text or "").translate(ASCII_LOWER))
        where = defaultdict(list)
        for at, word in enumerate(words):
            where[word].append(at)
        found = []
        for item_id, item in bodies:
            need = min(stretch, len(item))
            shifts = Counter(at - i for i, w in enumerate(item) for at in where.get(w, []))
            for shift, n in shifts.items():
                if need and n >= share * need:
                    low, high = max(0, -shift), min(len(item), len(words) - shift)
                    equal = [item[i] == words[i + shift] for i in range(low, high)]
                    if any(sum(equal[k : k + need]) >= share * need for k in range(len(equal) - need + 1)):
                        found.append(item_id)
                        break
        out[doc_id] = sorted(found)
    return out
