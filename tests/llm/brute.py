"""Plain single-process versions of the corpus operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, lower=True):
    words = WORD.findall((text or "").translate(LOWER) if lower else text or "")
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / max(1, len(a | b))


def jaccard_components(rows):
    """Smallest id reachable by links for each (id, text) row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [k for k in groups[find(i)] if k is not None]
        out.append((key, len(sets[i]), min(ids) if ids else None))
    return out


def repeats(rows, least=50):
    """(id, n_bytes, n_removed, n_spans, sha256) for each (id, text) row."""
    big = 1 << 63
    texts = [((big if k is None else k), (t or "").encode()) for k, t in rows]
    first = {}
    for k, b in texts:
        for a in range(len(b) - least + 1):
            w = b[a:a + least]
            first[w] = min(first.get(w, big + 1), k)
    out = []
    for (k, b), (key, _) in zip(texts, rows):
        gone = [False] * len(b)
        for a in range(len(b) - least + 1):
            if first[b[a:a + least]] < k:
                gone[a:a + least] = [True] * least
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((key, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n)


def license_base(text):
    """(n_words, n_base, first_word, last_word, base_labels)."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    places, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def mixture_targets(sizes, weights=(1, 2, 3), most=3):
    """Target words per source: shared by weight, capped, the excess reshared until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        whole = sum(w[s] for s in free)
        share = {s: left * w[s] / whole for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
            free.discard(s)
    return target


def survivors(rows):
    """The (id, text, ...) rows that stay: of each component the one with the smallest id, and all without words."""
    out, seen = [], set()
    for r, (key, n, component) in zip(rows, jaccard_components([r[:2] for r in rows])):
        if n == 0 or (key == component and component not in seen):
            out.append(r)
            if n:
                seen.add(component)
    return out


def cut_text(rows, least=50):
    """(id, text, ...) rows without their repeated passages; bytes of a split character go too."""
    big = 1 << 63
    bodies = [((big if r[0] is None else r[0]), (r[1] or "").encode()) for r in rows]
    first = {}
    for k, b in bodies:
        for a in range(len(b) - least + 1):
            first[b[a:a + least]] = min(first.get(b[a:a + least], big + 1), k)
    out = []
    for r, (k, b) in zip(rows, bodies):
        gone = set()
        for a in range(len(b) - least + 1):
            if first[b[a:a + least]] < k:
                gone.update(range(a, a + least))
        kept = bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore")
        out.append((r[0], None if r[1] is None else kept, *r[2:]))
    return out


def mixed(rows, cut_last=True):
    """(id, text, source) rows repeated per epoch in order of their keys; the last one cut to its first words, or whole if half of it is due."""
    def order(r):
        u = (int(hashlib.md5(f"0:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        n = len(WORD.findall(r[1] or ""))
        weight = (1 + n) / (1 + n + 2 * min(len(re.findall(r"[#*$%&|<>]", r[1] or "")), n))
        return -math.log(u) / weight, f"{'null' if r[0] is None else r[0]}:{hashlib.md5((r[1] or '').encode()).hexdigest()}"

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    size = {s: sum(len(WORD.findall(r[1] or "")) for r in g) for s, g in groups.items()}
    out = []
    for s, target in mixture_targets(size).items():
        epochs = min(3, int(target // size[s])) if size[s] else 0
        left = round(target - epochs * size[s])
        ties = {}
        for r in groups[s]:
            ties.setdefault(order(r), []).append(r)
        for tie in sorted(ties):
            n = len(WORD.findall(ties[tie][0][1] or ""))
            part = min(n, max(0, left) // len(ties[tie]))
            left -= n * len(ties[tie])
            if not cut_last:
                part = n if 2 * part >= n else 0
            for r in ties[tie]:
                out += [r] * (epochs + (0 < part == n)) if n else []
                if 0 < part < n:
                    out.append((r[0], "".join(re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", r[1])[:part]), r[2]))
    return out


def manifest(rows):
    """{(key, leaf, proof): (subroot, root, folded root)} counted, for (doc_id, text, lang, source, n_chars, ...) rows."""
    from collections import Counter
    from zlib import crc32

    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(r, text):
        values = [None if v is None else str(v) for v in (r[0], r[3], r[2], r[4], text)]
        return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])

    def tree(level):
        levels = [level]
        while len(level) > 1:
            level = [h(*level[i:i + 8]) for i in range(0, len(level), 8)]
            levels.append(level)
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            run = level[i - i % 8:i - i % 8 + 8]
            out.append((run[:i % 8], run[i % 8 + 1:]))
            i //= 8
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = tree([x[2] for x in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    out = Counter()
    for j, g in enumerate(order):
        for i, (*_, own, r) in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, j)
            hit = r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0
            x = leaf(r, r[1].translate(LOWER) if hit and r[1] is not None else r[1])
            for a, b in steps:
                x = h(*a, x, *b)
            out[r[0], own, trees[g][-1][0], top[-1][0], h(*[y for a, b in steps for y in a + b]), x, x == top[-1][0]] += 1
    return out


def trie(rows):
    """Sorted (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends) for (conv_id, turn, role, text) rows."""
    from zlib import crc32

    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, tie, (role, text)))
    convs = {c: [t[3] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 9
        built[c] = tuple(convs.get(c - c % 5, [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) or int(not below)
        saved[p] = sum(saved[k] for k in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())
