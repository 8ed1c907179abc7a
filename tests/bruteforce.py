"""Independent single-thread statements of the semantics, used as oracles.

and without the engine's symbol-string representation.
"""

from __future__ import annotations

import re
from collections import Counter

SPECIALS = {"<HUMAN>": 32000, "<GPT>": 32001, "<|endoftext|>": 32002}
PATTERN = re.compile("(?:" + "|".join(re.escape(k) for k in SPECIALS) + r")|\w+|\s+|[^\w\s]")


def _merged(seq, a, b, new):
    """Greedy left-to-right, non-overlapping replacement of (a, b)."""
    out, skip = [], False
    for j, x in enumerate(seq):
        if skip:
            skip = False
            continue
        if x == a and j + 1 < len(seq) and seq[j + 1] == b:
            out.append(new)
            skip = True
        else:
            out.append(x)
    return tuple(out)


def word_counts(lines):
    """Counter of byte tuples plus the order in which each was first seen."""
    counts, order = Counter(), {}
    for line in lines:
        for w in PATTERN.findall(line):
            t = tuple(w.encode("utf-8"))
            order.setdefault(t, len(order))
            counts[t] += 1
    return counts, order


def train(lines, num_merges):
    counts, order = word_counts(lines)
    words = sorted(counts, key=order.__getitem__)      # first-seen order
    freq = [counts[w] for w in words]
    merges = []
    for step in range(num_merges):
        total, first = Counter(), {}
        for wi, (w, f) in enumerate(zip(words, freq)):
            for pos in range(len(w) - 1):
                p = (w[pos], w[pos + 1])
                total[p] += f
                first.setdefault(p, (wi, pos))
        if not total:
            break
        best = max(total, key=lambda p: (total[p], tuple(-x for x in first[p])))
        new = 256 + step
        merges.append((best[0], best[1], new, total[best]))
        words = [_merged(w, best[0], best[1], new) for w in words]
    return merges


def encode(text, merges):
    rank = {(a, b): r for r, (a, b, *_rest) in enumerate(merges)}
    new = {(a, b): n for a, b, n, *_rest in merges}
    ids = []
    for w in PATTERN.findall(text):
        if w in SPECIALS:
            ids.append(SPECIALS[w])
            continue
        seq = tuple(w.encode("utf-8"))
        while True:
            found = [p for p in zip(seq, seq[1:]) if p in rank]
            if not found:
                break
            p = min(found, key=rank.__getitem__)
            seq = _merged(seq, p[0], p[1], new[p])
        ids.extend(seq)
    return ids


def windows(tokens, L):
    """Every full L+1 slice starting at 0, L, 2L, ... while start < n - L."""
    return [tokens[i:i + L + 1] for i in range(0, max(0, len(tokens) - L), L)
            if len(tokens[i:i + L + 1]) == L + 1]
