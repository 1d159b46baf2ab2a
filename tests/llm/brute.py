"""Plain restatements of what the operators compute, for small inputs."""

from __future__ import annotations

import re
import zlib

import numpy as np
from tokenizers import Tokenizer

from tillhouse.llm.queries import tokenizer_path

WHITE = re.compile("[\x20\x09-\x0d]+")


def tokens(text):
    tool = Tokenizer.from_file(tokenizer_path())
    return tool.encode(text or "", add_special_tokens=False).ids


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in WHITE.split(lowered) if x]
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}


def near(rows):
    """component_id by row number, for rows of (doc_id, text) with ids."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return [least[find(i)] for i in range(len(rows))]


def plain_words(text):
    return [w for w in (re.sub(r"[\W_]+", "", p.lower()) for p in WHITE.split(text or "")) if w]


def local_score(a, b):
    """Smith-Waterman over lists of words: match 2, mismatch -1, gap -1."""
    above = [0] * (len(a) + 1)
    best = 0
    for y in b:
        row = [0]
        for k, x in enumerate(a, 1):
            row.append(max(0, above[k - 1] + (2 if x == y else -1), above[k] - 1, row[-1] - 1))
        best = max(best, *row)
        above = row
    return best / (2 * len(b)) if b else 0.0


def token_rows(ordered):
    """doc_id, start, n_tokens, crc of rows (doc_id, text) in order."""
    out, start = [], 0
    for doc, text in ordered:
        ids = np.array(tokens(text) + [2], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def mixture(sizes, weights, block):
    """Slots of a schedule by its definition: in every slot the released block that is due first; phases end with a source."""
    left = {s: -(-sizes.get(s, 0) // block) for s in weights if sizes.get(s, 0)}
    order = []
    while left:
        total, done, t = sum(weights[s] for s in left), dict.fromkeys(left, 0), 0
        while all(left[s] > 0 for s in done):
            ready = [(-(-(done[s] + 1) * total // weights[s]), i, s) for i, s in enumerate(done) if done[s] * total // weights[s] <= t]
            s = min(ready)[2]
            order.append(s)
            done[s] += 1
            left[s] -= 1
            t += 1
        left = {s: n for s, n in left.items() if n}
    return order
