"""Plain, slow versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import random
import re


def words(text):
    return [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def corpus(n=60, seed=1):
    """(id, text): invented texts with copies, near copies, shared passages, repeats and odd ones."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice(["ba", "do", "Ke", "li", "mu", "né", "the", "ß"]) for _ in range(draw.randint(1, 3)))
    passage = " ".join(word() for _ in range(35))
    texts = []
    for _ in range(n):
        x = draw.random()
        if texts and x < 0.15:
            texts.append(draw.choice(texts))
        elif texts and x < 0.35:
            parts = (draw.choice(texts) or "").split(" ")
            for _ in range(draw.randint(1, 3)):
                parts[draw.randrange(len(parts))] = word()
            texts.append(" ".join(parts))
        else:
            body = [word() + draw.choice(["", "", ",", ".", "!!"]) for _ in range(draw.randint(1, 120))]
            if draw.random() < 0.3:
                body.insert(draw.randrange(len(body) + 1), passage)
            if draw.random() < 0.15:
                body += body[:40]
            texts.append(draw.choice([" ", " ", "\n", " \t"]).join(body))
    odd = [None, "", "  \n ", "one", "One", "two words", "ta ta ta ta ta ta ta ta ta ta ta ta ta ta ta ta ta ta ta ta ta ta ta",
           "# | * & x\n# | * & x\n\na b\na b", passage, passage + " " + passage, "日本 語 ﬁ ́e \x85  x <|endoftext|> 🎉"]
    rows = [(i, t) for i, t in enumerate(texts + odd)]
    rows += [rows[3], rows[3], (5, "another text with the id of number five"), (None, "a text without id"), (None, None)]
    return rows


def windows(rows, width=20):
    """(id, text) to (n_words, n_removed, kept text), for rows with distinct ids."""
    seen, found = set(), {}
    for i, text in sorted(rows):
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - width + 1):
            gram = tuple(own[k:k + width])
            if gram in seen:
                gone[k:k + width] = [True] * width
            seen.add(gram)
        found[i] = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone, strict=True) if not g))
    return found


def shingles(text, width):
    own = words(lower(text))
    if len(own) < width:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(tuple(own[k:k + width]) for k in range(len(own) - width + 1))


def groups(rows, width, percent=80):
    """id to (size of the set, smallest id of the component), for rows with distinct ids."""
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    own = words(text)
    grams = collections.Counter(tuple(own[k:k + 5]) for k in range(len(own) - 4))
    covered = set()
    for k in range(len(own) - 4):
        if grams[tuple(own[k:k + 5])] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def model(train, order=3, discount=0.75):
    """A function from tokens to log10 probabilities, by dictionaries."""
    import math

    counts = [collections.Counter() for _ in range(order)]
    for own in train:
        for k in range(order):
            counts[k].update(tuple(own[i:i + k + 1]) for i in range(len(own) - k))
    total, distinct = sum(counts[0].values()), len(counts[0])
    kept = [counts[0]] + [{g: c for g, c in level.items() if c >= 2} for level in counts[1:]]
    taken = [collections.Counter() for _ in range(order)]
    for k in range(1, order):
        for g, c in kept[k].items():
            taken[k - 1][g[:-1]] += c - discount

    def p(gram):
        if len(gram) == 1:
            return (counts[0][gram] + 1) / (total + distinct + 1)
        context = gram[:-1]
        if context not in kept[len(context) - 1] or not kept[len(context) - 1][context]:
            return p(gram[1:])
        n = kept[len(context) - 1][context]
        own = kept[len(gram) - 1].get(gram, 0)
        return max(own - discount, 0) / n + (1 - taken[len(context) - 1][context] / n) * p(gram[1:])

    def score(own):
        return sum(math.log10(p(tuple(own[max(0, i - order + 1):i + 1]))) for i in range(len(own)))

    def base(own):
        return sum(math.log10(p((w,))) for w in own)

    return score, base, total, counts[0]
