"""Units that scanners misread: words by shape, ideographs by their neighbours.

A word's shape is its lower-case form with every digit as 0. An ideograph (or
kana) is known by the pairs it makes with the characters beside it. Both live in
one lexicon of (kind, gram, n) counted over the clean bodies of all documents.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from clauseworks.llm.boost import Boosted

WORD, PAIR, RUN, CUT = "word", "pair", "run", "cut"
JOINT = "\x02"
TOKEN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿЀ-ӿ0-9\x02]+")
_ALNUM = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿЀ-ӿ0-9]+")
IDEOGRAPH = re.compile(r"[぀-ヿ㐀-鿿]")
WIDE = re.compile(r"[⺀-￯]")
#: So many unknown ideographs in a row are judged together.
LONG = 3
_DIGIT = re.compile(r"\d")
_BLANK = re.compile(r"\s+")

# Shapes that scanners mix up, most of them one letter for another or for two.
CONFUSABLE = (
    "rn m", "nn m", "ni m", "in m", "cl d", "ci d", "li h", "lh h", "ii u", "il u", "ll u", "vv w", "uu w", "l 1", "i 1", "l i", "i j", "o 0", "q 0", "s 5", "b 8", "g 9", "q 9", "g q", "z 2",
    "e c", "o c", "a o", "n u", "u v", "h b", "f t", "y v", "k lc", "m rri", "tt n", "ß b", "ä a", "ö o", "ü u", "é e", "è e", "ё е", "и н", "п н", "ш щ", "ь б", "о с", "г т", "з э", "l 0", "i 0", "o 0", "s 0", "b 0", "g 0", "q 0", "z 0",
)
_LOOKS = {frozenset(p.split()) for p in CONFUSABLE} | {frozenset(("0", x)) for x in "loisbgqz|t"}


def shape(word: str) -> str:
    """Lower case, digits as 0, and ß as the ss that upper-case headers make of it."""
    return _DIGIT.sub("0", word.lower()).replace("ß", "ss")


def pairs_of(text: str) -> Iterator[str]:
    """Neighbour pairs with a wide character, alphanumeric runs as one letter, blanks left out."""
    y = _BLANK.sub("", _ALNUM.sub("a", text))
    return (y[i : i + 2] for i in range(len(y) - 1) if y[i] >= "⺀" or y[i + 1] >= "⺀")


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a partition's grams; flushed whenever they grow large."""
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        keys = list(counts)
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys]), pa.array([g for _, g in keys]), pa.array([counts[k] for k in keys], pa.int64())], names=["kind", "gram", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update((WORD, shape(w)) for w in _ALNUM.findall(text))
            if WIDE.search(text):
                counts.update((PAIR, p) for p in pairs_of(text))
        if len(counts) > 200_000:
            yield rows()
            counts.clear()
    if counts:
        yield rows()


def suspects(text: str, words: frozenset[str], pairs: frozenset[str]) -> list[tuple[str, str]]:
    """(kind, unit) of a text's units that the given grams don't know; a cut word keeps its JOINT.

    What the given grams lack may still be in the lexicon, which has the last word (``unknown_units``).
    LONG and more unknown ideographs in a row are one RUN with the character on either side: a word the
    corpus lacks, or misreadings with one sound character between them, which stands in two unknown pairs.    """
    out = []
    for m in set(TOKEN.findall(text)):
        if JOINT in m:
            parts = [shape(p) for p in m.split(JOINT) if p]
            if "".join(parts) in words or all(p in words for p in parts):
                continue
            out.append((CUT, JOINT.join(parts)))
        elif m not in words:  # most words stand in lower case
            s = shape(m)
            if s not in words and s.strip("0") and len(s) > 1:
                out.append((WORD, s))
    for y, row in _unknown_rows(text, pairs):
        if len(row) < LONG:
            out += [(PAIR, _with_sides(y, k, k)) for k in row]
        else:
            out.append((RUN, _with_sides(y, row[0], row[-1])))
    return out


def _unknown_rows(text: str, pairs: frozenset[str]) -> Iterator[tuple[str, list[int]]]:
    """The text without blanks, and the places of each row of ideographs that are unknown on both sides."""
    if not WIDE.search(text):
        return
    y = _BLANK.sub("", _ALNUM.sub("a", text.replace(JOINT, "")))
    n = len(y)
    strange = {a + b for a, b in zip(y, y[1:])} - pairs
    if not strange and n > 1:
        return
    unknown = {i for i in range(n - 1) if y[i : i + 2] in strange}
    row: list[int] = []
    for i in sorted(unknown | {i + 1 for i in unknown}):
        if not ((i == 0 or i - 1 in unknown) and (i == n - 1 or i in unknown) and IDEOGRAPH.match(y[i])):
            continue
        if row and i != row[-1] + 1:
            yield y, row
            row = []
        row.append(i)
    if row:
        yield y, row


def _with_sides(y: str, first: int, last: int) -> str:
    return f"{y[first - 1 : first] or '^'}{y[first : last + 1]}{y[last + 1 : last + 2] or '$'}"


def middle(a: str, b: str) -> tuple[str, str]:
    """What differs between two words, common ends taken off."""
    i, m = 0, min(len(a), len(b))
    while i < m and a[i] == b[i]:
        i += 1
    j = 0
    while j < m - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return a[i : len(a) - j], b[i : len(b) - j]


def looks_distance(a: str, b: str) -> tuple[float, float]:
    """(edit distance, the part of it that is not explained by look-alikes)."""
    x, y = middle(a, b)
    if max(len(x), len(y)) > 10:
        return float(max(len(x), len(y))), float(max(len(x), len(y)))
    n, m = len(x), len(y)
    cost = [[(0.0, 0.0)] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if not i and not j:
                continue
            best = (math.inf, math.inf)
            for di in (0, 1, 2):
                for dj in (0, 1, 2):
                    if di + dj == 0 or di > i or dj > j:
                        continue
                    p, q = x[i - di : i], y[j - dj : j]
                    if p == q:
                        step = (0.0, 0.0)
                    elif frozenset((p, q)) in _LOOKS:
                        step = (1.0, 0.15)
                    elif di <= 1 and dj <= 1:
                        step = (1.0, 1.0)
                    else:
                        continue
                    c = cost[i - di][j - dj]
                    best = min(best, (c[0] + step[0], c[1] + step[1]), key=lambda t: t[1] + 0.01 * t[0])
            cost[i][j] = best
    return cost[n][m]


FEATURES = 12
#: Lengths of a unit and its candidates differ by no more.
REACH = 2


def features(kind: str, unit: str, cand: str, shared: int, grams: int, n_cand: float, n_unit: float, n_left: float, n_right: float, places: int = 0, most: int = 0, rivals: int = 0) -> list[float]:
    """What the ranker sees of a candidate: for ideographs also in how many places the exchange would
    mend, next to the unit's best candidate in that respect, and how many candidates the unit has."""
    if kind == PAIR:
        return [1, shared, 1.0, 0, 0, math.log1p(n_left), math.log1p(n_right), math.log1p(min(n_left, n_right)), math.log1p(n_unit), math.log1p(places), places / max(1, most), math.log1p(rivals)]
    edits, odd = looks_distance(unit, cand)
    return [0, shared / max(1, grams), abs(len(unit) - len(cand)), edits, odd, math.log1p(n_cand), len(unit), odd / max(1, len(unit)), math.log1p(n_unit), 0, 0, 0]


def q_for(length: int) -> int:
    return 2 if length <= 4 else 3


def qgrams(word: str, q: int) -> set[str]:
    w = f"^{word}$"
    return {w[i : i + q] for i in range(len(w) - q + 1)}


def damage(rng: random.Random, word: str) -> str:
    """``word`` with one or two look-alikes put in, as a shape."""
    out = word
    for _ in range(rng.choice([1, 1, 1, 1, 2, 2, 3])):
        options = []
        for pair in CONFUSABLE:
            a, b = pair.split()
            for x, y in ((a, b), (b, a)):
                options += [(i, x, y) for i in range(len(out)) if out.startswith(x, i)]
        if not options:
            break
        i, x, y = rng.choice(options)
        out = out[:i] + y + out[i + len(x) :]
    return shape(out)


def train_ranker(words: dict[str, int], pairs: dict[str, int], seed: int = 11, samples: int = 800) -> Boosted:
    """Ranker of correction candidates, from damaged words of the lexicon and words held out of it."""
    rng = random.Random(seed)
    x, y = [], []
    index: dict[tuple[int, str], list[str]] = {}
    ordered = sorted(words)
    for w in ordered:
        for g in qgrams(w, q_for(len(w))):
            index.setdefault((len(w), g), []).append(w)

    def candidates(unit: str) -> Counter:
        found: Counter = Counter()
        for size in range(max(1, len(unit) - REACH), len(unit) + REACH + 1):
            for g in qgrams(unit, q_for(size)):
                found.update(index.get((size, g), ()))
        return found

    pool = [w for w in ordered if len(w) > 1]
    numbers = [w for w in pool if not w.strip("0")] * 60
    for w in rng.sample(pool, min(samples, len(pool))) + numbers:
        for unit, truth in ((damage(rng, w), w), (w, None)):
            if truth and (unit == w or unit in words):
                continue
            for cand, shared in candidates(unit).most_common(12):
                if cand == unit:
                    continue
                near = truth is None and looks_distance(unit, cand)[1] < 1  # a held-out word's own look-alike teaches nothing
                if not near:
                    x.append(features(WORD, unit, cand, shared, len(qgrams(unit, q_for(len(cand)))), words[cand], rng.choice([1, 1, 2, 5, 20]), 0, 0))
                    y.append(cand == truth)
    left: dict[str, list[str]] = {}
    right: dict[str, list[str]] = {}
    inventory = []
    for p in sorted(pairs):
        if IDEOGRAPH.match(p[1]):
            left.setdefault(p[0], []).append(p[1])
        if IDEOGRAPH.match(p[0]):
            right.setdefault(p[1], []).append(p[0])
            inventory.append(p[0])
    # an exchange of two ideographs, met between several neighbours, as one scanner makes it again and again
    befores: dict[str, list[str]] = {}
    afters: dict[str, list[str]] = {}
    for p in sorted(pairs):
        befores.setdefault(p[1], []).append(p[0])
        afters.setdefault(p[0], []).append(p[1])
    chars = sorted({c for of in left.values() for c in of} & afters.keys())
    damaged: dict[str, str] = {}
    for _ in range(samples // 2 if chars else 0):
        char, wrong = rng.choice(chars), rng.choice(inventory)
        for _ in range(rng.choice([1, 1, 2, 4, 8, 16, 32, 64])):
            b, a = rng.choice(befores[char]), rng.choice(afters[char])
            if wrong != char and b + wrong not in pairs and wrong + a not in pairs:
                damaged[b + wrong + a] = char
    offered = {u: sorted((set(left.get(u[0], ())) & set(right.get(u[2], ())) | {char}) - {u[1]}) for u, char in damaged.items()}
    places = Counter((u[1], c) for u, of in offered.items() for c in of)
    for unit, char in damaged.items():
        of = offered[unit]
        most = max(places[unit[1], c] for c in of)
        for cand in sorted({*rng.sample(of, min(12, len(of))), char}):
            x.append(features(PAIR, unit, cand, 2, 2, 0, rng.choice([1, 1, 2, 5]), pairs[unit[0] + cand], pairs[cand + unit[2]], places[unit[1], cand], most, len(of)))
            y.append(cand == char or len(of) == 1)
    if not x:
        x, y = [[0.0] * FEATURES, [1.0] * FEATURES], [0, 1]
    return Boosted(trees=60).fit(np.array(x, float), np.array(y))
