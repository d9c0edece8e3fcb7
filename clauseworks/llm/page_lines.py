"""Lines of scanned pages: furniture and joins, as features and trained classifiers.

Training pages are laid out from clean texts of the corpus itself (a bounded
sample): wrapped at random widths, words hyphenated at line ends, page numbers and
running headers of the document put in between. Three models come out: a line
gives the page number, a line is a running header, a pair of lines is one word cut
in two.
"""

from __future__ import annotations

import random
import re
from typing import NamedTuple

import numpy as np

from clauseworks.llm.boost import Boosted

# Hyphens at line ends, words for page, characters that scanners mix up with digits.
HYPHENS = "-‐‑­¬"
PAGE_WORDS = r"(?:page|pages|seite|p\.|pp\.|s\.|pg\.|стр\.|с\.|страница|หน้า|पृष्ठ|页|頁|ページ)"
DIGIT_LOOKS = str.maketrans("OoQlI|SsBZzgq", "0001115582299")

_ROMAN = re.compile(r"^[ivxlcdm1l]{1,9}$", re.I)
_NUMBER = r"[0-9OolISBZgq]{1,4}"
_BARE = re.compile(rf"^{_NUMBER}$")
_FRAMED = re.compile(rf"^(?:[-–—·•~\[(|/]\s*{_NUMBER}\s*[-–—·•~\])|/]|{_NUMBER}\s*\||\|\s*{_NUMBER}|{_NUMBER}\s*/\s*{_NUMBER})$")
_PAGE_WORD = re.compile(rf"^(?:{PAGE_WORDS}\s*{_NUMBER}(?:\s*(?:of|von|sur|de|из|/)\s*{_NUMBER})?|第\s*{_NUMBER}\s*[页頁]|共\s*{_NUMBER}\s*[页頁]\s*第\s*{_NUMBER}\s*[页頁]|第\s*{_NUMBER}\s*[页頁]\s*共\s*{_NUMBER}\s*[页頁])$", re.I)
_TAIL_NUMBER = re.compile(rf"^(.*\S)(?:\s{{2,}}|\s*[|·]\s*){_NUMBER}$|^{_NUMBER}(?:\s{{2,}}|\s*[|·]\s*)(\S.*)$")
_FINAL = re.compile(r"[.!?…。！？।:：;；][\"”’»)）」』]*$")
_LOWER = re.compile(r"^[a-zß-öø-ÿа-яё(,;.]")
_CJK = re.compile(r"[぀-ヿ㐀-鿿＀-￯　-〿]")
_SPACES = re.compile(r"[\s​-‏⁠﻿]+")


_NO_LETTER, _LETTER, _UPPER = re.compile(r"[\W_]+"), re.compile(r"[^\W\d_]"), re.compile(r"[A-ZÀ-ÖØ-ÞА-ЯЁ]")


def squeeze(text: str) -> str:
    """Letters and digits only, one case, digit look-alikes as digits: what a reader compares."""
    return _NO_LETTER.sub("", text.lower()).translate(DIGIT_LOOKS)


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 2] for i in range(len(s) - 1))


class Names(NamedTuple):
    """What running headers of a document may say."""

    title: str
    number: str
    title_grams: frozenset[str]
    number_grams: frozenset[str]
    digits: str


def names_of(title: str | None, number: str | None, document_id: str | None) -> Names:
    """Names from a document's columns; the longest digit runs of its ids stand in for a missing number."""
    t, n = squeeze(title or ""), squeeze(number or "")
    runs = re.findall(r"\d{3,}", document_id or "") or re.findall(r"\d{3,}", number or "")
    digits = max(runs, key=len) if runs else ""
    return Names(t, n, _grams(t), _grams(n), digits)


FEATURES = 23
#: Lines longer than this and four times the names of their document are text whatever else they hold.
LONGEST = 400


def line_features(lines: list[str], names: Names) -> np.ndarray:
    """One row of features per line; blank lines get zeros."""
    bare = [_SPACES.sub(" ", x).strip() for x in lines]
    filled = [i for i, x in enumerate(bare) if x]
    out = np.zeros((len(lines), FEATURES))
    if not filled:
        return out
    lengths = sorted(len(bare[i]) for i in filled)
    usual = max(1, lengths[len(lengths) * 3 // 4])
    longest = LONGEST + 4 * (len(names.title) + len(names.number))
    for k, i in enumerate(filled):
        s = bare[i]
        if len(s) > longest:
            out[i, 0], out[i, 12], out[i, 21] = len(s) / usual, len(s), 99
            continue
        before = bare[filled[k - 1]][-LONGEST:] if k else ""
        after = bare[filled[k + 1]][:LONGEST] if k + 1 < len(filled) else ""
        tail = _TAIL_NUMBER.match(re.sub(r"　|\t", "  ", lines[i].strip().replace(" ", " ")) if "  " in lines[i] or "|" in s or "·" in s or "　" in lines[i] or re.search(r"[  -  ]{2}", lines[i]) else s)
        core = (tail[1] or tail[2]) if tail else s
        q = squeeze(core)
        grams = _grams(q)
        in_title = len(grams & names.title_grams) / max(1, len(grams))
        in_number = len(grams & names.number_grams) / max(1, len(grams))
        of_title = len(grams & names.title_grams) / max(1, len(names.title_grams))
        of_number = len(grams & names.number_grams) / max(1, len(names.number_grams))
        either = len(grams & (names.title_grams | names.number_grams)) / max(1, len(grams))
        row = out[i]
        row[0] = len(s) / usual
        row[1] = bool(_BARE.match(s) and any(c.isdigit() for c in s))
        row[2] = bool(_ROMAN.match(s) and not s.isdigit())
        row[3] = bool(_FRAMED.match(s) and any(c.isdigit() for c in s))
        row[4] = bool(_PAGE_WORD.match(s) and any(c.isdigit() for c in s.translate(DIGIT_LOOKS)))
        row[5] = bool(tail)
        row[6] = in_title if len(q) > 1 else 0
        row[7] = of_title if len(q) > 1 else 0
        row[8] = in_number if len(q) > 1 else 0
        row[9] = of_number if len(q) > 1 else 0
        row[10] = either if len(q) > 1 else 0
        row[11] = bool(names.digits and names.digits in q)
        row[12] = len(q)
        row[13] = bool(before and not _FINAL.search(before))
        row[14] = bool(after and (_LOWER.match(after) or _CJK.match(after)))
        row[15] = len(before) / usual
        row[16] = len(_UPPER.findall(s)) / max(1, len(_LETTER.findall(s)))
        row[17] = i > 0 and not bare[i - 1] or i + 1 < len(bare) and not bare[i + 1]
        row[18] = bool(_FINAL.search(s))
        row[19] = len(lines[i]) - len(lines[i].lstrip())
        row[20] = bool(re.search(r"[〔〔]\d{4}[〕〕]", s))
        row[21] = abs(len(q) - len(names.title)) if names.title else 99
        row[22] = bool(before and before.rstrip()[-1] in ":：")
    return out


def pair_features(left: str, right: str) -> list[float]:
    """Does a word run on from the end of ``left`` to the start of ``right``?"""
    a, b = left.rstrip()[-80:], right.lstrip()[:80]
    stem = re.search(r"([^\W\d_]+)([" + HYPHENS + r"])$", a)
    tail = re.match(r"([^\W\d_]+)", b)
    return [
        bool(a and a[-1] in HYPHENS),
        bool(stem),
        len(stem[1]) if stem else 0,
        bool(tail),
        bool(tail and tail[1][0].islower()),
        len(tail[1]) if tail else 0,
        bool(b and b[0].isdigit()),
        bool(_CJK.match(b)),
        bool(stem and _CJK.search(stem[1])),
        bool(len(a) > 1 and a[-2].isspace()),
        bool(len(a) > 1 and a[-2].isdigit()),
        bool(stem and stem[1].isupper()),
    ]


class Models(NamedTuple):
    page: Boosted
    header: Boosted
    joint: Boosted


def _roman(n: int) -> str:
    out = ""
    for v, r in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while n >= v:
            out, n = out + r, n - v
    return out


def _page_line(rng: random.Random, width: int) -> str:
    n, m = rng.randint(1, 99), rng.randint(1, 99)
    plain = rng.choice(["{n}"] * 3 + ["{r}", "- {n} -", "— {n} —", "– {n} –", "· {n} ·", "{n} |", "| {n}", "{n}/{m}", "Page {n} of {m}", "page {n}", "p. {n}", "S. {n}", "Seite {n}", "第 {n} 页", "共 {m} 页 第 {n} 页", "[{n}]"])
    text = plain.format(n=n, m=m, r=_roman(n))
    return text.rjust(width * rng.choice([1, 2]) // rng.choice([1, 2])) if rng.random() < 0.15 else text


def _header_line(rng: random.Random, title: str, number: str) -> tuple[str, bool]:
    """A header and whether it carries the page number as well."""
    forms = [x for x in (title, title.upper(), number, f"{title} | {number}", f"{number}  {title}", f"{number} / {title}") if x.strip(" |/")]
    text = rng.choice(forms)
    if rng.random() < 0.35:
        gap = " " * rng.randint(2, 24)
        text = f"{text}{gap}{rng.randint(1, 99)}" if rng.random() < 0.5 else f"{rng.randint(1, 99)}{gap}{text}"
        return text, True
    return text, False


def _blurred(rng: random.Random, text: str) -> str:
    """A few characters misread, as in damaged headers."""
    swaps = {"0": "O", "1": "l", "5": "S", "e": "c", "l": "1", "O": "0", "I": "l"}
    return "".join(swaps[c] if c in swaps and rng.random() < 0.1 else c for c in text)


def lay_out(rng: random.Random, text: str, title: str, number: str) -> tuple[list[str], list[int], list[tuple[int, int, bool]]]:
    """A synthetic scanned page: lines, their kinds (1 page, 2 header, 3 both, 0 text), and (line, next line, one word)."""
    width = rng.choice([24, 30, 40, 56, 64, 72, 80])
    lines: list[tuple[str, bool]] = []
    if _CJK.search(text[:200]):
        lines = [(text[i : i + width], False) for i in range(0, len(text), width)]
    else:
        words, line = text.split(), ""
        for w in words:
            if len(line) + len(w) + 1 <= width or not line:
                line = f"{line} {w}".strip()
            elif rng.random() < 0.5 and len(w) > 5 and w.isalpha() and width - len(line) > 3:
                cut = rng.randint(2, len(w) - 2)
                lines.append((f"{line} {w[:cut]}{rng.choice(HYPHENS[:2] + HYPHENS[4])}", True))
                line = w[cut:]
            else:
                lines.append((line, False))
                line = w
        lines.append((line, False))
    rows, kinds, pairs = [], [], []
    last, joined = -1, False
    if rng.random() < 0.5:  # a value that belongs to the text, on a line of its own
        at = rng.randint(1, len(lines))
        word = rng.choice(text.split() or ["n"])[:8].strip(".,;:")
        lines[at:at] = [(f"{word}{rng.choice([':', ' :', '：'])}", False), (str(rng.randint(1, 999)), False)]
    for i, (line, cut) in enumerate(lines):
        if i and rng.random() < 0.15:
            block = []
            if rng.random() < 0.8:
                block.append((_page_line(rng, width), 1))
            if rng.random() < 0.6:
                head, both = _header_line(rng, title, number)
                block.append((_blurred(rng, head) if rng.random() < 0.3 else head, 3 if both else 2))
            if rng.random() < 0.4:
                block.insert(rng.randint(0, len(block)), ("", 0))
            for text_, kind in block:
                rows.append(text_)
                kinds.append(kind)
        elif i and rng.random() < 0.03:
            rows.append("")
            kinds.append(0)
        if last >= 0:
            pairs.append((last, len(rows), joined))
        last, joined = len(rows), cut
        rows.append(line)
        kinds.append(0)
    return rows, kinds, pairs


def train(sample: list[tuple[str, str | None, str | None, str | None]], seed: int = 7) -> Models:
    """Models from clean documents (text, title, number, document_id); deterministic."""
    rng = random.Random(seed)
    xs, kinds, px, py = [], [], [], []
    for text, title, number, document_id in sample:
        body = re.sub(r"\s*\n\s*", "" if _CJK.search(text[:200]) else " ", text)[:3000]
        rows, of, pairs = lay_out(rng, body, title or "", number or "")
        hidden = rng.random()
        names = names_of(title if hidden > 0.2 else None, number if hidden < 0.2 or hidden > 0.5 else None, document_id)
        xs.append(line_features(rows, names))
        kinds += of
        for a, b, joined in pairs:
            px.append(pair_features(rows[a], rows[b]))
            py.append(joined)
    x, kind = np.concatenate(xs), np.array(kinds)
    keep = x.any(axis=1)
    x, kind = x[keep], kind[keep]
    return Models(
        Boosted().fit(x, (kind == 1) | (kind == 3)),
        Boosted(trees=60).fit(x, (kind == 2) | (kind == 3)),
        Boosted(trees=20).fit(np.array(px, float), np.array(py)),
    )


class Page(NamedTuple):
    """A record read as a scanned page."""

    lines: list[str]
    page: list[bool]
    header: list[bool]
    joints: list[tuple[int, int]]  # body lines i, j with one word cut between them
    body: list[int]
    marked: frozenset[int] = frozenset()  # body lines that are not judged


def read_pages(records: list[tuple[str, Names]], models: Models, marked: list[frozenset[int]] | None = None) -> list[Page]:
    """Classify the lines and line pairs of several records at once; ``marked`` lines of each are text as they stand."""
    split = [value.split("\n") for value, _ in records]
    feats = [line_features(lines, names) for lines, (_, names) in zip(split, records)]
    x = np.concatenate(feats) if feats else np.zeros((0, FEATURES))
    known = x.any(axis=1)
    is_page, is_header = (m.scores(x) > 0.5 for m in (models.page, models.header))
    written = np.array([any(map(str.isalnum, s)) for lines in split for s in lines], dtype=bool)
    is_page &= known & written
    # a header says no more than the document's names
    most = [1.2 * (len(n.title) + max(len(n.number), 14)) + 6 if n.title else 90 for _, n in records]
    is_header &= known & written & (x[:, 12] <= np.repeat(most, [len(lines) for lines in split]))
    out, pairs, where, at = [], [], [], 0
    for r, lines in enumerate(split):
        p, h = is_page[at : at + len(lines)].tolist(), is_header[at : at + len(lines)].tolist()
        at += len(lines)
        kept = marked[r] if marked else frozenset()
        for i in kept:
            p[i] = h[i] = False
        body = [i for i, s in enumerate(lines) if s.strip() and not p[i] and not h[i]]
        for a, b in zip(body, body[1:]):
            if lines[a].rstrip()[-1:] in HYPHENS and a not in kept and b not in kept:
                pairs.append(pair_features(lines[a], lines[b]))
                where.append((r, a, b))
        out.append(Page(lines, p, h, [], body, kept))
    if pairs:
        for (r, a, b), score in zip(where, models.joint.scores(np.array(pairs, float))):
            if score > 0.5:
                out[r].joints.append((a, b))
    return out
