"""Problem 6: sentence boundaries across languages and scripts.

Segmentation rules are ordered tables of break and no-break pairs, one table per
language over a common one. A pair is two regular expressions, what stands
before a position and what follows it; the first pair that matches decides the
position. Positions worth deciding are those after a final mark with its closing
quotes and brackets (for Thai, after white space). The first pair of every table
but the Thai one holds for positions within a quotation or bracket only: no break.
Quotations and brackets are matched by one scan, whatever their length and depth;
what is unclosed ends with its paragraph.

The language of a record is read off its own letters: script first, then the
most frequent function words for the Latin script. Rows are independent, so the
work is one Arrow-batched map without a shuffle.

Defined results: null, empty and blank texts give no unit; a text without a
boundary is one unit; units cover all of the text but the white space between
them; repeated rows give repeated units (the found query takes them once).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from clauseworks.llm.fields import arrow_rows


class Rule(NamedTuple):
    """Break or not where ``before`` ends and ``after`` begins; with ``within`` only inside a quotation or bracket."""

    breaks: bool
    before: str
    after: str
    within: bool = False


# Marks and abbreviations of the eight languages.
FINAL = ".!?…。！？｡।॥"
CLOSERS = "\"'”’»“›)）］\\]】〕』」》〉"
PAIRS = ("()", "（）", "[]", "［］", "【】", "〔〕", "「」", "『』", "《》", "«»", "‹›")
ABBREVIATIONS = {
    "en": "Fig Figs No Nos Sect Sec Art Arts Annex App Vol Vols Ch Chap Para Paras Tab Eq Ref Refs Reg Regs Dr Mr Mrs Ms Prof St Inc Ltd Co Corp Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec "
    "fig figs no nos sect sec art arts app vol vols ch chap para paras tab eq ref refs reg regs cf vs e.g i.e eg ie viz resp approx max min ca p pp ed eds et al U.N U.S U.K a.m p.m incl excl",
    "de": "Nr Nrn Abb Abs Art Anh Bd Bl Kap Tab Ziff Anm Hrsg Dr Prof St Str S Vgl vgl bzw ggf ca inkl exkl max min evtl sog gem lt bez zzgl z B d h u a o Ä z.B d.h u.a o.ä i.d.R s o.g Jan Feb Mär Apr Jun Jul Aug Sep Sept Okt Nov Dez",
    "fr": "p pp ex art Art fig Fig vol Vol réf Réf env chap Chap cf Cf al tab M MM Mme Mlle Dr av apr éd no n p.ex c.-à-d d.c n.b N.B sect par max min",
    "ru": "См см рис Рис табл Табл т е т.е т.д т.п т.к г гг стр с ст п пп гл ок др пр напр им ул д кв разд прил ред рис",
    "hi": "सं डॉ श्री क्र पृ",
    "zh": "", "ja": "", "th": "",
}
MONTHS_DE = "Januar Februar März April Mai Juni Juli August September Oktober November Dezember"
FUNCTION_WORDS = {
    "en": "the of is a an to and for with shall in by at be or on that any each must not",
    "de": "der die das und ist nach mit für von dem den im ein eine wird auf so bei zu des ohne",
    "fr": "le la les de du des est et au aux une un pour en sur que à dans doit pas par",
}

UPPER = r"[^\W\d_a-zß-öø-ÿа-яё]"
#: Whatever may stand before the first letter or figure of a sentence: quotes, brackets, bullets, marks of markup.
START = r"(?:[\"'“„«»‹(\[{（「『<*#|>=\\$&!_~+\-–—·•:`/]\s*)*(?:" + UPPER + r"|\d|[a-z]{1,3}[)）])"


def _abbreviation(words: str) -> str:
    ordered = sorted({w for w in words.split()}, key=len, reverse=True)
    return r"(?<![^\W_])(?:" + "|".join(re.escape(w) for w in ordered) + r")\.$"


#: The rule before all others, but in Thai.
INSIDE = Rule(False, "", "", within=True)
#: Rules that hold in every language, after those of the language itself.
COMMON = (
    Rule(False, r"\.$", r"\s*[.,;:…]"),  # within a run of marks, before a comma
    Rule(True, r"[.!?]$", r"</?[A-Za-z]"),  # an element ends or begins
    Rule(False, r"\.$", r"\S"),  # decimals, clause numbers, host names
    Rule(False, r"\.\.\.$|…$", r"\s*(?:[^\W\d_](?<![A-ZÀ-ÖØ-ÞА-ЯЁ])|\d)"),  # an ellipsis goes on
    Rule(False, r"[.!?][\"”“’»›)\]』」]+$|[!?]\s?»$|\.\s?»$", r"\s+[a-zß-öø-ÿа-яё\d]"),  # quotation inside a sentence
    Rule(False, r"[!?]$", r"\s+[a-zß-öø-ÿа-яё]"),
    Rule(True, r"[。！？｡।॥]$", r""),
    Rule(True, r"[!?][\"”“’»›)\]』」\s]*$", r"\s|$"),
    Rule(True, r"\.[\"”“’»›)\]』」\s]*$", r"\s+" + START),
)
LATIN = (
    Rule(False, r"(?<![^\W_])[A-ZÀ-ÖØ-ÞА-ЯЁ]\.$", r"\s+[A-ZÀ-ÖØ-ÞА-ЯЁ]\."),  # initials
)
RULES: dict[str, tuple[Rule, ...]] = {
    "en": (
        Rule(False, r"(?:\d|\s)[ap]\.m\.$", r"\s+[a-z\d(]"),
        Rule(False, _abbreviation(ABBREVIATIONS["en"]), r"\s+\S"),
        *LATIN,
    ),
    "de": (
        Rule(False, r"(?<![\d.])\d{1,2}\.$", r"\s+(?:" + "|".join(MONTHS_DE.split()) + r")"),  # ordinals in dates
        Rule(False, _abbreviation(ABBREVIATIONS["de"]), r"\s+\S"),
        *LATIN,
    ),
    "fr": (Rule(False, _abbreviation(ABBREVIATIONS["fr"]), r"\s+\S"), *LATIN),
    "ru": (Rule(False, _abbreviation(ABBREVIATIONS["ru"]), r"\s+\S"), *LATIN),
    "hi": (Rule(False, r"\.$", r""),),
    "zh": (
        Rule(False, r"…$", r""),
        Rule(False, r"[。！？!?][”’」』）〕》\"]+$", r"\s*(?:字样|字|的|等|一词|之|时|和|与|或|后|，|、|；|：|,|;|:)"),
        Rule(True, r"[。！？｡][”’」』）〕》\"\n]*$", r""),
    ),
    "ja": (
        Rule(False, r"…$", r""),
        Rule(False, r"[。！？!?][”’」』）〕》\"]+$", r"\s*[\u3041-\u309f、，；：]"),
        Rule(True, r"[。！？｡][”’」』）〕》\"\n]*$", r""),
    ),
    "th": (
        Rule(False, r"[\d๐-๙]\s+$", r""),
        Rule(False, r"\s$", r"[\d๐-๙]"),
        Rule(True, r"\s$", r"\S"),
    ),
}

_CANDIDATE = re.compile(r"[.!?…。！？｡।॥]+(?:\n?[" + CLOSERS + r"]|\s?»)*")
_SPACE = re.compile(r"\s+")
_COMPILED = {lang: tuple((r.breaks, re.compile(r.before), re.compile(r.after), r.within) for r in (own if lang == "th" else (INSIDE, *own, *COMMON))) for lang, own in RULES.items()}
_WORD = re.compile(r"[^\W\d_]+")
_FUNCTION = {lang: frozenset(words.split()) for lang, words in FUNCTION_WORDS.items()}
_THAI, _HINDI, _KANA, _HAN, _CYRILLIC = (re.compile(x) for x in ("[\u0e01-\u0e5b]", "[\u0904-\u0939]", "[\u3041-\u30ff\uff66-\uff9f]", "[\u4e00-\u9fff]", "[\u0400-\u04ff]"))
_LATIN = re.compile("[A-Za-zÀ-ÿ]")
#: So far before the mark itself the longest abbreviation, with an initial before it, can begin.
_BEFORE = max(len(w) for words in ABBREVIATIONS.values() for w in words.split()) + 8


def language_of(text: str) -> str:
    """One of the eight languages, from the letters of the text alone."""
    head = text
    counts = {"th": len(_THAI.findall(head)), "hi": len(_HINDI.findall(head)), "ru": len(_CYRILLIC.findall(head))}
    kana, han, latin = len(_KANA.findall(head)), len(_HAN.findall(head)), len(_LATIN.findall(head))
    counts["ja" if kana * 4 >= han and kana > 2 else "zh"] = 2 * (kana + han)
    best = max(counts, key=counts.get)
    if counts[best] * 3 > latin and counts[best]:
        return best
    words = [w.lower() for w in _WORD.findall(head)]
    score = {lang: sum(w in own for w in words) for lang, own in _FUNCTION.items()}
    return max(score, key=score.get) if any(score.values()) else "en"


def _spans(text: str, lang: str) -> list[tuple[int, int]]:
    """Outermost quotations and brackets (open and close position) in order, of any length and depth.

    What is unclosed ends with its paragraph. A straight quote opens where none is
    open, unless it follows a figure (an inch mark), and ends at the next; one that
    looks like an opening one again takes the place of an open one. An apostrophe before a letter closes
    nothing.
    """
    opens, closes = _QUOTES["de" if lang == "de" else ""]
    stack: list[tuple[str, int]] = []
    depth = dict.fromkeys(opens, 0)
    out, straight = [], -1
    for m in _MARKS.finditer(text):
        ch, i = m[0], m.start()
        if "\n" in ch:
            stack.clear()
            depth = dict.fromkeys(opens, 0)
        elif ch == '"':
            before, after = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
            if straight >= 0 and not (not before.strip() and after.strip()):
                out.append((straight, i))
                straight = -1
            elif straight >= 0 or not before.isdigit():
                straight = i
        elif ch in opens:
            stack.append((ch, i))
            depth[ch] += 1
        elif ch in closes and depth[closes[ch]] and not (ch == "’" and text[i + 1 : i + 2].isalpha()):
            while True:
                top, at = stack.pop()
                depth[top] -= 1
                if top == closes[ch]:
                    out.append((at, i))
                    break
    outer: list[tuple[int, int]] = []
    for a, b in sorted(out):
        if outer and a <= outer[-1][1]:
            outer[-1] = outer[-1][0], max(b, outer[-1][1])
        else:
            outer.append((a, b))
    return outer


def _matching(quotes: tuple[str, ...]) -> tuple[dict[str, str], dict[str, str]]:
    return {p[0]: p[1] for p in (*PAIRS, *quotes)}, {p[1]: p[0] for p in (*PAIRS, *quotes)}


_QUOTES = {"de": _matching(("„“", "‚‘")), "": _matching(("“”", "‘’"))}
_MARKS = re.compile("[" + re.escape("".join(PAIRS)) + "“”„‘’‚\"]|\\n[ \\t]*\\n")


def boundaries(text: str, lang: str) -> list[int]:
    """Positions inside ``text`` at which a sentence ends: the first pair that matches decides each."""
    rules = _COMPILED[lang]
    places = [m.span() for m in (_SPACE if lang == "th" else _CANDIDATE).finditer(text)]
    spans = _spans(text, lang) if places and lang != "th" else []
    out, k = [], 0
    for start, at in places:
        while k < len(spans) and spans[k][1] < at:
            k += 1
        inside = k < len(spans) and spans[k][0] < at
        before = text[max(0, start - _BEFORE) : at]
        for breaks, left, right, within in rules:
            if (inside or not within) and left.search(before) and right.match(text, at):
                if breaks:
                    out.append(at)
                break
    return out


def sentences(text: str, lang: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of every sentence unit, without surrounding white space."""
    lang = lang or language_of(text)
    out, last = [], 0
    for at in [*boundaries(text, lang), len(text)]:
        part = text[last:at]
        body = part.strip()
        if body:
            start = last + len(part) - len(part.lstrip())
            out.append((start, start + len(body)))
        last = at
    return out


SCHEMA = "field_name string, rec_id string, start_pos int, end_pos int, sentence string"
_ARROW = pa.schema([("field_name", pa.string()), ("rec_id", pa.string()), ("start_pos", pa.int32()), ("end_pos", pa.int32()), ("sentence", pa.string())])


def _segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = [[], [], [], [], []]
        for field, rec, value in arrow_rows(batch, "field_name", "rec_id", "value"):
            for a, b in sentences(value):
                for col, v in zip(cols, (field, rec, a, b, value[a:b])):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW.types)], schema=_ARROW)


def sentence_units(values: DataFrame) -> DataFrame:
    """Sentence units of every value: (field_name, rec_id, start_pos, end_pos, sentence)."""
    return values.select("field_name", "rec_id", "value").mapInArrow(_segment, SCHEMA)


def found(values: DataFrame) -> DataFrame:
    return sentence_units(values).select("field_name", "rec_id", "start_pos", "end_pos").distinct()
