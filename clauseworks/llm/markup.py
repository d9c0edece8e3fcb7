r"""Problem 3: markup residue in text documents.

Every record with a mark of HTML, Markdown, wiki or LaTeX syntax is parsed into a
tree of presentation nodes (element, fence, table, heading, template ...) with
content leaves; every node knows the languages whose marks stand in it. The trees
of one host are merged into a site style tree. A content's importance joins the
entropy of its path's presentation styles with the rarity of the content (what
repeats on every page carries nothing). A branch's composite importance joins the
entropy of the styles of its whole subtree with the mean importance of the
contents below it. Removed are contents of low importance, branches all of whose
contents are low, and navigation, headers and footers whose composite importance
is low, with all that stands in them.

The found query reads the languages of the nodes that are kept; a removed branch
counts as the HTML elements that bound it. So that no mark is lost with a branch,
nodes with marks of another language are never removed, nor are headings, items,
cells, code, formulas, subscripts and superscripts outside of furniture. Digits
are masked, so that page counts repeat, only inside furniture.

Output notation: headings are lines of their own after one section sign per
level, list items start with a bullet, table cells are separated by a broken bar,
code is indented by four blanks, formulas stand between angle brackets
U+27E8 and U+27E9.

Sites: the host of a document's source_url, else its publisher; a provision has
the site of its document, else the series that leads the document_id. Only
distinct (record, path, content) rows are shuffled; removals go out by a checked
broadcast.

Defined results: null and empty values give no row; a record without marks keeps
its text; unclosed and crossed elements close at the end; unknown elements are
text; of a path deeper than ``DEEPEST`` nodes the middle ones are left out; a site
with fewer than ``MIN_PAGES`` records loses nothing; repeated rows are cleaned
each, the found query gives them once.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauseworks.llm.fields import arrow_rows
from clauseworks.llm.scale import sized
from clauseworks.session import checkpointed

LANGUAGES = ("html", "markdown", "wiki", "latex")
#: A block is removed below this importance, on sites of at least so many records.
LOW, MIN_PAGES, GAMMA = 0.2, 20, 0.9
#: Nodes of a path, the outermost and innermost half of it if there are more.
DEEPEST = 32
#: Path of what belongs to a record as a whole; it is never removed.
ROOT = "record"

# The elements of HTML.
ELEMENTS = (
    "a abbr address area article aside audio b base bdi bdo big blockquote body br button canvas caption center cite code col colgroup data dd del details dfn dialog div dl dt em embed "
    "fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark math menu meta meter nav "
    "nobr noscript object ol optgroup option output p param picture pre progress q rp rt ruby s samp script section select small source span strike strong style sub summary sup svg table "
    "tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr"
).split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header html li main menu nav ol p pre section table tbody tfoot thead tr ul title".split())
SILENT = frozenset("script style head meta link noscript template".split())
#: Parts of a page around its content, and nodes that are never removed outside of these.
FURNITURE = frozenset("aside footer header menu nav".split())
STRUCTURE = frozenset("sub sup td th tr row li item dd dt h1 h2 h3 h4 h5 h6 code pre math".split())
LATEX_HEADINGS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
LATEX_SYMBOLS = {"le": "≤", "leq": "≤", "ge": "≥", "geq": "≥", "times": "×", "cdot": "·", "pm": "±", "ldots": "…", "dots": "…", "degree": "°", "alpha": "α", "beta": "β", "mu": "μ", "Omega": "Ω", "omega": "ω", "neq": "≠", "approx": "≈"}

_NAMES = "|".join(sorted(ELEMENTS, key=len, reverse=True))
TAG = re.compile(rf"</?(?:{_NAMES})(?:\s[^<>]*)?/?>|</(?:{_NAMES})\b|<!--.*?-->|<!--|<!DOCTYPE[^>]*>|<(?:{_NAMES})(?:\s[^<>]*)?$", re.I | re.S)
REFERENCE = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
FORMULA = re.compile(r"\$\$[^$]+\$\$|(?<![A-Za-z\d$\\])\$(?=[^\s$])[^$\n]*?(?<=[^\s$\\])\$(?![\dA-Za-z$])")
LATEX = re.compile(r"\\(?:[A-Za-z]{2,}\*?|[A-Za-z](?=[{\s_^\\]))|\\[()\[\]]|\\\\\s*(?:\\hline|$)|" + FORMULA.pattern, re.M)
WIKI = re.compile(
    r"'''?[^'\n]+?'''?|^={1,6}[^=\n]+={1,6}\s*$|\[\[[^\[\]\n]+\]\]|\{\{[^{}\\\n]+\}\}|^\{\||^\|\}|^\|-\s*$|^\|[^|\n]*\|\||^![^!\n]*!!|</?(?:ref|nowiki|gallery|math)\b[^>]*>|__(?:TOC|NOTOC|FORCETOC|NOEDITSECTION)__", re.M
)
MARKDOWN = re.compile(
    r"\*\*(?=\S)[^*\n]+?\*\*|(?<!\w)__(?=\S)[^_\n]+?__(?!\w)|(?<![\w*\\])\*(?=[^\s*])[^*\n]*?(?<=[^\s*])\*(?![\w*])|(?<!\w)_(?=[^\s_])[^_\n]*?(?<=[^\s_])_(?!\w)"
    r"|^#{1,6}[ \t]+\S|^[^\s|].*\n(?:=+|-{3,})[ \t]*$|^```|^~~~|(?<!`)`[^`\n]+`(?!`)|!?\[[^\[\]\n]*\]\([^()\s]*(?:\s+\"[^\"]*\")?\)|^\|[^\n]*\|[ \t]*$|^>[ \t]|^\[[^\]\n]+\]:\s+\S|\[\^[\w-]+\]|~~[^~\n]+~~",
    re.M,
)
#: A record without any of these characters carries no mark; tested in the JVM before Python sees it.
HINT = r"[<>&\\$*_`#|{\[~'=!\u200b-\u200f\u2060\ufeff\u00ad]|-{3}"


def marks(text: str) -> list[str]:
    """The languages whose marks ``text`` carries."""
    out = []
    if TAG.search(text) or any(html.unescape(m[0]) != m[0] for m in REFERENCE.finditer(text)):
        out.append("html")
    rest = _HIDDEN.sub("", text)
    return out + _line_marks(TAG.sub(lambda m: "\n" * m[0].count("\n"), rest) if out else rest, rest)


_HIDDEN = re.compile("[\u200b-\u200f\u2060\ufeff\u00ad]")


def _line_marks(bare: str, whole: str) -> list[str]:
    """The languages other than HTML whose marks a text without elements carries; LaTeX is looked for in ``whole``."""
    out = []
    if _is_markdown(bare):
        out.append("markdown")
    if any(_is_wiki(m[0]) for m in WIKI.finditer(bare)):
        out.append("wiki")
    if LATEX.search(whole):
        out.append("latex")
    return out


def _is_wiki(mark: str) -> bool:
    """Quotation by two or three apostrophes is balanced; single apostrophes of words are not."""
    if mark.startswith("'"):
        return mark.startswith("'''") == mark.endswith("'''")
    return True


def _is_markdown(text: str) -> bool:
    formulas = FORMULA.sub(" ", text)
    formulas = re.sub(r"\\[A-Za-z]+\*?(?:\{[^{}\n]*\})*|[_^]\{[^{}]*\}", " ", formulas)
    return any(_is_markdown_mark(formulas, m) for m in MARKDOWN.finditer(formulas))


def _is_markdown_mark(text: str, m: re.Match) -> bool:
    mark = m[0]
    if mark[0] == ">":
        return _is_quote(text[m.start() :].split("\n", 1)[0], text[: m.start()])
    if mark[0] == "|" and ("||" in mark or mark.strip() in ("|-", "|}", "||")):
        return False
    return not (mark.rstrip()[-1] in "=" and "\n" in mark and mark.split("\n")[0].startswith("="))


def _is_quote(line: str, before: str) -> bool:
    """A line-initial > before a number goes on with a comparison, unless what stands before it is at its end."""
    if not re.match(r">\s*[-+−]?\d", line):
        return True
    last = before.rstrip().rsplit("\n", 1)[-1].strip()
    return not last or last[0] in ">#" or last[-1] in ".!?:;。！？：；"


#: Constructs over several lines, with all that stands inside them.
_BLOCKS = re.compile(
    r"^(```|~~~).*?(?:^\1|\Z)|^\{\|.*?(?:^\|\}|\Z)|\\begin\{(\w+\*?)\}.*?(?:\\end\{\2\}|\Z)|<(pre|code|script|style|table|head)\b[^<>]*>.*?(?:</\3\s*>|\Z)|\$\$[^$]+\$\$", re.M | re.S | re.I
)

_EXTERNAL = re.compile(r"\[[a-z]+://[^\[\]\n]*\]", re.I)


def marked_lines(text: str, langs: list[str]) -> frozenset[int]:
    """Numbers of the lines that hold a mark of ``langs`` or lie inside a marked block."""
    spans = [m.span() for m in _BLOCKS.finditer(text)] if langs else []
    if "html" in langs:
        spans += [m.span() for m in TAG.finditer(text)] + [m.span() for m in REFERENCE.finditer(text) if html.unescape(m[0]) != m[0]]
    if "wiki" in langs:
        spans += [m.span() for m in WIKI.finditer(text) if _is_wiki(m[0])] + [m.span() for m in _EXTERNAL.finditer(text)]
    if "markdown" in langs:
        spans += [m.span() for m in MARKDOWN.finditer(text) if _is_markdown_mark(text, m)]
    if "latex" in langs:
        spans += [m.span() for m in LATEX.finditer(text)]
    return frozenset(n for lo, hi in spans for n in range(text.count("\n", 0, lo), text.count("\n", 0, max(lo, hi - 1)) + 1))


class Leaf(NamedTuple):
    """Content of a record's tree: its path of nodes, their styles, and the languages of its marks."""

    path: str
    style: str
    text: str
    languages: tuple[str, ...] = ()


class _Tree(HTMLParser):
    """Leaves of a record's tree in order, the text of block leaves joined."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.styles: list[str] = []
        self.leaves: list[Leaf] = []

    def path(self) -> str:
        return "/".join(_ends(self.stack)) or "text"

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            return self.handle_data("\n")
        if tag in VOID:
            return None
        if tag in ("li", "p", "tr", "td", "th", "dd", "dt") and tag in self.stack:  # an unclosed sibling ends here
            at = len(self.stack) - 1 - self.stack[::-1].index(tag)
            if not {"table", "ul", "ol"} & set(self.stack[at:]):
                del self.stack[at:], self.styles[at:]
        self.stack.append(tag)
        self.styles.append(tag + "".join(sorted(f".{k}" for k, _ in attrs)))
        return None

    def handle_endtag(self, tag):
        if re.fullmatch("h[1-6]", tag) and tag not in self.stack:
            tag = next((t for t in reversed(self.stack) if re.fullmatch("h[1-6]", t)), tag)
        if tag in self.stack:
            at = len(self.stack) - 1 - self.stack[::-1].index(tag)
            del self.stack[at:], self.styles[at:]

    def handle_comment(self, data):
        self.leaves.append(Leaf(self.path() + "/comment", "comment", data))

    def handle_data(self, data):
        path, style = self.path(), " ".join(_ends(self.styles))
        if self.leaves and self.leaves[-1].path == path:
            self.leaves[-1] = Leaf(path, style, self.leaves[-1].text + data)
        else:
            self.leaves.append(Leaf(path, style, data))


def _ends(nodes: list[str]) -> list[str]:
    return nodes if len(nodes) <= DEEPEST else nodes[: DEEPEST // 2] + nodes[-DEEPEST // 2 :]


_NOT_TAG = re.compile(rf"<(?!/?(?:{_NAMES})(?:[\s/>])|!--|!DOCTYPE)", re.I)


def leaves(text: str, langs: list[str]) -> list[Leaf]:
    """The content leaves of a record, in order."""
    if "html" in langs:
        tree = _Tree()
        tree.feed(_NOT_TAG.sub("&lt;", text))
        tree.close()
        found = tree.leaves
    else:
        found = [Leaf("text", "text", text)]
    others = {"markdown", "wiki", "latex"} & set(langs)
    out = []
    for path, style, data, _ in found:
        nodes = path.split("/")
        own = ("html",) if "html" in langs and (nodes[0] != "text" or nodes[-1] == "comment") else ()
        if others:
            plain = _HIDDEN.sub("", data)
            own += tuple(x for x in _line_marks(plain, plain) if x in others)
        if others and not {"script", "style", "comment", "pre", "code"} & set(nodes):
            out += [Leaf(f"{path}/{kind}" if kind else path, f"{style} {kind}".strip(), body, own) for kind, body in _lines(data, langs)]
        else:
            out.append(Leaf(path, style, data, own))
    return out


def _lines(text: str, langs: list[str]) -> Iterator[tuple[str, str]]:
    """(kind, body) of the line-level constructs of Markdown, wiki and LaTeX; kind '' is running text."""
    fence, table, plain = None, False, []
    rows = text.split("\n")

    def flush():
        if plain:
            yield "", "\n".join(plain)
            plain.clear()

    i = 0
    while i < len(rows):
        line = rows[i]
        bare = line.strip("\u200b\u200c\u2060\ufeff ")
        after = rows[i + 1].strip() if i + 1 < len(rows) else ""
        i += 1
        if fence is not None:
            if bare.startswith(fence) or re.match(r"\\end\{(?:verbatim|lstlisting)\}", bare):
                yield "code", "\n".join(code)  # noqa: F821
                fence = None
            else:
                code.append(line)  # noqa: F821
            continue
        if bare[:3] in ("```", "~~~") or re.match(r"\\begin\{(?:verbatim|lstlisting)\}", bare):
            yield from flush()
            fence, code = (bare[:3] if bare[0] in "`~" else "\\end"), []
        elif m := re.match(r"(#{1,6})\s+(.*?)\s*#*$", bare):
            yield from flush()
            yield f"h{len(m[1])}", m[2]
        elif m := re.match(r"(={1,6})\s*([^=].*?)\s*={1,6}$", bare):
            yield from flush()
            yield f"h{len(m[1])}", m[2]
        elif bare and re.fullmatch(r"=+|-{3,}", after) and "markdown" in langs:
            yield from flush()
            yield ("h1" if after[0] == "=" else "h2"), bare
            i += 1
        elif m := re.match(r"\\(part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?\{(.*?)\}\s*(.*)$", bare):
            yield from flush()
            yield f"h{LATEX_HEADINGS[m[1]]}", m[2]
            if m[3]:
                plain.append(m[3])
        elif bare.startswith("{|"):
            yield from flush()
            table = True
        elif bare.startswith("|}"):
            table = False
        elif table and (bare.startswith("|-") or not bare):
            continue
        elif table or re.fullmatch(r"\|.*\|", bare):
            yield from flush()
            if not re.fullmatch(r"[|:\-\s]+", bare):
                yield "row", " ¦ ".join(c.strip() for c in re.split(r"\|\||!!|\|", bare.strip("|! ")))
        elif m := re.match(r"\\begin\{tabular\}(?:\{[^}]*\})?(.*?)(?:\\end\{tabular\})?$", bare):
            yield from flush()
            for row in re.split(r"\\\\", m[1].replace("\\hline", "")):
                if row.strip():
                    yield "row", " ¦ ".join(c.strip() for c in row.split("&"))
        elif re.match(r"\\(?:begin|end)\{", bare):
            yield from flush()
            rest = re.sub(r"\\(?:begin|end)\{[^}]*\}", "", bare).strip()
            if rest:
                plain.append(rest)
        elif m := re.match(r"(?:[-+*]|\\item|[:*#]+)\s+(.*)$", bare):
            yield from flush()
            yield "item", m[1]
        elif (m := re.match(r">\s?(.*)$", bare)) and _is_quote(bare, "\n".join(rows[: i - 1])):
            yield from flush()
            yield "quote", m[1]
        else:
            plain.append(line)
    if fence is not None:
        yield "code", "\n".join(code)
    yield from flush()


_INLINE = (
    (re.compile(r"!\[([^\]]*)\]\([^)]*\)"), r"\1"),
    (re.compile(r"\[([^\]]*)\]\([^)\s]*(?:\s+\"[^\"]*\")?\)"), r"\1"),
    (re.compile(r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]"), r"\1"),
    (re.compile(r"\{\{(?:ref|clause|cite)\|([^{}|]*)(?:\|[^{}]*)?\}\}"), r"\1"),
    (re.compile(r"\{\{[^{}]*\}\}"), ""),
    (re.compile(r"\*\*([^*\n]+?)\*\*"), r"\1"),
    (re.compile(r"'''?([^'\n]+?)'''?"), r"\1"),
    (re.compile(r"(?<!`)`([^`\n]+)`(?!`)"), r"\1"),
    (re.compile(r"~~([^~\n]+)~~"), r"\1"),
    (re.compile(r"\\(?:ref|label|cite|pageref)\{[^}]*\}"), ""),
    (re.compile(r"\\(?:[A-Za-z]+)\*?\{([^{}]*)\}"), r"\1"),
    (re.compile(r"\\([%$&_#{}])"), r"\1"),
)


def _inline(text: str) -> str:
    """Running text without inline marks; formulas kept between angle brackets."""
    kept: list[str] = []

    def keep(m: re.Match) -> str:
        kept.append(m[0].strip("$"))
        return f"\x00{len(kept) - 1}\x00"

    text = FORMULA.sub(keep, text)
    for pattern, to in _INLINE:
        text = pattern.sub(to, text)
    text = re.sub(r"\\([A-Za-z]+)", lambda m: LATEX_SYMBOLS.get(m[1], ""), text).replace("\\\\", "\n").replace("~", " ") if "\\" in text else text
    return re.sub("\x00(\\d+)\x00", lambda m: f"⟨{kept[int(m[1])]}⟩", text)


def _block(path: str) -> str:
    """The path as far as its last block; what isn't written stands by itself."""
    nodes = path.split("/")
    if SILENT & set(nodes) or nodes[-1] == "comment":
        return path
    at = max((i for i, n in enumerate(nodes) if n in BLOCK or n in ("row", "item", "quote")), default=-1)
    return "/".join(nodes[: at + 1]) or nodes[0]


def blocks(found: list[Leaf]) -> Iterator[tuple[str, int, list[Leaf]]]:
    """(path, content, leaves) of a record's blocks; the inline leaves of a block are one content."""
    for path, of in groupby(found, lambda leaf: _block(leaf.path)):
        part = list(of)
        yield path, _signature(path, "".join(leaf.text for leaf in part)), part


def _stays(path: str, part: list[Leaf]) -> bool:
    """Blanks, marks of another language than HTML, and what gives a text its structure stay however often they come."""
    text = "".join(leaf.text for leaf in part)
    if not text.strip() or any(x != "html" for leaf in part for x in leaf.languages):
        return True
    return not FURNITURE & set(path.split("/")) and (any(STRUCTURE & set(leaf.path.split("/")) for leaf in part) or bool(FORMULA.search(text) or LATEX.search(text)))


def written(found: list[Leaf], dropped: frozenset[tuple[str, int | None]] = frozenset()) -> str:
    """The clean text of a record's leaves, without the ``dropped`` (path, content) blocks; content None drops the path."""
    out: list[str] = []
    kept = found
    if dropped:
        kept = [leaf for path, content, part in blocks(found) if not {(path, content), (path, None)} & dropped or _stays(path, part) for leaf in part]
    for path, _, data, _ in kept:
        nodes = path.split("/")
        if SILENT & set(nodes) or nodes[-1] == "comment":
            continue
        if {"pre", "code"} & set(nodes) and "\n" in data or nodes[-1] == "code" or "pre" in nodes:
            if data.strip():
                out.append("\n" + "\n".join("    " + x for x in data.strip("\n").split("\n")) + "\n")
            continue
        body = _inline(data)
        heading = next((n for n in reversed(nodes) if re.fullmatch("h[1-6]", n)), None)
        if not body.strip():
            out.append("\n" if "\n" in body else " " if body else "")
        elif heading:
            out.append(f"\n\n{'§' * int(heading[1])} {body.strip()}\n")
        elif "li" in nodes or nodes[-1] == "item":
            out.append(f"\n• {body.strip()}")
        elif nodes[-1] in ("td", "th"):
            out.append(f" ¦ {body.strip()}" if out and out[-1].strip() and "tr" in nodes and out[-1][:2] in (" ¦", "\n¦") else f"\n¦ {body.strip()}")
        elif nodes[-1] == "row":
            out.append(f"\n¦ {body}")
        elif nodes[-1] in BLOCK or nodes[-1] == "quote":
            out.append(f"\n{body}\n")
        else:
            out.append(body)
    text = re.sub(r"[ \t]+\n", "\n", "".join(out))
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n")


def clean(text: str) -> str:
    """One record's clean text by itself, without a site to compare with."""
    langs = marks(text)
    return written(leaves(text, langs)) if langs else text


def _signature(path: str, text: str) -> int:
    """A stable 64-bit name of a block's content; digits are masked in the furniture of pages."""
    import hashlib

    plain = " ".join(text.split())
    if FURNITURE & set(path.split("/")):
        plain = re.sub(r"\d+", "0", plain)
    return int.from_bytes(hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


NODES = "field_name string, rec_id string, site string, path string, style string, content long, first int, stays boolean, languages array<string>"
_NODES_ARROW = pa.schema(
    [("field_name", pa.string()), ("rec_id", pa.string()), ("site", pa.string()), ("path", pa.string()), ("style", pa.string()), ("content", pa.int64()), ("first", pa.int32()), ("stays", pa.bool_()), ("languages", pa.list_(pa.string()))]
)


def nodes_of(value: str) -> Iterator[tuple[str, str, int, int, bool, list[str]]]:
    """(path, style, content, first, stays, languages) of a record's distinct (path, content); ``first`` is 1 once for each path.

    A language that no single block shows (a character reference in plain text, a
    construct across blocks) stands at the record's root.
    """
    langs = marks(value)
    if not langs:
        return
    paths: set[str] = set()
    nodes: dict[tuple[str, int], tuple] = {}
    for path, content, part in blocks(leaves(value, langs)):
        own = {x for leaf in part for x in leaf.languages}
        if (path, content) in nodes:
            style, first, stays, before = nodes[path, content]
            nodes[path, content] = style, first, stays or _stays(path, part), before | own
        else:
            nodes[path, content] = part[0].style, int(path not in paths), _stays(path, part), own
            paths.add(path)
    missing = set(langs).difference(*(n[3] for n in nodes.values()))
    if missing:
        yield ROOT, " ".join(langs), _signature(ROOT, value), 1, True, sorted(missing)
    for (path, content), (style, first, stays, own) in nodes.items():
        yield path, style, content, first, stays, sorted(own)


def _emit_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = [[] for _ in _NODES_ARROW]
        for field, rec, site, value in arrow_rows(batch, "field_name", "rec_id", "site", "value"):
            for node in nodes_of(value):
                for col, v in zip(cols, (field, rec, site, *node)):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _NODES_ARROW.types)], schema=_NODES_ARROW)


def site_of(df: DataFrame) -> Column:
    """The site of a row: host of source_url, else publisher, else the series of its document_id."""
    host = F.lower(F.regexp_extract("source_url", r"^[a-z]+://([^/:?#]+)", 1)) if "source_url" in df.columns else F.lit(None)
    publisher = F.col("publisher") if "publisher" in df.columns else F.lit(None)
    return F.coalesce(F.nullif(host, F.lit("")), publisher, _series(), F.lit("unknown"))


def _series() -> Column:
    return F.nullif(F.regexp_extract("document_id", r"^[a-z]+(?:-[a-z]+)*", 0), F.lit(""))


def with_document_sites(provisions: DataFrame, documents: DataFrame) -> DataFrame:
    """``provisions`` with the ``site`` of their document, else of their series."""
    sites = documents.where("document_id is not null").groupBy(F.col("document_id").alias("_site_id")).agg(F.min(site_of(documents)).alias("_site"))
    joined = provisions.join(sized(checkpointed(sites)), F.col("document_id") == F.col("_site_id"), "left")
    return joined.withColumn("site", F.coalesce("_site", _series(), F.lit("unknown"))).drop("_site", "_site_id")


def hinted(values: DataFrame) -> DataFrame:
    return values.where(F.col("value").rlike("(?m)" + HINT))


def _entropy(total: Column, weighted: Column) -> Column:
    """Entropy of counts n from their sum and the sum of n log n, to the base of the sum: 1 is an even spread."""
    return (F.log(total.cast("double")) - weighted / total) / F.log(F.greatest(total, F.lit(2)).cast("double"))


def style_tree(nodes: DataFrame) -> DataFrame:
    """Merged trees: (site, path, content, n, pages, importance) of the content leaves.

    Entropies are to the base of the number of pages, so 1 is an even spread. With n
    of m pages showing a content, its importance is one minus its own entropy log_m n.
    """
    by_content = nodes.groupBy("site", "path", "content").agg(F.count(F.lit(1)).alias("n"))
    styles = _styles(nodes).groupBy("site", "path").agg(F.sum("firsts").alias("pages"), F.sum("n").alias("all"), F.sum(F.col("n") * F.log("n")).alias("weighted"))
    content = F.lit(1.0) - F.log("n") / F.log(F.greatest("pages", F.lit(2)).cast("double"))
    importance = F.when(F.col("pages") > 1, (1 - GAMMA) * _entropy(F.col("all"), F.col("weighted")) + GAMMA * content).otherwise(1.0)
    return by_content.join(styles, ["site", "path"]).select("site", "path", "content", "n", "pages", importance.alias("importance"))


def _styles(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("site", "path", "style").agg(F.count(F.lit(1)).alias("n"), F.sum("first").alias("firsts"))


def _branches(df: DataFrame) -> DataFrame:
    """``df`` once for every branch (leading part of its path) that it lies in."""
    nodes = F.split("path", "/")
    return df.withColumn("branch", F.explode(F.transform(F.sequence(F.lit(1), F.size(nodes)), lambda k: F.array_join(F.slice(nodes, 1, k), "/"))))


def branch_tree(nodes: DataFrame, tree: DataFrame) -> DataFrame:
    """Composite importance of every branch: (site, branch, pages, most, composite).

    Contents and styles are first summed per path, so only rows of paths are repeated
    for their branches. ``most`` is the highest importance of a content in the branch.
    """
    per_path = tree.groupBy("site", "path").agg(F.sum(F.col("n") * F.col("importance")).alias("weight"), F.sum("n").alias("n"), F.max("importance").alias("most"), F.max("pages").alias("pages"))
    contents = _branches(per_path).groupBy("site", "branch").agg((F.sum("weight") / F.sum("n")).alias("mean"), F.max("most").alias("most"), F.max("pages").alias("pages"))
    styles = _branches(_styles(nodes)).groupBy("site", "branch", "style").agg(F.sum("n").alias("n"))
    styles = styles.groupBy("site", "branch").agg(_entropy(F.sum("n"), F.sum(F.col("n") * F.log("n"))).alias("presentation"))
    composite = (1 - GAMMA) * F.col("presentation") + GAMMA * F.col("mean")
    return contents.join(styles, ["site", "branch"]).select("site", "branch", "pages", "most", composite.alias("composite"))


def removals(nodes: DataFrame) -> DataFrame:
    """(site, path, content) of what the merged trees take out of every page; content null stands for the whole path.

    Contents that low have n above pages ** (1 - LOW / GAMMA), so a path has few of them however many pages there are.
    """
    tree = checkpointed(style_tree(nodes).where(F.col("path") != ROOT))
    often = F.col("pages") >= MIN_PAGES
    leaves_ = tree.where(often & (F.col("importance") < LOW)).select("site", "path", "content")
    furniture = F.substring_index("branch", "/", -1).isin(*sorted(FURNITURE))
    low = branch_tree(nodes, tree).where(often & (F.col("composite") < LOW) & (furniture | (F.col("most") < LOW))).select("site", "branch")
    paths = _branches(tree.select("site", "path").distinct()).join(low, ["site", "branch"], "left_semi").select("site", "path").distinct()
    return leaves_.join(paths, ["site", "path"], "left_anti").unionByName(paths.withColumn("content", F.lit(None).cast("long")))


def marked_nodes(values: DataFrame) -> DataFrame:
    """Presentation nodes of all records with marks; ``values`` is (field_name, rec_id, value, site)."""
    return hinted(values).select("field_name", "rec_id", "site", "value").mapInArrow(_emit_nodes, NODES)


def judged_nodes(nodes: DataFrame) -> DataFrame:
    """The nodes with ``kept``: neither their content nor a branch they lie in is removed by the merged trees."""
    gone = checkpointed(removals(nodes))
    one = gone.where("content is not null").withColumn("low", F.lit(True))
    whole = gone.where("content is null").select("site", "path", F.lit(True).alias("whole"))
    judged = nodes.join(sized(one), ["site", "path", "content"], "left").join(sized(whole), ["site", "path"], "left")
    return judged.withColumn("kept", F.col("stays") | ~F.coalesce("low", "whole", F.lit(False))).drop("low", "whole")


def found(values: DataFrame) -> DataFrame:
    """(field_name, rec_id, markup): languages of each record's nodes that the merged trees keep; a removed node is HTML."""
    judged = judged_nodes(checkpointed(marked_nodes(values)))
    at_node = F.when(F.col("kept"), F.col("languages")).otherwise(F.array(F.lit("html")))
    return judged.select("field_name", "rec_id", F.explode(at_node).alias("markup")).distinct()


def cleaned(values: DataFrame) -> DataFrame:
    """(field_name, rec_id, value, clean): every record's text without markup and what the merged trees remove."""
    low = checkpointed(removals(checkpointed(marked_nodes(values).drop("field_name", "rec_id", "languages"))).groupBy("site").agg(F.collect_list(F.struct("path", "content")).alias("dropped")))
    joined = values.join(sized(low), "site", "left").select("field_name", "rec_id", "value", "dropped")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, dropped in arrow_rows(batch, "value", "dropped"):
                langs = marks(value)
                out.append(written(leaves(value, langs), frozenset((x["path"], x["content"]) for x in dropped or ())) if langs else value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.string())], names=["field_name", "rec_id", "value", "clean"])

    return joined.mapInArrow(write, "field_name string, rec_id string, value string, clean string")
