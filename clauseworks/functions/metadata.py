"""Classification and metadata extraction: ordered first-match rules as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clauseworks.functions import rules
from clauseworks.functions.text import strip


def _first(*options: Column) -> Column:
    return F.coalesce(*[F.nullif(o, F.lit("")) for o in options])


def standard_type(text: Column) -> Column:
    """The standard family named first in the order of precedence, else ``unknown``."""
    upper = F.upper(F.coalesce(text, F.lit("")))
    out = None
    for name, pattern in rules.STANDARD_TYPES:
        out = (F if out is None else out).when(upper.rlike(pattern), name)
    return out.otherwise("unknown")


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def title(text: Column, path: Column) -> Column:
    """First ATX heading, else h1, else the file stem in title case."""
    heading = strip(F.regexp_extract(text, r"(?mdU)^#\s+(.+)$", 1))
    h1 = strip(F.regexp_extract(text, r"(?is)<h1[^>]*>(.*?)</h1>", 1))
    return _first(heading, h1, F.initcap(F.replace(stem(path), F.lit("-"), F.lit(" "))))


def standard_id(text: Column) -> Column:
    return F.upper(F.replace(_first(*[F.regexp_extract(text, p, 1) for p in rules.STANDARD_IDS]), F.lit(" "), F.lit("")))


def standard_id_from_path(path: Column) -> Column:
    return F.upper(_first(F.regexp_extract(stem(path), rules.PATH_ID, 1)))


def iso_date(date: Column) -> Column:
    """``Y-M-D``, ``Y/M/D``, eight digits and 年月日 as ``YYYY-MM-DD``; other text unchanged."""
    loose = r"(?U)^(\d{4})[-/年](\d{1,2})[-/月](\d{1,2})"
    compact = r"(?U)^(\d{4})(\d{2})(\d{2})"
    part = lambda p, i: F.lpad(F.regexp_extract(date, p, i), 2, "0")
    parts = lambda p: F.concat_ws("-", F.regexp_extract(date, p, 1), part(p, 2), part(p, 3))
    return F.when(date.rlike(loose), parts(loose)).when(date.rlike(compact), parts(compact)).otherwise(date)


def release_date(text: Column) -> Column:
    return iso_date(_first(*[F.regexp_extract(text, p, 1) for p in rules.date_shapes(rules.RELEASE)]))


def effective_date(text: Column) -> Column:
    return iso_date(_first(*[F.regexp_extract(text, p, 1) for p in rules.date_shapes(rules.EFFECTIVE)]))


def publisher(text: Column) -> Column:
    return _first(
        strip(F.regexp_extract(text, rules.PUBLISHER_LABEL, 1)),
        F.regexp_extract(text, rules.PUBLISHER_BODIES, 0),
        strip(F.regexp_extract(text, rules.PUBLISHER_ENGLISH, 1)),
        F.regexp_extract(text, rules.PUBLISHER_ACRONYM, 1),
    )


def metadata(text: Column, path: Column, given_type: Column | None = None) -> dict[str, Column]:
    """The metadata record of one extracted text."""
    name = title(text, path)
    number = F.coalesce(standard_id(text), standard_id_from_path(path))
    by_title = standard_type(name)
    found = F.when(by_title != "unknown", by_title).otherwise(standard_type(number))
    return {
        "title": name,
        "document_type": F.coalesce(given_type, found) if given_type is not None else found,
        "standard_id": number,
        "publisher": publisher(text),
        "release_date": release_date(text),
        "effective_date": effective_date(text),
        "sha256": F.sha2(text.cast("binary"), 256),
        "confidence": F.lit("low"),
        "review_status": F.lit("draft"),
    }


def raw_folder(document_type: Column) -> Column:
    pairs = [F.lit(x) for kv in rules.RAW_FOLDERS.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), document_type), F.lit("web"))
