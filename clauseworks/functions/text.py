"""Text normalisation as Column functions (nulls give nulls unless said otherwise)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseworks.functions import rules


def strip(c: Column) -> Column:
    """Without surrounding white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def slugify(c: Column) -> Column:
    """Lower case, anything but letters, digits, ``_`` and ``-`` as one ``-``."""
    dashed = F.regexp_replace(strip(F.lower(c)), r"(?U)[^\w\-]+", "-")
    return F.regexp_replace(F.regexp_replace(dashed, "-+", "-"), "^-+|-+$", "")


def drop_pictures(c: Column) -> Column:
    return F.regexp_replace(c, rules.PICTURE, "")


def unwrap_brackets(c: Column) -> Column:
    """``[X]`` as X where X is wholly ideographs and wide punctuation; other brackets stay."""
    return F.regexp_replace(c, rules.BRACKETED, "$1$2")


def normalise_standard_tokens(c: Column) -> Column:
    for pattern, to in rules.STANDARD_TOKENS:
        c = F.regexp_replace(c, pattern, to)
    return c


def collapse_cjk_gaps(c: Column) -> Column:
    """Lines with several gaps between ideographs lose them."""

    def line(x: Column) -> Column:
        return F.when(F.regexp_count(x, F.lit(rules.CJK_GAP)) >= rules.GAPS_PER_LINE, F.regexp_replace(x, rules.CJK_GAP, "")).otherwise(x)

    return F.array_join(F.transform(F.split(c, "\n", -1), line), "\n")


def split_joined_english(c: Column) -> Column:
    return F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")


def drop_breaks(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)<br\s*/?>", "")


def collapse_blank_lines(c: Column) -> Column:
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def lines_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, line) of every line."""
    return df.select(key, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))


def joined_lines(lines: DataFrame, key: str, text: str) -> DataFrame:
    """The lines of every key in order, as one text again."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return lines.groupBy(key).agg(F.array_join(F.transform(rows, lambda r: r["line"]), "\n").alias(text))


def _squashed(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[\s|]+", "")


def table_title_lines(lines: DataFrame, key: str) -> DataFrame:
    """Lines with ``repeats`` true for table rows that only repeat a title just above.

    A row with ``|`` repeats one of the last three filled lines without ``|`` if one
    squashed content holds the other and the row's has more than five characters.
    """
    plain = (~F.col("line").contains("|")) & (strip(F.col("line")) != "")
    own = _squashed(F.col("line"))
    separator = F.col("line").rlike(r"(?U)^[\s|:\-]*$")
    # a filled line knows the two filled ones before it; the last filled line's three are carried on to the rows below it
    filled = Window.partitionBy(key, "plain").orderBy("pos")
    above = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    known = lines.withColumns({"own": own, "plain": plain}).repartition(key)  # one exchange for both windows
    three = F.when(F.col("plain"), F.array("own", F.lag("own", 1).over(filled), F.lag("own", 2).over(filled)))
    known = known.withColumn("three", three).withColumn("titles", F.last("three", ignorenulls=True).over(above))
    repeats = F.coalesce(F.exists("titles", lambda t: F.coalesce(t.contains(F.col("own")) | F.col("own").contains(t), F.lit(False))), F.lit(False))
    return known.withColumn("repeats", F.col("line").contains("|") & ~separator & (F.length("own") > rules.TITLE_CHARS) & repeats).drop("titles", "three", "own", "plain")


def page_noise_lines(lines: DataFrame, key: str) -> DataFrame:
    """Lines with ``noise`` true for page numbers, catalogue lines, and repeats of a standard's header."""
    header = F.col("line").rlike(rules.STANDARD_HEADER)
    norm = F.when(header, F.upper(F.regexp_replace("line", r"(?U)\s+", "")))
    nth = F.row_number().over(Window.partitionBy(key, "norm").orderBy("pos"))
    marked = lines.withColumn("norm", norm).withColumn("nth", nth)
    noise = (strip(F.col("line")) == "SAC") | F.col("line").rlike(rules.ICS_LINE) | F.col("line").rlike(rules.PAGE_NUMBER) | (F.col("norm").isNotNull() & (F.col("nth") > 1))
    return marked.withColumn("noise", noise).drop("norm", "nth")


def cleaned(df: DataFrame, key: str, text: str) -> DataFrame:
    """The whole cleaning in its fixed order: (key, text)."""
    c = F.col(text)
    for f in (drop_pictures, unwrap_brackets, normalise_standard_tokens, collapse_cjk_gaps, split_joined_english, drop_breaks):
        c = f(c)
    lines = lines_of(df.select(key, c.alias(text)), key, text)
    lines = table_title_lines(lines, key).where(~F.col("repeats")).select(key, "pos", "line")
    lines = page_noise_lines(lines, key).where(~F.col("noise"))
    return joined_lines(lines, key, text).withColumn(text, collapse_blank_lines(F.col(text)))


def quality(text: Column, pages: Column) -> dict[str, Column]:
    """Measures of extracted text and whether it is poor."""
    n = F.greatest(pages, F.lit(1))
    filled = F.size(F.filter(F.split(text, "\n", -1), lambda x: strip(x) != ""))
    omitted = ((F.length(text) - F.length(F.replace(text, F.lit(rules.OMITTED), F.lit("")))) / len(rules.OMITTED)).cast("int")
    runs = F.regexp_count(text, F.lit("[A-Za-z]{50,}"))
    average = F.length(text) / n
    return {
        "total_chars": F.length(text),
        "n_lines": filled,
        "omitted_images": omitted,
        "long_runs": runs,
        "avg_chars_per_page": average,
        "is_poor": (average < rules.POOR_AVERAGE) | (omitted > 0.5 * pages) | (runs > 10),
    }


def shortened(c: Column, n: int, mark: str = "…") -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit(mark))).otherwise(c)


def like_escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\%_])", r"\\$1")


def has_cjk(c: Column) -> Column:
    return c.rlike(r"[一-鿿]")


# HTML, by patterns alone

_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&ge;", "≥"), ("&le;", "≤"), ("&amp;", "&"))


def decoded(c: Column) -> Column:
    """The character references that text extraction leaves behind."""
    for a, b in _ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def html_title(html: Column, slug: Column) -> Column:
    title = strip(decoded(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))
    return F.coalesce(F.nullif(title, F.lit("")), slug)


def html_markdown(html: Column) -> Column:
    """Markdown with ATX headings and ``-`` bullets; scripts, styles and the head are left out."""
    c = F.regexp_replace(html, r"(?is)<(script|style|noscript|head)\b.*?</\1>|<(?:meta|link)\b[^>]*>|<!--.*?-->", "")
    for level in range(1, 7):
        c = F.regexp_replace(c, rf"(?is)<h{level}\b[^>]*>\s*(.*?)\s*</h\d>", "\n\n" + "#" * level + " $1\n\n")
    c = F.regexp_replace(c, r"(?is)<li\b[^>]*>\s*", "\n- ")
    c = F.regexp_replace(c, r"(?is)<br\s*/?>|</?(?:p|div|ul|ol|tr|table|body|html)\b[^>]*>", "\n")
    c = F.regexp_replace(c, r"(?is)</t[dh]>\s*<t[dh]\b[^>]*>", " | ")
    c = F.regexp_replace(c, r"(?s)</?[a-zA-Z][^<>]*>", "")
    return collapse_blank_lines(decoded(F.regexp_replace(c, r"[ \t]+\n", "\n")))


def attachment_links(html: Column, base_url: Column) -> Column:
    """Sorted distinct absolute links to documents, by their suffix."""
    hrefs = F.regexp_extract_all(html, F.lit(r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))
    suffix = r"(?i)\.(?:" + "|".join(s[1:] for s in rules.ATTACHMENTS) + r")$"
    origin = F.regexp_extract(base_url, r"^[a-zA-Z]+://[^/]+", 0)
    folder = F.regexp_replace(base_url, r"[^/]*$", "")

    def absolute(h: Column) -> Column:
        return F.when(h.rlike("(?i)^https?://"), h).when(h.startswith("/"), F.concat(origin, h)).otherwise(F.concat(folder, h))

    return F.array_sort(F.array_distinct(F.transform(F.filter(hrefs, lambda h: h.rlike(suffix)), absolute)))


def relinked_assets(markdown: Column, folder: Column) -> Column:
    """Image links into ``folder``; absolute and data links stay."""
    return F.regexp_replace(markdown, F.lit(r"!\[([^\]]*)\]\((?!https?://|data:)(?:[^)/]*/)*([^)/]+)\)"), F.concat(F.lit(r"![$1]("), folder, F.lit(r"/$2)")))
