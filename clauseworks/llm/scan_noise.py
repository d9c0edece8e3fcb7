"""Problem 1: noise in text from scanned pages.

1. A lexicon is counted over the clean bodies of all documents (word shapes, and
   neighbour pairs of ideographs).
2. Records laid out in lines are read page-wise: line classifiers find page
   numbers and running headers, a line-pair classifier finds words cut at line
   ends, also across furniture. Records of a single line are read as running text.
   What the lexicon's most frequent grams don't know becomes a suspect; joins with
   the whole lexicon have the last word, also on whether a cut word keeps its hyphen.
3. Correction candidates of the distinct suspects come from character q-gram
   inverted joins (ideographs: from the pairs with a hole that their neighbours
   make); a gradient-boosted ranker scores them, the best above one half wins. How
   many places the same exchange would mend is one of its features.
   In three or more unknown ideographs in a row it takes another correction close
   by, or the same exchange elsewhere, to tell misreadings from an unknown word.
4. Accepted corrections are joined back to the records; the repaired text is
   written without furniture, with cut words rejoined and paragraphs run on.

All records are read; lines with markup, or inside a marked block, are not judged
and stay as they are. The models are fitted on at most ``TRAIN_DOCUMENTS``
documents and ``SNAPSHOT`` grams, everything else covers all rows, and no result but
the fit depends on these two.

Defined results: null and empty values give no row; a record whose document is
unknown is judged without a title; an empty corpus accepts no correction; repeated
rows give one row in the found query.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseworks.llm import lookalikes, markup, misreadings, page_lines
from clauseworks.llm.boost import Boosted
from clauseworks.llm.fields import arrow_rows
from clauseworks.llm.scale import sized
from clauseworks.session import checkpointed

#: Documents laid out as training pages.
TRAIN_DOCUMENTS = 1500
#: Most frequent grams known to the readers beforehand; the rest of the lexicon is joined.
SNAPSHOT = 40_000
#: A gram counts as known from so many times on.
LEAST = 3
#: With so many unknown words, and these half of all, a record is code or another language and nothing misread.
FOREIGN = 8
_RE_SUSPECT = re.compile(lookalikes.SUSPECT)
_RE_CYRILLIC, _RE_LATIN = re.compile("[Ѐ-ӿ]"), re.compile("[A-Za-z]")


def lexicon(documents: DataFrame) -> DataFrame:
    """(kind, gram, n) over the text of all documents, grams under LEAST left out."""
    text = documents.where("text is not null").select("text")
    counted = text.mapInArrow(misreadings.count_grams, "kind string, gram string, n long")
    return checkpointed(counted.groupBy("kind", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST))


def snapshot(lex: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """The most frequent word shapes and pairs, at most SNAPSHOT of each."""
    out = []
    for kind in (misreadings.WORD, misreadings.PAIR):
        rows = lex.where(F.col("kind") == kind).orderBy(F.desc("n"), "gram").limit(SNAPSHOT).collect()
        out.append({r["gram"]: r["n"] for r in rows})
    return out[0], out[1]


def training_sample(documents: DataFrame) -> list[tuple]:
    """At most TRAIN_DOCUMENTS (text, title, number, document_id), the same whatever the partitioning."""
    every = documents.count()  # from the files' footers
    share = min(1.0, 2.0 * TRAIN_DOCUMENTS / max(1, every))
    hashed = documents.withColumn("h", F.xxhash64("doc_id")).where(F.col("h") <= min(2**63 - 1, int(share * 2**64) - 2**63))
    clean = hashed.where((F.length("text") > 80) & F.col("title").isNotNull()).select("text", "title", "standard_id", "document_id", "h")
    rows = clean.collect()  # about 2 x TRAIN_DOCUMENTS however many there are
    return [tuple(r)[:4] for r in sorted(rows, key=lambda r: (r["h"], r["text"]))[:TRAIN_DOCUMENTS]]


def document_names(documents: DataFrame) -> DataFrame:
    """(name_id, title, number, head) of every document_id; head is the first line of its text."""
    head = F.substring_index("text", "\n", 1)
    return (
        documents.where("document_id is not null")
        .groupBy(F.col("document_id").alias("name_id"))
        .agg(F.max("title").alias("title"), F.max("standard_id").alias("number"), F.max(F.when(F.length(head) < 300, head)).alias("head"))
    )


def _with_names(provisions: DataFrame, names: DataFrame) -> DataFrame:
    """``provisions`` with the ``name_id`` of their document.

    Where the provision's id doesn't go on from its document_id (a damaged or missing
    reference), the longest leading part of the id that names a document counts.
    """
    sound = F.coalesce(F.startswith(F.col("rec_id"), F.concat(F.col("document_id"), F.lit("-"))), F.lit(False))
    parts = F.split("rec_id", "-")
    heads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "-"))
    odd = provisions.where(~sound)
    asked = odd.select("rec_id").distinct().select("rec_id", F.explode(heads).alias("name_id"))
    by_id = asked.join(names.select("name_id"), "name_id").groupBy("rec_id").agg(F.max_by("name_id", F.length("name_id")).alias("head"))
    mended = odd.join(by_id, "rec_id", "left").withColumn("name_id", F.coalesce("head", "document_id")).drop("head")
    return provisions.where(sound).withColumn("name_id", F.col("document_id")).unionByName(mended)


def laid_out(tables: dict[str, DataFrame]) -> DataFrame:
    """(field_name, rec_id, value, title, number, head) of the values with line breaks; a document's own columns are at hand."""
    lines = F.col("value").contains("\n") & F.col("rec_id").isNotNull()
    docs = tables["documents"]
    head = F.substring_index("text", "\n", 1)
    own = docs.select(
        F.lit("documents.source_text").alias("field_name"), F.col("document_id").alias("rec_id"), F.col("source_text").alias("value"),
        "title", F.col("standard_id").alias("number"), F.when(F.length(head) < 300, head).alias("head"),
    ).where(lines)
    prov = tables["provisions"].select(F.lit("provisions.text").alias("field_name"), F.col("provision_id").alias("rec_id"), F.col("text").alias("value"), "document_id").where(lines)
    names = document_names(docs)
    prov = _with_names(prov, names).join(names, "name_id", "left").select("field_name", "rec_id", "value", "title", "number", "head")
    # the join leaves a document's provisions together; reading pages is the work, so it is spread by record
    return own.unionByName(prov).repartition(_spread(docs), "field_name", "rec_id")


def _spread(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)


def single_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """(field_name, rec_id, value) of the values of one line."""
    part = lambda name, rec, column: tables[name].select(F.lit(f"{name}.{column}").alias("field_name"), F.col(rec).alias("rec_id"), F.col(column).alias("value"))
    both = part("documents", "document_id", "source_text").unionByName(part("provisions", "provision_id", "text"))
    return both.where((F.col("value") != "") & ~F.col("value").contains("\n") & F.col("rec_id").isNotNull())


def plain(text: str) -> str:
    """The text with look-alike characters in their plain form, line breaks kept."""
    if not (_RE_SUSPECT.search(text) or _RE_CYRILLIC.search(text) and _RE_LATIN.search(text)):
        return text
    script = "cyr" if len(_RE_CYRILLIC.findall(text)) > len(_RE_LATIN.findall(text)) else "other"
    odd = lambda w: _RE_SUSPECT.search(w) or _RE_CYRILLIC.search(w) and (script == "other" or _RE_LATIN.search(w))
    return "\n".join(" ".join(lookalikes.plain_form(w, script)[0] if odd(w) else w for w in line.split(" ")) for line in text.split("\n"))


def plain_unmarked(text: str, marked: frozenset[int]) -> str:
    """``plain`` but for the marked lines, which stay as they are."""
    out = plain(text)
    if marked and out != text:
        out = "\n".join(a if i in marked else b for i, (a, b) in enumerate(zip(text.split("\n"), out.split("\n"))))
    return out


def stretches(page: page_lines.Page) -> Iterator[tuple[bool, list[int]]]:
    """The body lines of a page in stretches of marked and unmarked ones."""
    return ((marked, list(lines)) for marked, lines in groupby(page.body, page.marked.__contains__))


def run_on(page: page_lines.Page, joint: str) -> list[str]:
    """The unmarked stretches of a page's body as running text; cut words are joined by ``joint``."""
    cut = {a for a, _ in page.joints}
    wide = sum(len(misreadings.IDEOGRAPH.findall(page.lines[i])) for i in page.body)
    latin = sum(len(_RE_LATIN.findall(page.lines[i])) + len(_RE_CYRILLIC.findall(page.lines[i])) for i in page.body)
    gap = "" if wide * 2 > latin else " "
    return ["".join(page.lines[i].rstrip()[:-1] + joint if i in cut else page.lines[i] + gap for i in lines) for marked, lines in stretches(page) if not marked]


def _names(title, number, head, rec_id):
    if head and (title is None or number is None):
        parts = re.split(r"\s{2,}|　| (?=[A-Z]{2,}[ /]|〔)", head, maxsplit=1)
        title = title or parts[0]
        number = number or (parts[1] if len(parts) > 1 else None)
    return page_lines.names_of(title, number, rec_id)


_READ = "field_name string, rec_id string, hyphen boolean, header boolean, page boolean, suspects array<struct<kind:string,unit:string>>, cuts array<string>, size int"
_UNITS = pa.list_(pa.struct([("kind", pa.string()), ("unit", pa.string())]))
_READ_ARROW = pa.schema([("field_name", pa.string()), ("rec_id", pa.string()), ("hyphen", pa.bool_()), ("header", pa.bool_()), ("page", pa.bool_()), ("suspects", _UNITS), ("cuts", pa.list_(pa.string())), ("size", pa.int32())])
_AT_ONCE = 300


def _pages(batch: pa.RecordBatch, models: page_lines.Models) -> Iterator[tuple]:
    """(field, rec_id, value, page) of a batch's records; lines with markup are not judged."""
    rows = list(arrow_rows(batch, "field_name", "rec_id", "value", "title", "number", "head"))
    for lo in range(0, len(rows), _AT_ONCE):
        part = rows[lo : lo + _AT_ONCE]
        marked = [markup.marked_lines(r[2], markup.marks(r[2])) for r in part]
        records = [(plain_unmarked(v, kept), _names(t, n, h, rec)) for (_, rec, v, t, n, h), kept in zip(part, marked)]
        for row, page in zip(part, page_lines.read_pages(records, models, marked)):
            yield row[0], row[1], row[2], page


def read(values: DataFrame, models: page_lines.Models, words: dict[str, int], pairs: dict[str, int]) -> DataFrame:
    """One row per page-like record: its kinds of noise and its suspicious units."""
    known_words, known_pairs = frozenset(words), frozenset(pairs)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for field, rec, _, page in _pages(batch, models):
                body = run_on(page, misreadings.JOINT)
                heads = " \n".join(s for s, h in zip(page.lines, page.header) if h)
                units = {u for part in (*body, heads) for u in misreadings.suspects(part, known_words, known_pairs)}
                if page.joints or any(page.page) or any(page.header) or units:
                    out.append({"field_name": field, "rec_id": rec, "hyphen": bool(page.joints), "header": any(page.header), "page": any(page.page), "suspects": [{"kind": k, "unit": u} for k, u in sorted(units)], "cuts": sorted({cut_word(page, *joint) for joint in page.joints}), "size": sum(map(units_in, body))})
            yield pa.RecordBatch.from_pylist(out, schema=_READ_ARROW)

    return values.mapInArrow(go, _READ)


def read_lines(values: DataFrame, words: dict[str, int], pairs: dict[str, int]) -> DataFrame:
    """The same of values of one line: no furniture, no cut words."""
    known_words, known_pairs = frozenset(words), frozenset(pairs)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for field, rec, value in arrow_rows(batch, "field_name", "rec_id", "value"):
                text = plain(value)
                units = set(misreadings.suspects(text, known_words, known_pairs))
                if units and not markup.marks(value):
                    out.append({"field_name": field, "rec_id": rec, "hyphen": False, "header": False, "page": False, "suspects": [{"kind": k, "unit": u} for k, u in sorted(units)], "cuts": [], "size": units_in(text)})
            yield pa.RecordBatch.from_pylist(out, schema=_READ_ARROW)

    return values.mapInArrow(go, _READ)


def units_in(text: str) -> int:
    """Words and ideographs of a text."""
    return len(misreadings.TOKEN.findall(text)) + len(misreadings.IDEOGRAPH.findall(text))


def cut_word(page: page_lines.Page, a: int, b: int) -> str:
    """Shapes of the letters before and after the cut between two lines, with JOINT between them."""
    left, right = page.lines[a].rstrip()[:-1], page.lines[b].lstrip()
    i, j = len(left), 0
    while i and left[i - 1].isalpha():
        i -= 1
    while j < len(right) and right[j].isalpha():
        j += 1
    return misreadings.shape(left[i:]) + misreadings.JOINT + misreadings.shape(right[:j])


def cut_words(units: DataFrame, words: DataFrame) -> DataFrame:
    """(unit, whole, apart): does the lexicon hold a cut word in one, and each of its parts?"""
    asked = units.select("unit").distinct()
    whole = asked.select("unit", F.translate("unit", misreadings.JOINT, "").alias("w")).join(words, "w", "left_semi").select("unit", F.lit(True).alias("whole"))
    parts = asked.select("unit", F.explode(F.array_distinct(F.split("unit", misreadings.JOINT))).alias("w"))
    strange = parts.join(words, "w", "left_anti").select("unit").distinct().withColumn("strange", F.lit(True))
    joined = asked.join(whole, "unit", "left").join(strange, "unit", "left")
    return joined.select("unit", F.coalesce("whole", F.lit(False)).alias("whole"), F.col("strange").isNull().alias("apart"))


def candidates(units: DataFrame, lex: DataFrame) -> DataFrame:
    """(kind, unit, n_unit, cand, shared, grams, n_cand, n_left, n_right) by q-gram inverted joins.

    Words meet lexicon words of nearly their length through shared q-grams, keyed by
    length and gram; ideographs meet those that stand beside the same neighbours.
    """
    size = F.length("w")
    grams = F.expr("array_distinct(transform(sequence(1, length(w) + 3 - q), i -> substring(concat('^', w, '$'), i, q)))")
    of_length = F.when(F.col("size") <= 4, 2).otherwise(3).alias("q")
    words = lex.where(F.col("kind") == misreadings.WORD).select(F.col("gram").alias("w"), F.col("n").alias("n_cand"))
    posting = words.select("w", "n_cand", size.alias("size")).select("w", "n_cand", "size", of_length).select(F.col("w").alias("cand"), "n_cand", "size", F.explode(grams).alias("g"))
    longest = words.agg(F.max(F.length("w"))).first()[0] or 0  # a longer unit has no candidate
    asked = units.where((F.col("kind") == misreadings.WORD) & (F.length("unit") <= longest + misreadings.REACH)).select(F.col("unit").alias("w"), "n_unit")
    asked = asked.withColumn("size", F.explode(F.sequence(F.greatest(size - misreadings.REACH, F.lit(1)), size + misreadings.REACH))).select("w", "n_unit", "size", of_length)
    asked = asked.where(size + 2 >= F.col("q")).withColumn("gs", grams).select(F.col("w").alias("unit"), "n_unit", "size", F.size("gs").alias("grams"), F.explode("gs").alias("g"))
    by_word = (
        asked.join(posting, ["size", "g"])
        .groupBy("unit", "cand")
        .agg(F.first("n_unit").alias("n_unit"), F.count(F.lit(1)).alias("shared"), F.first("grams").alias("grams"), F.first("n_cand").alias("n_cand"))
        .where((F.col("shared") * 8 >= F.col("grams")) & (F.col("unit") != F.col("cand")))
        .select(F.lit(misreadings.WORD).alias("kind"), "unit", "n_unit", "cand", "shared", "grams", "n_cand", F.lit(0).cast("long").alias("n_left"), F.lit(0).cast("long").alias("n_right"))
    )
    pairs = lex.where(F.col("kind") == misreadings.PAIR)
    first, second = F.substring("gram", 1, 1), F.substring("gram", 2, 1)
    holes = pairs.select(F.concat(first, F.lit("_")).alias("g"), second.alias("cand"), "n").union(pairs.select(F.concat(F.lit("_"), second), first, "n"))
    asked = units.where(F.col("kind") == misreadings.PAIR).select("unit", "n_unit")
    left, right = F.concat(F.substring("unit", 1, 1), F.lit("_")), F.concat(F.lit("_"), F.substring("unit", 3, 1))
    sides = asked.select("unit", "n_unit", left.alias("g")).union(asked.select("unit", "n_unit", right))
    edge = F.col("unit").startswith("^") | F.col("unit").endswith("$")
    by_pair = (
        sides.join(holes, "g")
        .groupBy("unit", "cand")
        .agg(
            F.first("n_unit").alias("n_unit"),
            F.count(F.lit(1)).alias("shared"),
            F.max(F.when(F.col("g").endswith("_"), F.col("n"))).alias("l"),
            F.max(F.when(F.col("g").startswith("_"), F.col("n"))).alias("r"),
        )
        .where((F.col("shared") >= F.when(edge, 1).otherwise(2)) & (F.col("cand") != F.substring("unit", 2, 1)) & F.col("cand").rlike(misreadings.IDEOGRAPH.pattern))
        .select(F.lit(misreadings.PAIR).alias("kind"), "unit", "n_unit", "cand", F.lit(2).cast("long").alias("shared"), F.lit(2).alias("grams"), F.lit(0).cast("long").alias("n_cand"), F.coalesce("l", "r").alias("n_left"), F.coalesce("r", "l").alias("n_right"))
    )
    return by_word.unionByName(by_pair)


def corrections(units: DataFrame, lex: DataFrame, ranker: Boosted) -> DataFrame:
    """(kind, unit, cand, score): the best candidate of every unit that the ranker accepts.

    An ideograph is mistaken for the same other one in many places: in how many units
    the exchange is a candidate, how that compares with the unit's other candidates,
    and how many these are, are features.
    """
    import numpy as np

    names = ("kind", "unit", "cand", "shared", "grams", "n_cand", "n_unit", "n_left", "n_right", "places", "most", "rivals")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [misreadings.features(*row) for row in arrow_rows(batch, *names)]
            s = ranker.scores(np.array(x, float)) if x else np.zeros(0)
            cols = [batch.column(batch.schema.get_field_index(n)) for n in ("kind", "unit", "cand")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(s, pa.float64())], names=["kind", "unit", "cand", "score"])

    every = checkpointed(candidates(units, lex))
    pair, wrong = F.col("kind") == misreadings.PAIR, F.substring("unit", 2, 1)
    places = every.where(pair).groupBy("kind", wrong.alias("wrong"), "cand").agg(F.count(F.lit(1)).alias("places"))
    every = every.withColumn("wrong", F.when(pair, wrong)).join(places, ["kind", "wrong", "cand"], "left").withColumn("places", F.coalesce("places", F.lit(0)))
    of_unit = Window.partitionBy("kind", "unit")
    every = every.withColumns({"most": F.max("places").over(of_unit), "rivals": F.count(F.lit(1)).over(of_unit)})
    scored = every.select(*names).repartition(_spread(units), "unit").mapInArrow(score, "kind string, unit string, cand string, score double").where("score > 0.5")
    best = F.row_number().over(Window.partitionBy("kind", "unit").orderBy(F.desc("score"), "cand"))
    return scored.withColumn("r", best).where("r = 1").select("kind", "unit", "cand", "score")


def run_places(runs: DataFrame) -> DataFrame:
    """(run, n, at, kind, unit): every ideograph of the distinct long runs, as a unit between its neighbours."""
    each = F.expr("transform(sequence(2, length(run) - 1), i -> substring(run, i - 1, 3))")
    return runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).select("run", "n", F.posexplode(each).alias("at", "unit")).withColumn("kind", F.lit(misreadings.PAIR))


def run_fixes(places: DataFrame, unknown: DataFrame, fixes: DataFrame, alone: DataFrame) -> DataFrame:
    """(run, kind, unit, cand): the corrections of long runs that are misreadings and no word the corpus lacks.

    What the whole lexicon knows divides a run first. In what is still long, a
    correction counts if another one stands at most two places away (a single sound
    character between them) or the same exchange is accepted outside of long runs.
    """
    wrong = F.substring("unit", 2, 1)
    left = places.join(unknown.select("kind", "unit"), ["kind", "unit"], "left_semi").join(fixes.select("kind", "unit", "cand"), ["kind", "unit"], "left")
    left = left.withColumn("part", F.col("at") - F.row_number().over(Window.partitionBy("run").orderBy("at")))
    part = Window.partitionBy("run", "part")
    near = part.orderBy("at").rangeBetween(-2, 2)
    left = checkpointed(left.withColumns({"long": F.count(F.lit(1)).over(part), "near": F.count("cand").over(near), "wrong": wrong}).where("cand is not null"))
    short = F.col("long") < misreadings.LONG
    seen = alone.join(sized(fixes), ["kind", "unit"]).where(F.col("kind") == misreadings.PAIR).select(wrong.alias("wrong"), "cand")
    seen = seen.union(left.where(short).select("wrong", "cand")).distinct().withColumn("seen", F.lit(True))
    backed = short | (F.col("near") > 1) | F.col("seen").isNotNull()
    return left.join(seen, ["wrong", "cand"], "left").where(backed).select("run", "kind", "unit", "cand").distinct()


class Reading:
    """The stages of one run, each computed once."""

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        docs = tables["documents"]
        self.lex = lexicon(docs)
        self.words, self.pairs = snapshot(self.lex)
        self.models = page_lines.train(training_sample(docs)) if self.words else None
        self.values = laid_out(tables)
        if self.models is None:
            self.models = page_lines.train([("a b c d e f g h", "t", "1", "d-1")] * 4)
        lines = read_lines(single_lines(tables), self.words, self.pairs)
        self.records = checkpointed(read(self.values, self.models, self.words, self.pairs).unionByName(lines))
        self.known = self.lex.where(F.col("kind") == misreadings.WORD).select(F.col("gram").alias("w"))
        units = self.records.select("field_name", "rec_id", "size", F.inline("suspects"))
        cut = F.col("kind") == misreadings.CUT
        joined = cut_words(units.where(cut), self.known).where("not whole and not apart").select("unit")
        words = units.where(cut).join(joined, "unit", "left_semi").select("field_name", "rec_id", "size", F.lit(misreadings.WORD).alias("kind"), F.translate("unit", misreadings.JOINT, "").alias("unit"))
        alone, runs = units.where(~cut & (F.col("kind") != misreadings.RUN)).unionByName(words), units.where(F.col("kind") == misreadings.RUN).withColumnRenamed("unit", "run")
        places = run_places(runs)
        counted = alone.groupBy("kind", "unit").agg(F.count(F.lit(1)).alias("n")).unionByName(places.select("kind", "unit", "n"))
        distinct = checkpointed(unknown_units(counted.groupBy("kind", "unit").agg(F.sum("n").alias("n_unit")), self.lex))
        alone = checkpointed(judged(alone, distinct))
        asked = alone.select("kind", "unit").union(places.select("kind", "unit")).distinct()
        distinct = checkpointed(distinct.join(asked, ["kind", "unit"], "left_semi"))
        self.fixes = checkpointed(corrections(distinct, self.lex, misreadings.train_ranker(self.words, self.pairs)))
        in_runs = checkpointed(run_fixes(places, distinct, self.fixes, alone))
        columns = ("field_name", "rec_id", "kind", "unit", "cand")
        self.misread = alone.join(sized(self.fixes), ["kind", "unit"]).select(*columns).unionByName(runs.drop("kind").join(sized(in_runs), "run").select(*columns))


def judged(alone: DataFrame, unknown: DataFrame) -> DataFrame:
    """Units that the lexicon lacks, but for records that are no text of the corpus: FOREIGN or more words, half of all or more, unknown."""
    left = checkpointed(alone.join(unknown.select("kind", "unit"), ["kind", "unit"], "left_semi"))
    n = F.count_if(F.col("kind") == misreadings.WORD)
    foreign = left.groupBy("field_name", "rec_id").agg(n.alias("n"), F.max("size").alias("size")).where((F.col("n") >= FOREIGN) & (F.col("n") * 2 >= F.col("size")))
    return left.join(foreign.select("field_name", "rec_id"), ["field_name", "rec_id"], "left_anti")


def unknown_units(units: DataFrame, lex: DataFrame) -> DataFrame:
    """``units`` without the words and pairs of the whole lexicon; an ideograph is unknown by both of its pairs."""
    words = lex.where(F.col("kind") == misreadings.WORD).select("kind", F.col("gram").alias("unit"))
    pairs = lex.where(F.col("kind") == misreadings.PAIR).select("gram")
    ideographs = units.where(F.col("kind") == misreadings.PAIR)
    for at in (1, 2):
        ideographs = ideographs.join(pairs, F.substring("unit", at, 2) == F.col("gram"), "left_anti")
    return units.where(F.col("kind") == misreadings.WORD).join(words, ["kind", "unit"], "left_anti").unionByName(ideographs)


def found(tables: dict[str, DataFrame]) -> DataFrame:
    """(field_name, rec_id, noise) of every record with scan noise."""
    run = Reading(tables)
    flags = [F.when(F.col(c), F.lit(c)) for c in ("hyphen", "header", "page")]
    kinds = run.records.select("field_name", "rec_id", F.explode(F.filter(F.array(*flags), lambda x: x.isNotNull())).alias("noise"))
    return kinds.union(run.misread.select("field_name", "rec_id", F.lit("misread"))).distinct()


_LIST_ITEM = re.compile(r"^\s*(?:[a-zA-Z0-9]{1,3}[)）.]|[-+*•])\s*")
_FINAL = re.compile(r"[.!?…。！？।；;:：][\"”’»)）」』]*\s*$")


def paragraphs(page: page_lines.Page, hyphened: frozenset[str], fixes: dict[tuple[str, str], str]) -> str:
    """A page as paragraphs: furniture gone, cut words whole but for the ``hyphened``, accepted corrections made; marked lines as they are."""
    cut = {a for a, _ in page.joints}
    usual = sorted(len(page.lines[i]) for i in page.body)[len(page.body) * 3 // 4] if page.body else 0
    wide = sum(len(misreadings.IDEOGRAPH.findall(page.lines[i])) for i in page.body) * 2 > sum(len(_RE_LATIN.findall(page.lines[i])) for i in page.body)
    whole, last = "", None
    for marked, lines in stretches(page):
        if last is not None:
            whole += "\n\n" if any(not page.lines[j].strip() for j in range(last + 1, lines[0])) else "\n"
        if marked:
            whole += "\n".join(page.lines[j] for j in range(lines[0], lines[-1] + 1) if not page.page[j] and not page.header[j])
        else:
            whole += corrected(_paragraphs(page, lines, cut, usual, wide, hyphened), fixes)
        last = lines[-1]
    return whole


def _paragraphs(page: page_lines.Page, body: list[int], cut: set[int], usual: int, wide: bool, hyphened: frozenset[str]) -> str:
    out = ""
    for k, i in enumerate(body):
        line = page.lines[i]
        if k:
            prev = body[k - 1]
            blank = any(not page.lines[j].strip() for j in range(prev + 1, i)) and not any(page.page[j] or page.header[j] for j in range(prev + 1, i))
            if prev in cut:
                out += ("-" if cut_word(page, prev, i) in hyphened else "") + line.lstrip()
                line = ""
            elif _FINAL.search(out) and (blank or len(page.lines[prev]) < 0.75 * usual) or _LIST_ITEM.match(line) and _FINAL.search(out):
                out += "\n" + line.lstrip()
                line = ""
            else:
                out += "" if wide else " "
        out += (line.rstrip() if not wide else line) if line else ""
        if i in cut:
            out = out.rstrip()[:-1]
    return out


def corrected(text: str, fixes: dict[tuple[str, str], str]) -> str:
    """``text`` with the accepted corrections of its units; case and digits are kept."""

    def word(m: re.Match) -> str:
        fix = fixes.get((misreadings.WORD, misreadings.shape(m[0])))
        if fix is None:
            return m[0]
        if "0" in fix and len(fix) == len(m[0]):
            digits = m[0].translate(page_lines.DIGIT_LOOKS)
            return "".join(d if f == "0" else (c if c.lower() == f else f) for c, d, f in zip(m[0], digits, fix))
        return fix.upper() if m[0].isupper() and len(m[0]) > 1 else fix.capitalize() if m[0][0].isupper() else fix

    text = misreadings.TOKEN.sub(word, text)
    for (kind, unit), cand in fixes.items():
        if kind == misreadings.PAIR:
            near = [re.escape(c) if c not in "a^$" else {"a": r"[A-Za-z0-9]", "^": "^", "$": "$"}[c] for c in (unit[0], unit[2])]
            text = re.sub(f"({near[0]}\\s*){re.escape(unit[1])}(?=\\s*{near[1]})", lambda m: m[1] + cand, text)  # noqa: B023
    return text


def repaired(tables: dict[str, DataFrame]) -> DataFrame:
    """(field_name, rec_id, repaired): page-like records as continuous paragraphs, one-line records with their corrections."""
    run = Reading(tables)
    fixes = run.misread.groupBy("field_name", "rec_id").agg(F.collect_set(F.struct("kind", "unit", "cand")).alias("fixes"))
    cuts = run.records.select("field_name", "rec_id", F.explode("cuts").alias("unit"))
    hyphened = cuts.join(sized(checkpointed(cut_words(cuts, run.known).where("apart and not whole").select("unit"))), "unit")
    hyphened = hyphened.groupBy("field_name", "rec_id").agg(F.collect_set("unit").alias("hyphened"))
    noisy = run.records.select("field_name", "rec_id").distinct()
    values = run.values.join(noisy, ["field_name", "rec_id"]).join(fixes, ["field_name", "rec_id"], "left").join(hyphened, ["field_name", "rec_id"], "left")
    lines = single_lines(tables).join(fixes, ["field_name", "rec_id"])
    models = run.models
    of = lambda fixes: {(x["kind"], x["unit"]): x["cand"] for x in fixes or ()}

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {(f, r, v): (of(x), frozenset(h or ())) for f, r, v, x, h in arrow_rows(batch, "field_name", "rec_id", "value", "fixes", "hyphened")}
            rows = [(f, r, paragraphs(page, own[f, r, v][1], own[f, r, v][0])) for f, r, v, page in _pages(batch, models)]
            yield _named(rows)

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _named([(f, r, corrected(plain(v), of(x))) for f, r, v, x in arrow_rows(batch, "field_name", "rec_id", "value", "fixes")])

    schema = "field_name string, rec_id string, repaired string"
    return values.mapInArrow(go, schema).unionByName(lines.mapInArrow(mend, schema))


def _named(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in list(zip(*rows)) or [(), (), ()]], names=["field_name", "rec_id", "repaired"])
