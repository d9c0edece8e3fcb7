"""Problem 2: text that looks the same in different characters.

Words (stretches between ordinary blanks and punctuation) that hold anything but
their script's plain characters are collected, mapped to the form they look like,
and grouped in SQL by that form under the accent-sensitive ``UNICODE`` collation:
zero-width characters and the order or composition of accents do not matter to
it, accents and case do. Each class also has its mapped form as a member. The
canonical member is chosen deterministically: plain members first, then the one
written most often, then the least string. It is joined back to every word.

Only distinct suspicious words reach a shuffle; records without one are passed over
by one character-class search in an Arrow-batched map.

Defined results: null and empty values give no row and stay as they are; a value
of nothing but zero-width characters becomes empty; tabs and line breaks stay;
superscripts, unit signs, ordinary wide punctuation, symbols such as the Greek
letters of units, and each language's own script are left alone; repeated rows
are normalised each, the found query gives them once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clauseworks.llm.fields import arrow_rows
from clauseworks.session import checkpointed

VARIANTS = ("width", "combining", "invisible", "space", "lookalike")

# Letters of other scripts that look like a Latin letter, and the radicals
# without a compatibility mapping in Unicode that look like an ideograph.
CYRILLIC_LATIN = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝѵьЬѴҮ", "ABESIJKMHOPCTYXaesijopcyxhdqwvbbVY"))
GREEK_LATIN = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοιν", "ABEZHIKMNOPTYXoiv"))
LATIN_CYRILLIC = dict(zip("ABEKMHOPCTYXSIJaeopcyxsij", "АВЕКМНОРСТУХЅІЈаеорсухѕіј"))
RADICAL_IDEOGRAPH = dict(zip("⺁⺄⺅⺈⺉⺋⺌⺍⺎⺏⺐⺑⺒⺓⺔⺖⺗⺘⺙⺛⺝⺞⺟⺠⺡⺢⺣⺥⺨⺩⺫⺬⺭⺮⺰⺱⺲⺴⺶⺷⺸⺺⺽⻀⻂⻃⻄⻅⻆⻇⻈⻉⻋⻌⻍⻎⻏⻐⻑⻒⻓⻔⻖⻗⻘⻙⻚⻛⻜⻝⻟⻠⻢⻣⻤⻥⻦⻧⻨⻩⻪⻬⻮⻰⻲⻳",
                             "厂乙亻⺈刂㔾小小尢尢尢巳巳幺彑忄心扌攵旡月歺母民氵氺灬爫犭王罒示礻竹纟罓罒网羊羊羊肀臼艹衤覀西见角角讠贝车辶辶辶阝钅長长长门阝雨青韦页风飞食飠饣马骨鬼鱼鸟卤麦黄黾齐齿龙龟龟"))

_INVISIBLE = "­͏؜ᅟᅠ᠋-᠎​-‏‪-‮⁠-⁤⁦-⁯ㅤ︀-️﻿ﾠ"
_SPACES = "   -   　"
_WIDTH = "０-９Ａ-Ｚａ-ｚｦ-ﾟ"
_MARKS = "̀-͎͐-ͯٓ-़ٕ᷀-゙゚᷿"
_RADICALS = "\u2e80-\u2ef3\u2f00-\u2fd5\uf900-\ufaff"
_LOOK_OTHER = "".join(CYRILLIC_LATIN) + "".join(GREEK_LATIN)

#: Anything that may make a word suspicious whatever the script of the record.
SUSPECT = f"[{_INVISIBLE}{_SPACES}{_WIDTH}{_MARKS}{_RADICALS}{''.join(GREEK_LATIN)}]"
_BREAKS = " \\t\\r\\n、。，；：？！（）「」“”〈〉《》|<>"


def _radical(ch: str) -> str:
    plain = unicodedata.normalize("NFKC", ch)
    return plain if plain != ch else RADICAL_IDEOGRAPH.get(ch, ch)


_RE_INVISIBLE, _RE_SPACE, _RE_WIDTH, _RE_RADICAL = (re.compile(f"[{x}]") for x in (_INVISIBLE, _SPACES, _WIDTH, _RADICALS))
_RE_COMBINED = re.compile(f"(\\w)([{_MARKS}])")
_RE_LATIN, _RE_CYRILLIC = re.compile("[A-Za-zÀ-ÿ]"), re.compile("[\u0400-\u04ff]")
_LETTERS = re.compile(r"[A-Za-z\u0370-\u03ff\u0400-\u04ff]+")


def _composed(m: re.Match) -> str:
    both = unicodedata.normalize("NFC", m[0])
    return both if len(both) == 1 else m[0]


def _letters(run: str, script: str) -> str:
    """A run of letters in one alphabet, where its odd letters have doubles there."""
    latin, cyrillic = len(_RE_LATIN.findall(run)), sum(c in CYRILLIC_LATIN or "\u0400" <= c <= "\u04ff" for c in run)
    own_cyrillic = sum("\u0400" <= c <= "\u04ff" and c not in CYRILLIC_LATIN for c in run)
    own_latin = sum(c.isascii() and c not in LATIN_CYRILLIC for c in run)
    if cyrillic and (own_cyrillic > own_latin or (script == "cyr" and not own_latin and (latin == 0 or cyrillic >= latin))):
        return "".join(LATIN_CYRILLIC.get(c, c) for c in run)
    if cyrillic or any(c in GREEK_LATIN for c in run):
        rest = own_cyrillic == 0
        return "".join((CYRILLIC_LATIN.get(c) if rest else None) or GREEK_LATIN.get(c) or c for c in run)
    return run


def plain_form(word: str, script: str) -> tuple[str, list[str]]:
    """The form that ``word`` looks like in plain characters, and the kinds of variants it holds."""
    kinds = []
    out = word
    if _RE_WIDTH.search(out):
        kinds.append("width")
        out = _RE_WIDTH.sub(lambda m: unicodedata.normalize("NFKC", m[0]), out)
        out = out.replace("\u309b", "\u3099").replace("\u309c", "\u309a").replace("\uff9e", "\u3099").replace("\uff9f", "\u309a")
    if _RE_INVISIBLE.search(out):
        kinds.append("invisible")
        out = _RE_INVISIBLE.sub("", out)
    if _RE_SPACE.search(out):
        kinds.append("space")
        out = _RE_SPACE.sub(" ", out)
    if (joined := _RE_COMBINED.sub(_composed, out)) != out:
        if any(len(_composed(m)) == 1 for m in _RE_COMBINED.finditer(_RE_INVISIBLE.sub("", word))):
            kinds.append("combining")
        out = joined
    if (ideographs := _RE_RADICAL.sub(lambda m: _radical(m[0]), out)) != out:
        kinds.append("lookalike")
        out = ideographs
    if (letters := _LETTERS.sub(lambda m: _letters(m[0], script), out)) != out:
        kinds.append("lookalike")
        out = letters
    return out, sorted(set(kinds))


_PLAIN = T.StructType([T.StructField("plain", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType()))])


def _plain_frame(word: pd.Series, script: pd.Series) -> pd.DataFrame:
    done = [plain_form(w, s) for w, s in zip(word, script)]
    return pd.DataFrame({"plain": [d[0] for d in done], "kinds": [d[1] for d in done]})




#: Letters both alphabets have.
_BOTH = "".join(sorted({*LATIN_CYRILLIC, *LATIN_CYRILLIC.values()}))
_HINT = re.compile(SUSPECT[:-1] + "".join(CYRILLIC_LATIN) + "]")
_WORDS = re.compile(f"[^{_BREAKS}]+")
_MIXED = re.compile(f"{SUSPECT}|[A-Za-z][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-z]")
_OTHER = re.compile(SUSPECT[:-1] + "".join(CYRILLIC_LATIN) + "]")
_TWINS = re.compile(f"(?<![^\\W_])[{_BOTH}]+(?![^\\W_])")
_WIDE = re.compile("[A-Za-z぀-ヿ一-鿿]")


def words_of(text: str) -> tuple[str, list[str]]:
    """Script of a text ('cyr' where Cyrillic letters lead, else 'other') and its distinct words worth a look."""
    if not _HINT.search(text):
        return "other", []
    cyrillic = _RE_CYRILLIC.findall(text)
    if cyrillic and len(cyrillic) > len(_WIDE.findall(text)):
        odd = {w for w in _WORDS.findall(text) if _MIXED.search(w)}
        return "cyr", sorted(odd | set(_TWINS.findall(text)))
    return "other", sorted({w for w in _WORDS.findall(text) if _OTHER.search(w)})


_ARROW = pa.schema([("field_name", pa.string()), ("rec_id", pa.string()), ("script", pa.string()), ("word", pa.string())])


def _emit_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: list[list] = [[], [], [], []]
        for field, rec, value in arrow_rows(batch, "field_name", "rec_id", "value"):
            script, words = words_of(value)
            for w in words:
                for col, v in zip(cols, (field, rec, script, w)):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], schema=_ARROW)


def suspicious_words(values: DataFrame) -> DataFrame:
    """(field_name, rec_id, script, word): words that hold other than plain characters.

    In Cyrillic records these are also the words written wholly in letters both
    alphabets have; how often each spelling occurs decides between them. Most texts
    are passed over by one character-class search, which Python's engine does from a
    bitmap several times faster than the JVM's.
    """
    narrow = values.where(F.col("value") != "").select("field_name", "rec_id", "value")
    return checkpointed(narrow.mapInArrow(_emit_words, "field_name string, rec_id string, script string, word string"))


CLASSES_SQL = """
    WITH members AS (
        SELECT script, word, plain, kinds, n FROM {spellings}
        UNION ALL
        SELECT DISTINCT script, plain AS word, plain, CAST(array() AS ARRAY<STRING>) AS kinds, 0L AS n FROM {spellings}
    ), chosen AS (
        SELECT script, collate(plain, 'UNICODE') AS look,
               min_by(word, struct(CASE WHEN size(kinds) = 0 THEN 0 ELSE 1 END AS odd, -n AS rarely, word)) AS canonical
        FROM members GROUP BY script, collate(plain, 'UNICODE')
    )
    SELECT s.script, s.word, c.canonical, s.kinds
    FROM {spellings} s JOIN chosen c
      ON s.script = c.script AND collate(s.plain, 'UNICODE') = c.look
    WHERE s.word <> c.canonical
"""


def canonical_words(words: DataFrame) -> DataFrame:
    """(script, word, canonical, kinds) of every spelling that is not its class's canonical member."""
    counted = words.groupBy("script", "word").agg(F.count(F.lit(1)).alias("n"))
    mapped = counted.withColumn("f", F.pandas_udf(_plain_frame, _PLAIN)("word", "script"))
    # words of letters both alphabets have look the same in either: one class, most frequent spelling wins
    twin = F.translate("f.plain", "".join(LATIN_CYRILLIC), "".join(LATIN_CYRILLIC.values()))
    plain_twin = (F.col("script") == "cyr") & F.col("word").rlike(f"^[{_BOTH}]+$")
    spellings = mapped.select("script", "word", "n", F.when(plain_twin, twin).otherwise(F.col("f.plain")).alias("plain"), F.when(plain_twin, F.expr("CAST(array() AS ARRAY<STRING>)")).otherwise(F.col("f.kinds")).alias("kinds"))
    return words.sparkSession.sql(CLASSES_SQL, spellings=checkpointed(spellings))  # read three times


def variants(values: DataFrame) -> DataFrame:
    """(field_name, rec_id, word, canonical, variant) of every odd spelling in every record."""
    words = suspicious_words(values)
    odd = canonical_words(words)
    return words.join(odd, ["script", "word"]).select(
        "field_name", "rec_id", "word", "canonical", F.explode(F.when(F.size("kinds") > 0, F.col("kinds")).otherwise(F.array(F.lit("lookalike")))).alias("variant")
    )


def found(values: DataFrame) -> DataFrame:
    return variants(values).select("field_name", "rec_id", "variant").distinct()


def normalised(values: DataFrame) -> DataFrame:
    """(field_name, rec_id, value, normal): every value in one consistent form.

    A record's odd words are gathered (no more than its own words) and replaced,
    longest first; records without one keep their text.
    """
    words = suspicious_words(values)
    odd = canonical_words(words)
    each = words.join(odd, ["script", "word"]).groupBy("field_name", "rec_id").agg(
        F.array_sort(F.collect_set(F.struct((-F.length("word")).alias("size"), "word", "canonical"))).alias("odd")
    )
    rewritten = F.aggregate("odd", F.col("value"), lambda text, o: F.replace(text, o["word"], o["canonical"]))
    return values.join(each, ["field_name", "rec_id"], "left").select(
        "field_name", "rec_id", "value", F.when(F.col("odd").isNull(), F.col("value")).otherwise(rewritten).alias("normal")
    )
