import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clauseworks.operators import provisions as pv

DOCS = "document_id string, text string, label string, kind string"


def split(spark, *texts):
    df = spark.createDataFrame([(f"d{i}", t, "clash", "clash") for i, t in enumerate(texts)], DOCS)
    return pv.split_provisions(df).orderBy("document_id", "source_offset").collect()


def test_labels_kinds_titles_offsets(spark):
    text = "front\n1 Scope\nbody\n4.1 Only text\n第一条 文\n附录 A: x\nAnnex B: y\n4.1 again\n4.1 "
    rows = split(spark, text)
    assert [(r["label"], r["kind"], r["title"], r["text"], r["occurrence"]) for r in rows] == [
        ("1", "section", "Scope", "body", 1), ("4.1", "clause", "unknown", "Only text", 1), ("第一条", "article", "unknown", "文", 1),
        ("附录 A", "annex", "unknown", "x", 1), ("Annex B", "annex", "unknown", "y", 1), ("4.1", "clause", "unknown", "again", 2),
    ]
    for r in rows:
        assert text[r["source_offset"] :].startswith(r["label"])
    assert [r["provision_id"] for r in rows] == ["d0-1", "d0-4-1", "d0-第一条", "d0-附录-a", "d0-annex-b", "d0-4-1-dup-2"]
    assert rows[-1]["confidence"] == "low"


def test_fallback_null_empty_long(spark):
    rows = split(spark, "just a sentence", None, "", "1 " + "x" * 60_000)
    assert [(r["document_id"], r["label"], len(r["text"])) for r in rows] == [("d0", "fallback", 15), ("d2", "fallback", 0), ("d3", "1", 60_000)]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "2.1", "3.4.5"]), st.text(alphabet="ab 😀", min_size=1, max_size=8).filter(str.strip)), min_size=1, max_size=8))
def test_model(spark, parts):
    text = "".join(f"{label} {body}\n" for label, body in parts)
    rows = split(spark, text)
    assert [(r["label"], r["text"]) for r in rows] == [(a, b.strip()) for a, b in parts]
    assert len({r["provision_id"] for r in rows}) == len(rows)
    assert [r["source_offset"] for r in rows] == [m.start() for m in re.finditer(r"(?m)^\d", text)]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [("不得使用", "must_not"), ("必须", "must"), ("应用", "must"), ("宜", "should"), ("可以", "may"), ("是指", "define"), ("不应 shall", "must_not"), ("Shall \n not", "must_not"), ("it must", "must"), ("recommended", "should"), ("scan", "may"), ("means", "define"), ("应 shall not", "must"), ("nothing", "unknown")],
)
def test_modality(spark, text, wanted):
    assert spark.createDataFrame([(text,)], "t string").select(pv.modality_of(F.col("t")).alias("m")).first()["m"] == wanted


def test_requirement_counter(spark):
    df = spark.createDataFrame([("d", "1 none\n2 shall go\n3 must go\n", "", "")], DOCS)
    got = pv.extract_requirements(pv.split_provisions(df)).orderBy("requirement_id").collect()
    assert [(r["requirement_id"], r["modality"]) for r in got] == [("d-2-r1", "must"), ("d-3-r2", "must")]


def test_tags(spark):
    df = spark.createDataFrame([("p", "制动液 ABS", "座椅"), ("q", None, None)], "id string, text string, title string")
    rows = {r["id"]: r for r in pv.tagged(df, pv.tagging_text(F.col("text"), F.col("title"))).collect()}
    assert rows["p"]["topics"] == ["braking-system", "seats"] and rows["p"]["entities"] == ["component"]
    assert rows["p"]["topic_keywords"]["braking-system"] == ["abs", "制动", "制动液"]
    assert rows["q"]["topics"] == []
    tags = spark.createDataFrame([("p", ["b", "a"], None), ("p", ["a", "c"], ["e"]), (None, ["x"], []), ("z", [], [])], "id string, topics array<string>, entities array<string>")
    assert {r["id"]: (r["topics"], r["entities"]) for r in pv.merged_tags(tags).collect()} == {"p": (["a", "b", "c"], ["e"]), "z": ([], [])}
    assert pv.junction(tags, "topics", "topic").count() == 3
