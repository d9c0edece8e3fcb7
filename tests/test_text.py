import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clauseworks.functions import metadata as md
from clauseworks.functions import text as tx


def one(spark, f, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("f", "given_", "wanted"),
    [
        (tx.slugify, "  Hello,  World_1 – 标准 ", "hello-world_1-标准"),
        (tx.slugify, None, None),
        (tx.drop_pictures, "a **==> picture [1 x 2] intentionally omitted <==**\nb", "a b"),
        (tx.unwrap_brackets, "[年版的]第[—]条 [1] [GB 7258] [a[条]", "年版的第—条 [1] [GB 7258] [a[条]"),
        (tx.normalise_standard_tokens, "gb / t 1234 GB 7258-2017 GB/T1234 - 2010", "GB/T 1234 GB 7258—2017 GB/T 1234—2010"),
        (tx.collapse_cjk_gaps, "机 动 车 运 行\n两 字", "机动车运行\n两 字"),
        (tx.split_joined_english, "roadVehicle", "road Vehicle"),
        (tx.drop_breaks, "a<br/>b<br >c", "abc"),
        (tx.collapse_blank_lines, "\n\na\n\n\n\nb \n", "a\n\nb"),
        (tx.like_escaped, r"5%_\ ", r"5\%\_\\ "),
        (tx.html_markdown, "<head><title>t</title></head><h2>A</h2><p>x &lt; y</p><ul><li>one<li>two</ul><script>var p='</p>';</script>", "## A\n\nx < y\n\n- one\n- two"),
    ],
)
def test_rules(spark, f, given_, wanted):
    assert one(spark, f, given_) == wanted


def test_html_title_and_attachments(spark):
    assert one(spark, tx.html_title, "<title> A &amp; B </title>", "s") == "A & B"
    assert one(spark, tx.html_title, "<p>", "slug") == "slug"
    html = '<a href="/f/a.PDF">x</a><a class=q href=\'b.docx\'>y</a><a href="https://o.org/c.doc">z</a><a href="n.html">n</a>'
    assert one(spark, tx.attachment_links, html, "https://h.org/p/q.html") == ["https://h.org/f/a.PDF", "https://h.org/p/b.docx", "https://o.org/c.doc"]


@pytest.mark.parametrize(("text", "wanted"), [("GB/T 12 on ISO", "gb-t"), ("gb / z 1", "gb-z"), ("GB 7258", "gb"), ("GB7258", "unknown"), ("see ISO 1", "iso"), ("UN R 13", "unece"), ("ECE R13", "ece"), (None, "unknown"), ("", "unknown")])
def test_standard_type(spark, text, wanted):
    assert one(spark, md.standard_type, text) == wanted


def test_metadata(spark):
    assert one(spark, md.standard_id, "x iso 26262-1:2018 gb 7258-2017") == "GB7258-2017"
    assert one(spark, md.standard_id, "ISO 26262-1:2018") == "ISO26262"
    assert one(spark, md.standard_id, None) is None
    assert one(spark, md.standard_id_from_path, "raw/gb-7258-2017.pdf") == "GB-7258-2017"
    assert one(spark, md.title, "no heading", "a/b/brake-test-r1.pdf") == "Brake Test R1"
    assert one(spark, md.title, "# Head\nx", "p") == "Head"
    for text, wanted in (("发布日期：2017/9/1", "2017-09-01"), ("2017-09-01 发布", "2017-09-01"), ("20170901发布", "2017-09-01"), ("2017-9-1 (first) release", "2017-09-01"), ("公布 2017年9月1日", "2017-09-01"), ("no", None)):
        assert one(spark, md.release_date, text) == wanted
    assert one(spark, md.publisher, "a\n发布部门： 交通局 \nISO") == "交通局"
    assert one(spark, md.publisher, "Published by: The Body\n") == "The Body"
    assert one(spark, md.publisher, "by SAE.") == "SAE"


def test_page_noise_and_table_titles(spark):
    text = "GB 7258—2017\n1\nbody\ngb 7258—2017\nSAC\nxiv\nXIV\nbody"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    assert [r["pos"] for r in tx.page_noise_lines(tx.lines_of(df, "doc_id", "text"), "doc_id").where("noise").orderBy("pos").collect()] == [1, 3, 4, 6]
    rows = "Table 1 Limits\n| Table 1 Limits |\n|---|\n| a | b |\nother"
    df = spark.createDataFrame([(1, rows)], "doc_id int, text string")
    assert [r["pos"] for r in tx.table_title_lines(tx.lines_of(df, "doc_id", "text"), "doc_id").where("repeats").collect()] == [1]
    assert tx.cleaned(df, "doc_id", "text").first()["text"] == "Table 1 Limits\n|---|\n| a | b |\nother"


def test_quality(spark):
    df = spark.createDataFrame([("x" * 60 + "\n\n" + "intentionally omitted " * 3,)], "t string")
    row = df.select(*[c.alias(k) for k, c in tx.quality(F.col("t"), F.lit(2)).items()]).first()
    assert (row["n_lines"], row["omitted_images"], row["long_runs"], row["is_poor"]) == (2, 3, 1, True)


@settings(max_examples=15, deadline=None)
@given(st.text(alphabet="aB-_ 标.\n\t", max_size=30))
def test_slug_model(spark, text):
    import re

    model = re.sub("-+", "-", re.sub(r"[^\w\-]+", "-", text.lower().strip())).strip("-")
    assert one(spark, tx.slugify, text) == model
