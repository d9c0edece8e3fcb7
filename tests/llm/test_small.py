"""Splitting, sentences, look-alikes and markup: units, edge cases and brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clauseworks.llm import lookalikes, markup, sentences, splitting

VALUES = "field_name string, rec_id string, value string"
LIMITS = "field_name string, max_chars int, overlap_chars int, value string"


# problem 4


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .。\n，́", max_size=400), st.integers(2, 60), st.integers(0, 20))
def test_pieces_cover_and_fit(text, limit, overlap):
    if overlap >= limit:
        with pytest.raises(ValueError):
            splitting.bisect_cuts(text, limit, overlap)
        return
    parts = splitting.pieces(text, limit, overlap)
    assert all(0 <= b - a <= limit for a, b in parts)
    assert parts[0][0] == 0 and parts[-1][1] == len(text)
    for (_, b), (c, _) in zip(parts, parts[1:]):
        assert b - c == min(overlap, b)


def test_cuts_are_natural():
    text = "One sentence here. " * 40 + "\n\n" + "Other words follow. " * 40
    parts = splitting.pieces(text, 800, 50)
    assert text[: parts[0][1]].endswith(("\n\n", ". "))
    assert splitting.pieces("x" * 100, 100, 10) == [(0, 100)]
    assert "é" not in {text[b - 1 : b + 1] for text in ["é" * 50] for _, b in splitting.pieces(text, 31, 3)[:-1]}


def test_split_table(spark):
    values = spark.createDataFrame([("t.a", "1", "x y " * 50), ("t.a", "1", "x y " * 50), ("t.a", "2", None), ("t.a", "3", ""), ("t.b", "4", "z" * 999), ("t.a", "5", "q" * 40), (None, "6", "q" * 99), ("t.a", "7", "w" * 100_000)], VALUES)
    limits = spark.createDataFrame([("t.a", 40, 5, "clash")], LIMITS)
    assert {tuple(r) for r in splitting.found(values, limits).collect()} == {("t.a", "1"), ("t.a", "7")}
    assert splitting.found(values.limit(0), limits).count() == 0


# problem 6


@pytest.mark.parametrize(
    ("lang", "text", "n"),
    [
        ("en", 'See Fig. 3 and No. 4, cf. Sect. 2.1, i.e. this. It says "Stop! Hot surface." next to it. Stored at 6:30 p.m. for 2 h. Seals, etc. The end', 5),
        ("en", "(The drum need not be tested.) A plate reads “Check it daily.” The U.N. group: no; yes.\nNew line", 4),
        ("en", "The sequence 1, 2, ... 32 is used vs. the other. Is it? Yes!", 3),
        ("de", "Vgl. Art. 5 bzw. Abb. 6, d. h. die Achse. Die Frist endet am 4. Mai 2020 z. B. hier. Auf ihm steht „Achtung! Heiß.“ in Rot. Schrauben usw. Ist es so?", 5),
        ("fr", "Voir la p. 2 du vol. 3, réf. 4. Il porte « Attention ! Chaud. » à 3 %. Cela vise p. ex. le feu. Revient-il ?", 4),
        ("ru", "См. рис. 5 и табл. 6, т. е. мост. На нём пишут «Внимание! Горячо.» рядом. Конец?", 3),
        ("zh", "轴（见表3。注：仅限M1类）为3.5 mm。标牌写明：“每日检查。”踏板上标注“停车！请勿开启。”字样，见7.2。能否复位？能……等部件", 5),
        ("ja", "図1（表2を参照。）の値は3 gとする。「確認しましたか？」と表示する。復帰するか？する。", 4),
        ("hi", "सं. 5 के अनुसार है। क्या होगा? मान 3.5 है।", 3),
        ("th", "ค่า 41 องศาของเพลา ตามข้อ 12.16 ของระเบียบ", 2),
    ],
)
def test_sentences(lang, text, n):
    units = sentences.sentences(text)
    assert sentences.language_of(text) == lang
    assert len(units) == n, [text[a:b] for a, b in units]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet='aB. "“”。？\n（）5', max_size=60))
def test_sentences_hold_all_text(text):
    units = sentences.sentences(text)
    left = list(text)
    for a, b in units:
        assert text[a:b] == text[a:b].strip() != ""
        left[a:b] = " " * (b - a)
    assert "".join(left).strip() == ""


def test_sentence_table(spark):
    long = "The drum turns. " * 5000
    values = spark.createDataFrame([("f", "1", "One. Two."), ("f", "1", "One. Two."), ("f", "2", " \n "), ("f", "3", long), ("f", "4", "no end")], VALUES)
    got = sentences.found(values)
    assert got.where("rec_id = '1'").count() == 2 and got.where("rec_id = '2'").count() == 0
    assert got.where("rec_id = '3'").count() == 5000 and got.where("rec_id = '4'").count() == 1


# problem 2


@pytest.mark.parametrize(
    ("word", "script", "plain", "kinds"),
    [
        ("Ｈｅｒ", "other", "Her", ["width"]), ("ｶﾞｰ", "other", "ガー", ["width"]), ("gén", "other", "gén", ["combining"]), ("ай", "cyr", "ай", ["combining"]),
        ("sh​all", "other", "shall", ["invisible"]), ("7 mm", "other", "7 mm", ["space"]), ("不⼩于", "other", "不小于", ["lookalike"]), ("⻋载", "other", "车载", ["lookalike"]),
        ("оf", "other", "of", ["lookalike"]), ("ISΟ", "other", "ISO", ["lookalike"]), ("вaл", "cyr", "вал", ["lookalike"]), ("kРа", "cyr", "kPa", ["lookalike"]),
        ("m²", "other", "m²", []), ("μΩ", "other", "μΩ", []), ("вал", "cyr", "вал", []), ("が「、。」", "other", "が「、。」", []), ("कि", "other", "कि", []),
    ],
)
def test_plain_form(word, script, plain, kinds):
    assert lookalikes.plain_form(word, script) == (plain, kinds)


def test_lookalike_table(spark):
    rows = [
        ("f", "1", "the drum оf 7 mm"), ("f", "1", "the drum оf 7 mm"), ("f", "2", None), ("f", "3", ""), ("f", "4", "plain text, m² and 表（3）"), ("f", "5", "Café Café"),
        ("f", "6", "​​"), ("f", "7", "с весом а и с валом, a тормоз с диском а потом а"), ("f", "8", "x" * 50_000 + " ｙ"),
    ]
    values = spark.createDataFrame(rows, VALUES)
    assert {tuple(r) for r in lookalikes.found(values).collect()} == {("f", "1", "lookalike"), ("f", "1", "space"), ("f", "5", "combining"), ("f", "6", "invisible"), ("f", "7", "lookalike"), ("f", "8", "width")}
    normal = {r["rec_id"]: r["normal"] for r in lookalikes.normalised(values).collect()}
    assert normal["1"] == "the drum of 7 mm" and normal["5"] == "Café Café" and normal["6"] == "" and normal["2"] is None and normal["4"] == rows[4][2]
    assert normal["8"].endswith(" y")
    assert lookalikes.found(values.limit(0)).count() == 0


# problem 3


@pytest.mark.parametrize(
    ("text", "langs"),
    [
        ("<p>x</p>", ["html"]), ("a &nbsp; b", ["html"]), ("<!-- c -->", ["html"]), ("a < 5 and b > 3 & up, US$ 105, US$ 7, 3*7, 6*8, item #38 [13]", []), ("**b**", ["markdown"]), ("## H\nx", ["markdown"]),
        ("[a](b.md)", ["markdown"]), ("Head\n----\nx", ["markdown"]), ("| a | b |\n|---|---|", ["markdown"]), ("- a\n* b\n+ c\n: d\n1. e", []), ("== H ==\nx", ["wiki"]), ("'''b'''", ["wiki"]), ("[[a|b]] {{ref|1}}", ["wiki"]),
        ("{| class=\"w\"\n|-\n| a || b\n|}", ["wiki"]), ("\\textbf{b}", ["latex"]), ("with $d_{max} \\le 4$ here", ["latex"]), ("**b** $x^2$", ["markdown", "latex"]), ("l'arrêt d'essai", []), ("【注】（a）～ “x” ——", []), ("", []),
    ],
)
def test_marks(text, langs):
    assert markup.marks(text) == langs


def test_clean_keeps_structure():
    text = "<html><head><style>p{}</style></head><h2>Title</h3><p>a &lt; b<ul><li>one<li>two</ul><pre><code>x = 1\n  y</code></pre><table><tr><td>c</td><td>d</td></tr></table><script>var p='</p>';</script>"
    out = markup.clean(text)
    assert "§§ Title" in out and "• one" in out and "    x = 1\n      y" in out and "¦ c" in out and "var" not in out and "a < b" in out
    out = markup.clean("# H\n\n**b** $x_1$ [l](u)\n\n```\ncode *x*\n```\n- i\n\n| a | b |\n|---|---|\n| 1 | 2 |")
    assert out.startswith("§ H") and "b ⟨x_1⟩ l" in out and "    code *x*" in out and "• i" in out and "¦ a ¦ b" in out
    out = markup.clean("== H ==\n'''b''' [[t|n]]\n{|\n|-\n| a || b\n|}\n\\section{S}\n\\emph{e}")
    assert "§§ H" in out and "b n" in out and "¦ a ¦ b" in out and "§§ S" in out


def test_markup_table(spark):
    schema = VALUES + ", site string, path string"
    page = lambda i, body: ("f", str(i), f"<div class='nav'><b>Home | About</b></div><p>{body} {i}</p>", "s", "clash")
    rnd = random.Random(1)
    rows = [page(i, "".join(rnd.choice("abcdefghij") for _ in range(12))) for i in range(30)]
    rows += [("f", "n", None, "s", "clash"), ("f", "e", "", "s", "clash"), ("f", "u", "<p><b>open", None, "clash"), ("f", "t", "plain", "s", "clash"), ("f", "0", rows[0][2], "s", "clash"), ("f", "L", "<p>" + "w " * 40_000 + "</p>", "s", "clash")]
    df = spark.createDataFrame(rows, schema)
    got = {tuple(r) for r in markup.found(df).collect()}
    assert ("f", "0", "html") in got and ("f", "L", "html") in got and not any(r[1] in ("n", "e", "t") for r in got)
    clean = {r["rec_id"]: r["clean"] for r in markup.cleaned(df.where("value <> ''")).collect()}
    assert "Home" not in clean["5"] and clean["5"].endswith(" 5") and clean["t"] == "plain"
    assert markup.found(df.limit(0)).count() == 0


def test_numbers_and_common_openings_stay(spark):
    nav = lambda i: f"<nav><ul><li>Home</li><li>Page {i} of 30</li></ul></nav>"
    page = lambda i: f"{nav(i)}<h2>Scope</h2>\n<p>All rights are reserved.</p>\n<h2>Part {'abc'[i % 3]}{i}</h2>\n<p>v<sub>{i}</sub> = 9 m/s<sup>2</sup></p>\n<p>text {i}</p>\n<table><tr><td>{i}</td> <td>7</td></tr></table><ul><li>seal</li> <li>item {i}</li></ul>"
    df = spark.createDataFrame([("f", str(i), page(i), "s") for i in range(30)], VALUES + ", site string")
    for r in markup.cleaned(df).collect():
        i, clean = r["rec_id"], r["clean"]
        assert "Home" not in clean and "Page" not in clean and "reserved" not in clean
        assert "§§ Scope" in clean and f"§§ Part {'abc'[int(i) % 3]}{i}" in clean and f"v{i} = 9 m/s2" in "".join(clean.split("\n")) and f"text {i}" in clean
        assert f"¦ {i}" in clean and "¦ 7" in clean and "• seal" in clean and f"• item {i}" in clean


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>p/b&;lt#$\\\\{}[]()|=!'*_~`- \n\u200bax1", max_size=24))
def test_every_mark_passes_the_hint(text):
    import re

    langs = markup.marks(text)
    assert not langs or re.search("(?m)" + markup.HINT, text)
    assert {x for node in markup.nodes_of(text) for x in node[-1]} == set(langs)


def test_removed_branches_count_as_html(spark):
    links = "".join(f"<a>Part {c}</a> " for c in "abcdefgh")
    page = lambda i: f"<nav><div>{links}</div><p>crumb {chr(97 + i % 26)}{chr(97 + i // 26)}</p></nav><p>**b{i}** and text {i}</p>"
    rows = [("f", str(i), page(i), "s") for i in range(60)] + [("f", "only", f"<nav><div>{links}</div></nav>", "s"), ("f", "deep", "<div>" * 5000 + "x", "s")]
    df = spark.createDataFrame(rows, VALUES + ", site string")
    nodes = markup.marked_nodes(df)
    gone = {(r["path"], r["content"] is None) for r in markup.removals(nodes).collect()}
    assert ("nav/div", True) in gone and not any(path == "p" for path, _ in gone)
    judged = {(r["rec_id"], r["path"]): r["kept"] for r in markup.judged_nodes(nodes).collect()}
    assert not judged["only", "nav/div"] and judged["3", "p"]
    got = {tuple(r)[1:] for r in markup.found(df).collect()}
    assert got == {(r[1], "html") for r in rows} | {(str(i), "markdown") for i in range(60)}
    assert not any("Part" in r["clean"] for r in markup.cleaned(df).collect())
    plan = markup.removals(nodes)._jdf.queryExecution().optimizedPlan().toString()
    assert markup.branch_tree(nodes, markup.style_tree(nodes))._jdf.queryExecution().optimizedPlan().toString().count("ln(") >= 3 and "Join" in plan


def test_provisions_have_the_site_of_their_document(spark):
    docs = spark.createDataFrame([("d-1", "https://Host.org/x", None), ("d-1", "https://host.org/y", None), ("e-2", None, "P"), (None, "https://n.org", None)], "document_id string, source_url string, publisher string")
    provs = spark.createDataFrame([("d-1", "1"), ("e-2", "2"), ("iso-3", "3"), (None, "4")], "document_id string, provision_id string")
    assert {r["provision_id"]: r["site"] for r in markup.with_document_sites(provs, docs).collect()} == {"1": "host.org", "2": "P", "3": "iso", "4": "unknown"}


def test_found_sees_every_mark(spark):
    rows = [("f", "w", "= Title =\nx", "s"), ("f", "m", "Title\n=\nx", "s"), ("f", "q", "a\n\u200b> b", "s"), ("f", "n", "a = b", "s")]
    got = {tuple(r)[1:] for r in markup.found(spark.createDataFrame(rows, VALUES + ", site string")).collect()}
    assert got == {(r[1], lang) for r in rows for lang in markup.marks(r[2])} and {("w", "wiki"), ("m", "markdown"), ("q", "markdown")} <= got and "n" not in {r for r, _ in got}


def test_long_and_nested_spans_hold_together():
    inner = "The drum turns slowly here. " * 600
    for a, b in ("()", "“”", '""', "[]", "‘’"):
        assert len(sentences.sentences(f"The plate {a}{inner}it says{b} must be read. The end.")) == 2, a
    assert len(sentences.sentences("It (see [a, “b «c {d Stop! Go on.) must be read. The end.")) == 2
    assert len(sentences.sentences("It (is open. So it is.\n\nAnother one) here. The end.")) == 4
    assert len(sentences.sentences("It (a [b (c [d (e [f. G] h.) i.] j.) k.] l.) ends. The end.")) == 2
    assert len(sentences.sentences("(" * 30_000 + "a. B" + "]" * 30_000 + ". The end.")) == 3
    assert len(sentences.sentences('A bolt of 5" holds. It is "tight. So" it is. The end.')) == 3
    assert len(sentences.sentences("It’s ‘the driver’s seat. It is’ fixed. The end.")) == 2
    assert len(sentences.sentences("Really?" + "!" * 500 + " Yes.")) == 2


def test_the_first_pair_of_a_table_decides():
    assert all(rules[0][3] == (lang != "th") for lang, rules in sentences._COMPILED.items())
