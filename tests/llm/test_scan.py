"""Scan noise: trees, line classifiers on held-out pages, misreadings, repair."""

import random

import numpy as np
import pytest

from clauseworks.llm import boost, markup, misreadings, page_lines, scan_noise

WORDS = "the hydraulic housing shall not exceed seven values when sealed under bending fatigue while each bracket returns within limits of pressure and temperature".split()
DOCS = "doc_id long, document_id string, title string, standard_id string, text string, source_text string"
PROV = "provision_id string, document_id string, text string, title string"


def sentence(rng, n=60):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def documents(n=60, seed=1):
    rng = random.Random(seed)
    return [(i, f"iso-{1000000 + i}-2010", f"{rng.choice(WORDS).capitalize()} {rng.choice(WORDS)} – {rng.choice(WORDS)}", f"ISO{1000000 + i}:2010", sentence(rng), None) for i in range(n)]


def test_boosted_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = (x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)
    model = boost.Boosted().fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


@pytest.fixture(scope="module")
def models():
    return page_lines.train([(r[4], r[2], r[3], r[1]) for r in documents(200)])


def test_lines_on_held_out_pages(models):
    rng = random.Random(99)
    right = total = joined = joints = 0
    for r in documents(60, seed=5):
        rows, kinds, pairs = page_lines.lay_out(rng, r[4], r[2], r[3])
        page = page_lines.read_pages([("\n".join(rows), page_lines.names_of(r[2], r[3], r[1]))], models)[0]
        for k, s in enumerate(rows):
            if s.strip():
                total += 1
                right += (page.page[k], page.header[k]) == (kinds[k] in (1, 3), kinds[k] in (2, 3))
        wanted = {(a, b) for a, b, cut in pairs if cut}
        joints += len(wanted)
        joined += len(wanted & set(page.joints))
    assert right / total > 0.97 and joined / joints > 0.95


def test_suspects_and_distance():
    known = frozenset(["housing", "load", "bearing", "m0"])
    assert misreadings.suspects("housin9 M3 load\x02bearing hous\x02ing 123", known, frozenset()) == [("word", "housin0")]
    pairs = frozenset(["电动", "动机", "机的", "的电"])
    assert misreadings.suspects("的电劫机的", frozenset(), pairs) == [("pair", "电劫机")]
    assert misreadings.suspects("的电试样数量机的", frozenset(), pairs) == [("run", "电试样数量机")]  # a word the corpus lacks
    assert misreadings.looks_distance("sliall", "shall") == (1.0, 0.15)
    assert misreadings.looks_distance("shall", "shall") == (0.0, 0.0)
    assert misreadings.looks_distance("shbll", "shall")[1] == 1.0


def test_found_and_repaired(spark):
    docs = documents(80)
    d = docs[3]
    scan = f"The hydraulic housing shall not exc-\n— 12 —\n{d[2].upper()}   \need seven values when sea1ed under\nbending fatigue while each bracket\nreturns within limits of pressure\nand temperature."
    quiet = "The hydraulic housing shall not\nexceed seven values when sealed – under\nbending fatigue of temperature."
    docs += [(900, "iso-9-2001", None, None, None, scan), (901, "iso-10-2001", "T", "ISO10", "", quiet), (902, None, None, None, None, "a\nb"), (903, "iso-11-2001", "T", None, None, "x" * 70_000 + "\ny")]
    tables = {
        "documents": spark.createDataFrame(docs, DOCS),
        "provisions": spark.createDataFrame([(f"{d[1]}-1-1", d[1], scan, "clash"), (f"{d[1]}-1-1", d[1], scan, "clash"), ("p", None, None, None), ("q", "nope", "", None), ("one", d[1], "not sea1ed under pressure limits", None), ("code", None, "sea1ed l1mits hou5ing pres5ure 5even va1ues fat1gue brac1ket", None)], PROV),
    }
    got = {tuple(r) for r in scan_noise.found(tables).collect()}
    mine = {r[2] for r in got if r[1] == f"{d[1]}-1-1"}
    assert mine == {"hyphen", "page", "header", "misread"}
    assert {"hyphen", "page", "misread"} <= {r[2] for r in got if r[1] == "iso-9-2001"}
    assert not any(r[1] in ("iso-10-2001", "p", "q", "code") for r in got) and ("provisions.text", "one", "misread") in got
    text = {r["rec_id"]: r["repaired"] for r in scan_noise.repaired(tables).collect()}
    assert text["one"] == "not sealed under pressure limits"
    text = text[f"{d[1]}-1-1"]
    assert text.startswith("The hydraulic housing shall not exceed seven values when sealed under bending") and "12" not in text and "\n" not in text


def test_misreadings_with_one_sound_character_between(spark, monkeypatch):
    pairs = frozenset("的滑 滑动 动门 门锁 锁上 上的".split())
    assert misreadings.suspects("的滑劫门销上的", frozenset(), pairs) == [("run", "滑劫门销上")]
    assert misreadings.suspects("的滑劫门锁上的", frozenset(), pairs) == [("pair", "滑劫门")]
    rng = random.Random(4)
    terms = "滑动 门锁 上的 车辆 间隙 之间 制动 装置 试验 压力 温度 应当 符合 要求 移动 拉杆 转向 轴承 安全 螺栓 检查 座椅 强度 方向 连接 管路 灯光 信号 侧面 前部".split()
    docs = [(i, f"gb-{1000000 + i}-2010", None, f"GB{1000000 + i}", "。".join("".join(rng.choice(terms) for _ in range(9)) for _ in range(25)) + "。滑动门锁上的，之间的间隙", None) for i in range(40)]
    bad = ["滑劫门销上的车辆\n应当符合要求", "车辆应当之问的问隙\n符合要求"]
    unknown = "车辆蝴蝶翅膀应当\n符合要求"
    rows = [(f"gb-1000001-2010-{i}", "gb-1000001-2010", t, None) for i, t in enumerate([*bad, unknown])]
    tables = {"documents": spark.createDataFrame(docs, DOCS), "provisions": spark.createDataFrame(rows, PROV)}
    for most in (scan_noise.SNAPSHOT, 600):  # also where the readers know only a part of the lexicon
        monkeypatch.setattr(scan_noise, "SNAPSHOT", most)
        got = {r["rec_id"] for r in scan_noise.found(tables).where("noise = 'misread'").collect()}
        assert got == {"gb-1000001-2010-0", "gb-1000001-2010-1"}
    text = {r["rec_id"]: r["repaired"] for r in scan_noise.repaired(tables).collect()}
    assert text["gb-1000001-2010-0"].startswith("滑动门锁上的车辆") and text["gb-1000001-2010-1"].startswith("车辆应当之间的间隙")


@pytest.mark.parametrize("most", [10, scan_noise.SNAPSHOT])
def test_results_do_not_hang_on_the_snapshot(spark, monkeypatch, most):
    docs = documents(80)
    d = docs[3]
    full = scan_noise.misreadings.train_ranker
    monkeypatch.setattr(scan_noise, "SNAPSHOT", most)
    words = {w: 50 for w in WORDS}  # the fit may hang on it
    monkeypatch.setattr(scan_noise.misreadings, "train_ranker", lambda *_: full(words, {}))
    docs += [(100 + i, f"iso-{2000000 + i}-2011", None, None, "The self and the reset. " * 3, None) for i in range(4)]
    scan = "The hydraulic housing shall not exc-\need seven values of self-\nreset when sea1ed under\nbending hous-\ning fat1gue."
    tables = {"documents": spark.createDataFrame(docs, DOCS), "provisions": spark.createDataFrame([(f"{d[1]}-1-1", d[1], scan, None), (f"{d[1]}-1-2", "damaged", "within l1mits of pressure", None)], PROV)}
    assert {tuple(r)[1:] for r in scan_noise.found(tables).collect()} == {(f"{d[1]}-1-1", "hyphen"), (f"{d[1]}-1-1", "misread"), (f"{d[1]}-1-2", "misread")}
    text = {r["rec_id"]: r["repaired"] for r in scan_noise.repaired(tables).collect()}
    assert text == {f"{d[1]}-1-1": "The hydraulic housing shall not exceed seven values of self-reset when sealed under bending housing fatigue.", f"{d[1]}-1-2": "within limits of pressure"}


def test_documents_of_damaged_references(spark):
    provs = spark.createDataFrame([("iso-1-2-3", "iso-1"), ("iso-1-2-4", "damaged"), ("iso-1-2-5", None), ("x-9", "y")], "rec_id string, document_id string")
    names = spark.createDataFrame([("iso",), ("iso-1",), ("iso-1-2",)], "name_id string")
    assert {r["rec_id"]: r["name_id"] for r in scan_noise._with_names(provs, names).collect()} == {"iso-1-2-3": "iso-1", "iso-1-2-4": "iso-1-2", "iso-1-2-5": "iso-1-2", "x-9": "y"}


def test_marked_records_are_read(spark):
    assert markup.marks("where a < 12.63 and b\n> 17.9, with\nmore") == [] and markup.marks("Said.\n\n> 5.1 The clause") == markup.marks("a\n> so") == ["markdown"]
    text = "a\n**b** c\n\n```\nx\n\ny\n```\nz\n<p>q\nr</p>"
    assert markup.marked_lines(text, ["html", "markdown"]) == {1, 3, 4, 5, 6, 7, 9, 10} and markup.marked_lines(text, []) == frozenset()
    docs = documents(80)
    d = docs[3]
    scan = f"The hydraulic housing shall not exc-\n— 12 —\n{d[2].upper()}   \need seven values where a < 12 and b\n> 17.9 when sea1ed under bending"
    marked = scan + "\nfatigue.\n**each** sea1ed bra-\nwithin limits of pressure."
    rows = [(f"{d[1]}-1-{i}", d[1], t, None) for i, t in enumerate([scan, marked])]
    tables = {"documents": spark.createDataFrame(docs, DOCS), "provisions": spark.createDataFrame(rows, PROV)}
    got = {(r["rec_id"], r["noise"]) for r in scan_noise.found(tables).collect()}
    assert {(r[0], k) for r in rows for k in ("hyphen", "header", "page", "misread")} <= got
    out = {r["rec_id"]: r["repaired"] for r in scan_noise.repaired(tables).collect()}[rows[1][0]]
    assert out.startswith("The hydraulic housing shall not exceed seven values where a < 12 and b > 17.9 when sealed under") and "\n**each** sea1ed bra-\nwithin limits" in out


def test_empty_tables(spark):
    tables = {"documents": spark.createDataFrame([], DOCS), "provisions": spark.createDataFrame([], PROV)}
    assert scan_noise.found(tables).count() == 0
