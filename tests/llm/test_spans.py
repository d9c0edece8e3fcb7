"""Shared spans: recompression against brute force, hot keys, copies, edge cases."""

import random

import pytest

from clauseworks.llm import shared_spans as ss

SCHEMA = "doc_id long, text string, key string, n int"


def brute(rows, span=ss.SPAN):
    from collections import defaultdict

    seen = defaultdict(set)
    for i, t in rows:
        if i is not None and t is not None:
            for k in range(len(t) - span + 1):
                seen[t[k : k + span]].add(i)
    return {(a, b) for ids in seen.values() for a in ids for b in ids if a < b}


def corpus(seed, n=60):
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "abcdefghij ", "的一是不了人在有我他，。0123"])
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [word(rng.choice([150, 199, 200, 201, 260, 500])) for _ in range(8)]
    rows = []
    for i in range(n):
        text = word(rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            cut = rng.randint(0, 30)
            text += s[cut:] + word(rng.randint(0, 120))
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    assert {tuple(r) for r in ss.shared_pairs(df).collect()} == brute(rows)


def test_hot_keys_and_runs(spark, monkeypatch):
    monkeypatch.setattr(ss, "_CHUNK", 2000)
    rows = corpus(11)
    rows += [(100 + i, f"{i:05d}" * 3 + "=" * (210 + i) + f"{i:04d}" * 5) for i in range(6)] + [(200 + i, f"{i:03d}" + "ab" * 120 + f"{i}" * 9) for i in range(5)]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    assert {tuple(r) for r in ss.shared_pairs(df).collect()} == brute(rows)


def test_copies_nulls_amounts(spark):
    rng = random.Random(3)
    word = lambda k: "".join(rng.choice("abcdefghijklmnop ") for _ in range(k))
    copy, common = word(700), word(250)
    rows = [(1, copy), (2, copy), (2, copy), (3, word(100) + common + word(50)), (4, common + word(300)), (5, None), (None, copy), (6, ""), (7, "x" * 199), (8, word(60_000))]
    df = spark.createDataFrame([(i, t, None, None) for i, t in rows], SCHEMA)
    assert {tuple(r) for r in ss.shared_pairs(df).collect()} == {(1, 2), (3, 4)}
    got = {r["doc_id"]: r.asDict() for r in ss.shared_amounts(df).collect()}
    assert got[1]["shared_chars"] == 700 and got[2]["class_id"] == 1 and got[1]["n_copies"] == 2
    assert 250 <= got[3]["shared_chars"] <= 252 and got[3]["n_linked_classes"] == 1 and got[8]["shared_chars"] == 0
    assert ss.shared_pairs(df.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [1, ss._CHUNK])
def test_amounts_count_every_occurrence(spark, monkeypatch, chunk):
    monkeypatch.setattr(ss, "_CHUNK", chunk)
    rng = random.Random(8)
    word = lambda k: "".join(rng.choice("abcdefghijklmnop ") for _ in range(k))
    twice = word(260)
    rows = [(i, word(50) + twice + word(70) + twice + word(40)) for i in range(6)] + [(10 + i, word(60) + "." * (300 + i) + word(60)) for i in range(6)]
    windows = {}
    for i, t in rows:
        for k in range(len(t) - ss.SPAN + 1):
            windows.setdefault(t[k : k + ss.SPAN], set()).add(i)
    wanted = {}
    for i, t in rows:
        wanted[i] = len({c for k in range(len(t) - ss.SPAN + 1) if len(windows[t[k : k + ss.SPAN]]) > 1 for c in range(k, k + ss.SPAN)})
    df = spark.createDataFrame([(i, t, None, 1) for i, t in rows], SCHEMA)
    got = ss.shared_amounts(df).collect()
    assert {r["doc_id"]: r["shared_chars"] for r in got} == wanted
    pairs = brute(rows)
    assert {r["doc_id"]: r["n_linked_classes"] for r in got} == {i: sum(i in p for p in pairs) for i, _ in rows}
    assert wanted[0] >= 520 and wanted[10] >= 300


def test_links_and_groups_against_brute_force(spark):
    rows = corpus(21, 120)
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    pairs = brute(rows)
    got = {r["doc_id"]: r for r in ss.shared_amounts(df).collect()}
    texts = dict(rows)
    other = {i: len({texts[k] for p in pairs if i in p for k in p} - {t}) for i, t in rows if len(t) >= ss.SPAN}
    assert {i: r["n_linked_classes"] for i, r in got.items()} == other and max(other.values()) > 5
    members = {}
    for r in ss.group_members(df).collect():
        members.setdefault(r["group_id"], set()).add(r["class_id"])
    of = {i: r["class_id"] for i, r in got.items()}
    assert {(min(of[a], of[b]), max(of[a], of[b])) for a, b in pairs if of[a] != of[b]} == {(a, b) for m in members.values() for a in m for b in m if a < b}


def test_every_shared_window_has_a_shared_key():
    """Periods of 1 to 40, barely long enough, in any phase and next to more of the same."""
    rng = random.Random(5)
    for k in range(1500):
        period = k % 40 + 1
        unit = "".join(rng.choice("abcd|- .") for _ in range(period))
        size = rng.randint(200, 240)
        some = lambda n: (unit * 300)[rng.randint(0, period) :][: rng.randint(0, n)] if rng.random() < 0.3 else ""
        core = (unit * 300)[rng.randint(0, period) :][:size] if k % 3 else "".join(rng.choice("ab") for _ in range(size))
        word = lambda: "".join(rng.choice("ABCDEFGH") for _ in range(rng.randint(0, 80)))
        own, key, _, _ = ss.span_keys([word() + some(300) + core + some(300) + word(), word() + core + word()])
        assert set(key[own == 0].tolist()) & set(key[own == 1].tolist()), (unit, size)


def test_few_windows_are_keys_themselves():
    rng = random.Random(6)
    text = " ".join(rng.choice(["brake", "seal", "shall", "not", "exceed", "of", "the", "pressure", "1.5", "MPa"]) + rng.choice(["", ",", "s"]) for _ in range(20_000))
    _, _, a, b = ss.span_keys([text])
    assert len(a) < len(text) / 6 and (b - a == ss.SPAN).mean() < 0.1
    _, key, _, _ = ss.span_keys(["| --- " * 2000])
    assert len(set(key.tolist())) < 60  # no more than the phases of the period and what stands at the ends


def test_hot_keys_ask_in_two_rows_of_a_chunk():
    import pyarrow as pa

    shared = "".join(random.Random(7).choice("abcdefghijkl") for _ in range(260))
    texts = [shared + f"{i:04d}" * 20 for i in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(200), pa.int64()), pa.array(range(200), pa.int64())], names=["text", "h1", "h2"])
    rows = pa.Table.from_batches(list(ss._emit_keys(iter([batch])))).to_pandas()
    many = rows.groupby("key").filter(lambda g: len(g) == 200)
    assert len(many) and many["known"].all() and (many["place"] == many["key"]).sum() == 2 * many["key"].nunique()
