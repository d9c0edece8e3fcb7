"""Token packing and source mixing on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clauseworks.llm import mixing, packing, tokens

WINDOWS = "window_name string, capacity_tokens int, doc_id string"


def test_nnls_is_the_least_squares_optimum():
    rng = np.random.default_rng(3)
    for steps in (16, 40, 64):
        target = rng.integers(0, 60, steps).astype(float)
        cols = packing.patterns(target.astype(int), steps)
        weight = np.sqrt(np.arange(1, steps + 1))
        x = packing.nnls(cols, target, weight)
        fitted = np.zeros(steps)
        for k in (0, 2, 4):
            np.add.at(fitted, cols[:, k] - 1, x * cols[:, k + 1])
        miss = (target - fitted) * weight
        slope = sum(miss[cols[:, k] - 1] * cols[:, k + 1] * weight[cols[:, k] - 1] for k in (0, 2, 4))
        norm = np.sqrt(sum((cols[:, k + 1] * weight[cols[:, k] - 1]) ** 2 for k in (0, 2, 4)))
        assert x.min() >= 0 and (slope / norm).max() <= 0.05 * weight[-1] + 1e-6  # nothing enters,
        assert np.abs((slope / norm)[x > 1e-6]).max(initial=0) < 1e-3  # nothing in it moves


def test_patterns_are_exact_and_supplied():
    counts = np.zeros(100, dtype=int)
    counts[[0, 9, 19, 29, 49, 99]] = [100, 3, 5, 2, 2, 1]
    got = packing.patterns(counts, 100)
    assert (sum(got[:, k] * got[:, k + 1] for k in (0, 2, 4)) == 100).all()
    for row in got.tolist():
        assert all(n <= counts[b - 1] for b, n in zip(row[0::2], row[1::2]))
    rows = {tuple(sorted((b, n) for b, n in zip(r[0::2], r[1::2]) if n)) for r in got.tolist()}
    assert {((100, 1),), ((50, 2),), ((1, 100),), ((20, 1), (30, 1), (50, 1)), ((1, 80), (20, 1))} <= rows


def test_patterns_do_the_packing():
    rng = np.random.default_rng(1)
    steps = 256
    sizes = np.clip(np.rint(rng.lognormal(4.2, 0.8, 40_000)), 1, steps).astype(int)
    _, fitted, containers = packing.plan(dict(enumerate(np.bincount(sizes).tolist()[1:], 1)), steps)
    assert containers <= 1.002 * -(-sizes.sum() // steps) and fitted > 0.97 * containers


def test_plan_uses_every_item_once():
    rng = random.Random(5)
    for _ in range(20):
        steps = rng.choice([7, 32, 100])
        histogram = {s: rng.randint(1, 50) for s in rng.sample(range(1, steps + 1), min(steps, 9))}
        runs, fitted, containers = packing.plan(histogram, steps)
        assert 0 <= fitted <= containers
        used, room = {}, np.full(containers, steps)
        for step, first, times, container in runs:
            for k in range(times):
                used.setdefault(step, []).append(first + k)
                room[container + k] -= step
        assert {s: sorted(r) for s, r in used.items()} == {s: list(range(n)) for s, n in histogram.items()}
        assert room.min() >= 0


def first_fit_decreasing(sizes, capacity):
    rooms = []
    for size in sorted(sizes, reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= size), None)
        if at is None:
            rooms.append(capacity - size)
        else:
            rooms[at] -= size
    return len(rooms)


@pytest.mark.parametrize("rows_per_task", [packing.ROWS, 30])
def test_pack_table(spark, monkeypatch, rows_per_task):
    monkeypatch.setattr(packing, "ROWS", rows_per_task)
    rng = random.Random(2)
    rows = [(i, rng.choice([5, 40, 100, 100, 100, 512, 700, 1500])) for i in range(400)] + [(400, 0), (7, 100), (401, 513), (402, 5000)]
    windows = spark.createDataFrame([("w", 512, "clash"), ("x", 2048, "clash")], WINDOWS)
    counted = spark.createDataFrame(rows, "doc_id long, n_tokens long")
    packed = packing.pack(counted, windows).collect()
    report = {r["window_name"]: r for r in packing.fill_report(packing.pack(counted, windows), windows).collect()}
    for name, capacity in (("w", 512), ("x", 2048)):
        mine = [r for r in packed if r["window_name"] == name]
        assert sum(r["n_tokens"] for r in mine) == sum(n for _, n in rows)
        fill = {}
        for r in mine:
            if r["container_id"] >= 0:
                fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
        assert max(fill.values()) <= capacity and set(fill) == set(range(len(fill)))
        assert len(fill) <= 1.02 * first_fit_decreasing([r["n_tokens"] for r in mine if r["n_tokens"]], capacity) + 1
        assert all(r["n_tokens"] == capacity or r["piece_no"] == 0 or r["start_token"] + r["n_tokens"] in (700, 1500, 513, 5000) for r in mine)
        assert [r["container_id"] for r in mine if r["doc_id"] == 400] == [-1]
        assert {r["container_id"] for r in mine if r["by_pattern"]} == set(range(report[name]["n_by_pattern"])) and report[name]["n_containers"] == len(fill)
    assert packing.pack(counted.limit(0), windows).count() == packing.pack(counted, windows.limit(0)).count() == 0


def test_token_counts(spark):
    texts = [None, "", "shall not", "不得使用", "word " * 9000, "x" * 45_000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.with_token_counts(df).collect()}
    encode = tokens.encoder().encode_ordinary
    assert got[0] == got[1] == 0 and got[2] == len(encode(texts[2])) and got[3] == len(encode(texts[3]))
    assert abs(got[4] - len(encode(texts[4]))) <= 4 and got[5] > 0


TARGETS = "source string, target_share double, max_repeats int"


def test_mix_shares_and_caps(spark):
    rng = random.Random(4)
    sources = {"big": 600, "mid": 150, "small": 20, "other": 30, None: 25}
    rows = [(i, s, f"{s} title" if s else "small title", s, "word " * rng.randint(20, 400)) for i, (s, n) in enumerate((s, n) for s, n in sources.items() for _ in range(n))]
    rows += [(9001, "big", None, None, ""), (9002, None, None, None, None)]
    docs = mixing.described(spark.createDataFrame(rows, "doc_id long, source string, title string, publisher string, text string")).cache()
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 6), ("absent", 0.1, 3)], TARGETS)
    mixed = mixing.mix(docs, targets).cache()
    assert mixed.count() == len(rows)
    report = {r["source"]: r for r in mixing.share_report(mixed, targets).collect()}
    for s, share in (("big", 0.5), ("mid", 0.3), ("small", 0.2)):
        assert abs(report[s]["actual_share"] - share) < 0.02, report
        assert report[s]["most_repeats"] <= report[s]["max_repeats"]
    assert report["absent"]["actual_share"] == 0 and report["other"]["actual_share"] == 0
    assert mixed.where("source = 'other' or n_tokens = 0").agg(F.max("repeats")).first()[0] == 0
    assert mixing.mix(docs, targets.limit(0)).count() == mixing.classifier_report(docs, targets.limit(0)).count() == 0


@pytest.mark.parametrize("telling", [True, False])
def test_classifier_of_texts(spark, telling):
    """Held-out accuracy where the text tells the source, and the shares where it doesn't."""
    rng = random.Random(9)
    words = {"a": "valve brake seal pressure".split(), "b": "lamp mirror light beam".split(), "c": "制动 灯光 座椅".split()}
    common = "the shall be of when not".split()
    rows = []
    for i in range(900):
        source = rng.choices("abc", (5, 3, 2))[0]
        own = words[source] if telling else rng.choice(list(words.values()))
        rows.append((i, source if i % 9 else None, " ".join(rng.choice(own if rng.random() < 0.3 else common) for _ in range(40)), source))
    docs = mixing.described(spark.createDataFrame(rows, "doc_id long, source string, text string, true string")).cache()
    targets = spark.createDataFrame([("a", 0.4, 2), ("b", 0.3, 2), ("c", 0.3, 2)], TARGETS)
    report = mixing.classifier_report(docs, targets).first()
    if not telling:
        assert report["log_loss"] <= report["log_loss_of_shares"] + 1e-9 and report["log_loss"] > report["log_loss_of_shares"] - 0.03
        return
    assert report["accuracy"] > 0.95 > report["accuracy_of_shares"] + 0.3 and report["weight"] > 0.8
    of = {r["doc_id"]: r["q"] for r in mixing.memberships(docs, ["a", "b", "c"]).collect()}
    hidden = [(of[i], "abc".index(true)) for i, source, _, true in rows if source is None]
    assert np.mean([q[k] >= mixing.STEPS - 1 for q, k in hidden]) > 0.9 and all(sum(q) == mixing.STEPS for q, _ in hidden)
