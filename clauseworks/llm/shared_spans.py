"""Problem 9: long exact spans shared between records.

Texts are parsed by recompression (``recompress.py``): globally consistent names
for runs and pairs, round after round, so that equal substrings have equal
interior symbols. Around every final symbol of length e two spans of
(200 + e) / 2 characters are taken, one reaching left and one reaching right: a
shared substring of 200 characters that holds the symbol holds one of the two,
so records that share it share a key. Every symbol knows the stretch of text that
decides it; the few windows of 200 characters that hold no such stretch (mostly
repetitions of a short period) are keys themselves, each distinct one once. So no
shared window is without a shared key.

Keys that two classes of one batch share are known for shared on the spot; only
two of their rows go to the count of the key, so a key of a third of all texts
does not gather them. Texts with shared keys then hash the 200-character windows
around these keys, two independent 64-bit hashes each; texts with an equal window
share it. Windows with the same texts form one group; pairs are named within a
group once. Nothing is paired before that.

Exact copies are one class from the start (two 64-bit hashes of the text), so a
class is parsed into keys per stored row but meets others once.

Defined results: null texts, null ids and texts under 200 characters share
nothing; a text repeated under one doc_id is one record; exact copies under
several doc_ids share all of their text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseworks.llm import recompress as rc
from clauseworks.llm.scale import sized
from clauseworks.session import checkpointed

SPAN = 200
#: Symbols stop growing at this length; the larger, the fewer keys and the more windows that are keys themselves.
FREEZE = 28
ROUNDS = 14
#: Characters parsed at once (few enough for a processor's cache), and those whose keys are compared on the spot.
_PARSED, _CHUNK = 100_000, 1_000_000


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _chunks(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def span_keys(texts: list[str], span: int = SPAN, freeze: int = FREEZE, rounds: int = ROUNDS):
    """Keys of several texts: (text number, key, start, end), offsets within the text."""
    coded = [rc.codes(t) for t in texts]
    sizes = np.array([len(c) for c in coded], dtype=np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    symbols = np.concatenate(coded) if coded else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(coded)), sizes)
    _, start, length, own, lo, hi = rc.recompress(symbols, owner, freeze, rounds)
    h = rc.prefix_sums(symbols)
    # window starts that hold the stretch of some symbol
    decided = (hi - lo <= span) & (lo >= begins[own]) & (hi <= ends[own])
    cover = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(cover, np.maximum(hi - span, begins[own])[decided], 1)
    np.add.at(cover, lo[decided] + 1, -1)
    bare = np.flatnonzero((np.cumsum(cover[:-1]) == 0) & (np.arange(len(symbols)) + span <= np.repeat(ends, sizes)))
    out = [(owner[bare], rc.span_hash(h, bare, bare + span), bare - begins[owner[bare]], bare + span - begins[owner[bare]])]
    short = length <= span
    start, length, own = start[short], length[short], own[short]
    reach = (span - length + 1) // 2
    for left, right in ((reach, 0), (0, reach)):
        a, b = start - left, start + length + right
        ok = (a >= begins[own]) & (b <= ends[own])
        a, b, o = a[ok], b[ok], own[ok]
        out.append((o, rc.span_hash(h, a, b), a - begins[o], b - begins[o]))
    return tuple(np.concatenate(x) for x in zip(*out))


KEYS = "place long, key long, h1 long, h2 long, known boolean"
_KEYS = pa.schema([("place", pa.int64()), ("key", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("known", pa.bool_())])


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (key, class) of each chunk; ``place`` is the key where other chunks have to be asked, else the row's own.

    Of a key that several classes of the chunk hold, the first and last row ask for the others.
    """
    for batch in batches:
        texts = batch.column(0).to_pylist()
        h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        for lo, hi in _chunks(texts, _CHUNK):
            parts = []
            for c, d in _chunks(texts[lo:hi], _PARSED):
                own, key, _, _ = span_keys(texts[lo + c : lo + d])
                parts.append((own.astype(np.int64) + lo + c, _signed(key)))
            at, key = (np.concatenate(x) for x in zip(*parts))
            a, b = h1[at], h2[at]
            order = np.lexsort((b, a, key))
            key, a, b = key[order], a[order], b[order]
            new_key = np.append(True, key[1:] != key[:-1])[: len(key)]
            once = new_key | np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(key)]
            key, a, b, new_key = key[once], a[once], b[once], new_key[once]
            last = np.append(new_key[1:], True)[: len(key)]
            known = ~(new_key & last)
            asks = new_key | last
            place = np.where(asks, key, _signed(rc.mix(key.view(np.uint64) ^ rc.mix(a.view(np.uint64)))))
            by_class = np.lexsort((b, a))  # equal hashes side by side take little room in the shuffle
            yield pa.RecordBatch.from_arrays([pa.array(x[by_class]) for x in (place, key, a, b, known)], schema=_KEYS)


def _windows(text: str, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes and the start of every window of SPAN characters around a wanted key."""
    _, key, a, b = span_keys([text])
    hit = np.isin(_signed(key), wanted)
    n = len(text)
    cover = np.zeros(n + 1, dtype=np.int64)
    lo = np.maximum(0, b - SPAN)[hit]
    hi = np.minimum(a, n - SPAN)[hit]
    np.add.at(cover, lo, 1)
    np.add.at(cover, np.maximum(hi + 1, lo), -1)
    starts = np.flatnonzero(np.cumsum(cover[:n]) > 0)
    c = rc.codes(text)
    w1 = rc.span_hash(rc.prefix_sums(c, 0), starts, starts + SPAN, 0)
    w2 = rc.span_hash(rc.prefix_sums(c, 1), starts, starts + SPAN, 1)
    return _signed(w1), _signed(w2), starts


_WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("start_pos", pa.int32()), ("last_pos", pa.int32()), ("first", pa.bool_())])


def _emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All places of every distinct window, consecutive ones as one row; ``first`` marks one row of each window."""
    for batch in batches:
        for h1, h2, text, keys in zip(*(batch.column(i).to_pylist() for i in range(4))):
            w1, w2, starts = _windows(text, np.array(keys, dtype=np.int64))
            order = np.lexsort((starts, w1))
            w1, w2, starts = w1[order], w2[order], starts[order].astype(np.int32)
            first = np.append(True, w1[1:] != w1[:-1])[: len(w1)]
            at = np.flatnonzero(first | np.append(True, np.diff(starts) != 1)[: len(w1)])
            last = starts[np.append(at[1:], len(starts)) - 1] if len(at) else starts
            same = np.full(len(at), h1, np.int64), np.full(len(at), h2, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (w1[at], w2[at], *same, starts[at], last, first[at])], schema=_WINDOWS)


def _hashed(documents: DataFrame) -> DataFrame:
    """doc_id, text and the two hashes that name the class of exact copies."""
    long_enough = documents.where(F.col("doc_id").isNotNull() & (F.length("text") >= SPAN))
    return long_enough.select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("copy"), "text", F.length("text")).alias("h2"))


def _pairs_of_groups(members: DataFrame, *group: str) -> DataFrame:
    """Pairs of classes within the groups of ``members`` (group columns, h1, h2), each pair once."""
    a = members.select(*group, F.col("h1").alias("a1"), F.col("h2").alias("a2"))
    b = members.select(*group, F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    ordered = (F.col("a1") < F.col("b1")) | ((F.col("a1") == F.col("b1")) & (F.col("a2") < F.col("b2")))
    return a.join(b, list(group)).where(ordered).select("a1", "a2", "b1", "b2").distinct()


def _texts(hashed: DataFrame, classes: DataFrame) -> DataFrame:
    """One text for each of ``classes`` (h1, h2); the classes go out by broadcast if a count allows it."""
    return hashed.join(sized(classes), ["h1", "h2"]).dropDuplicates(["h1", "h2"]).select("h1", "h2", "text")


def shared_windows(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows that several classes hold.

    Returns their places (w1, w2, h1, h2, start_pos, last_pos, first), checkpointed, and
    per distinct window its number of classes and the name of their set
    (w1, w2, n, s1, s2).
    """
    hashed = _hashed(documents)
    keys = hashed.select("text", "h1", "h2").mapInArrow(_emit_keys, KEYS)
    at = Window.partitionBy("place")
    several = F.col("known") | (F.min("h1").over(at) != F.max("h1").over(at)) | (F.min("h2").over(at) != F.max("h2").over(at))
    shared = keys.withColumn("several", several).where("several").groupBy("h1", "h2").agg(F.collect_set("key").alias("keys"))
    wanted = checkpointed(shared)
    texts = _texts(hashed, wanted.select("h1", "h2")).join(wanted, ["h1", "h2"])
    windows = checkpointed(texts.select("h1", "h2", "text", "keys").mapInArrow(_emit_windows, "w1 long, w2 long, h1 long, h2 long, start_pos int, last_pos int, first boolean"))
    groups = windows.where("first").groupBy("w1", "w2").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("h1", "h2")).alias("s1"), F.bit_xor(F.xxhash64("h2", "h1")).alias("s2")
    ).where("n > 1")
    groups = checkpointed(groups)
    return windows.join(groups.select("w1", "w2"), ["w1", "w2"], "left_semi"), groups


def span_groups(windows: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_id, n, h1, h2): the classes of every set that shares a window, each set once."""
    one_each = groups.groupBy("n", "s1", "s2").agg(F.min(F.struct("w1", "w2")).alias("w")).select("n", F.col("s1").alias("group_id"), "w.w1", "w.w2")
    return windows.where("first").join(one_each, ["w1", "w2"]).select("group_id", "n", "h1", "h2")


def _members(documents: DataFrame) -> DataFrame:
    return checkpointed(_hashed(documents).select("doc_id", "h1", "h2").distinct())


def shared_pairs(documents: DataFrame) -> DataFrame:
    """(doc_a, doc_b) of all documents that share a span; copies are joined in at the end."""
    sets = checkpointed(span_groups(*shared_windows(documents)))
    pairs = checkpointed(_pairs_of_groups(sets, "group_id", "n"))
    members = _members(documents)
    a = members.select(F.col("doc_id").alias("a"), F.col("h1").alias("a1"), F.col("h2").alias("a2"))
    b = members.select(F.col("doc_id").alias("b"), F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    between = pairs.join(a, ["a1", "a2"]).join(b, ["b1", "b2"]).select("a", "b")
    within = a.join(b, (F.col("a1") == F.col("b1")) & (F.col("a2") == F.col("b2"))).where("a < b").select("a", "b")
    return between.union(within).where("a <> b").select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).distinct()


def links(sets: DataFrame) -> DataFrame:
    """(h1, h2, n_groups, n_linked_classes): in how many groups a class is, and how many other classes these hold.

    A class in a single group has the group's size. Of the others, classes in the
    same groups are counted as one with their number, so a passage that very many
    texts share is met once per combination of groups and not once per pair.
    """
    of = checkpointed(sets.groupBy("h1", "h2").agg(F.array_sort(F.collect_set("group_id")).alias("ids"), F.max("n").alias("n")))
    single = of.where("size(ids) = 1").select("h1", "h2", F.lit(1).alias("n_groups"), (F.col("n") - 1).alias("n_linked_classes"))
    kinds = checkpointed(of.groupBy("ids").agg(F.count(F.lit(1)).alias("weight")))
    many = kinds.where("size(ids) > 1").select("ids", F.explode("ids").alias("group_id"))
    others = kinds.select(F.xxhash64("ids").alias("other"), "weight", F.explode("ids").alias("group_id"))
    met = many.join(others, "group_id").select("ids", "other", "weight").distinct().groupBy("ids").agg((F.sum("weight") - 1).alias("n_linked_classes"))
    return single.unionByName(of.where("size(ids) > 1").join(met, "ids").select("h1", "h2", F.size("ids").alias("n_groups"), "n_linked_classes"))


def shared_amounts(documents: DataFrame) -> DataFrame:
    """Per doc_id: its length, the characters of it that other documents hold too, and its class.

    (doc_id, n_chars, shared_chars, n_copies, n_groups, n_linked_classes, class_id): class_id
    is the least doc_id among exact copies; n_linked_classes counts other classes that share
    a span, n_groups the sets they form (the members are those of ``group_members``).
    """
    windows, groups = shared_windows(documents)
    order = Window.partitionBy("h1", "h2").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = windows.select("h1", "h2", F.col("start_pos").alias("lo"), (F.col("last_pos") + SPAN).alias("hi"))
    covered = (
        spans.distinct()
        .withColumn("from", F.greatest("lo", F.coalesce(before, F.lit(0))))
        .groupBy("h1", "h2")
        .agg(F.sum(F.greatest(F.col("hi") - F.col("from"), F.lit(0))).alias("in_spans"))
    )
    linked = links(checkpointed(span_groups(windows, groups)))
    docs = checkpointed(_hashed(documents).select("doc_id", "h1", "h2", F.length("text").alias("n_chars")).distinct())
    classes = docs.groupBy("h1", "h2").agg(F.min("doc_id").alias("class_id"), F.count_distinct("doc_id").alias("n_copies"))
    return (
        docs.join(classes, ["h1", "h2"])
        .join(covered, ["h1", "h2"], "left")
        .join(linked, ["h1", "h2"], "left")
        .select(
            "doc_id",
            "n_chars",
            F.when(F.col("n_copies") > 1, F.col("n_chars")).otherwise(F.coalesce("in_spans", F.lit(0))).cast("long").alias("shared_chars"),
            "n_copies",
            F.coalesce("n_groups", F.lit(0)).alias("n_groups"),
            F.coalesce("n_linked_classes", F.lit(0)).alias("n_linked_classes"),
            "class_id",
        )
    )


def group_members(documents: DataFrame) -> DataFrame:
    """(group_id, n_classes, class_id): which classes of copies share a span, a row per class and group."""
    sets = span_groups(*shared_windows(documents))
    classes = _members(documents).groupBy("h1", "h2").agg(F.min("doc_id").alias("class_id"))
    return sets.join(classes, ["h1", "h2"]).select("group_id", F.col("n").alias("n_classes"), "class_id")
