"""Problem 8: mixing sources to target weights.

Soft-membership mixing. A classifier fitted on labelled documents (those with a
known source, at most about ``FIT_ROWS`` of them, picked by a hash) predicts a
posterior over sources for documents without one, from the words of the text and
the title and from the metadata. A fifth of the sample is held out: on it the
posterior's temperature and its weight against the sources' own shares are chosen
by log-loss. Where the classifier tells nothing the weight is 0, and documents
without a source get the shares as their posterior; ``classifier_report`` says so.

Non-negative document rates are then fitted by projected-gradient least squares:
expected source token totals (rate x tokens x membership) against the target
totals, every rate between 0 and the cap on repeats. Documents of equal membership
always get equal steps, so the gradient runs over groups of equal membership
(rounded posteriors); each iteration is one small distributed sum.

Rates become whole repeats by one threshold per group on a hash of the document:
all documents get the whole part, those below the threshold one more, the
threshold is set on token totals per hash slot, so the group's total meets its
rate to within a few documents.

Size of the mixture: ``total_tokens`` if given, else the largest total all present
sources can supply within their caps. Shares of targets without any document
cannot be met; they are spread over the others and reported.

Defined results: documents of a source without a target get repeats 0; null or
empty texts have no tokens and get repeats 0; null sources are mixed by
posterior; no targets gives no rows; repeated doc_ids are documents each.
"""

from __future__ import annotations

import re
import warnings
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseworks.llm.fields import arrow_rows
from clauseworks.llm.tokens import VOCABULARY, count_tokens
from clauseworks.session import checkpointed

#: Feature slots of the classifier: the model has SLOTS x sources numbers, whatever the data.
SLOTS = 1 << 14
#: Labelled documents the classifier is fitted and judged on.
FIT_ROWS = 8_000
#: So many documents of all sources are added to each when slot frequencies are counted.
SMOOTH = 20
#: Temperatures and weights of the classifier that are tried on the held-out part.
TEMPERATURES, WEIGHTS = (1, 3, 10, 30, 100, 300), (0.0, 0.25, 0.5, 0.75, 0.9, 0.99)
#: Posteriors are rounded to this many steps, which bounds the groups of equal membership per source count.
STEPS = 8
HASH_SLOTS = 1 << 12
#: Columns whose values are the classifier's features.
FEATURES = ("document_type", "publisher", "lang", "review_status", "confidence")


_WORD = re.compile(r"[^\W\d_]+")
_WIDE = re.compile("[\u0e00-\u0e7f\u3040-\u30ff\u3400-\u9fff]")


def _slots(values: dict[str, str | None]) -> list[int]:
    """Hashed features of a document: metadata, words of the title, words of the text (of scripts without blanks, letter pairs)."""
    out = {f"{c}={values[c]}" for c in FEATURES if c in values}
    if series := re.match(r"[a-z-]+", values.get("document_id") or ""):
        out.add("series=" + series[0])
    for field in ("title", "text"):
        for w in set(_WORD.findall((values.get(field) or "").lower())):
            out.update((f"{field[1]}:{w[i : i + 2]}" for i in range(len(w) - 1)) if _WIDE.match(w) else (f"{field[1]}:{w}",))
    return sorted({zlib.crc32(x.encode("utf-8", "surrogatepass")) % SLOTS for x in out})


def described(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, slots): one reading of the texts.

    ``slots`` are the features of the documents without a source and of the labelled
    sample, null for the others.
    """
    share = min(1.0, FIT_ROWS / max(1, documents.count()))
    carried = [c for c in dict.fromkeys(("text", "title", "document_id", *FEATURES)) if c in documents.columns]
    in_sample = F.xxhash64("doc_id") <= min(2**63 - 1, int(share * 2**64) - 2**63)
    narrow = documents.select("doc_id", F.col("source").cast("string").alias("source"), (F.col("source").isNull() | in_sample).alias("asked"), *[F.col(c).cast("string").alias("of_" + c) for c in carried])
    names = ["doc_id", "source", "n_tokens", "slots"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, slots = [], []
            for asked, *row in arrow_rows(batch, "asked", *["of_" + c for c in carried]):
                values = dict(zip(carried, row))
                counts.append(count_tokens(values["text"], path) if values.get("text") else 0)
                slots.append(_slots(values) if asked else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(counts, pa.int64()), pa.array(slots, pa.list_(pa.int32()))], names=names)

    return narrow.mapInArrow(describe, "doc_id long, source string, n_tokens long, slots array<int>")


class Classifier(NamedTuple):
    """Naive Bayes over feature slots, cooled by a temperature and mixed with the sources' shares."""

    prior: np.ndarray
    like: np.ndarray
    temperature: float = 1.0
    weight: float = 1.0

    def posterior(self, slots: list[int]) -> np.ndarray:
        z = (np.log(np.maximum(self.prior, 1e-300)) + self.like[slots].sum(axis=0)) / self.temperature
        p = np.exp(z - z.max())
        return self.weight * p / p.sum() + (1 - self.weight) * self.prior


def _fit(rows: list[tuple[int, list[int]]], k: int) -> Classifier:
    """Slot frequencies per source, drawn towards those of all documents; a source without documents has no share."""
    counts, prior = np.zeros((SLOTS, k)), np.zeros(k)
    for source, slots in rows:
        counts[slots, source] += 1
        prior[source] += 1
    if not rows:
        return Classifier(np.full(k, 1 / k), np.zeros((SLOTS, k)), weight=0.0)
    of_all = (counts.sum(axis=1, keepdims=True) + 0.5) / (len(rows) + 1)
    return Classifier(prior / len(rows), np.log((counts + SMOOTH * of_all) / (prior + SMOOTH)))


def fit_posteriors(counted: DataFrame, sources: list[str]) -> tuple[Classifier, dict]:
    """The classifier, and how it does on the fifth that is held out against the sources' shares alone."""
    of = {s: i for i, s in enumerate(sources)}
    sample = counted.where(F.col("source").isin(sources) & F.col("slots").isNotNull()).select("doc_id", "source", "slots").collect()  # about FIT_ROWS
    rows = [(of[r["source"]], r["slots"]) for r in sorted(sample, key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))]
    held, fit = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    model = _fit(fit, len(sources))
    if not held:
        return model._replace(weight=0.0), {"n_fit": len(fit), "n_held_out": 0, "accuracy": None, "accuracy_of_shares": None, "log_loss": None, "log_loss_of_shares": None, "temperature": 1.0, "weight": 0.0}
    true = np.array([y for y, _ in held])

    def loss(m: Classifier) -> float:
        p = np.array([m.posterior(slots) for _, slots in held])
        return float(-np.log(np.maximum(p[np.arange(len(true)), true], 1e-12)).mean())

    tried = [model._replace(temperature=float(t), weight=w) for t in TEMPERATURES for w in WEIGHTS if w or t == 1]
    best = min(tried, key=loss)
    shares = model._replace(weight=0.0)
    report = {
        "n_fit": len(fit), "n_held_out": len(held), "accuracy": float(np.mean([model.posterior(x).argmax() == y for y, x in held])),
        "accuracy_of_shares": float((true == model.prior.argmax()).mean()), "log_loss": loss(best), "log_loss_of_shares": loss(shares), "temperature": best.temperature, "weight": best.weight,
    }
    return _fit(rows, len(sources))._replace(temperature=best.temperature, weight=best.weight), report


def classifier_report(counted: DataFrame, targets: DataFrame) -> DataFrame:
    """One row: what ``fit_posteriors`` measured. A weight of 0 means that the shares are used as posterior."""
    schema = "n_fit int, n_held_out int, accuracy double, accuracy_of_shares double, log_loss double, log_loss_of_shares double, temperature double, weight double"
    sources = [r["source"] for r in targets.where("source is not null and target_share > 0").orderBy("source").collect()]
    rows = [tuple(fit_posteriors(counted, sources)[1].values())] if sources else []
    return counted.sparkSession.createDataFrame(rows, schema)


def memberships(counted: DataFrame, sources: list[str]) -> DataFrame:
    """(doc_id, source, n_tokens, h, q): q is the membership in ``STEPS``ths per target source.

    Known sources are certain (a known source without a target belongs to none).
    """
    model, _ = fit_posteriors(counted, sources)
    k = len(sources)
    of = {s: i for i, s in enumerate(sources)}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = []
            for source, slots in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                row = [0] * k
                if source is None:
                    p = STEPS * model.posterior(slots or [])
                    low = np.floor(p).astype(int)
                    low[np.argsort(low - p, kind="stable")[: STEPS - int(low.sum())]] += 1
                    row = low.tolist()
                elif source in of:
                    row[of[source]] = STEPS
                q.append(row)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(q, pa.list_(pa.int32()))], names=["doc_id", "source", "n_tokens", "q"])

    out = counted.select("doc_id", "source", "n_tokens", "slots").mapInArrow(assign, "doc_id long, source string, n_tokens long, q array<int>")
    return out.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(HASH_SLOTS * HASH_SLOTS)))


def _cap(targets: list, q: Column) -> Column:
    """Most repeats of a document: the least cap of the sources it may belong to."""
    caps = F.array(*[F.lit(int(t["max_repeats"])) for t in targets])
    allowed = F.zip_with(q, caps, lambda a, c: F.when(a > 0, c))
    return F.coalesce(F.array_min(F.filter(allowed, lambda x: x.isNotNull())), F.lit(0))


def fit_rates(groups: DataFrame, goal: np.ndarray, iterations: int = 60) -> DataFrame:
    """Rates per membership group by projected gradient on the squared, goal-scaled misses.

    Each iteration sums rate x tokens x membership over the groups in Spark and
    takes a projected step, scaled per source by its supply; it stops when no total moves.
    """
    k = len(goal)
    scale = np.maximum(goal, 1.0)
    share = [F.col("q")[i] / F.lit(float(STEPS)) for i in range(k)]
    totals = groups.agg(*[F.sum(F.col("tokens") * s).alias(f"t{i}") for i, s in enumerate(share)]).first()
    supply = np.array([float(totals[i] or 0.0) for i in range(k)])
    start = np.clip(goal / np.maximum(supply, 1.0), 0.0, None)
    state = groups.withColumn("rate", F.least(sum(s * F.lit(float(x)) for s, x in zip(share, start)), F.col("cap").cast("double")))
    state = checkpointed(state)
    last, moved = None, 1.0
    for i in range(iterations):
        got = state.agg(*[F.sum(F.col("rate") * F.col("tokens") * s).alias(f"t{j}") for j, s in enumerate(share)]).first()
        miss = np.array([float(got[j] or 0.0) for j in range(k)]) / scale - goal / scale
        moved = np.abs(miss - (0 if last is None else last)).max()
        if np.abs(miss).max() < 1e-6 or moved < 1e-9:
            break
        last = miss
        # preconditioned per source: the step of a group depends on its membership, not on its size
        precondition = np.where(supply > 0, supply / scale, 1.0)
        slope = sum(s * F.lit(float(m / p)) for s, m, p in zip(share, miss, precondition))
        state = state.withColumn("rate", F.greatest(F.lit(0.0), F.least(F.col("cap").cast("double"), F.col("rate") - slope)))
        if i % 8 == 7:
            state = checkpointed(state)
    else:
        warnings.warn(f"source totals still move by {moved:.1e} of their targets after {iterations} steps", stacklevel=2)
    return checkpointed(state.select("source", "q", "cap", "tokens", "rate"))


def mix(counted: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, q, rate, repeats) for every document.

    ``counted`` is the ``described`` documents; ``targets`` a fixed handful of rows
    (source, target_share, max_repeats).
    """
    rows = targets.where("source is not null and target_share > 0").orderBy("source").collect()
    if not rows:
        return counted.sparkSession.createDataFrame([], "doc_id long, source string, n_tokens long, q array<int>, rate double, repeats int")
    sources = [r["source"] for r in rows]
    k = len(rows)
    docs = memberships(counted, sources)
    docs = checkpointed(docs.withColumn("cap", F.when(F.col("n_tokens") > 0, _cap(rows, F.col("q"))).otherwise(0)))
    # a document without a source is a group apart from the source's own
    groups = docs.where("cap > 0").groupBy("source", "q", "cap").agg(F.sum("n_tokens").alias("tokens"))
    groups = checkpointed(groups)
    share = [F.col("q")[i] / F.lit(float(STEPS)) for i in range(k)]
    got = groups.agg(*[F.sum(F.when(F.col("source").isNotNull(), F.col("tokens") * F.col("cap") * s)).alias(f"t{i}") for i, s in enumerate(share)]).first()
    most = np.array([float(got[i] or 0.0) for i in range(k)])
    want = np.array([float(r["target_share"]) for r in rows])
    present = most > 0
    want = np.where(present, want, 0.0)
    want = want / want.sum() if want.sum() else want
    total = float(total_tokens) if total_tokens else float(np.floor((most[present] / want[present]).min())) if present.any() else 0.0
    rates = fit_rates(groups, want * total)

    # whole repeats: the fraction of a group's tokens is met by a threshold on the hash, in two levels
    part = rates.select("source", "q", "cap", "rate", F.floor("rate").cast("int").alias("whole"), ((F.col("rate") - F.floor("rate")) * F.col("tokens")).alias("extra"))
    same = [docs["q"] == part["q"], docs["source"].eqNullSafe(part["source"]), docs["cap"] == part["cap"]]
    part = F.broadcast(part) if _few(part) else part
    keyed = docs.join(part, same[0] & same[1] & same[2], "left").select(
        docs["doc_id"], docs["source"], docs["n_tokens"], docs["q"], "h", F.coalesce("rate", F.lit(0.0)).alias("rate"),
        F.coalesce("whole", F.lit(0)).alias("whole"), F.coalesce("extra", F.lit(0.0)).alias("extra"),
    )
    keyed = checkpointed(keyed)
    high = F.floor(F.col("h") / HASH_SLOTS)
    group = ["source", "q", "whole", "extra"]
    def below(level: DataFrame, order: str, base: Column) -> DataFrame:
        over = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return level.withColumn("sum_to", base + F.sum("tokens").over(over))

    slots = keyed.where("extra > 0").groupBy(*group, high.alias("slot")).agg(F.sum("n_tokens").alias("tokens"))
    edge = below(slots, "slot", F.lit(0)).where("sum_to > extra").groupBy(*group).agg(F.min_by(F.struct("slot", (F.col("sum_to") - F.col("tokens")).alias("base")), "slot").alias("edge"))
    edge = checkpointed(edge.select(*group, "edge.slot", "edge.base"))

    def on_group(a: DataFrame, b: DataFrame) -> Column:
        return a["source"].eqNullSafe(b["source"]) & (a["q"] == b["q"]) & (a["whole"] == b["whole"]) & (a["extra"] == b["extra"])

    marked = keyed.join(F.broadcast(edge) if _few(edge) else edge, on_group(keyed, edge), "left").select(keyed["*"], "slot", "base")
    fine = marked.where(high == F.col("slot")).groupBy(*group, "base", "h").agg(F.sum("n_tokens").alias("tokens"))
    cut = below(fine, "h", F.col("base")).where(2 * F.col("sum_to") - F.col("tokens") <= 2 * F.col("extra")).groupBy(*group).agg(F.max("h").alias("last"))
    cut = checkpointed(cut)
    done = marked.join(F.broadcast(cut) if _few(cut) else cut, on_group(marked, cut), "left").select(marked["*"], "last")
    one_more = (F.col("extra") > 0) & (F.col("slot").isNull() | (high < F.col("slot")) | ((high == F.col("slot")) & (F.col("h") <= F.col("last"))))
    return done.select("doc_id", "source", "n_tokens", "q", "rate", (F.col("whole") + F.when(one_more, 1).otherwise(0)).cast("int").alias("repeats"))


def _few(df: DataFrame, rows: int = 50_000) -> bool:
    return df.limit(rows + 1).count() <= rows


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: target share, actual share, documents used, most repeats of one document.

    Documents without a source count for the sources they belong to, in proportion.
    Sources on either side only are listed too.
    """
    rows = targets.where("source is not null and target_share > 0").orderBy("source").collect()
    names = F.array(*[F.lit(r["source"]) for r in rows])
    used = mixed.withColumn("taken", F.col("n_tokens") * F.col("repeats"))
    soft = used.where("repeats > 0").select(F.posexplode("q").alias("pos", "part"), "taken", "repeats").where("part > 0")
    soft = soft.select(F.element_at(names, F.col("pos") + 1).alias("source"), (F.col("taken") * F.col("part") / STEPS).alias("taken"), "repeats")
    got = soft.groupBy("source").agg(F.sum("taken").alias("tokens"), F.count(F.lit(1)).alias("n_documents"), F.max("repeats").alias("most_repeats"))
    without = used.where(F.col("source").isNotNull()).groupBy("source").agg(F.sum("taken").alias("own_tokens")).select("source")
    every = targets.where("source is not null").select("source").union(without).distinct()
    total = got.agg(F.sum("tokens").alias("all_tokens"))
    return (
        every.join(targets, "source", "left")
        .join(got, "source", "left")
        .join(F.broadcast(total))
        .select(
            "source",
            F.coalesce("target_share", F.lit(0.0)).alias("target_share"),
            F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"),
            F.coalesce("tokens", F.lit(0.0)).alias("tokens"),
            F.coalesce("n_documents", F.lit(0)).alias("n_documents"),
            F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
            F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"),
        )
    )
