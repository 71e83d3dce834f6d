"""Toxicity by non-negative positive-unlabelled learning (operator 10).

Confirmed toxic documents are the positives; every other document, labelled or
not, is unlabelled text that holds toxic documents at the class prior. Linear
classifiers are fitted in numpy with the class-prior corrected risk

    prior * E_P[loss(g)] + max(0, E_U[loss(-g)] - prior * E_P[loss(-g)]),

whose second part, the risk on negatives, is kept from going below zero: where
it would, the step follows its gradient upwards instead.

Features are the distinct words of a text in lower case (runs of letters a to z and
of characters beyond ASCII) and their first bytes (three to six), hashed into
``2**FEATURE_BITS`` places, so that inflected and compound forms of a stem help
each other. How many documents hold a feature is counted
over all training documents and over the positives; the ``MAX_FEATURES``
features whose two shares differ most for their size are kept. All training
documents are unlabelled examples: they are dealt out to members of about
``MEMBER_ROWS`` rows, each member is fitted by one task against the same
positives, and weights are averaged.

Only labelled rows are sampled, those with the smallest hash of their id: at
most ``max_positive`` positives, and at most ``max_labelled`` labelled rows to
choose the L1 penalty and to calibrate. A quarter of these is set aside: the penalty
with the least risk on it wins, and a logistic curve fitted there turns the
classifier's value into a probability. The class prior comes from all labels of
the training rows. Scoring reads every row and whole texts.

Defined results: null and empty texts are scored like any text without known
features. A label row that is null or repeated counts by its largest label. Rows
without ``doc_id`` fall into the held-out part. Without any positive example
every score is almost 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsink.llm.common import mix64, text_of, written
from docsink.llm.words import split_words

MAX_POSITIVE = 9_000
MAX_LABELLED = 27_000
MAX_FEATURES = 4_096
FEATURE_BITS = 18
PREFIXES = (3, 4, 5, 6)
MIN_POSITIVE = 3  # positives that must hold a feature
MEMBER_ROWS = 20_000
STEPS = 100
RATE = 0.1
PENALTIES = (1.5e-3, 5e-4, 2e-4, 5e-5)
SCALE = 8.0  # length of a document's vector of features
PIECE_CHARS = 300_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_MASK = (1 << FEATURE_BITS) - 1
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def features_of(texts: list[str], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of several texts, one text after another, and how many each has.

    With ``known``, a table by feature, its numbers instead, without those below 0.
    """
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    words = split_words(raw, _LETTER)
    number, length = words.numbers(), words.end - words.start
    # Equal words of a text count once.
    with np.errstate(over="ignore"):
        _, first = np.unique(mix64(number + words.doc.astype(np.uint64) * _GOLDEN), return_index=True)
        marks = {n: np.uint64(n) * _GOLDEN for n in PREFIXES}
    first.sort()
    number, length, doc = number[first], length[first], words.doc[first]
    heads = words.heads()[first]
    parts, owners = [number & np.uint64(_MASK)], [doc]
    for n in PREFIXES:
        some = length >= n
        head = heads[some] & np.uint64((1 << 8 * n) - 1)
        parts.append(mix64(head + marks[n]) & np.uint64(_MASK))
        owners.append(doc[some])
    feature, owner = np.concatenate(parts).astype(np.int64), np.concatenate(owners)
    if known is not None:
        feature = known[feature]
        owner, feature = owner[feature >= 0], feature[feature >= 0]
    pairs = np.unique(owner << 32 | feature)
    return pairs & 0xFFFFFFFF, np.bincount(pairs >> 32, minlength=len(texts))


def _in_pieces(texts: list[str]) -> Iterator[list[str]]:
    """Texts of about ``PIECE_CHARS`` characters at a time, one at least."""
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= PIECE_CHARS):
            size += len(texts[end])
            end += 1
        yield texts[begin:end]
        begin = end


def is_held_out(doc_id: str = "doc_id") -> Column:
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key) % 5 == 0


class _Rows:
    """Sparse 0/1 rows, scaled to length ``SCALE``."""

    def __init__(self, rows: list[np.ndarray]) -> None:
        sizes = np.array([len(r) for r in rows], np.int64)
        self.n = len(rows)
        self.column = np.concatenate(rows).astype(np.int32) if self.n else np.zeros(0, np.int32)
        self.sizes = sizes
        self.full = np.flatnonzero(sizes)
        self.begin = (np.cumsum(sizes) - sizes)[self.full]
        self.value = SCALE / np.sqrt(np.maximum(sizes, 1))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.full):
            out[self.full] = np.add.reduceat(weights[self.column], self.begin) * self.value[self.full]
        return out

    def transposed_dot(self, x: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, np.repeat(x * self.value, self.sizes), width)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _risk(at_p: np.ndarray, at_u: np.ndarray, prior: float) -> float:
    """Non-negative risk of a classifier's values at positives and at unlabelled rows."""
    negatives = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
    return prior * np.logaddexp(0, -at_p).mean() + max(0.0, negatives)


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, width: int, penalty: float
) -> tuple[np.ndarray, float]:
    """Weights and constant that minimise the non-negative risk plus an L1 penalty.

    Accelerated proximal gradient on whole batches; the penalty leaves features
    that only some noisy labels speak for at zero.
    """
    p, u = _Rows(positive), _Rows(unlabelled)
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    ahead, pace = theta, 1.0
    for _ in range(STEPS):
        at_p, at_u = p.dot(ahead[:-1]) + ahead[-1], u.dot(ahead[:-1]) + ahead[-1]
        # Derivatives of the logistic losses by g.
        as_positive = prior * -_sigmoid(-at_p) / p.n
        p_negative = -prior * _sigmoid(at_p) / p.n
        u_negative = _sigmoid(at_u) / u.n
        on_negatives = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        if on_negatives >= 0:
            by_p, by_u = as_positive + p_negative, u_negative
        else:
            by_p, by_u = -p_negative, -u_negative
        slope = np.append(p.transposed_dot(by_p, width) + u.transposed_dot(by_u, width), by_p.sum() + by_u.sum())
        moved = ahead - RATE * slope
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - RATE * penalty, 0)
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead, theta, pace = moved + (pace - 1) / faster * (moved - theta), moved, faster
    return theta[:-1], float(theta[-1])


@dataclass(frozen=True)
class Model:
    """Weights of hashed features, and the curve that turns a value into a probability."""

    constant: float
    weights: dict[int, float] = field(default_factory=dict)
    slope: float = 1.0
    shift: float = 0.0

    def values(self, feature: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Values of rows of features that have a weight."""
        table = np.zeros(_MASK + 1)
        table[list(self.weights)] = list(self.weights.values())
        owner = np.repeat(np.arange(len(sizes)), sizes)
        sums = np.bincount(owner, table[feature], len(sizes))
        return sums * SCALE / np.sqrt(np.maximum(sizes, 1)) + self.constant

    def probabilities(self, feature: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.values(feature, sizes) + self.shift)


def calibrated(values: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits labels best; targets are smoothed (Platt)."""
    n, m = int(toxic.sum()), int((~toxic).sum())
    if not n or not m:
        return 1.0, 0.0
    target = np.where(toxic, (n + 1) / (n + 2), 1 / (m + 2))
    theta = np.array([1.0, 0.0])
    design = np.stack([values, np.ones_like(values)], axis=1)
    for _ in range(100):
        p = _sigmoid(design @ theta)
        slope = design.T @ (p - target)
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)


def _sampled_labels(labels: DataFrame, max_positive: int, max_labelled: int) -> DataFrame:
    """``doc_id, toxic`` of the labelled rows that are looked at."""

    def first(rows: DataFrame, count: int) -> DataFrame:
        return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(count)

    return first(labels.where("toxic = 1"), max_positive).unionByName(first(labels.where("toxic <> 1"), max_labelled))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows of a task, and how many positives among them, hold each feature."""
    counts = np.zeros((2, _MASK + 2), np.int64)
    for batch in batches:
        begin = 0
        positive = batch.column(1).to_numpy(zero_copy_only=False)
        for texts in _in_pieces(batch.column(0).to_pylist()):
            feature, sizes = features_of(texts)
            here = positive[begin : begin + len(texts)]
            counts[0] += np.bincount(feature, minlength=_MASK + 2)
            counts[1] += np.bincount(feature[np.repeat(here, sizes)], minlength=_MASK + 2)
            counts[:, -1] += len(texts), here.sum()
            begin += len(texts)
    used = np.flatnonzero(counts[0])
    yield pa.record_batch(
        {"feature": pa.array(used, pa.int64()), "n": pa.array(counts[0, used]), "positive": pa.array(counts[1, used])}
    )


def _telling(counts: pa.Table, max_features: int) -> list[int]:
    """Features whose share among positives differs most from that among all rows, in standard errors."""
    feature, n, positive = (counts[c].to_numpy() for c in ("feature", "n", "positive"))
    rows, positives = n[feature > _MASK].sum(), positive[feature > _MASK].sum()
    if not positives:
        return []
    share = n / rows
    error = np.sqrt(np.maximum(share * (1 - share), 0) / positives) + 1e-12
    strength = np.abs(positive / positives - share) / error
    strength[(feature > _MASK) | (positive < MIN_POSITIVE)] = -1
    order = np.lexsort((feature, -strength))[:max_features]
    return feature[order[strength[order] > 0]].tolist()


def _known_features(features: list[int]):
    """Rows as numbers of known features."""
    known = np.full(_MASK + 1, -1, np.int64)
    known[features] = np.arange(len(features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for texts in _in_pieces(batch.column(1).to_pylist()):
                found, sizes = features_of(texts, known)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0).slice(begin, len(texts)),
                        "toxic": batch.column(2).slice(begin, len(texts)),
                        "known": pa.ListArray.from_arrays(offsets, pa.array(found.astype(np.int32))),
                    }
                )
                begin += len(texts)

    return run


def _apart(ids: list, toxic: np.ndarray) -> np.ndarray:
    """Which labelled rows are set aside: a quarter, if that leaves and takes both kinds."""
    apart = np.array([zlib.crc32(f"apart {i}".encode()) % 4 == 0 for i in ids], bool)
    enough = min((toxic & apart).sum(), (toxic & ~apart).sum(), (~toxic & apart).sum()) > 0
    return apart if enough else np.zeros(len(ids), bool)


def _penalty(rows: list[np.ndarray], toxic: np.ndarray, apart: np.ndarray, prior: float, width: int, spark) -> float:
    """Penalty of least risk on the rows set aside; a task per penalty."""
    if not apart.any():
        return PENALTIES[1]

    def part(which: np.ndarray) -> list[np.ndarray]:
        return [rows[i] for i in np.flatnonzero(which)]

    def trial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for penalty in frame["penalty"]:
                weights, constant = fit(part(toxic & ~apart), part(~apart), prior, width, penalty)
                values = _Rows(part(apart)).dot(weights) + constant
                yield pd.DataFrame({"penalty": [penalty], "risk": [_risk(values[toxic[apart]], values, prior)]})

    trials = spark.createDataFrame([(p,) for p in PENALTIES], "penalty double").repartition(len(PENALTIES), "penalty")
    done = trials.mapInPandas(trial, "penalty double, risk double").collect()
    return min(done, key=lambda r: (r.risk, -r.penalty)).penalty


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    max_positive: int = MAX_POSITIVE,
    max_labelled: int = MAX_LABELLED,
    max_features: int = MAX_FEATURES,
    member_rows: int = MEMBER_ROWS,
) -> Model:
    """Averaged weights of the ensemble, calibrated."""
    spark = docs.sparkSession
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out())
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = labels.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("toxic")).first()
    if not counts.toxic:
        return Model(-30.0)
    prior = min(max(counts.toxic / counts.n, 1e-4), 0.9)
    empty = Model(float(np.log(prior / (1 - prior))))

    # At most ``max_positive + max_labelled`` rows of two numbers.
    sampled = F.broadcast(written(_sampled_labels(labels, max_positive, max_labelled), "labelled"))
    rows = docs.where(F.col("doc_id").isNotNull() & ~is_held_out()).select("doc_id", text_of().alias("text"))
    rows = rows.join(sampled, "doc_id", "left").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    marked = rows.select("text", F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("positive"))
    counted = marked.mapInArrow(_counts, "feature long, n long, positive long")
    summed = counted.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
    features = _telling(summed.toArrow(), max_features)  # one row per place of the hash
    if not features:
        return empty

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_known_features(features), f"doc_id {doc_id}, toxic int, known array<int>")
    found = written(found, "features")
    labelled = found.where("toxic is not null").dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id").combine_chunks()
    toxic = labelled["toxic"].to_numpy() == 1
    held = [np.asarray(row.values, np.int32) for row in labelled["known"]]
    apart = _apart(labelled["doc_id"].to_pylist(), toxic)
    penalty = _penalty(held, toxic, apart, prior, len(features), spark)
    positive = [held[i] for i in np.flatnonzero(toxic & ~apart)]

    def member(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(size=group["known"].map(len)).sort_values(["doc_id", "size"])
        weights, constant = fit(positive, group["known"].tolist(), prior, len(features), penalty)
        used = np.flatnonzero(weights)
        return pd.DataFrame(
            {"number": [*used, -1], "weight": np.append(weights[used], constant) * len(group), "rows": len(group)}
        )

    members = max(1, -(-found.count() // member_rows))
    dealt = found.select("doc_id", "known", F.pmod(F.xxhash64("doc_id"), F.lit(members)).alias("member"))
    fitted = dealt.groupBy("member").applyInPandas(member, "number long, weight double, rows long")
    averaged = fitted.groupBy("number").agg(F.sum("weight").alias("weight"), F.sum("rows").alias("rows")).collect()
    total = sum(r["rows"] for r in averaged if r.number < 0)
    constant = sum(r.weight for r in averaged if r.number < 0) / total
    weights = {features[r.number]: r.weight / total for r in averaged if r.number >= 0 and r.weight}
    # Features without a weight count for the length of a row, too.
    model = Model(constant, {f: weights.get(f, 0.0) for f in features})
    aside = [held[i] for i in np.flatnonzero(apart)]
    places = np.array(features, np.int64)[np.concatenate([np.zeros(0, np.int64), *aside])]
    values = model.values(places, np.array([len(row) for row in aside], np.int64))
    slope, shift = calibrated(values, toxic[apart])
    return replace(model, slope=slope, shift=shift)


def score_column(model: Model, text: str = "text") -> Column:
    """Probability of being toxic, 0 to 1."""

    known = np.full(_MASK + 1, -1, np.int64)
    known[list(model.weights)] = list(model.weights)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [model.probabilities(*features_of(piece, known)) for piece in _in_pieces(texts.tolist())]
            yield pd.Series(np.concatenate([np.zeros(0), *found]))

    scores.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(scores, "double")(text_of(text))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    scored = docs.select("doc_id", is_held_out().alias("held_out"), score_column(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not predicted toxic, with the columns of ``docs``."""
    rows = docs.select(F.struct("*").alias("_row"), score_column(model).alias("_score"))
    return rows.where("_score < 0.5").select("_row.*")
