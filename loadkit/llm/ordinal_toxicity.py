"""Severity grades of toxic text by cumulative-link ordinal regression.

Features are sparse: words and their first letters, counted as log(1 + n). One
weight vector serves every threshold: P(grade <= k) = sigmoid(cut[k] - w.x),
with increasing cuts. The labels name toxic and other texts only, so the grades
of toxic texts are set by how dense the words are that tell the two apart:
other texts are grade 0, toxic ones 1 to 3 by the thirds of that density.

Defined results. A missing, empty or wordless text has no features; it gets the
probabilities of w.x = 0 and is kept. Without labels of both kinds, or a word that tells
them apart, nothing is learned: every text is grade 0. Labels that repeat a document count once if they agree
and not at all if they differ. Rows that repeat a doc_id are judged each on
its own text; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm import textarrays as X
from loadkit.llm.shared import map_batches, schema, stage

LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """The classifier is fitted on about `sample` labelled texts of each kind. A feature
    is used when at least `least` of these hold it, the log of how much more often one
    kind holds it is above `odds`, and the root of its likelihood ratio statistic is above
    `z`. A text is rejected when its expected severity is at least `limit`."""

    sample: int = 4000
    least: int = 4
    odds: float = 1.5
    z: float = 4.0
    grades: int = 4
    prefixes: tuple[int, ...] = (4, 5, 6)
    l2: float = 1e-3
    steps: int = 400
    limit: float = 0.35


@dataclass
class Model:
    """Weights by feature, shared by all thresholds, and the increasing cuts."""

    weights: dict[str, float] = field(default_factory=dict)
    cuts: tuple[float, ...] = ()


def features_of(word: str, prefixes: tuple[int, ...]) -> list[str]:
    """A word and, marked by a star, its beginnings."""
    return [word, *[word[:k] + "*" for k in prefixes if len(word) > k]]


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def grade_probabilities(score: np.ndarray, cuts: tuple[float, ...]) -> np.ndarray:
    """P(grade = k) for each score, one row per text."""
    below = np.column_stack([np.zeros(len(score)), *[sigmoid(c - score) for c in cuts], np.ones(len(score))])
    return np.diff(below, axis=1)


def fit_cumulative_link(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grade: np.ndarray, n_features: int,
                        settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts by full-batch Adam on the mean log loss of sparse rows.

    Cuts are c0 and c0 plus sums of exp(d), so that they stay in order.
    """
    n, tops = len(grade), settings.grades - 1
    counts = np.bincount(grade, minlength=settings.grades)
    share = np.clip(np.cumsum(counts)[:-1] / n, 0.01, 0.99)
    start = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    # The toxic texts weigh a fifth together, whatever the sample holds of them: a text without features is then kept.
    weight = np.where(grade > 0, 0.2 / max(1, (grade > 0).sum()), 0.8 / max(1, (grade == 0).sum()))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, settings.steps + 1):
        w, gaps = theta[:n_features], np.exp(theta[n_features + 1:])
        cuts = theta[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(rows, values * w[cols], minlength=n)
        upper = np.where(grade < tops, sigmoid(cuts[np.minimum(grade, tops - 1)] - score), 1.0)
        lower = np.where(grade > 0, sigmoid(cuts[np.maximum(grade - 1, 0)] - score), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        up, down = weight * upper * (1 - upper) / p, weight * lower * (1 - lower) / p
        by_score = up - down  # the loss falls by -d(score)
        by_cut = np.bincount(np.minimum(grade, tops - 1), np.where(grade < tops, -up, 0), minlength=tops)
        by_cut += np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, down, 0), minlength=tops)
        by_gap = np.cumsum(by_cut[::-1])[::-1]
        g = np.concatenate([np.bincount(cols, values * by_score[rows], minlength=n_features) + settings.l2 * w / n_features,
                            by_gap[:1], by_gap[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    gaps = np.exp(theta[n_features + 1:])
    return theta[:n_features], theta[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(text, toxic) of about `sample` labelled documents of each kind, chosen by hash."""
    known = (labels.select(F.col("doc_id").alias("doc"), F.col("toxic").alias("toxic")).where("doc IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("doc").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other").drop("other"))
    counts = known.groupBy("toxic").agg(F.count("*").alias("n"))
    share = F.pmod(F.xxhash64("doc", F.lit(5)), F.lit(1 << 40)) / float(1 << 40)
    few = stage(known.join(counts, "toxic").where(share * F.col("n") < F.lit(settings.sample)).select("doc", "toxic"), "labelled-sample")
    # About `sample` ids of each kind, which is checked; the texts are then not shuffled.
    if few.count() <= 8 * settings.sample:
        few = F.broadcast(few)
    given = docs.select(F.col("doc_id").alias("doc"), F.col("text").alias("text")).join(few, "doc")
    # Rows that repeat an id are one document, with the least of their texts.
    return given.groupBy("doc", "toxic").agg(F.min("text").alias("text")).select("doc", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from a bounded sample of the labelled documents.

    Executors turn the sampled texts into feature counts; the driver gets the
    bounded sample's candidate features and fits the weights.
    """
    def count(batch) -> Iterator[pa.RecordBatch]:
        words, held, times = [], [], []
        for text in batch.column("text").to_pylist():
            found = words_of(text)
            tally: dict[str, int] = {}
            for word in found:
                for f in features_of(word, settings.prefixes):
                    tally[f] = tally.get(f, 0) + 1
            words.append(len(found)), held.append(list(tally)), times.append(list(tally.values()))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("toxic"), pa.array(words, pa.int64()), pa.array(held, pa.list_(pa.string())),
             pa.array(times, pa.list_(pa.int64()))], ["doc", "toxic", "words", "features", "times"])

    sample = labelled_sample(docs, labels, settings)
    kinds = {f.name: f.dataType.simpleString() for f in sample.schema.fields}
    counted = map_batches(sample, count, f"doc {kinds['doc']}, toxic {kinds['toxic']}, words long, features array<string>, times array<long>")
    counted = counted.persist()
    try:
        return _fit_counted(counted, settings)
    finally:
        counted.unpersist()


def _fit_counted(counted: DataFrame, settings: Settings) -> Model:
    pairs = counted.select((F.col("toxic") > 0).alias("toxic"), F.explode("features").alias("feature"))
    kinds = {r.toxic: r.n for r in counted.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return Model()
    yes, no = kinds[True], kinds[False]
    held = pairs.groupBy("feature").agg(F.sum(F.col("toxic").cast("long")).alias("a"), F.sum((~F.col("toxic")).cast("long")).alias("b"))
    # Root of the likelihood ratio statistic: how far the feature's texts are from the sample's mix of kinds.
    total = F.col("a") + F.col("b")
    part = lambda n, of: F.when(n > 0, n * F.log(n / (total * F.lit(of / (yes + no))))).otherwise(0.0)
    ratio = F.sqrt(F.greatest(2 * (part(F.col("a"), yes) + part(F.col("b"), no)), F.lit(0.0)))
    sign = F.when(F.col("a") * F.lit(no) > F.col("b") * F.lit(yes), 1).otherwise(-1)
    odds = F.log((F.col("a") + 0.5) / (yes + 1) / ((F.col("b") + 0.5) / (no + 1)))
    chosen = (held.where((total >= settings.least) & (F.abs(odds) > settings.odds))
              .withColumn("z", ratio * sign).where(F.abs("z") > settings.z))
    signs = {r.feature: r.z for r in chosen.select("feature", "z").collect()}
    if not signs:
        return Model()
    place = {f: i for i, f in enumerate(sorted(signs))}
    keep = chosen.select("feature")
    each = (counted.select("doc", "toxic", "words", F.explode(F.arrays_zip("features", "times")).alias("x"))
            .select("doc", "toxic", "words", F.col("x.features").alias("feature"), F.col("x.times").alias("times")).join(keep, "feature"))
    found = {r.doc: r for r in each.groupBy("doc").agg(F.collect_list("feature").alias("f"), F.collect_list("times").alias("t")).collect()}
    texts = sorted(counted.select("doc", "toxic", "words").collect(), key=lambda r: r.doc)
    rows, cols, values, density = [], [], [], np.zeros(len(texts))
    for i, text in enumerate(texts):
        if (row := found.get(text.doc)) is not None:
            for f, t in zip(row.f, row.t):
                rows.append(i), cols.append(place[f]), values.append(np.log1p(t))
                density[i] += t * (signs[f] > 0) / max(1, text.words)
    toxic = np.array([r.toxic > 0 for r in texts])
    thirds = np.quantile(density[toxic], np.arange(1, settings.grades - 1) / (settings.grades - 1))
    grade = np.where(toxic, 1 + np.searchsorted(thirds, density, side="right"), 0)
    w, cuts = fit_cumulative_link(np.array(rows, np.int64), np.array(cols, np.int64), np.array(values), grade, len(place), settings)
    return Model({f: float(w[i]) for f, i in place.items()}, tuple(float(c) for c in cuts))


class Judge:
    """Scores of texts; the features of words seen before are remembered, up to a bound."""

    def __init__(self, model: Model, settings: Settings):
        self.model, self.settings, self.memo = model, settings, {}
        self.number = {f: i for i, f in enumerate(model.weights)}
        self.weight = np.array(list(model.weights.values()) or [0.0])

    def known(self, word: str) -> list[int]:
        if word not in self.memo:
            if len(self.memo) > 100_000:
                self.memo.clear()
            self.memo[word] = [self.number[f] for w in words_of(word) for f in features_of(w, self.settings.prefixes) if f in self.number]
        return self.memo[word]

    def scores(self, column: pa.Array) -> np.ndarray:
        """w.x of every text. Words between white space are looked up once per batch."""
        data, offsets = X.flat(column)
        texts = len(offsets) - 1
        words = X.Words(data, offsets)
        code, distinct = X.codes(words.array())
        known = [self.known(w.decode()) for w in X.as_list(distinct)]
        many = np.array([len(k) for k in known], np.int64)
        hit = np.flatnonzero(many[code]) if len(code) else code
        text_of = np.repeat(np.arange(texts), np.diff(words.first))[hit]
        begin = np.concatenate([[0], np.cumsum(many)])
        every = np.array([f for k in known for f in k], np.int64)
        reps = many[code[hit]]
        inner = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        feature = every[np.repeat(begin[code[hit]], reps) + inner] if reps.sum() else np.zeros(0, np.int64)
        pair, times = np.unique(np.repeat(text_of, reps) * len(self.weight) + feature, return_counts=True)
        return np.bincount(pair // len(self.weight), np.log1p(times) * self.weight[pair % len(self.weight)], minlength=texts)


def judge(docs: DataFrame, model: Model, settings: Settings = Settings(), text: str = "text",
          carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns of every row with P(grade > 0), the expected severity and the verdict."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.col(f"`{text}`").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"))
    made: list[Judge] = []

    def work(batch):
        if not made:
            made.append(Judge(shipped.value, settings))
        score = made[0].scores(batch.column("_text"))
        p = grade_probabilities(score, shipped.value.cuts)
        severity = p @ np.arange(p.shape[1])
        grade = p.argmax(axis=1).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column("_row"), pa.array(1 - p[:, 0]), pa.array(severity), pa.array(grade), pa.array(severity >= settings.limit)],
            ["_row", "p_toxic", "expected_severity", "grade", "toxic"])

    out = map_batches(given, work, schema(given.schema["_row"], "p_toxic double, expected_severity double, grade int, toxic boolean"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in carry], "p_toxic", "expected_severity", "grade", "toxic",
                      (~F.col("toxic")).alias("kept"))
