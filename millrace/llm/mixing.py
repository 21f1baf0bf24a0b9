"""Soft-membership mixing: document rates whose expected tokens per domain match target weights."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import _PLACES, mix, slices, utf8, word_hashes
from millrace.session import stored

BITS = 17


@dataclass(frozen=True)
class DomainModel:
    """Weights of hashed words and word pairs per domain; ``bias`` is the log prior."""

    domains: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def posteriors(self, features: list[np.ndarray]) -> np.ndarray:
        if not self.domains:
            return np.zeros((len(features), 0))
        logits = np.tile(self.bias.astype(np.float64), (len(features), 1))
        for row, own in enumerate(features):
            if len(own):
                logits[row] += self.weights[own].sum(axis=0) / np.sqrt(len(own))
        logits /= self.temperature
        shares = np.exp(logits - logits.max(axis=1, keepdims=True))
        return shares / shares.sum(axis=1, keepdims=True)


def features_of(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Per row the distinct buckets of its words and pairs of neighbouring words, and its number of words."""
    words, bounds = word_hashes(data, offsets)
    shift = np.uint64(64 - BITS)
    single = (words >> shift).astype(np.int32)
    double = (mix(words[:-1] * _PLACES[0] + words[1:] * _PLACES[1]) >> shift).astype(np.int32)
    found = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        found.append(np.unique(np.concatenate([single[first:last], double[first:max(first, last - 1)]])))
    return found, np.diff(bounds)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found, _ = features_of(*utf8(batch.column("text")))
        yield pa.record_batch({"domain": batch.column("domain"), "buckets": pa.array([x.tobytes() for x in found], pa.binary())})


def fit(labels: list[str], features: list[np.ndarray], epochs: int = 6, batch: int = 16, rate: float = 0.5,
        decay: float = 1e-4, seed: int = 5) -> DomainModel:
    """Multinomial logistic regression by stochastic gradient descent; the temperature comes from a tenth left out."""
    domains = tuple(sorted(set(labels)))
    if not domains:
        return DomainModel((), np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0)
    place = {x: k for k, x in enumerate(domains)}
    target = np.array([place[x] for x in labels])
    prior = np.bincount(target, minlength=len(domains)) / len(target)
    weights, bias = np.zeros((1 << BITS, len(domains)), np.float32), np.log(prior)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    aside, learned = order[:len(order) // 10], order[len(order) // 10:]
    steps, step = max(1, epochs * -(-len(learned) // batch)), 0
    for _ in range(epochs):
        rng.shuffle(learned)
        for first in range(0, len(learned), batch):
            rows, now = learned[first:first + batch], rate * (1 - step / steps)
            step += 1
            wrong = DomainModel(domains, weights, bias, 1.0).posteriors([features[k] for k in rows])
            wrong[np.arange(len(rows)), target[rows]] -= 1
            for k, gap in zip(rows, wrong, strict=True):
                own = features[k]
                if len(own):
                    weights[own] -= now * (gap / np.sqrt(len(own)) + decay * weights[own])
    temperature = 1.0
    if len(aside):
        truth, held = target[aside], [features[k] for k in aside]
        temperature = min(np.geomspace(0.25, 8, 41), key=lambda t: -np.log(DomainModel(
            domains, weights, bias, t).posteriors(held)[np.arange(len(truth)), truth] + 1e-12).mean())
    return DomainModel(domains, weights, bias, float(temperature))


def shares_of_sample(counts: Mapping[str, int], most: int) -> dict[str, int]:
    """How many rows of each domain a sample of ``most`` takes: in proportion, but of a rare one at least an equal part of half."""
    total, least = max(1, sum(counts.values())), most // (2 * max(1, len(counts)))
    return {x: min(n, max(least, (most // 2) * n // total)) for x, n in sorted(counts.items())}


def learn_domains(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  label_column: str = "domain", most: int = 4000, longest: int = 20_000) -> DomainModel:
    """A classifier of domains from at most ``most`` labelled rows, as many of each domain, chosen by a hash of the id.

    Only rows whose text has up to ``longest`` characters are chosen. Labels without id or domain are left out; an id
    labelled twice counts with its alphabetically last domain.
    """
    named = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("domain")).filter(
        "id IS NOT NULL AND domain IS NOT NULL").groupBy("id").agg(F.max("domain").alias("domain"))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter(
        f"id IS NOT NULL AND length(text) <= {longest}")
    usable = stored(rows.select("id").join(named, "id").distinct().withColumn("_luck", F.xxhash64(F.lit(3), "id")), "labelled")
    counts = {r["domain"]: r["count"] for r in usable.groupBy("domain").count().collect()}  # a row per domain
    wanted = shares_of_sample(counts, most)
    parts = [usable.filter(F.col("domain") == x).orderBy("_luck", "id").limit(n).select("id", "domain") for x, n in wanted.items()]
    chosen = functools.reduce(DataFrame.union, parts, usable.select("id", "domain").limit(0))
    texts = rows.join(F.broadcast(chosen), "id").groupBy("domain", "id").agg(F.max("text").alias("text"))
    sample = texts.select("domain", "text").mapInArrow(_labelled, "domain string, buckets binary").toPandas()
    sample = sample.sort_values(["domain", "buckets"])
    model = fit(sample["domain"].tolist(), [np.frombuffer(x, np.int32) for x in sample["buckets"]])
    if not model.domains:
        return model
    drawn = sample["domain"].value_counts()
    excess = np.array([np.log(drawn[x] / len(sample)) - np.log(counts[x] / sum(counts.values())) for x in model.domains])
    return replace(model, bias=model.bias - model.temperature * excess)


def _posteriors(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned: DomainModel = model.value
        for batch in slices(batches, "text"):
            found, words = features_of(*utf8(batch.column("text")))
            shares = learned.posteriors(found)
            ends = np.arange(len(batch) + 1, dtype=np.int32) * shares.shape[1]
            yield pa.record_batch({"id": batch.column("id"), "tokens": pa.array(words.astype(np.int64)),
                                   "posteriors": pa.ListArray.from_arrays(pa.array(ends), pa.array(shares.ravel()))})
    return run


def rates_after(shares: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """Each document's rate: 1 less the steps so far, ``moved`` per domain, projected to the nonnegative."""
    return np.maximum(0.0, 1.0 - shares @ moved)


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.asarray(batch.column("posteriors").flatten()).reshape(len(batch), width)


def _sums(moved: np.ndarray, width: int):
    """Tokens, their rates squared, expected tokens per domain, and the moments of the posteriors of documents with a rate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares, expected, moments = 0.0, 0.0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            shares, tokens = _matrix(batch, width), np.asarray(batch.column("tokens"), np.float64)
            rate = rates_after(shares, moved)
            total += tokens.sum()
            squares += tokens @ (rate * rate)
            expected += (tokens * rate) @ shares
            moments += shares.T @ (shares * (tokens * (rate > 0))[:, None])
        values = np.concatenate([[total, squares], expected, moments.ravel()])
        yield pa.record_batch({"cell": pa.array(np.arange(len(values), dtype=np.int32)), "value": pa.array(values)})
    return run


def _rates(moved: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = rates_after(_matrix(batch, width), moved)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [*batch.schema.names, "rate"])
    return run


@dataclass(frozen=True)
class Fit:
    moved: np.ndarray        # a document's rate is 1 less its posteriors times this, and at least 0
    residual: np.ndarray     # expected share per domain less its target
    reached: bool            # whether all targets are met; if not, this is the least-squares fit
    passes: int


@dataclass(frozen=True)
class _Point:
    moved: np.ndarray
    squares: float
    residual: np.ndarray
    moments: np.ndarray

    def gradient(self, hold: float) -> np.ndarray:
        return hold * self.moved - self.residual

    def value(self, hold: float, targets: np.ndarray) -> float:
        return float(hold * self.moved @ self.moved + self.squares) / 2 + float(targets @ self.moved)


def solve_steps(members: DataFrame, targets: np.ndarray, tolerance: float = 1e-5, least_hold: float = 1e-9, most_passes: int = 200,
                most_squares: float | None = None) -> Fit:
    """What gives every row of ``members`` (tokens, posteriors) its nonnegative rate.

    Least squares of the expected tokens per domain, sum(rate * tokens * posterior), against ``targets`` of the total, plus
    ``hold`` times the squared distance of the rates from 1. The rates are always the projection of 1 less all steps so
    far. A step is the residual, scaled by the inverse curvature of the rows whose rate is not 0, and halved as long as it
    overshoots; without that scaling thousands of passes do not get there. ``hold`` begins at 0.01 (1 with ``most_squares``) and is divided by ten
    until every domain is within ``tolerance`` of the total, which leaves the rates as near to 1 as the targets allow, or
    until ``least_hold``: then no rates reach the targets, and these are, to about ``least_hold`` times the squares of the
    rates, the nearest. Such a fit may rest on a handful of documents; with ``most_squares`` it stops at the last ``hold``
    whose rates have at most that mean square over the tokens (the reciprocal of the share of the corpus that counts, in
    effect). Not settling within ``most_passes`` is an error.

    A pass over ``members`` sums a few numbers per task, and a row's rate follows from a number per domain, so nothing
    else is kept between passes.
    """
    width, passes = len(targets), 0

    def look(moved: np.ndarray) -> _Point | None:
        nonlocal passes
        if passes >= most_passes:
            raise ArithmeticError(f"the rates did not settle in {most_passes} passes over the documents")
        passes += 1
        cells = members.mapInArrow(_sums(moved, width), "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        found = np.array([value for _, value in sorted((r["cell"], r["value"]) for r in cells.collect())])  # 2 + domains + domains squared
        if not len(found) or found[0] <= 0:
            return None
        found /= found[0]
        return _Point(moved, found[1], found[2:2 + width] - targets, found[2 + width:].reshape(width, width))

    at, hold, kept = look(np.zeros(width)), 0.01 if most_squares is None else 1.0, None
    if at is None:  # no words, so any rates do
        return Fit(np.zeros(width), np.zeros(width), True, passes)
    while True:
        while np.abs(at.gradient(hold)).max() > tolerance / 10:
            slope = at.gradient(hold)
            step, length = -np.linalg.solve(at.moments + hold * np.eye(width), slope), 1.0
            tried = look(at.moved + step)
            while tried.value(hold, targets) > at.value(hold, targets) + 1e-4 * length * float(slope @ step) and length > 1e-6:
                length /= 2
                tried = look(at.moved + length * step)
            if length <= 1e-6:
                break  # as good as rounding allows
            at = tried
        if most_squares is not None and at.squares > most_squares and kept is not None:
            return Fit(kept.moved, kept.residual, False, passes)
        kept, reached = at, bool(np.abs(at.residual).max() <= tolerance)
        if reached or hold <= least_hold:
            return Fit(at.moved, at.residual, reached, passes)
        hold = max(least_hold, hold / 10)


def solve_rates(members: DataFrame, targets: np.ndarray, tolerance: float = 1e-5) -> DataFrame:
    """``members`` with the ``rate`` of each row."""
    fit = solve_steps(members, targets, tolerance)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in members.schema) + ", rate double"
    return members.mapInArrow(_rates(fit.moved, len(targets)), schema)


def domain_of_labels() -> Column:
    """The domains of the labels table: ``toxic``, else ``low`` quality, else ``good``; null if both marks are."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
            .when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), "good"))


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], id_column: str = "doc_id",
                 text_column: str = "text", label_column: str = "domain", most_labelled: int = 4000,
                 tolerance: float = 1e-5, label_id: str | None = None) -> DataFrame:
    """Per row ``id_column, tokens, posteriors, rate``: how often a document is to be used so that the mix has ``targets``.

    ``targets`` gives weights per domain, scaled to sum to 1; a learned domain that it does not name has weight 0, and the
    weight of a named one that no label has goes to the others in proportion. Targets that no rates reach get the rates of
    least squares. ``tokens`` counts words; ``posteriors`` is a map of domain to probability. The
    expected tokens of a domain are sum(rate * tokens * posterior), and their total stays that of the table.

    A null or empty text has 0 tokens and the prior as posteriors; its rate counts for nothing in the sums. Equal texts
    get equal rates, whatever their ids; null ids are kept. Without a usable label of a named domain every rate is 1, and
    without any label ``posteriors`` is empty. Other columns are ignored; an empty table gives an empty result.

    ``labels`` names documents by ``label_id``, a column of ``docs`` too and ``id_column`` by default.
    """
    model, members, weights = _members(docs, labels, targets, id_column, text_column, label_column, most_labelled, label_id)
    rated = members.withColumn("rate", F.lit(1.0)) if weights is None else solve_rates(members, weights, tolerance)
    names = F.array(*[F.lit(x) for x in model.domains]).cast("array<string>")
    return rated.select(F.col("id").alias(id_column), "tokens", F.map_from_arrays(names, "posteriors").alias("posteriors"), "rate")


def _members(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], id_column: str, text_column: str, label_column: str,
             most_labelled: int, label_id: str | None) -> tuple[DomainModel, DataFrame, np.ndarray | None]:
    model = learn_domains(docs, labels, label_id or id_column, text_column, label_column, most_labelled)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS x domains floats
    members = stored(rows.mapInArrow(_posteriors(shared), "id long, tokens long, posteriors array<double>"), "members")
    if not model.domains:
        return model, members, None
    weights = np.array([float(targets.get(x, 0.0)) for x in model.domains])
    return model, members, weights / weights.sum() if weights.sum() > 0 else None


def _rated_rows(model, moved: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rate = np.ones(len(batch))
            if moved is not None:
                found, _ = features_of(*utf8(batch.column("text")))
                rate = rates_after(model.value.posteriors(found), moved)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [*batch.schema.names, "rate"])
    return run


def mixed_rows(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], key: str, columns: list[str], label_id: str,
               text_column: str = "text", label_column: str = "domain", most_labelled: int = 4000, most_squares: float = 4.0) -> DataFrame:
    """``columns`` of the rows of ``docs``, each as often as its rate says: a mix with ``targets``.

    The rates are those of ``mixing_rates``, computed again where the text is, so no text is shuffled; targets out
    of reach are followed only as far as ``most_squares`` of ``solve_steps`` allows, lest a few documents make up the mix.
    ``key`` tells the rows apart; a row's fraction of a copy is decided by its hash.
    """
    model, members, weights = _members(docs, labels, targets, key, text_column, label_column, most_labelled, label_id)
    moved = None if weights is None else solve_steps(members, weights, most_squares=most_squares).moved
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = [x for x in columns if x != text_column]
    rows = docs.select(F.col(key).alias("key"), F.col(text_column).cast("string").alias("text"), *[F.col(x).alias(f"c{k}") for k, x in enumerate(carried)])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", rate double"
    rated = rows.mapInArrow(_rated_rows(shared, moved), schema).withColumn("n", copies(F.col("rate"), "key")).filter("n > 0")
    names = {"text": text_column} | {f"c{k}": x for k, x in enumerate(carried)}
    return rated.select(*[F.col(x).alias(name) for x, name in names.items()], F.explode(F.sequence(F.lit(1), "n")).alias("_copy")).select(*columns)


def copies(rate: Column, *key: Column | str) -> Column:
    """How many copies of a row make its ``rate`` in expectation: the whole part, and one more by a hash of ``key``."""
    luck = F.pmod(F.xxhash64(F.lit(17), *key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + luck).cast("int")
