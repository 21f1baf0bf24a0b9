"""Language of texts: averaged hashed subword embeddings with a linear softmax, and a calibrated score to reject by."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.words import _LOWER, _SPACE, slices, utf8
from millrace.session import stored

BITS = 16
GRAMS = (3, 4)          # bytes of a subword, white space at a word's ends included
SLICE_BITS = 16  # of the order of a sample; a language has at most 65,536 slices
GRAMS_PER_TEXT = 512    # of a training text, evenly spaced over the whole of it
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """``table`` holds each subword's share of every language's logit, the embedding already multiplied in."""

    languages: tuple[str, ...]
    table: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    shares = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shares / shares.sum(axis=1, keepdims=True)


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of subword the hashes of all of them in order and the row of each.

    A subword lies within a word and the white space on either side; a text's ends count as white space.
    """
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    stream = np.full(len(data) + len(lengths) + 1, 32, np.uint8)
    stream[np.arange(len(data)) + row + 1] = np.where(_SPACE[data], np.uint8(32), _LOWER[data])
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)  # of the place after the leading space
    space = stream == 32
    wide = stream.astype(np.uint64)
    for n in GRAMS:
        count = len(stream) - n + 1
        if count <= 0:
            continue
        packed, inside = wide[:count].copy(), np.ones(count, bool)
        for k in range(1, n):
            packed |= wide[k:count + k] << np.uint64(8 * k)
            if k < n - 1:
                inside &= ~space[k:count + k]
        places = np.flatnonzero(inside)
        hashes = ((packed[places] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)
        yield hashes, owner[places]


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found: list[list[np.ndarray]] = [[] for _ in range(len(batch))]
        for hashes, owner in subwords(*utf8(batch.column("text"))):
            bounds = np.searchsorted(owner, np.arange(len(batch) + 1))
            for row in range(len(batch)):
                found[row].append(hashes[bounds[row]:bounds[row + 1]])
        chosen = []
        for parts in found:
            own = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            picks = np.linspace(0, len(own) - 1, min(len(own), GRAMS_PER_TEXT)).astype(np.int64)
            chosen.append(own[picks].tobytes())
        yield pa.record_batch({"lang": batch.column("lang"), "grams": pa.array(chosen, pa.binary())})


def fit(labels: list[str], grams: list[np.ndarray], dim: int = 16, epochs: int = 8, batch: int = 16, drawn: int = 96,
        rate: float = 0.5, rejected_share: float = 0.0005, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent on nine tenths of the texts; temperature and rejection come from the tenth left out.

    Each step draws ``drawn`` subwords of each text, so short texts are met in training as well.
    """
    languages = tuple(sorted(set(labels)))
    if not languages:
        return LanguageModel((), np.zeros((1 << BITS, 0), np.float32), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    place = {x: k for k, x in enumerate(languages)}
    target = np.array([place[x] for x in labels])
    order = rng.permutation([k for k, own in enumerate(grams) if len(own)])
    aside, learned = order[:len(order) // 10], order[len(order) // 10:]
    inner = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    outer = np.zeros((dim, len(languages)), np.float32)

    def draw(rows: np.ndarray, n: int) -> np.ndarray:
        return np.stack([grams[k][rng.integers(0, len(grams[k]), n)] for k in rows])

    steps, step = max(1, epochs * -(-len(learned) // batch)), 0
    for _ in range(epochs):
        rng.shuffle(learned)
        for first in range(0, len(learned), batch):
            rows, now = learned[first:first + batch], rate * (1 - step / steps)
            idx = draw(rows, drawn)
            hidden = inner[idx].mean(axis=1)
            wrong = softmax(hidden @ outer)
            wrong[np.arange(len(rows)), target[rows]] -= 1
            back = (wrong @ outer.T) * now
            outer -= now * (hidden.T @ wrong)
            np.subtract.at(inner, idx.ravel(), np.repeat(back / drawn, drawn, axis=0).astype(np.float32))
            step += 1
    table = inner @ outer
    if not len(aside):
        return LanguageModel(languages, table, 1.0, 0.0)
    logits = np.concatenate([np.stack([table[grams[k]].mean(axis=0) for k in aside]), table[draw(aside, 24)].mean(axis=1)])
    truth = np.concatenate([target[aside]] * 2)
    temperature = min(np.geomspace(0.02, 20, 60), key=lambda t: -np.log(
        softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean())
    best = softmax(logits / temperature).max(axis=1)
    return LanguageModel(languages, table, float(temperature), float(min(0.6, np.quantile(best, rejected_share))))


def learn_languages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang",
                    per_language: int = 1500, most: int = 8000, longest: int = 20_000) -> LanguageModel:
    """A model learned from a bounded sample of labelled rows.

    At most ``per_language`` rows of a language and ``most`` in all, chosen by a hash of the id among those whose text has
    1 to ``longest`` characters. Only hashed subwords of the chosen rows reach the driver, ``GRAMS_PER_TEXT`` of each.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(label_column).alias("lang"))
    rows = rows.filter("id IS NOT NULL AND lang IS NOT NULL AND length(text) BETWEEN 1 AND %d" % longest)
    luck = F.xxhash64(F.lit(11), "id")
    known = stored(rows.select("id", "lang", luck.alias("luck")).withColumn("slice", F.shiftright("luck", 64 - SLICE_BITS)), "labelled")
    # slices of the order with their counts say where a language has enough, so that few more rows than wanted are ranked
    counts = known.groupBy("lang", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("slice")) - F.col("n")
    ends = counts.withColumn("before", before).filter(F.col("before") < per_language).groupBy("lang").agg(F.max("slice").alias("end"))
    ranked = known.join(ends, "lang").filter(F.col("slice") <= F.col("end")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy("luck", "id")))
    chosen = ranked.filter(F.col("rank") <= per_language).orderBy("rank", "luck", "id").limit(most).select("id")
    texts = rows.join(F.broadcast(chosen.distinct()), "id", "left_semi").groupBy("id").agg(
        F.max(F.struct("lang", "text")).alias("row")).select("row.lang", "row.text")
    sample = texts.mapInArrow(_training_rows, "lang string, grams binary").toPandas().sort_values(["lang", "grams"])
    return fit(sample["lang"].tolist(), [np.frombuffer(x, np.int32) for x in sample["grams"]])


def _predict(model, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned: LanguageModel = model.value
        width = len(learned.languages)
        names = np.array([*learned.languages, UNKNOWN], object)
        table = np.ascontiguousarray(learned.table)
        for batch in slices(batches, "text", 1 << 20):
            data, offsets = utf8(batch.column("text"))
            sums, counts = np.zeros((len(batch), width), np.float64), np.zeros(len(batch))
            for hashes, owner in subwords(data, offsets):
                bounds = np.searchsorted(owner, np.arange(len(batch) + 1))
                counts += np.diff(bounds)
                filled = np.flatnonzero(np.diff(bounds))
                if width and len(filled):
                    sums[filled] += np.add.reduceat(table[hashes], bounds[filled], axis=0, dtype=np.float64)
            plain = np.concatenate([[0], np.cumsum((_LOWER[data] >= 97) & (_LOWER[data] <= 122))])
            lettered = plain[offsets[1:]] > plain[offsets[:-1]]
            for row in np.flatnonzero(~lettered & (np.diff(offsets) > 0)):
                text = data[offsets[row]:offsets[row + 1]].tobytes().decode("utf-8", "replace")
                lettered[row] = any(map(str.isalpha, text))
            best, score = np.full(len(batch), width), np.zeros(len(batch))
            if width:
                shares = learned.probabilities(sums / np.maximum(counts, 1)[:, None])
                best, score = np.where(lettered, shares.argmax(axis=1), width), np.where(lettered, shares.max(axis=1), 0.0)
            out = {"lang_pred": pa.array(names[best].tolist(), pa.string()), "score": pa.array(score),
                   "rejected": pa.array(~lettered | (score < learned.reject_below))}
            kept = [name for name in batch.schema.names if name != "text" or with_text]
            yield pa.RecordBatch.from_pydict({**{name: batch.column(name) for name in kept}, **out})
    return run


def identify_languages(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_column, lang_pred, score, rejected`` per row, from the whole text and nothing else.

    ``lang_pred`` is a language of the model, or ``und`` with score 0 for a null text and one without letters.
    ``rejected`` marks those and texts whose calibrated score is below the model's bound. Null ids and repeated rows are
    kept, each with its own row. ``keep`` names columns to carry along, the text among them; others are ignored. An empty
    table gives an empty result. A model that has learned no language answers ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS x languages floats
    carried = [name for name in keep if name not in (id_column, text_column)]
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"),
                       *[F.col(name).alias(f"c{k}") for k, name in enumerate(carried)])
    types = {f.name: f.dataType.simpleString() for f in rows.schema if f.name != "text" or text_column in keep}
    schema = ", ".join(f"{name} {kind}" for name, kind in types.items())
    found = rows.mapInArrow(_predict(shared, text_column in keep), f"{schema}, lang_pred string, score double, rejected boolean")
    names = {"id": id_column, "text": text_column} | {f"c{k}": name for k, name in enumerate(carried)}
    return found.select(*[F.col(name).alias(names[name]) for name in types], "lang_pred", "score", "rejected")
