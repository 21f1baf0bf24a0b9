"""Fill-in-middle: texts cut at two word boundaries and reordered, with the boundaries of shared chunks remembered.

A text is cut into chunks where a rolling hash of its last bytes has a given remainder, so equal passages are cut alike
wherever they stand. What a cut needs to know of a chunk (where words end inside it, its code points, whether it begins
and ends with a space) is kept per content: the memo's key is the chunk itself, so a remembered summary is always that of
equal bytes. Adding up the summaries of a text's chunks gives its number of units, and finds the chunk that a cut falls into.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.llm.words import slices, utf8

MARKS = ("<P>", "<S>", "<M>")  # fixed values: what stands before prefix, suffix and middle
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"  # fixed values: the bytes that part words
WINDOW = 32          # bytes under the rolling hash
CHUNK_BYTES = 512    # the mean length of a chunk is about this
MOST_CHUNK_BYTES = 8 * CHUNK_BYTES
MEMO_BYTES = 32 << 20
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_GEAR = np.random.default_rng(97).integers(0, 2**63, 256, dtype=np.uint64)


class Summary(NamedTuple):
    ends: np.ndarray     # places inside the chunk before which a word ends
    opens: bool          # the chunk begins with a space
    closes: bool         # the chunk ends within a word
    points: int          # code points that begin in the chunk


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Where the chunks of one text end. A stretch without a cut is cut every ``MOST_CHUNK_BYTES``."""
    if len(data) <= WINDOW:
        return np.array([len(data)], np.int64) if len(data) else np.zeros(0, np.int64)
    # h(p) = sum of gear(byte) * 2**age over the last 32 bytes, modulo 2**32, doubled up: 1, 2, 4, ... 32 bytes
    rolling = _GEAR[data]
    span = 1
    while span < WINDOW:
        rolling = rolling[span:] + (rolling[:-span] << np.uint64(span))
        span *= 2
    top = (rolling >> np.uint64(16)) & np.uint64(CHUNK_BYTES - 1)
    found = np.flatnonzero(top == 0) + WINDOW
    found = np.append(found[found < len(data)], len(data))
    starts = np.append(0, found[:-1])
    long = np.flatnonzero(found - starts > MOST_CHUNK_BYTES)
    if len(long):
        extra = [np.arange(starts[k] + MOST_CHUNK_BYTES, found[k], MOST_CHUNK_BYTES) for k in long]
        found = np.sort(np.concatenate([found, *extra]))
    return found


def summarise(chunk: bytes) -> Summary:
    data = np.frombuffer(chunk, np.uint8)
    space = _IS_SPACE[data]
    return Summary(np.flatnonzero(space[1:] & ~space[:-1]) + 1, bool(space[0]), not space[-1], _points(data))


def _points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


class Memo:
    """Summaries by content, at most ``most_bytes`` of chunks and places; a full memo begins anew. Results do not depend on it."""

    def __init__(self, most_bytes: int = MEMO_BYTES):
        self.known: dict[bytes, Summary] = {}
        self.most_bytes, self.held, self.hits, self.misses = most_bytes, 0, 0, 0

    def summary(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        found = summarise(chunk)
        size = len(chunk) + found.ends.nbytes
        if self.held + size > self.most_bytes:
            self.known, self.held = {}, 0
        self.known[chunk] = found
        self.held += size
        return found


class Cuts:
    """The unit boundaries of one text, from the summaries of its chunks."""

    def __init__(self, text: bytes, memo: Memo):
        self.text = text
        self.bounds = chunk_ends(np.frombuffer(text, np.uint8))
        self.starts = np.append(0, self.bounds)[:-1]
        self.parts = [memo.summary(text[a:b]) for a, b in zip(self.starts.tolist(), self.bounds.tolist(), strict=True)]
        # a word may also end where two chunks meet; the last unit ends with the text
        meets = [a.closes and b.opens for a, b in zip(self.parts, self.parts[1:])]
        counts = np.array([len(p.ends) for p in self.parts], np.int64)
        counts[:len(meets)] += np.array(meets, np.int64)
        self.totals = np.cumsum(counts)
        self.points = np.append(0, np.cumsum([p.points for p in self.parts]))
        self.units = int(self.totals[-1]) + 1 if text else 0

    def place(self, k: int) -> tuple[int, int]:
        """Where the ``k``-th unit ends: in bytes and in code points."""
        if k == 0:
            return 0, 0
        if k == self.units:
            return len(self.text), int(self.points[-1])
        part = int(np.searchsorted(self.totals, k, "left"))
        within = k - 1 - (int(self.totals[part - 1]) if part else 0)
        start, ends = int(self.starts[part]), self.parts[part].ends
        if within == len(ends):
            return int(self.bounds[part]), int(self.points[part + 1])
        at = start + int(ends[within])
        return at, int(self.points[part]) + _points(np.frombuffer(self.text, np.uint8, at - start, start))


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 of a document; a null id counts as an empty one."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(found[k:k + 4], "big") for k in (0, 4, 8, 12)]


def transform(text: bytes, numbers: list[int], memo: Memo, percent: int, spm_percent: int) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    cuts = Cuts(text, memo)
    p, s, m = (mark.encode() for mark in MARKS)
    if not text or p in text or s in text or m in text or numbers[2] % 100 >= percent:
        return cuts.units, "plain", None, None, text
    low, high = sorted(x % (cuts.units + 1) for x in numbers[:2])
    (a, a_points), (b, b_points) = cuts.place(low), cuts.place(high)
    if numbers[3] % 100 < spm_percent:
        form, output = "spm", b"".join((s, text[b:], p, text[:a], m, text[a:b]))
    else:
        form, output = "psm", b"".join((p, text[:a], s, text[b:], m, text[a:b]))
    return cuts.units, form, a_points, b_points - a_points, output


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 42, percent: int = 50,
                   spm_percent: int = 80, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep, n, form, prefix_chars, middle_chars, output`` of every row.

    A unit is a word with the spaces before it, or the spaces at the end; ``n`` counts them. ``percent`` of the rows are
    reordered, of these ``spm_percent`` with the suffix first; both, and the cuts, follow from ``seed`` and the integer
    ``doc_id`` alone, so rows with one id are cut by the same numbers. A null text counts as empty. Empty texts and texts
    that hold one of the marks stay ``plain``, with null lengths. Rows are handled one by one and none is shuffled: ties,
    repeated rows and empty tables need no rule, and other columns than ``keep`` may have any name. A text is one value of
    one row, so a task needs memory for some times its longest text (beyond that, about ``MEMO_BYTES``).
    """
    inner = docs.select(F.struct(*keep).alias("kept"), F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = T.StructType([
        inner.schema["kept"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo()
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            whole, bounds = data.tobytes(), offsets.tolist()
            made = [transform(whole[a:b], draws(seed, k), memo, percent, spm_percent)
                    for a, b, k in zip(bounds, bounds[1:], batch.column("id").to_pylist())]
            n, form, prefix, middle, output = zip(*made) if made else ((),) * 5
            outputs = pa.array(output, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), outputs], names=schema.names)

    found = inner.mapInArrow(run, schema)
    return found.select("kept.*", *[x for x in schema.names if x != "kept"])


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of, from it and its form alone."""
    p, s, m = MARKS

    def parted(first: str, second: str, third: str) -> list[Column]:
        """What follows each mark. The marks occur once, since no text that holds one is reordered."""
        rest = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, third, 1)
        return [one, two, F.substr(rest, F.length(two) + len(third) + 1)]

    prefix, suffix, middle = parted(p, s, m)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parted(s, p, m)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))
