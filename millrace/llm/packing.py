"""Documents as token pieces, packed into sequences of fixed length by bounded-space best fit."""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.words import slices, utf8
from millrace.session import stored

FULL_ENOUGH = 0.98        # of the capacity: a sequence that a task leaves with less is packed again with those of others
SEQUENCES_PER_TASK = 1024  # about how many sequences a task of the second pass makes
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class BestFit:
    """A fixed number of open bins, found by a bitset whose bit ``f`` says that a bin with ``f`` free places is open.

    An item goes to the open bin with the least sufficient space. When a new bin is needed and all are open, the fullest
    closes first. ``closed`` collects the bins that take no more.
    """

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.most, self.open, self.made, self.free = capacity, open_bins, 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.closed: list[int] = []

    def _take(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.free ^= 1 << free
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The bin of an item, counted from 0, and the item's place in it."""
        fits = self.free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            chosen = self._take(free)
        else:
            if self.open == self.most:
                self.closed.append(self._take((self.free & -self.free).bit_length() - 1))
            chosen, free = self.made, self.capacity
            self.made += 1
        if rest := free - length:
            self.bins[rest].append(chosen)
            self.free |= 1 << rest
            self.open += 1
        else:
            self.closed.append(chosen)
        return chosen, self.capacity - free


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else one above 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (chr(256 + k) for k in range(256))
    return [chr(b) if b in printable else next(others) for b in range(256)]


class WordTokens:
    """Token ids of texts, as little-endian bytes, with the ids of short stretches between white space remembered.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its stretches in order. A
    stretch of Latin letters with punctuation after them is one word and one mark to the model, and is put to it as such;
    others take the tokenizer's whole way. Texts that may hold the strings of special tokens are encoded whole.
    """

    LONGEST, MOST = 32, 250_000
    PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)")
    LETTERS = _byte_letters()

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    @classmethod
    @functools.lru_cache(maxsize=4)
    def shared(cls, path: str) -> WordTokens:
        """One per worker process, so that what a task has met serves the next."""
        return cls(path)

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            written = word if word.isascii() else "".join(self.LETTERS[b] for b in word.encode())
            found = np.array([x.id for x in self.tokenizer.model.tokenize(written)], "<u4").tobytes()
            if len(self.words) < self.MOST:
                self.words[word] = found
        return found

    def _whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def _stretch(self, stretch: bytes) -> bytes:
        if len(stretch) > self.LONGEST:
            return self._whole(stretch)
        plain = self.PLAIN.fullmatch(stretch.decode("utf-8", "replace"))
        if plain is None:
            ids = self._whole(stretch)
        else:
            ids = self._word(plain[1].lower()) + (self._word(plain[2]) if plain[2] else b"")
        if len(self.known) < self.MOST:
            self.known[stretch] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        if b"<|" in text:
            return self._whole(text)
        stretches = text.split()
        parts = list(map(self.known.get, stretches))
        if None in parts:
            parts = [self._stretch(stretches[k]) if part is None else part for k, part in enumerate(parts)]
        return b"".join(parts)


class _Sequences:
    """The pieces of open bins, until these close; a piece is a row up to ``ids_crc32``, with its ids if they are kept."""

    def __init__(self, capacity: int, open_bins: int, with_ids: bool) -> None:
        self.bins, self.held, self.with_ids = BestFit(capacity, open_bins), {}, with_ids

    def place(self, pieces: list[tuple]) -> None:
        for piece in pieces:
            chosen, offset = self.bins.place(piece[3])
            self.held.setdefault(chosen, []).append((offset, piece))

    def closed(self, base: int) -> pa.RecordBatch:
        done = self.bins.closed
        self.bins.closed = []
        return self._rows(done, base)

    def rest(self, base: int, full_enough: float) -> Iterator[pa.RecordBatch]:
        """What is left: sequences that are nearly full, and the pieces of the others without a sequence."""
        lengths = {x: sum(piece[3] for _, piece in rows) for x, rows in self.held.items()}
        yield self._rows([x for x, n in lengths.items() if n >= full_enough * self.bins.capacity], base)
        yield self._rows(list(self.held), None)

    def _rows(self, done: list[int], base: int | None) -> pa.RecordBatch:
        rows = [(piece, None if base is None else base + x, offset) for x in done for offset, piece in self.held.pop(x)]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array([piece[k] for piece, _, _ in rows], kind) for k, kind in enumerate(kinds)]
        arrays += [pa.array([x for _, x, _ in rows], pa.int64()), pa.array([offset for _, _, offset in rows], pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        if self.with_ids:
            arrays.append(pa.array([piece[5] for piece, _, _ in rows], pa.binary()))
            names.append("ids")
        return pa.record_batch(arrays, names)


def _pack(path: str, capacity: int, end_id: int, open_bins: int, lookahead: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, sequences, waiting = WordTokens.shared(path), _Sequences(capacity, open_bins, with_ids), []
        base, end = TaskContext.get().partitionId() << 40, np.array([end_id], "<u4").tobytes()

        def placed() -> pa.RecordBatch:
            waiting.sort(key=lambda piece: -piece[3])
            sequences.place(waiting)
            waiting.clear()
            return sequences.closed(base)

        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            whole, bounds = data.tobytes(), offsets.tolist()
            for row, doc in enumerate(batch.column("id").to_pylist()):
                ids = tokens.ids(whole[bounds[row]:bounds[row + 1]]) + end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + capacity)]
                    waiting.append((doc, piece, start, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                    if len(waiting) == lookahead:
                        yield placed()
        yield placed()
        yield from sequences.rest(base, FULL_ENOUGH)
    return run


def _pack_again(capacity: int, open_bins: int, with_ids: bool):
    """Pieces that come longest first into sequences, all of which are final."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = _Sequences(capacity, open_bins, with_ids)
        base = (TaskContext.get().partitionId() << 40) + (1 << 39)  # apart from the numbers of the first pass
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        for batch in batches:
            sequences.place(list(zip(*[batch.column(x).to_pylist() for x in names], strict=True)))
            yield sequences.closed(base)
        yield from sequences.rest(base, 0.0)
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
                   capacity: int = 4096, end_id: int = 1, open_bins: int = 1024, lookahead: int = 8192,
                   with_ids: bool = True) -> DataFrame:
    """A row per piece of a document: its ids (little-endian unsigned 32-bit), its sequence and its place there.

    A document is its token ids and then ``end_id``. Only documents longer than ``capacity`` are cut, into pieces of
    ``capacity`` ids; the last may be shorter. Each task packs the rows of its partition, without a shuffle of
    texts, and a repeated task makes the same sequences. Sequences that tasks leave unfinished are taken apart, and their
    pieces packed again, longest first, in as many tasks as they fill ``SEQUENCES_PER_TASK`` sequences each, so the number
    of sequences hardly depends on the number of partitions. A task holds ``lookahead`` pieces, places the longest first, and keeps at most
    ``open_bins`` unfinished sequences, so its memory does not depend on the partition. Sequences are filled without gaps
    from 0; their numbers are unique and otherwise arbitrary.

    A null or empty text is the end id alone. A null id is kept. Equal rows are packed once each. Other columns are
    ignored. An empty table gives an empty result. ``ids`` is left out unless ``with_ids``.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    run = _pack(tokenizer_path, capacity, end_id, open_bins, lookahead, with_ids)
    schema = SCHEMA + (", ids binary" if with_ids else "")
    packed = stored(rows.mapInArrow(run, schema), "packed")
    left = packed.filter("sequence_id IS NULL")
    tasks = max(1, (left.agg(F.sum("length")).first()[0] or 0) // (capacity * SEQUENCES_PER_TASK))
    order = [F.desc("length"), "doc_id", "piece", "ids_crc32", "start"]  # a repeated task sees the same order
    again = left.repartition(tasks).sortWithinPartitions(*order).mapInArrow(
        _pack_again(capacity, open_bins, with_ids), schema)
    return packed.filter("sequence_id IS NOT NULL").unionByName(again).withColumnRenamed("doc_id", id_column)
