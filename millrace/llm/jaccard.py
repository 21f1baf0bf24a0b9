"""Jaccard self-join of documents on word shingles: a size-aware heavy-light join.

Small sets enumerate fixed-size subsets (pairs) of the shingles at the rare end of their order and meet in those; large
sets scan the inverted lists of single shingles at that end. The size that divides them is the cheaper one by a count of
both kinds of work over all documents. Every pair that meets this way is a candidate, and whether it is linked is
always decided on the two whole sets.

Only components are wanted, so pairs inside a component that is already known are never made. Rounds pair the members
of a list with one random member of it, and the last round compares what is still apart, all of it. Lists with the same
members are searched once. A pair is left out if the parity bits of its two sets differ in more places than the sets of
a link can: each shingle that only one set holds changes at most one bit, so no link is lost. Few bits travel with the
lists; a pair is looked at once more with bits in proportion to its sets before the sets themselves are brought together.

Sets that share many lists would meet in each of them. A list leaves out a pair that meets in one of the few lists before
it, which each of its members knows; the first list of a pair never does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.components import connected_components
from millrace.llm.match import rows_perhaps_among, rows_without
from millrace.llm.words import mix, shingle_sets, slices, utf8
from millrace.session import stored

SKETCH = 1 << 18        # counters of shingles that repeat, for the order only; any order gives the same links
COUNTED_AT_ONCE = 1 << 20
SUBSET = 2
EASY = 8                # complete comparisons per list entry that are not worth a round of trials
STILL_EASY = 64         # the same after the first round, which has joined most of what is linked
HOT = 13                # level, 1 + log2 of a sketch counter, from which a shingle's entries are salted
SALTS = 64
PARITY_BITS = 512       # of each set; those of a link differ in at most as many places as its sets do
LISTS_BEFORE = 4        # of an entry's own lists, in the order of their keys, that it knows of
BITS_PER_SHINGLE = 4    # least, of the parity bits that a pair is looked at with before its whole sets
SET_BYTES = 6           # of each hash in the sets that pairs are decided on


def _overlap(num: int, s, t):
    """Least intersection of linked sets of sizes ``s`` and ``t``, in hundredths ``num`` of the union."""
    return -(-num * (s + t) // (100 + num))


def _signatures(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, waiting, size = np.zeros(SKETCH, np.int64), [], 0

        def count() -> None:
            if waiting:
                found, times = np.unique(np.concatenate(waiting), return_counts=True)
                repeated = times > 1
                np.add.at(sketch, (found[repeated] & np.uint64(SKETCH - 1)).astype(np.int64), times[repeated])
                waiting.clear()

        for batch in slices(batches, "text"):
            sets = shingle_sets(*utf8(batch.column("text")), n_words)
            for found in sets:
                waiting.append(found)
                size += len(found)
            if size > COUNTED_AT_ONCE:
                count()
                size = 0
            lengths = np.array([len(x) for x in sets], np.int32)
            signs = pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary())
            bits = pa.array([parities(x) for x in sets], pa.list_(pa.int64()))
            yield pa.record_batch({"id": batch.column("id"), "n": pa.array(lengths), "sign": signs, "bits": bits,
                                   "bucket": pa.nulls(len(sets), pa.int32()), "times": pa.nulls(len(sets), pa.int64())})
        count()
        used = np.flatnonzero(sketch)
        yield pa.record_batch({"id": pa.nulls(len(used), pa.int64()), "n": pa.nulls(len(used), pa.int32()),
                               "sign": pa.nulls(len(used), pa.binary()), "bits": pa.nulls(len(used), pa.list_(pa.int64())), "bucket": pa.array(used.astype(np.int32)),
                               "times": pa.array(sketch[used])})
    return run


def _keys(n_words: int, num: int, boundary: int, levels):
    """Per document its keys at the rare end: single shingles in order, or pairs with those of a lister first.

    The lowest bit of a key says that it is frequent.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in slices(batches, "text"):
            ids = batch.column("id").to_pylist()
            rows: list[tuple] = []
            for row, found in enumerate(shingle_sets(*utf8(batch.column("text")), n_words)):
                n = len(found)
                if not n or ids[row] is None:
                    continue
                rank = level[(found & np.uint64(SKETCH - 1)).astype(np.int64)]
                order = np.argsort(rank, kind="stable")
                ordered, ranked = found[order], rank[order]
                probe = n - -(-num * n // 100) + 1
                if n < boundary:
                    most = min(n, probe + 1)
                    later, earlier = np.tril_indices(most, -1)
                    hot = (ranked[earlier] >= HOT).astype(np.uint64)
                    pairs = mix(ordered[earlier] * np.uint64(0xA0761D6478BD642F) + ordered[later] * np.uint64(0xE7037ED1A0B428DB))
                    rows.append((ids[row], n, True, pairs & ~np.uint64(1) | hot))
                if n >= boundary * num // 100:
                    hot = (ranked[:probe] >= HOT).astype(np.uint64)
                    rows.append((ids[row], n, False, ordered[:probe] & ~np.uint64(1) | hot))
            if rows:
                ends = np.cumsum([0, *(len(r[3]) for r in rows)]).astype(np.int32)
                flat = pa.array(np.concatenate([r[3] for r in rows]).view(np.int64))
                yield pa.record_batch({
                    "id": pa.array([r[0] for r in rows], pa.int64()), "n": pa.array([r[1] for r in rows], pa.int32()),
                    "small": pa.array([r[2] for r in rows]), "keys": pa.ListArray.from_arrays(pa.array(ends), flat)})
    return run


def _whole_sets(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(*utf8(batch.column("text")), n_words)
            yield pa.record_batch({"id": batch.column("id"), "shingles": pa.array([packed(x) for x in sets], pa.binary())})
    return run


def parities(found: np.ndarray) -> np.ndarray:
    """For each of ``PARITY_BITS`` classes of hashes whether the set holds an odd number of them, in 64-bit words."""
    held = np.bincount((found >> np.uint64(64 - PARITY_BITS.bit_length() + 1)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits(held.astype(np.uint8) & 1).view(np.int64)


def sketch(found: np.ndarray) -> bytes:
    """Parities by the upper bits of the hashes, with ``BITS_PER_SHINGLE`` or up to twice as many for each shingle, 2^18 at most."""
    wide = min(18, max(9, (BITS_PER_SHINGLE * len(found) - 1).bit_length()))
    held = np.bincount((found >> np.uint64(64 - wide)).astype(np.int64), minlength=1 << wide)
    return np.packbits(held.astype(np.uint8) & 1).tobytes()


def places_apart(x: bytes, y: bytes) -> int:
    """In how many places two sketches differ; the longer one is folded to the length of the other."""
    left, right = (np.unpackbits(np.frombuffer(data, np.uint8)) for data in (x, y))
    n = min(len(left), len(right))
    left, right = (np.bitwise_xor.reduce(bits.reshape(n, -1), axis=1) for bits in (left, right))
    return int(np.count_nonzero(left != right))


def _sketches(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(*utf8(batch.column("text")), n_words)
            yield pa.record_batch({"id": batch.column("id"), "size": pa.array([len(x) for x in sets], pa.int32()),
                                   "sketch": pa.array([sketch(x) for x in sets], pa.binary())})
    return run


def _perhaps_linked(num: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = (np.asarray(batch.column("size_a"), np.int64) + np.asarray(batch.column("size_b"), np.int64)) * (100 - num)
            differ = np.array([places_apart(x.as_py(), y.as_py()) for x, y in zip(batch.column("of_a"), batch.column("of_b"), strict=True)], np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(differ * (100 + num) <= most))
    return run


def packed(found: np.ndarray) -> bytes:
    """The upper ``SET_BYTES`` bytes of each hash; two of one pair of sets are equal by chance once in about 10**9 pairs."""
    return found.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()


def unpacked(data: pa.Scalar) -> np.ndarray:
    held = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, SET_BYTES)
    wide = np.zeros((len(held), 8), np.uint8)
    wide[:, :SET_BYTES] = held
    return wide.view(">u8").ravel().astype(np.uint64)


def _linked(num: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for row, (x, y) in enumerate(zip(batch.column("of_a"), batch.column("of_b"), strict=True)):
                left, right = unpacked(x), unpacked(y)
                common = len(np.intersect1d(left, right, assume_unique=True))
                keep[row] = 100 * common >= num * (len(left) + len(right) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def choose_boundary(sizes: dict[int, int], num: int, mates: float) -> int:
    """The size from which sets scan lists, at the least cost summed over all sets.

    A small set costs its subsets. A large one costs its listed shingles, each with the ``mates`` found in the list.
    Sets just below the boundary pay both, because they must meet the large ones.
    """
    def subsets(n: int) -> float:
        return math.comb(min(n, n - -(-num * n // 100) + SUBSET), SUBSET)

    def scans(n: int) -> float:
        return (n - -(-num * n // 100) + 1) * (1 + mates)

    best, least = 0, math.inf
    for boundary in sorted({1, *(n + 1 for n in sizes), *(-(-(n + 1) * 100 // num) for n in sizes)}):
        small = sum(count * subsets(n) for n, count in sizes.items() if 0 < n < boundary)
        if small > least:  # it only grows with the boundary
            break
        cost = small + sum(count * scans(n) for n, count in sizes.items() if n >= max(1, boundary * num // 100))
        if cost < least:
            best, least = boundary, cost
    return best


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n_words: int = 5,
                       num: int = 80, rounds: int = 3, partners: int = 6) -> DataFrame:
    """Per row ``id_column, n_shingles, component_id`` under the links 100 * intersection >= ``num`` * union.

    ``component_id`` is the smallest id reachable by links, the row's own id included. A null or empty text has an empty
    set, links with nothing and is its own component; a text of fewer than ``n_words`` words is one shingle. Rows are
    kept as they come: equal rows give equal results, an id that has several texts links what they link with, and a row
    without id has a null component unless a row with the same words has an id. Other columns are ignored. An empty
    table gives an empty result.

    ``rounds`` and ``partners`` say how many pairs are tried before the last, complete round; they change only the work.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    first = stored(texts.mapInArrow(_signatures(n_words), "id long, n int, sign binary, bits array<long>, bucket int, times long"), "signatures")
    rows = first.filter("bucket IS NULL").select("id", "n", "sign")
    classes = stored(rows.filter("n > 0").groupBy("sign").agg(F.min("id").alias("rep"), F.max("n").alias("n")), "classes")

    counts = first.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("times").alias("times")).toPandas()  # SKETCH rows at most
    level, mates = np.zeros(SKETCH, np.uint8), 0.0
    if len(counts):
        level[counts["bucket"]] = 1 + np.log2(counts["times"].to_numpy(np.float64)).astype(np.uint8)
    sizes = {r["n"]: r["c"] for r in classes.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}  # one row per set size
    total = sum(n * c for n, c in sizes.items())
    if total:
        mates = float((counts["times"].to_numpy(np.float64).clip(max=1e4)).sum()) / total
    boundary = choose_boundary(sizes, num, mates)

    told = stored(rows.join(classes.select("sign", "rep"), "sign").select("id", "rep"), "told")
    # an id with several texts joins their classes, and stays in the search if one of them is its own
    classes_of = told.filter("id IS NOT NULL AND rep IS NOT NULL").groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"))
    several = stored(classes_of.filter("a < z"), "several")
    shared_ids = stored(told.join(several, "id").filter("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "shared-ids")
    own = told.filter("id = rep").join(several, "id", "left_semi").select("id")
    again = stored(told.filter("id <> rep").select("id").join(own, "id", "left_anti"), "copies")
    levels = spark.sparkContext.broadcast(level)  # SKETCH bytes
    keyed = rows_without(texts, again, "id").mapInArrow(_keys(n_words, num, boundary, levels), "id long, n int, small boolean, keys array<long>")
    n, position = F.col("n"), F.col("pos")
    listed = n - F.ceil(n * (2 * num) / (100 + num) - 1e-9).cast("int") + 1  # the part that meets larger sets
    entries = keyed.select("id", "n", "small", F.posexplode("keys").alias("pos", "key")).select(
        "key", "id", "n", F.when(F.col("small"), n).otherwise(n - position).alias("rest"),
        F.when(F.col("small"), position < listed * (listed + 1) / 2).otherwise(position < listed).alias("lists"))
    frequent = F.col("key").bitwiseAND(1) == 1
    entries = entries.withColumn("salt", F.when(frequent, F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("key", "salt"))  # frequent keys stay in any case, so salts may part them
    lists = stored(entries.withColumn("c", shared).filter((F.col("c") > 1) | frequent).drop("c", "salt"), "lists")
    members = F.sum(F.xxhash64("id", "n").cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64("n", "id")).alias("parity")
    span = lists.groupBy("key").agg(F.max("lists").alias("any"), F.min("n").alias("least"), F.max("rest").alias("most"),
                                    F.min("id").alias("lo"), F.max("id").alias("hi"), *members).filter("any AND lo < hi")
    possible = F.least("rest", "most") * (100 + num) >= num * (n + F.greatest(F.col("least"), F.ceil(n * num / 100 - 1e-9)))
    # lists with the same members become one; where a list lacks some of them, it searches more than it must
    lists = lists.join(span, "key").filter(possible).groupBy(F.xxhash64("total", "parity").alias("key"), "id", "n").agg(
        F.max("rest").alias("rest"), F.max("lists").alias("lists"))
    bits = first.filter("id IS NOT NULL AND n > 0").select("id", "n", "bits").distinct()   # an id with several texts meets with the bits of each
    earlier = F.collect_list(F.struct("key", "rest", "lists")).over(Window.partitionBy("id", "n").orderBy("key").rowsBetween(-LISTS_BEFORE, -1))
    lists = stored(lists.withColumn("earlier", earlier).join(bits, ["id", "n"]), "lists")

    def texts_of(pairs: DataFrame) -> DataFrame:
        ids = stored(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "candidates")
        return rows_perhaps_among(texts, ids, "id")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")
        seen = stored(texts_of(pairs).mapInArrow(_sketches(n_words), "id long, size int, sketch binary"), "sketches")
        left, right = (seen.select(F.col("id").alias(x), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"of_{x}")) for x in ("a", "b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "size_a", "size_b", "of_a", "of_b")
        pairs = stored(both.mapInArrow(_perhaps_linked(num), "a long, b long").distinct(), "perhaps")
        sets = stored(texts_of(pairs).mapInArrow(_whole_sets(n_words), "id long, shingles binary"), "sets")
        left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
        right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")
        return stored(both.mapInArrow(_linked(num), "a long, b long"), "links")

    def meets(rest, in_lists, h_n, h_rest, h_lists):
        return (F.least(rest, h_rest) * (100 + num) >= num * (n + h_n)) & (in_lists & (n <= h_n) | h_lists & (h_n <= n))

    def fits(h_n, h_rest, h_lists, h_bits):
        differ = sum((F.bit_count(F.col("bits")[k].bitwiseXOR(h_bits[k])) for k in range(PARITY_BITS // 64)), F.lit(0))
        return (meets(F.col("rest"), F.col("lists"), h_n, h_rest, h_lists) & (100 * F.least("n", h_n) >= num * F.greatest("n", h_n))
                & (differ * (100 + num) <= (n + h_n) * (100 - num)))

    def met_before():
        """Whether a pair also meets in a list before this one; what else decides about a pair is the same in all lists."""
        return F.exists("earlier", lambda x: F.exists("h_earlier", lambda y: (x["key"] == y["key"]) & meets(
            x["rest"], x["lists"], F.col("h_n"), y["rest"], y["lists"])))

    components, links, placed = None, None if shared_ids.isEmpty() else shared_ids, lists.withColumn("component", F.col("id"))
    for turn in range(rounds + 1):
        if components is not None:
            placed = lists.join(components, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id")).drop("node")
        sized = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
        apart = stored(sized.groupBy("key").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("kinds"),
                                                F.max_by("component", F.struct("c", "component")).alias("largest"), F.max("c").alias("most"))
                       .filter("kinds > 1"), "apart")
        work = apart.agg(F.sum(F.col("c").cast("double")), F.sum((F.col("c") - F.col("most")) * F.col("c").cast("double"))).first()
        if work[0] is None:
            break
        last = turn == rounds or work[1] <= (STILL_EASY if turn else EASY) * work[0]
        placed = placed.join(apart.select("key", "largest"), "key")
        if last:  # all that are apart: members outside a list's largest component against the whole list
            placed = stored(placed, "placed")
            hub = placed.filter("component <> largest").select("key", *[F.col(x).alias(f"h_{x}") for x in ("id", "n", "rest", "lists", "bits", "component", "earlier")])
            once = (F.col("component") == F.col("largest")) | (F.col("id") < F.col("h_id"))   # of two hubs, the pair and not its mirror image
            met = placed.join(hub, "key").filter((F.col("component") != F.col("h_component")) & once & fits(
                *[F.col(f"h_{x}") for x in ("n", "rest", "lists", "bits")]) & ~met_before())
            pairs = met.select(F.least("id", "h_id").alias("a"), F.greatest("id", "h_id").alias("b")).distinct()
        else:  # every member with a few members of its lists, the same for lists with the same members
            placed = stored(placed.drop("earlier"), "placed")
            tries = min(partners, 2 ** turn)   # most of a group is linked to its first one, and then left out
            luck = [F.xxhash64("id", F.lit(turn * partners + k)) for k in range(tries)]
            hubs = placed.groupBy("key").agg(*[F.min(F.struct(x.alias("luck"), "id", "n", "rest", "lists", "bits", "component")).alias(f"h{k}") for k, x in enumerate(luck)])
            tried = []
            for k in range(tries):
                h = F.col(f"h{k}")
                good = (F.col("component") != h["component"]) & fits(h["n"], h["rest"], h["lists"], h["bits"])
                tried.append(F.min(F.when(good, F.struct(h["luck"].alias("luck"), h["id"].alias("id")))).alias(f"t{k}"))
            chosen = placed.join(hubs, "key").groupBy("id").agg(*tried)
            pairs = chosen.select("id", F.explode(F.array(*[F.col(f"t{k}.id") for k in range(tries)])).alias("h")).filter("h IS NOT NULL").select(
                F.least("id", "h").alias("a"), F.greatest("id", "h").alias("b")).distinct()
        found = verified(pairs)
        links = found if links is None else links.union(found)
        components = stored(connected_components(links), "components")
        if last:
            break
    if components is None and links is not None:
        components = stored(connected_components(links), "components")
    if components is None:
        components = lists.filter("false").select(F.col("id").alias("node"), F.col("id").alias("component"))
    named = classes.join(components, classes.rep == components.node, "left").select(
        "sign", F.coalesce("component", "rep").alias("component"))
    return rows.join(named, "sign", "left").select(
        F.col("id").alias(id_column), F.col("n").cast("int").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))
