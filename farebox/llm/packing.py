"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands."""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.session import bound_batches
from farebox.sources.scratch import cut_lineage, scratch_path

CAPACITY = 2048
SEPARATOR = 0
SPECIAL = {"<|endoftext|>": 50256}  # fixed value of the vocabulary
SHARD = 4096  # pieces that are packed together, on average
ISLANDS, EPOCHS = 2, 2
POPULATION, GROWN = 3, 12  # packings on an island at first, and where the least of them misses the bound
EFFORT = 1 << 17  # documents that the children of an epoch place, where the bound is not met before
SPARE = 500  # one sequence in so many may be too much in a shard: its emptiest are packed again with others'
FULL = 0.985  # emptier sequences of a round are packed again with those of other shards
MOST_TASKS = 1 << 14
SHRINK = 0.75  # a further round follows while it has to deal with at most this share of the last one's pieces


@lru_cache(maxsize=2)
def _encoding(vocabulary: str):
    """The byte-level BPE of ``vocabulary`` (a file of public_tokenizers), with its special token.

    The rank file of the same vocabulary gives the ids that the tokenizers library gives, four
    times as fast; tests compare the two. As there, the special token's string in a text is one id.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(vocabulary: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoding.encode_to_numpy(text.as_py() or "", allowed_special="all")
                ids = np.append(ids, SEPARATOR).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


class Packing:
    """Items in bins. Open bins are found by their free space through a bit mask."""

    def __init__(self, lengths: list[int], capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.free: list[int] = []
        self.by_space: dict[int, list[int]] = {}
        self.mask = 0

    def add_bin(self, items: list[int]) -> None:
        self.bins.append(items)
        self.free.append(self.capacity - sum(self.lengths[i] for i in items))
        self._open(len(self.bins) - 1)

    def _open(self, at: int) -> None:
        space = self.free[at]
        if space:
            self.by_space.setdefault(space, []).append(at)
            self.mask |= 1 << space

    def best_fit(self, items: list[int]) -> None:
        """Put each item where least space is left over; a new bin if it fits nowhere."""
        for item in items:
            length = self.lengths[item]
            fitting = self.mask >> length
            if fitting:
                space = length + (fitting & -fitting).bit_length() - 1
                stack = self.by_space[space]
                at = stack.pop()
                if not stack:
                    self.mask &= ~(1 << space)
                self.bins[at].append(item)
                self.free[at] = space - length
                self._open(at)
            else:
                self.add_bin([item])

    def replace(self, displaced: list[int], rng: random.Random) -> list[int]:
        """Swap one or two items of a bin for one or two larger displaced ones, where that fills the bin
        best; what is displaced in the end is smaller and finds a place more easily."""
        held = sorted(displaced, key=self.lengths.__getitem__)
        sizes = [self.lengths[i] for i in held]
        for at in rng.sample(range(len(self.bins)), len(self.bins)):
            space = self.free[at]
            if not space or not held:
                continue
            gain, out, into = 0, (), ()
            items = self.bins[at]
            for leaving in chain(((i,) for i in items), combinations(items[:PAIRED], 2)):
                room = sum(self.lengths[i] for i in leaving)
                for entering in _fitting(sizes, room + space):
                    more = sum(sizes[k] for k in entering) - room
                    if more > gain:
                        gain, out, into = more, leaving, entering
                if gain == space:
                    break
            if gain:
                entering = [held[k] for k in into]
                self.bins[at] = [i for i in items if i not in out] + entering
                self._close(at)
                self.free[at] -= gain
                self._open(at)
                held = sorted([i for k, i in enumerate(held) if k not in into] + list(out), key=self.lengths.__getitem__)
                sizes = [self.lengths[i] for i in held]
        return held

    def _close(self, at: int) -> None:
        space = self.free[at]
        if space:
            stack = self.by_space[space]
            stack.remove(at)
            if not stack:
                self.mask &= ~(1 << space)

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then uneven filling, which leaves room to save a bin."""
        return -len(self.bins), sum((1 - f / self.capacity) ** 2 for f in self.free)


PAIRED = 8  # items of a bin that are tried in pairs


def _fitting(sizes: list[int], room: int) -> list[tuple[int, ...]]:
    """The largest of the ascending ``sizes`` that fits into ``room``, and the two that fill it best."""
    one = bisect_right(sizes, room) - 1
    found: list[tuple[int, ...]] = [(one,)] if one >= 0 else []
    low, high, best, pair = 0, one, 0, ()
    while low < high:
        total = sizes[low] + sizes[high]
        if total <= room:
            if total > best:
                best, pair = total, (low, high)
            low += 1
        else:
            high -= 1
    return [*found, pair] if pair else found


def _descending(items, lengths, rng: random.Random, noise: float = 0.0) -> list[int]:
    """By length; ``noise`` blurs the order."""
    return sorted(items, key=lambda i: -lengths[i] * (1 + noise * rng.random()))


def crossover(a: Packing, b: Packing, rng: random.Random) -> Packing:
    """Whole well-filled bins of ``b`` enter ``a``; bins of ``a`` that hold one of their documents are
    dissolved, as are the emptiest few, and what they leave without a place is best-fitted."""
    ranked = sorted(range(len(b.bins)), key=b.free.__getitem__)
    well = ranked[: max(1, len(ranked) // 2)]
    injected = [b.bins[i] for i in rng.sample(well, max(1, len(well) // 2))]
    taken = {item for items in injected for item in items}
    child, displaced = Packing(a.lengths, a.capacity), []
    dissolve = max(1, len(a.bins) // 50)
    emptiest = set(sorted(range(len(a.bins)), key=a.free.__getitem__)[-dissolve:])
    for at, items in enumerate(a.bins):
        if at in emptiest or not taken.isdisjoint(items):
            displaced += [i for i in items if i not in taken]
        else:
            child.add_bin(list(items))
    displaced = child.replace(displaced, rng)  # in bins of ``a``; those of ``b`` stay whole
    for items in injected:
        child.add_bin(list(items))
    child.best_fit(_descending(displaced, a.lengths, rng, rng.choice((0.0, 0.05))))
    return child


def _from_bins(numbers: list[int], lengths: list[int], capacity: int) -> Packing:
    bins: dict[int, list[int]] = {}
    for item, number in enumerate(numbers):
        bins.setdefault(number, []).append(item)
    packing = Packing(lengths, capacity)
    for items in bins.values():
        packing.add_bin(items)
    return packing


def evolve(lengths: list[int], elites: list[list[int]], seed: int, capacity: int) -> tuple[list[int], tuple]:
    """One epoch of an island: the bin number of each item in its fittest packing, and the fitness."""
    rng = random.Random(seed)
    population = [_from_bins(e, lengths, capacity) for e in elites]
    bound = -(-sum(lengths) // capacity)

    def fill_up(size: int) -> None:
        while len(population) < size:
            fresh = Packing(lengths, capacity)
            fresh.best_fit(_descending(range(len(lengths)), lengths, rng, (0.0, 0.02, 0.1, 0.3)[len(population) % 4]))
            population.append(fresh)

    fill_up(POPULATION)
    fewest, spent = min(len(p.bins) for p in population), 0
    while fewest > bound + bound // SPARE and spent < EFFORT:
        fill_up(GROWN)
        population.sort(key=Packing.fitness, reverse=True)
        children = []
        for _ in range(GROWN // 3):
            a, b = sorted(rng.sample(range(len(population)), 2))
            children += [crossover(population[a], population[b], rng), crossover(population[b], population[a], rng)]
        # children take the place of the least fit, and packings of one fitness stand for each other
        kinds = {p.fitness(): p for p in [*children, *population]}
        population = [kinds[f] for f in sorted(kinds, reverse=True)][:GROWN]
        fewest, spent = len(population[0].bins), spent + len(children) * len(lengths)
    best = max(population, key=Packing.fitness)
    numbers = [0] * len(lengths)
    for number, items in enumerate(best.bins):
        for item in items:
            numbers[item] = number
    return numbers, best.fitness()


ISLAND = "shard long, island int, lengths array<int>, bins array<int>, fewer int, uneven double"


def _epoch(number: int, capacity: int):
    """Rows (shard, island, lengths, elites): one epoch on each island."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, island, lengths, elites in zip(*(c.to_pylist() for c in batch.columns)):
                seed = hash((shard, island, number))
                bins, (fewer, uneven) = evolve(lengths, [e for e in elites if e is not None], seed, capacity)
                row = [[shard], [island], [lengths], [bins], [fewer], [uneven]]
                kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(row, kinds)],
                    ["shard", "island", "lengths", "bins", "fewer", "uneven"],
                )

    return run


def _pack_shards(pieces: DataFrame, count: int, capacity: int) -> tuple[DataFrame, int]:
    """(pieces with shard, bin, offset and fill, shards). ``pieces`` has ``count`` rows."""
    shards = max(1, -(-count // SHARD))
    # the row number keeps rows that repeat a document out of one shard; the rows are read from files
    shard = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(shards))
    item = F.struct(F.col("length").cast("int").alias("length"), "doc_id", "piece", "start", "ids_crc32")
    grouped = cut_lineage(pieces.groupBy(shard.alias("shard")).agg(F.sort_array(F.collect_list(item)).alias("items")))
    lengths = F.transform("items", lambda i: i["length"])
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    start = grouped.select("shard", lengths.alias("lengths"), islands)
    start = start.withColumn("elites", F.array().cast("array<array<int>>")).select("shard", "island", "lengths", "elites")
    state = start
    for number in range(EPOCHS):
        # a number of its own, as rows of few bytes and much work would be put into one task
        spread = state.repartition(min(shards * ISLANDS, MOST_TASKS), "shard", "island")
        state = cut_lineage(spread.mapInArrow(_epoch(number, capacity), ISLAND))
        if number + 1 < EPOCHS:  # the elite of each island also goes to the next one of its ring
            ring = state.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("bins").alias("guest"))
            state = state.join(ring, ["shard", "island"]).select(
                "shard", "island", "lengths", F.array("bins", "guest").alias("elites")
            )
    best = state.groupBy("shard").agg(F.max_by("bins", F.struct("fewer", "uneven", -F.col("island"))).alias("bins"))
    placed = grouped.join(best, "shard").select("shard", "items", "bins").mapInArrow(_placed, PLACED)
    return cut_lineage(placed), shards


PLACED = PIECE + ", shard long, bin long, offset long, fill long"


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "shard", "bin", "offset", "fill"]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 7]
    for batch in batches:
        for shard, items, bins in zip(*(c.to_pylist() for c in batch.columns)):
            fill: dict[int, int] = {}
            rows = []
            for i, number in zip(items, bins):
                at = fill.get(number, 0)
                fill[number] = at + i["length"]
                rows.append([i["doc_id"], i["piece"], i["start"], i["length"], i["ids_crc32"], shard, number, at])
            rows = [(*r, fill[r[6]]) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and one separator id (null and empty texts: only that); one longer
    than ``capacity`` is cut into pieces of ``capacity`` ids, of which the first may be shorter.
    Pieces of full length are sequences of their own. The others are dealt by hash to shards of
    about ``SHARD`` pieces. Each shard evolves on ``ISLANDS`` islands, tasks of their own, which
    start from blurred best-fit-decreasing packings; a crossover injects whole well-filled bins of
    one parent, removes the bins that hold a document twice, lets displaced documents replace smaller
    ones and best-fits the rest. An island is done with the least possible number of sequences, or one in
    ``SPARE`` more; others
    grow their population and go on for ``EFFORT`` placements. After an epoch each island's elite
    migrates to the next. Sequences that stay emptier than ``FULL`` are opened and
    packed again together with those of other shards, as long as that makes them ever fewer.

    Rows that repeat a doc_id are separate documents. Empty input gives no rows. Only one shard's
    lengths are in a task at a time, and nothing but counts reaches the driver. Seeds follow from
    shard, island and epoch, so a task that runs again gives the same packing.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, "pieces")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts.mapInArrow(_pieces(vocabulary, capacity), PIECE).write.parquet(path)
    pieces = spark.read.parquet(path)
    whole = pieces.where(F.col("length") == capacity)
    done = whole.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, shards, number, left = pieces.where(F.col("length") < capacity), 0, 0, None
    while count := rest.count():
        last = left is not None and count > SHRINK * left
        placed, shards = _pack_shards(rest, count, capacity)
        last = last or shards == 1
        ready = placed if last else placed.where(F.col("fill") >= FULL * capacity)
        sequence = F.lit(number) * F.lit(1 << 56) + F.col("shard") * F.lit(1 << 20) + F.col("bin")
        done = done.unionByName(ready.select(*pieces.columns, sequence.alias("sequence_id"), "offset"))
        if last:
            break
        rest, left, number = placed.where(F.col("fill") < FULL * capacity).select(pieces.columns), count, number + 1
    return done
