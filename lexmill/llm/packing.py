"""Filling containers of fixed capacity by Karmarkar-Karp multiway differencing.

A block of items is dealt into k windows of near-equal sums: every item starts
as a partial partition (one window holds it, k-1 are empty); the two partial
partitions with the largest imbalances are merged again and again, the fullest
windows of one onto the emptiest of the other, until one partition is left.
k starts at the sum divided by the capacity, rounded up. Windows within the
capacity and nearly full are closed; the items of the others are dealt again,
and k rises by the excess whenever the capacity is exceeded and nothing closes.

Blocks are cut from the stream of a partition, so nothing is shuffled, and a
hot source, language or length cannot end up in one task. A block ends when it
holds ``CONTAINERS_PER_BLOCK`` containers' worth of tokens or
``ITEMS_PER_BLOCK`` items, whichever comes first (many small items per container
fill it well even in fewer containers); only the block's last container may be
slack. Which documents share a container depends on how the table is
partitioned; that every document is packed once, whole if it can be, and within
the capacity does not. An item larger than the capacity is cut into full
containers and a rest.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.bpe import TOKENIZER_DIR, count_tokens

#: Containers a block fills; larger blocks waste less and cost more per item.
CONTAINERS_PER_BLOCK = 320
#: Items a block holds at most; bounds a task's memory where containers are large.
ITEMS_PER_BLOCK = 6_400
#: Windows filled this far are closed at once.
FULL = 0.985


class _Partial:
    """A partial partition: loads of its windows, ascending, and the items in each."""

    __slots__ = ("loads", "bins")

    def __init__(self, loads: list[int], bins: list[list[int]]):
        self.loads, self.bins = loads, bins

    @property
    def imbalance(self) -> int:
        return self.loads[-1] - self.loads[0]

    def add(self, size: int, item: int) -> None:
        """Merge with a single item: onto the emptiest window."""
        load, own = self.loads.pop(0) + size, self.bins.pop(0)
        own.append(item)
        at = bisect_right(self.loads, load)
        self.loads.insert(at, load)
        self.bins.insert(at, own)

    def merge(self, other: _Partial) -> _Partial:
        """The fullest windows of the other one onto the emptiest of this."""
        both = sorted(zip([x + y for x, y in zip(self.loads, reversed(other.loads), strict=True)], range(len(self.loads)), strict=True))
        theirs = other.bins[::-1]
        return _Partial([load for load, _ in both], [self.bins[i] + theirs[i] for _, i in both])


def differencing(sizes: Sequence[int], k: int) -> list[list[int]]:
    """Deal items into k windows of near-equal sums; each window lists item numbers.

    The two partial partitions of largest imbalance are merged until one is
    left. Single items have their size as imbalance; a partition that grows from
    one keeps that imbalance while a window of it is empty, so it takes the next
    largest single items, one a window, as long as no other partition's
    imbalance is larger: such a run is merged at once.
    """
    if k == 1 or not len(sizes):
        return [list(range(len(sizes))), *[[] for _ in range(k - 1)]]
    single = sorted(((int(s), i) for i, s in enumerate(sizes)), key=lambda x: (-x[0], x[1]))
    heap: list[tuple[int, int, _Partial]] = []
    at = count = 0
    while at < len(single) or len(heap) > 1:
        count += 1
        largest = -heap[0][0] if heap else -1
        if at < len(single) and single[at][0] >= largest:
            end = at + 1  # a run of single items, each at least as large as any imbalance
            while end < len(single) and end - at < k and single[end][0] >= largest:
                end += 1
            run = single[at:end][::-1]
            at = end
            partial = _Partial([0] * (k - len(run)) + [s for s, _ in run], [[] for _ in range(k - len(run))] + [[i] for _, i in run])
        else:
            partial = heapq.heappop(heap)[2]
            if at < len(single) and (not heap or single[at][0] >= -heap[0][0]):
                partial.add(*single[at])
                at += 1
            else:
                partial = partial.merge(heapq.heappop(heap)[2])
        heapq.heappush(heap, (-partial.imbalance, count, partial))
    return heap[0][2].bins[::-1]


def fill(sizes: Sequence[int], capacity: int, full: float = FULL) -> list[list[int]]:
    """Containers (lists of item numbers) of at most ``capacity``; items are at most that large."""
    sizes = np.asarray(sizes, np.int64)
    closed: list[list[int]] = []
    rest = np.flatnonzero(sizes > 0)
    extra = 0
    while len(rest):
        total = int(sizes[rest].sum())
        k = -(-total // capacity) + extra
        bins = [[int(rest[i]) for i in b] for b in differencing(sizes[rest], k)] if k > 1 else [rest.tolist()]
        loads = [int(sizes[b].sum()) for b in bins]
        if max(loads) <= capacity:
            closed += [b for b in bins if b]
            break
        done = [b for b, n in zip(bins, loads, strict=True) if capacity * full <= n <= capacity]
        if done:
            closed += done
            taken = np.zeros(len(sizes), bool)
            taken[[i for b in done for i in b]] = True
            rest = rest[~taken[rest]]
            extra = 0 if len(done) * 10 >= len(bins) else extra
        else:
            over = sum(n - capacity for n in loads if n > capacity)
            extra += max(1, over // (2 * capacity))
    return closed


def pack_documents(df: DataFrame, id_col: str, text_col: str, specs: Sequence[tuple[int, str, int]], tokenizer_dir: str = TOKENIZER_DIR, containers_per_block: int = CONTAINERS_PER_BLOCK, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """Put every document into containers of each spec (spec_id, tokenizer, capacity).

    One row per piece: spec_id, container (string, unique within the spec), id,
    piece (from 0), start (its first token in the document), n_tokens, capacity.
    A document is cut only if it exceeds the capacity. A document of no tokens
    (null or empty text) takes no room: it is one piece of 0 tokens in the
    container "none". Repeated ids are packed as rows of their own. An empty
    table, or no specs, gives no rows.
    """
    out = None
    for tokenizer in sorted({t for _, t, _ in specs}):
        own = [(int(s), int(c)) for s, t, c in specs if t == tokenizer]
        if any(c <= 0 for _, c in own):
            raise ValueError("a capacity must be positive")
        part = _pack_sizes(count_tokens(df, id_col, text_col, tokenizer, tokenizer_dir).withColumnsRenamed({id_col: "id"}), own, containers_per_block, items_per_block).withColumnRenamed("id", id_col)
        out = part if out is None else out.unionByName(part)
    if out is None:
        id_type = dict(df.select(F.col(id_col).alias("i")).dtypes)["i"]
        out = df.sparkSession.createDataFrame([], f"spec_id int, container string, `{id_col}` {id_type}, piece int, start long, n_tokens long, capacity int")
    return out


def _pack_sizes(sizes: DataFrame, specs: list[tuple[int, int]], containers_per_block: int, items_per_block: int) -> DataFrame:
    id_type = dict(sizes.dtypes)["id"]
    names = ["spec_id", "container", "id", "piece", "start", "n_tokens", "capacity"]
    types = [pa.int32(), pa.string(), None, pa.int32(), pa.int64(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        open_: dict[int, list[tuple[object, int]]] = {s: [] for s, _ in specs}
        held = dict.fromkeys(open_, 0)
        blocks = dict.fromkeys(open_, 0)
        kind = pa.int64()

        def close(spec: int, capacity: int) -> pa.RecordBatch:
            block = blocks[spec]
            blocks[spec] += 1
            ids, piece, start, n, box = [], [], [], [], []
            rests: list[int] = []  # pieces below the capacity
            made = 0
            for i, tokens in open_[spec]:
                at = p = 0
                while tokens - at > capacity:
                    ids.append(i), piece.append(p), start.append(at), n.append(capacity), box.append(made)
                    made, at, p = made + 1, at + capacity, p + 1
                ids.append(i), piece.append(p), start.append(at), n.append(tokens - at), box.append(-1)
                rests.append(len(ids) - 1)
            for items in fill([n[r] for r in rests], capacity):
                for r in items:
                    box[rests[r]] = made
                made += 1
            open_[spec], held[spec] = [], 0
            label = [f"{part}-{block}-{b}" if b >= 0 else "none" for b in box]
            columns = [[spec] * len(ids), label, ids, piece, start, n, [capacity] * len(ids)]
            return pa.RecordBatch.from_arrays([pa.array(c, t or kind) for c, t in zip(columns, types, strict=True)], names=names)

        for b in batches:
            kind = b.schema.field(0).type
            for i, tokens in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for spec, capacity in specs:
                    open_[spec].append((i, tokens))
                    held[spec] += tokens
                    if held[spec] >= containers_per_block * capacity or len(open_[spec]) >= items_per_block:
                        yield close(spec, capacity)
        for spec, capacity in specs:
            if open_[spec]:
                yield close(spec, capacity)

    return sizes.mapInArrow(run, f"spec_id int, container string, id {id_type}, piece int, start long, n_tokens long, capacity int")


def packing_report(packed: DataFrame) -> DataFrame:
    """Per spec: containers, tokens and the share of the room that is used."""
    real = packed.where(F.col("container") != "none")
    return real.groupBy("spec_id", "capacity", "container").agg(F.sum("n_tokens").alias("n")).groupBy("spec_id", "capacity").agg(F.count("*").alias("containers"), F.sum("n").alias("tokens")).withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 4))
