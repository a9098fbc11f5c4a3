"""Operator 7, packing: cutting-stock column generation over a length histogram.

1. Every text is tokenised (operator 6's encoder, the end id 1 appended) and cut
   into pieces of ``capacity`` tokens and a remainder (a remainder over half a
   sequence is cut once more, at the half). By their length, rounded up to
   ``unit`` tokens, pieces fall into ``capacity / unit`` classes.
2. Their histogram (a fixed number of classes) goes to the driver, where the
   cutting-stock linear program is solved by column generation: a revised
   simplex over patterns, new patterns priced by an unbounded-knapsack dynamic
   programme. Pattern counts are rounded down and the few pieces left over are
   placed by first fit decreasing.
3. Patterns become a table of slots per class (a few thousand rows at any corpus
   size). Pieces are ranked inside their class, block by block with block
   offsets, so a class that holds a third of the pieces is never one task, and
   the rank names the slot: sequence and place in it.
4. A piece's offset is the sum of the lengths before it in its sequence.

The plan only sees rounded-up lengths, so no sequence exceeds the capacity.

Defined results. A null text counts as empty and is one piece of one token (the
end id). Null ids and repeated rows are documents like others. An empty table
gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winback.llm.common import bounded_batches, shuffle_blocks, stored
from winback.llm.wordtokens import WordEncoder, batches, default_vocabulary, kept_encoder, read_json

CAPACITY = 2048
UNIT = 4                # resolution of the length classes, tokens
END_ID = 1
BLOCK_ROWS = 200_000    # pieces ranked together
GAP = 1e-3              # column generation stops this close to the optimum
MAX_PIVOTS = 2_500      # simplex steps; stopping early only costs padding


# -- the plan (driver, sizes fixed by the classes) ---------------------------

def price(duals: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern (copies of sizes 1..capacity) of largest
    total dual value, and that value."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    gain = np.maximum(duals, 0.0)
    for c in range(1, capacity + 1):
        v = best[c - 1::-1][:c] + gain[:c]          # sizes 1..c leave c-1..0
        k = int(np.argmax(v))
        if v[k] > best[c - 1]:
            best[c], pick[c] = v[k], k + 1
        else:
            best[c] = best[c - 1]
    pattern = np.zeros(capacity, np.int64)
    c = capacity
    while c > 0:
        if pick[c]:
            pattern[pick[c] - 1] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[capacity]), pattern


def solve(demand: np.ndarray, max_pivots: int = MAX_PIVOTS) -> list[tuple[np.ndarray, float]]:
    """Patterns and (fractional) times of use that cover ``demand`` of sizes
    1..n with few bins of size n: column generation from one-size patterns."""
    n = len(demand)
    sizes = np.nonzero(demand)[0]
    if not len(sizes):
        return []
    m = len(sizes)
    basis = np.zeros((m, m))
    for i, s in enumerate(sizes):
        basis[i, i] = n // (s + 1)
    inverse = np.diag(1.0 / np.diag(basis))
    x = demand[sizes] / np.diag(basis)
    for _ in range(max_pivots):        # rounding drift is harmless: uses are rounded down
        duals = np.zeros(n)
        duals[sizes] = inverse.sum(axis=0)
        value, pattern = price(duals, n)
        column = pattern[sizes].astype(float)
        if value <= 1 + GAP or not column.any():      # within GAP of the optimum
            break
        way = np.einsum("ij,j->i", inverse, column)
        up = way > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / way[up]
        out = int(np.argmin(ratio))
        step = ratio[out]
        x -= step * way
        x[out] = step
        basis[:, out] = column
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
    patterns = []
    for j in range(m):
        if x[j] > 1e-9:
            whole = np.zeros(n, np.int64)
            whole[sizes] = basis[:, j].astype(np.int64)
            patterns.append((whole, float(x[j])))
    return patterns


def plan(demand: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins as (pattern, times): a pattern lists (size, copies); every piece of
    ``demand`` (size -> pieces, sizes 1..capacity) has exactly one place."""
    left = np.zeros(capacity, np.int64)
    for size, n in demand.items():
        left[size - 1] += n
    bins = []
    for pattern, times in sorted(solve(left.astype(float)), key=lambda p: -p[1]):
        used = pattern > 0
        times = min([int(times + 1e-6), *(left[used] // pattern[used]).tolist()])
        if times > 0:
            left -= times * pattern
            bins.append(([(int(s) + 1, int(pattern[s])) for s in np.nonzero(pattern)[0]], times))
    # first fit decreasing; bins kept by free room
    free: dict[int, list[list[int]]] = defaultdict(list)
    rooms: list[int] = []
    opened: list[list[int]] = []
    for s in range(capacity, 0, -1):
        for _ in range(int(left[s - 1])):
            at = bisect_right(rooms, s - 1)          # the fullest bin with room
            if at < len(rooms):
                room = rooms[at]
                own = free[room].pop()
                if not free[room]:
                    rooms.pop(at)
            else:
                room, own = capacity, []
                opened.append(own)
            own.append(s)
            room -= s
            if room:
                if not free[room]:
                    rooms.insert(bisect_right(rooms, room), room)
                free[room].append(own)
    for own in opened:
        sizes, copies = np.unique(own, return_counts=True)
        bins.append((list(zip(sizes.tolist(), copies.tolist())), 1))
    return bins


def slot_table(bins) -> dict[int, tuple[list[int], list[int], list[int]]]:
    """Per size: (first rank, first sequence, place) of each run of slots."""
    table: dict = defaultdict(lambda: ([], [], []))
    filled: dict[int, int] = defaultdict(int)
    base = 0
    for pattern, times in bins:
        place = 0
        for size, copies in pattern:
            for _ in range(copies):
                ranks, seqs, places = table[size]
                ranks.append(filled[size])
                seqs.append(base)
                places.append(place)
                filled[size] += times
                place += 1
        base += times
    return dict(table)


# -- Spark ------------------------------------------------------------------

def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Whole sequences, and a remainder over half a sequence cut at the half:
    two such halves fill a sequence, and what is left is short enough to fit."""
    at = [*range(0, n, capacity), n]
    if at[-1] - at[-2] > capacity // 2:
        at.insert(-1, at[-2] + capacity // 2)
    return list(zip(at, at[1:]))


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece."""
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    bounded_batches(spark)
    spec = spark.sparkContext.broadcast(read_json(vocabulary))

    def work(batch_iter):
        enc = kept_encoder(f"pieces {vocabulary}", lambda: WordEncoder(spec.value))
        tail = np.array([end_id], np.uint32)
        for batch in batch_iter:
            for first, texts in batches(batch.column(1)):
                row, start, length, crc, total = [], [], [], [], []
                for i, ids in enumerate(enc.encode(texts)):
                    ids = np.concatenate([ids, tail]).astype("<u4")
                    for s, e in cuts(len(ids), capacity):
                        part = ids[s:e]
                        row.append(first + i)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        total.append(len(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())),
                     *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    src = docs.select("doc_id", F.col("text").cast("string"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(work, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def assign(parts: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """``parts`` (any rows with a ``length`` from 1 to ``capacity``, stored) with
    sequence_id and offset."""
    spark = parts.sparkSession
    sized = parts.withColumn("_size", F.ceil(F.col("length") / unit).cast("int"))
    hist = {r._size: r.n for r in sized.groupBy("_size").agg(F.count("*").alias("n")).collect()}
    table = spark.sparkContext.broadcast(
        {k: tuple(np.array(a, np.int64) for a in v)
         for k, v in slot_table(plan(hist, capacity // unit)).items()})
    blocks = shuffle_blocks(spark, sum(hist.values()), BLOCK_ROWS)
    order = [c for c in parts.columns]
    ranked = (sized.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
              .withColumn("_in", F.row_number().over(
                  Window.partitionBy("_block", "_size").orderBy(*order))))
    # pieces of a class before each block: (blocks x classes) rows
    sums = (sized.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
            .groupBy("_block", "_size").agg(F.count("*").alias("_n")))
    before = Window.partitionBy("_size").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_block", "_size", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = ranked.join(sums, ["_block", "_size"])

    def place(size: pa.Array, rank: pa.Array):
        s, r = size.to_numpy(), rank.to_numpy()
        seq, at = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
        for k in np.unique(s):
            rows = np.nonzero(s == k)[0]
            first, base, slot = table.value[int(k)]
            run = np.searchsorted(first, r[rows], side="right") - 1
            seq[rows] = base[run] + r[rows] - first[run]
            at[rows] = slot[run]
        return seq, at

    def work(batch_iter):
        for b in batch_iter:
            n = b.num_columns
            seq, at = place(b.column(n - 2), b.column(n - 1))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(n - 2)), pa.array(seq), pa.array(at)],
                [*order, "sequence_id", "_slot"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    placed = (ranked.select(*order, "_size", (F.col("_before") + F.col("_in") - 1).alias("_rank"))
              .mapInArrow(work, f"{schema}, sequence_id long, _slot long"))
    inside = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).drop("_slot")


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
         unit: int = UNIT, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. A sequence holds at most ``capacity`` tokens."""
    return assign(stored(pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity, unit)
