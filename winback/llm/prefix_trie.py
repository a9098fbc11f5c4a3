"""Operator 13, conversation prefix trie: time-forward processing.

A node of the trie is a distinct sequence of first turns, told by its depth and two
64-bit XORs over its turns' hashes (which depend on the turn's place), so prefixes
are running sums and no path is ever compared. Nodes get their totals by
time-forward processing, in reverse level order, with messages to parents:

* **Shards.** Every node knows from its members' lengths how many turns lie below
  it at most. Subtrees of at most ``cap`` turns are shards. A task holds some whole
  shards, sorted by falling depth, and sends each node's totals to its parent through
  a priority queue that spills sorted runs (``SpillingQueue``).
* **Across shard roots.** The nodes above have more than ``cap`` turns below them.
  They are cut into at most (turns / cap) root-to-leaf chains, each chain into
  segments by range partitions, so neither a hot turn nor one endless conversation
  is one task. The segments (a table of at most that many rows plus partitions)
  pass their totals on in the same way; running sums inside segments give every node.

Text leaves the scan only as hashes, a length and its first characters (for ties).
Turns are numbered through a range sort, prefixes summed in blocks of ``BLOCK``
turns, so a conversation with a third of all rows is spread. The hash of the ids
that end at a node is sequential by its definition: the ids are sorted and joined in
pieces by many tasks, then the pieces of a node are streamed through one digest.

Defined results. Rows with a null conv_id take no part. Turns of a conversation are
ordered by turn (null first), then role, text (its first 64 characters, then a hash);
repeated rows are turns of their own. Null and empty roles and texts are the same.
A conversation without rows does not exist; one that loses all its turns in the
rebuilding is a member of the root only. The base of c is c - c % 100, with the
remainder's sign that of c. An empty table has no nodes. Very long texts and
conversations are read whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winback.llm.common import bounded_batches, stored

GROUP = 100             # conversations that share a base
HEADS = 6               # first turns taken from the base: fewer than this
BLOCK = 1_024           # turns of a conversation that are summed in one window
SHARDS_PER_PARTITION = 8
LEAST_CAP, MOST_CAP = 64, 2_000_000     # turns below a shard root
QUEUE_ROWS = 500_000    # messages a priority queue holds in memory
ENDS_PER_PIECE = 512    # ids in a piece that is hashed
KEY = ["depth", "xa", "xb"]
UP = ["up_depth", "pa", "pb"]
TOTALS = "leaves long, saved long, children long"


class SpillingQueue:
    """Smallest entry first; beyond ``limit`` entries it writes sorted runs to
    unlinked files that end with the task."""

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        f = tempfile.TemporaryFile()
        self.heap.sort()
        for i in range(0, len(self.heap), 10_000):
            pickle.dump(self.heap[i:i + 10_000], f)
        f.seek(0)
        self.heap = []
        self.spilled += 1
        run = self._entries(f)
        heapq.heappush(self.runs, (next(run), self.spilled, run))

    @staticmethod
    def _entries(f) -> Iterator[tuple]:
        with f:
            while True:
                try:
                    yield from pickle.load(f)
                except EOFError:
                    return

    def first(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            entry, n, run = self.runs[0]
            after = next(run, None)
            heapq.heapreplace(self.runs, (after, n, run)) if after else heapq.heappop(self.runs)
            return entry
        return heapq.heappop(self.heap)


def climb(df: DataFrame, limit: int = QUEUE_ROWS) -> DataFrame:
    """Time-forward processing inside partitions. ``df`` is sorted by (level desc, a,
    b) and has these, the parent's up_level, up_a, up_b, ``top`` (the parent is not
    in this partition), own_leaves, own_saved. Adds leaves (1 for a node that has
    neither own leaves nor children), saved, children."""
    names = df.columns
    at = {n: names.index(n) for n in ("level", "a", "b", "up_level", "up_a", "up_b", "top", "own_leaves", "own_saved")}

    def work(batches):
        queue = SpillingQueue(limit)
        for batch in batches:
            cols = [batch.column(at[n]).to_pylist() for n in at]
            leaves, saved, children = [], [], []
            for level, a, b, up_level, up_a, up_b, top, own, save in zip(*cols):
                key, n = (-level, a, b), 0
                while (m := queue.first()) is not None and m[:3] == key:
                    queue.pop()
                    n, own, save = n + 1, own + m[3], save + m[4]
                own = own if own or n else 1
                if not top:
                    queue.push((-up_level, up_a, up_b, own, save))
                leaves.append(own)
                saved.append(save)
                children.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x, pa.int64()) for x in (leaves, saved, children))],
                [*names, "leaves", "saved", "children"])
        if queue.first() is not None:
            raise ValueError("a message was sent to a node that is not in its shard")

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(work, f"{kinds}, {TOTALS}")


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv, pos from 0, t1, t2 hashes of role and text, n code points), stored."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    d = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.substring(role, 1, 64).alias("r"),
        F.substring(text, 1, 64).alias("s"), F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), text, role).alias("t2"), F.length(text).cast("long").alias("n"),
        F.monotonically_increasing_id().alias("uid"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), *map(F.col, ("r", "s", "t1", "t2", "uid"))]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "t1", "t2", "n")

    def work(batches):
        part, last, size = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(conv):
                continue
            new = np.ones(len(conv), bool)
            new[1:] = conv[1:] != conv[:-1]
            starts = np.nonzero(new)[0]
            at = np.arange(len(conv)) - np.repeat(starts, np.diff([*starts, len(conv)]))
            if last == conv[0]:                 # a run that goes on
                at[:starts[1] if len(starts) > 1 else len(at)] += size
            last, size = conv[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(conv), part), pa.int32()), pa.array(at, pa.int64()), *batch.columns],
                ["part", "at", "conv", "t1", "t2", "n"])

    d = stored(d.mapInArrow(work, "part int, at long, conv long, t1 long, t2 long, n long"), "trie_turns")
    # one row per range partition: where its first conversation goes on from
    ends = sorted(d.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "at")).alias("end")).collect())
    carry, open_conv, open_rows = [], None, 0
    for r in ends:
        before = open_rows if r.first == open_conv else 0
        if before:
            carry.append((r.part, r.first, before))
        open_rows = r.end.at + 1 + (before if r.first == r.end.conv else 0)
        open_conv = r.end.conv
    if not carry:
        return d.select("conv", F.col("at").alias("pos"), "t1", "t2", "n")
    c = F.broadcast(d.sparkSession.createDataFrame(carry, "part int, conv long, before long"))
    return d.join(c, ["part", "conv"], "left").select(
        "conv", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "t1", "t2", "n")


def rebuilt(turns: DataFrame, heads: int = HEADS, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(rows of rebuilt conversations: conv, size, depth from 1, t1, t2, n; one row per
    conversation: conv, size)."""
    c = F.col("conv")
    base = c - c % group
    sizes = stored(turns.groupBy("conv").agg(F.count("*").alias("own")), "trie_sizes")
    h = F.when(base == c, 0).otherwise(F.crc32(c.cast("string").cast("binary")) % heads)
    bases = sizes.where(c % group == 0).select(c.alias("base"), F.col("own").alias("base_size"))
    convs = sizes.select("conv", "own", base.alias("base"), h.alias("h")).join(bases, "base", "left")
    kept = F.least("h", F.coalesce("base_size", F.lit(0)))
    convs = stored(convs.select("conv", "base", "h", kept.alias("kept"),
                                (kept + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size")), "trie_convs")
    own = turns.join(convs, "conv").where("pos >= h").select(
        "conv", "size", (F.col("pos") - F.col("h") + F.col("kept") + 1).alias("depth"), "t1", "t2", "n")
    first = turns.where((c % group == 0) & (F.col("pos") < heads - 1)).withColumnRenamed("conv", "base")
    taken = first.join(convs.where("kept > 0"), "base").where("pos < kept").select(
        "conv", "size", (F.col("pos") + 1).alias("depth"), "t1", "t2", "n")
    return own.unionByName(taken), convs.select("conv", "size")


def prefixes(rows: DataFrame, longest: int, block: int = BLOCK) -> DataFrame:
    """(conv, size, depth, n, xa, xb: the prefix up to this turn, pa, pb: before it), stored."""
    rows = rows.select("conv", "size", "depth", "n", F.floor((F.col("depth") - 1) / block).alias("block"),
                       F.xxhash64(F.lit(3), "depth", "t1", "t2").alias("ha"),
                       F.xxhash64(F.lit(4), "t2", "t1", "depth").alias("hb"))
    w = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    p = rows.select("conv", "size", "depth", "n", "block", "ha", "hb",
                    F.bit_xor("ha").over(w).alias("xa"), F.bit_xor("hb").over(w).alias("xb"))
    cols = ["conv", "size", "depth", "n"]
    if longest > block:                 # what earlier blocks of a conversation sum up to
        p = stored(p, "trie_blocks")
        before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        sums = (p.where(F.col("size") > block).groupBy("conv", "block")
                .agg(F.bit_xor("ha").alias("sa"), F.bit_xor("hb").alias("sb"))
                .select("conv", "block", F.bit_xor("sa").over(before).alias("sa"), F.bit_xor("sb").over(before).alias("sb")))
        p = p.join(sums, ["conv", "block"], "left")
        p = p.select(*cols, "ha", "hb", *[F.col(f"x{k}").bitwiseXOR(F.coalesce(f"s{k}", F.lit(0))).alias(f"x{k}") for k in "ab"])
    return stored(p.select(*cols, "xa", "xb", *[F.col(f"x{k}").bitwiseXOR(F.col(f"h{k}")).alias(f"p{k}") for k in "ab"]),
                  "trie_prefixes")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, xa, xb, ends_sha256) of the conversations (conv) that end at each node."""
    order = [*KEY, "conv"]
    d = ends.repartitionByRange(*order).sortWithinPartitions(*order)

    def pieces(batches):
        key, ids = None, []

        def piece():
            return pa.RecordBatch.from_pylist([{"depth": key[0], "xa": key[1], "xb": key[2], "first": ids[0],
                                                "ids": ",".join(map(str, ids))}])
        for batch in batches:
            for *k, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key or len(ids) == ENDS_PER_PIECE:
                    if ids:
                        yield piece()
                    key, ids = k, []
                ids.append(conv)
        if ids:
            yield piece()

    def digests(batches):
        key, sha = None, None
        for batch in batches:
            out = []
            for *k, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if k == key:
                    sha.update(b"," + ids.encode())
                else:
                    if key:
                        out.append((*key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out))), [*KEY, "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], [*KEY, "ends_sha256"])

    kinds = "depth long, xa long, xb long"
    p = d.select(*KEY, "conv").mapInArrow(pieces, f"{kinds}, first long, ids string")
    return (p.repartition(*KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(digests, f"{kinds}, ends_sha256 string"))


def _light(nodes: DataFrame, heavy: DataFrame, paths: DataFrame, cap: int) -> DataFrame:
    """Totals of the nodes in shards, stored."""
    # a conversation's shard: its first node that is not above all shards
    shards = (paths.join(heavy.select(*KEY), KEY, "left_anti").groupBy("conv")
              .agg(F.min(F.struct(*KEY)).alias("shard")))
    d = nodes.where(F.col("below") <= cap).join(shards.withColumnRenamed("conv", "conv_id"), "conv_id")
    d = d.select(F.col("depth").alias("level"), F.col("xa").alias("a"), F.col("xb").alias("b"),
                 F.col("up_depth").alias("up_level"), F.col("pa").alias("up_a"), F.col("pb").alias("up_b"),
                 (F.col("depth") == F.col("shard.depth")).alias("top"), F.lit(0).cast("long").alias("own_leaves"),
                 F.col("worth").alias("own_saved"), "conv_id", "n_convs", "shard")
    d = d.repartition("shard").sortWithinPartitions(F.desc("level"), "a", "b").drop("shard")
    return stored(climb(d).withColumnsRenamed({"level": "depth", "a": "xa", "b": "xb", "up_level": "up_depth",
                                               "up_a": "pa", "up_b": "pb"}), "trie_light")


def _heavy(heavy: DataFrame, light: DataFrame, paths: DataFrame) -> DataFrame:
    """Totals of the nodes above all shards, stored."""
    got = (light.where("top").groupBy(*UP).agg(F.sum("leaves").alias("own_leaves"), F.sum("saved").alias("got_saved"),
                                               F.count("*").alias("light_children"))
           .withColumnsRenamed(dict(zip(UP, KEY))))
    below = heavy.groupBy(*UP).agg(F.count("*").alias("heavy_children")).withColumnsRenamed(dict(zip(UP, KEY)))
    zero = F.lit(0).cast("long")
    d = heavy.join(got, KEY, "left").join(below, KEY, "left").na.fill(0, ["own_leaves", "got_saved", "light_children", "heavy_children"])
    children = F.col("light_children") + F.col("heavy_children")
    d = d.select(*KEY, *UP, "conv_id", "n_convs", (F.col("worth") + F.col("got_saved")).alias("own_saved"),
                 children.alias("children"), F.when(children == 0, 1).otherwise(F.col("own_leaves")).alias("own_leaves"),
                 "heavy_children")
    # chains: the smallest conversation among those of the lowest nodes that pass a node
    reps = stored(d.where("heavy_children = 0").select(F.col("conv_id").alias("conv"), F.col("depth").alias("low")), "trie_reps")
    way = (paths.join(reps, "conv").where("depth <= low").select(*KEY, "conv")
           .unionByName(reps.select(zero.alias("depth"), zero.alias("xa"), zero.alias("xb"), "conv")))
    d = d.join(way.groupBy(*KEY).agg(F.min("conv").alias("chain")), KEY)
    d = stored(d.repartitionByRange("chain", "depth").withColumn("part", F.spark_partition_id().cast("long")), "trie_heavy")
    # segments: what a range partition holds of a chain
    s = d.groupBy("part", "chain").agg(F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved"),
                                       F.min(F.struct("depth", *UP)).alias("first"))
    s = s.select("part", "chain", "own_leaves", "own_saved", F.col("first.depth").alias("level"), *[F.col(f"first.{c}") for c in UP])
    levels = s.select("part", "chain", F.col("level").alias("up_level"))
    above = (d.select(*KEY, F.col("part").alias("up_a"), F.col("chain").alias("up_b"))
             .join(levels.withColumnsRenamed({"part": "up_a", "chain": "up_b"}), ["up_a", "up_b"])
             .withColumnsRenamed(dict(zip(KEY, UP))))
    s = s.join(above, UP, "left").select(
        "level", F.col("part").alias("a"), F.col("chain").alias("b"), "up_level", "up_a", "up_b",
        F.col("up_level").isNull().alias("top"), "own_leaves", "own_saved", *UP)
    s = stored(climb(s.repartition(1).sortWithinPartitions(F.desc("level"), "a", "b")), "trie_segments")
    hung = (s.where(~F.col("top")).groupBy(*UP).agg(F.sum("leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved"))
            .withColumnsRenamed(dict(zip(UP, KEY))))
    w = Window.partitionBy("part", "chain").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    full = d.join(hung, KEY, "left").na.fill(0, ["hung_leaves", "hung_saved"])
    return stored(full.select(*KEY, *UP, "conv_id", "n_convs", "children",
                              F.sum(F.col("own_leaves") + F.col("hung_leaves")).over(w).alias("leaves"),
                              F.sum(F.col("own_saved") + F.col("hung_saved")).over(w).alias("saved")), "trie_top")


def trie(conversations: DataFrame, cap: int | None = None, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``cap``: turns below a shard root (from the table's size
    and the partitions if not given)."""
    spark = conversations.sparkSession
    bounded_batches(spark)
    rows, convs = rebuilt(turns_in_order(conversations))
    n_convs, total, longest = convs.agg(F.count("*"), F.sum("size"), F.max("size")).first()
    paths = prefixes(rows, longest or 0, block)
    if cap is None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        cap = min(MOST_CAP, max(LEAST_CAP, (total or 0) // (SHARDS_PER_PARTITION * parts)))
    zero = F.lit(0).cast("long")
    nodes = paths.groupBy(*KEY).agg(
        F.min(F.col("depth") - 1).alias("up_depth"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"),
        ((F.count("*") - 1) * F.max("n")).alias("worth"), F.sum(F.col("size") - F.col("depth") + 1).alias("below"))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(c) for c in KEY], F.lit(-1).cast("long").alias("up_depth"), zero.alias("pa"), zero.alias("pb"),
        "conv_id", "n_convs", zero.alias("worth"), F.lit(2 ** 62).alias("below"))
    nodes = stored(nodes, "trie_nodes")
    heavy = stored(nodes.where(F.col("below") > cap).unionByName(root), "trie_above")
    light = _light(nodes, heavy, paths, cap)
    top = _heavy(heavy, light, paths)
    cols = [*KEY, *UP, "conv_id", "n_convs", "children", "leaves", "saved"]
    every = light.select(*cols).unionByName(top.select(*cols))
    ends = (paths.where("depth = size").select(*KEY, "conv")
            .unionByName(convs.where("size = 0").select(*[zero.alias(c) for c in KEY], "conv")))
    parents = every.select(*[F.col(k).alias(u) for k, u in zip(KEY, UP)], F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (every.join(ends_digest(ends), KEY, "left").join(parents, UP, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
