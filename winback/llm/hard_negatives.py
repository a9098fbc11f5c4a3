"""Operator 11, hard-negative mining: anchor-clustered shared lists.

Anchors are clustered by direction. For a cluster with centroid c and radius r (the
largest angle between a member and c) every candidate x has the angular upper bound
|x| cos(max(0, angle(x, c) - r)): times a member's own norm, no score of x with a
member is higher. A task reads a block of candidates and, for each cluster, sorts
the block once by that bound; all members walk the shared list from its head. A
member stops, certified, when its norm times the bound of the next entry falls
under what could still change its result: the worst of its k best so far, or the
lower end of its windows. Scores are exact integer inner products.

Two walks. The first finds every anchor's first ``positives`` rows of its own
label; a grouped top-k over the tasks' results gives the final ones. These open
for each positive a window of scores, and the second walk finds the first
``negatives`` rows of other labels in each of them.

Anchors are taken in chunks of at most ``CHUNK_BYTES`` (a hash of unique row
numbers deals them out, and each chunk's size is checked); a chunk is clustered and
broadcast, candidates never move. A task holds one block of candidates and the
chunk's best rows, whatever the number of rows of a label or copies of a vector.

Defined results. Rows with a null vec_id, label or vector, or with a null or
non-finite component, take no part. Repeated rows are rows of their own: a second
row with an anchor's id is another candidate and another anchor. Equal scores are
ordered by vec_id, copies of an id by row. Shorter vectors are filled up with
zeros; zero vectors score 0. Where products could pass 2^53 whole Python integers
are multiplied, and scores beyond 64 bits are cut to the nearest long. An anchor
without positives, or a positive without negatives in its window (one with a
negative score never has any), gives no row; an empty table an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winback.llm.common import bounded_batches, stored

POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95            # per cent of the positive's score
CHUNK_BYTES = 32 * 1024 ** 2    # anchors' components in one broadcast
CHUNK_ROWS = 32_768
BLOCK_BYTES = 16 * 1024 ** 2    # candidates' components in one block
SLAB = 512                      # first entries of a list walked at once; doubled after each
LLOYD_ROUNDS = 4
NONE = -2 ** 62                 # the score of a free place


def vectors(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, label, q: whole components as doubles) of the rows that take part, stored."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    label = F.col("label").cast("long")
    d = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                          x.alias("x"), bad.alias("bad"))
    whole = F.transform("x", lambda v: F.when(F.abs(v) >= 2.0 ** 44, v * 256)
                        .otherwise(F.floor(v * 256).cast("double")))
    d = d.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.col("bad"))
    return stored(d.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", whole.alias("q")), "vectors")


def matrix(q: pa.Array, width: int) -> np.ndarray:
    """Rows of components, filled up with zeros to ``width``."""
    sizes = np.diff(q.offsets.to_numpy())
    flat = q.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions (zero for zero vectors) and norms; scaled first, so nothing overflows."""
    most = np.abs(x).max(axis=1, initial=0.0)
    scaled = x / np.where(most > 0, most, 1.0)[:, None]
    norm = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled / np.where(norm > 0, norm, 1.0)[:, None], norm * most


def products(a: np.ndarray, b: np.ndarray, wide: bool) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``."""
    if not wide:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    s = np.dot(whole(a), whole(b).T) if a.size and b.size else np.zeros((len(a), len(b)), object)
    return np.clip(s, NONE + 1, 2 ** 62).astype(np.int64)


class Anchors:
    """A chunk of anchors by cluster: what tasks need to walk the lists."""

    def __init__(self, rows: pa.Table, width: int, wide: bool):
        self.row, self.vec_id, self.label = (rows[c].to_numpy() for c in ("row", "vec_id", "label"))
        q = matrix(rows["q"].combine_chunks(), width)
        u, self.norm = units(q)
        self.width, self.wide = width, wide
        small = np.abs(q).max(initial=0) < 2 ** 15
        self.q = q.astype(np.int16) if small else q
        n = len(q)
        k = min(n, int(2 * np.sqrt(n)) + 1)
        order = np.lexsort(u.T) if width else np.arange(n)
        c = u[order[np.linspace(0, n - 1, k).astype(int)]]
        for _ in range(LLOYD_ROUNDS):
            at = np.argmax(u @ c.T, axis=1)
            sums = np.zeros_like(c)
            np.add.at(sums, at, u)
            c = np.where(np.abs(sums).sum(axis=1, keepdims=True) > 0, units(sums)[0], c)
        at = np.argmax(u @ c.T, axis=1)
        used = np.unique(at)
        self.centroids = c[used]
        self.members = [np.nonzero(at == i)[0] for i in used]
        # members' angles to their centroid, the largest
        self.radius = np.array([angles(u[m], c[i][None])[:, 0].max() for i, m in zip(used, self.members)])


def angles(u: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Angles between unit rows, from chords: exact for small ones too."""
    dot = np.clip(u @ c.T, -1.0, 1.0)
    return 2 * np.arcsin(np.sqrt(np.maximum(0.0, (1.0 - dot) / 2)))


class Best:
    """The k best rows (score falling, vec_id, row rising) of n places."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), NONE, np.int64)
        self.vec_id, self.row = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)

    def worst(self, i):
        return self.score[i, -1]

    def offer(self, i: int, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        if len(score) > 4 * self.k:         # all ties of the k-th stay
            keep = score >= np.partition(score, -self.k)[-self.k]
            score, vec_id, row = score[keep], vec_id[keep], row[keep]
        score, vec_id, row = (np.concatenate(x) for x in (
            (self.score[i], score), (self.vec_id[i], vec_id), (self.row[i], row)))
        by = np.lexsort((row, vec_id, -score))[:self.k]
        self.score[i], self.vec_id[i], self.row[i] = score[by], vec_id[by], row[by]


class PositiveWalk:
    """An anchor's k best other rows of its label."""

    def __init__(self, anchors: Anchors, k: int):
        self.a, self.best = anchors, Best(len(anchors.row), k)

    def need(self, members: np.ndarray) -> np.ndarray:
        return self.best.worst(members)

    def take(self, i: int, score, label, vec_id, row) -> None:
        ok = np.nonzero((score >= self.best.worst(i)) & (label == self.a.label[i]) & (row != self.a.row[i]))[0]
        if len(ok):
            self.best.offer(i, score[ok], vec_id[ok], row[ok])

    def found(self):
        i, j = np.nonzero(self.best.score != NONE)
        return {"anchor": self.a.row[i], "anchor_id": self.a.vec_id[i], "score": self.best.score[i, j],
                "vec_id": self.best.vec_id[i, j], "row": self.best.row[i, j]}


class NegativeWalk:
    """The k best rows of other labels in every window of an anchor. ``windows``:
    (anchor's place, positive's place, lowest, highest score), by anchor."""

    def __init__(self, anchors: Anchors, k: int, place, number, low, high):
        self.a, self.place, self.number, self.low, self.high = anchors, place, number, low, high
        self.best = Best(len(place), k)
        self.floor = np.append(low, 2 ** 62)        # a window's lowest score that still counts
        n = len(anchors.row)
        first, size = np.searchsorted(place, np.arange(n)), np.bincount(place, minlength=n)
        j = np.arange(size.max(initial=1))
        self.of = np.where(j < size[:, None], first[:, None] + j, len(place))       # an anchor's windows
        self.count = size

    def need(self, members: np.ndarray) -> np.ndarray:
        return self.floor[self.of[members]].min(axis=1)

    def take(self, i: int, score, label, vec_id, row) -> None:
        js = self.of[i, :self.count[i]]
        if not len(js):
            return
        ok = np.nonzero((score >= self.floor[js].min()) & (score <= self.high[js].max()) & (label != self.a.label[i]))[0]
        if not len(ok):
            return
        score, vec_id, row = score[ok], vec_id[ok], row[ok]
        for j in js:
            inside = np.nonzero((score >= self.floor[j]) & (score <= self.high[j]))[0]
            if len(inside):
                self.best.offer(j, score[inside], vec_id[inside], row[inside])
                self.floor[j] = max(self.low[j], self.best.worst(j))

    def found(self):
        w, j = np.nonzero(self.best.score != NONE)
        return {"anchor": self.a.row[self.place[w]], "anchor_id": self.a.vec_id[self.place[w]], "positive": self.number[w],
                "score": self.best.score[w, j], "vec_id": self.best.vec_id[w, j], "row": self.best.row[w, j]}


def walk_block(walk, a: Anchors, x: np.ndarray, label, vec_id, row) -> int:
    """Let all anchors walk their cluster's list over a block; scores computed."""
    u, norm = units(x)
    away = angles(u, a.centroids)
    slack = 1e-6
    computed = 0
    for k, members in enumerate(a.members):
        gap = np.maximum(0.0, away[:, k] - a.radius[k] - slack)
        bound = norm * np.cos(np.minimum(gap, np.pi))
        order = np.argsort(-bound, kind="stable")
        at, size = 0, SLAB
        while at < len(order):
            # certified: no later entry can reach what a member still needs
            head = a.norm[members] * bound[order[at]]
            head = head + np.abs(head) * 1e-9 + 1e-3
            members = members[head >= walk.need(members)]
            if not len(members):
                break
            slab = order[at:at + size]
            s = products(a.q[members].astype(np.float64), x[slab], a.wide)
            computed += s.size
            for m, scores in zip(members, s):
                walk.take(m, scores, label[slab], vec_id[slab], row[slab])
            at, size = at + size, 2 * size
    return computed


def _walked(candidates: DataFrame, start, names: dict[str, str], width: int) -> DataFrame:
    """``start()`` gives a task's walk; its found rows."""
    block_rows = max(1_024, BLOCK_BYTES // (8 * max(1, width)))

    def work(batches):
        walk, held, n = start(), [], 0

        def block():
            t = pa.Table.from_batches(held)
            x = matrix(t["q"].combine_chunks(), width)
            walk_block(walk, walk.a, x, *(t[c].to_numpy() for c in ("label", "vec_id", "row")))
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= block_rows:
                block()
                held, n = [], 0
        if n:
            block()
        got = walk.found()
        yield pa.RecordBatch.from_arrays([pa.array(got[c], pa.int64()) for c in names], list(names))

    return candidates.mapInArrow(work, ", ".join(f"{c} {t}" for c, t in names.items()))


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(embeddings: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
         least: int = LEAST, most: int = MOST, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors
    are the rows whose vec_id is divisible by ``every``."""
    spark = embeddings.sparkSession
    bounded_batches(spark)
    d = vectors(embeddings)
    anchor = F.col("vec_id") % every == 0
    n, width, highest = d.agg(F.count(F.when(anchor, 1)), F.max(F.size("q")),
                              F.max(F.array_max(F.transform("q", F.abs)))).first()
    width, highest = width or 0, highest or 0.0
    wide = highest * highest * width >= 2.0 ** 53
    rows = max(1, min(chunk_rows, CHUNK_BYTES // (8 * max(1, width))))
    chunks = -(-n // rows)
    spread = F.pmod(F.xxhash64("row"), F.lit(max(1, chunks)))
    sizes = d.where(anchor).groupBy(spread.alias("chunk")).agg(F.count("*").alias("n")).collect() if n else []
    results = []
    for c, size in sorted(sizes):
        if size > 2 * rows + 1_000:                 # not with unique row numbers
            raise ValueError("a chunk of anchors is over twice its size")
        table = d.where(anchor & (spread == c)).toArrow().sort_by("row")
        a = spark.sparkContext.broadcast(Anchors(table, width, wide))
        found = _walked(d, lambda a=a: PositiveWalk(a.value, positives),
                        {"anchor": "long", "anchor_id": "long", "score": "long", "vec_id": "long", "row": "long"}, width)
        best = stored(_first(found, ["anchor"], positives), "positives")
        # at most (anchors in a chunk) x positives windows
        w = best.where("score >= 0").select("anchor", "rank", "score").toArrow().sort_by([("anchor", "ascending"), ("rank", "ascending")])
        score = w["score"].to_pylist()              # whole numbers: 95 times a score can pass 64 bits
        windows = spark.sparkContext.broadcast((
            np.searchsorted(table["row"].to_numpy(), w["anchor"].to_numpy()), w["rank"].to_numpy().astype(np.int64),
            np.array([-(-least * s // 100) for s in score], np.int64), np.array([most * s // 100 for s in score], np.int64)))
        found = _walked(d, lambda a=a, windows=windows: NegativeWalk(a.value, negatives, *windows.value),
                        {"anchor": "long", "anchor_id": "long", "positive": "long", "score": "long", "vec_id": "long",
                         "row": "long"}, width)
        hard = _first(found, ["anchor", "positive"], negatives)
        best = best.select("anchor", F.col("rank").cast("long").alias("positive"), F.col("vec_id").alias("positive_id"),
                           F.col("score").alias("positive_score"))
        results.append(stored(hard.join(best, ["anchor", "positive"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")), "hard_negatives"))
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, results)
