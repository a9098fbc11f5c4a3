"""Product propensity: one binary model per product, isotonic calibration,
scoring to long and wide tables (ML-9..ML-12, ML-14, FN-13, AGG-11, SET-1).

Models are fitted on all labelled rows. Up to ``ONE_PIECE_ROWS`` of them are a table that
every task gets, and a product's fit of 1,000 rounds is one task. A larger table is stored
as blocks of bin numbers, which one task a product holds up to ``TASK_ROWS``; beyond that
they are spread over all tasks and every level of a tree is a job that adds up their counts
(``Spread``), which gives the same trees. Products run side by side on all executors, and a
lost one costs its own fits, or some rounds of a spread one. Every customer is scored. Scores
go to a long table by batches of products: a batch is one job over the stored score frame
with a plan of its own size, and its folder is replaced by a re-run, so neither planning nor
what a failure costs grows with the catalogue. The wide table is one pivot of the long one.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winback.operators import product_trees as trees
from winback.operators.boosting import side_by_side
from winback.operators.prep import SCORING_FEATURES, impute_scoring
from winback.operators.values import value_table
from winback.session import ensure_checkpoint_dir, scratch_path
from winback.sources.io import Files, materialize

# --- fixed values: product model of the original (trees, depth, rate, sampling)
PRODUCT_MODEL = {"rounds": 1000, "depth": 5, "rate": 0.01, "subsample": 0.9, "colsample": 0.6}
# -----------------------------------------------------------------------------
ONE_PIECE_ROWS = 100_000    # labelled rows up to which every task gets the whole table
TASK_ROWS = 8_000_000       # rows of a larger table up to which a product's fit is one task; some 50 bytes each
SPREAD_ROWS, SPREAD_CHUNK_ROWS = 500_000, 1 << 15   # of a table beyond that: rows a task, and at once
SPREAD_FITS = 4             # its fits at a time
CHECKPOINT_ROUNDS = 50
NO_PRODUCT = np.iinfo(np.int64).min     # of a stored row without one
PRODUCTS_PER_BATCH = 16
SCORE_ROWS = 2_000          # rows that a task scores at once


def product_ids(df: DataFrame, col: str = "pdm_prod_type_id") -> list[int]:
    """Sorted distinct product ids (the catalogue, of which each gets a model)."""
    return sorted(int(r[0]) for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())


def product_targets(df: DataFrame, products: Sequence[int],
                    col: str = "pdm_prod_type_id") -> DataFrame:
    """FN-13 / ML-9 target step: ``target_<p>`` = 1 if the row's product is
    ``p`` else 0, for every product, as columns of the same row (no row
    expansion)."""
    return df.select("*", *[F.when(F.col(col) == p, 1).otherwise(0).alias(f"target_{p}")
                            for p in products])


def training_frame(training: DataFrame, features: Sequence[str] = SCORING_FEATURES, key: str = "customer_id",
                   product_col: str = "pdm_prod_type_id", calibration_fraction: float = 0.2,
                   max_rows: int | None = None) -> DataFrame:
    """ML-9 input: product, imputed features as an array, the held-out flag (by a hash
    of the key), and the row's ``place`` in the order of key and product, so that a fit that
    is run again grows the same trees. All rows, unless ``max_rows`` asks for a hash sample."""
    x = training
    if max_rows is not None and (rows := training.count()) > max_rows:
        bucket = F.pmod(F.xxhash64(F.lit(23), F.col(key), F.col(product_col)), F.lit(1_000_000))
        x = x.where(bucket < int(1_000_000 * max_rows / rows))
    x = impute_scoring(x, features, keep=(key, product_col))
    held = F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(1000)) < int(calibration_fraction * 1000)
    ordered = (x.select(key, product_col, F.array(*[F.col(c).cast("double") for c in features]).alias("features"),
                        held.alias("held_out"))
               .orderBy(key, product_col, "features"))
    if max_rows is not None:
        ordered = ordered.limit(max_rows)
    return ordered.select(product_col, "features", "held_out", F.monotonically_increasing_id().alias("place"))


def _matrix(column, width: int) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit_product_models(frame: DataFrame, products: Sequence[int], product_col: str = "pdm_prod_type_id",
                       params: dict | None = None, binned: DataFrame | None = None) -> DataFrame:
    """ML-9 / ML-10 over a ``training_frame``: (product, fit_rows, held_rows, model), one
    row per product: trees on (product == p), then isotonic calibration on
    the held-out rows (the original calibrated on its own training rows and then saved
    the uncalibrated model). A frame beyond ``ONE_PIECE_ROWS`` is fitted from its
    ``binned_frame`` (``binned``, if it is stored already)."""
    products = [int(p) for p in products]
    params = dict(PRODUCT_MODEL if params is None else params)
    if binned is None:
        if in_one_piece(frame):
            return _fit_from_table(frame, products, product_col, params)
        binned = materialize(binned_frame(frame, product_col), "binned")
    return _fit_from_blocks(binned, products, params, TASK_ROWS)


def in_one_piece(frame: DataFrame) -> bool:
    return frame.count() <= ONE_PIECE_ROWS


def _fit_from_table(frame: DataFrame, products: list[int], product_col: str, params: dict) -> DataFrame:
    """One task a product, which gets the whole table."""
    spark = frame.sparkSession
    table = frame.toArrow().sort_by("place")    # at most ONE_PIECE_ROWS rows
    width = len(table["features"][0]) if table.num_rows else 0
    data = spark.sparkContext.broadcast((
        _matrix(table["features"], width) if width else np.empty((0, 0)), table[product_col].to_numpy(),
        table["held_out"].to_numpy()))

    def work(batches):
        x, product, held = data.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                p = products[i]
                y = (product == p).astype(np.float64)
                m = trees.fit(x[~held], y[~held], **params)
                raw = 1 / (1 + np.exp(-trees.margins(m, x[held])))
                m["boundaries"], m["predictions"] = trees.isotonic(raw, y[held])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.array([int((~held).sum())], pa.int64()),
                     pa.array([int(held.sum())], pa.int64()), pa.array([trees.packed(m)], pa.binary())],
                    ["product", "fit_rows", "held_rows", "model"])

    return spark.range(0, len(products), 1, max(1, len(products))).mapInArrow(      # one product a task
        work, MODELS)


MODELS = "product int, fit_rows long, held_rows long, model binary"


def quantile_edges(rows: DataFrame, width: int) -> list[np.ndarray]:
    """``product_trees.bin_edges`` of the ``features`` of a table of any size: the values
    themselves where there are few, else the exact quantiles, from counts per value."""
    values = value_table(rows.select(*[F.col("features")[i].alias(str(i)) for i in range(width)]))
    counts: dict[str, list] = {}        # at most range partitions + columns rows
    for c, *part in sorted(values.groupBy("column_name", "part").agg(F.sum("value_count"), F.count(F.lit(1))).collect()):
        counts.setdefault(c, []).append(part)
    places = []
    for c, parts in counts.items():
        total, different = sum(n for _, n, _ in parts), sum(d for _, _, d in parts)
        for part, before in zip(parts, itertools.accumulate((n for _, n, _ in parts), initial=0)):
            places.append((c, part[0], before, total, different))
    if not places:
        return [np.empty(0)] * width
    t = rows.sparkSession.createDataFrame(places, "column_name string, part int, before long, total long, different long")
    w = Window.partitionBy("column_name", "part").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    v = values.join(F.broadcast(t), ["column_name", "part"]).withColumn("upto", F.col("before") + F.sum("value_count").over(w))
    # quantile i of b is the first value that i / b of the rows reach
    reached = v.where(F.expr(f"different <= {trees.BINS} OR "
                             f"({trees.BINS} * upto) div total > ({trees.BINS} * (upto - value_count)) div total"))
    found: dict[str, list] = {}
    for c, number in sorted(reached.select("column_name", "number").collect()):     # BINS a column
        found.setdefault(c, []).append(number)
    return [np.array(found.get(str(i), [])[:-1]) for i in range(width)]


BLOCKS = ("place long, fit_rows long, held_rows long, fit_bins binary, fit_products binary, held_bins binary, "
          "held_products binary, edges binary")


def binned_frame(frame: DataFrame, product_col: str = "pdm_prod_type_id") -> DataFrame:
    """A stored ``training_frame`` as blocks of neighbouring rows, an Arrow batch at most:
    bin numbers (by the edges of all rows that models are fitted on, which every block
    carries) and products, of fitted and of held-out rows."""
    first = frame.select(F.size("features")).first()
    width = first[0] if first else 0
    edges = quantile_edges(frame.where(~F.col("held_out")), width)
    kept = trees.packed({str(i): e for i, e in enumerate(edges)})

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = trees.binned(_matrix(batch.column(0), width), edges).astype(np.uint8)
            product = batch.column(1).cast(pa.int64()).fill_null(NO_PRODUCT).to_numpy()
            held, place = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()
            ends = [0, *(np.flatnonzero(np.diff(place) != 1) + 1).tolist(), len(place)]
            for lo, hi in itertools.pairwise(ends):
                h = held[lo:hi]
                row = {"place": int(place[lo]), "fit_rows": int((~h).sum()), "held_rows": int(h.sum()), "edges": kept}
                for name, some in (("fit", ~h), ("held", h)):
                    row[f"{name}_bins"] = bins[lo:hi][some].tobytes()
                    row[f"{name}_products"] = product[lo:hi][some].tobytes()
                yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema([(n, pa.int64() if k == "long" else pa.binary()) for n, k in (c.split() for c in BLOCKS.split(", "))])
    return frame.select("features", product_col, "held_out", "place").mapInArrow(work, BLOCKS)


def _fit_from_blocks(binned: DataFrame, products: list[int], params: dict, task_rows: int) -> DataFrame:
    """Trees of every product by a job, or a chain of jobs, of its own, side by side; then the
    held-out rows' scores and their calibration for all products at once."""
    spark = binned.sparkSession
    blocks = sorted(map(tuple, binned.select("place", "fit_rows", "held_rows").collect()))  # one a block of some 10,000 rows
    fit_rows, held_rows = sum(b[1] for b in blocks), sum(b[2] for b in blocks)
    some = binned.select("edges").first()
    if not some or not products:
        return spark.createDataFrame([], MODELS)
    kept = trees.unpacked(bytes(some[0]))
    edges = [kept[str(i)] for i in range(len(kept))]
    starts = spark.sparkContext.broadcast((np.array([b[0] for b in blocks]), np.cumsum([0, *(b[1] for b in blocks)])))
    rows = binned.where("fit_rows > 0").select("place", "fit_bins", "fit_products")
    positives = _positives(rows, products)

    def job(p):
        of = _blocks_of(p, len(edges), starts)
        if fit_rows <= task_rows:
            return lambda: _fit_here(rows, of, edges, fit_rows, positives[p], params)
        return lambda: _fit_spread(rows, of, edges, fit_rows, positives[p], params)

    workers = spark.sparkContext.defaultParallelism if fit_rows <= task_rows else SPREAD_FITS
    fits = side_by_side(spark, {p: job(p) for p in products}, workers)
    ends = calibration(held_scores(binned, fits, edges))
    return spark.createDataFrame([(p, fit_rows, held_rows, trees.packed(
        m | dict(zip(("boundaries", "predictions"), trees.steps(ends.get(p, [])))))) for p, m in sorted(fits.items())], MODELS)


def _positives(rows: DataFrame, products: list[int]) -> dict[int, int]:
    """Fitted rows of every product."""
    def work(batches):
        for batch in batches:
            for b in batch.column(0).to_pylist():
                p, n = np.unique(np.frombuffer(b, np.int64), return_counts=True)
                wanted = np.isin(p, products)
                yield pa.RecordBatch.from_arrays([pa.array(p[wanted]), pa.array(n[wanted])], ["product", "n"])

    counts = rows.select("fit_products").mapInArrow(work, "product long, n long").groupBy("product").agg(F.sum("n"))
    return dict.fromkeys(products, 0) | {p: int(n) for p, n in counts.collect()}


def _blocks_of(p: int, width: int, starts):
    """From stored blocks to those of ``fit_blocks``: (rows before, bins by column, target)."""
    def of(place, bins, product):
        places, before = starts.value
        return (int(before[np.searchsorted(places, place)]), np.frombuffer(bins, np.uint8).reshape(-1, width).T,
                np.frombuffer(product, np.int64) == p)
    return of


def _fit_here(rows: DataFrame, of, edges: list[np.ndarray], fit_rows: int, positives: int, params: dict) -> dict:
    """One task holds all blocks."""
    def work(batches):
        blocks = (of(*block) for batch in batches for block in zip(*(c.to_pylist() for c in batch.columns)))
        m = trees.fit_blocks(trees.Here(blocks), edges, fit_rows, positives, **params)
        yield pa.RecordBatch.from_arrays([pa.array([trees.packed(m)], pa.binary())], ["model"])

    return trees.unpacked(bytes(rows.coalesce(1).mapInArrow(work, "model binary").first()[0]))


def _fit_spread(rows: DataFrame, of, edges: list[np.ndarray], fit_rows: int, positives: int, params: dict) -> dict:
    held = Spread(rows, of, fit_rows)
    try:
        return trees.fit_blocks(held, edges, fit_rows, positives, **params)
    finally:
        held.close()


class Spread:
    """Rows of ``fit_blocks`` over all tasks: chunks are kept by Spark, each round's from the
    ones of the round before, and every level of a tree is a job that returns its counts. After
    ``CHECKPOINT_ROUNDS`` rounds the chunks are stored, so a lost executor costs that many."""

    def __init__(self, rows: DataFrame, of, fit_rows: int):
        self.parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-fit_rows // SPREAD_ROWS))
        self.rows, self.of, self.age, self.stored = rows.repartition(self.parts).rdd, of, 0, None
        self.spark = rows.sparkSession
        ensure_checkpoint_dir(self.spark)

    def start(self, margin: float) -> None:
        of = self.of
        self.chunks = self.rows.mapPartitions(
            lambda rows: trees.chunked((of(*r) for r in rows), margin, SPREAD_CHUNK_ROWS))

    def begin(self, r: trees.Round, before: tuple | None) -> None:
        def begun(c):
            for f, cut in before[0] if before else ():
                c.step(f, cut)
            if before:
                c.end(before[1])
            c.begin(r)
            return c

        old, self.round = self.chunks, r
        self.chunks = old.map(begun).persist(StorageLevel.MEMORY_AND_DISK)
        self.age += 1
        if self.age % CHECKPOINT_ROUNDS == 0:
            self.chunks.checkpoint()
        self.root = self._counted(None, [])
        old.unpersist()
        if self.age % CHECKPOINT_ROUNDS == 0:
            before, self.stored = self.stored, self.chunks.getCheckpointFile()
            if before:
                Files(self.spark, before).delete()

    def counts(self, light, path) -> np.ndarray:
        return self.root if light is None else self._counted(light, path)

    def _counted(self, light, path) -> np.ndarray:
        r = self.round

        def work(chunks):
            def at_level():
                for c in chunks:
                    for f, cut in path:
                        c.step(f, cut)
                    yield c
            yield r.counts(at_level(), light)

        # whole numbers in doubles: their sum is the same in any order
        return self.chunks.mapPartitions(work).treeReduce(np.add, 2 if self.parts > 64 else 1)

    def close(self) -> None:
        self.chunks.unpersist()
        if self.stored:
            Files(self.spark, self.stored).delete()


def held_scores(binned: DataFrame, models: dict[int, dict], edges: list[np.ndarray]) -> DataFrame:
    """(product, raw, positives, weight): the uncalibrated scores of the held-out rows."""
    data = binned.sparkSession.sparkContext.broadcast(
        [(p, trees.packed(trees.on_bins(m, edges))) for p, m in sorted(models.items())])
    width = len(edges)

    def work(batches):
        ready = [(p, trees.scorer(trees.unpacked(m))) for p, m in data.value]
        for batch in batches:
            for bins, product in zip(*(c.to_pylist() for c in batch.columns)):
                x, product = np.frombuffer(bins, np.uint8).reshape(-1, width), np.frombuffer(product, np.int64)
                for at in range(0, len(x), SCORE_ROWS):
                    part = x[at:at + SCORE_ROWS].astype(np.float64)
                    for p, score in ready:
                        raw = 1 / (1 + np.exp(-score(part)))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(part), p, np.int32)), pa.array(raw),
                             pa.array((product[at:at + SCORE_ROWS] == p).astype(np.int64)),
                             pa.array(np.ones(len(part), np.int64))],
                            ["product", "raw", "positives", "weight"])

    rows = binned.where("held_rows > 0").select("held_bins", "held_products")
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism * 4).mapInArrow(
        work, "product int, raw double, positives long, weight long")


def calibration(scores: DataFrame) -> dict[int, list[list[float]]]:
    """Blocks of the isotonic fit by product, from (product, raw, positives, weight) of any
    number of rows: equal scores are counted, each range of scores is pooled in a task, and
    what is left of the ranges (few blocks) is pooled here."""
    def work(batches):
        rows = itertools.chain.from_iterable(zip(*(c.to_pylist() for c in batch.columns)) for batch in batches)
        for p, some in itertools.groupby(rows, lambda r: r[0]):
            blocks = trees.pooled((total, weight, raw, raw) for _, raw, total, weight in some)
            total, weight, first, last = zip(*blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p] * len(blocks), pa.int32()), *(pa.array(c, pa.float64()) for c in (first, last, total, weight))],
                ["product", "first", "last", "total", "weight"])

    counted = scores.groupBy("product", "raw").agg(F.sum("positives").cast("double").alias("total"),
                                                   F.sum("weight").cast("double").alias("weight"))
    parts = counted.orderBy("product", "raw").mapInArrow(
        work, "product int, first double, last double, total double, weight double").collect()
    return {p: trees.pooled((total, weight, first, last) for _, first, last, total, weight in some)
            for p, some in itertools.groupby(sorted(map(tuple, parts)), lambda r: r[0])}


def score_frame(score: DataFrame, features: Sequence[str] = SCORING_FEATURES, key: str = "customer_id") -> DataFrame:
    """Key and imputed features (an array) of the rows to score."""
    x = impute_scoring(score, features, keep=(key,))
    return x.select(key, F.array(*[F.col(c).cast("double") for c in features]).alias("features"))


def score_batch(frame: DataFrame, models: DataFrame, products: Sequence[int], key: str = "customer_id") -> DataFrame:
    """ML-11: (key, p, pdm_prod_type_id) of a few products from one scan of a
    ``score_frame``. Their models (some 100 kB each) go to every task."""
    spark = frame.sparkSession
    rows = models.where(F.col("product").isin([int(p) for p in products])).select("product", "model").collect()
    data = spark.sparkContext.broadcast(sorted((r.product, bytes(r.model)) for r in rows))
    kind = frame.schema[key].dataType.simpleString()

    def work(batches):
        ready = [(p, m, trees.scorer(m)) for p, m in ((p, trees.unpacked(b)) for p, b in data.value)]
        for batch in batches:
            for at in range(0, batch.num_rows, SCORE_ROWS):
                part = batch.slice(at, SCORE_ROWS)
                x = _matrix(part.column(1), len(part.column(1)[0]))
                for p, m, score in ready:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(trees.probability(m, x, score=score), pa.float64()),
                         pa.array(np.full(len(x), p), pa.int32())], [key, "p", "pdm_prod_type_id"])

    return frame.select(key, "features").mapInArrow(work, f"{key} {kind}, p double, pdm_prod_type_id int")


def batches_of(products: Sequence[int], size: int = PRODUCTS_PER_BATCH) -> list[Sequence[int]]:
    return [products[i:i + size] for i in range(0, len(products), size)]


def score_long(score: DataFrame, models: DataFrame, products: Sequence[int], features: Sequence[str] = SCORING_FEATURES,
               key: str = "customer_id", path: str | None = None, batch: int = PRODUCTS_PER_BATCH) -> DataFrame:
    """ML-11 / SET-1: the long table (key, p, pdm_prod_type_id) under ``path``, one folder
    per batch of products; a batch that is run again replaces its own folder only."""
    spark = score.sparkSession
    path = path or scratch_path(spark, f"scores_{uuid.uuid4().hex[:12]}")
    frame = materialize(score_frame(score, features, key), "score_frame")
    for i, some in enumerate(batches_of(products, batch)):
        score_batch(frame, models, some, key).write.mode("overwrite").parquet(f"{path}/batch={i}")
    return spark.read.parquet(path).drop("batch")


def score_wide(long: DataFrame, products: Sequence[int], key: str = "customer_id", prefix: str = "p") -> DataFrame:
    """ML-12: calibrated probability of every product as columns ``p<id>`` next to the
    key, one pivot of the long table."""
    return pivot_wide(long, key, "pdm_prod_type_id", "p", products, prefix)


def pivot_wide(long: DataFrame, index: str, columns: str, values: str,
               column_values: Sequence, prefix: str = "p") -> DataFrame:
    """AGG-11 / FN-20: long -> wide with columns ``<prefix><value>``.

    The value list is given, so Spark skips its distinct-values job. Like the
    original, a duplicate (index, column) pair is an error: each cell also
    counts its rows and ``raise_error`` fires when a count exceeds one."""
    g = (long.groupBy(index).pivot(columns, list(column_values))
         .agg(F.first(values).alias("v"), F.count(F.lit(1)).alias("n")))
    out = [F.col(index)]
    for v in column_values:
        cell, n = F.col(f"`{v}_v`"), F.col(f"`{v}_n`")
        out.append(F.when(n > 1, F.raise_error(F.lit(f"duplicate entries for {columns}={v}")))
                   .otherwise(cell).alias(f"{prefix}{v}"))
    return g.select(*out)
