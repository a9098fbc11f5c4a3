"""Hard negatives against all inner products: real, clustered, hot and hard vectors."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from winback.llm import hard_negatives as n

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=50, k=5, m=3):
    d = []
    for i, x, label in rows:
        if i is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        d.append((i, [math.floor(256 * float(np.float32(v))) for v in x], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for j, (i, q, label) in enumerate(d):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, x)), o, other, e) for e, (o, x, other) in enumerate(d))
        for s, p, *_ in [x for x in scored if x[2] == label and x[3] != j][:k]:
            inside = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:m]
            out += [(i, p, r + 1, x[1], -s, -x[0]) for r, x in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, **kw):
    got = n.mine(spark.createDataFrame([(*r, "clash", None) for r in rows], SCHEMA), **kw)
    assert got.columns == NAMES
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("chunk_rows", [n.CHUNK_ROWS, 3])
def test_real_vectors(spark, sf_dir, chunk_rows):
    d = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [tuple(r) for r in d.select("vec_id", "embedding", "label").collect()]
    got = sorted(map(tuple, n.mine(d, every=10, chunk_rows=chunk_rows).collect()))
    assert got == brute(rows, every=10) and len(got) > 0


def test_hot_copies_ties_and_clusters(spark):
    r = np.random.default_rng(2)
    centers = r.normal(size=(6, 12))
    rows = []
    for i in range(1500):
        c = int(r.integers(6))
        x = centers[c] + 0.15 * r.normal(size=12)
        rows.append((i, [float(np.float32(v)) for v in x / np.linalg.norm(x)], c if r.random() < 0.7 else int(r.integers(10))))
    hot = rows[3][1]
    rows += [(2000 + i, hot, i % 2) for i in range(700)] + [(50, rows[50][1], rows[50][2])] * 2 + [(100, hot, 3)] * 2
    random.Random(1).shuffle(rows)
    assert mined(spark, rows, every=50) == brute(rows)


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 0.0], 1), (50, None, 1), (50, [1.0, 0.0], None), (100, [1.0, None], 2), (150, [1.0, nan], 1),
            (200, [inf, 1.0], 1), (250, [], 1), (251, [], 1), (300, [0.0, 0.0], 2), (301, [0.0], 2), (302, [0.5], 3),
            (400, [1.0, 1.0, 1.0], 4), (401, [1.0, 1.0], 4), (402, [0.9, 0.3], 5), (403, [0.6, 0.6, 0.1], 6),
            (450, [-1.0, -1.0], 4), (500, [0.8, 0.7], 4), (500, [0.8, 0.7], 4), (0, [0.8, 0.7], 3), (7, [0.5, 0.4], 3)]
    assert mined(spark, rows) == brute(rows)
    wide = [(i, [float(np.float32(v * 2.0 ** 21)) for v in x], label) for i, x, label in
            [(0, [1.1, 0.3], 0), (1, [1.0, 0.4], 1), (2, [0.7, 0.1], 2), (3, [0.5, 0.5], 3), (8, [0.9, 0.2], 1), (50, [1.0, 0.3], 1)]]
    assert mined(spark, wide) == brute(wide) and brute(wide)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == []


def test_walks_end_early_on_clustered_vectors():
    r = np.random.default_rng(0)
    centers = r.normal(size=(40, 32))
    x = np.repeat(centers, 200, axis=0) + 0.05 * r.normal(size=(8000, 32))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    ids = np.arange(8000)
    label = ids // 200
    own = ids % 50 == 0
    a = n.Anchors(pa.table({"row": ids[own], "vec_id": ids[own], "label": label[own], "q": list(x[own])}), 32, False)
    walk = n.PositiveWalk(a, 5)
    computed = n.walk_block(walk, a, x, label, ids, ids)
    assert computed < 0.25 * own.sum() * 8000
    assert (walk.best.score[:, -1] != n.NONE).all()
