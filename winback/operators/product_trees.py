"""Boosted trees for one binary target, on a table inside a task (``fit``) or on rows that
several tasks hold in blocks (``fit_blocks``).

Second-order logistic boosting over quantile bins, as the original's boosting library
does it (``pyspark.ml`` boosts on first derivatives, with a dozen small jobs a round).
A tree is complete: ``2^depth - 1`` split nodes in level order and ``2^depth`` leaves; a
node that isn't split sends all its rows to the left. Values up to a node's threshold go
left. Models are plain arrays, so they are stored in a binary column of a table.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator, Sequence

import numpy as np

BINS = 64
LAMBDA = 1.0            # the original library's default penalty on leaf weights
MIN_CHILD_WEIGHT = 1.0  # and its least sum of second derivatives in a child
CHUNK_ROWS = 1 << 16    # rows of a block that are counted at once, which a core's cache holds
CELLS = 1 << 12         # bins of columns that are counted as one


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Inner edges per column: the values themselves where there are few, else quantiles."""
    edges = []
    for col in x.T:
        values = np.unique(col)
        if len(values) > bins:
            values = np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:], method="inverted_cdf"))
        edges.append(values[:-1])
    return edges


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, col, "left") for e, col in zip(edges, x.T)], axis=1).astype(np.int64)


def best_splits(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the best cut in (column, bin), whether to split) of every node, from the sums
    of first and second derivatives by (column, node, bin)."""
    k = g.shape[1]
    left = [np.cumsum(s, axis=2) for s in (g, h)]
    total = [s[:, :, -1:] for s in left]
    right = [a - c for a, c in zip(total, left)]
    gain = (left[0] ** 2 / (left[1] + LAMBDA) + right[0] ** 2 / (right[1] + LAMBDA)
            - total[0] ** 2 / (total[1] + LAMBDA))
    gain[(left[1] < MIN_CHILD_WEIGHT) | (right[1] < MIN_CHILD_WEIGHT)] = 0
    flat = gain.transpose(1, 0, 2).reshape(k, -1)
    best = flat.argmax(axis=1)
    return best, flat[np.arange(k), best] > 1e-9


def thresholds(edges: Sequence[np.ndarray], f: np.ndarray, cut: np.ndarray, split: np.ndarray) -> list[float]:
    return [edges[j][c] if s and c < len(edges[j]) else np.inf for j, c, s in zip(f, cut, split)]


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 1000, depth: int = 5, rate: float = 0.01, subsample: float = 0.9,
        colsample: float = 0.6, seed: int = 0) -> dict[str, np.ndarray]:
    """Trees for P(y = 1 | x). Equal gains go to the first column and lowest threshold."""
    rng = np.random.default_rng(seed)
    n, width = x.shape
    edges = bin_edges(x) if n else [np.empty(0)] * width
    b = binned(x, edges) if n else np.empty((0, width), np.int64)
    size = max((len(e) for e in edges), default=0) + 1
    share = float(np.clip(y.mean() if n else 0.5, 1e-6, 1 - 1e-6))
    start = np.log(share / (1 - share))
    margin = np.full(n, start)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feature = np.zeros((rounds, inner), np.int16)
    threshold = np.full((rounds, inner), np.inf, np.float64)
    value = np.zeros((rounds, leaves), np.float64)
    take = max(1, round(colsample * width))
    by_column = np.ascontiguousarray(b.T)       # a column's bins side by side
    every = np.arange(n)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        rows = np.nonzero(rng.random(n) < subsample)[0]
        cols = np.sort(rng.choice(width, take, replace=False))
        bt, gt, ht = by_column[cols][:, rows], g[rows], h[rows]
        whole = np.zeros(n, np.int64)
        for level in range(depth):
            k = 2 ** level
            node = whole[rows] * size
            sums = [np.empty((take, k, size)), np.empty((take, k, size))]
            for j in range(take):
                at = node + bt[j]
                for s, w in zip(sums, (gt, ht)):
                    s[j] = np.bincount(at, w, k * size).reshape(k, size)
            best, split = best_splits(*sums)
            f, cut = cols[best // size], np.where(split, best % size, size)
            first = k - 1
            feature[t, first:first + k] = f
            threshold[t, first:first + k] = thresholds(edges, f, cut, split)
            whole = 2 * whole + (by_column.ravel().take(f[whole] * n + every) > cut[whole])
        gs, hs = (np.bincount(whole[rows], w, leaves) for w in (gt, ht))
        value[t] = -rate * gs / (hs + LAMBDA)
        margin += value[t][whole]
    return {"feature": feature, "threshold": threshold, "value": value, "start": np.array([start])}


class Chunk:
    """Rows that are counted at once: bins by column, target, and of each run of rows the place
    of its first among all rows; then what a round keeps of them."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, runs: list[tuple[int, int]], start: float):
        self.bins, self.y, self.runs, self.n = bins, y, runs, len(y)
        self.margin = np.full(self.n, start)
        self.g = self.h = self.node = np.empty(0)
        self.joint: list[np.ndarray] = []

    def begin(self, r: Round) -> None:
        """Derivatives of the drawn rows (0 of the others) and the joint bins of each group of columns."""
        drawn = []
        for place, rows in self.runs:
            bits = np.random.PCG64()
            bits.state = r.state
            drawn.append(np.random.Generator(bits.advance(place)).random(rows))
        scale = (np.concatenate(drawn) < r.subsample) * r.unit
        p = np.negative(self.margin)
        np.exp(p, out=p)
        p += 1
        np.divide(1, p, out=p)
        self.g, self.h = (np.rint(d * scale) for d in (p - self.y, p * (1 - p)))
        self.joint = []
        for group in r.groups:
            joint = self.bins[group[0]].astype(np.uint16)
            for j in group[1:]:
                joint *= np.uint16(r.sizes[j])
                joint += self.bins[j]
            self.joint.append(joint)
        self.node = np.zeros(self.n, r.node_type)

    def step(self, f: np.ndarray, cut: np.ndarray) -> None:
        """Every row to its child in the next level."""
        at = (f * self.n).take(self.node)
        at += np.arange(self.n)
        right = self.bins.ravel().take(at) > cut.take(self.node)
        self.node <<= 1
        self.node |= right

    def end(self, value: np.ndarray) -> None:
        self.margin += value.take(self.node)

    def count(self, r: Round, light: np.ndarray | None, sums: list[np.ndarray]) -> None:
        """Adds both derivatives by (node, joint bin) over all rows, or those of the child
        ``light[i]`` of every node i of the level above."""
        rows, g, h = None, self.g, self.h
        if light is not None:
            wanted = np.zeros(2 * len(light), bool)
            wanted[2 * np.arange(len(light)) + light] = True
            rows = np.flatnonzero(wanted.take(self.node))
            parent = (self.node.take(rows) >> 1).astype(np.intp)
            g, h = g.take(rows), h.take(rows)
        for joint, m, s in zip(self.joint, r.cells, sums):
            at = joint.astype(np.intp) if rows is None else parent * m + joint.take(rows)
            for total, w in zip(s, (g, h)):
                total += np.bincount(at, w, len(total))


class Round:
    """What all rows of a round need: the state of the draws, the columns in groups that are
    counted as one (their bins multiply to at most ``most`` unless a column has more)."""

    def __init__(self, state: dict, subsample: float, unit: float, cols: Sequence[int], sizes: Sequence[int], most: int,
                 leaves: int):
        self.state, self.subsample, self.unit, self.sizes = state, subsample, unit, sizes
        self.cols, self.node_type = [int(c) for c in cols], np.min_scalar_type(leaves)
        groups: list[list] = []
        for j in sorted(self.cols, key=lambda j: -sizes[j]):
            room = next((g for g in groups if g[0] * sizes[j] <= most), None)
            if room:
                room[0] *= sizes[j]
                room[1].append(j)
            else:
                groups.append([sizes[j], [j]])
        self.cells, self.groups = [g[0] for g in groups], [g[1] for g in groups]

    def counts(self, chunks: Iterable[Chunk], light: np.ndarray | None) -> np.ndarray:
        """Sums of both derivatives by (column, node, bin) over the rows of ``chunks``."""
        nodes = 1 if light is None else len(light)
        sums = [np.zeros((2, nodes * m)) for m in self.cells]
        for c in chunks:
            c.count(self, light, sums)
        out = np.zeros((2, len(self.cols), nodes, max(self.sizes)))
        for group, s in zip(self.groups, sums):
            s = s.reshape(2, nodes, *(self.sizes[j] for j in group))
            for i, j in enumerate(group):
                others = tuple(2 + a for a in range(len(group)) if a != i)
                out[:, self.cols.index(j), :, :self.sizes[j]] = s.sum(axis=others)
        return out


class Here:
    """Rows of ``fit_blocks`` in this process."""

    def __init__(self, blocks: Iterable[tuple[int, np.ndarray, np.ndarray]], chunk_rows: int = CHUNK_ROWS):
        self.blocks, self.chunk_rows = blocks, chunk_rows

    def start(self, margin: float) -> None:
        self.chunks = list(chunked(self.blocks, margin, self.chunk_rows))
        self.blocks = ()

    def begin(self, r: Round, before: tuple | None) -> None:
        self.round = r
        for c in self.chunks:
            if before:
                c.step(*before[0][-1])
                c.end(before[1])
            c.begin(r)

    def counts(self, light: np.ndarray | None, path: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        for c in self.chunks if path else ():
            c.step(*path[-1])
        return self.round.counts(self.chunks, light)


def chunked(blocks: Iterable[tuple[int, np.ndarray, np.ndarray]], margin: float,
            rows: int = CHUNK_ROWS) -> Iterator[Chunk]:
    """Blocks (place of the first row among all, bins by column, target) joined to chunks of up
    to ``rows`` rows; a longer one is cut."""
    def chunk():
        return Chunk(np.concatenate([b for _, b, _ in some], axis=1), np.concatenate([y for _, _, y in some]),
                     [(place, len(y)) for place, _, y in some], margin)

    some, size = [], 0
    for first, all_bins, all_y in blocks:
        for i in range(0, len(all_y), rows):
            piece = first + i, all_bins[:, i:i + rows], all_y[i:i + rows]
            if some and size + len(piece[2]) > rows:
                yield chunk()
                some, size = [], 0
            some.append(piece)
            size += len(piece[2])
    if some:
        yield chunk()


def fit_blocks(held, edges: Sequence[np.ndarray], n: int, positives: int, rounds: int = 1000, depth: int = 5,
               rate: float = 0.01, subsample: float = 0.9, colsample: float = 0.6, seed: int = 0,
               cells: int = CELLS) -> dict[str, np.ndarray]:
    """``fit`` of ``n`` rows that ``held`` has (``Here`` or in many tasks) and counts.
    Derivatives are rounded to whole multiples of a power of two that is small enough for
    their sums to be exact, so neither the order of rows nor who counts them changes a
    tree, and of two children only the lighter one's rows are counted."""
    rng = np.random.default_rng(seed)
    width = len(edges)
    sizes = [len(e) + 1 for e in edges]
    size = max(sizes)
    unit = 2.0 ** (52 - int(n).bit_length())
    share = float(np.clip(positives / n if n else 0.5, 1e-6, 1 - 1e-6))
    start = np.log(share / (1 - share))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feature = np.zeros((rounds, inner), np.int16)
    threshold = np.full((rounds, inner), np.inf, np.float64)
    value = np.zeros((rounds, leaves), np.float64)
    take = max(1, round(colsample * width))
    held.start(start)
    tree = None
    for t in range(rounds):
        state = rng.bit_generator.state
        rng.bit_generator.advance(n)            # one draw a row
        rng.bit_generator.state |= {k: state[k] for k in ("has_uint32", "uinteger")}
        cols = np.sort(rng.choice(width, take, replace=False))
        held.begin(Round(state, subsample, unit, cols, sizes, cells, leaves), tree)
        sums, light, path = None, None, []
        for level in range(depth):
            k = 2 ** level
            counted = held.counts(light, path)
            if level:
                every = np.empty((2, take, k, size))
                at = 2 * np.arange(k // 2)
                every[:, :, at + light] = counted
                every[:, :, at + 1 - light] = sums - counted
                sums = every
            else:
                sums = counted
            best, split = best_splits(*(sums / unit))
            column, cut = best // size, np.where(split, best % size, size)
            f, first = cols[column], k - 1
            feature[t, first:first + k] = f
            threshold[t, first:first + k] = thresholds(edges, f, cut, split)
            path.append((f, cut))
            upto = np.cumsum(sums[:, column, np.arange(k)], axis=2)
            left = upto[:, np.arange(k), np.minimum(cut, size - 1)]
            children = np.stack([left, upto[:, :, -1] - left], axis=2)      # derivative, node, side
            light = np.where(children[1, :, 0] <= children[1, :, 1], 0, 1)
        gs, hs = children.reshape(2, leaves) / unit
        value[t] = -rate * gs / (hs + LAMBDA)
        tree = path, value[t]
    return {"feature": feature, "threshold": threshold, "value": value, "start": np.array([start])}


def on_bins(model: dict[str, np.ndarray], edges: Sequence[np.ndarray]) -> dict[str, np.ndarray]:
    """The model with thresholds as bins, for rows of bins."""
    bins = np.full(model["threshold"].shape, np.inf)
    for j, e in enumerate(edges):
        at = (model["feature"] == j) & np.isfinite(model["threshold"])
        bins[at] = np.searchsorted(e, model["threshold"][at], "left")
    return model | {"threshold": bins}


def walked(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Log-odds of the rows of ``x``, level by level, for trees of any depth."""
    out = np.full(len(x), float(model["start"][0]))
    rows = np.arange(len(x))
    inner = model["feature"].shape[1]
    for feature, threshold, value in zip(model["feature"], model["threshold"], model["value"]):
        node = np.zeros(len(x), np.int64)
        while len(node) and node[0] < inner:        # all rows are on the same level
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        out += value[node - inner]
    return out


# Place of the lowest set bit of a 32-bit number: (bit * DEBRUIJN mod 2^32) >> 27 is one of 32 codes.
DEBRUIJN = np.uint32(0x077CB531)
CODE_OF_BIT = np.array([((1 << i) * 0x077CB531 & 0xFFFFFFFF) >> 27 for i in range(32)])


def scorer(model: dict[str, np.ndarray]):
    """The function from rows to their log-odds. For trees of up to 32 leaves each column's
    step between a model's thresholds gives a tree's set of leaves that it leaves open; the
    first leaf that all columns leave open is the row's. Same leaves, added in the same order,
    as by walking the nodes."""
    feature, threshold, value = model["feature"], model["threshold"], model["value"]
    trees, inner = feature.shape
    leaves = inner + 1
    if leaves > 32:
        return lambda x: walked(model, x)
    # leaves under the left child of each node, which a step to the right closes
    closed = np.zeros(inner, np.uint32)
    for node in range(inner):
        level = (node + 1).bit_length() - 1
        span = leaves >> level
        first = (node + 1 - (1 << level)) * span
        closed[node] = sum(1 << i for i in range(first, first + span // 2))
    steps, tables, used = {}, {}, [[] for _ in range(trees)]
    for f in np.unique(feature[np.isfinite(threshold)]).tolist():
        tree, node = np.nonzero((feature == f) & np.isfinite(threshold))
        at = threshold[tree, node]
        steps[f] = np.unique(at)
        open_ = np.full((trees, len(steps[f]) + 1), 0xFFFFFFFF, np.uint32)
        np.bitwise_and.at(open_, (tree, np.searchsorted(steps[f], at) + 1), ~closed[node])
        tables[f] = np.bitwise_and.accumulate(open_, axis=1)
        for t in np.unique(tree).tolist():
            used[t].append(f)
    coded = np.zeros((trees, 32))
    coded[:, CODE_OF_BIT[:leaves]] = value

    def score(x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), float(model["start"][0]))
        step = {f: np.where(np.isnan(x[:, f]), 0, np.searchsorted(s, x[:, f], "left")) for f, s in steps.items()}
        some, left = np.empty(len(x), np.uint32), np.empty(len(x), np.uint32)
        for t in range(trees):
            left.fill(0xFFFFFFFF)
            for f in used[t]:
                np.take(tables[f][t], step[f], out=some, mode="clip")
                np.bitwise_and(left, some, out=left)
            np.bitwise_and(left, -left, out=left)
            np.multiply(left, DEBRUIJN, out=left)
            out += coded[t].take(left >> np.uint32(27), mode="clip")
        return out

    return score


def margins(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Log-odds of the rows of ``x``."""
    return scorer(model)(x)


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(boundaries, predictions): the non-decreasing step fit of ``y`` on ``score``, equal
    scores pooled; predictions between boundaries are interpolated."""
    s, at = np.unique(score, return_inverse=True)
    return steps(pooled(zip(np.bincount(at, y), np.bincount(at).astype(float), s, s)))


def pooled(parts: Iterable[tuple[float, float, float, float]]) -> list[list[float]]:
    """Parts (sum, weight, first score, last score) in the order of scores, neighbours pooled
    until their means rise. Parts that were pooled piece by piece give the same blocks."""
    blocks: list[list[float]] = []
    for part in parts:
        blocks.append([*part])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, weight, _, last = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += weight
            blocks[-1][3] = last
    return blocks


def steps(blocks: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """(boundaries, predictions) of pooled blocks."""
    if not blocks:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    ends = [(score, b[0] / b[1]) for b in blocks for score in dict.fromkeys(b[2:])]
    return np.array([e[0] for e in ends]), np.array([e[1] for e in ends])


def probability(model: dict[str, np.ndarray], x: np.ndarray, calibrated: bool = True, score=None) -> np.ndarray:
    """``score``: the model's ``scorer``, if there is one already."""
    p = 1 / (1 + np.exp(-(score or scorer(model))(x)))
    return np.interp(p, model["boundaries"], model["predictions"]) if calibrated else p


def packed(model: dict[str, np.ndarray]) -> bytes:
    f = io.BytesIO()
    np.savez_compressed(f, **model)
    return f.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as f:
        return dict(f)
