"""Operator 1, LM scoring: prediction by partial matching over bytes.

Training counts every (context, next byte) of up to ``order`` preceding bytes in
one pass and keeps all of them. Each task cuts its texts into chunks and sends the
distinct longest grams of a chunk, packed nine bits a symbol into one long, with
their counts to hash blocks of grams, where counts are summed over the corpus. The
sums are dealt again by the last ``SPLIT`` bytes of their contexts, so a block
holds every order from there on whole; the orders below are marginals with at most
257 ** SPLIT grams, bounded by the alphabet, and go to every block. There each
distinct gram gets its log probability once; a second join by gram block hands a
chunk those of its grams, and its texts add them up. No table of all contexts is
held in one place. ``share`` above 0 asks for a smaller model: contexts that hold
less than that share of all positions go to the escape.

A byte's probability starts at the longest known context. A symbol seen there has
(count - 1/2) / n, with n the context's count, and the halves taken from its q
symbols are the escape estimate, q / 2n (method D); the escape mass goes to the context one shorter, where all symbols of the longer
one are excluded, down to a uniform choice among symbols never seen at order 0.
Exclusion needs no set per byte: the symbols of a context are also symbols of the
shorter one, so a node stores how much of its parent's count they hold. The
probability then depends on the last ``order + 1`` bytes alone.

A text's score is the log10 probability of its bytes (A-Z lower-cased) and one
end symbol. Beside it stands a word unigram base. Frequent words (at least
``WORD_SHARE`` of all tokens, so a bounded number) are broadcast, the others are joined.

Defined results. Null text counts as empty: one end. The table may be empty
(no rows), or without training rows (every symbol is uniform over 257). Repeated
ids and rows are scored each for itself; a null id trains and is scored as a text
that is not held out. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.common import bounded_batches, release, shuffle_blocks, stored, trim
from winback.llm.wordtokens import batches

ORDER = 5
SHARE = 0.0                 # every counted context is kept
WORD_SHARE = 2.0 ** -22     # words that are broadcast; the others are joined
SPLIT = 3                   # context bytes by which counts are dealt
FOLDS, HELD_OUT = 5, 1
BITS = 9                    # a symbol: byte, END or PAD
END, PAD = 256, 257
SYMBOLS = 257               # bytes and END can be predicted
FLUSH_GRAMS = 800_000
FLUSH_WORDS = 400_000
RUN_BYTES = 1_000_000       # texts handled together
CHUNK_BYTES = 32_000_000    # texts that ask for their grams together
DOCS_PER_BLOCK = 1_000


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed gram of every position (bytes and end) of every text, and the
    first position of each text. The predicted symbol is in the lowest bits."""
    lens = np.array([len(t) for t in texts], np.int64)
    total = int(lens.sum()) + (order + 1) * len(texts)
    sym = np.full(total + order, PAD, np.uint64)
    first = order + np.cumsum(lens + order + 1) - lens - 1      # where each text begins
    data = np.frombuffer(b"".join(texts), np.uint8)
    own = np.ones(total + order, bool)
    own[:order] = False
    shift = np.repeat(first - (np.cumsum(lens) - lens), lens)
    at = np.arange(len(data)) + shift
    sym[at] = data
    sym[first + lens] = END
    real = np.zeros(total + order, bool)
    real[at] = True
    real[first + lens] = True
    g = sym.copy()
    for j in range(1, order + 1):
        g[order:] |= sym[order - j: len(sym) - j] << np.uint64(BITS * j)
    return g[real], np.cumsum(lens + 1) - lens - 1


class GramCounter:
    """Counts of packed grams, merged by sorting."""

    def __init__(self):
        self.parts: list = []
        self.size = 0

    def add(self, g: np.ndarray, weight: int = 1):
        k, c = np.unique(g, return_counts=True)
        self.parts.append((k, c * weight))
        self.size += len(k)
        if self.size > FLUSH_GRAMS and len(self.parts) > 1:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])

    def merged(self):
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        k = np.concatenate([p[0] for p in self.parts])
        c = np.concatenate([p[1] for p in self.parts])
        return _summed(k, c)

    def clear(self):
        self.parts, self.size = [], 0


def tokens(text: bytes) -> list[bytes]:
    """Words of a lower-cased text."""
    return text.split()


def _low(symbols: int) -> np.uint64:
    """Mask of the last symbols of a gram."""
    return np.uint64((1 << (BITS * symbols)) - 1)


def _by_block(keys: np.ndarray, blocks: int):
    """(block, indices in order) of hashed keys."""
    h = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    b = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    order = np.argsort(b, kind="stable")
    b = b[order]
    starts = np.nonzero(np.concatenate([[True], b[1:] != b[:-1]]))[0] if len(b) else []
    for s, e in zip(starts, [*starts[1:], len(b)]):
        yield int(b[s]), order[s:e]


def _summed(keys: np.ndarray, counts: np.ndarray):
    """Sorted distinct keys and the sums of their counts."""
    by = np.argsort(keys, kind="stable")
    k, c = keys[by], counts[by]
    start = np.nonzero(np.concatenate([[True], k[1:] != k[:-1]]))[0] if len(k) else np.zeros(0, np.int64)
    return k[start], np.add.reduceat(c, start) if len(k) else c


def _joined(column, kind) -> np.ndarray:
    parts = [np.frombuffer(x.as_py(), kind) for x in column]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


_PART = "chunk string, doc_ids array<{}>, sizes binary, texts binary, word binary, n long, block int, keys binary, counts binary"


def _parts(docs: DataFrame, order: int, blocks: int) -> DataFrame:
    """Rows of three kinds. Texts (``texts`` set): runs of lower-cased
    texts of a chunk, joined and compressed, with their ids and sizes.
    Words (``word`` set): training counts; the empty word is the end. Grams
    (``block`` set): packed distinct longest grams of a chunk and their training
    counts, 0 for grams of held-out texts only."""
    schema = _PART.format(docs.schema["doc_id"].dataType.simpleString())
    names = [f.split()[0] for f in schema.split(", ")]

    def count(batch_iter):
        seen, words, chunk, size = GramCounter(), Counter(), uuid.uuid4().hex, 0
        kinds = dict(zip(names, [pa.string(), None, pa.binary(), pa.binary(), pa.binary(), pa.int64(),
                                 pa.int32(), pa.binary(), pa.binary()]))
        packer = zstandard.ZstdCompressor(level=3)

        def rows(n, /, **columns):
            return pa.RecordBatch.from_arrays(
                [columns[k] if isinstance(columns.get(k), pa.Array) else
                 pa.array(columns[k], kinds[k]) if k in columns else pa.nulls(n, kinds[k]) for k in names], names)

        def flush_words():
            b = rows(len(words), word=list(words.keys()), n=list(words.values()))
            words.clear()
            return b

        def flush_grams():
            k, c = seen.merged()
            seen.clear()
            got = [(b, k[i].tobytes(), c[i].astype(np.int64).tobytes()) for b, i in _by_block(k, blocks)]
            for i in range(0, len(got), 500):
                b, x, y = zip(*got[i:i + 500])
                yield rows(len(b), chunk=[chunk] * len(b), block=b, keys=x, counts=y)

        for batch in batch_iter:
            ids = batch.column(0)
            kinds["doc_ids"] = pa.list_(ids.type)
            for first, texts in batches(batch.column(1), RUN_BYTES):
                own = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
                held = [held_out(ids[first + i].as_py()) for i in range(len(own))]
                sizes = np.array([len(t) for t in own], np.int64)
                yield rows(1, chunk=[chunk], sizes=[sizes.tobytes()], texts=[packer.compress(b"".join(own))],
                           doc_ids=pa.ListArray.from_arrays([0, len(own)], ids.slice(first, len(own))))
                size += int(sizes.sum())
                train = [t for t, h in zip(own, held) if not h]
                if train:
                    seen.add(grams(train, order)[0])
                    for t in train:
                        words.update(tokens(t))
                    words[b""] += len(train)
                if len(train) < len(own):
                    seen.add(grams([t for t, h in zip(own, held) if h], order)[0], 0)
                if len(words) > FLUSH_WORDS:
                    yield flush_words()
                if seen.size > FLUSH_GRAMS or size > CHUNK_BYTES:
                    yield from flush_grams()
                    trim()
                    chunk, size = uuid.uuid4().hex, 0
        if kinds["doc_ids"] is not None:
            yield flush_words()
            yield from flush_grams()
            trim()

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(count, schema)


def _counts(parts: DataFrame, order: int, blocks: int) -> DataFrame:
    """(block, keys, counts): the counts of every distinct gram over the corpus,
    dealt by the last ``SPLIT`` symbols of its context."""
    split = min(order, SPLIT)

    def total(table: pa.Table) -> pa.Table:
        trim()                                          # of the group before
        k, c = _summed(_joined(table["keys"], np.uint64), _joined(table["counts"], np.int64))
        got = [(b, k[i].tobytes(), c[i].tobytes())
               for b, i in _by_block((k >> np.uint64(BITS)) & _low(split), blocks)]
        b, x, y = zip(*got)
        return pa.table({"block": pa.array(b, pa.int32()), "keys": pa.array(x, pa.binary()),
                         "counts": pa.array(y, pa.binary())})

    return (parts.where("block is not null").select("block", "keys", "counts").groupBy("block")
            .applyInArrow(total, "block int, keys binary, counts binary"))


def _lower_orders(counts: DataFrame, order: int):
    """Sorted grams and counts of the orders below the split: at most 257 ** SPLIT."""
    split = min(order, SPLIT)
    if not split:
        return [], []

    def marginal(batch_iter):
        for t in batch_iter:
            k, c = _joined(t.column(0), np.uint64), _joined(t.column(1), np.int64)
            k, c = _summed((k & _low(split))[c > 0], c[c > 0])
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(c)], ["key", "n"])

    got = (counts.select("keys", "counts").mapInArrow(marginal, "key long, n long")
           .groupBy("key").agg(F.sum("n").alias("n")).toArrow())
    k, c = got.column("key").to_numpy().astype(np.uint64), got.column("n").to_numpy().astype(np.int64)
    levels = [_summed(k & _low(i + 1), c) for i in range(split)]
    return [x for x, _ in levels], [x for _, x in levels]


def _prices(counts: DataFrame, low, order: int, blocks: int, share: float) -> DataFrame:
    """(block, keys, logs): the log10 probability of every distinct gram, by gram block."""
    split = min(order, SPLIT)

    def price(table: pa.Table) -> pa.Table:
        trim()
        k, c = _joined(table["keys"], np.uint64), _joined(table["counts"], np.int64)
        keys, ns = map(list, low.value)
        for i in range(split, order + 1):
            x, n = _summed((k & _low(i + 1))[c > 0], c[c > 0])
            keys.append(x)
            ns.append(n)
        total = int(ns[0].sum())
        v = Trie(keys, ns, None, total, total * share).log10(k)
        b, x, y = zip(*((b, k[i].tobytes(), v[i].tobytes()) for b, i in _by_block(k, blocks)))
        return pa.table({"block": pa.array(b, pa.int32()), "keys": pa.array(x, pa.binary()),
                         "logs": pa.array(y, pa.binary())})

    return counts.groupBy("block").applyInArrow(price, "block int, keys binary, logs binary")


def _answers(parts: DataFrame, prices: DataFrame) -> DataFrame:
    """(chunk, keys, logs): every chunk's grams with their log probabilities."""
    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        trim()
        k, v = _joined(known["keys"], np.uint64), _joined(known["logs"], np.float64)
        by = np.argsort(k)
        k, v = k[by], v[by]
        del known, by
        logs = [v[np.searchsorted(k, np.frombuffer(x.as_py(), np.uint64))].tobytes() for x in asked["keys"]]
        return pa.table({"chunk": asked["chunk"], "keys": asked["keys"], "logs": pa.array(logs, pa.binary())})

    return (parts.where("block is not null").select("block", "chunk", "keys").groupBy("block")
            .cogroup(prices.groupBy("block")).applyInArrow(answer, "chunk string, keys binary, logs binary"))


class Trie:
    """Byte-context trie in sorted arrays, one set per order."""

    def __init__(self, keys: list[np.ndarray], counts: list[np.ndarray],
                 docs: int | None, total: int, floor: float = 0.0):
        """keys[k], counts[k]: grams of k + 1 symbols, sorted, with all grams of
        each of their contexts; ``docs``: texts seen (not needed: a context's
        count is the sum of its grams); ``total``: positions seen. Grams counted
        less than ``floor`` times go to the escape."""
        self.order = len(keys) - 1
        self.keys, self.counts = [], []
        self.ctx, self.n, self.q, self.kept, self.excl = [], [], [], [], []
        one = np.uint64(BITS)
        for k, (key, c) in enumerate(zip(keys, counts)):
            ctx, n = _summed(key >> one, c)
            key, c = key[c >= floor], c[c >= floor]
            known, start, q = np.unique(key >> one, return_index=True, return_counts=True)
            n = n[np.searchsorted(ctx, known)]
            kept = np.add.reduceat(c, start) if len(key) else np.zeros(0, np.int64)
            excl = np.zeros(len(known), np.int64)
            if k and len(key):
                at, hit = self._find(self.keys[k - 1], key & _low(k))
                excl = np.add.reduceat(np.where(hit, self.counts[k - 1][at], 0), start)
            self.keys.append(key)
            self.counts.append(c)
            self.ctx.append(known)
            self.n.append(n)
            self.q.append(q.astype(np.int64))
            self.kept.append(kept)
            self.excl.append(excl)

    @staticmethod
    def _find(table: np.ndarray, want: np.ndarray):
        if not len(table):
            return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
        at = np.minimum(np.searchsorted(table, want), len(table) - 1)
        return at, table[at] == want

    def log10(self, g: np.ndarray) -> np.ndarray:
        """log10 probability of the lowest symbol of each gram after the others."""
        out = np.zeros(len(g))
        live = np.arange(len(g))
        used = np.zeros(len(g), np.int64)       # count of excluded symbols at this order
        gone = np.zeros(len(g), np.int64)       # how many symbols are excluded
        for k in range(self.order, -1, -1):
            if not len(live):
                break
            low = g[live] & np.uint64((1 << (BITS * (k + 1))) - 1)
            ci, known = self._find(self.ctx[k], low >> np.uint64(BITS))
            si, seen = self._find(self.keys[k], low)
            seen &= known
            if not known.any():
                continue
            n, q = self.n[k][ci] - used[live], self.q[k][ci] - gone[live]
            rest = self.n[k][ci] - self.kept[k][ci]             # lost to pruning
            full = (k == 0) & (self.q[k][ci] >= SYMBOLS)        # nothing is left to escape to
            escape = np.where(full, 0.0, rest + 0.5 * q)
            whole = np.where(full, n - rest, n)
            ok = known & (whole > 0)
            hit = ok & seen
            c = self.counts[k][si[hit]]
            out[live[hit]] += np.log10((c - np.where(full[hit], 0.0, 0.5)) / whole[hit])
            esc = ok & ~seen & (escape > 0)
            out[live[esc]] += np.log10(escape[esc] / whole[esc])
            used[live] = np.where(known, self.excl[k][ci], used[live])
            gone[live] = np.where(known, self.q[k][ci], gone[live])
            live = live[~hit]
        out[live] -= np.log10(np.maximum(SYMBOLS - gone[live], 1))
        return out


class Known:
    """Log probabilities of a chunk's grams."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        by = np.argsort(keys)
        self.logs = logs[by]
        del logs
        self.keys = keys[by]

    def log10(self, g: np.ndarray) -> np.ndarray:
        return self.logs[np.searchsorted(self.keys, g)]


class GramCache:
    """Scores of grams that a worker has met, in two fixed tables of ``1 << bits``
    slots; a gram that finds both its slots taken is looked up again. ``trie``: what has all scores."""

    def __init__(self, trie: Trie | Known | None = None, bits: int = 20):
        self.trie, self.drop = trie, np.uint64(64 - bits)
        self.mult = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
        none = np.uint64(0xFFFFFFFFFFFFFFFF)
        self.keys = [np.full(1 << bits, none), np.full(1 << bits, none)]
        self.vals = [np.zeros(1 << bits), np.zeros(1 << bits)]
        self.none = none

    def log10(self, g: np.ndarray) -> np.ndarray:
        slot = (g * self.mult[0]) >> self.drop
        out = self.vals[0][slot]
        miss = np.nonzero(self.keys[0][slot] != g)[0]
        if not len(miss):
            return out
        m = g[miss]
        slot = (m * self.mult[1]) >> self.drop
        out[miss] = self.vals[1][slot]
        far = self.keys[1][slot] != m
        miss, m = miss[far], m[far]
        if len(m):
            u, inverse = np.unique(m, return_inverse=True)
            v = self.trie.log10(u)
            out[miss] = v[inverse]
            for i in (0, 1):
                slot = (u * self.mult[i]) >> self.drop
                free = self.keys[i][slot] == self.none if i == 0 else np.ones(len(u), bool)
                self.keys[i][slot[free]] = u[free]
                # of grams that share a slot the last key and the last value stay
                self.vals[i][slot[free]] = v[free]
                u, v = u[~free], v[~free]
        return out


_LOADED: dict = {}          # in a worker process: the model it used last


def _loaded(key: str, head):
    """(gram cache, log counts of common words), built once per worker process."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = (GramCache(), {w: math.log10(c + 0.5) for w, c in head.value.items()})
    return _LOADED[key]


def score(docs: DataFrame, order: int = ORDER, share: float = SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    n_bytes of every text; log10 units."""
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = shuffle_blocks(spark, docs.count(), DOCS_PER_BLOCK)
    parts = stored(_parts(docs, order, blocks), "ppm_parts")
    words = stored(parts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "ppm_words")
    n_train, v = words.agg(F.sum("n"), F.count("*")).first()
    n_train = n_train or 0
    denominator = n_train + 0.5 * (v + 1)
    common = {bytes(r.word): r.n for r in words.where(F.col("n") >= F.lit(n_train * WORD_SHARE)).collect()}
    common.setdefault(b"", 0)
    head = spark.sparkContext.broadcast(common)
    counts = stored(_counts(parts, order, blocks), "ppm_counts")
    low = spark.sparkContext.broadcast(_lower_orders(counts, order))
    prices = stored(_prices(counts, low, order, blocks, share), "ppm_prices")
    release(counts)
    answers = stored(_answers(parts, prices), "ppm_answers")
    release(prices)
    key = uuid.uuid4().hex

    def work(runs: pa.Table, known: pa.Table) -> pa.Table:
        cache, logs = _loaded(key, head)
        cache.trie = None                               # the chunk before
        trim()
        cache.trie = Known(_joined(known["keys"], np.uint64), _joined(known["logs"], np.float64))
        del known
        ends = head.value[b""]
        unpacker, out = zstandard.ZstdDecompressor(), []
        for ids, sizes, packed in zip(runs["doc_ids"], runs["sizes"], runs["texts"]):
            data, ends_at = unpacker.decompress(packed.as_py()), np.cumsum(np.frombuffer(sizes.as_py(), np.int64))
            own = [data[a:b] for a, b in zip([0, *ends_at[:-1].tolist()], ends_at.tolist())]
            g, start = grams(own, order)
            scores = np.add.reduceat(cache.log10(g), start)
            n_tok, n_known, base, rare, rare_n = [], [], [], [], []
            for t in own:
                seen = Counter(tokens(t))
                know, s, rw, rn = (1 if ends else 0), logs[b""] if ends else 0.0, [], []
                for w, c in seen.items():
                    x = logs.get(w)
                    if x is None:
                        rw.append(w)
                        rn.append(c)
                    else:
                        know += c
                        s += c * x
                n_tok.append(sum(seen.values()) + 1)
                n_known.append(know)
                base.append(s)
                rare.append(rw)
                rare_n.append(rn)
            out.append(pa.table({
                "doc_id": ids.values, "held_out": pa.array([held_out(i.as_py()) for i in ids.values], pa.bool_()),
                "n_bytes": pa.array([len(t) for t in own], pa.int64()),
                "n_tokens": pa.array(n_tok, pa.int64()), "known": pa.array(n_known, pa.int64()),
                "base": pa.array(base, pa.float64()), "score": pa.array(scores, pa.float64()),
                "rare": pa.array(rare, pa.list_(pa.binary())), "rare_n": pa.array(rare_n, pa.list_(pa.int64()))}))
        return pa.concat_tables(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stored(
        parts.where("texts is not null").select("chunk", "doc_ids", "sizes", "texts").groupBy("chunk")
        .cogroup(answers.groupBy("chunk")).applyInArrow(
            work, f"doc_id {kind}, held_out boolean, n_bytes long, n_tokens long, known long, base double, "
                  "score double, rare array<binary>, rare_n array<long>")
        .withColumn("_row", F.monotonically_increasing_id()), "ppm_scores")
    release(parts, answers)
    # rare words: found through a join with the counted words
    rare = (scored.select("_row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x"))
            .select("_row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("k")))
    found = (rare.join(words.where(F.col("word") != F.lit(b"")), "word")
             .groupBy("_row").agg(F.sum("k").alias("_k"), F.sum(F.col("k") * F.log10(F.col("n") + 0.5)).alias("_s")))
    known = F.col("known") + F.coalesce("_k", F.lit(0))
    none = math.log10(0.5)
    return (scored.drop("rare", "rare_n").join(found, "_row", "left")
            .select("doc_id", "held_out", "n_tokens", known.alias("n_known"),
                    F.lit(n_train).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("_s", F.lit(0.0)) + (F.col("n_tokens") - known) * none
                     - F.col("n_tokens") * math.log10(denominator)).alias("base_score"),
                    "score", "n_bytes"))
