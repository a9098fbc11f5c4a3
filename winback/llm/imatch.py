"""Operator 8, document fingerprints: I-Match over randomised lexicon subsets.

The lexicon keeps terms whose document frequency lies in a band: rarer terms are
often typing errors, commoner ones say nothing. At most (mean distinct terms of
a document) / ``min_share`` terms reach the lower bound, at any corpus size. A
document's distinct lexicon terms are sorted and hashed several times, each time
only those in a random subset of the lexicon. Subsets keep one term in 2^s; a
document uses the two scales next to the number of its lexicon terms, so a subset
holds about one or two of them and a few changed terms leave many subsets alone.

A fingerprint is ``scale:hash...`` (8 hex digits per subset, zeros: no term in
it). The likeness of two fingerprints is the share of equal hashes among the
subsets of the scales they have in common in which either has a term; equal
fingerprints have likeness 1.

Defined results. Null text counts as empty: no terms, and its fingerprint equals
that of any text without words. Texts without a lexicon term use all their
distinct terms. Equal texts have equal fingerprints. An empty table gives an
empty result. Null ids and repeated ids keep their rows; null ids sort last in
``edit_pairs``, ties by text. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.common import bounded_batches, freeing, shuffle_blocks, text_of
from winback.llm.wordtokens import batches

MIN_SHARE = 2.0 ** -11      # of documents that hold a lexicon term
MAX_SHARE = 2.0 ** -3
SUBSETS = 32                # per scale
SCALES = 2
FLUSH_TERMS = 500_000
BLOCK_ROWS = 20_000         # documents sorted together in ``edit_pairs``


def terms(text: str) -> set[bytes]:
    """Distinct words, A-Z lower-cased."""
    return set(text.encode("utf-8", "surrogatepass").lower().split())


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df) over all documents: counted per task, then summed."""
    def count(batch_iter):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"term": pa.array(list(seen.keys()), pa.binary()),
                                               "df": pa.array(list(seen.values()), pa.int64())})

        for batch in batch_iter:
            for _, texts in batches(batch.column(0)):
                for t in texts:
                    seen.update(terms(t))
                    if len(seen) > FLUSH_TERMS:
                        yield out()
                        seen.clear()
        yield out()

    return (docs.select(F.col("text").cast("string")).mapInArrow(count, "term binary, df long")
            .groupBy("term").agg(F.sum("df").alias("df")))


def lexicon(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> list[bytes]:
    """Terms in the frequency band (at most mean distinct terms / ``min_share``)."""
    bounded_batches(docs.sparkSession)
    n = docs.count()
    with freeing(docs.sparkSession):
        rows = document_frequencies(docs).where(
            (F.col("df") >= F.lit(n * min_share)) & (F.col("df") <= F.lit(n * max_share))).select("term").collect()
    return sorted(bytes(r.term) for r in rows)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Fingerprinter:
    """Fingerprints of texts, given the lexicon."""

    def __init__(self, words: list[bytes], subsets: int = SUBSETS):
        self.lexicon = {w: xxhash.xxh3_64_intdigest(w) for w in words}
        self.seeds = _mix(np.arange(1, subsets + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """(scale, hashes of shape (SCALES, subsets) as uint32, 0: empty subset)."""
        own = terms(text)
        lex = self.lexicon
        hashed = [lex[w] for w in own if w in lex] or [xxhash.xxh3_64_intdigest(w) for w in own]
        t = np.unique(np.array(hashed, np.uint64))
        out = np.zeros((SCALES, len(self.seeds)), np.uint32)
        if not len(t):
            return 0, out
        scale = int(math.log2(len(t)))
        drawn = _mix(t[:, None] ^ self.seeds[None, :])
        value = _mix(drawn + t[:, None])
        for i in range(SCALES):
            s = scale + i
            inside = drawn < np.uint64(1 << (64 - s)) if s else np.ones(drawn.shape, bool)
            total = _mix(np.where(inside, value, np.uint64(0)).sum(axis=0)) >> np.uint64(32)
            out[i] = np.where(inside.any(axis=0), np.maximum(total, np.uint64(1)), np.uint64(0))
        return scale, out


def text_form(fp: tuple[int, np.ndarray]) -> str:
    return f"{fp[0]:02d}:" + fp[1].astype(">u4").tobytes().hex()


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of equal subset hashes, over subsets where either has a term."""
    if a[0] == b[0]:
        x, y = a[1], b[1]
        if np.array_equal(x, y):
            return 1.0
    elif abs(a[0] - b[0]) < SCALES:
        lo, hi = (a, b) if a[0] < b[0] else (b, a)
        d = hi[0] - lo[0]
        x, y = lo[1][d:], hi[1][:SCALES - d]
    else:
        return 0.0
    either = (x | y) != 0
    n = int(either.sum())
    return float(((x == y) & either).sum() / n) if n else 0.0


def fingerprints(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """doc_id and fingerprint of every text: one narrow pass after the lexicon."""
    words = docs.sparkSession.sparkContext.broadcast(lexicon(docs, min_share, max_share))

    def work(batch_iter):
        fp = Fingerprinter(words.value)
        for batch in batch_iter:
            for first, texts in batches(batch.column(1)):
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column(0).slice(first, len(texts)),
                     "fingerprint": pa.array([text_form(fp.of(t)) for t in texts], pa.string())})

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _edited(text: str, after: str) -> str:
    k = len(text) // 3
    return text[:len(text) - k] + after[:k]


def edit_pairs(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """Every document beside an edited copy of itself and beside the next document
    (descending id, after the last the first): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    Ids are cut into blocks at quantiles; a block is sorted in one task and read
    as a stream, and each block also gets the first document of the next block."""
    spark = docs.sparkSession
    words = spark.sparkContext.broadcast(lexicon(docs, min_share, max_share))
    low = -(1 << 63)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"),
                    F.coalesce(F.col("doc_id").cast("long"), F.lit(low)).alias("_o"))
    ids = d.select("_o")
    blocks = shuffle_blocks(spark, ids.count(), BLOCK_ROWS)
    cuts = ids.select(F.col("_o").cast("double")).approxQuantile("_o", [i / blocks for i in range(1, blocks)], 0.001) \
        if blocks > 1 else []
    cuts = sorted({float(c) for c in cuts}, reverse=True)
    d = d.withColumn("_block", _block(F.col("_o").cast("double"), cuts))
    # the first document of each block, to be read after the last of the one before
    heads = [(r[0], r[1]) for r in d.groupBy("_block").agg(F.max("_o")).orderBy("_block").collect()]
    if not heads:
        return spark.createDataFrame([], _PAIRS)
    to = {o: heads[i - 1][0] for i, (_, o) in enumerate(heads)}
    first = F.broadcast(spark.createDataFrame(list(to.items()), "_o long, _to int"))
    donors = (d.join(first, "_o").groupBy("_o").agg(F.min("text").alias("text"), F.first("_to").alias("_block"))
              .select(F.lit(None).cast("long").alias("doc_id"), "text", "_o", "_block", F.lit(1).alias("_last")))
    rows = (d.select("doc_id", "text", "_o", "_block", F.lit(0).alias("_last")).unionByName(donors)
            .repartition(blocks, "_block")
            .sortWithinPartitions("_block", "_last", F.desc("_o"), "text")
            .select("doc_id", "text", "_block", "_last"))

    def work(batch_iter):
        fp = Fingerprinter(words.value)
        names = [f.split()[0] for f in _PAIRS.split(", ")]
        out: list = []
        before = None

        def batch():
            cols = dict(zip(names, zip(*out)))
            out.clear()
            return pa.RecordBatch.from_pydict(
                {k: pa.array(v, pa.int64() if k in ("doc_id", "n_chars") else None) for k, v in cols.items()})

        for b in batch_iter:
            for doc, text, block, last in zip(*(b.column(i) for i in range(4))):
                text = text.as_py()
                own = fp.of(text)
                key = block.as_py()
                if before and before[0] == key:
                    _, i, t, f = before
                    e = _edited(t, text)
                    ef = fp.of(e)
                    out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), text_form(f),
                                text_form(ef), likeness(f, ef), likeness(f, own)))
                    if len(out) >= 2000:
                        yield batch()
                before = None if last.as_py() else (key, doc.as_py(), text, own)
        if out:
            yield batch()

    return rows.mapInArrow(work, _PAIRS)


_PAIRS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _block(value, cuts: list[float]):
    """Number of cuts (descending) above ``value``: a binary search."""
    if not cuts:
        return F.lit(0)
    table = F.split(F.lit(",".join(repr(c) for c in cuts)), ",").cast("array<double>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda p, s: F.when(
        F.get(table, p + s - 1) > value, p + s).otherwise(p))
