"""Operator 4, suffix-array dedup: bytes of repeated 50-byte strings are removed.

A byte goes when a ``length``-byte string that covers it also starts in a document
of smaller id; strings are judged on the input. All of it is exact:

1. Every window of ``length`` bytes names an anchor: its 20-byte gram of smallest
   hash. Equal windows name equal anchors, and about one byte in sixteen is one.
   Anchors found in more than one document are marked in a fixed-size bit table
   (blocks of anchors are merged in parallel, each anchor sent once per task).
2. Around each marked anchor the windows that name it form a segment. Segments are
   dealt by anchor, each different text once per task with its smallest and largest
   document, so a passage in a third of all documents is a few rows.
3. Where one anchor has several different segments, a suffix array of their texts
   is built by two-stage sorting: only suffixes smaller than their successor are
   sorted directly, the others follow from them bucket by bucket; windows whose
   adjacent common prefix is at least ``length`` are equal. Each window of a segment
   gets the smallest document that has it.
4. Documents' segments are joined with these (a plain join, so Spark splits hot
   ones), and each document's spans are cut out of its text.

An anchor that the bit table marks by chance only costs work. Segments meet by the
64-bit hash of their text.

Defined results. Null text counts as empty. Texts shorter than ``length`` and rows
with a null id lose nothing and remove nothing. Repeated rows of one id do not
remove each other. An empty table gives an empty result. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.common import bounded_batches, shuffle_blocks, stored
from winback.llm.ngram_join import _by_block, _mix, _runs
from winback.llm.wordtokens import batches

LENGTH = 50
GRAM = 20                   # bytes of an anchor, 16 + 4
TABLE_BITS = 27
SPAN_BITS = 20              # a span is at most 2 * length - GRAM bytes long
RUN_CHARS = 250_000
FLUSH_ANCHORS = 300_000
FLUSH_BYTES = 3_000_000
SORT_BYTES = 150_000        # texts of anchors sorted together
DOCS_PER_BLOCK = 1_000
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def anchors(texts: list[bytes], length: int = LENGTH):
    """(text number, key, first window, last window) of every anchor of every
    text; windows count from the text's start."""
    lens = np.array([len(t) for t in texts], np.int64)
    none = np.zeros(0, np.int64)
    if not len(lens) or lens.max(initial=0) < length:
        return none, none.astype(np.uint64), none, none
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum(lens) - lens
    h = _BYTE[data]
    for step, mult in ((1, 0xD6E8FEB86659FD93), (2, 0xA0761D6478BD642F), (4, 0xE7037ED1A0B428DB), (8, 0x8EBC6AF09C88C6E3)):
        h = h[:-step] * np.uint64(mult) + h[step:]
        if step == 2:
            four = h
    h = _mix(h[:len(four) - 16] * np.uint64(0x589965CC75374CC3) + four[16:])
    # the place breaks ties, so equal windows choose equal places
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span, have = length - GRAM + 1, 1
    while have < span:
        step = min(have, span - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    count = np.maximum(lens - length + 1, 0)
    doc = np.repeat(np.arange(len(lens)), count)
    window = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = (low[np.repeat(begin, count) + window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.nonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))[0]
    last = np.concatenate([new[1:], [len(at)]]) - 1
    # an anchor's hash is the smallest of a window's: mixed again, keys are even
    return doc[new], _mix(h[at[new]]), window[new], window[last]


# -- two-stage suffix sorting ------------------------------------------------

def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (small non-negative integers below 512) in the order of
    their first ``depth`` symbols (equal ones in any order)."""
    n = len(text)
    t = text.astype(np.int16)
    up = np.zeros(n, np.int8)
    up[:-1] = np.sign(t[1:] - t[:-1])
    up[-1] = -1                                      # the end is smaller than all
    place = np.where(up != 0, np.arange(n, dtype=np.int32), np.int32(n))
    up = up[np.minimum.accumulate(place[::-1])[::-1]]
    small = up > 0                                   # smaller than the next suffix
    words = packed(t, depth)
    pick = np.nonzero(small)[0]
    for w in reversed(words):                        # last word first, each sort stable
        pick = pick[np.argsort(w[pick], kind="stable")]
    first = t[pick]
    rank = np.full(n + 1, -1, np.int32)
    out, done = [], 0
    others = np.nonzero(~small)[0]
    others = others[np.argsort(t[others], kind="stable")]
    ends = np.searchsorted(t[others], np.arange(t.max() + 2)) if n else []
    starts_b = np.searchsorted(first, np.arange(t.max() + 2)) if n else []
    after = np.append(t[1:], np.int16(-1))
    for c in range(int(t.max()) + 1 if n else 0):
        bucket = others[ends[c]:ends[c + 1]]
        # successors in smaller buckets are placed; runs of c follow one by one
        turn = bucket[after[bucket] != c]
        waiting = bucket[after[bucket] == c]
        while len(turn):
            turn = turn[np.argsort(rank[turn + 1], kind="stable")]
            rank[turn] = done + np.arange(len(turn))
            done += len(turn)
            out.append(turn)
            if not len(waiting):
                break
            ready = rank[waiting + 1] >= 0
            turn, waiting = waiting[ready], waiting[~ready]
        own = pick[starts_b[c]:starts_b[c + 1]]
        rank[own] = done + np.arange(len(own))
        done += len(own)
        out.append(own)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def packed(t: np.ndarray, depth: int) -> list[np.ndarray]:
    """Words of seven 9-bit symbols that cover ``depth`` symbols from each place."""
    n = len(t)
    pad = np.concatenate([t, np.zeros(depth + 14, t.dtype)])
    seven = np.zeros(n + depth + 7, np.int64)
    for i in range(7):
        seven = (seven << 9) | pad[i:i + n + depth + 7]
    return [seven[i:i + n] for i in range(0, depth, 7)]


def first_documents(texts: list[bytes], docs: np.ndarray, length: int = LENGTH):
    """(text number, smallest of ``docs`` among the texts that contain it) of every
    window of every text, in order."""
    lens = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int16) + np.int16(1)
    begin = np.cumsum(lens + 1) - lens - 1
    data[begin + lens] = 0
    count = lens - length + 1
    seg = np.repeat(np.arange(len(texts)), count)
    where = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    is_window = np.full(len(data), -1, np.int32)
    is_window[where] = np.arange(len(where), dtype=np.int32)
    order = suffix_order(data, length)
    order = order[is_window[order] >= 0]
    words = packed(data, length - length % 7)
    same = np.ones(len(order) - 1, bool)
    a, b = order[:-1], order[1:]
    for w in words:
        same &= w[a] == w[b]
    for i in range(length - length % 7, length):
        same &= data[a + i] == data[b + i]
    start = np.nonzero(np.concatenate([[True], ~same]))[0]
    number = is_window[order]
    least = np.minimum.reduceat(docs[seg[number]], start)
    out = np.empty(len(where), np.int64)
    out[number] = np.repeat(least, np.diff([*start, len(order)]))
    return seg, out


# -- Spark -------------------------------------------------------------------

def _texts(batch, *more: int):
    """(ids, texts as bytes, values of the columns ``more``) of rows (id, text, ...)
    with an id, in runs."""
    for first, texts in batches(batch.column(1), RUN_CHARS):
        own, *rest = (batch.column(i).slice(first, len(texts)).to_pylist() for i in (0, *more))
        keep = [i for i, x in enumerate(own) if x is not None]
        yield (np.array([own[i] for i in keep], np.int64),
               [texts[i].encode("utf-8", "surrogatepass") for i in keep], *([x[i] for i in keep] for x in rest))


def shared_anchors(docs: DataFrame, blocks: int, length: int, bits: int) -> np.ndarray:
    """Bit table (uint8 of 2^bits / 8) of anchors found in two or more documents.
    What reaches the driver is that table, cut into the blocks' ranges."""
    def send(batch_iter):
        keys, owners, size = [], [], 0

        def flush():
            k, o = np.concatenate(keys), np.concatenate(owners)
            keys.clear(), owners.clear()
            by = np.lexsort((o, k))
            k, o = k[by], o[by]
            start = _runs(k)
            last = np.concatenate([start[1:], [len(k)]]) - 1
            # the lowest bit says: several documents have it here
            k = (k[start] & ~np.uint64(1)) | (o[start] != o[last]).astype(np.uint64)
            got = [(b, k[i].tobytes()) for b, i in _by_block(k, blocks)]
            b, x = zip(*got)
            return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(x, pa.binary())], ["block", "keys"])

        for batch in batch_iter:
            for ids, texts in _texts(batch):
                doc, key, _, _ = anchors(texts, length)
                keys.append(key)
                owners.append(ids[doc])
                size += len(key)
                if size > FLUSH_ANCHORS:
                    yield flush()
                    size = 0
        if size:
            yield flush()
        pa.default_memory_pool().release_unused()

    def merge(table: pa.Table) -> pa.Table:
        k = np.sort(np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["keys"]]))
        name = k >> np.uint64(1)
        start = _runs(name)
        width = np.diff([*start, len(k)])
        many = (width > 1) | ((np.bitwise_or.reduceat(k, start) & np.uint64(1)) == 1)
        bit = (k[start][many] >> np.uint64(64 - bits)).astype(np.int64)
        if not len(bit):
            return pa.table({"at": pa.array([], pa.int64()), "part": pa.array([], pa.binary())})
        lo, hi = int(bit[0]) >> 3, (int(bit[-1]) >> 3) + 1
        part = np.zeros((hi - lo) * 8, bool)
        part[bit - lo * 8] = True
        return pa.table({"at": pa.array([lo], pa.int64()), "part": pa.array([np.packbits(part).tobytes()], pa.binary())})

    found = stored(docs.mapInArrow(send, "block int, keys binary").groupBy("block")
                   .applyInArrow(merge, "at long, part binary"), "anchors")
    table = np.zeros(1 << (bits - 3), np.uint8)
    for at, part in found.toLocalIterator():
        part = np.frombuffer(part, np.uint8)
        table[at:at + len(part)] |= part
    return table


def _marked(table: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    bit = (key >> np.uint64(64 - bits)).astype(np.int64)
    return (table[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1


def _segments(ids, texts, table, length, bits):
    """(text number, key, first window, segment) of the marked anchors."""
    doc, key, lo, hi = anchors(texts, length)
    if not len(key):
        return
    keep = np.nonzero(_marked(table, key, bits))[0]
    for d, k, a, b in zip(doc[keep].tolist(), key[keep].tolist(), lo[keep].tolist(), hi[keep].tolist()):
        yield d, k, a, texts[d][a:b + length]


_SEGMENT = "block int, keys binary, least binary, most binary, lens binary, texts binary"


def _first_seen(docs: DataFrame, table, blocks: int, length: int, bits: int) -> DataFrame:
    """(seg, frm, upto, first): windows frm..upto of the segments with hash ``seg``
    were first in document ``first``; only where it is smaller than another."""
    def send(batch_iter):
        seen: dict = {}
        size = 0

        def flush():
            k = np.array([x[0] for x in seen], np.uint64)
            text = [x[1] for x in seen]
            ends = np.array(list(seen.values()), np.int64)
            lens = np.array([len(t) for t in text], np.int32)
            rows = []
            for b, i in _by_block(k, blocks):
                rows.append((b, k[i].tobytes(), ends[i, 0].tobytes(), ends[i, 1].tobytes(), lens[i].tobytes(),
                             b"".join([text[j] for j in i.tolist()])))
            seen.clear()
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                [f.split()[0] for f in _SEGMENT.split(", ")])

        for batch in batch_iter:
            for ids, texts in _texts(batch):
                own = ids.tolist()
                for d, k, _, text in _segments(ids, texts, table.value, length, bits):
                    if size > FLUSH_BYTES:
                        yield flush()
                        size = 0
                    i, name = own[d], (k, text)
                    x = seen.get(name)
                    if x is None:
                        seen[name] = (i, i)
                        size += len(text)
                    elif i < x[0] or i > x[1]:
                        seen[name] = (min(i, x[0]), max(i, x[1]))
        if seen:
            yield flush()
        pa.default_memory_pool().release_unused()

    def judge(t: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in t["keys"]])
        least = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in t["least"]])
        most = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in t["most"]])
        text = []
        for lens, whole in zip(t["lens"], t["texts"]):
            whole, at = whole.as_buffer().to_pybytes(), 0
            for n in np.frombuffer(lens.as_py(), np.int32).tolist():
                text.append(whole[at:at + n])
                at += n
        seg = np.array([xxhash.xxh3_64_intdigest(x) for x in text], np.uint64)
        by = np.lexsort((seg, keys))
        keys, seg, least, most = keys[by], seg[by], least[by], most[by]
        new = np.nonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (seg[1:] != seg[:-1])]))[0]
        least, most = np.minimum.reduceat(least, new), np.maximum.reduceat(most, new)
        keys, seg = keys[new], seg[new]
        text = [text[i] for i in by[new].tolist()]
        start = _runs(keys)
        width = np.diff([*start, len(keys)])
        windows = np.array([len(x) for x in text], np.int64) - length + 1
        alone = start[width == 1]
        alone = alone[least[alone] < most[alone]]
        out = [(seg[alone], np.zeros(len(alone), np.int64), windows[alone] - 1, least[alone])]
        todo: list[int] = []
        size = 0
        several = np.nonzero(width > 1)[0].tolist()
        for j, r in enumerate(several):
            own = range(int(start[r]), int(start[r] + width[r]))
            todo += own
            size += sum(len(text[i]) for i in own)
            if size > SORT_BYTES or j == len(several) - 1:
                at = np.array(todo)
                number, first = first_documents([text[i] for i in todo], least[at], length)
                # runs of windows of one text with one first document
                run = np.nonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (first[1:] != first[:-1])]))[0]
                last = np.concatenate([run[1:], [len(number)]]) - 1
                which = at[number[run]]
                begin = np.cumsum(windows[at]) - windows[at]
                keep = first[run] < most[which]
                out.append(tuple(x[keep] for x in (seg[which], run - begin[number[run]],
                                                   last - begin[number[run]], first[run])))
                todo, size = [], 0
        out = [np.concatenate(x) for x in zip(*out)]
        return pa.table({"seg": pa.array(out[0].view(np.int64)), "frm": pa.array(out[1].astype(np.int32)),
                         "upto": pa.array(out[2].astype(np.int32)), "first": pa.array(out[3])})

    return (docs.mapInArrow(send, _SEGMENT).groupBy("block")
            .applyInArrow(judge, "seg long, frm int, upto int, first long"))


def _instances(docs: DataFrame, table, length: int, bits: int) -> DataFrame:
    """(seg, doc_id, row, at): the segments of every document (doc_id, text, row);
    ``at`` is the first window."""
    def work(batch_iter):
        for batch in batch_iter:
            for ids, texts, row in _texts(batch, 2):
                own = ids.tolist()
                got = [(xxhash.xxh3_64_intdigest(text), own[d], row[d], a)
                       for d, _, a, text in _segments(ids, texts, table.value, length, bits)]
                if got:
                    seg, doc, r, at = zip(*got)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(seg, np.uint64).view(np.int64)), pa.array(doc, pa.int64()),
                         pa.array(r, pa.int64()), pa.array(at, pa.int32())], ["seg", "doc_id", "row", "at"])

    return docs.mapInArrow(work, "seg long, doc_id long, row long, at int")


def repeated_spans(docs: DataFrame, length: int = LENGTH, bits: int = TABLE_BITS) -> DataFrame:
    """(doc_id, row, spans): spans to remove, that may overlap, each one long with
    the first byte in its upper bits and the length in the lower ``SPAN_BITS``;
    ``row`` is ``xxhash64`` of the text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    blocks = shuffle_blocks(spark, d.count(), DOCS_PER_BLOCK)
    table = spark.sparkContext.broadcast(shared_anchors(d, blocks, length, bits))
    seen = stored(_first_seen(d, table, blocks, length, bits), "first_seen")
    hits = (_instances(d.withColumn("row", F.xxhash64("text")), table, length, bits).join(seen, "seg").where(F.col("first") < F.col("doc_id"))
            .select("doc_id", "row", ((F.col("at") + F.col("frm")).cast("long") * (1 << SPAN_BITS)
                                      + F.col("upto") - F.col("frm") + length).alias("span")))
    return hits.groupBy("doc_id", "row").agg(F.collect_list("span").alias("spans"))


def cut_repeats(docs: DataFrame, length: int = LENGTH, bits: int = TABLE_BITS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (binary: the
    remaining bytes)."""
    spans = stored(repeated_spans(docs, length, bits), "spans")
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return _cut(d.withColumn("row", F.xxhash64("text")).join(spans, ["doc_id", "row"], "left"))


_CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def cut(text: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs)."""
    if not len(spans):
        return text, 0, 0
    spans = np.sort(spans)
    begin = spans >> SPAN_BITS
    reach = np.maximum.accumulate(begin + (spans & ((1 << SPAN_BITS) - 1)))
    new = np.nonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))[0]   # touching spans are one run
    s, e = begin[new], reach[np.concatenate([new[1:], [len(spans)]]) - 1]
    kept = [text[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(text)])]
    return b"".join(kept), int((e - s).sum()), len(new)


def _cut(d: DataFrame) -> DataFrame:
    def work(batch_iter):
        for batch in batch_iter:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                n, gone, runs, kept = [], [], [], []
                for text, spans in zip(part.column(1), part.column(2)):
                    text = text.as_py().encode("utf-8", "surrogatepass")
                    spans = spans.values.to_numpy() if spans.is_valid else np.zeros(0, np.int64)
                    k, g, r = cut(text, spans)
                    n.append(len(text))
                    gone.append(g)
                    runs.append(r)
                    kept.append(k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, runs)), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return d.select("doc_id", "text", "spans").mapInArrow(work, _CUT)
