"""Operator 2, n-gram Jaccard join: blocked sparse product of the document by
shingle incidence matrix, with size bounds.

Documents are rows, distinct 5-word shingles (64-bit hashes) are columns; two
documents link when their Jaccard similarity is at least ``threshold``. Equal rows
(copies) are one class from the start. Then, all of it exact:

1. Columns are dealt into hash blocks; each task sends its part of a block as one
   packed row, with a column that several of its own documents share sent once.
   A link needs at least ``threshold`` of a row's columns shared, so a row of whose
   lowest 40 % columns too many are held by it alone has no link: most rows end here.
   A row sends as many columns as the test of any possible partner needs to find.
2. Among the rows left, columns are counted per block and each row keeps its rarest
   columns, as many as a partner must meet (the prefix bound).
3. Rows that meet in a kept column are compared, first each with one hub of its
   columns; rows that are connected need no further comparison. What stays
   unconnected after some rounds is compared pair by pair, so no link is lost and a
   large group of near copies costs about one comparison a row.
4. Pairs whose sizes, or whose columns met anywhere, cannot reach the threshold are
   discarded; the others get their whole overlap from the sorted rows.

Defined results. Null or blank text has no shingle and links with nothing. Fewer
than five words: the whole sequence is one shingle. Repeated rows are copies. A
null id takes part in its group but never names it (a group of null ids only has a
null component); ``keep_one`` decides by row, so it keeps one row of such groups
and of repeated rows too. An empty table gives an empty result. Other columns are ignored
by ``link_components`` and kept by ``keep_one``.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.common import bounded_batches, release, shuffle_blocks, stored, trim
from winback.llm.graph import components
from winback.llm.wordtokens import batches

N = 5
THRESHOLD = 75              # percent
FIRST_SHARE = 0.4           # share of a row's columns in the first test
DOCS_PER_BLOCK = 4_000
FLUSH_ENTRIES = 400_000
HUB_ROUNDS = 1
TABLE_OWNERS = 16_000_000   # rows left that are told by a bit table of at most 64 MB
CACHE_WORDS = 150_000
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(x):
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _WordHash(dict):
    def __missing__(self, word):
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Sorted distinct shingle hashes of a text."""

    def __init__(self, n: int = N):
        self.n, self.cache = n, _WordHash()

    def of(self, text: str) -> np.ndarray:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        words = text.encode("utf-8", "surrogatepass").lower().split()
        w = np.fromiter(map(self.cache.__getitem__, words), np.uint64, len(words))
        if not len(w):
            return w
        n = min(self.n, len(w))
        h = w[:len(w) - n + 1].copy()
        for i in range(1, n):
            h = h * _MULT + w[i:len(w) - n + 1 + i]
        return np.unique(_mix(h ^ np.uint64(n)))


def class_of(row: np.ndarray) -> tuple[bytes, int]:
    """128-bit identity of a row, and its first 64 bits as a signed long, never 0."""
    d = xxhash.xxh3_128_digest(row.tobytes())
    return d, int.from_bytes(d[:8], "little", signed=True) or 1


def most_alone(n, threshold: int = THRESHOLD):
    """Columns that a linked row of n columns can have without its partner."""
    return n - (-(-threshold * n // 100))


def tested(n):
    """How many of its lowest columns a row of n columns is tested on."""
    return np.minimum(n, (FIRST_SHARE * n).astype(np.int64) + 1)


@cache
def sent(n: int, threshold: int = THRESHOLD) -> int:
    """How many of its lowest columns a row of n columns sends. Of the columns that
    a linked row of m shares, those sent number at least what is sent less the
    columns that the partner lacks, ``n - overlap``; the partner's test must not
    miss more than ``most_alone(m)`` of the columns it is tested on."""
    m = np.arange(max(1, -(-threshold * n // 100)), 100 * n // threshold + 1)
    overlap = -(-threshold * (n + m) // (100 + threshold))
    need = tested(m) + n - overlap - most_alone(m, threshold)
    return int(min(n, max(tested(np.int64(n)), need.max(initial=0))))


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.nonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))[0]


def _by_block(keys: np.ndarray, blocks: int):
    """(block, slice of rows) after sorting by block: block is a key's top bits."""
    b = ((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    order = np.argsort(b, kind="stable")
    b = b[order]
    starts = _runs(b)
    for s, e in zip(starts, [*starts[1:], len(b)]):
        yield int(b[s]), order[s:e]


_PART = "block int, kind int, keys binary, owners binary, doc_id long, text_hash long, n int, owner long, cls binary"
_FOUND = "kind int, doc_id long, text_hash long, n int, owner long, cls binary, shared int"


def _rows(schema: str, columns: dict, n: int) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[k], kinds[t]) if k in columns else pa.nulls(n, kinds[t]) for k, t in names],
        [k for k, _ in names])


def _text_hash(docs: DataFrame):
    """With the id, what tells rows apart: rows equal in both are repeats."""
    return F.xxhash64(docs["text"].cast("string"))


def _first_parts(docs: DataFrame, blocks: int, n: int, threshold: int) -> DataFrame:
    """Every document's row figures (kind 0) and, packed by block, the lowest
    columns of its row (kind 1); kind 2: columns found shared within the task."""
    def work(batch_iter):
        shingler = Shingler(n)
        keys, owners, size = [], [], 0

        def flush():
            k, o = np.concatenate(keys), np.concatenate(owners)
            keys.clear(), owners.clear()
            by = np.lexsort((o, k))
            k, o = k[by], o[by]
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])
            k, o = k[new], o[new]                       # copies count once
            start = _runs(k)
            many = np.repeat(np.diff([*start, len(k)]) > 1, np.diff([*start, len(k)]))
            own, count = np.unique(o[many], return_counts=True)
            head = np.zeros(len(k), bool)
            head[start] = True
            o = np.where(many, 0, o)                    # 0: shared by several here
            k, o = k[~many | head], o[~many | head]
            if len(own):
                yield _rows(_PART, {"block": [int(own[0] % blocks)], "kind": [2],
                                    "keys": [count.astype(np.int64).tobytes()],
                                    "owners": [own.tobytes()]}, 1)
            parts = [(b, k[i].tobytes(), o[i].tobytes()) for b, i in _by_block(k, blocks)]
            b, x, y = zip(*parts)
            yield _rows(_PART, {"block": b, "kind": [1] * len(b), "keys": x, "owners": y}, len(b))

        for batch in batch_iter:
            for first, texts in batches(batch.column(1)):
                ns, owns, clss = [], [], []
                for t in texts:
                    row = shingler.of(t)
                    cls, owner = class_of(row)
                    ns.append(len(row))
                    owns.append(owner)
                    clss.append(cls)
                    p = sent(len(row), threshold)
                    keys.append(row[:p])
                    owners.append(np.full(p, owner, np.int64))
                    size += p
                yield _rows(_PART, {"block": [(first + i) % blocks for i in range(len(ns))], "kind": [0] * len(ns),
                                    "doc_id": batch.column(0).slice(first, len(texts)),
                                    "text_hash": batch.column(2).slice(first, len(texts)), "n": ns, "owner": owns, "cls": clss}, len(ns))
                if size > FLUSH_ENTRIES:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()
        trim()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       _text_hash(docs)).mapInArrow(work, _PART)


def _shared_counts(parts: DataFrame) -> DataFrame:
    """Per block: the row figures unchanged, and for every class how many of its
    columns in the block another class holds too."""
    def work(table: pa.Table) -> pa.Table:
        trim()                                          # of the group before
        kind = table.column("kind").to_numpy()
        docs = table.filter(pa.array(kind == 0))
        out = [pa.table({"kind": docs["kind"], "doc_id": docs["doc_id"], "text_hash": docs["text_hash"],
                         "n": docs["n"], "owner": docs["owner"], "cls": docs["cls"], "shared": pa.nulls(len(docs), pa.int32())})]
        own, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.nonzero(kind == 2)[0].tolist():
            own.append(np.frombuffer(table["owners"][i].as_py(), np.int64))
            count.append(np.frombuffer(table["keys"][i].as_py(), np.int64))
        packed = np.nonzero(kind == 1)[0].tolist()
        if packed:
            k = np.concatenate([np.frombuffer(table["keys"][i].as_py(), np.uint64) for i in packed])
            o = np.concatenate([np.frombuffer(table["owners"][i].as_py(), np.int64) for i in packed])
            by = np.lexsort((o, k))
            k, o = k[by], o[by]
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1]) | (o[1:] == 0)])
            k, o = k[new], o[new]
            start = _runs(k)
            width = np.diff([*start, len(k)])
            hit = np.repeat((width > 1) | (o[start] == 0), width) & (o != 0)
            own.append(o[hit])
            count.append(np.ones(int(hit.sum()), np.int64))
        own, count = np.concatenate(own), np.concatenate(count)
        who, at = np.unique(own, return_inverse=True)
        total = np.bincount(at, count, len(who)).astype(np.int32) if len(who) else np.zeros(0, np.int32)
        m = len(who)
        out.append(pa.table({"kind": pa.array(np.full(m, 2, np.int32)), "doc_id": pa.nulls(m, pa.int64()),
                             "text_hash": pa.nulls(m, pa.int64()), "n": pa.nulls(m, pa.int32()), "owner": pa.array(who, pa.int64()),
                             "cls": pa.nulls(m, pa.binary()), "shared": pa.array(total, pa.int32())}))
        return pa.concat_tables(out)

    return parts.groupBy("block").applyInArrow(work, _FOUND)


def _bit_table(left: DataFrame, bits: int) -> np.ndarray:
    """A table of ``bits`` bits in which each owner, itself a hash, sets one; combined by
    Spark into pages, so ``bits`` / 8 bytes come back whatever the number of rows."""
    slot = F.col("owner").bitwiseAND(F.lit(bits - 1)) + 1
    pages = (left.select(F.bitmap_bucket_number(slot).alias("page"), F.bitmap_bit_position(slot).alias("bit"))
             .groupBy("page").agg(F.bitmap_construct_agg("bit").alias("map")).toArrow())
    table = np.zeros((bits // 32_768, 4_096), np.uint8)
    for page, m in zip(pages["page"].to_pylist(), pages["map"].to_pylist()):
        table[page - 1] = np.frombuffer(m, np.uint8)
    return table.reshape(-1)


def _rows_left(docs: DataFrame, left: DataFrame, n: int, table_owners: int = TABLE_OWNERS) -> DataFrame:
    """(owner, n, keys) of the classes in ``left`` (owner). Texts are shingled again where
    they lie: a class is told by its own hash, so no text and no id is shuffled. Rows that
    hit the bit table (one in 16 of the others does, too) are sent, a class once per task
    as far as the task remembers, and met with ``left``; beyond ``table_owners`` classes
    all rows are sent."""
    spark, count = docs.sparkSession, left.count()
    bits = 1 << max(15, (16 * count - 1).bit_length())
    table = spark.sparkContext.broadcast(_bit_table(left, bits)) if count <= table_owners else None

    def work(batch_iter):
        shingler, mask, known = Shingler(n), bits - 1, set()
        for batch in batch_iter:
            for _, texts in batches(batch.column(0)):
                owners, sizes, keys = [], [], []
                for t in texts:
                    row = shingler.of(t)
                    if not len(row):
                        continue
                    o = class_of(row)[1]
                    if o in known or table is not None and not table.value[(o & mask) >> 3] >> (o & 7) & 1:
                        continue
                    if len(known) < 100_000:
                        known.add(o)
                    owners.append(o)
                    sizes.append(len(row))
                    keys.append(row.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(sizes, pa.int32()),
                                                  pa.array(keys, pa.binary())], ["owner", "n", "keys"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(work, "owner long, n int, keys binary")
    return rows.join(left.select("owner"), "owner", "left_semi").dropDuplicates(["owner"])


def _entries(key, owner, n, met, place) -> pa.Table:
    def col(parts, kind):
        return pa.array(np.concatenate(parts) if parts else [], kind)
    return pa.table({"key": col(key, pa.int64()), "owner": col(owner, pa.int64()), "n": col(n, pa.int32()),
                     "met": col(met, pa.int32()), "place": col(place, pa.int32())})


def _reach(most, na, nb, threshold: int):
    """Whether an overlap of at most ``most`` can link rows of these sizes."""
    return 100 * most >= threshold * (na + nb - most)


def _postings(rows: DataFrame, blocks: int, threshold: int) -> DataFrame:
    """(key, owner, n, met, place), stored: for every row its rarest columns, as many as a
    partner must meet at least once, without those that no other row left has.
    ``met``: columns of the row that any other row has, a bound on every overlap;
    ``place``: how many rarer columns the row has. Rows are counted chunk by chunk:
    a column is sent once per chunk and block."""
    def send(batch_iter):
        import uuid
        for batch in batch_iter:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                chunk = uuid.uuid4().hex
                keys = [np.frombuffer(k.as_py(), np.uint64) for k in part.column(2)]
                k, c = np.unique(np.concatenate(keys), return_counts=True)
                got = [(b, k[j].tobytes(), c[j].astype(np.int64).tobytes()) for b, j in _by_block(k, blocks)]
                b, x, y = zip(*got)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b, pa.int32()), pa.array([chunk] * len(b)), pa.array(x, pa.binary()),
                     pa.array(y, pa.binary()), pa.nulls(len(b), pa.binary()), pa.nulls(len(b), pa.binary())],
                    ["block", "chunk", "keys", "counts", "owners", "sizes"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1], pa.int32()), pa.array([chunk]),
                     pa.array([b"".join(x.tobytes() for x in keys)], pa.binary()), pa.nulls(1, pa.binary()),
                     pa.array([part.column(0).to_numpy().astype(np.int64).tobytes()], pa.binary()),
                     pa.array([np.array([len(x) for x in keys], np.int64).tobytes()], pa.binary())],
                    ["block", "chunk", "keys", "counts", "owners", "sizes"])

    def total(table: pa.Table) -> pa.Table:
        trim()
        ks = [np.frombuffer(x.as_py(), np.uint64) for x in table["keys"]]
        cs = [np.frombuffer(x.as_py(), np.int64) for x in table["counts"]]
        k, at = np.unique(np.concatenate(ks), return_inverse=True)
        sums = np.bincount(at, np.concatenate(cs), len(k)).astype(np.int64)
        chunk, keys, freqs, i = [], [], [], 0
        for c, own in zip(table["chunk"].to_pylist(), ks):
            f = sums[at[i:i + len(own)]]
            i += len(own)
            if (f > 1).any():
                chunk.append(c)
                keys.append(own[f > 1].tobytes())
                freqs.append(f[f > 1].tobytes())
        return pa.table({"chunk": pa.array(chunk, pa.string()), "keys": pa.array(keys, pa.binary()),
                         "freqs": pa.array(freqs, pa.binary())})

    def pick(chunk: pa.Table, found: pa.Table) -> pa.Table:
        trim()
        if not len(chunk) or not len(found):
            return _entries([], [], [], [], [])
        fk = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in found["keys"]])
        ff = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in found["freqs"]])
        by = np.argsort(fk)
        fk, ff = fk[by], ff[by]
        out: list = [[], [], [], [], []]
        for i in range(len(chunk)):
            keys = np.frombuffer(chunk["keys"][i].as_py(), np.uint64)
            owners = np.frombuffer(chunk["owners"][i].as_py(), np.int64)
            ends = np.cumsum(np.frombuffer(chunk["sizes"][i].as_py(), np.int64))
            at = np.minimum(np.searchsorted(fk, keys), len(fk) - 1)
            freq = np.where(fk[at] == keys, ff[at], 1)
            for o, s, e in zip(owners, np.concatenate([[0], ends[:-1]]), ends):
                k, f = keys[s:e], freq[s:e]
                first = np.lexsort((k, f))[:most_alone(len(k), threshold) + 1]
                place = np.arange(len(first), dtype=np.int32)
                met = f[first] > 1
                m = int(met.sum())
                out[0].append(k[first[met]].astype(np.int64))
                out[1].append(np.full(m, o, np.int64))
                out[2].append(np.full(m, len(k), np.int32))
                out[3].append(np.full(m, int((f > 1).sum()), np.int32))
                out[4].append(place[met])
        return _entries(*out)

    sent = stored(rows.mapInArrow(
        send, "block int, chunk string, keys binary, counts binary, owners binary, sizes binary"), "incidence")
    found = (sent.where("block >= 0").select("block", "chunk", "keys", "counts").groupBy("block")
             .applyInArrow(total, "chunk string, keys binary, freqs binary"))
    postings = stored(sent.where("block = -1").select("chunk", "keys", "owners", "sizes").groupBy("chunk")
                      .cogroup(found.groupBy("chunk"))
                      .applyInArrow(pick, "key long, owner long, n int, met int, place int"), "postings")
    release(sent)
    return postings


def _linked(pairs: DataFrame, rows: DataFrame, threshold: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose rows link."""
    x = rows.select(F.col("owner").alias("a"), F.col("keys").alias("ka"))
    y = rows.select(F.col("owner").alias("b"), F.col("keys").alias("kb"))

    def work(batch_iter):
        for t in batch_iter:
            a, b, keep = t.column(0), t.column(1), []
            for ka, kb in zip(t.column(2), t.column(3)):
                ka, kb = np.frombuffer(ka.as_py(), np.uint64), np.frombuffer(kb.as_py(), np.uint64)
                o = len(np.intersect1d(ka, kb, assume_unique=True))
                keep.append(100 * o >= threshold * (len(ka) + len(kb) - o))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    return (pairs.join(x, "a").join(y, "b").select("a", "b", "ka", "kb")
            .mapInArrow(work, "a long, b long"))


def _class_components(rows: DataFrame, postings: DataFrame, threshold: int) -> DataFrame | None:
    """(node, comp) of linked classes, stored; None if there is no link. Releases
    ``postings`` and what it stores itself."""
    links = comp = None
    news, kept = [], postings
    entry = ("key", "owner", "n", "met", "place")
    alone = F.floor(64 * (F.col("n") - F.col("met")) / F.col("n"))
    for turn in range(HUB_ROUNDS + 1):
        if comp is None:
            here = postings.withColumn("comp", F.col("owner"))
        else:
            here = (postings.join(comp.withColumnRenamed("node", "owner"), "owner", "left")
                    .withColumn("comp", F.coalesce("comp", "owner")))
        # a column's hub: first a row with few columns of its own, later any
        hub = F.struct((alone if turn == 0 else F.lit(0)).alias("alone"), F.xxhash64("owner", F.lit(turn)).alias("h"),
                       *(F.col(c) for c in ("owner", "comp", "n", "met")))
        # columns whose rows are not yet all connected
        open_keys = (here.groupBy("key").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"),
                                             F.min(hub).alias("_hub")).where("_lo < _hi"))
        here = stored(here.join(open_keys.select("key", "_hub"), "key"), "open")
        release(kept)
        kept, postings = here, here.select(*entry)
        if turn < HUB_ROUNDS:
            h = F.col("_hub")
            pairs = (here.where((h["comp"] != F.col("comp"))
                                & _reach(F.least("met", h["met"]), F.col("n"), h["n"], threshold))
                     .groupBy(F.col("owner").alias("a")).agg(F.min("_hub").alias("_h"))
                     .select("a", F.col("_h.owner").alias("b")))
        else:
            a, b = here.alias("a"), here.alias("b")
            smaller = (F.col("a.n") < F.col("b.n")) | (
                (F.col("a.n") == F.col("b.n")) & (F.col("a.owner") < F.col("b.owner")))
            # met at their rarest common column, two rows share no more than what
            # both have from there on
            most = F.least("a.met", "b.met", F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
            pairs = (a.join(b, (F.col("a.key") == F.col("b.key")) & smaller & (F.col("a.comp") != F.col("b.comp"))
                            & _reach(most, F.col("a.n"), F.col("b.n"), threshold))
                     .select(F.col("a.owner").alias("a"), F.col("b.owner").alias("b")).distinct())
        new = stored(_linked(pairs, rows, threshold), "linked")
        news.append(new)
        links = new if links is None else links.union(new)
        if new.limit(1).count():
            before, comp = comp, components(links)
            release(before)
        if not postings.limit(1).count():
            break
    release(kept, *news)
    return comp


def _members(docs: DataFrame, n: int, threshold: int) -> DataFrame:
    """One row per document: doc_id, text_hash, n, component_id and comp, the
    group (null for a document without shingles)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = shuffle_blocks(spark, docs.count(), DOCS_PER_BLOCK)
    first = stored(_shared_counts(_first_parts(docs, blocks, n, threshold)), "first")
    figures = first.where("kind = 0").select("doc_id", "text_hash", "n", "owner", "cls")
    classes = stored(figures.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                                F.first("owner").alias("owner")), "classes")
    shared = first.where("kind = 2").groupBy("owner").agg(F.sum("shared").alias("shared"))
    tested = F.least(F.col("n"), F.floor(FIRST_SHARE * F.col("n")).cast("int") + 1)
    allowed = F.col("n") - F.ceil(threshold * F.col("n") / 100.0)
    left = stored(classes.where("n > 0").join(shared, "owner")
                  .where(tested - F.col("shared") <= allowed).select("owner"), "left")
    rows = stored(_rows_left(docs, left, n), "rows")
    release(left)
    comp = _class_components(rows, _postings(rows, blocks, threshold), threshold)
    release(rows)
    if comp is not None:
        named = (classes.join(comp.withColumnRenamed("node", "owner").select("owner", "comp"), "owner", "left")
                 .withColumn("comp", F.coalesce("comp", "owner")))
        names = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
        named = named.join(names, "comp").select("cls", "comp", "component_id")
    else:
        named = classes.select("cls", F.col("owner").alias("comp"), F.col("doc_id").alias("component_id"))
    members = stored(figures.where("n > 0").join(named, "cls")
                     .select("doc_id", "text_hash", "n", "component_id", "comp")
                     .union(figures.where("n = 0").select("doc_id", "text_hash", "n", "doc_id", F.lit(None).cast("long"))),
                     "members")
    release(first, classes, comp)
    return members


def link_components(docs: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id
    reachable by links, itself included)."""
    return _members(docs, n, threshold).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group: of smallest id, null ids last; of rows
    that share this id the one of smallest text hash; of rows that repeat id and
    text any one. Blank texts are in no group and all stay. Further columns may have
    any name. The rows are shuffled once to meet their marks, also where few marks would
    be broadcast: what the job needs then follows its input."""
    every = _members(docs, n, threshold)
    members = stored(every.where("comp is not null")
                     .groupBy("comp", "doc_id", "text_hash").agg(F.count("*").alias("rows")), "copies")
    release(every)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    # stored: a join of two plain shuffles, in which a large group is split
    best = stored(members.groupBy("comp").agg(F.min(rank).alias("best")), "best")
    marked = (members.join(best, "comp").withColumn("gone", ~rank.eqNullSafe(F.col("best")))
              .where("gone or rows > 1")
              .select(F.col("doc_id").alias("keep_id"), F.col("text_hash").alias("keep_hash"), "gone"))
    marked = stored(marked, "marked")
    release(members, best)
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    whole = docs.select(F.struct(*quoted).alias("row"), F.col("doc_id").cast("long").alias("id"), _text_hash(docs).alias("own"))
    own = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("own") == F.col("keep_hash"))
    once = whole.join(marked.hint("merge"), own, "left_anti")
    repeated = whole.join(marked.where("not gone").hint("merge"), own, "left_semi").dropDuplicates(["id", "own"])
    return once.union(repeated).select(*[F.col("row")[c].alias(c) for c in docs.columns])
