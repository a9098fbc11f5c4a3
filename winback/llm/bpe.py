"""Operator 6, BPE encoding and decoding with a minimal acyclic transducer.

1. The corpus' words are counted (map-side combined), and words that hold at
   least ``share`` of all words become the lexicon. At most ``1 / share`` words
   can do so, however large the corpus: that bounds the automaton.
2. Each lexicon word is encoded once; the words are compiled into a minimal
   acyclic automaton with shared prefixes and suffixes. The sum of the skip
   counts along a word's path is the word's number, which indexes its ids.
3. The automaton is one flat integer array in the shared folder, handed to the
   executors with ``addFile`` and memory-mapped by their Python workers.
4. Every text is split into words; each distinct word of a task is looked up in
   the automaton once, all words of a batch in step, and words that it lacks
   are merged exactly. Ids are gathered by index, so a frequent word costs one
   dictionary lookup per occurrence.

Results equal the library's ``encode(add_special_tokens=False)`` and
``decode(skip_special_tokens=False)`` on the same vocabulary.

Defined results. Null text counts as empty: no ids, empty decoded text. Null
ids, repeated rows and other columns do not matter: every row is encoded for
itself. An empty table gives an empty result (and an empty lexicon). A text is
encoded whole, however long; one text must fit in a worker's memory.
"""

from __future__ import annotations

import hashlib
import io
import os
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.llm.common import bounded_batches, stored
from winback.llm.wordtokens import FOREIGN, WordEncoder, batches, default_vocabulary, kept_encoder, read_json, split
from winback.session import scratch_path

SHARE = 2.0 ** -18
FLUSH_WORDS = 300_000


# -- the automaton ----------------------------------------------------------

def compile_automaton(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimal acyclic automaton of sorted distinct words: (edge keys, targets,
    skips), edges sorted by ``state * 257 + label``. Label 0 ends a word, label
    b + 1 is byte b. An edge's skip is the number of words that leave its state
    by smaller labels, so skips add up to the word's number."""
    register: dict[tuple, int] = {}
    edges: list[tuple] = []                  # by state: ((label, target), ...)
    counts: list[int] = []                   # words below a state

    def freeze(children: list) -> int:
        key = tuple(children)
        state = register.get(key)
        if state is None:
            state = register[key] = len(edges)
            edges.append(key)
            counts.append(sum(1 if t < 0 else counts[t] for _, t in key))
        return state

    path: list[list] = [[]]                  # open states from the root down
    labels: list[int] = []
    for word in words:
        own = [b + 1 for b in word]
        same = 0
        while same < len(labels) and same < len(own) and labels[same] == own[same]:
            same += 1
        while len(labels) > same:            # what the last word has beyond is final
            state = freeze(path.pop())
            path[-1].append((labels.pop(), state))
        for b in own[same:]:
            labels.append(b)
            path.append([])
        path[-1].append((0, -1))
    while labels:
        state = freeze(path.pop())
        path[-1].append((labels.pop(), state))
    root = freeze(path.pop())
    n = len(edges)                           # the root is the last state; make it 0
    key, target, skip = [], [], []
    for state, out in enumerate(edges):
        below = 0
        for label, t in out:
            key.append((n - 1 - state) * 257 + label)
            target.append(n - 1 - t if t >= 0 else -1)
            skip.append(below)
            below += 1 if t < 0 else counts[t]
    assert root == n - 1
    order = np.argsort(np.array(key, np.int64), kind="stable")
    return (np.array(key, np.int64)[order], np.array(target, np.int64)[order],
            np.array(skip, np.int64)[order])


class Lexicon:
    """Lookup in a compiled automaton laid out in one integer array."""

    def __init__(self, flat: np.ndarray):
        e, w, n = (int(x) for x in flat[:3])
        self.keys, self.targets, self.skips = (flat[3 + i * e: 3 + (i + 1) * e] for i in range(3))
        at = 3 + 3 * e
        self.starts, self.ids = flat[at: at + w + 1], flat[at + w + 1: at + w + 1 + n]

    @staticmethod
    def build(words: list[bytes], ids: list[list[int]]) -> np.ndarray:
        """The flat array of sorted distinct ``words`` with their ids."""
        keys, targets, skips = compile_automaton(words)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        flat_ids = np.array([i for x in ids for i in x], np.int64)
        head = np.array([len(keys), len(words), len(flat_ids)], np.int64)
        return np.concatenate([head, keys, targets, skips, starts, flat_ids])

    def find(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 where the lexicon lacks it. All words take
        one step of the automaton at a time."""
        n = len(words)
        number = np.zeros(n, np.int64)
        if not len(self.keys):
            return number - 1
        lens = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(lens) - lens
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        state = np.zeros(n, np.int64)
        live = np.arange(n)
        step = 0
        while len(live):
            inside = step < lens[live]
            label = np.where(inside, data[np.minimum(begin[live] + step, len(data) - 1)] + 1, 0)
            want = state[live] * 257 + label
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[at] == want
            number[live[~hit]] = -1
            number[live[hit]] += self.skips[at[hit]]
            state[live[hit]] = self.targets[at[hit]]
            live = live[hit & inside]
            step += 1
        return number

    def ids_of(self, number: int) -> np.ndarray:
        return self.ids[self.starts[number]: self.starts[number + 1]]


# -- Spark ------------------------------------------------------------------

def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts: counted per task, then summed."""
    def count(batch_iter):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(list(seen.keys()), pa.string()),
                 "n": pa.array(list(seen.values()), pa.int64())})

        for batch in batch_iter:
            for _, texts in batches(batch.column(0)):
                for t in texts:
                    seen.update(w for w in split(t) if w[0] != FOREIGN)
                if len(seen) > FLUSH_WORDS:
                    yield out()
                    seen.clear()
        yield out()

    return (docs.select(F.col("text").cast("string")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, vocabulary: str, share: float = SHARE) -> np.ndarray:
    """Automaton of the words holding at least ``share`` of all words. What
    reaches the driver is at most ``1 / share`` words."""
    from tokenizers import Tokenizer

    counts = stored(count_words(docs), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") >= F.lit(total * share)).select("word").collect()
    words = sorted(r.word for r in rows)
    words.sort(key=lambda w: w.encode())
    tok = Tokenizer.from_str(read_json(vocabulary))
    ids = [e.ids for e in tok.encode_batch(words, add_special_tokens=False)]
    return Lexicon.build([w.encode() for w in words], ids)


def publish(spark: SparkSession, flat: np.ndarray) -> str:
    """Put the flat array into the shared folder and hand it to the executors;
    returns the name under which workers find it."""
    name = f"lexicon_{uuid.uuid4().hex[:12]}.npy"
    path = os.path.join(scratch_path(spark, "llm"), name)
    buf = io.BytesIO()
    np.save(buf, flat)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target, True)
    out.write(bytearray(buf.getvalue()))
    out.close()
    spark.sparkContext.addFile(path)
    return name


def mapped_lexicon(name: str) -> Lexicon:
    """The published automaton, memory-mapped (in a Python worker)."""
    return Lexicon(np.load(SparkFiles.get(name), mmap_mode="r"))


def encode(docs: DataFrame, vocabulary: str | None = None, share: float = SHARE,
           as_text: bool = False) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit) and n_tokens of every
    text; with ``as_text`` also the text that the ids decode to."""
    return _run(docs, vocabulary, share, _full if as_text else _ids)


def encode_digests(docs: DataFrame, vocabulary: str | None = None, share: float = SHARE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""
    return _run(docs, vocabulary, share, _digests)


def _le(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


_ids = ("n_tokens long, ids binary", False, lambda ids, _: (len(ids), _le(ids)))
_full = ("n_tokens long, ids binary, decoded string", True,
         lambda ids, text: (len(ids), _le(ids), text))
_digests = ("n_tokens long, ids_sha256 string, decoded_sha256 string", True,
            lambda ids, text: (len(ids), hashlib.sha256(_le(ids)).hexdigest(),
                               hashlib.sha256(text.encode()).hexdigest()))


def _run(docs: DataFrame, vocabulary: str | None, share: float, what) -> DataFrame:
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    bounded_batches(spark)
    fields, decode, row = what
    lexicon = publish(spark, build_lexicon(docs, vocabulary, share))
    spec = spark.sparkContext.broadcast(read_json(vocabulary))
    names = [f.split()[0] for f in fields.split(", ")]

    def work(batch_iter):
        enc = kept_encoder(lexicon, lambda: WordEncoder(spec.value, mapped_lexicon(lexicon)))
        for batch in batch_iter:
            for start, texts in batches(batch.column(1)):
                got = [row(*x) if decode else row(x, None) for x in enc.encode(texts, decode)]
                cols = dict(zip(names, zip(*got)))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column(0).slice(start, len(texts)),
                     **{k: pa.array(v) for k, v in cols.items()}})

    src = docs.select("doc_id", F.col("text").cast("string"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(work, f"doc_id {kind}, {fields}")


def decode(ids: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and ``decoded`` text of rows (doc_id, ids binary); null ids count
    as none."""
    vocabulary = vocabulary or default_vocabulary()
    spec = ids.sparkSession.sparkContext.broadcast(read_json(vocabulary))

    def work(batch_iter):
        strings = WordEncoder(spec.value).strings
        for batch in batch_iter:
            out = [" ".join([strings[i] for i in np.frombuffer(x.as_py() or b"", "<u4")])
                   for x in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "decoded": pa.array(out, pa.string())})

    src = ids.select("doc_id", "ids")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(work, f"doc_id {kind}, decoded string")
