"""Operator 3, quality rules: hashed n-gram log-likelihood ratio.

Word unigrams and bigrams are hashed into a fixed number of buckets. Two
multinomials over the buckets are counted: one on trusted documents (labelled
``quality = 1``) and one on the whole raw corpus. A document's score is the
mean over its n-grams of ``log(p_trusted / p_raw)``; every document is compared
with one threshold. Only DataFrame functions run. Texts are shuffled once, to meet
their labels; the two counts are map-side combined into ``buckets`` rows and the
per-bucket log ratios (``buckets`` doubles, a fixed size) return as a constant
of the scoring plan.

All labelled rows are used, for the trusted counts and for the threshold; the raw
counts and the scores cover every document. Labels are joined by id, by a shuffle of
both sides whatever their number, so the disk needed is the texts' own size and grows
with them alone. The figures of the scored rows are stored, without their texts, so a text is scored
once: the threshold is read off the stored scores of all labelled documents. It is the score that best separates the
two labels (balanced accuracy) among those that reject at most ``max_loss`` of
the trusted ones. Without labels of both kinds no document is rejected by score.

Defined results. Null text counts as empty; no words: all figures 0, score 0.0,
``base_failed`` (fewer than 50 words). Null ids stay as rows. Repeated rows are
scored each for itself. An empty table gives an empty result. Labels of
repeated or null ids: an id counts as trusted if any of its labels says 1.
Columns besides ``doc_id`` and ``text`` are ignored by ``quality_figures`` and
kept as they are by ``keep_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.llm.common import release, stored, text_of, words_of

BUCKETS = 1 << 14
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
MAX_LOSS = 0.002        # share of trusted documents that the threshold may reject
HIST_STEP = 0.01        # resolution of the threshold


def ngram_buckets(hashes: Column, buckets: int) -> Column:
    """Bucket numbers of the unigrams and of the bigrams of a word-hash array."""
    uni = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    bi = F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))),
                     lambda h, i: F.pmod(F.xxhash64(h, F.get(hashes, i + 1)),
                                         F.lit(buckets)).cast("int"))
    return F.concat(uni, bi)


def _with_words(docs: DataFrame, *keep: str) -> DataFrame:
    return (docs.select("doc_id", text_of(docs).alias("_t"), *keep)
            .withColumn("_w", words_of(F.col("_t")))
            .withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w))))


def _sum(array: Column, zero: Column) -> Column:
    return F.aggregate(array, zero, lambda a, x: a + x)


def _with_figures(words: DataFrame) -> DataFrame:
    """The rule figures of each text (see the contract of ``quality_figures``).

    Repeated 3-word windows: each window's hash is packed with its position into
    one long and the array sorted, so equal windows become neighbours (n log n);
    neighbours that agree in the packed bits are confirmed on the whole hash. Texts
    whose windows all differ, as their distinct count tells, go without that."""
    t, h, bits = F.col("_t"), F.col("_h"), F.col("_bits")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    s, win = F.col("_sorted"), F.col("_win")

    def same(x, y):
        return F.coalesce(
            (F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0)
            & (F.get(win, x.bitwiseAND(mask).cast("int")) == F.get(win, y.bitwiseAND(mask).cast("int"))),
            F.lit(False))

    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\f\r")) != "")
    at = F.col("_at")
    return (words
            # not null, so that the packed windows are sorted as plain longs
            .withColumn("_bits", F.coalesce(F.ceil(F.log2(F.size("_w") + 2.0)).cast("int"), F.lit(1)))
            .withColumn("_win", F.transform(
                F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))),
                lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))))
            .withColumn("_again", F.size(F.array_distinct("_win")) < F.size("_win"))
            .withColumn("_sorted", F.when(F.col("_again"), F.sort_array(F.transform(
                win, lambda x, i: F.call_function("shiftleft", x, bits).bitwiseOR(i.cast("long")))))
                .otherwise(F.array().cast("array<long>")))
            .withColumn("_at", F.sort_array(F.transform(
                F.filter(s, lambda x, i: same(x, F.get(s, i + 1)) | same(x, F.get(s, i - 1))),
                lambda x: x.bitwiseAND(mask))))
            .withColumn("_lines", lines)
            .withColumn("n_words", F.size("_w").cast("long"))
            .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count(t, F.lit(SYMBOLS)).cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("n_repeat_words", _sum(F.transform(
                at, lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))),
                F.lit(0).cast("long")))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))


def labelled(labels: DataFrame) -> DataFrame:
    """Every labelled id once: (doc_id, _good 0/1)."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("_good")))


def _spread(docs: DataFrame) -> Column:
    """A second join key that deals out the rows without an id, which match no label."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64(text_of(docs))).otherwise(F.lit(0).cast("long"))


def _text_key(text: Column) -> list[Column]:
    """Two hashes that tell a text, _k1 and _k2."""
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2")]


def _literal(values: list[float]) -> Column:
    """A constant array<double>, folded once by the optimizer."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def _marked(docs: DataFrame, own: DataFrame) -> DataFrame:
    """(text, _good) of every row; _good is null where no label says 1. Both sides are
    shuffled also where few labels would be broadcast: what the job needs then follows
    its input."""
    good = own.where("_good = 1").select("doc_id", F.lit(0).cast("long").alias("_key"), "_good")
    return (docs.select("doc_id", "text", _spread(docs).alias("_key"))
            .join(good.hint("merge"), ["doc_id", "_key"], "left"))


def log_ratios(docs: DataFrame, own: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """``log(p_trusted / p_raw)`` per bucket, add-one smoothed. Two sums per
    bucket over the whole corpus, combined before the shuffle."""
    counts = (_with_words(_marked(docs, own), "_good")
              .select(F.coalesce("_good", F.lit(0)).alias("_good"),
                      F.explode(ngram_buckets(F.col("_h"), buckets)).alias("b"))
              .groupBy("b").agg(F.count("*").alias("raw"), F.sum("_good").alias("good")))
    counts = stored(counts, "gram_counts")  # stored: the shuffled texts are given back here
    raw, good_n = [1.0] * buckets, [1.0] * buckets
    for b, r, g in counts.collect():        # at most ``buckets`` rows
        raw[b] += r
        good_n[b] += g
    release(counts)
    if sum(good_n) == buckets:              # nothing trusted: no evidence either way
        return [0.0] * buckets
    sr, sg = sum(raw), sum(good_n)
    return [math.log(g / sg) - math.log(r / sr) for g, r in zip(good_n, raw)]


def _with_score(words: DataFrame, ratios: list[float]) -> DataFrame:
    n = F.size("_w") + F.greatest(F.size("_w") - 1, F.lit(0))
    grams = ngram_buckets(F.col("_h"), len(ratios))
    total = F.aggregate(grams, F.lit(0.0), lambda a, b: a + F.get(_literal(ratios), b))
    return words.withColumn("quality_score", F.when(n > 0, total / n).otherwise(0.0))


def threshold(scored: DataFrame, own: DataFrame, max_loss: float = MAX_LOSS) -> float:
    """Cut with the best balanced accuracy on all labelled rows of ``scored`` (doc_id,
    base_failed, quality_score) among those that reject at most ``max_loss`` of the
    trusted documents."""
    hist = (scored.join(own.hint("merge"), "doc_id")
            .groupBy("base_failed", F.floor(F.col("quality_score") / HIST_STEP).alias("b"))
            .agg(F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad"))
            .orderBy("b").collect())        # one row per score step
    hist = [r for r in hist if not r.base_failed]
    good, bad = sum(r.good for r in hist), sum(r.bad for r in hist)
    best, cut, lost, caught = 0.0, -math.inf, 0, 0
    if not good or not bad:
        return cut
    for r in hist:
        lost, caught = lost + r.good, caught + r.bad
        gain = caught / bad - lost / good
        if lost <= max_loss * good and gain > best:
            best, cut = gain, (r.b + 1) * HIST_STEP
    return cut


def _scored(docs: DataFrame, ratios: list[float], *keep: str) -> DataFrame:
    return _with_score(_with_figures(_with_words(docs, *keep)), ratios)


def quality_figures(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
                    max_loss: float = MAX_LOSS) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, quality_score, kept."""
    own = labelled(labels)
    figures = stored(_scored(docs, log_ratios(docs, own, buckets)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "quality_score"), "quality")
    return _verdict(figures, threshold(figures, own, max_loss))


def _verdict(scored: DataFrame, cut: float) -> DataFrame:
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality_score") >= F.lit(float(cut))))


def keep_documents(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
                   max_loss: float = MAX_LOSS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged. Only figures are stored:
    the rows meet their verdict by id and 128 bits of hash of the text, on which it depends,
    by a shuffle at every size."""
    own = labelled(labels)
    ratios = log_ratios(docs, own, buckets)
    scored = stored(_scored(docs, ratios).select("doc_id", *_text_key(F.col("_t")), "base_failed", "quality_score"),
                    "quality")
    kept = (_verdict(scored, threshold(scored, own, max_loss)).where("kept")
            .select(F.col("doc_id").alias("_id"), F.col("_k1").alias("_l1"), F.col("_k2").alias("_l2")))
    whole = docs.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("_row"),
                        "doc_id", *_text_key(text_of(docs)))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_k1") == F.col("_l1")) & (F.col("_k2") == F.col("_l2"))
    return whole.join(kept.hint("merge"), same, "left_semi").select("_row.*")
