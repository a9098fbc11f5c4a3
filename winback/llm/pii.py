"""Operator 5, personal data: patterns propose, checksums confirm, context adjusts.

Regular expressions propose spans per kind; a validator keeps or drops each
(ip parts at most 255, Luhn for cards, digit counts for phones, mod-97 for
IBANs). Emails, ips, cards and phones that pass are always reported with score
1. The method adds ``iban`` and ``secret`` spans: each starts from the score of
its pattern, gains for a passed checksum and for context words shortly before
the span, and is reported from ``min_score`` on.

Everything is one narrow projection of built-in functions; texts without the
characters a kind needs skip its pattern. The patterns use possessive
quantifiers and start only where a run starts, so a very long text costs time
in proportion to its length and no regex recursion.

Span offsets are code points, end exclusive. They come from splitting the text
at the matches and adding up lengths (in blocks of 64, so many matches do not
cost the square of their number).

Defined results. A null text counts as empty and gives no spans. Null ids,
repeated rows and further columns are left as they are; every row is judged for
itself. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.llm.common import text_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret")
# Same matches as the plain patterns, without their repeated scanning.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{9,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+",
}
# A text must match this before the pattern is tried.
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
          "iban": "[A-Z]{2}[0-9]{2}", "secret": r"(?i)(?:password|passwd|token|secret|api.?key)"}
CONTEXT = {"iban": r"(?i)\b(?:iban|bank|account|konto|cuenta|compte)\b",
           "secret": r"(?i)(?:password|passwd|token|secret|api.?key)[\x20\"'=:]*$"}
CONTEXT_CHARS = 40
PATTERN_SCORE = {"iban": 0.3, "secret": 0.2}
CHECK_SCORE = {"iban": 0.5, "secret": 0.3}
CONTEXT_SCORE = {"iban": 0.2, "secret": 0.5}
MIN_SCORE = 0.7
_BLOCK = 64
_SPANS = "array<struct<start:long,end:long,score:double>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a digit string."""
    return F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
            i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """ISO 13616 check: first four characters moved to the end, letters as 10..35."""
    s = F.regexp_replace(code, " ", "")
    moved = F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))
    return F.aggregate(
        F.split(moved, ""), F.lit(0),
        lambda a, c: F.when(F.ascii(c) >= 65, (a * 100 + F.ascii(c) - 55) % 97)
        .otherwise((a * 10 + F.ascii(c) - 48) % 97)) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        n = F.length(_digits(m))
        return n.between(13, 19) & luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _check(kind: str, m: Column) -> Column:
    """The confirming test of an added kind: mod-97, or a mix of digits and letters."""
    return mod97(m) if kind == "iban" else m.rlike("[0-9]") & m.rlike("[A-Za-z]")


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)


def _scorer(kind: str, text: Column):
    """Score of a span of an added kind: pattern, checksum, words just before it."""
    def score(s):
        frm = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0).cast("long"))
        before = F.substring(text, (frm + 1).cast("int"), (s["start"] - frm).cast("int"))
        v = (F.lit(PATTERN_SCORE[kind])
             + F.when(_check(kind, s["m"]), CHECK_SCORE[kind]).otherwise(0.0)
             + F.when(before.rlike(CONTEXT[kind]), CONTEXT_SCORE[kind]).otherwise(0.0))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("score"))
    return score


def find_spans(docs: DataFrame, kinds=KINDS, min_score: float = MIN_SCORE, keep=()) -> DataFrame:
    """doc_id, ``_t`` (text, null as empty), the ``keep`` columns, and for each kind
    ``<kind>_spans``: array of (start, end, score) in order of start."""
    d = docs.select("doc_id", text_of(docs).alias("_t"), *keep)
    t = F.col("_t")
    for kind in kinds:
        rx = PATTERNS[kind]
        hit = t.contains("@") if kind == "email" else t.rlike(GUARDS[kind])
        # matches, then the pieces between them, then running lengths
        d = d.withColumn("_ms", F.when(hit, F.regexp_extract_all(t, F.lit(rx), F.lit(0))))
        some = F.size("_ms") > 0
        d = d.withColumn("_len", F.when(some, F.transform(
            F.slice(F.split(t, rx, -1), 1, F.size("_ms")), lambda p: F.length(p).cast("long"))))
        ms, gap = F.col("_ms"), F.col("_len")
        d = d.withColumn("_both", F.when(some, F.transform(
            ms, lambda m, i: F.get(gap, i) + F.length(m))))
        both = F.col("_both")
        d = d.withColumn("_blocks", F.when(some, F.transform(
            F.sequence(F.lit(0), F.floor((F.size("_ms") - 1) / _BLOCK).cast("int")),
            lambda b: _total(F.slice(both, b * _BLOCK + 1, _BLOCK)))))
        blocks = F.col("_blocks")

        def span(m, i):
            b = F.floor(i / _BLOCK).cast("int")
            at = (_total(F.slice(blocks, F.lit(1), b))
                  + _total(F.slice(both, b * _BLOCK + 1, i % _BLOCK)) + F.get(gap, i))
            return F.struct(at.alias("start"), (at + F.length(m)).alias("end"), m.alias("m"))

        placed = F.filter(F.transform(ms, span), lambda s: _valid(kind, s["m"]))
        if kind in BASE_KINDS:
            scored = F.transform(placed, lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.lit(1.0).alias("score")))
        else:
            scored = F.filter(F.transform(placed, _scorer(kind, t)), lambda s: s["score"] >= min_score)
        d = d.withColumn(f"{kind}_spans", F.when(some, scored).otherwise(
            F.array().cast(_SPANS))).drop("_ms", "_len", "_both", "_blocks")
    return d


def _named(kind: str) -> Column:
    return F.transform(F.col(f"{kind}_spans"), lambda s: F.concat(
        F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def spans_string(kinds) -> Column:
    """``kind:start:end`` of all spans, by kind and start, comma-joined."""
    return F.array_join(F.concat(*[_named(k) for k in kinds]), ",")


def _ordered(kind: str) -> Column:
    return F.transform(F.col(f"{kind}_spans"), lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("neg_end"), F.lit(kind.upper()).alias("kind")))


def redact(docs: DataFrame, kinds=KINDS, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with every found span replaced by ``<KIND>``; where spans overlap
    the leftmost (then the longest) wins and the others lose the shared part.
    A null text stays null; all other columns are kept."""
    cols = docs.columns
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    d = find_spans(whole, kinds, min_score, keep=("_row",))
    d = d.withColumn("_all", F.sort_array(F.concat(*[_ordered(k) for k in kinds])))
    t, spans = F.col("_t"), F.col("_all")
    # from left to right: text up to the span, its mark, and where to go on
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(a, s):
        end, inside = -s["neg_end"], s["start"] < a["at"]
        cut = F.substring(t, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.when(inside, F.struct(a["out"].alias("out"), F.greatest(a["at"], end).alias("at"))).otherwise(
            F.struct(F.concat(a["out"], F.array(cut, F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("out"),
                     end.alias("at")))

    done = F.aggregate(spans, start, step, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substr(t, (a["at"] + 1).cast("int"))))
    text = F.when(F.col("_row.text").isNull(), F.col("_row.text")).when(
        F.size("_all") == 0, t).otherwise(done)
    return d.withColumn("_new", text).select(*[
        F.col("_new").alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in cols])
