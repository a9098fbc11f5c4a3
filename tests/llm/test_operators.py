"""Each operator against a brute-force version, on real and on hard rows."""

import hashlib
import math
import os
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from winback.llm import (bpe, imatch, license_scan, line_dedup, ngram_join, packing, pii, ppm,
                         quality_rules, suffix_dedup)

W = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_op1_base_and_model(docs, rows):
    got = [tuple(r) for r in ppm.score(docs, order=3, share=1e-6).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]
    train = [lower(t).encode() for i, t in rows if not ppm.held_out(i)]
    c = Counter(w for t in train for w in [*t.split(), b""])
    n = sum(c.values())
    d = n + 0.5 * (len(c) + 1)
    counts, total = [defaultdict(Counter) for _ in range(4)], 0
    for t in train:
        s = [257] * 3 + list(t) + [256]
        total += len(s) - 3
        for p in range(3, len(s)):
            for k in range(4):
                counts[k][tuple(s[p - k:p])][s[p]] += 1

    def logp(s, p):
        lp, gone = 0.0, set()
        for k in range(3, -1, -1):
            node = counts[k].get(tuple(s[p - k:p]), {})
            keep = {a: b for a, b in node.items() if b >= total * 1e-6}
            if not keep:
                continue
            left = {a: b for a, b in keep.items() if a not in gone}
            rest = sum(node.values()) - sum(keep.values())
            whole, esc = sum(left.values()) + rest, rest + 0.5 * len(left)
            if s[p] in left:
                return lp + math.log10((left[s[p]] - 0.5) / whole)
            if esc > 0:
                lp += math.log10(esc / whole)
            gone = set(keep)
        return lp - math.log10(257 - len(gone))

    want = {}
    for i, t in rows:
        t = lower(t).encode()
        words = [*t.split(), b""]
        want.setdefault((i, len(words)), (ppm.held_out(i), sum(c[w] > 0 for w in words),
                                          sum(math.log10((c[w] + 0.5) / d) for w in words), t))
    assert len(got) == len(rows)
    for j, (i, held, tokens, known, train_n, base, score) in enumerate(got):
        h, k, b, t = want[i, tokens]
        assert (held, known, train_n) == (h, k, n)
        assert base == pytest.approx(b, rel=1e-9)
        if j % 9 == 0 and len(t) < 5000:
            s = [257] * 3 + list(t) + [256]
            assert score == pytest.approx(sum(logp(s, p) for p in range(3, len(s))), rel=1e-9)


def test_op1_probabilities_sum_to_one():
    keys, counts = [], []
    g, _ = ppm.grams([b"abracadabra", b"abc"], 2)
    for k in range(3):
        u, c = np.unique(g & np.uint64((1 << (9 * (k + 1))) - 1), return_counts=True)
        keys.append(u)
        counts.append(c)
    trie = ppm.Trie(keys, counts, 2, len(g))
    for context in (b"ab", b"zz", b"ra", b"bz"):
        low = sum(b << (9 * (2 - i)) for i, b in enumerate(context))
        probs = 10 ** trie.log10(np.array([low | s for s in range(257)], np.uint64))
        assert probs.sum() == pytest.approx(1.0, abs=1e-9)


def test_op1_keeps_rare_contexts_of_a_large_corpus(spark):
    rows = [(i, "ab" * 500_000) for i in range(8)] + [(20, "quick zebras jump"), (21, "quick zebras")]
    assert not ppm.held_out(20)
    got = {r.doc_id: r.score for r in ppm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    train = [t.encode() for i, t in rows if not ppm.held_out(i)]
    g = np.concatenate([ppm.grams([t], 5)[0] for t in train])
    assert len(g) > 2 ** 22                             # a share of 2^-22 would cut what is met once
    levels = [np.unique(g & np.uint64((1 << (9 * (k + 1))) - 1), return_counts=True) for k in range(6)]
    trie = ppm.Trie([k for k, _ in levels], [c for _, c in levels], len(train), len(g))
    assert got[20] == pytest.approx(trie.log10(ppm.grams([rows[8][1].encode()], 5)[0]).sum(), rel=1e-9)
    assert got[21] == pytest.approx(trie.log10(ppm.grams([rows[9][1].encode()], 5)[0]).sum(), rel=1e-9)


def brute_components(rows, n=5, threshold=75):
    sets = []
    for i, t in rows:
        w = W.findall(lower(t))
        k = min(n, len(w))
        sets.append((i, {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()))
    parent, inv = list(range(len(sets))), defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (_, s) in enumerate(sets):
        c = Counter(y for k in s for y in inv[k])
        for k in s:
            inv[k].append(x)
        for y, o in c.items():
            if 100 * o >= threshold * (len(s) + len(sets[y][1]) - o):
                parent[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return [(i, len(s), least.get(find(x))) for x, (i, s) in enumerate(sets)]


def test_op2_components(docs, rows):
    same([tuple(r) for r in ngram_join.link_components(docs).collect()], brute_components(rows))


@pytest.mark.parametrize("threshold", [75, 60])
def test_op2_pairs_of_short_texts(spark, threshold):
    rng, rows = np.random.default_rng(9), []
    for words in (5, 6, 7, 8, 9, 10, 12):
        for j in range(12):
            w = [f"w{x}" for x in rng.integers(0, 10 ** 9, words + 1)]
            rows += [(len(rows), " ".join(w[:-1])), (len(rows) + 1, " ".join(w if j % 2 else [w[-1], *w[:-1]]))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    same([tuple(r) for r in ngram_join.link_components(d, threshold=threshold).collect()],
         brute_components(rows, threshold=threshold))


def test_op2_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(f"x{rng.integers(9)}" if rng.random() < 0.02 else w for w in base)) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    same([tuple(r) for r in ngram_join.link_components(d).collect()], brute_components(rows))
    assert ngram_join.keep_one(d).columns == ["doc_id", "text"]


def test_op2_keep_one_decides_by_row(spark):
    def text(seed, n=30):
        return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 10 ** 9, n))

    near = text(1) + " end"
    rows = [(1, text(1)), (1, text(1)), (2, near), (None, near), (3, text(2)), (3, text(1)), (4, text(3)), (4, text(3)),
            (None, text(4)), (None, text(4)), (None, text(5)), (5, text(6)), (5, text(6) + " end"), (5, text(7)),
            (6, ""), (6, ""), (None, None)]
    d = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, row string")
    got = [(r.doc_id, r.text) for r in ngram_join.keep_one(d).collect()]
    assert sum(r in got for r in [(5, text(6)), (5, text(6) + " end")]) == 1
    same([r for r in got if r[1] is None or not r[1].startswith(text(6))],
         [(1, text(1)), (3, text(2)), (4, text(3)), (None, text(4)), (None, text(5)), (5, text(7)),
          (6, ""), (6, ""), (None, None)])
    assert len(got) == 10 and ngram_join.keep_one(d).columns == d.columns


def test_op3_figures(spark, docs, rows, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = [tuple(r) for r in quality_rules.quality_figures(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()]

    def figures(t):
        w = W.findall(t)
        c = Counter(zip(w, w[1:], w[2:]))
        cover = {i + j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if W.search(x)]
        return (len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)),
                len(cover), len(w) < 50 or 2 * len(cover) > len(w))

    same(got, [(i, *figures(t)) for i, t in rows])
    kept = quality_rules.keep_documents(docs, labels)
    assert kept.columns == docs.columns


def test_op3_catches_bad_and_keeps_good(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    r = quality_rules.quality_figures(docs, labels).join(labels, "doc_id").collect()
    bad = [x.kept for x in r if x.quality == 0]
    good = [x.kept for x in r if x.quality == 1 and not x.base_failed]
    assert sum(bad) <= 0.05 * len(bad) and sum(good) >= 0.98 * len(good)


def brute_cut(rows, length=50):
    first = {}
    rows = [(i, t.encode()) for i, t in rows]
    for i, t in rows:
        for p in range(len(t) - length + 1 if i is not None else 0):
            first[t[p:p + length]] = min(i, first.get(t[p:p + length], i))
    out = []
    for i, t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1 if i is not None else 0):
            if first[t[p:p + length]] < i:
                gone[p:p + length] = True
        runs = int((gone[1:] < gone[:-1]).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_op4_removed_bytes(docs, rows):
    got = suffix_dedup.cut_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    same([tuple(r) for r in got.collect()], brute_cut(rows))


def test_op4_suffix_order():
    rng = np.random.default_rng(1)
    for _ in range(20):
        t = rng.integers(0, 3, 150)
        order = suffix_dedup.suffix_order(t, 50)
        keys = [tuple(t[i:i + 50].tolist()) for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(150))


def test_op5_base_spans(docs, rows):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
             "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
             "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, m):
        d = [int(x) for x in re.sub("[^0-9]", "", m)]
        back = d[::-1]
        luhn = (sum(back[::2]) + sum(x * 2 - 9 * (x > 4) for x in back[1::2])) % 10 == 0
        return {"email": True, "ip": kind != "ip" or all(int(x) < 256 for x in m.split(".")),
                "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]

    want = [(i, ",".join(f"{k}:{m.start()}:{m.end()}" for k, rx in kinds.items()
                         for m in re.finditer(rx, t) if ok(k, m[0]))) for i, t in rows]
    found = pii.find_spans(docs)
    same([tuple(r) for r in found.select("doc_id", pii.spans_string(pii.BASE_KINDS)).collect()], want)
    hard = found.where("doc_id = 900009").select(pii.spans_string(pii.KINDS)).first()[0]
    assert "iban:" in hard and "secret:" in hard
    text = pii.redact(docs).where("doc_id = 900009").first().text
    assert "<IBAN>" in text and "4111 1111 1111 1111" not in text and "password=<SECRET>" in text


def test_op6_equals_the_library(docs, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    want = []
    for i, t in rows:
        ids = tok.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    same([tuple(r) for r in bpe.encode_digests(docs).collect()], want)


def test_op6_every_character():
    """Every code point alone, between letters and beside a blank equals the library."""
    import sys

    from tokenizers import Tokenizer
    from winback.llm.wordtokens import FOREIGN, WordEncoder, split
    spec = open(bpe.default_vocabulary(), encoding="utf-8").read()
    tok, enc = Tokenizer.from_str(spec), WordEncoder(spec)
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    rare = [c for c in points if ord(c) >= 0x3000][::53]        # scripts without case or marks: a sample
    for some in (points[:0x3000], rare):
        texts = [t for c in some for t in (c, f"a{c}b", f"The {c} x{c}")]
        for t, (ids, text) in zip(texts, enc.encode(texts, decode=True)):
            want = tok.encode(t, add_special_tokens=False).ids
            assert ids.tolist() == want, (t, hex(ord(t[0])))
            assert text == tok.decode(want, skip_special_tokens=False)
    assert split("Ɓauna don’t GO") == [FOREIGN + "Ɓauna", FOREIGN + "don’t", "go"]


def test_op6_mixed_texts():
    import random

    from tokenizers import Tokenizer
    from winback.llm.wordtokens import WordEncoder
    spec = open(bpe.default_vocabulary(), encoding="utf-8").read()
    tok, enc, r = Tokenizer.from_str(spec), WordEncoder(spec), random.Random(2)
    chars = "abzEßŋŊƁɗɖƉé\u0301\u0308İıſσΣς日本—’'\"<|> \u00a0\u2003\t\n\u200b12²½😀sdtre"
    texts = ["".join(r.choice(chars) for _ in range(r.randrange(40))) for _ in range(4000)]
    texts += ["Ɓauna da Ɗan Kano", "Ŋutinya Ɖe", "it’s <|endoftext|> x<|endoftext|>y", "\u00a0 \u2003 a", "\u0301 a"]
    for t, (ids, text) in zip(texts, enc.encode(texts, decode=True)):
        want = tok.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want, t
        assert text == tok.decode(want, skip_special_tokens=False)


def test_op6_automaton():
    words = sorted({b"car", b"cars", b"cat", b"cats", b"dog", b"dogs", b"", b"\xff"})
    lex = bpe.Lexicon(bpe.Lexicon.build(words, [[i] for i in range(len(words))]))
    assert lex.find(words).tolist() == list(range(len(words)))
    assert lex.find([b"ca", b"catss", b"x"]).tolist() == [-1, -1, -1]
    assert len(lex.keys) < sum(map(len, words)) + len(words)        # endings are shared


def test_op7_pieces(docs, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    got = packing.pack(docs).collect()
    want = Counter()
    for i, t in rows:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        for a, b in packing.cuts(len(ids), 2048):
            want[i, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b])), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    seq = defaultdict(list)
    for r in got:
        seq[r.sequence_id].append((r.offset, r.length))
    for s in seq.values():
        assert [o for o, _ in sorted(s)] == [sum(x for _, x in sorted(s)[:k]) for k in range(len(s))]
        assert sum(x for _, x in s) <= 2048
    assert sum(r.length for r in got) >= 0.97 * 2048 * (len(seq) - 1)


def test_op8_edits(docs, rows):
    got = imatch.edit_pairs(docs).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter((i, len(t), hashlib.sha256(imatch._edited(t, after).encode()).hexdigest())
                   for (i, t), (_, after) in zip(order, order[1:] + order[:1]))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.8
    alone = {r.doc_id: r.fingerprint for r in imatch.fingerprints(docs).collect()}
    assert all(r.fingerprint == alone[r.doc_id] for r in got)


def test_op9_licenses(spark):
    d = spark.createDataFrame([(1, "x y z\nReleased under the MIT License.\nmore"), (2, None), (3, "a license to sing"),
                               (4, "This work is licensed under the GNU General Public License, version 3."),
                               (5, "Licensed under CC BY-NC 4.0.")], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in license_scan.scan(d).collect()}
    assert got == {1: ["MIT"], 2: [], 3: [], 4: ["GPL-3.0"], 5: ["CC-BY-NC-4.0"]}


def test_op9_long_lines_wrapped_and_several_notices(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files")
    other = "some other plain words of a page that says nothing on its terms of use or on who wrote it ".split()
    rows, want = [], {}

    def add(text, *names):
        rows.append((len(rows), text))
        want[len(rows) - 1] = sorted(names)

    for n in (5, 10, 15, 57, 200):
        before, after = " ".join((other * 12)[:n]), " ".join((other * 12)[3:n + 3])
        add(f"{before} Licensed under CC BY 4.0. {after}", "CC-BY-4.0")
        add(f"{before} Released under the MIT License. {after}", "MIT")
        add(f"{before} Licensed under the Apache License, Version 2.0. {after}", "Apache-2.0")
    for width in (2, 3, 5, 9):
        for mark in ("", "# ", " * "):
            for name in ("MIT", "GPL-3.0", "Apache-2.0", "BSD-3-Clause"):
                w = license_scan.TEMPLATES[name][-2].split()        # the last one names the SPDX id
                add("a title\n" + "\n".join(mark + " ".join(w[i:i + width]) for i in range(0, len(w), width)) + "\nend", name)
    add("Permission is hereby\ngranted, " + mit.split(", ", 1)[1], "MIT")
    add("Released under the MIT License. Licensed under the Apache License, Version 2.0. Licensed under CC BY 4.0. "
        "Released under the BSD 3-Clause License.", "MIT", "Apache-2.0", "CC-BY-4.0", "BSD-3-Clause")
    for name, texts in license_scan.TEMPLATES.items():
        for t in texts:
            add(t, name)                # and not its neighbours of nearly the same words
    add("Not released under the MIT License. It isn't licensed under CC BY 4.0.")
    add("This project is licensed under the MIT License, see the file", "MIT")
    add("This work is licensed under the GNU General Public License, version 4.")
    add("x. SPDX-License-Identifier: MIT */ int main() {}", "MIT")
    gpl = license_scan.TEMPLATES["GPL-2.0-or-later"][0]
    add(gpl.replace("free software:", "free software;"), "GPL-2.0-or-later")
    add(license_scan.TEMPLATES["LGPL-2.1-or-later"][0], "LGPL-2.1-or-later")
    add("the license of a driver is granted by the office, free of charge")
    got = {r.doc_id: r.licenses for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_op9_ranking_by_saving_loses_nothing():
    """Every block confirmed with every template, against those that pass the saving."""
    import random
    r = random.Random(11)
    by_saving, by_wording = (license_scan.Scanner(license_scan.TEMPLATES, x) for x in (license_scan.MIN_SAVING, -1e9))
    plain = "some other words of a page on its terms of use and who wrote it, the free software license or copyright".split()
    least = 1.0
    for _ in range(700):
        text = []
        for t in r.sample(by_wording.known, r.choice([1, 1, 2])):
            w = list(t.words)
            for _ in range(r.randrange(t.allowed + 1)):
                w[r.randrange(len(w))] = r.choice(plain)
            n = r.choice([0, 2, 9, 40, 150])
            text += [*(r.choice(plain) for _ in range(n)), *w, *(r.choice(plain) for _ in range(n))]
        places = [i for i, x in enumerate(text) if x in by_wording.of]
        least = min([least, *(x for x, at, t in by_wording.ranked(text, places) if t.place(text, at))])
        assert by_saving.text(" ".join(text))[1] == by_wording.text(" ".join(text))[1]
    assert least > license_scan.MIN_SAVING + 0.05


def test_op9_templates_of_the_caller(spark):
    own = {"House-1": ["All rights in these recipes remain with the kitchen that cooked them first."], "Empty": [""]}
    d = spark.createDataFrame([(1, "so: all rights in these recipes remain with the kitchen\nthat cooked them first"),
                               (2, "Released under the MIT License."), (None, None)], "doc_id long, text string")
    assert sorted(((r.doc_id, r.licenses) for r in license_scan.scan(d, own).collect()), key=str) == sorted(
        [(1, ["House-1"]), (2, []), (None, [])], key=str)
    assert [r.licenses for r in license_scan.scan(d, {}).collect()] == [[], [], []]


def test_op10_lines(docs):
    pages, lines = defaultdict(set), defaultdict(set)
    all_rows = docs.select("doc_id", "source", "text").collect()
    for r in all_rows:
        if r.text is not None:
            pages[r.source].add(r.text)
            for x in r.text.split("\n"):
                if x.strip(" \t\x0b\f\r"):
                    lines[r.source, x.strip(" \t\x0b\f\r")].add(r.text)
    gone = {k for k, v in lines.items() if len(v) >= 5 and len(v) > 0.1 * len(pages[k[0]])}
    want = [(r.doc_id, r.text if r.text is None else "\n".join(
        x for x in r.text.split("\n") if (r.source, x.strip(" \t\x0b\f\r")) not in gone)) for r in all_rows]
    same([tuple(r) for r in line_dedup.drop_boilerplate(docs).select("doc_id", "text").collect()], want)


def test_empty_tables(spark, empty, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for f in (lambda d: ppm.score(d), ngram_join.link_components, ngram_join.keep_one,
              lambda d: quality_rules.quality_figures(d, labels.limit(0)), suffix_dedup.cut_repeats,
              pii.find_spans, pii.redact, bpe.encode_digests, packing.pack, imatch.edit_pairs, license_scan.scan,
              line_dedup.drop_boilerplate):
        assert f(empty).count() == 0


def _links(texts, threshold=75):
    """Component numbers of texts by all pairs."""
    sets = []
    for t in texts:
        w = W.findall(lower(t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= threshold * len(a | sets[j]):
                comp = [min(comp[i], comp[j]) if c in (comp[i], comp[j]) else c for c in comp]
    return comp


@pytest.mark.parametrize("owners", [ngram_join.TABLE_OWNERS, 0])
def test_op2_rows_left_by_table_and_by_join(spark, owners, monkeypatch):
    import random
    r = random.Random(8)
    monkeypatch.setattr(ngram_join._rows_left, "__defaults__", (owners,))
    base = [[f"w{r.randrange(400)}" for _ in range(40)] for _ in range(30)]
    texts = []
    for i in range(300):
        w = list(r.choice(base))
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = f"x{i}"
        texts.append(" ".join(w))
    ids = [None if r.random() < 0.3 else r.randrange(200) for _ in texts]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    comp = _links(texts)
    names = {c: min((i for i, d in zip(ids, comp) if d == c and i is not None), default=None) for c in comp}
    got = Counter((x.doc_id, x.component_id) for x in ngram_join.link_components(docs).collect())
    assert got == Counter((i, names[c]) for i, c in zip(ids, comp))
    kept = ngram_join.keep_one(docs).collect()
    at = {}
    for t, c in zip(texts, comp):
        at.setdefault(t, c)
    assert sorted(at[x.text] for x in kept) == sorted(set(comp))


def test_op2_null_ids_meet_no_text(spark):
    """500 rows with null ids: what is sent grows with the rows, not with their square."""
    docs = spark.createDataFrame([(None, f"one two three four five six seven a{i} b{i} c{i}") for i in range(500)],
                                 "doc_id long, text string")
    left = spark.createDataFrame([(ngram_join.class_of(ngram_join.Shingler().of(r.text))[1],) for r in docs.collect()], "owner long")
    rows = ngram_join._rows_left(docs, left, 5)
    assert rows.count() == 500
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "doc_id" not in plan.split("MapInArrow")[0]


def test_stages_take_columns_of_any_name(spark):
    text = "word " * 60 + "Some more of the same text with a few other words in it."
    rows = [(1, text, "a", 1, 5, 7), (2, text, "a", 2, 6, 8), (None, None, None, 3, 7, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `m.n` int, _keep_own int, row int")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2]], key=str)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality_rules.keep_documents(docs, labels).columns == docs.columns
    assert quality_rules.keep_documents(docs, labels).collect() is not None


def test_op3_fits_on_all_labels(spark):
    """More than 20,000 labelled rows: each of them counts, whatever its hash."""
    word = F.concat(F.lit("w"), F.col("id").cast("string"))
    docs = spark.range(0, 22_000, 1, 2).select(F.col("id").alias("doc_id"), word.alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(None, "lone"), (None, "lone")], "doc_id long, text string"))
    labels = docs.where("doc_id is not null").select("doc_id", F.lit(1).alias("quality"))
    ratios = quality_rules.log_ratios(docs, quality_rules.labelled(labels))
    b = docs.select(F.pmod(F.xxhash64("text"), F.lit(quality_rules.BUCKETS)).alias("b"), "doc_id").collect()
    raw, good = Counter(r.b for r in b), Counter(r.b for r in b if r.doc_id is not None)
    n = quality_rules.BUCKETS
    want = [math.log((good[i] + 1) / (22_000 + n)) - math.log((raw[i] + 1) / (22_002 + n)) for i in range(n)]
    assert max(abs(x - y) for x, y in zip(ratios, want)) < 1e-12


def test_op3_labels_may_be_shuffled(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    want = quality_rules.quality_figures(docs, labels).collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        same(quality_rules.quality_figures(docs, labels).collect(), want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_op3_labels_meet_texts_the_same_way_at_every_size(spark, docs):
    for n in (0, 3, 5_000):
        labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
        plan = quality_rules._marked(docs, quality_rules.labelled(labels))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_workers_give_freed_memory_back():
    import psutil

    from winback.llm.common import trim
    me = psutil.Process()
    held = [b"x" * 100_000 for _ in range(3_000)]
    held, full = held[-1:], me.memory_info().rss        # the last one keeps the heap's end in use
    trim()
    assert held and full - me.memory_info().rss > 100e6


def left_on_disk(monkeypatch, *modules):
    """Names and columns of the tables that these modules store from here on and keep."""
    from winback.llm import common
    made = []

    def stored(df, name):
        made.append((name, common.stored(df, name)))
        return made[-1][1]

    for m in modules:
        monkeypatch.setattr(m, "stored", stored)
    return lambda: {name: t.columns for name, t in made if os.path.exists(t.stored_path.removeprefix("file:"))}


def test_op2_leaves_only_marks_on_disk(spark, monkeypatch):
    from winback.llm import graph
    base = " ".join(f"w{i}" for i in range(60))
    d = spark.createDataFrame([(i, f"{base} x{i}" if i < 20 else f"{base} {base} y{i}") for i in range(40)],
                              "doc_id long, text string")
    left = left_on_disk(monkeypatch, ngram_join, graph)
    assert ngram_join.keep_one(d).count() < 40
    assert list(left()) == ["marked"]


def test_stages_meet_texts_by_one_shuffle_at_every_size(spark, sf_dir):
    """Few marks or verdicts, which would be broadcast, are met as many are."""
    text = "some words of a text that comes back with one word more at its end"
    d = spark.createDataFrame([(1, text), (1, text), (2, text + " x"), (3, "other"), (None, text), (4, None)],
                              "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    for kept in (ngram_join.keep_one(d), quality_rules.keep_documents(d, labels)):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_op3_keep_documents_stores_no_text_and_keeps_every_row(spark, monkeypatch):
    r = np.random.default_rng(3)

    def text(words, n=60):
        return " ".join(f"{words}{x}" for x in r.integers(0, 40, n))

    rows = [(i, text("good" if i % 3 else "bad")) for i in range(60)]
    rows += [rows[1], rows[1], rows[3], (None, rows[1][1]), (None, rows[2][1]), (None, rows[3][1]), (None, None), (70, None),
             (70, ""), (1, text("bad")), (1, text("good")), (71, rows[1][1])]
    docs = spark.createDataFrame([(i, t, str(n), 7) for n, (i, t) in enumerate(rows)], "doc_id long, text string, _row string, _k1 int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60) if i != 1], "doc_id long, quality int")
    left = left_on_disk(monkeypatch, quality_rules)
    got = quality_rules.keep_documents(docs, labels)
    assert got.columns == docs.columns
    same([tuple(x) for x in got.collect()],
         [(i, t, str(n), 7) for n, (i, t) in enumerate(rows) if t and t.startswith("good")])
    assert left() == {"quality": ["doc_id", "_k1", "_k2", "base_failed", "quality_score"]}
