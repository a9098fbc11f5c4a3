"""Per-task encoder shared by BPE and packing: words to token ids, exactly as
the tokenizers library encodes, with each distinct word resolved once.

A text is lower-cased and split into words by the vocabulary's own rule, where its
characters are Latin letters and plain blanks (there lower-casing, normalisation and
the letter classes are the same everywhere). No word reaches over a blank, so a text
is cut at blanks where it has other characters, and only the pieces that hold them go
to the library, each distinct one once per task. A word is looked up in the lexicon
automaton first; words that it lacks are merged exactly by the library's model.
"""

from __future__ import annotations

import re

import numpy as np

# The letters and numbers of Latin texts (lower-cased), and the word
# pattern of the word_bpe vocabulary file over them.
LETTERS = "a-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
WORD = re.compile(f"[{LETTERS}]+|[{NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^\\t\\n\\x0b\\x0c\\r {LETTERS}{NUMBERS}]+")
# Pieces with anything outside these, in their lower-cased form, go to the library:
# other scripts (some Latin capitals have small letters there), control and uncommon
# blank characters, the dotted capital I, and special token marks.
OTHER = re.compile("[^\t\n\x0b\x0c\r -~¡-įı-ɏ]|<\\|")
PIECE = re.compile("[^\t\n\x0b\x0c\r ]+")
FOREIGN = "\0"              # starts the key of a piece for the library; no word holds it


def _byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


BYTE_CHARS = _byte_chars()
CACHE_WORDS, CACHE_CHARS = 250_000, 16_000_000


def split(text: str) -> list[str]:
    """The words of a text in order; a piece that only the library may split stands for
    its words as it is, behind ``FOREIGN``."""
    low = text.lower()
    if not OTHER.search(low):
        return WORD.findall(low)
    out: list[str] = []
    for piece in PIECE.findall(text):
        low = piece.lower()
        if OTHER.search(low):
            out.append(FOREIGN + piece)
        else:
            out += WORD.findall(low)
    return out


_ENCODER: dict = {}         # in a worker process: the encoder that it used last


def kept_encoder(key: str, make):
    """The encoder of ``key``, made once per worker process."""
    if key not in _ENCODER:
        _ENCODER.clear()
        _ENCODER[key] = make()
    return _ENCODER[key]


class _Codes(dict):
    """Word to a running code; unseen words are listed until they are resolved."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.chars = 0

    def __missing__(self, word):
        code = self[word] = len(self)
        self.new.append(word)
        self.chars += len(word)
        return code


class WordEncoder:
    def __init__(self, tokenizer_json: str, lexicon=None):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.lexicon = lexicon
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.strings = [self.tok.id_to_token(i) or "" for i in range(size)]
        self._clear()

    def _clear(self):
        self.codes = _Codes()
        self.starts = np.zeros(0, np.int64)
        self.lens = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.decoded: list[str] = []

    def _resolve(self):
        """Token ids of the words seen for the first time."""
        new, self.codes.new = self.codes.new, []
        if not new:
            return
        lists: list = [None] * len(new)
        for i, w in enumerate(new):
            if w[0] == FOREIGN:
                lists[i] = self.tok.encode(w[1:], add_special_tokens=False).ids
        if self.lexicon is not None:
            own = [i for i, x in enumerate(lists) if x is None]
            found = self.lexicon.find([new[i].encode() for i in own]) if own else np.zeros(0, np.int64)
            for k in np.nonzero(found >= 0)[0]:
                lists[own[k]] = self.lexicon.ids_of(found[k])
        rest = [i for i, x in enumerate(lists) if x is None]
        merge = self.tok.model.tokenize
        for i in rest:
            w = new[i]
            if not w.isascii():
                w = "".join([BYTE_CHARS[b] for b in w.encode()])
            lists[i] = [x.id for x in merge(w)]
        lens = np.array([len(x) for x in lists], np.int64)
        flat = np.concatenate([np.asarray(x, np.uint32) for x in lists]) if len(lists) else self.flat[:0]
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.flat = np.concatenate([self.flat, flat])
        s = self.strings
        self.decoded += [" ".join([s[j] for j in x]) for x in lists]

    def _gather(self, codes: np.ndarray) -> np.ndarray:
        lens = self.lens[codes]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[codes] - ends + lens, lens) + np.arange(total)
        return self.flat[at]

    def encode(self, texts: list[str], decode: bool = False):
        """For each text: its ids (uint32), or (ids, decoded text)."""
        if len(self.codes) > CACHE_WORDS or self.codes.chars > CACHE_CHARS:
            self._clear()
        per = []
        get = self.codes.__getitem__
        for t in texts:
            w = split(t)
            per.append(np.fromiter(map(get, w), np.int64, len(w)))
        self._resolve()
        for c in per:
            ids = self._gather(c)
            if not decode:
                yield ids
                continue
            said = c[self.lens[c] > 0]          # a piece of uncommon blanks has no ids
            yield ids, " ".join(map(self.decoded.__getitem__, said.tolist()))


def batches(column, max_chars: int = 4_000_000):
    """Python texts of an Arrow string column in runs of about ``max_chars``:
    (first row, list of texts); null as empty."""
    start, size, out = 0, 0, []
    for i, t in enumerate(column):
        t = t.as_py() or ""
        out.append(t)
        size += len(t)
        if size >= max_chars:
            yield start, out
            start, size, out = i + 1, 0, []
    if out:
        yield start, out


def read_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
