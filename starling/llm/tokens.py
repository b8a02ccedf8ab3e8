"""Token ids of whole texts, remembered by word."""

from __future__ import annotations

import re

import numpy as np

from .common import single_thread

# Byte-level pre-tokenizers cut before every blank that a visible character follows. The test for
# visible is narrower here than theirs, and a cut left out changes nothing.
_CUT = re.compile(r" (?=\S)").split
# Words that are certain to be cut into their letters and the marks after them.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]{0,3})").fullmatch
_LONGEST = 64
# How many words an encoder remembers in a generation: two of them take about 170 MB.
WORDS = 500_000


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: visible ones stand for themselves,
    the others follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + n) for n, b in enumerate(hidden)}}


class WordEncoder:
    """Encodes with a tokenizer file of the ``tokenizers`` library, byte-level BPE without prefix.

    Ids depend on a word alone, so words are looked up first and only new ones encoded; plain words
    go straight to the library's model. Two generations of ``words`` words each are remembered, and
    a word that is met again moves to the young one. A text that holds the string of an added token,
    such as a special one, is left to the library whole, which makes it that token's id.
    """

    def __init__(self, path: str, words: int = WORDS):
        single_thread()
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added))).search if added else lambda _: None
        self._model = self._tokenizer.model
        self._letters = byte_letters()
        self._blank = self._letters[0x20]
        self._bytes = [i.to_bytes(4, "little") for i in range(self._tokenizer.get_vocab_size())]
        self._known_marks: dict[str, bytes] = {}
        self._line_end = self._encode("\n")
        self._words = words
        self._known = _Known(self._encode_word)

    def _encode(self, piece: str) -> bytes:
        return np.array(
            self._tokenizer.encode(piece, add_special_tokens=False).ids, dtype="<u4"
        ).tobytes()

    def _plain(self, core: str, blank: str) -> bytes:
        if not core.isascii():
            core = core.encode().decode("latin-1").translate(self._letters)
        return b"".join([self._bytes[t.id] for t in self._model.tokenize(blank + core)])

    def _marks(self, marks: str) -> bytes:
        if marks not in self._known_marks:
            self._known_marks[marks] = b"".join([self._bytes[t.id] for t in self._model.tokenize(marks)])
        return self._known_marks[marks]

    def _encode_word(self, word: str) -> bytes:
        """Plain words, also several with single line ends between, are cut here."""
        first, *lines = word.split("\n") if "\n" in word else (word,)
        plain = _PLAIN(first)
        others = [_PLAIN(line) for line in lines]
        if plain is None or None in others:
            return self._encode(" " + word)
        core, marks = plain.groups()
        ids = (self._known.get(core) if marks or lines else None) or self._plain(core, self._blank)
        if marks:
            ids += self._marks(marks)
        for other in others:
            core, marks = other.groups()
            ids += self._line_end + self._plain(core, "")
            if marks:
                ids += self._marks(marks)
        return ids

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._added(text):
            return self._encode(text)
        if len(self._known) > self._words:
            self._known = _Known(self._encode_word, self._known)
        first, *rest = _CUT(text)
        return b"".join([self._encode(first) if first else b"", *map(self._known.__getitem__, rest)])


class _Known(dict):
    """Ids by word; a word it lacks comes from the older generation or is encoded."""

    def __init__(self, encode, older: dict | None = None):
        super().__init__()
        self._encode_word = encode
        # Only the entries of the older generation: what it held before is dropped.
        self._older = dict(older or {})

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._encode_word(word)
        if len(word) <= _LONGEST:
            self[word] = ids
        return ids


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, words: int = WORDS) -> WordEncoder:
    """The Python worker's encoder of a tokenizer file that remembers so many words."""
    if (path, words) not in _encoders:
        _encoders[path, words] = WordEncoder(path, words)
    return _encoders[path, words]
