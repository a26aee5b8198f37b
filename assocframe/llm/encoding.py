"""Token ids of whole texts, encoded word by word with the tokenizers library.

Both vocabularies never merge across certain places, so the ids of a text are
the ids of its words one after the other:

* ``byte``: a space that follows a non-space and precedes a non-space belongs to
  the word behind it, and a lone line feed is a piece of its own;
* ``word``: ASCII white space is dropped and separates words.

In both, a letter or digit followed by ASCII punctuation other than an
apostrophe is a border too.  The library encodes each distinct word once per
worker (the memo has a fixed number of entries), which gives exactly the ids of
encoding the text at once; tests hold the two against each other.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

#: Entries of a memo, and how many of them may be words that came again and are kept when a full memo is emptied.
MEMO, KEPT = 900_000, 650_000

# Any run of two white spaces, or one that is neither a space nor a line feed.  Looking for each is faster than a pattern.
_UNUSUAL = ["  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(1 << 16)) if c.isspace() and c not in " \n")]
_SAFE_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \n])")
_TAIL = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_BYTE_TAIL = _TAIL.encode()
# Byte-level vocabularies write a byte as a letter: printable ones of Latin-1 as themselves, the others, in order, from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_SPACE = chr(_LETTERS[ord(" ")])


def _little(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Memo(dict):
    """Values by key, made when first asked for.

    A key that is made a second time, after the memo was emptied, is kept from
    then on; words that never come back do not push out those that do.
    """

    def __init__(self, make, share: int = 1) -> None:
        super().__init__()
        self.make = make
        self.most, self.most_kept = MEMO // share, KEPT // share
        self.kept: dict = {}
        self.seen = bytearray(1 << 22)

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.most:
            self.clear()
            self.update(self.kept)
        place = hash(key)
        at, bit = place >> 3 & 0x3FFFFF, 1 << (place & 7)
        if self.seen[at] & bit:
            if len(self.kept) < self.most_kept:
                self.kept[key] = value
        else:
            self.seen[at] |= bit
        self[key] = value
        return value


class TextEncoder:
    """``encode(text)``: the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.by_byte = self.tokenizer.normalizer is None
        self.cores = _Memo(self._byte_core if self.by_byte else self._word_core, 2)
        self.words = _Memo(self._after_space if self.by_byte else self._word)
        self.chunks = _Memo(self._chunk, 8)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_byte:
            if "<|" in text:  # perhaps a special token, which the library looks for before it changes letters
                return b"".join(self._whole(w.decode("utf-8", "surrogatepass")) for w in text.encode("utf-8", "surrogatepass").split())
            # The vocabulary knows lower case only; letters beyond A-Z are left to the library.
            return b"".join(map(self.words.__getitem__, text.encode("utf-8", "surrogatepass").lower().split()))
        if any(mark in text for mark in _UNUSUAL):
            return b"".join(map(self.chunks.__getitem__, _SAFE_CUT.split(text)))
        head, *rest = text.replace("\n", " \n").split(" ")
        return (self.chunks[head] if head else b"") + b"".join(map(self.words.__getitem__, rest))

    def _whole(self, text: str) -> bytes:
        return _little(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _chunk(self, text: str) -> bytes:
        return self._piece(text) if self.by_byte and text.isalpha() else self._whole(text)

    def _piece(self, word: str) -> bytes:
        """The ids of a word that the vocabulary's rules leave in one piece; a space may precede its letters."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_LETTERS)
        elif word[0] == " ":
            word = _SPACE + word[1:]
        return _little([t.id for t in self.tokenize(word)])

    def _byte_core(self, core: str) -> bytes:
        """A space and a word; a word of letters is one piece with its space."""
        return self._piece(" " + core) if core.isalpha() else self._whole(" " + core)

    def _after_space(self, word: str) -> bytes:
        """The ids of a space and the word, or of a line feed and the word."""
        core = word.rstrip(_TAIL)
        # A border lies behind a letter or digit; "<|" may start a special token.
        if not core or not (core[-1].isascii() and core[-1].isalnum()) or "<|" in word:
            core = word
        tail = self.chunks[word[len(core) :]] if len(core) < len(word) else b""
        if core.startswith("\n"):
            return (self.chunks["\n"] if len(core) > 1 else b"") + self.chunks[core[1:] or core] + tail
        return self.cores[core] + tail

    def _word_core(self, core: bytes) -> bytes:
        text = core.decode("utf-8", "surrogatepass")
        # Letters of Latin-1 are in normal form, and each has one lower-case form.
        if text.isalpha() and max(text) <= "ÿ":
            return self._piece(text.lower())
        return self._whole(text)

    def _word(self, word: bytes) -> bytes:
        core = word.rstrip(_BYTE_TAIL)
        if not core or not core[-1:].isalnum():
            core = word
        if len(core) == len(word):
            return self._word_core(core)
        return self.cores[core] + self.chunks[word[len(core) :].decode()]


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)
