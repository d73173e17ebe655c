"""Token ids by the tokenizers library, with a cache of word pieces in each Python worker.

A text is parted at places where the library's own pre-tokenizer always parts it, so that every piece is encoded by
the library once and remembered. Texts and words outside the plain cases (double or rare white space, digits, letters
beyond Latin-1) go to the library whole. Strings of special tokens count as ordinary text, or, with special, as those
tokens, which is the library's default; texts that hold one then go to the library whole too.
"""

from __future__ import annotations

import json
import struct
from functools import lru_cache, partial

import numpy as np
from tokenizers import Tokenizer

#: Words that a worker remembers at most; the table is emptied when full.
CACHED = 400_000
#: Control characters that str.split() takes for white space and the pre-tokenizers don't.
_ODD = "\x1c\x1d\x1e\x1f"
_POINTS = frozenset(".,:;!?")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else 256 and on."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        out = self[word] = self.make(word)
        return out


def _bytes(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


class Coder:
    """encode(text): the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, special: bool = False):
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        self.model = self.tok.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.spaced = (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel"  # a word takes the space before it along
        self.letters = byte_letters()
        self.pieces = _Cache(self._piece)
        self.words = _Cache(partial(self._word, ""))
        self.after_space = _Cache(partial(self._word, " "))
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.parted = self._spaced_text if self.spaced else self._words_text
        self.encode = self._special_text if special else self.parted

    def whole(self, text: str) -> bytes:
        return _bytes(self.tok.encode(text, add_special_tokens=False).ids)

    def _special_text(self, text: str) -> bytes:
        return self.whole(text) if any(t in text for t in self.added) else self.parted(text)

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            shown = piece.replace(" ", self.letters[32])  # all other bytes of it stand for themselves
        else:
            shown = "".join(map(self.letters.__getitem__, piece.encode()))
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, lead: str, word: str) -> bytes:
        core, tail = (word[:-1], word[-1]) if word[-1:] in _POINTS else (word, "")
        if core.isalpha() and (core.isascii() or max(core) < "Ā"):
            out = self.pieces[lead + (core if self.spaced else core.lower())]
            return out + self.pieces[tail] if tail else out
        return self.whole(lead + word)

    def _words_text(self, text: str) -> bytes:
        if any(c in text for c in _ODD):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, text.split()))

    def _spaced_text(self, text: str) -> bytes:
        if text.split() != text.replace("\n", " ").split(" "):  # a gap that isn't one space or line feed
            return self.whole(text)
        out, after = [], self.after_space.__getitem__
        for line in text.split("\n"):
            first, _, rest = line.partition(" ")
            out.append(self.words[first])
            if rest:
                out.extend(map(after, rest.split(" ")))
            out.append(self.pieces["\n"])
        return b"".join(out[:-1])


@lru_cache(maxsize=4)
def coder(path: str, special: bool = False) -> Coder:
    """One for each worker process, file and reading of special tokens."""
    return Coder(path, special)


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
