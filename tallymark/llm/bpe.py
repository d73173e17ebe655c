"""Byte-pair encoding and decoding by contiguous rank arrays.

The distinct new words of a batch of texts are laid out as rows of a matrix of parts, words of like length together,
beside a matrix of the ranks of neighbouring parts. Each round scans every row for its smallest rank (the leftmost of
equals), deletes the boundary there, which moves the rest of the row up, and looks up the ranks of the two neighbours
of the new part; a row without a rank is done. Words longer than SHORT bytes, for which scanning would cost the square
of the length, merge in the same order through a heap. A worker remembers the ids of up to two times CACHED words.

A tokenizer is a file of the tokenizers library with a BPE model on bytes. Where its rules part words at white space
and drop that (lower-casing vocabularies with word ends), texts are parted there first; else its own pre-tokenizer
parts the text. Letters beyond U+024F are normalised and parted by the library's normaliser and pre-tokenizer, so that
both hold to one Unicode version. Strings of added tokens in a text are those tokens, as in the library's plain call.

Defined cases: a null or empty text has no ids and decodes to the empty text; repeated rows are each encoded; a null
doc_id stays null; other columns are ignored; an empty table gives an empty result; a text is never cut.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from .common import sliced_by_bytes, table
from .tokens import byte_letters, public

#: Longest word, in bytes, that is merged by scanning.
SHORT = 48
#: Words whose ids a worker remembers, and as many again of the words before them.
CACHED = 250_000
#: Rows of a matrix of parts.
ROWS = 4096
#: Bytes of text that a worker encodes at a time.
BATCH_BYTES = 4 << 20
_NONE = np.int32(2**31 - 1)
#: The white space that the library's pattern \s matches (fixed values), and what str.split() takes besides.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_ODD = re.compile("[\x1c-\x1f]")


class Merges:
    """The model's merge rules as sorted arrays, and the parts that a word of bytes starts from."""

    def __init__(self, model: dict):
        vocab, tail = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + tail] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.of_pair = dict(zip(keys.tolist(), range(keys.size), strict=True))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of parts; _NONE where no rule joins them. A part below 0 is none."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
        return np.where((self.keys[at] == key) & (left >= 0), self.rank[at], _NONE)

    def scan(self, parts: np.ndarray, put) -> None:
        """Merges every row of parts (-1 beyond a word's end); put(rows, parts) takes those that are done."""
        rows, ranks = np.arange(len(parts)), self.ranks(parts[:, :-1], parts[:, 1:])
        while rows.size:
            at = ranks.argmin(1)
            low = ranks[np.arange(rows.size), at]
            go = low != _NONE
            if not go.all():
                put(rows[~go], parts[~go])
                rows, parts, ranks, at, low = rows[go], parts[go], ranks[go], at[go], low[go]
                if not rows.size:
                    return
            n, here = np.arange(rows.size), at[:, None]
            # the boundary behind part `at` goes: parts after it and ranks from it on move up by one
            tail = np.arange(parts.shape[1] - 1)[None, :]
            parts = np.where(tail <= here, parts[:, :-1], parts[:, 1:])
            parts[n, at] = self.made[low]
            if parts.shape[1] == 1:
                put(rows, parts)
                return
            ranks = np.where(tail[:, :-1] < here, ranks[:, :-1], ranks[:, 1:])
            before, after = at > 0, at < ranks.shape[1]
            ranks[n[before], at[before] - 1] = self.ranks(parts[n[before], at[before] - 1], parts[n[before], at[before]])
            ranks[n[after], at[after]] = self.ranks(parts[n[after], at[after]], parts[n[after], at[after] + 1])

    def long(self, parts: list[int]) -> list[int]:
        """The same merges for one long word, by a heap of (rank, place) over a linked list."""
        n, rank = len(parts), self.of_pair.get
        follow, before, heap = [*range(1, n), -1], [*range(-1, n - 1)], []

        def push(i: int) -> None:
            if i >= 0 and follow[i] >= 0:
                r = rank(parts[i] << 32 | parts[follow[i]])
                if r is not None:
                    heapq.heappush(heap, (r, i))

        for i in range(n):
            push(i)
        while heap:
            r, i = heapq.heappop(heap)
            j = follow[i]
            if parts[i] < 0 or j < 0 or rank(parts[i] << 32 | parts[j]) != r:
                continue  # a neighbour was merged since
            parts[i], parts[j], follow[i] = int(self.made[r]), -1, follow[j]
            if follow[i] >= 0:
                before[follow[i]] = i
            push(i)
            push(before[i])
        return [p for p in parts if p >= 0]

    def encoded(self, words: list[bytes]) -> list[bytes]:
        """Of each word, not empty, the ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(size)
        ids = self.first[flat]
        ids[ends - 1] = self.last[flat[ends - 1]]
        order = np.argsort(size, kind="stable")
        short = order[: np.searchsorted(size[order], SHORT, "right")]
        for k in range(0, short.size, ROWS):
            block = short[k : k + ROWS]
            cols = np.arange(max(2, int(size[block].max())))
            at = (ends - size)[block][:, None] + cols
            parts = np.where(cols < size[block][:, None], ids[np.minimum(at, ids.size - 1)], np.int32(-1))

            def put(rows: np.ndarray, done: np.ndarray, block: np.ndarray = block) -> None:
                raw, wide = done.astype("<u4").tobytes(), 4 * done.shape[1]
                starts = np.arange(0, len(raw), wide)
                for i, start, end in zip(block[rows].tolist(), starts.tolist(), (starts + 4 * (done >= 0).sum(1)).tolist(), strict=True):
                    out[i] = raw[start:end]

            self.scan(parts, put)
        for i in order[short.size :].tolist():
            out[i] = np.array(self.long(ids[ends[i] - size[i] : ends[i]].tolist()), "<u4").tobytes()
        return out


class Codec:
    """Encodes and decodes with one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE":
            raise ValueError(f"{path} has a {spec['model']['type']} model, not byte-pair encoding")
        tok = Tokenizer.from_file(path)
        self.merges = Merges(spec["model"])
        self.normal = tok.normalizer.normalize_str if tok.normalizer else str
        self.parted = tok.pre_tokenizer.pre_tokenize_str
        self.bytes_of = {c: b for b, c in byte_letters().items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {i: t for t, i in self.added.items()}
        self.names = np.array([names.get(i) for i in range(max(names) + 1)], object)
        self.numbers = np.array([str(i) for i in range(self.names.size)], object)
        self.joined = (spec["decoder"] or {}).get("type") == "ByteLevel"
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        # words of lower case between white space that is dropped
        self.plain = (
            [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
        )
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"] + "| ") if self.plain else None
        self.fixed = {t: np.array([i], "<u4").tobytes() for t, i in self.added.items()}
        self.known: dict[str, bytes] = dict(self.fixed)
        self.before: dict[str, bytes] = {}

    def pieces(self, word: str) -> list[str]:
        """The pre-tokenizer's pieces of a word (or text)."""
        return [bytes(map(self.bytes_of.__getitem__, p)).decode() for p, _ in self.parted(self.normal(word))]

    def learn(self, words: list[str]) -> None:
        """Puts the ids of these words into the memory."""
        easy = [w for w in words if w.isascii() or max(w) < "\u0250"] if self.plain else []
        rest = words if len(easy) == 0 else [] if len(easy) == len(words) else [w for w in words if not (w.isascii() or max(w) < "\u0250")]
        # one pass over the easy words: the pattern's pieces, and a space behind each word
        found = self.pattern.findall(" ".join(easy).lower() + " ") if easy else []
        slow = [self.pieces(w) for w in rest]
        asked = list(set(found).union(*slow))
        of = dict(zip(asked, self.merges.encoded(list(map(str.encode, asked))), strict=True)) if asked else {}
        ids = list(map(of.__getitem__, found))
        at = 0
        for word in easy:
            end = found.index(" ", at)
            self.known[word] = ids[at] if end == at + 1 else b"".join(ids[at:end])
            at = end + 1
        self.known.update((w, b"".join(map(of.__getitem__, x))) for w, x in zip(rest, slow, strict=True))

    def words(self, text: str) -> list[str]:
        """Parts of a text, none with an added token inside, that are encoded each by itself."""
        if self.marks is not None and self.marks.search(text):
            out = []
            for k, piece in enumerate(self.marks.split(text)):
                out += [piece] if k % 2 else self.words(piece)
            return out
        if not self.plain:
            return [text] if text else []
        return [w for w in _SPACE.split(text) if w] if _ODD.search(text) else text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Of each text, the ids as little-endian unsigned 32-bit integers."""
        parted = [self.words(t) for t in texts]
        asked = set().union(*parted)
        if len(self.known) + len(asked) > CACHED:  # what is asked for again moves on from the memory before
            self.known, self.before = dict(self.fixed), self.known
        missing = asked - self.known.keys()
        again = missing & self.before.keys()
        self.known.update(zip(again, map(self.before.__getitem__, again), strict=True))
        self.learn(list(missing - again))
        return [b"".join(map(self.known.__getitem__, words)) for words in parted]

    def decode(self, ids: np.ndarray) -> str:
        names = self.names[ids].tolist()
        if not self.joined:
            return " ".join(names)
        out, held = [], bytearray()
        for n in names:
            if n in self.added:
                held += n.encode()
            else:
                held += bytes(map(self.bytes_of.__getitem__, n))
        out.append(held.decode("utf-8", "replace"))
        return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One for each worker process and file."""
    return Codec(path)


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids (array of int) of every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(tokenizer)
        for batch in sliced_by_bytes(batches, "text", BATCH_BYTES):
            found = code.encode([t or "" for t in batch.column("text").to_pylist()])
            ends = np.cumsum([0] + [len(x) // 4 for x in found]).astype(np.int32)
            flat = np.frombuffer(b"".join(found), "<i4")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and text of every row of rows (doc_id, ids); null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(tokenizer)
        for batch in batches:
            out = [code.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(out, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """n_tokens and the digests of the ids and of the text they decode to, for every row of docs (doc_id, text); ids
    and decoded texts stay within the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(tokenizer)
        for batch in sliced_by_bytes(batches, "text", BATCH_BYTES):
            counts, shas, backs = [], [], []
            for raw in code.encode([t or "" for t in batch.column("text").to_pylist()]):
                ids = np.frombuffer(raw, "<u4")
                counts.append(ids.size)
                shas.append(hashlib.sha256(" ".join(code.numbers[ids].tolist()).encode()).hexdigest())
                backs.append(hashlib.sha256(code.decode(ids).encode()).hexdigest())
            cols = [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(backs, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public("word_bpe_49k.json"))
