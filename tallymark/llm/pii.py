"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

find_pii() gives every span with its kind, place, score and evidence; op6_pii() derives the digest columns.
Kinds email, ip, card and phone are the base and are always reported, whatever their score. The added kinds count only
with a score of LEAST or more, and only where no base span overlaps them:

    iban     confirmed by mod 97; worth 0.8, so only words that speak against it (AGAINST) can take it out
    secret   a token of eight or more characters with a digit that is given to a name such as password, to its end, with
             the dots inside it; worth 0.7, so the same words take it out
    key      a token of twenty or more letters and digits, of both cases, that nothing names; worth 0.45, so it counts
             only near a word of CONTEXT such as token or credential
    account  a run of eight to twelve digits that no checksum confirms; worth 0.4, only near a word such as account

A word of CONTEXT within REACH code points adds 0.2, one of AGAINST takes 0.3. Where a base span or an IBAN lies in a
secret, what is left of the secret before, between and after them are spans of their own.

Defined cases: a null text is an empty one; a null doc_id stays null; repeated rows are searched row by row; offsets
count code points; an empty table gives an empty result. Every scan is linear in the text, and overlaps are looked up
by bisection, so one very long text or run of digits cannot stall a task.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, table, texts

KINDS = ("email", "ip", "card", "phone", "iban", "secret", "key", "account")
LEAST = 0.6
REACH = 40  # code points before and after a span that are searched for context words

#: Context words by kind (fixed values).
CONTEXT = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "telefon", "mobil"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"),
    "secret": ("login", "credential", "auth", "bearer", "private"),
    "key": ("password", "secret", "token", "api", "key", "credential", "auth", "bearer"),
    "account": ("account", "iban", "bank", "konto", "cuenta", "compte", "passport", "ssn", "tax id", "steuer"),
}
#: Context words that speak against a span of any kind (fixed values).
AGAINST = ("example", "sample", "dummy", "placeholder", "beispiel", "ejemplo", "exemple", "isbn", "checksum", "commit")
#: What a kind's pattern and checksum are worth without any context.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "secret": 0.7, "key": 0.45, "account": 0.4}


def _any_of(words: tuple[str, ...]) -> re.Pattern:
    return re.compile("(?<![a-z])(?:" + "|".join(words) + ")", re.I)


_NEAR = {k: _any_of(w) for k, w in CONTEXT.items()}
_AGAINST = _any_of(AGAINST)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits is taken whole: from within it no match could start or end that the whole run doesn't give.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?i)(?<![a-z])(?:password|passwd|secret|token|api_?key)\s{0,3}[=:]\s{0,3}[\"']?((?:[A-Za-z0-9_~+/=\-]|\.(?=[A-Za-z0-9_~+/=\-])){8,})")
_KEY = re.compile(r"(?<![\w+/=.@-])(?=[\w+/-]*[0-9])(?=[\w+/-]*[A-Z])(?=[\w+/-]*[a-z])[A-Za-z0-9_+/-]{20,}={0,2}(?![\w@])", re.ASCII)
_ACCOUNT = re.compile(r"(?<![\w.+-])[0-9]{8,12}(?![\w-]|\.[0-9])", re.ASCII)
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The IBAN check: first four characters moved to the end, letters as 10 to 35, remainder 1."""
    s = iban.replace(" ", "")
    rest = 0
    for c in s[4:] + s[:4]:
        v = int(c, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def iban_length(proposed: str) -> int:
    """Length of the longest part from the start, ending before a space or at the end, that passes mod 97; else 0."""
    n = len(proposed)
    while n > 0:
        if 15 <= len(proposed[:n].replace(" ", "")) <= 34 and mod97(proposed[:n]):
            return n
        n = proposed.rfind(" ", 0, n)
    return 0


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """The search goes on from the end of an IBAN, and from the next character of a proposal that is none."""
    at = 0
    while m := _IBAN.search(text, at):
        n = iban_length(m[0])
        if n:
            yield m.start(), m.start() + n
        at = m.start() + (n or 1)


class Taken:
    """Spans in order, to be asked which part of a text they leave."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [s for s, _, _ in spans]
        self.ends = [e for _, _, e in spans]
        self.reach = list(accumulate(self.ends, max))  # never falls, so it can be bisected

    def clear(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return not before or self.reach[before - 1] <= start

    def left(self, start: int, end: int) -> Iterator[tuple[int, int]]:
        """The parts of start to end that no span overlaps."""
        for i in range(bisect_right(self.reach, start), bisect_left(self.starts, end)):
            if start < self.starts[i]:
                yield start, self.starts[i]
            start = max(start, self.ends[i])
        if start < end:
            yield start, end


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email pattern, found from each @ so that long words cost no retries."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), in order; kind indexes KINDS."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if _HAS_DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


_HAS_DIGIT = re.compile("[0-9]")


def score(text: str, start: int, kind: str, end: int) -> float:
    """What the pattern and its checksum are worth, more with a context word near, less with one that speaks against."""
    sides = ((max(0, start - REACH), start), (end, min(len(text), end + REACH)))
    near = any(_NEAR[kind].search(text, a, b) for a, b in sides)
    against = any(_AGAINST.search(text, a, b) for a, b in sides)
    return round(max(0.0, min(1.0, PRIOR[kind] + 0.2 * near - 0.3 * against)), 2)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the added kinds that their validator and score confirm, clear of the base ones and of each other."""
    if not _HAS_DIGIT.search(text):
        return []
    counts = lambda s, k, e: score(text, s, KINDS[k], e) >= LEAST
    taken = Taken(base)
    found = [(s, 4, e) for s, e in ibans(text) if taken.clear(s, e) and counts(s, 4, e)]
    taken = Taken(sorted(base + found))
    for m in _SECRET.finditer(text):
        s, e = m.span(1)
        if _HAS_DIGIT.search(m[1]) and counts(s, 5, e):
            found += [(x, 5, y) for x, y in taken.left(s, e) if (x, y) == (s, e) or any(map(str.isalnum, text[x:y]))]
    for k, pattern in ((6, _KEY), (7, _ACCOUNT)):
        taken = Taken(sorted(base + found))
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if taken.clear(*m.span()) and counts(m.start(), k, m.end())]
    return sorted(found)


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced as one."""
    out, at = [], 0
    for s, k, e in spans_of(text)[1]:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k]}]"]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and the array spans(kind, start, end, score) of each row, by start and then kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in sliced(batches):
            rows = [[{"kind": KINDS[k], "start": s, "end": e, "score": score(t, s, KINDS[k], e)} for s, k, e in spans_of(t)[1]] for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, spans {_SPANS}")


def redact(docs: DataFrame) -> DataFrame:
    """docs with each text redacted, null staying null; where the table has n_chars it follows the new text."""
    schema = docs.schema
    at = schema.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            new = [None if t is None else redacted(t) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    out = docs.mapInArrow(run, schema)
    if "n_chars" in schema.names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(schema["n_chars"].dataType))
    return out


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    said = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:4]))
    return found.select(
        "doc_id",
        *(_count(k).alias(f"n_{k}") for k in KINDS[:4]),
        F.sha2(F.encode(said(base), "UTF-8"), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("max_score"),
    )
