"""Name keys, text clean-up and extraction, as expressions that Catalyst compiles.

The folds differ on purpose and are never exchanged: ascii_key drops accents, german_key spells umlauts out, roster_key
leaves initialisms alone, search_key keeps every letter of any script.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache, reduce
from html import unescape
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored

ColumnOrName = Column | str


def _col(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


@lru_cache
def _letters() -> tuple[str, str, dict[str, str]]:
    """Latin letters and what compatibility decomposition without marks leaves of them: one letter each, and the rest."""
    src, dst, longer = [], [], {}
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        c = chr(code)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain != c and plain.isascii() and plain:
            if len(plain) == 1:
                src.append(c)
                dst.append(plain)
            else:
                longer[c] = plain
    return "".join(src), "".join(dst), longer


@lru_cache
def _marked_letters() -> tuple[str, str]:
    """Letters of any script whose canonical decomposition is one letter and marks, and those letters."""
    found = [(chr(c), unicodedata.normalize("NFD", chr(c))) for c in range(0xC0, 0x2000)]
    found = [(c, d[0]) for c, d in found if len(d) > 1 and all(map(unicodedata.combining, d[1:]))]
    return "".join(c for c, _ in found), "".join(d for _, d in found)


def unaccented(x: ColumnOrName) -> Column:
    """Latin letters without their marks, ligatures spelled out, combining marks removed."""
    src, dst, longer = _letters()
    out = F.translate(_col(x), src, dst)
    out = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), [(k, v) for k, v in longer.items() if k in "ĳĲﬀﬁﬂﬃﬄ"], out)
    return F.regexp_replace(out, r"\p{M}+", "")


def joined_initials(x: ColumnOrName) -> Column:
    """Runs of two or more single letters with dots become one word: F.C. is FC."""
    inner = F.regexp_replace(_col(x), r"(?<![\p{L}])(\p{L})\.(?=\p{L}\.)", "$1\u0001")
    last = F.regexp_replace(inner, "\u0001(\\p{L})\\.", "\u0001$1 ")
    return F.replace(last, F.lit("\u0001"), F.lit(""))


def _squeezed(x: Column, drop: str) -> Column:
    return F.trim(F.regexp_replace(x, drop, " "))


def ascii_key(x: ColumnOrName) -> Column:
    """Initials joined, eszett as ss, accents dropped, lower case, anything but letters and digits a space."""
    text = F.replace(joined_initials(F.coalesce(_col(x), F.lit(""))), F.lit("ß"), F.lit("ss"))
    return _squeezed(F.lower(unaccented(text)), "[^a-z0-9]+")


def german_key(x: ColumnOrName) -> Column:
    """Umlauts as two letters before accents are dropped."""
    out = F.coalesce(_col(x), F.lit(""))
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.lower(_squeezed(unaccented(out), "[^0-9a-zA-Z]+"))


def roster_key(x: ColumnOrName) -> Column:
    """Like ascii_key, with initialisms left apart."""
    text = F.replace(F.coalesce(_col(x), F.lit("")), F.lit("ß"), F.lit("ss"))
    return _squeezed(F.lower(unaccented(text)), "[^a-z0-9]+")


def romanian_key(x: ColumnOrName) -> Column:
    """Comma and cedilla letters alike; what isn't ASCII after that is dropped, not spaced."""
    return F.lower(F.regexp_replace(unaccented(F.coalesce(_col(x), F.lit(""))), r"[^\x00-\x7F]+", ""))


def search_key(x: ColumnOrName) -> Column:
    """Marks dropped, letters without a decomposition spelled out, every other letter or digit kept."""
    out = F.lower(F.coalesce(_col(x), F.lit("")))
    for a, b in (("ß", "ss"), ("ø", "o"), ("đ", "d"), ("ł", "l"), ("æ", "ae"), ("œ", "oe"), ("ı", "i"), ("þ", "th"), ("ð", "d")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return _squeezed(unaccented(F.translate(out, *_marked_letters())), r"[^\p{L}\p{N}]+")


def words(key: ColumnOrName) -> Column:
    """The words of a folded text; none of an empty one."""
    return F.filter(F.split(_col(key), r"\s+"), lambda w: w != "")


def name_parts(key: ColumnOrName, forms: list[str], markers: list[str]) -> Column:
    """P5: struct(core, forms, years, markers), each a sorted set. Years are digits, two or more, and no marker."""
    w, f, m = F.array_sort(F.array_distinct(words(key))), F.array(*map(F.lit, forms)), F.array(*map(F.lit, markers))
    digits = lambda x: x.rlike("^[0-9]+$")
    return F.struct(
        F.filter(w, lambda x: ~F.array_contains(m, x) & ~F.array_contains(f, x) & ~digits(x)).alias("core"),
        F.filter(w, lambda x: F.array_contains(f, x)).alias("forms"),
        F.filter(w, lambda x: digits(x) & ~F.array_contains(m, x) & (F.length(x) >= 2)).alias("years"),
        F.filter(w, lambda x: F.array_contains(m, x)).alias("markers"),
    )


def stem_er(word: Column) -> Column:
    """A German town adjective without its -er, for words of six letters or more; else null."""
    return F.when((F.length(word) >= 6) & F.lower(word).endswith("er"), F.substring(word, F.lit(1), F.length(word) - 2))


def ngrams(name: ColumnOrName, longest: int = 3) -> Column:
    """Runs of up to `longest` words without digits, three letters alone or four together, then -er stems; distinct."""
    parts = F.filter(F.split(_col(name), r"[^\p{L}\p{N}_]+"), lambda w: (w != "") & ~w.rlike("^[0-9]+$"))
    runs = []
    for size in range(1, longest + 1):
        starts = F.when(F.size(parts) >= size, F.sequence(F.lit(1), F.size(parts) - size + 1)).otherwise(F.array().cast("array<int>"))
        runs.append(F.filter(_runs(parts, starts, size), _long_enough(3 if size == 1 else 4)))
    stems = F.filter(F.transform(parts, stem_er), lambda s: s.isNotNull() & (F.length(s) >= 3))
    return F.array_distinct(F.concat(*runs, stems))


def _runs(parts: Column, starts: Column, size: int) -> Column:
    return F.transform(starts, lambda i: F.array_join(F.slice(parts, i, size), " "))


def _long_enough(least: int):
    return lambda g: F.length(F.replace(g, F.lit(" "), F.lit(""))) >= least


def phrase_in(needle: ColumnOrName, haystack: ColumnOrName) -> Column:
    """Whole words only; false where either is null or empty."""
    a, b = F.coalesce(_col(needle), F.lit("")), F.coalesce(_col(haystack), F.lit(""))
    return (a != "") & (b != "") & F.contains(F.concat(F.lit(" "), b, F.lit(" ")), F.concat(F.lit(" "), a, F.lit(" ")))


def name_forms(name: ColumnOrName) -> Column:
    """The name's german_key, and the one with -er endings taken off where that differs, as (form, stemmed)."""
    parts = F.filter(F.split(_col(name), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    plain = german_key(name)
    stemmed = german_key(F.array_join(F.transform(parts, lambda w: F.coalesce(stem_er(w), w)), " "))
    both = F.array(F.struct(plain.alias("form"), F.lit(False).alias("stemmed")), F.struct(stemmed.alias("form"), F.lit(True).alias("stemmed")))
    return F.filter(both, lambda s: ~s["stemmed"] | ((s["form"] != "") & (s["form"] != plain)))


def place_cuts(place: ColumnOrName, qualifiers: list[str]) -> Column:
    """How many leading words may stand for a place, largest first: all, up to a qualifier, up to a bracket or comma."""
    parts = words(german_key(place))
    n = F.size(parts)
    quals = F.array(*map(F.lit, qualifiers))
    at = F.filter(F.transform(parts, lambda w, i: F.when((i > 0) & F.array_contains(quals, w), i)), lambda i: i.isNotNull())
    head = F.size(words(german_key(F.regexp_replace(_col(place), r"[(,/][\s\S]*$", ""))))
    cut = F.when((head > 0) & (head < n), F.array(head)).otherwise(F.array().cast("array<int>"))
    return F.reverse(F.array_sort(F.array_distinct(F.concat(F.array(n), at, cut))))


def place_in_name(place: ColumnOrName, name: ColumnOrName, qualifiers: list[str]) -> Column:
    """The longest admitted lead of the place's name that stands in one of the name's forms; else null."""
    parts, forms = words(german_key(place)), name_forms(name)
    leads = F.filter(F.transform(place_cuts(place, qualifiers), lambda k: F.array_join(F.slice(parts, F.lit(1), k), " ")), _long_enough(3))
    return F.get(F.filter(leads, lambda lead: F.exists(forms, lambda f: phrase_in(lead, f["form"]))), F.lit(0))


def number_in(x: ColumnOrName, low: int = 100, high: int = 200_000) -> Column:
    """All digits once separators are gone, within the range; else null."""
    bare = F.regexp_replace(_col(x), r"[\s.,'  ]", "")
    n = F.when(bare.rlike("^[0-9]{1,12}$"), bare.try_cast("long"))
    return F.when(n.between(low, high), n)


def first_number(*columns: ColumnOrName, low: int = 100, high: int = 200_000) -> Column:
    """The first of the columns that holds a usable number."""
    return F.coalesce(*(number_in(c, low, high) for c in columns))


@lru_cache
def _entities() -> str:
    """The named character references with a semicolon, as JSON."""
    return json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")})


@lru_cache
def _bare() -> dict[str, str]:
    """Those that count without one too, at the start of a longer word as well."""
    return {k: v for k, v in html5.items() if not k.endswith(";")}


@lru_cache
def _codes() -> dict[int, str]:
    """What numbers up to 159 stand for where that isn't their own character: control characters nothing, those of the
    second control range what Windows has there."""
    return {n: c for n in range(160) if (c := unescape(f"&#{n};")) != chr(n)}


def unescaped(x: ColumnOrName) -> Column:
    """P10: named and numeric character references as their characters, as HTML reads them: the older names and numbers
    need no semicolon, the longest older name at the start of a word counts, numbers of no character are dropped or give
    the replacement character; what is none stays. An ampersand that one gives starts no further one."""
    table = F.from_json(F.lit(_entities()), "map<string,string>")
    bare = F.create_map(*(F.lit(v) for kv in _bare().items() for v in kv))
    names = "^(" + "|".join(sorted(_bare(), key=lambda n: (-len(n), n))) + ")"

    def one(p: Column) -> Column:
        parts = F.regexp_extract(p, "^&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)", 1)
        word = F.rtrim(parts, F.lit(";"))
        rest = F.substring(p, F.length(parts) + 2, F.length(p))
        named = F.when(F.endswith(parts, F.lit(";")), F.element_at(table, word))
        first = F.regexp_extract(word, names, 1)
        older = F.concat(F.element_at(bare, first), F.substring(parts, F.length(first) + 1, F.length(parts)))
        digits = F.ltrim(F.regexp_extract(word, "^#[xX]?(.*)", 1), F.lit("0"))
        # ten digits are beyond the last character in either base
        number = F.when(F.length(digits) > 9, F.lit("99999999")).when(F.lower(F.substring(word, 2, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits)
        char = F.when(F.startswith(parts, F.lit("#")), _character(F.coalesce(number.try_cast("long"), F.lit(0)))).when(named.isNotNull(), named).when(first != "", older)
        return F.when(char.isNull(), p).otherwise(F.concat(char, rest))

    def quick(p: Column) -> Column:
        out = one(p)
        for name in ("nbsp", "quot", "gt", "lt", "amp"):
            out = F.when(F.startswith(p, F.lit(f"&{name};")), F.concat(F.lit(unescape(f"&{name};")), F.substring(p, len(name) + 3, 1 << 30))).otherwise(out)
        return F.when(F.startswith(p, F.lit("&")), out).otherwise(p)

    return F.when(F.contains(_col(x), F.lit("&")), F.array_join(F.transform(F.split(_col(x), "(?=&)"), quick), "")).otherwise(_col(x))


def _character(n: Column) -> Column:
    codes = F.create_map(*(F.lit(v) for kv in _codes().items() for v in kv))
    own = F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")
    none = n.between(0xFDD0, 0xFDEF) | (n.cast("long").bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return F.when(n < 160, F.coalesce(F.element_at(codes, n.cast("int")), own)).when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("\ufffd")).when(none, F.lit("")).otherwise(own)


def html_text(x: ColumnOrName) -> Column:
    """P10: tags as spaces, character references as characters, white space (no-break spaces too) collapsed."""
    out = unescaped(F.regexp_replace(_col(x), "<[^>]*>", " "))
    return F.trim(F.regexp_replace(out, r"[\s\u00a0]+", " "))


def split_names(x: ColumnOrName) -> Column:
    """Parts at comma, slash or semicolon; a dash alone is none."""
    parts = F.transform(F.split(F.coalesce(_col(x), F.lit("")), "[,/;]"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: ~p.isin("", "-", "–", "—"))


def split_urls(x: ColumnOrName) -> Column:
    """Parts only at a semicolon that a further http(s) address follows."""
    parts = F.transform(F.split(F.coalesce(_col(x), F.lit("")), r";(?=\s*https?://)"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def picked_sentence(text: ColumnOrName, pattern: str, most: int = 30) -> Column:
    """struct(sentence, matched, past): the first sentence that matches, cut to `most` words, else the first."""
    held = F.regexp_replace(_col(text), r"\b(St|Dr|No|Nr|Mt|vs|approx|ca|z\. ?B|e\. ?g|i\. ?e)\.", "$1\u0001")
    sentences = F.transform(F.split(held, r"(?<=[.!?])\s+(?=\p{Lu})"), lambda s: F.replace(s, F.lit("\u0001"), F.lit(".")))
    hit = F.get(F.filter(sentences, lambda s: s.rlike(pattern)), F.lit(0))
    chosen = F.coalesce(hit, F.get(sentences, F.lit(0)))
    return F.struct(first_words(chosen, most).alias("sentence"), hit.isNotNull().alias("matched"), chosen.rlike(r"(?i)\b(was|were|war|waren|former|ehemalig\w*)\b").alias("past"))


def first_words(x: ColumnOrName, n: int) -> Column:
    """The first n words."""
    return F.array_join(F.slice(words(_col(x)), 1, n), " ")


def clip_around(x: ColumnOrName, pattern: str, n: int) -> Column:
    """N words on either side of the first match of the pattern; null without one."""
    at = F.regexp_instr(_col(x), F.lit(pattern))
    before, rest = words(F.substring(_col(x), F.lit(1), at - 1)), words(F.substring(_col(x), at, F.length(_col(x))))
    return F.when(at > 0, F.array_join(F.concat(F.slice(before, F.greatest(F.lit(1), F.size(before) - n + 1), F.lit(n)), F.slice(rest, 1, n + 1)), " "))


def without_marks(x: ColumnOrName) -> Column:
    """Footnote marks [a], status marks (C) and a tail after ', at ' removed."""
    out = F.regexp_replace(_col(x), r"\[[^\]]{0,12}\]|\s*\((?:C|P|R|Q|O|X|Y|Z|[a-z])\)", "")
    return F.trim(F.regexp_replace(out, r",\s+at\s+.*$", ""))


def or_null(x: ColumnOrName) -> Column:
    """Trimmed, the empty string as null."""
    return F.nullif(F.trim(_col(x)), F.lit(""))


def trimmed(x: ColumnOrName) -> Column:
    """Trimmed, null as the empty string."""
    return F.trim(F.coalesce(_col(x), F.lit("")))


def host(url: ColumnOrName) -> Column:
    """The address's host in lower case; null where it isn't an address."""
    return F.lower(F.nullif(F.regexp_extract(_col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def slug(x: ColumnOrName) -> Column:
    """The ascii_key with hyphens."""
    return F.replace(ascii_key(x), F.lit(" "), F.lit("-"))


def accent_pattern(name: ColumnOrName, common: list[str]) -> Column:
    """A pattern for the longest word that isn't common (of equals the later): vowels and c, n, s, t, z match any
    accented form."""
    skip = F.array(*map(F.lit, common))
    keyed = F.transform(F.filter(words(roster_key(name)), lambda w: ~F.array_contains(skip, w)), lambda w, i: F.struct(F.length(w), i, w.alias("w")))
    word = F.array_max(keyed)["w"]
    classes = {"a": "[aàáâãäåăą]", "c": "[cçćč]", "e": "[eèéêëęě]", "i": "[iìíîïı]", "n": "[nñńň]", "o": "[oòóôõöőø]", "s": "[sśšșş]", "t": "[tțţť]", "u": "[uùúûüűů]", "z": "[zźżž]"}
    table = F.create_map(*(F.lit(x) for kv in classes.items() for x in kv))
    return F.array_join(F.transform(F.split(word, ""), lambda c: F.coalesce(F.element_at(table, c), c)), "")


def picked(row: ColumnOrName, fields: list[str], scored: Column | None = None, score_fields: tuple[str, ...] = ()) -> Column:
    """A struct of the named fields; those in score_fields only where `scored` holds."""
    r = _col(row)
    return F.struct(*((F.when(scored, r[f]) if f in score_fields and scored is not None else r[f]).alias(f) for f in fields))


def labelled_result(results: ColumnOrName, label: str, field: str = "name") -> Column:
    """The first element whose label is that one; null without."""
    return F.get(F.filter(_col(results), lambda r: r[field] == label), F.lit(0))


def wkt_point(x: ColumnOrName, places: int = 6) -> Column:
    """Point(lon lat) as struct(lat, lon), rounded half to even; nulls where it isn't one."""
    number = r"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)"
    part = lambda i: F.bround(F.nullif(F.regexp_extract(_col(x), rf"(?i)^\s*point\s*\(\s*{number}\s+{number}\s*\)\s*$", i), F.lit("")).try_cast("double"), places)
    return F.struct(part(2).alias("lat"), part(1).alias("lon"))


def stable_id(*parts: ColumnOrName, digits: int = 12) -> Column:
    """Hex digits of the SHA-256 of the parts joined by a bar, in lower case; null parts are empty."""
    return F.substring(F.sha2(F.lower(F.concat_ws("|", *(F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts))), 256), 1, digits)


def row_hash(columns: list[str], digits: int = 16) -> Column:
    """Hex digits of the SHA-256 of the row's JSON, keys sorted, nulls kept."""
    return F.substring(F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"}), 256), 1, digits)


def fingerprint(x: ColumnOrName) -> Column:
    """FNV-1a, 32 bits, over the trimmed text's UTF-8 bytes, as eight hex digits."""
    text = F.regexp_replace(F.coalesce(_col(x), F.lit("")), r"^[\s ﻿]+|[\s ﻿]+$", "")
    hexed = F.hex(F.encode(text, "UTF-8"))
    pairs = F.filter(F.regexp_extract_all(hexed, F.lit("(..)"), 1), lambda p: p != "")
    step = lambda a, p: (a.bitwiseXOR(F.conv(p, 16, 10).cast("long")) * F.lit(16777619)).bitwiseAND(F.lit(4294967295))
    return F.lpad(F.lower(F.hex(F.aggregate(pairs, F.lit(2166136261).cast("long"), step))), 8, "0")


#: Levels of a JSON document that are opened before its rows are written and looked at again.
LEVELS = 6


def flattened(rows: DataFrame, json: str, keep: list[str]) -> DataFrame:
    """P20: a row for each leaf of the JSON texts in a column, at any depth: the kept columns, path (as a.b[0]), leaf as
    text (null for JSON's null) and kind (string, number, boolean, null). Empty objects and lists have no leaves; a null
    text has none; a text that isn't JSON, or names a key twice, is a leaf of its own at the empty path, of kind text.

    A document is parsed once, into a Variant, whose objects and lists are opened level by level; what has been opened
    to LEVELS is written, and only what hasn't been found to be a leaf is opened further.
    """
    names = [F.col(f"_k{i}") for i in range(len(keep))]
    texts = rows.where(F.col(json).isNotNull()).select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), F.col(json).cast("string").alias("_text"))
    # a small file is one task, and opening the texts costs far more than reading them
    spread = texts.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    left = spread.select(*names, F.lit("").alias("_path"), F.try_parse_json("_text").alias("_v"), "_text")
    out = []
    while True:
        nodes = F.array(_node(F.col("_path"), F.col("_v"), False))
        for _ in range(LEVELS):
            nodes = F.flatten(F.transform(nodes, lambda n: F.when(n["leaf"], F.array(n)).otherwise(F.coalesce(_members(n["path"], n["v"]), F.array(_node(n["path"], n["v"], True))))))
        seen = left.select(*names, "_text", F.explode(nodes).alias("_n")).select(*names, "_text", "_n.*")
        kind = F.when(F.col("_kind") == "STRING", "string").when(F.col("_kind") == "BOOLEAN", "boolean").when(F.col("_kind") == "VOID", "null").when(F.col("_kind").isNull(), "text").otherwise("number")
        seen = seen.withColumn("_kind", F.when(F.col("leaf"), F.schema_of_variant("v")))
        text = F.when(F.col("leaf"), F.when(F.col("v").isNull(), F.col("_text")).otherwise(F.col("v").cast("string")))
        seen = stored(seen.select(*names, F.col("path").alias("_path"), F.when(~F.col("leaf"), F.col("v")).alias("_v"), "leaf", text.alias("_leaf"), F.when(F.col("leaf"), kind).alias("_is")), "leaves")
        out.append(seen.where("leaf").select(*names, F.regexp_replace("_path", r"^\.", "").alias("path"), F.col("_leaf").alias("leaf"), F.col("_is").alias("kind")))
        left = seen.where("not leaf").select(*names, "_path", "_v", F.lit(None).cast("string").alias("_text"))
        if not left.head(1):
            break
    whole = reduce(DataFrame.unionByName, out)
    return whole.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), "path", "leaf", "kind")


def _node(path: Column, v: Column, leaf: bool) -> Column:
    return F.struct(path.alias("path"), v.alias("v"), F.lit(leaf).alias("leaf"))


def _members(path: Column, v: Column) -> Column:
    """An object's or list's members with their paths; null for a leaf."""
    fields = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    items = F.try_variant_get(v, "$", "array<variant>")
    return F.coalesce(
        F.transform(fields, lambda e: _node(F.concat(path, F.lit("."), e["key"]), e["value"], False)),
        F.transform(items, lambda x, i: _node(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), x, False)),
    )


def path_allowed(path: ColumnOrName, allowed: list[str]) -> Column:
    """P20: whether the path, its list positions as [], is one of those allowed; one that ends in a dot allows all below."""
    plain = F.regexp_replace(_col(path), r"\[[0-9]+\]", "[]")
    below = [F.startswith(plain, F.lit(a)) for a in allowed if a.endswith(".")]
    return reduce(lambda a, b: a | b, below, plain.isin(*allowed))


def numbers_in(x: ColumnOrName) -> Column:
    """The distinct numbers, without their thousands separators."""
    found = F.regexp_extract_all(F.coalesce(_col(x), F.lit("")), F.lit(r"([0-9]+(?:[.,'   ][0-9]{3})*)"), 1)
    return F.array_sort(F.array_distinct(F.transform(found, lambda n: F.regexp_replace(n, "[^0-9]", ""))))


def dates_in(x: ColumnOrName) -> Column:
    """The distinct ISO days."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(_col(x), F.lit("")), F.lit(r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b"), 1)))


def urls_in(x: ColumnOrName) -> Column:
    """The distinct addresses, without the punctuation after them."""
    found = F.regexp_extract_all(F.coalesce(_col(x), F.lit("")), F.lit(r"(https?://[^\s\"'<>]+)"), 1)
    return F.array_sort(F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?)\]]+$", ""))))


def holds_card_number(x: ColumnOrName) -> Column:
    """Whether 13 to 19 digits, spaces or hyphens between them, pass the Luhn check."""
    runs = F.regexp_extract_all(F.coalesce(_col(x), F.lit("")), F.lit(r"((?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9]))"), 1)
    return F.exists(runs, lambda r: F.call_function("luhn_check", F.regexp_replace(r, "[^0-9]", "")))


def labels_in_order(labels: ColumnOrName, languages: list[str]) -> Column:
    """Of a map of labels: English, the given languages, then the others by language; distinct."""
    m = _col(labels)
    first = F.array(*(F.element_at(m, lang) for lang in ["en", *languages]))
    return F.array_distinct(F.array_compact(F.concat(first, F.transform(F.array_sort(F.map_keys(m)), lambda k: F.element_at(m, k)))))


def best_label(labels: ColumnOrName, entity: ColumnOrName, languages: tuple[str, ...] = ("en", "de", "ro")) -> Column:
    """The first label of the languages in order, else the id."""
    return F.coalesce(*(F.element_at(_col(labels), lang) for lang in languages), _col(entity))


def season_of(title: ColumnOrName) -> Column:
    """P25: the season that a title starts or ends with, as 2026-27; null without."""
    s = F.regexp_extract(_col(title), r"\b([0-9]{4}[–-][0-9]{2}(?:[0-9]{2})?)\b", 1)
    return F.replace(F.nullif(s, F.lit("")), F.lit("–"), F.lit("-"))


def without_season(title: ColumnOrName) -> Column:
    """P25: the title without its season."""
    return F.trim(F.regexp_replace(_col(title), r"^\s*[0-9]{4}[–-][0-9]{2,4}\s+|\s+[0-9]{4}[–-][0-9]{2,4}\s*$", ""))


def time_at_precision(time: ColumnOrName, precision: ColumnOrName) -> Column:
    """P25: year, month or day of +YYYY-MM-DD..., as the precision (9 or less, 10, more) says; null where it isn't one."""
    form = r"(?s)^(?:\+|(-))?0*([0-9]+)-([0-9]{2})-([0-9]{2}).*$"
    said = lambda x: F.regexp_replace(_col(time), form, x)
    p = F.coalesce(_col(precision), F.lit(11))
    return F.when(F.rlike(_col(time), F.lit(form)), F.when(p <= 9, said("$1$2")).when(p == 10, said("$1$2-$3")).otherwise(said("$1$2-$3-$4")))


#: A statement as the functions below take it.
STATEMENT = "struct<value:string,snaktype:string,rank:string,start:string,end:string>"


def statements(claims_json: ColumnOrName, prop: str, start: str = "P580", end: str = "P582") -> Column:
    """The statements of a property in an entity's JSON claims, as an array of STATEMENT."""
    snak = "struct<snaktype:string,datavalue:struct<type:string,value:string>>"
    kind = f"map<string,array<struct<rank:string,mainsnak:{snak},qualifiers:map<string,array<{snak}>>>>>"
    found = F.element_at(F.from_json(_col(claims_json), kind), prop)
    qual = lambda s, p: _once(F.get(F.element_at(s["qualifiers"], p), F.lit(0)), _snak_value)
    return F.transform(
        F.coalesce(found, F.array().cast(f"array<struct<rank:string,mainsnak:{snak},qualifiers:map<string,array<{snak}>>>>")),
        lambda s: F.struct(
            F.when(s["mainsnak"]["snaktype"] == "value", _snak_value(s["mainsnak"])).alias("value"),
            F.coalesce(s["mainsnak"]["snaktype"], F.lit("?")).alias("snaktype"),
            F.coalesce(s["rank"], F.lit("normal")).alias("rank"),
            qual(s, start).alias("start"),
            qual(s, end).alias("end"),
        ),
    )


def _once(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), x worked out once however often f names it: Spark shares no subexpressions inside a lambda."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _snak_value(snak: Column) -> Column:
    kind, value = snak["datavalue"]["type"], snak["datavalue"]["value"]
    at = lambda p: F.get_json_object(value, p)
    return (
        F.when(kind == "wikibase-entityid", at("$.id"))
        .when(kind == "time", _once(F.struct(at("$.time").alias("time"), at("$.precision").try_cast("int").alias("precision")), lambda t: time_at_precision(t["time"], t["precision"])))
        .when(kind == "globecoordinate", F.concat_ws(",", at("$.latitude"), at("$.longitude")))
        .when(kind == "quantity", F.floor(at("$.amount").try_cast("double")).cast("string"))
        .otherwise(value)
    )


def truthy(found: ColumnOrName) -> Column:
    """Preferred statements if any, else normal ones; deprecated and valueless ones never."""
    s = _col(found)
    best = F.when(F.exists(s, lambda x: x["rank"] == "preferred"), "preferred").otherwise("normal")
    return F.filter(s, lambda x: (x["rank"] == best) & (x["snaktype"] == "value") & x["value"].isNotNull())


def suppression_shape(found: ColumnOrName, tracked: list[str]) -> Column:
    """Why tracked values are invisible: B a preferred statement without a value, C a preferred other value over a
    normal tracked one, A all tracked ones deprecated, ? none of these; null without a tracked value."""
    s = _col(found)
    mine = F.filter(s, lambda x: x["value"].isin(*tracked))
    return F.when(
        F.size(mine) > 0,
        F.when(F.exists(s, lambda x: (x["rank"] == "preferred") & (x["snaktype"] != "value")), "B")
        .when(F.exists(s, lambda x: (x["rank"] == "preferred") & (x["snaktype"] == "value") & ~F.coalesce(x["value"].isin(*tracked), F.lit(False))) & F.exists(mine, lambda x: x["rank"] == "normal"), "C")
        .when(F.forall(mine, lambda x: x["rank"] == "deprecated"), "A")
        .otherwise("?"),
    )


def first_available(**columns: ColumnOrName) -> Column:
    """struct(value, label) of the first column that isn't null, in the order given."""
    label = F.coalesce(*(F.when(_col(c).isNotNull(), F.lit(name)) for name, c in columns.items()))
    return F.struct(F.coalesce(*(_col(c) for c in columns.values())).alias("value"), label.alias("label"))
