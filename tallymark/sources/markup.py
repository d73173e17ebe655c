"""Scans of marked-up pages.

Rows of simple tables are found by patterns in the JVM. Rosters and info boxes nest, so they are walked in Python, a
batch of pages at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.textkeys import html_text


def table_rows(pages: DataFrame, html: str, keep: list[str], least: int = 4) -> DataFrame:
    """Ord, cells (texts) and link (the first cell's first address) of the rows with at least so many cells."""
    rows = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("ord", "_row"))
    cells = rows.withColumn("_c", F.regexp_extract_all("_row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1)).where(F.size("_c") >= least)
    link = F.nullif(F.regexp_extract(F.col("_c")[0], r"(?is)<a[^>]*href=[\"']([^\"']*)", 1), F.lit(""))
    return cells.select(*keep, "ord", F.transform("_c", html_text).alias("cells"), link.alias("link"))


_TABLE = re.compile(r"(?is)<table\b.*?</table>")
_ROW = re.compile(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr>|</table>)")
_LINK = re.compile(r"(?is)<a\b[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>")


def _text(html: str) -> str:
    return " ".join(unescape(re.sub(r"<[^>]*>", " ", html)).split())


_SPAN = re.compile(r"(?i)\b(row|col)span\s*=\s*[\"']?\s*([0-9]{1,4})")
_OPEN = re.compile(r"(?is)<(t[hd])\b([^>]*)>(.*?)(?=<t[hd]\b|</t[hd]>|\Z)")


def table_grid(table: str) -> list[list[tuple[str, str, int]]]:
    """A table's rows of (kind, inner HTML, number of the cell); a cell that spans rows or columns stands in each."""
    grid, below, n = [], {}, 0
    for row in _ROW.findall(table):
        cells, line = iter(_OPEN.findall(row)), []
        while True:
            if len(line) in below:
                cell, left = below.pop(len(line))
                if left > 1:
                    below[len(line)] = cell, left - 1
                line.append(cell)
                continue
            found = next(cells, None)
            if found is None:
                if any(at > len(line) for at in below):  # a gap before a cell that hangs down further right
                    line.append(("td", "", -1))
                    continue
                break
            spans = {k.lower(): int(v) for k, v in _SPAN.findall(found[1])}
            cell = (found[0].lower(), found[2], n)
            n += 1
            for _ in range(max(1, min(spans.get("col", 1), 1000))):
                if spans.get("row", 1) > 1:
                    below[len(line)] = cell, spans["row"] - 1
                line.append(cell)
        grid.append(line)
    return grid


def _table_rows(table: str, wanted: dict[str, tuple[str, ...]], entity: str) -> list[dict[str, str | None]] | None:
    """The rows under a table's header; None where it has no word for one of the wanted columns."""
    grid = table_grid(table)
    heads = next((i for i, r in enumerate(grid) if r and all(k == "th" for k, _, _ in r)), None)
    if heads is None:
        return None
    names = [_text(c).lower() for _, c, _ in grid[heads]]
    at = {k: next((i for i, n in enumerate(names) if any(w in n for w in ws)), None) for k, ws in wanted.items()}
    if None in at.values():
        return None
    out = []
    for r in grid[heads + 1 :]:
        if len(r) < len(names) or len({c for _, _, c in r}) == 1 < len(names):
            continue  # short, or one note across all columns
        found = {k: _text(r[i][1]) or None for k, i in at.items()}
        link = _LINK.search(r[at[entity]][1])
        found["link"] = link[1] if link else None
        if found[entity]:
            out.append(found)
    return out


def rosters(html: str, shapes: dict[str, dict[str, tuple[str, ...]]], entity: str) -> list[dict[str, str | None]]:
    """The rows of a page's membership tables. shapes names kinds of tables, the better ones first, by the words that
    head their columns. The first shape that any table has is used alone: all tables of it, united; an entity counts
    once, by its link or else its name, as its first row has it. Rows have the shape's name and every shape's columns."""
    columns = list(dict.fromkeys(c for wanted in shapes.values() for c in wanted))
    tables = _TABLE.findall(html)
    for shape, wanted in shapes.items():
        found = [rows for t in tables if (rows := _table_rows(t, wanted, entity)) is not None]
        if found:
            once: dict[str, dict[str, str | None]] = {}
            for row in (r for rows in found for r in rows):
                once.setdefault(row["link"] or f" {row[entity]}", {"shape": shape, **dict.fromkeys(columns), **row})
            return list(once.values())
    return []


def roster(html: str, wanted: dict[str, tuple[str, ...]], entity: str) -> list[dict[str, str | None]]:
    """The rows of all tables of one shape, see rosters()."""
    return [{k: v for k, v in r.items() if k != "shape"} for r in rosters(html, {"": wanted}, entity)]


_ASIDE = re.compile(r"(?s)<!--.*?-->|<ref\b[^>]*/>|<ref\b.*?</ref>")
_TOKEN = re.compile(r"(?s)(?P<open>\[\[|\{\{)|(?P<close>\]\]|\}\})|(?P<bar>\|)|(?P<text>.[^\[\]{}|]*)")
_NAMED = re.compile(r"(?is)^\{\{\s*(?:ill|interlanguage link)\s*\|\s*([^|{}]+)")


def infobox_fields(wikitext: str) -> list[tuple[str, str]]:
    """(key, value) of every field of the text's templates, in order, comments and footnotes left out.

    The text is read as tokens onto a stack of brackets. A bar belongs to the innermost one that is open; that one's
    fields are what lies between its bars, and a bracket that closes becomes part of the field around it: a link as it
    stands, an interlanguage link as the name it shows, any other template as nothing.
    """
    found: list[tuple[str, str]] = []
    stack: list[tuple[str, list[str]]] = [("", [""])]

    def field(text: str) -> None:
        key, eq, value = text.partition("=")
        if eq and value.strip():
            found.append((key.strip(), value.strip()))

    def closed(kind: str, parts: list[str]) -> str:
        whole = ("[[" if kind == "[[" else "{{") + "|".join(parts) + ("]]" if kind == "[[" else "}}")
        if kind != "{{":
            return whole
        for part in parts[1:]:
            field(part)
        shown = _NAMED.match(whole)
        return shown[1].strip() if shown else ""

    for m in _TOKEN.finditer(_ASIDE.sub("", wikitext)):
        kind, parts = stack[-1]
        if m["open"]:
            stack.append((m["open"], [""]))
        elif m["close"] and kind and (kind == "[[") == (m["close"] == "]]"):
            stack.pop()
            stack[-1][1][-1] += closed(kind, parts)
        elif m["bar"] and (kind or len(stack) == 1):
            parts.append("")
        else:
            parts[-1] += m[0]
    for kind, parts in reversed(stack):  # a box that never closes, as in a text that is cut short
        if kind != "[[":
            for part in parts:
                field(part)
    return found


def infobox_value(wikitext: str, keys: tuple[str, ...]) -> str | None:
    """The value of the first of the keys that has one."""
    fields = infobox_fields(wikitext)
    return next((v for k in keys for name, v in fields if name == k), None)


_WIKILINK = re.compile(r"\[\[([^\]|]*)(?:\|([^\]]*))?\]\]")


def linked_name(value: str) -> tuple[str, str | None]:
    """(name, title of its article) of a value. A value that starts with a link has that link's text and title; else
    there is no article, and the name ends at the first comma, semicolon or line break: what follows is the town."""
    text = re.sub(r"<[^>]*>", " ", re.sub(r"(?i)<br\s*/?>", ", ", value)).strip()
    lead = _WIKILINK.match(text)
    name = (lead[2] or lead[1]) if lead else re.split("[,;\n]", _WIKILINK.sub(lambda m: m[1] if m[2] is None else m[2], text), maxsplit=1)[0]
    title = lead[1].partition("#")[0].strip() if lead else ""
    return " ".join(name.split()).strip(" ,;"), title or None


def change_links(html: str, heading: str = "changes") -> list[tuple[str, str]]:
    """(link, row text) of the rows under a heading that holds the word, a table's caption before its rows' texts."""
    parts = re.split(r"(?is)<h[2-4]\b[^>]*>(.*?)</h[2-4]>", html)
    out = []
    for title, body in zip(parts[1::2], parts[2::2], strict=True):
        if heading in _text(title).lower():
            for table in _TABLE.findall(body):
                caption = re.search(r"(?is)<caption\b[^>]*>(.*?)</caption>", table)
                lead = f"{_text(caption[1])}: " if caption else ""
                for row in _ROW.findall(table):
                    out += [(href, lead + _text(row)) for href, _ in _LINK.findall(row)]
    return out


def scanned(pages: DataFrame, key: str, html: str, kind: str, scan) -> DataFrame:
    """S12, S13, S21 over a table of pages: for each page what scan(text) gives, a list of structs of the DDL type kind."""
    schema = f"{key} {pages.schema[key].dataType.simpleString()}, found array<{kind}>"
    names = [f.split(":")[0].strip() for f in kind.removeprefix("struct<").removesuffix(">").split(",")]
    arrow = pa.list_(pa.struct([(n, pa.string()) for n in names]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[dict(zip(names, x, strict=True)) if not isinstance(x, dict) else x for x in scan(t or "")] for t in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(rows, arrow)], names=[key, "found"])

    return pages.select(key, html).mapInArrow(run, schema).select(key, F.posexplode("found").alias("ord", "_f")).select(key, "ord", "_f.*")
