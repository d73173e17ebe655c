"""Row-level validation: tables with declared rules, rejected rows with reasons, notices.

A rule is a condition that fails and a text that says so. checked() evaluates all rules of a table in one pass over it;
uniqueness and references add a join each. Every result says how many rows were looked at, so that a check of nothing
isn't taken for a pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day
from ..functions.textkeys import dates_in, fingerprint, numbers_in, search_key, urls_in, words
from .pairs import listed, paired


@dataclass(frozen=True)
class TableSpec:
    """What a table needs. closed vocabularies reject a row, known ones only note it."""

    required: Sequence[str]
    optional: Sequence[str] = ()
    key: Sequence[str] = ()
    closed: dict[str, Sequence[str]] = field(default_factory=dict)
    known: dict[str, Sequence[str]] = field(default_factory=dict)
    rules: dict[str, Column] = field(default_factory=dict)
    warnings: dict[str, Column] = field(default_factory=dict)
    exempt: Column | None = None


def column_problems(columns: Sequence[str], spec: TableSpec) -> tuple[list[str], list[str]]:
    """V1: (required columns that are missing, columns that the table doesn't declare)."""
    declared = {*spec.required, *spec.optional}
    return [c for c in spec.required if c not in columns], [c for c in columns if c not in declared]


def blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""


def conditional(when: Column, needs: Column) -> Column:
    """V4: fails unless both hold or neither does."""
    return F.coalesce(when, F.lit(False)) != F.coalesce(needs, F.lit(False))


def checked(rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine). Both have notices; quarantine has reasons. Raises where a required column is
    missing, as then the table isn't read at all."""
    lacking, unknown = column_problems(rows.columns, spec)
    if lacking:
        raise ValueError(f"columns missing: {', '.join(lacking)}")
    fails = [F.when(blank(c), F.lit(f"{c} is empty")) for c in spec.required]
    fails += [F.when(~blank(c) & ~F.col(c).isin(*v), F.concat(F.lit(f"{c} isn't allowed: "), F.col(c))) for c, v in spec.closed.items()]
    fails += [F.when(F.coalesce(bad, F.lit(False)), F.lit(said)) for said, bad in spec.rules.items()]
    notes = [F.lit(f"unknown column {c}") for c in unknown]
    notes += [F.when(~blank(c) & ~F.col(c).isin(*v), F.concat(F.lit(f"{c} is new: "), F.col(c))) for c, v in spec.known.items()]
    notes += [F.when(F.coalesce(bad, F.lit(False)), F.lit(said)) for said, bad in spec.warnings.items()]
    empty = F.array().cast("array<string>")
    out = rows
    if spec.key:
        counts = rows.groupBy(*spec.key).agg(F.count("*").alias("_n")).where("_n > 1")
        twice = F.col("_n").isNotNull() & (~F.coalesce(spec.exempt, F.lit(False)) if spec.exempt is not None else F.lit(True))
        out = rows.join(counts, list(spec.key), "left").select(*rows.columns, "_n")
        fails.append(F.when(twice, F.lit(f"key repeated: {', '.join(spec.key)}")))
    out = out.withColumn("reasons", F.array_compact(F.array(*fails)) if fails else empty).withColumn("notices", F.array_compact(F.array(*notes)) if notes else empty)
    if spec.key:
        out = out.drop("_n")
    return out.where(F.size("reasons") == 0).drop("reasons"), out.where(F.size("reasons") > 0)


def dangling(rows: DataFrame, refs: Column, dim: DataFrame, dim_key: str, row: str) -> DataFrame:
    """V5: (row, ref) of the references, one or a list, that name no row of dim."""
    found = rows.select(row, F.explode(refs).alias("ref")).where(F.col("ref").isNotNull() & (F.col("ref") != ""))
    return found.join(dim.select(F.col(dim_key).alias("ref")).distinct(), "ref", "left_anti").select(row, "ref")


def ref_list(c: str) -> Column:
    """The parts of a cell with references between semicolons."""
    return F.filter(F.transform(F.split(F.coalesce(F.col(c).cast("string"), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")


def agreement(rows: DataFrame, a: str, b: str, allowed: DataFrame) -> DataFrame:
    """V6: rows whose pair of values (a, b) the table allowed doesn't list."""
    return rows.join(allowed.select(a, b).distinct(), [a, b], "left_anti")


def list_difference(a: Column, b: Column) -> Column:
    """V6: struct(stray, absent): what only the first list has, and only the second."""
    return F.struct(F.array_except(a, b).alias("stray"), F.array_except(b, a).alias("absent"))


def parent_problems(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """V7: (child, problem): its own parent, several parents, or a parent that is itself a child."""
    e = edges.select(child, parent).distinct()
    own = e.where(F.col(child) == F.col(parent)).select(child, F.lit("own parent").alias("problem"))
    many = e.groupBy(child).agg(F.count("*").alias("n")).where("n > 1").select(child, F.lit("several parents").alias("problem"))
    kids = e.where(F.col(child) != F.col(parent)).select(F.col(child).alias("_c")).distinct()
    deep = e.where(F.col(child) != F.col(parent)).join(kids, F.col(parent) == F.col("_c"), "left_semi").select(child, F.lit("parent is a child").alias("problem")).distinct()
    return own.unionByName(many).unionByName(deep)


def conflicts(friends: DataFrame, rivals: DataFrame, a: str, b: str, ended: str) -> DataFrame:
    """V8: undirected pairs (lo, hi) that are rivals and friends at once, unless the friendship has ended."""
    pair = lambda df: df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()
    return pair(friends.where(~F.coalesce(F.col(ended), F.lit(False)))).join(pair(rivals), ["lo", "hi"], "left_semi")


NO_CLAIM = "no factual claim"


def why_status(status: str, checked_on: str, basis: str, sources: str, note: str, as_of: Column) -> Column:
    """V9: struct(errors, warnings) of a text's status: checked needs a day that has come and a source, or the basis that
    there is no claim, not both; unverified or no status has neither day nor basis. sources is an array."""
    st, on, ba, src = F.col(status), F.col(checked_on), F.col(basis), F.col(sources)
    d = day(on)
    have = F.coalesce(F.size(src), F.lit(0)) > 0
    is_checked = F.coalesce(st == "checked", F.lit(False))
    url = lambda u: F.coalesce(u.rlike(r"^https?://\S+$"), F.lit(False))
    no_claim = F.coalesce(ba == NO_CLAIM, F.lit(False))
    errors = F.array_compact(
        F.array(
            F.when(src.isNotNull() & F.exists(src, lambda u: ~url(u)), "a source isn't an address"),
            F.when(st.isNotNull() & ~st.isin("checked", "unverified"), "unknown status"),
            F.when(~is_checked & on.isNotNull(), "a day without being checked"),
            F.when(~is_checked & ba.isNotNull(), "a basis without being checked"),
            F.when(is_checked & on.isNull(), "no day").when(is_checked & d.isNull(), "not a day").when(is_checked & (d > as_of), "a day to come"),
            F.when(is_checked & ba.isNotNull() & ~no_claim, "unknown basis"),
            F.when(is_checked & no_claim & have, "no claim, yet sources").when(is_checked & ~no_claim & ~have, "no source"),
        )
    )
    warnings = F.array_compact(F.array(F.when(is_checked & (F.coalesce(F.col(note), F.lit("")) != ""), "a note was added")))
    return F.struct(errors.alias("errors"), warnings.alias("warnings"))


def pair_problems(rows: DataFrame, a: str, b: str, kind: str, kinds: Sequence[str], off_map: str, row: str) -> DataFrame:
    """(row, problem): unknown kind, both ends the same, an end without id and without a name for it, or the pair
    given before in either order (the smallest row stays)."""
    key = F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.concat_ws("|", F.least(a, b), F.greatest(a, b)))
    keyed = rows.withColumn("_p", key)
    first = keyed.where("_p is not null").groupBy("_p").agg(F.min(row).alias("_first"))
    problems = F.array_compact(
        F.array(
            F.when(~F.coalesce(F.col(kind).isin(*kinds), F.lit(False)), "unknown kind"),
            F.when(F.col(a) == F.col(b), "both ends are the same"),
            F.when((F.col(a).isNull() | F.col(b).isNull()) & blank(off_map), "an end without id or name"),
            F.when(F.col(row) != F.col("_first"), "pair repeated"),
        )
    )
    return keyed.join(first, "_p", "left").select(row, F.explode(problems).alias("problem"))


def translation_problems(source: str, translated: str, stated: str, glossary: dict[str, str] | None = None) -> Column:
    """What a translation lost: numbers, days, addresses, glossary terms; and stale where the fingerprint it states
    isn't the source's."""
    s, t = F.col(source), F.col(translated)
    lost = lambda f, name: F.when(F.size(F.array_except(f(s), f(t))) > 0, F.lit(f"{name} missing"))
    terms = [F.when(F.contains(search_key(s), search_key(F.lit(a))) & ~F.contains(search_key(t), search_key(F.lit(b))), F.lit(f"term missing: {b}")) for a, b in (glossary or {}).items()]
    return F.array_compact(F.array(lost(numbers_in, "number"), lost(dates_in, "day"), lost(urls_in, "address"), *terms, F.when(fingerprint(s) != F.col(stated), "stale")))


def glossary_problems(rows: DataFrame, row: str, source: str, translated: str, glossary: DataFrame) -> DataFrame:
    """(row, term, wanted) where a source text has a term of the glossary (term, wanted) as a phrase and its
    translation lacks a word of what is wanted for it. A word counts by its stem, without a last vowel, anywhere in the
    text, both folded; words of less than three letters don't count. A missing translation has no problems here.

    Terms and texts meet on the term's longest word, so the glossary is a table of any size.
    """
    g = glossary.where("term is not null and wanted is not null").select("term", "wanted", search_key("term").alias("_term"), F.split(search_key("wanted"), " ").alias("_w")).where("_term <> ''").distinct()
    word = F.col("_w")
    stem = lambda w: F.when((F.length(w) > 3) & F.substring(w, -1, 1).isin("a", "e", "i", "u"), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)
    stems = F.transform(F.filter(word, lambda w: F.length(w) >= 3), stem)
    longest = F.array_max(F.transform(F.split("_term", " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    g = g.select("term", "wanted", "_term", stems.alias("_stems"), longest.alias("_on"))
    t = rows.where(F.col(translated).isNotNull()).select(F.col(row).alias("_row"), search_key(source).alias("_source"), search_key(translated).alias("_dst"))
    t = t.withColumn("_on", F.explode(F.array_distinct(F.split("_source", " "))))
    phrase = F.contains(F.concat(F.lit(" "), F.col("_source"), F.lit(" ")), F.concat(F.lit(" "), F.col("_term"), F.lit(" ")))
    hit = t.join(g, "_on").where(phrase & ~F.forall("_stems", lambda x: F.contains(F.col("_dst"), x)))
    return hit.select(F.col("_row").alias(row), "term", "wanted")


def quote_problems(quote: str, most: int = 15) -> Column:
    """The quote has too many words."""
    return F.size(words(F.coalesce(F.col(quote), F.lit("")))) > most


def crowded(rows: DataFrame, key: str, most: int = 12) -> DataFrame:
    """Keys with more rows than a page can hold, a warning."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most)


def sale_notices(rows: DataFrame, end: str, as_of: Column, days: int = 14) -> DataFrame:
    """Rows whose sale ended more than so many days ago; only notices."""
    return rows.where(F.date_diff(as_of, F.col(end)) > days).withColumn("days_past", F.date_diff(as_of, F.col(end)))


def link_problems(rows: DataFrame, bucket: str, event: str, host: str, others: str, leg: str, row: str, events: DataFrame, event_key: str) -> DataFrame:
    """(row, problem) of a file with two kinds of line: either an event or a host with others, never both or neither;
    one event for each bucket, one host line for each bucket and leg, a host that isn't among the others, a known event."""
    has_event, has_host = ~blank(event), ~blank(host)
    lines = rows.withColumn("_e", has_event).withColumn("_h", has_host)
    per_bucket = lines.groupBy(bucket).agg(F.count_if("_e").alias("_ne"))
    per_leg = lines.where("_h").groupBy(bucket, F.coalesce(leg, F.lit("")).alias("_leg")).agg(F.count("*").alias("_nh"))
    known = events.select(F.col(event_key).alias("_known")).distinct()
    j = lines.join(per_bucket, bucket, "left").withColumn("_leg", F.coalesce(leg, F.lit(""))).join(per_leg, [bucket, "_leg"], "left").join(known, F.col(event) == F.col("_known"), "left")
    problems = F.array_compact(
        F.array(
            F.when(F.col("_e") & (F.col("_h") | ~blank(others)), "both kinds of cell"),
            F.when(~F.col("_e") & ~F.col("_h"), "neither kind of cell"),
            F.when(F.col("_e") & (F.col("_ne") > 1), "several events"),
            F.when(F.col("_h") & (F.col("_nh") > 1), "several hosts for a leg"),
            F.when(F.col("_h") & F.array_contains(ref_list(others), F.col(host)), "host among the others"),
            F.when(F.col("_e") & F.col("_known").isNull(), "unknown event"),
        )
    )
    return j.select(row, F.explode(problems).alias("problem"))


def decimal(c: str) -> Column:
    """A number with a decimal point or comma; null where it isn't one."""
    return F.replace(F.trim(F.col(c)), F.lit(","), F.lit(".")).try_cast("double")


def price_problems(low: str, high: str, season: str, currency: str, country: str, phase: str) -> Column:
    """Numeric and format rules of a price row."""
    return F.array_compact(
        F.array(
            F.when(~blank(low) & ~F.coalesce(decimal(low) > 0, F.lit(False)), "price isn't above 0"),
            F.when(~blank(high) & ~F.coalesce(decimal(high) >= decimal(low), F.lit(False)), "largest price below the price"),
            F.when(~blank(season) & ~F.col(season).rlike("^[0-9]{4}-[0-9]{2}$"), "season isn't YYYY-YY"),
            F.when(~blank(currency) & ~F.col(currency).rlike("^[A-Z]{3}$"), "currency isn't three letters"),
            F.when(~blank(country) & ~F.col(country).rlike("^[A-Z]{2}$"), "country isn't two letters"),
            F.when(~blank(phase) & ~F.coalesce(F.col(phase).try_cast("int") >= 1, F.lit(False)), "phase isn't 1 or more"),
        )
    )


def list_or_word(c: str, words_allowed: Sequence[str], pattern: str) -> Column:
    """Fails unless the cell is one of the words or a list of ids between semicolons."""
    parts = ref_list(c)
    return ~(F.col(c).isin(*words_allowed) | ((F.size(parts) > 0) & F.forall(parts, lambda x: x.rlike(pattern))))


def aged_rows(rows: DataFrame, refs: Column, sources: DataFrame, source_key: str, published: str, row: str, note: str, as_of: Column) -> DataFrame:
    """Rows (confirmed ones are the caller's choice) whose newest document is more than twelve months old: the days
    that markers name in the note and the cited sources, and the day that a source's field starts with; at least one
    marked day is needed."""
    from ..functions.dates import marked_days, opening_day, year_before

    cited = rows.select(row, F.explode(refs).alias("_ref")).join(sources.select(F.col(source_key).alias("_ref"), F.col(published).alias("_pub")), "_ref")
    marked = cited.select(row, F.explode(marked_days("_pub")).alias("d"), F.lit(True).alias("marked")).unionByName(rows.select(row, F.explode(marked_days(note)).alias("d"), F.lit(True).alias("marked")))
    leading = cited.select(row, opening_day("_pub").alias("d"), F.lit(False).alias("marked")).where("d is not null")
    newest = marked.unionByName(leading).groupBy(row).agg(F.max("d").alias("newest"), F.bool_or("marked").alias("marked"))
    return newest.where(F.col("marked") & (F.col("newest") < year_before(as_of))).select(row, "newest")


#: Lengths of day blocks, as powers of two; the last holds all days there are.
BLOCKS = range(4, 24, 2)


def overlapping(rows: DataFrame, start: str, end: str, row: str, scope: list[str] = ()) -> DataFrame:
    """Pairs (a, b), a before b by row, of intervals of a scope that share a day; start and end are days. Intervals of
    equal ends are a class and meet as lists. A pair comes from the later one's first day, in the block in which the earlier
    one, that touches one or two of the smallest blocks as long as itself, finds it; so a row is shuffled about once for
    each length of block in use, and pairs are not."""
    s, e = F.unix_date(start).cast("long"), F.unix_date(end).cast("long")
    scoped = [f"_c{i}" for i in range(len(scope))]
    spans = rows.where(F.col(end) >= F.col(start)).select(*(F.col(c).alias(k) for c, k in zip(scope, scoped)), F.col(row).alias("_row"), s.alias("_s"), e.alias("_e"))
    power = F.lit(BLOCKS[-1])
    for k in reversed(BLOCKS[:-1]):
        power = F.when(F.col("_e") - F.col("_s") < 1 << k, k).otherwise(power)
    shift = lambda day, k: F.call_function("shiftright", day, k)
    key = lambda block, k: F.struct(*scoped, k.alias("k"), block.alias("block"))
    lists = listed(spans, [*scoped, "_s", "_e"], F.col("_row"), "_a", ordered=True)
    x = lists.withColumn("_k", power).withColumn("_block", F.explode_outer(F.sequence(shift(F.col("_s"), F.col("_k")), shift(F.col("_e"), F.col("_k")))))
    x = x.select(key(F.col("_block"), F.col("_k")).alias("_key"), F.col("_s").alias("_sa"), F.col("_e").alias("_ea"), "_a")
    used = lists.agg(F.sort_array(F.collect_set(power))).scalar()
    y = lists.withColumn("_k", F.explode_outer(used)).select(key(shift(F.col("_s"), F.col("_k")), F.col("_k")).alias("_key"), F.col("_s").alias("_sb"), F.col("_e").alias("_eb"), F.col("_a").alias("_b"))
    later = (F.col("_sb") <= F.col("_ea")) & ((F.col("_sa") < F.col("_sb")) | ((F.col("_sa") == F.col("_sb")) & (F.col("_ea") <= F.col("_eb"))))
    alike = (F.col("_sa") == F.col("_sb")) & (F.col("_ea") == F.col("_eb"))
    met = paired(x, y, "_key", "_a", "_b", lambda both: both.where(later).withColumn("_alike", alike).drop("_sa", "_ea", "_sb", "_eb"))
    pairs = met.where(F.when(F.col("_alike"), F.col("_a") < F.col("_b")).otherwise(F.col("_a") != F.col("_b")))
    return pairs.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))


def overlap_totals(rows: DataFrame, start: str, end: str, scope: list[str]) -> DataFrame:
    """Scope, rows and overlaps, the number of overlapping pairs, without making a pair: an interval overlaps those
    that are open when it starts, whose number is a running sum over days."""
    spans = rows.where(F.col(end) >= F.col(start))
    began = spans.select(*scope, F.col(start).alias("_day"), F.lit(1).alias("_in"), F.lit(0).alias("_out"))
    ended = spans.select(*scope, F.date_add(end, 1).alias("_day"), F.lit(0).alias("_in"), F.lit(1).alias("_out"))
    days = began.unionByName(ended).groupBy(*scope, "_day").agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out"))
    before = Window.partitionBy(*scope).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    still = F.coalesce(F.sum(F.col("_in") - F.col("_out")).over(before), F.lit(0)) - F.col("_out")
    met = days.withColumn("_met", F.col("_in") * still + F.floor(F.col("_in") * (F.col("_in") - 1) / 2))
    return met.groupBy(*scope).agg(F.sum("_in").alias("rows"), F.sum("_met").cast("long").alias("overlaps"))


def interval_problems(rows: DataFrame, start: str, end: str, row: str, scope: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid rows with inclusive days, rejected rows, overlapping pairs within a scope). Both rows of an overlap stay."""
    s, e = day(start), day(end)
    parsed = rows.withColumn("_s", s).withColumn("_e", e)
    reason = F.when(F.col("_s").isNull() | F.col("_e").isNull(), "not a day").when(F.col("_e") < F.col("_s"), "ends before it starts")
    valid = parsed.where(reason.isNull())
    days = valid.withColumn("days", F.date_diff("_e", "_s") + 1).drop("_s", "_e")
    return days, parsed.withColumn("reason", reason).where("reason is not null").drop("_s", "_e"), overlapping(valid, "_s", "_e", row, scope)
