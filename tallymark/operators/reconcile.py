"""Reconciliation of sources, overlays and verdicts.

Verdicts are one `when` chain each, so their order is part of the expression. Three-valued signals stay null where
nothing is known; no rule turns unknown into false before its verdict.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine, within
from ..functions.textkeys import suppression_shape, truthy
from .summary import largest_spread

__all__ = ["suppression_shape", "truthy"]  # R12 and R11, kept beside the statements they read


def two_source_verdict(a: str, b: str, matched: Column | None = None, share: float = 0.05) -> Column:
    """Unmatched, neither, only-a, only-b, agree, differ."""
    x, y = F.col(a), F.col(b)
    start = F.when(~F.coalesce(matched, F.lit(False)), "unmatched") if matched is not None else F.when(F.lit(False), "")
    return start.when(x.isNull() & y.isNull(), "neither").when(y.isNull(), "only-a").when(x.isNull(), "only-b").when(within(a, b, share), "agree").otherwise("differ")


def three_source_verdict(a: str, b: str, c: str, candidates: str, same_name: Column, share: float = 0.05) -> Column:
    """R2: no candidate, several, another ground's name, and only then the figures: how many of the pairs agree."""
    pairs = [F.coalesce(within(x, y, share), F.lit(False)) for x, y in combinations((a, b, c), 2)]
    have = sum((F.col(x).isNotNull().cast("int") for x in (a, b, c)), F.lit(0))
    agree = sum((p.cast("int") for p in pairs), F.lit(0))
    n = F.col(candidates)
    return F.when(F.coalesce(n, F.lit(0)) == 0, "unmatched").when(n > 1, "ambiguous").when(same_name == F.lit(False), "other-ground").when(have == 0, "neither").when(have == 1, "single").when(agree >= have - 1, "agree").when(agree > 0, "partly").otherwise("differ")


def majority(figures: dict[str, str], groups: dict[str, str], share: float = 0.05) -> Column:
    """struct(verdict, proposed, taken_from, supporters) of figures {source: column}, in the order of preference;
    groups has the independent group that each source belongs to.

    Every pair of sources of different groups within the share, with whatever else is within it of both, is a cluster;
    the largest one wins, of equals the one of the first pair in the order of the groups. A null or zero figure is none.
    """
    value = {s: F.when(F.col(c) > 0, F.col(c)) for s, c in figures.items()}
    order = list(dict.fromkeys(groups[s] for s in figures))
    in_order = sorted(figures, key=lambda s: order.index(groups[s]))
    close = {(s, t): F.coalesce(_close(value[s], value[t], share), F.lit(False)) for s in figures for t in figures if s != t}
    clusters = []
    pairs = [(s, t) for g, h in combinations(order, 2) for s in in_order if groups[s] == g for t in in_order if groups[t] == h]
    for i, (s, t) in enumerate(pairs):
        members = F.array_compact(F.array(F.lit(s), F.lit(t), *(F.when(close[s, x] & close[t, x], F.lit(x)) for x in figures if x not in (s, t))))
        clusters.append(F.when(close[s, t], F.struct(F.size(members).alias("n"), F.lit(-i).alias("i"), members.alias("members"))))
    best = F.array_max(F.array(*clusters))
    members = best["members"]
    pick = F.coalesce(*(F.when(F.array_contains(members, s), F.lit(s)) for s in figures))
    have = F.size(F.array_distinct(F.array_compact(F.array(*(F.when(value[s].isNotNull(), F.lit(groups[s])) for s in figures)))))
    proposed = F.coalesce(*(F.when(pick == s, value[s]) for s in figures))
    verdict = F.when(have == 0, "none").when(best.isNotNull(), "agreed").when(have == 1, "single-source").otherwise("contested")
    return F.struct(verdict.alias("verdict"), proposed.alias("proposed"), pick.alias("taken_from"), F.coalesce(F.size(members), F.lit(0)).alias("supporters"))


def _close(a: Column, b: Column, share: float) -> Column:
    return F.abs(a - b) / F.greatest(a, b) <= share


CLEAR = "<clear>"


def overlay(base: DataFrame, hand: DataFrame, key: str, fields: list[str], clearable: list[str], skip: str, needed: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(rows, problems). Of hand's text columns a blank keeps base's value, CLEAR nulls it (clearable fields only),
    anything else replaces it, cast to base's type; `skip` in the column of that name deletes the row; a row of hand
    without key adds one, if it has the needed fields and no row of base has its name."""
    h = hand.select(*(F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) for c in hand.columns))
    keyed, fresh = h.where(F.col(key).isNotNull()), h.where(F.col(key).isNull())
    bad_clear = F.array_compact(F.array(*(F.when(F.col(f"h_{f}") == CLEAR, F.lit(f)) for f in fields if f not in clearable)))
    k = keyed.select(F.col(key).alias("_k"), *(F.col(f).alias(f"h_{f}") for f in fields))
    joined = base.join(k, base[key] == k["_k"], "full")
    unknown = joined.where(base[key].isNull()).select(F.col("_k").alias("row"), F.lit("unknown key").alias("problem"))
    refused = joined.where(base[key].isNotNull() & (F.size(bad_clear) > 0)).select(F.col("_k").alias("row"), F.concat(F.lit("can't clear "), F.array_join(bad_clear, ", ")).alias("problem"))
    gone = F.coalesce(F.lower(f"h_{skip}") == "skip", F.lit(False))
    ok = F.size(bad_clear) == 0

    def new(f: str) -> Column:
        x, kind = F.col(f"h_{f}"), base.schema[f].dataType
        return F.when(x.isNull() | ~ok, F.col(f)).when(x == CLEAR, F.lit(None).cast(kind)).otherwise(x.try_cast(kind)).alias(f)

    kept = joined.where(base[key].isNotNull() & ~gone).select(*(new(c) if c in fields else F.col(c) for c in base.columns))
    lacks = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in needed)))
    taken = base.select(F.lower(name).alias("_n")).distinct()
    fresh = fresh.join(taken, F.lower(name) == F.col("_n"), "left")
    problem = F.when(F.size(lacks) > 0, F.concat(F.lit("lacks "), F.array_join(lacks, ", "))).when(F.col("_n").isNotNull(), "name is taken")
    added = fresh.where(problem.isNull()).select(*(F.col(c).try_cast(base.schema[c].dataType).alias(c) if c in hand.columns else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in base.columns))
    added = added.withColumn(key, F.concat(F.lit("hand:"), F.substring(F.sha2(F.lower(name), 256), 1, 12)).try_cast(base.schema[key].dataType) if base.schema[key].dataType.typeName() == "string" else F.col(key))
    problems = unknown.unionByName(refused).unionByName(fresh.where(problem.isNotNull()).select(F.col(name).alias("row"), problem.alias("problem")))
    return kept.unionByName(added), problems


def hand_links(proposed: DataFrame, hand: DataFrame, left: str, source: str, right: str) -> DataFrame:
    """Proposed links (left, source, right) with hand's decisions (and column action): a link row replaces the whole
    answer of its (left, source) and takes its right side from others; a reject row removes that link. origin says which."""
    cols = [left, source, right]
    links, rejects = hand.where("action = 'link'").select(*cols).distinct(), hand.where("action = 'reject'").select(*cols).distinct()
    out = proposed.select(*cols).join(links.select(left, source).distinct(), [left, source], "left_anti").join(links.select(source, right).distinct(), [source, right], "left_anti")
    out = out.join(rejects, cols, "left_anti").withColumn("origin", F.lit("proposed"))
    return out.unionByName(links.withColumn("origin", F.lit("hand")))


def unambiguous_links(proposed: DataFrame, left: str, source: str, right: str) -> tuple[DataFrame, DataFrame]:
    """(links, reviews): a left row with several right ones of one source has none of them linked."""
    n = F.count("*").over(Window.partitionBy(left, source))
    counted = proposed.withColumn("candidates", n)
    return counted.where("candidates = 1").drop("candidates"), counted.where("candidates > 1")


def reviewed(proposals: DataFrame, reviews: DataFrame, key: str, ref: str) -> DataFrame:
    """Proposals (verdict) under decisions (key, ref or null for all, decision): rejected, held or open. Evidence
    columns stay; a decision for the ref comes before one for the whole key."""
    one = reviews.where(F.col(ref).isNotNull()).select(F.col(key).alias("_k1"), F.col(ref).alias("_r1"), F.col("decision").alias("_d1"))
    whole = reviews.where(F.col(ref).isNull()).select(F.col(key).alias("_k2"), F.col("decision").alias("_d2"))
    out = proposals.join(one, (F.col(key) == F.col("_k1")) & (F.col(ref) == F.col("_r1")), "left").join(whole, F.col(key) == F.col("_k2"), "left")
    said = F.coalesce("_d1", "_d2")
    verdict = F.when(said == "rejected", "rejected").when(said == "held", "held").otherwise(F.col("verdict"))
    return out.withColumn("verdict", verdict).withColumn("decision", said).drop("_k1", "_r1", "_d1", "_k2", "_d2")


#: R8's verdicts in the order of its report.
ROSTER_ORDER = ["missing", "wrong-tier", "unplaced", "removed-by-hand", "no-item", "extra", "ok"]


def roster_check(roster: DataFrame, ours: DataFrame, removed: DataFrame, item: str, tier: str, lat: str) -> DataFrame:
    """Each row of the roster (item, tier) against ours, then our rows of the roster's tiers that it doesn't name."""
    r = roster.select(F.col(item).alias("item"), F.col(tier).alias("roster_tier"))
    o = ours.select(F.col(item).alias("_o"), F.col(tier).alias("our_tier"), F.col(lat).alias("_lat"))
    gone = removed.select(F.col(item).alias("_g")).distinct()
    j = r.join(o, F.col("item") == F.col("_o"), "left").join(gone, F.col("item") == F.col("_g"), "left")
    verdict = (
        F.when(F.col("item").isNull(), "no-item")
        .when(F.col("_g").isNotNull(), "removed-by-hand")
        .when(F.col("_o").isNull(), "missing")
        .when(F.col("our_tier") != F.col("roster_tier"), "wrong-tier")
        .when(F.col("_lat").isNull(), "unplaced")
        .otherwise("ok")
    )
    named = j.select("item", "roster_tier", "our_tier", verdict.alias("verdict"))
    tiers = r.select("roster_tier").distinct()
    extra = o.join(r.where(F.col("item").isNotNull()).select("item").distinct(), F.col("_o") == F.col("item"), "left_anti").join(tiers, F.col("our_tier") == F.col("roster_tier"), "left_semi")
    none = F.lit(None).cast(ours.schema[tier].dataType)
    return named.unionByName(extra.select(F.col("_o").alias("item"), none.alias("roster_tier"), "our_tier", F.lit("extra").alias("verdict")))


def gated(candidates: DataFrame, gates: list[tuple[str, Callable[[DataFrame], DataFrame]]], healthy: bool) -> tuple[DataFrame, DataFrame]:
    """(surfaced, held): rows that pass every gate in order, and the others with the first gate that held them;
    with healthy False, as after a failed source, nothing surfaces and everything is held by `source`. Each gate gives
    back the rows it lets through, all columns as they are."""
    left = candidates
    held = candidates.where("false").withColumn("gate", F.lit(""))
    if not healthy:
        return candidates.where("false"), candidates.withColumn("gate", F.lit("source"))
    for name, gate in gates:
        passed = gate(left)
        held = held.unionByName(left.exceptAll(passed).withColumn("gate", F.lit(name)))
        left = passed
    return left, held


def country_report(rows: DataFrame, in_box: Column, other_country: Column) -> DataFrame:
    """Rows outside their country's box or tagged with another country, with both reasons; nothing is dropped by it."""
    why = F.array_compact(F.array(F.when(~F.coalesce(in_box, F.lit(True)), "outside the box"), F.when(F.coalesce(other_country, F.lit(False)), "other country")))
    return rows.withColumn("reasons", F.concat_ws("; ", why)).where("reasons <> ''")


def classified(branches: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """One row for each piece of evidence, the branches in their order."""
    out = None
    for i, (kind, df) in enumerate(branches.items()):
        part = df.select(F.lit(i).alias("branch"), F.lit(kind).alias("kind"), *(F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))
        out = part if out is None else out.unionByName(part)
    return out


@dataclass(frozen=True)
class Rule:
    """A kind of evidence, when a row is one, and what it says. Of the rules of one group the first that holds counts;
    a rule without a group stands by itself."""

    kind: str
    when: Column
    detail: Column | None = None
    group: str = ""


def by_rules(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows with branch (the rule's number), kind and detail, once for each rule that counts for them: one pass over
    the rows, whatever the number of rules."""
    found: list[Column] = []
    for name in dict.fromkeys(r.group or f" {i}" for i, r in enumerate(rules)):
        first = None
        for i, r in enumerate(rules):
            if (r.group or f" {i}") == name:
                said = F.struct(F.lit(i).alias("branch"), F.lit(r.kind).alias("kind"), (r.detail if r.detail is not None else F.lit(None)).cast("string").alias("detail"))
                first = F.when(r.when, said) if first is None else first.when(r.when, said)
        found.append(first)
    return rows.withColumn("_e", F.explode(F.array_compact(F.array(*found)))).select(*rows.columns, "_e.*")


def roster_evidence(roster: DataFrame, infos: DataFrame, twins: DataFrame) -> DataFrame:
    """Id, tier, branch, kind and detail of the evidence that a roster (id, tier) and what is known of entities
    (id, tagged, the tier of their tag, shape, why a tag doesn't count, grounds, their number, dissolved) give.

    A roster's entity is read once, at its best tier. twins (id, twin) names team items that stand for a roster's entity:
    where that has no tag the twin's is read, and a twin is no extra. Entities with a tag that are on no roster are extras.
    """
    own = roster.groupBy("id").agg(F.min("tier").alias("tier"), F.count("*").alias("_times"))
    info = infos.select("id", F.struct("tagged", "shape", "grounds", "dissolved").alias("_i"))
    twin = twins.join(infos.select(F.col("id").alias("twin"), F.struct("tagged", "shape", "grounds").alias("_t")), "twin").groupBy("id").agg(F.min_by(F.struct("twin", "_t.*"), "twin").alias("_t"))
    side = own.join(info, "id", "left").join(twin, "id", "left")
    via = F.col("_i.tagged").isNull() & F.col("_t.tagged").isNotNull()
    tagged, shape = F.coalesce("_i.tagged", "_t.tagged"), F.coalesce("_i.shape", "_t.shape")
    grounds = F.when(via, F.col("_t.grounds")).otherwise(F.col("_i.grounds"))
    said = F.concat_ws("; ", F.concat(F.lit("tagged "), tagged.cast("string")), F.when(via, F.concat(F.lit("via "), F.col("_t.twin").cast("string"))), F.when(F.col("_times") > 1, "in several tiers"))
    main = [
        Rule("roster-untagged", F.col("_i").isNull(), F.lit("no entity"), "roster"),
        Rule("roster-ok", tagged == F.col("tier"), said, "roster"),
        Rule("roster-wrong-tier", tagged.isNotNull(), said, "roster"),
        Rule("rank-shape", shape.isNotNull(), shape, "roster"),
        Rule("roster-untagged", F.lit(True), F.when(F.col("_i.dissolved"), "dissolved").otherwise("no tag"), "roster"),
        Rule("two-grounds", (grounds > 1) & F.col("_i").isNotNull(), grounds),
    ]
    extras = infos.where("tagged is not null").join(own.select("id"), "id", "left_anti").join(twins.select(F.col("twin").alias("id")).distinct(), "id", "left_anti")
    rest = [Rule("extra-dissolved", F.coalesce("dissolved", F.lit(False)), None, "extra"), Rule("extra", F.lit(True), None, "extra")]
    beside = by_rules(extras.select("id", F.col("tagged").alias("tier"), "dissolved"), rest).withColumn("branch", F.col("branch") + len(main))
    return by_rules(side, main).select("id", "tier", "branch", "kind", "detail").unionByName(beside.select("id", "tier", "branch", "kind", "detail"))


def same_division(a: Column, b: Column) -> Column:
    """struct(same, reason): true, false, or null with what is unknown; a and b are structs of country, tier, group."""
    unknown = F.when(a.isNull() | b.isNull(), "no such entity").when(a["tier"].isNull() | b["tier"].isNull(), "no tier").when((a["country"] == b["country"]) & (a["tier"] == b["tier"]) & (a["group"].isNull() | b["group"].isNull()), "no group")
    same = (a["country"] == b["country"]) & (a["tier"] == b["tier"]) & (a["group"] == b["group"])
    return F.struct(F.when(unknown.isNull(), F.coalesce(same, F.lit(False))).alias("same"), unknown.alias("reason"))


def tracked(now: DataFrame, state: DataFrame, uid: str, stamp: Column) -> DataFrame:
    """The state after now (uid, hash): an equal hash keeps stamp and sequence, another one counts up, a new uid
    starts at 0, a uid that is gone keeps its state. change says which."""
    n, s = now.select(F.col(uid).alias("_u"), F.col("hash").alias("_h")), state.select(uid, "hash", "dtstamp", "sequence")
    j = s.join(n, F.col(uid) == F.col("_u"), "full")
    change = F.when(F.col("_u").isNull(), "gone").when(F.col(uid).isNull(), "new").when(F.col("hash") == F.col("_h"), "same").otherwise("changed")
    moved = change.isin("new", "changed")
    return j.select(
        F.coalesce(uid, "_u").alias(uid),
        F.coalesce("_h", "hash").alias("hash"),
        F.when(moved, stamp).otherwise(F.col("dtstamp")).alias("dtstamp"),
        F.when(change == "new", 0).when(change == "changed", F.col("sequence") + 1).otherwise(F.col("sequence")).cast("int").alias("sequence"),
        change.alias("change"),
    )


def layered(layers: dict[str, DataFrame], on: DataFrame, keys: dict[str, str]) -> DataFrame:
    """For each row of `on` the rules of every layer that fits, in the layers' order; none replaces another. keys has
    the column that each layer shares with `on`."""
    out = None
    for i, (name, rules) in enumerate(layers.items()):
        part = on.join(rules, keys[name]).withColumn("layer", F.lit(name)).withColumn("layer_order", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def filled_labels(rows: DataFrame, label: str, country: str, tier: str) -> DataFrame:
    """The own label, else the only one at that tier of that country, else null."""
    known = rows.where(F.col(label).isNotNull()).groupBy(country, tier).agg(F.min(label).alias("_l"), (F.min(label) == F.max(label)).alias("_one"))
    return rows.join(known, [country, tier], "left").withColumn(label, F.coalesce(F.col(label), F.when(F.col("_one"), F.col("_l")))).drop("_l", "_one")


def same_name_notes(rows: DataFrame, key: str, name_key: str, scope: list[str]) -> DataFrame:
    """Rows whose name and scope others have too, with the first such id and how many others: a note, never a
    decision."""
    groups = rows.groupBy(name_key, *scope).agg(F.min(key).alias("first"), (F.count_distinct(key) - 1).cast("int").alias("others")).where("others > 0")
    return rows.join(groups, [name_key, *scope])


def angles(**reasons: Column) -> Column:
    """The names of the reasons that hold; any one suffices."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in reasons.items())))


def diagnosis(rows: DataFrame, leagues: str, lat: str, ground_lat: str, dissolved: str, gates: dict[str, Column]) -> DataFrame:
    """For each row what there is and which gates stop it; empty where none does."""
    stops = angles(**{"no league": F.size(F.coalesce(leagues, F.array().cast("array<string>"))) == 0, "no position": F.col(lat).isNull() & F.col(ground_lat).isNull(), "dissolved": F.col(dissolved).isNotNull(), **gates})
    where = F.when(F.col(lat).isNotNull(), "own").when(F.col(ground_lat).isNotNull(), "ground")
    return rows.withColumn("position", where).withColumn("stopped_by", stops)


def unplaced(rows: DataFrame, tier: str, lat: str, lon: str) -> DataFrame:
    """The tier is known and the position isn't."""
    return rows.where(F.col(tier).isNotNull() & (F.col(lat).isNull() | F.col(lon).isNull()))


def stale_preferred(rows: DataFrame, found: str, mapped: list[str]) -> DataFrame:
    """Rows whose preferred statements are all unmapped while a normal one is mapped."""
    pref = F.filter(found, lambda s: (s["rank"] == "preferred") & s["value"].isNotNull())
    normal = F.exists(found, lambda s: (s["rank"] == "normal") & F.coalesce(s["value"].isin(*mapped), F.lit(False)))
    return rows.where((F.size(pref) > 0) & F.forall(pref, lambda s: ~s["value"].isin(*mapped)) & normal)


def agreement_groups(pairs: dict[tuple[str, str], Column], have: dict[str, Column], lead: str) -> Column:
    """struct(with_lead, largest_other, odd): the sources that pairwise agreement connects to the lead source, the
    most that another group has, and whether the lead stands alone against two or more. Closure by as many rounds of
    boolean algebra as there are sources, less two; no graph is walked."""
    names = list(have)
    at = lambda a, b: have[a] & have[b] & F.coalesce(pairs.get((a, b), pairs.get((b, a), F.lit(False))), F.lit(False))
    reach = {(a, b): (have[a] if a == b else at(a, b)) for a in names for b in names}
    for _ in range(max(0, len(names) - 2)):
        step = {}
        for a in names:
            for b in names:
                c = reach[a, b]
                for x in names:
                    if x not in (a, b):
                        c = c | (reach[a, x] & at(x, b))
                step[a, b] = c
        reach = step
    count = lambda a: sum((reach[a, b].cast("int") for b in names), F.lit(0))
    outside = [F.when(have[a] & ~reach[lead, a], count(a)).otherwise(0) for a in names if a != lead]
    members = F.array_compact(F.array(*(F.when(reach[lead, b], F.lit(b)) for b in names)))
    largest = F.greatest(*outside, F.lit(0))
    return F.struct(members.alias("with_lead"), largest.alias("largest_other"), ((F.size(members) < 2) & (largest >= 2)).alias("odd"))


def same_by_position(lat: str, lon: str, others: list[tuple[str, str]], metres: float = 150.0) -> Column:
    """Whether one of the other positions is that near; null where none can be compared."""
    near = [haversine(lat, lon, a, b) for a, b in others]
    return (F.least(*near) if len(near) > 1 else near[0]) <= metres


def ranked_position(sources: list[tuple[str, str, str]], metres: float = 150.0) -> Column:
    """struct(source, lat, lon, others, agree) of (name, lat, lon) in order: the first that there is, how many more
    there are, and whether all of them are within the distance of it (null without others)."""
    pts = F.array_compact(F.array(*(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(F.lit(n).alias("source"), F.col(a).alias("lat"), F.col(b).alias("lon"))) for n, a, b in sources)))
    first = F.get(pts, F.lit(0))
    rest = F.slice(pts, 2, len(sources))
    agree = F.when(F.size(rest) > 0, F.forall(rest, lambda p: haversine(first["lat"], first["lon"], p["lat"], p["lon"]) <= metres))
    return F.struct(first["source"].alias("source"), first["lat"].alias("lat"), first["lon"].alias("lon"), F.greatest(F.lit(0), F.size(rest)).alias("others"), agree.alias("agree"))


def spread_usable(rows: DataFrame, by: str, lat: str, lon: str, metres: float = 150.0) -> DataFrame:
    """Whether a group's equal-named hits are near enough to use; several wide apart aren't."""
    return largest_spread(rows, by, lat, lon).select(by, (F.col("spread_m") <= metres).alias("usable"))


def proposal_verdict(problems: Column, lat: str) -> Column:
    """Ok without problems, unplaced without a position, else attention."""
    return F.when(F.size(F.array_compact(problems)) == 0, "ok").when(F.col(lat).isNull(), "unplaced").otherwise("attention")


def review_decisions(rows: DataFrame, key: str, ref: str) -> tuple[DataFrame, DataFrame]:
    """(decisions, problems): rejected, held or open; held needs a ref, each needs reason and date, one for a key
    and ref."""
    n = F.count("*").over(Window.partitionBy(key, F.coalesce(ref, F.lit(""))))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    problem = (
        F.when(~F.coalesce(F.col("decision").isin("rejected", "held", "open"), F.lit(False)), "unknown decision")
        .when((F.col("decision") == "held") & blank(ref), "held without a ref")
        .when(blank("reason"), "no reason")
        .when(F.try_to_timestamp("decided_on", F.lit("yyyy-MM-dd")).isNull(), "no date")
        .when(n > 1, "decided twice")
    )
    out = rows.withColumn("problem", problem)
    return out.where("problem is null").drop("problem"), out.where("problem is not null")
