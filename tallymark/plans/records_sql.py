"""DuckDB SQL with the rows of the queries in records.py."""

from __future__ import annotations

from .records import AS_OF

_D = f"DATE '{AS_OF}'"
_O = "o AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)"
_F = """f AS (SELECT *, CASE WHEN s_suppkey%9>0 THEN round(s_acctbal+1000, 2) END AS a, CASE WHEN s_suppkey%7>0 THEN CASE WHEN s_suppkey%3=0 THEN s_acctbal+1100 ELSE s_acctbal+1010 END END AS b FROM supplier)"""
_V = "CASE {0} WHEN a IS NULL AND b IS NULL THEN 'neither' WHEN b IS NULL THEN 'only-a' WHEN a IS NULL THEN 'only-b' WHEN abs(a-b)/nullif(greatest(a,b),0) <= 0.05 THEN 'agree' ELSE 'differ' END"
_M = """m AS (SELECT event_id, user_id, event_type, v%5 AS home, v%4 AS away, event_id%10=0 AS exhibition, v*100 AS crowd, event_id%3>0 AS complete, v%3 AS cards,
    CASE event_id%4 WHEN 0 THEN 'home' WHEN 1 THEN 'away' WHEN 2 THEN 'neutral' END AS side FROM (SELECT *, CAST(floor(value) AS BIGINT) AS v FROM events))"""


def _edges(a: int, b: int, name: str = "e") -> str:
    return f"{name} AS (SELECT n_nationkey AS x, CASE WHEN n_nationkey%6>0 THEN (n_nationkey*{a}+{b})%25 END AS y, n_name AS name, n_nationkey%3 AS rank, n_nationkey%4=0 AS ended FROM nation)"


_PAIR = "SELECT DISTINCT least(x,y) AS lo, greatest(x,y) AS hi FROM {0} WHERE x IS NOT NULL AND y IS NOT NULL {1}"

ORACLE_SQL = {
    "fold_first_wins": """WITH o AS (SELECT *, CASE WHEN o_orderkey%3>0 THEN o_orderstatus END AS status FROM orders), s AS (SELECT o_custkey, o_orderstatus, min(o_orderkey) AS k FROM o GROUP BY ALL),
        l AS (SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY k) AS seen FROM s GROUP BY 1) SELECT o_custkey, arg_min(status, o_orderkey) FILTER (status IS NOT NULL) AS status, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority, any_value(seen) AS seen FROM o JOIN l USING (o_custkey) GROUP BY 1""",
    "first_order": "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1",
    "min_tier_ambiguous": "SELECT p_name, CAST(min(floor(p_size/10)) AS BIGINT) AS least, min(floor(p_size/10)) <> max(floor(p_size/10)) AS ambiguous FROM part GROUP BY 1",
    "distinct_places": "SELECT l_partkey, count(DISTINCT l_suppkey) AS places, count(DISTINCT l_suppkey) > 1 AS several FROM lineitem GROUP BY 1",
    "mode_with_ties": "SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS r FROM events GROUP BY 1, 2) WHERE r = 1",
    "match_sides": """WITH m AS (SELECT l_orderkey*10+l_linenumber AS ord, min(l_partkey) AS home, max(l_suppkey) AS away FROM lineitem GROUP BY 1), b AS (SELECT ord, home AS team, 'h'||ord AS name FROM m UNION ALL SELECT ord, away, 'a'||ord FROM m)
        SELECT team, arg_max(name, ord) AS name FROM b WHERE team >= 100 GROUP BY 1""",
    "fixture_counters": "SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS paid, count(*) FILTER (value < 5) AS small, count(*) FILTER (user_id IS NULL) AS no_user FROM events GROUP BY 1",
    "members_by_type": "SELECT event_type, count(DISTINCT user_id) AS members FROM events GROUP BY 1",
    "verdict_two_source": f"WITH {_F} SELECT s_suppkey, {_V.format('WHEN s_suppkey%11=0 THEN ' + chr(39) + 'unmatched' + chr(39))} AS verdict FROM f",
    "verdict_tally": f"""WITH {_F}, v AS (SELECT s_nationkey, {_V.format('')} AS v FROM f) SELECT s_nationkey, count(*) FILTER (v='agree') AS agree, count(*) FILTER (v='differ') AS differ, count(*) FILTER (v='only-a') AS only_a,
        count(*) FILTER (v='only-b') AS only_b, count(*) FILTER (v='neither') AS neither FROM v GROUP BY 1""",
    "largest_gaps": f"WITH {_F} SELECT s_suppkey, round(abs(a-b), 2) AS gap FROM f WHERE a IS NOT NULL AND b IS NOT NULL ORDER BY abs(a-b) DESC, s_suppkey LIMIT 12",
    "majority_capacity": """WITH p AS (SELECT p_partkey AS k, p_partkey%50*100+5000 AS n FROM part), q AS (SELECT k, CASE WHEN k%2=0 THEN n END AS t, CASE WHEN k%3>0 THEN n+k%5*100 END AS w, CASE WHEN k%5>1 THEN n+k%7*60 END AS o, CASE WHEN k%4>1 THEN n-k%6*70 END AS s FROM p),
        l AS (SELECT k, 't' AS src, 0 AS grp, 0 AS pref, t AS v FROM q UNION ALL SELECT k,'w',0,2,w FROM q UNION ALL SELECT k,'s',1,1,s FROM q UNION ALL SELECT k,'o',2,3,o FROM q), h AS (SELECT * FROM l WHERE v IS NOT NULL),
        c AS (SELECT a.k, a.grp AS ga, b.grp AS gb, a.pref AS pa, b.pref AS pb, a.src AS sa, b.src AS sb, a.v AS va, b.v AS vb FROM h a JOIN h b ON a.k=b.k AND a.grp<b.grp AND abs(a.v-b.v)/greatest(a.v,b.v) <= 0.05),
        z AS (SELECT c.k, ga, gb, CASE WHEN sa='w' THEN 1 ELSE 0 END AS oa, list(x.src) AS members, list(x.pref) AS prefs, count(*) AS n FROM c JOIN h x ON x.k=c.k AND (x.src IN (sa,sb) OR (abs(x.v-va)/greatest(x.v,va)<=0.05 AND abs(x.v-vb)/greatest(x.v,vb)<=0.05)) GROUP BY c.k, ga, gb, sa, sb),
        b AS (SELECT k, list_min(prefs) AS pref FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, ga, gb, oa) AS r FROM z) WHERE r=1), g AS (SELECT k, count(DISTINCT grp) AS g FROM h GROUP BY 1)
        SELECT q.k AS p_partkey, CASE WHEN g IS NULL THEN 'none' WHEN b.k IS NOT NULL THEN 'agreed' WHEN g=1 THEN 'single-source' ELSE 'contested' END AS verdict, h.v AS proposed, CASE h.src WHEN 't' THEN 'table' WHEN 'w' THEN 'wikidata' WHEN 's' THEN 'stadiumdb' WHEN 'o' THEN 'osm' END AS taken_from
        FROM q LEFT JOIN g ON g.k=q.k LEFT JOIN b ON b.k=q.k LEFT JOIN h ON h.k=q.k AND h.pref=b.pref""",
    "three_sources": f"""WITH {_F}, g AS (SELECT *, CASE WHEN s_suppkey%4>0 THEN s_acctbal+1005 END AS c, CASE WHEN s_suppkey%13=0 THEN 2 WHEN s_suppkey%17=0 THEN 0 ELSE 1 END AS n, CASE WHEN s_suppkey%5>0 THEN s_suppkey%6>0 END AS same FROM f),
        h AS (SELECT *, (a IS NOT NULL)::INT+(b IS NOT NULL)::INT+(c IS NOT NULL)::INT AS have, coalesce((abs(a-b)/nullif(greatest(a,b),0)<=0.05)::INT, 0)*(a IS NOT NULL AND b IS NOT NULL)::INT + coalesce((abs(a-c)/nullif(greatest(a,c),0)<=0.05)::INT,0)*(a IS NOT NULL AND c IS NOT NULL)::INT + coalesce((abs(b-c)/nullif(greatest(b,c),0)<=0.05)::INT,0)*(b IS NOT NULL AND c IS NOT NULL)::INT AS agree FROM g)
        SELECT s_suppkey, CASE WHEN n=0 THEN 'unmatched' WHEN n>1 THEN 'ambiguous' WHEN NOT same THEN 'other-ground' WHEN have=0 THEN 'neither' WHEN have=1 THEN 'single' WHEN agree>=have-1 THEN 'agree' WHEN agree>0 THEN 'partly' ELSE 'differ' END AS verdict FROM h""",
    "overlay_sparse": """WITH h AS (SELECT c_custkey AS k, c_name, CASE WHEN c_custkey%40=0 THEN 'skip' WHEN c_custkey%20=0 THEN '7' WHEN c_custkey%50=0 THEN '3' END AS tier, c_custkey%30=0 AS clr FROM customer WHERE c_custkey%10=0)
        SELECT CAST(c.c_custkey AS VARCHAR) AS id, c.c_name AS name, coalesce(CAST(h.tier AS INTEGER), c_nationkey) AS tier, CASE WHEN h.clr THEN NULL ELSE c_mktsegment END AS venue FROM customer c LEFT JOIN (SELECT * FROM h WHERE k%50>0) h ON h.k=c.c_custkey WHERE coalesce(h.tier,'') <> 'skip'
        UNION ALL SELECT 'hand', 'New '||c_name, CAST(tier AS INTEGER), NULL FROM h WHERE k%50=0 AND k%100>0 AND NOT clr AND tier <> 'skip'
        UNION ALL SELECT 'hand', 'New '||c_name, CAST(tier AS INTEGER), '<clear>' FROM h WHERE k%50=0 AND k%100>0 AND clr AND tier <> 'skip'""",
    "hand_links": """WITH l AS (SELECT DISTINCT l_orderkey AS team, l_linenumber%2 AS source, l_partkey%500 AS club FROM lineitem), p AS (SELECT team, source, any_value(club) AS club FROM l GROUP BY 1,2 HAVING count(*)=1),
        h AS (SELECT o_orderkey AS team, 0 AS source, o_custkey%500 AS club, o_orderkey%40=0 AS lnk FROM orders WHERE o_orderkey%20=0), k AS (SELECT DISTINCT team, source, club FROM h WHERE lnk)
        SELECT team, source, club, 'proposed' AS origin FROM p WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.team=p.team AND k.source=p.source) AND NOT EXISTS (SELECT 1 FROM k WHERE k.source=p.source AND k.club=p.club) AND NOT EXISTS (SELECT 1 FROM h WHERE NOT lnk AND h.team=p.team AND h.source=p.source AND h.club=p.club)
        UNION ALL SELECT team, source, club, 'hand' FROM k""",
    "ambiguous_links": "WITH l AS (SELECT DISTINCT l_orderkey, l_returnflag, l_suppkey FROM lineitem) SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_returnflag) AS candidates FROM l) WHERE candidates > 1",
    "scoped_pick": """WITH p AS (SELECT c_custkey, s_suppkey, s_suppkey%3=0 AS yes FROM customer JOIN supplier ON c_nationkey=s_nationkey AND s_suppkey%4=c_custkey%4), w AS (SELECT *, count(*) OVER q AS n, count(*) FILTER (yes) OVER q AS a FROM p WINDOW q AS (PARTITION BY c_custkey))
        SELECT c_custkey, s_suppkey, CASE WHEN n=1 OR a=1 THEN 'link' ELSE 'ambiguous' END AS verdict FROM w WHERE n=1 OR (a=1 AND yes) OR a<>1""",
    "roster_cascade": """WITH u AS (SELECT c_custkey AS i, c_custkey%3 AS t, CASE WHEN c_custkey%8>0 THEN 1.0 END AS lat FROM customer WHERE c_custkey%6>0), r AS (SELECT CASE WHEN c_custkey%11>0 THEN c_custkey END AS item, CASE WHEN c_custkey%7=0 THEN (c_custkey+1)%3 ELSE c_custkey%3 END AS t FROM customer WHERE c_custkey%5>0)
        SELECT item, r.t AS roster_tier, u.t AS our_tier, CASE WHEN item IS NULL THEN 'no-item' WHEN item%13=0 THEN 'removed-by-hand' WHEN u.i IS NULL THEN 'missing' WHEN u.t<>r.t THEN 'wrong-tier' WHEN lat IS NULL THEN 'unplaced' ELSE 'ok' END AS verdict FROM r LEFT JOIN u ON u.i=r.item
        UNION ALL SELECT i, NULL, t, 'extra' FROM u WHERE i NOT IN (SELECT item FROM r WHERE item IS NOT NULL) AND t IN (SELECT t FROM r)""",
    "change_tracking": """WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS uid, substr(sha256(o_orderstatus||'|'||o_orderpriority),1,16) AS h FROM orders),
        s AS (SELECT uid, CASE WHEN k%4=0 THEN 'old' ELSE h END AS hash, '19980101' AS dtstamp, CAST(k%3 AS INTEGER) AS seq FROM o WHERE k%5>0), n AS (SELECT uid, h FROM o WHERE k%6>0),
        j AS (SELECT coalesce(s.uid,n.uid) AS uid, h, hash, dtstamp, seq, CASE WHEN n.uid IS NULL THEN 'gone' WHEN s.uid IS NULL THEN 'new' WHEN h=hash THEN 'same' ELSE 'changed' END AS change FROM s FULL JOIN n ON s.uid=n.uid)
        SELECT uid, coalesce(h,hash) AS hash, CASE WHEN change IN ('new','changed') THEN '19980630' ELSE dtstamp END AS dtstamp, CAST(CASE change WHEN 'new' THEN 0 WHEN 'changed' THEN seq+1 ELSE seq END AS INTEGER) AS sequence, change FROM j""",
    "quarantine_orders": """WITH o AS (SELECT CASE WHEN o_orderkey%101=0 THEN o_orderkey-1 ELSE o_orderkey END AS key, CASE WHEN o_orderkey%17=0 THEN ' ' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey%23=0 THEN '9-NONE' ELSE o_orderpriority END AS priority, o_totalprice AS p FROM orders),
        r AS (SELECT key, status, priority, concat_ws('; ', CASE WHEN trim(status)='' THEN 'status is empty' END, CASE WHEN priority NOT IN ('1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW') THEN 'priority isn''t allowed: '||priority END, CASE WHEN NOT p BETWEEN 1000 AND 490000 THEN 'price out of range' END, CASE WHEN count(*) OVER (PARTITION BY key) > 1 THEN 'key repeated: key' END) AS reasons FROM o) SELECT * FROM r WHERE reasons <> ''""",
    "ref_integrity": "SELECT DISTINCT l_orderkey, CAST(l_suppkey*2 AS VARCHAR) AS ref FROM lineitem WHERE l_suppkey*2 NOT IN (SELECT s_suppkey FROM supplier) UNION SELECT l_orderkey, CAST(l_suppkey AS VARCHAR) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)",
    "unused_dim": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "used_dim": "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "edge_conflict": f"WITH {_edges(7, 3, 'f')}, {_edges(18, 4, 'r')} {_PAIR.format('f', 'AND NOT ended')} INTERSECT {_PAIR.format('r', '')}",
    "parent_of_parent": f"""WITH {_edges(7, 0)}, t AS (SELECT DISTINCT x, y FROM e WHERE y IS NOT NULL AND x%2=1) SELECT x, 'own parent' AS problem FROM t WHERE x=y UNION ALL SELECT x, 'several parents' FROM t GROUP BY x HAVING count(*)>1
        UNION ALL SELECT DISTINCT x, 'parent is a child' FROM t WHERE x<>y AND y IN (SELECT x FROM t WHERE x<>y)""",
    "mirrored_edges": f"""WITH {_edges(7, 3)}, b AS (SELECT x, y, name, rank, false AS m FROM e UNION ALL SELECT y, x, name, NULL, true FROM e WHERE y IS NOT NULL AND NOT EXISTS (SELECT 1 FROM e o WHERE o.x=e.y AND o.y=e.x))
        SELECT x, y, rank, m AS mirrored, CAST(row_number() OVER (PARTITION BY x ORDER BY m, rank NULLS LAST, name, y NULLS FIRST) AS INTEGER) AS position FROM b""",
    "edges_both_ways": f"WITH {_edges(7, 3)} SELECT x, y FROM e WHERE y IS NOT NULL UNION SELECT y, x FROM e WHERE y IS NOT NULL",
    "next_meeting": f"""WITH {_edges(7, 3)}, m AS (SELECT o_custkey%25 AS h, o_orderkey%24 AS a, CAST(o_orderdate AS DATE) AS day FROM orders), k AS (SELECT least(h,a) AS lo, greatest(h,a) AS hi, min(day) AS next FROM m WHERE day >= {_D} GROUP BY 1,2), s AS (SELECT h AS s FROM m UNION SELECT a FROM m)
        SELECT CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, next, CASE WHEN next IS NOT NULL THEN 'meeting' ELSE CASE (x IN (SELECT s FROM s))::INT + (y IN (SELECT s FROM s))::INT WHEN 2 THEN 'none' WHEN 1 THEN 'one-sided' ELSE 'no-source' END END AS status FROM e LEFT JOIN k ON lo=least(x,y) AND hi=greatest(x,y) WHERE y IS NOT NULL""",
    "date_precision": f"""WITH {_O}, s AS (SELECT o_orderkey, day AS s, day + CAST(o_orderkey%40 AS INTEGER) AS e, o_orderkey%2=0 AS c FROM o) SELECT o_orderkey, CASE WHEN c THEN CASE WHEN s=e THEN CAST(s AS VARCHAR) ELSE s||'/'||e END
        ELSE CASE WHEN strftime(s,'%Y-%m')=strftime(e,'%Y-%m') THEN strftime(s,'%Y-%m') ELSE strftime(s,'%Y-%m')||'/'||strftime(e,'%Y-%m') END END AS shown FROM s""",
    "explode_days": f"WITH {_O}, e AS (SELECT unnest(generate_series(day, day + CAST(o_orderkey%6 AS INTEGER), INTERVAL 1 DAY)) AS t FROM o) SELECT CAST(t AS DATE) AS \"on\", count(*) AS n FROM e GROUP BY 1",
    "recurrence_next": f"""WITH {_O}, r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey%9=0 THEN NULL WHEN o_orderkey%7=0 THEN 'disputed' WHEN o_orderkey%5=0 THEN 'guess' ELSE 'confirmed' END AS src, CASE WHEN o_orderkey%4=0 THEN 'annual' WHEN o_orderkey%11=0 THEN 'per fixture' END AS rec, day FROM o),
        s AS (SELECT *, CASE WHEN rec='annual' THEN CASE WHEN k%8>0 THEN day+365 END ELSE day END AS s, CASE WHEN rec='annual' THEN CASE WHEN k%8>0 THEN day+368 END ELSE day END AS e FROM r),
        q AS (SELECT *, CASE WHEN src IS NULL THEN 'no source for the date' WHEN src='disputed' THEN 'disputed date' WHEN src='guess' THEN 'unknown source for the date' WHEN rec='per fixture' THEN 'recurs with each fixture' WHEN s IS NULL THEN 'annual without a next estimate' WHEN e < {_D} THEN 'in the past' END AS reason FROM s)
        SELECT k AS o_orderkey, CASE WHEN reason IS NULL THEN s END AS start, CASE WHEN reason IS NULL THEN e END AS "end", reason FROM q""",
    "aged_rows": f"""WITH {_O}, n AS (SELECT o_orderkey, CASE WHEN o_orderkey%2=0 THEN day ELSE last_day(day) END AS own, CASE WHEN o_custkey%7=1 THEN DATE '1997-10-14' END AS cited FROM o), m AS (SELECT o_orderkey, greatest(own, coalesce(cited, own)) AS newest FROM n)
        SELECT o_orderkey, newest FROM m WHERE newest < DATE '1997-06-30'""",
    "stale_orders": f"WITH {_O} SELECT o_orderpriority, count(*) FILTER (day < {_D}) AS past, count(*) FILTER (day > {_D}) AS future, count(*) FILTER (date_diff('day', day, {_D}) > 365) AS stale FROM o GROUP BY 1",
    "month_ends": f"WITH {_O} SELECT CAST(CASE o_orderkey%3 WHEN 0 THEN make_date(year(day),12,31) WHEN 1 THEN last_day(day) ELSE day END AS DATE) AS \"on\", count(*) AS n FROM o GROUP BY 1",
    "year_before": f"WITH {_O} SELECT o_orderkey, CAST(day - INTERVAL 12 MONTH AS DATE) AS before, day+1 AS after, day-3 AS alarm FROM o",
    "holiday_overlaps": f"""WITH {_O}, v AS (SELECT o_orderkey AS k, day AS s, day + CAST(o_orderkey%9-1 AS INTEGER) AS e FROM o), w AS (SELECT * FROM v WHERE e>=s) SELECT a.k AS a, b.k AS b FROM w a JOIN w b ON a.k<b.k AND a.s<=b.e AND b.s<=a.e""",
    "holidays_by_scope": f"""WITH {_O}, w AS (SELECT * FROM (SELECT o_orderkey AS k, o_custkey AS c, day AS s, day + CAST(o_orderkey%90-1 AS INTEGER) AS e FROM o) WHERE e>=s) SELECT a.k AS a, b.k AS b FROM w a JOIN w b ON a.c=b.c AND a.k<b.k AND a.s<=b.e AND b.s<=a.e""",
    "holiday_totals": f"""WITH {_O}, w AS (SELECT * FROM (SELECT o_orderkey AS k, o_custkey::VARCHAR AS c, o_orderpriority AS p, day AS s, day + CAST(o_orderkey%90-1 AS INTEGER) AS e FROM o) WHERE e>=s), x AS (SELECT c AS scope, k, s, e FROM w UNION ALL SELECT p, k, s, e FROM w),
        n AS (SELECT a.scope, count(*) AS n FROM x a JOIN x b ON a.scope=b.scope AND a.k<b.k AND a.s<=b.e AND b.s<=a.e GROUP BY 1) SELECT scope, count(*) AS rows, coalesce(any_value(n), 0) AS overlaps FROM x LEFT JOIN n USING (scope) GROUP BY scope""",
    "local_to_utc": """SELECT event_id, CASE user_id%3 WHEN 0 THEN timezone('UTC', timezone('Europe/Bucharest', ts)) WHEN 1 THEN timezone('UTC', timezone('Europe/London', ts)) ELSE timezone('UTC', timezone('Europe/Berlin', ts)) END AS utc, user_id%3=2 AS guessed FROM events""",
    "attended_stats": f"WITH {_M} SELECT count(*) AS matches, sum(home+away) FILTER (NOT exhibition)::BIGINT AS goals, count(DISTINCT user_id) AS distinct_user_id, count(DISTINCT event_type) AS distinct_event_type, sum(cards) FILTER (complete)::BIGINT AS cards, max(crowd) AS largest_crowd, min(crowd) AS smallest_crowd FROM m",
    "win_draw_loss": f"""WITH {_M}, s AS (SELECT event_type, CASE side WHEN 'home' THEN home WHEN 'away' THEN away END AS own, CASE side WHEN 'home' THEN away WHEN 'away' THEN home END AS oth FROM m)
        SELECT event_type, count(*) FILTER (own>oth) AS won, count(*) FILTER (own=oth) AS drawn, count(*) FILTER (own<oth) AS lost, count(*) FILTER (own IS NOT NULL AND oth IS NOT NULL) AS counted, count(*) AS total FROM s GROUP BY 1""",
    "biggest_crowds": f"""WITH {_M}, r AS (SELECT *, rank() OVER (PARTITION BY event_type ORDER BY home DESC) AS k FROM m), t AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place, greatest(0, count(*) OVER (PARTITION BY event_type)-5) AS more FROM r WHERE k=1)
        SELECT event_type, event_id, CAST(place AS INTEGER) AS place, more FROM t WHERE place<=5""",
    "renewals": f"WITH {_O}, r AS (SELECT o_orderkey, CAST(date_diff('day', {_D}, day) AS INTEGER) AS days FROM o WHERE day >= DATE '1998-06-01') SELECT *, CASE WHEN days<0 THEN 'overdue' ELSE 'due' END AS status FROM r WHERE days<=20",
    "shortlist": """WITH l AS (SELECT *, CAST(floor(l_quantity/20) AS BIGINT) AS level, min(floor(l_quantity/20)) OVER (PARTITION BY l_orderkey) AS b FROM lineitem), k AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM l WHERE level=b)
        SELECT l_orderkey, l_linenumber, l_partkey, level, CASE WHEN n=1 AND l_returnflag<>'R' THEN 'confident' ELSE 'ambiguous' END AS verdict FROM k""",
    "best_choices": """WITH p AS (SELECT *, p_size%4 AS rank, CASE WHEN p_partkey%3>0 THEN p_retailprice END AS lat FROM part), b AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY rank, lat IS NULL, p_partkey) AS r FROM p),
        k AS (SELECT p_brand, p_type, min(p_partkey) AS o FROM p GROUP BY 1,2), l AS (SELECT p_brand, array_to_string(list(p_type ORDER BY o)[1:3], ',') AS kinds FROM k GROUP BY 1) SELECT p_brand, p_partkey, rank, kinds FROM b JOIN l USING (p_brand) WHERE r=1""",
    "latest_rows": "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS r FROM orders) WHERE r=1",
    "sources_united": "SELECT 'customer' AS source, c_nationkey AS nation, count(*) AS n, count(c_acctbal) AS with_balance FROM customer GROUP BY ALL UNION ALL SELECT 'supplier', s_nationkey, count(*), 0 FROM supplier GROUP BY ALL",
    "rows_compared": """WITH a AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey%3>0), b AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey%5>0)
        SELECT 'left' AS side, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'right', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
    "rows_common": "SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey%2=0 INTERSECT SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey%2=1",
    "labels_filled": """WITH p AS (SELECT *, CASE WHEN p_partkey%2=0 THEN p_type END AS l FROM part), k AS (SELECT p_brand, p_size, min(l) AS m FROM p WHERE l IS NOT NULL GROUP BY 1,2 HAVING min(l)=max(l)) SELECT p_partkey, coalesce(l, m) AS label FROM p LEFT JOIN k USING (p_brand, p_size)""",
    "divisions": """WITH s AS (SELECT c_custkey AS k, c_custkey%3 AS ca, CASE WHEN c_custkey%5>0 THEN c_custkey%2 END AS ta, CASE WHEN c_custkey%4>0 THEN c_custkey%2 END AS ga, (c_custkey+6)%3 AS cb, CASE WHEN (c_custkey+6)%5>0 THEN (c_custkey+6)%2 END AS tb, CASE WHEN (c_custkey+6)%4>0 THEN (c_custkey+6)%2 END AS gb FROM customer),
        u AS (SELECT *, CASE WHEN ta IS NULL OR tb IS NULL THEN 'no tier' WHEN ca=cb AND ta=tb AND (ga IS NULL OR gb IS NULL) THEN 'no group' END AS reason FROM s) SELECT k AS c_custkey, CASE WHEN reason IS NULL THEN coalesce(ca=cb AND ta=tb AND ga=gb, false) END AS same, reason FROM u""",
    "shared_targets": "WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS row, p_brand||'|'||p_size AS t FROM part) SELECT row, min(row) OVER (PARTITION BY t) AS first, CAST(count(*) OVER (PARTITION BY t)-1 AS INTEGER) AS others FROM p QUALIFY count(*) OVER (PARTITION BY t) > 1",
    "pair_sanity": f"""WITH {_edges(24, 0)}, k AS (SELECT *, CASE WHEN y IS NOT NULL THEN least(x,y)||'|'||greatest(x,y) END AS p FROM e), f AS (SELECT *, min(name) OVER (PARTITION BY p) AS first FROM k)
        SELECT name, 'unknown kind' AS problem FROM f WHERE x%5=0 UNION ALL SELECT name, 'both ends are the same' FROM f WHERE x=y UNION ALL SELECT name, 'an end without id or name' FROM f WHERE y IS NULL AND x%12>0 UNION ALL SELECT name, 'pair repeated' FROM f WHERE p IS NOT NULL AND name<>first""",
    "price_rules": """WITH p AS (SELECT p_partkey AS k, CASE WHEN p_partkey%6=0 THEN 0 ELSE p_partkey%90+1.5 END AS lo, p_partkey%80 AS hi FROM part), n AS (SELECT k, (k%6=0)::INT+(hi<lo)::INT+(k%5=0)::INT+(k%4=0)::INT+(k%3=0)::INT AS c FROM p) SELECT k AS p_partkey, c AS problems FROM n WHERE c>0""",
    "formations": "SELECT p_partkey, p_size%5||'-'||p_size%4||'-'||p_size%6 AS f FROM part WHERE p_size%5+p_size%4+p_size%6=10",
    "snapshot_kept": "WITH o AS (SELECT o_custkey%40 AS part, count(*) AS n FROM orders GROUP BY 1) SELECT part, CASE WHEN part%7>0 THEN n ELSE -n END AS n, part%7=0 AS last_fetch_failed FROM o",
    "gated_rows": "SELECT c_custkey, CASE WHEN NOT c_acctbal>1000 THEN 'balance' ELSE 'nation' END AS gate FROM customer WHERE NOT c_acctbal>1000 OR NOT c_nationkey<20",
    "coverage_cube": "SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(grouping(o_orderstatus, o_orderpriority) AS BIGINT) AS level FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "moving_frame": "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving FROM orders",
    "events_tumbling": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "user_sessions": """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
        SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM s GROUP BY user_id, k""",
}
# the stream's rows are those of the batch
ORACLE_SQL["change_states"] = ORACLE_SQL["change_tracking"]
