"""DuckDB SQL with the rows of those of the subpackage's queries that SQL can express."""

from __future__ import annotations

from .ranked import TERM
from .repetition import MOST_COVERED, MOST_IN_LINES

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP1 = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)),
    e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, m.c = d.doc_id AS kept
    FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m ON m.doc_id = d.doc_id"""

_OP2 = f"""WITH w AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents), x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, CASE WHEN len(w) >= 50 THEN len(w) - 49 ELSE 0 END AS n FROM w),
    k AS (SELECT doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 48))) AS i FROM w)),
    d AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) < doc_id AS dup FROM k),
    c AS (SELECT x.doc_id, x.i, word, coalesce(max(dup::INT) OVER (PARTITION BY x.doc_id ORDER BY x.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone FROM x LEFT JOIN d ON d.doc_id = x.doc_id AND d.i = x.i)
    SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(sum(gone), 0)::BIGINT AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256
    FROM w LEFT JOIN c ON c.doc_id = w.doc_id GROUP BY w.doc_id, w.w"""


def _grams(k: int) -> str:
    return f"""g{k} AS (SELECT doc_id, i, (count(*) OVER (PARTITION BY doc_id, g) > 1)::INT AS dup FROM (SELECT doc_id, i, array_to_string(w[i:i+{k - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {k - 2}))) AS i FROM w))),
    c{k} AS (SELECT x.doc_id, sum(s) FILTER (m = 1) AS chars, count(*) FILTER (m = 1) AS words FROM (SELECT x.doc_id, s, max(dup) OVER (PARTITION BY x.doc_id ORDER BY x.i ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS m FROM x LEFT JOIN g{k} g ON g.doc_id = x.doc_id AND g.i = x.i) x GROUP BY 1)"""


def _op3() -> str:
    # limits as repetition.py has them
    over = " OR ".join(f"coalesce(c{k}.chars, 0) / word_chars > {v}" for k, v in MOST_COVERED.items())
    joins = " ".join(f"LEFT JOIN c{k} ON c{k}.doc_id = d.doc_id" for k in MOST_COVERED)
    return rf"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("text")} AS w FROM documents), x AS (SELECT doc_id, i, length(word) AS s FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w)),
    {", ".join(map(_grams, MOST_COVERED))},
    l AS (SELECT doc_id, line, count(*) AS n, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS c FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
    ll AS (SELECT doc_id, sum(n - 1) AS dup, sum((n - 1) * c) AS dup_chars FROM l GROUP BY 1),
    d AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM w),
    v AS (SELECT d.*, coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(c8.words, 0)::BIGINT AS n_repeat_words, coalesce(dup_chars, 0) AS dup_chars, {over} AS over FROM d LEFT JOIN ll ON ll.doc_id = d.doc_id {joins}),
    f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM v)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT over AND dup_chars / word_chars <= {MOST_IN_LINES} AS kept FROM f"""


_OP7 = """WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages), s AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS last FROM p),
    b AS (SELECT *, list_transform([0, 1, 2, 3], lambda c: ('0x' || substr(x, 1 + 10 * c, 10))::UBIGINT) AS v FROM s)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, array_to_string(list_transform(v, lambda q: array_to_string(list_transform([35, 30, 25, 20, 15, 10, 5, 0], lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((q >> j) & 31)::INT, 1)), '')), '') AS payload_digest,
    CASE WHEN last = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN last <> page_id THEN last END AS refers_to FROM b"""

_OP13 = """WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || x)) AS p FROM t),
    l AS (SELECT conv_id, list({'role': role, 'x': x} ORDER BY p) AS ts, list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, k: xor(s >> 1, 3988292384 * (s & 1)))) AS crc FROM o GROUP BY conv_id),
    h AS (SELECT *, xor(crc, 4294967295) % 6 AS h FROM l),
    b AS (SELECT h.conv_id, list_concat(coalesce(base.ts[1:h.h], []), h.ts[h.h + 1:]) AS ts FROM h LEFT JOIN l base ON base.conv_id = h.conv_id - h.conv_id % 100),
    g AS (SELECT d, ts[1:d] AS pre, min(conv_id) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ts) = d), '')) AS ends FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM b) GROUP BY ALL),
    c AS (SELECT d - 1 AS d, pre[1:d - 1] AS pre, count(*) AS k FROM g WHERE d > 0 GROUP BY ALL),
    v AS (SELECT g.*, coalesce(c.k, 0) AS k, CASE WHEN g.d > 0 THEN (g.n - 1) * length(g.pre[g.d].x) ELSE 0 END AS s FROM g LEFT JOIN c ON c.d = g.d AND c.pre = g.pre),
    r AS (SELECT a, pre[1:a] AS pre, sum((k = 0)::BIGINT) AS leaves, sum(s) AS saved FROM (SELECT *, unnest(range(d + 1)) AS a FROM v) GROUP BY ALL)
    SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n AS n_convs, v.k AS n_children, r.leaves::BIGINT AS n_leaves, r.saved::BIGINT AS saved_tokens, v.ends AS ends_sha256
    FROM v JOIN r ON r.a = v.d AND r.pre = v.pre LEFT JOIN v up ON up.d = v.d - 1 AND up.pre = v.pre[1:v.d - 1]"""

_OP11 = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}') AS w FROM documents),
    s AS (SELECT count(*) AS docs, sum(len(w)) AS total FROM d WHERE len(w) > 0),
    p AS (SELECT doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY doc_id, term),
    f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY term),
    i AS (SELECT item_id, term, count(*) AS m FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}')) AS term FROM benchmark) GROUP BY ALL),
    r AS (SELECT item_id, doc_id, CAST(sum(m * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score FROM i JOIN p USING (term) JOIN f USING (term), s GROUP BY ALL)
    SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 20"""

ORACLE_SQL = {"op1_minhash": _OP1, "op2_substrings": _OP2, "op3_repetition": _op3(), "op7_warc": _OP7, "op11_ranked": _OP11, "op13_trie": _OP13}
