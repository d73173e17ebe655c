"""Queries on names and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import textkeys as T
from ..operators.quality import glossary_problems, translation_problems
from ..operators.ranking import typeahead as typeahead_list
from ..operators.reconcile import angles, same_name_notes
from ..operators.resolve import containment_join, name_candidates, name_join, name_strength
from ..operators.summary import duplicate_groups as groups_of
from ..operators.summary import histogram, modes
from .places import read

FORMS, MARKERS = ["small", "large"], ["ii", "b"]


def _named(spark: SparkSession, d: str) -> DataFrame:
    """Parts with a second spelling of their names: upper case, hyphens, for some a legal form, year or marker more."""
    k = F.col("p_partkey")
    other = F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))), F.when(k % 3 == 0, F.lit(" Small")).otherwise(F.lit("")), F.when(k % 5 == 0, F.lit(" 1904")).otherwise(F.lit("")), F.when(k % 7 == 0, F.lit(" II")).otherwise(F.lit("")))
    return read(spark, d, "part").select("p_partkey", "p_brand", "p_name", other.alias("other"))


def name_core_join(spark: SparkSession, d: str) -> DataFrame:
    p = _named(spark, d)
    a = p.select(F.col("p_partkey").alias("a"), "p_name")
    b = p.select(F.col("p_partkey").alias("b"), "other")
    return name_join(a, b, T.ascii_key("p_name"), T.ascii_key("other"), FORMS, MARKERS, columns=["a", "b"]).select("a", "b")


def token_containment(spark: SparkSession, d: str) -> DataFrame:
    p = _named(spark, d)
    a = p.select(F.col("p_partkey").alias("a"), "other")
    b = p.select("p_name").distinct()
    return containment_join(a, b, "a", "p_name", T.words(T.ascii_key("other")), T.words(T.ascii_key("p_name"))).select("a", "p_name", "exact")


def phrase_in(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select("p_partkey", T.phrase_in(F.lit("red"), T.ascii_key("p_name")).alias("red"), T.phrase_in(F.lit("ring"), T.ascii_key("p_name")).alias("ring"))
    return p.where("red or ring")


def text_key(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", F.md5(T.ascii_key("text")).alias("key"), F.size(T.words(T.ascii_key("text"))).alias("n"))


def german_spelling(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").where("lang = 'de'").select("doc_id", F.md5(T.german_key("text")).alias("key"))


def common_words(spark: SparkSession, d: str) -> DataFrame:
    w = read(spark, d, "documents").select("lang", F.posexplode(F.split("text", " ")).alias("pos", "word"), "doc_id").where("word rlike '^[a-z]{2,}$'")
    return modes(w.withColumn("ord", F.col("doc_id") * 100000 + F.col("pos")), "lang", "word", "ord")


def word_pairs(spark: SparkSession, d: str) -> DataFrame:
    g = read(spark, d, "part").select("p_partkey", F.explode(T.ngrams("p_name", 2)).alias("gram"))
    return g.groupBy("gram").agg(F.count("*").alias("n"))


def html_text(spark: SparkSession, d: str) -> DataFrame:
    t = T.html_text("html")
    return read(spark, d, "pages").select("page_id", F.md5(t).alias("text_md5"), F.length(t).alias("n_chars"))


def html_host(spark: SparkSession, d: str) -> DataFrame:
    return histogram(read(spark, d, "pages"), T.host("url"), "host")


def typeahead(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select("p_partkey", "p_name", "p_size", T.search_key("p_name").alias("key"))
    return typeahead_list(p, "key", "p_size", "p_partkey", "re").select("p_partkey", "p_name", "rank", "more")


def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", F.md5(T.ascii_key("text")).alias("h"))
    return groups_of(docs, "doc_id", [F.col("h")])


def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "nation").select("n_nationkey", T.fingerprint("n_name").alias("fp"))


def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select("c_custkey", T.stable_id("c_name", "c_mktsegment").alias("uid"))


def numbers_found(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "documents").select("doc_id", T.numbers_in("text").alias("n")).where(F.size("n") > 0)
    return c.select("doc_id", F.array_join("n", ",").alias("numbers"))


def card_numbers(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.holds_card_number("text").alias("card")).where("card")


def figures(spark: SparkSession, d: str) -> DataFrame:
    s = F.concat(F.lit("ca. "), (F.col("p_partkey") * 97).cast("string"), F.when(F.col("p_partkey") % 2 == 0, F.lit(" seats")).otherwise(F.lit("")))
    p = read(spark, d, "part").select("p_partkey", T.first_number(F.regexp_replace(s, "[a-z. ]+", ""), F.lit("500")).alias("figure"))
    return p


def wkt_points(spark: SparkSession, d: str) -> DataFrame:
    w = F.concat(F.lit("Point("), (F.col("s_suppkey") * 1.5).cast("string"), F.lit(" "), (F.col("s_suppkey") * 0.25).cast("string"), F.lit(")"))
    return read(spark, d, "supplier").withColumn("p", T.wkt_point(w)).select("s_suppkey", F.col("p")["lat"].alias("lat"), F.col("p")["lon"].alias("lon"))


def strengths(spark: SparkSession, d: str) -> DataFrame:
    p = _named(spark, d)
    s = name_strength(T.words(T.ascii_key("p_name")), T.words(T.ascii_key("other")), F.array(F.lit("ring")))
    return p.select("p_partkey", s.alias("strength"))


def same_names(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").withColumn("key", T.ascii_key("p_name"))
    return same_name_notes(p, "p_partkey", "key", ["p_brand"]).select("p_partkey", "first", "others")


def name_lists(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select("p_partkey", "p_brand", "p_name")
    one = read(spark, d, "part").where("p_partkey % 3 = 0").select("p_brand", F.col("p_type").alias("code"), F.split("p_name", " ")[0].alias("label")).distinct()
    two = read(spark, d, "part").where("p_partkey % 3 = 1").select("p_brand", F.col("p_type").alias("code"), F.split("p_name", " ")[1].alias("label")).distinct()
    return name_candidates(p, [one, two], "p_brand", "p_name").select("p_partkey", "code", "label", "source_order")


def lost_in_translation(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderkey", F.concat(F.lit("Order "), F.col("o_custkey").cast("string"), F.lit(" of "), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("src"))
    o = o.withColumn("dst", F.when(F.col("o_orderkey") % 4 == 0, F.regexp_replace("src", "[0-9]{4}-[0-9]{2}-[0-9]{2}", "?")).otherwise(F.col("src"))).withColumn("fp", F.when(F.col("o_orderkey") % 6 == 0, F.lit("00000000")).otherwise(T.fingerprint("src")))
    p = translation_problems("src", "dst", "fp")
    return o.select("o_orderkey", F.exists(p, lambda x: x == "day missing").alias("day_lost"), F.exists(p, lambda x: x == "stale").alias("stale"))


def glossary_terms(spark: SparkSession, d: str) -> DataFrame:
    """Names whose translation has a term in another form, lacks one, or has all."""
    p = read(spark, d, "part")
    k, words = F.col("p_partkey"), F.split("p_name", " ")
    dst = F.when(k % 3 == 0, F.array_join(F.transform(words, lambda w: F.concat(w, F.lit("i"))), " ")).when(k % 3 == 1, F.concat(words[0], F.lit("elor"))).otherwise(F.upper("p_name"))
    terms = p.select(F.explode(words).alias("term")).distinct().select("term", F.concat("term", F.lit("a")).alias("wanted"))
    phrases = p.select(F.col("p_name").alias("term"), F.concat(F.lit("la "), words[0], F.lit("e "), words[1]).alias("wanted")).distinct()
    rows = p.select("p_partkey", "p_name", dst.alias("dst"))
    return glossary_problems(rows, "p_partkey", "p_name", "dst", terms.unionByName(phrases))


def reasons_listed(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer")
    return c.select("c_custkey", F.array_join(angles(debt=F.col("c_acctbal") < 0, machinery=F.col("c_mktsegment") == "MACHINERY"), ",").alias("why")).where("why <> ''")


QUERIES = {
    f.__name__: f
    for f in (name_core_join, token_containment, phrase_in, text_key, german_spelling, common_words, word_pairs, html_text, html_host, typeahead, duplicate_groups, fingerprints, stable_ids, numbers_found, card_numbers, figures, wkt_points, strengths, same_names, name_lists, lost_in_translation, glossary_terms, reasons_listed)
}

_KEY = "trim(regexp_replace(lower(strip_accents(replace({0}, 'ß', 'ss'))), '[^a-z0-9]+', ' ', 'g'))"
_N = """n AS (SELECT p_partkey, p_brand, p_name, upper(replace(p_name,' ','-')) || CASE WHEN p_partkey%3=0 THEN ' Small' ELSE '' END || CASE WHEN p_partkey%5=0 THEN ' 1904' ELSE '' END || CASE WHEN p_partkey%7=0 THEN ' II' ELSE '' END AS other FROM part),
 w AS (SELECT p_partkey, p_name, string_split(lower(p_name), ' ') AS a, string_split(replace(lower(other),'-',' '), ' ') AS b FROM n)"""
_PARTS = "list_sort(list_distinct(list_filter({0}, lambda x: x NOT IN ('small','large','ii','b','1904')))) AS {1}c, list_filter({0}, lambda x: x IN ('small','large')) AS {1}f, list_contains({0}, 'ii') AS {1}m"
_ALNUM = r"""trim(regexp_replace(regexp_replace({0}, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"""
_HT = "html"
ORACLE_SQL = {
    "name_core_join": f"""WITH {_N}, x AS (SELECT p_partkey AS a, {_PARTS.format('a', 'a')} FROM w), y AS (SELECT p_partkey AS b, {_PARTS.format('b', 'b')} FROM w)
        SELECT x.a, y.b FROM x JOIN y ON ac = bc AND am = bm WHERE len(ac) > 0 AND NOT (len(af) > 0 AND len(bf) > 0 AND len(list_intersect(af, bf)) = 0)""",
    "token_containment": f"""WITH {_N}, t AS (SELECT DISTINCT p_name, list_distinct(a) AS a FROM w) SELECT w.p_partkey AS a, t.p_name, len(list_distinct(w.b)) = len(t.a) AS exact FROM w, t WHERE list_has_all(w.b, t.a)""",
    "phrase_in": "SELECT p_partkey, (' '||p_name||' ') LIKE '% red %' AS red, (' '||p_name||' ') LIKE '% ring %' AS ring FROM part WHERE (' '||p_name||' ') LIKE '% red %' OR (' '||p_name||' ') LIKE '% ring %'",
    "text_key": f"WITH k AS (SELECT doc_id, {_KEY.format('text')} AS k FROM documents) SELECT doc_id, md5(k) AS key, CAST(CASE WHEN k = '' THEN 0 ELSE len(string_split(k, ' ')) END AS INTEGER) AS n FROM k",
    "german_spelling": "SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(replace(replace(replace(replace(replace(replace(replace(text,'ä','ae'),'ö','oe'),'ü','ue'),'Ä','Ae'),'Ö','Oe'),'Ü','Ue'),'ß','ss'))), '[^0-9a-z]+', ' ', 'g'))) AS key FROM documents WHERE lang = 'de'",
    "common_words": """WITH x AS (SELECT lang, doc_id, string_split(text, ' ') AS w FROM documents), e AS (SELECT lang, doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM x),
        c AS (SELECT lang, word, count(*) AS n, min(doc_id*100000+pos) AS f FROM e WHERE regexp_full_match(word, '[a-z]{2,}') GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, f) AS k FROM c) SELECT lang, word, n FROM r WHERE k = 1""",
    "word_pairs": """WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part), g AS (SELECT p_partkey, unnest(list_distinct(list_concat(list_filter(w, lambda x: len(x) >= 3), CASE WHEN len(w) = 2 THEN [p] ELSE [] END,
        list_transform(list_filter(w, lambda x: len(x) >= 6 AND x LIKE '%er'), lambda x: x[:-3])))) AS gram FROM (SELECT *, array_to_string(w, ' ') AS p FROM w)) SELECT gram, count(*) AS n FROM g GROUP BY 1""",
    "html_text": r"""WITH e AS (SELECT key AS name, value AS char FROM (SELECT unnest(map_entries(CAST('@'::JSON AS MAP(VARCHAR, VARCHAR))), recursive := true))),
        p AS (SELECT page_id, unnest(string_split(t, '&')) AS p, generate_subscripts(string_split(t, '&'), 1) AS i FROM (SELECT page_id, regexp_replace(html, '<[^>]*>', ' ', 'g') AS t FROM pages)),
        q AS (SELECT *, regexp_extract(p, '^([A-Za-z][A-Za-z0-9]*;)', 1) AS n, regexp_extract(p, '^#([0-9]{1,7});', 1) AS d, regexp_extract(p, '^#[xX]([0-9a-fA-F]{1,6});', 1) AS h FROM p),
        u AS (SELECT page_id, i, CASE WHEN i = 1 THEN p WHEN char IS NOT NULL THEN char || substr(p, length(n) + 1) WHEN d <> '' THEN chr(d::INT) || substr(p, length(d) + 3) WHEN h <> '' THEN chr(('0x' || h)::INT) || substr(p, length(h) + 4) ELSE '&' || p END AS s FROM q LEFT JOIN e ON e.name || ';' = q.n),
        t AS (SELECT page_id, trim(regexp_replace(string_agg(s, '' ORDER BY i), '[\s\x{a0}]+', ' ', 'g')) AS t FROM u GROUP BY 1)
        SELECT page_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS n_chars FROM t""".replace("@", T._entities().replace("'", "''")),
    "html_host": "WITH h AS (SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host FROM pages) SELECT host, count(*) AS n FROM h WHERE host <> '' GROUP BY 1",
    "typeahead": """WITH f AS (SELECT p_partkey, p_name, p_size, CASE WHEN p_name LIKE 're%' THEN 0 WHEN p_name LIKE '% re%' THEN 1 ELSE 2 END AS rank FROM part WHERE p_name LIKE '%re%')
        SELECT p_partkey, p_name, rank, (SELECT greatest(0, count(*) - 8) FROM f) AS more FROM f ORDER BY rank, p_size, p_partkey LIMIT 8""",
    "duplicate_groups": f"WITH k AS (SELECT doc_id, md5({_KEY.format('text')}) AS h FROM documents) SELECT min(doc_id) AS first, CAST(count(DISTINCT doc_id) AS INTEGER) AS n, max(doc_id) AS last FROM k GROUP BY h HAVING count(DISTINCT doc_id) > 1",
    "fingerprints": """WITH RECURSIVE f(k, name, i, h) AS (SELECT n_nationkey, n_name, 0, 2166136261::HUGEINT FROM nation
        UNION ALL SELECT k, name, i+1, (xor(h::UBIGINT, ascii(substr(name, i+1, 1))::UBIGINT)::HUGEINT * 16777619) % 4294967296 FROM f WHERE i < length(name))
        SELECT k AS n_nationkey, lpad(lower(to_hex(h::UBIGINT)), 8, '0') AS fp FROM f WHERE i = length(name)""",
    "stable_ids": "SELECT c_custkey, substr(sha256(lower(c_name || '|' || c_mktsegment)), 1, 12) AS uid FROM customer",
    "numbers_found": """WITH e AS (SELECT doc_id, list_sort(list_distinct(list_transform(regexp_extract_all(text, '([0-9]+(?:[.,''   ][0-9]{3})*)', 1), lambda x: regexp_replace(x, '[^0-9]', '', 'g')))) AS n FROM documents)
        SELECT doc_id, array_to_string(n, ',') AS numbers FROM e WHERE len(n) > 0""",
    "card_numbers": r"""WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '([^0-9])', '\1\1', 'g') AS t FROM documents WHERE regexp_matches(text, '[0-9]([ -]?[0-9]){12}')),
        r AS (SELECT doc_id, regexp_replace(unnest(regexp_extract_all(t, '(?:^|[^0-9])([0-9](?:(?:  |--)?[0-9]){12,18})(?:[^0-9]|$)', 1)), '[^0-9]', '', 'g') AS n FROM t)
        SELECT DISTINCT doc_id, true AS card FROM r WHERE list_sum(list_transform(range(1, length(n)+1), lambda i: CASE WHEN i%2=1 THEN CAST(substr(n, length(n)+1-i, 1) AS INT) ELSE (2*CAST(substr(n, length(n)+1-i, 1) AS INT))%10 + (2*CAST(substr(n, length(n)+1-i, 1) AS INT))//10 END)) % 10 = 0""",
    "figures": "SELECT p_partkey, CAST(CASE WHEN p_partkey*97 BETWEEN 100 AND 200000 THEN p_partkey*97 ELSE 500 END AS BIGINT) AS figure FROM part",
    "wkt_points": "SELECT s_suppkey, s_suppkey*0.25::DOUBLE AS lat, s_suppkey*1.5::DOUBLE AS lon FROM supplier",
    "strengths": f"""WITH {_N}, s AS (SELECT p_partkey, list_distinct(a) AS a, list_distinct(b) AS b, list_filter(a, lambda x: x <> 'ring') AS x, list_filter(b, lambda x: x <> 'ring') AS y FROM w)
        SELECT p_partkey, CASE WHEN list_has_all(a,b) AND list_has_all(b,a) THEN 'exact' WHEN len(x)=0 OR len(y)=0 THEN NULL WHEN list_has_all(x,y) AND list_has_all(y,x) THEN 'exact' WHEN list_has_all(x,y) OR list_has_all(y,x) THEN 'contained' END AS strength FROM s""",
    "same_names": "WITH p AS (SELECT * FROM part) SELECT a.p_partkey, least(a.p_partkey, min(b.p_partkey)) AS first, CAST(count(*) AS INTEGER) AS others FROM p a JOIN p b ON a.p_name = b.p_name AND a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey GROUP BY 1",
    "name_lists": """WITH p AS (SELECT p_partkey, p_brand, p_name FROM part), o AS (SELECT DISTINCT p_brand, p_type AS code, split_part(p_name,' ',1) AS label FROM part WHERE p_partkey%3=0),
        t AS (SELECT DISTINCT p_brand, p_type AS code, split_part(p_name,' ',2) AS label FROM part WHERE p_partkey%3=1),
        a AS (SELECT p_partkey, code, label, 0 AS source_order FROM p JOIN o USING (p_brand) WHERE contains(p_name, label) OR contains(label, p_name)),
        b AS (SELECT p_partkey, code, label, 1 AS source_order FROM p JOIN t USING (p_brand) WHERE contains(p_name, label) OR contains(label, p_name))
        SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.p_partkey = b.p_partkey AND a.code = b.code)""",
    "lost_in_translation": "SELECT o_orderkey, o_orderkey % 4 = 0 AS day_lost, o_orderkey % 6 = 0 AS stale FROM orders",
    "glossary_terms": """WITH p AS (SELECT p_partkey, p_name, string_split(p_name, ' ') AS w FROM part), t AS (SELECT *, CASE p_partkey%3 WHEN 0 THEN array_to_string(list_transform(w, lambda x: x || 'i'), ' ') WHEN 1 THEN w[1] || 'elor' ELSE p_name END AS dst FROM p),
        g AS (SELECT DISTINCT unnest(w) AS term FROM p), h AS (SELECT term, term || 'a' AS wanted, [term || 'a'] AS ws FROM g UNION ALL SELECT DISTINCT p_name, 'la ' || w[1] || 'e ' || w[2], [w[1] || 'e', w[2]] FROM p),
        s AS (SELECT term, wanted, list_transform(list_filter(ws, lambda x: length(x) >= 3), lambda x: CASE WHEN length(x) > 3 AND right(x, 1) IN ('a', 'e', 'i', 'u') THEN x[:-2] ELSE x END) AS stems FROM h)
        SELECT p_partkey, term, wanted FROM t JOIN s ON contains(' ' || p_name || ' ', ' ' || term || ' ') WHERE NOT list_aggregate(list_transform(stems, lambda x: contains(dst, x)), 'bool_and')""",
    "reasons_listed": "WITH r AS (SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'debt' END, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'machinery' END) AS why FROM customer) SELECT * FROM r WHERE why <> ''",
}
