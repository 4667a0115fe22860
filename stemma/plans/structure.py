"""Queries on versions, trees, joins of sources, references and text forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text as fn
from stemma.lineage import cut
from stemma.operators import characters, compare, history, languoids, references, trees
from stemma.plans.registry import SQL, query, table
from stemma.sources import bibtex

_VERSIONS = """v AS (SELECT 'orders' AS filename, CAST(o_custkey AS VARCHAR) AS bibkey, year(o_orderdate) AS version, max(o_orderkey) // 50 AS id FROM orders GROUP BY ALL)"""


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """orders by customer and year: a year is a version, and the id is that of the last order's block."""
    o = table(spark, folder, "orders").groupBy(F.col("o_custkey").cast("string").alias("bibkey"), F.year("o_orderdate").alias("version")).agg(F.floor(F.max("o_orderkey") / 50).alias("id"))
    return o.select(F.lit("orders").alias("filename"), "bibkey", "version", "id")


@query(f"""WITH {_VERSIONS}, f AS (SELECT filename, bibkey, id, min(version) AS version FROM v GROUP BY ALL)
SELECT filename, bibkey, count(*) AS n, string_agg(version || ':' || id, ', ' ORDER BY version, id) AS history FROM f GROUP BY ALL HAVING count(*) > 1""")
def id_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.id_history(versions(spark, folder))


@query(f"""WITH {_VERSIONS} SELECT a.id, max(b.id) AS replacement FROM v a JOIN v b USING (filename, bibkey) WHERE a.version = 1995 AND b.version = 1996 AND a.id <> b.id
GROUP BY a.id HAVING count(DISTINCT b.id) = 1""")
def version_replacements(spark: SparkSession, folder: str) -> DataFrame:
    return history.replaced(versions(spark, folder), 1995, 1996)


def intervals(spark: SparkSession, folder: str) -> DataFrame:
    """The same versions as intervals, kept up year by year."""
    rows = cut(versions(spark, folder))
    years = [r.version for r in rows.select("version").distinct().orderBy("version").collect()]
    out = history.opened(rows, years[0]) if years else history.opened(rows, 0)
    for year in years[1:]:
        out = cut(history.with_version(out, rows.where(F.col("version") == year), year))
    return out


@query(SQL["id_history"])
def interval_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.history_of(intervals(spark, folder))


@query(SQL["version_replacements"])
def interval_replacements(spark: SparkSession, folder: str) -> DataFrame:
    return history.replaced_by_intervals(intervals(spark, folder), 1995, 1996)


@query("""WITH r AS (SELECT CAST(o_orderdate AS DATE) AS version, o_custkey AS k FROM orders), bad AS (SELECT DISTINCT version FROM r GROUP BY version, k HAVING count(*) > 1)
SELECT CAST(version AS VARCHAR) AS version, count(*) AS n FROM r WHERE version NOT IN (SELECT version FROM bad) GROUP BY version""")
def accepted_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Versions, each a day, whose keys are unique; on some days a customer orders twice."""
    rows = table(spark, folder, "orders").select(F.lit("orders").alias("filename"), F.col("o_custkey").alias("bibkey"), F.to_date("o_orderdate").cast("string").alias("version"))
    good, _ = history.accepted(rows)
    return good.groupBy("version").agg(F.count("*").alias("n"))


def members(spark: SparkSession, folder: str) -> DataFrame:
    """region, nation, customer as a classification."""
    n = table(spark, folder, "nation").join(F.broadcast(table(spark, folder, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    path = n.select("n_nationkey", F.array("r_name", "n_name").alias("path"))
    return table(spark, folder, "customer").join(F.broadcast(path), F.col("c_nationkey") == F.col("n_nationkey")).select("path", F.col("c_name").alias("name"), F.col("c_custkey").alias("code"))


_MEMBERS = "m AS (SELECT [r_name, n_name] AS path, c_name AS name, c_custkey AS code FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
_ROUTES = """p AS (SELECT DISTINCT list_concat([''], path) AS p FROM m),
w AS (SELECT DISTINCT p[i] AS frm, p[j] AS "to", array_to_string(p[i + 1 : j - 1], '>') AS route FROM p, range(1, 4) a(i), range(1, 4) b(j) WHERE i < j)"""


@query(f'WITH {_MEMBERS}, {_ROUTES} SELECT frm, "to", route FROM w')
def walk_routes(spark: SparkSession, folder: str) -> DataFrame:
    return trees.walk_routes(members(spark, folder)).withColumn("route", F.array_join("route", ">"))


@query(f"WITH {_MEMBERS} SELECT name, code, count(DISTINCT path) AS paths FROM m GROUP BY ALL")
def member_paths(spark: SparkSession, folder: str) -> DataFrame:
    return trees.member_paths(members(spark, folder))


@query("""WITH m AS (SELECT l_returnflag || '>' || l_linestatus AS path, l_suppkey AS code FROM lineitem)
SELECT code, string_agg(DISTINCT path, ', ' ORDER BY path) AS paths FROM m GROUP BY code""")
def member_path_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The paths that a member of several is under."""
    rows = table(spark, folder, "lineitem").select(F.array("l_returnflag", "l_linestatus").alias("path"), F.lit("").alias("name"), F.col("l_suppkey").alias("code"))
    return trees.paths_of(rows).select("code", F.array_join(F.transform("paths", lambda p: F.array_join(p, ">")), ", ").alias("paths"))


@query(f"""WITH {_MEMBERS}, {_ROUTES}, a AS (SELECT count(*) AS ambiguous FROM (SELECT 1 FROM w GROUP BY frm, "to" HAVING count(*) > 1)),
b AS (SELECT count(*) AS multiple FROM (SELECT 1 FROM m GROUP BY name, code HAVING count(DISTINCT path) > 1)) SELECT ambiguous, multiple, ambiguous = 0 AND multiple = 0 AS is_tree FROM a, b""")
def is_tree(spark: SparkSession, folder: str) -> DataFrame:
    return trees.is_tree(members(spark, folder))


@query(f"WITH {_MEMBERS} SELECT DISTINCT array_to_string(path[1 : k], ', ') AS prefix, code FROM m, range(1, 3) t(k)")
def extents(spark: SparkSession, folder: str) -> DataFrame:
    return trees.extents(members(spark, folder)).withColumn("prefix", F.array_join("prefix", ", "))


@query(f"WITH {_MEMBERS} SELECT array_to_string(path[1 : k], ', ') AS prefix, array_to_string(list_sort(list(code)), ',') AS codes FROM m, range(1, 3) t(k) GROUP BY ALL")
def extent_lists(spark: SparkSession, folder: str) -> DataFrame:
    return trees.extent_lists(members(spark, folder)).select(F.array_join("prefix", ", ").alias("prefix"), F.array_join("codes", ",").alias("codes"))


@query(f"WITH {_MEMBERS} SELECT array_to_string(path, ', ') AS path, name, code FROM m")
def member_triples(spark: SparkSession, folder: str) -> DataFrame:
    return trees.member_triples(members(spark, folder))


@query("""SELECT user_id, event_id, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS path FROM events""")
def carry_forward(spark: SparkSession, folder: str) -> DataFrame:
    """The last event of one type up to each event of a user."""
    e = table(spark, folder, "events").select("user_id", "event_id", F.when(F.col("event_type") == "view", F.col("event_id")).alias("own"))
    return trees.carried_forward(e, ["user_id"], "event_id", "own", "path").drop("own")


@query("""SELECT n_nationkey AS key, n_name AS name, customers, suppliers FROM nation FULL JOIN (SELECT c_nationkey AS k, count(*) AS customers FROM customer WHERE c_acctbal < 0 GROUP BY ALL) a ON n_nationkey = a.k
FULL JOIN (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_acctbal < 0 GROUP BY ALL) b ON n_nationkey = b.k""")
def languoid_full_outer(spark: SparkSession, folder: str) -> DataFrame:
    """Three sources by one key."""
    n = table(spark, folder, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    c = table(spark, folder, "customer").where("c_acctbal < 0").groupBy(F.col("c_nationkey").alias("key")).agg(F.count("*").alias("customers"))
    s = table(spark, folder, "supplier").where("s_acctbal < 0").groupBy(F.col("s_nationkey").alias("key")).agg(F.count("*").alias("suppliers"))
    return languoids.full_join([n, c, s], "key")


@query("""SELECT c_custkey AS key, coalesce(CASE WHEN c_acctbal > 0 THEN c_nationkey END, s_nationkey) AS nation,
CASE WHEN c_acctbal > 0 AND c_nationkey <> s_nationkey THEN s_nationkey END AS "nation-gl", CASE WHEN s_suppkey IS NULL THEN 'not in other source' END AS note
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""")
def enrich_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("nation"))
    b = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"))
    return languoids.enriched(a, b, "key", ["nation"])


@query("""SELECT c_custkey AS key, c_acctbal AS x, s_acctbal AS x_other FROM customer JOIN supplier ON c_custkey = s_suppkey WHERE abs(c_acctbal - s_acctbal) > 0.001""")
def far_apart(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("x"))
    b = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("x"))
    return languoids.far_apart(a, b, "key", ["x"])


@query("SELECT c, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> '' GROUP BY c")
def char_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """How often each character occurs."""
    return characters.histogram(table(spark, folder, "documents"))


@query("""SELECT c, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> '' AND NOT ord(c) BETWEEN 20 AND 126 GROUP BY c ORDER BY n DESC, c""")
def unusual_characters(spark: SparkSession, folder: str) -> DataFrame:
    """The same without printable ASCII, the most frequent first."""
    return characters.table(table(spark, folder, "documents")).drop("name")


@query("""SELECT conv_id, turn, i AS "index", parts[i] AS part FROM (SELECT conv_id, turn, string_split(text, ' and ') AS parts FROM conversations), range(1, 100000) t(i) WHERE i <= len(parts)""")
def contributors(spark: SparkSession, folder: str) -> DataFrame:
    """The names in a list, numbered from 1."""
    parts = F.split("text", " and ")
    return table(spark, folder, "conversations").select("conv_id", "turn", F.posexplode(parts).alias("i", "part")).select("conv_id", "turn", (F.col("i") + 1).alias("index"), "part")


_COMMENT = "c AS (SELECT p_partkey AS key, 'see **' || p_brand || '**:' || p_size || ' and **' || p_type || '**, ' || p_name AS text FROM part)"


def comments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_partkey").alias("key"), F.concat(F.lit("see **"), "p_brand", F.lit("**:"), "p_size", F.lit(" and **"), "p_type", F.lit("**, "), "p_name").alias("text"))


@query(f"""WITH {_COMMENT}, e AS (SELECT key, regexp_extract_all(text, '\\*\\*([^*]+)\\*\\*(:[\\d,\\s\\-]+)?', 1) AS r, regexp_extract_all(text, '\\*\\*([^*]+)\\*\\*(:[\\d,\\s\\-]+)?', 2) AS p FROM c)
SELECT key, i - 1 AS place, r[i] AS ref, coalesce(p[i], '') AS pages FROM e, range(1, 3) t(i)""")
def ref_extract(spark: SparkSession, folder: str) -> DataFrame:
    return references.extracted(comments(spark, folder), "key", "text")


@query(f"""WITH {_COMMENT}, e AS (SELECT key, unnest(regexp_extract_all(text, '\\*\\*([^*]+)\\*\\*', 1)) AS ref FROM c)
SELECT DISTINCT key, ref FROM e WHERE ref NOT IN (SELECT p_brand FROM part)""")
def ref_unknown(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "part").select(F.col("p_brand").alias("ref")).distinct()
    return references.unknown(references.extracted(comments(spark, folder), "key", "text"), known, "key")


@query("""WITH ids AS (SELECT p_brand AS ref, min(p_partkey) AS id FROM part GROUP BY p_brand)
SELECT p_partkey AS key, 'see **' || id || '**:' || p_size || ' and **' || p_type || '**, ' || p_name AS text FROM part JOIN ids ON ref = p_brand""")
def ref_translate(spark: SparkSession, folder: str) -> DataFrame:
    ids = table(spark, folder, "part").groupBy(F.col("p_brand").alias("ref")).agg(F.min("p_partkey").alias("id"))
    return references.translated(comments(spark, folder), "text", ids)


@query("""WITH ids AS (SELECT p_brand AS ref, min(p_partkey) AS id FROM part GROUP BY p_brand)
SELECT p_size AS key, CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN 'a **' || id || '**:3-4, **' || id || '** and **none**' ELSE p_name END AS text FROM part JOIN ids ON ref = p_brand""")
def ref_translate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same for rows whose keys repeat, with null texts and unknown references."""
    k = F.col("p_partkey") % 3
    text = F.when(k == 1, F.concat(F.lit("a **"), "p_brand", F.lit("**:3-4, **"), "p_brand", F.lit("** and **none**"))).when(k == 2, F.col("p_name"))
    ids = table(spark, folder, "part").groupBy(F.col("p_brand").alias("ref")).agg(F.min("p_partkey").alias("id"))
    return references.translated(table(spark, folder, "part").select(F.col("p_size").alias("key"), text.alias("text")), "text", ids)


_YEARS = """y AS (SELECT p_partkey AS key, CASE p_partkey % 5 WHEN 0 THEN '18' || (10 + p_size) || '-' || (p_size % 10) WHEN 1 THEN '[19' || (10 + p_size) || '] 1952' WHEN 2 THEN 'in press'
WHEN 3 THEN '18' || (10 + p_size) || '/19' || (10 + p_size) ELSE '' END AS text FROM part)"""


@query(f"""WITH {_YEARS}, b AS (SELECT key, CASE WHEN regexp_matches(text, '\\[[\\d,\\-/]+\\]') THEN regexp_extract(text, '\\[([\\d,\\-/]+)\\]', 1) ELSE text END AS s FROM y),
p AS (SELECT key, list_filter(string_split_regex(s, '[,\\-/\\s\\[\\]]+'), lambda x: trim(x) <> '') AS p FROM b)
SELECT key, CASE len(p) WHEN 0 THEN '[nd]' WHEN 1 THEN p[1] ELSE p[1] || '-' || left(p[1], greatest(length(p[1]) - length(p[-1]), 0)) || p[-1] END AS year FROM p""")
def year_range(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    later = (10 + F.col("p_size")).cast("string")
    k = F.col("p_partkey") % 5
    text = F.when(k == 0, F.concat(F.lit("18"), later, F.lit("-"), (F.col("p_size") % 10).cast("string"))).when(k == 1, F.concat(F.lit("[19"), later, F.lit("] 1952"))).when(k == 2, "in press")
    text = text.when(k == 3, F.concat(F.lit("18"), later, F.lit("/19"), later)).otherwise("")
    return p.select(F.col("p_partkey").alias("key"), fn.year(text).alias("year"))


@query("""WITH r AS (SELECT p_partkey AS key, 100 + p_size AS a, 100 + p_size + p_partkey % 90 AS b FROM part) SELECT key, 'xii+' || a || '-' || b AS text, '12+' || (b - a + 1) AS pages, 12 + b - a + 1 AS total FROM r""")
def page_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Roman and Arabic pages of a text and their sum."""
    a = 100 + F.col("p_size")
    text = F.concat(F.lit("xii+"), a, F.lit("-"), a + F.col("p_partkey") % 90)
    out = table(spark, folder, "part").select(F.col("p_partkey").alias("key"), text.alias("text")).withColumn("pages", fn.page_count(F.col("text")))
    return out.withColumn("total", fn.page_value(F.col("pages")))


@query("""SELECT n_nationkey AS key, CASE n_nationkey % 3 WHEN 0 THEN lower(left(n_name, 3)) || '|zsm' WHEN 1 THEN lower(left(n_name, 3)) || '|ind' ELSE '' END AS codes FROM nation""")
def language_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes out of the three ways in which a field lists them."""
    n = table(spark, folder, "nation")
    own = F.lower(F.substring("n_name", 1, 3))
    k = F.col("n_nationkey") % 3
    text = F.when(k == 0, F.concat(F.lit("Own ["), own, F.lit("], Standard Malay [zsm]"))).when(k == 1, F.concat(own, F.lit(", ind"))).otherwise(F.concat(own, F.lit(", Malay")))
    return n.select(F.col("n_nationkey").alias("key"), F.array_join(fn.language_codes(text), "|").alias("codes"))


@query("""SELECT coalesce(c_custkey, s_suppkey) AS key, CASE WHEN s_suppkey IS NULL THEN 'left only' WHEN c_custkey IS NULL THEN 'right only' ELSE 'differ' END AS side, c_nationkey AS "left", s_nationkey AS "right"
FROM customer FULL JOIN supplier ON c_custkey = s_suppkey WHERE c_nationkey IS DISTINCT FROM s_nationkey""")
def differences(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions of entries by key."""
    a = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("v"))
    b = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("v"))
    return compare.differences(a, b, ["key"], "v")


_TITLE = "p_name || ' {" + "Ünïcode} “" + "quoted” 50% #1, ' || p_size || ' = " + "\\" + "\\& ß'"


def _written(spark: SparkSession, folder: str, encoding: str) -> DataFrame:
    """Parts as BibTeX entries with braces, accents, quotes and commas, written as text and read again."""
    p = table(spark, folder, "part")
    title = F.concat("p_name", F.lit(" {Ünïcode} “quoted” 50% #1, "), "p_size", F.lit(" = \\\\& ß"))
    fields = F.create_map(F.lit("title"), title, F.lit("year"), F.col("p_size").cast("string"), F.lit("url"), F.lit("http://é.org/a_b"))
    text = bibtex.entry_text(F.lit("misc"), F.concat(F.lit("p"), "p_partkey"), bibtex.escaped(fields, encoding))
    return bibtex.parsed(p.select(text.alias("text"), (F.concat(F.col("p_partkey") % 3, F.lit(".bib"))).alias("filename")), encoding=encoding)


@query(f"SELECT (p_partkey % 3) || '.bib' AS filename, 'p' || p_partkey AS bibkey, 'misc' AS entrytype, {_TITLE} AS title, CAST(p_size AS VARCHAR) AS year, 'http://é.org/a_b' AS url FROM part")
def bibtex_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Entries as they are after they were written as BibTeX and read again."""
    return _written(spark, folder, "utf-8").select("filename", "bibkey", "entrytype", "fields.title", "fields.year", "fields.url")


@query("SELECT 'p' || p_partkey AS bibkey, CAST(p_size AS VARCHAR) AS year, 'http://é.org/a_b' AS url, true AS letters FROM part")
def latex_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The same in LaTeX encoding: letters come back from their commands, and verbatim fields were never changed."""
    return _written(spark, folder, "latex").select("bibkey", "fields.year", "fields.url", F.col("fields.title").contains("Ünïcode").alias("letters"))


@query("SELECT (p_partkey % 3) || '.bib' AS filename, count(*) AS entries, 0 AS changed FROM part GROUP BY 1")
def roundtrip_check(spark: SparkSession, folder: str) -> DataFrame:
    """By file: how many entries are read again, and how many of them differ if they are written and read a second time."""
    once = _written(spark, folder, "utf-8")
    text = once.select("filename", "fields", bibtex.entry_text(F.col("entrytype"), F.col("bibkey"), F.col("fields")).alias("text"))
    again = bibtex.parsed(text.select("filename", "text")).select("filename", "bibkey", F.map_entries("fields").alias("new"))
    both = once.join(again, ["filename", "bibkey"], "left").withColumn("same", F.array_sort(F.map_entries("fields")).eqNullSafe(F.array_sort("new")))
    return both.groupBy("filename").agg(F.count("*").alias("entries"), F.count_if(~F.col("same")).cast("int").alias("changed"))
