"""Queries on words, match keys and annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text as fn
from stemma.operators import annotate, compare, keyid
from stemma.plans.registry import SQL, query, table

#: Small rule and word tables of these queries.
RULE_SET = {
    ("kind", "english", 3): [[(True, "the"), (False, "la")], [(True, "of"), (True, "and")]],
    ("kind", "romance", 2): [[(True, "la")], [(True, "de"), (False, "der")]],
    ("kind", "german", 1): [[(True, "der")], [(True, "und"), (True, "die")]],
    ("kind", "bare", 0): [[(False, "the"), (False, "de"), (False, "der")]],
}
DICTIONARY = {"the": "eng", "of": "eng", "and": "eng", "der": "deu", "und": "deu", "die": "deu", "les": "fra", "des": "fra", "los": "spa", "del": "spa"}

_STRIP = "replace(replace(replace(regexp_replace(strip_accents(lower({0})), '[{{}}]', '', 'g'), 'ß', 'ss'), '''', ''), '\"', '')"
_WORDS = "list_filter(string_split_regex(" + _STRIP + ", '[()\\[\\]:,.\\s\\-?!;/~=]+'), lambda w: w <> '')"


def _sql_words(column: str) -> str:
    return _WORDS.format(column)


_TITLE = "text"
_TITLED = f"""doc AS (SELECT doc_id, lang, source, {_sql_words(_TITLE)} AS ws FROM documents),
freq AS (SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM doc) GROUP BY word)"""
_TYPES = """types AS (SELECT doc_id, source, word, min(i) AS i FROM (SELECT doc_id, source, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM doc)
  WHERE regexp_matches(word, '^[a-zA-Z].') GROUP BY ALL),
rare AS (SELECT doc_id, source, word, i, row_number() OVER (PARTITION BY doc_id, source ORDER BY n, i) AS r FROM types JOIN freq USING (word)),
two AS (SELECT doc_id, source, string_agg(word, '-' ORDER BY i) AS rarest FROM rare WHERE r <= 2 GROUP BY ALL)"""


def _titled(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts stand for titles."""
    return table(spark, folder, "documents").select("doc_id", "source", "lang", F.col("text").alias("title"))


@query(f"WITH {_TITLED} SELECT word, n FROM freq")
def title_words(spark: SparkSession, folder: str) -> DataFrame:
    """How often each word occurs in titles."""
    return keyid.word_frequencies(_titled(spark, folder))


@query(f"WITH {_TITLED}, {_TYPES} SELECT doc_id, rarest FROM two")
def rarest_words(spark: SparkSession, folder: str) -> DataFrame:
    """The two rarest distinct words of each title, the earlier first, in title order."""
    d = _titled(spark, folder)
    return keyid.rarest(d, "doc_id", keyid.word_frequencies(d), complete=True).select("doc_id", F.array_join("rarest", "-").alias("rarest"))


@query(f"""WITH {_TITLED}, {_TYPES} SELECT doc_id, regexp_replace(lower(d.source || '_' || coalesce(rarest, '') || CAST(1900 + doc_id % 120 AS VARCHAR)), '[^a-z0-9_\\-\\[\\]]', '', 'g') AS hash
FROM doc d LEFT JOIN two USING (doc_id)""")
def keyid_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Match keys of documents: source as the author's name, two rarest words, year."""
    d = _titled(spark, folder)
    entries = d.select("doc_id", "title", F.initcap("source").alias("author"), (1900 + F.col("doc_id") % 120).cast("string").alias("year"))
    return keyid.keyed(entries, "doc_id").select("doc_id", "hash")


_RULE_SQL = {"english": [("the and not la", "list_contains(ws, 'the') AND NOT list_contains(ws, 'la')"), ("and and of", "list_contains(ws, 'and') AND list_contains(ws, 'of')")],
             "romance": [("la", "list_contains(ws, 'la')"), ("de and not der", "list_contains(ws, 'de') AND NOT list_contains(ws, 'der')")],
             "bare": [("not de and not der and not the", "NOT list_contains(ws, 'the') AND NOT list_contains(ws, 'de') AND NOT list_contains(ws, 'der')")],
             "german": [("der", "list_contains(ws, 'der')"), ("die and und", "list_contains(ws, 'die') AND list_contains(ws, 'und')")]}
_RANK = {"english": 3, "romance": 2, "german": 1, "bare": 0}
_FIRED = " UNION ALL ".join(f"SELECT doc_id, '{label}' AS label, {_RANK[label]} AS rank, '{rule.replace('the and not la', 'not la and the')}' AS rule FROM doc WHERE {cond}" for label, rules in _RULE_SQL.items() for rule, cond in rules)


@query(f"""WITH doc AS (SELECT doc_id, {_sql_words('text')} AS ws FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
fired AS ({_FIRED}), one AS (SELECT doc_id, label, rank, string_agg(DISTINCT rule, ';' ORDER BY rule) AS rules FROM fired GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rank DESC, label) AS r FROM one)
SELECT doc_id, 'kind' AS class, label || ' (computerized assignment from "' || rules || '")' AS value FROM best WHERE r = 1""")
def trigger_annotate(spark: SparkSession, folder: str) -> DataFrame:
    """Label the documents that have no label of their own, by rules over their words."""
    d = table(spark, folder, "documents").join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_anti")
    rules = spark.createDataFrame(annotate.rule_rows(RULE_SET), annotate.RULES)
    return annotate.annotated(annotate.fired(d.select("doc_id", fn.words(F.col("text")).alias("ws")), "doc_id", "ws", rules), "doc_id")


@query(SQL["trigger_annotate"])
def trigger_annotate_by_index(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the way for any number of rules: each found by the rarest of its words."""
    d = table(spark, folder, "documents").join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_anti")
    rules = spark.createDataFrame(annotate.rule_rows(RULE_SET), annotate.RULES)
    return annotate.annotated(annotate.fired_by_index(d.select("doc_id", fn.words(F.col("text")).alias("ws")), "doc_id", "ws", rules), "doc_id")


@query("""SELECT rule, string_agg(DISTINCT label, ', ' ORDER BY label) AS labels FROM (
SELECT CASE WHEN p_size % 2 = 0 THEN a || ' and ' || b ELSE 'not ' || a || ' and ' || b END AS rule, p_brand AS label FROM (
SELECT p_size, p_brand, least(lower(split_part(p_type, ' ', 1)), lower(split_part(p_name, ' ', 1))) AS a, greatest(lower(split_part(p_type, ' ', 1)), lower(split_part(p_name, ' ', 1))) AS b FROM part) WHERE a <> b) GROUP BY rule""")
def trigger_rule_index(spark: SparkSession, folder: str) -> DataFrame:
    """Rules of two words of a part, the first negative for odd sizes, each with the brands that have it."""
    word = lambda c: F.lower(F.substring_index(c, " ", 1))
    p = table(spark, folder, "part").select("p_size", "p_brand", F.least(word("p_type"), word("p_name")).alias("a"), F.greatest(word("p_type"), word("p_name")).alias("b")).where("a <> b").distinct()
    keys = sorted((r.p_brand, r.p_size % 2, r.a, r.b) for r in p.collect())
    rows = annotate.rule_rows({("brand", brand, k): [[(not odd, a), (True, b)]] for k, (brand, odd, a, b) in enumerate(keys)})
    return annotate.rule_index(spark.createDataFrame(rows, annotate.RULES))


_DICT_SQL = "dict(word, label) AS (VALUES " + ", ".join(f"('{w}', '{x}')" for w, x in DICTIONARY.items()) + ")"


@query(f"""WITH {_DICT_SQL}, w AS (SELECT DISTINCT doc_id, unnest({_sql_words('text')}) AS word FROM documents)
SELECT doc_id, min(label) AS label FROM w JOIN dict USING (word) GROUP BY doc_id HAVING count(DISTINCT label) = 1""")
def unique_label(spark: SparkSession, folder: str) -> DataFrame:
    """The language of writing, where the known words agree."""
    d = table(spark, folder, "documents").select("doc_id", fn.words(F.col("text")).alias("ws"))
    return annotate.unique_label(d, "doc_id", "ws", spark.createDataFrame(list(DICTIONARY.items()), "word string, label string"))


@query(f"""WITH w AS (SELECT lang, unnest({_sql_words('text')}) AS word FROM documents), c AS (SELECT lang, word, count(*) AS f FROM w GROUP BY ALL),
t AS (SELECT word, sum(f) AS total FROM c GROUP BY word) SELECT lang, word, f, (1 + f) / (1 - f + total) AS specificity FROM c JOIN t USING (word) WHERE f > 9""")
def word_specificity(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    return annotate.specificity(d.select("lang", F.explode(fn.words(F.col("text"))).alias("word")), "lang", "word")


@query("""SELECT c_mktsegment AS segment, string_agg(DISTINCT r_name, ', ' ORDER BY r_name) AS areas FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY c_mktsegment""")
def macro_area(spark: SparkSession, folder: str) -> DataFrame:
    """The areas of a record's codes."""
    pairs = table(spark, folder, "customer").groupBy("c_mktsegment").agg(F.collect_set("c_nationkey").alias("codes"))
    areas = table(spark, folder, "nation").join(F.broadcast(table(spark, folder, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("code"), F.col("r_name").alias("area"))
    return annotate.looked_up(pairs.withColumnRenamed("c_mktsegment", "segment"), "segment", "codes", areas, "code", "area")


_T = "t AS (SELECT p_type AS kind, row_number() OVER (ORDER BY p_type) AS place FROM (SELECT DISTINCT p_type FROM part))"
_TOP = "SELECT p_brand AS lang, max(place) AS place, arg_max(kind, place) AS kind FROM part JOIN t ON p_type = kind"


def _part(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, folder, "part").select(F.col("p_brand").alias("lang"), F.col("p_type").alias("kind"), F.concat(F.lit("p"), "p_partkey").alias("key"), F.col("p_size").alias("pages"), F.col("p_retailprice").alias("price"))
    return p, annotate.ranks(p.select("kind").distinct().withColumn("rank", F.lit(0)), "kind", "rank")


@query(f"WITH {_T} {_TOP} GROUP BY p_brand")
def status_top(spark: SparkSession, folder: str) -> DataFrame:
    p, types = _part(spark, folder)
    return annotate.status(p, "lang", "kind", types).withColumn("place", F.col("place").cast("long"))


@query(f"WITH {_T}, s AS ({_TOP} GROUP BY p_brand) SELECT s.lang, s.kind, 'p' || p_partkey AS key FROM part JOIN s ON p_brand = s.lang AND p_type = s.kind")
def status_witness(spark: SparkSession, folder: str) -> DataFrame:
    p, types = _part(spark, folder)
    return annotate.witnesses(p, "lang", "kind", types).select("lang", "kind", "key")


@query(f"""WITH {_T}, a AS ({_TOP} GROUP BY p_brand), b AS ({_TOP} WHERE p_size <= 3 GROUP BY p_brand)
SELECT a.lang, b.kind AS before, a.kind AS after FROM a JOIN b USING (lang) WHERE a.place > b.place""")
def status_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Brands whose top type is higher than among small parts, the reference records."""
    p, types = _part(spark, folder)
    return annotate.guarded(p.where("pages <= 3"), p, "lang", "kind", types)


@query("""SELECT lang, kind, key, pages FROM (SELECT p_brand AS lang, p_type AS kind, 'p' || p_partkey AS key, p_size AS pages,
row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_size DESC, p_retailprice DESC, 'p' || p_partkey DESC) AS r FROM part) WHERE r = 1""")
def best_material(spark: SparkSession, folder: str) -> DataFrame:
    p, _ = _part(spark, folder)
    return annotate.best_material(p, ["lang", "kind"], F.col("pages"), F.col("price"), "key").where("place = 1").select("lang", "kind", "key", "pages")


_KINDS = "list_sort(list_distinct([p_type, 'SMALL ' || p_size % 3]))"


@query(f"""WITH m AS (SELECT 'p' || p_partkey AS key, CASE WHEN p_partkey % 5 = 0 THEN ['!Unsorted'] WHEN p_partkey % 2 = 0 THEN [p_brand, 'B' || p_size % 4] ELSE [p_brand] END AS languages,
{_KINDS} AS kinds, p_size AS pages, p_retailprice AS year FROM part),
t AS (SELECT kind, row_number() OVER (ORDER BY kind) AS rank FROM (SELECT DISTINCT unnest(kinds) AS kind FROM m) WHERE kind <> 'SMALL 2'),
e AS (SELECT key, language, pages / len(kinds) AS pages, year, unnest(kinds) AS kind FROM (SELECT *, unnest(languages) AS language FROM m))
SELECT language, row_number() OVER (PARTITION BY language ORDER BY rank DESC, pages DESC, year DESC, key DESC) AS place, kind, rank, pages, year, key FROM e JOIN t USING (kind)""")
def descriptive_material(spark: SparkSession, folder: str) -> DataFrame:
    """The material of each brand by type, pages shared by a part's types; parts without a brand are unsorted."""
    p, k = table(spark, folder, "part"), F.col("p_partkey")
    languages = F.when(k % 5 == 0, F.array().cast("array<string>")).when(k % 2 == 0, F.array("p_brand", F.concat(F.lit("B"), F.col("p_size") % 4))).otherwise(F.array("p_brand"))
    kinds = F.array_sort(F.array_distinct(F.array("p_type", F.concat(F.lit("SMALL "), F.col("p_size") % 3))))
    m = p.select(F.concat(F.lit("p"), k).alias("key"), languages.alias("languages"), kinds.alias("kinds"), F.col("p_size").alias("pages"), F.col("p_retailprice").alias("year"))
    names = m.select(F.explode("kinds").alias("kind")).distinct().where("kind <> 'SMALL 2'").withColumn("r", F.lit(0))
    out = annotate.descriptive_material(m, annotate.ranks(names, "kind", "r"))
    return out.withColumns({"place": F.col("place").cast("long"), "rank": F.col("rank").cast("long")})


_MARKED = """d AS (SELECT 'd' || doc_id AS key, source AS language, list_contains(ws, 'the') AS a, list_contains(ws, 'der') AS b, doc_id % 3 = 0 AS own FROM
(SELECT doc_id, source, """ + _sql_words("text") + """ AS ws FROM documents)),
after AS (SELECT key, language, CASE WHEN own THEN 'wordlist' WHEN a THEN 'grammar' WHEN b THEN 'text' END AS kind,
 CASE WHEN own THEN 'wordlist' WHEN a THEN 'grammar (computerized assignment from "the")' WHEN b THEN 'text (computerized assignment from "der")' END AS value FROM d),
place(kind, p) AS (VALUES ('text', 1), ('wordlist', 2), ('grammar', 3)),
before AS (SELECT language, max(p) AS p FROM after JOIN place USING (kind) WHERE kind = 'wordlist' GROUP BY language),
top AS (SELECT language, max(p) AS p FROM after JOIN place USING (kind) GROUP BY language),
risen AS (SELECT language, top.p, before.p AS q FROM top JOIN before USING (language) WHERE top.p > before.p),
seen AS (SELECT key, language, q, value FROM after JOIN place USING (kind) JOIN risen USING (language, p))"""
_HHTYPES = {("hhtype", "grammar", 3): [[(True, "the")]], ("hhtype", "text", 1): [[(True, "der")]]}


def _conservative(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents marked with types by their words, a third with a type of their own, which are the reference records."""
    d = table(spark, folder, "documents")
    own = F.when(F.col("doc_id") % 3 == 0, F.create_map(F.lit("title"), "text", F.lit("lgcode"), "source", F.lit("hhtype"), F.lit("wordlist"))).otherwise(F.create_map(F.lit("title"), "text", F.lit("lgcode"), "source"))
    records = d.select(F.concat(F.lit("d"), "doc_id").alias("key"), own.alias("fields"))
    types = spark.createDataFrame([("text", 1), ("wordlist", 2), ("grammar", 3)], "kind string, place int")
    marked = annotate.marked(records, spark.createDataFrame(annotate.rule_rows(_HHTYPES), annotate.RULES), fn.words)
    kinds = lambda f: F.filter(F.array(F.substring_index(F.try_element_at(f, F.lit("hhtype")), " ", 1)), lambda x: x.isNotNull())
    languages = lambda f: F.filter(F.array(F.try_element_at(f, F.lit("lgcode"))), lambda x: x.isNotNull())
    return annotate.conservative(marked, records.where(F.map_contains_key("fields", F.lit("hhtype"))), languages, kinds, types, "hhtype")


@query(f"WITH {_MARKED} SELECT key, CASE WHEN key NOT IN (SELECT key FROM seen) THEN value END AS hhtype FROM after")
def mark_conservative(spark: SparkSession, folder: str) -> DataFrame:
    """Types by words, but none that raises a source over the status of its reference records."""
    return _conservative(spark, folder)[0].select("key", F.try_element_at("fields", F.lit("hhtype")).alias("hhtype"))


@query(f"WITH {_MARKED} SELECT language, 'wordlist' AS before, 'grammar' AS after, value, key FROM seen")
def mark_conservative_log(spark: SparkSession, folder: str) -> DataFrame:
    """The marks that were taken back, with the status before and after."""
    return _conservative(spark, folder)[1]


_PEOPLE = """people AS (SELECT p_partkey AS key, p_partkey % 6 AS k, split_part(p_name, ' ', 1) AS one, split_part(p_name, ' ', 2) AS two, p_size, p_type, p_name, p_brand FROM part)"""
_CAP = "upper(left({0}, 1)) || substr({0}, 2)"
_AUTHOR = f"""CASE WHEN k = 0 THEN {_CAP.format('one')} || ', Ann B. and Bo van der ' || {_CAP.format('two')} WHEN k = 1 THEN '{{' || p_brand || '}}' WHEN k = 2 THEN 'Jo ' || {_CAP.format('two')} WHEN k IN (3, 4) THEN NULL
  ELSE {_CAP.format('two')} || ', C. and ' || {_CAP.format('one')} || ', D.' END"""
_NAMES = f"""CASE WHEN k = 0 THEN least({_CAP.format('one')}, {_CAP.format('two')}) || '-' || greatest({_CAP.format('one')}, {_CAP.format('two')}) WHEN k = 1 THEN p_brand WHEN k = 2 THEN {_CAP.format('two')} WHEN k = 3 THEN {_CAP.format('one')}
  WHEN k = 5 THEN least({_CAP.format('one')}, {_CAP.format('two')}) || '-' || greatest({_CAP.format('one')}, {_CAP.format('two')}) END"""


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as entries: lists of authors in several forms, editors, and neither."""
    p, k = table(spark, folder, "part"), F.col("p_partkey") % 6
    word = lambda i: F.split("p_name", " ")[i]
    cap = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), c.substr(F.lit(2), F.length(c)))
    author = F.when(k == 0, F.concat(cap(word(0)), F.lit(", Ann B. and Bo van der "), cap(word(1)))).when(k == 1, F.concat(F.lit("{"), "p_brand", F.lit("}")))
    author = author.when(k == 2, F.concat(F.lit("Jo "), cap(word(1)))).when(k == 5, F.concat(cap(word(1)), F.lit(", C. and "), cap(word(0)), F.lit(", D.")))
    return p.select(
        F.col("p_partkey").alias("key"), author.alias("author"), F.when(k == 3, F.concat(F.lit("Li "), cap(word(0)))).alias("editor"), F.lower("p_type").alias("title"), "p_size",
        (1900 + F.col("p_size")).cast("string").alias("year"), F.when(F.col("p_partkey") % 2 == 0, F.lit("4")).alias("volume"), F.when(F.col("p_partkey") % 4 == 0, F.col("p_brand")).alias("journal"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("Grammar")).alias("extra_hash"),
    )


#: ``people`` and their match keys: hashed (key, hash).
HASH_SQL = f"""{_PEOPLE}, doc AS (SELECT *, {_sql_words('p_type')} AS ws FROM people), freq AS (SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM doc) GROUP BY word),
types AS (SELECT key, word, min(i) AS i FROM (SELECT key, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM doc) WHERE regexp_matches(word, '^[a-zA-Z].') GROUP BY ALL),
rare AS (SELECT key, word, i, row_number() OVER (PARTITION BY key ORDER BY n, i) AS r FROM types JOIN freq USING (word)),
two AS (SELECT key, string_agg(word, '-' ORDER BY i) AS rarest FROM rare WHERE r <= 2 GROUP BY ALL),
hashed AS (SELECT key, CASE WHEN k = 4 THEN '__missingcontrib__' || regexp_replace(lower(p_type || CASE WHEN key % 4 = 0 THEN p_brand ELSE '' END || CASE WHEN key % 2 = 0 THEN '4' ELSE '' END || (1900 + p_size)), '[^a-z0-9_\\-\\[\\]]', '_', 'g')
ELSE regexp_replace(lower({_NAMES} || '_' || coalesce(rarest, '') || CASE WHEN key % 2 = 0 AND key % 4 <> 0 THEN 'iv' ELSE '' END || (1900 + p_size) || CASE WHEN key % 7 = 0 THEN 'grammar' ELSE '' END), '[^a-z0-9_\\-\\[\\]]', '', 'g') END AS hash
FROM people LEFT JOIN two USING (key))"""


@query(f"WITH {HASH_SQL} SELECT key, hash FROM hashed")
def keyid_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Match keys of entries with lists of authors, editors or neither, volumes, journals and an extra part of the key."""
    return keyid.keyed(people(spark, folder), "key").select("key", "hash")


@query(f"""WITH {_PEOPLE} SELECT key, {_AUTHOR} AS text FROM people WHERE k = 1""")
def name_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of authors that the two name readers part differently: names in braces, which only one opens."""
    return compare.name_readings(people(spark, folder), ["key"], "author").select("key", "text")


@query(f"""WITH {_PEOPLE} SELECT key, {_NAMES} AS names FROM people WHERE k NOT IN (3, 4)""")
def author_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The last names of all authors, sorted and hyphen-joined."""
    return people(spark, folder).where("author is not null").select("key", keyid.author_key_of("author").alias("names"))
