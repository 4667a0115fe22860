"""Queries on merging and on the counts of fields and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.model import EAV_SQL, files_of, values_of
from stemma.operators import merge
from stemma.plans.registry import query

_RANKED = f"""WITH {EAV_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id, field ORDER BY priority DESC, filename, bibkey) AS rk
  FROM eav JOIN files USING (filename))"""


@query(f"{_RANKED} SELECT id, field, value FROM ranked WHERE rk = 1")
def priority_merge(spark: SparkSession, folder: str) -> DataFrame:
    return merge.first_values(merge.with_priority(values_of(spark, folder), files_of(spark)))


@query(f"""{_RANKED}, one AS (SELECT id, field, value, min(rk) AS rk FROM ranked WHERE field = 'isbn' GROUP BY ALL)
SELECT id, field, string_agg(value, ', ' ORDER BY rk) AS value FROM one GROUP BY id, field""")
def union_merge(spark: SparkSession, folder: str) -> DataFrame:
    values = values_of(spark, folder).where(F.col("field") == "isbn")
    return merge.joined_values(merge.with_priority(values, files_of(spark)))


@query(f"""WITH {EAV_SQL}, one AS (SELECT DISTINCT id, split_part(filename, '.bib', 1) AS s, bibkey FROM eav)
SELECT id, (SELECT string_agg(s, ', ' ORDER BY s) FROM (SELECT DISTINCT s FROM one b WHERE b.id = a.id)) AS src,
       string_agg(s || '#' || bibkey, ', ' ORDER BY s || '#' || bibkey) AS srctrickle FROM one a GROUP BY id""")
def provenance(spark: SparkSession, folder: str) -> DataFrame:
    return merge.provenance(values_of(spark, folder))


@query(f"""{_RANKED}, one AS (SELECT id, field, value, min(rk) AS rk FROM ranked GROUP BY ALL),
shown AS (SELECT id, field, CASE WHEN field = 'isbn' THEN string_agg(value, ', ' ORDER BY rk) ELSE first(value ORDER BY rk) END AS value FROM one GROUP BY id, field),
src AS (SELECT id, string_agg(DISTINCT split_part(filename, '.bib', 1), ', ' ORDER BY split_part(filename, '.bib', 1)) AS src,
        string_agg(DISTINCT split_part(filename, '.bib', 1) || '#' || bibkey, ', ' ORDER BY split_part(filename, '.bib', 1) || '#' || bibkey) AS srctrickle FROM eav GROUP BY id)
SELECT id, max(value) FILTER (field = 'ENTRYTYPE') AS entrytype, max(value) FILTER (field = 'title') AS title, max(value) FILTER (field = 'year') AS year,
       max(value) FILTER (field = 'publisher') AS publisher, max(value) FILTER (field = 'isbn') AS isbn, any_value(src) AS src, any_value(srctrickle) AS srctrickle
FROM shown JOIN src USING (id) GROUP BY id""")
def merged_records(spark: SparkSession, folder: str) -> DataFrame:
    out = merge.merged(values_of(spark, folder), files_of(spark))
    return out.select("id", "entrytype", *[F.try_element_at("fields", F.lit(x)).alias(x) for x in ("title", "year", "publisher", "isbn", "src", "srctrickle")])


@query(f"""{_RANKED}, f AS (SELECT * FROM ranked WHERE rk = 1)
SELECT r.id, r.field, f.filename AS file1, f.bibkey AS bibkey1, r.filename AS file2, r.bibkey AS bibkey2, f.value AS value1, r.value AS value2
FROM ranked r JOIN f ON r.id = f.id AND r.field = f.field WHERE r.rk > 1 AND lower(r.value) <> lower(f.value) AND r.field NOT IN ('fn', 'asjp_name', 'isbn')""")
def conflict_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return merge.conflicts(values_of(spark, folder), files_of(spark))


@query(f"""{_RANKED}, f AS (SELECT * FROM ranked WHERE rk = 1)
SELECT f.filename AS file1, r.filename AS file2, count(*) AS n FROM ranked r JOIN f ON r.id = f.id AND r.field = f.field
WHERE r.rk > 1 AND lower(r.value) <> lower(f.value) AND r.field NOT IN ('fn', 'asjp_name', 'isbn') AND f.filename <> r.filename GROUP BY ALL ORDER BY n, file1, file2""")
def conflict_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return merge.conflict_matrix(merge.conflicts(values_of(spark, folder), files_of(spark))).orderBy("n", "file1", "file2")


@query(f"""WITH {EAV_SQL}, e AS (SELECT DISTINCT filename, bibkey FROM eav)
SELECT filename, count(*) AS n, CAST((SELECT count(*) FROM e) AS BIGINT) AS total FROM e GROUP BY filename""")
def entry_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Entries by file and in all."""
    by_file = values_of(spark, folder).select("filename", "bibkey").distinct().groupBy("filename").agg(F.count("*").alias("n"))
    return by_file.crossJoin(F.broadcast(by_file.agg(F.sum("n").alias("total"))))


@query(f"WITH {EAV_SQL} SELECT field, count(*) AS n FROM eav GROUP BY field ORDER BY n DESC, field")
def field_stats(spark: SparkSession, folder: str) -> DataFrame:
    return values_of(spark, folder).groupBy("field").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "field")


@query(f"WITH {EAV_SQL} SELECT field, count(*) AS n, string_agg(DISTINCT replace(filename, '.bib', ''), ', ' ORDER BY replace(filename, '.bib', '')) AS files FROM eav GROUP BY field")
def field_stats_files(spark: SparkSession, folder: str) -> DataFrame:
    files = F.array_join(F.array_sort(F.collect_set(F.replace("filename", F.lit(".bib"), F.lit("")))), ", ")
    return values_of(spark, folder).groupBy("field").agg(F.count("*").alias("n"), files.alias("files"))


@query(f"WITH {EAV_SQL} SELECT field, count(*) AS n FROM eav GROUP BY field ORDER BY n DESC, field LIMIT 3")
def top_fields(spark: SparkSession, folder: str) -> DataFrame:
    return values_of(spark, folder).groupBy("field").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "field").limit(3)


@query(f"""WITH {EAV_SQL} SELECT filename, bibkey, max(value) FILTER (field = 'author') AS author, max(value) FILTER (field = 'editor') AS editor,
max(value) FILTER (field = 'year') AS year, max(value) FILTER (field = 'title') AS title FROM eav GROUP BY ALL""")
def key_fields(spark: SparkSession, folder: str) -> DataFrame:
    """author, editor, year and title of each entry."""
    names = ["author", "editor", "year", "title"]
    return values_of(spark, folder).groupBy("filename", "bibkey").agg(*[F.max(F.when(F.col("field") == x, F.col("value"))).alias(x) for x in names])


@query(f"""WITH {EAV_SQL}, e AS (SELECT filename, bibkey, list(field) AS fields FROM eav GROUP BY ALL)
SELECT filename, count(*) AS n, CAST(sum(list_contains(fields, 'publisher')::INT) AS BIGINT) AS with_publisher, CAST(sum((NOT list_contains(fields, 'publisher'))::INT) AS BIGINT) AS without_publisher FROM e GROUP BY filename""")
def field_presence(spark: SparkSession, folder: str) -> DataFrame:
    from stemma.model import wide_form

    has = F.map_contains_key("fields", "publisher")
    return wide_form(values_of(spark, folder)).groupBy("filename").agg(F.count("*").alias("n"), F.count_if(has).alias("with_publisher"), F.count_if(~has).alias("without_publisher"))
