"""Annotation of records: rules over words, lookups, and labels by rank."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from stemma.joins import few
from stemma.lineage import cut
from stemma.operators.ranges import placed

#: Rules as rows: class, label, rank, rule, word, positive.
RULES = "class string, label string, rank int, rule string, word string, positive boolean"
#: Most terms of rules, and words of a dictionary, that are made part of a plan; more are joined.
RULE_TERMS = 20_000
_RULE = ["class", "label", "rank", "rule"]


def rule_text(terms: list[tuple[bool, str]]) -> str:
    """A conjunction in words, terms in order: ``a and not b``."""
    return " and ".join(word if positive else f"not {word}" for positive, word in sorted(terms, key=lambda x: (x[1], not x[0])))


def rule_rows(rules: dict[tuple[str, str, int], list[list[tuple[bool, str]]]]) -> list[tuple]:
    return [(c, label, rank, rule_text(terms), word, positive) for (c, label, rank), every in rules.items() for terms in every for positive, word in terms]


def rule_index(rules: DataFrame) -> DataFrame:
    """Each conjunction once, with the labels that it stands for."""
    return rules.groupBy("rule").agg(F.array_join(F.array_sort(F.collect_set("label")), ", ").alias("labels"))


def _among(words: str, dictionary: list[str]) -> Column:
    """The distinct words of an array that are in a small list, found before any row is made of them."""
    return F.array_intersect(F.col(words), F.array(*map(F.lit, dictionary)).cast("array<string>"))


def fired(records: DataFrame, key: str, words: str, rules: DataFrame) -> DataFrame:
    """The labels whose rules fire on a record's words (an array): key, class, label, rank, rule.

    A rule fires if all its positive words are there and no negative one; without positive words, on all records that have
    none of its words, also on records without words. Keys are unique. Rules of RULE_TERMS terms at most are a part of the
    plan, more are looked up by ``fired_by_index``.
    """
    terms = rules.limit(RULE_TERMS + 1).collect()
    return _fired(records, key, words, rules, terms) if len(terms) <= RULE_TERMS else fired_by_index(records, key, words, rules)


def fired_by_index(records: DataFrame, key: str, words: str, rules: DataFrame, lot: int = RULE_TERMS) -> DataFrame:
    """The same for any number of rules: each is found by the one of its positive words that the fewest records have.

    Only records with that word are held against the rule's other words, and a rule of one word is decided by it. Rules
    without positive words fire on nearly all records and are decided in the records' rows, in lots of about ``lot`` terms.
    """
    held = cut(records.select(key, F.array_distinct(F.coalesce(words, F.array().cast("array<string>"))).alias("ws")))
    each = held.select(key, F.explode("ws").alias("word"))
    whole = cut(rules.groupBy(*_RULE).agg(F.collect_set(F.when(F.col("positive"), F.col("word"))).alias("pos"), F.collect_set(F.when(~F.col("positive"), F.col("word"))).alias("neg")))
    asked = whole.where(F.size("pos") > 0).select(*_RULE, F.explode("pos").alias("word"), (F.size("pos") + F.size("neg") == 1).alias("alone"))
    # A positive word that no record has is rarer than all, and its rule meets nothing.
    known = each.join(asked.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    rare = F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), "word")).alias("word")
    index = asked.join(known, "word", "left").groupBy(*_RULE, "alone").agg(rare)
    met = each.join(index, "word")
    found = met.where("alone").select(key, *_RULE)
    open_ = met.where("not alone").select(key, *_RULE).join(whole, _RULE).join(held, key)
    found = found.unionByName(open_.where((F.size(F.array_intersect("pos", "ws")) == F.size("pos")) & ~F.arrays_overlap("neg", "ws")).select(key, *_RULE))
    waiting: list[tuple] = []
    for rule in whole.where(F.size("pos") == 0).toLocalIterator():
        waiting += [(rule["class"], rule.label, rule["rank"], rule.rule, word, False) for word in rule.neg]
        if len(waiting) >= lot:
            found, waiting = found.unionByName(_bare(held, key, waiting)), []
    return found.unionByName(_bare(held, key, waiting)) if waiting else found


def _bare(held: DataFrame, key: str, rows: list[tuple]) -> DataFrame:
    rules = held.sparkSession.createDataFrame(rows, RULES)
    return _fired(held, key, "ws", rules, rules.collect())


def _fired(records: DataFrame, key: str, words: str, rules: DataFrame, terms: list[Row]) -> DataFrame:
    """Only a record's words that rules have become rows; a rule without positive words is decided in the record's row."""
    every: dict[tuple, list] = {}
    for t in terms:
        every.setdefault((t["class"], t.label, t["rank"], t.rule), []).append(t)
    spark, names = records.sparkSession, ["class", "label", "rank", "rule"]
    needed = spark.createDataFrame([(*k, sum(t.positive for t in ts)) for k, ts in every.items()], "class string, label string, rank int, rule string, needed int")
    bare = {k: [t.word for t in ts] for k, ts in every.items() if not any(t.positive for t in ts)}
    held = records.select(key, F.coalesce(_among(words, sorted({t.word for t in terms})), F.array().cast("array<string>")).alias("ws"))
    cells = "struct<word:string,class:string,label:string,rank:int,rule:string>"
    own = F.transform("ws", lambda w: F.struct(w.alias("word"), *[F.lit(None).cast("int" if c == "rank" else "string").alias(c) for c in names]).cast(cells))
    for k, ws in bare.items():
        alone = F.struct(F.lit(None).cast("string").alias("word"), *[F.lit(v).alias(c) for c, v in zip(names, k)]).cast(cells)
        own = F.concat(own, F.when(F.arrays_overlap("ws", F.array(*map(F.lit, ws))), F.array().cast(f"array<{cells}>")).otherwise(F.array(alone)))
    each = held.select(key, F.explode(own).alias("x"))
    told = rules.select("word", "positive", *[F.col(c).alias(f"__{c}") for c in names])
    hits = each.select(key, "x.*").join(F.broadcast(told), "word", "left").select(key, "positive", *[F.coalesce(f"__{c}", c).alias(c) for c in names])
    found = hits.groupBy(key, *names).agg(F.count_if("positive").alias("n"), F.count_if(~F.col("positive")).alias("bad"))
    return found.join(F.broadcast(needed), names).where("bad = 0 and n = needed").select(key, *names)


def annotated(found: DataFrame, key: str) -> DataFrame:
    """One label for each record and class, the higher rank first, then the label, with a remark that names the rules."""
    one = found.groupBy(key, "class", "label", "rank").agg(F.array_join(F.array_sort(F.collect_set("rule")), ";").alias("rules"))
    best = one.groupBy(key, "class").agg(F.min_by(F.struct("label", "rules"), F.struct((-F.col("rank")).alias("r"), "label")).alias("x"))
    return best.select(key, "class", F.concat(F.col("x.label"), F.lit(' (computerized assignment from "'), F.col("x.rules"), F.lit('")')).alias("value"))


def looked_up(records: DataFrame, key: str, codes: str, areas: DataFrame, code: str, area: str) -> DataFrame:
    """The sorted areas of a record's codes, comma-joined; records without any are left out."""
    pairs = records.select(key, F.explode(codes).alias(code)).join(few(areas.where(F.col(area).isNotNull())), code)
    return pairs.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(area)), ", ").alias("areas"))


def unique_label(records: DataFrame, key: str, words: str, dictionary: DataFrame) -> DataFrame:
    """The label of a record's words, where all that have one have the same: key, label. Keys are unique.

    With a dictionary (word, label) of RULE_TERMS words at most, records are decided in their rows; a larger one is joined.
    """
    pairs = dictionary.limit(RULE_TERMS + 1).collect()
    if len(pairs) > RULE_TERMS:
        each = records.select(key, F.explode(F.array_distinct(words)).alias("word")).join(dictionary.select("word", "label").distinct(), "word")
        return each.groupBy(key).agg(F.min("label").alias("label"), F.max("label").alias("__other")).where("label = __other").select(key, "label")
    if not pairs:
        return records.select(key, F.lit(None).cast("string").alias("label")).limit(0)
    labels: dict[str, set] = {}
    for r in pairs:
        labels.setdefault(r.word, set()).add(r.label)
    named = F.create_map(*[x for w, found in sorted(labels.items()) for x in (F.lit(w), F.array(*map(F.lit, sorted(found))))])
    found = F.array_distinct(F.flatten(F.transform(_among(words, sorted(labels)), lambda w: F.element_at(named, w))))
    # Exploded, as a filter would work out the words a second time.
    alone = F.filter(F.array(found), lambda x: F.size(x) == 1)
    return records.select(key, F.explode(alone).alias("x")).select(key, F.get("x", F.lit(0)).alias("label"))


def ranks(names: DataFrame, column: str, rank: str) -> DataFrame:
    """Positions of a small dimension by its rank, then name: the highest rank has the largest number."""
    return names.withColumn("place", F.row_number().over(Window.orderBy(rank, column)))


def status(records: DataFrame, language: str, kind: str, types: DataFrame) -> DataFrame:
    """The highest type of each language: language, place, kind. Unranked types are skipped."""
    ranked = records.join(F.broadcast(types.select(kind, "place")), kind)
    return ranked.groupBy(language).agg(F.max("place").alias("place"), F.max_by(kind, "place").alias(kind))


def witnesses(records: DataFrame, language: str, kind: str, types: DataFrame) -> DataFrame:
    """The records that have the highest type of their language."""
    top = status(records, language, kind, types)
    return records.join(top.select(language, kind), [language, kind], "left_semi")


def guarded(before: DataFrame, after: DataFrame, language: str, kind: str, types: DataFrame) -> DataFrame:
    """Languages whose status rises over that of the reference records: language, before, after."""
    a = status(after, language, kind, types).select(language, F.col(kind).alias("after"), F.col("place").alias("__a"))
    b = status(before, language, kind, types).select(language, F.col(kind).alias("before"), F.col("place").alias("__b"))
    return a.join(b, language).where("__a > __b").select(language, "before", "after")


def reverted(annotations: DataFrame, blamed: DataFrame, language: str) -> DataFrame:
    """Annotations without those of languages whose status rose."""
    return annotations.join(blamed.select(language), language, "left_anti")


def best_material(records: DataFrame, by: list[str], pages: Column, year: Column, key: str) -> DataFrame:
    """The records of each group from most to fewest pages, then by latest year and key, with their place."""
    return placed(records, by, [pages.desc(), year.desc(), F.desc(key)])


def descriptive_material(records: DataFrame, types: DataFrame, unsorted: str | None = "!Unsorted") -> DataFrame:
    """The material of each language, best first: language, place, kind, rank, pages, year, key.

    ``records`` are (key, languages, kinds, pages, year), both arrays; ``types`` are (kind, place), the highest with the
    largest. A record's pages are divided by the number of its types, and it counts once for each; types without a rank
    are skipped. Records without languages belong to ``unsorted``, or go if that is null.
    """
    lost = F.array(F.lit(unsorted)) if unsorted is not None else F.array().cast("array<string>")
    languages = F.when(F.size(F.coalesce("languages", F.array().cast("array<string>"))) > 0, F.array_distinct("languages")).otherwise(lost)
    shared = F.coalesce(F.col("pages"), F.lit(0)) / F.size("kinds")
    each = records.where(F.size("kinds") > 0).select("key", "year", shared.alias("pages"), F.explode(languages).alias("language"), "kinds")
    ranked = each.withColumn("kind", F.explode(F.array_distinct("kinds"))).join(few(types.select("kind", F.col("place").alias("rank"))), "kind")
    out = placed(ranked.select("language", "kind", "rank", "pages", "year", "key"), ["language"], [F.desc("rank"), F.desc("pages"), F.desc("year"), F.desc("key")])
    return out.select("language", "place", "kind", "rank", "pages", "year", "key")


def marked(records: DataFrame, rules: DataFrame, words: Callable[[Column], Column]) -> DataFrame:
    """``records`` (key, fields) with the labels of the rules that fire on the title, in the fields named by the classes.

    Records that have a field for each class already stay as they are; of the others, all classes with a label get it.
    """
    classes = sorted(r["class"] for r in rules.select("class").distinct().collect())
    free = records.where(F.exists(F.array(*map(F.lit, classes)), lambda c: ~F.map_contains_key("fields", c))) if classes else records.limit(0)
    title = F.coalesce(F.try_element_at("fields", F.lit("title")), F.lit(""))
    found = annotated(fired(free.select("key", words(title).alias("ws")), "key", "ws", rules), "key")
    new = found.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("class", "value"))).alias("new"))
    kept = F.map_filter("fields", lambda k, _: ~F.map_contains_key("new", k))
    return records.join(new, "key", "left").withColumn("fields", F.when(F.col("new").isNull(), F.col("fields")).otherwise(F.map_concat(kept, "new"))).drop("new")


def conservative(marked_: DataFrame, reference: DataFrame, languages: Callable[[Column], Column], kinds: Callable[[Column], Column], types: DataFrame, blamed: str) -> tuple[DataFrame, DataFrame]:
    """Marked records (key, fields) without the ``blamed`` field where it would raise a language over its status in ``reference`` (key, fields).

    ``languages`` and ``kinds`` are the arrays of a record's fields. The second table logs the witnesses: language,
    before, after, value, key. Languages that the reference has no status for are left alone.
    """
    each = lambda df: df.select("key", F.explode(languages(F.col("fields"))).alias("language"), kinds(F.col("fields")).alias("ks")).select("key", "language", F.explode("ks").alias("kind"))
    after = each(marked_)
    risen = guarded(each(reference), after, "language", "kind", types)
    seen = after.join(risen.withColumn("kind", F.col("after")), ["language", "kind"]).select("key", "language", "before", "after").distinct()
    lost = seen.select("key").distinct().withColumn("lost", F.lit(True))
    out = marked_.join(lost, "key", "left").withColumn("fields", F.when(F.col("lost"), F.map_filter("fields", lambda k, _: k != blamed)).otherwise(F.col("fields"))).drop("lost")
    log = marked_.join(seen, "key").select("language", "before", "after", F.try_element_at("fields", F.lit(blamed)).alias("value"), "key")
    return out, log


def specificity(pairs: DataFrame, label: str, word: str, least: int = 9) -> DataFrame:
    """How much a word speaks for a label: (1 + f) / (1 - f + sum of f over labels), for f over ``least``."""
    counts = pairs.groupBy(label, word).agg(F.count("*").alias("f"))
    total = counts.groupBy(word).agg(F.sum("f").alias("total"))
    return counts.where(F.col("f") > least).join(total, word).select(label, word, "f", ((1 + F.col("f")) / (1 - F.col("f") + F.col("total"))).alias("specificity"))
