"""Findings and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import has_hit, hits, json_string_content, looked_at
from ..functions.rules import ALL_VALUES, ValueRule


def rule_hits(df: DataFrame, text: str, rule: ValueRule, *keep: str) -> DataFrame:
    """One row per hit of a rule: the ``keep`` columns, hit (its place, from 0) and value."""
    return df.select(*keep, F.posexplode(hits(F.col(text), rule)).alias("hit", "value"))


def rule_counts(df: DataFrame, text: str, rules: tuple[ValueRule, ...] = ALL_VALUES, *keep: str) -> DataFrame:
    """One row per input row and rule with hits: the ``keep`` columns, seq (the rule's place), rule and n."""
    given, look = looked_at(df, text, *keep)
    sized = given.select(*keep, *[F.size(hits(F.col("_text"), r, look)).cast("long").alias(f"_n{i}") for i, r in enumerate(rules)])
    counts = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(r.name).alias("rule"), F.col(f"_n{i}").alias("n")) for i, r in enumerate(rules)])
    return sized.select(*keep, F.explode(F.filter(counts, lambda x: x["n"] > 0)).alias("f")).select(*keep, "f.*")


def count_by_rule(found: DataFrame, *by: str) -> DataFrame:
    """Hits and rows by rule and ``by``."""
    return found.groupBy("rule", *by).agg(F.sum("n").alias("hits"), F.count("*").alias("rows"))


def rule_values(df: DataFrame, text: str, rules: tuple[ValueRule, ...] = ALL_VALUES, *keep: str) -> DataFrame:
    """One row per hit: the ``keep`` columns, seq (the rule's place), rule and value."""
    given, look = looked_at(df, text, *keep)

    def named(place: int, rule: ValueRule) -> Column:
        return F.transform(hits(F.col("_text"), rule, look), lambda v: F.struct(F.lit(place).alias("seq"), F.lit(rule.name).alias("rule"), v.alias("value")))

    found = F.flatten(F.array(*[named(i, r) for i, r in enumerate(rules)]))
    return given.select(*keep, F.explode(found).alias("f")).select(*keep, "f.*")


def count_values(values: DataFrame, *by: str) -> DataFrame:
    """Hits and distinct values by rule and ``by``: as many tokens as values, since a token stands for one value. Values are pre-aggregated
    by rule and ``by`` before they are counted."""
    each = values.groupBy("rule", *by, "value").agg(F.count("*").alias("n"))
    return each.groupBy("rule", *by).agg(F.sum("n").alias("hits"), F.count("*").alias("n_tokens"))


def value_sketches(values: DataFrame, *by: str, bits: int = 14) -> DataFrame:
    """(rule, by..., sketch): HyperLogLog sketches of the values, of fixed size, that any later job can merge. They hold no plain text."""
    return values.groupBy("rule", *by).agg(F.hll_sketch_agg("value", bits).alias("sketch"))


def estimate_values(sketches: DataFrame, *by: str) -> DataFrame:
    """(rule, by..., n_tokens): sketches merged by rule and ``by``, and what they estimate."""
    return sketches.groupBy("rule", *by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_tokens"))


def rules_of_keys(keys: DataFrame, key: str, catalog: DataFrame) -> DataFrame:
    """By key: the first field rule that has it, if any, and how often it stands. The catalog is a table of fixed size."""
    own = catalog.filter("kind = 'field'").select(F.explode("keys").alias("_key"), "name", "place")
    counted = keys.groupBy(key).agg(F.count("*").alias("n"))
    return counted.join(F.broadcast(own), F.lower(F.col(key)) == F.col("_key"), "left").groupBy(key, "n").agg(F.min_by("name", "place").alias("rule")).select(key, "rule", "n")


def first_finding(found: DataFrame, key: str) -> DataFrame:
    """The first finding of each key in rule order."""
    return found.groupBy(key).agg(F.min_by(F.struct("rule", "n"), "seq").alias("f")).select(key, "f.rule", "f.n")


def block_reason(found: DataFrame, key: str, most: int = 8) -> DataFrame:
    """The first ``most`` findings of each key as one text, and how many more there are."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", "rule", "n")))
    said = lambda x: F.concat(x["rule"], F.lit(" (value) x"), x["n"].cast("string"))
    own = found.groupBy(key).agg(ordered.alias("all"))  # at most one row for each rule
    shown = F.array_join(F.transform(F.slice("all", 1, most), said), "; ")
    return own.select(key, F.concat(shown, F.when(F.size("all") > most, F.concat(F.lit("; ... and "), (F.size("all") - most).cast("string"), F.lit(" more"))).otherwise("")).alias("reason"))


def summarize(found: DataFrame, value: str, most: int = 8) -> DataFrame:
    """By rule: hits, the first ``most`` distinct values of a column in order, and how many others there are. Spark keeps no more
    than ``most`` rows of a rule in a task before they meet."""
    distinct = found.groupBy("rule", value).agg(F.sum("n").alias("n"))
    first = distinct.withColumn("rank", F.row_number().over(Window.partitionBy("rule").orderBy(value))).filter(F.col("rank") <= most)
    shown = first.groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list(F.col(value).cast("string"))), ",").alias("shown"))
    total = distinct.groupBy("rule").agg(F.sum("n").alias("hits"), F.greatest(F.count("*") - most, F.lit(0)).cast("long").alias("omitted"))
    return total.join(shown, "rule").select("rule", "hits", "shown", "omitted")


def report(found: DataFrame, most: int = 8) -> DataFrame:
    """A findings table (request_id, seq, rule, rule_type, path, field, fields, omitted_fields, excerpt) by rule and type: hits, the
    first ``most`` distinct paths, fields and excerpts in the order in which they were first seen, and how many more there are."""
    by = ["rule", "rule_type"]
    fields = F.concat(F.when(F.col("field").isNotNull(), F.array("field")).otherwise(F.array().cast("array<string>")), F.coalesce("fields", F.array().cast("array<string>")))
    out = found.groupBy(*by).agg(F.count("*").alias("hits"), F.sum("omitted_fields").alias("_more"))
    for name, values in (("paths", F.array("path")), ("fields", fields), ("excerpts", F.array("excerpt"))):
        seen = found.select(*by, "request_id", "seq", F.posexplode(values).alias("at", "v")).filter("v <> ''").groupBy(*by, "v").agg(F.min(F.struct("request_id", "seq", "at")).alias("first"))
        top = seen.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("first", "v"))).filter(F.col("rank") <= most)
        shown = top.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "v"))), lambda x: x["v"]).alias(name))
        rest = seen.groupBy(*by).agg(F.greatest(F.count("*") - most, F.lit(0)).cast("long").alias(f"omitted_{name}"))
        out = out.join(shown, by, "left").join(rest, by, "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>"))).withColumn(f"omitted_{name}", F.coalesce(f"omitted_{name}", F.lit(0).cast("long")))
    return out.withColumn("omitted_fields", F.col("omitted_fields") + F.coalesce("_more", F.lit(0))).drop("_more")


def request_reason(found: DataFrame, most: int = 8) -> DataFrame:
    """(request_id, reason): the first ``most`` findings of each request as one text: rule, type, path, field and excerpt."""
    quoted = lambda c: F.concat(F.lit('"'), json_string_content(c), F.lit('"'))
    shown = F.when(F.coalesce("excerpt", F.lit("")) != "", F.col("excerpt")).otherwise(F.coalesce("context", F.lit("")))
    said = F.concat("rule", F.lit(" ("), "rule_type", F.lit(") at "), "path", F.coalesce(F.concat(F.lit(" field "), quoted(F.col("field"))), F.lit("")), F.lit(": "), quoted(shown))
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("request_id").orderBy("seq"))).filter(F.col("rank") <= most)
    texts = first.groupBy("request_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", said.alias("s")))), lambda x: x["s"]), "; ").alias("shown"))
    total = found.groupBy("request_id").agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > most, F.concat(F.lit("; ... and "), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise("")
    return texts.join(total, "request_id").select("request_id", F.concat("shown", more).alias("reason"))


def read_only_summary(found: DataFrame, most: int = 8) -> DataFrame:
    """By request and path of what could only be read: how many rules matched, and the first ``most`` rules and field names."""
    own = found.filter("read_only").groupBy("request_id", "path").agg(F.array_sort(F.collect_list(F.struct("seq", "rule", "field"))).alias("all"))  # one for each rule
    first = lambda name: F.array_compact(F.transform(F.slice("all", 1, most), lambda x: x[name]))
    return own.select("request_id", "path", F.size("all").cast("long").alias("matched_rules"), first("rule").alias("rules"), first("field").alias("fields"))


def all_findings(matches: DataFrame, read_only: DataFrame) -> DataFrame:
    """Both kinds of findings in one table; of a request the read-only ones come last."""
    last = matches.groupBy("request_id").agg((F.max("seq") + 1).alias("_n"))
    moved = read_only.join(last, "request_id", "left").withColumn("seq", F.col("seq") + F.coalesce("_n", F.lit(0))).drop("_n")
    return matches.unionByName(moved)


def with_any_secret(df: DataFrame, text: str, *keep: str, rules: tuple[ValueRule, ...] = ALL_VALUES) -> DataFrame:
    """The ``keep`` columns, the text as ``_text`` and ``has_secret``; null has none."""
    given, look = looked_at(df, text, *keep)
    found = F.lit(False)
    for r in rules:
        found = found | has_hit(F.col("_text"), r, look)
    return given.select(*keep, "_text", F.coalesce(found, F.lit(False)).alias("has_secret"))


def any_secret(text: Column, rules: tuple[ValueRule, ...] = ALL_VALUES) -> Column:
    """Whether any rule hits; null has no secret."""
    out = F.lit(False)
    for r in rules:
        out = out | has_hit(text, r)
    return F.coalesce(out, F.lit(False))
