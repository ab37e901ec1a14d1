"""Redaction of texts, fields and typed tables, and blocking."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dialect
from ..functions.columns import has_hit, looked_at, make_token
from ..functions.rules import FieldRule, RuleSet, ValueRule
from ..functions.scan import TextRedactor

#: First characters of marked strings: value rules have to redact the rest, or it is done.
_HIT, _DONE = "h", "d"
RESULT = "struct<text:string,rules:array<string>,tokens:map<string,string>>"


def redact_text(text: Column, rules: tuple[ValueRule, ...], key: bytes, label: str = "REDACTED", known: Column | None = None) -> Column:
    """Struct of the redacted text, the rules that fired in order, and token -> original. Null stays null. ``known`` (an array of
    tokens that have a mapping) leaves those alone, so that a second pass changes nothing."""
    work = TextRedactor(rules, key, label)

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series, tokens: pd.Series) -> pd.DataFrame:
        done = [(None, None, None) if t is None else work(t, frozenset(k) if k is not None else None) for t, k in zip(texts, tokens, strict=True)]
        return pd.DataFrame(done, columns=["text", "rules", "tokens"])

    return run(text, F.lit(None).cast("array<string>") if known is None else known)


def redact_field(value: Column, key: bytes, label: str = "REDACTED", known: Column | None = None) -> Column:
    """The whole value as one token, unless it is one of ``known`` (an array of tokens that have a mapping). What only looks like a
    token is redacted."""
    token = make_token(value, key, label)
    return token if known is None else F.when(F.coalesce(F.array_contains(known, value), F.lit(False)), value).otherwise(token)


def field_rules_for(name: str, rules: tuple[FieldRule, ...]) -> list[FieldRule]:
    """All rules that have the name among their keys, in order."""
    return [r for r in rules if name.lower() in {k.lower() for k in r.keys}]


def _has_list(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType)) or isinstance(kind, T.StructType) and any(_has_list(f.dataType) for f in kind.fields)


def _unmark(a: pa.Array, work: TextRedactor) -> pa.Array:
    """The array with its strings, map keys apart, without their marks, redacted where they have a hit; the rest stays."""
    if pa.types.is_string(a.type):
        return pa.array([s if s is None else work(s[1:])[0] if s[0] == _HIT else s[1:] for s in a.to_pylist()], pa.string())
    if pa.types.is_struct(a.type):
        return pa.StructArray.from_arrays([_unmark(a.field(i), work) for i in range(a.type.num_fields)], fields=list(a.type), mask=a.is_null())
    if pa.types.is_map(a.type):
        entries = pa.StructArray.from_arrays([a.keys, _unmark(a.items, work)], fields=[a.type.key_field, a.type.item_field])
        return pa.Array.from_buffers(a.type, len(a), a.buffers()[:2], offset=a.offset, children=[entries])
    if pa.types.is_list(a.type):
        return pa.Array.from_buffers(a.type, len(a), a.buffers()[:2], offset=a.offset, children=[_unmark(a.values, work)])
    return a


def redact_columns(df: DataFrame, rules: RuleSet, key: bytes, label: str = "REDACTED", known: Column | None = None) -> DataFrame:
    """Field rules on the names of columns, struct fields and map keys, value rules on every other string, at any depth of
    structs, arrays and map values. Of the field rules that have a name the first whose pattern, if any, finds the value takes
    it. Values that aren't strings become tokens of their JSON text under a field rule without a pattern and stay elsewhere;
    such values of a map, whose type has no room for a token, become null. Map keys stay. Of token-shaped values under a field rule
only those in ``known`` (an array of tokens that have a mapping) stay.

    Python functions can't run inside functions of arrays and maps, so strings there are first marked with whether a value rule
    hits, and one Arrow pass over the column redacts the marked ones."""

    def walk(value: Column, kind: T.DataType, name: str | None, mark: bool) -> Column:
        own = field_rules_for(name, rules.fields) if name else []
        if isinstance(kind, T.StringType):
            return string(value, [(F.lit(True), r) for r in own], mark)
        if any(not r.pattern for r in own):
            nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
            token = make_token(F.to_json(value) if nested else value.cast("string"), key, label)
            return F.concat(F.lit(_DONE), token) if mark else token
        if isinstance(kind, T.StructType):
            return F.when(value.isNotNull(), F.struct(*[walk(value[f.name], f.dataType, f.name, mark).alias(f.name) for f in kind.fields]))
        if isinstance(kind, T.ArrayType):
            return F.transform(value, lambda x: walk(x, kind.elementType, None, mark))
        if isinstance(kind, T.MapType):
            return F.transform_values(value, lambda k, v: entry(k, v, kind, mark))
        return value

    def entry(k: Column, v: Column, kind: T.MapType, mark: bool) -> Column:
        fits = [(F.lower(k).isin(sorted({x.lower() for x in r.keys})), r) for r in rules.fields] if isinstance(kind.keyType, T.StringType) else []
        if isinstance(kind.valueType, T.StringType):
            return string(v, fits, mark)
        out = walk(v, kind.valueType, None, mark)
        for fit, r in fits:
            out = out if r.pattern else F.when(~fit, out)
        return out

    def string(value: Column, fits: list[tuple[Column, FieldRule]], mark: bool) -> Column:
        """The value under the first of the rules that fits and whose pattern finds it, else under value rules."""
        whole = redact_field(value, key, label, known)
        whole = F.concat(F.lit(_DONE), whole) if mark else whole
        out = plain(value, mark)
        for fit, r in reversed(fits):
            fit = fit & F.coalesce(value.rlike(dialect.java(r.pattern)), F.lit(False)) if r.pattern else fit
            out = F.when(fit, whole).otherwise(out)
        return out

    def plain(value: Column, mark: bool) -> Column:
        # Spark runs a Python function on all rows, whatever the branch: rows without a hit send it null.
        found = F.lit(False)
        for r in rules.values:
            found = found | F.coalesce(has_hit(value, r), F.lit(False))
        if mark:
            return F.concat(F.when(found, _HIT).otherwise(_DONE), value)
        return F.coalesce(redact_text(F.when(found, value), rules.values, key, label)["text"], value) if rules.values else value

    work = TextRedactor(rules.values, key, label)

    def unmark(column: Column, kind: T.DataType) -> Column:
        @F.arrow_udf(kind)
        def run(a: pa.Array) -> pa.Array:
            return _unmark(a, work)

        return run(column)

    inside = {f.name for f in df.schema.fields if _has_list(f.dataType) and all(r.pattern for r in field_rules_for(f.name, rules.fields))}
    done = df.select(*[walk(F.col(_quoted(f.name)), f.dataType, f.name, f.name in inside).alias(f.name) for f in df.schema.fields])
    if not inside:
        return done
    return done.select(*[unmark(F.col(_quoted(f.name)), f.dataType).alias(f.name) if f.name in inside else F.col(_quoted(f.name)) for f in done.schema.fields])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def blocked(df: DataFrame, text: str, rules: tuple[ValueRule, ...]) -> DataFrame:
    """Rows with any hit, with ``reason``: the first rule that hits. Built-in expressions only."""
    given, look = looked_at(df.withColumn("_row", F.struct(*df.columns)), text, "_row")
    first = F.lit(None).cast("string")
    for r in reversed(rules):
        first = F.when(has_hit(F.col("_text"), r, look), r.name).otherwise(first)
    return given.select("_row", first.alias("reason")).filter(F.col("reason").isNotNull()).select(*[F.col("_row")[c].alias(c) for c in df.columns if c != "reason"], "reason")
