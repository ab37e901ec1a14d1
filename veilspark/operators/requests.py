"""Chat requests as JSON: strict reading, content regions as rows, redaction of the regions alone, findings.

A body is one JSON object. Only the regions that hold conversation text are rewritten; every other key and value stays. A body
that isn't one object, whose regions have the wrong shape, or whose format is unknown is rejected with a path and a reason that
never quote content. So is one on which reading fails in any other way.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dialect
from ..functions.columns import all_tokens
from ..functions.regions import FORMATS, SHAPES, Listing, Malformed, See, is_text, read_json, read_request, write_json
from ..functions.rules import RuleSet
from ..functions.scan import TextRedactor, field_name

FINDING = "struct<rule:string,rule_type:string,path:string,field:string,fields:array<string>,omitted_fields:int,context:string,excerpt:string,read_only:boolean>"
RESULT = f"struct<body:string,rules:array<string>,tokens:map<string,string>,findings:array<{FINDING}>,error_path:string,error:string>"
REGION = "array<struct<path:string,kind:string,text:string>>"


def classify(source_format: Column) -> Column:
    return F.when(source_format.isin(FORMATS), "redact").otherwise("reject")


class _Stop(Exception):
    """Block mode has its first finding."""


class RequestRedactor(See):
    """Redacts the regions of one body at a time. With ``block`` it stops at the first finding and makes no tokens."""

    def __init__(self, rules: RuleSet, key: bytes, label: str, block: bool = False):
        self.redact, self.block = TextRedactor(rules.values, key, label), block
        self.keys: dict[str, list] = {}
        for r in rules.fields:
            for k in {k.lower() for k in r.keys}:
                self.keys.setdefault(k, []).append((r.name, re.compile(dialect.python(r.pattern)) if r.pattern else None))

    def __call__(self, source_format: str | None, body: str | None, known: frozenset[str] = frozenset()) -> tuple:
        self.known, self.findings, self.made = known, [], {}
        try:
            tree = read_request(source_format, body)
            try:
                SHAPES[source_format](tree, "", self)
            except _Stop:
                pass
        except Malformed as e:
            return None, None, None, None, e.path, e.detail
        except Exception:  # noqa: BLE001  whatever it is, the row is rejected and the others go on
            return None, None, None, None, "", "could not be scanned"
        fired = list(dict.fromkeys(f[0] for f in self.findings if not f[-1]))
        return (write_json(tree) if fired else body), fired, {} if self.block else self.made, self.findings, None, None

    def note(self, *finding) -> None:
        self.findings.append(finding)
        if self.block:
            raise _Stop

    def text(self, value: str, path: str) -> str:
        out, hits, made = self.redact.scan(value, self.known)
        self.made.update(made)
        for hit in hits:
            self.note(hit.rule, "value", path, None, hit.fields, hit.omitted, hit.context, hit.excerpt, False)
        return out

    def tree(self, value: object, path: str, name: str | None = None) -> object:
        """Field rules by key, value rules on other strings, at any depth. Keys are masked in paths."""
        plain = is_text(value)
        # A pattern can't be tried on a value that isn't a string.
        rule = next((r for r, p in self.keys.get((name or "").lower(), ()) if p is None or plain and p.search(value)), None)
        if rule is not None:
            said = value if plain else write_json(value)
            if plain and said in self.known:
                return said
            token = self.redact.make(said)
            self.made[token] = said
            self.note(rule, "field", path, field_name(name), None, 0, token, f'{write_json(field_name(name))}: "[REDACTED]"', False)
            return token
        if isinstance(value, dict):
            return {k: self.tree(v, f"{path}.*", k) for k, v in value.items()}
        if isinstance(value, list):
            return [self.tree(v, f"{path}[{i}]") for i, v in enumerate(value)]
        return self.text(value, path) if plain else value

    def strict(self, value: str, path: str) -> str:
        before = len(self.findings)
        walked = self.tree(read_json(value, path), path)
        return write_json(walked) if len(self.findings) > before else value

    def arguments(self, value: str, path: str) -> str:
        """JSON inside a string. Text that doesn't parse stays as it is; what value rules find there is read-only."""
        try:
            return self.strict(value, path)
        except Malformed:
            for rule, field in self.redact.detect(value, self.known):
                self.note(rule, "value", path, field or None, None, 0, "[redacted]", "", True)
            return value


def with_known(requests: DataFrame, vault: DataFrame | None) -> DataFrame:
    """``requests`` with ``known``: those tokens of each body that the vault (token) has; where requests have ``ts`` and mappings expire, still has
    then. Tokens are looked for as they stand and with escapes. Bodies don't take part in the joins but the last, which is by request_id."""
    if vault is None:
        return requests.withColumn("known", F.lit(None).cast("array<string>"))
    timed = "ts" in requests.columns and "expires_at" in vault.columns
    held = vault.groupBy("token").agg(F.max("expires_at").alias("_until")) if timed else vault.select("token").distinct()
    found = requests.select("request_id", *(["ts"] if timed else []), F.explode(F.array_distinct(all_tokens(F.col("body")))).alias("token"))
    found = found.join(held, "token").filter("ts <= _until") if timed else found.join(held, "token", "left_semi")
    return requests.join(found.groupBy("request_id").agg(F.collect_set("token").alias("known")), "request_id", "left")


def redact_requests(df: DataFrame, rules: RuleSet, key: bytes, label: str = "REDACTED", vault: DataFrame | None = None, mode: str = "filter") -> DataFrame:
    """``df`` (request_id, source_format, body, ...) with the struct ``result``: the body (as it came where nothing was found; null
    where it is rejected), the rules that fired, token -> original, the findings in order, and the error's path and reason.

    Tokens that ``vault`` has stay as they are; all else of a token's shape is plain text. Without a vault rows are worked on
    where they are. In block mode a row ends at its first finding, and no token is made."""
    return redact_known(with_known(df, vault), rules, key, label, mode).drop("known")


def redact_known(df: DataFrame, rules: RuleSet, key: bytes, label: str = "REDACTED", mode: str = "filter") -> DataFrame:
    """``redact_requests`` where the tokens to keep stand in the column ``known``."""
    work = RequestRedactor(rules, key, label, mode == "block")

    @F.pandas_udf(RESULT)
    def run(kinds: pd.Series, bodies: pd.Series, known: pd.Series) -> pd.DataFrame:
        done = [work(k, b, frozenset(t) if t is not None else frozenset()) for k, b, t in zip(kinds, bodies, known, strict=True)]
        return pd.DataFrame(done, columns=["body", "rules", "tokens", "findings", "error_path", "error"])

    return df.withColumn("result", run("source_format", "body", "known"))


def findings_of(done: DataFrame, *keep: str) -> DataFrame:
    """The findings table: request_id, the ``keep`` columns, seq, and the members of a finding, read-only ones included."""
    return done.select("request_id", *keep, F.posexplode("result.findings").alias("seq", "f")).select("request_id", *keep, "seq", "f.*")


def split_results(done: DataFrame, mode: str = "filter") -> tuple[DataFrame, DataFrame]:
    """(passed, rejected): in block mode any finding, read-only ones too, rejects a row."""
    bad = F.col("result.error").isNotNull()
    hit = F.coalesce(F.size("result.findings") > 0, F.lit(False)) if mode == "block" else F.lit(False)
    first = F.get("result.findings", F.lit(0))
    reason = F.coalesce("result.error", F.concat(F.lit("blocked by "), first["rule"]))
    return done.filter(~bad & ~hit), done.filter(bad | hit).select("request_id", "source_format", reason.alias("reason"), F.coalesce("result.error_path", first["path"]).alias("path"))


def regions(df: DataFrame) -> DataFrame:
    """(request_id, seq, path, kind, text): the regions of each accepted body, in order. Rejected bodies give none."""

    @F.pandas_udf(REGION)
    def run(kinds: pd.Series, bodies: pd.Series) -> pd.Series:
        def own(kind, body):
            see = Listing()
            try:
                SHAPES[kind](read_request(kind, body), "", see)
            except (Malformed, RecursionError):
                return []
            return see.found

        return pd.Series([own(k, b) for k, b in zip(kinds, bodies, strict=True)])

    return df.select("request_id", F.posexplode(run("source_format", "body")).alias("seq", "r")).select("request_id", "seq", "r.*")


def prompt_regions(df: DataFrame) -> DataFrame:
    """(request_id, path, text): the prompts of image and video requests, by built-in functions."""
    own = df.filter(F.col("source_format").isin("openai-image", "openai-video"))
    return own.select("request_id", F.lit("prompt").alias("path"), F.get_json_object("body", "$.prompt").alias("text")).filter("text is not null")


def redact_json(body: Column, rules: RuleSet, key: bytes, label: str = "REDACTED") -> Column:
    """Struct like a request's for any JSON text: field rules by key and value rules on all other strings, at any depth. Text that
    isn't one JSON value is an error."""
    work = RequestRedactor(rules, key, label)

    def one(text: str | None) -> tuple:
        work.known, work.findings, work.made = frozenset(), [], {}
        if text is None:
            return None, None, None, None, None, None
        try:
            walked = work.tree(read_json(text), "")
        except Malformed as e:
            return None, None, None, None, e.path, e.detail
        except Exception:  # noqa: BLE001
            return None, None, None, None, "", "could not be scanned"
        return (write_json(walked) if work.findings else text), list(dict.fromkeys(f[0] for f in work.findings)), work.made, work.findings, None, None

    @F.pandas_udf(RESULT)
    def run(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(b) for b in bodies], columns=["body", "rules", "tokens", "findings", "error_path", "error"])

    return run(body)


def json_error(text: Column) -> Column:
    """Why a text isn't one JSON value, without its content; null where it is one."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def own(t):
            try:
                read_json(t or "")
            except Malformed as e:
                return e.detail
            return None

        return pd.Series([own(t) for t in texts], dtype=object)

    return run(text)


def chat_requests(turns: DataFrame) -> DataFrame:
    """Chat bodies from a conversations table: one request per conversation, its turns in order."""
    message = F.struct("role", F.col("text").alias("content"))
    own = turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", message.alias("m")))), lambda x: x["m"]).alias("messages"))
    return own.select(F.col("conv_id").cast("string").alias("request_id"), F.lit("openai").alias("source_format"), F.to_json(F.struct(F.lit("m").alias("model"), "messages")).alias("body"))
