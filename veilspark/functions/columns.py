"""Column functions: tokens, checks, excerpts and names, all built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import GATES, ValueRule

TOKEN = r"<[^<>\r\n]+_[0-9a-f]{16}>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Weights and check characters of the identity number.
ID_WEIGHTS = [7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2]
ID_CHECKS = "10X98765432"


def pads(key: bytes) -> tuple[bytes, bytes]:
    """The two padded keys of HMAC-SHA256."""
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def make_token(text: Column, key: bytes, label: str = "REDACTED") -> Column:
    """``<label_hex>`` with the first 16 digits of HMAC-SHA256(key, text); null for null."""
    inner, outer = pads(key)
    digest = F.sha2(F.concat(F.lit(inner), text.cast("binary")), 256)
    whole = F.sha2(F.concat(F.lit(outer), F.unhex(digest)), 256)
    return F.concat(F.lit(f"<{label}_"), F.substring(whole, 1, 16), F.lit(">"))


def tokens_in(text: Column) -> Column:
    """All token-shaped parts of a text."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def is_whole_token(text: Column) -> Column:
    return text.rlike(r"\A" + TOKEN + r"\z")


def canonical_tokens(text: Column) -> Column:
    """Escaped angle brackets around tokens as plain ones."""
    return F.regexp_replace(text, r"(?<!\\)\\u003[cC]([^<>\r\n\\]+_[0-9a-f]{16})\\u003[eE]", r"<$1>")


def json_characters(text: Column) -> Column:
    r"""JSON text with its ``\uXXXX`` escapes of printable ASCII as the characters themselves. An escaped backslash becomes a line feed, so
    that what follows it is no escape and nothing joins across it; all else stays."""
    parts = F.split(F.replace(text, F.lit("\\\\"), F.lit("\n")), r"\\u")
    one = lambda p: F.when(p.rlike(r"\A00[2-7][0-9a-fA-F]"), F.concat(F.char(F.conv(F.substring(p, 1, 4), 16, 10).cast("int")), F.substring(p, F.lit(5), F.length(p)))).otherwise(F.concat(F.lit("\\u"), p))
    return F.array_join(F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), one)), "")


def all_tokens(text: Column) -> Column:
    """Token-shaped parts as they stand, then those with characters escaped as JSON allows."""
    none = F.array().cast("array<string>")
    return F.concat(tokens_in(text), F.when(F.contains(text, F.lit("\\u00")), tokens_in(json_characters(text))).otherwise(none))


def token_tail(text: Column, label: str | None = None) -> Column:
    """Length of a trailing start of a token: of any with an open bracket and no closing one behind it, or of one of a label."""
    if label is None:
        return F.length(F.regexp_extract(text, r"<[^<>\r\n]*\z", 0))
    start = ""
    for atom in reversed(["<", *[f"[{c}]" for c in f"{label}_"], *["[0-9a-f]"] * 16]):
        start = f"(?:{atom}{start})?"
    return F.length(F.regexp_extract(text, start[3:-2] + r"\z", 0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def china_id(number: Column) -> Column:
    """18 characters with a MOD 11-2 check character, x or X."""
    total = sum((F.substring(number, i + 1, 1).try_cast("int") * w for i, w in enumerate(ID_WEIGHTS)), F.lit(0))
    check = F.substring(F.lit(ID_CHECKS), (total % 11 + 1).cast("int"), F.lit(1))
    return F.coalesce((F.length(number) == 18) & number.rlike(r"\A[0-9]{17}[0-9Xx]\z") & (check == F.upper(F.substring(number, 18, 1))), F.lit(False))


VALIDATORS = {"luhn": luhn, "china_id": china_id}


def looked_at(df: DataFrame, text: str, *keep: str) -> tuple[DataFrame, Looked]:
    """The ``keep`` columns and ``_text``, with what the cheap tests of rules need computed once for each row."""
    named = {gate: f"_gate{i}" for i, gate in enumerate(sorted(set(GATES.values())))}
    given = df.select(*keep, F.col(text).alias("_text"))
    assigned = F.contains("_text", F.lit(":")) | F.contains("_text", F.lit("="))
    given = given.select("*", F.when(assigned, F.lower("_text")).otherwise("").alias("_low"), *[F.col("_text").rlike(gate).alias(name) for gate, name in named.items()])
    return given, Looked(F.col("_low"), {gate: F.col(name) for gate, name in named.items()})


@dataclass
class Looked:
    """A text in lower case (empty where nothing is assigned in it), and whether each gate finds something."""

    lowered: Column
    gates: dict[str, Column]


def hits(text: Column, rule: ValueRule, given: Looked | None = None) -> Column:
    """The sensitive parts that a rule finds in a text, in order: group 1 where it took part, else the whole hit; empty ones and
    those that the validator refuses are left out. ``given`` is what ``looked_at`` has on the text."""
    found = F.regexp_extract_all(text, F.lit(rule.java), F.lit(1 if rule.has_group else 0))
    check = VALIDATORS.get(rule.validator or "")
    kept = F.filter(found, lambda x: (x != "") & check(x)) if check else F.array_remove(found, F.lit(""))
    may = _may_hit(text, rule, given)
    return kept if may is None else F.when(may, kept).otherwise(F.when(text.isNotNull(), F.array().cast("array<string>")))


def _may_hit(text: Column, rule: ValueRule, given: Looked | None) -> Column | None:
    """A cheap test that every text with a hit passes; null for rules without one."""
    if rule.literals:
        where = (F.lower(text) if given is None else given.lowered) if rule.is_config else text
        may = reduce(Column.__or__, [F.contains(where, F.lit(x)) for x in rule.literals])
        return (F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))) & may if rule.is_config else may
    if rule.gate:
        return text.rlike(rule.gate) if given is None else given.gates[rule.gate]
    return None


def has_hit(text: Column, rule: ValueRule, given: Looked | None = None) -> Column:
    """Whether a rule finds anything; the catalog's patterns have no empty hits, so one search is enough where none can be refused."""
    if rule.validator or not rule.built_in:
        return F.size(hits(text, rule, given)) > 0
    may = _may_hit(text, rule, given)
    found = text.rlike(rule.java)
    return found if may is None else may & found


def clean(text: Column) -> Column:
    """Control characters as spaces."""
    return F.regexp_replace(text, r"[\x00-\x1F\x7F-\x9F]", " ")


def field_name(name: Column) -> Column:
    """At most 80 characters, control characters as spaces."""
    shown = clean(name)
    return F.when(F.length(shown) > 80, F.concat(F.substring(shown, 1, 77), F.lit("..."))).otherwise(shown)


def excerpt(text: Column, focus: Column, width: int = 160) -> Column:
    """At most ``width`` characters around the focus, with dots where it cuts; the focus and every token are masked."""
    mask = lambda x: F.regexp_replace(x, TOKEN, "[REDACTED]")
    at = F.instr(text, focus)
    before = mask(F.substring(text, F.lit(1), at - 1))
    masked = clean(F.concat(before, F.lit("[REDACTED]"), mask(F.substring(text, at + F.length(focus), F.length(text)))))
    n, inner = F.length(masked), width - 6
    start = F.least(F.greatest(F.length(before) - (inner - 10) // 2, F.lit(0)), n - inner)
    shown = (
        F.when(n <= width, masked).when(start == 0, F.concat(F.substring(masked, 1, width - 3), F.lit("...")))
        .when(start + inner == n, F.concat(F.lit("..."), F.right(masked, F.lit(width - 3)))).otherwise(F.concat(F.lit("..."), F.substring(masked, start + 1, F.lit(inner)), F.lit("...")))
    )
    return F.when(at > 0, shown).otherwise(F.lit(""))


def field_excerpt(name: Column) -> Column:
    return F.concat(F.lit('"'), name, F.lit('": "[REDACTED]"'))


def media_route(content_type: Column) -> Column:
    """json, sse, other, or unknown where there is no media type; parameters are cut off."""
    kind = F.lower(F.trim(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1))))
    return F.when(kind == "", "unknown").when((kind == "application/json") | kind.endswith("+json"), "json").when(kind == "text/event-stream", "sse").otherwise("other")


def looks_like_json(body: Column) -> Column:
    """Whether a body starts like a JSON value."""
    return body.rlike(r'\A[ \t\r\n]*(?:[{\["0-9-]|true|false|null|(?:t|tr|tru|f|fa|fal|fals|n|nu|nul)[ \t\r\n]*\z)')


def is_sse(body: Column) -> Column:
    """Whether a body has a ``data:`` field of an event stream."""
    return body.rlike(r"(?:\A|[\r\n])data:")


def config_key(before: Column) -> Column:
    """The name in front of a config value (``before`` is all of a hit up to its value); empty where it is no plain name."""
    return field_name(F.regexp_extract(before, r"\A\s*([A-Za-z0-9_.-]+)\s*[:=]\s*\z", 1))


def mask_path(steps: Column) -> Column:
    """A path from an array of steps: ``[i]`` stays, keys become ``.*``."""
    return F.array_join(F.transform(steps, lambda x: F.when(x.rlike(r"\A\[[0-9]+\]\z"), x).otherwise(".*")), "")


def json_string_content(text: Column) -> Column:
    """A text as it stands between the quotes of a JSON string."""
    said = F.to_json(F.struct(text.alias("a")))
    return F.when(text.isNotNull(), F.substring(said, F.lit(7), F.length(said) - 8))


def sse_split(body: Column) -> Column:
    """Array of struct(event, data): the events of a stream with any line ends, several data lines joined by line feeds."""
    lines = F.split(body, r"\r\n\r\n|\n\n|\r\r")
    field = lambda e, name: F.regexp_extract_all(e, F.lit(rf"(?:\A|[\r\n]){name}: ?([^\r\n]*)"), F.lit(1))
    own = F.transform(lines, lambda e: F.struct(F.coalesce(F.get(field(e, "event"), F.lit(0)), F.lit("")).alias("event"), F.array_join(field(e, "data"), "\n").alias("data")))
    return F.filter(own, lambda e: (e["event"] != "") | (e["data"] != ""))
