"""The sequential part of text redaction, for Arrow batches: rules run in order over what earlier rules left."""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable
from dataclasses import dataclass

from .columns import ID_CHECKS, ID_WEIGHTS, TOKEN
from .rules import ValueRule


MASK = "[REDACTED]"
#: Config names that one hit keeps.
MOST_FIELDS = 8


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
    return bool(digits) and total % 10 == 0


def china_id(number: str) -> bool:
    return len(number) == 18 and ID_CHECKS[sum(int(c) * w for c, w in zip(number, ID_WEIGHTS, strict=False)) % 11] == number[-1].upper()


VALIDATORS: dict[str | None, Callable[[str], bool]] = {"luhn": luhn, "china_id": china_id, None: lambda _: True}


@dataclass
class Hit:
    """One rule's finding in a text: the config names that it took values from, and the redacted text around its first token."""

    rule: str
    token: str
    fields: list[str]
    omitted: int = 0
    context: str = ""
    excerpt: str = ""


def field_name(name: str) -> str:
    """At most 80 characters, control characters as spaces."""
    return re.sub(r"[\x00-\x1F\x7F]", " ", name[:77] + "..." if len(name) > 80 else name)


def config_name(before: str) -> str:
    """The name in front of a config rule's value, or nothing."""
    m = re.fullmatch(r"\s*([A-Za-z0-9_.-]+)\s*[:=]\s*", before, re.ASCII)
    return field_name(m[1]) if m else ""


def excerpt_at(text: str, start: int, size: int, width: int = 160) -> str:
    """``width`` characters around a place, dots where it cuts included."""
    if len(text) <= width:
        return text
    inner = width - 6
    at = min(max(start - (inner - size) // 2, 0), len(text) - inner)
    if at == 0:
        return text[: width - 3] + "..."
    if at + inner == len(text):
        return "..." + text[len(text) - width + 3 :]
    return f"...{text[at : at + inner]}..."


class TextRedactor:
    """Redacts texts with an ordered list of rules and one key; remembers nothing between texts."""

    def __init__(self, rules: tuple[ValueRule, ...], key: bytes, label: str):
        self.rules = [(r.name, r.python, r.has_group, VALIDATORS[r.validator], r.literals, r.gate, r.is_config) for r in rules]
        self.key, self.label = key, label
        self.token = re.compile(TOKEN)

    def make(self, text: str) -> str:
        return f"<{self.label}_{hmac.new(self.key, text.encode('utf-8', 'replace'), hashlib.sha256).hexdigest()[:16]}>"

    def __call__(self, text: str, known: frozenset[str] | None = None) -> tuple[str, list[str], dict[str, str]]:
        """The text with tokens for secrets, the rules that fired, and token -> original. Tokens in ``known`` stay as they are."""
        out, hits, made = self.scan(text, known or frozenset(), False)
        return out, list(dict.fromkeys(h.rule for h in hits)), made

    def gaps(self, text: str, known: frozenset[str]) -> list[tuple[str, bool]]:
        """The text's parts, and whether each is a known token."""
        parts, last = [], 0
        for m in self.token.finditer(text) if known else ():
            if m[0] in known:
                parts += [(text[last : m.start()], False), (m[0], True)]
                last = m.end()
        return [*parts, (text[last:], False)]

    def scan(self, text: str, known: frozenset[str], shown: bool = True) -> tuple[str, list[Hit], dict[str, str]]:
        """The redacted text, a hit for each rule and part between known tokens, with excerpts if ``shown``, and token -> original."""
        out, hits, made = [], [], {}
        for part, fixed in self.gaps(text, known):
            if part and not fixed:
                part, own = self._part(part, made)
                for h in own if shown else ():
                    at = part.index(h.token)
                    h.context = excerpt_at(part, at, len(h.token))
                    before = self.token.sub(MASK, part[:at])
                    masked = re.sub(r"[\x00-\x1F\x7F-\x9F]", " ", before + MASK + self.token.sub(MASK, part[at + len(h.token) :]))
                    h.excerpt = excerpt_at(masked, len(before), len(MASK))
                hits += own
            out.append(part)
        return "".join(out), hits, made

    def _part(self, text: str, made: dict[str, str]) -> tuple[str, list[Hit]]:
        parts, hits, lowered, gates = [(text, False)], [], None, {}
        for name, find, grouped, valid, literals, gate, fold in self.rules:
            if literals is not None:
                if fold and lowered is None:
                    lowered = text.lower() if ":" in text or "=" in text else ""
                if not any(x in (lowered if fold else text) for x in literals):
                    continue
            if gate is not None:
                if gate not in gates:
                    gates[gate] = re.search(gate, text) is not None
                if not gates[gate]:
                    continue
            out: list[tuple[str, bool]] = []
            hit = None
            for part, fixed in parts:
                at = 0
                for m in () if fixed else find(part):
                    start, end = m.span(1) if grouped and m.start(1) >= 0 else m.span()
                    if m.start() > at:
                        out.append((part[at : m.start()], False))
                    at = m.end()
                    secret = part[start:end]
                    if not secret or not valid(secret):
                        out.append((m[0], False))
                        continue
                    token = self.make(secret)
                    hit = hit or Hit(name, token, [])
                    if fold and (field := config_name(part[m.start() : start])) and field not in hit.fields:
                        if len(hit.fields) < MOST_FIELDS:
                            hit.fields.append(field)
                        else:
                            hit.omitted += 1
                    made[token] = secret
                    out += [(part[m.start() : start], False), (token, True), (part[end : m.end()], False)]
                out.append((part[at:], fixed))
            parts = [p for p in out if p[0]]
            if hit:
                hits.append(hit)
        return "".join(p for p, _ in parts), hits

    def detect(self, text: str, known: frozenset[str]) -> list[tuple[str, str]]:
        """(rule, config name) of the first hit of each rule between known tokens; nothing is replaced."""
        out = []
        for name, find, grouped, valid, _, _, fold in self.rules:
            found = ((p, m) for p, fixed in self.gaps(text, known) if not fixed for m in find(p))
            spans = ((p, m, *(m.span(1) if grouped and m.start(1) >= 0 else m.span())) for p, m in found)
            first = next(((p, m, a) for p, m, a, b in spans if b > a and valid(p[a:b])), None)
            if first:
                p, m, a = first
                out.append((name, config_name(p[m.start() : a]) if fold else ""))
        return out
