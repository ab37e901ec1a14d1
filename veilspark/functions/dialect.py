r"""Custom patterns in the dialect of a linear engine, written anew for Java and for Python.

Rules are written for an engine whose classes are ASCII, whose ``$`` is the very end, and which knows no look-around and no
back-references. Java's and Python's engines read the same text differently (``$`` before a last line feed, ``\s`` with ``\v``, Unicode
word borders in Java, its other line ends for ``.``, ASCII folding alone under ``(?i)``). So a pattern is parsed once; flags, classes and
borders are resolved; and what is written has only groups, repeats, alternatives, explicit classes and look-arounds of one character,
which both engines take in one way. What the dialect doesn't have is refused.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

TOP = 0x10FFFF
Ranges = list[tuple[int, int]]
_WORD: Ranges = [(48, 57), (65, 90), (95, 95), (97, 122)]
#: The classes behind a backslash and between colons.
_PERL = {"d": [(48, 57)], "s": [(9, 10), (12, 13), (32, 32)], "w": _WORD}
_POSIX = {
    "alnum": [(48, 57), (65, 90), (97, 122)], "alpha": [(65, 90), (97, 122)], "ascii": [(0, 127)], "blank": [(9, 9), (32, 32)], "cntrl": [(0, 31), (127, 127)], "digit": [(48, 57)], "graph": [(33, 126)],
    "lower": [(97, 122)], "print": [(32, 126)], "punct": [(33, 47), (58, 64), (91, 96), (123, 126)], "space": [(9, 13), (32, 32)], "upper": [(65, 90)], "word": _WORD, "xdigit": [(48, 57), (65, 70), (97, 102)],
}
_CONTROL = {"a": 7, "f": 12, "t": 9, "n": 10, "r": 13, "v": 11}
_MOST = 1000


def _merged(ranges: Ranges) -> Ranges:
    out: Ranges = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _without(ranges: Ranges) -> Ranges:
    """All other characters."""
    out, at = [], 0
    for lo, hi in _merged(ranges):
        if lo > at:
            out.append((at, lo - 1))
        at = hi + 1
    return out + [(at, TOP)] if at <= TOP else out


@lru_cache(maxsize=1)
def _folds() -> dict[int, tuple[int, ...]]:
    """Letter -> all letters that are one when case is ignored."""
    groups: dict[str, list[int]] = {}
    for code in range(TOP + 1):
        c = chr(code)
        if c.lower() != c or c.upper() != c:
            up = c.upper() if len(c.upper()) == 1 else c
            groups.setdefault(up.lower() if len(up.lower()) == 1 else up, []).append(code)
    for key in groups:
        if len(key) == 1 and ord(key) not in groups[key]:
            groups[key].append(ord(key))
    return {code: tuple(own) for own in groups.values() if len(own) > 1 for code in own}


def _folded(ranges: Ranges) -> Ranges:
    extra = [(x, x) for code, own in _folds().items() if any(lo <= code <= hi for lo, hi in ranges) for x in own]
    return _merged(ranges + extra)


@lru_cache(maxsize=64)
def _category(name: str) -> tuple[tuple[int, int], ...]:
    """Characters of a general category; other Unicode classes aren't known."""
    if name == "Any":
        return ((0, TOP),)
    found = [code for code in range(TOP + 1) if unicodedata.category(chr(code)).startswith(name)] if re.fullmatch(r"[CLMNPSZ][a-z]?", name) else []
    if not found:
        raise ValueError(f"no such class: {name}")
    return tuple(_merged([(x, x) for x in found]))


def _unquoted(pattern: str) -> str:
    r"""With what stands between \Q and \E as single characters."""
    return re.sub(r"\\Q(.*?)(?:\\E|\Z)|\\.", lambda m: m[0] if m[1] is None else "".join(f"\\x{{{ord(c):X}}}" for c in m[1]), pattern, flags=re.DOTALL)


class _Parser:
    """Reads a pattern and writes it with ``escape`` (a character's code -> text inside a class) and ``end`` (the very end)."""

    def __init__(self, pattern: str, escape: Callable[[int], str], end: str):
        self.s, self.at, self.escape, self.end, self.groups = _unquoted(pattern), 0, escape, end, 0

    def whole(self) -> str:
        out = self.alternatives(frozenset())
        if self.at < len(self.s):
            raise ValueError("a bracket closes what none has opened")
        return out

    def alternatives(self, flags: frozenset[str]) -> str:
        """Up to the closing bracket or the end. Flags set inside hold up to there."""
        parts = [""]
        while self.at < len(self.s) and self.s[self.at] != ")":
            if self.s[self.at] == "|":
                self.at += 1
                parts.append("")
            elif m := re.compile(r"\(\?([imsU]*)(?:-([imsU]+))?\)").match(self.s, self.at):
                self.at, flags = m.end(), flags.union(m[1]) - frozenset(m[2] or "")
            else:
                parts[-1] += self.repeated(flags)
        return "|".join(parts)

    def repeated(self, flags: frozenset[str]) -> str:
        c = self.s[self.at]
        if c in "*+?":
            raise ValueError("nothing to repeat")
        atom = self.atom(flags)
        m = re.compile(r"[*+?]|\{(\d+)(,(\d*))?\}").match(self.s, self.at)
        if not m:
            return atom
        if m[1] and max(int(m[1]), int(m[3] or 0)) > _MOST or m[3] and int(m[3]) < int(m[1]):
            raise ValueError("a repeat out of range")
        self.at = m.end()
        lazy = self.s[self.at : self.at + 1] == "?"
        self.at += lazy
        if re.compile(r"[*+?]|\{\d+(?:,\d*)?\}").match(self.s, self.at):
            raise ValueError("a repeat of a repeat")
        return f"(?:{atom}){m[0]}{'?' if lazy != ('U' in flags) else ''}"

    def atom(self, flags: frozenset[str]) -> str:
        c = self.s[self.at]
        self.at += 1
        if c == "(":
            return self.group(flags)
        if c == "[":
            return self.bracket(flags)
        if c == ".":
            return self.cls([(0, TOP)] if "s" in flags else _without([(10, 10)]))
        if c == "^":
            return r"(?:\A|(?<=\n))" if "m" in flags else r"\A"
        if c == "$":
            return f"(?=\\n|{self.end})" if "m" in flags else self.end
        if c == "\\":
            return self.escaped(flags)
        return self.char(ord(c), flags)

    def group(self, flags: frozenset[str]) -> str:
        lead = "("
        if self.s[self.at : self.at + 1] == "?":
            m = re.compile(r"\?(?:P?<([A-Za-z_]\w*)>|([imsU]*)(?:-([imsU]+))?:)").match(self.s, self.at)
            if not m:
                raise ValueError("a group that isn't in the dialect")
            self.at = m.end()
            if not m[1]:
                lead, flags = "(?:", flags.union(m[2]) - frozenset(m[3] or "")
        self.groups += lead == "("
        inner = self.alternatives(flags)
        if self.s[self.at : self.at + 1] != ")":
            raise ValueError("a bracket isn't closed")
        self.at += 1
        return f"{lead}{inner})"

    def escaped(self, flags: frozenset[str]) -> str:
        c = self.s[self.at : self.at + 1]
        if c in ("b", "B", "A", "z"):
            self.at += 1
            word = self.cls(_WORD)
            inside, edge = f"(?<={word})(?={word})|(?<!{word})(?!{word})", f"(?<={word})(?!{word})|(?<!{word})(?={word})"
            return {"b": f"(?:{edge})", "B": f"(?:{inside})", "A": r"\A", "z": self.end}[c]
        ranges = self.special()
        if ranges is not None:
            return self.cls(_folded(ranges) if "i" in flags and c in "pP" else ranges)
        return self.char(self.code(), flags)

    def special(self) -> Ranges | None:
        """The class behind a backslash, if there is one."""
        c = self.s[self.at : self.at + 1]
        if c.lower() in _PERL and c:
            self.at += 1
            return _PERL[c] if c.islower() else _without(_PERL[c.lower()])
        if c and c in "pP":
            m = re.compile(r"[pP](?:\{(\^?)(\w+)\}|(\w))").match(self.s, self.at)
            if not m:
                raise ValueError("a class isn't closed")
            self.at = m.end()
            own = list(_category(m[2] or m[3]))
            return _without(own) if (c == "P") != bool(m[1]) else own
        return None

    def code(self) -> int:
        """The character behind a backslash."""
        m = re.compile(r"x\{([0-9A-Fa-f]+)\}|x([0-9A-Fa-f]{2})|([1-7][0-7]{1,2}|0[0-7]{0,2})|([aftnrv])|([^\w\s]|[^\x00-\x7f])|(\s)").match(self.s, self.at)
        if not m:
            raise ValueError("an escape that isn't in the dialect")
        self.at = m.end()
        code = int(m[1] or m[2], 16) if m[1] or m[2] else int(m[3], 8) if m[3] else _CONTROL[m[4]] if m[4] else ord(m[5] or m[6])
        if code > TOP:
            raise ValueError("no such character")
        return code

    def bracket(self, flags: frozenset[str]) -> str:
        negated = self.s[self.at : self.at + 1] == "^"
        self.at += negated
        ranges: Ranges = []
        first = True
        while first or self.s[self.at : self.at + 1] != "]":
            first = False
            if self.at >= len(self.s):
                raise ValueError("a class isn't closed")
            if m := re.compile(r"\[:(\^?)(\w+):\]").match(self.s, self.at):
                if m[2] not in _POSIX:
                    raise ValueError("no such class")
                self.at = m.end()
                ranges += _without(_POSIX[m[2]]) if m[1] else _POSIX[m[2]]
                continue
            low = self.member()
            if isinstance(low, list):
                ranges += low
                continue
            if self.s[self.at : self.at + 1] == "-" and self.s[self.at + 1 : self.at + 2] not in ("]", ""):
                self.at += 1
                high = self.member()
                if isinstance(high, list) or high < low:
                    raise ValueError("a range runs backward")
                ranges.append((low, high))
            else:
                ranges.append((low, low))
        self.at += 1
        if "i" in flags:
            ranges = _folded(ranges)
        return self.cls(_without(ranges) if negated else ranges)

    def member(self) -> int | Ranges:
        """A character of a class, or a class inside it."""
        c = self.s[self.at]
        self.at += 1
        if c != "\\":
            return ord(c)
        own = self.special()
        return self.code() if own is None else own

    def char(self, code: int, flags: frozenset[str]) -> str:
        return self.cls([(x, x) for x in _folds().get(code, (code,))] if "i" in flags else [(code, code)])

    def cls(self, ranges: Ranges) -> str:
        ranges = _merged(ranges)
        if not ranges:
            return r"(?!)"
        if len(ranges) == 1 and ranges[0][0] == ranges[0][1] and chr(ranges[0][0]).isalnum() and ranges[0][0] < 128:
            return chr(ranges[0][0])
        return "[" + "".join(self.escape(lo) if lo == hi else f"{self.escape(lo)}-{self.escape(hi)}" for lo, hi in ranges) + "]"


def _java(code: int) -> str:
    return chr(code) if code < 128 and chr(code).isalnum() else f"\\x{{{code:X}}}"


def _python(code: int) -> str:
    return chr(code) if code < 128 and chr(code).isalnum() else f"\\U{code:08X}"


@lru_cache(maxsize=1024)
def java(pattern: str) -> str:
    return _Parser(pattern, _java, r"\z").whole()


@lru_cache(maxsize=1024)
def python(pattern: str) -> str:
    return _Parser(pattern, _python, r"\Z").whole()


def find(pattern: str) -> Callable[[str], Iterator[re.Match]]:
    """All hits in a text, as ``java``'s: the search goes on a character further behind an empty one."""
    search = re.compile(python(pattern)).search

    def hits(text: str) -> Iterator[re.Match]:
        at = 0
        while at <= len(text) and (m := search(text, at)):
            yield m
            at = m.end() + (m.end() == m.start())

    return hits


@lru_cache(maxsize=1024)
def groups(pattern: str) -> int:
    """How many groups a pattern has; ValueError where it isn't in the dialect."""
    parser = _Parser(pattern, _python, r"\Z")
    parser.whole()
    return parser.groups
