"""Macro statements of one program, read once in text order.

A reference sees the latest definition above it, whether the program's own, one
that an include above brought, or a parameter of the macro it stands in. Small
helper that tasks run on each file; which files and macros meet is decided by
the joins of ``operators.resolve``.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa

# Fixed value: the longest text a macro variable can hold.
LONGEST_VALUE = 65_534
_DEEPEST = 4000  # values within values that are followed at a use; beyond, the reference stays open

_EVENT = re.compile(
    r"%let\s+(?P<let>\w+)\s*=(?P<value>[^;]*);"
    r"|%macro\s+(?P<macro>\w+)\s*(?:\((?P<params>[^)]*)\))?[^;]*;(?P<body>.*?)%mend\b[^;]*;?"
    r"|%include\s+['\"](?P<path>[^'\"]+)['\"]"
    r"|%(?P<call>\w+)",
    re.IGNORECASE | re.DOTALL,
)
# One reference as written; ``&&ds&i`` is one, since its parts only count together.
_TOKEN = re.compile(r"(?:&&+\w+(?:&\w+)*|&\w+)\.?")
_RUN = re.compile(r"(&+)(\w*)(\.?)")
_OPEN = re.compile(r"&\w")
_OPEN_END = re.compile(r"&\w+\Z")
_PATH = re.compile(r"%include\s+['\"]([^'\"]+)['\"]", re.IGNORECASE)
# A text with none of these keeps every statement as written; nothing in it is defined or replaced.
CHANGING = "(?i)&|%let|%macro"
_CHANGING = re.compile(CHANGING)
# A text with none of these defines nothing: its includes are the ones written, in their order.
DEFINING = "(?i)%let|%macro"

ENTRY = "struct<name: string, value: string, origin: string>"
MACRO = "struct<name: string, params: string, body: string>"
GIVEN = f"file_path string, code string, included array<struct<site: int, entries: array<{ENTRY}>>>, macros array<{MACRO}>"
READ = (
    "file_path string, code string, text string, total int, open array<string>, sites array<struct<site: int, include_file: string, path: string>>, "
    f"entries array<{ENTRY}>, definitions array<struct<name: string, value: string>>"
)
SITES = "file_path string, sites array<struct<site: int, include_file: string, path: string>>"
HEADERS = "file_path string, name string, params string, body string"


@dataclass
class _Scope:
    """Names of a macro: values while it runs, names without a value where it is only defined."""

    values: dict[str, str] = field(default_factory=dict)
    masked: frozenset[str] = frozenset()
    runs: bool = False


def _name_of(token: str) -> str:
    """A reference as notes name it: lower-cased, without the first ``&`` and the closing dot."""
    return token.rstrip(".").lower()[1:]


def _arguments(text: str, at: int) -> tuple[list[str], int]:
    """Arguments of a call whose bracket opens at ``at``, and where they end; commas inside brackets and quotes belong to one."""
    parts, depth, quote, begin = [], 0, "", at + 1
    for i in range(at, len(text)):
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if not depth:
                return [*parts, text[begin:i]], i + 1
        elif c == "," and depth == 1:
            parts.append(text[begin:i])
            begin = i + 1
    return [], at


def _bound(params: str, given: list[str]) -> dict[str, str]:
    """Values of a macro's parameters: by name, then by position, then the default, else empty."""
    names, values = [], {}
    for p in filter(None, (p.strip() for p in params.split(","))):
        name, has_default, default = p.partition("=")
        names.append(name.strip().lower())
        values[names[-1]] = default.strip() if has_default else ""
    place = 0
    for g in given:
        name, named, value = g.partition("=")
        if named and name.strip().lower() in values:
            values[name.strip().lower()] = value.strip()
        elif place < len(names):
            values[names[place]] = g.strip()
            place += 1
    return values


class Program:
    """One reading of a program, with what its includes bring and the macros it may call."""

    def __init__(self, path: str, code: str, included: dict[int, list[dict]], macros: dict[str, tuple[str, str]]) -> None:
        self.path, self.included = path, included
        self.env: dict[str, str] = {}
        self.entries: dict[tuple[str, str], str] = {}
        self.macros = dict(macros)
        self.sites: list[dict] = []
        self.total, self.open, self.extra = 0, [], []
        self.pending: list[str] = []  # references inside definitions that nothing above settles
        self._known: dict[str, str | None] = {}  # values of names here, until the next definition
        self._depth = 0
        # Definitions still to come: a name without one above takes the first below.
        self.ahead: dict[str, deque[str]] = defaultdict(deque)
        site = 0
        for m in _EVENT.finditer(code):
            if m["let"]:
                self.ahead[m["let"].lower()].append(m["value"].strip())
            elif m["macro"]:
                self.macros[m["macro"].lower()] = (m["params"] or "", m["body"])
                site += len(_sites(m["body"]))
            elif m["path"]:
                for e in self._brought(site):
                    self.ahead[e["name"]].append(e["value"])
                site += 1
        self.text = "\n".join([self._read(code, None, ()), *self.extra])
        # A definition is settled at its use: what its references stand for shows at the end.
        self._known = {}
        for token in self.pending:
            if _OPEN.search(self._expand(token, None, False, self._known)):
                self.open.append(_name_of(token))

    def _brought(self, site: int) -> list[dict]:
        """Definitions of an include, without those that come back to the program itself."""
        return [e for e in self.included.get(site, ()) if e["origin"] != self.path]

    # -- references -------------------------------------------------------------

    def _value(self, name: str, scope: _Scope | None, ahead: bool, known: dict[str, str | None]) -> str | None:
        if name in known:
            return known[name]
        known[name] = None  # open while its own value is looked up: circles end here
        if scope and name in scope.masked:
            return None
        value = scope.values.get(name) if scope else None
        value = self.env.get(name) if value is None else value
        if value is None and ahead and self.ahead[name]:
            value = self.ahead[name][0]
        if value is not None and "&" in value:
            self._depth += 1
            value = self._expand(value, scope, ahead, known) if self._depth < _DEEPEST else None
            self._depth -= 1
        known[name] = value if value is None or len(value) <= LONGEST_VALUE else None
        return known[name]

    def _expand(self, text: str, scope: _Scope | None, ahead: bool, known: dict[str, str | None] | None = None) -> str:
        """References replaced, ``&&`` halved; scanned as often as the longest run of ``&`` can need."""
        known = {} if known is None else known
        runs = [len(m[1]) for m in _RUN.finditer(text)]
        for _ in range(max(runs, default=0)):
            out, last = [], 0
            for m in _RUN.finditer(text):
                run, name = len(m[1]), m[2].lower()
                value = self._value(name, scope, ahead, known) if name and run % 2 else None
                if value is not None:
                    # A value that ends in an open reference is closed, so that what follows stays apart.
                    new = "&" * (run // 2) + value + ("." if _OPEN_END.search(value) else "")
                elif name:
                    new = "&" * -(-run // 2) + m[2] + m[3]
                else:
                    new = m[0]
                out += [text[last : m.start()], new]
                last = m.end()
            text = "".join([*out, text[last:]])
            if "&" not in text:
                break
        return text

    def _fill(self, text: str, scope: _Scope | None) -> str:
        """Text with its references replaced; each counts, and those that stay open are noted."""
        if "&" not in text:
            return text
        out, last, known = [], 0, self._known if scope is None else {}
        for m in _TOKEN.finditer(text):
            name = m[0].strip("&.").lower()
            new = m[0]
            if not (scope and name in scope.masked):
                new = self._expand(m[0], scope, True, known)
                self.total += 1
                if _OPEN.search(new):
                    self.open.append(_name_of(m[0]))
            out += [text[last : m.start()], new]
            last = m.end()
        return "".join([*out, text[last:]])

    # -- statements -------------------------------------------------------------

    def _read(self, text: str, scope: _Scope | None, chain: tuple[str, ...]) -> str:
        out, at = [], 0
        while m := _EVENT.search(text, at):
            out.append(self._fill(text[at : m.start()], scope))
            at = m.end()
            if m["let"]:
                out += [text[m.start() : m.start("value")], self._let(m["let"].lower(), m["value"].strip(), scope), ";"]
            elif m["path"]:
                out.append(text[m.start() : m.start("path")] + self._include(m["path"], scope) + text[m.end("path") : at])
            elif m["macro"]:
                name, params = m["macro"].lower(), m["params"] or ""
                self.macros[name] = (params, m["body"])
                body = self._read(m["body"], _Scope(masked=frozenset(_bound(params, []))), chain)
                out += [text[m.start() : m.start("body")], body, text[m.end("body") : at]]
            else:
                done, at = self._call(text, m, scope, chain)
                out.append(done)
        return "".join([*out, self._fill(text[at:], scope)])

    def _let(self, name: str, raw: str, scope: _Scope | None) -> str:
        if scope is None and self.ahead[name]:
            self.ahead[name].popleft()
        value = self._expand(raw, scope, False)
        if scope is None:
            tokens = [m[0] for m in _TOKEN.finditer(raw)]
            self.total += len(tokens)
            self.pending += [t for t in tokens if _OPEN.search(value)]
        shown = value if scope is None else self._fill(raw, scope)
        if scope is None or (scope.runs and name in self.env and name not in scope.values):
            self._define(name, value, self.path)
        else:
            scope.values[name] = value
        return shown

    def _define(self, name: str, value: str, origin: str) -> None:
        self.env[name] = value
        self._known = {}
        self.entries.pop((name, origin), None)  # the order is that of the last definition
        self.entries[name, origin] = value

    def _include(self, path: str, scope: _Scope | None) -> str:
        shown = self._fill(path, scope)
        if scope is not None and scope.runs:
            return shown  # the text of another program's macro; its includes are that program's
        if scope is None:
            for e in self._brought(len(self.sites)):
                self.ahead[e["name"]].popleft()
                self._define(e["name"], self._expand(e["value"], None, False), e["origin"])
        self.sites.append({"site": len(self.sites), "include_file": path, "path": shown})
        return shown

    def _call(self, text: str, m: re.Match, scope: _Scope | None, chain: tuple[str, ...]) -> tuple[str, int]:
        name, at = m["call"].lower(), m.end()
        if name not in self.macros or name in chain or (scope is not None and not scope.runs):
            return m[0], at
        rest = re.compile(r"\s*").match(text, at).end()
        given, end = _arguments(text, rest) if text[rest : rest + 1] == "(" else ([], at)
        given = [self._fill(g, scope) for g in given]
        params, body = self.macros[name]
        values = {**(scope.values if scope else {}), **_bound(params, given)}
        self.extra.append(self._read(body, _Scope(values, runs=True), (*chain, name)))
        return f"{m[0]}({','.join(given)})" if end > at else m[0], end


def _sites(text: str) -> list[str]:
    return [m["path"] for m in _EVENT.finditer(text) if m["path"]]


def definitions(code: str) -> dict[str, str]:
    """The program's own ``%let`` definitions as written, the last one of each name."""
    return {m["let"].lower(): m["value"].strip() for m in re.finditer(r"%let\s+(?P<let>\w+)\s*=(?P<value>[^;]*);", code, re.IGNORECASE)}


def _row(r: dict) -> dict:
    code = r["code"] or ""
    plain = not r["included"] and not r["macros"] and not _CHANGING.search(code)
    if plain:
        sites = [{"site": i, "include_file": path, "path": path} for i, path in enumerate(_PATH.findall(code))]
        return {"file_path": r["file_path"], "code": r["code"], "text": code, "total": 0, "open": [], "sites": sites, "entries": [], "definitions": []}
    included = {i["site"]: i["entries"] for i in r["included"] or ()}
    p = Program(r["file_path"], code, included, {m["name"]: (m["params"], m["body"]) for m in r["macros"] or ()})
    return {
        "file_path": r["file_path"], "code": r["code"], "text": p.text, "total": p.total, "open": p.open, "sites": p.sites,
        "entries": [{"name": n, "value": v, "origin": o} for (n, o), v in p.entries.items()],
        "definitions": [{"name": n, "value": v} for n, v in definitions(code).items()],
    }


def _read_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))  # chains of values that are settled at their use
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_row(r) for r in batch.to_pylist()], schema=schema)


def read_programs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``READ`` rows of ``GIVEN`` rows."""
    return _read_batches(batches, _SCHEMA)


def read_sites(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``SITES`` rows of ``GIVEN`` rows: the includes alone."""
    return _read_batches(batches, pa.schema([_SCHEMA.field(n) for n in ("file_path", "sites")]))


def macro_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``HEADERS`` rows of (file_path, code): the macros a program defines, the last one of each name."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            found = {m["macro"].lower(): m for m in _EVENT.finditer(r["code"] or "") if m["macro"]}
            rows += [{"file_path": r["file_path"], "name": n, "params": m["params"] or "", "body": m["body"]} for n, m in found.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, pa.string()) for n in ("file_path", "name", "params", "body")]))


_PAIR = [("name", pa.string()), ("value", pa.string())]
_SCHEMA = pa.schema([
    ("file_path", pa.string()), ("code", pa.string()), ("text", pa.string()), ("total", pa.int32()), ("open", pa.list_(pa.string())),
    ("sites", pa.list_(pa.struct([("site", pa.int32()), ("include_file", pa.string()), ("path", pa.string())]))),
    ("entries", pa.list_(pa.struct([*_PAIR, ("origin", pa.string())]))), ("definitions", pa.list_(pa.struct(_PAIR))),
])
