"""Job files as dictionaries: the relaxed JSON notation of configuration files, JSON itself, and SQL job files.

A section such as `source` may name one plugin several times, so an object
also keeps its entries in the order they were written.  Dotted keys stay one
key (`row.num`), which is how options are looked up.
"""

from __future__ import annotations

import os
import re

_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?")
_WORDS = {"true": True, "false": False, "null": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}


class ConfigError(ValueError):
    """A job file that cannot be read."""


class Entries(dict):
    """An object: a dict, where later entries win and objects merge, and `pairs` as written."""

    def __init__(self):
        super().__init__()
        self.pairs: list[tuple[str, object]] = []

    def put(self, key: str, value, append: bool = False) -> None:
        self.pairs.append((key, value))
        old = self.get(key)
        if append:
            value = [*(old or []), value]
        elif isinstance(old, Entries) and isinstance(value, Entries):
            merged = Entries()
            for k, v in [*old.pairs, *value.pairs]:
                merged.put(k, v)
            value = merged
        self[key] = value


def substitute(text: str, variables: dict[str, str] | None = None) -> str:
    """${name}, ${name:default} and ${name:} from the variables, then the environment; others stay as they are."""
    known = {**os.environ, **(variables or {})}

    def one(m: re.Match) -> str:
        if m[1] in known:
            return str(known[m[1]])
        return m[0] if m[2] is None else m[2].strip('"')

    return re.sub(r"\$\{([\w.]+)(?::([^}]*))?\}", one, text)


class _Reader:
    def __init__(self, text: str):
        self.text, self.at = text, 0

    def fail(self, what: str):
        raise ConfigError(f"{what} in line {self.text.count(chr(10), 0, self.at) + 1}")

    def skip(self, extra: str = "") -> None:
        """Blanks, comments, and the separators given."""
        while self.at < len(self.text):
            c = self.text[self.at]
            if c == "#" or self.text.startswith("//", self.at):
                end = self.text.find("\n", self.at)
                self.at = len(self.text) if end < 0 else end
            elif c.isspace() or c in extra:
                self.at += 1
            else:
                return

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def quoted(self) -> str:
        if self.text.startswith('"""', self.at):
            end = self.text.find('"""', self.at + 3)
            if end < 0:
                self.fail("open string")
            out, self.at = self.text[self.at + 3 : end], end + 3
            return out
        out, self.at = [], self.at + 1
        while (c := self.peek()) != '"':
            if not c:
                self.fail("open string")
            if c == "\\":
                self.at += 1
                c = self.peek()
                if c == "u":
                    c, self.at = chr(int(self.text[self.at + 1 : self.at + 5], 16)), self.at + 4
                else:
                    c = _ESCAPES.get(c, c)
            out.append(c)
            self.at += 1
        self.at += 1
        return "".join(out)

    def key(self) -> str:
        if self.peek() == '"':
            return self.quoted()
        m = re.compile(r"[^\s\"{}\[\]:=,+#]+").match(self.text, self.at)
        if not m:
            self.fail(f"no key at {self.peek()!r}")
        self.at = m.end()
        return m[0]

    def entries(self, closed: bool) -> Entries:
        out = Entries()
        while True:
            self.skip(",")
            if self.peek() == "}" and closed:
                self.at += 1
                return out
            if not self.peek():
                if closed:
                    self.fail("open object")
                return out
            name = self.key()
            self.skip()
            append = self.text.startswith("+=", self.at)
            if append:
                self.at += 2
            elif self.peek() and self.peek() in ":=":
                self.at += 1
            elif self.peek() != "{":
                self.fail(f"no value for {name}")
            self.skip()
            out.put(name, self.value(), append)

    def value(self):
        c = self.peek()
        if c == "{":
            self.at += 1
            return self.entries(True)
        if c == "[":
            self.at += 1
            out = []
            while True:
                self.skip(",")
                if self.peek() == "]":
                    self.at += 1
                    return out
                if not self.peek():
                    self.fail("open list")
                out.append(self.value())
        if c == '"':
            first = self.quoted()
            rest = self.bare()
            return first + rest if rest else first
        text = self.bare()
        if text.lower() in _WORDS and text == text.lower():
            return _WORDS[text]
        if _NUMBER.fullmatch(text):
            return float(text) if re.search(r"[.eE]", text) else int(text)
        return text

    def bare(self) -> str:
        """Text without quotes, up to the end of the entry; quoted parts within it lose their quotes."""
        out = []
        while (c := self.peek()) and c not in "\n,}]#" and not (self.text.startswith("//", self.at) and (not out or out[-1].isspace())):
            if self.text.startswith("${", self.at):
                end = self.text.find("}", self.at)
                if end < 0:
                    self.fail("open variable")
                out.append(self.text[self.at : end + 1])
                self.at = end + 1
            elif c == '"':
                out.append(self.quoted())
            else:
                out.append(c)
                self.at += 1
        return "".join(out).strip()


def parse(text: str, variables: dict[str, str] | None = None) -> Entries:
    """A job file in the relaxed notation, of which JSON is a part."""
    reader = _Reader(substitute(text, variables))
    reader.skip()
    braces = reader.peek() == "{"
    reader.at += braces
    out = reader.entries(braces)
    reader.skip()
    if reader.at < len(reader.text):
        reader.fail("text after the end")
    return out


def _value(text: str):
    reader = _Reader(text)
    reader.skip()
    return reader.value() if reader.peek() in ("{", "[") else text


def _statements(text: str) -> list[str]:
    """Split at semicolons outside quotes, without comments."""
    parts, now = [], []
    for m in re.finditer(r"'(?:[^']|'')*'|`[^`]*`|--[^\n]*|/\*.*?\*/|;|.", text, re.S):
        if m[0] == ";":
            parts.append("".join(now))
            now = []
        elif not m[0].startswith(("--", "/*")):
            now.append(m[0])
    return [p.strip() for p in [*parts, "".join(now)] if p.strip()]


def parse_sql_job(text: str, variables: dict[str, str] | None = None) -> Entries:
    """A job of CREATE TABLE … WITH, CREATE TABLE … AS SELECT and INSERT INTO … SELECT.

    Tables may be declared after their use.  An INSERT of a bare table name
    passes the whole dataset on; any other SELECT becomes a SQL transform.
    """
    text = substitute(text, variables)
    conf = Entries()
    for m in re.finditer(r"/\*\s*config\b(.*?)\*/", text, re.S):
        for k, v in parse(m[1]).pairs:
            conf.put(k, v)
    made: dict[str, Entries] = {name: Entries() for name in ("source", "transform", "sink")}
    targets: dict[str, Entries] = {}
    inserts: list[tuple[str, str]] = []

    def select(query: str, output: str) -> None:
        source = re.search(r"(?is)\bfrom\s+`?([\w.]+)`?", re.sub(r"'(?:[^']|'')*'", lambda m: "x" * len(m[0]), query))
        if not source:
            raise ConfigError(f"no table in {query}")
        step = Entries()
        for k, v in (("plugin_input", source[1]), ("plugin_output", output), ("query", query)):
            step.put(k, v)
        made["transform"].put("Sql", step)

    for statement in _statements(text):
        if m := re.fullmatch(r"(?is)create\s+table\s+`?([\w.]+)`?\s+with\s*\((.*)\)", statement):
            options = Entries()
            for k, v in re.findall(r"'((?:[^']|'')+)'\s*=\s*'((?:[^']|'')*)'", m[2]):
                options.put(k.replace("''", "'"), _value(v.replace("''", "'")))
            kind, plugin = options.pop("type", None), options.pop("connector", None)
            if kind not in ("source", "sink") or not plugin:
                raise ConfigError(f"table {m[1]} needs a connector, and a type of source or sink")
            if kind == "source":
                options["plugin_output"] = m[1]
                made["source"].put(plugin, options)
            else:
                targets[m[1]] = options
                options["_plugin"] = plugin
        elif m := re.fullmatch(r"(?is)create\s+table\s+`?([\w.]+)`?\s+as\s+(select\b.*)", statement):
            select(m[2], m[1])
        elif m := re.fullmatch(r"(?is)insert\s+into\s+`?([\w.]+)`?\s+(select\b.*)", statement):
            inserts.append((m[1], m[2]))
        else:
            raise ConfigError(f"not a statement of a job: {statement[:80]}")
    for i, (target, query) in enumerate(inserts):
        if target not in targets:
            raise ConfigError(f"no sink table {target}")
        options = Entries()
        options.update({k: v for k, v in targets[target].items() if k != "_plugin"})
        whole = re.fullmatch(r"(?is)select\s+`?([\w.]+)`?", query)
        if whole:
            options["plugin_input"] = whole[1]
        else:
            options["plugin_input"] = f"{target}__{i}"
            select(query, options["plugin_input"])
        made["sink"].put(targets[target]["_plugin"], options)
    for name, section in made.items():
        conf.put(name, section)
    return conf


def steps(section) -> list[tuple[str, dict]]:
    """(plugin, options) in order, from an object by plugin names or a list with `plugin_name`."""
    if section is None:
        return []
    if isinstance(section, list):
        return [(s["plugin_name"], {k: v for k, v in s.items() if k != "plugin_name"}) for s in section]
    found = []
    for name, options in getattr(section, "pairs", None) or list(section.items()):
        found += [(name, dict(o)) for o in (options if isinstance(options, list) else [options])]
    return found


def load(path: str, variables: dict[str, str] | None = None) -> Entries:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return parse_sql_job(text, variables) if path.endswith(".sql") else parse(text, variables)
