"""Chat templates given as text, compiled to one Column expression.

Tokenizers carry their own chat template.  The part of the template language
that such templates are made of is understood: loops over ``messages``,
conditions, ``loop.first`` / ``loop.last`` / ``loop.index0``, a message's
fields, string literals, joining by ``+`` or ``~``, comparisons, ``and`` /
``or`` / ``not``, ``| trim`` and ``raise_exception``.  The result is
Catalyst's own ``transform`` / ``when`` / ``concat``: no Python runs per row.
Anything else is an error when the template is compiled, never a different
text.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip

_TAGS = re.compile(r"(\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#.*?#\})", re.S)
_TOKENS = re.compile(r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|[-+~|.()\[\],]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}
Scope = dict[str, object]


class TemplateError(ValueError):
    """The template uses something that is not understood."""


def _pieces(template: str) -> list[tuple[str, str]]:
    """(kind, body) of the text and tags: white space at ``-``, the newline
    after a block tag and the blanks before one are dropped."""
    out, trim = [], False
    parts = _TAGS.split(template)
    for i, part in enumerate(parts):
        if i % 2 == 0:
            starts_line = i == 0 or trim == "line" and part.startswith("\n")
            if trim == "all":
                part = part.lstrip()
            elif trim == "line":
                part = part.removeprefix("\n")
            following = parts[i + 1] if i + 1 < len(parts) else ""
            if following.startswith(("{%-", "{{-")):
                part = part.rstrip()
            elif following.startswith(("{%", "{#")):
                part = re.sub(r"(\n|\A)[ \t]+\Z" if starts_line else r"(\n)[ \t]+\Z", r"\1", part)
            if part:
                out.append(("text", part))
            continue
        trim = "all" if part.endswith(("-%}", "-}}")) else "line" if part.startswith(("{%", "{#")) else False
        if not part.startswith("{#"):
            out.append(("block" if part.startswith("{%") else "value", part[2:-2].strip("-").strip()))
    return out


class _Expression:
    """Recursive descent over one tag's expression."""

    def __init__(self, source: str, scope: Scope):
        self.source, self.scope, self.at = source, scope, 0
        self.tokens, end = [], 0
        while source[end:].strip():
            m = _TOKENS.match(source, end)
            if not m:
                raise TemplateError(f"cannot read {source[end:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            end = m.end()

    def parse(self):
        out = self._either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source!r}")
        return out

    def _next(self, *marks: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in marks:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def _need(self, mark: str) -> None:
        if not self._next(mark):
            raise TemplateError(f"expected {mark!r} in {self.source!r}")

    def _either(self):
        out = self._both()
        while self._next("or"):
            out = _truth(out) | _truth(self._both())
        return out

    def _both(self):
        out = self._negated()
        while self._next("and"):
            out = _truth(out) & _truth(self._negated())
        return out

    def _negated(self):
        return ~_truth(self._negated()) if self._next("not") else self._compared()

    def _compared(self):
        left = self._joined()
        mark = self._next("==", "!=")
        if not mark:
            return left
        same = _value(left).eqNullSafe(_value(self._joined()))
        return same if mark == "==" else ~same

    def _joined(self):
        out = self._filtered()
        while self._next("+", "~"):
            out = _Str(F.concat(_text(out), _text(self._filtered())))
        return out

    def _filtered(self):
        out = self._atom()
        while True:
            if self._next("|"):
                if not self._next("trim"):
                    raise TemplateError(f"only the trim filter is known: {self.source!r}")
                out = _Str(strip(_text(out)))
            elif self._next("["):
                out = self._field(out, self._either())
                self._need("]")
            elif self._next("."):
                kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "name":
                    raise TemplateError(f"no field name in {self.source!r}")
                self.at += 1
                out = self._field(out, name)
            else:
                return out

    def _field(self, of, name):
        if isinstance(of, dict) and name in of:
            return of[name]
        if isinstance(of, _Messages) and isinstance(name, int):
            return _Message(F.get(of.column, F.lit(name)))
        if isinstance(of, _Message) and name in ("role", "content"):
            return _Str(of.column[name])
        raise TemplateError(f"no {name!r} in {self.source!r}")

    def _atom(self):
        if self._next("("):
            out = self._either()
            self._need(")")
            return out
        kind, word = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        self.at += 1
        if kind == "string":
            return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), word[1:-1], flags=re.S)
        if kind == "number":
            return int(word)
        if word in ("true", "True", "false", "False"):
            return word.lower() == "true"
        if word == "raise_exception":
            self._need("(")
            said = self._either()
            self._need(")")
            return _Str(F.raise_error(_text(said)).cast("string"))
        if kind == "name" and word in self.scope:
            return self.scope[word]
        raise TemplateError(f"unknown {word!r} in {self.source!r}")


class _Str:
    """A text; other columns are truth values or numbers."""

    def __init__(self, column: Column):
        self.column = column


class _Messages:
    def __init__(self, column: Column):
        self.column = column


class _Message:
    def __init__(self, column: Column):
        self.column = column


def _value(x) -> Column:
    if isinstance(x, (_Messages, _Message, dict)):
        raise TemplateError("a message or list is no text")
    return x.column if isinstance(x, _Str) else x if isinstance(x, Column) else F.lit(x)


def _text(x) -> Column:
    return F.coalesce(_value(x).cast("string"), F.lit(""))


def _truth(x) -> Column:
    """Truth of a value: a text is true unless empty."""
    if isinstance(x, (bool, int, str)):
        return F.lit(bool(x))
    if isinstance(x, _Messages):
        return F.size(x.column) > 0
    if isinstance(x, _Message):
        return x.column.isNotNull()
    return F.length(_text(x)) > 0 if isinstance(x, _Str) else x


def _block(pieces: list, at: int, scope: Scope, ends: tuple[str, ...]) -> tuple[list[Callable[[Scope], Column]], int]:
    """Renderers of the pieces up to a tag of ``ends``, and its place."""
    out: list[Callable[[Scope], Column]] = []
    while at < len(pieces):
        kind, body = pieces[at]
        word = body.split(None, 1)[0] if kind == "block" and body else ""
        if kind == "block" and word in ends:
            return out, at
        at += 1
        if kind == "text":
            out.append(lambda s, body=body: F.lit(body))
        elif kind == "value":
            out.append(lambda s, body=body: _text(_Expression(body, s).parse()))
        elif word == "for":
            m = re.fullmatch(r"for\s+(\w+)\s+in\s+messages", body)
            if not m:
                raise TemplateError(f"only loops over messages are known: {body!r}")
            inner, at = _block(pieces, at, scope, ("endfor",))
            out.append(_loop(m[1], inner))
            at += 1
        elif word == "if":
            branches, test, closing = [], body[2:], ""
            while closing != "endif":
                inner, at = _block(pieces, at, scope, ("elif", "else", "endif"))
                if at == len(pieces):
                    break
                branches.append((test, inner))
                closing = pieces[at][1].split(None, 1)[0]
                test = pieces[at][1][4:] if closing == "elif" else None
                at += 1
            out.append(_choice(branches))
        else:
            raise TemplateError(f"unknown tag {body!r}")
    if ends:
        raise TemplateError(f"missing {' or '.join(ends)}")
    return out, at


def _join(parts: list, scope: Scope) -> Column:
    return F.concat(F.lit(""), *[p(scope) for p in parts])


def _loop(name: str, inner: list) -> Callable[[Scope], Column]:
    def render(scope: Scope) -> Column:
        all_ = scope["messages"].column

        def one(m: Column, i: Column) -> Column:
            loop = {"first": i == 0, "last": i == F.size(all_) - 1, "index0": i, "index": i + 1}
            return _join(inner, scope | {name: _Message(m), "loop": loop})
        return F.array_join(F.transform(all_, one), "")
    return render


def _choice(branches: list) -> Callable[[Scope], Column]:
    def render(scope: Scope) -> Column:
        out, last = None, F.lit("")
        for test, inner in branches:
            body = _join(inner, scope)
            if test is None:
                last = body
                continue
            hit = F.coalesce(_truth(_Expression(test, scope).parse()), F.lit(False))
            out = F.when(hit, body) if out is None else out.when(hit, body)
        return out.otherwise(last)
    return render


def render_template(messages, template: str, generation_prompt: bool = False, bos_token: str = "", eos_token: str = "") -> Column:
    """Text of the chat ``messages`` (array of role and content) by a chat
    template.  Null fields count as empty text; null messages give null."""
    c = col(messages)
    scope: Scope = {"messages": _Messages(c), "add_generation_prompt": generation_prompt, "bos_token": bos_token, "eos_token": eos_token}
    parts, _ = _block(_pieces(template), 0, scope, ())
    return F.when(c.isNotNull(), _join(parts, scope))
