"""JSON of any depth: the standard library's parser and writer, and ways without recursion where nesting is beyond these."""

from __future__ import annotations

import json
import re

_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"(-?(?:0|[1-9][0-9]*))(\.[0-9]+)?([eE][-+]?[0-9]+)?")
_WORDS = (("true", True), ("false", False), ("null", None))


def _no_constant(name: str):
    raise ValueError(f"{name} is no JSON")


def loads(text: str) -> object:
    """The value of a JSON text; ValueError if it is none. NaN and infinities are none."""
    try:
        return json.loads(text, parse_constant=_no_constant)
    except RecursionError:
        return _loads_flat(text)


def _loads_flat(text: str) -> object:
    """As ``json.loads``, the open containers on a list instead of the call stack."""
    n, space, number, string = len(text), _SPACE.match, _NUMBER.match, json.decoder.scanstring
    opened: list[tuple[object, str | None]] = []  # a container and the key it stands under in the one before
    box: object = None
    key: str | None = None
    at = space(text, 0).end()

    def fail():
        raise ValueError(f"no JSON at {at}")

    def member(at: int) -> tuple[str, int]:
        """Key and place of the value after it."""
        if text[at : at + 1] != '"':
            raise ValueError(f"no JSON at {at}")
        k, at = string(text, at + 1, True)
        at = space(text, at).end()
        if text[at : at + 1] != ":":
            raise ValueError(f"no JSON at {at}")
        return k, space(text, at + 1).end()

    while True:
        c = text[at : at + 1]
        value: object
        if c == "{" or c == "[":
            opened.append((box, key))
            box, key = ({} if c == "{" else []), None
            at = space(text, at + 1).end()
            if text[at : at + 1] != ("}" if c == "{" else "]"):
                if c == "{":
                    key, at = member(at)
                continue
            value = None
            closing = True
        else:
            closing = False
            if c == '"':
                value, at = string(text, at + 1, True)
            elif m := number(text, at):
                whole, fraction, exponent = m.groups()
                value = float(m.group()) if fraction or exponent else int(whole)
                at = m.end()
            else:
                for word, value in _WORDS:
                    if text.startswith(word, at):
                        at += len(word)
                        break
                else:
                    fail()
        while True:
            if closing:
                value, (box, key) = box, opened.pop()
                at += 1
            if not opened:
                at = space(text, at).end()
                if at != n:
                    fail()
                return value
            if isinstance(box, dict):
                box[key] = value
            else:
                box.append(value)
            at = space(text, at).end()
            c = text[at : at + 1]
            if c == ",":
                at = space(text, at + 1).end()
                if isinstance(box, dict):
                    key, at = member(at)
                break
            if c != ("}" if isinstance(box, dict) else "]"):
                fail()
            closing = True


def dumps(value: object) -> str:
    """Canonical JSON: keys sorted, no spaces, characters as they are."""
    try:
        return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    except RecursionError:
        pass
    out: list[str] = []
    todo: list[object] = [value]
    done = object()  # marks text that is ready to be put out
    while todo:
        x = todo.pop()
        if x is done:
            out.append(todo.pop())
        elif isinstance(x, dict) and x:
            rest: list[object] = []
            for i, k in enumerate(sorted(x)):
                rest += [("," if i else "{") + json.dumps(k, ensure_ascii=False) + ":", done, x[k]]
            todo += ["}", done, *_reversed(rest, done)]
        elif isinstance(x, list) and x:
            rest = []
            for i, e in enumerate(x):
                rest += ["," if i else "[", done, e]
            todo += ["]", done, *_reversed(rest, done)]
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return "".join(out)


def _reversed(triples: list, done: object) -> list:
    """Triples of text, mark and value, the first to be taken from the end first."""
    out: list = []
    for i in range(len(triples) - 3, -1, -3):
        out += [triples[i + 2], triples[i], done]
    return out
