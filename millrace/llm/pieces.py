"""Texts as the pieces between single spaces, for byte-level tokenizers.

A byte-level tokenizer of this family splits a text by a pattern before it merges bytes. A
blank in front of a character that is no white space always begins a match, and what is in
front of it never looks further than that blank. So a text can be cut there, and every cut
part keeps its tokens wherever it occurs: tasks remember the ids of parts they have seen.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import regex

#: Parts of which a task remembers the ids at once, and the longest part that is kept.
REMEMBERED = 250_000
LONGEST = 64
_cut = re.compile(r"(?= \S)")


def parts(text: str) -> list[str]:
    """The text cut at every blank that a character other than white space follows.

    All parts but the first lack that blank, which belongs to them.
    """
    if "  " in text:
        first, *rest = _cut.split(text)
        return [first, *[p[1:] for p in rest]]
    # Without double blanks, blanks before other white space may be cut too, with equal matches.
    return text.split(" ")


class PartIds:
    """Ids of texts as little-endian unsigned 32-bit integers; remembers parts seen before."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode
        self.known: dict[str, bytes] = {}

    def _learn(self, part: str) -> bytes:
        found = self.encode(" " + part)
        if len(part) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[part] = found
        return found

    def of(self, text: str) -> bytes:
        first, *rest = parts(text)
        found = list(map(self.known.get, rest))
        if None in found:
            found = [self._learn(p) if f is None else f for p, f in zip(rest, found)]
        return self.encode(first) + b"".join(found)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def matches(pattern: str) -> Callable[[str], list[str]]:
    return regex.compile(pattern).findall
