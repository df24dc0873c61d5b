"""Cuts a text where a tokenizer's pre-tokenisation never looks across.

The pattern of the byte-level tokenizers attaches one space to the word
behind it and looks ahead only inside white space. A space between two
characters that aren't white space therefore starts a new, independent
segment. Distinct segments are few, so a task encodes each once.
"""

from __future__ import annotations

import re
import sys

OTHER_SPACE = re.compile(r"[^\S\x20\n]")
CUT = re.compile(r"(?<=\S)(?=\x20\S)")


def segments(text: str) -> list[str]:
    """Pieces whose concatenation is the text; all but the first start with
    the space that belongs to them."""
    if not text:
        return []
    parts = text.split(" ")
    if "" in parts or " \n" in text or "\n " in text or OTHER_SPACE.search(text):
        return CUT.split(text)
    head = parts[0]
    del parts[0]
    return [head, *[" " + p for p in parts]]


class Cache:
    """Results by segment in two generations, bounded in bytes.

    Keys, values and the objects themselves count. A full generation becomes
    the older one; what is asked for again moves to the younger.
    """

    def __init__(self, size: int = 32 << 20):
        self.young, self.old = {}, {}
        self.size, self.used = size // 2, 0

    def get(self, segment: str):
        made = self.young.get(segment)
        if made is None and (made := self.old.get(segment)) is not None:
            self.keep(segment, made)
        return made

    def keep(self, segment: str, made):
        """Stores and returns."""
        if self.used > self.size:
            self.old, self.young, self.used = self.young, {}, 0
        self.used += 100 + sys.getsizeof(segment) + sys.getsizeof(made)
        self.young[segment] = made
        return made
