"""Where a merge-type SentencePiece vocabulary can never join two characters.

A merge makes a piece of the vocabulary out of two neighbours, so a merge can
cross the place between characters ``a`` and ``b`` only if some piece holds
``ab``.  Where none does, both sides are encoded independently of each other:
such a place is a proven boundary.
"""

from __future__ import annotations

import re
from functools import cache

import sentencepiece

#: SentencePiece's visible white space (fixed value of the format).
SPACE = "▁"


@cache
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    """The library's processor, one per worker process and file."""
    return sentencepiece.SentencePieceProcessor(model_file=path)


def is_normal(sp: sentencepiece.SentencePieceProcessor, i: int) -> bool:
    return not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))


@cache
def joinable(path: str) -> frozenset[str]:
    """All two-character strings that occur inside a piece."""
    sp = processor(path)
    out = set()
    for i in range(sp.get_piece_size()):
        if is_normal(sp, i):
            p = sp.id_to_piece(i)
            out.update(a + b for a, b in zip(p, p[1:]))
    return frozenset(out)


def proven(path: str, data: bytes, at: int) -> bool:
    """Whether no merge can cross byte ``at`` of UTF-8 text ``data``."""
    if not 0 < at < len(data):
        return True
    first = at - 1
    while data[first] & 0xC0 == 0x80:
        first -= 1
    if data[at] & 0xC0 == 0x80:
        return False
    last = at + 1
    while last < len(data) and data[last] & 0xC0 == 0x80:
        last += 1
    return data[first:last].decode().replace(" ", SPACE) not in joinable(path)


@cache
def segment_pattern(path: str) -> re.Pattern:
    """Cuts a text, its visible white space written as spaces, into segments whose
    ends are proven boundaries: spaces belong to what follows them; characters
    that pieces join fall into the same class; every other stands alone."""
    group: dict[str, str] = {}

    def top(c: str) -> str:
        while group.setdefault(c, c) != c:
            c = group[c]
        return c

    trailing = {p[0] for p in joinable(path) if p[1] == SPACE and p[0] != SPACE}
    for a, b in joinable(path):
        if SPACE not in (a, b):
            group[top(a)] = top(b)
    classes: dict[str, list[str]] = {}
    for c in list(group):
        classes.setdefault(top(c), []).append(c)
    if trailing:  # white space may end a piece: only whole texts are safe
        return re.compile(r"[\s\S]+")
    runs = ["[" + "".join(map(re.escape, sorted(cs))) + "]+" for cs in sorted(classes.values(), key=len, reverse=True)]
    return re.compile(" *(?:" + "|".join([*runs, "[^ ]"]) + ")| +")
