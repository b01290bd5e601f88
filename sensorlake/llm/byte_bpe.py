"""Token ids of byte-level BPE vocabulary files of the ``tokenizers`` library, for whole corpora.

The library's own encoder keeps every piece's text and offsets, which costs
more than the encoding.  Where the file's merges are in the order of their ids,
merging by lowest id first is the same rule, and ``tiktoken`` merges so: the
ids are the library's.  Whether a character is a letter, a digit or white space
depends on each library's tables of Unicode; texts with characters younger than
Unicode 3.2, about which the tables may differ, go through ``tokenizers``, as
does a white space run too long for the other's regular expressions.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import tiktoken
import tokenizers

#: The pre-tokeniser's pattern (fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that are encoded at once.
STRETCH = 1 << 18
#: A place behind something and before white space: the pre-tokeniser never joins the two.
_CUT = re.compile(r"(?<=\S)(?=[\t-\r ])")


def stretches(text: str, most: int = STRETCH) -> Iterator[str]:
    """The text in stretches of about ``most`` characters, cut where the pre-tokeniser cuts in any case."""
    at = 0
    while len(text) - at > most:
        cut = _CUT.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def byte_characters() -> dict[str, int]:
    """The character by which such files write each byte: its own where that is printable, else the next from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@cache
def _young() -> re.Pattern:
    """Characters that Unicode 3.2 does not have."""
    old, runs = unicodedata.ucd_3_2_0, []
    for c in range(0x110000):
        if old.category(chr(c)) == "Cn":
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]")


class ByteBpe:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        splitter, added, model = kind.get("pre_tokenizer") or {}, kind.get("added_tokens", []), kind["model"]
        plain = kind.get("normalizer") is None and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not (plain and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")):
            raise ValueError(f"{path} is no byte-level BPE vocabulary without normaliser")
        if any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
            raise ValueError(f"{path} has special strings that depend on what stands beside them")
        special = {t["content"]: t["id"] for t in added}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError(f"the merges of {path} are not in the order of their ids")
        byte_of = byte_characters()
        ranks = {bytes(map(byte_of.__getitem__, piece)): i for piece, i in model["vocab"].items() if piece not in special}
        self.fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.whole = tokenizers.Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()

    def _encode(self, text: str) -> np.ndarray:
        if text.isascii() or not _young().search(text):
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # its stack for white space runs is full
                pass
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        """The ids, without added special tokens, as unsigned 32-bit numbers; a special string inside the text is its id."""
        parts = [self._encode(x) for x in stretches(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


@cache
def byte_bpe(path: str) -> ByteBpe:
    """One encoder per worker process and file."""
    return ByteBpe(path)
