r"""The word split of byte-level BPE vocabularies, written for ``re``.

The published pattern needs ``\p{L}`` and ``\p{N}``. Here a letter is a word character that is no number and no
underscore, and the number signs that Python counts as letters are listed from the Unicode data, so both patterns cut
alike.
"""

import json
import re
import sys
import unicodedata
from functools import cache

# Fixed value: Unicode white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _ranges(points: list[int]) -> str:
    parts: list[list[int]] = []
    for p in points:
        if parts and parts[-1][1] == p - 1:
            parts[-1][1] = p
        else:
            parts.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in parts)


@cache
def pattern() -> re.Pattern:
    """Contractions, runs of letters, numbers or other signs with a space before them, and white space."""
    kinds = [(p, unicodedata.category(chr(p))) for p in range(sys.maxunicode + 1) if chr(p).isalnum()]
    numbers = _ranges([p for p, kind in kinds if kind in ("Nl", "No")])
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_{numbers}]+| ?[\d{numbers}]+| ?(?:[^\w{SPACE}]|_)+"
        rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


def plain_byte_level(path: str) -> bool:
    """Whether a tokenizers file cuts texts by the byte-level pattern and does nothing else to them, so that each word's
    tokens depend on the word alone."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    cutter = spec["pre_tokenizer"] or {}
    odd = any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
    return (
        spec["normalizer"] is None and spec["model"]["type"] == "BPE" and cutter.get("type") == "ByteLevel"
        and not cutter.get("add_prefix_space") and cutter.get("use_regex", True) and not odd
    )
