"""Byte-pair merge tables read from public tokenizer files."""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import repeat

#: Unicode White_Space, as the tokenizer library's patterns take it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: First and last of the letters and digits of Unicode 16, which the
#: tokenizer library knows and Python's ``unicodedata`` does not.
UNICODE_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16130, 0x16139), (0x16D40, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5FA),
)
#: The small letters of Unicode 16 and 17, in part by their distance.
SMALL = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
SMALL |= {0x10D50 + i: 0x10D70 + i for i in range(22)} | {0x16EA0 + i: 0x16EBB + i for i in range(25)}


def shadow(text: str) -> str:
    """``text`` with a private-use letter for each character that came after Unicode 16:
    the regex module takes some for letters or digits, the library takes them for signs."""
    if text.isascii() or text.isprintable():  # unassigned characters are not printable
        return text
    return "".join(["\ue000" if unicodedata.category(c) == "Cn" and not any(a <= ord(c) <= b for a, b in UNICODE_16) else c for c in text])


#: Above all ranks.
NONE = 1 << 62


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, free = [], 0x100
    for b in range(256):
        letters.append(chr(b if b in plain else free))
        free += b not in plain
    return letters


@dataclass
class MergeTable:
    """``ranks`` maps a pair of ids, packed in one integer, to rank << 32 | merged id."""

    vocab: dict[str, int]
    ranks: dict[int, int]
    specials: dict[str, int]

    @property
    def pairs(self) -> dict[tuple[int, int], int]:
        """``ranks`` by pairs as they are."""
        return {(k >> 32, k & 0xFFFFFFFF): v for k, v in self.ranks.items()}

    @classmethod
    def from_file(cls, path: str) -> MergeTable:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        ranks: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks.setdefault(vocab[a] << 32 | vocab[b], rank << 32 | vocab[a + b])
        return cls(vocab, ranks, {t["content"]: t["id"] for t in spec["added_tokens"]})


def merge(symbols: list[int], ranks: dict[int, int]) -> tuple[list[int], int]:
    """Merge ``symbols`` in place, always the leftmost pair of the lowest rank.

    A heap holds rank << 40 | position of each adjacent pair; a doubly linked
    list joins the symbols left.  ``pairs`` has what each position's pair becomes
    now, by which stale heap entries are seen.
    Returns the list, with -1 where a symbol went, and the number of merges.
    """
    n = len(symbols)
    get = ranks.get
    pairs = [get(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:])]
    heap = [found >> 32 << 40 | i for i, found in enumerate(pairs) if found >= 0]
    if not heap:
        return symbols, 0
    heapify(heap)
    pairs.append(-1)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFFFF
        found = pairs[i]
        if found >> 32 != entry >> 40:
            continue
        new = found & 0xFFFFFFFF
        j = after[i]
        symbols[i], symbols[j], pairs[j] = new, -1, -1
        k = after[i] = after[j]
        merges += 1
        if k < n:
            before[k] = i
            found = pairs[i] = get(new << 32 | symbols[k], -1)
            if found >= 0:
                heappush(heap, found >> 32 << 40 | i)
        else:
            pairs[i] = -1
        h = before[i]
        if h >= 0:
            found = pairs[h] = get(symbols[h] << 32 | new, -1)
            if found >= 0:
                heappush(heap, found >> 32 << 40 | h)
    return symbols, merges


def merge_short(symbols: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """The same merges by scanning a list of the pairs' ranks: less work for short inputs.
    ``pairs`` has the ranks by pairs as they are."""
    get = pairs.get
    found = [*map(get, zip(symbols, symbols[1:]), repeat(NONE))]
    while found:
        least = min(found)
        if least == NONE:
            break
        i = found.index(least)
        symbols[i : i + 2] = [least & 0xFFFFFFFF]
        del found[i]
        if i < len(found):
            found[i] = get((symbols[i], symbols[i + 1]), NONE)
        if i:
            found[i - 1] = get((symbols[i - 1], symbols[i]), NONE)
    return symbols
