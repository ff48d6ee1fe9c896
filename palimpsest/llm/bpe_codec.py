"""BPE encoding and decoding with forced boundaries.

Two neighbouring bytes that stand side by side in no vocabulary token can never
end up in one token, so a word is cut there for certain.  The fragments between
the cuts are merged on their own and their identifiers concatenated.
"""

from __future__ import annotations

import hashlib
import re
import struct
import sys
import unicodedata
from array import array

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, map_rows
from .merges import SMALL, SPACE, MergeTable, byte_letters, merge, merge_short, shadow

_CHUNK = re.compile(f"[^{SPACE}]+")
END = "</w>"
#: No byte of UTF-8.
LAST = b"\xff"
#: The words of a vocabulary with word ends.
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")


#: First and last of the combining marks that came after Unicode 9, which the
#: tokenizer library's normal form takes for letters of their own; and a vowel sign that it
#: does not compose.
LATER_MARKS = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA), (0x1715, 0x1715),
    (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50),
    (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930), (0x1193D, 0x1193E),
    (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45),
    (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF),
    (0x1E4EC, 0x1E4EF),
)
_LATER = re.compile("([" + "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER_MARKS) + "]+)")
_SMALLER = re.compile("[" + "".join(map(chr, SMALL)) + "]")


def composed(text: str) -> str:
    """The normal form NFC by the tables of Unicode 9: later marks part what stands around them."""
    return "".join([x if i % 2 else unicodedata.normalize("NFC", x) for i, x in enumerate(_LATER.split(text))])


def lowered(text: str) -> str:
    """``text`` in the library's normal form and lowered.  No letter of it depends on what stands beyond white space."""
    try:
        text.encode("latin-1")  # all of these are in normal form
        return text.lower()
    except UnicodeEncodeError:
        pass
    # The library lowers letter by letter, without the rule for a final sigma.
    text = (composed(text) if _LATER.search(text) else unicodedata.normalize("NFC", text)).replace("Σ", "σ")
    return (text.translate(SMALL) if _SMALLER.search(text) else text).lower()


class WordCodec:
    """Encodes and decodes as the tokenizer library does for a lower-casing BPE with word ends."""

    def __init__(self, table: MergeTable, memo: int = 150_000) -> None:
        self.ranks, self.pairs, self.specials = table.ranks, table.pairs, table.specials
        self.token = {i: t for t, i in table.vocab.items()} | {i: t for t, i in table.specials.items()}
        letters = byte_letters()
        byte = {x: b for b, x in enumerate(letters)}
        self.inner = [table.vocab[x] for x in letters]
        self.last = [table.vocab[x + END] for x in letters]
        # What stands side by side in some token: within it, and at a word's end.
        self.joined, self.joined_last = bytearray(65536), bytearray(65536)
        for token in table.vocab:
            ends = token.endswith(END) and len(token) > len(END)
            own = [byte.get(x, 0) for x in (token[: -len(END)] if ends else token)]
            for i, (a, b) in enumerate(zip(own, own[1:])):
                (self.joined_last if ends and i == len(own) - 2 else self.joined)[a << 8 | b] = 1
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(table.specials, key=len, reverse=True))) + ")") if table.specials else None
        self.fragments = Memo(self._fragment, memo, 64)
        # Words are chunks too, and held once.
        self.chunks = Memo(self._chunk, 2 * memo, 64)

    def cuts(self, word: bytes) -> list[bytes]:
        """``word`` cut where no token can cross."""
        n, joined = len(word), self.joined
        at = [i for i, (a, b) in enumerate(zip(word, word[1:]), 1) if not joined[a << 8 | b]]
        # At the word's end other tokens stand.
        if n > 1 and self.joined_last[word[-2] << 8 | word[-1]] == (n - 1 in at[-1:]):
            at = at[:-1] if n - 1 in at[-1:] else [*at, n - 1]
        return [word[i:j] for i, j in zip([0, *at], [*at, n])] if at else [word]

    def _fragment(self, key: bytes) -> bytes:
        """``key``: a fragment's bytes, and LAST after them if it ends its word."""
        last = key.endswith(LAST)
        fragment = key[:-1] if last else key
        symbols = [self.inner[b] for b in fragment]
        if last:
            symbols[-1] = self.last[fragment[-1]]
        if len(symbols) < 64:
            ids = merge_short(symbols, self.pairs)
        else:
            ids = [s for s in merge(symbols, self.ranks)[0] if s >= 0]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        parts = self.cuts(word.encode())
        parts[-1] += LAST
        return self.fragments[parts[0]] if len(parts) == 1 else b"".join([self.fragments[p] for p in parts])

    def _chunk(self, chunk: str) -> bytes:
        """``chunk``: lowered, without white space."""
        if chunk.isalpha():
            return self._word(chunk)
        if chunk.isascii():
            words = _WORDS.findall(chunk)
        else:
            words = [chunk[m.start() : m.end()] for m in _WORDS.finditer(shadow(chunk))]
        if len(words) == 1 and words[0] == chunk:
            return self._word(chunk)
        return b"".join([self.chunks[w] for w in words])

    def _plain(self, text: str) -> bytes:
        # A text is lowered at once, so that forms of one word are one chunk.
        return b"".join(map(self.chunks.__getitem__, _CHUNK.findall(lowered(text))))

    def encode(self, text: str | None) -> bytes:
        """Identifiers of the whole of ``text``, little-endian unsigned 32-bit integers; null is
        empty.  Special strings become their tokens."""
        if not text:
            return b""
        if self.split is None or not self.split.search(text):
            return self._plain(text)
        return b"".join([struct.pack("<I", self.specials[part]) if part in self.specials else self._plain(part) for part in self.split.split(text)])

    def decode(self, ids: bytes) -> str:
        """Tokens of ``ids`` joined by spaces: the file names no decoder of its own.  Unknown
        identifiers stand for nothing."""
        got = array("I", ids)
        if sys.byteorder != "little":
            got.byteswap()
        return " ".join([t for t in map(self.token.get, got) if t is not None])


def encode_table(
    docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", payload: bool = True
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) for each row, and with ``payload``
    also ids (binary, little-endian unsigned 32-bit) and decoded (string).

    ``tokenizer`` is the path, on the driver, of a BPE file with word ends; its
    table (fixed size) is broadcast.  Null, empty and blank texts have no ids and
    decode to an empty text.  Repeated rows give a row each, an empty table none,
    and other columns are left aside, whatever their names.
    """
    table = docs.sparkSession.sparkContext.broadcast(MergeTable.from_file(tokenizer))

    def encoded(codec: WordCodec, keys: list, texts: list) -> tuple:
        ids = [codec.encode(t) for t in texts]
        decoded = [codec.decode(i) for i in ids]
        out = (keys, [len(i) // 4 for i in ids], [hashlib.sha256(i).hexdigest() for i in ids], [hashlib.sha256(t.encode()).hexdigest() for t in decoded])
        return (*out, ids, decoded) if payload else out

    kind = docs.schema[key].dataType.simpleString()
    schema = f"k {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * payload
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    out = map_rows(rows, encoded, ["k", "t"], schema, lambda: WordCodec(table.value))
    return out.withColumnRenamed("k", key)
