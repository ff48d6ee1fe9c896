"""Token counts by heap-and-linked-list byte-pair merging.

Each piece of a text starts as its bytes; the lowest-rank adjacent pair is
merged again and again (``merges.merge``), and the count is the number of bytes
less the number of merges.  No token identifiers are made.
"""

from __future__ import annotations

import re

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, map_rows
from .merges import SPACE, MergeTable, byte_letters, merge, shadow

#: White space and what follows it up to the next: no piece crosses such an edge.
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: The pieces of a byte-level vocabulary of this kind.
_PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


class TokenCounter:
    """Counts for texts; the memos are bounded and only save time."""

    def __init__(self, table: MergeTable, memo: int = 300_000) -> None:
        self.ranks = table.ranks
        letters = byte_letters()
        self.first = [table.vocab[x] for x in letters]
        self.specials = re.compile("|".join(map(re.escape, sorted(table.specials, key=len, reverse=True)))) if table.specials else None
        # Pieces are chunks too, and held once.
        self.chunks = Memo(self._chunk, 2 * memo, 64)

    def _piece(self, piece: str) -> int:
        symbols = [self.first[b] for b in piece.encode()]
        n = len(symbols)
        return n - merge(symbols, self.ranks)[1]

    def _chunk(self, chunk: str) -> int:
        if chunk[chunk[0] == " " :].isalpha():
            return self._piece(chunk)
        pieces = [chunk[m.start() : m.end()] for m in _PIECE.finditer(shadow(chunk))]
        return self._piece(chunk) if len(pieces) == 1 else sum(map(self.chunks.__getitem__, pieces))

    def _plain(self, text: str) -> int:
        return sum(map(self.chunks.__getitem__, _CHUNK.findall(text)))

    def count(self, text: str | None) -> int:
        """Tokens of ``text``; a null is an empty text.  Special strings count one each."""
        if not text:
            return 0
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        parts = self.specials.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row of ``docs``.

    ``tokenizer`` is the path, on the driver, of a byte-level BPE file; its
    table (fixed size) is broadcast.  Null and empty texts count 0.  Repeated
    rows and ids give a row each; other columns are left aside, whatever their
    names.  An empty table gives an empty result.  A text of any length is
    counted whole: memory grows with its longest piece only.
    """
    table = docs.sparkSession.sparkContext.broadcast(MergeTable.from_file(tokenizer))

    def counted(counter: TokenCounter, keys: list, texts: list) -> tuple:
        return keys, [len((t or "").encode()) for t in texts], [counter.count(t) for t in texts]

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    out = map_rows(rows, counted, ["k", "t"], f"k {kind}, n_bytes bigint, n_tokens bigint", lambda: TokenCounter(table.value))
    return out.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
