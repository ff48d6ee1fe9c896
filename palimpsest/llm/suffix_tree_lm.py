"""Language-model scoring with a probabilistic suffix tree over all words.

The tree's states are contexts of words, of any number and length: every context
above a count floor whose shorter suffix is a state is tested for divergence from
it.  A state's next-word distribution is smoothed by its suffix's, the root's being
the unigram base.  Texts are encoded once as hashes of their words, packed in blocks; contexts are
counted, tested and kept as Spark rows; a text is scored by the longest suffix
states, whose terms the tasks hold for the commonest and find by a join for all
others.  Word counts likewise.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, partial, reduce
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..sources import storage
from .common import fold, of_texts, slices

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Hashes that stand for the end and the start of a text, and for what parts stretches of texts,
#: and what a packed block of words begins with; words have those of ``word_keys``.
END, START, APART, PACKED = 0x452821E638D01377, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89
#: A context's hash is a polynomial of its words' hashes in this base, the last word's first.
_BASE = 0xD6E8FEB86659FD93
_UNBASE = pow(_BASE, -1, 1 << 64)
#: Bits of a filter: sixteen an entry, and between these powers of two; what it lets through in error goes at
#: the exact joins after it.
_LEAST_BITS, _MOST_BITS = 16, 28
#: Parts that a context's followers are dealt into where they meet what is known of it.
SALTS = 8
#: Contexts, of forty bytes or less, that go to every task.
_FEW = 500_000
#: Words that a task works on at a time, and pairs that it gathers before it counts them.
_WORDS, _PAIRS = 1 << 19, 1 << 21
#: Words of a packed block of texts, about: a word's hash stands there once.
_BLOCK = 1 << 21
#: Bytes of packed words that a task counts.
_SHARE = 48 << 20
#: Where there are more words than that, what follows contexts is counted by short hashes first, and by itself where these
#: are frequent, in so many runs: the shuffle of one is gone before the next one writes.
RUNS, _ONE_RUN = 1, 1 << 20
#: Bits of a pair that are left out where it is counted by a short hash, and words a part of such hashes.
_SHORT, _PART = 24, 1 << 20
#: Spark's switch for shuffles that go with the query that made them.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Params:
    """``least``: occurrences of a context that is tested.  ``follow``: occurrences from which
    on a word after a context has a probability of its own there; that of the others is the
    suffix's, scaled.  A context is a state if it diverges from its suffix by ``divergence``
    or more and the gain in likelihood is beyond chance: twice that is as much as what as many
    free parameters give by chance, and ``deviations`` standard deviations more.  ``prior``
    smooths the states.  ``counted`` words and ``terms`` of states are held by the tasks; all
    others are joined."""

    counted: int = 500_000
    least: int = 50
    follow: int = 8
    divergence: float = 0.01
    deviations: float = 5.0
    prior: float = 100.0
    terms: int = 2_000_000

    def __post_init__(self) -> None:
        if self.follow > self.least:
            raise ValueError("a context is counted as what follows a shorter one: least is not below follow")


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTERS = np.random.default_rng(7).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_LETTERS[65:91] = _LETTERS[97:123]
_STEP = 0xD1342543DE82EF95
#: Bytes that are hashed at a time.
_WINDOW = 1 << 18


@cache
def _steps() -> tuple[np.ndarray, np.ndarray]:
    """Powers of _STEP, and their inverses, modulo 2 ** 64."""
    ups, downs = np.full(_WINDOW + 1, _STEP, np.uint64), np.full(_WINDOW + 1, pow(_STEP, -1, 1 << 64), np.uint64)
    ups[0] = downs[0] = 1
    return np.multiply.accumulate(ups), np.multiply.accumulate(downs)


def word_keys(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, how many of them each text has): the texts are the bytes ``data``
    between ``cuts``.  Words are the runs of anything but white space, with A-Z lowered; a hash
    is a polynomial of their letters, summed up once for all words of a stretch."""
    space = _IS_SPACE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = space[1:] | space[:-1]
    edge[cuts] = True
    starts = np.flatnonzero(edge[:-1] & ~space)
    ends = np.flatnonzero(edge[1:] & ~space) + 1
    ups, downs = _steps()
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        first = int(starts[i])
        j = int(np.searchsorted(ends, first + _WINDOW, "right"))
        if j > i:
            sums = np.zeros(int(ends[j - 1]) - first + 1, np.uint64)
            np.cumsum(_LETTERS[data[first : ends[j - 1]]] * ups[: len(sums) - 1], out=sums[1:])
            at = starts[i:j] - first
            out[i:j] = (sums[ends[i:j] - first] - sums[at]) * downs[at]
        else:  # a word longer than a stretch
            j, total = i + 1, 0
            for k in range(int(ends[i]) - 1, first - 1, -_WINDOW):
                part = data[max(first, k - _WINDOW + 1) : k + 1]
                total = (total * pow(_STEP, len(part), 1 << 64) + int((_LETTERS[part] * ups[: len(part)]).sum(dtype=np.uint64))) % (1 << 64)
            out[i] = total
        i = j
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(29)), np.diff(np.searchsorted(starts, cuts))


def cut(df: DataFrame, name: str) -> DataFrame:
    """``storage.cut``; the shuffles that it made are deleted with it, not when the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN, None)
    conf.set(_CLEAN, "true")
    try:
        return storage.cut(df, name)
    finally:
        conf.unset(_CLEAN) if before is None else conf.set(_CLEAN, before)


def drop(*cuts: DataFrame) -> None:
    """Delete the files of cut tables, or of unions of such, that nothing reads any more."""
    for df in cuts:
        for folder in {unquote(file).rpartition("/")[0] for file in df.inputFiles()}:
            storage.delete(df.sparkSession, folder)


class Table:
    """Values of distinct 64-bit keys, for many at once.  A key stands at its slot or in the
    next free place after it; no key is 0.  A filter tells most keys that are not there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        keys = keys.view(np.uint64)
        self.slots = np.uint64(len(keys) * 5 // 2 + 16)
        slot = self._slot(keys)
        order, place = np.argsort(slot, kind="stable"), np.arange(len(keys))
        at = np.maximum.accumulate(slot[order] - place) + place
        size = max(int(self.slots), at[-1] + 1 if len(at) else 0) + 1
        self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size, values.dtype)
        self.keys[at], self.values[at] = keys[order], values[order]
        self.filter = Filter.of(keys)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX >> np.uint64(32)) * self.slots >> np.uint64(32)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it is not there."""
        out, rest = np.full(len(keys), -1, np.int64), np.flatnonzero(self.filter.passes(keys))
        keys = keys[rest]
        at = self._slot(keys)
        while len(rest):
            there = self.keys[at]
            hit = there == keys
            out[rest[hit]] = at[hit]
            on = ~hit & (there != 0)
            rest, at, keys = rest[on], at[on] + 1, keys[on]
        return out


class Filter:
    """Which 64-bit keys may be in a set; its size follows the set's, up to a bound."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.shift = bits, np.uint64(64 - (len(bits) * 64).bit_length() + 1)

    @staticmethod
    def _size(n: int) -> int:
        return 1 << min(max((16 * n).bit_length(), _LEAST_BITS), _MOST_BITS)

    @classmethod
    def of(cls, keys: np.ndarray) -> Filter:
        out = cls(np.zeros(cls._size(len(keys)) // 64, np.uint64))
        slot = keys >> out.shift
        np.bitwise_or.at(out.bits, slot >> np.uint64(6), np.uint64(1) << (slot & np.uint64(63)))
        return out

    @classmethod
    def made(cls, keys: DataFrame, column: str = "c") -> Filter:
        """Of a table's keys: its tasks set the bits, the driver sees no key."""
        out = cls(np.zeros(cls._size(keys.count()) // 64, np.uint64))
        slot = F.shiftrightunsigned(column, int(out.shift))
        words = keys.select(slot.alias("s")).groupBy(F.shiftright("s", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("bits")).toArrow()
        out.bits[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
        return out

    def passes(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> self.shift
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def longer(context: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Hashes of contexts with one more word before their first, ``depth`` words then."""
    return context + word * np.uint64(pow(_BASE, depth - 1, 1 << 64))


def followed(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of contexts with the word after them, as keys of terms."""
    h = (~context * _MIX ^ word) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(29))


def pack_words(words: np.ndarray) -> bytes:
    """A block of words: the hashes of those that stand there more than once, the commonest first, and of the others as
    they come; then a number for each word, 0 for the next of the others, whose bytes of one weight stand together."""
    coded = pa.array(words).dictionary_encode()
    hashes, codes = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    n = np.bincount(codes, minlength=len(hashes))
    order = np.argsort(-n, kind="stable")
    many = int((n > 1).sum())
    number = np.zeros(len(hashes), "<u4")
    number[order[:many]] = np.arange(1, many + 1)
    planes = number[codes].view(np.uint8).reshape(-1, 4).T.tobytes()
    head = np.array([PACKED, len(words), many, len(hashes) - many], "<u8")
    return head.tobytes() + hashes[order].astype("<u8").tobytes() + pa.compress(planes, "zstd", asbytes=True)


def unpack_words(block: pa.Buffer) -> np.ndarray:
    _, size, many, once = map(int, np.frombuffer(block, "<u8", 4))
    hashes = np.frombuffer(block, "<u8", many + once, 32)
    data = np.frombuffer(pa.decompress(block[32 + 8 * (many + once) :], 4 * size, "zstd"), np.uint8)
    codes = np.ascontiguousarray(data.reshape(4, size).T).view("<u4").ravel()
    words = np.concatenate([np.zeros(1, np.uint64), hashes[:many]])[codes]
    words[codes == 0] = hashes[many:]
    return words


def encoded(rows: DataFrame) -> DataFrame:
    """(k, f, train, w) of rows (k, t, f): blocks of whole texts, of which f is above 0 or not, their k and f as lists, and
    the hashes of the texts' words, each text's between those of a start and an end, packed."""
    kind = rows.schema["k"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[tuple[pa.Array, pa.Array, np.ndarray]]] = {True: [], False: []}

        def give(train: bool) -> pa.RecordBatch:
            k, f, words = zip(*held[train])
            held[train].clear()
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in map(pa.concat_arrays, (k, f))]
            block = pack_words(np.concatenate(words))
            return pa.RecordBatch.from_arrays([*lists, pa.array([train]), pa.array([block], pa.binary())], names=["k", "f", "train", "w"])

        for batch in slices(batches):
            texts = pc.fill_null(batch["t"].cast(pa.string()), "")
            cuts = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
            keys, counts = word_keys(data, cuts - cuts[0])
            ends = np.concatenate([[0], np.cumsum(counts + 2)])
            words = np.empty(ends[-1], np.uint64)
            words[np.arange(len(keys)) + 2 * np.repeat(np.arange(len(counts)), counts) + 1] = keys
            words[ends[:-1]], words[ends[1:] - 1] = START, END
            learnt = batch["f"].to_numpy() > 0
            for train in (True, False):
                own = learnt == train
                if own.any():
                    held[train].append((batch["k"].filter(pa.array(own)), batch["f"].filter(pa.array(own)), words[np.repeat(own, counts + 2)]))
                if sum(len(w) for _, _, w in held[train]) >= _BLOCK:
                    yield give(train)
        for train in (True, False):
            if held[train]:
                yield give(train)

    return cut(rows.select("k", "t", "f").mapInArrow(made, f"k array<{kind}>, f array<int>, train boolean, w binary"), "lm-texts")


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, words, starts): encoded texts, plain or of packed blocks, in parts of so many words, and where each text
    starts and the last one ends.  Of a block, a row of k and f for each text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        w = batch["w"].cast(pa.binary())
        cuts = np.frombuffer(w.buffers()[1], np.int32)[w.offset : w.offset + len(w) + 1].astype(np.int64)
        data = w.buffers()[2] or pa.py_buffer(b"")
        if cuts[1] - cuts[0] >= 8 and int.from_bytes(data[int(cuts[0]) : int(cuts[0]) + 8], "little") == PACKED:
            for i in range(batch.num_rows):
                words = unpack_words(data[int(cuts[i]) : int(cuts[i + 1])])
                lists = {name: batch[name].slice(i, 1).flatten() for name in ("k", "f") if name in batch.schema.names}
                rows = pa.RecordBatch.from_pydict(lists) if lists else batch.slice(i, 1)
                yield from _parts(rows, words, np.append(np.flatnonzero(words == words[0]), len(words)))
        else:
            cuts //= 8
            yield from _parts(batch, np.frombuffer(data, np.uint64, int(cuts[-1])), cuts)


def _parts(rows: pa.RecordBatch, words: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    at = 0
    while at < len(cuts) - 1:
        stop = max(at + 1, int(np.searchsorted(cuts, cuts[at] + _WORDS, "right")) - 1)
        yield rows.slice(at, stop - at), words[cuts[at] : cuts[stop]], cuts[at : stop + 1] - cuts[at]
        at = stop


def _places(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The place of each word in its text, or in its stretch where these begin with APART, at -1."""
    if len(words) and words[0] == APART:
        starts = np.append(np.flatnonzero(words == np.uint64(APART)), len(words))
        return np.arange(len(words)) - np.repeat(starts[:-1], np.diff(starts)) - 1
    return np.arange(starts[-1]) - np.repeat(starts[:-1], np.diff(starts))


#: Words of a row of stretches, about.
_ROW = 2048


def stretches(texts: DataFrame, pairs: Filter, packed: bool = False) -> DataFrame:
    """Columns w and size, its words: the stretches of encoded texts in which every pair of neighbours passes ``pairs``, of
    three words or more, each with the word after it and APART before it, many to a row, or ``packed`` in blocks.  All that
    follows contexts of three words or more, of frequent pairs, is here."""
    shared = texts.sparkSession.sparkContext.broadcast(pairs)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, starts in _sequences(batches):
            inside = np.zeros(len(words) + 2, bool)  # whether a word and the one before it pass
            inside[1:-2] = shared.value.passes(longer(words[1:], words[:-1], 2)) & (words[1:] != np.uint64(END))
            inside[starts[:-1]] = False
            first = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
            past = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
            long = past - first >= 2
            first, past = first[long], past[long]
            sizes = past - first + 3  # with the word before the first pair, the one after the last, and APART
            ends = np.cumsum(sizes)
            out = words[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(first - 2, sizes)]
            out[ends - sizes] = APART
            if packed:
                if len(out):
                    yield pa.RecordBatch.from_arrays([pa.array([pack_words(out)], pa.binary()), pa.array([len(out)])], names=["w", "size"])
                continue
            new = np.flatnonzero(np.diff(ends // _ROW, prepend=0))
            cuts = np.unique(np.concatenate([[0], ends[new], ends[-1:]])).astype(np.int64)
            w = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 8).astype(np.int32)), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays([w, pa.array(np.diff(cuts))], names=["w", "size"])

    return cut(texts.select("w").mapInArrow(found, "w binary, size bigint"), "lm-stretches")


def _tasks(texts: DataFrame) -> int:
    """As many as there are shares of packed words, and two for each core at least."""
    files = texts.inputFiles()
    size = sum(storage.sizes(texts.sparkSession, {f.rpartition("/")[0] for f in files})) if files else 0
    return max(2 * texts.sparkSession.sparkContext.defaultParallelism, -(-size // _SHARE))


def _counted(texts: DataFrame, found: Callable) -> DataFrame:
    """(kind, a, b, n): how often each pair occurs that ``found`` gives, by kinds, for words and
    their places; a task counts its own before they are shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = []

        def give() -> Iterator[pa.RecordBatch]:
            for kind, pairs in enumerate(zip(*held)):
                a, b = map(np.concatenate, zip(*pairs))
                z = followed(a, b)
                order = np.argsort(z)
                z = z[order]
                first = np.flatnonzero(np.diff(z, prepend=~z[:1]))
                n, at = np.diff(first, append=len(z)).astype(np.int64), order[first]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int8)), pa.array(a[at].view(np.int64)), pa.array(b[at].view(np.int64)), pa.array(n)], names=["kind", "a", "b", "n"])
            held.clear()

        gathered = 0
        for _, words, starts in _sequences(batches):
            held.append(found(words, _places(words, starts)))
            gathered += sum(len(a) for a, _ in held[-1])
            if gathered > _PAIRS:
                yield from give()
                gathered = 0
        yield from give()

    # What a task counts many times leaves it once: small files are read by few tasks.
    texts = texts.select("w").coalesce(_tasks(texts))
    return texts.mapInArrow(counted, "kind tinyint, a bigint, b bigint, n bigint").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))


def _packed(short: np.ndarray, n: np.ndarray) -> bytes:
    """Short hashes in order, as steps from one to the next, and their counts: bytes of one weight stand together."""
    steps = np.diff(short, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 8 - _SHORT // 8]
    return pa.compress(steps.T.tobytes() + n.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unpacked(blob: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    wide = 8 - _SHORT // 8
    data = np.frombuffer(pa.decompress(blob, size * (wide + 4), "zstd", asbytes=True), np.uint8)
    steps, n = np.zeros((size, 8), np.uint8), np.ascontiguousarray(data[size * wide :].reshape(4, size).T)
    steps[:, :wide] = data[: size * wide].reshape(wide, size).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), n.view("<u4").ravel()


def frequent(texts: DataFrame, found: Callable, least: int, words: int) -> Filter:
    """Passes the pairs that ``found`` gives, of any kind, ``least`` times or more in about so many words, and few others.
    Tasks count hashes of 40 bits, which take three bytes or four in a shuffle, where a pair takes twenty."""
    parts = max(1, words // _PART)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def give() -> Iterator[pa.RecordBatch]:
            short = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            held.clear()
            first = np.flatnonzero(np.diff(short, prepend=~short[:1]))
            n = np.minimum(np.diff(first, append=len(short)), least)
            short = short[first]
            part = (short * np.uint64(parts) >> np.uint64(64 - _SHORT)).astype(np.int32)
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            ends = np.append(starts[1:], len(part))
            blobs = [_packed(short[a:b], n[a:b]) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(part[starts]), pa.array((ends - starts).astype(np.int32)), pa.array(blobs, pa.binary())], names=["part", "size", "blob"])

        gathered = 0
        for _, words, starts in _sequences(batches):
            for a, b in found(words, _places(words, starts)):
                held.append(followed(a, b) >> np.uint64(_SHORT))
                gathered += len(a)
            if gathered > _PAIRS:
                yield from give()
                gathered = 0
        if gathered:
            yield from give()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [_unpacked(blob, size) for batch in batches for size, blob in zip(batch["size"].to_pylist(), batch["blob"].to_pylist())]
        if got:
            short, n = map(np.concatenate, zip(*got))
            order = np.argsort(short)
            short = short[order]
            first = np.flatnonzero(np.diff(short, prepend=~short[:1]))
            often = short[first][np.add.reduceat(n[order].astype(np.int64), first) >= least]
            yield pa.RecordBatch.from_arrays([pa.array((often << np.uint64(_SHORT)).view(np.int64))], names=["c"])

    dealt = texts.select("w").mapInArrow(counted, "part int, size int, blob binary").repartition(parts, "part")
    often = cut(dealt.select("size", "blob").mapInArrow(summed, "c bigint"), "lm-often")
    out = Filter.made(often)
    drop(often)
    return out


def word_counts(texts: DataFrame) -> DataFrame:
    """(key, n): occurrences of each word, and of the end, in encoded texts."""
    found = lambda words, place: [(np.zeros(int((place > 0).sum()), np.uint64), words[place > 0])]
    return _counted(texts, found).select(F.col("b").alias("key"), "n")


def _walk(words: np.ndarray, place: np.ndarray, kept: list[Filter], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, context of ``depth`` words before it, its suffix) where all suffixes pass the
    filters of the states of their lengths."""
    at = np.flatnonzero(place >= depth)
    context = suffix = np.zeros(len(at), np.uint64)
    for d in range(1, depth + 1):
        if d > 1:
            inside = kept[d - 2].passes(context)
            at, context = at[inside], context[inside]
        suffix, context = context, longer(context, words[at - d], d)
    return at, context, suffix


def _run(keys: np.ndarray, runs: int) -> np.ndarray:
    """In which run each key is counted."""
    return (keys * _MIX >> np.uint64(40)) % np.uint64(runs)


@F.pandas_udf(LongType())
def _ahead(context: pd.Series, word: pd.Series) -> pd.Series:
    """The context that ends in ``word`` after ``context``."""
    return pd.Series((context.to_numpy(np.int64).view(np.uint64) * np.uint64(_BASE) + word.to_numpy(np.int64).view(np.uint64)).view(np.int64))


@F.pandas_udf(LongType())
def _term(context: pd.Series, word: pd.Series) -> pd.Series:
    return pd.Series(followed(context.to_numpy(np.int64).view(np.uint64), word.to_numpy(np.int64).view(np.uint64)).view(np.int64))


def _met(followers: DataFrame, contexts: DataFrame, few: bool) -> DataFrame:
    """Followers beside what is known of their contexts, (c, ...): ``few`` of these go to every
    task, many meet them in salts, as a context may have very many."""
    if few:
        return followers.join(F.broadcast(contexts), "c")
    return followers.join(contexts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["c", "salt"])


def levels(texts: DataFrame, words: DataFrame, whole: float, params: Params) -> Iterator[tuple[DataFrame, DataFrame]]:
    """For contexts of one word, two and so on, until none is kept: (c, back) of the states, and
    (c, x, n, lp, below, back) of their followers, lp and below being the logarithms of x's
    probability there and at the suffix, back that of the scale of all other words'.

    ``words``: (key, n) of every word of the encoded ``texts``; ``whole``: the base's divisor.
    What is given is the caller's to drop; all other tables go as soon as nothing reads them.
    """
    spark = texts.sparkSession
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ends = words.where(F.col("key") == _long(END)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))  # as many as starts
    started = ends.select(_long(START).alias("key"), "n")
    heavy = words.where(F.col("key") != _long(END)).union(started).where(F.col("n") >= params.least)
    heavy = cut(heavy.select(F.col("key").alias("c"), F.lit(0).cast("bigint").alias("s"), F.col("n").alias("total")), "lm-contexts")
    above = words.select(F.lit(0).cast("bigint").alias("s"), F.col("key").alias("x"), F.log((F.col("n") + 0.1) / F.lit(whole)).alias("below"))
    kept: list[Filter] = []
    # A word that is not there often enough does not follow a context so.
    open_ = Filter.made(words.where(F.col("n") >= params.follow).select(_term(F.lit(0).cast("bigint"), "key").alias("c")))
    pairs, tested_before, depth = None, None, 1
    many = size > _ONE_RUN
    where, runs = texts, RUNS if many else 1
    while True:
        shared = spark.sparkContext.broadcast((kept, open_, tested_before, Filter.made(heavy)))

        def following(run: int, often: Broadcast | None, words: np.ndarray, place: np.ndarray, shared=shared, depth=depth, runs=runs) -> list[tuple[np.ndarray, np.ndarray]]:
            """Of one run, and those that are ``often`` there: pairs of contexts and the words after them; and, from three
            words on, of contexts and suffixes, of contexts that have not been counted yet: what precedes their last word
            was not tested."""
            kept, open_, tested, known = shared.value
            at, context, suffix = _walk(words, place, kept, depth)
            own = _run(context + words[at], runs) == run
            inside = own & known.passes(context)
            new = np.zeros(len(at), bool)
            if depth > 2:
                new = np.ones(len(at), bool) if tested is None else tested.find((context - words[at - 1]) * np.uint64(_UNBASE)) < 0
            inside |= new & own
            new &= _run(context, runs) == run
            totals = (context[new], suffix[new])
            at, context, suffix = at[inside], context[inside], suffix[inside]
            inside = open_.passes(followed(suffix, words[at]))
            at, context = at[inside], context[inside]
            pairs = [(context, words[at]), totals]
            if often is None:
                return pairs
            passed = [often.value.passes(followed(a, b)) for a, b in pairs]
            return [(a[fits], b[fits]) for (a, b), fits in zip(pairs, passed)]

        often = spark.sparkContext.broadcast(frequent(where, partial(following, 0, None, runs=1), params.follow, size)) if many else None
        enough = F.col("n") >= F.when(F.col("kind") == 1, params.least).otherwise(params.follow)
        done = [cut(_counted(where, partial(following, run, often)).where(enough), "lm-counts") for run in range(runs)]
        if often is not None:
            often.destroy()
        counts = reduce(DataFrame.union, done)
        if depth > 2:
            before = heavy
            own = counts.where("kind = 1").select(F.col("a").alias("c"), F.col("b").alias("s"), F.col("n").alias("total"))
            heavy = cut(heavy.union(own.join(states.select(F.col("c").alias("s")), "s", "left_semi").select("c", "s", "total")).distinct(), "lm-contexts")
            drop(before)
        if heavy.isEmpty():
            drop(heavy, *done, *([where] if depth > 2 else []))
            return
        followers = counts.where("kind = 0").select(F.col("a").alias("c"), F.col("b").alias("x"), "n")
        followers = cut(followers.withColumn("salt", F.pmod(F.xxhash64("x"), F.lit(SALTS)).cast("int")), "lm-pairs")
        shared.destroy()  # what was counted with it is written
        drop(*done)
        own = followers.groupBy("c").agg(F.sum("n").alias("own"))
        # What a state leaves to its suffix: the prior, and its rarer followers' share.
        left = F.col("total") - F.coalesce("own", F.lit(0)) + params.prior
        about = cut(heavy.join(own, "c", "left").withColumn("left", left), "lm-totals")
        few = about.count() <= _FEW
        p = (F.col("n") + F.col("left") * F.exp("below")) / (F.col("total") + params.prior)
        seen = _met(followers, about, few).join(above, ["s", "x"])
        seen = seen.select("c", "s", "salt", "x", "n", F.log(p).alias("lp"), "below", F.log(F.col("left") / (F.col("total") + params.prior)).alias("back"))
        seen = cut(seen, "lm-followers")
        sums = seen.groupBy("c").agg(
            F.count("*").alias("seen"), F.sum(F.exp("lp") * (F.col("lp") - F.col("below"))).alias("gain"), F.sum(F.exp("below")).alias("covered"), F.max("back").alias("back")
        )
        divergence = F.col("gain") + F.exp("back") * (1 - F.col("covered")) * F.col("back")
        chance = F.col("seen") + params.deviations * F.sqrt(2 * F.col("seen"))
        tested = about.join(sums, "c").withColumn("d", divergence).where((F.col("d") >= params.divergence) & (2 * F.col("total") * F.col("d") >= chance))
        states = cut(tested.select("c", "back"), "lm-states")
        if states.isEmpty():
            drop(heavy, followers, about, seen, states, *([where] if depth > 2 else []))
            return
        level = cut(_met(seen, states.select("c"), few).drop("salt"), "lm-level")
        drop(about, seen)
        kept = [*kept, Filter.made(states)]
        above = level.select(F.col("c").alias("s"), "x", F.col("lp").alias("below"))
        yield states, level.drop("s")
        # What does not follow a suffix often enough does not follow the context so.
        open_ = Filter.made(followers.select(_term("c", "x").alias("c")))
        tested_before = None
        if (n := heavy.count()) <= params.terms:
            tested_before = Table(heavy.select("c").toArrow()["c"].to_numpy(), np.zeros(n, bool))
        # What follows a tested context often enough makes a longer one with it.
        ahead = followers.where((F.col("n") >= params.least) & (F.col("x") != _long(END))).join(heavy.select("c", "s"), "c")
        last = F.col("x") if depth == 1 else _ahead("s", "x")
        ahead = cut(ahead.select(_ahead("c", "x").alias("c"), last.alias("s"), F.col("n").alias("total")), "lm-ahead")
        pairs = Filter.made(ahead) if depth == 1 else pairs
        tested = heavy
        heavy = cut(ahead.join(states.select(F.col("c").alias("s")), "s", "left_semi").select("c", "s", "total"), "lm-contexts")
        drop(tested, followers, ahead)
        depth += 1
        if depth == 3:
            # From here on only stretches of frequent pairs are of use, a small part of the texts.
            where = stretches(texts, pairs, packed=True)
            size = where.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
            many = size > _ONE_RUN
            runs = RUNS if many else 1


def _long(key: int) -> Column:
    return F.lit(key - (key >> 63 << 64)).cast("bigint")


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, params: Params = Params()) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    The model learns from the rows whose fold is not 0; rows without a key are
    neither learnt from nor held out.  Null and empty texts are an end alone.
    Repeated rows are learnt from and scored as often as they stand there; other
    columns are left aside, whatever their names; an empty table gives an empty
    result.  Words are told apart by 64-bit hashes.

    A state of a text's contexts gives two terms at each word after it: that of words
    not seen there, and what the word, if seen, has beyond it.  They are log10, and
    add up over the suffixes of the longest state.
    """
    kind = docs.schema[key].dataType.simpleString()
    spark = docs.sparkSession
    texts = encoded(of_texts(docs).select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), fold(key, folds).alias("f")))
    training = texts.where("train").select("w")
    counts = cut(word_counts(training), "lm-words")
    distinct, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    whole = float(total + 0.1 * (distinct + 1))
    log10 = 1 / math.log(10)
    terms, kept, made = None, [], []
    for states, level in levels(training, counts, whole, params):
        made += [states, level]
        kept.append(Filter.made(states))
        own = states.select(F.col("c").alias("z"), (F.col("back") * log10).alias("g"), F.lit(1 << 62).alias("n"))
        own = own.union(level.select(_term("c", "x"), (F.col("lp") - F.col("below") - F.col("back")) * log10, "n"))
        terms = own if terms is None else terms.union(own)
    terms = cut(terms if terms is not None else counts.limit(0).select(F.col("key").alias("z"), F.lit(0.0).alias("g"), "n"), "lm-terms")
    drop(*made)
    words, _ = _commonest(counts.select("key", F.col("n").alias("g"), "n"), params.counted, np.int64)
    held, others = _commonest(terms, params.terms, np.float32)
    shared = spark.sparkContext.broadcast((words, kept, held, None if others is None else Filter.made(others, "z")))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kept, held, rest = shared.value
        for batch, w, starts in _sequences(batches):
            n, place = batch.num_rows, _places(w, starts)
            row = np.repeat(np.arange(n), np.diff(starts))
            inner = place > 0
            found = words.find(w[inner])
            known = found >= 0
            base = np.bincount(row[inner][known], weights=np.log10((words.values[found[known]] + 0.1) / whole), minlength=n).astype(np.float64)
            rare_keys, rare_rows = w[inner][~known], row[inner][~known]
            gain, zs, owners = np.zeros(n), [], []
            at, context = np.flatnonzero(inner), np.zeros(int(inner.sum()), np.uint64)
            for d, states in enumerate(kept, 1):
                within = place[at] >= d
                at, context = at[within], context[within]
                context = longer(context, w[at - d], d)
                inside = states.passes(context)
                at, context = at[inside], context[inside]
                for z in (context, followed(context, w[at])):
                    there = held.find(z)
                    hit = there >= 0
                    gain += np.bincount(row[at[hit]], weights=held.values[there[hit]], minlength=n)
                    if rest is not None:
                        open_ = np.flatnonzero(~hit)
                        open_ = open_[rest.passes(z[open_])]
                        zs.append(z[open_])
                        owners.append(row[at[open_]])
            z, owner = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((zs, np.uint64), (owners, np.int64)))
            order = np.argsort(owner, kind="stable")
            lists = [_lists(rare_keys, rare_rows, n), _lists(z[order], owner[order], n)]
            yield pa.RecordBatch.from_arrays(
                [batch["k"], batch["f"], pa.array(np.diff(starts) - 1), pa.array(np.bincount(row[inner][known], minlength=n).astype(np.int64)), pa.array(base), pa.array(gain), *lists],
                names=["k", "f", "n_tokens", "known", "base", "gain", "keys", "zs"],
            )

    ddl = f"k {kind}, f int, n_tokens bigint, known bigint, base double, gain double, keys array<bigint>, zs array<bigint>"
    got = cut(texts.select("k", "f", "w").mapInArrow(scored, ddl).withColumn("u", F.monotonically_increasing_id()), "lm-scored")
    drop(texts)
    # The words that tasks hold are looked up there; none of the others is common.
    rare = got.select("u", F.explode("keys").alias("key")).join(counts.select("key", "n"), "key", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    more = rare.select("u", F.when(n > 0, 1).otherwise(0).cast("bigint").alias("more_known"), F.log10((n + 0.1) / F.lit(whole)).alias("more_base"), F.lit(0.0).alias("more_gain"))
    if others is not None:
        more = more.union(got.select("u", F.explode("zs").alias("z")).join(others, "z").select("u", F.lit(0).cast("bigint"), F.lit(0.0), "g"))
    sums = more.groupBy("u").agg(*[F.sum(c).alias(c) for c in ("more_known", "more_base", "more_gain")])
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0))
    return got.join(sums, "u", "left").select(
        F.col("k").alias(key),
        (F.col("f") == 0).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("gain") + F.coalesce("more_gain", F.lit(0.0))).alias("score"),
    )


def _commonest(rows: DataFrame, most: int, kind: type) -> tuple[Table, DataFrame | None]:
    """A table of (key, g), of a numeric ``kind``, of the rows (key, g, n) of greatest n, whole classes of n, ``most`` at
    the most; and the other rows, None if there are none."""
    key = rows.columns[0]
    upto = F.sum("m").over(Window.orderBy(F.desc("n")))
    by_count = rows.groupBy("n").agg(F.count("*").alias("m"))
    fits = by_count.withColumn("upto", upto).agg(F.min(F.when(F.col("upto") <= most, F.col("n"))), F.max("upto")).first()
    least, size = fits[0], fits[1] or 0
    held = rows.where(F.col("n") >= least) if least is not None else rows.limit(0)
    got = held.select(key, "g").toArrow()
    table = Table(got[key].to_numpy(), got["g"].to_numpy().astype(kind))
    del got
    pa.default_memory_pool().release_unused()
    return table, None if size <= most else rows.where(F.col("n") < least) if least is not None else rows


def _lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.ListArray:
    """``values`` as one list a row; ``rows`` are sorted."""
    cuts = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(values.view(np.int64)))
