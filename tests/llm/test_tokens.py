"""Token counts and the codec against the tokenizer library."""

import hashlib
import struct
import unicodedata

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from palimpsest.llm.bpe_codec import WordCodec, encode_table
from palimpsest.llm.common import Memo
from palimpsest.llm.merges import MergeTable, byte_letters, merge, merge_short
from palimpsest.llm.token_count import TokenCounter, token_counts

from .conftest import awkward_rows

BYTES, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}
TABLE = MergeTable.from_file(BYTES)
COUNTER, CODEC = TokenCounter(TABLE), WordCodec(MergeTable.from_file(WORDS))
#: Scripts that the library's Unicode tables and Python's agree on.
TEXT = st.text(st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" \n\t ñßÄΣσİ你好😀'.,|<>")), max_size=80)
SPECIAL = st.lists(st.one_of(TEXT, st.sampled_from(["<|endoftext|>", "<|startoftext|>", "don't", "  ", "\n\n"])), max_size=6).map("".join)


def ids(path, text):
    return LIBRARY[path].encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(SPECIAL)
def test_count_equals_library(text):
    assert COUNTER.count(text) == len(ids(BYTES, text))


@settings(max_examples=300, deadline=None)
@given(SPECIAL)
def test_codec_equals_library(text):
    expected = ids(WORDS, text)
    got = CODEC.encode(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == expected
    assert CODEC.decode(got) == LIBRARY[WORDS].decode(expected, skip_special_tokens=False)


MARKS = [chr(c) for c in range(0x110000) if unicodedata.combining(chr(c))]


def test_every_mark_is_ordered_as_the_library_does():
    """Each mark beside marks of higher and lower classes, and beside itself."""
    for mark in MARKS:
        for text in (f"q\u0345{mark}", f"a{mark}\u0334\u0301", f"a\u0301{mark}\u0323e{mark}\u0301"):
            got = CODEC.encode(text)
            assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids(WORDS, text), hex(ord(mark))


def test_every_letter_that_composes_does_as_in_the_library():
    for c in map(chr, range(0x110000)):
        if unicodedata.normalize("NFD", c) != c:
            text = unicodedata.normalize("NFD", c)
            got = CODEC.encode(text)
            assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids(WORDS, text), hex(ord(c))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(MARKS), st.sampled_from("aeoEÅ ñ\u0345\u0334")), max_size=12).map("".join))
def test_runs_of_marks(text):
    got = CODEC.encode(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids(WORDS, text)


@given(st.lists(st.sampled_from(b"abcdeth "), max_size=60))
def test_both_merges_agree(letters):
    first = [COUNTER.first[b] for b in letters]
    merged, n = merge(list(first), COUNTER.ranks)
    whole = [s for s in merged if s >= 0]
    assert whole == merge_short(list(first), TABLE.pairs) and n == len(first) - len(whole)


def test_cuts_stand_where_no_token_crosses():
    letters = byte_letters()
    for word in ("internationalisation", "xqzjkvw", "éñß", "a"):
        raw = word.encode()
        parts = CODEC.cuts(raw)
        assert b"".join(parts) == raw
        place = 0
        for part in parts[:-1]:
            place += len(part)
            pair = letters[raw[place - 1]] + letters[raw[place]] + "</w>" * (place == len(raw) - 1)
            assert not any(pair in t for t in CODEC.token.values() if not t.startswith("<|"))


def test_tables(spark, awkward, nothing, documents):
    for df, rows in ((awkward, awkward_rows()), (documents, [(r.doc_id, r.text) for r in documents.collect()])):
        expected = sorted(repr((r[0], len((r[1] or "").encode()), len(ids(BYTES, r[1] or "")), len(ids(BYTES, r[1] or "")) > 1024)) for r in rows)
        assert sorted(repr(tuple(r)) for r in token_counts(df, BYTES).collect()) == expected
        expected = []
        for r in rows:
            i = ids(WORDS, r[1] or "")
            packed, text = struct.pack(f"<{len(i)}I", *i), LIBRARY[WORDS].decode(i, skip_special_tokens=False)
            expected.append(repr((r[0], len(i), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), packed, text)))
        got = [repr((*tuple(r)[:4], bytes(r.ids), r.decoded)) for r in encode_table(df, WORDS).collect()]
        assert sorted(got) == sorted(expected)
    assert token_counts(nothing, BYTES).count() == encode_table(nothing, WORDS).count() == 0


@pytest.mark.parametrize("limit,over", [(2, True), (3, False)])
def test_limit(spark, limit, over):
    df = spark.createDataFrame([(1, " a b c")], "doc_id bigint, text string")
    row = token_counts(df, BYTES, limit).first()
    assert (row.n_tokens, row.over_limit) == (3, over)


def test_forms_of_a_word_are_encoded_once(monkeypatch):
    """A text is lowered before it is cut, and a word that is a chunk of its own too is held once."""
    codec = WordCodec(MergeTable.from_file(P.path("word_bpe_49k.json")))
    worked = []
    monkeypatch.setattr(codec, "cuts", lambda word, cuts=codec.cuts: worked.append(word) or cuts(word))
    ids = codec.encode("Straßen straßen, STRASSEN STRAßEN")
    assert sorted(worked) == [b",", b"strassen", "straßen".encode()]
    assert codec.decode(ids).split() == codec.decode(codec.encode("straßen straßen , strassen straßen")).split()


def test_a_merge_looks_up_new_neighbours_only():
    """Each pair is looked up once as it comes to be, and a piece that is a chunk of its own too is held once."""

    class Ranks(dict):
        asked = 0

        def get(self, *args):
            self.asked += 1
            return super().get(*args)

    ranks = Ranks(TABLE.ranks)
    symbols = [COUNTER.first[b] for b in b" internationalisationinternationalisation"]
    merges = merge(symbols, ranks)[1]
    assert merges > 25 and ranks.asked <= 41 - 1 + 2 * merges
    counter = TokenCounter(TABLE)
    assert counter.count(" word word word, word") == len(ids(BYTES, " word word word, word"))
    assert sorted(k for memo in vars(counter).values() if isinstance(memo, Memo) for k in memo) == [" word", " word,", ","]
