"""Operators 2 and 10 against the public libraries."""

import base64
import hashlib
import random
import struct
import time

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from salesflow.llm import bpe_codec, token_counts
from salesflow.llm.bpe import Vocabulary
from salesflow.llm.queries import QUERIES

from . import helpers

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


def long_matches():
    random_ = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return {
        "one letter": "a" * 100_000, "one sign": "=" * 300_001, "any letters": "".join(random_.choice(letters) for _ in range(30_000)),
        "words": "".join(random_.choice(["the", "token", "izer", "ing", "un", "straw", "berry"]) for _ in range(20_000)),
        "digits": "".join(random_.choice("0123456789") for _ in range(10_000)), "han": "".join(chr(random_.randint(0x4E00, 0x9FFF)) for _ in range(4000)),
        "at the bound": "q" * token_counts.LONG, "over it": "q" * (token_counts.LONG + 1), "two": "ab" * 700 + " " + "é" * 3000,
    }


@pytest.mark.parametrize("name", long_matches())
def test_long_matches_by_state_maps(name, monkeypatch):
    text, library = long_matches()[name], Tokenizer.from_file(JSON)
    wanted = len(library.encode(text, add_special_tokens=False).ids)
    assert token_counts.count_tokens([text], JSON) == [wanted]
    began = time.process_time()  # the transitions are compiled now
    assert token_counts.count_tokens([text], JSON) == [wanted]
    assert time.process_time() - began < 1
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)  # the table is dropped between rounds
    monkeypatch.setattr(token_counts, "ENTRIES", 1)
    assert token_counts.count_tokens([text[:6000]], JSON) == [len(library.encode(text[:6000], add_special_tokens=False).ids)]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n, seed):
    random_ = random.Random(seed)
    parts = ["aaaa", "the", "ing", "'re", "'s", " '", "''s", "'r", "'v", "'ll", "'l", "e", "'", " ", "  ", "\n", "1", " ", "é", "的", "😀",
             "<|endoftext|>"]
    out = ["", " ", "a" * 5000, "ab" * 3000, "-" * 999, "\n" * 50 + "x", "it's 'tis we'll o'r 'v"]
    for _ in range(n):
        out.append("".join(random_.choice(parts) for _ in range(random_.randint(0, 80))))
        out.append("".join(chr(x) for _ in range(60) if not 0xD800 <= (x := random_.randint(1, 0x3FFF)) < 0xE000))
    return out


def test_counts_equal_the_library():
    every = texts(300, 1)
    expected = [len(e.ids) for e in Tokenizer.from_file(JSON).encode_batch(every, add_special_tokens=False)]
    assert token_counts.count_tokens(every, JSON) == expected


def test_counts_do_not_depend_on_table_or_chunk_sizes(monkeypatch):
    every = texts(60, 2)
    expected = token_counts.count_tokens(every, JSON)
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "CHUNK", 7)
    monkeypatch.setattr(token_counts, "GROUP", 500)
    assert token_counts.count_tokens(every, JSON) == expected


def test_every_character_counts_as_in_the_library():
    every = ["a" + chr(c) + "1 " + chr(c) * 2 + " x" for c in range(1, 0x3000)]
    expected = [len(e.ids) for e in Tokenizer.from_file(JSON).encode_batch(every, add_special_tokens=False)]
    assert token_counts.count_tokens(every, JSON) == expected


def test_codec_equals_the_library_and_round_trips(library):
    for text in texts(300, 3):
        ids = bpe_codec.encode(text, RANKS)
        assert ids == library.encode_ordinary(text)
        assert bpe_codec.decode(ids, RANKS) == text.encode()


def test_join_is_associative_and_equals_the_whole(library):
    vocabulary = Vocabulary.from_ranks(RANKS)
    random_ = random.Random(4)
    for _ in range(300):
        data = [bytes(random_.choice(b"aabth e\xc3\xa9") for _ in range(random_.randint(0, 40))) for _ in range(3)]
        a, b, c = (vocabulary.merge(x) for x in data)
        join = lambda x, y: bpe_codec.join(vocabulary, x, y)
        assert join(join(a, b), c) == join(a, join(b, c)) == vocabulary.merge(b"".join(data))
        assert bpe_codec.encode_tree(vocabulary, b"".join(data)) == vocabulary.merge(b"".join(data))


def test_segments_do_not_change_results(monkeypatch, library):
    from salesflow.llm import common

    text = " ".join(texts(5, 5))
    monkeypatch.setattr(common.segments, "__defaults__", (64,))
    assert sum(map(len, common.segments(text))) == len(text)
    assert [x for s in common.segments(text) for x in bpe_codec.encode(s, RANKS)] == library.encode_ordinary(text)
    expected = len(Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids)
    assert token_counts.count_tokens([text], JSON) == [expected]


def test_queries_on_whole_tables(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    counts = Tokenizer.from_file(JSON)
    for r in QUERIES["op2_token_count"](spark, SF).collect():
        n = len(counts.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)
    found = QUERIES["op10_byte_bpe"](spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == helpers.sha(docs[r.doc_id])


def test_edge_rows(spark, library):
    counted = token_counts.token_counts(helpers.edges(spark), JSON)
    assert counted.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = helpers.rows(counted, "doc_id", "n_bytes")
    assert got == sorted(((i, len((t or "").encode())) for i, t, *_ in helpers.EDGES), key=str)
    coded = bpe_codec.codec_digests(helpers.edges(spark), RANKS)
    expected = [(i, len(library.encode_ordinary(t or "")), helpers.sha(t or "")) for i, t, *_ in helpers.EDGES]
    assert helpers.rows(coded, "doc_id", "n_tokens", "decoded_sha256") == sorted(expected, key=str)
    ids = bpe_codec.encode_documents(helpers.edges(spark), RANKS).where("doc_id = 6").first().ids
    assert ids == library.encode_ordinary("é😀的" * 100)
    assert token_counts.token_counts(helpers.empty(spark), JSON).count() == 0
    assert bpe_codec.codec_digests(helpers.empty(spark), RANKS).count() == 0
