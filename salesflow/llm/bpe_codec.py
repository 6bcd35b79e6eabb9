"""Operator 10, byte-level BPE encoding and decoding by monoid tree reduction.

Encoded stretches of one pattern match form a monoid: joining two of them re-encodes a window around the boundary,
which grows on either side until the tokens beyond it provably stay (they can be neighbours of the window's outer
tokens, see bpe.py). A match is halved down to leaves of a few bytes, and encoded by joining up the tree. Decoding
concatenates the bytes of tokens up the same kind of tree.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import regex
from pyspark.sql import DataFrame

from .bpe import Vocabulary
from .common import map_texts, segments

#: The pattern that splits text before the merges: a fixed value, as published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of a leaf, which the merge process encodes directly.
LEAF = 16
#: Ids that one leaf of decoding concatenates.
DECODE_LEAF = 1 << 16
#: Matches whose ids a worker remembers; beyond this many it forgets them and encodes them again.
MEMO = 300_000


def join(vocabulary: Vocabulary, left: list[int], right: list[int]) -> list[int]:
    """The encoding of the bytes of `left` and `right` together, of the encodings of each."""
    if not left or not right:
        return left or right
    tokens, ok = vocabulary.token_bytes, vocabulary.pair_ok
    i = j = 1
    while True:
        window = vocabulary.merge(b"".join(tokens[x] for x in left[-i:] + right[:j]))
        fits_left = i >= len(left) or ok(left[-i - 1], window[0])
        fits_right = j >= len(right) or ok(window[-1], right[j])
        if fits_left and fits_right:
            return left[:-i] + window + right[j:]
        i, j = (i if fits_left else min(2 * i, len(left))), (j if fits_right else min(2 * j, len(right)))


def encode_tree(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """The merge process over some bytes, by halves; cuts are at multiples of powers of two, so that runs of one
    byte are cut between like tokens."""
    if len(data) <= LEAF:
        return vocabulary.merge(data)
    cut = 1 << ((len(data) - 1).bit_length() - 1)
    return join(vocabulary, encode_tree(vocabulary, data[:cut]), encode_tree(vocabulary, data[cut:]))


def encode_match(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """Ids of one match of the pattern: the token with these very bytes, if there is one, else their encoding."""
    whole = vocabulary.ids.get(data)
    return encode_tree(vocabulary, data) if whole is None else [whole]


def decode_tree(token_bytes: list[bytes], ids: list[int]) -> bytes:
    if len(ids) <= DECODE_LEAF:
        return b"".join(map(token_bytes.__getitem__, ids))
    half = len(ids) // 2
    return decode_tree(token_bytes, ids[:half]) + decode_tree(token_bytes, ids[half:])


class Packed(dict):
    """Ids of matches as little-endian 32-bit integers; encodes those it lacks."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, match: str) -> bytes:
        made = np.array(encode_match(self.vocabulary, match.encode()), "<u4").tobytes()
        if len(match) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[match] = made
        return made


@functools.cache
def codec(path: str, pattern: str) -> tuple[Packed, regex.Pattern]:
    """One for each worker process, kept between its tasks."""
    return Packed(Vocabulary.from_ranks(path)), regex.compile(pattern)


def encode(text: str, path: str, pattern: str = PATTERN) -> list[int]:
    packed, matcher = codec(path, pattern)
    return np.frombuffer(b"".join(map(packed.__getitem__, matcher.findall(text))), "<u4").tolist()


def decode(ids: list[int], path: str, pattern: str = PATTERN) -> bytes:
    return decode_tree(codec(path, pattern)[0].vocabulary.token_bytes, ids)


def _batches(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, fields: str, finish) -> DataFrame:
    def prepare():
        packed, matcher = codec(path, pattern)
        tokens = packed.vocabulary.token_bytes

        def work(texts: list[str]) -> dict:
            out: dict[str, list] = {f.split()[0]: [] for f in fields.split(", ")}
            for text in texts:
                parts = (b"".join(map(packed.__getitem__, matcher.findall(x))) for x in segments(text))
                for name, value in zip(out, finish(parts, tokens)):
                    out[name].append(value)
            return out

        return work

    return map_texts(docs, id_col, text_col, fields, prepare)


def encode_documents(docs: DataFrame, path: str, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text; one row per input row, an empty array for null and empty texts."""

    def finish(parts, tokens):
        return (np.frombuffer(b"".join(parts), "<u4").astype(np.int32),)

    return _batches(docs, path, pattern, id_col, text_col, "ids array<int>", finish)


def codec_digests(docs: DataFrame, path: str, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every whole text and decodes the ids; one row per input row.

    Columns: the id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers) and decoded_sha256
    (of the decoded bytes). Null and empty texts have no ids and the digests of nothing; null and repeated ids stay
    rows of their own; other columns are not read, so their names can't clash. `path` has to be readable by the
    executors.
    """

    def finish(parts, tokens):
        n, ids_hash, decoded_hash = 0, hashlib.sha256(), hashlib.sha256()
        for packed in parts:
            n += len(packed) // 4
            ids_hash.update(packed)
            decoded_hash.update(decode_tree(tokens, np.frombuffer(packed, "<u4").tolist()))
        return n, ids_hash.hexdigest(), decoded_hash.hexdigest()

    return _batches(docs, path, pattern, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", finish)
