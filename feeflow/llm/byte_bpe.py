"""Byte-level BPE encoding and decoding of whole texts.

Texts are split by Spark's regular expressions. The words of a batch of texts are numbered
(Arrow), every distinct word of a batch is encoded once, and texts take the tokens of their words by
number: no text leaves its partition. A word that is a token is that token. The others are merged
together, those of about one length as the rows of a matrix: every step joins in each row the
leftmost pair of lowest rank, so all rows have the same number of pieces, and only the two pairs
beside the new piece are looked up again. A token has one pair that can make it, the last one of its
own encoding: while no pair crosses its ends, its bytes are joined as if they stood alone.
Decoding is Spark's: it looks up the bytes of every id and concatenates them.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.text import giving_back

# Words of the texts that are encoded together, about.
GROUP_WORDS = 1 << 22
# Words of the texts that take their tokens together, about.
SLICE_WORDS = 1 << 18
# Longer words are rare and would be merged in quadratic time: their pieces are joined from a heap.
LONG = 256
# Words up to this many bytes share a matrix with those of the same length, longer ones with those of
# the same multiple of it.
WIDTH = 16
# Bytes of words that are merged together, about.
MATRIX_BYTES = 1 << 18
NO_PAIR = np.iinfo(np.int32).max

# Letters and numbers of Unicode 16 that Java 17's classes don't have.
LETTERS = (
    r"\x{870}-\x{887}\x{889}-\x{88e}\x{8b5}\x{8c8}-\x{8c9}\x{c5d}\x{cdd}\x{170d}\x{171f}\x{1b4c}\x{1c89}-\x{1c8a}\x{2c2f}\x{2c5f}"
    r"\x{9ffd}-\x{9fff}\x{a7c0}-\x{a7c1}\x{a7cb}-\x{a7cd}\x{a7d0}-\x{a7d1}\x{a7d3}\x{a7d5}-\x{a7dc}\x{a7f2}-\x{a7f4}\x{10570}-\x{1057a}"
    r"\x{1057c}-\x{1058a}\x{1058c}-\x{10592}\x{10594}-\x{10595}\x{10597}-\x{105a1}\x{105a3}-\x{105b1}\x{105b3}-\x{105b9}"
    r"\x{105bb}-\x{105bc}\x{105c0}-\x{105f3}\x{10780}-\x{10785}\x{10787}-\x{107b0}\x{107b2}-\x{107ba}\x{10d4a}-\x{10d65}"
    r"\x{10d6f}-\x{10d85}\x{10ec2}-\x{10ec4}\x{10f70}-\x{10f81}\x{11071}-\x{11072}\x{11075}\x{1123f}-\x{11240}\x{11380}-\x{11389}"
    r"\x{1138b}\x{1138e}\x{11390}-\x{113b5}\x{113b7}\x{113d1}\x{113d3}\x{11740}-\x{11746}\x{11ab0}-\x{11abf}\x{11bc0}-\x{11be0}"
    r"\x{11f02}\x{11f04}-\x{11f10}\x{11f12}-\x{11f33}\x{12f90}-\x{12ff0}\x{1342f}\x{13441}-\x{13446}\x{13460}-\x{143fa}"
    r"\x{16100}-\x{1611d}\x{16a70}-\x{16abe}\x{16d40}-\x{16d6c}\x{18cff}\x{1aff0}-\x{1aff3}\x{1aff5}-\x{1affb}\x{1affd}-\x{1affe}"
    r"\x{1b11f}-\x{1b122}\x{1b132}\x{1b155}\x{1df00}-\x{1df1e}\x{1df25}-\x{1df2a}\x{1e030}-\x{1e06d}\x{1e290}-\x{1e2ad}"
    r"\x{1e4d0}-\x{1e4eb}\x{1e5d0}-\x{1e5ed}\x{1e5f0}\x{1e7e0}-\x{1e7e6}\x{1e7e8}-\x{1e7eb}\x{1e7ed}-\x{1e7ee}\x{1e7f0}-\x{1e7fe}"
    r"\x{2a6de}-\x{2a6df}\x{2b735}-\x{2b739}\x{2ebf0}-\x{2ee5d}\x{31350}-\x{323af}"
)
NUMBERS = (
    r"\x{10d40}-\x{10d49}\x{116d0}-\x{116e3}\x{11bf0}-\x{11bf9}\x{11f50}-\x{11f59}\x{16130}-\x{16139}\x{16ac0}-\x{16ac9}"
    r"\x{16d70}-\x{16d79}\x{1ccf0}-\x{1ccf9}\x{1d2c0}-\x{1d2d3}\x{1e4f0}-\x{1e4f9}\x{1e5f1}-\x{1e5fa}"
)


def java_pattern(pattern: str) -> str:
    """The tokenizer's pattern for Java: Unicode white space, and classes of the newer Unicode."""
    for name, more in ((r"\p{L}", LETTERS), (r"\p{N}", NUMBERS)):
        # First one range test, so that older characters don't go through all ranges.
        new = rf"[\x{{870}}-\x{{323af}}&&[{more}]]"
        inside = pattern.replace(rf"\s\p{{L}}\p{{N}}", "\x00")
        pattern = inside.replace(name, f"[{name}{new}]").replace("\x00", r"\s\p{L}\p{N}")
    both = rf"[\x{{870}}-\x{{323af}}&&[{LETTERS}{NUMBERS}]]"
    return "(?U)" + pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s\p{{L}}\p{{N}}{both}]")


def ranks_of(path: str | None = None) -> dict[bytes, int]:
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@dataclass
class Merges:
    """Pairs of tokens that make a token, by sorted keys, and the ranks of single bytes and of pairs
    of them. Byte 256 is the padding after a word: it has a rank that no pair has."""

    key: np.ndarray
    rank: np.ndarray
    byte: np.ndarray
    first: np.ndarray

    def look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token of each pair, or NO_PAIR."""
        if not len(self.key):
            return np.full(len(a), NO_PAIR, np.int32)
        key = _pair_key(a, b)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NO_PAIR)


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b


@functools.lru_cache(maxsize=4)
def merges_of(path: str | None) -> Merges:
    ranks = ranks_of(path)
    if not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("the ranks lack single bytes")
    made = []
    for token, rank in ranks.items():
        if len(token) > 1:
            parts = heap_merges(token, ranks, below=rank)
            if len(parts) == 2:  # otherwise the token is found only where it is a word of its own
                made.append((*parts, rank))
    a, b, rank = np.array(made, np.int64).reshape(-1, 3).T
    key = _pair_key(a, b)
    order = np.argsort(key)
    byte = np.array([*(ranks[bytes([b])] for b in range(256)), NO_PAIR], np.int32)
    out = Merges(key[order], rank[order].astype(np.int32), byte, np.zeros(0, np.int32))
    out.first = out.look(np.repeat(byte, 257), np.tile(byte, 257)).reshape(257, 257)
    return out


def matrix_merges(words: np.ndarray, merges: Merges) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of words, a row of bytes each (256 after its end): (rows, their tokens, then NO_PAIR)
    for every number of steps that words take."""
    row = np.arange(len(words))
    piece, rank = merges.byte[words], merges.first[words[:, :-1], words[:, 1:]]
    while rank.shape[1]:
        at = rank.argmin(1)
        least = rank[np.arange(len(row)), at]
        going = least != NO_PAIR
        if not going.all():
            yield row[~going], piece[~going]
            row, piece, rank, at, least = row[going], piece[going], rank[going], at[going], least[going]
        n, each = len(row), np.arange(len(row))
        if not n:
            return
        keep = np.ones(piece.shape, bool)
        keep[each, at + 1] = False
        piece[each, at] = least
        piece = piece[keep].reshape(n, -1)
        rank = rank[keep[:, 1:]].reshape(n, -1)  # without the pair that was joined
        before = np.flatnonzero(at > 0)
        rank[before, at[before] - 1] = merges.look(piece[before, at[before] - 1], least[before])
        after = np.flatnonzero(at < rank.shape[1])
        rank[after, at[after]] = merges.look(least[after], piece[after, at[after] + 1])
    yield row, piece


def heap_merges(word: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[int]:
    """Ids of a word of any length, pairs from a heap by (rank, place); or of what it is joined
    to by ranks ``below`` one."""
    if below is None and word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the piece that begins at each place
    gone = bytearray(n)
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            rank = ranks.get(word[i : end[end[i]]])
            if rank is not None and (below is None or rank < below):
                heapq.heappush(heap, (rank, i, end[end[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, to = heapq.heappop(heap)
        if gone[i] or end[i] >= to or end[end[i]] != to:  # a piece of the pair was joined meanwhile
            continue
        gone[end[i]] = 1
        end[i] = to
        if to < n:
            before[to] = i
        offer(before[i])
        offer(i)
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _tokens_of(words: pa.Array, ranks: dict[bytes, int], tokens: pa.Array, ids: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``words``, word after word, and where each word's begin. ``tokens`` and ``ids`` are
    those of ``ranks``."""
    words = words.cast(pa.binary())
    size = pc.binary_length(words).to_numpy().astype(np.int64)
    off = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw = words.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    whole = pc.fill_null(pc.index_in(words, value_set=tokens), -1).to_numpy()
    count = (whole >= 0).astype(np.int64)
    parts = [(np.flatnonzero(whole >= 0), ids[whole[whole >= 0]][:, None])]
    for i in np.flatnonzero((whole < 0) & (size > LONG)):
        one = np.array([heap_merges(words[int(i)].as_py(), ranks)], np.int32)
        count[i] = one.shape[1]
        parts.append((np.array([i]), one))
    width = np.where(size > WIDTH, -(-size // WIDTH) * WIDTH, size)
    short = np.flatnonzero((whole < 0) & (size <= LONG))
    short = short[np.argsort(width[short], kind="stable")]
    lo = 0
    while lo < len(short):
        w = int(width[short[lo]])
        hi = min(int(np.searchsorted(width[short], w, "right")), lo + max(1, MATRIX_BYTES // max(1, w)))
        some = short[lo:hi]
        inside = np.arange(w) < size[some, None]
        matrix = np.full(inside.shape, 256, np.int16)
        matrix[inside] = data[(off[some, None] + np.arange(w))[inside]]
        for row, piece in matrix_merges(matrix, merges):
            count[some[row]] = (piece != NO_PAIR).sum(1)
            parts.append((some[row], piece))
        lo = hi
    begin = np.concatenate(([0], np.cumsum(count)))
    flat = np.empty(int(begin[-1]), np.int32)
    for row, piece in parts:
        real = piece != NO_PAIR
        flat[(begin[row, None] + np.arange(piece.shape[1]))[real]] = piece[real]
    return flat, begin


def _map_ids(it: Iterator[pa.RecordBatch], path: str | None, merges: Merges, group: int) -> Iterator[pa.RecordBatch]:
    """Ids of every text from its words, those of a group of texts at once."""
    ranks = ranks_of(path)
    tokens, numbers = pa.array(ranks.keys(), pa.binary()), np.fromiter(ranks.values(), np.int32, len(ranks))
    for batch in it:
        lists = batch.column("words")
        end = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        lo = 0
        while lo < len(lists):
            first = lo
            hi = max(lo + 1, int(np.searchsorted(end, end[lo] + group, "right")) - 1)
            code = lists.slice(lo, hi - lo).flatten().dictionary_encode()
            flat, begin = _tokens_of(code.dictionary, ranks, tokens, numbers, merges)
            word, size = code.indices.to_numpy(), np.diff(begin)
            while lo < hi:  # texts take their tokens a few at a time, so that work arrays stay small
                mid = min(hi, max(lo + 1, int(np.searchsorted(end, end[lo] + SLICE_WORDS, "right")) - 1))
                some = word[end[lo] - end[first] : end[mid] - end[first]]
                to = np.concatenate(([0], np.cumsum(size[some])))
                ids = flat[np.arange(to[-1]) + np.repeat(begin[some] - to[:-1], size[some])].astype("<i4", copy=False)
                text = to[end[lo : mid + 1] - end[lo]].astype(np.int32)  # where each text's ids begin
                raw = pa.Array.from_buffers(pa.binary(), mid - lo, [None, pa.py_buffer(4 * text), pa.py_buffer(ids)])
                ids = pa.ListArray.from_arrays(pa.array(text), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, mid - lo), ids, raw], ["id", "ids", "ids_bytes"])
                lo = mid


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None, group_words: int = GROUP_WORDS
) -> DataFrame:
    """One row per row of ``docs``: id, ``ids`` (the token ids of the whole text in order) and
    ``ids_bytes`` (the same as little-endian unsigned 32-bit integers).

    Ids are those of the ranks at ``path`` with ``pattern``, every match on its own, special
    strings being ordinary text. A null text is empty and has no ids; bytes outside all matches
    have none. Repeated rows are encoded like any other, other columns are ignored, an empty
    table gives no rows. ``group_words`` changes no result.
    """
    import public_tokenizers

    merges = merges_of(path)
    id_type = docs.schema[id_col].dataType.simpleString()
    pattern, text = pattern or public_tokenizers.PATTERN, F.coalesce(text_col, F.lit(""))
    split = lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0))
    # The ranges of newer letters cost time in every class; most texts have no character as high as the first.
    found = F.when(text.rlike(r"[\x{870}-\x{10ffff}]"), split(java_pattern(pattern))).otherwise(split("(?U)" + pattern))
    rows = docs.select(F.col(id_col).alias("id"), found.alias("words"))
    out = rows.mapInArrow(lambda it: giving_back(_map_ids(it, path, merges, group_words)), f"id {id_type}, ids array<int>, ids_bytes binary")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (with ``ids``) and its ``decoded`` bytes: the pieces of all ids in order. Ids that
    no piece has make the row's bytes null; null ids too."""
    ranks = ranks_of(path)
    pieces: list[str | None] = [None] * (max(ranks.values()) + 1)
    for k, v in ranks.items():
        pieces[v] = k.decode("latin-1")
    literal = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    found = F.transform("ids", lambda i: F.get(literal, i))
    if None in pieces:
        known = ~F.exists(found, lambda x: x.isNull())
    else:
        known = (F.size("ids") == 0) | ((F.array_min("ids") >= 0) & (F.array_max("ids") < len(pieces)) & (F.size(F.array_compact("ids")) == F.size("ids")))
    whole = F.when(known, F.array_join(found, ""))
    return encoded.withColumn("decoded", F.encode(whole, "ISO-8859-1"))
