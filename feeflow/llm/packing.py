"""Best-fit packing of token sequences by a configuration linear program.

Pieces of a text's tokens fill sequences of fixed capacity. What matters is only how many
pieces there are of each length, so the program works on that histogram (at most
``capacity`` numbers, whatever the input): a variable per configuration (a multiset of
lengths that fits a sequence), a constraint per length. Multiplicative weights keep a price
for every length; each step the best configuration for the prices is found by a knapsack
dynamic program over the capacity, used, and the prices of what it holds fall. The
fractional solution is rounded down; the few pieces left over go best-fit into open
sequences, longest first. Spark numbers the pieces of each length and looks up the place
of each number.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.store import saved, small_batches
from feeflow.llm.text import Texts, giving_back, texts_of

# Remembered words (white-space separated parts of texts) per Python worker, about, and the slots that
# they are looked up in: a table that grew to four times as many took 75 MB more.
CACHE = 1_000_000
SLOTS = 1 << 21
# Words that the tokenizer encodes at once: its results are large.
ENCODED = 4000
# Texts whose words are looked up together: work arrays take some 40 times as much.
SLICE = 1 << 19
# Multiplicative weights: sweeps over the lengths, configurations between two runs of the
# dynamic program, and how fast a price falls.
SWEEPS, PRICED, ETA = 12, 64, 4.0


# --- tokens ----------------------------------------------------------------------------


class _WordIds:
    """Token ids of texts whose tokenizer works within white-space separated words.

    Words are cut at ASCII white space and looked up by a 64-bit hash in an open table, the hash
    checked against length, first and last 8 bytes; only words that aren't there are encoded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self._reset()

    def _reset(self) -> None:
        self.slot_hash, self.slot_word = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32)
        # Room for all words to remember: memory is taken as it is filled, and what is there isn't copied.
        room = CACHE * 5 // 4
        self.marks = np.empty((room, 3), np.uint64)  # length, first and last bytes of each word
        self.hashes = np.empty(room, np.uint64)
        self.begin = np.zeros(room, np.int64)  # ids of word k: flat[begin[k]:begin[k + 1]]
        self.flat = np.empty(4 * room, np.uint32)
        self.known = 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The word of each hash, -1 if it isn't there."""
        mask = np.uint64(len(self.slot_hash) - 1)
        slot = (h & mask).astype(np.int64)
        at = self.slot_hash[slot]
        out = np.where(at == h, self.slot_word[slot], -1)
        todo = np.flatnonzero((at != h) & (at != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & int(mask)
            at = self.slot_hash[slot[todo]]
            hit = at == h[todo]
            out[todo[hit]] = self.slot_word[slot[todo[hit]]]
            todo = todo[~hit & (at != 0)]
        return out

    def _put(self, h: np.ndarray, first: int) -> None:
        """Slots for distinct new hashes, words ``first`` and up."""
        slot = (h & np.uint64(len(self.slot_hash) - 1)).astype(np.int64)
        todo = np.arange(len(h))
        while len(todo):
            _, one = np.unique(slot[todo], return_index=True)
            one = todo[one]
            one = one[self.slot_hash[slot[one]] == 0]
            self.slot_hash[slot[one]], self.slot_word[slot[one]] = h[one], first + one
            todo = todo[self.slot_hash[slot[todo]] != h[todo]]
            slot[todo] = (slot[todo] + 1) & (len(self.slot_hash) - 1)

    def _learn(self, h: np.ndarray, marks: np.ndarray, words: list[str]) -> None:
        first = self.known
        self.hashes, self.marks = _appended(self.hashes, first, h), _appended(self.marks, first, marks)
        for lo in range(0, len(words), ENCODED):
            got = self._encoded(words[lo : lo + ENCODED])
            used = int(self.begin[self.known])
            ends = used + np.cumsum([len(g) for g in got])
            self.begin = _appended(self.begin, self.known + 1, ends)
            self.flat = _appended(self.flat, used, np.fromiter(chain.from_iterable(got), np.uint32, int(ends[-1]) - used))
            self.known += len(got)
        if 2 * self.known > len(self.slot_hash):  # a larger table, from all words
            slots = 1 << (2 * self.known).bit_length()
            self.slot_hash, self.slot_word = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
            self._put(self.hashes[: self.known], 0)
        else:
            self._put(h, first)

    def _encoded(self, words: list[str]) -> list[list[int]]:
        return [e.ids for lo in range(0, len(words), ENCODED) for e in self.tok.encode_batch(words[lo : lo + ENCODED], add_special_tokens=False)]

    def ids(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and where each text's begin."""
        if self.known > CACHE:
            self._reset()
        start, end, first = t.words()
        t = Texts(_folded(t, start, end), t.off)
        h = np.maximum(t.word_hashes(start, end, lower=False), 1)
        marks = _marks(t.buf, start, end)
        num = self._find(h)
        new = np.flatnonzero(num < 0)
        if len(new):
            _, one = np.unique(h[new], return_index=True)
            one = new[one]
            raw = t.buf.tobytes()
            self._learn(h[one], marks[one], [raw[a:b].decode() for a, b in zip(start[one].tolist(), end[one].tolist(), strict=True)])
            num[new] = self._find(h[new])
        other = np.flatnonzero((self.marks[num] != marks).any(1)) if len(num) else num
        size = self.begin[num + 1] - self.begin[num]
        begin, flat = self.begin[num], self.flat
        if len(other):  # another word with the same hash
            got = self._encoded([t.buf[start[i] : end[i]].tobytes().decode() for i in other])
            size[other] = [len(g) for g in got]
            flat = flat[: self.begin[self.known]]
            begin[other] = len(flat) + np.cumsum(size[other]) - size[other]
            flat = np.concatenate((flat, np.array([i for g in got for i in g], np.uint32)))
        total = np.concatenate(([0], np.cumsum(size)))
        out = flat[np.arange(total[-1]) + np.repeat(begin - total[:-1], size)]
        return out, total[first]


def _appended(a: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``a`` with ``more`` from row ``at`` on: in place as long as there is room."""
    if at + len(more) > len(a):
        a = np.concatenate((a[:at], np.empty((max(len(more), len(a)), *a.shape[1:]), a.dtype)))
    a[at : at + len(more)] = more
    return a


def _folded(t: Texts, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case, which the tokenizer does anyway and which makes fewer words.
    Not in words beyond ASCII, where a mark may join a letter first, nor near special tokens, which
    are those written in lower case only."""
    if t.buf.tobytes().find(b"<|") >= 0:
        return t.buf
    buf = np.where((t.buf >= 65) & (t.buf <= 90), t.buf + np.uint8(32), t.buf)
    if len(start):
        above = np.concatenate(([0], np.cumsum(t.buf >= 128, dtype=np.int64)))
        odd = np.flatnonzero(above[end] > above[start])
        size = end[odd] - start[odd]
        to = np.cumsum(size)
        at = np.arange(int(to[-1]) if len(to) else 0) + np.repeat(start[odd] - (to - size), size)
        buf[at] = t.buf[at]
    return buf


def _marks(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Length, first and last 8 bytes of each word: all of it, up to 16 bytes."""
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))
    size = end - start
    n = np.minimum(size, 8)
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)[n]
    return np.stack((size.astype(np.uint64), eight[start] & mask, eight[end - n] & mask), 1)


_tokenizers: dict[str, _WordIds] = {}


def _map_pieces(it: Iterator[pa.RecordBatch], path: str | None, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    import public_tokenizers

    path = path or public_tokenizers.path("word_bpe_49k.json")
    if path not in _tokenizers:
        _tokenizers[path] = _WordIds(path)
    words = _tokenizers[path]
    for batch in it:
        for lo, _, t in texts_of(batch.column("text"), SLICE):
            flat, begin = words.ids(t)
            n = len(t)
            begin = begin + np.arange(n + 1)  # with the end id of each text
            ids = np.full(len(flat) + n, end_id, "<u4")
            ids[np.delete(np.arange(len(ids)), begin[1:] - 1)] = flat
            size = np.diff(begin)
            pieces = -(-size // capacity)
            text = np.repeat(np.arange(n), pieces)
            piece = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(size[text] - start, capacity)
            raw, at = memoryview(ids.tobytes()), 4 * (begin[text] + start)
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(text + lo)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                ["id", "piece", "start", "length", "ids_crc32"],
            )


# --- the linear program on the histogram -------------------------------------------------


def knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """For every capacity c up to ``capacity`` the index of a length in a set of largest total
    price that fits c, -2 if that of c - 1 is as good, -1 if nothing fits."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    size, price = lengths[price > 0], price[price > 0]
    index = np.flatnonzero(np.isin(lengths, size))
    if not len(size):
        return last
    for c in range(int(size[0]), capacity + 1):
        k = int(np.searchsorted(size, c, "right"))
        value = best[c - size[:k]] + price[:k]
        j = k - 1 - int(value[::-1].argmax())  # among equals the longest
        if value[j] > best[c - 1]:
            best[c], last[c] = value[j], index[j]
        else:
            best[c], last[c] = best[c - 1], -2
    return last


def _traced(last: np.ndarray, lengths: np.ndarray, c: int) -> dict[int, int]:
    """How often each length (by index) is in the best set for capacity c."""
    out: dict[int, int] = {}
    while last[c] != -1:
        if last[c] == -2:
            c -= 1
        else:
            j = int(last[c])
            out[j] = out.get(j, 0) + 1
            c -= int(lengths[j])
    return out


def fractional(lengths: np.ndarray, count: np.ndarray, capacity: int, sweeps: int = SWEEPS) -> dict[tuple[tuple[int, int], ...], float]:
    """Configurations ((index of length, pieces), ...) and how often each is used, covering
    ``count`` exactly, by multiplicative weights.

    A sweep covers the same fraction of every length. The price of a length is its size times
    a weight that falls exponentially with the part of it that is covered ahead of the sweep, and
    is 0 when none is left. For each length behind, longest first, the dynamic program's best
    set for the rest of the capacity completes the configuration; it runs anew whenever a
    length in the set has run out or PRICED configurations have used its prices."""
    covered = np.zeros(len(lengths))
    out: dict[tuple[tuple[int, int], ...], float] = {}
    count = count.astype(float)
    for sweep in range(1, sweeps + 1):
        goal = sweep / sweeps
        last, used = None, 0
        for j in np.argsort(-lengths):
            while covered[j] < goal * count[j] - 1e-9:
                if last is None or used >= PRICED:
                    ahead = np.maximum(0, covered / count - goal + 1 / sweeps)
                    price = np.where(count - covered > 1e-9, lengths * np.exp(-ETA * ahead), 0.0)
                    last, used = knapsack(price, lengths, capacity), 0
                config = _traced(last, lengths, capacity - int(lengths[j]))
                config[int(j)] = config.get(int(j), 0) + 1
                at = np.array(list(config), np.int64)
                each = np.array(list(config.values()), np.float64)
                often = ((count[at] - covered[at]) / each).min()
                if often <= 1e-9:  # something ran out: price anew without it
                    if used == 0:
                        config = {int(j): 1}
                        at, each = np.array([j]), np.ones(1)
                        often = count[j] - covered[j]
                    else:
                        last = None
                        continue
                often = min(often, (goal * count[j] - covered[j]) / config[int(j)])
                covered[at] += often * each
                key = tuple(sorted(config.items()))
                out[key] = out.get(key, 0.0) + float(often)
                used += 1
    return out


def plan(lengths: np.ndarray, count: np.ndarray, capacity: int, sweeps: int = SWEEPS) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how many sequences, [(length, pieces of it in each)]) for a whole histogram.

    The fractional solution is rounded down; what is left over, at most a few pieces per
    configuration, goes best-fit into the room that is left and into new sequences."""
    left = count.astype(np.int64).copy()
    whole: list[tuple[int, list[tuple[int, int]]]] = []
    for config, often in fractional(lengths, count, capacity, sweeps).items():
        n = int(often + 1e-6)
        if n > 0:
            for j, each in config:
                left[j] -= n * each
            whole.append((n, [(int(lengths[j]), each) for j, each in config]))
    return _best_fit(lengths, left, capacity, whole)


def _best_fit(
    lengths: np.ndarray, count: np.ndarray, capacity: int, whole: list[tuple[int, list[tuple[int, int]]]]
) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit, longest first, of whole classes: open sequences of equal content are one class.

    ``whole`` are sequences begun already. All pieces of a length go to the fullest classes that they fit; a class is split where
    they run out. Work depends on the number of classes, not of pieces."""
    free: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}
    for many, content in whole:
        free.setdefault(capacity - sum(size * each for size, each in content), []).append((many, tuple(content)))
    for j in np.argsort(-lengths):
        size, n = int(lengths[j]), int(count[j])
        added: list[tuple[int, int, tuple]] = []
        while n > 0:
            room = min((r for r, c in free.items() if r >= size and c), default=None)
            if room is None:
                each = capacity // size
                if n >= each:
                    added.append((capacity - each * size, n // each, ((size, each),)))
                if n % each:
                    added.append((capacity - (n % each) * size, 1, ((size, n % each),)))
                break
            many, content = free[room].pop()
            each = min(room // size, n)
            use = min(many, n // each)
            if many > use:
                free[room].append((many - use, content))
            added.append((room - each * size, use, (*content, (size, each))))
            n -= use * each
        for room, many, content in added:
            free.setdefault(room, []).append((many, content))
    return [(many, list(content)) for classes in free.values() for many, content in classes]


# --- places of pieces ----------------------------------------------------------------------


def _places(configs: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first number, pieces per sequence, first sequence, offset of each block."""
    by: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for n, content in configs:
        offset = 0
        for size, each in content:
            by.setdefault(size, []).append((used.get(size, 0), each, sequence, offset))
            used[size] = used.get(size, 0) + n * each
            offset += size * each
        sequence += n
    return {size: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for size, rows in by.items()}


def _map_places(it: Iterator[pa.RecordBatch], places, first) -> Iterator[pa.RecordBatch]:
    for batch in it:
        length = batch.column("length").to_numpy()
        number = batch.column("number").to_numpy()
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for size in np.unique(length):
            at = np.flatnonzero(length == size)
            begin, each, seq, off = places[int(size)]
            j = number[at] - first[int(size)]
            b = np.searchsorted(begin, j, "right") - 1
            k = j - begin[b]
            sequence[at] = seq[b] + k // each[b]
            offset[at] = off[b] + k % each[b] * size
        keep = [batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
    tokenizer_path: str | None = None, end_id: int = 0, sweeps: int = SWEEPS,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A text's tokens are its ids by the tokenizer (default: the public word_bpe_49k.json, found
    on each executor) without special ones, then ``end_id``; null is an empty text. Texts longer
    than ``capacity`` are cut into pieces of that many tokens, the last may be shorter; no
    other text is cut. Pieces share sequences of at most ``capacity`` tokens without gaps.
    The tokenizer must work within white-space separated words. Rows with repeated or null ids
    are packed like any other; rows stay rows. Other columns are ignored; an empty table gives
    no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    cols = f"id {id_type}, piece int, start long, length long, ids_crc32 long"
    pieces = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        lambda it: giving_back(_map_pieces(it, tokenizer_path, capacity, end_id)), cols
    )
    # Sorted by length into written parts: a piece's number is its place in its part plus the
    # sizes of the parts before. A length that most pieces have spreads over many parts.
    with small_batches(spark):
        pieces = saved(pieces, "pieces")
    ordered = saved(
        pieces.orderBy("length", "id", "piece", "ids_crc32").withColumn("row", F.monotonically_increasing_id()), "ordered_pieces"
    )
    part = F.shiftright("row", 33).alias("part")
    sizes = ordered.groupBy(part, "length").count().orderBy("part", "length").collect()  # parts + lengths rows at most
    histogram: dict[int, int] = {}
    offsets: dict[int, int] = {}
    total = 0
    for r in sizes:
        offsets.setdefault(r["part"], total)
        total += r["count"]
        histogram[r["length"]] = histogram.get(r["length"], 0) + r["count"]
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], np.int64)
    first = dict(zip(lengths.tolist(), (np.cumsum(counts) - counts).tolist(), strict=True))
    places = _places(plan(lengths, counts, capacity, sweeps)) if len(lengths) else {}
    offset = spark.createDataFrame(list(offsets.items()), "part long, before long")  # a row per part
    numbered = ordered.withColumn("part", F.shiftright("row", 33)).join(F.broadcast(offset), "part")
    numbered = numbered.withColumn("number", F.col("before") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1)))
    out = numbered.select("id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        lambda it: _map_places(it, places, first), cols + ", sequence_id long, offset long"
    )
    return out.withColumnRenamed("id", id_col)
