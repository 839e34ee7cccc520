"""Token counts of a sentencepiece BPE model by rank-synchronous merging.

A pre-token (spaces and the word after them) is cut into characters. Distinct new
pre-tokens of a batch are held as one ragged numpy array; in each round every sequence
merges its pair of lowest rank (leftmost among equals), all sequences at the same time,
until none has a pair that is a piece. What survives is counted; a character without a
piece counts its UTF-8 bytes. Counts of pre-tokens are remembered in each Python worker.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
# Remembered pre-tokens per Python worker; when full, remembering starts anew.
CACHE = 400_000
# Longer pre-tokens are merged one by one with a heap: a round for each merge would be
# quadratic there.
LONG = 200


class PieceBpe:
    """Ranks and sizes of the pieces of a BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = [sp.id_to_piece(i) for i in normal]
        score = np.array([sp.get_score(i) for i in normal])
        order = np.lexsort((np.arange(len(score)), -score))
        # Equal scores are equal ranks: then the leftmost pair goes first.
        value = score[order]
        rank = np.concatenate(([0], np.cumsum(value[1:] != value[:-1])))
        self.rank = {pieces[i]: int(r) for i, r in zip(order, rank, strict=True)}
        inner = {c for p in pieces if len(p) > 1 for c in p}
        self.alone = {c for c in "\n\r\t" if c not in inner}
        if any(SPACE in p[1:].lstrip(SPACE) or (p.endswith(SPACE) and p.strip(SPACE)) for p in pieces):
            raise ValueError("a piece has a space after a letter: pre-tokens are not independent")
        self.sym: dict[str, int] = {}  # symbol text -> id
        self.size: list[int] = []  # tokens that a surviving symbol counts
        self.text: list[str] = []
        self.pair: dict[int, tuple[int, int]] = {}  # (left << 32 | right) -> rank, merged id
        self.known: dict[str, int] = {}

    def _id(self, text: str) -> int:
        i = self.sym.get(text)
        if i is None:
            i = self.sym[text] = len(self.text)
            self.text.append(text)
            self.size.append(1 if text in self.rank else len(text.encode("utf-8", "surrogatepass")))
        return i

    def _merge_of(self, key: int) -> tuple[int, int]:
        got = self.pair.get(key)
        if got is None:
            whole = self.text[key >> 32] + self.text[key & 0xFFFFFFFF]
            rank = self.rank.get(whole)
            got = self.pair[key] = (1 << 30, -1) if rank is None else (rank, self._id(whole))
        return got

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, inv = np.unique(left << 32 | right, return_inverse=True)
        got = np.array([self._merge_of(k) for k in keys.tolist()], np.int64).reshape(-1, 2)
        return got[inv, 0], got[inv, 1]

    def count_new(self, pretokens: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        out = np.zeros(len(pretokens), np.int64)
        short = [i for i, p in enumerate(pretokens) if len(p) <= LONG]
        for i, p in enumerate(pretokens):
            if len(p) > LONG:
                out[i] = self._count_long(p)
        if not short:
            return out.tolist()
        ids = np.array([self._id(c) for i in short for c in pretokens[i]], np.int64)
        seq = np.repeat(np.arange(len(short)), [len(pretokens[i]) for i in short])
        done = np.zeros(len(short), np.int64)
        while len(ids):
            inside = np.flatnonzero(seq[1:] == seq[:-1])
            rank, merged = self._ranks(ids[inside], ids[inside + 1])
            best = np.full(len(short), 1 << 30)
            np.minimum.at(best, seq[inside], rank)
            at = np.flatnonzero((rank == best[seq[inside]]) & (rank < 1 << 30))
            at = at[np.unique(seq[inside[at]], return_index=True)[1]]  # the leftmost of each sequence
            active = np.zeros(len(short), bool)
            active[seq[inside[at]]] = True
            rest = ~active[seq]
            size = np.array(self.size)
            done += np.bincount(seq[rest], size[ids[rest]], len(short)).astype(np.int64)
            ids[inside[at]] = merged[at]
            stay = ~rest
            stay[inside[at] + 1] = False
            ids, seq = ids[stay], seq[stay]
        out[short] = done
        return out.tolist()

    def _count_long(self, p: str) -> int:
        ids = [self._id(c) for c in p]
        nxt, prv = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            if i >= 0 and nxt[i] < len(ids):
                rank, new = self._merge_of(ids[i] << 32 | ids[nxt[i]])
                if new >= 0:
                    heapq.heappush(heap, (rank, i, ids[i], ids[nxt[i]]))

        for i in range(len(ids) - 1):
            push(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            if ids[i] != left or nxt[i] >= len(ids) or ids[nxt[i]] != right:
                continue
            j = nxt[i]
            ids[i] = self._merge_of(left << 32 | right)[1]
            ids[j] = -1
            nxt[i] = nxt[j]
            if nxt[i] < len(ids):
                prv[nxt[i]] = i
            push(prv[i])
            push(i)
        return sum(self.size[i] for i in ids if i >= 0)

    def _pretokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the tokens of characters that no piece joins to others."""
        plain = 0
        if not text:
            return [], 0
        text = text.replace(SPACE, " ")  # the model writes spaces that way
        if "\n" in self.alone and "\n" in text:
            lines = text.split("\n")
            plain = len(lines) - 1
        else:
            lines = [text]
        out: list[str] = []
        for k, line in enumerate(lines):
            if k == 0:
                line = " " + line
            if "  " in line or line.endswith(" "):
                out += _PRE.findall(line)
            elif line:
                words = line.split(" ")
                if words[0]:
                    out.append(words[0])
                out += [" " + w for w in words[1:]]
        return out, plain

    def count(self, texts: list[str]) -> list[int]:
        cut = [self._pretokens(t) for t in texts]
        if len(self.known) > CACHE:
            self.known.clear()
        if len(self.pair) > CACHE:
            self.pair.clear()
        new = list(set().union(*(p for p, _ in cut)) - self.known.keys()) if cut else []
        for lo in range(0, len(new), 50_000):
            part = new[lo : lo + 50_000]
            self.known.update(zip(part, self.count_new([p.replace(" ", SPACE) for p in part]), strict=True))
        get = self.known.__getitem__
        return [sum(map(get, p)) + plain for p, plain in cut]


_PRE = re.compile(" *[^ ]+| +")
_models: dict[str, PieceBpe] = {}


def _model(path: str) -> PieceBpe:
    if path not in _models:
        _models[path] = PieceBpe(path)
    return _models[path]


def _map_counts(it: Iterator[pa.RecordBatch], path: str | None, limit: int) -> Iterator[pa.RecordBatch]:
    import public_tokenizers

    model = _model(path or public_tokenizers.path("piece_bpe_32k.model"))
    for batch in it:
        n_bytes, n_tokens, part, size = [], [], [], 0
        for x in batch.column("text"):
            part.append(x.as_py() or "")
            n_bytes.append(len(part[-1].encode("utf-8", "surrogatepass")))
            size += n_bytes[-1]
            if size > 4 << 20:
                n_tokens += model.count(part)
                part, size = [], 0
        n_tokens += model.count(part)
        n = np.array(n_tokens, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n_bytes, pa.int64()), pa.array(n), pa.array(n > limit)],
            ["id", "n_bytes", "n_tokens", "over_limit"],
        )


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None, limit: int = 4096
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Tokens are those of the sentencepiece BPE model at ``model_path`` (default: the public
    piece_bpe_32k.model, found on each executor) without begin and end. A null or empty text
    has 0 of both. Ids may be null or repeated, rows stay as they are, other columns are
    ignored, an empty table gives no rows. The model must add a leading space, normalise
    nothing else and have no piece with a space after a letter.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        lambda it: _map_counts(it, model_path, limit), f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean"
    )
    return out.withColumnRenamed("id", id_col)
