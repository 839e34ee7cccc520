"""Scores of a log-bilinear language model trained with noise-contrastive estimation.

Counts of all words of the training texts are summed by Spark. All words that occur MIN_COUNT times
are ids of the model, as far as a task's memory goes (HELD_COUNTS), so it grows with the corpus; every
other word has the id of a bucket by its hash, known words and unknown ones alike. Each id has
a context vector r and a target vector q. The two tokens before a position predict
q_w . (c1 * r_a + c2 * r_b) + b_w. Training goes in rounds: each has its own part of the rows, dealt
by a hash of the row into shards, and every shard trains a copy from the last average in numpy
(noise-contrastive estimation); the copies are averaged by their number of tokens, in groups first.
Every position is an example once.

The probability of an id has three levels. The most frequent ids and the classes of the others are
the outputs of the first, the groups of a class those of the second, the ids of a group those
of the third, all log-bilinear in the same context and trained with noise of their own: words drawn
by frequency and shared by a minibatch at the first level, drawn evenly for each token at the others.
The normalisers are exact sums over blocks of tokens, so every token has a normalised log-probability
at about 3 * vocabulary ** (1 / 3) products. A word of a bucket is the bucket times its share of the
bucket's words, add-one smoothed with the exact counts. Counts of the frequent part of them travel
with the task (a table of fixed size), those of the rest are joined.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.language import is_held_out
from feeflow.llm.store import saved, small_batches
from feeflow.llm.text import Texts, give_back, giving_back, texts_of

# Words with an id of their own: those that occur so often, besides bucket 0 (id 0) and the end (1).
MIN_COUNT = 8
DIMENSIONS = 16
# Counts that every task holds; further words are joined.
HELD_COUNTS = 1 << 18
# Buckets of the words without an id of their own.
BUCKETS = 1 << 10
# Ids below HEAD are outputs of the first level.
HEAD = 64
# Rounds of training, each from the last average over a part of the rows of its own; tokens of a
# shard, which one copy trains on in a round; parameters of a piece that is averaged at once, and
# copies that are.
ROUNDS, SHARD_TOKENS, CHUNK, FAN_IN = 2, 1 << 20, 1 << 14, 64
SHARD_PER_WORD = 16  # a shard has at least so many tokens per id of the model
BLOCK = 1024  # tokens that are normalised at once
SCORED_BYTES = 2 << 20  # of texts scored together: the more tokens, the larger the products of a group
BATCH, NOISE_SHARED, NOISE_PER_TOKEN, NOISE_DEEP, RATE = 8192, 32, 16, 2, 0.2
END = np.uint64(0xE4D0F7E4D0F7E4D1)  # the end token's place among word hashes


def tokens(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of every text and an end after each, and where each
    text's begin."""
    start, end, first = t.words()
    h = t.word_hashes(start, end)
    n = len(t)
    out = np.empty(len(h) + n, np.uint64)
    ends = first[1:] + np.arange(n)
    word = np.ones(len(out), bool)
    word[ends] = False
    out[word] = h
    out[ends] = END
    return out, np.concatenate(([0], ends + 1))


def _map_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        parts = [np.unique(tokens(t)[0], return_counts=True) for _, _, t in texts_of(batch.column("text"))]
        if not parts:
            continue
        h, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        c = np.bincount(inv, np.concatenate([p[1] for p in parts])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])


@dataclass
class Vocabulary:
    """Sorted hashes with their counts; ``id`` is the model's id (a bucket's: no own)."""

    h: np.ndarray
    c: np.ndarray
    id: np.ndarray
    own: np.ndarray  # whether the id is the word's own
    unigram: np.ndarray  # probability of each id
    bucket_id: np.ndarray

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash and whether it is there."""
        if not len(self.h):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return at, self.h[at] == h

    def ids(self, h: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        """The model's ids of hashes that were looked up."""
        out = self.bucket_id[(h % np.uint64(len(self.bucket_id))).astype(np.int64)]
        out[there] = self.id[at[there]]
        return out


def own_words(top: pa.Table, size: int | None) -> int:
    """How many words of (h, c), by falling count, have an id of their own; ``size``: of so many
    ids at most besides buckets, or (None) all with MIN_COUNT."""
    c = top.column("c").to_numpy()[top.column("h").to_numpy().astype(np.int64).view(np.uint64) != END]
    return int((c >= MIN_COUNT).sum()) if size is None else min(len(c), size - 2)


def vocabulary(top: pa.Table, total: int, size: int | None, rest: np.ndarray | None = None) -> Vocabulary:
    """From (h, c), hashes and counts by falling count, the number of training tokens, and the tokens
    of every bucket (none: one bucket for all that is left)."""
    h = top.column("h").to_numpy().astype(np.int64).view(np.uint64)
    c = top.column("c").to_numpy().astype(np.int64)
    words = np.flatnonzero(h != END)[: own_words(top, size)]
    if rest is None:
        rest = np.array([max(0, total - c[words].sum() - c[h == END].sum())])
    n = len(rest)
    bucket_id = np.concatenate(([0], 2 + len(words) + np.arange(n - 1)))
    number = bucket_id[(h % np.uint64(n)).astype(np.int64)]
    own = h == END
    own[words] = True
    number[words] = np.arange(2, 2 + len(words))
    number[h == END] = 1
    k = 1 + n + len(words)
    uni = np.bincount(number[own], c[own], k) if len(h) else np.zeros(k)
    uni[bucket_id] = rest
    uni = (uni + 1) / (uni.sum() + k)
    order = np.argsort(h)
    return Vocabulary(h[order], c[order], number[order], own[order], uni, bucket_id)


@dataclass
class Levels:
    """Three levels of k ids. Ids below ``head`` and ``classes`` classes are the first level's outputs,
    the ``size`` groups of a class the second's, the ``size`` ids of a group the third's. Class j has
    row k + j, group j row k + classes + j."""

    k: int

    def __post_init__(self):
        self.head = min(self.k, HEAD)
        rest = self.k - self.head
        self.size = max(1, math.ceil(rest ** (1 / 3)))
        self.groups = -(-rest // self.size)
        self.classes = -(-self.groups // self.size)
        self.first_rows = np.concatenate((np.arange(self.head), self.k + np.arange(self.classes)))

    def path(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first level's output of each id, and its group (of ids from head on)."""
        group = (w - self.head) // self.size
        return np.where(w < self.head, w, self.head + group // self.size), group

    def group_rows(self, j: np.ndarray | int) -> tuple[np.ndarray | int, np.ndarray | int]:
        """First row and the row after the last of the groups of class j."""
        base = self.k + self.classes
        return base + j * self.size, base + np.minimum((j + 1) * self.size, self.groups)

    def id_rows(self, j: np.ndarray | int) -> tuple[np.ndarray | int, np.ndarray | int]:
        """First id and the id after the last of group j."""
        return self.head + j * self.size, np.minimum(self.head + (j + 1) * self.size, self.k)

    def split(self, unigram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the first level's outputs, and of every row given the level above."""
        first, group = self.path(np.arange(self.k))
        one = np.bincount(first, unigram, len(self.first_rows))
        of_group = np.bincount(group[self.head :], unigram[self.head :], self.groups)
        given = unigram.copy()
        given[self.head :] /= of_group[group[self.head :]]
        return one, np.concatenate((given, one[self.head :], of_group / one[self.head + np.arange(self.groups) // self.size]))


def _start(k: int, dim: int, unigram: np.ndarray) -> dict[str, np.ndarray]:
    r = np.random.default_rng(7)
    _, given = Levels(k).split(unigram)
    draw = lambda n: r.normal(0, 0.1, (n, dim)).astype(np.float32)
    return {"r": draw(k), "q": draw(len(given)), "c1": np.ones(dim, np.float32), "c2": np.full(dim, 0.5, np.float32), "b": np.log(given).astype(np.float32)}


def _contexts(ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The id before every token and the one before that (before a text: its end)."""
    one, two = np.empty_like(ids), np.empty_like(ids)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    one[begin[:-1]] = 1
    two[begin[:-1]] = 1
    second = begin[:-1] + 1
    two[second[second < begin[1:]]] = 1
    return one, two


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Trainer:
    """Adagrad on noise-contrastive estimation at all levels, minibatch by minibatch."""

    def __init__(self, unigram: np.ndarray, dim: int = DIMENSIONS, p: dict[str, np.ndarray] | None = None):
        """``p``: parameters to go on from, which are changed in place."""
        self.levels = Levels(len(unigram))
        one, _ = self.levels.split(unigram)
        self.cum_one, self.log_one = np.cumsum(one), np.log(NOISE_PER_TOKEN * one).astype(np.float32)
        self.p = _start(len(unigram), dim, unigram) if p is None else p
        self.g = {k: np.full_like(v, 0.1) for k, v in self.p.items()}
        self.random = np.random.default_rng(11)

    def _step(self, name: str, grad: np.ndarray, where: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> None:
        """Of all parameters of a name, or (``where``, see ``_sums``) of some rows of them."""
        p, g = self.p[name], self.g[name]
        if where is None:
            g += grad**2
            p += RATE * grad / np.sqrt(g)
            return
        order, at, u = where
        total = np.add.reduceat(grad.take(order, 0), at)
        square = g.take(u, 0)
        square += total * total
        g[u] = square
        np.sqrt(square, out=square)
        np.divide(total, square, out=total)
        total *= np.float32(RATE)
        p[u] += total

    @staticmethod
    def _sums(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How to add up gradients by rows: an order, where each row begins in it, and the rows."""
        order = np.argsort(rows.astype(np.int32), kind="stable")
        rows = rows[order]
        at = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        return order, at, rows[at]

    def _deep(self, ctx: np.ndarray, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A lower level for tokens with outputs ``rows`` among lo to hi: gradients of contexts and of
        outputs, and the outputs' rows."""
        p, n = self.p, len(rows)
        noise = lo[:, None] + (self.random.random((n, NOISE_DEEP)) * (hi - lo)[:, None]).astype(np.int64)
        every = np.concatenate((rows[:, None], noise), 1)
        q = p["q"][every]
        x = np.einsum("nkd,nd->nk", q, ctx) + p["b"][every] - np.log(NOISE_DEEP / (hi - lo)).astype(np.float32)[:, None]
        slope = -_sigmoid(x)
        slope[:, 0] += 1
        return np.einsum("nk,nkd->nd", slope, q), (slope[:, :, None] * ctx[:, None, :]).reshape(-1, ctx.shape[1]), slope.ravel(), every.ravel()

    def fit(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> None:
        """One minibatch: a the token before, b the one before that, w the token."""
        p, lv, n = self.p, self.levels, np.float32(len(w))
        ra, rb = p["r"][a], p["r"][b]
        ctx = ra * p["c1"] + rb * p["c2"]
        noise = np.minimum(np.searchsorted(self.cum_one, self.random.random(NOISE_SHARED) * self.cum_one[-1]), len(lv.first_rows) - 1)
        out, group = lv.path(w)
        rows, noise_rows = lv.first_rows[out], lv.first_rows[noise]
        qw, qn = p["q"][rows], p["q"][noise_rows]
        data = 1 - _sigmoid((ctx * qw).sum(1) + p["b"][rows] - self.log_one[out])
        false = -_sigmoid(ctx @ qn.T + p["b"][noise_rows] - self.log_one[noise]) * np.float32(NOISE_PER_TOKEN / NOISE_SHARED)
        d_ctx = data[:, None] * qw + false @ qn
        grad_q, grad_b, where = [data[:, None] * ctx, false.T @ ctx], [data, false.sum(0)], [rows, noise_rows]
        tail = np.flatnonzero(w >= lv.head)
        if len(tail):
            c, group = ctx[tail], group[tail]
            for rows, (lo, hi) in ((lv.k + lv.classes + group, lv.group_rows(group // lv.size)), (w[tail], lv.id_rows(group))):
                d, gq, gb, every = self._deep(c, rows, lo, hi)
                d_ctx[tail] += d
                grad_q.append(gq)
                grad_b.append(gb)
                where.append(every)
        d_ctx /= n
        sums = self._sums(np.concatenate(where))
        self._step("q", np.concatenate(grad_q) / n, sums)
        self._step("b", np.concatenate(grad_b) / n, sums)
        self._step("c1", (d_ctx * ra).sum(0))
        self._step("c2", (d_ctx * rb).sum(0))
        self._step("r", np.concatenate((d_ctx * p["c1"], d_ctx * p["c2"])), self._sums(np.concatenate((a, b))))


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in ("r", "q", "c1", "c2", "b")])


def _unflat(x: np.ndarray, k: int, dim: int) -> dict[str, np.ndarray]:
    levels = Levels(k)
    outputs = k + levels.classes + levels.groups
    r, q, c1, c2, b = np.split(x, np.cumsum([k * dim, outputs * dim, dim, dim]))
    return {"r": r.reshape(k, dim), "q": q.reshape(outputs, dim), "c1": c1, "c2": c2, "b": b}


def _map_ids(it: Iterator[pa.RecordBatch], vocab: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Model ids of every training text, in the place that its row's hash gives it."""
    for batch in it:
        for lo, hi, t in texts_of(batch.column("text")):
            h, begin = tokens(t)
            at, there = vocab.look(h)
            ids = vocab.ids(h, at, there).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(lo, hi - lo), batch.column("shard").slice(lo, hi - lo), ids], ["key", "shard", "ids"])


def _fit_shard(table: pa.Table, unigram: np.ndarray, dim: int, flat: np.ndarray | None) -> pa.Table:
    """One copy, from the last average (``flat``; none yet: the start), after all positions of a
    shard's texts, whatever order they came in."""
    ids = table.column("ids").combine_chunks()
    key = table.column("key").to_numpy()
    length = ids.value_lengths().to_numpy().astype(np.int64)
    crc = np.array([zlib.crc32(x.values.to_numpy()) for x in ids], np.int64)
    order = np.lexsort((crc, length, key))
    begin = np.concatenate(([0], np.cumsum(length[order])))
    ids = ids.take(pa.array(order)).flatten().to_numpy()  # 32 bits each, as the contexts
    trainer = Trainer(unigram, dim, None if flat is None else _unflat(flat.copy(), len(unigram), dim))
    one, two = _contexts(ids, begin)
    for lo in range(0, len(ids), BATCH):
        x = slice(lo, lo + BATCH)
        trainer.fit(*(i[x].astype(np.int64) for i in (one, two, ids)))
    seen, flat = len(ids), trainer.p
    del trainer, ids, one, two  # all but the parameters goes before they are copied
    flat = _flat(flat)
    give_back()
    cuts = range(0, len(flat), CHUNK)
    n = len(cuts)
    return pa.table(
        {
            "lo": pa.array(cuts, pa.int64()), "shard": pa.repeat(pa.scalar(table.column("shard")[0].as_py(), pa.int64()), n),
            "seen": pa.repeat(pa.scalar(seen, pa.int64()), n),
            "x": pa.ListArray.from_arrays(pa.array([*cuts, len(flat)], pa.int32()), pa.array(flat.astype(np.float32, copy=False))),
        }
    )


def _average(table: pa.Table) -> pa.Table:
    """Of one piece of the parameters over a group of copies, by their tokens, in the order of the shards."""
    order = np.argsort(table.column("shard").to_numpy())
    seen = table.column("seen").to_numpy()[order]
    rows = table.column("x").combine_chunks().take(pa.array(order))
    x = rows.flatten().to_numpy().reshape(len(order), -1).astype(float)
    mean = (seen / seen.sum()) @ x
    one = {"lo": table.column("lo")[:1], "shard": table.column("shard").take(pa.array(order[:1])), "seen": pa.array([int(seen.sum())], pa.int64())}
    return pa.table({**one, "x": pa.array([mean.astype(np.float32)], pa.list_(pa.float32()))})


def _averaged(fitted: DataFrame, shards: int) -> pa.Table:
    """The average of all copies, FAN_IN at a time, so that a task never holds more than so many."""
    columns = "lo long, shard long, seen long, x array<float>"
    level = 1
    while True:
        level *= FAN_IN
        fitted = fitted.groupBy("lo", F.floor(F.col("shard") / level)).applyInArrow(_average, columns)
        if level >= shards:
            return saved(fitted, "lm_average").orderBy("lo").toArrow()


def train(training: DataFrame, vocab: Vocabulary, total: int, dim: int, shard_tokens: int = SHARD_TOKENS) -> dict[str, np.ndarray]:
    """Parameters after ROUNDS rounds over ``training`` (key, text) of ``total`` tokens.

    A row's key decides its round and its shard in the round, so neither files nor partitions
    matter. In a round, every shard's copy starts from the last average and trains on all
    positions of its rows; every row belongs to one round."""
    k = len(vocab.unigram)
    flat: np.ndarray | None = None
    shards = max(1, -(-total // (ROUNDS * max(shard_tokens, SHARD_PER_WORD * k))))
    place = F.pmod(F.xxhash64("key"), F.lit(ROUNDS * shards))
    dealt = training.withColumn("round", F.pmod(place, F.lit(ROUNDS))).withColumn("shard", F.floor(place / ROUNDS).cast("long"))
    for at in range(ROUNDS):
        some = dealt.filter(F.col("round") == at).select("key", "shard", "text")
        coded = some.mapInArrow(lambda it: giving_back(_map_ids(it, vocab)), "key long, shard long, ids array<int>")
        fitted = coded.groupBy("shard").applyInArrow(_fitter(vocab.unigram, dim, flat), "lo long, shard long, seen long, x array<float>")
        average = _averaged(fitted, shards)
        if average.num_rows:  # the model's parameters
            flat = average.column("x").combine_chunks().flatten().to_numpy()
    return _start(k, dim, vocab.unigram) if flat is None else _unflat(flat, k, dim)


def _fitter(unigram: np.ndarray, dim: int, flat: np.ndarray | None):
    return lambda table: _fit_shard(table, unigram, dim, flat)


def _normalised(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Column ``at`` of each row of scores, less the log of the sum of the row's exponentials."""
    out = s[np.arange(len(s)), at]
    if s.max() < 500 and out.min() > -500:  # no sum is beyond what a double holds
        return out - np.log(np.exp(s, out=s).sum(1))
    top = s.max(1)
    s -= top[:, None]
    return out - top - np.log(np.exp(s, out=s).sum(1))


class LogBilinear:
    """Normalised log10-probabilities of the vocabulary after two tokens, in double precision: a
    token's doesn't depend on what else is in its block. Parameters stay as they were trained, in
    single precision, until a block needs them: every worker holds them all."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        self.levels = Levels(len(p["r"]))

    def log10(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
        p, lv = self.p, self.levels
        c1, c2 = p["c1"].astype(float), p["c2"].astype(float)
        context = lambda i: p["r"][a[i]] * c1 + p["r"][b[i]] * c2
        out = np.empty(len(w))
        first, group = lv.path(w)
        outputs = lambda rows: (p["q"][rows].astype(float).T, p["b"][rows].astype(float))
        q, bias = outputs(lv.first_rows)
        for lo in range(0, len(w), BLOCK):
            x = slice(lo, lo + BLOCK)
            out[x] = _normalised(context(x) @ q + bias, first[x])
        tail = np.flatnonzero(w >= lv.head)
        tail = tail[np.argsort(w[tail], kind="stable")]
        group = group[tail]
        deep = np.zeros(len(tail))
        second = lv.k + lv.classes + group
        for part, rows, output in ((group // lv.size, lv.group_rows, second), (group, lv.id_rows, w[tail])):
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                begin, end = rows(int(part[lo]))
                q, bias = outputs(slice(begin, end))
                for x in (slice(k, min(k + BLOCK, hi)) for k in range(lo, hi, BLOCK)):
                    deep[x] += _normalised(context(tail[x]) @ q + bias, output[x] - begin)
        out[tail] += deep
        return out / np.log(10)


def _map_scores(it: Iterator[pa.RecordBatch], vocab: Vocabulary, model: LogBilinear, log_bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``log_bucket``: log10 of what the words of each bucket share."""
    log_c = np.log10(vocab.c + 1.0)
    own_word = vocab.own
    for batch in it:
        for lo, hi, t in texts_of(batch.column("text"), SCORED_BYTES):
            h, begin = tokens(t)
            at, there = vocab.look(h)
            ids = vocab.ids(h, at, there)
            own = np.zeros(len(h), bool)
            own[there] = own_word[at[there]]
            shared = np.where(own, 0.0, log_bucket[(h % np.uint64(len(log_bucket))).astype(np.int64)])
            text = np.repeat(np.arange(len(t)), np.diff(begin))
            one, two = _contexts(ids, begin)
            by = lambda w: np.bincount(text, w, len(t))  # noqa: B023, E731
            known = np.where(there, log_c[at] if len(log_c) else 0.0, 0.0)
            rest = np.flatnonzero(~there)
            ends = np.concatenate(([0], np.cumsum(np.bincount(text[rest], minlength=len(t))))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), pa.array(np.diff(begin).astype(np.int64)),
                    pa.array(by(there).astype(np.int64)), pa.array(by(known)), pa.array(by(known * ~own - shared)),
                    pa.array(by(model.log10(one, two, ids))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(h[rest].view(np.int64))),
                ],
                ["id", "held_out", "n_tokens", "n_known", "log_c", "log_share", "log_model", "rest"],
            )


def _buckets(counts: DataFrame, top: pa.Table, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and kinds of the words of every bucket: all but the end and the first ``own`` of ``top``."""
    end = int(END.view(np.int64))
    other = F.col("h") != end
    h, c = top.column("h").to_numpy(), top.column("c").to_numpy()
    if own:
        last = np.flatnonzero(h != end)[own - 1]
        c_last, h_last = F.lit(int(c[last])), F.lit(int(h[last]))
        other &= (F.col("c") < c_last) | ((F.col("c") == c_last) & (F.col("h") > h_last))
    # The hash as an unsigned number, modulo a power of two.
    sums = counts.filter(other).groupBy(F.col("h").bitwiseAND(F.lit(BUCKETS - 1)).alias("at")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    rest, kinds = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for r in sums:  # BUCKETS rows
        rest[r["at"]], kinds[r["at"]] = r["c"], r["v"]
    return rest, kinds


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int | None = None, dim: int = DIMENSIONS, held_counts: int = HELD_COUNTS
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words with A-Z lower-cased and one end per text (a null text has the end
    only). Rows with crc32(id as text; null: empty) mod 7 = 2 are held out, the others train.
    With c the token's count in the N training tokens of V kinds: n_known counts tokens with
    c > 0, base_score sums log10((c + 1) / (N + V + 1)), score sums the log10-probabilities of
    the log-bilinear model; ids of their own have the words with c >= MIN_COUNT among the
    ``held_counts`` most frequent, or the ``size`` - 2 most frequent, all others that of a bucket
    times the word's share of it. Repeated rows train and are scored like any other; without training
    rows all counts are 0. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), is_held_out(id_col, 7, 2).alias("held_out"))
    training = base.filter("not held_out").select(F.xxhash64("id", "text").alias("key"), "text")
    counts = training.mapInArrow(lambda it: giving_back(_map_counts(it)), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    with small_batches(spark):
        counts = saved(counts, "word_counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("c"), "h").limit(held_counts).toArrow()  # of fixed size
    rest, kinds = _buckets(counts, top, own_words(top, size))
    vocab = vocabulary(top, n, size, rest)
    with small_batches(spark):
        model = LogBilinear(train(training, vocab, n, dim))
    log_bucket = np.log10(rest + kinds + 1.0)
    scored = base.mapInArrow(
        lambda it: giving_back(_map_scores(it, vocab, model, log_bucket)),
        f"id {id_type}, held_out boolean, n_tokens long, n_known long, log_c double, log_share double, log_model double, rest array<long>",
    )
    with small_batches(spark):
        scored = saved(scored.withColumn("row", F.monotonically_increasing_id()), "lm_rows")
    out = scored.drop("rest")
    if v > held_counts:
        # Words beyond the held counts: each is rare, so no key is hot.
        rest = scored.select("row", F.explode("rest").alias("h")).join(counts, "h")
        rest = rest.groupBy(F.col("row").alias("rest_row")).agg(F.count("*").alias("more"), F.sum(F.log10(F.col("c") + 1.0)).alias("log_more"))
        out = out.join(rest, F.col("row") == F.col("rest_row"), "left")
    else:
        out = out.withColumns({"more": F.lit(0).cast("long"), "log_more": F.lit(0.0)})
    more, log_more = F.coalesce("more", F.lit(0)), F.coalesce("log_more", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + more).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_c") + log_more - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("log_model") + F.col("log_share") + log_more).alias("score"),
    )
