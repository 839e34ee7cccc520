"""Language ID of mixed-language texts: script ranges, per-word scores, Viterbi.

The script of a word (code point ranges) narrows its candidates to the languages that use
the script in the training texts. A naive Bayes score over the character n-grams of the word
is kept for each candidate; over the words of a text a Viterbi path maximises the sum of
scores minus a penalty for every switch of language, so a text is labelled in spans. The
language with most labelled letters is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.store import checked_broadcast, saved
from feeflow.llm.text import giving_back

# Texts per language that the model learns from, about (a fraction of the language's texts
# chosen by a hash of their ids). The model converges long before.
TRAIN_DOCS = 1500
BUCKETS = 1 << 15
N_GRAMS = (1, 2, 3, 4)
SWITCH = 12.0
# A language is a candidate for a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.002
CACHE = 200_000
# Characters of the texts that are labelled together, about: their words are Python strings.
SLICE_CHARS = 2 << 20

# First code point of script blocks (the standard's block starts, merged), and
# the script that begins there.
SCRIPT_STARTS = [0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0900, 0x0980, 0x0E00, 0x0E80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x3100, 0x4E00, 0xA000, 0xAC00, 0xD7B0, 0xFB50, 0xFE70, 0xFF00, 0x20000]
SCRIPT_NAMES = ["latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari", "indic", "thai", "other", "georgian", "hangul", "other", "latin", "greek", "other", "kana", "other", "han", "other", "hangul", "other", "arabic", "arabic", "other", "han"]
SCRIPTS = sorted(set(SCRIPT_NAMES))
_STARTS = np.array(SCRIPT_STARTS)
_NUMBER = np.array([SCRIPTS.index(n) for n in SCRIPT_NAMES])


def is_held_out(id_col: str, mod: int = 4, rest: int = 2):
    """crc32 of the id as text (null: empty), modulo ``mod``, equals ``rest``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod == rest


def letters(word: str) -> str:
    """The letters of a word, lower-cased."""
    return word.lower() if word.isalpha() else "".join(c for c in word.lower() if c.isalpha())


def script_of(word: str) -> int:
    """Number of the script of most letters (the first such)."""
    code = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
    return int(np.bincount(_NUMBER[np.searchsorted(_STARTS, code, "right") - 1]).argmax())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words (with both ends marked), and the word of each."""
    padded = ["<" + w + ">" for w in words]
    size = np.array([len(p) for p in padded], np.int64)
    code = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), size)
    all_b, all_w = [], []
    for n in N_GRAMS:
        if len(code) < n:
            continue
        h = np.full(len(code) - n + 1, n, np.uint64)
        for j in range(n):
            h = (h ^ code[j : len(code) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        ok = word[: len(h)] == word[n - 1 :]
        all_b.append((h[ok] % np.uint64(BUCKETS)).astype(np.int64))
        all_w.append(word[: len(h)][ok])
    return np.concatenate(all_b), np.concatenate(all_w)


def _train_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, kind (0 n-gram bucket, 1 script), key, c."""
    for batch in it:
        total: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = [w for w in map(letters, text.split()) if w]
            if not words:
                continue
            grams, scripts = total.setdefault(lang, [np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPTS), np.int64)])
            grams += np.bincount(features(words)[0], minlength=BUCKETS)
            code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
            scripts += np.bincount(_NUMBER[np.searchsorted(_STARTS, code, "right") - 1], minlength=len(SCRIPTS))
        for lang, counts in total.items():
            for kind, c in enumerate(counts):
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(np.full(len(at), kind, np.int32)), pa.array(at), pa.array(c[at])],
                    ["lang", "kind", "key", "c"],
                )


class LanguageModel:
    """Scores of n-gram buckets per language, and the languages of each script."""

    def __init__(self, langs: list[str], grams: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        smooth = grams + 0.5
        log = np.log(smooth / smooth.sum(1, keepdims=True))
        self.score = (log - log.mean(0)).T.astype(np.float32) if len(langs) else np.zeros((BUCKETS, 0), np.float32)
        uses = scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(1, keepdims=True))
        self.uses = uses.T if len(langs) else np.zeros((len(SCRIPTS), 0), bool)  # script x language

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row per word: per language the mean over n-gram lengths; far below for languages
        that don't use the word's script, unless none does."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        bucket, word = features(words)
        np.add.at(out, word, self.score[bucket]) if len(words) < 64 else self._add(out, word, bucket)
        out /= len(N_GRAMS)
        uses = self.uses[[script_of(w) for w in words]] if words else self.uses[:0]
        out[~uses & uses.any(1, keepdims=True)] -= 50
        out[~uses.any(1)] = 0
        return out

    def _add(self, out: np.ndarray, word: np.ndarray, bucket: np.ndarray) -> None:
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(word, self.score[bucket, k], len(out)).astype(np.float32)


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = TRAIN_DOCS) -> LanguageModel:
    """From the rows with text and language; about ``per_language`` texts of each language, drawn by their
    id (a null id: by the text). The shares, a row per language, go to the texts: no text is moved."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        "text is not null and lang is not null"
    )
    share = saved(labelled.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*")).alias("share")), "language_shares")
    by = F.when(F.col("id").isNull(), F.xxhash64("text", F.lit("lang"))).otherwise(F.xxhash64("id", F.lit("lang")))
    draw = F.pmod(by, F.lit(1 << 30)) / float(1 << 30)
    some = labelled.join(checked_broadcast(share), "lang").filter(draw < F.col("share")).select("lang", "text")
    rows = some.mapInArrow(_train_counts, "lang string, kind int, key long, c long").groupBy("lang", "kind", "key").agg(F.sum("c").alias("c")).collect()
    langs = sorted({r[0] for r in rows})
    at = {x: i for i, x in enumerate(langs)}
    grams, scripts = np.zeros((len(langs), BUCKETS)), np.zeros((len(langs), len(SCRIPTS)))
    for lang, kind, key, c in rows:
        (scripts if kind else grams)[at[lang], key] = c
    return LanguageModel(langs, grams, scripts)


def viterbi(score: np.ndarray, begin: np.ndarray, switch: float) -> np.ndarray:
    """The best language of every word: rows of ``score`` are words, text after text.

    All texts advance by one word together; text i has rows begin[i]:begin[i + 1]."""
    size = np.diff(begin)
    order = np.argsort(-size, kind="stable")
    start, size = begin[:-1][order], size[order]
    n_lang = score.shape[1]
    came = np.empty((len(score), n_lang), np.int8 if n_lang < 128 else np.int32)
    best = np.zeros((len(order), n_lang), np.float64)
    steps = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(steps), "left")
    own = np.arange(n_lang)
    for t in range(steps):
        m = alive[t]
        b = best[:m]
        top = b.argmax(1)
        high = b[np.arange(m), top] - switch
        stay = b >= high[:, None]
        came[start[:m] + t] = np.where(stay, own, top[:, None])
        best[:m] = np.where(stay, b, high[:, None]) + score[start[:m] + t]
    path = np.empty(len(score), np.int64)
    now = best.argmax(1) if n_lang else np.zeros(len(order), np.int64)
    for t in range(steps - 1, -1, -1):
        m = alive[t]
        path[start[:m] + t] = now[:m]
        now[:m] = came[start[:m] + t, now[:m]]
    return path


def _label(it: Iterator[pa.RecordBatch], model: LanguageModel, switch: float, spans: bool) -> Iterator[pa.RecordBatch]:
    known: dict[str, int] = {}
    table = np.zeros((0, len(model.langs)), np.float32)

    def rows(ids: pa.Array, lo: int, texts: list[str]) -> pa.RecordBatch:
        nonlocal table
        if len(known) > CACHE:
            known.clear()
            table = table[:0]
        words = [t.split() for t in texts]
        new = list(set().union(*words) - known.keys()) if words else []
        if new:
            # Words without letters say nothing.
            plain = [letters(w) for w in new]
            s = np.zeros((len(new), len(model.langs)), np.float32)
            real = [i for i, p in enumerate(plain) if p]
            for k in range(0, len(real) if model.langs else 0, 20_000):
                part = real[k : k + 20_000]
                s[part] = model.word_scores([plain[i] for i in part])
            width = np.array([len(p) for p in plain], np.float32)[:, None]
            known.update(zip(new, range(len(table), len(table) + len(new)), strict=True))
            table = np.concatenate((table if table.shape[1] == s.shape[1] + 1 else np.zeros((0, s.shape[1] + 1), np.float32), np.hstack((s, width))))
        count = np.array([len(w) for w in words], np.int64)
        begin = np.concatenate(([0], np.cumsum(count)))
        num = np.fromiter((known[w] for ws in words for w in ws), np.int64, int(begin[-1]))
        got = table[num] if len(num) else np.zeros((0, len(model.langs) + 1), np.float32)
        width = got[:, -1]
        path = viterbi(got[:, :-1], begin, switch) if model.langs else np.zeros(len(num), np.int64)
        text = np.repeat(np.arange(len(texts)), count)
        n_lang = max(1, len(model.langs))
        share = np.bincount(text * n_lang + path, width, len(texts) * n_lang).reshape(len(texts), n_lang)
        total = share.sum(1)
        ok = (total > 0) & bool(model.langs)
        top = share.argmax(1)
        lang = [model.langs[k] if o else "und" for k, o in zip(top, ok, strict=True)]
        score = np.where(ok, share.max(1) / np.maximum(total, 1), 0.0)
        out = [ids.slice(lo, len(texts)), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
        names = ["id", "lang_pred", "score"]
        if spans:
            cuts = []
            for i in range(len(texts)):
                p = path[begin[i] : begin[i + 1]]
                at = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1]))) if len(p) and ok[i] else np.zeros(0, int)
                end = np.append(at[1:], len(p))
                cuts.append([{"first": int(a), "n": int(b - a), "lang": model.langs[p[a]]} for a, b in zip(at, end, strict=False)])
            out.append(pa.array(cuts, pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32()), ("lang", pa.string())]))))
            names.append("spans")
        return pa.RecordBatch.from_arrays(out, names)

    for batch in it:
        ids, lo, part, size = batch.column("id"), 0, [], 0
        for i, x in enumerate(batch.column("text")):
            part.append(x.as_py() or "")
            size += len(part[-1])
            if size > SLICE_CHARS:
                yield rows(ids, lo, part)
                lo, part, size = i + 1, [], 0
        if part:
            yield rows(ids, lo, part)


def predict(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH, spans: bool = False
) -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score and, if asked for, spans.

    lang_pred is the language of most letters on the Viterbi path and score its share of them
    (0 to 1); ``und`` with score 0 if the text is null, empty or has no letters, or the model
    knows no language. spans (array of first word, number of words, language) cover all words
    of a labelled text. Equal scores go to the language first in code point order. Ids may be
    null or repeated; rows stay rows; other columns are ignored; an empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    cols = f"id {id_type}, lang_pred string, score double" + (", spans array<struct<first:int,n:int,lang:string>>" if spans else "")
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lambda it: giving_back(_label(it, model, switch, spans)), cols)
    return out.withColumnRenamed("id", id_col)
