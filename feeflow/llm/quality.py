"""Quality rules on repetition coverage, measured in numpy over whole Arrow batches.

Rolling hashes of the words give all n-grams of several lengths; those that occur more than
once in their text are found by sorting (text, hash) pairs, and every character of a word
that a repeated n-gram covers is counted once. Lines are treated the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.text import Texts, mix, powers, texts_of

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_CONT = (np.arange(256) & 0xC0) == 0x80  # UTF-8 bytes that begin no code point


@dataclass(frozen=True)
class Rules:
    """Largest shares that a kept text has: of characters of words in repeated n-grams (by
    n), of characters and of number of lines that repeat an earlier one, of symbols per word."""

    # Falling: words in a repeated n-gram lie in repeated shorter ones too, and long ones seldom repeat by chance.
    covered: dict[int, float] = field(default_factory=lambda: {4: 0.40, 5: 0.25, 6: 0.22, 7: 0.18, 8: 0.15, 9: 0.13, 10: 0.10})
    line_chars: float = 0.30
    lines: float = 0.35
    symbols: float = 0.10
    min_words: int = 10
    max_repeat_percent: int = 20


def _repeated(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value occurs more than once in its text, and whether it did before."""
    key = mix(h + mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    again, before = np.empty(len(k), bool), np.empty(len(k), bool)
    again[order] = same[1:] | same[:-1]
    before[order] = same[:-1]
    return again, before


def _covered(again: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in a window of n words (at its first word) that is ``again``."""
    delta = np.zeros(words + 1, np.int32)
    delta[: len(again)] += again
    delta[n : n + len(again)] -= again
    return np.cumsum(delta[:-1]) > 0


def measure(t: Texts, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Per text: n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines,
    line_chars and dup_line_chars (code points of words), n_repeat_words (5-word windows) and
    for every n of ``lengths`` ``chars_n``, the characters of words in repeated n-grams."""
    n_text = len(t)
    start, end, first = t.words()
    n_words = np.diff(first)
    text = np.repeat(np.arange(n_text), n_words)
    cont = np.concatenate(([0], np.cumsum(_CONT[t.buf])))
    chars = (end - start) - (cont[end] - cont[start])
    h = t.word_hashes(start, end, lower=False)
    up, _ = powers(max(lengths) + 2)
    per_text = lambda w: np.bincount(text, w, n_text).astype(np.int64)
    out = {"n_words": n_words.astype(np.int64), "word_chars": per_text(chars)}
    sym = np.concatenate(([0], np.cumsum(SYMBOLS[t.buf])))
    out["n_symbols"] = sym[t.off[1:]] - sym[t.off[:-1]]
    roll = np.zeros(len(h), np.uint64)
    for n in range(1, max(lengths) + 1):
        if len(h) < n:
            roll = roll[:0]
        else:
            roll = roll[: len(h) - n + 1] + h[n - 1 :] * up[n]
        if n not in lengths:
            continue
        inside = np.flatnonzero(text[: len(roll)] == text[n - 1 :]) if len(roll) else np.zeros(0, np.int64)
        again = np.zeros(len(roll), bool)
        again[inside] = _repeated(text[inside], roll[inside])[0]
        cover = _covered(again, n, len(h))
        out[f"chars_{n}"] = per_text(chars * cover)
        if n == 5:
            out["n_repeat_words"] = per_text(cover)
    # Lines: from after a \n (or the text's begin) to the next \n (or its end).
    edge = np.zeros(len(t.buf) + 1, bool)
    edge[1:] = t.buf == 10
    edge[t.off] = True
    s = np.flatnonzero(edge[:-1])
    nxt = np.append(s[1:], len(t.buf))
    e = nxt - ((t.buf[np.maximum(nxt, 1) - 1] == 10) & (nxt > s)).astype(np.int64) if len(s) else nxt[:0]
    a, b = np.searchsorted(start, s), np.searchsorted(start, nxt)
    real = b > a
    s, e, a, b = s[real], e[real], a[real], b[real]
    prefix = t.prefix(False)
    down = powers(len(t.buf) + 1)[1]
    line_h = mix((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64))
    line_text = np.searchsorted(t.off, s, "right") - 1
    before = _repeated(line_text, line_h)[1]
    word_sum = np.concatenate(([0], np.cumsum(chars)))
    size = word_sum[b] - word_sum[a]
    by_line = lambda w=None: np.bincount(line_text, w, n_text).astype(np.int64)
    out |= {"n_lines": by_line(), "n_dup_lines": by_line(before), "dup_line_chars": by_line(size * before)}
    return out


def verdict(m: dict[str, np.ndarray], rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """base_failed, kept."""
    words, chars = m["n_words"], np.maximum(m["word_chars"], 1)
    failed = (words < rules.min_words) | (100 * m["n_repeat_words"] > rules.max_repeat_percent * words)
    bad = failed | (m["dup_line_chars"] > rules.line_chars * chars) | (m["n_dup_lines"] > rules.lines * np.maximum(m["n_lines"], 1))
    bad |= m["n_symbols"] > rules.symbols * np.maximum(words, 1)
    for n, most in rules.covered.items():
        bad |= m[f"chars_{n}"] > most * chars
    return failed, ~bad


def _map_quality(it: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    lengths = tuple(sorted({5, *rules.covered}))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for batch in it:
        for lo, hi, t in texts_of(batch.column("text")):
            m = measure(t, lengths)
            failed, kept = verdict(m, rules)
            most = np.max([m[f"chars_{n}"] for n in rules.covered], 0) if rules.covered else np.zeros(len(t))
            share = most / np.maximum(m["word_chars"], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(lo, hi - lo), *(pa.array(m[n].astype(np.int64)) for n in names), pa.array(failed), pa.array(kept), pa.array(share.astype(float))],
                ["id", *names, "base_failed", "kept", "covered_share"],
            )


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, covered_share.

    A null or empty text has no words and fails. Words, lines and n-grams count as written.
    A line without a word is no line here; of equal lines all but the first are duplicates.
    covered_share is the largest share of word characters in repeated n-grams of one length.
    Ids may be null or repeated; rows stay rows and are judged alone; other columns are
    ignored; an empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    cols = f"id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, covered_share double"
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lambda it: _map_quality(it, rules or Rules()), cols)
    return out.withColumnRenamed("id", id_col)
