"""Fill-in-the-middle texts by repeated-capture matching.

A text is a run of units, a word with the white space before it or trailing white space. One
fullmatch of ``(unit)*`` keeps every repetition of the group, so the ends of its captures are
the places where a text may be cut: their number is n, and both cuts are looked up in them.
Cutting and putting together works on whole texts inside Arrow batches; putting a text back
together from output and form is a built-in expression.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Possessive: a unit is never given back, so no state to backtrack to is kept. The lookahead is what
# the second branch of the unit needs: only white space that nothing follows comes there.
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
# Texts of about this many characters are handed on together.
SLICE_CHARS = 2 << 20


def cut(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """Number of units, and the offsets of both cuts in code points."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, ends[a - 1] if a else 0, ends[b - 1] if b else 0


def draws(seed: int, key: str) -> list[int]:
    """Four 32-bit numbers from the hash of a row's id."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def transform(text: str, key: str, seed: int, fim_percent: int, spm_percent: int) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars and output of one text."""
    h1, h2, h3, h4 = draws(seed, key)
    n, a, b = cut(text, h1, h2)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


_OUT = "n long, form string, prefix_chars long, middle_chars long, output string"


def _map_fim(it: Iterator[pa.RecordBatch], seed: int, fim_percent: int, spm_percent: int) -> Iterator[pa.RecordBatch]:
    def rows(ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([ids, *cols], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    for batch in it:
        ids, keys, out, lo, chars = batch.column("id"), batch.column("key"), [], 0, 0
        for i, x in enumerate(batch.column("text")):
            text = x.as_py() or ""
            out.append(transform(text, keys[i].as_py(), seed, fim_percent, spm_percent))
            chars += len(text)
            if chars > SLICE_CHARS:
                yield rows(ids.slice(lo, len(out)), out)
                lo, chars, out = i + 1, 0, []
        if out:
            yield rows(ids.slice(lo, len(out)), out)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """One row per row of ``docs``: id, n (units), form, prefix_chars, middle_chars, output.

    The cuts and the form follow from the id alone and from ``seed``: of ``fim_percent`` of the
    ids, ``spm_percent`` are suffix-first (spm), the others prefix-first (psm); the rest is plain,
    as are empty texts and texts that hold a marker. The lengths are code points, null for
    plain. A null text is empty, a null id has the empty string as its text. Repeated rows are
    treated like any other, other columns are ignored, an empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(lambda it: _map_fim(it, seed, fim_percent, spm_percent), f"id {id_type}, {_OUT}")
    return out.withColumnRenamed("id", id_col)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``output`` was made from: no text that was cut holds a marker, so the
    markers in an output are the three that were put in."""
    part = F.split(F.col(output), "<[PSM]>", -1)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
