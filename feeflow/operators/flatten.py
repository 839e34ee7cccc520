"""Parsing and reshaping of transaction documents.

Inputs and outputs of one transaction always travel in one message, so they are
exploded *separately*: one row per input plus one row per output, never one row
per (input, output) pair. The pair product of the original job grows with
|inputs| x |outputs| per transaction; the long form grows with the sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.schemas import HEADER_COLUMNS, ITEM_COLUMNS


def expand(docs: DataFrame, doc_col: str | None = None) -> DataFrame:
    """Struct star expansion (P3): ``op`` plus every field of ``x`` as a column.

    ``doc_col`` names a parsed struct column (``from_json(...) AS data``); without
    it ``docs`` must already have ``op`` and ``x`` columns.
    """
    if doc_col:
        return docs.select(f"{doc_col}.op", f"{doc_col}.x.*")
    return docs.select("op", "x.*")


def _input_fields(i: Column) -> dict[str, Column]:
    po = i["prev_out"]
    return {
        "side": F.lit("in"),
        "sequence": i["sequence"],
        "spent": po["spent"],
        "item_tx_index": po["tx_index"],
        "item_type": po["type"],
        "addr": po["addr"],
        "value": po["value"],
        "n": po["n"],
        "script": po["script"],
        "sig_script": i["script"],
    }


def _output_fields(o: Column) -> dict[str, Column]:
    return {
        "side": F.lit("out"),
        "sequence": F.lit(None).cast("bigint"),
        "spent": o["spent"],
        "item_tx_index": o["tx_index"],
        "item_type": o["type"],
        "addr": o["addr"],
        "value": o["value"],
        "n": o["n"],
        "script": o["script"],
        "sig_script": F.lit(None).cast("string"),
    }


def _item(fields_of, names: list[str]):
    """Lambda building an item struct with only the ``names`` fields.

    The optimiser cannot prune fields inside a lambda, so building only what the
    caller needs keeps the generator cheap.
    """
    return lambda e: F.struct(*[fields_of(e)[n].alias(n) for n in names])


def explode_inputs(tx: DataFrame, outer: bool = False) -> DataFrame:
    """One row per input (P4): header columns plus ``in_*`` leaves.

    Like ``explode``, a transaction with a NULL or empty input array yields no row,
    unless ``outer`` is set.
    """
    gen = F.explode_outer if outer else F.explode
    return tx.select(*HEADER_COLUMNS, gen("inputs").alias("i")).select(
        *HEADER_COLUMNS,
        F.col("i.sequence").alias("in_sequence"),
        F.col("i.prev_out.spent").alias("in_spent"),
        F.col("i.prev_out.tx_index").alias("in_tx_index"),
        F.col("i.prev_out.type").alias("in_type"),
        F.col("i.prev_out.addr").alias("in_addr"),
        F.col("i.prev_out.value").alias("in_value"),
        F.col("i.prev_out.n").alias("in_n"),
        F.col("i.prev_out.script").alias("in_script"),
        F.col("i.script").alias("in_sig_script"),
    )


def explode_outputs(tx: DataFrame, outer: bool = False) -> DataFrame:
    """One row per output (P5): header columns plus ``out_*`` leaves."""
    gen = F.explode_outer if outer else F.explode
    return tx.select(*HEADER_COLUMNS, gen("out").alias("o")).select(
        *HEADER_COLUMNS,
        F.col("o.spent").alias("out_spent"),
        F.col("o.tx_index").alias("out_tx_index"),
        F.col("o.type").alias("out_type"),
        F.col("o.addr").alias("out_addr"),
        F.col("o.value").alias("out_value"),
        F.col("o.n").alias("out_n"),
        F.col("o.script").alias("out_script"),
    )


def flatten(tx: DataFrame, header: list[str] | None = None, items: list[str] | None = None) -> DataFrame:
    """The flat relation in long form (P4-P6): one row per input and per output.

    A single generator over the concatenated item arrays: one pass over the
    documents, no union, no pair product. As in the original job, a transaction
    whose input or output array is NULL or empty contributes no row.
    ``side`` is 'in' or 'out'; ``sequence`` and ``sig_script`` exist only for inputs.
    ``items`` restricts the item columns produced (all of ``ITEM_COLUMNS`` by default).
    """
    cols = list(HEADER_COLUMNS if header is None else header)
    names = list(ITEM_COLUMNS if items is None else items)
    both = (F.size("inputs") > 0) & (F.size("out") > 0)
    generated = F.when(
        both,
        F.concat(F.transform("inputs", _item(_input_fields, names)), F.transform("out", _item(_output_fields, names))),
    )
    return tx.select(*cols, F.inline(generated)).select(*cols, *names)


def fee_items(tx: DataFrame) -> DataFrame:
    """The slim long form the fee plan needs: hash, size, is_input, addr, value."""
    return flatten(tx, header=["hash", "size"], items=["side", "addr", "value"]).select(
        "hash", "size", (F.col("side") == "in").alias("is_input"), "addr", "value"
    )


def window_bounds(df: DataFrame, window_col: str = "window") -> DataFrame:
    """Window struct expansion (P7) followed by the drop of the struct (P10)."""
    return df.select(
        F.col(f"{window_col}.start").alias("window_start"),
        F.col(f"{window_col}.end").alias("window_end"),
        "*",
    ).drop(window_col)
