"""Hand-made transaction documents for tests."""

from __future__ import annotations

import json

from feeflow.schemas import TX_DOC


def coin(addr, value, n=0, spent=False):
    return {"spent": spent, "tx_index": 1, "type": 0, "addr": addr, "value": value, "n": n, "script": "s"}


def doc(hash_, size, time, inputs, outs, op="utx"):
    """A document; ``inputs`` and ``outs`` are lists of (addr, value)."""
    return {
        "op": op,
        "x": {
            "lock_time": 0,
            "ver": 1,
            "size": size,
            "inputs": [
                {"sequence": 4294967295, "prev_out": coin(a, v, i, True), "script": "sig"}
                for i, (a, v) in enumerate(inputs)
            ],
            "time": time,
            "tx_index": 7,
            "vin_sz": len(inputs),
            "hash": hash_,
            "vout_sz": len(outs),
            "relayed_by": "0.0.0.0",
            "out": [coin(a, v, i) for i, (a, v) in enumerate(outs)],
        },
    }


def split(total, k):
    """k positive parts summing to total."""
    parts = [total // k] * k
    parts[0] += total - sum(parts)
    return parts


# (hash, time, size, n_in, n_out, sum_in, sum_out, fee, fee_rate): the golden table of FIXTURES.md §4.
GOLDEN = [
    ("c4a0dae726", 1677464386, 226, 1, 2, 21171100, 21169678, 1422, 6.29),
    ("8beadc7ad6", 1677464387, 224, 1, 2, 1653915, 1646971, 6944, 31.0),
    ("46be4948c0", 1677464387, 151, 1, 1, 5000, 4849, 151, 1.0),
    ("316bded4af", 1677464387, 223, 1, 2, 19980000, 19977885, 2115, 9.48),
    ("5aef69e799", 1677464388, 223, 1, 2, 1175095, 1146695, 28400, 127.35),
    ("6c881be883", 1677464388, 224, 1, 2, 12967135, 12966989, 146, 0.65),
    ("ffdb8183c8", 1677464390, 347, 1, 4, 92238715, 92228222, 10493, 30.24),
    ("fa7ead4270", 1677464390, 226, 1, 2, 4331775, 4331346, 429, 1.9),
    ("53c88925ce", 1677464392, 225, 1, 2, 2078532, 2076372, 2160, 9.6),
    ("d0df941777", 1677464392, 189, 1, 1, 33935, 33744, 191, 1.01),
    ("319953b490", 1677464392, 462, 2, 4, 686265953, 686257753, 8200, 17.75),
    ("6b437962d1", 1677464393, 369, 2, 2, 1843383, 1840712, 2671, 7.24),
]


def golden_docs():
    out = []
    for h, t, size, ni, no, si, so, _fee, _rate in GOLDEN:
        ins = [(f"{h}-in{i}", v) for i, v in enumerate(split(si, ni))]
        outs = [(f"{h}-out{i}", v) for i, v in enumerate(split(so, no))]
        if h == "ffdb8183c8":  # one output without an address survives as a NULL key
            outs[1] = (None, outs[1][1])
        out.append(doc(h, size, t, ins, outs))
    return out


def to_df(spark, docs):
    return spark.createDataFrame(docs, TX_DOC)


def to_json_lines(docs):
    return "\n".join(json.dumps(d) for d in docs) + "\n"
