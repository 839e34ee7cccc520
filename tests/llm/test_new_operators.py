"""Fill-in-middle, whitening and byte-level BPE against brute-force forms."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feeflow.llm import byte_bpe, fill_middle, whitening
from feeflow.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.fixtures import SCHEMA, counts, frame, make_docs
from tests.oracle_util import digest, duck

ROWS = [*make_docs(), (None, "a null id", "en", "x"), (200, "<P>a marker", "en", "x"), (201, "ends in <S", "en", "x"), (202, "<", None, None)]
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# --- fill-in-middle ---------------------------------------------------------------------------


def _fim(doc_id, text, fim=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return doc_id, n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("fim", [50, 100])
def test_fill_in_middle(spark, fim):
    r = random.Random(5)
    rows = ROWS + [(1000 + i, "".join(r.choice("ab <PSM>\n\x0bé🙂\x1c\x85") for _ in range(r.randint(0, 30))), None, None) for i in range(1500)]
    out = fill_middle.fill_in_middle(frame(spark, rows), fim_percent=fim).withColumn("back", fill_middle.restored()).collect()
    assert counts(tuple(x)[:6] for x in out) == counts(_fim(i, t, fim) for i, t, *_ in rows)
    assert counts((x.doc_id, x.back) for x in out) == counts((i, t or "") for i, t, *_ in rows)
    assert {x.form for x in out} == {"plain", "spm", "psm"}


def test_fill_in_middle_captures_are_the_matches():
    r = random.Random(6)
    for _ in range(5000):
        text = "".join(r.choice(" \n\tab\x0bé日\x1c\x85") for _ in range(r.randint(0, 12)))
        assert fill_middle.UNITS.fullmatch(text).ends(1) == [m.end() for m in UNIT.finditer(text)]


def test_fill_in_middle_sql(spark):
    name = "op11_fill_in_middle"
    got = digest(QUERIES[name](spark, SF_SMALL).toPandas())
    assert got[:3] == digest(duck(SF_SMALL).sql(ORACLE[name]).df())[:3]


# --- whitening --------------------------------------------------------------------------------


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "c", "c") for i, v in rows], "vec_id long, embedding array<float>, label int, id string, x string, w string").repartition(5)


def _whitened(rows, components=16):
    """(id, component): n, deviation, whitened, explained, by eigenvectors of the covariance."""
    x = {}
    for k, (i, v) in enumerate(rows):
        if v and all(c is not None and np.isfinite(np.float32(c)) for c in v):
            x[k] = (i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v])
    fit = np.array(sorted({tuple(c) for _, c in x.values()}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = (n * fit - sums).astype(float) / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    out = []
    for i, c in x.values():
        d = n * np.array(c, dtype=object) - sums
        w = (d.astype(float) / n) @ v
        out += [(i, k + 1, n, int((d * d).sum()), w[k] / np.sqrt(e[k]), e[k] / e.sum()) for k in range(min(components, len(e))) if e[k] > 1e-12 * e[0]]
    return out


def _same(got, want):
    assert len(got) == len(want) > 0
    assert counts(tuple(x)[:4] for x in got) == counts(x[:4] for x in want)
    def by(rows):
        rows = sorted(map(tuple, rows), key=lambda x: (x[0] is None, x[0] or 0, x[3], abs(x[4])))
        return {k: [x for x in rows if x[1] == k] for k in {x[1] for x in rows}}

    a, b = by(got), by(want)
    for k in b:
        p, q = (np.array([x[4] for x in r[k]]) for r in (a, b))
        sign = np.sign(p @ q)
        assert abs(np.abs(p) - np.abs(q)).max() < 1e-8
        assert sum(np.sign(x) == sign * np.sign(y) for x, y in zip(p, q, strict=True)) >= 0.9 * len(p)
        assert np.allclose([x[5] for x in a[k]], b[k][0][5], rtol=1e-9)
    assert max(x[6] for x in got) <= 1e-9


def test_whitening(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 7)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    r = np.random.default_rng(1)
    base = r.normal(size=(150, 20)) * np.linspace(3, 0.2, 20) @ np.linalg.qr(r.normal(size=(20, 20)))[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(900 + i, rows[3][1]) for i in range(70)] + [rows[5], (None, rows[6][1]), (None, rows[8][1])]  # copies don't weigh
    odd = [None, [], [None] * 20, [float("nan")] + [0.0] * 19, [float("inf")] + [0.0] * 19, [None] + [1.0] * 19]
    rows += [(500 + i, v) for i, v in enumerate(odd)]
    _same(whitening.whiten(_vectors(spark, rows)).collect(), _whitened(rows))
    # Fewer distinct vectors than dimensions; others of another length go.
    few = rows[:6] + [(700, [1.0, 2.0])]
    _same(whitening.whiten(_vectors(spark, few)).collect(), _whitened(few[:6]))
    assert whitening.whiten(_vectors(spark, few[:6])).select("component").distinct().count() == 5


def test_whitening_without_spread(spark):
    assert whitening.whiten(_vectors(spark, [(1, [1.0, 2.0])] * 4)).collect() == []
    empty = whitening.whiten(_vectors(spark, []).filter("false"))
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and empty.count() == 0
    huge = whitening.whiten(_vectors(spark, [(1, [1e38, 0.0]), (2, [-1e38, 1.0]), (3, [0.0, 5.0])])).collect()
    assert {x.vec_id for x in huge} == {1, 2, 3} and all(x.deviation is None for x in huge if x.vec_id < 3)


@pytest.mark.parametrize("case", ["plain", "graded", "deficient", "short", "isotropic", "twice", "wilkinson"])
def test_singular_values_and_vectors(case):
    r = np.random.default_rng(3)
    x = r.normal(size=(400, 24))
    w = np.linalg.cholesky(np.diag(np.abs(np.arange(21) - 10.0)) + np.eye(21, k=1) + np.eye(21, k=-1) + 3 * np.eye(21))
    a = {
        "plain": x, "graded": x * np.logspace(0, -7, 24), "deficient": np.repeat(x[:, :8], 3, axis=1), "short": x[:5],
        "isotropic": np.linalg.qr(x)[0], "twice": np.kron(np.eye(2), x[:, :12]), "wilkinson": w.T,
    }[case]
    values, v = whitening.principal_axes(np.linalg.qr(a, mode="r"), 64)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    want = want[want > 1e-18 * want[0]]
    assert np.allclose(values, want, rtol=1e-11)
    assert np.abs(v.T @ v - np.eye(len(values))).max() < 1e-12
    assert np.abs(a.T @ (a @ v) - v * values).max() < 1e-12 * want[0]


# --- byte-level BPE -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(), special_tokens={})


def _encoded(tokenizer, rows):
    ids = [tokenizer.encode_ordinary(t or "") for _, t, *_ in rows]
    return counts((r[0], tuple(x), b"".join(k.to_bytes(4, "little") for k in x), (r[1] or "").encode()) for r, x in zip(rows, ids, strict=True))


@pytest.mark.parametrize("group", [300, 1 << 22])
def test_byte_bpe(spark, tokenizer, group):
    r = random.Random(2)
    letters = [chr(c) for c in r.sample([c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF], 3000)]
    rows = ROWS + [(2000 + i, "".join(r.choice("aab  \n\t\réßñ日本語한а́🙂'stvmre.,12\x85 ") for _ in range(r.randint(1, 60))), None, None) for i in range(400)]
    rows += [(3000 + i, " a".join(letters[k : k + 30]), None, None) for i, k in enumerate(range(0, 3000, 30))]
    rows += [(4000, "ࡰࢉ \U000323af \U00010d40\U000116d0 ࡰ٠ 'ࡰ", None, None), (4001, "it's we've I'LL " * 9, None, None), (4002, "\n" * 700 + "é" * 400, None, None)]
    out = byte_bpe.decode(byte_bpe.encode(frame(spark, rows), group_words=group)).collect()
    assert counts((x.doc_id, tuple(x.ids), bytes(x.ids_bytes), bytes(x.decoded)) for x in out) == _encoded(tokenizer, rows)


def test_byte_bpe_long_words_fold_like_short_ones(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG", 5)
    rows = ROWS[:20]
    out = byte_bpe.decode(byte_bpe.encode(frame(spark, rows))).collect()
    assert counts((x.doc_id, tuple(x.ids), bytes(x.ids_bytes), bytes(x.decoded)) for x in out) == _encoded(tokenizer, rows)


def test_byte_bpe_merges_words_of_a_batch_together(tokenizer, monkeypatch):
    r = random.Random(4)
    some = ["".join(r.choice("aeinorst lé日🙂") for _ in range(n)) for n in range(1, 90) for _ in range(5)]
    one_by_one = []
    heap = byte_bpe.heap_merges
    merges, ranks = byte_bpe.merges_of(None), byte_bpe.ranks_of()
    monkeypatch.setattr(byte_bpe, "heap_merges", lambda *x: one_by_one.append(x) or heap(*x))
    monkeypatch.setattr(byte_bpe, "MATRIX_BYTES", 200)
    flat, begin = byte_bpe._tokens_of(pa.array(some), ranks, pa.array(ranks.keys(), pa.binary()), np.fromiter(ranks.values(), np.int32), merges)
    for i, w in enumerate(some):  # a match of the pattern on its own is one word
        assert flat[begin[i] : begin[i + 1]].tolist() == tokenizer._encode_single_piece(w)
    assert len(one_by_one) == sum(len(w.encode()) > byte_bpe.LONG for w in some)


def test_byte_bpe_tokens_that_no_pair_makes(spark, tmp_path):
    import base64

    import tiktoken

    # "wxyz" is found as a whole word only: its "xy" is joined first, and neither "wxy" nor "xyz" is a token.
    ranks = {bytes([b]): b for b in range(256)} | {b"xy": 256, b"yz": 257, b"wxyz": 258, b"ab": 259}
    path = tmp_path / "own.tiktoken"
    path.write_text("".join(f"{base64.b64encode(k).decode()} {v}\n" for k, v in ranks.items()))
    own = tiktoken.Encoding("own", pat_str=r"\w+|\W+", mergeable_ranks=ranks, special_tokens={})
    texts = ["wxyz", "wxyzw xyz awxyz", "abab wxyz", "é wxy"]
    out = byte_bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), path=str(path), pattern=r"\w+|\W+").collect()
    assert {x.doc_id: x.ids for x in out} == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}
    back = byte_bpe.decode(spark.createDataFrame([(1, [97, 9999]), (2, None), (3, []), (4, [97, None]), (5, [-1]), (6, [97, 258])], "doc_id int, ids array<int>"), path=str(path))
    got = {x.doc_id: None if x.decoded is None else bytes(x.decoded) for x in back.collect()}
    assert got == {1: None, 2: None, 3: b"", 4: None, 5: None, 6: b"awxyz"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert fill_middle.fill_in_middle(none).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(none)).count() == 0


def test_queries_keep_every_row(spark):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for name in ("op11_fill_in_middle", "op13_byte_bpe"):
        out = QUERIES[name](spark, SF_SMALL)
        assert out.count() == n
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").filter(F.col("embedding").isNotNull()).count()
    assert QUERIES["op12_embedding_whitening"](spark, SF_SMALL).count() == 16 * vectors
