"""Whole jobs: what a shortcut of an operator would leave out."""

from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from feeflow.llm import line_chunks, lm_scores, packing, quality
from tests.llm.fixtures import SCHEMA, counts, frame, make_docs, words


def test_lm_trains_on_every_token():
    # Each text has a word that no other has, and all of them are in the vocabulary.
    texts = [f"w{i} a b c" for i in range(40)]
    t = next(lm_scores.texts_of(pa.array(texts)))[2]
    h, c = np.unique(lm_scores.tokens(t)[0], return_counts=True)
    vocab = lm_scores.vocabulary(pa.table({"h": h.view(np.int64), "c": c}), int(c.sum()), 512)
    examples = []

    class Recorder(lm_scores.Trainer):
        def fit(self, a, b, w):
            examples.extend(np.asarray(w).tolist())
            super().fit(a, b, w)

    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array([0] * 40, pa.int64()), pa.array(texts)], ["key", "shard", "text"])
    coded = pa.Table.from_batches(lm_scores._map_ids(iter([batch]), vocab))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(lm_scores, "Trainer", Recorder)
        out = lm_scores._fit_shard(coded, vocab.unigram, 4, None)
    assert len(examples) == 5 * len(texts) and len(set(examples)) == 44
    assert out.column("seen")[0].as_py() == 5 * len(texts)


def test_lm_scores_do_not_depend_on_files(spark, monkeypatch):
    import functools

    monkeypatch.setattr(lm_scores, "train", functools.partial(lm_scores.train, shard_tokens=3000))  # several shards
    rows = make_docs()[:130]
    one = lm_scores.lm_scores(frame(spark, rows).coalesce(1), size=60).collect()
    many = lm_scores.lm_scores(frame(spark, rows[::-1]).repartition(60), size=60).collect()
    a, b = ({r.doc_id: r.score for r in x} for x in (one, many))
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) <= 1e-9 * abs(a[i]) for i in a)


def test_lm_rounds_start_from_the_last_average(spark):
    rows = [(i, " ".join(["a b c d e f g h"] * 40), "en", "s") for i in range(200)]
    t = next(lm_scores.texts_of(pa.array([r[1] for r in rows])))[2]
    h, c = np.unique(lm_scores.tokens(t)[0], return_counts=True)
    vocab = lm_scores.vocabulary(pa.table({"h": h.view(np.int64), "c": c}), int(c.sum()), 64)
    training = frame(spark, rows).selectExpr("doc_id as key", "text")
    gap = []
    for rounds in (1, 4):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(lm_scores, "ROUNDS", rounds)
            # 32 shards either way, all in one round or 8 in each of 4: later rounds go on from the average.
            p = lm_scores.train(training, vocab, int(c.sum()), 8, shard_tokens=int(c.sum()) // 32 + 1)
        start = lm_scores._start(len(vocab.unigram), 8, vocab.unigram)
        gap.append(float(np.abs(p["q"] - start["q"]).sum()))
    assert gap[1] > 2 * gap[0] > 0


def _without_repeated_windows(rows):
    """(id, text, lines, removed lines) by windows of two worded lines and by chunks, in plain Python."""
    from tests.llm.test_operators import _chunked

    first, units = {}, {}
    for i, text, *_ in sorted({r[:2] for r in rows if r[1] is not None}):
        lines, found, at = text.split("\n"), [], 0
        worded = [k for k, x in enumerate(lines) if words(x)]
        found += [(a, b, (False, lines[a] + "\n" + lines[b])) for a, b in zip(worded, worded[1:], strict=False)]
        for c in _chunked(text):
            if len(c) > 1 and words("\n".join(c)):
                found.append((at, at + len(c) - 1, (True, "\n".join(c))))
            at += len(c)
        units[i] = found
        for a, b, key in found:
            first[key] = min(first.get(key, (i, a, b)), (i, a, b))
    for i, text, *_ in rows:
        gone = set()
        for a, b, key in units.get(i, []):
            if not (first[key][0] == i and a <= first[key][2]):
                gone |= set(range(a, b + 1))
        lines = text.split("\n") if text is not None else []
        yield i, None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)


def test_line_passages_as_in_python(spark):
    rows = [*make_docs(), (200, "a\na\na\na\na", "en", "s"), (201, "p q\n\nr s\n \nt\nu", "en", "s"), (202, "x\np q\nr s\nt\ny", "en", "s")]
    out = line_chunks.dedup_line_passages(frame(spark, rows))
    assert out.columns == [*(c.split()[0] for c in SCHEMA.split(", ")), "n_lines", "n_removed_lines", "n_removed_chunks"]
    assert counts(out.select("doc_id", "text", "n_lines", "n_removed_lines").collect()) == counts(_without_repeated_windows(rows))
    old = {r.doc_id: r.n_removed_chunks for r in line_chunks.dedup_line_chunks(frame(spark, rows)).collect()}
    assert {r.doc_id: r.n_removed_chunks for r in out.collect()} == old
    empty = spark.createDataFrame([], SCHEMA)
    assert line_chunks.dedup_line_passages(empty).count() == 0
    nulls = frame(spark, [(None, None, None, None), (None, "a\nb", None, None), (None, "a\nb", None, None), (None, "c\na\nb", None, None)])
    assert sorted((r.text or "", r.n_removed_lines) for r in line_chunks.dedup_line_passages(nulls).collect())[0] == ("", 0)


def test_planted_line_passages_go_whole(spark):
    """The query removes every later copy of two- to six-line passages, edges and one-line chunks too."""
    from feeflow.llm.queries import QUERIES

    rng = np.random.default_rng(4)
    line = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10**9, 12))
    passages = [[line() for _ in range(n)] for n in (2, 2, 2, 3, 3, 3, 4, 5, 6) for _ in range(4)]
    rows, own = [], {}
    for i in range(4 * len(passages)):
        a, b = [line() for _ in range(3)], [line() for _ in range(3)]
        own[i] = "\n".join(a + b)
        rows.append((i, "\n".join(a + passages[i % len(passages)] + b), "en", "s"))
    path = _table(spark, rows)
    kept = {r.doc_id: r for r in QUERIES["op6_line_dedup"](spark, path).collect()}
    import hashlib

    for i, text, *_ in rows:
        want = text if i < len(passages) else own[i]
        assert kept[i].kept_md5 == hashlib.md5(want.encode()).hexdigest(), i
        assert kept[i].n_removed_lines == (0 if i < len(passages) else len(passages[i % len(passages)]))


def _table(spark, rows) -> str:
    import tempfile

    path = tempfile.mkdtemp()
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    return path


def test_packing_splits_words_as_the_tokenizer(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    texts = ["a\x1cb", "a \x1d\x1e c\x1f", "A\x1fB\x1c", "x <|ENDOFTEXT|> y", "X<|EndOfText|>Y z", "x<|endoftext|>y <|startoftext|> Z", "<| A |>"]
    texts += [f"a{chr(c)}B" for c in [*range(1, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]]
    tok = Tokenizer.from_file(path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in packing.pack(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4")
        assert (got[i].start, got[i].length, got[i].ids_crc32) == (0, len(ids), zlib.crc32(ids.tobytes())), t


def test_quality_rejects_a_long_passage_pasted_twice(spark):
    w = [f"w{k:03}" for k in range(200)]
    long = w[:168] + w[20:36] + w[168:184]  # 16 words twice: 32 of 200 words, below the base rule's 20 %
    short = [*w[:180], *(x for k in range(4) for x in (*w[20 * k : 20 * k + 5], f"x{k}"))]  # four phrases of 5 words twice: 40 of 204
    got = {r.doc_id: r for r in quality.quality_rules(frame(spark, [(i, " ".join(x), "en", "s") for i, x in enumerate((long, short, w))])).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [got[i].kept for i in range(3)] == [False, True, True]


def test_lm_vocabulary_grows_and_stays_normalised():
    sizes = []
    for kinds in (1000, 4000):
        top = pa.table({"h": np.arange(1, kinds + 1), "c": np.full(kinds, 9)})
        sizes.append(len(lm_scores.vocabulary(top, 9 * kinds, None).unigram))
    assert sizes == [1002, 4002]
    k, rng = 700, np.random.default_rng(3)  # two levels
    uni = 1.0 / np.arange(1, k + 1)
    uni /= uni.sum()
    trainer = lm_scores.Trainer(uni, 8)
    ids = [0]
    for _ in range(30000):  # the next id follows the one before, mostly
        ids.append((ids[-1] * 7 + 3) % k if rng.random() < 0.8 else int(rng.integers(k)))
    ids = np.array(ids)
    x = np.arange(2, len(ids))
    before = lm_scores.LogBilinear(trainer.p).log10(ids[x - 1], ids[x - 2], ids[x]).mean()
    for _ in range(6):
        for lo in range(2, len(ids) - 512, 512):
            y = np.arange(lo, lo + 512)
            trainer.fit(ids[y - 1], ids[y - 2], ids[y])
    model = lm_scores.LogBilinear(trainer.p)
    a, b = rng.integers(0, k, 50), rng.integers(0, k, 50)
    w = np.tile(np.arange(k), 50)
    p = 10 ** model.log10(np.repeat(a, k), np.repeat(b, k), w)
    assert np.allclose(p.reshape(50, k).sum(1), 1, atol=1e-4)
    after = model.log10(ids[x - 1], ids[x - 2], ids[x]).mean()
    assert after > before + 0.1


def test_packing_looks_words_up_like_the_tokenizer(monkeypatch):
    import random

    from public_tokenizers import path
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path("word_bpe_49k.json"))
    r = random.Random(4)
    parts = [*"aAbBzJHTWY  \n\t\x0b\x1c\x85\xa0  　éÉßñİΣσς日本̱́̌̈̊<>|'s12,.!🙂", "<|endoftext|>", "<|ENDOFTEXT|>", " the ", " The ", "x" * 20]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    for cache, same_hash in ((100, False), (10**6, True)):  # forgets all the time; all words of one length have one hash
        monkeypatch.setattr(packing, "CACHE", cache)
        if same_hash:
            monkeypatch.setattr(packing.Texts, "word_hashes", lambda self, a, b, lower=True: (b - a).astype(np.uint64))
        ids = packing._WordIds(path("word_bpe_49k.json"))
        for k in range(0, len(texts), 100):
            for lo, hi, t in packing.texts_of(pa.array(texts[k : k + 100])):
                got, begin = ids.ids(t)
                assert [got[begin[i] : begin[i + 1]].tolist() for i in range(hi - lo)] == want[k + lo : k + hi]


def test_packing_word_table_grows(monkeypatch):
    from public_tokenizers import path

    ids = packing._WordIds(path("word_bpe_49k.json"))
    monkeypatch.setattr(ids, "_encoded", lambda words: [[int(w[1:])] for w in words])
    ids.slot_hash, ids.slot_word = np.zeros(8, np.uint64), np.zeros(8, np.int32)
    for part in (range(3), range(2000), range(1000, 5000)):
        t = next(packing.texts_of(pa.array([" ".join(f"w{i}" for i in part)])))[2]
        assert ids.ids(t)[0].tolist() == list(part)


def test_lm_average_in_groups_is_the_weighted_mean(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "FAN_IN", 2)
    r = np.random.default_rng(2)
    x, seen = r.normal(size=(7, 2, 5)), r.integers(1, 50, 7)
    rows = [(lo * 5, shard, int(seen[shard]), [float(v) for v in x[shard, lo]]) for shard in range(7) for lo in range(2)]
    got = lm_scores._averaged(spark.createDataFrame(rows, "lo long, shard long, seen long, x array<float>").repartition(3), 7)
    want = (x * seen[:, None, None]).sum(0) / seen.sum()
    assert got.column("lo").to_pylist() == [0, 5]
    assert np.allclose(got.column("x").to_pylist(), want, atol=1e-5)


def test_lm_rare_words_share_their_bucket(spark):
    rows = [(i, f"a b c a b rare{i} rare{i % 7}", "en", "s") for i in range(300)]
    out = {r.doc_id: r for r in lm_scores.lm_scores(frame(spark, [*rows, (1000, "never", "en", "s"), (1001, "", "en", "s")]), size=5).collect()}
    assert out[1000].n_known == 1 and out[1001].n_known == 1 and out[1000].score < out[1001].score < 0
    # With all rare words in buckets, a seen one is more likely than an unseen one of the same bucket, by (c + 1).
    assert np.isfinite([r.score for r in out.values()]).all()


def test_language_texts_without_ids_are_drawn_one_by_one(spark):
    from feeflow.llm import language

    rows = [(None, f"the weather on day {i} is fine and we go out", "en", "s") for i in range(400)] + [(i, f"le temps du jour {i} est beau", "fr", "s") for i in range(400)]
    few, all_ = (language.train(frame(spark, rows), "doc_id", "text", "lang", per_language=n) for n in (100, 400))
    assert few.langs == all_.langs == ["en", "fr"]
    # A quarter of either language was drawn, with ids or without: its n-grams vary less than those of all.
    assert not np.array_equal(few.score, all_.score)
    out = language.predict(frame(spark, rows[:5] + rows[-5:]), few).collect()
    assert {(r.doc_id is None, r.lang_pred) for r in out} == {(True, "en"), (False, "fr")}


def test_workers_hold_little_beside_their_texts():
    texts = pa.array(["some words " * 100] * 4000)
    assert max(len(t.buf) for _, _, t in packing.texts_of(texts)) <= 1 << 20
    uni = np.full(5000, 1 / 5000)
    model = lm_scores.LogBilinear(lm_scores.Trainer(uni, 16).p)
    ids = np.random.default_rng(3).integers(0, len(uni), 100_000)
    tracemalloc.start()
    model.log10(ids, ids[::-1], ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * len(ids)  # bytes a token; one vector of DIMENSIONS alone has 128


def test_packing_word_table_stays_small(monkeypatch):
    from public_tokenizers import path

    assert 2 * packing.CACHE <= packing.SLOTS == len(packing._WordIds(path("word_bpe_49k.json")).slot_hash)
    ids = packing._WordIds(path("word_bpe_49k.json"))
    monkeypatch.setattr(ids, "_encoded", lambda words: [[int(w[1:])] for w in words])
    ids.slot_hash, ids.slot_word = np.zeros(8, np.uint64), np.zeros(8, np.int32)
    for n in range(100, 6000, 100):
        ids.ids(next(packing.texts_of(pa.array([" ".join(f"w{i}" for i in range(n))])))[2])
        assert 2 * n <= len(ids.slot_hash) <= max(8, 4 * n)


def test_packing_word_table_is_filled_in_place(monkeypatch):
    from public_tokenizers import path

    ids = packing._WordIds(path("word_bpe_49k.json"))
    monkeypatch.setattr(ids, "_encoded", lambda words: [[int(w[1:])] for w in words])
    look = lambda a, b: ids.ids(next(packing.texts_of(pa.array([" ".join(f"w{i}" for i in range(a, b))])))[2])[0]
    look(0, 100_000)
    tracemalloc.start()
    assert look(100_000, 100_100).tolist() == list(range(100_000, 100_100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000  # a copy of what the table holds has 24 bytes a word and more
    sizes = []
    monkeypatch.setattr(packing._WordIds, "ids", lambda self, t: sizes.append(len(t.buf)) or (np.zeros(0, np.uint32), np.zeros(len(t) + 1, np.int64)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(["some words " * 100] * 2000)], ["id", "text"])
    assert sum(len(b) for b in packing._map_pieces(iter([batch]), path("word_bpe_49k.json"), 2048, 0)) == 2000
    assert sum(sizes) == 2000 * 1100 and max(sizes) <= 1 << 19


def test_lm_workers_hold_parameters_in_single_precision():
    import pickle

    k, n = 300_000, 100_000
    uni = np.full(k, 1 / k)
    start = lm_scores._start(k, 16, uni)
    parameters = sum(v.nbytes for v in start.values())
    assert len(pickle.dumps(lm_scores.LogBilinear(start))) < 1.1 * parameters
    ids = pa.array(np.random.default_rng(3).integers(0, k, (1000, n // 1000)).astype(np.int32).tolist(), pa.list_(pa.int32()))
    table = pa.table({"key": pa.array(range(1000), pa.int64()), "shard": pa.array([0] * 1000, pa.int64()), "ids": ids})
    flat = lm_scores._flat(start)
    before = flat.copy()
    tracemalloc.start()
    lm_scores._fit_shard(table, uni, 16, flat)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * parameters + (20 << 20)  # a copy, its squared gradients, the work of a minibatch
    assert (flat == before).all()


def test_workers_give_freed_memory_back(monkeypatch):
    from feeflow.llm import text

    seen = []
    monkeypatch.setattr(text, "give_back", lambda: seen.append("back"))
    assert list(text.giving_back(iter([1, 2]))) == [1, 2] and seen == ["back"]
    monkeypatch.undo()
    text.give_back()


def test_workers_get_few_texts_at_once(spark, monkeypatch):
    from feeflow.llm import store

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def sizes():
        return {r[0] for r in spark.range(0, 900, 1, 1).mapInArrow(lambda it: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in it), "n long").collect()}

    before = spark.conf.get(key, None)
    with store.small_batches(spark, 300):
        assert sizes() == {300}
        with store.small_batches(spark, 400):
            assert sizes() == {300}
    assert spark.conf.get(key, None) == before and sizes() == {900}
    # The packing's texts go through it, however many there are.
    seen = []
    monkeypatch.setattr(packing, "small_batches", lambda s: seen.append(s) or store.small_batches(s, 50))
    rows = [(i, f"a b c {i}", "en", "s") for i in range(120)]
    assert packing.pack(frame(spark, rows)).count() == 120 and len(seen) == 1
