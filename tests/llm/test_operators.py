"""Every operator against its brute-force form on a table with odd cases."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feeflow.llm import embedding_tiles, language, line_chunks, lm_scores, mixing, ngram_join, packing, quality, repeats, token_counts
from feeflow.llm.graph import components
from feeflow.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.fixtures import SCHEMA, counts, frame, least_reachable, lower, make_docs, shingle_sets, words

ROWS = make_docs()


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


def test_components_of_chain_and_star(spark):
    import random

    ids = random.Random(1).sample(range(10**6), 300)
    edges = list(zip(ids[:199], ids[1:200], strict=True)) + [(ids[200], x) for x in ids[201:]] + [(5, 5)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == set(ids)
    assert len({got[x] for x in ids[:200]}) == 1 and len({got[x] for x in ids[200:]}) == 1 and len(set(got.values())) == 2
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("points", [None, 4])
def test_ngram_join(spark, docs, points, monkeypatch):
    if points:  # everything by slices, windows and rings
        for name, value in (("REGION_POINTS", points), ("REGION_SHINGLES", 3000), ("PRUNE_POINTS", 6)):
            monkeypatch.setattr(ngram_join, name, value)
    sets = shingle_sets(ROWS)
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = least_reachable([r[0] for r in ROWS], links)
    want = counts((r[0], len(s), x) for r, s, x in zip(ROWS, sets, least, strict=True))
    got = ngram_join.ngram_jaccard_join(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert counts(got.collect()) == want
    assert len(set(least)) < len({r[0] for r in ROWS}) - 60


@pytest.mark.parametrize("families", [14, 1])
def test_large_regions_by_cells_and_rings(spark, families, monkeypatch):
    """Families of near texts are cut into cells of cells; one family of texts all about as far from each other into rings."""
    import random

    r = random.Random(5)
    texts = []
    for f in range(families):
        base = [f"f{f}w{i}" for i in range(120)]
        for _ in range(280 // families):
            w = base[:]
            for _ in range(r.choice([1, 2, 2, 3, 5])):
                w[r.randrange(120)] = f"x{r.randrange(10**9)}"
            texts.append(" ".join(w))
    hints = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    sets = [set(x.tolist()) for x in ngram_join._sets(pa.array(texts), 5, hints)]
    fp = [int(ngram_join._fingerprint(x)) for x in ngram_join._sets(pa.array(texts), 5, hints)]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    monkeypatch.setattr(ngram_join, "REGION_POINTS", 16)
    calls = {"_to_pivots": 0, "_ring_rows": 0}
    for name in calls:
        def spy(*args, name=name, to=getattr(ngram_join, name)):
            calls[name] += 1
            return to(*args)
        monkeypatch.setattr(ngram_join, name, spy)
    members = spark.createDataFrame([(7, f, len(s), 1) for f, s in zip(fp, sets, strict=True)], "region long, fp long, n long, copies long")
    got = ngram_join._links_of_large(members, spark.createDataFrame(list(zip(fp, texts, strict=True)), "fp long, text string"), 5, 80, hints)
    at = {f: i for i, f in enumerate(fp)}
    found = [(at[e.a], at[e.b]) for e in got.collect()]  # pairs that connect what links connect
    ids = list(range(len(fp)))
    assert least_reachable(ids, found) == least_reachable(ids, links)
    assert calls["_to_pivots"] > 1 if families > 1 else calls["_ring_rows"] == 1


def test_repeats(docs):
    length, seen = 400, {}
    raw = [(r[1] or "").encode() for r in ROWS]
    for b in raw:
        for k in range(len(b) - length + 1):
            seen[b[k : k + length]] = seen.get(b[k : k + length], 0) + 1
    want = []
    for r, b in zip(ROWS, raw, strict=True):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want.append((r[0], len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = repeats.remove_repeats(docs).collect()
    assert counts(tuple(x)[:5] for x in got) == counts(want)
    assert all(x.n_kept == x.n_bytes - x.n_removed for x in got)
    assert sum(x[2] for x in want) > 20_000


def test_repeats_of_very_many_equal_rows(spark):
    rows = [(None, ROWS[3][1], None, None)] * 3000 + [(1, "apart " + "".join(map(str, range(300))), None, None)]
    got = repeats.remove_repeats(frame(spark, rows).repartition(6)).collect()
    n = len(ROWS[3][1].encode())
    assert n >= 400 and counts((x.doc_id, x.n_removed, x.n_spans, x.n_kept) for x in got) == counts([(None, n, 1, 0)] * 3000 + [(1, 0, 0, len(rows[-1][1]))])


def test_token_counts(docs):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = [(r[0], len((r[1] or "").encode()), n, n > 4096) for r, n in ((r, len(sp.encode(r[1] or ""))) for r in ROWS)]
    assert counts(token_counts.token_counts(docs).collect()) == counts(want)
    rng = np.random.default_rng(0)
    alphabet = list("aab  \n\t\réßñ日本語한а́🙂<s></s>▁<0x0A>xyzthe.,1234567890")
    texts = ["".join(rng.choice(alphabet, n)) for n in rng.choice([1, 2, 5, 30, 500], 400)]
    texts += ["a" * 3000, " " * 70, "\n" * 7, " a", "a ", "a\n b", "the" * 300]
    model = token_counts.PieceBpe(public_tokenizers.path("piece_bpe_32k.model"))
    assert model.count(texts) == [len(x) for x in sp.encode(texts)]


def test_language(spark, docs):
    model = language.train(docs.filter(~language.is_held_out("doc_id")), "doc_id", "text", "lang")
    assert model.langs == ["en", "fr", "ru"]
    got = {r.doc_id: r for r in language.predict(docs, model, spans=True).collect()}
    by_id = {r[0]: r for r in ROWS}
    assert len(got) == len(by_id)
    for i, r in got.items():
        has = any(ch.isalpha() for ch in by_id[i][1] or "")
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not has)
        if by_id[i][2] and (i % 5 or i >= 60) and i < 120:
            assert r.lang_pred == by_id[i][2]
    mixed = " ".join([*words(by_id[60][1])[:60], *words(by_id[90][1])[:30]])
    one = language.predict(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model, spans=True).first()
    assert one.lang_pred == "en" and [s.lang for s in one.spans] == ["en", "fr"]
    assert abs(one.spans[0].n - 60) <= 3
    nothing = language.LanguageModel([], np.zeros((0, language.BUCKETS)), np.zeros((0, len(language.SCRIPTS))))
    assert language.predict(docs, nothing).filter("lang_pred <> 'und' or score <> 0").count() == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    sizes = [5, 0, 3, 6, 1]
    begin = np.concatenate(([0], np.cumsum(sizes)))
    score = rng.normal(0, 2, (sum(sizes), 3))
    path = language.viterbi(score, begin, 1.5)
    import itertools

    for a, b in zip(begin[:-1], begin[1:], strict=True):
        value = lambda p, s=score[a:b]: sum(s[i, k] for i, k in enumerate(p)) - 1.5 * sum(x != y for x, y in zip(p, p[1:], strict=False))
        best = max((value(p) for p in itertools.product(range(3), repeat=b - a)), default=0)
        assert math.isclose(value(path[a:b].tolist()), best, abs_tol=1e-9)


def test_language_held_out_accuracy(spark):
    out = QUERIES["op4_language_id"](spark, SF_SMALL.replace("0.001", "0.01"))
    truth = spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "lang")
    right, n = out.filter("held_out").join(truth, "doc_id").selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert n > 200 and right >= 0.98 * n


def test_packing(docs):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path("word_bpe_49k.json"))
    ids = {r[0]: [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in ROWS}
    got = packing.pack(docs).collect()
    n_rows = {}
    for r in ROWS:
        n_rows[r[0]] = n_rows.get(r[0], 0) + 1
    want = counts(
        (i, k, k * 2048, len(x[k * 2048 : (k + 1) * 2048]), zlib.crc32(np.array(x[k * 2048 : (k + 1) * 2048], "<u4").tobytes()))
        for i, x in ids.items() for _ in range(n_rows[i]) for k in range(-(-len(x) // 2048))
    )
    assert counts(r[:5] for r in got) == want
    end: dict[int, int] = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end.get(r.sequence_id, 0)
        end[r.sequence_id] = r.offset + r.length
    assert max(end.values()) <= 2048
    room: list[int] = []  # best fit, longest first
    for n in sorted((r.length for r in got), reverse=True):
        k = min((k for k in range(len(room)) if room[k] >= n), key=lambda k: room[k], default=None)
        if k is None:
            room.append(2048 - n)
        else:
            room[k] -= n
    assert len(end) <= 1.02 * len(room) + 1


def test_packing_plan_uses_few_sequences():
    rng = np.random.default_rng(0)
    for lens in (rng.integers(1, 300, 3000), rng.integers(1, 129, 500), np.full(10, 128), np.array([1])):
        size, n = np.unique(lens, return_counts=True)
        got = packing.plan(size, n, 300)
        used: dict[int, int] = {}
        for many, content in got:
            assert sum(a * b for a, b in content) <= 300
            for a, b in content:
                used[a] = used.get(a, 0) + many * b
        assert used == dict(zip(size.tolist(), n.tolist(), strict=True))
        fractional = sum(packing.fractional(size, n, 300).values())
        assert sum(m for m, _ in got) <= 1.06 * max(fractional, lens.sum() / 300) + 1


def _chunked(text):
    """Chunks of lines by the rule of the operator, in plain Python."""
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, first = [], 0
    for i in range(len(lines)):
        if ((h[i - 1] if i else 0) * line_chunks.BASE + h[i]) % line_chunks.DIVISOR == 0 or i == len(lines) - 1:
            out.append(lines[first : i + 1])
            first = i + 1
    return out


def test_line_dedup(docs):
    places: dict[str, set] = {}
    for i, text, *_ in ROWS:
        for no, c in enumerate(_chunked(text) if text is not None else []):
            if len(c) > 1 and words("\n".join(c)):
                places.setdefault("\n".join(c), set()).add((i, no))
    want = []
    for i, text, *_ in ROWS:
        if text is None:
            want.append((i, None, 0, 0, 0))
            continue
        cs = _chunked(text)
        gone = [no for no, c in enumerate(cs) if min(places.get("\n".join(c), {(i, no)})) != (i, no)]
        kept = "\n".join("\n".join(c) for no, c in enumerate(cs) if no not in gone)
        want.append((i, kept, text.count("\n") + 1, sum(len(cs[no]) for no in gone), len(gone)))
    out = line_chunks.dedup_line_chunks(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed_lines", "n_removed_chunks"]
    got = out.select("doc_id", "text", "n_lines", "n_removed_lines", "n_removed_chunks").collect()
    assert counts(got) == counts(want)
    assert sum(w[3] for w in want) > 50


def test_mixing(docs):
    got = mixing.mix_to_targets(docs).collect()
    again = mixing.mix_to_targets(docs.repartition(7)).collect()
    assert counts(got) == counts(again)
    source = {r[0]: r[3] for r in ROWS}
    size = {}
    for r in ROWS:
        size[r[3]] = size.get(r[3], 0) + len(words(r[1]))
    order = [*sorted(s for s in size if s is not None), None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(size.values()), set()
    while True:
        share = (total - sum(3 * size[s] for s in capped)) / (sum(weight[s] for s in order if s not in capped) or 1)
        more = {s for s in order if s not in capped and share * weight[s] >= 3 * size[s]}
        if not more:
            break
        capped |= more
    taken: dict = {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s]
        assert math.isclose(r.target, 3 * size[s] if s in capped else share * weight[s])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken.setdefault(s, []).append(r.taken)
    for s in order:
        t = 3 * size[s] if s in capped else share * weight[s]
        largest = max(r.size for r in got if source[r.doc_id] == s)
        assert abs(sum(taken[s]) - t) <= largest * 2


def test_mixing_favours_odds(spark):
    rows = [(i, "w " * (64 if i % 2 else 1024), "en", "s" if i < 4000 else "t") for i in range(8000)]
    got = mixing.mix_to_targets(frame(spark, rows)).collect()
    more = {k: [r.copies for r in got if r.doc_id < 4000 and r.size == k] for k in (64, 1024)}
    assert abs(sum(r.taken for r in got if r.doc_id < 4000) - got[0].target if got[0].doc_id < 4000 else 0) <= 1024
    assert sum(more[1024]) > 1.2 * sum(more[64])  # the tilt; each rank is a random odds over inclusion odds


def test_quality(docs):
    rules = quality.Rules()
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    for i, text, *_ in ROWS:
        w = words(text)
        seen, dup = set(), 0
        for line in (text or "").split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        covered = {}
        for n in (5, *rules.covered):
            c = {}
            for k in range(len(w) - n + 1):
                c[tuple(w[k : k + n])] = c.get(tuple(w[k : k + n]), 0) + 1
            mark = [False] * len(w)
            for k in range(len(w) - n + 1):
                if c[tuple(w[k : k + n])] > 1:
                    mark[k : k + n] = [True] * n
            covered[n] = mark
        r = got[i]
        n_symbols = sum(ch in "#*$%&|<>" for ch in text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), n_symbols, dup, sum(covered[5])), i
        failed = len(w) < 10 or 100 * sum(covered[5]) > 20 * len(w)
        assert r.base_failed == failed and not (failed and r.kept)
        share = max(sum(len(x) for x, m in zip(w, covered[n], strict=True) if m) for n in rules.covered) / max(1, r.word_chars)
        assert math.isclose(r.covered_share, share)
    assert sum(r.kept for r in got.values()) > 100


def _vectors():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (400, 24)).astype(np.float32)
    x[100:160] = x[7] + rng.normal(0, 0.18, (60, 24))
    x[200:230] = x[9] * np.linspace(0.1, 30, 30)[:, None]
    x[300:320] = x[11]
    rows = [(i, v.tolist(), "clash") for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [nan] * 24, [inf] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0], [1e30] * 24, [3.0] * 24, [-0.0] * 24]
    return rows + [(1000 + i, v, "clash") for i, v in enumerate(odd)] + [rows[11]]


@pytest.mark.parametrize("tile", [None, 64])
def test_embeddings(spark, tile, monkeypatch):
    if tile:
        monkeypatch.setattr(embedding_tiles, "TILE", tile)
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, m string")
    good = [i for i, (_, v, _) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = []
    unit = {i: np.array(rows[i][1], np.float32).astype(float) for i in good}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in unit.items()}
    for a in good:
        links += [(a, b) for b in good if b < a and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    n_links = np.bincount(np.array(links).ravel(), minlength=len(rows))
    least = least_reachable([r[0] for r in rows], links)
    want = counts((r[0], int(n), c, r[0] == c) for r, n, c in zip(rows, n_links, least, strict=True))
    assert counts(embedding_tiles.embedding_near_dedup(df).collect()) == want
    assert n_links.max() > 20


@pytest.mark.parametrize("held", [1 << 18, 50])
def test_lm_scores(docs, held):
    held_out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(r[0], [*words(lower(r[1] or "")), "\n"]) for r in ROWS]
    c: dict[str, int] = {}
    for i, ts in tokens:
        for t in ts if not held_out(i) else []:
            c[t] = c.get(t, 0) + 1
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in lm_scores.lm_scores(docs, size=40, held_counts=held).collect()}
    for i, ts in tokens:
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(i), len(ts), sum(t in c for t in ts), n)
        assert math.isclose(r.base_score, sum(math.log10((c.get(t, 0) + 1) / (n + v + 1)) for t in ts), rel_tol=1e-9)
        assert r.score < 0
    base = sum(r.base_score for r in got.values() if r.held_out)
    assert sum(r.score for r in got.values() if r.held_out) > 1.05 * base


def test_log_bilinear_model_is_normalised_and_learns():
    rng = np.random.default_rng(1)
    k = 12
    uni = np.full(k, 1 / k)
    trainer = lm_scores.Trainer(uni, 8)
    ids = [0, 1]
    for _ in range(20000):  # the next id follows the one before, mostly
        ids.append((ids[-1] * 5 + 1) % k if rng.random() < 0.8 else int(rng.integers(k)))
    ids = np.array(ids)
    for lo in 8 * list(range(2, len(ids) - 512, 512)):
        x = np.arange(lo, lo + 512)
        trainer.fit(ids[x - 1], ids[x - 2], ids[x])
    model = lm_scores.LogBilinear(trainer.p)
    a, b, w = (g.ravel() for g in np.meshgrid(np.arange(k), np.arange(k), np.arange(k), indexing="ij"))
    p = 10 ** model.log10(a, b, w)
    assert np.allclose(p.reshape(k, k, k).sum(2), 1, atol=1e-4)
    x = np.arange(2, len(ids))
    assert model.log10(ids[x - 1], ids[x - 2], ids[x]).mean() > np.log10(1 / k) + 0.3


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    model = language.train(none, "doc_id", "text", "lang")
    for out in (
        mixing.mix_to_targets(none), ngram_join.ngram_jaccard_join(none), token_counts.token_counts(none), language.predict(none, model),
        packing.pack(none), line_chunks.dedup_line_chunks(none), repeats.remove_repeats(none), quality.quality_rules(none),
        embedding_tiles.embedding_near_dedup(vectors), lm_scores.lm_scores(none),
    ):
        assert out.collect() == []


def test_null_columns(spark):
    rows = [(None, None, None, None), (None, "a b c d e f", None, None), (1, None, None, None), (None, "a b c d e f", None, None)]
    df = frame(spark, rows)
    model = language.train(df, "doc_id", "text", "lang")
    assert ngram_join.ngram_jaccard_join(df).count() == 4
    assert sum(r.taken for r in mixing.mix_to_targets(df).collect()) == 12
    assert language.predict(df, model).filter("lang_pred = 'und'").count() == 4
    assert packing.pack(df).selectExpr("sum(length)").first()[0] == 2 * 7 + 2
    assert line_chunks.dedup_line_chunks(df).filter("text is null").count() == 2
    assert repeats.remove_repeats(df).selectExpr("sum(n_bytes)").first()[0] == 22
    assert quality.quality_rules(df).filter("not base_failed").count() == 0
    assert lm_scores.lm_scores(df).selectExpr("sum(n_tokens)").first()[0] == 16
    assert token_counts.token_counts(df).count() == 4
    nulls = spark.createDataFrame([(None, [1.0, 2.0]), (None, [2.0, 4.0]), (3, None)], "vec_id long, embedding array<double>")
    got = counts(embedding_tiles.embedding_near_dedup(nulls).collect())
    assert got == counts([(None, 1, None, True), (None, 1, None, True), (3, 0, 3, True)])


def test_tiles_travel_once_per_block_in_reach(spark):
    """However many tiles are in reach of each other, each is copied to a fixed number of blocks; far ones don't meet."""
    copies = {}
    for n in (55, 110):
        size = embedding_tiles._block_size(n, 64)
        tiles = spark.createDataFrame([(t, t / n / 10, (t + 1) / n / 10, t // size) for t in range(n)], "tile long, lo double, hi double, block long")
        near = embedding_tiles._pair_tiles(tiles, 0.3)
        assert near.select("a", "b").distinct().count() == 66 and near.groupBy("a", "b", "tile").count().filter("count > 1").isEmpty()
        copies[n] = near.count() / n
    assert copies[55] == copies[110] == 11
    assert embedding_tiles._block_size(10**6, 64) == 16 and embedding_tiles._block_size(10**6, 10**5) == 1
    far = tiles.withColumns({c: F.col(c) * 1000 for c in ("lo", "hi")})
    assert {(r.a, r.b) for r in embedding_tiles._pair_tiles(far, 0.3).select("a", "b").distinct().collect()} == {(i, j) for i in range(11) for j in (i, i + 1) if j < 11}
