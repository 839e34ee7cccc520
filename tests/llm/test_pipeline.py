"""The stages on the odd table: what each keeps, drops and returns."""

from __future__ import annotations

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.fixtures import frame, make_docs, shingle_sets, words


def test_stages(spark, tmp_path):
    rows = make_docs()
    path = str(tmp_path / "documents.parquet")
    frame(spark, rows).write.parquet(path)
    docs = spark.read.parquet(path)
    cols, seen = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language_id" and len(corpus_pipeline.STAGES) == 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        step = str(tmp_path / f"out{k}")
        out.write.parquet(step)
        docs = seen[name] = spark.read.parquet(step)
        if k < 4:
            assert docs.columns == cols
    kept = {r.doc_id for r in seen["language_id"].collect()}
    assert kept >= set(range(126)) and not kept & {130, 131, 132, 138, 140}
    near = seen["ngram_jaccard_join"].collect()
    sets = [s for s in shingle_sets([tuple(r) for r in near]) if s]
    assert all(100 * len(a & b) < 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert {r.doc_id for r in near} <= kept
    lines = seen["line_dedup"].collect()
    assert sum(len(words(r.text)) for r in lines) < sum(len(words(r.text)) for r in seen["language_id"].collect())
    mixed = seen["mixing"].collect()
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in near} and len(mixed) != len(near)
    sequences: dict[int, int] = {}
    for r in docs.collect():
        sequences[r.sequence_id] = sequences.get(r.sequence_id, 0) + r.length
    assert max(sequences.values()) <= 2048


def test_run_on_the_given_tables(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 100


def test_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
