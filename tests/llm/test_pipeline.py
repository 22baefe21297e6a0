"""The pipeline against plain forms of its stages, and what every stage promises."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarrymill.llm import language_id
from tests.llm.test_language_and_mixture import plain_targets
from tests.llm.test_scan_pack_vectors import check_batches
from tests.llm.test_text_dedup import plain_components, plain_lines, plain_simhash, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_run_agree_with_plain_forms(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], folder).write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    assert all(f.columns == docs.columns for f in frames[:-1])
    told, lines, single, mixed, packed = [f.collect() for f in frames[1:]]

    model = language_id.fit(docs)
    rows = docs.collect()
    marks = language_id.classify([r.text for r in rows], model)
    assert Counter(map(tuple, told)) == Counter(tuple(r) for r, m in zip(rows, marks) if m[3])
    assert len(told) > 0.97 * len(rows)

    want = plain_lines([(r.doc_id, r.text) for r in told], 10)
    assert Counter((r.doc_id, r.text) for r in lines) == Counter((d, t) for d, t, _, _ in want.elements())
    assert all(r.n_chars == len(r.text) for r in lines)

    ids = [r.doc_id for r in lines]
    component = plain_components(ids, [plain_simhash(r.text) for r in lines])
    assert {tuple(r) for r in single} == {tuple(r) for r, c in zip(lines, component) if r.doc_id == c}

    size, longest = Counter(), Counter()
    for r in single:
        size[r.source] += len(words(r.text))
        longest[r.source] = max(longest[r.source], len(words(r.text)))
    target, taken = plain_targets(size), Counter()
    assert set(map(tuple, mixed)) <= set(map(tuple, single)) and max(Counter(r.doc_id for r in mixed).values()) <= 2
    for r in mixed:
        taken[r.source] += len(words(r.text))
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 for s in target)

    check_batches(packed, 65_536, len(mixed))
    assert Counter(r.doc_id for r in packed) == Counter(r.doc_id for r in mixed)
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).collect())) == Counter(map(tuple, packed))


@pytest.mark.parametrize("rows", [[], [(None, None), (None, ""), (1, None), (1, "a b"), (1, "a b")], [(2, "the cat sat on the mat", "en", None)]])
def test_stages_take_awkward_tables(make_docs, spark, folder, rows):
    docs = make_docs(rows, {"fingerprint": F.lit("x"), "_times": F.lit(1)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        out.collect()
    corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()


def test_texts_with_many_copies_stay_once(make_docs, spark, folder):
    rows = [(i, "one text\nin many copies") for i in range(12)] + [(100 + i, f"common\nown {i}") for i in range(10)]
    got = corpus_pipeline.unshared_lines(spark, make_docs(rows), folder)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(
        rows[:12] + [(100 + i, f"own {i}") for i in range(10)])
    kept = [r.text for r in corpus_pipeline.one_of_each(spark, got, folder).collect()]
    assert kept.count("one text\nin many copies") == 1
