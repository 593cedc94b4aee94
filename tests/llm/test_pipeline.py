"""The pipeline's stages against plain versions of what they should keep."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from keyfold.llm.common import workers_find_package  # noqa: E402
from tests_llm_brute import components, repeated  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    workers_find_package(spark)
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["input"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline._written(stage(spark, docs, SF), "test").cache()
        out[name] = docs.collect()
    return out


def test_documents_of_known_languages_stay(stages):
    assert sorted(r.doc_id for r in stages["language_id"]) == sorted(r.doc_id for r in stages["input"] if any(c.isalpha() for c in r.text or ""))


def test_one_document_of_each_group_stays(stages):
    groups = components([(r.doc_id, r.text) for r in stages["language_id"]])
    assert sorted(r.doc_id for r in stages["near_duplicates"]) == sorted(d for d, c in groups.items() if d == c)


def test_passages_are_cut(stages):
    expected = repeated([(r.doc_id, r.text) for r in stages["near_duplicates"]])
    assert {r.doc_id: r.text for r in stages["repeated_passages"]} == {d: t for d, t in expected.items() if t.strip()}


def test_sources_meet_targets(stages):
    words = lambda rows: sum(len((r.text or "").encode().split()) for r in rows)
    assert words(stages["mix_sources"]) == pytest.approx(1.5 * words(stages["repeated_passages"]), rel=0.01)
    assert all(r.n_chars == len(r.text) for r in stages["mix_sources"])


def test_all_tokens_are_packed(stages):
    assert sum(r.length for r in stages["pack_sequences"] if r.start == 0) > 0
    assert sum(r.doc_tokens for r in stages["pack_sequences"] if r.start == 0) == sum(r.length for r in stages["pack_sequences"])
    assert sum(r.start == 0 for r in stages["pack_sequences"]) == len(stages["mix_sources"])


def test_columns(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert list(stages[name][0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_is_the_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == len(stages["pack_sequences"])


def test_awkward_rows(spark, docs, no_docs):
    for rows in (docs, no_docs):
        out = rows
        for _, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline._written(stage(spark, out, SF), "test")
            out.count()


def test_rows_of_null_id_are_near_duplicates_too(spark, docs):
    """One row of each component stays, though ids are null or repeated."""
    from llm_data import prose

    near = lambda i, tail: prose(i, 60) + tail
    rows = [(None, near(1, " a b")), (7, near(1, "")), (5, near(1, " c")), (None, near(1, "")),  # a document has an id
            (None, near(2, "")), (None, near(2, " x")), (None, near(2, " x")),  # none has
            (9, near(3, "")), (9, near(3, " y")), (9, near(4, "")),  # one id, two groups
            (None, "?!" * 30)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.text.split()[0]) for r in corpus_pipeline.near_duplicates(spark, table, SF).collect()]
    first = lambda i: prose(i, 1)
    assert sorted(got, key=str) == sorted([(5, first(1)), (None, first(2)), (9, first(3)), (9, first(4)), (None, "?!" * 30)], key=str)
