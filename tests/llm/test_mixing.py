from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from keyfold.llm import mixing


def goals(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Shares by weight; what is above the cap is shared again until nothing is."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total >= most * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            free.remove(s)
            left -= out[s]
    return out


def check(rows, got, **options):
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    expected = goals(sizes, **options)
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=str) == sorted(((i, s, size(t)) for i, t, s in rows), key=str)
    for source, whole in sizes.items():
        mine = [r for r in got if r.source == source]
        assert {r.source_size for r in mine} == {whole}
        assert mine[0].target == pytest.approx(expected[source])
        assert abs(sum(r.taken for r in mine) - expected[source]) <= 1
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
        assert sum(r.size > 0 and r.taken % r.size > 0 for r in mine) <= 1


@pytest.mark.parametrize("weights", [(5, 2, 1), (1,), (1, 100)])
def test_awkward_rows(docs, weights):
    check([(r.doc_id, r.text, r.source) for r in docs.collect()], mixing.mix(docs, weights=weights).collect(), weights=weights)


def test_given_table(sample):
    got = mixing.mix(sample).collect()
    check([(r.doc_id, r.text, r.source) for r in sample.collect()], got)
    again = mixing.mix(sample.repartition(5)).collect()
    assert sorted(got) == sorted(again)


def test_rates_are_tilts(sample):
    """Within a source, the log rate is in proportion to the size."""
    rows = mixing.mix(sample).where("rate < 2 and size > 0").collect()
    for source in {r.source for r in rows}:
        import math
        slopes = [math.log(r.rate) / r.size for r in rows if r.source == source]
        assert max(slopes) - min(slopes) <= 1e-9 * max(1e-9, max(map(abs, slopes))) + 1e-12


def test_empty(no_docs, docs):
    assert mixing.mix(no_docs).count() == 0
    assert {r.taken for r in mixing.mix(docs.where("text is null")).collect()} == {0}


def test_only_dataframe_functions(docs):
    assert "Python" not in mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()


def test_mixed_documents(docs):
    taken = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert out.agg(F.sum(mixing.word_count("text"))).first()[0] == taken
