"""The stages of the pipeline, each on its own input, against brute force."""

import pytest

import corpus_pipeline
from lacuna.llm import quality_model
from lacuna.llm.tables import written

from .test_dedup import brute_components, brute_lines
from .test_text import check_packed, direct_ids, whole_mix, whole_targets

STAGES = dict(corpus_pipeline.STAGES)


def triples(rows):
    return [(r["doc_id"], r["text"], r["source"]) for r in rows]


def whole_rows(rows):
    return sorted(map(str, rows))


def good(spark, ids):
    return spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")


def check_pieces(rows, docs):
    """All tokens of all documents are in the sequences, each once."""
    check_packed(rows, 2048)
    want = sorted((str(i), len(direct_ids(t))) for i, t, _ in docs)
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in rows if r["start"] == 0) == want
    assert sum(r["length"] for r in rows) == sum(n for _, n in want)


def test_stage_order():
    assert list(STAGES) == ["quality_classifier", "line_dedup", "ngram_join", "source_mixing", "packing"]


def test_classifier_stage_drops_what_it_rejects(spark, odd_docs, odd_rows, as_table):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    folder = as_table(labels=labels)
    out = STAGES["quality_classifier"](spark, odd_docs, folder)
    assert out.columns == odd_docs.columns
    scored = quality_model.classify(odd_docs, labels, odd_docs.columns, names=("__s", "__p")).collect()
    kept = [r[:-2] for r in scored if r["__p"] == 1]
    assert whole_rows(map(tuple, out.collect())) == whole_rows(kept)
    assert 0 < len(kept) < len(odd_rows)


def test_stages_equal_brute_force(spark, odd_docs, odd_rows, as_table):
    folder = as_table(documents=odd_docs, labels=good(spark, range(12)))
    docs, columns = odd_docs, odd_docs.columns

    def stage(name):
        out = written(STAGES[name](spark, docs, folder))
        assert name == "packing" or out.columns == columns
        return out, out.collect()

    docs, rows = stage("quality_classifier")  # labels of one class keep all
    assert whole_rows(rows) == whole_rows(odd_docs.collect())

    before = triples(rows)
    docs, rows = stage("line_dedup")
    want = brute_lines([(i, t) for i, t, _ in before if i is not None])
    assert whole_rows((r["doc_id"], r["source"]) for r in rows) == whole_rows(
        (i, s) for i, _, s in before)
    assert all(r["text"] == want.get(r["doc_id"]) for r in rows if r["doc_id"] is not None)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
    assert any(t and t != want[i] for i, t, _ in before if i is not None)

    before = triples(rows)
    docs, rows = stage("ngram_join")
    roots = brute_components([r[:2] for r in before if r[0] is not None])
    assert {r["doc_id"] for r in rows} == {*roots.values(), None}
    assert set(triples(rows)) <= set(before) and len(rows) < len(before)
    filled = [r["doc_id"] for r in rows if r["text"] and r["text"].split()]
    assert len(filled) == len(set(filled))

    before = triples(rows)
    targets = whole_targets(before, docs)
    docs, rows = stage("source_mixing")
    assert sorted(triples(rows), key=str) == whole_mix(before, targets)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)

    _, packed = stage("packing")
    check_pieces(packed, triples(rows))

    check_pieces(corpus_pipeline.run(spark, folder).collect(), triples(rows))


def test_run_on_an_empty_table(spark, no_docs, as_table):
    assert corpus_pipeline.run(spark, as_table(documents=no_docs, labels=good(spark, []))).count() == 0


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stages_on_an_empty_table(name, spark, no_docs, as_table):
    out = STAGES[name](spark, no_docs, as_table(labels=good(spark, [])))
    assert out.columns == no_docs.columns and out.count() == 0
