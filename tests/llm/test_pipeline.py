"""The stages in a row, each against brute force on what it was given."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from corpus_cases import collected, prose
from test_neardup import expected
from test_repeats import WORD, covered

from gaugeflow.llm import common, decontaminate

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
def test_stages(spark):
    docs = common.table(spark, SF_DIR, "documents")
    columns = docs.columns
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        results[name] = (docs, common.stored(stage(spark, docs, SF_DIR), "test-stage"))
        docs = results[name][1]
        if name != "packing":
            assert docs.columns == columns

    before, after = results["language"]
    assert after.count() == before.count() and after.exceptAll(before).count() == 0

    before, after = results["near_duplicates"]
    pairs = [(r.doc_id, r.text) for r in before.collect()]
    wanted = {i for i, _, _, kept in expected(pairs, 5) if kept}
    assert {r.doc_id for r in after.collect()} == wanted

    before, after = results["repeated_passages"]
    texts = sorted((r.doc_id, tuple(WORD.findall(r.text))) for r in before.collect())
    kept = {
        i: [w for w, g in zip(words, gone, strict=True) if not g]
        for (i, words), gone in zip(texts, covered(texts, 13), strict=True)
    }
    got = {r.doc_id: (WORD.findall(r.text), r.n_chars, len(r.text)) for r in after.collect()}
    assert {i: words for i, (words, _, _) in got.items()} == kept
    assert all(n == size for _, n, size in got.values())

    before, after = results["benchmark_leaks"]
    grams = [
        {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        for (text,) in common.table(spark, SF_DIR, "benchmark").select("text").collect()
        for w in [WORD.findall(text.lower())]
    ]
    clean = set()
    for r in before.collect():
        words = WORD.findall(r.text.lower())
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        if not any(g and 100 * len(g & own) >= 80 * len(g) for g in grams):
            clean.add(r.doc_id)
    assert {r.doc_id for r in after.collect()} == clean

    before, after = results["packing"]
    packed = after.toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in before.collect()}
    assert packed.groupby("sequence_id").length.sum().max() <= 2048

    run = contract.queries()["pipeline"](spark, SF_DIR)
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert collected(run.select(*own)) == collected(after.select(*own))


def test_rows_without_an_id_of_their_own(spark):
    text, other = prose(60, 1), prose(60, 2)
    rows = [(None, text), (None, text), (3, text), (5, other), (5, other), (None, prose(60, 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.remove_near_duplicates(spark, docs, SF_DIR)
    assert collected(kept) == sorted([(3, text), (5, other), rows[5]], key=repr)

    passage = " ".join(prose(60, 4).split())
    rows = [(7, passage), (7, f"start {passage} end"), (None, f"other {passage} tail"), (None, f"x {passage}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = corpus_pipeline.remove_repeated_passages(spark, docs, SF_DIR).collect()
    found = sorted(((r.doc_id, len(WORD.findall(r.text))) for r in cut), key=repr)
    sizes = [(7, 60), (7, 2), (None, 2), (None, 1)]
    swapped = [(7, 0), (7, 62), (None, 2), (None, 1)]  # rows of one id may come in either order
    assert found in (sorted(sizes, key=repr), sorted(swapped, key=repr))

    benchmark = spark.createDataFrame([(1, prose(20, 5))], "item_id long, text string")
    leak = f"start {prose(20, 5)} end"
    rows = [(None, leak), (None, text), (2, leak), (2, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = decontaminate.decontaminate(docs, benchmark)
    assert collected(clean) == sorted([(None, text), (2, other)], key=repr)


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, block int"
    rows = [(1, None, "en", "s", 0, 1), (2, "", None, None, 0, 2), (None, "a b c", "en", "s", 5, 3)]
    rows += [(k, f"the text of number {k} " * 5, "en", "s", 99, 4) for k in (3, 3, 4)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, SF_DIR), "test-stage")
        assert docs.columns == [part.split()[0] for part in schema.split(", ")]
    assert {r.doc_id for r in docs.collect()} == {None, 3, 4}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
