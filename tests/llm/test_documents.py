"""op1, op2, op3, op5 on small tables with every odd case, and their SQL."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import collected, corpus, documents, prose  # noqa: F401

from gaugeflow.llm import decontaminate, langid, licenses, quality


def sql(statement: str, **tables) -> list[tuple]:
    db = duckdb.connect()
    for name, df in tables.items():
        db.register(name, df.toArrow())
    result = db.execute(statement)
    return [d[0] for d in result.description], result.fetchall()


@pytest.fixture
def unique(corpus):
    seen: dict = {}
    for i, text in corpus:
        seen.setdefault(i, text)
    return list(seen.items())


def test_quality_equals_sql(documents, unique):
    docs = documents(unique).withColumnRenamed("block", "low").drop("words")
    found = quality.judge(docs, min_group=3)
    names, wanted = sql(quality.oracle_sql(min_group=3), documents=docs)
    assert collected(found.select(*names)) == sorted(wanted, key=repr)
    kept = {r.doc_id: (r.base_failed, r.kept) for r in found.collect()}
    assert kept[0] == kept[1] == kept[3] == (True, False)
    assert kept[48] == (True, False) and kept[10] == (False, True)


def test_quality_outliers_and_repeated_rows(documents):
    rows = [(k, prose(60, k)) for k in range(40)]
    rows += [(90, " ".join(w + "***" for w in prose(60, 91).split()))] * 2
    found = {r.doc_id: r.kept for r in quality.judge(documents(rows)).collect()}
    assert not found[90] and all(found[k] for k in range(40))
    assert quality.judge(documents(rows)).count() == 42
    assert quality.judge(documents([])).count() == 0


def test_containment_equals_sql(spark, documents, unique):
    items = [
        (1, prose(70, 99)),
        (2, prose(70, 98)),
        (3, " ".join(prose(6000, 5).split()[100:500])),
        (4, "one two"),
        (5, None),
        (6, "of the of the of the"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(unique)
    found = decontaminate.contaminations(docs, benchmark)
    names, wanted = sql(decontaminate.ORACLE_SQL, documents=docs, benchmark=benchmark)
    assert collected(found.select(*names)) == sorted(wanted, key=repr)
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert {(43, 1), (44, 1), (45, 1), (50, 3), (51, 3), (48, 6), (49, 6)} <= pairs
    clean = decontaminate.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in unique} - {d for d, _ in pairs}
    shuffled = decontaminate.Rules(broadcast_rows=0)
    assert collected(decontaminate.contaminations(docs, benchmark, shuffled)) == collected(found)
    assert decontaminate.contaminations(documents([]), benchmark).count() == 0
    assert decontaminate.contaminations(docs, benchmark.limit(0)).count() == 0


LANGUAGES = {"aa": "er th on in re wh", "bb": "ción que ñ las rr os", "cc": "sch ung ß keit ü der"}


@pytest.fixture(scope="module")
def labelled() -> list[tuple]:
    draw = np.random.default_rng(2)
    rows = []
    for k in range(600):
        lang = list(LANGUAGES)[k % 3]
        n = int(draw.integers(4, 120))
        words = draw.choice(LANGUAGES[lang].split(), (n, 2))
        rows.append((k, " ".join(a + b for a, b in words), lang if k % 10 else None, lang))
    return rows


def test_language_on_the_held_out_fold(spark, labelled):
    odd = [(1000, None, "aa", "aa"), (1001, "12 .. 3", "aa", "aa"), (1002, "", None, "x")]
    odd += [(1003, "erth " * 20_000, "zz", "aa"), (1003, "erth onin", None, "aa")]
    schema = "doc_id long, text string, lang string, truth string"
    docs = spark.createDataFrame(labelled + odd, schema)
    found = langid.identify(docs).collect()
    assert len(found) == len(labelled) + len(odd)
    truth = {r[0]: r[3] for r in labelled}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.lang_pred for r in found}
    assert by_id[1000] == by_id[1001] == by_id[1002] == "und" and by_id[1003] in LANGUAGES | {"zz": 0}
    assert langid.identify(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", docs["lang"].substr(9, 1)).filter("doc_id = 1")
    unlabelled = unlabelled.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert [r.lang_pred for r in langid.identify(unlabelled).collect()] == ["und"]


def test_windows_cover_every_byte():
    offsets = np.array([0, 0, 5, 5 + langid.WINDOW, 900])
    owner, start, held = langid.window_places(offsets)
    seen = np.concatenate([np.arange(s, s + h) for s, h in zip(start, held, strict=True)])
    assert seen.tolist() == list(range(900)) and 0 not in owner


def test_gradients_match_differences():
    draw = np.random.default_rng(1)
    widths, each, d = (2, 3), 3, 4
    weights = [draw.normal(size=(257, d))]
    weights += [draw.normal(size=(w * d, each)) for w in widths]
    weights += [draw.normal(size=6) + 1, draw.normal(size=(6, 2)), draw.normal(size=2)]
    x = draw.integers(0, 256, (5, 12))
    target, weight = np.array([0, 1, 1, 0, 1]), np.ones(5)

    def loss() -> float:
        embed, *filters, bias, out, out_bias = weights
        net = langid.Network(("a", "b"), widths, embed, tuple(filters), bias, out, out_bias)
        return -np.log(net.probabilities(x)[np.arange(5), target]).mean()

    grads = langid._gradients(x, target, weight, widths, each, weights)
    for w, g in zip(weights, grads, strict=True):
        place = tuple(draw.integers(0, n) for n in w.shape)
        if w.shape == (257, d):
            place = (int(x[0, 3]), 1)
        held = w[place]
        w[place] = held + 1e-5
        up = loss()
        w[place] = held - 1e-5
        down = loss()
        w[place] = held
        assert abs((up - down) / 2e-5 - g[place]) < 1e-4


def test_licences(documents):
    lines = {
        1: ("mit", "Released under the MIT License."),
        2: ("apache", "Licensed under the Apache License, Version 2.0"),
        3: ("gpl", "this work is licensed under the GNU General Public License, version 3"),
        4: ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
        5: ("unknown", "All rights reserved."),
        6: ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    }
    rows = [(k, prose(40, k)) for k in range(100, 400)]
    rows += [(k, f"{prose(40, k)}\n{line}\n{prose(30, k + 50)}") for k, (_, line) in lines.items()]
    rows += [(7, None), (8, ""), (9, lines[1][1]), (9, lines[1][1]), (10, prose(9000, 4) + "\n" + lines[1][1])]
    docs = documents(rows)
    found = licenses.scan(docs).collect()
    by_doc = {r.doc_id: r for r in found}
    for k, (family, _) in lines.items():
        assert by_doc[k].family == family, k
        assert by_doc[k].confirmed == (family != "unknown")
    assert sum(r.doc_id == 9 for r in found) == 2 and by_doc[10].family == "mit"
    assert set(by_doc) <= {*lines, 9, 10}
    model = licenses.train(docs.select("doc_id", "text").na.fill({"text": ""}))
    assert licenses.scan(documents([]), model=model).count() == 0


def test_text_bytes_of_a_slice():
    column = pa.array(["ab", None, "é", ""]).slice(1, 3)
    from gaugeflow.llm.common import text_bytes

    data, offsets = text_bytes(column)
    assert data.tobytes() == "é".encode() and offsets.tolist() == [0, 0, 2, 2]
