"""Hard negatives, license templates and lexical search against their plain versions, and on awkward inputs."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from creditloom.llm import hard_negatives, lexical, licenses, queries
from creditloom.llm.license_templates import TEMPLATES

VECTORS = "vec_id long, embedding array<double>, label int, score long, row string, `rank` int, upper string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, "x", 1, None) for i, label, v in rows], VECTORS).repartition(3)


def mined(df, **options):
    return sorted((tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **options).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def expected(rows, **options):
    return brute.hard_negatives([(i, label, v, i is not None and i % 10 == 0) for i, label, v in rows], **options)


def test_hard_negatives_equal_the_plain_version(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), [rng.choice([-1.0, 0.25, 0.5, 0.501, 1.0]) for _ in range(4)]) for i in range(120)]
    assert mined(vectors(spark, rows)) == expected(rows)
    assert mined(vectors(spark, rows), positives=2, negatives=3, low=0, high=100) == expected(rows, positives=2, negatives=3, low=0, high=100)


def test_hard_negatives_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = [1.0, 0.5]
    rows = [
        (10, 1, base), (10, 1, base), (10, 1, base), (11, 1, base), (None, 1, base), (20, 1, [0.5]), (30, 2, []), (40, None, base), (50, 1, None),
        (60, 1, [1.0, None]), (70, 1, [nan, 1.0]), (80, 1, [inf, 1.0]), (12, 2, [0.5, 0.5]), (12, 2, [0.5, 0.5]), (None, 3, [0.5, 0.5]), (13, 2, [0.25]), (90, 4, [-1.0, -1.0]), (91, 4, [1.0, 1.0]),
    ]
    assert mined(vectors(spark, rows)) == expected(rows)
    assert mined(vectors(spark, [])) == []
    assert mined(vectors(spark, rows[12:13])) == []


def test_scores_stay_exact_where_doubles_are_not(spark):
    rows = [(10, 1, [1e6, 1e6, 3.0]), (11, 1, [1e6, 1e6, 1.0]), (12, 2, [9e5, 8e5, 1.0]), (13, 2, [9e5, 8e5, 1.0 + 1 / 256]), (14, 2, [9e5, 8e5, 1.0 + 2 / 256])]
    assert mined(vectors(spark, rows)) == expected(rows)
    huge = [(10, 1, [1e300, 1.0]), (11, 1, [1e300, 1.0]), (12, 2, [1e299, 0.0])]
    assert all(0 <= r[4] < 1 << 62 for r in mined(vectors(spark, huge), high=100))


def test_slots_hold_each_row_once(spark):
    """Windows overlap; a row is kept in the slot of the least upper limit it reaches."""
    import pyarrow as pa

    anchors = pa.table({"row": pa.array([0]), "label": pa.array(["a"]), "vector": pa.array([[1]], pa.list_(pa.int32())), "upper": pa.array([[90, 60]]), "lower": pa.array([[30, 20]])})
    rows = pa.table({"row": pa.array(range(1, 101)), "label": pa.array(["b"] * 100), "vector": pa.array([[i] for i in range(1, 101)], pa.list_(pa.int32()))})
    _, slot, score, _ = hard_negatives.search(anchors, rows, 4, True)
    assert sorted(zip(slot.tolist(), score.tolist(), strict=True)) == [(0, 87), (0, 88), (0, 89), (0, 90), (1, 57), (1, 58), (1, 59), (1, 60)]


FILLED = {"{{1..20}}": "the authors", "{{1..12}}": "some name here", "{{1..8}}": "two words", "{{1..6}}": "this one", "{{0..8}}": "2001 by us", "{{1..3}}": "new", "{{1..4}}": "4 0"}


def instance(template, optional):
    """A text of the template, with its optional regions or without."""
    import re

    for mark, said in FILLED.items():
        template = template.replace(mark, said)
    template = re.sub(r"\{\{(.*?)\}\}", lambda m: m[1].split("|")[-1], template, flags=re.S)
    while "[[" in template:
        template = re.sub(r"\[\[((?:(?!\[\[|\]\]).)*)\]\]", r" \1 " if optional else " ", template, flags=re.S)
    return template


@pytest.mark.parametrize(("label", "name", "template"), TEMPLATES)
def test_every_template_takes_its_own_text(label, name, template):
    scanner = licenses.Scanner([(label, template)], [])
    for optional in (True, False):
        words = licenses.terms(("Before it. " + instance(template, optional) + " And after.").encode())
        assert [p[0] for p in scanner.places(words)] == [label]
        assert brute.template_expression(template).search(" ".join(w.decode() for w in words) + " ")
        run = licenses.compiled(label, template).run
        at = next(i for i in range(len(words)) if words[i : i + len(run)] == run)
        for gone in {at, at + len(run) - 1, at + len(run) // 2}:  # one mandatory word less
            assert not list(scanner.places(words[:gone] + words[gone + 1 :])) or label in ("lgpl",)


def test_automata_equal_regular_expressions():
    rng = random.Random(3)
    templates = ["a [[b [[c]] ]] d", "{{a|b c|}} d {{0..2}} a", "[[{{1..2}} b]] c d [[a]]", "{{1..3}} a b", "a b {{2..2}}", "d"]
    for template in templates:
        scanner, plain = licenses.Scanner([("x", template)], []), brute.template_expression(template)
        for _ in range(400):
            words = [rng.choice("abcd") for _ in range(rng.randrange(9))]
            line = "".join(w + " " for w in words)
            found = {(s, e) for _, s, e, _ in scanner.places([w.encode() for w in words])}
            assert bool(found) == bool(plain.search(line)), (template, words)
            for s, e in found:
                assert plain.fullmatch("".join(w + " " for w in words[s:e])), (template, words, s, e)


def test_markup_faults_are_told():
    for template in ("a [[ b", "a ]] b", "[[a]] {{1..2}}", ""):
        with pytest.raises(ValueError):
            licenses.compiled("x", template)


LICENSED = [
    None, "", " \n", "Released under the MIT License. Released UNDER the-mit license!", "under the mit under the mit license", "cc by nc cc by nc",
    "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "Apache License, Version 2.0", "under thé mit license",
    "x" * 100_000 + " All rights reserved. " + "under the mit license " * 20_000,
]


def test_license_scan_on_odd_texts(spark):
    schema = "doc_id long, text string, spans string, n_words string, covered int"
    rows = [(i, t, "x", None, 1) for i, t in enumerate(LICENSED)] + [(3, LICENSED[3], None, None, None), (None, LICENSED[6], None, None, None)]
    found = licenses.scan(spark.createDataFrame(rows, schema).repartition(3)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = LICENSED[r.doc_id] if r.doc_id is not None else LICENSED[6]
        n, places = brute.phrase_places(text, licenses.PHRASES)
        assert r.n_words == n and sorted((s["label"], s["start"]) for s in r.spans if s["base"]) == sorted(places)
        assert 0 <= r.covered <= r.n_words
    labels = {r.doc_id: {s["label"] for s in r.spans} for r in found}
    assert labels[7] == {"gpl-3"} and labels[6] == {"cc-by-nc"} and labels[9] == set() and labels[10] == {"mit", "all-rights-reserved"}
    assert licenses.scan(spark.createDataFrame([], schema)).count() == 0


def test_license_query_columns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in queries.op12_license_scan(spark, SF_DIR).collect():
        n, places = brute.phrase_places(texts[r.doc_id], licenses.PHRASES)
        starts = [p for _, p in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for label, _ in places})) and 0 <= r.score <= 1
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}


def ranked(docs, items, **options):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.rank(docs, items, **options).collect())


DOCS = "doc_id long, text string, score long, id string, terms string, `row` int"


def test_lexical_search_equals_the_plain_version(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "x y", "1", "A"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 30, 80]), weights=range(len(words), 0, -1))) for _ in range(400)] + [None, "", "...", "w0 " * 5000]
    texts += [texts[5]] * 30  # ties
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[7]), (None, texts[7])]
    items = [(i, " ".join(rng.choices(words, k=9))) for i in range(12)] + [(12, None), (13, ""), (14, "nowhere"), (15, texts[5])]
    rows = spark.createDataFrame([(*d, 5, "x", None, 1) for d in docs], DOCS).repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    for k in (50, 3):
        got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.rank(rows, asked, k).collect()]
        assert sorted(got, key=str) == sorted(brute.lexical(docs, items, k), key=str)


def test_lexical_search_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "x", None, 2)], DOCS)
    items = spark.createDataFrame([(1, "a"), (1, "a")], "item_id long, text string")
    assert lexical.rank(docs.limit(0), items).count() == 0 and lexical.rank(docs, items.limit(0)).count() == 0
    assert lexical.rank(docs.withColumn("text", F.lit(None).cast("string")), items).count() == 0
    two = docs.unionByName(docs.withColumns({"doc_id": F.lit(2).cast("long"), "text": F.lit("c")}))
    impact = 10**9 // (1000 + 20 * (50 + 50 * 2 * 2 // 3))
    assert ranked(two, items) == [(1, 1, 1, int(1000 * np.log(6 / 3)) * impact)] * 2


def tree(rng, groups, size, width):
    """Documents of some groups with terms of their own; (tree, dense values)."""
    values = np.zeros((groups * size, width), np.int64)
    for g in range(groups):
        own = rng.choice(width, 12, replace=False)
        for i in range(g * size, (g + 1) * size):
            values[i, rng.choice(own, 9, replace=False)] = rng.integers(10**8, 10**9)
    starts = np.r_[0, np.cumsum((values > 0).sum(axis=1))]
    return lexical.BallTree(starts, np.nonzero(values)[1], values[values > 0], width), values


def test_balls_hold_their_documents_and_prune():
    rng = np.random.default_rng(4)
    ball, values = tree(rng, 16, 256, 600)
    for node in ball.nodes:
        centre = np.zeros(600)
        centre[node.terms] = node.centroid
        assert np.sqrt(((values[ball.order[node.low : node.high]] - centre) ** 2).sum(axis=1)).max(initial=0) <= node.radius
        most = values[ball.order[node.low : node.high]][:, node.terms].max(axis=0, initial=0)
        assert (most <= (node.centroid + node.axes) * (1 + lexical.SLACK) + 1).all()
    leaves = sum(n.parts is None for n in ball.nodes)
    visited = 0
    for _ in range(30):
        query = np.sort(np.flatnonzero(values[rng.integers(len(values))]))
        scores, docs, seen = ball.search(query, 5)
        plain = values[:, query].sum(axis=1)
        order = np.lexsort((np.arange(len(plain)), -plain))[:5]
        assert docs.tolist() == order.tolist() and scores.tolist() == plain[order].tolist()
        visited += seen
    assert visited < 0.1 * 30 * leaves


def test_tree_of_copies_and_of_nothing():
    copies = lexical.BallTree(np.arange(0, 1001, 2), np.tile([0, 3], 500), np.tile([5, 7], 500), 4)
    assert copies.search(np.array([0]), 3)[:2][1].tolist() == [0, 1, 2] and max(n.high - n.low for n in copies.nodes if n.parts is None) <= lexical.LEAF
    assert copies.search(np.array([1]), 3)[1].tolist() == []
    assert lexical.BallTree(np.array([0]), np.empty(0, int), np.empty(0, int), 1).search(np.array([0]), 3)[1].tolist() == []
    assert lexical.BallTree(np.array([0, 0, 0]), np.empty(0, int), np.empty(0, int), 1).search(np.array([0]), 3)[1].tolist() == []
