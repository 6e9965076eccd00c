"""Rows that keep() and the pipeline's stages must not lose, and texts on which work must stay in proportion."""

from __future__ import annotations

import time

import brute
import pytest
from conftest import SF_DIR

import corpus_pipeline
from creditloom.llm import near_dedup, pii, secrets

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, hash long, open int, `row` string, _removed int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "x", 1, 0, "r", 9) for i, t, s in rows], DOCS).repartition(3)


def prose(k, n=80):
    return " ".join(f"w{(k * 7919 + j * j * 31 + j) % 9973}" for j in range(n))


def test_keep_loses_no_document(spark):
    near = prose(1) + " end"
    rows = [(1, prose(1), "a"), (1, prose(2), "a"), (1, prose(1), "b"), (2, near, "a"), (1, near, "a"), (3, prose(3), "a"), (3, prose(3), "a"), (4, None, "a"), (4, None, "a"), (5, " \n", "a"), (None, prose(1), "a"), (None, prose(4), "a")]
    kept = near_dedup.keep(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    group = [t for none, d, t in texts if t in (prose(1), near) and not none]
    assert len(group) == 1  # one of the group of five rows
    assert (False, 1, prose(2)) in texts and [d for _, d, t in texts if t == prose(3)] == [3]
    assert [t for _, d, t in texts if d == 4] == ["", ""] and (False, 5, " \n") in texts
    assert sorted(t for none, _, t in texts if none) == sorted([prose(1), prose(4)])
    assert near_dedup.keep(frame(spark, [])).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, stage):
    """Nulls in every column, repeated rows, empty and blank texts, clashing extra columns, no rows."""
    rows = [(1, prose(1), "a"), (1, prose(1), "a"), (2, prose(2) + "\nshared line of some length\n", None), (3, prose(3) + "\nshared line of some length", "a"), (4, None, "b"), (None, prose(5), "b"), (5, "", "a"), (6, " \n ", None)]
    docs = frame(spark, rows)
    out = stage(spark, docs, SF_DIR)
    last = stage is corpus_pipeline.STAGES[-1][1]
    assert [c for c in out.columns if c != "replica"] == docs.columns and ("replica" in out.columns) == last
    assert {r.doc_id for r in out.collect()} <= {1, 2, 3, 4, 5, 6, None}
    assert all(r._removed == 9 and r.id == "x" for r in out.collect())
    assert stage(spark, frame(spark, []), SF_DIR).count() == 0
    without = stage(spark, docs.drop("n_chars"), SF_DIR)
    assert "n_chars" not in without.columns and without.count() == out.count()


def test_secret_scan_is_linear_in_runs():
    automaton = secrets.keyword_automaton()
    began = time.time()
    assert secrets.find_secrets("eyJ" * 350_000, automaton) == []
    assert time.time() - began < 5
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abc"
    text = "eyJ" * 1000 + " " + token + " eyJx." + token
    assert (len("eyJ" * 1000) + 1) in [a for k, a, _, _ in secrets.find_secrets(text, automaton) if k == "jwt"]


def test_personal_data_in_long_texts(spark):
    text = "write a.b@c.example.org now " * 100_000
    began = time.time()
    row = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert len(row.spans) == 100_000 and row.spans[-1]["start"] == len(text) - len("a.b@c.example.org now ") and time.time() - began < 60
    for n in (0, 1, 2, 3, 5, 17, 100):
        short = "call +1 (212) 555-0100 or 4111 1111 1111 1111, mail x@y.z or 10.0.0.1; " * n
        found = pii.find(spark.createDataFrame([(1, short)], "doc_id long, text string")).collect()[0].spans
        assert [(s["kind"], s["start"], s["end"]) for s in found if s["kind"] in ("email", "ip", "card", "phone")] == brute.private(short)
