"""The filter audit against counting every order by hand."""

import itertools
import re

import pytest

from gleaner.llm import interactions

LABELS = "doc_id long, quality int, toxic int"


def by_hand(rows, grades):
    """{(part, order, step): counts} by applying the filters in every order; `rows` are (id, text, part)."""
    told = []
    for i, text, part in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": re.search("[#$%&*|]", text) is not None,
                 "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)}
        mine = [g for g in grades if g[0] == i and i is not None]
        told.append((part or "", fails, any(g[1] == 1 for g in mine), any(g[2] == 1 for g in mine)))
    found, total = {}, {}
    for part in {t[0] for t in told}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [t for t in told if t[0] == part]
            out = []
            for step, name in enumerate(order, 1):
                here = [t for t in left if t[1][name]]
                failing = [t for t in told if t[0] == part and t[1][name]]
                left = [t for t in left if not t[1][name]]
                out.append((len(left), len(here), len(failing) - len(here), sum(sum(t[1].values()) == 1 for t in failing),
                            sum(t[2] for t in here), sum(t[3] for t in here)))
                total[part, name] = total.get((part, name), 0) + len(here)
                found[part, order, step] = out[-1]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


ROWS = [(1, words(250), "en"), (2, words(250), "de"), (2, words(250), "en"), (3, words(250), None), (3, words(300), "en"),
        (None, words(250), "en"), (None, None, "en"), (4, None, "en"), (5, "", "en"), (6, " \n\t", None), (7, "same " * 400, "en"),
        (8, "same " * 400, "en"), (9, words(250) + " 50% off", "en"), (10, words(250).upper(), "en"), (11, "ÀÉ " * 300, "de"),
        (12, "# A B", "de"), (13, "x\x85y " + words(199), "en"), (14, "word " + words(60_000), "en"), (15, "A " * 50_000, "")]
GRADES = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (5, 1, 1), (7, None, 1), (8, 1, None), (12, 1, 1), (99, 1, 1), (None, 1, 1), (14, 1, 0)]


@pytest.mark.parametrize("parts", [1, 5])
def test_audit_equals_counting_by_hand(spark, parts):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in ROWS], "doc_id long, text string, lang string, good int, id string, n int")
    labels = spark.createDataFrame(GRADES, LABELS)
    rows = interactions.audit(docs.repartition(parts), labels).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in interactions.COUNTS) for r in rows} == by_hand(ROWS, GRADES)
    assert len(rows) == 3 * 600


def test_copies_of_one_text_in_a_third_of_all_rows(spark):
    docs = spark.createDataFrame([(i, words(200) if i % 3 else words(200, 1000 + i), "en") for i in range(300)], "doc_id long, text string, lang string")
    rows = interactions.audit(docs, spark.createDataFrame([], LABELS)).filter("filter_order = 'ABCDE' and step = 5").collect()
    assert [(r.kept, r.removed, r.unique_fails, r.shapley) for r in rows] == [(101, 199, 199, 120 * 199)]


def test_other_filters_and_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert interactions.audit(empty, spark.createDataFrame([], LABELS)).collect() == []
    docs = spark.createDataFrame([(1, "a b c", "en"), (2, "a", "en"), (3, "$", "en")], "doc_id long, text string, lang string")
    found = interactions.audit(docs, spark.createDataFrame([], LABELS), {"X": "n_words < 3", "Y": "has_symbol"})
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in found.collect()}
    assert got == {("XY", 1): (1, 2, 0, 1, 3), ("XY", 2): (1, 0, 1, 0, 1), ("YX", 1): (2, 1, 0, 0, 1), ("YX", 2): (1, 1, 1, 1, 3)}


def test_nothing_but_digests_is_shuffled(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    plan = interactions.audit(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
