"""The topic sweep on blocks of records: the same models whatever the blocks, and the rule of expectation-maximisation."""

import os
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.operators import cluster, topics


def corpus(spark):
    rows = [(i, ["storm", "coast", "rain"] * (1 + i % 3) + [f"w{i}"] if i % 2 else ["dog", "cat", "storm"] + [f"w{i}"] * 2) for i in range(40)]
    return spark.createDataFrame(rows + [(None, ["dog", "tax"]), (1, ["tax"]), (77, []), (78, None)], "doc_id bigint, lemmas array<string>")


def swept(lists):
    rows = cluster.topic_sweep(lists, ks=(3, 2), num_words=4, passes=4).collect()
    return {(r.k, r.topic, r["rank"]): (r.term, round(r.weight, 4)) for r in rows}


def test_models_do_not_depend_on_blocks_or_partitions(spark, monkeypatch):
    lists = corpus(spark)
    one = swept(lists.repartition(1))
    assert len(one) == 20 and one == swept(lists.repartition(7))
    monkeypatch.setattr(topics, "BLOCK", 30)
    assert one == swept(lists)


def test_sweep_follows_the_rule(spark):
    lists = corpus(spark)
    terms = cluster.doc_terms(lists)
    numbers = cluster.term_numbers(terms)
    rows = terms.join(numbers.select("lemma", "number"), "lemma").select(F.xxhash64("doc_id").alias("doc"), "number", "n").collect()
    size, n = numbers.count(), np.array([r.n for r in rows], float)[:, None]
    docs, d = np.unique([r.doc for r in rows], return_inverse=True)
    w = np.array([r.number for r in rows])
    shares = topics._uniform(docs[d], w, 3, 7)
    for step in range(5):
        shares *= n / shares.sum(1, keepdims=True)
        by_doc, by_word = np.zeros((len(docs), 3)), np.zeros((size, 3))
        np.add.at(by_doc, d, shares)
        np.add.at(by_word, w, shares)
        shares = (by_word[w] + 0.1) * (by_doc[d] + 50 / 3) / (by_word.sum(0) + 0.1 * size)
    found = {(r.topic, r.number): r.weight for r in topics.sweep(terms, numbers, (3,), size, 4).collect()}
    assert len(found) == 3 * size
    for (topic, number), weight in found.items():
        assert weight == pytest.approx(by_word[number, topic] / by_word[:, topic].sum(), rel=1e-4)


def test_no_words_no_topics(spark):
    assert cluster.topic_sweep(corpus(spark).filter("doc_id > 76"), ks=(2,)).collect() == []


def test_each_word_is_written_once_a_pass(spark, monkeypatch):
    """Whatever the number of blocks; before, every block wrote its own counts of a word."""
    written, scratch = [], topics.scratch

    @contextmanager
    def noted(session):
        with scratch(session) as keep:
            def write(df, name="scratch", **options):
                out = keep(df, name, **options)
                if name == "topic-counts":
                    written.append(out.filter(f"kind IN ({topics.SHARED}, {topics.LOCAL})").agg(F.sum(F.octet_length("counts"))).first()[0])
                return out
            yield write
    monkeypatch.setattr(topics, "scratch", noted)
    monkeypatch.setattr(topics, "BLOCK", 30)
    terms = cluster.doc_terms(corpus(spark))
    numbers = cluster.term_numbers(terms)
    topics.sweep(terms, numbers, (3,), 4, 1)
    assert written == [numbers.count() * 3 * 4] * 2


def test_models_do_not_depend_on_the_others_of_their_group(spark, monkeypatch):
    lists = corpus(spark)
    assert topics._groups([10, 9, 8, 7, 6]) == [(0, [10, 9]), (19, [8, 7]), (34, [6])] and topics._groups([30, 2]) == [(0, [30]), (30, [2])]
    together = swept(lists)
    monkeypatch.setattr(topics, "WIDTH", 1)
    assert swept(lists) == together


def test_words_of_records_are_deleted_before_the_passes(spark, monkeypatch):
    left, fit, stage = [], topics._fit, cluster.doc_terms
    made = []
    monkeypatch.setattr(cluster, "doc_terms", lambda *a, **b: made.append(stage(*a, **b)) or made[-1])

    def noted(*a):
        left.extend(p for p in made[0].inputFiles() if os.path.exists(p.removeprefix("file://").removeprefix("file:")))
        return fit(*a)
    monkeypatch.setattr(topics, "_fit", noted)
    assert len(swept(corpus(spark))) == 20 and made[0].inputFiles() and not left


@pytest.mark.parametrize("chunk, tile, heavy", [(1000, 64, 3), (97, 16, 5), (1 << 18, 1 << 12, 64)])
def test_chunks_add_up(monkeypatch, chunk, tile, heavy):
    """One block's counts from chunks that cut records, with words of many and of few occurrences, against plain sums."""
    for name, value in (("CHUNK", chunk), ("TILE", tile), ("HEAVY", heavy)):
        monkeypatch.setattr(topics, name, value)
    draw = np.random.default_rng(5)
    rows = sorted({(int(d) - 20, int(w)) for d, w in zip(draw.integers(0, 40, 4000), 300 * draw.random(4000) ** 3)})
    d, w = np.array(rows).T
    n = draw.integers(1, 400, len(d))
    df = np.bincount(w)[w] + (w % 7 == 0)  # these words are in another block too
    keys, ks = [4, 9], [3, 2]
    batches = [pa.record_batch([d[a:a + 50], (w << 32 | n)[a:a + 50], df[a:a + 50]], names=["doc", "entry", "df"]) for a in range(0, len(d), 50)]
    monkeypatch.setattr(topics, "_runs", lambda b, count, runs=topics._runs: ((1, *r[1:]) for r in runs(b, 1)))
    own = pa.Table.from_batches(list(topics._pack(keys)(iter(batches))))
    shares, totals, sent = topics._uniform(d, w, 5, 7), None, topics._moving([])
    docs, at = np.unique(d, return_inverse=True)
    for _ in range(3):
        for part in (slice(0, 3), slice(3, 5)):
            shares[:, part] *= n[:, None] / shares[:, part].sum(1, keepdims=True)
        by_doc, by_word = np.zeros((len(docs), 5)), np.zeros((w.max() + 1, 5))
        np.add.at(by_doc, at, shares)
        np.add.at(by_word, w, shares)
        made = topics._step(ks, keys, 7, 0, totals, 300)(own, sent).to_pylist()
        found = {i: c for r in made if r["ids"] for i, c in zip(np.frombuffer(r["ids"], np.uint32).tolist(), np.frombuffer(r["counts"], np.float32).reshape(-1, 5))}
        assert {i for r in made if r["kind"] == topics.LOCAL for i in np.frombuffer(r["ids"], np.uint32).tolist()} == set(w[w % 7 > 0].tolist())
        assert sorted(found) == sorted(set(w.tolist())) and all(c == pytest.approx(by_word[i], rel=1e-4) for i, c in found.items())
        assert np.frombuffer(next(r["counts"] for r in made if r["kind"] == topics.DOCS), np.float32).reshape(-1, 5) == pytest.approx(by_doc, rel=1e-4)
        totals = np.frombuffer(next(r["counts"] for r in made if r["kind"] == topics.TOTALS))
        sent = topics._moving([(9, r["kind"], keys.index(r["target"]) if r["kind"] == topics.SHARED else 9, b"", r["counts"])
                               for r in made if r["kind"] != topics.TOTALS])
        alpha = 50 / np.array([3, 3, 3, 2, 2])
        shares = (by_word[w] + 0.1) * (by_doc[at] + alpha) / (by_doc.sum(0) + 0.1 * 300)
