"""op4: targets against step-by-step resharing, words taken near them, times against the integrated schedule."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from casita.llm.mixing import Mix, plan, targets, training_order, training_time
from casita.llm.queries import op4_mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(sizes, share=1.5, cap=2):
    """Deal, stop at the caps, reshare the excess by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in over)
        open_ -= set(over)
    return out


def check(rows, docs):
    sizes, taken = defaultdict(int), defaultdict(int)
    by_id = {r.doc_id: r for r in docs}
    for r in rows:
        d = by_id[r.doc_id]
        assert r.size == len(WORDS.findall(d.text or ""))
        sizes[d.source] += r.size
        taken[d.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = reshared(sizes)
    for r in rows:
        s = by_id[r.doc_id].source
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s], rel=1e-9, abs=1e-9)
    largest = defaultdict(int)
    for r in rows:
        largest[by_id[r.doc_id].source] = max(largest[by_id[r.doc_id].source], r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6


def test_query(spark, sf_dir):
    rows = op4_mixing(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    assert sorted(rows) == sorted(op4_mixing(spark, sf_dir).collect())


def test_query_matches_sql(spark, sf_dir):
    from casita.llm.queries import oracle_sql
    from tests.oracle import compare, connect

    compare(spark, connect(sf_dir), sf_dir, op4_mixing, oracle_sql()["op4_mixing"])


def test_odd_inputs(make):
    rows = [(i, "w " * (i % 7 + 1), "en", ["b", "é", None, "B", "\U0001f600"][i % 5]) for i in range(200)]
    rows += [(900, None, "en", "empty"), (901, "", "en", "empty"), (902, "x " * 60_000, "en", "b")]
    docs = make(rows, ("size", "key", "times", "bucket", "target"))
    got = plan(docs, Mix(bucket_rows=4)).select("doc.doc_id", "size", "source_size", "target", "taken").collect()
    check(got, docs.collect())
    assert plan(make([])).count() == 0
    twice = make(rows[:20] + rows[:20])
    got = plan(twice).select("doc.doc_id", "taken").collect()
    assert len(got) == 40 and sorted(got) == sorted(plan(twice).select("doc.doc_id", "taken").collect())


def test_small_last_documents_keep_targets_near(make):
    rows = [(i, "w " * (900 if i % 150 == 0 else 9 + i % 5), "en", "abc"[i % 3]) for i in range(1, 2_000)]
    got = plan(make(rows)).select("doc.source", "target", "taken").groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 20 for r in got)


def test_time_inverts_the_schedule(spark):
    for c in (-0.5, 0.0, 0.5, 0.9):
        got = spark.range(101).select((F.col("id") / 100).alias("u")).select("u", training_time(F.col("u"), F.lit(c)).alias("t")).collect()
        assert all(r.t + c * (r.t**2 - r.t) == pytest.approx(r.u, abs=1e-9) for r in got)


def test_order_has_each_pass_once(make):
    planned = plan(make([(i, "w " * 9, "en", "abc"[i % 3]) for i in range(90)]))
    order = training_order(planned).collect()
    assert len(order) == sum(r.taken // r.size for r in planned.collect())
    assert [r.t for r in order] == sorted(r.t for r in order)


def test_targets_of_no_words(spark):
    got = targets(spark.createDataFrame([("a", 0), (None, 0)], "source string, source_size long")).collect()
    assert [r.target for r in got] == [0.0, 0.0]
