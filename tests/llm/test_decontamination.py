"""op7: retrieval against scoring every part; leaks against a direct search; clean documents stay."""

import math
import random

import numpy as np
import pytest

from casita.llm.decontamination import Bm25, Index, _may_find, decontaminate, find_leaks, leaks, passages, question_length, shingles, slices, wand, words_of
from casita.llm.queries import op7_decontamination

SCHEMA = "item_id long, text string"


def index_of(texts, how=Bm25()):
    items = [(i, words_of(t), question_length(t)) for i, t in enumerate(texts)]
    parts = [(k, w[a : a + how.part_words]) for k, (_, w, _) in enumerate(items) for a in range(0, len(w), how.part_words)]
    df = {}
    for _, w in parts:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    return Index.build(parts, items, df, len(parts), sum(len(w) for _, w in parts) / len(parts), how), parts, df


def scores(parts, df, terms, how):
    """BM25 of each part over its threshold, term by term."""
    n, average = len(parts), sum(len(w) for _, w in parts) / len(parts)

    def impact(w, t):
        c = w.count(t)
        return math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (how.k1 + 1) / (c + how.k1 * (1 - how.b + how.b * len(w) / average)) if c else 0.0

    return [sum(impact(w, t) for t in terms) / (how.threshold * sum(impact(w, t) for t in set(w))) for _, w in parts]


def test_wand_retrieves_all_above_threshold():
    rng = random.Random(1)
    vocab = [f"t{i}" for i in range(60)]
    how = Bm25(block=4, threshold=0.4)
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(6, 90))) for _ in range(80)]
    index, parts, df = index_of(texts, how)
    hits = 0
    for _ in range(300):
        terms = sorted(set(rng.choices(vocab, k=rng.randrange(1, 40))))
        want = {p: s for p, s in enumerate(scores(parts, df, [t for t in terms if t in df], how)) if s >= 1}
        got = dict(wand(index, [index.terms[t] for t in terms if t in index.terms], how.block))
        assert got.keys() == want.keys()
        assert all(got[p] == pytest.approx(want[p]) for p in got)
        hits += len(want)
    assert hits > 50


def test_no_passage_is_skipped_wrongly():
    rng = random.Random(3)
    vocab = [f"t{i}" for i in range(200)]
    how = Bm25(passage_words=32, part_words=16, block=4)
    texts = [" ".join(rng.choice(vocab) for _ in range(16)) for _ in range(50)]
    index, _, _ = index_of(texts, how)
    words = []
    for _ in range(80):
        words += rng.choice(texts).split()[: rng.randrange(6, 17)] if rng.random() < 0.4 else rng.choices(vocab, k=10)
    ids = np.array([index.terms.get(w, 0) for w in words], np.int32)
    want = {}
    for s in range(0, max(1, len(ids) - 16), 16):
        if got := wand(index, [int(t) for t in np.unique(ids[s : s + 32]) if t], how.block):
            want[s] = got
    assert dict(passages(ids, index, how)) == want and len(want) > 10


def direct(docs, items, how=Bm25()):
    out = set()
    for i, t in items:
        own = shingles(words_of(t))
        if own:
            for d, x in docs:
                have = set(shingles(words_of(x)))
                if sum(s in have for s in own) / len(own) >= 0.95:
                    out.add((d, i))
    return out


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in op7_decontamination(spark, sf_dir).collect()}
    assert got == direct(docs, items) and got


def test_near_leaks_and_slices(spark, make):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(30)) + ". " + " ".join(word() for _ in range(12)) + ".") for i in range(40)] + [(40, " ".join(word() for _ in range(200)))]
    items += [(98, "too short"), (99, None), (1, None), (3, items[3][1])]
    texts = []
    for k in range(40):
        w = items[k][1].split()
        if k % 4 == 1:
            w[7] = "changed"
        if k % 4 == 2:
            w = w[: len(w) // 2]  # half an item is no leak
        body = [word() for _ in range(rng.randrange(0, 400))]
        texts.append(" ".join(body + (["X", *w] if k % 4 != 3 else []) + body[::-1]).upper())
    texts.append("so " * 50 + items[40][1])
    bench = spark.createDataFrame([(*r, "c") for r in items], SCHEMA + ", words string")
    want = {(k, k) for k in range(40) if k % 4 < 2} | {(40, 40)}
    for how in (Bm25(), Bm25(slice_parts=9, block=2)):
        assert {(r.doc_id, r.item_id) for r in find_leaks(make(texts, ("item_id", "start")), bench, how).collect()} == want
        kept = decontaminate(make(texts, ("item_id", "digest", "key", "bad")), bench, how)
        assert {r.doc_id for r in kept.collect()} == set(range(41)) - {d for d, _ in want}
        assert kept.columns[-1] == "bad"


def test_many_slices_find_the_same(spark, make):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(20, 60))) + ".") for i in range(400)]
    texts = [" ".join([word() for _ in range(60)] + (items[k * 7][1].split() if k % 2 else []) + [word() for _ in range(40)]) for k in range(50)]
    bench = spark.createDataFrame(items, SCHEMA)
    one = {tuple(r)[:3] for r in find_leaks(make(texts), bench).collect()}
    index, many = slices(bench, how := Bm25(slice_parts=8))
    assert many == 50 and len(one) == 25
    assert {tuple(r)[:3] for r in find_leaks(make(texts), bench, how).collect()} == one
    # what the heavy terms let through is far less than every text for every slice
    assert _may_find(make(texts).select("doc_id", "text").withColumnRenamed("doc_id", "key"), index, many).count() < len(texts) * many


def test_short_items_and_items_without_an_id(spark, make):
    item = "the quick brown fox jumps over the lazy dog near the river bank today"
    bench = spark.createDataFrame([(1, "Lisbon, 1755"), (None, item), (None, "other words of an item that has no number at all"), (2, " ")], SCHEMA)
    texts = ["it was\nlisbon 1755.\nyes", "lisbon 1755 was a bad year", "1755 lisbon", f"so {item} and", "clean"]
    assert sorted((r.doc_id, r.item_id) for r in find_leaks(make(texts), bench).collect()) == [(0, 1), (3, None)]
    assert [r.doc_id for r in decontaminate(make(texts), bench).orderBy("doc_id").collect()] == [1, 2, 4]


def test_one_edit_fails_no_item(spark, make):
    """Wherever one word changes, an item of 40 words keeps 0.8 of its shingles, and is found."""
    words = [f"w{i}" for i in range(40)]
    item = " ".join(words[:39]) + ". " + words[39]
    bench = spark.createDataFrame([(1, item)], SCHEMA)
    texts = [item.replace(f"w{k} ", "changed ") if k < 38 else item.replace("w38.", "changed.") if k == 38 else item.replace("w39", "changed") for k in range(40)]
    assert find_leaks(make(texts), bench).count() == 40


def test_odd_inputs(spark, make):
    item = "the quick brown fox jumps over the lazy dog near the river bank today"
    bench = spark.createDataFrame([(1, item), (1, item)], SCHEMA)
    texts = [None, "", item, item + " x" * 90_000, "clean text", item]
    assert sorted((r.doc_id, r.item_id) for r in find_leaks(make([*texts, (2, item, "", "")]), bench).collect()) == [(2, 1), (3, 1), (5, 1)]
    none = spark.createDataFrame([], SCHEMA)
    assert find_leaks(make(texts), none).count() == 0
    assert decontaminate(make(texts), none).count() == 6
    assert find_leaks(make([]), bench).count() == 0
    index, _, _ = index_of([item])
    assert leaks("", index, Bm25()) == []
