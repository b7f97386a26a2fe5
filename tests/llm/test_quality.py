"""op1: counts against a brute-force count; estimates against all subsets and converged runs; odd inputs."""

import re
from collections import Counter
from itertools import combinations

import numpy as np

from casita.llm.quality import FEATURES, QualityRules, chi_square_above, chi_square_tail, mcd, quality
from casita.llm.queries import op1_quality_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ("kept", "n_words", "x1", "g", "doc", "start")


def brute(text):
    text = text or ""
    w = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    marked = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(marked), n < 10 or 100 * len(marked) > 20 * n)


def test_query_counts(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op1_quality_rules(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(docs[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_odd_inputs(make):
    texts = [None, "", "a " * 40, "x\ny\nx\n \n ", "été \U0001f600 " * 9, "one two three four five " * 2, "w" * 50_000, " ".join(map(str, range(30_000)))]
    got = {r.doc.doc_id: r for r in quality(make([*texts, *texts[:2]], CLASH)).collect()}
    assert len(got) == 10
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), i
    assert got[0].doc.kept == "x"


def test_empty_table(make):
    assert quality(make([])).count() == 0


def _estimate(y, rules):
    return y.mean(axis=0), rules.consistency * np.cov(y.T, bias=True) + np.diag(np.square(rules.floors))


def _d2(x, m, c):
    return np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)


def _converged(x, rules, tries=300):
    """Concentration from many random subsets, each to its end with exactly the nearest h: the best of all."""
    rng, best = np.random.default_rng(0), (np.inf, None, None)
    size = int(np.ceil(rules.h * len(x)))
    for _ in range(tries):
        m, c = _estimate(x[rng.choice(len(x), 6, replace=False)], rules)
        det = np.inf
        while True:
            m, c = _estimate(x[np.argsort(_d2(x, m, c), kind="stable")[:size]], rules)
            if np.linalg.det(c) > det * (1 - 1e-9):
                break
            det = np.linalg.det(c)
        best = min(best, (det, m, c), key=lambda e: e[0])
    return best


def test_smallest_determinant_of_all_subsets(make):
    """Of all 12-subsets of 16 vectors, and of many converged runs on 150, none has a smaller determinant."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    rules = QualityRules(min_docs=5)
    spark = make([]).sparkSession
    groups = {"small": np.r_[rng.normal(0, 1, (13, 4)), rng.normal(9, 1, (3, 4))], "large": np.r_[rng.normal(0, [1, 2, 0.5, 1], (120, 4)), rng.normal(7, 0.3, (30, 4))]}
    rows = [((k, None), i % 32, *map(float, v)) for k, x in groups.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g struct<g_lang:string,g_own:string>, salt int, x1 double, x2 double, x3 double, x4 double")
    det = {r.g.g_lang: r.d for r in mcd(df, rules, keep_det=True).select("g", F.exp(2 * F.col("logdet")).alias("d")).collect()}
    least = min(np.linalg.det(_estimate(groups["small"][list(s)], rules)[1]) for s in combinations(range(16), 12))
    assert det["small"] <= least * 1.001
    assert det["large"] <= _converged(groups["large"], rules)[0] * 1.01


def test_chi_square():
    assert abs(chi_square_above(0.05) - 9.487729) < 1e-5 and abs(chi_square_tail(12.591587, 6) - 0.05) < 1e-6
    assert abs(QualityRules().consistency - 1.486) < 1e-3


def test_small_groups_are_pooled(make):
    rng = np.random.default_rng(2)
    text = lambda i: " ".join(rng.choice([f"word{k}" for k in range(40)], 60)) + f" {i}"
    rows = [(i, text(i), f"l{i % 7}", "s") for i in range(70)] + [(99, "%%%### " * 30 + " ".join(f"q{k}" for k in range(200)), "rare", "t")]
    got = {r.doc.doc_id: r for r in quality(make(rows)).collect()}
    assert all(r.distance is not None for r in got.values()) and not got[99].kept and all(got[i].kept or got[i].base_failed for i in range(70)) and sum(r.kept for r in got.values()) > 50


def test_estimates_match_converged_runs_and_outliers_go(make):
    rng = np.random.default_rng(1)
    vocab = ["word", "ab", "letters", "of", "some", "length", "xyzzy", "quite", "remarkable", "to"]
    clean = [" ".join(rng.choice(vocab, 80 + i % 50)) + f" {i}" for i in range(120)]
    junk = [" ".join(w + "%%%###" for w in rng.choice(vocab, 60)) for _ in range(5)] + [" ".join("q" * 25 + str(k) for k in range(60))]
    rows = [(i, t, "en", "s") for i, t in enumerate(clean + junk)] + [(900 + i, "to be " + str(i), None, None) for i in range(3)]
    got = {r.doc.doc_id: r for r in quality(make(rows)).collect()}
    stat = lambda r: (np.log((r.word_chars + 100) / (r.n_words + 20)), np.sqrt(r.n_symbols / (r.word_chars + 100)), np.sqrt(r.n_dup_lines / 6), np.sqrt(r.n_repeat_words / (r.n_words + 50)))
    ids = range(len(clean) + len(junk))
    rules = QualityRules()
    x = np.array([stat(got[i]) for i in ids])
    _, m, c = _converged(x, rules, 40)
    assert np.allclose([got[i].distance for i in ids], np.sqrt(_d2(x, m, c)), rtol=0.15, atol=0.1)
    assert [i for i in ids if not got[i].kept and not got[i].base_failed] == list(range(len(clean), len(clean) + len(junk)))
    assert got[900].distance is None  # too few in its group, in its language and in the last pool: nobody is judged
    assert len(FEATURES) == 4


def test_ends_where_two_documents_swap_for_ever(make, monkeypatch):
    """Group a rises and falls by the same amount in turn, b falls twice; each ends with its lowest determinant."""
    from casita.llm import quality as module
    from pyspark.sql import functions as F

    spark = make([]).sparkSession
    rng = np.random.default_rng(3)
    rows = [((k, None), i % 32, *map(float, v)) for k in "ab" for i, v in enumerate(rng.normal(0, 1, (30, 4)))]
    df = spark.createDataFrame(rows, "g struct<g_lang:string,g_own:string>, salt int, x1 double, x2 double, x3 double, x4 double")
    falls, calls = {"a": [0.0, 0.0, 0.04, -0.04] + [0.04, -0.04] * 10, "b": [0.0, 0.0, 0.5, 0.25] + [0.0] * 20}, []

    def step(judged, now, rules):
        fall = F.when(F.col("g.g_lang") == "a", falls["a"][len(calls)]).otherwise(falls["b"][len(calls)])
        calls.append(1)
        return now.withColumn("logdet", F.col("logdet") - fall).withColumn("fall", fall)

    def det():
        return {r.g.g_lang: r.logdet for r in mcd(df, QualityRules(min_docs=5, max_steps=20), keep_det=True).collect()}

    monkeypatch.setattr(module, "_step", step)
    got = det()
    assert len(calls) == 5
    falls["a"][2:], falls["b"][2:] = [0.0] * 20, [0.0] * 20
    calls.clear()
    start = det()
    assert abs(start["a"] - got["a"] - 0.04) < 1e-9 and abs(start["b"] - got["b"] - 0.75) < 1e-9
