"""The pipeline against a brute-force version: each stage on what the last one kept."""

import random
import re
from collections import Counter

import corpus_pipeline
from casita.llm.queries import op1_quality_rules

from .test_decontamination import direct
from .test_mixing import reshared
from .test_simhash import brute_components, brute_print
from .test_tokens import want as want_tokens

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_pipeline(spark, sf_dir, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows, done = [tuple(r) for r in docs.collect()], {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
        done[name], before, rows = [tuple(r) for r in docs.collect()], rows, [tuple(r) for r in docs.collect()]
        by_id = {r[0]: r for r in before}
        if k == 0:
            kept = {r.doc_id for r in op1_quality_rules(spark, sf_dir).collect() if r.kept}
            assert sorted(rows) == sorted(by_id[i] for i in kept) and len(kept) > len(before) * 0.7
        elif k == 1:
            component = brute_components({i: brute_print(r[1]) for i, r in by_id.items()})
            assert sorted(rows) == sorted(by_id[i] for i in set(component.values())) and len(rows) < len(before)
        elif k == 2:
            leaked = {d for d, _ in direct([r[:2] for r in before], items)}
            assert sorted(rows) == sorted(r for i, r in by_id.items() if i not in leaked) and leaked
        elif k == 3:
            size = {i: len(WORDS.findall(r[1])) for i, r in by_id.items()}
            sizes, taken = Counter(), Counter()
            for i, r in by_id.items():
                sizes[r[3]] += size[i]
            for r in rows:
                assert r == by_id[r[0]]
                taken[r[3]] += size[r[0]]
            assert max(Counter(r[0] for r in rows).values()) <= 2
            for s, t in reshared(sizes).items():
                assert abs(taken[s] - t) <= max(size[i] for i, r in by_id.items() if r[3] == s)
        else:
            assert sorted(rows) == want_tokens(sorted(r[:2] for r in before))


def test_empty(spark, make, tmp_path):
    make([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows(spark, make, tmp_path):
    """Repeated rows, nulls and columns with clashing names pass every stage."""
    text = " ".join(f"w{i % 97}x{i}" for i in range(60))
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, text + " end", None, None), (5, "other " + text[::-1], "de", "b")]
    make(rows, ("kept", "size", "doc", "seen", "t")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {1, 4, 5} and got


def test_null_ids_and_shared_ids_stay(spark, make):
    """Documents without an id, and texts that share one, are near-duplicates only of what they resemble."""
    rng = random.Random(11)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(5))
    rows = [(None, a, "en", "s"), (None, b, "en", "s"), (1, c, "en", "s"), (1, d, "en", "s"), (1, d, "en", "s"), (2, d, "en", "s"), (None, d, "en", "s"), (3, e, "en", "s"), (None, e, None, "s"), (None, None, None, None)]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, make(rows, ("key", "best", "k", "fp")), "").collect()]
    assert Counter(got) == Counter([(None, a), (None, b), (1, c), (1, d), (3, e), (None, None)])


def test_null_and_shared_ids_pass_the_stages(spark, make, tmp_path):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(4)]
    make([(None, texts[0], "en", "s"), (None, texts[1], "en", "s"), (1, texts[2], "en", "s"), (1, texts[3], "en", "s")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a question of other words entirely? yes.")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert sorted(r.text for r in docs.collect()) == sorted(texts), name


def test_scratch_tables_of_written_stages_go(spark, make, tmp_path):
    """Once a stage is written, the next one deletes what it left; a stage that is not written keeps it."""
    from casita.llm.common import reads_scratch

    text = " ".join(f"w{i % 97}x{i}" for i in range(60))
    make([(i, f"{text} {i}", "en", "a") for i in range(5)]).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    first = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert reads_scratch(first, "pipeline") and not reads_scratch(docs, "pipeline")
    second = corpus_pipeline.near_duplicates(spark, first, str(tmp_path))
    assert second.count() >= 1
    first.write.parquet(f"{tmp_path}/0")
    third = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/0"), str(tmp_path))
    assert third.count() >= 1
    try:
        gone = first.count() < 0
    except Exception:
        gone = True
    assert gone
