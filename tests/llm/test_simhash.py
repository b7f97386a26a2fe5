"""op2: fingerprints and components against brute force over all pairs."""

import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from casita.llm.queries import op2_simhash
from casita.llm.simhash import MAX_BITS, cell_links, fingerprint, near_duplicates

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(t)
    s = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= MAX_BITS:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: brute_print(t) for i, t in docs.items()}
    want = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op2_simhash(spark, sf_dir).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in docs}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \t\nÉé Z\x1c\x85", max_size=40))
def test_fingerprint(text):
    assert fingerprint(text) == brute_print(text)


def test_long_text():
    text = " ".join(str(i * i) for i in range(5_000))
    assert fingerprint(text) == brute_print(text)


def test_cell_links_join_as_all_pairs_do():
    rng = np.random.default_rng(3)
    for _ in range(60):
        base = rng.integers(0, 2**63, 3, dtype=np.uint64)
        fp = np.unique([b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 7), replace=False))) for b in np.repeat(base, 15)])
        prints = {i: int(x) for i, x in enumerate(fp)}
        links = cell_links(fp)
        assert all((prints[a] ^ prints[b]).bit_count() <= MAX_BITS for a, b in links)
        assert len(links) < len(fp)
        root = list(range(len(fp)))
        for _ in fp:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        assert dict(enumerate(root)) == brute_components(prints)


def test_chains_and_planted_bits(spark, make, monkeypatch):
    """Prints given as such: chains of links reach the smallest document."""
    from casita.llm import simhash

    rng = np.random.default_rng(5)
    prints = {}
    for b in rng.integers(-(2**63), 2**63, 12):
        x = int(b)
        for _ in range(9):
            prints[int(rng.integers(0, 10**9))] = x
            x ^= sum(1 << int(k) for k in rng.choice(62, rng.integers(1, 6), replace=False))
    table = spark.createDataFrame(list(prints.items()), "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: table)
    got = {r.doc_id: r.component_id for r in near_duplicates(make([])).collect()}
    low = {i: x & (2**64 - 1) for i, x in sorted(prints.items())}
    assert got == brute_components(low)


def test_odd_inputs(make):
    texts = [None, "", " \n", "a b c", "A B C", "a  b\tc", "long " * 20_000, None]
    got = {r.doc_id: r for r in near_duplicates(make(texts, ("fp", "cell", "node", "component_id"))).collect()}
    assert [got[i].component_id for i in range(8)] == [0, 0, 0, 3, 3, 3, got[6].component_id, 0]
    assert got[0].fingerprint == "0" * 16
    assert near_duplicates(make([])).count() == 0
