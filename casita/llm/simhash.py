"""SimHash near-duplicates by a segment-popcount embedding.

A text is lower-cased (A-Z) and cut into words; every 4-word shingle, repeats included, is hashed (XXH64, seed 42), and a
fingerprint bit is 1 if it is set in over half of the hashes. Fingerprints that differ in at most `max_bits` = 4 bits are
linked, and documents of linked fingerprints form a component.

The join: a fingerprint is embedded as the bit counts of its 32 segments of two bits. The Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints, so a linked pair has Manhattan distance 4 at most. The
32 coordinates are dealt to G groups; with a budget of 4 at most four groups can differ, so a linked pair agrees on all
coordinates of some G - 4 groups. Each fingerprint enters the C(G, 4) grid cells that leave four groups open (70 cells with
G = 8); pairs are sought within cells, those whose Manhattan distance is above 4 are left out, and the exact Hamming
distance decides on the rest. (Counts 0, 1, 2 are written as 00, 01, 11, so that Manhattan distance is a bit count.)

Scale: copies collapse to one row a fingerprint before the join (an aggregate that combines on the map side), so a group
of copies of any size enters each cell once. Within a cell only links that join two parts not yet joined are emitted: a
cell's members are first compared to its few leaders, and members are compared to each other only across parts that the
leaders left apart; no pair list exists. A cell holds distinct fingerprints that agree on most coordinates; as their
number grows, G grows with it (8, 10, 12), so cells stay small: what is found does not depend on G.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; texts of under four words
have one shingle, the whole sequence; very long texts are hashed whole. A null doc_id is no candidate for component_id; a
component of null ids only has a null component_id. Repeated rows are returned each. Empty tables give empty tables. Only
doc_id and text are read, so extra columns may have any name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, scratch

SHINGLE = 4
MAX_BITS = 4
#: What a-z and A-Z differ by; other letters stay.
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_EACH_BYTE = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit (64 counts): eight bit planes, added 255 rows at a time within bytes."""
    total = np.zeros(64, dtype=np.int64)
    starts = np.arange(0, len(hashes), 255)
    for k in range(8):
        plane = (hashes >> np.uint64(k)) & _EACH_BYTE
        part = np.add.reduceat(plane, starts)
        total[k::8] += part.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None) -> int:
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    words = raw.split()  # of bytes: at space and \t \n \v \f \r, no others
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - SHINGLE + 1)
    first = [0, *ends[: n - 1]]
    last = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a : b - 1], 42) for a, b in zip(first, last, strict=True)], dtype=np.uint64)
    bits = bit_counts(hashes) * 2 > n
    return int(np.packbits(bits[::-1]).view(">u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = np.fromiter((fingerprint(x) for x in batch.column("text").to_pylist()), dtype=np.uint64, count=batch.num_rows)
        own = [c for c in batch.schema.names if c != "text"]
        yield pa.record_batch([*[batch.column(c) for c in own], pa.array(got.view(np.int64))], names=[*own, "fp"])


def fingerprints(docs: DataFrame, keyed: bool = False) -> DataFrame:
    """(doc_id, fp), or (doc_id, key, fp): fp the fingerprint as a signed long, key a string of the input."""
    key = ["key"] if keyed else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *key, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, f"doc_id long, {'key string, ' if keyed else ''}fp long")


def groups_for(n: int) -> int:
    """Groups of coordinates for n distinct fingerprints: more groups, more and smaller cells."""
    return 8 if n <= 1 << 27 else 10 if n <= 1 << 30 else 12


def open_masks(groups: int) -> list[int]:
    """Per cell of a fingerprint, the bits of the coordinates that it keeps: all but those of four groups."""
    bounds = [32 * g // groups for g in range(groups + 1)]
    bits = [sum(3 << (2 * k) for k in range(lo, hi)) for lo, hi in itertools.pairwise(bounds)]
    return [sum(b for g, b in enumerate(bits) if g not in left) for left in itertools.combinations(range(groups), MAX_BITS)]


def cells(distinct: DataFrame, groups: int = 8) -> DataFrame:
    """(cell, fp): the grid cells of each fingerprint; a cell is the hash of its number and of the coordinates that it keeps."""
    # bit count of a 2-bit field ab is a + b: fields (fp & 01..) and (fp >> 1 & 01..) add without a carry out of a field
    low = F.expr("fp & 6148914691236517205L")
    high = F.expr("shiftrightunsigned(fp, 1) & 6148914691236517205L")
    # the top field could reach 2 = binary 10 in the sign bit; halves are added apart to stay within a long
    mask = F.lit(0xFFFFFFFF)
    lower = low.bitwiseAND(mask) + high.bitwiseAND(mask)
    upper = F.shiftrightunsigned(low, 32) + F.shiftrightunsigned(high, 32)
    t = F.shiftleft(upper, 32).bitwiseOR(lower)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    cell = [F.xxhash64(F.lit(k), F.col("t").bitwiseAND(F.lit(signed(m)).cast("long"))) for k, m in enumerate(open_masks(groups))]
    return distinct.select("fp", t.alias("t")).select(F.explode(F.array(*cell)).alias("cell"), "fp")


def unary(fp: np.ndarray) -> np.ndarray:
    """Segment bit counts 0, 1, 2 written as 00, 01, 11: the Manhattan distance of two is the number of bits that differ."""
    odd, even = fp & np.uint64(0x5555555555555555), (fp >> np.uint64(1)) & np.uint64(0x5555555555555555)
    return (odd | even) | (odd & even) << np.uint64(1)


def near(fp: np.ndarray, at: np.ndarray, one: int, counts: np.ndarray) -> np.ndarray:
    """Of the places `at`, those linked to fp[one]: the lower bound first, then the exact distance."""
    at = at[np.bitwise_count(counts[at] ^ counts[one]) <= MAX_BITS]
    return at[np.bitwise_count(fp[at] ^ fp[one]) <= MAX_BITS]


def cell_links(fp: np.ndarray) -> list[tuple[int, int]]:
    """Links (indices) that join the members of one cell as all pairs within MAX_BITS would: a forest, not the pairs."""
    m = len(fp)
    if m == 2:
        return [(0, 1)] if int(fp[0] ^ fp[1]).bit_count() <= MAX_BITS else []
    counts = unary(fp)
    part = np.full(m, -1, dtype=np.int64)
    links, leaders = [], []
    for i in range(m):  # every member joins the first leader near it, or leads
        if part[i] >= 0:
            continue
        own = near(fp, np.flatnonzero(part < 0), i, counts)
        part[own] = len(leaders)
        links += [(i, int(j)) for j in own if j != i]
        leaders.append(i)
    if len(leaders) == 1:
        return links
    root = list(range(len(leaders)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(len(leaders) + 1))
    lead = fp[leaders]
    for p in range(len(leaders)):
        # parts whose leaders are within 4 + 4 + 4 bits may touch
        for q in np.flatnonzero(np.bitwise_count(lead[p + 1 :] ^ lead[p]) <= 3 * MAX_BITS) + p + 1:
            if find(p) == find(int(q)):
                continue
            mine, theirs = order[bounds[p] : bounds[p + 1]], order[bounds[q] : bounds[q + 1]]
            for i in mine:
                hit = near(fp, theirs, i, counts)
                if len(hit):
                    links.append((int(i), int(hit[0])))
                    root[find(p)] = find(int(q))
                    break
    return links


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition sorted by cell; a cell may go on in the next batch."""
    rest_cell, rest_fp = np.empty(0, np.int64), np.empty(0, np.uint64)

    def links_of(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, np.int64)
        sizes = np.diff(np.r_[starts, len(cell)])
        a, b = [], []
        two = starts[sizes == 2]
        if len(two):
            counts = unary(fp)
            two = two[np.bitwise_count(counts[two] ^ counts[two + 1]) <= MAX_BITS]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= MAX_BITS]
            a.append(fp[two]), b.append(fp[two + 1])
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            own = fp[s : s + n]
            if got := cell_links(own):
                i, j = np.array(got, dtype=np.int64).T
                a.append(own[i]), b.append(own[j])
        a, b = (np.concatenate(x) if x else np.empty(0, np.uint64) for x in (a, b))
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        cell = np.concatenate([rest_cell, batch.column("cell").to_numpy()])
        fp = np.concatenate([rest_fp, batch.column("fp").to_numpy().view(np.uint64)])
        if not len(cell):
            continue
        cut = int(np.searchsorted(cell, cell[-1]))
        yield links_of(cell[:cut], fp[:cut])
        rest_cell, rest_fp = cell[cut:], fp[cut:]
    yield links_of(rest_cell, rest_fp)


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between fingerprints within MAX_BITS: as many as connect what such pairs connect."""
    dealt = cells(distinct, groups_for(distinct.count())).repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each input row."""
    prints = scratch(fingerprints(docs), "fingerprints")
    distinct = scratch(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp")))
    linked = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    label = linked.join(lowest, "root").select(F.col("fp").alias("f"), "component_id")
    joined = prints.join(label, prints.fp == label.f)
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame) -> DataFrame:
    """(key): of rows (doc_id, key, text), the first of each component by doc_id, nulls last, then key.

    Rows are told apart by key alone: a null doc_id, or one doc_id on several texts, joins or loses nothing.
    """
    prints = fingerprints(docs, keyed=True)
    distinct = scratch(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best")), "distinct")
    roots = components(links(distinct.select("fp")))
    linked = distinct.join(roots, distinct.fp == roots.node, "left").select("best", F.coalesce("root", "fp").alias("root"))
    return linked.groupBy("root").agg(F.min("best").alias("best")).select("best.key")
