"""Benchmark decontamination by BM25 with block-max WAND.

Test items are cut into parts of at most `part_words` = 64 words, which an inverted index holds: per term a posting list
of (part, BM25 impact) with the greatest impact of each block of 4 parts. Every passage of every text (128 words, a new
one each 64, so that any 64 words in a row lie in one passage) is a query: all parts that score at least `threshold` =
half of what the part scores against itself are retrieved. First, for all passages of a text at once, the block maxima of
a passage's words are added up; blocks whose sum stays below the threshold cannot hold a result. Passages with a block
left are run through block-max WAND. A retrieved item is a leak when, around the passage, at least 0.8 of its 5-word
shingles are found, and at least half of those of the question and of those of the answer (the last sentence, or the last
quarter of an item of one sentence). A side of few shingles also passes by ten, reaching into the other: one changed word
breaks five, so it fails no side by itself.

Scale: the parts are dealt by a hash of the item to slices of about `slice_parts` parts. A slice's index is built on an
executor and written to the shared folder; the driver fetches one slice at a time, sends it (its size is bounded), writes
what it finds and drops it, so memory does not grow with the benchmark. A benchmark of one slice is a narrow map over the
texts, without a shuffle. With more slices, a slice only reads the texts that it may find something in: a passage that
retrieves a part holds one of the part's heaviest terms, without which the others stay below the threshold; texts are
joined to the slices on those terms first. Document frequencies are counted over all items.

Defined results: null texts have no passages; long texts are searched whole, 65,536 words at a time. An item without a
word matches nothing; one of under five words is leaked by a text that has a line of just these words. Items without an
item_id are one item. Repeated rows of documents give their result once (by doc_id), repeated items once (by item_id); of
passages with equal scores the first counts; an empty table on either side gives no leaks. Only doc_id and text (item_id
and text) are read, so extra columns may have any name.
"""

from __future__ import annotations

import heapq
import math
import pickle
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, packed, scratch, scratch_path

_WORD = re.compile(r"\w+")
_ENDS = re.compile(r"[.!?\n]+\s*(?=\S)")
SHINGLE = 5


@dataclass(frozen=True)
class Bm25:
    k1: float = 1.2
    b: float = 0.75
    part_words: int = 64
    passage_words: int = 128
    block: int = 4
    threshold: float = 0.5
    similarity: float = 0.8
    #: Of the question's and the answer's shingles: their own, or so many.
    each_side: float = 0.5
    side_shingles: int = 10
    slice_parts: int = 1024


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_length(text: str) -> int:
    """Words of the question: all but the last sentence, or three quarters of a single one."""
    ends = [m.end() for m in _ENDS.finditer(text)]
    n = len(words_of(text))
    q = len(words_of(text[: ends[-1]])) if ends else 0
    return q if 0 < q < n else n - max(1, n // 4)


def shingles(words: list[str]) -> list[tuple[str, ...]]:
    return [tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


#: What float32 sums of block maxima may lack.
_SLACK = 1e-3


@dataclass
class Index:
    """One slice: impacts are divided by a part's threshold, so that a part is retrieved at 1."""

    terms: dict[str, int] = field(default_factory=dict)
    #: Per term: parts in ascending order, impacts, and the greatest impact of each block that has any.
    postings: list[tuple[list[int], list[float], dict[int, float]]] = field(default_factory=list)
    block_max: np.ndarray | None = None
    parts: list[int] = field(default_factory=list)
    items: list[tuple[int | None, list[str], int]] = field(default_factory=list)
    #: Terms of which a passage has one at least if it retrieves any part.
    heavy: set[str] = field(default_factory=set)

    @staticmethod
    def build(parts: list[tuple[int, list[str]]], items: list[tuple[int | None, list[str], int]], df: dict[str, int], n: int, average: float, how: Bm25) -> Index:
        own = Index(items=items, parts=[i for i, _ in parts])
        idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for p, (_, words) in enumerate(parts):
            tf: dict[str, int] = defaultdict(int)
            for w in words:
                tf[w] += 1
            norm = how.k1 * (1 - how.b + how.b * len(words) / average)
            impact = {t: idf[t] * c * (how.k1 + 1) / (c + norm) for t, c in tf.items()}
            needed = how.threshold * math.fsum(impact.values())
            left = 1 / how.threshold
            for t, x in sorted(impact.items(), key=lambda i: (-i[1], i[0])):
                lists[t].append((p, x / needed))
                if left >= 1 - _SLACK:
                    own.heavy.add(t)
                left -= x / needed
        blocks = max(1, -(-len(parts) // how.block))
        own.block_max = np.zeros((len(lists) + 1, blocks), dtype=np.float32)
        own.postings.append(([], [], {}))
        for k, (t, hits) in enumerate(sorted(lists.items()), 1):
            top: dict[int, float] = {}
            for p, x in hits:
                top[p // how.block] = max(top.get(p // how.block, 0.0), x)
            own.terms[t] = k
            own.postings.append(([p for p, _ in hits], [x for _, x in hits], top))
            for b, x in top.items():
                own.block_max[k, b] = x
        return own


def wand(index: Index, terms: list[int], block: int) -> list[tuple[int, float]]:
    """Block-max WAND over distinct terms: all (part, score) with a score of at least 1."""
    out = []
    cursors = [[index.postings[t][0][0], 0, t, max(index.postings[t][2].values())] for t in terms if index.postings[t][0]]
    heapq.heapify(cursors)

    def advance(c: list, to: int) -> None:
        """Moves a cursor to the first part >= to and puts it back if there is one."""
        parts = index.postings[c[2]][0]
        i = c[1]
        while i < len(parts) and parts[i] < to:
            i += 1
        if i < len(parts):
            heapq.heappush(cursors, [parts[i], i, c[2], c[3]])

    while cursors:
        # the pivot: the first part at which the lists up to it could reach 1
        taken, bound = [], 0.0
        while cursors and bound < 1 - _SLACK:
            c = heapq.heappop(cursors)
            taken.append(c)
            bound += c[3]
        if bound < 1 - _SLACK:
            break
        pivot = taken[-1][0]
        while cursors and cursors[0][0] == pivot:
            taken.append(heapq.heappop(cursors))
        at = pivot // block
        if sum(index.postings[c[2]][2].get(at, 0.0) for c in taken) < 1 - _SLACK:
            # no part of this block up to the next list's place can reach 1
            to = min((at + 1) * block, cursors[0][0] if cursors else (at + 1) * block)
            for c in taken:
                advance(c, max(to, pivot + 1))
            continue
        score = 0.0
        for c in taken:
            parts, impacts, _ = index.postings[c[2]]
            i = c[1]
            while i < len(parts) and parts[i] < pivot:
                i += 1
            if i < len(parts) and parts[i] == pivot:
                score += impacts[i]
                i += 1
            if i < len(parts):
                heapq.heappush(cursors, [parts[i], i, c[2], c[3]])
        if score >= 1 - 1e-9:
            out.append((pivot, score))
    return out


def passages(ids: np.ndarray, index: Index, how: Bm25) -> Iterator[tuple[int, list[tuple[int, float]]]]:
    """(start, retrieved parts) of each passage that retrieves any."""
    step, n = how.passage_words // 2, len(ids)
    for lo in range(0, n, 1024 * step):  # bounded memory for very long texts
        own = ids[lo : lo + 1025 * step]
        sums = np.add.reduceat(index.block_max[own], np.arange(0, len(own), step), axis=0)
        both = sums[:-1] + sums[1:] if len(sums) > 1 else sums
        both = both[:1024]
        for k in np.flatnonzero((both >= 1 - _SLACK).any(axis=1)):
            start = lo + int(k) * step
            terms = np.unique(ids[start : start + how.passage_words])
            if (index.block_max[terms].sum(axis=0) >= 1 - _SLACK).any() and (got := wand(index, [int(t) for t in terms if t], how.block)):
                yield start, got


def leaks(text: str | None, index: Index, how: Bm25) -> list[tuple[int | None, int, float, float, float]]:
    """(item_id, word where its passage starts, BM25 over the threshold, overlap of question and answer) of the items a text leaks."""
    words = words_of(text)
    get = index.terms.get
    ids = np.fromiter((get(w, 0) for w in words), dtype=np.int32, count=len(words))
    out: dict[int | None, tuple[int | None, int, float, float, float]] = {}
    for start, got in passages(ids, index, how):
        for p, score in got:
            item_id, item, q = index.items[index.parts[p]]
            if score * how.threshold <= out.get(item_id, (0, 0, 0.0))[2]:
                continue
            if len(item) < SHINGLE:
                if any(words_of(line) == item for line in text.split("\n")):
                    out[item_id] = (item_id, start, score * how.threshold, 1.0, 1.0)
                continue
            around = set(shingles(words[max(0, start - len(item)) : start + how.passage_words + len(item)]))
            found = [s in around for s in shingles(item)]
            edge = max(0, q - SHINGLE + 1)
            share = lambda x: sum(x) / len(x) if x else 1.0
            question = max(share(found[:edge]), share(found[: max(edge, how.side_shingles)]))
            answer = max(share(found[edge:]), share(found[max(0, min(edge, len(found) - how.side_shingles)) :]))
            if share(found) >= how.similarity and min(question, answer) >= how.each_side:
                out[item_id] = (item_id, start, score * how.threshold, question, answer)
    return list(out.values())


_SLICE = "slice int, data binary, heavy array<string>"


def slices(benchmark: DataFrame, how: Bm25 = Bm25()) -> tuple[DataFrame, int]:
    """A written table (slice, data, heavy) of the slices of the index, and how many there are."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, w, question_length(t)) for i, t in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True) if (w := words_of(t))]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.int32())], names=["item_id", "words", "question"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct().mapInArrow(cut, "item_id long, words array<string>, question int")
    chunks = F.transform(F.sequence(F.lit(0), F.ceil(F.size("words") / how.part_words).cast("int") - 1), lambda k: F.slice("words", k * how.part_words + 1, F.lit(how.part_words)))
    items = scratch(items.withColumn("chunks", chunks), "items")
    n, total = items.agg(F.sum(F.size("chunks")), F.sum(F.size("words"))).first()
    if not n:
        return benchmark.sparkSession.createDataFrame([], _SLICE), 0
    many = -(-n // how.slice_parts)
    df = items.select(F.explode("chunks").alias("part")).select(F.explode(F.array_distinct("part")).alias("term")).groupBy("term").agg(F.count("*").alias("d"))
    own = items.withColumn("slice", F.pmod(F.xxhash64("item_id", "words"), F.lit(many)).cast("int"))
    terms = scratch(own.select(F.col("slice").alias("of"), F.explode("words").alias("term")).distinct().join(df, "term"), "terms")

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table, own: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["words"]))
        parts = [(k, c) for k, r in enumerate(rows) for c in r["chunks"]]
        index = Index.build(parts, [(r["item_id"], r["words"], r["question"]) for r in rows], dict(zip(own.column("term").to_pylist(), own.column("d").to_pylist(), strict=True)), n, total / n, how)
        heavy = sorted(index.heavy)
        index.heavy = set()
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([pickle.dumps(index)], pa.binary()), "heavy": pa.array([heavy], pa.list_(pa.string()))})

    return scratch(own.groupBy("slice").cogroup(terms.groupBy("of")).applyInArrow(build, _SLICE), "slices"), many


def _may_find(texts: DataFrame, index: DataFrame, many: int) -> DataFrame:
    """A written table (slice, key, text): the texts that hold a heavy term of a slice."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(set(words_of(t))) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("digest"), pa.array(own, pa.list_(pa.string()))], names=["digest", "terms"])

    keyed = texts.withColumn("digest", F.md5("text"))
    held = keyed.select("digest", "text").mapInArrow(words, "digest string, terms array<string>").select("digest", F.explode("terms").alias("term"))
    heavy = index.select("slice", F.explode("heavy").alias("term")).groupBy("term").agg(F.collect_set("slice").alias("in"))
    wanted = held.join(bounded(scratch(heavy, "heavy"), 100), "term").select("digest", F.explode("in").alias("slice")).distinct()
    rows = keyed.join(wanted, "digest").select("slice", "key", "text")
    path = scratch_path(texts.sparkSession, "texts")
    rows.repartition("slice", F.pmod(F.xxhash64("text"), F.lit(16))).write.partitionBy("slice").parquet(path)
    return texts.sparkSession.read.schema(rows.schema).parquet(path)


def _search(texts: DataFrame, index: DataFrame, many: int, how: Bm25) -> DataFrame:
    """(key, item_id, start, bm25, question, answer) of the leaks of texts (key, text)."""
    spark = texts.sparkSession
    schema = f"key {texts.schema['key'].dataType.simpleString()}, item_id long, start long, bm25 double, question double, answer double"
    parts = _may_find(texts, index, many) if many > 1 else None
    path = scratch_path(spark, "leaks")
    for s in range(many):
        got = index.where(F.col("slice") == s).select("data").first()
        if got is None:  # no item fell into this slice
            continue
        sent = spark.sparkContext.broadcast(pickle.loads(got.data))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(k, x) for k, t in enumerate(batch.column("text").to_pylist()) for x in leaks(t, sent.value, how)]
                own = [pa.array([r[1][c] for r in rows], kind) for c, kind in enumerate([pa.int64()] * 2 + [pa.float64()] * 3)]
                yield pa.record_batch([batch.column("key").take(pa.array([r[0] for r in rows], pa.int64())), *own], names=["key", "item_id", "start", "bm25", "question", "answer"])

        own = texts if parts is None else parts.where(F.col("slice") == s).select("key", "text")
        found = own.mapInArrow(search, schema)
        if many == 1:
            return found
        found.write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(schema).parquet(path)


_LEAK = "doc_id long, item_id long, start long, bm25 double, question double, answer double"


def find_leaks(docs: DataFrame, benchmark: DataFrame, how: Bm25 = Bm25()) -> DataFrame:
    """(doc_id, item_id, start, bm25, question, answer): the leaked items of each document, a row each."""
    index, many = slices(benchmark, how)
    if not many:
        return docs.sparkSession.createDataFrame([], _LEAK)
    found = _search(docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text")), index, many, how)
    best = F.max_by(F.struct("start", "bm25", "question", "answer"), F.struct("bm25", -F.col("start")))
    out = found.groupBy(F.col("key").alias("doc_id"), "item_id").agg(best.alias("x"))
    return out.select("doc_id", "item_id", "x.start", F.round("x.bm25", 6).alias("bm25"), "x.question", "x.answer")


def decontaminate(docs: DataFrame, benchmark: DataFrame, how: Bm25 = Bm25()) -> DataFrame:
    """The rows of docs that leak no item; columns as they are. With one slice a filter without a shuffle."""
    index, many = slices(benchmark, how)
    if not many:
        return docs
    if many == 1:
        sent = docs.sparkSession.sparkContext.broadcast(pickle.loads(index.select("data").first().data))

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not leaks(t, sent.value, how) for t in batch.column("text").to_pylist()], pa.bool_()))

        return docs.mapInArrow(clean, docs.schema)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = _search(docs.select(F.md5(text).alias("key"), text.alias("text")), index, many, how)
    bad = scratch(found.select(F.col("key").alias("bad")).distinct(), "leaking")
    rows = packed(docs).withColumn("key", F.md5(F.coalesce(F.col("doc.text").cast("string"), F.lit(""))))
    kept = rows.join(bounded(bad, 80), F.col("key") == F.col("bad"), "left_anti")
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
