"""Line dedup within one edit, by a deletion-neighbourhood join.

A line (its words joined by a space) is dropped when an earlier line, by doc_id, then place, equals it or is within one
word edit of it: a word put in, left out or changed. Lines of under `min_fuzzy_words` = 5 words must be equal, so that
similarity stays at 0.8 or more. Lines without a word stay.

Every line emits itself and its variants with one word deleted, as 128-bit hashes. Two lines within one edit meet in equal
variants: equal lengths share a variant that lacks the same place; lengths that differ by one share the shorter line
itself and a variant of the longer. The earliest line of a variant is an aggregate, so no pair list exists: each line gets
the earliest line it meets, and that one pair is verified on the words themselves.

Scale: equal lines collapse to one row before anything else (an aggregate that combines on the map side). A line with a
partner within one edit shares its first or its last words with it (five, or two if either has under eleven words), and
half of its words at the start or the end; only lines that share these with another line go on to emit variants, and only
those that lack a word outside the shared half, which loses no partner. Joins back to the lines are equi-joins that AQE
may split where an edge, a half or a variant is common. A variant costs O(1) by sums of weighted word hashes, so long
lines are linear. Texts meet the lists of their lines by a broadcast while a list is small (its rows are counted first),
else by a shuffle.

Defined results: a null text has no lines and stays null; rows with one doc_id are one document (each of them keeps
what the document keeps), and rows without one are together the last document; very long lines are compared whole; an
empty table gives an empty table. Columns of the input are kept in a struct, so extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, doc_key, packed, scratch

#: Odd multipliers of the two hash lanes; their powers weigh the places of a line.
_BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


@dataclass(frozen=True)
class Lines:
    min_fuzzy_words: int = 5
    #: Words at a line's start and end of which one side is shared by lines within one edit: those of shorter lines (twice
    #: that is under min_fuzzy_words) and those of lines of `long_words` or more (twice that is under long_words).
    edge_words: tuple[int, int] = (2, 5)
    long_words: int = 11


def line_words(line: str) -> list[str]:
    return line.split()


def _hashes(words: list[str]) -> np.ndarray:
    """(2, n) word hashes, one lane a seed."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    return np.array([[xxhash.xxh3_64_intdigest(w, seed) for w in raw] for seed in (1, 2)], dtype=np.uint64).reshape(2, len(raw))


def _powers(n: int) -> np.ndarray:
    out = np.ones((2, n + 1), dtype=np.uint64)
    out[:, 1:] = _BASE[:, None]
    return np.multiply.accumulate(out, axis=1, dtype=np.uint64)


def variants(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the words (2,) and of the words less the i-th, for each i (2, n): sums of hash times power of the place."""
    h, p, n = _hashes(words), _powers(len(words)), len(words)
    term = h * p[:, :n]
    before = np.concatenate([np.zeros((2, 1), np.uint64), np.add.accumulate(term, axis=1, dtype=np.uint64)], axis=1)
    shifted = h[:, 1:] * p[:, : n - 1] if n else h
    after = np.concatenate([np.add.accumulate(shifted[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], np.zeros((2, 1), np.uint64)], axis=1)
    return before[:, n], before[:, :n] + after[:, :n]


def within_one_edit(a: list[str], b: list[str]) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    short, long_ = sorted((a, b), key=len)
    i = 0
    while i < len(short) and short[i] == long_[i]:
        i += 1
    return short[i + 1 :] == long_[i + 1 :] if len(a) == len(b) else short[i:] == long_[i + 1 :]


def _digest(words: list[str]) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
    return (h >> 64) - 2**63, (h & (2**64 - 1)) - 2**63


def _edge_keys(words: list[str], how: Lines = Lines()) -> list[int]:
    """Hashes of the first and of the last words: one edit leaves one of them as it is. The shortest of the long lines has
    a key for partners on either side of `long_words`."""
    n = len(words)
    if n < how.min_fuzzy_words:
        return []
    sizes = [k for k, own in zip(how.edge_words, (n <= how.long_words, n >= how.long_words), strict=True) if own]
    return [xxhash.xxh3_64_intdigest(f"{k} {side} {' '.join(part)}".encode("utf-8", "surrogatepass")) - 2**63 for k in sizes for side, part in ((0, words[:k]), (1, words[-k:]))]


def _half_keys(words: list[str]) -> list[int]:
    """For a line of n words: start, end, start and end that a partner of n, n - 1 or n + 1 words shares with it, if the edit is elsewhere."""
    out = []
    for n in (len(words), len(words) - 1):
        for side, half in ((0, words[: n // 2]), (1, words[len(words) - (n - n // 2) :])):
            out.append(xxhash.xxh3_64_intdigest(f"{n} {side} {' '.join(half)}".encode("utf-8", "surrogatepass")) - 2**63)
    return out


_LINE = "doc_id long, pos long, h1 long, h2 long, edges array<long>"


def _emit(how: Lines):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen = set()
                for pos, line in enumerate(text.split("\n") if text else ()):
                    words = line_words(line)
                    key = _digest(words) if words else None
                    if key and key not in seen:
                        seen.add(key)
                        for c, x in zip(cols, (doc, pos, *key, _edge_keys(words, how)), strict=True):
                            c.append(x)
            yield pa.record_batch([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.list_(pa.int64()))], names=["doc_id", "pos", "h1", "h2", "edges"])

    return emit


_WANTED = "doc_id long, spot long, h1 long, h2 long, words array<string>, halves array<long>"


def _emit_wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and half keys of the lines that are wanted of each text."""
    for batch in batches:
        cols: list[list] = [[], [], [], [], [], []]
        for doc, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True):
            lines = text.split("\n") if text else []
            for spot in places:
                words = line_words(lines[spot >> 32]) if spot >> 32 < len(lines) else []
                key = _digest(words) if words else (0, ~spot)
                if (key[1] ^ spot) & 0xFFFFFFFF == 0:  # else another row of this doc_id has the line
                    for c, x in zip(cols, (doc, spot, *key, words, _half_keys(words)), strict=True):
                        c.append(x)
        yield pa.record_batch([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.list_(pa.string())), pa.array(cols[5], pa.list_(pa.int64()))], names=["doc_id", "spot", "h1", "h2", "words", "halves"])


_VARIANT = "doc_id long, spot long, place int, v1 long, v2 long"


def _emit_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per line: its own hash with place -1, and the hash of each variant that lacks a word outside a shared half, with its place."""
    for batch in batches:
        parts, places = [], []
        for w, start, end in zip(batch.column("words").to_pylist(), batch.column("start").to_pylist(), batch.column("end").to_pylist(), strict=True):
            whole, less = variants(w)
            lo, hi = 0 if end else (len(w) - 1) // 2, len(w) if start else (len(w) - 1) // 2 + 1
            parts.append(np.concatenate([whole[:, None], less[:, lo:hi]], axis=1))
            places.append(np.r_[-1, lo:hi])
        sizes = np.array([len(x) for x in places], np.int64)
        keys = np.concatenate(parts, axis=1).view(np.int64) if parts else np.empty((2, 0), np.int64)
        place = np.concatenate(places) if parts else np.empty(0, np.int64)
        own = [pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes), pa.int64()) for c in ("doc_id", "spot")]
        yield pa.record_batch([*own, pa.array(place.astype(np.int32)), pa.array(keys[0]), pa.array(keys[1])], names=["doc_id", "spot", "place", "v1", "v2"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [within_one_edit(a, b) for a, b in zip(batch.column("words").to_pylist(), batch.column("p_words").to_pylist(), strict=True)]
        yield batch.select(["h1", "h2"]).filter(pa.array(ok, pa.bool_()))


def _near(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """(h1, h2) of distinct lines that an earlier line comes within one word edit of."""
    # a line's place in order, in one long: its number in the text, then bits of its hash for rows that share a doc_id
    spot = F.shiftleft("pos", 32).bitwiseOR(F.col("h2").bitwiseAND(F.lit(0xFFFFFFFF))).alias("spot")
    edge = distinct.select("doc_id", spot, F.explode("edges").alias("edge"))
    common = edge.groupBy("edge").agg(F.count("*").alias("n")).where("n > 1").select("edge")
    wanted = scratch(edge.join(common, "edge").groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("spot").alias("places")), "wanted")
    texts = docs.select(doc_key().alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(bounded(wanted, 200), F.col("doc_id") == F.col("id")).select("doc_id", "text", "places")
    lines = scratch(texts.mapInArrow(_emit_wanted, _WANTED).dropDuplicates(["h1", "h2"]), "wanted-lines")
    half = lines.select("h1", "h2", F.posexplode("halves").alias("k", "half"))
    common = half.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    # which of a line's halves, start or end, another line has: the edit is in the other one
    close = half.join(common, "half").groupBy("h1", "h2").agg(F.max(F.col("k") % 2 == 0).alias("start"), F.max(F.col("k") % 2 == 1).alias("end"))
    lines = lines.join(close, ["h1", "h2"]).select("doc_id", "spot", "h1", "h2", "words", "start", "end")
    each = scratch(lines.select("doc_id", "spot", "words", "start", "end").mapInArrow(_emit_variants, _VARIANT).select(F.struct("doc_id", "spot").alias("line"), "place", "v1", "v2"), "variants")
    whole, less = each.where("place < 0").select("v1", "v2", F.col("line").alias("w")), each.where("place >= 0")
    # the same place left out, or the whole of the shorter against a variant of the longer
    low = less.groupBy("v1", "v2", "place").agg(F.min("line").alias("p"), F.max("line").alias("q")).where("p < q").select("v1", "v2", "place", "p")
    alike = less.join(low, ["v1", "v2", "place"]).select("line", "p")
    met = less.join(whole, ["v1", "v2"]).select("line", "w")
    longer, shorter = met.select("line", F.col("w").alias("p")), met.groupBy(F.col("w").alias("line")).agg(F.min("line").alias("p"))
    pairs = alike.unionByName(shorter).unionByName(longer).where("line > p").groupBy("line").agg(F.min("p").alias("p"))
    text = lines.select(F.struct("doc_id", "spot").alias("line"), "h1", "h2", "words")
    both = pairs.join(text, "line").join(text.select(F.col("line").alias("p"), F.col("words").alias("p_words")), "p")
    return both.select("h1", "h2", "words", "p_words").mapInArrow(_verify, "h1 long, h2 long").distinct()


def duplicate_lines(docs: DataFrame, how: Lines = Lines()) -> DataFrame:
    """(doc_id, h1, h2, all): lines that a document loses: in all its places, or in all but the first."""
    plain = docs.select(doc_key().alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = scratch(plain.mapInArrow(_emit(how), _LINE), "lines")
    distinct = scratch(lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.max("doc_id").alias("last"), F.first("edges").alias("edges")).select("h1", "h2", "first.doc_id", "first.pos", "last", "edges"), "distinct-lines")
    fuzzy = _near(distinct, docs).withColumn("near", F.lit(True))
    # a line goes from every place if it is near an earlier one, else from every document but its first
    verdict = distinct.join(fuzzy, ["h1", "h2"], "left").where("near OR doc_id < last").select("h1", "h2", F.col("doc_id").alias("first"), F.coalesce("near", F.lit(False)).alias("near"))
    return lines.join(verdict, ["h1", "h2"]).where("near OR doc_id > first").select("doc_id", "h1", "h2")


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, total, gone = [], [], []
        for text, lost in zip(batch.column("text").to_pylist(), batch.column("lost").to_pylist(), strict=True):
            lost = {(r["h1"], r["h2"]) for r in lost or ()}
            kept, n, k = [], 0, 0
            for line in text.split("\n") if text else ():
                words = line_words(line)
                key = _digest(words) if words else None
                n += key is not None
                if key in lost:
                    k += 1
                else:
                    kept.append(line)
                    if key:
                        lost.add(key)
            texts.append("\n".join(kept) if text else text)
            total.append(n)
            gone.append(k)
        yield pa.record_batch([batch.column("doc"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())], names=["doc", "n_lines", "n_dropped", "kept_text"])


def drop_lines(docs: DataFrame, how: Lines = Lines()) -> DataFrame:
    """doc (a struct of the input's columns), n_lines with a word, n_dropped, kept_text."""
    lost = scratch(duplicate_lines(docs, how).groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("lost")).withColumnRenamed("doc_id", "id"), "lost")
    rows = packed(docs).withColumn("text", F.col("doc.text").cast("string")).join(bounded(lost, 200), doc_key("doc.doc_id") == F.col("id"), "left").select("doc", "text", "lost")
    return rows.mapInArrow(_keep, f"doc {rows.schema['doc'].dataType.simpleString()}, n_lines long, n_dropped long, kept_text string")
