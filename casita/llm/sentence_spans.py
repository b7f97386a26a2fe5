"""Substring dedup by sliding sentence spans.

A text is cut into sentences (after . ! ? and at line breaks; a sentence of over 40 words is cut further after words whose
hash says so, wherever it begins, so that equal stretches are cut alike). From every sentence starts one run, and at every sentence ends one:
at least `sentences` = 2 consecutive sentences, and as many more as it takes to reach `min_words` = 38 words (about the 50
tokens that are usual for exact substrings; shorter repeats are mostly stock phrases). So every
sentence of a repeated passage of that size lies in a run inside the passage, up to its short last ones. A whole text of
several sentences but fewer words is one run, which only such texts share. Runs are hashed (128 bits, white space made
single) and joined over all documents. The first occurrence of a run is the one with the smallest doc_id, then
place; sentences covered by any other occurrence are removed, the rest of the text stays as it is.

A repeat that begins or ends inside sentences may hold few whole ones, so spans of `min_words` words slide over the words of
a text as well. Of each `passage` - `min_words` + 1 = 14 spans in a row the one with the least hash counts: the choice depends on
these words alone, so two documents that share `passage` = 51 words in a row, wherever their sentences end, choose a span in common.
The words of spans that an earlier document has are passages: each of them is one of 38 in a row that stand there, and of a
repeat of 51 and more at most 13 words at each end are left out. One of 38 to 50 words is found where a span of it is chosen.
Passages repeat between documents; repeats inside a text are for the runs of sentences. kept_text is the text without the
sentences of repeated runs, rest_text is the text without these and without the passages.

Scale: repeats inside a text are settled where the text is read, so a text sends each of its runs and chosen spans once: three
longs. They are sorted by hash once, and a window of each hash finds its first document; it spills where a run is common. What
comes back to a document is the list of its own repeated runs and spans, bounded by its words. Texts are cut in Arrow
batches; a batch holds whole texts.

Defined results: a null text has no sentences and stays null; rows with one doc_id are one document (each keeps what the
document keeps), and rows without one are together the last document; very long texts are cut and hashed whole; an empty
table gives an empty table. Columns of the input are kept in a struct, so extra columns may
have any name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_key, packed

_CUT = re.compile(r"[.!?\n](?:\s+|(?<=\n))")
_LONG = 40
_NEXT_WORD = re.compile(r"\S+\s*")
_WORD = re.compile(r"\S+")


@dataclass(frozen=True)
class Spans:
    sentences: int = 2
    min_words: int = 38
    passage: int = 51


def sentences(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, words joined by a space, number of words); spans lie end to end and cover the text from its first sentence on."""
    out, at = [], 0
    cuts = [m.end() for m in _CUT.finditer(text)]
    for end in [*cuts, len(text)]:
        words = text[at:end].split()
        if len(words) > _LONG:
            out += _pieces(text, at, end)
        elif words:
            out.append((at, end, " ".join(words), len(words)))
        elif out:
            out[-1] = (out[-1][0], end, *out[-1][2:])
        at = end
    return out


def _pieces(text: str, at: int, end: int) -> Iterator[tuple[int, int, str, int]]:
    held, start = [], at
    for m in _NEXT_WORD.finditer(text, at, end):
        held.append(m[0].strip())
        if zlib.crc32(held[-1].encode("utf-8", "surrogatepass")) % 16 == 0:
            yield start, m.end(), " ".join(held), len(held)
            held, start = [], m.end()
    if held:
        yield start, end, " ".join(held), len(held)


def _shortest(words: list[int], how: Spans) -> list[tuple[int, int]]:
    """(i, j) of the shortest run from each i on, while there is one."""
    out, j, held = [], 0, 0
    for i in range(len(words)):
        while j < len(words) and (j - i < how.sentences or held < how.min_words):
            held += words[j]
            j += 1
        if j - i < how.sentences or held < how.min_words:
            break
        out.append((i, j))
        held -= words[i]
    return out


def runs(cut: list[tuple[int, int, str, int]], how: Spans) -> list[tuple[int, int, bytes]]:
    """(first sentence, end sentence, hash), in order: the shortest runs from each start and to each end."""
    words, texts, n = [c[3] for c in cut], [c[2] for c in cut], len(cut)
    spans = {*_shortest(words, how), *((n - j, n - i) for i, j in _shortest(words[::-1], how))}
    if not spans and n >= how.sentences:
        spans = {(0, n)}
    return [(i, j, _hash(" ".join(texts[i:j]))) for i, j in sorted(spans)]


def _hash(words: str, seed: int = 0) -> bytes:
    return xxhash.xxh3_128_digest(words, seed)


def _slide(op: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """op over each `width` values in a row."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = op(values[:-step], values[step:])
        have += step
    return values


def word_spans(words: list[str], how: Spans) -> list[tuple[int, bytes]]:
    """(first word, hash) of the chosen spans of min_words words; they are chosen by the sums of their words' hashes, and
    their own hashes are no run's."""
    k, width = how.min_words, max(how.passage - how.min_words, 0) + 1
    if len(words) < k + width - 1:
        return []
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(np.frombuffer(b"".join([xxhash.xxh3_64_digest(w) for w in words]), np.uint64), out=sums[1:])
    h = sums[k:] - sums[:-k]
    edge = np.zeros(width - 1, np.uint64)
    least = np.concatenate([edge, _slide(np.minimum, h, width), edge])
    return [(i, _hash(" ".join(words[i : i + k]), 1)) for i in np.flatnonzero(_slide(np.maximum, least, width) == h).tolist()]


def passages(text: str, known: set[bytes], how: Spans) -> tuple[int, list[tuple[int, int]]]:
    """Number of words in spans that are known, and where they stand, with the white space after them."""
    words = text.split()
    found = [i for i, h in word_spans(words, how) if h in known]
    if not found:
        return 0, []
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out = []
    for i in found:
        if out and i <= out[-1][1]:
            out[-1] = (out[-1][0], i + how.min_words)
        else:
            out.append((i, i + how.min_words))
    return sum(j - i for i, j in out), [(at[i], at[j]) for i, j in out]


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at : max(at, start)])
        at = max(at, end)
    return "".join([*out, text[at:]])


def _emit(how: Spans):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hashes = [], []
            for text in batch.column("text").to_pylist():
                own = {*(h for *_, h in runs(sentences(text), how)), *(h for _, h in word_spans(text.split(), how))} if text else ()
                sizes.append(len(own))
                hashes += own
            halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            ids = np.repeat(batch.column("doc_id").to_numpy(), sizes)
            yield pa.record_batch([pa.array(ids), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], names=["doc_id", "h1", "h2"])

    return emit


def _known(seen: pa.ListArray) -> Iterator[set[bytes]]:
    """The hashes of each list of halves."""
    both = seen.flatten()
    data = np.stack([both.field(k).to_numpy() for k in (0, 1)], axis=1).tobytes()
    at = 0
    for n in pc.fill_null(pc.list_value_length(seen), 0).to_pylist():
        yield {data[k : k + 16] for k in range(at, at + 16 * n, 16)}
        at += 16 * n


_PLACES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _remove(how: Spans):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone, total, spans, n_words, found, rests = [], [], [], [], [], [], []
            for text, known in zip(batch.column("text").to_pylist(), _known(batch.column("seen")), strict=True):
                cut = sentences(text or "")
                n, places = passages(text, known, how) if known else (0, [])
                drop = np.zeros(len(cut), dtype=bool)
                for i, j, h in runs(cut, how):
                    if h in known:
                        drop[i:j] = True
                    known.add(h)
                texts.append(text if text is None else text[: cut[0][0] if cut else len(text)] + "".join(text[c[0] : c[1]] for c, d in zip(cut, drop, strict=True) if not d))
                gone.append(int(drop.sum()))
                total.append(len(cut))
                spans.append([{"start": c[0], "end": c[1]} for c, d in zip(cut, drop, strict=True) if d])
                n_words.append(n)
                found.append([{"start": a, "end": b} for a, b in places])
                rests.append(_without(text, [*places, *((s["start"], s["end"]) for s in spans[-1])]) if places else texts[-1])
            yield pa.record_batch(
                [batch.column("doc"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, _PLACES), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(found, _PLACES), pa.array(rests, pa.string())],
                names=["doc", "n_sentences", "n_removed", "removed", "kept_text", "n_passage_words", "passages", "rest_text"],
            )

    return remove


def repeated(docs: DataFrame, how: Spans = Spans()) -> DataFrame:
    """(doc_id, h1, h2): runs and word spans of a document that an earlier document has too."""
    each = docs.select(doc_key().alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_emit(how), "doc_id long, h1 long, h2 long")
    first = F.min("doc_id").over(Window.partitionBy("h1", "h2"))
    return each.withColumn("first", first).where("doc_id > first").select("doc_id", "h1", "h2")


def remove_repeats(docs: DataFrame, how: Spans = Spans()) -> DataFrame:
    """doc (a struct of the input's columns), n_sentences, n_removed, removed (spans of code points), kept_text,
    n_passage_words, passages (spans of code points), rest_text."""
    seen = repeated(docs, how).groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("seen")).withColumnRenamed("doc_id", "id")
    rows = packed(docs).join(seen, doc_key("doc.doc_id") == F.col("id"), "left").select("doc", F.col("doc.text").cast("string").alias("text"), "seen")
    places = "array<struct<start:long,end:long>>"
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, n_sentences long, n_removed long, removed {places}, kept_text string, n_passage_words long, passages {places}, rest_text string"
    return rows.mapInArrow(_remove(how), schema)
