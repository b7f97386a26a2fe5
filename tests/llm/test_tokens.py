"""op5: exact round trip through the files, starts, random access."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from casita.llm import token_shards
from casita.llm.queries import op5_token_shards
from casita.llm.token_shards import Encoder, Shard, Shards, compress, encoder, expand, expand_all, pack, read_index, token_index, tokenizer_path, write_shards

PATH = tokenizer_path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def want(rows):
    out, at = [], 0
    for i, t in rows:
        ids = [*PLAIN.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    assert sorted(tuple(r) for r in op5_token_shards(spark, sf_dir).collect()) == want(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab c\n\t.!'s1\x1c\x85\0\u3000éñ×ß\U0001f600\u200bа", max_size=25) | st.sampled_from([None, "<|endoftext|>", " <|endoftext|> a", "a  b   c", " ", "\n \n", "\n\nB a\nB", "don't  I'll", "a \u3000b", "a \xa0b", " señor mañana× a÷b über"]), max_size=6))
def test_pieces(texts):
    own = encoder(PATH, 50)
    assert [x.tolist() for x in own.encode(pa.array(texts, pa.string()))] == [[*PLAIN.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_long_texts_in_blocks(monkeypatch):
    monkeypatch.setattr(Encoder, "BLOCK", 64)
    texts = ["one, two\n" * 40, "", "x" * 300, " word" * 50 + "   ", "é, ñ  ü" * 30]
    own = Encoder(PATH, 20)
    assert [x.tolist() for x in own.encode(pa.array(texts).slice(0))] == [[*PLAIN.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert [len(x) for x in own.encode(pa.array(texts).slice(1, 2))] == [1, 1 + len(PLAIN.encode(texts[2]).ids)]


def test_shared_hashes(monkeypatch):
    """Pieces that share a hash are told apart by their bytes."""
    monkeypatch.setattr(token_shards, "_POWER", np.zeros(2**16, np.uint64))
    texts = ["one two three", "six ten", "a b c d", "one two"]
    assert [x.tolist() for x in Encoder(PATH, 100).encode(pa.array(texts))] == [[*PLAIN.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_shared_hashes_of_long_pieces(monkeypatch):
    """The same beyond the 16 bytes that are compared as numbers."""
    monkeypatch.setattr(token_shards, "_POWER", np.zeros(2**16, np.uint64))
    texts = [" abcdefghijklmnopqrstu", " abcdefghijklmnopqrsuu one", " abcdefghijklmno", " abcdefghijklmnp two"]
    assert [x.tolist() for x in Encoder(PATH, 100).encode(pa.array(texts))] == [[*PLAIN.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_words_need_no_pattern():
    """Words of letters up to U+00FF go to the merges alone, at the begin of a text as well."""
    texts = ["señor mañana", " où être", "Äpfel", " straße Ünü"]
    own = Encoder(PATH, 100)
    own.tokenizer = type("None", (), {"encode_batch_fast": lambda self, texts, **_: [1 / 0 for _ in texts]})()
    assert [x.tolist() for x in own.encode(pa.array(texts))] == [[*PLAIN.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_letters_end_pieces():
    """A letter with an accent ends a piece before a comma, as a plain one does; signs do not."""
    b = np.frombuffer("été, ça×. né!".encode(), np.uint8)
    starts = token_shards.piece_starts(b, np.array([0]))
    assert [bytes(x).decode() for x in np.split(b, starts[1:])] == ["été", ",", " ça×.", " né", "!"]


def test_other_tokenizer():
    """Words in lower case with ends of their own: no piece of a text stands for itself there."""
    path = tokenizer_path("word_bpe_49k.json")
    other, texts = Tokenizer.from_file(path), ["One two.", "", "A\nB"]
    assert [x.tolist() for x in Encoder(path, 10).encode(pa.array(texts))] == [[*other.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def textbook(ids, base, least):
    """One pair at a time, the most frequent one, counted anew without overlaps; of equal ones the smallest."""
    seq, rules = list(ids), []
    ends = {0}
    while True:
        at, last = {}, {}
        for i, p in enumerate(zip(seq[:-1], seq[1:], strict=True)):
            if p[0] not in ends and last.get(p, -2) != i - 1:
                at.setdefault(p, []).append(i)
                last[p] = i
        if not at or max(map(len, at.values())) < least:
            return rules, seq
        pair = min(at, key=lambda p: (-len(at[p]), p))
        new = base + len(rules)
        rules.append(pair)
        if pair[1] in ends:
            ends.add(new)
        for i in reversed(at[pair]):
            seq[i : i + 2] = [new]


DOCS = st.lists(st.lists(st.integers(0, 4), max_size=60), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(DOCS)
def test_textbook(docs):
    flat = np.array([x for d in docs for x in (*d, 0)], np.uint32)
    rules, _, seq = compress(flat, 50_257, Shards(pairs_a_round=1, min_count=2))
    want_rules, want_seq = textbook(flat.tolist(), 50_257, 2)
    assert [tuple(r) for r in rules.tolist()] == want_rules and seq.tolist() == want_seq


@settings(max_examples=150, deadline=None)
@given(DOCS, st.sampled_from([Shards(min_count=2), Shards(min_count=2, pairs_a_round=4), Shards(min_count=3)]))
def test_grammar(docs, how):
    ids = [np.array([*d, 0], np.uint32) for d in docs]
    flat = np.concatenate(ids)
    rules, lengths, seq = compress(flat, 50_257, how)
    assert expand(seq, rules, lengths, 50_257).tolist() == flat.tolist()
    assert expand_all(seq, rules, lengths, 50_257).tolist() == flat.tolist()
    # it goes on to its end, and every rule is in use
    assert textbook_left(seq.tolist(), rules) < how.min_count
    used = set(seq.tolist()) | set(rules.ravel().tolist())
    assert set(range(50_257, 50_257 + len(rules))) <= used
    shard = Shard(pack(list(range(len(ids))), np.cumsum([len(x) for x in ids]), flat, 50_257, how))
    assert [x.tolist() for x in shard.documents()] == [x.tolist() for x in ids]
    assert [shard.document(k).tolist() for k in range(len(ids))] == [x.tolist() for x in ids]
    assert [shard.id(n) for n in range(len(flat))] == flat.tolist()


def textbook_left(seq, rules):
    """How often the most frequent pair still occurs."""
    ends = {0}
    for k, (_, b) in enumerate(rules.tolist()):
        if b in ends:
            ends.add(50_257 + k)
    at, last = {}, {}
    for i, p in enumerate(zip(seq[:-1], seq[1:], strict=True)):
        if p[0] not in ends and last.get(p, -2) != i - 1:
            at[p] = at.get(p, 0) + 1
            last[p] = i
    return max(at.values(), default=0)


def test_symbols_grow_by_a_bit():
    """From 2**16 symbols on a rule pays at four places in place of five: pairs that had four before become rules then."""
    base, flat = 65_530, np.append(np.random.default_rng(5).integers(1, 60, 12_000), 0).astype(np.uint32)
    rules, lengths, seq = compress(flat, base)
    assert base + len(rules) > 2**16 and expand(seq, rules, lengths, base).tolist() == flat.tolist()
    at, last = {}, {}
    for i, p in enumerate(zip(seq[:-2].tolist(), seq[1:-1].tolist(), strict=True)):
        if last.get(p, -2) != i - 1:
            at[p], last[p] = at.get(p, 0) + 1, i
    assert max(at.values()) < 4


def test_pairs_of_many_symbols():
    """Pairs and places that do not fit a number are grouped the same."""
    sym = np.random.default_rng(1).integers(0, 9, 1001).astype(np.int32)
    after, few, many = np.arange(1, 1002, dtype=np.int32), np.zeros(100, bool), np.zeros(2**28, bool)
    few[0] = many[0] = True
    for x, y in zip(token_shards._grouped(sym, after, few, np.arange(1000), 9), token_shards._grouped(sym, after, many, np.arange(1000), 9), strict=True):
        assert x.tolist() == y.tolist() and len(x)


def test_rounds_keep_up_with_the_textbook():
    """Many pairs a round cost no more than a twentieth in size on skewed ids."""
    flat = np.random.default_rng(3).zipf(1.3, 6000).astype(np.uint32) % 300
    rules, _, seq = compress(flat, 50_257, Shards(min_count=4))
    want_rules, want_seq = textbook(flat.tolist(), 50_257, 4)
    assert len(seq) + 2 * len(rules) <= 1.05 * (len(want_seq) + 2 * len(want_rules))


@pytest.mark.parametrize("bits", [1, 7, 8, 16, 17, 24, 31])
def test_bit_packing(bits):
    values = np.random.default_rng(bits).integers(0, 2**bits, 70_001).astype(np.uint32)
    data = np.frombuffer(token_shards._packed(values, bits), np.uint8)
    assert len(data) == -(-len(values) * bits // 8)
    assert (token_shards._unpacked(data, 0, len(values), bits) == values).all()
    assert token_shards._unpacked(data, 65_533, 9, bits).tolist() == values[65_533:65_542].tolist()


def test_grammar_gains():
    flat = np.tile(np.arange(1, 30, dtype=np.uint32), 400)
    rules, _, seq = compress(flat, 50_257)
    assert len(seq) + 2 * len(rules) < len(flat) / 10


def test_small_shards_and_odd_inputs(spark, make, tmp_path):
    texts = [None, "", "one two", "x " * 40_000, "é\U0001f600", "same", "same"]
    docs = make([*texts, *[f"number {k} of many" for k in range(60)]], ("tie", "part", "data"))
    how = Shards(shard_ids=50)
    write_shards(docs, f"{tmp_path}/a", how)
    shards = spark.read.parquet(f"{tmp_path}/a")
    assert shards.count() > 3
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(tuple(r) for r in read_index(shards).collect()) == want(rows)
    twice = [tuple(r) for r in token_index(make([(1, "b", "", ""), (1, "a", "", ""), (1, "b", "", ""), (None, "z", "", "")]), f"{tmp_path}/b").collect()]
    assert len(twice) == 4 and sorted(x[1] for x in twice) == [0, 2, 4, 6]
    assert token_index(make([]), f"{tmp_path}/c").count() == 0


def test_no_shard():
    with pytest.raises(ValueError):
        Shard(b"none")
