"""Token ids in binary shards, compressed by a Re-Pair grammar.

Texts are encoded by a given tokenizers file; each document ends with id 0. A shard holds whole documents in ascending
doc_id order, about `shard_ids` ids of them. Re-Pair: the most frequent pairs of neighbours are replaced by nonterminals
until no pair is worth a rule; the rules and the length of what each nonterminal expands to are stored, so a reader can
step to any id without expanding what lies before it. No rule crosses the end of a document (no pair starts with a
symbol that ends in id 0), so a document starts at a symbol.

Pairs go in rounds. A round takes pairs from the most frequent one down, at most `pairs_a_round` of them, such that no
symbol is on the right of one and on the left of another: such pairs never overlap, so replacing them together is
replacing them one by one. Counts are exact: the places of each pair that can still become a rule are listed, and a round
strikes out those that its replacements destroy and lists those that they create, so it costs what it changes.
The grammar ends when the most frequent pair saves no more bits than its rule takes (two symbols and a length), also when
the symbols have grown by a bit on the way; `min_count` = 2 ends where no pair occurs twice, and one pair a round is the
textbook order.

File format, a binary value per shard in a Parquet table (part, shard, n_ids, data), all little-endian: magic "RPG2";
counts of documents, rules and symbols, base (the first nonterminal) and bits of a symbol as 5 unsigned 64-bit integers;
then doc_id (int64), symbols up to the end of each document (uint64), ids up to the end of each document (uint64),
expansion lengths (uint32), and in that many bits each, the two symbols of every rule and the symbols.

Scale: one shuffle deals the texts to ranges of (doc_id, hash of text), so rows of one doc_id can spread; every task
writes its shards through Spark's Parquet writer, so lost tasks are repeated without trace. A document's start is the sum
over parts, shards and documents before it: running sums over one row a part, then one a shard.

Encoding: a piece of text that begins at a space before a non-space is tokenized by itself, and so are its runs of letters
(ASCII and U+00C0 to U+00FF) and what follows them; pieces are encoded once by a worker and their ids kept in a table of at
most `kept_pieces`; what does not fit is encoded anew in each block of text. Pieces of up to 16 bytes are looked up and
compared as two numbers, longer ones byte by byte. Texts with special tokens' strings are encoded whole.

Defined results: a null text is empty, its only id the end; rows with one doc_id follow each other, ordered by the hash of
their text; null doc_ids come first; an empty table gives an empty table; a text longer than a shard is a shard of its
own, and a worker holds one shard's texts at a time. Only doc_id and text are read, so extra columns may have any name.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAGIC = b"RPG2"
END_ID = 0


@dataclass(frozen=True)
class Shards:
    tokenizer: str = "byte_bpe_50k.json"
    shard_ids: int = 1_000_000
    #: Pairs that are replaced in one round, at most.
    pairs_a_round: int = 8192
    #: Least count of a pair that becomes a rule; None: as long as the rule saves bits.
    min_count: int | None = None
    kept_pieces: int = 500_000


# --- encoding


def tokenizer_path(name: str) -> str:
    """A path as it is; a bare name is a file of the installed public tokenizers."""
    if os.sep in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of each row, end to end."""
    ends = np.cumsum(length)
    at = np.repeat(start - (ends - length), length)
    at += np.arange(len(at), dtype=at.dtype)
    return flat[at]


def _class_table() -> np.ndarray:
    """What cuts need to know of a byte: 1 may follow the space that begins a piece, 2 an ASCII letter, 4 another ASCII character, 8 ASCII but no space, 16 ends a letter from U+00C0 to U+00FF if 0xC3 is before it."""
    out = np.zeros(256, np.uint8)
    out[0x21:0x7F] |= 1 | 8
    out[0xC3:0xE0] |= 1  # two-byte characters from U+00C0 on: none is a space
    letters = np.r_[65:91, 97:123]
    out[:128] |= 4
    out[letters] ^= 4 | 2
    out[0x80:0xC0] |= 16
    out[[0x97, 0xB7]] ^= 16  # the signs of multiplication and division
    return out


_CLASS = _class_table()
#: Bytes of letters up to U+00FF: no other character consists of them alone.
_LETTER = (_CLASS & (2 | 16)) > 0
_LETTER[0xC3] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX_TOO = np.uint64(0xC2B2AE3D27D4EB4F)
_POWER = np.multiply.accumulate(np.full(2**16, _MIX | np.uint64(1)), dtype=np.uint64)


def piece_starts(b: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pieces start in the bytes of texts that begin at `begins`: places where a token ends in any case.

    At a space before a character that is no space; after an ASCII letter or one from U+00C0 to U+00FF, before another ASCII
    character; and at an ASCII letter after a single line break.
    """
    kind = _CLASS[b]
    cut = np.zeros(len(b), bool)
    cut[:-1] = (b[:-1] == 32) & (kind[1:] & 1).view(bool)
    ends = begins[1:] - 1
    cut[ends[ends >= 0]] = False  # what follows is another text
    cut[1:] |= ((kind[:-1] >> 1) & (kind[1:] >> 2) & 1).view(bool)
    cut[2:] |= (b[:-2] == 0xC3) & ((kind[1:-1] >> 4) & (kind[2:] >> 2) & 1).view(bool)
    cut[2:] |= (b[1:-1] == 10) & ((kind[2:] >> 1) & (kind[:-2] >> 3) & 1).view(bool)
    cut[begins[begins < len(b)]] = True
    return np.flatnonzero(cut)


def _alphabet() -> np.ndarray:
    """How a byte-level vocabulary spells each byte: as its Latin-1 character, or from U+0100 on if that is none to be seen."""
    out = np.arange(256, dtype="<u4")
    unseen = np.r_[0:0x21, 0x7F:0xA1, 0xAD]
    out[unseen] = 0x100 + np.arange(len(unseen))
    return out


_ALPHABET = _alphabet()
#: Bytes of a piece that are looked at as two numbers, and which of a number's bytes belong to so many.
SHORT = 16
_FIRST = np.array([2 ** (8 * k) - 1 for k in range(9)], np.uint64)


def _as_numbers(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 8 bytes and the 8 after them of pieces, with zeros behind their ends; `words` are 8 bytes each, two more than the pieces need."""
    at, shift = start >> 3, (start.astype(np.uint64) & np.uint64(7)) << np.uint64(3)
    back, middle = np.uint64(63) - shift, words[at + 1]
    low = (words[at] >> shift | middle << np.uint64(1) << back) & _FIRST[np.minimum(size, 8)]
    return low, (middle >> shift | words[at + 2] << np.uint64(1) << back) & _FIRST[np.clip(size - 8, 0, 8)]


class Encoder:
    """ids of texts as little-endian uint16 or uint32 arrays, by pieces that are kept.

    A table finds a piece by the hash of its bytes, in one of two places; the bytes themselves are compared, so that
    nothing depends on the hash. Only a byte-level tokenizer with the common pattern is given pieces, others whole texts.
    """

    #: Pieces that are tokenized as one string, and bytes of text that are looked up at a time.
    TOGETHER, BLOCK = 2000, 1 << 21

    def __init__(self, path: str, kept: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        pre = told["pre_tokenizer"] or {}
        self.by_piece = told["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True and not pre.get("add_prefix_space")
        #: The same merges for words of letters, spelled as the vocabulary does (a space is U+0120): they need no pattern.
        self.words = Tokenizer.from_str(json.dumps(told | {"pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": " "}, "added_tokens": [], "post_processor": None}))
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.base = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2") if self.base <= 2**16 else np.dtype("<u4")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Bytes of text that an id stands for; a byte-level vocabulary has one character a byte.
        self.width = np.zeros(self.base, dtype=np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)
        self.kept, self.shift = kept, np.uint64(64 - max(1, (4 * kept).bit_length()))
        self.table = np.zeros(2 ** (64 - int(self.shift)), np.int32)
        #: By the number of a piece (0: the end of a text): hash, end of its ids in `ids` and of its bytes in `raw`. The
        #: first `known` pieces are in the table, later ones are those of the block at hand.
        self.hash, self.known = np.zeros(1024, np.uint64), 1
        self.ids, self.ends = np.full(4096, END_ID, self.dtype), np.ones(1024, np.int32)
        self.raw, self.raw_ends = np.zeros(8192, np.uint8), np.zeros(1024, np.int32)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _tokenized(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of pieces (bytes, end to end), also end to end, and how many each has."""
        ends = np.cumsum(sizes)
        starts = ends - sizes
        second = np.where(sizes > 1, raw[np.minimum(starts + 1, len(raw) - 1)], 0)
        spaced = (raw[starts] == 32) & (_CLASS[second] & 1).view(bool)
        letter = _LETTER[raw]
        letter[starts] |= spaced
        word = np.logical_and.reduceat(letter, starts)  # letters, maybe after a space: one token before merges
        length, flat, order = np.zeros(len(sizes), np.int64), [np.empty(0, self.dtype)], []
        for mask, tokenizer, spell in ((word, self.words, self._spelled), (spaced & ~word, self.tokenizer, lambda x, _: x.tobytes().decode())):
            own = np.flatnonzero(mask)
            for lo in range(0, len(own), self.TOGETHER):
                some = own[lo : lo + self.TOGETHER]
                text = spell(_gathered(raw, starts[some], sizes[some]), sizes[some])
                ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
                # words stand apart, and pieces that begin with a space before a non-space do not change each other
                have, want = np.cumsum(self.width[ids]), np.cumsum(sizes[some])
                at = np.searchsorted(have, want) + 1
                if at[-1] != len(ids) or not (have[at - 1] == want).all():
                    raise ValueError("the tokenizer joins pieces across spaces")
                flat.append(ids)
                length[some] = np.diff(at, prepend=0)
            order.append(own)
        own = np.flatnonzero(~spaced & ~word)
        data = raw.tobytes()
        pieces = [data[a:b].decode() for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
        for i, x in zip(own.tolist(), self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False), strict=True):
            flat.append(np.array(x.ids, dtype=self.dtype))
            length[i] = len(x.ids)
        # from the order in which they were encoded to that of the pieces
        order = np.concatenate([*order, own])
        begin = np.empty(len(sizes), np.int64)
        begin[order] = np.cumsum(length[order]) - length[order]
        return _gathered(np.concatenate(flat), begin, length), length

    @staticmethod
    def _spelled(raw: np.ndarray, sizes: np.ndarray) -> str:
        """Words as a byte-level vocabulary spells them, a space before each."""
        at = np.arange(len(raw)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)
        out = np.full(len(raw) + len(sizes), ord(" "), _ALPHABET.dtype)
        out[at] = _ALPHABET[raw]
        return out.tobytes().decode("utf-32-le")

    def _hashed(self, b: np.ndarray, starts: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray, long: np.ndarray) -> np.ndarray:
        """Hashes of pieces: of the two numbers of a short one, of all bytes of a long one."""
        h = low * _POWER[0]
        h += high * _POWER[1]
        h += size.astype(np.uint64) * _POWER[2]
        if len(long):
            ends = np.cumsum(size[long])
            place = np.arange(ends[-1]) - np.repeat(ends - size[long], size[long])
            h[long] = np.add.reduceat(_POWER[place & 0xFFFF] * (b[np.repeat(starts[long], size[long]) + place] + np.uint64(1)), ends - size[long])
        h ^= h >> np.uint64(29)
        h *= _MIX
        h |= np.uint64(1)  # 0 is no piece's hash
        return h

    def _found(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, 0 where there is none."""
        number = self.table[h >> self.shift]
        other = np.flatnonzero(self.hash[number] != h)
        again = self.table[(h[other] * _MIX_TOO) >> self.shift]
        number[other] = np.where(self.hash[again] == h[other], again, 0)
        return number

    def _block(self, b: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ends of the texts in them, texts that are to be encoded whole) of the bytes of some texts."""
        starts = piece_starts(b, begins)
        size = np.diff(starts, append=len(b))
        words = np.zeros(len(b) // 8 + 3, "<u8")
        words.view(np.uint8)[: len(b)] = b
        low, high = _as_numbers(words, starts, size)
        long = np.flatnonzero(size > SHORT)
        h = self._hashed(b, starts, size, low, high, long)
        number = self._found(h)
        miss = np.flatnonzero(number == 0)
        new, where, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
        if len(new):
            at = miss[where]
            raw = _gathered(b, starts[at], size[at])
            number[miss] = self.known + inverse
            self._add(new, *self._tokenized(raw, size[at]), raw, size[at])
        raw_start = self.raw_ends[number - 1]
        # the bytes of each piece against those in the table: a hash that two pieces share is found here
        same = size == self.raw_ends[number] - raw_start
        held_low, held_high = _as_numbers(self.raw.view("<u8"), raw_start, size)
        same &= (low == held_low) & (high == held_high)
        long = long[same[long]]
        if len(long):
            ends = np.cumsum(size[long])
            same[long] = np.logical_and.reduceat(_gathered(b, starts[long], size[long]) == _gathered(self.raw, raw_start[long].astype(np.int64), size[long]), ends - size[long])
        text = np.searchsorted(begins, starts[~same], side="right") - 1
        own = np.insert(number, first := np.searchsorted(starts, np.append(begins[1:], len(b))), 0)
        start = self.ends[own - 1] * (own > 0)
        length = self.ends[own] - start
        sizes = np.cumsum(length, dtype=np.int64)
        return _gathered(self.ids, start, length), sizes[first + np.arange(len(first))], np.unique(text)

    def _add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray, raw: np.ndarray, raw_sizes: np.ndarray) -> None:
        """Writes pieces behind the known ones; as many as there is room for become known."""
        lo, hi = self.known, self.known + len(hashes)

        def put(name: str, values: np.ndarray, at: int) -> None:
            held = getattr(self, name)
            if at + len(values) + SHORT + 8 > len(held):  # `raw` is read in numbers, beyond its end
                held = np.concatenate([held, np.zeros(-(-(at + len(values)) // 8) * 8 + 64, held.dtype)])
                setattr(self, name, held)
            held[at : at + len(values)] = values

        put("hash", hashes, lo)
        id_end, raw_end = int(self.ends[lo - 1]), int(self.raw_ends[lo - 1])
        put("ids", ids, id_end)
        put("ends", id_end + np.cumsum(sizes), lo)
        put("raw", raw, raw_end)
        put("raw_ends", raw_end + np.cumsum(raw_sizes), lo)
        self.known = max(lo, min(hi, self.kept))
        number = np.arange(lo, self.known, dtype=np.int32)
        for mix in (np.uint64(1), _MIX_TOO):
            slot = (self.hash[number] * mix) >> self.shift
            free = self.table[slot] == 0
            self.table[slot[free]] = number[free]
            number = number[self.table[slot] != number]

    def _begins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """offsets, and places within texts of over a block at which they can be cut."""
        more = []
        for k in np.flatnonzero(np.diff(offsets) > self.BLOCK):
            at = int(offsets[k])
            while offsets[k + 1] - at > self.BLOCK:
                look = data[at + self.BLOCK // 2 : min(int(offsets[k + 1]), at + self.BLOCK)]
                cut = np.flatnonzero((look[:-1] == 32) & (_CLASS[look[1:]] & 1).view(bool))
                at += self.BLOCK // 2 + int(cut[-1]) if len(cut) else self.BLOCK
                if len(cut):
                    more.append(at)
        return np.union1d(offsets, more).astype(np.int64) if more else offsets

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """ids of each text, with the end; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data and len(texts) else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        whole = set() if self.by_piece else set(range(len(texts)))
        for s in self.special:
            whole |= {k for k in np.flatnonzero(pc.match_substring(texts, s.decode()).to_numpy(zero_copy_only=False)).tolist()}
        parts: list[list[np.ndarray]] = [[] for _ in range(len(texts))]
        begins = offsets[:-1] if len(offsets) else offsets
        if len(data) > self.BLOCK:
            begins = self._begins(data, offsets)[:-1] if np.diff(offsets).max() > self.BLOCK else begins
        lo = 0
        while lo < len(begins) and self.by_piece:
            hi = max(lo + 1, int(np.searchsorted(begins, begins[lo] + self.BLOCK, side="left")))
            end = int(begins[hi]) if hi < len(begins) else len(data)
            ids, ends, odd = self._block(data[begins[lo] : end], begins[lo:hi] - begins[lo])
            # a place where a long text is cut begins no text
            text = np.arange(lo, hi) if len(begins) == len(texts) else np.searchsorted(offsets[:-1], begins[lo:hi], side="right") - 1
            whole |= set(text[odd].tolist())
            for k, x, y in zip(text.tolist(), np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
                parts[k].append(ids[x:y])
            lo = hi
        out = []
        for k, x in enumerate(parts):
            if k in whole:
                out.append(np.array([*self.whole(texts[k].as_py()), END_ID], dtype=self.dtype))
            else:
                out.append(x[0] if len(x) == 1 else np.concatenate([*[y[:-1] for y in x], [END_ID]]).astype(self.dtype))
        return out


@cache
def encoder(path: str, kept: int) -> Encoder:
    """One a worker process, so that what it has learned serves all its tasks."""
    return Encoder(path, kept)


# --- grammar


def _grouped(sym: np.ndarray, after: np.ndarray, ends: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that begin at ascending places: each as a number (left << 32 | right), how many places it has, and the places, ascending for each.

    Pairs with fewer places than `least` are left out, as are those that may not be: none begins with the end of a document.
    """
    bits, low = _bits(len(ends)), _bits(len(sym))
    pair, right = sym[at].astype(np.int64), sym[after[at]]
    if 2 * bits + low < 64:  # a number holds all three
        pair <<= bits
        pair |= right
        pair <<= low
        pair |= at
        pair.sort()
        at = pair & (1 << low) - 1
        pair >>= low
    else:
        bits = 32
        pair = pair << bits | right
        order = np.argsort(pair, kind="stable")
        pair, at = pair[order], at[order]
    edge = np.flatnonzero(pair[1:] != pair[:-1]) + 1
    edge = np.concatenate([np.zeros(min(1, len(pair)), np.int64), edge])
    size = np.diff(edge, append=len(pair))
    pair = pair[edge]
    keep = (size >= least) & ~ends[pair >> bits]
    at = at[np.repeat(keep, size)]
    pair = pair[keep]
    return (pair >> bits) << 32 | pair & (1 << bits) - 1, size[keep], at


def _every_other(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Mask of the places of some pairs, ascending for each: every other one of each stretch of overlaps, from its left end."""
    out = np.ones(len(at), bool)
    joined = np.flatnonzero(after[at[:-1]] == at[1:]) + 1
    n = np.arange(len(joined))
    out[joined[(n - np.maximum.accumulate(np.where(np.diff(joined, prepend=-1) != 1, n, 0))) % 2 == 0]] = False
    return out


_LATE = 2**31 - 1


def _apart(codes: np.ndarray, first: np.ndarray, room: int) -> np.ndarray:
    """Of codes in order of choice, the numbers of those that can be replaced at once: no symbol is left of one and right of another.

    A symbol goes to the side on which it comes first, so the first code always stays. `first` (2, symbols) holds large
    numbers, before and after.
    """
    a, b, k = codes >> 32, codes & 0xFFFFFFFF, np.arange(len(codes), dtype=first.dtype)
    first[0, a[::-1]], first[1, b[::-1]] = k[::-1], k[::-1]
    ok = (first[0, a] < first[1, a]) & (first[1, b] < first[0, b]) | (a == b) & (first[0, a] == k) & (first[1, a] == k)
    first[0, a], first[1, b] = _LATE, _LATE
    return np.flatnonzero(ok)[:room]


def _bits(n: int) -> int:
    """Bits of a symbol when there are n."""
    return max(1, (n - 1).bit_length())


def _worth(n: int) -> int:
    """Least count at which a rule saves bits when there are n symbols: it takes two and a length of 32 bits, and saves one in each place."""
    return 2 + 32 // _bits(n) + 1


def compress(ids: np.ndarray, base: int, how: Shards = Shards()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules (n, 2), expansion lengths (n,), symbols)."""
    n, end = base, len(ids)
    ends = np.zeros(base + end + 1, bool)
    ends[END_ID] = True
    # a symbol keeps the place of its first id; the places after and before it are those of its neighbours. One more symbol,
    # that is found nowhere else, stands behind the last and before the first
    sym, after, before = np.append(ids, len(ends) - 1).astype(np.int32), np.arange(1, end + 2, dtype=np.int32), np.arange(-1, end, dtype=np.int32)
    alive, touched = np.ones(end + 1, bool), np.zeros(end + 1, bool)
    alive[end] = False
    first = np.full((2, len(ends)), _LATE, np.int32)
    rules: list[np.ndarray] = []
    floor = how.min_count or _worth(base + end)  # more symbols than these there cannot be
    code, size, at = _grouped(sym, after, ends, np.arange(end), floor)
    while len(code):
        start = np.cumsum(size) - size
        twin, many = code >> 32 == code & 0xFFFFFFFF, size
        if twin.any():  # pairs of a symbol with itself overlap in runs
            own = np.flatnonzero(twin)
            many = size.copy()
            many[own] = np.add.reduceat(_every_other(_gathered(at, start[own], size[own]), after), np.cumsum(size[own]) - size[own], dtype=np.int64)
        often = np.flatnonzero(many >= (how.min_count or _worth(n + 1)))
        if not len(often):
            break
        often = often[np.lexsort((code[often], -many[often]))][: 4 * how.pairs_a_round]
        chosen = often[_apart(code[often], first, how.pairs_a_round)]
        chosen = chosen[np.argsort(code[chosen])]
        a, b = code[chosen] >> 32, code[chosen] & 0xFFFFFFFF
        hit = _gathered(at, start[chosen], size[chosen]) << 32 | np.repeat(np.arange(n, n + len(chosen)), size[chosen])
        hit.sort()  # by place
        hit, which = hit >> 32, hit & 0xFFFFFFFF
        if twin[chosen].any():
            real = _every_other(hit, after)
            hit, which = hit[real], which[real]
        # pairs that go or change begin at the hits, at their right halves and before them
        half = after[hit].astype(np.int64)
        beyond = after[half]
        touched[hit] = touched[half] = touched[before[hit]] = True
        sym[hit], after[hit], before[beyond], alive[half] = which, beyond, hit, False
        rules.append(np.stack([a, b], axis=1))
        ends[n : n + len(a)] = ends[b]
        n += len(a)
        left = ~touched[at]
        now = np.add.reduceat(left, start, dtype=np.int64)
        keep = now >= floor
        left &= np.repeat(keep, size)
        # pairs that come have a new symbol, so all their places are here
        more = _grouped(sym, after, ends, np.flatnonzero(touched & alive), floor)
        code, size, at = (np.concatenate(x) for x in zip((code[keep], now[keep], at[left]), more, strict=True))
        touched[:] = False
    out = np.concatenate(rules).astype(np.uint32) if rules else np.zeros((0, 2), np.uint32)
    return out, _lengths(rules, base), sym[alive].view(np.uint32)


def _lengths(rounds: list[np.ndarray], base: int) -> np.ndarray:
    """How many ids each nonterminal stands for."""
    length = np.ones(base, np.int64)
    for r in rounds:
        length = np.concatenate([length, length[r[:, 0]] + length[r[:, 1]]])
    return length[base:].astype(np.uint32)


def _sizes(symbols: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    big = symbols >= base
    out[big] = lengths[symbols[big] - base]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """All ids of symbols: each round splits the nonterminals left, whose places follow from the expansion lengths."""
    own = symbols.astype(np.uint32)
    at = np.cumsum(sizes := _sizes(own, lengths, base)) - sizes
    out = np.empty(int(sizes.sum()), np.uint32)
    while len(own):
        plain = own < base
        out[at[plain]] = own[plain]
        pair, at = rules[own[~plain] - base], at[~plain]
        first = pair[:, 0]
        own, at = np.concatenate([first, pair[:, 1]]), np.concatenate([at, at + _sizes(first, lengths, base)])
    return out


def expand_all(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The same for many symbols: every rule is expanded once, and the symbols take what theirs stand for."""
    size = np.concatenate([np.ones(base, np.int64), lengths.astype(np.int64)])
    start = np.cumsum(size) - size
    flat = np.concatenate([np.arange(base, dtype=np.uint32), expand(np.arange(base, base + len(rules)), rules, lengths, base)])
    return _gathered(flat, start[symbols], size[symbols])


def id_at(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int, n: int) -> int:
    """The n-th id: walks by expansion lengths, then down one branch of the grammar."""
    ends = np.cumsum(sizes := _sizes(symbols, lengths, base))
    k = int(np.searchsorted(ends, n, side="right"))
    n -= int(ends[k] - sizes[k])
    s = int(symbols[k])
    while s >= base:
        first, second = (int(x) for x in rules[s - base])
        size = int(lengths[first - base]) if first >= base else 1
        s, n = (first, n) if n < size else (second, n - size)
    return s


def _packed(values: np.ndarray, bits: int) -> bytes:
    """values in so many bits each, lowest first; 8 values begin at a whole byte."""
    out = []
    for lo in range(0, len(values), 2**16):
        raw = np.ascontiguousarray(values[lo : lo + 2**16], "<u4").view(np.uint8).reshape(-1, 4)
        out.append(np.packbits(np.unpackbits(raw, axis=1, count=bits, bitorder="little"), bitorder="little").tobytes())
    return b"".join(out)


def _unpacked(data: np.ndarray, first: int, n: int, bits: int) -> np.ndarray:
    """n values from the first-th on."""
    out = []
    for lo in range(first, first + n, 2**16):
        k = min(2**16, first + n - lo)
        at, skip = divmod(lo * bits, 8)
        raw = np.unpackbits(data[at : (lo + k) * bits // 8 + 1], bitorder="little")[skip : skip + k * bits].reshape(k, bits)
        wide = np.zeros((k, 32), np.uint8)
        wide[:, :bits] = raw
        out.append(np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel())
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def pack(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, base: int, how: Shards = Shards()) -> bytes:
    rules, lengths, seq = compress(ids, base, how)
    symbol_ends = np.searchsorted(np.cumsum(_sizes(seq, lengths, base)), ends) + 1
    bits = _bits(base + len(rules))
    head = MAGIC + struct.pack("<5Q", len(doc_ids), len(rules), len(seq), base, bits)
    known = [-(2**63) if i is None else i for i in doc_ids]
    return b"".join([head, np.array(known, "<i8").tobytes(), symbol_ends.astype("<u8").tobytes(), ends.astype("<u8").tobytes(), lengths.astype("<u4").tobytes(), _packed(rules.ravel(), bits), _packed(seq, bits)])


class Shard:
    """A shard read back: documents() for all, document(k) for one, without expanding the others."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard")
        n_docs, n_rules, self.n_symbols, self.base, self.bits = struct.unpack_from("<5Q", data, 4)
        at = 44

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids = take("<i8", n_docs)
        self.symbol_ends, self.ends = take("<u8", n_docs).astype(np.int64), take("<u8", n_docs).astype(np.int64)
        self.lengths = take("<u4", n_rules)
        self.rules = _unpacked(take("u1", -(-2 * n_rules * self.bits // 8)), 0, 2 * n_rules, self.bits).reshape(-1, 2)
        self.data = take("u1", -(-self.n_symbols * self.bits // 8))

    def symbols(self, lo: int, hi: int) -> np.ndarray:
        return _unpacked(self.data, lo, hi - lo, self.bits)

    def documents(self) -> Iterator[np.ndarray]:
        ids = expand_all(self.symbols(0, self.n_symbols), self.rules, self.lengths, self.base)
        for lo, hi in zip(np.r_[0, self.ends[:-1]].tolist(), self.ends.tolist(), strict=True):
            yield ids[lo:hi]

    def document(self, k: int) -> np.ndarray:
        lo = int(self.symbol_ends[k - 1]) if k else 0
        return expand(self.symbols(lo, int(self.symbol_ends[k])), self.rules, self.lengths, self.base)

    def id(self, n: int) -> int:
        """The n-th id: finds its document by the ends, then steps by expansion lengths."""
        k = int(np.searchsorted(self.ends, n, side="right"))
        lo = int(self.symbol_ends[k - 1]) if k else 0
        return id_at(self.symbols(lo, int(self.symbol_ends[k])), self.rules, self.lengths, self.base, n - (int(self.ends[k - 1]) if k else 0))


# --- tables


def _write(how: Shards):
    path = tokenizer_path(how.tokenizer)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, how.kept_pieces)
        part, shard = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def made() -> pa.RecordBatch:
            ids = np.concatenate(held)
            data = pack(docs, np.cumsum([len(x) for x in held]), ids, own.base, how)
            return pa.record_batch([pa.array([part], pa.int64()), pa.array([shard], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary())], names=["part", "shard", "n_ids", "data"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                for doc, own_ids in zip(some.column("doc_id").to_pylist(), own.encode(some.column("text")), strict=True):
                    docs.append(doc)
                    held.append(own_ids)
                    size += len(own_ids)
                    if size >= how.shard_ids:
                        yield made()
                        docs, held, size, shard = [], [], 0, shard + 1
        if docs:
            yield made()

    return write


def write_shards(docs: DataFrame, path: str, how: Shards = Shards()) -> None:
    """Writes the shards of docs (doc_id, text) as a Parquet table at path."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("tie"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    dealt.mapInArrow(_write(how), "part long, shard long, n_ids long, data binary").write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, shard, data in zip(batch.column("part").to_pylist(), batch.column("shard").to_pylist(), batch.column("data").to_pylist(), strict=True):
            got = Shard(data)
            crc = [zlib.crc32(np.ascontiguousarray(ids, "<u4")) for ids in got.documents()]
            sizes = np.diff(np.r_[0, got.ends])
            n = len(crc)
            doc = pa.array(got.doc_ids, mask=got.doc_ids == -(2**63))
            yield pa.record_batch([pa.array([part] * n, pa.int64()), pa.array([shard] * n, pa.int64()), doc, pa.array(got.ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())], names=["part", "shard", "doc_id", "local", "n_tokens", "ids_crc32"])


def read_index(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), read from the shards: start counts the ids of all documents before."""
    docs = shards.select("part", "shard", "data").mapInArrow(_read, "part long, shard long, doc_id long, local long, n_tokens long, ids_crc32 long")
    size = shards.select("part", "shard", "n_ids")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = size.groupBy("part").agg(F.sum("n_ids").alias("n")).select(F.col("part").alias("p"), before(Window.orderBy("part")).alias("p_start"))
    shard = size.select(F.col("part").alias("q"), F.col("shard").alias("s"), F.col("n_ids").alias("n")).withColumn("s_start", before(Window.partitionBy("q").orderBy("s")))
    starts = shard.join(part, F.col("q") == F.col("p")).select("q", "s", (F.col("p_start") + F.col("s_start")).alias("first"))
    joined = docs.join(starts, (F.col("part") == F.col("q")) & (F.col("shard") == F.col("s")))
    return joined.select("doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_index(docs: DataFrame, path: str, how: Shards = Shards()) -> DataFrame:
    """Writes the shards of docs at path, reads them back and returns their index."""
    write_shards(docs, path, how)
    return read_index(docs.sparkSession.read.parquet(path))
