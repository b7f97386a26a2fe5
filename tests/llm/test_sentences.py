"""op6: against a direct scan in document order."""

import random
import zlib

from casita.llm.queries import op6_sentence_spans
from casita.llm.sentence_spans import Spans, remove_repeats, sentences, word_spans


#: Short runs, so that small texts have some.
SHORT = Spans(min_words=15)


def plain_sentences(text):
    """Places between sentences found character by character; long ones cut after words whose checksum ends in four zero bits."""
    ends, n = [], len(text)
    for i in range(n):
        if text[i] == "\n" or (text[i].isspace() and i and text[i - 1] in ".!?"):
            j = i + 1
            while j < n and text[j].isspace():
                j += 1
            ends.append(j)
    out, at = [], 0
    for end in [*sorted(set(ends)), n]:
        words = text[at:end].split()
        if len(words) > 40:
            start, k, held = at, at, []
            for w in words:
                k = text.index(w, k) + len(w)
                held.append(w)
                if zlib.crc32(w.encode()) % 16 == 0:
                    while k < end and text[k].isspace():
                        k += 1
                    out.append((start, k, held))
                    start, held = k, []
            if held:
                out.append((start, end, held))
        elif words:
            out.append((at, end, words))
        elif out:
            out[-1] = (out[-1][0], end, out[-1][2])
        at = max(at, end)
    return out


def brute(rows, how=Spans()):
    """Every run of consecutive sentences that counts, in document order: what was seen before goes. Runs of up to
    min_words + 1 sentences do: a longer one is made of such, as every sentence has a word."""
    first, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        cut = plain_sentences(text or "")
        drop, own = set(), set()
        whole = sum(len(c[2]) for c in cut) < how.min_words
        for i in range(len(cut)):
            for j in range(i + how.sentences, min(len(cut), i + how.min_words + 1) + 1):
                if sum(len(c[2]) for c in cut[i:j]) >= how.min_words or (whole and (i, j) == (0, len(cut))):
                    key = " ".join(w for c in cut[i:j] for w in c[2])
                    if first.get(key, doc) != doc or key in own:
                        drop |= set(range(i, j))
                    own.add(key)
        for key in own:
            first.setdefault(key, doc)
        kept = None if text is None else (text[: cut[0][0]] if cut else text) + "".join(text[c[0] : c[1]] for k, c in enumerate(cut) if k not in drop)
        out[doc] = (len(cut), len(drop), kept)
    return out


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_sentences, r.n_removed, r.kept_text) for r in op6_sentence_spans(spark, sf_dir).collect()}
    want = brute(rows)
    assert got == want
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    short = {r.doc.doc_id: (r.n_sentences, r.n_removed, r.kept_text) for r in remove_repeats(docs, SHORT).collect()}
    assert short == brute(rows, SHORT)
    assert sum(x[1] for x in want.values()) > 20


def test_planted_passages_go_and_the_rest_stays(make):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    sentence = lambda n: (" ".join(word() for _ in range(n)) + ".").capitalize()
    passage = " ".join(sentence(rng.randrange(6, 20)) for _ in range(6))
    endless = " ".join(word() for _ in range(300))
    texts = []
    for k in range(30):
        own = [" ".join(sentence(9) for _ in range(4)) for _ in range(3)]
        texts.append(f"{own[0]} {passage if k % 3 == 0 else ''} {own[1]} {endless if k % 5 == 0 else ''}\n{own[2]}")
    got = {r.doc.doc_id: r for r in remove_repeats(make(texts), SHORT).collect()}
    for k, t in enumerate(texts):
        left = got[k].kept_text
        assert (passage in left) == (k == 0 or False) or k % 3, k
        if k % 5 == 0 and k:
            assert sum(w in left for w in endless.split()) < 120
        if k % 3 and k % 5:
            assert left == t and got[k].n_removed == 0


def test_spans_cover_the_text():
    for text in ["", "a. b! c\n\nd", "  lead. x", "word " * 500, "x.\n", "é? \U0001f600 yes."]:
        cut = sentences(text)
        assert all(a[1] == b[0] for a, b in zip(cut, cut[1:]))
        assert not cut or cut[-1][1] == len(text)


def test_odd_inputs(make):
    same = "This sentence has some eight words in it. And this one that follows has just as many."
    texts = [None, "", "short. one.", same, same, "x " * 60_000, None]
    docs = make([*texts, *[(3, same, "en", "s")]], ("seen", "doc", "h1", "kept_text", "id"))
    got = remove_repeats(docs, SHORT).collect()
    assert sorted((r.doc.doc_id, r.kept_text) for r in got if r.doc.doc_id in (3, 4)) == [(3, same), (3, same), (4, "")]
    assert [r.kept_text for r in got if r.doc.doc_id == 0] == [None]
    assert remove_repeats(make([])).count() == 0


def test_copies_and_short_endings_go_completely(make):
    rng = random.Random(5)
    sentence = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)) + "."
    many = lambda *sizes: " ".join(sentence(n) for n in sizes)
    shapes = [(20, 5, 5), (3, 3, 20, 2, 2), (9, 9, 9), (16, 1), (1, 16), (5, 5), (2, 30, 1, 1, 1), *[tuple(rng.randrange(1, 25) for _ in range(rng.randrange(2, 9))) for _ in range(20)]]
    whole = [many(*s) for s in shapes]
    passage = many(20, 5, 5)
    hosts = [f"{many(9, 8)} {passage} {many(7, 12)}" for _ in range(4)]
    texts = whole + hosts + whole
    got = {r.doc.doc_id: r for r in remove_repeats(make(texts), SHORT).collect()}
    for k, text in enumerate(texts[: len(whole) + 1]):
        assert got[k].kept_text == text, k
    for k in range(len(whole) + 1, len(whole) + 4):
        assert got[k].kept_text == texts[k].replace(passage + " ", ""), k
    for k in range(len(whole) + 4, len(texts)):
        assert got[k].kept_text == "" and got[k].n_removed == got[k].n_sentences, k


def test_rows_without_an_id_come_last(make):
    """Copies among rows with and without an id: the first one with an id stays."""
    same = "This sentence has some eight words in it. And this one that follows has just as many."
    rows = [(None, same, "en", "s"), (5, same, "en", "s"), (7, same, "en", "s"), (None, same + " More here.", "en", "s")]
    got = sorted(((r.doc.doc_id, r.kept_text) for r in remove_repeats(make(rows), SHORT).collect()), key=str)
    assert got == sorted([(None, ""), (5, same), (7, ""), (None, "More here.")], key=str)


def test_shifted_copies_of_an_endless_sentence(make):
    """Places to cut depend on the words alone, so a copy that starts elsewhere is cut alike."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(900)]
    texts = [" ".join(words), " ".join(["other", "words", "before"] + words[37:])]
    got = {r.doc.doc_id: r for r in remove_repeats(make(texts), SHORT).collect()}
    assert got[0].kept_text == texts[0] and sum(w in words for w in got[1].kept_text.split()) < 60


def earlier(rows, k):
    """By document: the places of words that start k words in a row which an earlier document has."""
    first, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words = (text or "").split()
        keys = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
        out[doc] = {i for i, key in enumerate(keys) if key in first}
        for key in keys:
            first.setdefault(key, doc)
    return out


def hold_passages(rows, got, how=Spans()):
    """All words of repeats but a few at their ends are in passages, and all words of passages are in repeats."""
    texts, gap = dict(rows), how.passage - how.min_words
    must, may = earlier(rows, how.passage), earlier(rows, how.min_words)
    for doc, r in got.items():
        text = texts[doc] or ""
        inside = {i for s in r.passages for i in range(len(text[: s.start].split()), len(text[: s.end].split()))}
        assert len(inside) == r.n_passage_words
        assert inside <= {j for i in may[doc] for j in range(i, i + how.min_words)}, doc
        assert inside >= {j for i in must[doc] for j in range(i + gap, i + how.min_words)}, doc
        lost = {i for s in [*r.passages, *r.removed] for i in range(s.start, s.end)}
        assert (r.rest_text or "") == "".join(c for i, c in enumerate(text) if i not in lost)
        assert r.passages or r.rest_text == r.kept_text
    return sum(bool(x) for x in must.values())


def test_repeats_of_over_50_words_are_passages(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op6_sentence_spans(spark, sf_dir).collect()}
    assert hold_passages(rows, got) >= 20
    assert sum(not r.n_removed and r.n_passage_words > 0 for r in got.values()) >= 2


def test_passages_that_begin_and_end_inside_sentences(make):
    rng = random.Random(8)
    words = lambda n: [rng.choice("abcdefghijklmnop") + str(rng.randrange(10**6)) for _ in range(n)]
    texts = []
    for k in range(40):
        passage = words(51 + 3 * k)
        for i in range(9, len(passage), rng.choice((9, 30, 10**6))):
            passage[i] += rng.choice((".", "!", "\u00e9.", "\U0001f600?"))
        for _ in range(2):
            texts.append(" ".join([*words(rng.randrange(60)), *passage]) + rng.choice((" ", "\n", "\t ")) + " ".join(words(rng.randrange(1, 60))))
    over = len(texts)
    texts += ["and " * 200, "x and " + "and " * 90 + "y", " ".join(words(300)), "", None]
    got = {r.doc.doc_id: r for r in remove_repeats(make(texts)).collect()}
    hold_passages(list(enumerate(texts)), got)
    assert [k for k in range(over) if got[k].n_passage_words] == list(range(1, over, 2))
    assert any(not got[k].n_removed for k in range(1, over, 2))
    assert got[over + 1].n_passage_words == 91 and got[over + 1].rest_text == "x y"
    assert [got[over + k].n_passage_words for k in (0, 2, 3, 4)] == [0, 0, 0, 0] and got[over + 4].rest_text is None


def test_chosen_spans_follow_from_the_words():
    rng = random.Random(9)
    how = Spans(min_words=5, passage=12)
    words = [rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(400)]
    chosen = dict(word_spans(words, how))
    assert all(any(i in chosen for i in range(k, k + 8)) for k in range(len(words) - 11))
    assert {i - 3: h for i, h in word_spans(["x", "y", "z", *words], how) if i >= 10}.items() <= chosen.items()
    assert word_spans(words[:11], how) == [] and len(word_spans(words[:12], how)) >= 1
    assert {i for i, _ in word_spans(words, Spans(min_words=5, passage=5))} == set(range(396))
