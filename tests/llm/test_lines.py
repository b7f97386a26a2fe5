"""op8: against all pairs of lines, on small tables."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from casita.llm.line_dedup import Lines, drop_lines, line_words, variants, within_one_edit
from casita.llm.queries import op8_line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def brute(rows, how=Lines()):
    """Lines in order, rows without an id last; a line goes if an earlier one equals it or, both long enough, is within one edit."""
    earlier, out = [], {}
    by_words = {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        kept, n, gone = [], 0, 0
        for line in text.split("\n") if text else ():
            w = tuple(line_words(line))
            if not w:
                kept.append(line)
                continue
            n += 1
            near = w in by_words
            if not near and len(w) >= how.min_fuzzy_words:
                near = any(len(e) >= how.min_fuzzy_words and abs(len(e) - len(w)) < 2 and (e[0] == w[0] or e[-1] == w[-1]) and within_one_edit(list(e), list(w)) for e in earlier)
            if w not in by_words:
                by_words[w] = True
                earlier.append(w)
            gone += near
            if not near:
                kept.append(line)
        out[doc] = (n, gone, "\n".join(kept) if text else text)
    return out


def told(df):
    return {r.doc.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()}


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=6), st.lists(st.sampled_from("ab"), max_size=6))
def test_edit(a, b):
    assert within_one_edit(a, b) == (distance(a, b) <= 1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c"]), min_size=1, max_size=8))
def test_variants(words):
    _, less = variants(words)
    for i in range(len(words)):
        assert (variants(words[:i] + words[i + 1 :])[0] == less[:, i]).all()


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in op8_line_dedup(spark, sf_dir).collect()}
    assert got == brute(rows)


def test_families(make):
    rng = random.Random(8)
    texts = []
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(4, 15))] for _ in range(12)]
    for _ in range(60):
        lines = []
        for _ in range(3):
            w = list(rng.choice(base))
            for _ in range(rng.randrange(3)):
                k = rng.randrange(len(w))
                kind = rng.randrange(3)
                w[k : k + (kind < 2)] = [] if kind == 0 else [f"w{rng.randrange(40)}"]
            lines.append(" ".join(w))
        texts.append("\n".join(lines))
    assert told(drop_lines(make(texts))) == brute(list(enumerate(texts)))


def test_odd_inputs(make):
    long = "one two three four five six seven eight nine ten"
    texts = [None, "", "\n \n", "a\na\nb", "a b", long, long + " eleven", long.replace("five", "5"), "x " * 60_000, "x " * 60_001 + "\ny", None]
    got = told(drop_lines(make(texts, ("words", "line", "lost", "doc", "h1", "places"))))
    assert got == brute(list(enumerate(texts)))
    twice = [(1, long, "", ""), (1, long, "", ""), (2, long + " x", "", ""), (1, "other", "", "")]
    rows = sorted((r.doc.doc_id, r.kept_text) for r in drop_lines(make(twice)).collect())
    assert rows == [(1, long), (1, long), (1, "other"), (2, "")]
    assert drop_lines(make([])).count() == 0


def test_rows_without_an_id_come_last(make):
    """A null id shields no line of others, and is compared like them."""
    line, other = "one two three four five six seven eight nine ten", "a b c d e f"
    rows = [(None, f"{line}\n{other}", "", ""), (2, line, "", ""), (3, f"{line}\nmore", "", ""), (None, other, "", "")]
    got = sorted(((r.doc.doc_id, r.kept_text) for r in drop_lines(make(rows)).collect()), key=str)
    assert got == sorted([(None, other), (2, line), (3, "more"), (None, other)], key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.lists(st.sampled_from("abc"), min_size=3, max_size=13).map(" ".join), min_size=1, max_size=4).map("\n".join), min_size=2, max_size=40))
def test_short_lines(make, texts):
    assert told(drop_lines(make(texts))) == brute(list(enumerate(texts)))
