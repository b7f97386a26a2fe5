r"""Personal data: fixed patterns, and a semi-Markov conditional random field over candidate stretches.

Four patterns give the base spans (email, ip, card, phone). Beyond them, stretches of text around digits, "@" and written-out
"at" and "dot" are cut into tokens, and a semi-Markov CRF labels them: a segment is a span of up to `max_tokens` tokens
with one of the four types, or a single outside token; whole-span features (digit count, checksum, octets, separators,
shape of the ends, cue words before it) score a segment, and dynamic programming over segments chooses boundaries and types
together. Entities it finds that touch no base span are added.

The weights are trained here, by gradient ascent on the conditional likelihood (forward-backward over segments) on
`n_train` = 250 generated stretches from a fixed seed: a bounded, documented sample that does not depend on the corpus.

Scale: a narrow map over the texts, no shuffle; the weights are a broadcast of fixed size. Every pattern is searched from
places that can start a match, so long runs cost linear time. A stretch is labelled as a whole, whatever its length; every
`settle` tokens the paths that are still open are followed back to the place where they meet, and what lies before it is
settled. A worker holds the tokens of one stretch at a time.

Defined results: a null text is empty; base_sha256 is then the digest of the empty string; repeated rows are each
searched; an empty table gives an empty table. Only doc_id and text are read, so extra columns may have any name. Offsets
are code points, end exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# --- base patterns

# The base patterns, cut where a search starts at an anchor.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is only tried from its start: from inside it, what follows would be the same
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _phones(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("+")
    while at >= 0:
        end = at
        if m := _PHONE.match(text, at):
            end = m.end()
            while end > at and not "0" <= text[end - 1] <= "9":
                end -= 1
        # the pattern takes a digit, at least one more character and a digit
        if end - at >= 4:
            yield at, end
            at = text.find("+", end)
        else:
            at = text.find("+", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
    if "+" in text:
        for a, b in _phones(text):
            if 9 <= sum("0" <= c <= "9" for c in text[a:b]) <= 15:
                out.append((3, a, b))
    return out


# --- segments and features

_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]", re.ASCII)
#: Where a stretch may lie: digits, or "at" and "dot" written out.
_SPARK = re.compile(r"[0-9]+|@|[\[({<]\s?(?:at|dot)\s?[\])}>]|\b(?:at|AT)\s+\w[\w.-]*\s+(?:dot|DOT)\b")
_NEAR = 24
_CUES = {
    "email": ("email", "mail", "e", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "mastercard", "credit", "cc", "tarjeta", "karte", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "telefono", "tfno", "whatsapp"),
}
_ALL = ("O", *KINDS)


@dataclass(frozen=True)
class Crf:
    #: A name of three parts, marked at, a host of four parts with marked dots and some hyphens take 26.
    max_tokens: int = 28
    settle: int = 256
    n_train: int = 250
    epochs: int = 30
    rate: float = 0.5
    l2: float = 0.002
    seed: int = 7


Token = tuple[str, int, int]


def tokens(text: str, start: int, end: int) -> list[Token]:
    return [(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]


def can_be(seq: list[Token], i: int, j: int) -> bool:
    """Whether tokens i to j may be an entity at all: a cheap bound on the segments that are scored."""
    first, last = seq[i][0], seq[j - 1][0]
    if not (last[-1].isalnum() and (first[0].isalnum() or first in "+(")):
        return False
    return any(seq[k + 1][1] - seq[k][2] <= 2 for k in range(i, j - 1)) if j - i > 1 else first.isdigit() and len(first) >= 7


_AT = frozenset(("@", "at", "AT"))
_DOT = frozenset((".", "dot", "DOT"))


def features(seq: list[Token], i: int, j: int, text: str) -> list[str]:
    """Whole-span features of tokens i to j (their names; each counts 1)."""
    words = [t[0] for t in seq[i:j]]
    raw = text[seq[i][1] : seq[j - 1][2]]
    digits = "".join(w for w in words if w.isdigit())
    alpha = [w for w in words if w.isalpha()]
    marks = {w for w in words if not w.isalnum()}
    out = [f"digits:{min(len(digits), 20)}", f"letters:{min(sum(map(len, alpha)), 3)}", f"first:{_shape(words[0])}", f"last:{_shape(words[-1])}"]
    groups = [len(w) for w in words if w.isdigit()]
    out.append(f"groups:{min(len(groups), 6)}")
    if not alpha:
        if 13 <= len(digits) <= 19:
            out.append("luhn" if luhn(digits) else "no-luhn")
            if len(groups) == 4 and set(groups) == {4}:
                out.append("4x4")
        if len(groups) == 4 and all(int(w) <= 255 for w in words if w.isdigit() and len(w) < 4) and max(groups) <= 3:
            out.append("octets")
            if words.count(".") == 3:
                out.append("octet-dots")
        if 9 <= len(digits) <= 15:
            out.append("phone-length")
        if 1 < len(groups) <= 6 and groups[-1] == 4 and len(digits) in (10, 11):
            out.append("phone-tail")
    at = [k for k, w in enumerate(words) if w in _AT]
    dot = [k for k, w in enumerate(words) if w in _DOT]
    if len(at) == 1 and dot and 0 < at[0] < dot[-1] < len(words) - 1:
        out.append("at-dot")
        out.append("at-dot-marked" if "@" in words or marks & {"[", "(", "{", "<"} else "at-dot-plain")
        if dot[-1] - at[0] > 1 and words[-1].isalpha() and 2 <= len(words[-1]) <= 6:
            out.append("host-end")
        if seq[i + at[0]][1] - seq[i][1] <= 30:
            out.append("short-local")
    out += [f"mark:{m}" for m in sorted(marks)]
    gaps = max((seq[k + 1][1] - seq[k][2] for k in range(i, j - 1)), default=0)
    out.append(f"gap:{min(gaps, 3)}")
    if "\n" in raw:
        out.append("line-break")
    before = [seq[k][0].lower() for k in range(max(0, i - 4), i)]
    out += [f"cue:{kind}" for kind, cues in _CUES.items() if any(b in cues for b in before)]
    if i and seq[i][1] == seq[i - 1][2]:
        out.append(f"glued:{_shape(seq[i - 1][0])}")
    if j < len(seq) and seq[j][1] == seq[j - 1][2]:
        out.append(f"glue-on:{_shape(seq[j][0])}")
    return out


def _shape(word: str) -> str:
    return f"d{min(len(word), 5)}" if word.isdigit() else "a" if word.isalpha() else word


class Model:
    """Weights by (label, feature) and (label, label)."""

    def __init__(self) -> None:
        self.w: dict[tuple[str, str], float] = {}

    def score(self, label: str, names: list[str]) -> float:
        w = self.w
        return w.get((label, "bias"), 0.0) + sum(w.get((label, f), 0.0) for f in names)


def segments(seq: list[Token], text: str, how: Crf) -> dict[int, list[tuple[int, list[str]]]]:
    """By end: (start, features) of the segments that may be entities."""
    out: dict[int, list[tuple[int, list[str]]]] = {}
    for j in range(1, len(seq) + 1):
        out[j] = [(i, features(seq, i, j, text)) for i in range(max(0, j - how.max_tokens), j) if can_be(seq, i, j)]
    return out


_OUTSIDE = "O"


def _outside(seq: list[Token], k: int) -> list[str]:
    return [f"tok:{_shape(seq[k][0])}"]


def decode(seq: list[Token], text: str, model: Model, how: Crf) -> list[tuple[str, int, int]]:
    """The best segmentation: (kind, first token, end token) of its entities. An entity may not follow another directly."""
    n = len(seq)
    best = [[0.0, -math.inf]]  # state 0: after an outside token, 1: after an entity
    back: dict[tuple[int, int], tuple[int, int, str]] = {}
    out: list[tuple[str, int, int]] = []
    settled = (0, 0)

    def settle(at: tuple[int, int]) -> None:
        """What leads to a state that every open path passes is decided."""
        nonlocal settled
        path, end = [], at
        while at != settled:
            i, s, label = back[at]
            if label != _OUTSIDE:
                path.append((label, i, at[0]))
            at = (i, s)
        settled = end
        out.extend(reversed(path))
        for key in [k for k in back if k[0] <= end[0]]:
            del back[key]

    for j in range(1, n + 1):
        s = 0 if best[j - 1][0] >= best[j - 1][1] else 1
        back[j, 0] = (j - 1, s, _OUTSIDE)
        state = [best[j - 1][s] + model.score(_OUTSIDE, _outside(seq, j - 1)), -math.inf]
        for i in range(max(0, j - how.max_tokens), j):
            if can_be(seq, i, j):
                names = features(seq, i, j, text)
                for label in KINDS:
                    x = best[i][0] + model.score(label, names)
                    if x > state[1]:
                        state[1], back[j, 1] = x, (i, 0, label)
        best.append(state)
        if j % how.settle == 0:
            # later segments start at one of the last max_tokens places, all others follow (j, 0) or (j, 1)
            paths = {(i, 0) for i in range(max(settled[0], j - how.max_tokens), j + 1) if (i, 0) in back or (i, 0) == settled} | ({(j, 1)} & back.keys())
            while len(paths) > 1 and settled not in paths:
                late = max(paths)
                paths.remove(late)
                paths.add(back[late][:2])
            if len(paths) == 1:
                settle(paths.pop())
    settle((n, 0 if best[n][0] >= best[n][1] else 1))
    return out


# --- training


def _examples(how: Crf) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Generated stretches: (text, entities as (kind, start, end))."""
    rng = random.Random(how.seed)
    filler = ["the", "and", "of", "report", "in", "lorem", "see", "page", "was", "total", "at", "dot", "on", "section", "value", "for", "year", "sold"]
    name = lambda: rng.choice(["ana", "jo.smith", "info", "m_lee", "sales2", "k-ray", "office", "x9"])
    host = lambda: rng.choice(["example", "mail2", "acme-corp", "post", "site"])
    end = lambda: rng.choice(["com", "org", "net", "es", "info"])
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    octet = lambda: str(rng.randrange(256))

    def card(sep: str) -> str:
        body = rng.choice("3456") + num(14)
        digits = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        return sep.join(digits[k : k + 4] for k in range(0, 16, 4))

    def unchecked() -> str:
        digits = next(d for d in iter(lambda: num(rng.choice((13, 15, 16, 16, 16, 18))), "") if not luhn(d))
        return digits if rng.random() < 0.7 else " ".join(digits[k : k + 4] for k in range(0, len(digits), 4))

    def entity() -> tuple[str, str]:
        kind = rng.choice(KINDS)
        if kind == "email":
            left, right = rng.choice([("[", "]"), ("(", ")"), ("{", "}"), (" [", "] "), (" (", ") ")])
            at, dot = rng.choice([("@", "."), (f"{left}at{right}", f"{left}dot{right}"), (f"{left}at{right}", "."), (" at ", " dot "), (" @ ", " . "), ("@", f"{left}dot{right}")])
            more = [rng.choice(["dept", "ac", "edu", "web"]) for _ in range(rng.choice((0, 0, 0, 1, 1, 2)))]
            return kind, f"{name()}{at}{dot.join([host(), *more])}{dot}{end()}"
        if kind == "ip":
            return kind, rng.choice([".", " . ", "[.]", "(.)", "."]).join(octet() for _ in range(4))
        if kind == "card":
            return kind, card(rng.choice(["", " ", "-", ".", "  ", " - "]))
        a, b, c = num(3), num(3), num(4)
        return kind, rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"+1 ({a}) {b}-{c}", f"00{num(2)} {a} {num(3)} {b}", f"+{num(2)}-{a}-{b}{num(3)}", f"({a}){b}-{c}"])

    def decoy() -> str:
        return rng.choice([
            num(rng.randrange(1, 9)), f"{num(2)}.{num(2)}", f"{num(1)},{num(3)},{num(3)}", f"20{num(2)}-{num(2)}-{num(2)}", f"{num(2)}/{num(2)}/20{num(2)}", f"v{num(1)}.{num(1)}.{num(1)}",
            f"{num(2)}:{num(2)}", f"{num(16)}0000", unchecked(), unchecked(), unchecked(), f"${num(3)}.{num(2)}", f"look at me dot", f"3.{num(6)}", f"({num(4)})", f"{num(3)}-{num(3)}", f"{num(1)}.{num(1)}.{num(1)}.{num(4)}", f"{num(2)}, {num(2)}, {num(2)}, {num(2)}", f"[{num(2)}]", f"{num(4)} {num(4)}",
        ])

    out = []
    for _ in range(how.n_train):
        text, own = "", []
        for _ in range(rng.randrange(1, 4)):
            text += "".join(rng.choice(filler) + " " for _ in range(rng.randrange(0, 5)))
            if rng.random() < 0.6:
                kind, s = entity()
                if rng.random() < 0.3:
                    text += rng.choice(_CUES[kind]) + rng.choice([": ", " "])
                own.append((kind, len(text), len(text) + len(s)))
            else:
                s = decoy()
            text += s + rng.choice([" ", ". ", ", ", " and "])
        out.append((text + rng.choice(filler), own))
    return out


@cache
def train(how: Crf = Crf()) -> Model:
    """Maximum conditional likelihood by full-batch gradient steps with step sizes that adapt to each weight."""
    names: dict[tuple[str, str], int] = {}
    index = lambda label, fs: np.array([names.setdefault((label, f), len(names)) for f in ("bias", *fs)])
    data = []
    for text, own in _examples(how):
        seq = tokens(text, 0, len(text))
        starts, ends = {t[1]: k for k, t in enumerate(seq)}, {t[2]: k + 1 for k, t in enumerate(seq)}
        gold = {(starts[a], ends[b]): kind for kind, a, b in own if a in starts and b in ends}
        found = segments(seq, text, how)
        if any((i, j) not in {(a, e) for e in found for a, _ in found[e]} for i, j in gold):
            continue  # no labelling of this stretch has the entity
        ents = [(i, j, label, fs) for j in range(1, len(seq) + 1) for i, fs in found[j] for label in KINDS]
        inside = {k for i, j in gold for k in range(i, j)}
        rows = [index(_OUTSIDE, _outside(seq, k)) for k in range(len(seq))] + [index(label, fs) for _, _, label, fs in ents]
        right = [float(k not in inside) for k in range(len(seq))] + [float(gold.get((i, j)) == label) for i, j, label, _ in ents]
        size = np.array([len(r) for r in rows])
        data.append((np.concatenate(rows), np.r_[0, np.cumsum(size)[:-1]], size, len(seq), [(i, j) for i, j, _, _ in ents], np.array(right)))
    w = np.zeros(len(names))
    seen = np.full(len(names), 1e-6)
    for _ in range(how.epochs):
        grad = -how.l2 * w * len(data)
        for flat, offset, size, n, ents, right in data:
            wanted = right - _expected(np.add.reduceat(w[flat], offset).tolist(), n, ents)
            grad += np.bincount(flat, np.repeat(wanted, size), len(w))
        grad /= len(data)
        seen += grad * grad
        w += how.rate * grad / np.sqrt(seen)
    model = Model()
    model.w = {k: float(w[i]) for k, i in names.items() if w[i]}
    return model


def _sum_of(xs: list[float]) -> float:
    """log of the sum of exp."""
    top = max(xs, default=-math.inf)
    return top + math.log(sum(math.exp(x - top) for x in xs)) if top > -math.inf else top


def _expected(score: list[float], n: int, ents: list[tuple[int, int]]) -> np.ndarray:
    """Probability of each segment (n outside tokens, then ents): forward and backward sums over all segmentations."""
    by_end: list[list] = [[] for _ in range(n + 1)]
    by_start: list[list] = [[] for _ in range(n + 1)]
    for (i, j), s in zip(ents, score[n:], strict=True):
        by_end[j].append((i, s))
        by_start[i].append((j, s))
    a0, a1 = [0.0] + [-math.inf] * n, [-math.inf] * (n + 1)  # after an outside token, after an entity
    for j in range(1, n + 1):
        a0[j] = _sum_of([a0[j - 1], a1[j - 1]]) + score[j - 1]
        a1[j] = _sum_of([a0[i] + s for i, s in by_end[j]])
    z = _sum_of([a0[n], a1[n]])
    b0, b1 = [-math.inf] * n + [0.0], [-math.inf] * n + [0.0]
    for i in range(n - 1, -1, -1):
        b1[i] = score[i] + b0[i + 1]
        b0[i] = _sum_of([b1[i], *[s + b1[j] for j, s in by_start[i]]])
    outside = [math.exp(_sum_of([a0[k], a1[k]]) + score[k] + b0[k + 1] - z) for k in range(n)]
    return np.array(outside + [math.exp(a0[i] + s + b1[j] - z) for (i, j), s in zip(ents, score[n:], strict=True)])


# --- search


def stretches(text: str) -> list[tuple[int, int]]:
    """[start, end) around sparks, merged where they come close; both ends are moved out to white space."""
    out: list[tuple[int, int]] = []
    for m in _SPARK.finditer(text):
        done = out[-1][1] if out else 0
        a, b = max(0, m.start() - _NEAR), max(done, min(len(text), m.end() + _NEAR))
        while a > done and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and b > done and not text[b - 1].isspace() and not text[b].isspace():
            b += 1
        if out and a <= done:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def spans(text: str, model: Model, how: Crf = Crf()) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each (kind, start, end) by kind, then start."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken], list(itertools.accumulate((b for _, b in taken), max))
    more = set()
    for lo, hi in stretches(text):
        seq = tokens(text, lo, hi)
        if sum(len(t[0]) for t in seq if t[0].isdigit()) < 4 and not any(t[0] in _AT for t in seq):
            continue  # too few digits for any type, and no address
        for kind, i, j in decode(seq, text, model, how):
            a, b = seq[i][1], seq[j - 1][2]
            k = bisect.bisect_left(starts, b)  # base spans of different kinds may overlap; ends[k] is the last end of the first k
            if not k or ends[k - 1] <= a:
                more.add((KINDS.index(kind), a, b))
    return base, sorted({*base, *more})


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in found)


_OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_pii(docs: DataFrame, how: Crf = Crf()) -> DataFrame:
    """doc_id, counts of the base spans by kind, digest of the base spans, all spans as kind:start:end."""
    sent = docs.sparkSession.sparkContext.broadcast(train(how))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: list[list[int]] = [[], [], [], []]
            digest, joined = [], []
            for text in batch.column("text").to_pylist():
                base, found = spans(text or "", sent.value, how)
                for k in range(4):
                    n[k].append(sum(x[0] == k for x in base))
                digest.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(found))
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in n], pa.array(digest, pa.string()), pa.array(joined, pa.string())], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(search, _OUT)


def mask(docs: DataFrame, how: Crf = Crf()) -> DataFrame:
    """docs with each span of its text replaced by its kind in angle brackets; columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(train(how))

    def replace(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for k, a, b in sorted(spans(text, sent.value, how)[1], key=lambda s: (s[1], -s[2])):
            if a >= at:
                out += [text[at:a], f"<{KINDS[k]}>"]
                at = b
        return "".join(out) + text[at:]

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index("text")
            yield batch.set_column(k, "text", pa.array([replace(t) for t in batch.column(k).to_pylist()], pa.string()))

    return docs.mapInArrow(masked, docs.schema)
