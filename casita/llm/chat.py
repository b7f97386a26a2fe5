r"""Chat formatting in budgeted windows (built-in functions only).

A turn is written as "### role: text", a line break and "</turn>". Inside texts a backslash is put before every backslash,
"#" and "<" (and before ":" in roles), so that no text can hold a control string: in a written text each "<" follows a
backslash, in a control string it follows a line break. Reading back drops the first of each pair.

Prefix sums of turn tokens choose the windows. A window is the system turn (the first turn, if its role is "system"), up to
`history` turns before its first new turn, as far as they fit `history_budget`, and new turns while all of them together
stay within the budget. A new turn that does not fit beside the system turn stands alone with it, never cut; a system
turn that takes the whole budget is an ordinary turn instead. Repeated turns are masked, so every assistant text is a
target exactly once. Tokens are words plus four control tokens a turn, a stand-in for a tokenizer's count that needs none.

Scale: one shuffle by conversation; a conversation is one document of the output, so its turns meet in one row, and its
windows hold slices of them. Work is linear in the turns. Equal conversations under many ids
stay apart.

Defined results: null roles and texts are empty; null conv_id is a conversation of its own; turns are ordered by (turn, role,
text) with a null turn first, so ties break by role and text, and repeated rows are turns of their own; long roles and texts are
read back by position; an empty table gives an empty table. Only the four columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK, let, running, word_array

END = "\n</turn>\n"


@dataclass(frozen=True)
class Windows:
    budget: int = 512
    history: int = 2
    history_budget: int = 128
    control_tokens: int = 4
    target_role: str = "assistant"


def escape(text: Column, extra: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\#<{extra}])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _ordered_turns(conversations: DataFrame, how: Windows) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    turns = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    head = lambda t: F.concat(F.lit("### "), escape(t.role, ":"), F.lit(": "))
    made = lambda t: F.struct(head(t).alias("head"), escape(t.text).alias("body"), (t.role == how.target_role).alias("target"), (F.size(word_array(t.text)) + how.control_tokens).cast("long").alias("tokens"))
    return turns.select("conv_id", (F.coalesce(F.get("turns", 0).role, F.lit("")) == "system").alias("has_system"), F.transform("turns", made).alias("turns"))


def _marks(turns: Column, own: Column, how: Windows) -> Column:
    """Per turn: its place, prefix sums before and with it, how many turns a window that starts at it repeats, and their tokens with the system turn's."""

    def marked(upto: Column) -> Column:
        before = lambda i: F.coalesce(F.get(upto, i - 1), F.lit(0).cast("long"))
        system = F.when(own == 1, F.get(upto, 0)).otherwise(F.lit(0).cast("long"))

        def mark(t: Column, i: Column) -> Column:
            room = F.least(F.lit(how.history_budget).cast("long"), how.budget - system - t.tokens)
            back = F.lit(0)
            for k in range(1, how.history + 1):  # sums grow with k, so the last one that fits is the longest
                back = F.when((i - k >= own) & (before(i) - before(i - k) <= room), k).otherwise(back)
            return F.struct(i.alias("i"), before(i).alias("before"), F.get(upto, i).alias("upto"), back.alias("back"), (system + before(i) - before(i - back)).alias("context"))

        return F.transform(turns, mark)

    return let(running(F.transform(turns, lambda t: t.tokens), lambda a, b: a + b, "long"), marked)


def _starts(turns: Column, own: Column, how: Windows) -> Column:
    """(first, back) of each window: its first new turn and how many turns before it are repeated."""

    def step(state: Column, m: Column) -> Column:
        opens = (m.i >= own) & ((state.first < 0) | (state.context + m.upto - state.since > how.budget))
        full = opens & (F.size(state.starts) == CHUNK)
        starts = F.when(full, F.slice(state.starts, 1, 0)).otherwise(state.starts)
        return F.struct(
            F.when(opens, m.i).otherwise(state.first).alias("first"),
            F.when(opens, m.before).otherwise(state.since).alias("since"),
            F.when(opens, m.context).otherwise(state.context).alias("context"),
            F.when(full, F.array_append(state.done, state.starts)).otherwise(state.done).alias("done"),
            F.when(opens, F.array_append(starts, F.struct(m.i.alias("first"), m.back.alias("back")))).otherwise(starts).alias("starts"),
        )

    none = "array<struct<first:int,back:int>>"
    zero = F.struct(F.lit(-1).alias("first"), F.lit(0).cast("long").alias("since"), F.lit(0).cast("long").alias("context"), F.array().cast(f"array<{none}>").alias("done"), F.array().cast(none).alias("starts"))
    found = F.aggregate(_marks(turns, own, how), zero, step, lambda s: F.concat(F.flatten(s.done), s.starts))
    alone = F.array(F.struct(own.alias("first"), F.lit(0).alias("back")))  # a system turn and nothing else
    return let(found, lambda x: F.when(F.size(x) == 0, alone).otherwise(x))


def format_windows(conversations: DataFrame, how: Windows = Windows()) -> DataFrame:
    """(conv_id, window, formatted, repeated, loss): `repeated` leading turns are context, loss the [start, end) spans of targets."""
    kept = F.col("has_system") & (F.get("turns", 0).tokens < how.budget)
    df = _ordered_turns(conversations, how).withColumn("own", kept.cast("int"))
    turns, own = F.col("turns"), F.col("own")

    def windows(starts: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            after = F.coalesce(F.get(starts, i + 1).first, F.size(turns))
            shown = F.concat(F.slice(turns, F.lit(1), own), F.slice(turns, s.first - s.back + 1, after - s.first + s.back))
            return F.struct(shown.alias("shown"), F.when(i == 0, 0).otherwise(own + s.back).alias("repeated"))

        return F.transform(starts, one)

    df = df.select("conv_id", F.posexplode(let(_starts(turns, own, how), windows)).alias("window", "w"))

    def written(w: Column) -> Column:
        ends = running(F.transform(w.shown, lambda t: F.length(t.head) + F.length(t.body) + len(END)), lambda a, b: a + b)
        span = lambda t, end: F.struct((end - len(END) - F.length(t.body)).alias("start"), (end - len(END)).alias("end"))
        spans = lambda e: F.transform(w.shown, lambda t, i: F.when(t.target & (i >= w.repeated), span(t, F.get(e, i))))
        text = F.array_join(F.transform(w.shown, lambda t: F.concat(t.head, t.body, F.lit(END))), "")
        return F.struct(text.alias("formatted"), F.array_compact(let(ends, spans)).alias("loss"))

    df = df.select("conv_id", "window", let(F.col("w"), written).alias("made"), F.col("w.repeated").cast("int").alias("repeated"))
    return df.select("conv_id", "window", "made.formatted", "repeated", "made.loss")


def read_turns(formatted: Column) -> Column:
    """The turns of one window: array of (role, text)."""
    parts = F.split(formatted, r"\n</turn>\n", -1)
    head = r"(?s)^### ((?:[^\\:]++|\\.)*+): "  # possessive: it does not recurse over a long role
    one = lambda p: F.struct(unescape(F.regexp_extract(p, head, 1)).alias("role"), unescape(F.regexp_replace(p, head, "")).alias("text"))
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), one)


def read_back(windows: DataFrame) -> DataFrame:
    """Digest of each conversation from its windows: turns each once, texts under the loss mask, characters written."""
    turns = F.slice(read_turns(F.col("formatted")), F.col("repeated") + 1, F.lit(2**31 - 1))
    loss = F.array_join(F.transform("loss", lambda s: unescape(F.substring("formatted", s.start + 1, s.end - s.start))), "")
    text = F.array_join(F.transform(F.col("fresh"), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    each = windows.select("conv_id", "window", turns.alias("fresh"), loss.alias("loss"), F.length("formatted").cast("long").alias("chars"))
    each = each.select("conv_id", F.struct("window", text.alias("text"), "loss").alias("part"), F.size("fresh").cast("long").alias("n"), "chars")
    one = each.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("parts"))
    whole = lambda c: F.array_join(F.transform("parts", lambda p: p[c]), "")
    df = one.select("conv_id", "n_turns", whole("text").alias("text"), whole("loss").alias("loss"), "formatted_chars")
    return df.select("conv_id", "n_turns", F.sha2("text", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
