"""op10: exact round trip of every conversation, targets once, windows within their budget."""

import hashlib
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casita.llm.chat import Windows, format_windows, read_back, read_turns
from casita.llm.queries import TRICKY, op10_chat_windows

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def want(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss))
    return out


def told(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    assert told(op10_chat_windows(spark, sf_dir)) == want(rows)


NASTY = st.text(alphabet="\\#<>/turn: \nas#é\U0001f600", max_size=30) | st.sampled_from(["\n</turn>\n", "### assistant: ", "\\", "\\\\", None, ""])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6) | st.none(), st.sampled_from(["user", "assistant", "system", "a: b", "\\", None]), NASTY), min_size=1, max_size=25))
def test_round_trip(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for how in (Windows(), Windows(budget=9, history=2, history_budget=12)):
        assert told(read_back(format_windows(df, how))) == want(rows)


def plain_windows(tokens, has_system, how):
    """(first, after, repeated) of each window, a turn at a time."""
    own = int(has_system and tokens[0] < how.budget)
    system = tokens[0] if own else 0
    out, first = [], own
    while first < len(tokens) or not out:
        back = 0
        while first < len(tokens) and out and back < how.history and first - back - 1 >= own and sum(tokens[first - back - 1 : first]) <= min(how.history_budget, how.budget - system - tokens[first]):
            back += 1
        after = min(first + 1, len(tokens))
        while after < len(tokens) and system + sum(tokens[first - back : after + 1]) <= how.budget:
            after += 1
        out.append((first, after, own + back if out else 0))
        first = after
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.lists(st.integers(0, 30), min_size=1, max_size=30)), min_size=1, max_size=12))
def test_windows(spark, convs):
    how = Windows(budget=60, history=2, history_budget=30)
    rows = [(c, k, "system" if k == 0 and has else "assistant" if k % 2 else "user", "w " * n, "x") for c, (has, sizes) in enumerate(convs) for k, n in enumerate(sizes)]
    got = format_windows(spark.createDataFrame(rows, SCHEMA + ", window string"), how).withColumn("turns", read_turns(F.col("formatted"))).orderBy("conv_id", "window").collect()
    for c, (has, sizes) in enumerate(convs):
        tokens = [n + how.control_tokens for n in sizes]
        want = plain_windows(tokens, has, how)
        mine = [r for r in got if r.conv_id == c]
        assert [(len(r.turns), r.repeated) for r in mine] == [(after - first + (rep if k else int(has and tokens[0] < how.budget)), rep) for k, (first, after, rep) in enumerate(want)]
        for r in mine:
            used = sum(len(t.text.split()) + how.control_tokens for t in r.turns)
            assert used <= how.budget or len(r.turns) - r.repeated - int(r.window == 0 and has) <= 1
            assert len(r.loss) == sum(t.role == "assistant" for t in r.turns[r.repeated :])


def test_budget_holds_the_system_turn(spark):
    how = Windows(budget=60, history=2, history_budget=30)
    rows = [(1, 0, "system", "s " * 40)] + [(1, k, "user", "w " * 4) for k in range(1, 9)]
    rows += [(2, 0, "system", "s " * 2_000)] + [(2, k, "assistant", "w " * 4) for k in range(1, 9)]
    rows += [(3, 0, "system", "alone")]
    got = format_windows(spark.createDataFrame(rows, SCHEMA), how).withColumn("turns", read_turns(F.col("formatted"))).orderBy("conv_id", "window").collect()
    used = lambda r: sum(len(t.text.split()) + how.control_tokens for t in r.turns)
    assert all(used(r) <= how.budget and r.turns[0].role == "system" for r in got if r.conv_id == 1)
    two = [r for r in got if r.conv_id == 2]
    assert len(two[0].turns) == 1 and all(used(r) <= how.budget and r.turns[0].role == "assistant" for r in two[1:])
    assert [len(r.turns) for r in got if r.conv_id == 3] == [1]


def test_long_roles_and_conversations(spark):
    rows = [(1, 0, "r:\\" * 35_000, "x:" * 1_000_000), (1, 1, "assistant", "\\" * 300_000)] + [(2, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(50_000)]
    assert told(read_back(format_windows(spark.createDataFrame(rows, SCHEMA)))) == want(rows)


def test_empty(spark):
    assert read_back(format_windows(spark.createDataFrame([], SCHEMA))).count() == 0
