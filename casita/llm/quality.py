"""Quality rules with robust multivariate outliers (built-in functions only).

Every text gets plain counts and a vector of four transformed statistics. Per language and source, the minimum
covariance determinant is estimated by concentration steps over all documents: in each step the 75 % of a group's
documents that lie nearest to the current centre give the next centre and covariance. Four starts run side by side (around
the coordinatewise median: scaled deviations, spatial signs, squashed deviations; and the classical estimate) for two
steps; the one with the smallest determinant goes on until a step no longer lowers it, and keeps the lower one: documents
that tie may swap, so that a determinant could rise and fall for ever. A document is rejected when its
squared Mahalanobis distance from its group's estimate is above the chi-square quantile of `tail`.

The estimate is a regularized one: `floors` are added to the variances, as without them a statistic that is 0 for most
texts has no variance and rejects all the others. The nearest documents are found by counts of binned distances: a bin is
1/1024 of a factor of e wide, and documents of the last bin, which agree to 0.1 % in squared distance, count as ties and
go together.

Scale: the texts are read once and their vectors written to a scratch table; a step is two aggregates over it, counts by
(group, start, bin) and sums by (group, start), with map-side combine, so a source that holds a third of all rows still
sends only its bins. Sums are fixed-point integers, so reruns agree whatever the order of addition. Group estimates meet
the documents in an equi-join on group and salt, so a hot source spreads over 32 tasks there as well. The driver sees how
many groups have not settled, nothing else.

Defined results: a null text has no words (base_failed). Very long texts are counted whole. Null lang or source is a group
of its own. A group below `min_docs` is pooled with the small groups of its language, a pool still below it with those of
all languages; a last pool still below it judges nobody. Repeated rows are each judged and returned. An empty table gives
an empty table. Columns of the input are kept apart in a struct, so extra columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, packed, scratch, word_array

#: Symbols that prose seldom holds.
SYMBOLS = "#*$%&|<>"
FEATURES = ("x1", "x2", "x3", "x4")
FIXED_POINT = 1_000_000
#: Bins of a squared distance to a factor of e.
BINS_PER_E = 1024
DIMENSIONS = len(FEATURES)


def chi_square_tail(x: float, df: int) -> float:
    """P(X > x) for an even number of degrees of freedom."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi_square_above(tail: float, df: int = DIMENSIONS) -> float:
    """x with P(X > x) = tail, by bisection."""
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_tail(mid, df) > tail else (lo, mid)
    return lo


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 10
    max_repeat_percent: int = 20
    min_docs: int = 50
    h: float = 0.75
    #: Steps of all starts before the best one goes on by itself, and most steps in all.
    first_steps: int = 2
    max_steps: int = 100
    #: A group has settled when a step lowers the log of its determinant by no more, or makes it rise.
    settled: float = 1e-4
    #: Share of a normal sample that would be rejected.
    tail: float = 1e-6
    #: Least standard deviation of each statistic: without it a statistic that is 0 for most texts rejects all the others.
    floors: tuple[float, ...] = (0.05, 0.05, 0.12, 0.1)

    @property
    def consistency(self) -> float:
        """Makes the covariance of the nearest share h consistent at the normal distribution."""
        return self.h / (1 - chi_square_tail(chi_square_above(1 - self.h), DIMENSIONS + 2))

    @property
    def max_distance(self) -> float:
        return math.sqrt(chi_square_above(self.tail))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 5-word window found twice or more in the text, the first one included."""

    def covered(windows: Column) -> Column:
        def marked(ranked: Column) -> Column:
            twice = F.filter(ranked, lambda p, i: F.coalesce(F.get(ranked, i - 1).h == p.h, F.lit(False)) | F.coalesce(F.get(ranked, i + 1).h == p.h, F.lit(False)))
            at = F.sort_array(F.transform(twice, lambda p: p.i))
            return let(at, lambda q: F.aggregate(F.transform(q, lambda x, j: F.least(F.lit(5), F.coalesce(F.get(q, j + 1) - x, F.lit(5)))), F.lit(0).cast("long"), lambda s, x: s + x))

        ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(ranked, marked)).otherwise(F.lit(0).cast("long"))

    def windows(hashed: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashed) - 5), lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(5)]))

    return F.when(F.size(words) < 6, F.lit(0).cast("long")).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashed: let(windows(hashed), covered)))


def with_counts(docs: DataFrame) -> DataFrame:
    """doc (all input columns, as a struct) and the counts of its whole text."""
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = "[^" + "".join("\\" + c for c in SYMBOLS) + "]+"
    return (
        packed(docs)
        .select(
            "doc",
            let(
                word_array(text),
                lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.aggregate(w, F.lit(0).cast("long"), lambda s, x: s + F.length(x)).alias("word_chars"), _repeat_words(w).alias("n_repeat_words")),
            ).alias("a"),
            F.length(F.regexp_replace(text, symbols, "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("b"),
        )
        .select("doc", "a.n_words", "a.word_chars", "n_symbols", "b.n_dup_lines", "a.n_repeat_words", "b.n_lines")
    )


def _vector(rules: QualityRules) -> list[Column]:
    """Shrunk towards what prose has, so that short texts do not stand out by chance alone."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return [
        F.log((chars + 100) / (n + 20)).alias("x1"),
        F.sqrt(F.col("n_symbols") / (chars + 100)).alias("x2"),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5)).alias("x3"),
        F.sqrt(F.col("n_repeat_words") / (n + 50)).alias("x4"),
        ((n < rules.min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(rules.max_repeat_percent) * n)).alias("base_failed"),
        *[F.coalesce(F.concat(F.lit("="), F.col(f"doc.{c}").cast("string")), F.lit("null")).alias(f"g_{c}") for c in ("lang", "source")],
    ]


#: Rows of a group are dealt to this many tasks where they meet the group's estimate.
SALTS = 32


def _meet(rows: DataFrame, small: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """Join with one row (or two) a group, once for each salt: a source with a third of all rows spreads over the tasks."""
    salted = small.withColumn("to_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, on & (F.col("salt") == F.col("to_salt")), how).drop("to_salt")


def _grouped(vectors: DataFrame, rules: QualityRules) -> DataFrame:
    """vectors with g, the group that judges a document, and its size."""
    count = vectors.groupBy("g_lang", "g_source").agg(F.count("*").alias("n"))
    enough = F.col("n") >= rules.min_docs
    # a group is (language, source), (language, null) or (null, null)
    small = count.where(~enough).groupBy(F.col("g_lang").alias("s_lang")).agg((F.sum("n") >= rules.min_docs).alias("s_enough"))
    group = count.join(small, F.col("g_lang") == F.col("s_lang"), "left")
    group = group.select(F.col("g_lang").alias("j_lang"), F.col("g_source").alias("j_source"), "n", F.struct(F.when(enough | F.col("s_enough"), F.col("g_lang")).alias("g_lang"), F.when(enough, F.col("g_source")).alias("g_own")).alias("g"))
    total = group.groupBy("g").agg(F.sum("n").alias("g_n")).select(F.col("g.g_lang").alias("t_lang"), F.col("g.g_own").alias("t_own"), "g_n")
    group = group.join(total, F.col("g.g_lang").eqNullSafe(F.col("t_lang")) & F.col("g.g_own").eqNullSafe(F.col("t_own")))
    group = group.select("j_lang", "j_source", "g", (F.col("g_n") >= rules.min_docs).alias("judged"))
    return _meet(vectors, group, (F.col("g_lang") == F.col("j_lang")) & (F.col("g_source") == F.col("j_source")), "left")


def _pairs() -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i:]]


def _moments() -> list[Column]:
    fixed = lambda c: F.sum(F.round(c * FIXED_POINT).cast("long"))
    return [F.count("*").alias("n"), *[fixed(F.col(a)).alias(f"s_{a}") for a in FEATURES], *[fixed(F.col(a) * F.col(b)).alias(f"s_{a}{b}") for a, b in _pairs()]]


def _estimate(moments: DataFrame, rules: QualityRules, keys: list[str]) -> DataFrame:
    """Centre, inverse Cholesky factor and log determinant from sums; the variances get the floors added."""
    n = F.col("n") * float(FIXED_POINT)
    df = moments.select(*keys, *[(F.col(f"s_{a}") / n).alias(f"m_{a}") for a in FEATURES], *[(F.col(f"s_{a}{b}") / n).alias(f"e_{a}{b}") for a, b in _pairs()])
    floor = lambda a, b: rules.floors[FEATURES.index(a)] ** 2 if a == b else 0.0
    df = df.withColumns({f"c_{a}{b}": rules.consistency * (F.col(f"e_{a}{b}") - F.col(f"m_{a}") * F.col(f"m_{b}")) + floor(a, b) for a, b in _pairs()})
    return _factor(df, keys)


def _factor(df: DataFrame, keys: list[str]) -> DataFrame:
    p = len(FEATURES)
    for j in range(p):  # Cholesky, a column at a time
        a = FEATURES[j]
        df = df.withColumn(f"l_{j}{j}", F.sqrt(reduce(lambda s, k: s - F.col(f"l_{j}{k}") * F.col(f"l_{j}{k}"), range(j), F.col(f"c_{a}{a}"))))
        below = {f"l_{i}{j}": reduce(lambda s, k, i=i: s - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}"), range(j), F.col(f"c_{a}{FEATURES[i]}")) / F.col(f"l_{j}{j}") for i in range(j + 1, p)}
        df = df.withColumns(below) if below else df
    logdet = reduce(lambda s, j: s + F.log(F.col(f"l_{j}{j}")), range(p), F.lit(0.0))
    return df.select(*keys, *[f"m_{a}" for a in FEATURES], *[f"l_{i}{j}" for i in range(p) for j in range(i + 1)], logdet.alias("logdet"))


def _distance(df: DataFrame) -> DataFrame:
    """df with d2, the squared Mahalanobis distance: forward substitution with the Cholesky factor."""
    for i, a in enumerate(FEATURES):
        df = df.withColumn(f"z_{i}", reduce(lambda s, k: s - F.col(f"l_{i}{k}") * F.col(f"z_{k}"), range(i), F.col(a) - F.col(f"m_{a}")) / F.col(f"l_{i}{i}"))
    return df.withColumn("d2", reduce(lambda s, i: s + F.col(f"z_{i}") * F.col(f"z_{i}"), range(1, len(FEATURES)), F.col("z_0") * F.col("z_0")))


def _starts(judged: DataFrame, rules: QualityRules) -> DataFrame:
    """Estimates (g, start) around the coordinatewise median, and the classical one.

    Medians and quartiles are exact for values rounded to 1/1000. With z, a document's deviations over those of its group:
    0 is a diagonal of squared deviations, 1 the covariance of z over its length, 2 that of tanh(z), both scaled back.
    """
    value = F.explode(F.array(*[F.struct(F.lit(a).alias("x"), F.round(F.col(a) * 1000).cast("long").alias("v")) for a in FEATURES]))
    counts = judged.select("g", value.alias("o")).groupBy("g", "o.x", "o.v").agg(F.count("*").alias("n"))
    w = Window.partitionBy("g", "x")
    run = counts.withColumn("upto", F.sum("n").over(w.orderBy("v"))).withColumn("all", F.sum("n").over(w))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("v"))) / 1000.0
    stat = run.groupBy("g", "x").agg(at(0.5).alias("m"), ((at(0.75) - at(0.25)) / 1.349).alias("s"))
    pick = lambda a, c: F.max(F.when(F.col("x") == a, F.col(c)))
    spread = lambda i, a: F.sqrt(pick(a, "s") * pick(a, "s") + rules.floors[i] ** 2)
    centre = scratch(stat.groupBy("g").agg(*[pick(a, "m").alias(f"m_{a}") for a in FEATURES], *[spread(i, a).alias(f"d_{a}") for i, a in enumerate(FEATURES)]), "centre")
    plain = centre.withColumns({f"c_{a}{b}": F.col(f"d_{a}") * F.col(f"d_{a}") if a == b else F.lit(0.0) for a, b in _pairs()})

    z = _meet(judged, centre.withColumnRenamed("g", "c_g"), F.col("g") == F.col("c_g"))
    z = z.select("g", *[((F.col(a) - F.col(f"m_{a}")) / F.col(f"d_{a}")).alias(a) for a in FEATURES])
    size = F.sqrt(reduce(lambda s, a: s + F.col(a) * F.col(a), FEATURES, F.lit(0.0)))
    kinds = [(1, lambda a: F.when(size > 0, F.col(a) / size).otherwise(0.0)), (2, lambda a: F.tanh(a))]
    each = z.select("g", F.explode(F.array(*[F.struct(F.lit(k).alias("start"), *[f(a).alias(a) for a in FEATURES]) for k, f in kinds])).alias("o")).select("g", "o.*")
    sums = each.groupBy("g", "start").agg(*_moments()).withColumnRenamed("g", "c_g")
    n = F.col("n") * float(FIXED_POINT)
    shaped = centre.join(sums, F.col("g") == F.col("c_g"))
    scaled = lambda a, b: F.col(f"s_{a}{b}") / n * F.col(f"d_{a}") * F.col(f"d_{b}") + (F.pow(F.col(f"d_{a}"), 2) * 0.01 if a == b else F.lit(0.0))
    shaped = shaped.withColumns({f"c_{a}{b}": scaled(a, b) for a, b in _pairs()})
    classical = _estimate(judged.groupBy("g").agg(*_moments()).withColumn("start", F.lit(3)), rules, ["g", "start"])
    return _factor(plain.withColumn("start", F.lit(0)), ["g", "start"]).unionByName(_factor(shaped, ["g", "start"])).unionByName(classical)


def _step(judged: DataFrame, now: DataFrame, rules: QualityRules) -> DataFrame:
    """One concentration step: (g, start) estimates from the nearest share h of each group, with `fall`, what the log determinant lost."""
    est = now.withColumnRenamed("g", "now_g").drop("fall")
    binned = _distance(_meet(judged, est, F.col("g") == F.col("now_g"))).withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * BINS_PER_E))
    w = Window.partitionBy("g", "start")
    counts = binned.groupBy("g", "start", "bin").agg(F.count("*").alias("n"))
    near = counts.withColumn("before", F.sum("n").over(w.orderBy("bin")) - F.col("n")).withColumn("all", F.sum("n").over(w)).where(F.col("before") < F.col("all") * rules.h)
    last = near.groupBy("g", "start").agg(F.max("bin").alias("last")).select(F.col("g").alias("l_g"), F.col("start").alias("l_start"), "last")
    est = est.join(last, (F.col("now_g") == F.col("l_g")) & (F.col("start") == F.col("l_start"))).drop("l_g", "l_start")
    binned = _distance(_meet(judged, scratch(est, "limits"), F.col("g") == F.col("now_g")))
    sums = binned.where(F.floor(F.log(F.col("d2") + 1e-6) * BINS_PER_E) <= F.col("last")).groupBy("g", "start").agg(*_moments(), F.first("logdet").alias("was"))
    found = _estimate(sums, rules, ["g", "start", "was"])
    return found.withColumn("fall", F.col("was") - F.col("logdet")).drop("was")


def _lower(after: DataFrame, now: DataFrame) -> DataFrame:
    """The estimates of a step, with the one before it where the determinant rose."""
    kept = [c for c in now.columns if c not in ("g", "fall")]
    was = now.select(F.col("g").alias("was_g"), *[F.col(c).alias(f"was_{c}") for c in kept])
    return after.join(was, F.col("g") == F.col("was_g")).select("g", *[F.when(F.col("fall") < 0, F.col(f"was_{c}")).otherwise(F.col(c)).alias(c) for c in kept], "fall")


def mcd(judged: DataFrame, rules: QualityRules, keep_det: bool = False) -> DataFrame:
    """The minimum-covariance-determinant estimate of each group g of judged (g, salt, x1 to x4), on request with logdet."""
    now = scratch(_starts(judged, rules), "starts")
    for _ in range(rules.first_steps):
        now = scratch(_step(judged, now, rules), "step")
    best = Window.partitionBy("g").orderBy("logdet", "start")
    now = now.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank")
    ended = []
    for _ in range(rules.max_steps - rules.first_steps):
        after = scratch(_lower(_step(judged, now, rules), now), "step")
        ended.append(after.where(F.col("fall") <= rules.settled))
        now = after.where(F.col("fall") > rules.settled)
        if now.isEmpty():
            break
    else:
        ended.append(now)
    return reduce(DataFrame.unionByName, ended).drop("start", "fall", *([] if keep_det else ["logdet"]))


def quality(docs: DataFrame, rules: QualityRules = QualityRules(), carry: list[str] | None = None) -> DataFrame:
    """doc (a struct of the input's columns, or of those in carry), its counts, base_failed, distance and kept."""
    kept = [F.col(f"doc.`{c}`").alias(c) for c in (carry or docs.columns)]
    vectors = with_counts(docs).select("*", *_vector(rules)).withColumn("doc", F.struct(*kept)).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    vectors = scratch(vectors, "quality")
    grouped = _grouped(vectors, rules)
    judged = scratch(grouped.where("judged").select("g", "salt", *FEATURES), "judged")
    best = mcd(judged, rules).withColumnRenamed("g", "b_g")
    scored = _distance(_meet(grouped, best, F.col("judged") & (F.col("g") == F.col("b_g")), "left"))
    distance = F.sqrt(F.col("d2"))
    verdict = ~F.col("base_failed") & F.coalesce(distance <= rules.max_distance, F.lit(True))
    return scored.select("doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", verdict.alias("kept"), F.round(distance, 6).alias("distance"))
