"""What the operators share: words, scratch tables, let-bindings, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and the five ASCII line and tab controls.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What a null doc_id counts as where documents have an order: the last one.
NO_ID = 2**63 - 1


def doc_key(name: str = "doc_id") -> Column:
    """doc_id as a long; rows without one are together the last document."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body uses it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


#: Lists that grow by one element at a time are kept in pieces of this size, so that a long one is not copied again and again.
CHUNK = 256


def running(values: Column, op: Callable[[Column, Column], Column], kind: str = "int") -> Column:
    """Running values of an array of `kind`: op over each element and all before it."""

    def step(state: Column, value: Column) -> Column:
        total = F.when(state.total.isNull(), value).otherwise(op(state.total, value))
        full = F.size(state.part) == CHUNK
        done = F.when(full, F.array_append(state.done, state.part)).otherwise(state.done)
        part = F.array_append(F.when(full, F.slice(state.part, 1, 0)).otherwise(state.part), total)
        return F.struct(total.alias("total"), done.alias("done"), part.alias("part"))

    zero = F.struct(F.lit(None).cast(kind).alias("total"), F.array().cast(f"array<array<{kind}>>").alias("done"), F.array().cast(f"array<{kind}>").alias("part"))
    return F.aggregate(values, zero, step, lambda s: F.concat(F.flatten(s.done), s.part))


def word_array(text: Column) -> Column:
    """The words of a text; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset (local runs)."""
    sc = spark.sparkContext
    told = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not told:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        told = tempfile.mkdtemp(prefix="casita-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(told)
    return told


#: Folder, below the application's, of the scratch tables that are written now.
_scope: ContextVar[str] = ContextVar("scope", default="main")


@contextmanager
def scratch_scope(name: str) -> Iterator[None]:
    """Scratch tables written inside go to a folder of this name, so that they can be deleted together."""
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)


def _scratch_root(spark: SparkSession, scope: str) -> str:
    return f"{shared_dir(spark)}/casita/{spark.sparkContext.applicationId}/{scope}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_scratch_root(spark, _scope.get())}/{name}-{uuid.uuid4().hex}"


def scratch(df: DataFrame, name: str) -> DataFrame:
    """df written once to a table in the shared folder and read back: this cuts lineage and survives a lost executor.

    The tables stay under <shared folder>/casita/<application>/<scope> until clear_scratch().
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession, scope: str = "main") -> None:
    """Deletes this application's scratch tables of a scope; only when no DataFrame that reads one is still to run."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark, scope))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def reads_scratch(df: DataFrame, scope: str) -> bool:
    """Whether the plan of df still reads scratch tables of a scope."""
    root = _scratch_root(df.sparkSession, scope).split(":", 1)[-1].lstrip("/")
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    files = [x for x in (leaves.apply(i) for i in range(leaves.size())) if x.getClass().getSimpleName() == "LogicalRelation"]
    roots = [x.relation().location().rootPaths() for x in files if x.relation().getClass().getSimpleName() == "HadoopFsRelation"]
    return any(root in r.apply(i).toString() for r in roots for i in range(r.size()))


#: A side of a join is sent to all executors up to this size; beyond it the join shuffles.
SENT_BYTES = 48_000_000


def bounded(side: DataFrame, row_bytes: int) -> DataFrame:
    """A written table, marked for broadcast if its rows, of row_bytes each at most on average, stay below SENT_BYTES."""
    return F.broadcast(side) if side.count() * row_bytes <= SENT_BYTES else side


def packed(df: DataFrame, name: str = "doc") -> DataFrame:
    """df with all columns in one struct, so that no column that an operator adds can clash with one of the input."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): (node, root), root the smallest node; only nodes with an edge appear.

    Alternating large-star and small-star steps: in each, a node's neighbours move to its smallest neighbour, found by
    an aggregate that combines on the map side; no neighbour list is ever gathered. The joins back to the edges are
    plain sort-merge joins that AQE may split where a node is hot. The edge table is written to the shared folder in
    each round, and rounds go on until nothing changes (O(log n) of them in practice); the driver sees only counts.
    """
    e = scratch(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    if e.isEmpty():
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))

    def state(x: DataFrame) -> tuple:
        row = x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    before = state(e)
    for _ in range(max_rounds):
        # large star: every neighbour above u moves to the smallest of u and its neighbours
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the smallest
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small_low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        e = scratch(moved, "edges")
        now = state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
