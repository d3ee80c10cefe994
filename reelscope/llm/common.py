"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelscope.session import scratch_path

# The white space of every contract here: blank, tab, LF, VT, FF, CR. It is
# also exactly what ``bytes.split()`` splits on.
SPACES = " \t\n\x0b\x0c\r"
NOT_SPACE = "[^\\x20\\x09-\\x0D]+"

# Rows handed to a Python function at once; bounds what one call holds when
# texts are long, whatever the size of the Arrow batch.
CHUNK_ROWS = 512

# Bytes of an Arrow batch on its way to a Python worker, beside Spark's bound
# on its rows: a batch of whole texts is held on both sides at once.
BATCH_BYTES = 8 << 20
# So that a worker gives freed memory back between batches and stages.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2",
                 "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576"}

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns with the given types, under the given names.

    Columns are found by their exact spelling and position, so further
    columns of any name (``TEXT`` beside ``text``, or one that an operator
    adds itself) change nothing.
    """
    at = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    bare = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return bare.select(*[F.col(f"c{at[c]}").cast(t).alias(c) for c, t in columns.items()])


def carry(docs: DataFrame, **columns: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with the named columns of the given types beside all its own,
    which are hidden under neutral names; and a function that gives them back
    under their names and types, some replaced by keyword."""
    at = {c: i for i, c in reversed(list(enumerate(docs.columns)))}
    types = dict(docs.dtypes)
    bare = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    bare = bare.select("*", *[F.col(f"c{at[c]}").cast(t).alias(c) for c, t in columns.items()])

    def back(df: DataFrame, **changed) -> DataFrame:
        return df.select(*[changed[c].cast(types[c]).alias(c) if c in changed else F.col(f"c{i}").alias(c)
                           for i, c in enumerate(docs.columns)])

    return bare, back


def land(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage, survives
    lost executors, and keeps a column pruned, compressed copy."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from the
    checkout; on a cluster it is installed or shipped with ``--py-files``.
    Also bounds what workers hold: see BATCH_BYTES and WORKER_MEMORY."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


_held: dict = {}


def hold(key: tuple, make: Callable[[], object]):
    """What a Python worker keeps between tasks: one object at a time (a
    tokenizer with its remembered words), so that workers that serve several
    stages do not pile them up."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """``mapInArrow`` in chunks of CHUNK_ROWS: ``fn`` takes and gives a dict of
    columns (lists or arrays); it may give more or fewer rows than it took."""
    spark = df.sparkSession
    importable(spark)
    out = pa.schema([pa.field(f.name, _arrow(f.dataType.simpleString()))
                     for f in spark.createDataFrame([], schema).schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(i, CHUNK_ROWS)
                got = fn({n: part.column(k).to_pylist() for k, n in enumerate(part.schema.names)})
                if len(next(iter(got.values()))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(got[f.name], type=f.type) for f in out], schema=out)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "binary": pa.binary(), "boolean": pa.bool_(), "float": pa.float32()}[kind]


# Rows up to which a counted table is broadcast; beyond, joins shuffle.
BROADCAST_ROWS = 20_000
# The same for rows of a key alone, where the other side is whole texts: about
# 20 MB at most.
BROADCAST_KEYS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it was counted to be short enough. For
    landed tables of narrow rows; longer ones take an ordinary join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
