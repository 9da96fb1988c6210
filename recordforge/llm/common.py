"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Salts that spread a hot join key; a side that is copied is copied this often.
SALTS = 64


def by_value(module_name: str) -> None:
    """Ship a module's functions with the job, so executors need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def frugal(task):
    """``task`` over Arrow batches; what it has freed goes back to the system at its end,
    since Python workers outlive their tasks and keep it otherwise."""

    def run(batches):
        import ctypes

        import pyarrow as pa

        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # in glibc
            if trim is not None:
                trim(0)

    return run


#: Rows go to Python in Arrow batches of so many bytes, where the session does not say otherwise.
BATCH_BYTES = "6m"
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def map_batches(df: DataFrame, task, schema) -> DataFrame:
    """``df`` through ``task`` over Arrow batches of bounded size. A session that holds Spark's
    own limit of 64 MB, which two tasks hold in the JVM and in Python at once, gets a lower one."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_CONF, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        conf.set(_BATCH_CONF, BATCH_BYTES)
    return df.mapInArrow(frugal(task), schema)


def text_slices(batch, column: str, max_chars: int = 1_000_000):
    """Row ranges of an Arrow batch that hold about ``max_chars`` bytes of text (one row at least)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.cast(pc.binary_length(col), pa.int64()), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + max_chars, side="right")))
        yield at, to - at
        at = to


def salted(df: DataFrame, salt: str = "_salt", n: int = SALTS) -> DataFrame:
    """Every row of a small side, once for each salt."""
    return df.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def salt_of(*cols, n: int = SALTS):
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


#: Rows up to which a counted side may be broadcast (narrow rows; some tens of MB at most).
BROADCAST_ROWS = 500_000


def block_pairs(rows: DataFrame) -> DataFrame:
    """Each row once for each pair (p, q) of blocks, p <= q, that its own block is part of; ``blocks`` counts its group's."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("p", F.least("block", "_other")).withColumn("q", F.greatest("block", "_other")).drop("_other")


def grouped(batches, n_keys: int):
    """Arrow tables of rows that agree in the first ``n_keys`` columns, from batches sorted by them."""
    import numpy as np
    import pyarrow as pa

    held: list = []

    def key(batch, i):
        return tuple(batch.column(c)[i].as_py() for c in range(n_keys))

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n - 1, dtype=bool)
        for c in range(n_keys):
            values = np.asarray(batch.column(c))
            change |= values[1:] != values[:-1]
        starts = np.concatenate([[0], np.nonzero(change)[0] + 1, [n]])
        if held and key(held[-1], held[-1].num_rows - 1) != key(batch, 0):
            yield pa.Table.from_batches(held)
            held = []
        for lo, hi in zip(starts[:-2], starts[1:-1]):
            yield pa.Table.from_batches([*held, batch.slice(lo, hi - lo)])
            held = []
        held.append(batch.slice(starts[-2], n - starts[-2]))
    if held:
        yield pa.Table.from_batches(held)


def merge_labels(pairs: "np.ndarray", n: int) -> "np.ndarray":  # noqa: F821
    """The smallest member reachable from each of 0..n-1 over the (k, 2) ``pairs``."""
    import numpy as np

    label = np.arange(n)
    if len(pairs):
        a, b = pairs[:, 0], pairs[:, 1]
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, label[a], low)
            np.minimum.at(new, label[b], low)
            new = np.minimum(new, new[new])
            new = new[new]
            if (new == label).all():
                break
            label = new
    return label
