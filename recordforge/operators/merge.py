"""Field-level survivorship rules for merging duplicate groups (M1-M7).

The reference folds the rows of a group pairwise, in survivor order
(completeness descending, then input order). Each rule has a closed form
as an order-aware aggregate, so a group is merged by one ``groupBy`` with
partial (map-side) aggregation — a huge group is never gathered in one task:

* ``first``       first present value (present = non-null and non-blank),
                  else the first row's value;
* ``longest``     first of the longest present values;
* ``shortest``    first of the shortest present values;
* ``not_generic`` first present value that is not the generic word, else the
                  last present value;
* ``mixed_case``  first present value in mixed case, else ``first``;
* ``midpoint``    running midpoint ``acc = (acc + x) / 2`` over non-null
                  values in survivor order.

``min_by(value, when(cond, order))`` plays the part of ``FILTER (WHERE cond)``
because ``min_by`` ignores null orderings.

The midpoint depends on every value and its place, so it is reduced in runs:
over a run of ``m`` values the fold is the map ``acc -> acc * 2**-m + b``, and
such maps compose in order. Values are range-partitioned and sorted by (group,
survivor order), each task folds its run of a group in one walk that holds no
values, and the few runs of a group are composed. A group that holds a third of all rows is spread over tasks by its
order; a group that fits one run is bit-identical to a sequential fold, and one
cut into runs differs from it by rounding only. No value is left out.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from .. import config
from ..functions.text import py_strip
from ..session import checkpoint_dir
from .normalise import completeness_expr, float_columns

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_RULES = {
    "display_address": "longest",
    "primary_type": "not_generic",
    "website": "shortest",
    "name": "mixed_case",
    "latitude": "midpoint",
    "longitude": "midpoint",
}

_ORDER = "__o"


def _present(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, NumericType):
        return F.col(c).isNotNull() & ~F.isnan(F.col(c))
    return F.col(c).isNotNull() & (py_strip(F.col(c).cast("string")) != F.lit(""))


def _first(df, c, head):
    return F.coalesce(F.min_by(c, F.when(_present(df, c), F.col(_ORDER))), head[c])


def _rule_expr(df: DataFrame, c: str, rule: str, generic: str, head: Column) -> Column:
    """The rule's aggregate; ``head`` is the group's first row, one aggregate for all columns."""
    o = F.col(_ORDER)
    pres = _present(df, c)
    if rule == "first":
        return _first(df, c, head)
    if rule == "longest":
        return F.coalesce(F.min_by(c, F.when(pres, F.struct(-F.length(c), o))), head[c])
    if rule == "shortest":
        return F.coalesce(F.min_by(c, F.when(pres, F.struct(F.length(c), o))), head[c])
    if rule == "not_generic":
        specific = pres & (F.lower(py_strip(F.col(c))) != F.lit(generic))
        return F.coalesce(F.min_by(c, F.when(specific, o)), F.max_by(c, F.when(pres, o)), head[c])
    if rule == "mixed_case":
        mixed = pres & (F.col(c) != F.upper(c)) & (F.col(c) != F.lower(c))
        return F.coalesce(F.min_by(c, F.when(mixed, o)), _first(df, c, head))
    raise ValueError(f"unknown merge rule {rule!r} for column {c!r}")


def survivor_order(order_by=("id",), columns=None, floats=()) -> Column:
    """M1: completeness descending, then the caller's order columns."""
    cols = [F.col(c) for c in order_by]
    return F.struct(-completeness_expr(columns, floats), *cols)


_RUN = StructType().add("__run", "long").add("head", "double").add("b", "double").add("a", "double")


def _fold_runs(batches):
    """Rows (keys, x) in order -> one row a run of equal keys: its number, the fold from its first value,
    and the map ``acc -> acc * a + b``. Holds one run's three numbers, whatever its length."""
    import pyarrow as pa
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 40  # tasks ascend with the ranges
    key, head, b, a, done, kinds = None, 0.0, 0.0, 1.0, [], None

    def pack():
        values = zip(*[(*k, *rest) for k, rest in done])
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names)

    for batch in batches:
        if kinds is None:
            kinds = [*batch.schema.types[:-1], pa.int64(), *[pa.float64()] * 3]
            names = [*batch.schema.names[:-1], *_RUN.names]
        keys = zip(*(c.to_pylist() for c in batch.columns[:-1]))
        for k, x in zip(keys, batch.columns[-1].to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, (number, head, b, a)))
                    number += 1
                key, head, b, a = k, x, x / 2.0, 0.5
            else:
                head, b, a = (head + x) / 2.0, (b + x) / 2.0, a / 2.0
        if done:
            yield pack()
            done = []
    if key is not None:
        done = [(key, (number, head, b, a))]
        yield pack()


def _midpoints(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Running midpoints of ``columns`` per group, from one stacked branch:
    (key, column, order, value) rows, folded run by run."""
    stacked = (
        df.select(
            *keys,
            _ORDER,
            F.explode(
                F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in columns])
            ).alias("__m"),
        )
        .select(*keys, _ORDER, "__m.c", "__m.x")
        .filter(F.col("x").isNotNull() & ~F.isnan(F.col("x")))
    )
    dealt = stacked.repartitionByRange(*keys, "c", _ORDER).sortWithinPartitions(*keys, "c", _ORDER, "x")
    fields = [*dealt.select(*keys, "c").schema.fields, *_RUN.fields]
    runs = dealt.select(*keys, "c", "x").mapInArrow(_fold_runs, StructType(fields))
    runs = runs.select(*keys, "c", F.struct(*_RUN.names).alias("r"))

    def compose(c):
        items = F.array_sort(F.collect_list(F.when(F.col("c") == F.lit(c), F.col("r"))))
        return F.aggregate(
            items,
            F.lit(None).cast("double"),
            lambda acc, r: F.when(acc.isNull(), r["head"])
            .when(F.abs(acc) == F.lit(float("inf")), acc + r["b"])  # 0 * inf is not a number
            .otherwise(acc * r["a"] + r["b"]),
        )

    return runs.groupBy(*keys).agg(*[compose(c).alias(c) for c in columns])


def merge_groups(
    df: DataFrame,
    keys,
    columns=None,
    order_by=("id",),
    rules: dict | None = None,
    generic: str = config.GENERIC_TYPE,
    reuse: bool = True,
) -> DataFrame:
    """One row per group of ``keys`` built by the survivorship ``rules``.

    ``columns`` are the record columns (default: all but helper keys); they
    define completeness and the output column order. With ``reuse`` the input
    is written to the checkpoint folder if the rules read it more than once;
    callers whose input is already written pass False.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = list(columns or [c for c in df.columns if c not in keys])
    rules = {**DEFAULT_RULES, **(rules or {})}
    d = df.withColumn(_ORDER, survivor_order(order_by, columns, float_columns(df)))
    ruled = {c: rules.get(c, "first") for c in columns if c not in keys}
    mids = [c for c, rule in ruled.items() if rule == "midpoint"]
    plain = [c for c in ruled if c not in mids]
    head = F.min_by(F.struct(*plain), _ORDER)
    aggs = [_rule_expr(d, c, ruled[c], generic, head).alias(c) for c in plain]
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("__n")]
    if mids and reuse:
        checkpoint_dir(df.sparkSession)
        d = d.checkpoint()
    merged = d.groupBy(*keys).agg(*aggs)
    if mids:
        merged = merged.join(_midpoints(d, keys, mids), keys, "left")
    return merged.select(*[c for c in columns], *[k for k in keys if k not in columns])
