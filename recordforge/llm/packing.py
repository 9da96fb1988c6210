"""Best-fit packing planned on the histogram of lengths (operator 6).

Documents are cut into pieces of at most ``capacity`` tokens. Best fit
decreasing needs only how many pieces there are of each length, at most
``capacity`` numbers, so it is planned on the driver over counts: the plan is
a table of runs (length, ranks, first sequence, offset). A piece finds its slot
by its rank among the pieces of its length. Planning cost and plan size depend
on the capacity, not on the number of documents.

Ranks are made in two steps, so a length that a third of all pieces share is
never in one task: pieces are counted by (length, hash bucket), the counts are
summed into offsets, and rows are numbered within their bucket. Pieces are
written once to the shared checkpoint folder before they are counted, so a
recomputed task cannot renumber them.

Null and empty texts are documents of the end token alone. Rows equal in every
column are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, map_batches, materialise, text_slices
from .tokens import ENCODE_BYTES, END_ID, ChunkEncoder

by_value(__name__)

CAPACITY = 4096
#: Pieces in a rank bucket, on average over all lengths.
BUCKET_ROWS = 4096


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over ``{length: count}``: runs (length, rank, n, sequence, offset, per).

    The pieces of a length with ranks ``rank .. rank + n - 1`` go ``per`` to a
    sequence, from sequence number ``sequence`` on, the first of each at ``offset``.
    """
    runs: list[tuple[int, int, int, int, int, int]] = []
    open_by: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences (first, count)
    rooms: list[int] = []
    n_sequences = 0

    def free(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in open_by:
                open_by[room] = []
                insort(rooms, room)
            open_by[room].append((first, count))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count = open_by[room].pop()
                if not open_by[room]:
                    del open_by[room], rooms[at]
            else:
                room, first = capacity, n_sequences
                count = -(-left // (capacity // length))
                n_sequences += count
            per = room // length
            full = min(count, left // per)
            if full:
                runs.append((length, rank, full * per, first, capacity - room, per))
                free(room - per * length, first, full)
                rank, left, first, count = rank + full * per, left - full * per, first + full, count - full
            if count and left:  # fewer pieces than one sequence still holds
                runs.append((length, rank, left, first, capacity - room, per))
                free(room - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            free(room, first, count)
    return runs


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document's ids and the end id, cut."""

    def cut(batches):
        import zlib

        import pyarrow as pa

        enc = ChunkEncoder(tokenizer)
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for at, n in text_slices(batch, "text", ENCODE_BYTES):
                part = batch.slice(at, n)
                rows = []
                flat, offsets = enc.encode(part.column(1))
                for key, lo, hi in zip(part.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    ids = flat[lo:hi].tobytes() + end
                    for k, lo in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[lo : lo + 4 * capacity]
                        rows.append((key, k, lo // 4, len(piece) // 4, zlib.crc32(piece), piece if with_ids else None))
                cols = list(zip(*rows))
                arrays = [pa.array(cols[0], part.schema.field(0).type), pa.array(cols[1], pa.int32())]
                arrays += [pa.array(c, pa.int64()) for c in cols[2:5]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(cols[5], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return map_batches(rows, cut, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS, key: tuple = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (with a ``length`` column of 1..capacity) plus sequence_id and offset.

    ``key`` orders pieces of one length. The other columns pass through.
    """
    spark = pieces.sparkSession
    pieces = materialise(pieces)
    n = pieces.count()
    hashed = F.pmod(F.xxhash64(*key), F.lit(max(1, -(-n // bucket_rows))))
    pieces = pieces.withColumn("_bucket", hashed)
    counts = materialise(pieces.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")))
    # one row per length, at most `capacity`
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = plan_best_fit(total, capacity)
    upto = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("length").alias("_l"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy("length", "_bucket").orderBy(*key, *[c for c in ("ids_crc32",) if c in pieces.columns])
    ranked = pieces.withColumn("_rank", F.row_number().over(within) - 1)
    ranked = ranked.join(offsets, (F.col("length") == F.col("_l")) & (F.col("_bucket") == F.col("_b")))
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_bucket", "_l", "_b", "_base")

    runs.sort()
    plan = spark.sparkContext.broadcast(np.asarray(runs, dtype=np.int64).reshape(-1, 6))  # bounded by the capacity
    out_cols = [c for c in ranked.columns if c != "_rank"]

    def place(batches):
        import pyarrow as pa

        length, rank, _, sequence, offset, per = plan.value.T
        first = np.searchsorted(length, np.arange(capacity + 2))  # where each length's runs begin
        for batch in batches:
            own = np.asarray(batch.column(batch.schema.get_field_index("length")))
            r = np.asarray(batch.column(batch.schema.get_field_index("_rank")))
            at = np.empty(len(r), dtype=np.int64)
            for x in np.unique(own):
                rows = np.nonzero(own == x)[0]
                lo, hi = first[x], first[x + 1]
                at[rows] = lo + np.searchsorted(rank[lo:hi], r[rows], side="right") - 1
            j = r - rank[at]
            seq, off = sequence[at] + j // per[at], offset[at] + (j % per[at]) * length[at]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in out_cols]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(seq), pa.array(off)], [*out_cols, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in out_cols) + ", sequence_id bigint, offset bigint"
    return map_batches(ranked, place, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``: one row per piece."""
    return pack(token_pieces(docs, capacity=capacity, tokenizer=tokenizer, with_ids=with_ids), capacity)
