"""Records of CSV files read range by range, though quoted cells may hold line breaks.

Spark's own CSV source reads such a file in one task, since a range of bytes may
begin inside a cell. Here the text source cuts the files into ranges of lines, and
quotes are counted: a line starts a record where the number of quotes before it
in the file is even (a doubled quote counts two). The counts of the ranges are
summed in file order, so every range knows whether it begins inside a cell; its
task joins lines to records. A record cut by the end of a range leaves a piece on
either side; the pieces, at most two a range, are put together by a shuffle. The
records then go to Spark's CSV parser (``from_csv``) as strings.

The rule holds for files as RFC 4180 has them. Elsewhere (a quote inside an
unquoted cell) the first record that breaks the rule is still cut rightly, so it
is seen there, and the job raises. Lines end with LF or CR LF. The files are read
three times (quotes, pieces, records) and nothing but the pieces is shuffled.
"""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ranges that may be broadcast (some 100 bytes each); beyond, the caller reads whole files.
MAX_RANGES = 1_000_000

RECORDS = "file string, start bigint, seq bigint, begins boolean, ends boolean, header boolean, text string"

_CELL = r'(?:"[^"]*(?:""[^"]*)*"|[^",]*)'
_RECORD = re.compile(rf"{_CELL}(?:,{_CELL})*")


def _lines(spark: SparkSession, path) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    return spark.read.option("lineSep", "\n").text(path).select(*place, F.col("value").alias("line"))


def ranges(spark: SparkSession, path) -> DataFrame:
    """One row per range that holds a line start: (file, start, quotes, lines, inside), ``inside``
    where it begins within a quoted cell."""
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    each = _lines(spark, path).groupBy("file", "start").agg(F.sum(quotes).alias("quotes"), F.count(F.lit(1)).alias("lines"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)


def _check(file: str, text: str) -> None:
    if '"' in text and not _RECORD.fullmatch(text):
        raise ValueError(f"{file}: a quote inside an unquoted cell, or one not closed; read this file with split=False")


class _Range:
    """Lines of one range, joined to records."""

    def __init__(self, file, start, quotes, lines, inside, pieces):
        self.place, self.pieces = (file, start), pieces
        self.expected, self.seen = (quotes, lines), [0, 0]
        self.open = self.begun_before = bool(inside)
        self.held: list[str] = []
        self.seq, self.header = 0, start == 0

    def add(self, line: str):
        n = line.count('"')
        self.seen[0] += n
        self.seen[1] += 1
        self.held.append(line)
        self.open ^= n % 2 == 1
        return None if self.open else self._out(True)

    def _out(self, ends: bool):
        begins, self.begun_before = not self.begun_before, False
        text, self.held = "\n".join(self.held), []
        if ends and text.endswith("\r"):
            text = text[:-1]
        if begins and ends:
            if not text:
                return None  # blank lines are no records
            if self.pieces:
                self.seq, self.header = self.seq + 1, False
                return None
            _check(self.place[0], text)
        self.seq += 1
        header, self.header = self.header, False
        return (*self.place, self.seq, begins, ends, header, text) if self.pieces != (begins and ends) else None

    def close(self):
        if tuple(self.seen) != self.expected:
            raise ValueError(f"{self.place[0]}: ranges changed between two readings; run the job again")
        return self._out(False) if self.held else None


def _joiner(pieces: bool):
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("begins", pa.bool_()),
                            ("ends", pa.bool_()), ("header", pa.bool_()), ("text", pa.string())])

        def pack(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        now, out = None, []
        for batch in batches:
            for file, start, line, quotes, lines, inside in zip(*(c.to_pylist() for c in batch.columns)):
                if quotes is None:
                    raise ValueError(f"{file}: ranges changed between two readings; run the job again")
                if now is None or now.place != (file, start):
                    out.append(now and now.close())
                    now = _Range(file, start, quotes, lines, inside, pieces)
                out.append(now.add(line))
            out = [r for r in out if r]
            if out:
                yield pack(out)
                out = []
        last = now and now.close()
        if last:
            yield pack([last])

    return run


def csv_records(spark: SparkSession, path) -> DataFrame | None:
    """(file, start, seq, header, text): every record's text without its line end, blank lines left
    out; ``header`` marks the first of a file, and (file, start, seq) orders them as they stand.
    None where there are more than ``MAX_RANGES`` ranges."""
    checkpoint_dir(spark)
    marks = ranges(spark, path).checkpoint()
    if marks.count() > MAX_RANGES:
        return None
    # a broadcast join keeps the lines of a range together and in order
    lines = _lines(spark, path).join(F.broadcast(marks), ["file", "start"], "left").select("file", "start", "line", "quotes", "lines", "inside")
    whole = lines.mapInArrow(_joiner(False), RECORDS)
    pieces = lines.mapInArrow(_joiner(True), RECORDS)
    so_far = Window.partitionBy("file").orderBy("start", "seq")
    pieces = pieces.withColumn("record", F.sum(F.col("begins").cast("int")).over(so_far))
    part = F.array_sort(F.collect_list(F.struct("start", "seq", "text")))
    cut = pieces.groupBy("file", "record").agg(part.alias("p"), F.max("header").alias("header"))
    text = F.array_join(F.transform("p", lambda x: x["text"]), "\n")
    cut = cut.select("file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["seq"].alias("seq"), "header", text.alias("text"))
    return whole.drop("begins", "ends").unionByName(cut.mapInArrow(_checked, cut.schema))


def _checked(batches):
    for batch in batches:
        for file, text in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()):
            _check(file, text)
        yield batch
