"""CSV records of large files, read by several tasks though values hold line breaks.

A line break ends a record only outside quotes, so a split does not know where
its first record begins. It follows from the parity of the quotes before it:

1. count the quotes of every split (one number a split), and take the running
   parity over a file's splits: whether each begins inside a value;
2. each task joins its lines to records, starting from that: a line whose
   running parity is odd goes on in the next one. What is left open at either
   end of a split is a fragment, two a split at most;
3. fragments are put together by file, in order. A record is only as large as
   it is, however many splits it spans.

Parity tells the same as a parser as long as quotes stand around whole values
(doubled inside), which every record is checked for: a file that has a quote
anywhere else is refused when it is read, never read wrongly. Lines end with LF
or CRLF.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A record whose quotes all stand around whole values.
WELL_QUOTED = r'(?s)\A(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*\z'

LINES = "file string, block long, row long, fragment int, text string"
_OUT = pa.schema([("file", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("fragment", pa.int32()), ("text", pa.large_string())])

HEAD, WHOLE, TAIL = 0, 1, 2  # goes on from before; a record; goes on behind


def refuse_odd_quotes(records: pa.Array) -> None:
    """Raise if a quote stands anywhere but around a whole value."""
    odd = pc.and_(pc.match_substring(records, '"'), pc.invert(pc.match_substring_regex(records, WELL_QUOTED)))
    if pc.any(odd).as_py():
        shown = records.filter(odd)[0].as_py()[:200]
        raise ValueError(f'a quote inside an unquoted value; load this file with multi_line="whole": {shown!r}')


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, block, open, value), in order, as whole records and fragments."""
    split, row, held, is_head = None, 0, [], False

    def fragment(kind: int) -> pa.RecordBatch:
        text = "\n".join(held)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([split[0]], [split[1]], [row], [kind], [text]), _OUT)], schema=_OUT)

    def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The batch by split; a task may read several, one after the other."""
        block, file = batch.column(1).to_numpy(), batch.column(0).dictionary_encode().indices.to_numpy()
        new = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
        for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
            if b > a:
                yield batch.slice(a, b - a)

    for batch in batches:
        for part in runs(batch):
            at = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
            if at != split:
                if held:  # what the split before leaves open
                    yield fragment(HEAD if is_head else TAIL)
                split, row, held = at, 0, []
                is_head = part.column(2)[0].as_py()
            lines = part.column(3).cast(pa.large_string())
            odd = pc.count_substring(lines, '"').to_numpy() & 1
            inside = bool(held) or is_head
            state = np.bitwise_xor.accumulate(np.concatenate([[int(inside)], odd]))  # before each line, and at the end
            ends = np.flatnonzero(state[1:] == 0)
            done = 0
            if len(ends) and inside:  # the open record or fragment ends in this batch
                held += lines.slice(0, int(ends[0]) + 1).to_pylist()
                yield fragment(HEAD if is_head else WHOLE)
                row, held, is_head, done = row + 1, [], False, int(ends[0]) + 1
                ends = ends[1:]
            if len(ends):
                offsets = np.concatenate([[done], ends + 1])
                whole = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), lines)
                texts = pc.binary_join(whole, pa.scalar("\n", pa.large_string()))
                n = len(ends)
                columns = [pa.array([at[0]] * n), pa.array([at[1]] * n, pa.int64()), pa.array(row + np.arange(n)), pa.array([WHOLE] * n, pa.int32()), texts]
                yield pa.RecordBatch.from_arrays(columns, schema=_OUT)
                row, done = row + n, int(ends[-1]) + 1
            held += lines.slice(done).to_pylist()
    if held:
        yield fragment(HEAD if is_head else TAIL)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        refuse_odd_quotes(batch.column(batch.schema.get_field_index("text")))
        yield batch


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, row, text) of every record, header lines and empty lines
    left out; (file, block, row) is its order in the files."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    located = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    first_line = F.min_by(F.col("value").endswith("\r"), "line").alias("crlf")
    splits = located.withColumn("quotes", quotes).withColumn("line", F.monotonically_increasing_id())
    splits = splits.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), first_line)  # one row a split
    in_file = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("quotes").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parity = splits.select("file", "block", (before % 2 == 1).alias("open"), F.first("crlf").over(in_file).alias("crlf"))
    # a file whose header ends with CRLF has line ends of that kind, also inside values
    line = F.when(F.col("crlf"), F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value"))
    located = located.join(F.broadcast(parity), ["file", "block"]).select("file", "block", "open", line.alias("value"))
    parts = located.mapInArrow(_records, LINES)
    # a fragment that begins a record opens a group, those behind it belong to it
    fragments = parts.where(f"fragment <> {WHOLE}")
    begun = F.sum(F.when(F.col("fragment") == TAIL, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("block", "fragment"))
    grouped = fragments.withColumn("record", begun).groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "fragment", "row", "text"))).alias("parts"))
    joined = grouped.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["row"].alias("row"), F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    records = parts.where(f"fragment = {WHOLE}").select("file", "block", "row", "text").unionByName(joined)
    first = (F.col("block") == 0) & (F.col("row") == 0)
    records = records.where(~first).where("text <> ''")
    return records.mapInArrow(_checked, "file string, block long, row long, text string")
