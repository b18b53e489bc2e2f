"""Raw CSV ingest (the bulk load of the raw layer).

Dialect: header line, comma, ``"`` quotes doubled inside values, optional BOM
and CRLF. Columns bind by *position* to the declared all-text schema (the
header line is skipped, never used for names). An unquoted empty field is
NULL, a quoted empty field ``""`` is the empty string. A row of the wrong
width fails the load (FAILFAST, raised when the rows are written).

Quoted values may hold line breaks if ``multi_line`` is true (the default). A
file that Spark would split is still read by several tasks: see
``strata.sources.csv_records``. ``multi_line="whole"`` reads each file in one
task, which also takes quotes inside unquoted values. An entity known to hold no
line breaks is loaded with ``multi_line=False``, after a check on its lines that
no quoted value is open at a line's end. A file that fails a check is refused,
never read wrongly.

Every row carries ``_ingest_pos`` = (load sequence, part number, file path,
byte offset of the split, position in the split): the stored replacement for
a database's physical row order, used as the "latest row" tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.csv_records import read_records
from strata.sources.schemas import INGEST_POS, RAW_COLUMNS, SOURCE_FILES, raw_schema
from strata.sources.spread import spread

# CSV reader options of the raw load.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "FAILFAST",
    "nullValue": "\u0001",
    "encoding": "UTF-8",
}

#: Whether an entity's values may hold line breaks, unless the load says otherwise.
MULTI_LINE = {entity: True for entity in SOURCE_FILES}


def ingest_position(load_seq: int, path: str = "_metadata.file_path", block: str = "_metadata.file_block_start", row: Column | None = None):
    """The position of a row just read, from the reader's file metadata."""
    path = F.col(path)
    return F.struct(
        F.lit(load_seq).cast("long").alias("load_seq"),
        # parts are numbered: the tenth comes after the second
        F.coalesce(F.regexp_extract(path, r"_([0-9]{1,18})[.]csv$", 1).try_cast("long"), F.lit(-1).cast("long")).alias("part"),
        path.alias("file"),
        F.col(block).alias("block"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )


def refuse_open_quotes(spark: SparkSession, paths: list[str]) -> None:
    """Raise if a line holds an odd number of quotes: a value goes on behind it."""
    lines = spark.read.text(paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    broken = lines.where(quotes % 2 == 1).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if broken:
        raise ValueError(f"{broken} lines end inside a quoted value; load {', '.join(paths)} with multi_line=True")


def _is_split(spark: SparkSession, paths: list[str]) -> bool:
    """Whether Spark would cut one of the files."""
    most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    summary = [path(p).getFileSystem(conf).getContentSummary(path(p)) for p in paths]
    return any(s.getLength() > most * max(1, s.getFileCount()) for s in summary)


def read_split_csv(spark: SparkSession, paths: list[str], entity: str, load_seq: int) -> DataFrame:
    """The rows of files that may be cut inside a quoted value."""
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    records = read_records(spark, paths)
    parsed = F.from_csv("text", F.lit(raw_schema(entity).simpleString()[7:-1].replace(":", " ")), options)
    return records.select(parsed.alias("r"), ingest_position(load_seq, "file", "block", F.col("row")).alias(INGEST_POS)).select(*[F.col(f"r.{c}").alias(c) for c in RAW_COLUMNS[entity]], INGEST_POS)


def read_raw_csv(spark: SparkSession, path: str | list[str], entity: str, load_seq: int, multi_line: bool | str = True) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    if multi_line is True and _is_split(spark, paths):
        return read_split_csv(spark, paths, entity, load_seq)
    if not multi_line:
        refuse_open_quotes(spark, paths)
    reader = spark.read.schema(raw_schema(entity))
    for k, v in (CSV_OPTIONS | {"multiLine": str(bool(multi_line)).lower()}).items():
        reader = reader.option(k, v)
    df = reader.csv(paths).select(*RAW_COLUMNS[entity], ingest_position(load_seq).alias(INGEST_POS))
    return spread(df)
