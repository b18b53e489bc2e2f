"""A CSV file that is read by several tasks gives the rows of the whole-file reader."""

import random

import pytest

from strata.sources import csv_source
from strata.sources.csv_source import read_raw_csv
from strata.sources.schemas import RAW_COLUMNS

ENTITY = "order_reviews"


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "256")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def value(rng, number, end):
    kind = rng.random()
    if kind < 0.2:
        return ""
    if kind < 0.3:
        return '""'
    if kind < 0.6:
        return f"plain {number} é"
    inner = rng.choice(["a,b", 'says ""hi""', f"line{end}break", f"{end}{end}", f'""{end}""', "x" * rng.randint(0, 200), f",{end},"])
    return f'"{inner * rng.randint(1, 3)}"'


def write(path, rng, rows, end="\n", big=0, last=True):
    width = len(RAW_COLUMNS[ENTITY])
    lines = [",".join(RAW_COLUMNS[ENTITY])]
    for i in range(rows):
        cells = [f"id{i}"] + [value(rng, i, end) for _ in range(width - 1)]
        if big and i == rows // 2:
            cells[2] = '"' + f"long{end}" * big + '"'
        lines.append(",".join(cells))
        if rng.random() < 0.02:
            lines.append("")  # an empty line is no row
    text = end.join(lines) + (end if last else "")
    with open(path, "wb") as out:
        out.write(b"\xef\xbb\xbf" * (end == "\r\n") + text.encode())


def rows_of(df):
    return [tuple(r)[:-1] for r in sorted(df.collect(), key=lambda r: tuple(r["_ingest_pos"]))]


@pytest.mark.parametrize("end, big, last", [("\n", 0, True), ("\r\n", 0, False), ("\n", 3000, True)])
def test_split_reader_equals_the_whole_file_reader(spark, scratch, small_splits, end, big, last):
    rng = random.Random(big + len(end))
    paths = [f"{scratch}/reviews_{i}.csv" for i in (2, 10)]
    for path in paths:
        write(path, rng, 300, end, big, last)
    split = read_raw_csv(spark, paths, ENTITY, 7)
    assert spark.read.option("lineSep", "\n").text(paths).rdd.getNumPartitions() > 6
    whole = read_raw_csv(spark, paths, ENTITY, 7, multi_line="whole")
    assert split.columns == whole.columns
    got, want = rows_of(split), rows_of(whole)
    assert got == want and len(got) == 600


def test_small_files_keep_the_whole_file_reader(spark, scratch):
    write(f"{scratch}/reviews.csv", random.Random(1), 20)
    plan = read_raw_csv(spark, f"{scratch}/reviews.csv", ENTITY, 1)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


def test_a_quote_inside_a_value_is_refused(spark, scratch, small_splits):
    path = f"{scratch}/reviews.csv"
    write(path, random.Random(3), 200)
    width = len(RAW_COLUMNS[ENTITY])
    with open(path, "ab") as out:
        out.write((",".join(["id", '5" pipe', *["x"] * (width - 2)]) + "\n").encode())
        out.write((",".join(["id2", 'a "b" c', *["x"] * (width - 2)]) + "\n").encode())
    with pytest.raises(Exception, match="whole"):
        read_raw_csv(spark, path, ENTITY, 1).collect()
    assert len(read_raw_csv(spark, path, ENTITY, 1, multi_line="whole").collect()) == 202


def test_a_row_of_the_wrong_width_fails(spark, scratch, small_splits):
    path = f"{scratch}/reviews.csv"
    write(path, random.Random(4), 200)
    with open(path, "ab") as out:
        out.write(b"only,two\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_raw_csv(spark, path, ENTITY, 1).collect()


def test_records_over_many_batches(spark, scratch, small_splits):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        path = f"{scratch}/reviews.csv"
        write(path, random.Random(5), 200, big=900)
        assert rows_of(read_raw_csv(spark, path, ENTITY, 1)) == rows_of(read_raw_csv(spark, path, ENTITY, 1, multi_line="whole"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert csv_source.MULTI_LINE[ENTITY] is True
