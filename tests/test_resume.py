"""A failed run is resumed: finished tables stay, the rest is written."""

import os

import pytest

from strata.plans import pipeline
from strata.plans.pipeline import LoadError, Warehouse
from strata.sources.schemas import ENTITY_ORDER, RAW_COLUMNS, SOURCE_FILES

FAILS = "order_payments"


def export(folder, tail=""):
    os.makedirs(folder, exist_ok=True)
    for entity in ENTITY_ORDER:
        width = len(RAW_COLUMNS[entity])
        lines = [",".join(RAW_COLUMNS[entity])] + [",".join([f"{k}{tail}"] + ["1"] * (width - 1)) for k in (1, 2, 2)]
        with open(os.path.join(folder, SOURCE_FILES[entity]), "w", encoding="utf-8") as out:
            out.write("\n".join(lines) + "\n")


def contents(wh, layer):
    drop = "_ingest_pos"
    return {e: sorted(map(str, wh.table(layer, e).drop(drop).collect())) for e in ENTITY_ORDER}


def files(wh, layer, run, table):
    folder = f"{wh.root}/{layer}/{run}/{table}"
    return {n: os.stat(os.path.join(folder, n)).st_mtime_ns for n in os.listdir(folder) if n.endswith(".parquet")}


def test_clean_load_goes_on_where_it_failed(spark, scratch, monkeypatch):
    export(f"{scratch}/in")
    wh, one = Warehouse(spark, f"{scratch}/wh", threads=1), Warehouse(spark, f"{scratch}/one")
    for w in (wh, one):
        w.create_layers()
        w.load_raw(source_dir=f"{scratch}/in")
    one.load_clean()
    right = pipeline.CLEANERS[FAILS]

    def broken(raw):
        raise RuntimeError("lost")

    monkeypatch.setitem(pipeline.CLEANERS, FAILS, broken)
    with pytest.raises(LoadError, match="lost"):
        wh.load_clean(run_id="r1")
    assert wh.runs("clean") == []
    finished = {t: files(wh, "clean", "r1", t) for t in ENTITY_ORDER if t != FAILS}
    monkeypatch.setitem(pipeline.CLEANERS, FAILS, right)
    rows = wh.load_clean(run_id="r1")
    assert {r["table"]: r["status"] for r in rows} == {t: "ok" if t == FAILS else "resumed" for t in ENTITY_ORDER}
    assert finished == {t: files(wh, "clean", "r1", t) for t in finished}
    assert contents(wh, "clean") == contents(one, "clean")
    assert all(r["rows"] == 2 for r in rows) and {r["table"]: r.get("dup_keys") for r in rows}["orders"] == 0
    with pytest.raises(LoadError, match="already"):
        wh.load_clean(run_id="r1")


def test_what_was_made_from_other_rows_is_written_again(spark, scratch, monkeypatch):
    export(f"{scratch}/in")
    wh = Warehouse(spark, f"{scratch}/wh", threads=1)
    wh.create_layers()
    wh.load_raw(source_dir=f"{scratch}/in")
    right = pipeline.CLEANERS[FAILS]
    monkeypatch.setitem(pipeline.CLEANERS, FAILS, lambda raw: 1 / 0)
    with pytest.raises(LoadError):
        wh.load_clean(run_id="r1")
    monkeypatch.setitem(pipeline.CLEANERS, FAILS, right)
    export(f"{scratch}/in2", tail="9")
    wh.load_raw(source_dir=f"{scratch}/in2")  # a newer raw layer
    rows = wh.load_clean(run_id="r1")
    assert {r["status"] for r in rows} == {"ok"}
    assert {r["customer_id"] for r in wh.table("clean", "customers").collect()} == {"19", "29"}


def test_raw_load_keeps_its_sequence(spark, scratch, monkeypatch):
    export(f"{scratch}/in")
    wh = Warehouse(spark, f"{scratch}/wh", threads=1)
    wh.create_layers()
    read = pipeline.read_raw_csv
    monkeypatch.setattr(pipeline, "read_raw_csv", lambda *a: 1 / 0 if a[2] == FAILS else read(*a))
    with pytest.raises(LoadError):
        wh.load_raw(source_dir=f"{scratch}/in", run_id="r1")
    monkeypatch.setattr(pipeline, "read_raw_csv", read)
    rows = wh.load_raw(source_dir=f"{scratch}/in", run_id="r1")
    assert sum(r["status"] == "resumed" for r in rows) == len(ENTITY_ORDER) - 1
    seqs = {r["s"] for e in ENTITY_ORDER for r in wh.table("raw", e).selectExpr("_ingest_pos.load_seq AS s").collect()}
    assert len(seqs) == 1
