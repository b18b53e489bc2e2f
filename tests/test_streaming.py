"""Incremental raw load: new files only, replay-safe."""

import os

from strata.plans.pipeline import Warehouse
from strata.streaming import start_raw_stream


def _write(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + "\n".join(rows) + "\n")


def test_stream_appends_new_files_once(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    ckpt = os.path.join(scratch, "stream-ckpt")
    _write(os.path.join(landing, "a.csv"), ["s1,1,a,sp", "s2,2,b,rj"])
    start_raw_stream(spark, wh, "sellers", landing, ckpt, "landing").awaitTermination()
    assert wh.table("raw", "sellers").count() == 2
    # nothing new: a rerun adds nothing
    start_raw_stream(spark, wh, "sellers", landing, ckpt, "landing").awaitTermination()
    assert wh.table("raw", "sellers").count() == 2
    _write(os.path.join(landing, "b.csv"), ["s1,9,z,mg"])
    start_raw_stream(spark, wh, "sellers", landing, ckpt, "landing").awaitTermination()
    raw = wh.table("raw", "sellers")
    assert raw.count() == 3
    from strata.plans.silver import clean_sellers

    got = {r["seller_id"]: r["seller_state"] for r in clean_sellers(raw).collect()}
    assert got == {"s1": "MG", "s2": "RJ"}  # the later batch is the more recent row
    streamed = [r for r in wh.audit().collect() if r["run_id"].startswith("stream-landing-")]
    assert sorted(r["rows"] for r in streamed) == [1, 2] and all(r["status"] == "ok" for r in streamed)


def test_new_checkpoint_keeps_the_old_runs(spark, scratch):
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    for name, row in (("a", "s1,1,a,sp"), ("b", "s2,2,b,rj")):
        landing = os.path.join(scratch, "landing-" + name)
        os.makedirs(landing)
        _write(os.path.join(landing, "x.csv"), [row])
        start_raw_stream(spark, wh, "sellers", landing, os.path.join(scratch, "ckpt-" + name), "landing").awaitTermination()
    assert {r["seller_id"] for r in wh.table("raw", "sellers").collect()} == {"s1", "s2"}


def test_streamed_row_is_newer_than_an_earlier_batch_load(spark, scratch):
    from strata.plans.silver import clean_sellers
    from strata.sources.csv_source import read_raw_csv
    from strata.sources.schemas import ENTITY_ORDER
    from tests.fixtures import empty_raw

    import time

    source = os.path.join(scratch, "olist_sellers_dataset.csv")
    _write(source, ["s1,1,a,sp"])
    frames = {e: empty_raw(spark, e) for e in ENTITY_ORDER}
    frames["sellers"] = read_raw_csv(spark, source, "sellers", time.time_ns())
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    wh.load_raw(frames=frames)
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    _write(os.path.join(landing, "later.csv"), ["s1,9,z,mg"])
    start_raw_stream(spark, wh, "sellers", landing, os.path.join(scratch, "ckpt"), "landing").awaitTermination()
    assert [r["seller_state"] for r in clean_sellers(wh.table("raw", "sellers")).collect()] == ["MG"]


def test_replayed_batch_is_not_loaded_twice(spark, scratch):
    """The stream's commit of its last batch is lost: it replays the batch."""
    landing, ckpt = os.path.join(scratch, "landing"), os.path.join(scratch, "ckpt")
    os.makedirs(landing)
    _write(os.path.join(landing, "x.csv"), ["s1,1,a,sp"])
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    start_raw_stream(spark, wh, "sellers", landing, ckpt, "landing").awaitTermination()
    for name in os.listdir(os.path.join(ckpt, "commits")):
        os.remove(os.path.join(ckpt, "commits", name))
    start_raw_stream(spark, wh, "sellers", landing, ckpt, "landing").awaitTermination()
    assert wh.table("raw", "sellers").count() == 1 and len(wh.runs("raw")) == 1
