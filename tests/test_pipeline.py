"""Sources and sinks: CSV raw load, clean load, model build, append mode,
all-or-nothing publish, audit and checks."""

import os

import pytest

from strata.plans.pipeline import LoadError, Warehouse
from strata.sources.schemas import ENTITY_ORDER, RAW_COLUMNS, SOURCE_FILES

CSV = {
    "customers": ['c1,u1,1234,Sao Paulo,sp', 'c2,u1,01234,"Rio, de ""Janeiro""",RJ', ',u9,1,x,y', 'c3,u2,,"",mg'],
    "sellers": ['s1,100,a,sp', 's2,200,b,rj'],
    "geolocation": ['1234,-23.5,-46.6,sao paulo,SP', '1234,-23.5,-46.6,sao paulo,SP', ',,,,'],
    "orders": [
        'o1,c1,delivered,2018-03-05 10:00:00,2018-03-05 11:00:00,2018-03-06 10:00:00,2018-03-08 10:00:00,2018-03-10 00:00:00',
        'o2,c3,canceled,2018-03-04 10:00:00,,,,2018-03-20 00:00:00',
    ],
    "order_items": ['o1,1,p1,s1,2018-03-06 00:00:00,10.00,1.00', 'o1,2,p2,s2,2018-03-06 00:00:00,20.00,2.00'],
    "order_payments": ['o1,1,credit_card,3,30.00'],
    "order_reviews": ['r1,o1,5,,"multi\nline comment",2018-03-09 00:00:00,2018-03-10 00:00:00'],
    "products": ['p1,cat_a,10,100,1,500,10,10,10', 'p2,cat_b,x,100,1,500,10,10,10'],
    "category_translation": ['cat_a,A'],
}


def write_csv(folder, bad_row=False, long_row=False):
    os.makedirs(folder, exist_ok=True)
    for e in ENTITY_ORDER:
        lines = [",".join(RAW_COLUMNS[e])] + CSV[e]
        if bad_row and e == "sellers":
            lines.append("s3,only_two")
        if long_row and e == "products":
            lines.append("p9,cat,1,2,3,4,5,6,7,8")
        body = "\r\n".join(lines)
        with open(os.path.join(folder, SOURCE_FILES[e]), "wb") as f:
            f.write(("﻿" + body).encode("utf-8"))  # BOM, CRLF, no final newline


def test_run_all_overwrite_then_append(spark, scratch):
    src = os.path.join(scratch, "csv")
    write_csv(src)
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.run_all(source_dir=src)
    raw_c = {r["customer_id"]: r for r in wh.table("raw", "customers").collect()}
    assert raw_c["c2"]["customer_city"] == 'Rio, de "Janeiro"' and raw_c["c3"]["customer_city"] == ""
    assert raw_c["c3"]["customer_zip_code_prefix"] is None
    assert wh.table("raw", "order_reviews").first()["review_comment_message"] == "multi\nline comment"
    assert wh.table("clean", "customers").count() == 3
    assert wh.table("clean", "geolocation").count() == 2
    assert wh.table("model", "fact_orders").count() == 2
    assert wh.table("model", "fact_order_items").count() == 2
    assert wh.table("model", "dim_customer").count() == 2
    rec = {r["entity"]: r for r in wh.reconcile().collect()}
    assert rec["customers"]["raw_rows"] == 4 and rec["customers"]["dropped_rows"] == 1
    assert all(r["present"] for r in wh.check_objects().collect())
    audit = wh.audit().collect()
    ok = [r for r in audit if r["layer"] == "clean" and r["table"] == "customers"]
    assert ok and ok[0]["rows"] == 3 and ok[0]["null_keys"] == 0 and ok[0]["dup_keys"] == 0
    pre = [r for r in audit if r["layer"] == "clean-precheck" and r["table"] == "customers"]
    assert pre and pre[0]["null_keys"] == 1
    assert {r["section"] for r in audit if r["layer"] == "raw"} == {"CRM", "GEO", "ERP", "PIM"}

    # append: the raw rows arrive twice, the clean load re-inserts everything
    wh.load_raw(source_dir=src, mode="append")
    assert wh.table("raw", "sellers").count() == 4
    wh.load_clean(mode="append")
    assert wh.table("clean", "sellers").count() == 4
    # the model over an appended clean layer multiplies item totals as
    # join-then-group does: 2 copies of o1 x 2 copies of its customer x 4
    # item rows = 16; distinct order counts do not change
    before = {r["order_id"]: r["total_items"] for r in wh.table("model", "fact_orders").collect()}
    wh.build_model()
    after = {r["order_id"]: r["total_items"] for r in wh.table("model", "fact_orders").collect()}
    assert before["o1"] == 2 and after["o1"] == 16
    assert {r["customer_unique_id"]: r["total_orders"] for r in wh.table("model", "dim_customer").collect()} == {
        "u1": 1, "u2": 1}
    # overwrite again: back to one copy
    wh.load_clean(mode="overwrite")
    assert wh.table("clean", "sellers").count() == 2
    wh.build_model()
    views = wh.register_views()
    assert "clean_sellers" in views and "fact_orders" in views
    assert spark.sql("SELECT count(*) FROM fact_orders").first()[0] == 2
    written = sorted(map(tuple, spark.sql("SELECT * FROM fact_order_items").collect()))
    wh.register_model_views()  # same names, now computed from the clean layer on read
    assert sorted(map(tuple, spark.sql("SELECT * FROM fact_order_items").collect())) == written


def test_bad_row_fails_and_publishes_nothing(spark, scratch):
    src = os.path.join(scratch, "csv")
    write_csv(src, bad_row=True)
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    with pytest.raises(LoadError):
        wh.load_raw(source_dir=src)
    assert wh.runs("raw") == []
    failed = [r for r in wh.audit().collect() if r["status"] == "failed"]
    assert [r["table"] for r in failed] == ["sellers"]


def test_too_long_row_fails(spark, scratch):
    src = os.path.join(scratch, "csv")
    write_csv(src, long_row=True)
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    with pytest.raises(LoadError):
        wh.load_raw(source_dir=src)
    assert wh.runs("raw") == []


def test_command_line(spark, scratch, capsys):
    from strata.__main__ import main

    src = os.path.join(scratch, "csv")
    write_csv(src)
    root = os.path.join(scratch, "wh")
    assert main(["run-all", "--root", root, "--source", src]) == 0
    out = capsys.readouterr().out
    assert '"table": "fact_orders"' in out and '"status": "ok"' in out
    assert main(["check", "--root", root]) == 0


def test_split_export_parts(spark, scratch):
    src = os.path.join(scratch, "csv")
    write_csv(src)
    # replace the sellers export by two parts; the later part's row wins
    os.remove(os.path.join(src, SOURCE_FILES["sellers"]))
    header = ",".join(RAW_COLUMNS["sellers"])
    with open(os.path.join(src, "olist_sellers_dataset_0001.csv"), "w") as f:
        f.write(header + "\ns1,100,a,sp\ns2,200,b,rj\n")
    with open(os.path.join(src, "olist_sellers_dataset_0002.csv"), "w") as f:
        f.write(header + "\ns1,300,c,mg\n")
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    wh.load_raw(source_dir=src)
    assert wh.table("raw", "sellers").count() == 3
    wh.load_clean()
    got = {r["seller_id"]: r["seller_state"] for r in wh.table("clean", "sellers").collect()}
    assert got == {"s1": "MG", "s2": "RJ"}


def test_absent_run_raises(spark, scratch):
    """A published run whose folder is gone fails the read instead of
    shrinking the table."""
    src = os.path.join(scratch, "csv")
    write_csv(src)
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    wh.load_raw(source_dir=src)
    wh.publish_run("raw", "never-written", ["sellers"])
    assert wh.table("raw", "customers").count() == 4  # not in the lost run
    with pytest.raises(LoadError, match="absent"):
        wh.table("raw", "sellers")
    assert {r["table"]: r["present"] for r in wh.check_objects().collect() if r["layer"] == "raw"}["sellers"] is False
    # the failed key check is audited
    with pytest.raises(LoadError, match="key check"):
        wh.load_clean()
    failed = [r for r in wh.audit().collect() if r["layer"] == "clean-precheck" and r["status"] == "failed"]
    assert [r["table"] for r in failed] == ["sellers"] and "absent" in failed[0]["error"]


def test_lost_publication_is_raised_and_audited(spark, scratch):
    src = os.path.join(scratch, "csv")
    write_csv(src)
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    published = os.path.join(scratch, "wh", "raw", "_published")
    assert wh._create_text(published + "/1.json", "{}") is True
    assert wh._create_text(published + "/1.json", "other") is False  # another writer was first
    assert open(published + "/1.json").read() == "{}"
    assert not [n for n in os.listdir(published) if n.endswith(".tmp")]
    wh2 = Warehouse(spark, os.path.join(scratch, "wh2"))
    wh2._mkdirs(wh2.root + "/raw")
    open(wh2.root + "/raw/_published", "w").close()  # nothing can be created in it
    with pytest.raises(Exception):
        wh2._create_text(wh2.root + "/raw/_published/1.json", "{}")
    # a load that loses the race: its manifest number is taken meanwhile
    wh3 = Warehouse(spark, os.path.join(scratch, "wh3"))
    wh3.create_layers()
    wh3._create_text_kept, wh3._create_text = wh3._create_text, lambda p, text: False
    with pytest.raises(LoadError, match="published manifest"):
        wh3.load_raw(source_dir=src)
    lost = [r for r in wh3.audit().collect() if r["status"] == "failed"]
    assert [r["section"] for r in lost] == ["publish"]


def test_views_follow_publications(spark, scratch):
    src = os.path.join(scratch, "csv")
    write_csv(src)
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    wh.load_raw(source_dir=src)
    wh.load_clean()
    assert "clean_sellers" in wh.register_views()
    assert spark.sql("SELECT count(*) FROM raw_sellers").first()[0] == 2
    wh.load_raw(source_dir=src, mode="append")
    assert spark.sql("SELECT count(*) FROM raw_sellers").first()[0] == 4
    wh.register_model_views()
    assert spark.sql("SELECT count(*) FROM dim_seller").first()[0] == 2
    with open(os.path.join(src, SOURCE_FILES["sellers"]), "ab") as f:
        f.write(b"\r\ns3,300,c,mg")
    wh.load_raw(source_dir=src)
    wh.load_clean()
    assert spark.sql("SELECT count(*) FROM clean_sellers").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM dim_seller").first()[0] == 3


def test_old_runs_go_only_when_asked(spark, scratch):
    src = os.path.join(scratch, "csv")
    write_csv(src)
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    for _ in range(3):
        wh.load_raw(source_dir=src)
    folders = lambda: [n for n in os.listdir(os.path.join(scratch, "wh", "raw")) if n != "_published"]
    assert len(folders()) == 3
    removed = wh.expire_runs(keep=2)
    assert len(removed) == 1 and len(folders()) == 2
    wh.expire_runs(keep=1)
    assert folders() == wh.runs("raw") and wh.table("raw", "sellers").count() == 2
    wh.load_raw(source_dir=src, mode="append")
    wh.expire_runs(keep=1)
    assert wh.table("raw", "sellers").count() == 4  # both runs are in the newest manifest


def test_source_file_names_are_strict_and_parts_numbered(spark, scratch):
    src = os.path.join(scratch, "csv")
    write_csv(src)
    os.remove(os.path.join(src, SOURCE_FILES["sellers"]))
    header = ",".join(RAW_COLUMNS["sellers"])
    for name, city in (("_2.csv", "second"), ("_10.csv", "tenth"), ("_old.csv", "old"), (".csv.bak", "bak")):
        with open(os.path.join(src, "olist_sellers_dataset" + name), "w") as f:
            f.write(f"{header}\ns1,100,{city},sp\n")
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    wh.load_raw(source_dir=src)
    wh.load_clean()
    assert wh.table("raw", "sellers").count() == 2
    assert [r["seller_city"] for r in wh.table("clean", "sellers").collect()] == ["tenth"]


def test_split_file_is_read_by_several_tasks(spark, scratch):
    from strata.plans.silver import clean_sellers
    from strata.sources.csv_source import read_raw_csv
    from strata.sources.schemas import INGEST_POS

    path = os.path.join(scratch, "olist_sellers_dataset.csv")
    with open(path, "w") as f:
        f.write(",".join(RAW_COLUMNS["sellers"]) + "\n")
        f.writelines(f"s{i % 500},{i},\"city, {i}\",sp\n" for i in range(20_000))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        df = read_raw_csv(spark, path, "sellers", 1, multi_line=False)
        assert df.select(f"{INGEST_POS}.block").distinct().count() > 3
        got = {r["seller_id"]: r["seller_city"] for r in clean_sellers(df).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {f"s{i % 500}": f"city, {i}" for i in range(19_500, 20_000)}


def test_open_quote_refused_without_multi_line(spark, scratch):
    from strata.sources.csv_source import read_raw_csv

    path = os.path.join(scratch, "olist_sellers_dataset.csv")
    with open(path, "w") as f:
        f.write(",".join(RAW_COLUMNS["sellers"]) + '\ns1,1,"two\nlines,with,enough,commas",sp\n')
    with pytest.raises(ValueError, match="multi_line"):
        read_raw_csv(spark, path, "sellers", 1, multi_line=False)
    assert read_raw_csv(spark, path, "sellers", 1).count() == 1


def test_discarded_rows_by_reason(spark, scratch):
    src = os.path.join(scratch, "csv")
    write_csv(src)
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    wh.create_layers()
    wh.load_raw(source_dir=src)
    wh.load_raw(source_dir=src, mode="append")
    got = {r["entity"]: (r["raw_rows"], r["blank_key_rows"], r["duplicate_rows"]) for r in wh.discarded().collect()}
    assert got["customers"] == (8, 2, 3) and got["geolocation"] == (6, 0, 4) and got["sellers"] == (4, 0, 2)
