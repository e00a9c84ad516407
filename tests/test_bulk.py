"""Bulk CSV files: order, numbering, defaults, fallbacks."""

import pytest

from changetide.sources import (
    as_rejects, bootstrap, bulk, csv_rejects, load_csv, load_shop_tables, replace_table, written,
)
from changetide.spec import ORDER_PRODUCTS, ORDERS, PRODUCTS
from changetide.streaming import ChangeLog, write_snapshot

from helpers import ITEMS


def write(path, header, lines):
    path.write_text("\n".join([header, *lines]) + "\n")


LINES = "order_id,product_id,add_to_cart_order,reordered"


def test_columns_by_name_with_defaults(spark, tmp_path):
    write(tmp_path / "orders.csv", "user_id,order_id,eval_set,unknown",
          ["7,1,prior,x", "8,2,,y"])
    rows = load_csv(spark, [str(tmp_path / "orders.csv")], ORDERS).orderBy("order_id").collect()
    assert [(r.order_id, r.user_id, r.eval_set, r.order_number, r.order_hour_of_day, r.status,
             r.days_since_prior) for r in rows] == [
        (1, 7, "prior", 1, 12, "completed", None), (2, 8, None, 1, 12, "completed", None)]


def test_quoted_text(spark, tmp_path):
    write(tmp_path / "products.csv", "product_id,product_name,aisle_id,department_id",
          ['1,"a ""good"" tea, green",3,4'])
    row = load_csv(spark, [str(tmp_path / "products.csv")], PRODUCTS).first()
    assert row.product_name == 'a "good" tea, green'


def test_a_bad_number_fails(spark, tmp_path):
    write(tmp_path / "products.csv", "product_id,product_name", ["one,tea"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_csv(spark, [str(tmp_path / "products.csv")], PRODUCTS).collect()


def test_the_limit_keeps_the_first_rows_in_file_order(spark, tmp_path):
    write(tmp_path / "orders.csv", "order_id,user_id", [f"{1000 - i},{i}" for i in range(500)])
    rows = load_csv(spark, [str(tmp_path / "orders.csv")], ORDERS, limit=120).collect()
    assert sorted(r.user_id for r in rows) == list(range(120))


def test_numbering_over_many_files_and_splits(spark, tmp_path):
    """Numbers follow the files' names and the lines in them, however the files are cut."""
    folder = tmp_path / "lines"
    folder.mkdir()
    for number, rows in enumerate([400, 1, 0, 250]):
        write(folder / f"part-{number}.csv", LINES, [f"{number},{i},1,0" for i in range(rows)])
    settings = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        loaded = load_csv(spark, [str(folder)], ORDER_PRODUCTS)
        rows = loaded.orderBy("id").collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    expected = [(n, i) for n, count in enumerate([400, 1, 0, 250]) for i in range(count)]
    assert [(r.order_id, r.product_id) for r in rows] == expected
    assert [r.id for r in rows] == list(range(1, 652))


@pytest.mark.parametrize("limit", [0, 1, 399, 400, 401, 500, 2000])
def test_the_limit_over_many_files_and_splits(spark, tmp_path, limit, monkeypatch):
    folder = tmp_path / "some orders"
    folder.mkdir()
    counts = [150, 250, 0, 90, 70]
    for number, rows in enumerate(counts):
        write(folder / f"part-{number}.csv", "order_id,user_id", [f"{i},{number}" for i in range(rows)])
    stored = []
    monkeypatch.setattr(bulk, "written", lambda frame, name: stored.append(frame) or written(frame, name))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = load_csv(spark, [str(folder)], ORDERS, limit).collect()
        kept = stored[0].count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [(number, i) for number, n in enumerate(counts) for i in range(n)][:limit]
    assert sorted((r.user_id, r.order_id) for r in rows) == expected
    assert kept <= limit + 100, "only splits that hold the first rows are stored"


def test_candidates_and_missing_files(spark, tmp_path):
    write(tmp_path / "order_products__train.csv", LINES, ["1,2,3,1"])
    write(tmp_path / "orders.csv", "order_id,user_id", [f"{i},1" for i in range(9)])
    tables = load_shop_tables(spark, str(tmp_path), limit=4)
    assert {name: rows.count() for name, rows in tables.items()} == {
        "orders": 4, "order_products": 1, "products": 0}
    assert tables["products"].columns == PRODUCTS.columns
    write(tmp_path / "order_products__prior.csv", LINES, [f"5,{i},1,0" for i in range(20)])
    lines = load_shop_tables(spark, str(tmp_path), limit=4)["order_products"]
    assert lines.count() == 12
    assert {r.order_id for r in lines.collect()} == {5}


def test_a_full_refresh_replaces(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (2,)], "k INT")
    replace_table(rows, str(tmp_path / "t"))
    replace_table(rows.filter("k = 1"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


# -- damaged files ------------------------------------------------------------------

DAMAGED = """k,v,more
1,10,a
2,x,b
3,30
none,40,d
,50,e
6,60,f,g,h
"7",70,"two
lines, quoted"
8,99999999999999,h
9,90,i
"""


def test_what_cannot_be_loaded_is_told_and_stops_nothing(spark, tmp_path):
    (tmp_path / "items.csv").write_text(DAMAGED)
    files = [str(tmp_path / "items.csv")]
    loaded = load_csv(spark, files, ITEMS, lenient=True)
    found = {(r.reason, r.column_name, r.value) for r in csv_rejects(spark, files, ITEMS).collect()}
    assert ("unreadable", "v", "x") in found and ("unreadable", "v", "99999999999999") in found
    assert ("malformed", None, "3,30") in found and ("malformed", None, "6,60,f,g,h") in found
    assert ("null_key", "k", '{"k":"none","v":"40","more":"d"}') in found
    assert ("null_key", "k", '{"v":"50","more":"e"}') in found
    assert {r.k: r.v for r in loaded.collect()}.items() >= {1: 10, 2: None, 8: None, 9: 90}.items()
    assert {3, 6, None}.isdisjoint(r.k for r in loaded.collect())


def test_limits_and_numbers_count_rows_that_are_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f"{i},{i}\n" if i % 3 else f"{i}\n" for i in range(30)))
    loaded = load_csv(spark, [str(tmp_path / "a.csv")], ITEMS, limit=7, lenient=True)
    assert [r.k for r in loaded.orderBy("k").collect()] == [1, 2, 4, 5, 7, 8, 10]
    (tmp_path / "b.csv").write_text("v\n" + "".join("1\n" if i % 4 else "1,2\n" for i in range(20)))
    numbered = load_csv(spark, [str(tmp_path / "b.csv")], ITEMS, lenient=True)
    assert sorted(r.k for r in numbered.collect()) == list(range(1, 16))
    assert csv_rejects(spark, [str(tmp_path / "none.csv")], ITEMS).count() == 0
    assert csv_rejects(spark, [str(tmp_path / "a.csv")], ITEMS).count() == 10


def test_rejects_of_a_load_stand_in_the_log(spark, tmp_path):
    (tmp_path / "items.csv").write_text(DAMAGED)
    files, root = [str(tmp_path / "items.csv")], str(tmp_path / "log")
    rows = bootstrap(load_csv(spark, files, ITEMS, lenient=True), ITEMS).unionByName(as_rejects(csv_rejects(spark, files, ITEMS), ITEMS))
    write_snapshot(rows, ITEMS, root)
    log = ChangeLog(spark, ITEMS, root)
    counts = {r.reason: r.n_messages for r in log.reject_summary().collect()}
    assert counts["null_key"] == 2 and counts["unreadable"] >= 2 and counts["malformed"] >= 2
    assert log.current().count() == load_csv(spark, files, ITEMS, lenient=True).count()
    assert "v: x" in {r.value for r in log.rejects().collect()}
    (tmp_path / "items.csv").write_text("k,v,more\n1,11,a\n")
    write_snapshot(bootstrap(load_csv(spark, files, ITEMS, lenient=True), ITEMS), ITEMS, root)     # a full refresh
    assert [tuple(r) for r in log.current().collect()] == [(1, 11)] and log.rejects().count() == 0
