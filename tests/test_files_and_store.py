"""CSV reading, the store, loads and routing on hand-made files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfline.plans import alerts, loading
from shelfline.operators.rules import keep_first
from shelfline.plans import validators
from shelfline.plans.refresh import published_mart, refresh_all_marts
from shelfline.schemas import DIM_PRODUCT, FACT_SALES
from shelfline.sources import files
from shelfline.sources.store import Store
from shelfline.star import Star
from shelfline.streaming.updates import stream_updates
from test_rules import DATE, PLAN, PRODUCT, SALE, STOCK

AS_OF = dt.date(2024, 12, 31)


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("_pos").collect()]


def test_read_csv_shapes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,name,x\n1,"a, b",N/A\n2,short\n\n3,too,many,"f,ields"\n4,"say ""hi""", pad \n', "utf-8-sig")
    df = files.read_csv(spark, path)
    assert rows(df, "id", "name", "x") == [("1", "a, b", None), ("2", "short", None), ("4", 'say "hi"', " pad ")]
    assert [r.line for r in files.overlong_lines(spark, path).collect()] == ['3,too,many,"f,ields"']


def test_read_csv_fallback_charset(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "old.csv", "id,name\n1,Книга\n", "cp1251")
    write(folder / "new.csv", "id,name\n2,Роман\n", "utf-8")
    got = files.read_csv(spark, str(folder)).select("id", "name").collect()
    assert sorted(map(tuple, got)) == [("1", "Книга"), ("2", "Роман")]


def test_read_csv_header_only(spark, tmp_path):
    df = files.read_csv(spark, write(tmp_path / "e.csv", "id,name\n"))
    assert df.columns == ["_pos", "id", "name"] and df.count() == 0


def test_read_csv_quoted_line_break(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'id,name\n1,"two\nlines"\n')
    assert rows(files.read_csv(spark, path, multiline=True), "id", "name") == [("1", "two\nlines")]


def test_cast_types(spark):
    df = spark.createDataFrame(
        [("9007199254740993", "2024-1-2", "2.0", "12.345"), ("x", "2024-02-30", "1e3", None), (None, None, "0x1A", "1_0")],
        "sales_id string, date string, sales_qty string, unit_price string")
    got = [tuple(map(str, r)) for r in files.cast_types(df, "fact_sales").collect()]
    assert got == [("9007199254740993", "2024-01-02", "2", "12.35"), ("None", "None", "1000", "None"), ("None",) * 4]


def test_split_with_empty_update(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "id int, date date")
    paths = files.split_history_update(df, str(tmp_path), "sales", dt.date(2024, 2, 1))
    assert files.read_csv(spark, paths["history"]).count() == 1
    update = files.read_csv(spark, paths["update"])
    assert update.count() == 0 and "date" in update.columns


def table_csv(folder, name, dicts, names):
    lines = [",".join(names)] + [",".join(d.get(n) or "" for n in names) for d in dicts]
    return write(folder / f"{name}.csv", "\n".join(lines) + "\n")


@pytest.fixture()
def sources(tmp_path):
    return {
        "dim_date": table_csv(tmp_path, "dim_date", [DATE, DATE | dict(date="2024-01-01", is_weekend="0")], list(DATE)),
        "dim_product": table_csv(tmp_path, "dim_product", [PRODUCT], DIM_PRODUCT.names),
        "fact_plan": table_csv(tmp_path, "fact_plan", [PLAN], list(PLAN)),
        "fact_sales": table_csv(tmp_path, "sales", [SALE, SALE | dict(sales_id="2", order_id="2")], FACT_SALES.names),
        "fact_inventory": table_csv(tmp_path, "stock", [STOCK | dict(closing_stock="4", sold_qty="16")], list(STOCK)),
    }


def test_historical_load_then_daily_update_and_stream(spark, tmp_path, sources):
    store = Store(spark, str(tmp_path / "store"))
    report = loading.historical_load(
        spark, store, sources, 1, as_of=AS_OF, work=str(tmp_path / "work"), marts=str(tmp_path / "marts"))
    assert {r.table_name: r.rows_loaded for r in report.summary.collect()} == {
        "dim_date": 2, "dim_product": 1, "fact_plan": 1, "fact_sales": 2, "fact_inventory": 1}

    star = store.star()
    assert star.today == dt.date(2024, 1, 1) and "genre" in star.sales.columns
    status = report.marts.collect()
    assert all(r.ok for r in status) and len(status) == 7
    assert spark.table("mart_daily_pulse").first().total_orders == 2
    assert spark.read.parquet(str(tmp_path / "marts/mart_inventory_alerts")).first().alert_level == "urgent"

    update = table_csv(tmp_path, "update", [
        SALE | dict(sales_id="2", order_id="9", date="2024-01-06"), SALE | dict(sales_id="3", order_id="12", date="2024-01-06")],
        FACT_SALES.names)
    stock = table_csv(tmp_path, "update_stock", [STOCK | dict(inventory_id="7"), STOCK | dict(inventory_id="8", date="2024-01-06")], list(STOCK))
    batches = {"fact_sales": files.read_csv(spark, update), "fact_inventory": files.read_csv(spark, stock)}
    first = loading.daily_update(spark, store, batches, str(tmp_path / "u1"), as_of=AS_OF)
    again = loading.daily_update(spark, store, batches, str(tmp_path / "u2"), as_of=AS_OF)
    assert (first.inserted["fact_sales"].inserted, first.inserted["fact_sales"].skipped) == (1, 1)
    assert first.inserted["fact_inventory"].inserted == 1 and first.existing == {"fact_sales": 0, "fact_inventory": 1}
    assert again.inserted["fact_sales"].inserted == 0 and again.existing["fact_sales"] == 1
    assert store.table("fact_sales").count() == 3 and store.star().today == dt.date(2024, 1, 6)

    incoming = tmp_path / "incoming"
    incoming.mkdir()
    table_csv(incoming, "one", [SALE | dict(sales_id="3"), SALE | dict(sales_id="4", order_id="10", date="2024-01-06")], FACT_SALES.names)
    for _ in range(2):
        stream_updates(spark, store, "fact_sales", str(incoming), str(tmp_path / "stream"), as_of=AS_OF).awaitTermination()
        assert store.table("fact_sales").count() == 4
        table_csv(incoming, "two", [SALE | dict(sales_id="4", order_id="11", date="2024-01-06")], FACT_SALES.names)


def test_first_row_of_a_repeated_key_is_inserted(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    sale = lambda i, q: (i, 1, 1, dt.date(2024, 1, 1), q)
    cols = "_pos bigint, sales_id bigint, order_id bigint, product_id bigint, date date, sales_qty int"
    products = spark.createDataFrame([(1,)], "product_id bigint")
    for name, kind in (("title", "string"), ("publisher", "string"), ("language", "string"), ("genre", "string"), ("format", "string"),
                       ("price_rub", "decimal(10,2)"), ("cost_rub", "decimal(10,2)"), ("avg_rating", "decimal(3,1)")):
        products = products.withColumn(name, F.lit(None).cast(kind))
    empty = spark.createDataFrame([], cols).drop("_pos")
    store.full_load({"dim_product": products, "fact_sales": empty}, 1)
    batch = spark.createDataFrame([(5, *sale(1, 50)), (2, *sale(1, 20)), (9, *sale(2, 7))], cols)
    assert store.insert_rows(batch, "fact_sales").inserted == 2
    assert {r.sales_id: r.sales_qty for r in store.table("fact_sales").collect()} == {1: 20, 2: 7}


def test_a_failed_load_leaves_the_published_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    good = spark.createDataFrame([(1,)], "product_id bigint")
    store.full_load({"dim_product": good}, 1)
    broken = good.select(F.raise_error(F.lit("stop")).cast("bigint").alias("product_id"))
    with pytest.raises(Exception):
        store.full_load({"dim_product": good.union(good), "fact_plan": broken}, 2)
    assert store.table("dim_product").count() == 1


def test_a_failing_mart_group_does_not_stop_the_rest(spark, tmp_path):
    def bad(star):
        raise ValueError("no such column")

    def good(star):
        return star.spark.range(3)

    status = refresh_all_marts(Star(spark), str(tmp_path), {"a": [bad], "b": [good]}).collect()
    assert [(r.mart_group, r.ok, r.error) for r in status] == [("a", False, "no such column"), ("b", True, None)]
    assert spark.read.parquet(str(tmp_path / "good")).count() == 3


def test_alert_routing(spark, tmp_path):
    found = spark.createDataFrame([(1, "critical"), (2, "urgent"), (3, "warning"), (4, "warning")], "product_id int, alert_level string")
    people = alerts.recipients(Star(spark), [("a@x", None, None), ("b@x", "B", ["critical"]), ("c@x", "C", [])])
    routed = alerts.alerts_for_recipients(found, people)
    log = alerts.alert_log(routed, AS_OF, dt.datetime(2024, 1, 1, 9, 30))
    for _ in range(2):
        files.append_log(log, str(tmp_path / "log"))
    lines = [json.loads(x) for p in (tmp_path / "log").glob("*.json") for x in p.read_text().splitlines()]
    assert sorted((x["recipient"], x["rows_sent"], x["warning"]) for x in lines) == [("a@x", 4, 2)] * 2 + [("b@x", 1, 0)] * 2
    assert all(x["success"] and x["error"] is None and x["ts"] == "2024-01-01T09:30:00" for x in lines)
    assert alerts.alert_subject(found, AS_OF).first()[0] == "[Stock] low stock: 1 critical, 1 urgent, 2 warning - 31.12.2024"
    warn = found.where("alert_level = 'warning'")
    assert [alerts.alert_gate(warn, level).first().send for level in ("warning", "urgent", "nonsense")] == [True, False, False]
    assert alerts.alert_gate(found, "nonsense").first().send
    assert not alerts.alert_gate(found.limit(0)).first().send


def test_loads_only_move_forward(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    product = spark.createDataFrame([(1, "t")], "product_id bigint, title string")
    store.full_load({"dim_product": product}, load_id=3)
    for old in (2, 3):
        with pytest.raises(ValueError):
            store.full_load({"dim_product": product.limit(0)}, load_id=old)
    assert store.table("dim_product").count() == 1 and store.latest_load() == 3


def test_first_row_follows_file_names(spark, tmp_path):
    (tmp_path / "day1.csv").write_text("id,name\n7,early\n")
    (tmp_path / "day2.csv").write_text("id,name\n" + "".join(f"{i},late\n" for i in range(4900)))
    (tmp_path / "day3.csv").write_bytes("id,name\n7,поздно\n".encode("cp1251"))
    kept = keep_first(files.read_csv(spark, str(tmp_path)), ["id"])
    assert [r.name for r in kept.where("id = '7'").collect()] == ["early"] and kept.count() == 4900


def test_overlong_lines_are_counted(spark, tmp_path):
    path = tmp_path / "plan.csv"
    path.write_text("plan_id,genre,format,year,month,plan_qty,plan_amount,plan_margin_target\n"
                    "1,Fiction,eBook,2024,1,1,1,0.5\n2,Fiction,eBook,2024,2,1,1,0.5,extra\n")
    checked = validators.validate_fact_plan(files.read_csv(spark, str(path), flag_overlong=True))
    summary = checked.summary().first()
    assert (summary.rows_received, summary.rows_rejected, summary.rows_loaded) == (2, 1, 1)
    assert [(r.code, r.n) for r in checked.details().collect()] == [("G-01", 1)]


def test_failed_group_keeps_its_marts(spark, tmp_path):
    def first(star):
        return star.spark.range(values["rows"])

    def second(star):
        if values["fail"]:
            raise RuntimeError("no")
        return star.spark.range(3)

    values = {"rows": 2, "fail": False}
    for values["rows"], values["fail"] in ((2, False), (5, True)):
        refresh_all_marts(Star(spark), str(tmp_path), {"g": [first, second]})
    assert published_mart(spark, str(tmp_path), "first").count() == 2
    assert published_mart(spark, str(tmp_path), "second").count() == 3


def test_alert_run_appends_and_reads_back(spark, tmp_path):
    found = spark.createDataFrame([(1, "critical"), (2, "warning"), (3, "warning")], "product_id bigint, alert_level string")
    people = alerts.recipients(Star(spark), [("a@x", "A", ["warning"]), ("b@x", "B", ["urgent"])])
    for expected in (1, 2):
        log = alerts.alert_run(found, people, AS_OF, str(tmp_path / "log"), "urgent")
        assert [(r.recipient, r.rows_sent) for r in log.collect()] == [("a@x", 2)] * expected
    quiet = found.where("alert_level = 'warning'")
    assert alerts.alert_run(quiet, people, AS_OF, str(tmp_path / "none"), "urgent").count() == 0


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", "sales_id,order_id,name\n1,10,x\n2,20,\"y, z\"\n")
    write(folder / "b.csv", "order_id,sales_id\n30,3\n40,4,5\n", "utf-8-sig")
    write(folder / "c.csv", "name,sales_id\r\nКнига,5\r\n\r\nТом,6\r\n", "cp1251")
    write(folder / "d.csv", "sales_id,order_id,name\n")
    df = files.read_csv(spark, str(folder))
    assert sorted(map(str, df.columns)) == ["_pos", "name", "order_id", "sales_id"]
    assert rows(df, "sales_id", "order_id", "name") == [
        ("1", "10", "x"), ("2", "20", "y, z"), ("3", "30", None), ("5", None, "Книга"), ("6", None, "Том")]
    marked = files.read_csv(spark, str(folder), flag_overlong=True)
    assert [r.sales_id for r in marked.where("_overlong").collect()] == ["4"]
    assert [r.line for r in files.overlong_lines(spark, str(folder)).collect()] == ["40,4,5"]


def test_stream_batch_of_files_with_swapped_headers(spark, tmp_path, sources):
    store = Store(spark, str(tmp_path / "store"))
    loading.historical_load(spark, store, sources, 1, as_of=AS_OF, work=str(tmp_path / "work"))
    incoming = tmp_path / "incoming"
    for fact in ("fact_sales", "fact_inventory"):
        (incoming / fact).mkdir(parents=True)
    new = dict(date="2024-01-06")
    table_csv(incoming / "fact_sales", "one", [SALE | new | dict(sales_id="31", order_id="41")], FACT_SALES.names)
    table_csv(incoming / "fact_sales", "two", [SALE | new | dict(sales_id="32", order_id="42")], FACT_SALES.names[::-1])
    table_csv(incoming / "fact_inventory", "three", [STOCK | new | dict(inventory_id="33")], list(STOCK)[::-1])
    for _ in range(2):
        stream_updates(spark, store, None, str(incoming), str(tmp_path / "stream"), as_of=AS_OF).awaitTermination()
    got = {r.sales_id: r.order_id for r in store.table("fact_sales").where("sales_id > 30").collect()}
    assert got == {31: 41, 32: 42} and store.table("fact_inventory").where("inventory_id = 33").count() == 1
    # one micro-batch, one commit
    assert len({e["commit"] for e in store._log() if e.batch}) == 1


def test_quoted_line_breaks_across_splits(spark, tmp_path):
    """A file cut into many splits within its quoted fields reads as in one piece."""
    lines, expected = ["id,name,note"], []
    for i in range(3000):
        note = ["plain", "two\nlines", 'a ""quote""\n\n\nand more', "", "x" * 50 + "\r\n" + "y" * 70][i % 5]
        lines.append(f'{i},n{i},"{note}"')
        expected.append((str(i), f"n{i}", note.replace('""', '"') or None))
    path = write(tmp_path / "long.csv", "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = files.read_csv(spark, path, multiline=True)
        got = [tuple(r) for r in df.orderBy(F.col("id").cast("int")).select("id", "name", "note").collect()]
        in_order = [r.id for r in df.orderBy("_pos").select("id").collect()]
        splits = files._lines(spark, path).select("block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert splits > 50 and got == expected and in_order == [r[0] for r in expected]
    single = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    assert sorted(map(tuple, single.collect())) == sorted(expected)
