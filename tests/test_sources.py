import pytest
from pyspark.sql import SparkSession

from tallymart import schemas
from tallymart.plans import order_book
from tallymart.session import materialise, new_path, shared_dir
from tallymart.sources import readers, writers
from tests.conftest import rows


@pytest.fixture
def quoted(spark):
    data = [(1, 'Rings, 11"" x 14"'), (2, 'say "hi", twice'), (3, None), (4, "plain")]
    return spark.createDataFrame(data, "id int, label string")


def test_quotes_and_commas_survive_csv(spark, quoted):
    path = new_path(spark, "csv")
    writers.csv(quoted, path)
    assert rows(readers.csv(spark, path, "id int, label string")) == rows(quoted)
    assert readers.csv(spark, path).dtypes == [("id", "int"), ("label", "string")]


def test_line_breaks_and_blanks_survive_csv(spark):
    texts = spark.createDataFrame([(1, "two\nlines"), (2, ""), (3, None), (4, " blank ")], "id int, label string")
    path = new_path(spark, "csv")
    writers.csv(texts, path)
    read = rows(readers.csv(spark, path, "id int, label string", line_breaks=True))
    assert read == [(1, "two\nlines"), (2, None), (3, None), (4, " blank ")]


def test_doubled_quotes_in_a_feed_file(spark, tmp_path):
    file = tmp_path / "feed.csv"
    file.write_text('Row ID,Product Name,Sales\n1,"Binders, 11"" x 14-7/8""",13.0032\n2,Pens,2.5\n')
    assert rows(readers.csv(spark, str(file), "row_id int, name string, sales double")) == [
        (1, 'Binders, 11" x 14-7/8"', 13.0032),
        (2, "Pens", 2.5),
    ]


def test_rows_that_do_not_fit_are_kept_aside(spark, tmp_path):
    file = tmp_path / "rows.csv"
    file.write_text("id,qty\n1,5\n2,many\n")
    read = readers.csv(spark, str(file), "id int, qty int", keep_corrupt=True)
    assert rows(read.select("id", "qty", readers.CORRUPT)) == [(1, 5, None), (2, None, "2,many")]


def test_single_file_and_file_metadata(spark, quoted):
    path = new_path(spark, "csv")
    writers.csv(quoted.repartition(3), path, single_file=True)
    files = readers.file_metadata(spark, path).filter("path like '%/part-%'").collect()
    assert len(files) == 1 and files[0].length > 0 and files[0].modificationTime is not None


def test_copy_is_verified(spark, quoted):
    source, target = new_path(spark, "a"), new_path(spark, "b")
    writers.csv(quoted, source)
    assert tuple(writers.copy_csv(spark, source, target, "id int, label string").first()) == (4, 4, True)
    assert writers.fingerprint(quoted).first() != writers.fingerprint(quoted.filter("id > 1")).first()


def test_a_copy_keeps_cells_that_do_not_fit_and_sees_lost_ones(spark):
    raw = spark.createDataFrame([("1", "2.5"), ("abc", "not a number"), ("3", None)], "id string, price string")
    source, target, emptied = (new_path(spark, name) for name in "abc")
    schema = "id bigint, price double"
    writers.csv(raw, source)
    assert tuple(writers.copy_csv(spark, source, target, schema).first()) == (3, 3, True)
    assert rows(readers.csv(spark, target, "id string, price string")) == rows(raw)
    assert rows(writers.unfit_rows(spark, target, schema)) == [("abc", "not a number")]
    writers.csv(readers.csv(spark, source, schema), emptied)
    assert tuple(writers.compare_copies(spark, source, emptied, schema).first()) == (3, 3, False)


def test_append_checks_the_columns(spark, quoted):
    writers.replace_table(quoted, "labels_t", new_path(spark, "t"))
    writers.append_to_table(quoted.select("label", "id"), "labels_t")
    writers.append_rows(spark, "labels_t", [(9, "nine")])
    assert readers.table(spark, "labels_t").count() == 9
    with pytest.raises(ValueError):
        writers.append_to_table(quoted.withColumnRenamed("label", "other"), "labels_t")
    spark.sql("DROP TABLE labels_t")


def test_replacing_a_table_replaces_its_schema(spark, quoted):
    path = new_path(spark, "t")
    writers.replace_table(quoted, "wide_t", path)
    writers.replace_table(quoted.selectExpr("id", "label", "id * 2 as twice"), "wide_t", path)
    assert spark.table("wide_t").columns == ["id", "label", "twice"]
    spark.sql("DROP TABLE wide_t")


def test_load_several_tables(spark):
    folder = new_path(spark, "shop")
    for name, schema in schemas.RAW_SHOP.items():
        writers.csv(spark.createDataFrame([], schema), f"{folder}/{name}.csv")
    tables = readers.csv_tables(spark, folder, schemas.RAW_SHOP)
    assert list(tables) == ["customers", "products", "orders", "order_items"]
    assert readers.columns(tables["orders"], schemas.LOAD_COLUMNS["orders"]).columns == schemas.LOAD_COLUMNS["orders"]


def test_order_book_export(spark):
    data = [(1, 5, "p", "Electronics", "tv", 100.0, "99.5", 1200.0, 1, "North", "Low", "Completed", "2024-01-01"),
            (2, None, "p", "Home", "mat", 10.0, "free", 10.0, 1, "South", "High", "Pending", "2024-01-01")]
    book = spark.createDataFrame(data, schemas.ORDERS_V3)
    typed = order_book.with_tax(order_book.typed(book))
    assert [(r[0], r[1], round(r[2], 6)) for r in rows(typed.select("item_name", "price", "final_price"))] == [("mat", None, 11.8), ("tv", 99.5, 118.0)]
    folder = new_path(spark, "export")
    assert order_book.final_export(typed, folder).count() == 1
    assert readers.csv(spark, f"{folder}/final_orders_csv").count() == 1


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = materialise(spark.range(3).toDF("n"))
    assert stored.inputFiles()[0].startswith("file://" + shared_dir(spark))
    assert isinstance(spark, SparkSession)


def test_an_empty_report_is_saved_with_its_columns(spark, quoted):
    path = new_path(spark, "empty")
    writers.csv(quoted.filter("id > 100"), path, single_file=True)
    read = readers.csv(spark, path)
    assert read.columns == ["id", "label"] and read.isEmpty()
