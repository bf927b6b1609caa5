import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import numeric, text
from tidemark.operators import graph, relational as rel
from tidemark.sources import readers, schemas, writers


def one(spark, column, **values):
    names = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], names).select(column.alias("v")).first()["v"]


def test_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b c",), ("a",)], "value string")
    writers.write_lines(df, str(tmp_path / "t"), single=True)
    assert rows(readers.read_lines(spark, str(tmp_path / "t"))) == [("a",), ("b c",)]
    assert len(list((tmp_path / "t").glob("part-*"))) == 1


def test_json_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", 3, True), ("B", None, False)], schemas.SEARCH_LOG)
    writers.write_json(df, str(tmp_path / "j"))
    assert rows(readers.read_json(spark, str(tmp_path / "j"), schemas.SEARCH_LOG).na.fill(0)) == [("A", 3, True), ("B", 0, False)]
    day = spark.createDataFrame([("S1", dt.date(2020, 1, 2), 1.0, 2.0, 3.0, 4.5)], schemas.DAILY_MAX)
    writers.write_csv(day, str(tmp_path / "c"))
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), schemas.DAILY_MAX)) == rows(day)
    assert list((tmp_path / "c").glob("*.gz"))


def test_space_separated_pages_with_file_name(spark, tmp_path):
    path = tmp_path / "pagecounts-20160801-120000.txt"
    path.write_text('en "Quoted 5 10\nde Main_Page 7 20\n')
    df = readers.with_source_file(readers.read_csv(spark, str(path), schemas.PAGEVIEWS, sep=" ", quote=""))
    got = df.select("language", "title", "views", "bytes", text.hour_label("filename").alias("hour"))
    assert rows(got) == [("de", "Main_Page", 7, 20, "20160801-1200"), ("en", '"Quoted', 5, 10, "20160801-1200")]


def test_connector_table_view_and_append(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(10)
    writers.write_table(df, "parquet", 3, path)
    writers.write_table(df, "parquet", 2, path)
    assert readers.read_table(spark, "parquet", path).count() == 20
    assert readers.register_view(spark, "numbers", "parquet", {"path": path}).count() == 20
    assert spark.sql("select max(id) from numbers").first()[0] == 9


def test_split_write_keeps_every_row(spark, tmp_path):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "score int")
    yes, no = str(tmp_path / "y"), str(tmp_path / "n")
    writers.split_write(df, F.col("score") > 0, yes, no)
    assert spark.read.json(yes).count() == 1 and spark.read.text(no).count() == 2


def test_grid(spark):
    got = rows(readers.grid(spark, {"a": (0, 1, 3), "b": (-100, 100, 2)}))
    assert got == [(0.0, -100.0), (0.0, 100.0), (0.5, -100.0), (0.5, 100.0), (1.0, -100.0), (1.0, 100.0)]


def test_access_log_drops_other_lines(spark):
    lines = spark.createDataFrame([
        ('h1 - - [01/Aug/1995:00:00:07 -0400] "GET /a HTTP/1.0" 200 12',), ("garbage",),
        ('h1 - - [01/Aug/1995:00:00:07 -0400] "GET /a HTTP/1.0" 304 -',),
        ('h2 - - [99/Zzz/1995:00:00:07 -0400] "GET /b HTTP/1.0" 200 5',),
    ], "value string")
    got = rel.parse_access_log(lines).orderBy("host").collect()
    assert [tuple(r) for r in got] == [("h1", dt.datetime(1995, 8, 1, 0, 0, 7), "/a", 12), ("h2", None, "/b", 5)]


def test_word_count(spark):
    lines = spark.createDataFrame([("Don't stop, STOP!",), ("  ",), ("été a_b",)], "value string")
    got = [tuple(r) for r in rel.word_count(lines).collect()]
    assert got == [("a", 1), ("b", 1), ("don", 1), ("stop", 2), ("t", 1), ("été", 1)]


def test_small_text_functions(spark):
    assert one(spark, text.min_number("s"), s="in 2010 and 987") == 987
    assert one(spark, text.min_number("s"), s="none") is None
    assert one(spark, text.smallest_year("s", 1000, 2100), s="a 1999 b 20001 c 1987 9") == 1987
    assert one(spark, text.clean_text("s"), s="  jane\n DOE ") == "Jane Doe"
    assert one(spark, text.list_item("s", ",", 2), s="a, b ,c") == "b"
    assert one(spark, text.list_item("s", ",", 9), s="a, b ,c") is None
    assert one(spark, text.absolutise("s", F.lit("http://h")), s="/x") == "http://h/x"
    assert one(spark, text.absolutise("s", F.lit("http://h")), s="http://o/y") == "http://o/y"
    assert one(spark, text.parse_list("s"), s="[http, udt, 4]") == ["http", "udt", "4"]
    assert one(spark, text.parse_list("s"), s="[]") == []
    assert one(spark, text.concat_fields(["a", "b"]), a="x", b=None) == "x "
    assert one(spark, text.order_line(F.lit(3), F.lit(2.5), "s"), s="p, q") == "Order #3 $2.50: p, q"
    assert one(spark, numeric.jaccard(text.tokens("a"), text.tokens("b")), a="x y y", b="Y z") == 1 / 3
    assert one(spark, numeric.jaccard(text.tokens("a"), text.tokens("b")), a="", b="--") is None
    assert spark.range(1, 2).select(numeric.total(["id", "id"], 4.0).alias("v")).first()["v"] == 0.5


def test_adjacency_keeps_lonely_vertices(spark):
    edges, vertices = graph.parse_adjacency(spark.createDataFrame([("1: 3 5",), ("2:",), ("3: 1",)], "value string"))
    assert rows(edges) == [("1", "3"), ("1", "5"), ("3", "1")]
    assert rows(vertices) == [("1",), ("2",), ("3",), ("5",)]


def test_in_list_of_one_key(spark, tables):
    got = rel.orders_parts(tables.orders, tables.lineitem, tables.part, keys=[1])
    whole = rel.orders_parts(tables.orders, tables.lineitem, tables.part).where("o_orderkey = 1")
    assert rows(got) == rows(whole)


def test_uuid_is_distinct(spark):
    df = rel.with_uuid(spark.range(1000))
    assert df.select("id").distinct().count() == 1000


def test_head_of_union(spark):
    a, b = spark.range(3), spark.range(2, 5)
    assert rel.union_rows(a, b).count() == 6
    assert rows(rel.head_rows(rel.union_distinct(a, b), ["id"], 4)) == [(0,), (1,), (2,), (3,)]


def test_absolute_addresses(spark):
    page = "https://h.org/a/b/c.html?x=1#top"
    want = {
        "/x": "https://h.org/x", "//cdn.org/x": "https://cdn.org/x", "x": "https://h.org/a/b/x", "../x?q#f": "https://h.org/a/x?q#f",
        "./": "https://h.org/a/b/", "..": "https://h.org/a/", "../../../x": "https://h.org/x", "?q": "https://h.org/a/b/c.html?q",
        "#f": "https://h.org/a/b/c.html?x=1#f", "": "https://h.org/a/b/c.html?x=1", "mailto:a@b": "mailto:a@b", "HTTP://o/y": "HTTP://o/y",
    }
    for link, address in want.items():
        assert one(spark, text.absolutise("s", F.lit(page)), s=link) == address
