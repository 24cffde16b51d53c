from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotativa.operators import partitions, reports, schemas
from rotativa.plans.headlines import process_pages, refresh_catalog
from rotativa.schema import HEADLINES
from rotativa.session import new_folder, shared_folder
from rotativa.sinks.files import with_partition_columns, write_headline_files, write_headline_table
from rotativa.sources.headlines import read_headline_files
from rotativa.sources.pages import decode_pages, land_pages, read_page_files, readable_pages, rejected_pages


def headline_rows(spark, *rows):
    return spark.createDataFrame(rows, HEADLINES)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def test_shared_folder_comes_from_the_session(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_working_tables_lie_where_executors_see_them(spark, monkeypatch):
    from rotativa import session

    def folder(**settings):
        class Conf:
            get = staticmethod(lambda key, default=None: settings.get(key.replace(".", "_"), default))

        class Session:
            conf = Conf()

        return session.shared_folder(Session())

    assert folder(spark_checkpoint_dir="hdfs://shared/", spark_sql_warehouse_dir="w") == "hdfs://shared"
    assert folder(spark_sql_warehouse_dir="hdfs://warehouse") == "hdfs://warehouse/_working"


def test_working_tables_are_removed(spark):
    from rotativa import session

    table = session.stored(spark.range(5).groupBy().count(), "some")
    assert table.first()[0] == 5 and session.folder_exists(spark, table.working_folder)
    session.discard(table)
    assert not session.folder_exists(spark, table.working_folder)



def test_text_survives_headline_files(spark, tmp_path):
    rows = [
        ("2024-01-15", "a, b", 'dice "hola", y', "/x", "eltiempo", "2024", "01", "15"),
        ("2024-01-15", None, "dos\nlíneas", "", "eltiempo", "2024", "01", "15"),
        ("2024-01-16", "", "  espacios  ", None, "elespectador", "2024", "01", "16"),
        ("2024-01-16", "back\\slash", "'", "#", "elespectador", "2024", "01", "16"),
    ]
    write_headline_files(headline_rows(spark, *rows), str(tmp_path / "out"))
    expected = [tuple(value or None for value in row) for row in rows]  # empty text reads as NULL
    assert sorted(map(tuple, read_headline_files(spark, str(tmp_path / "out")).collect()), key=repr) == sorted(expected, key=repr)
    assert (tmp_path / "out" / "periodico=eltiempo" / "year=2024" / "month=01" / "day=15").is_dir()


def test_four_and_five_column_files_read_alike(spark, tmp_path):
    write(tmp_path / "periodico=a/year=2024/month=01/day=02/x.csv", 'fecha,categoria,titular,enlace\n2024-01-02,C,"T, 1",/x\n')
    write(tmp_path / "periodico=b/year=2024/month=1/day=3/y.csv", "fecha,categoria,titular,enlace,periodico\n2024-01-03,C,T2,/y,b\n")
    write(tmp_path / "periodico=b/year=2024/month=1/day=4/empty.csv", "fecha,categoria,titular,enlace\n")
    found = sorted(map(tuple, read_headline_files(spark, str(tmp_path)).collect()))
    assert found == [
        ("2024-01-02", "C", "T, 1", "/x", "a", "2024", "01", "02"),
        ("2024-01-03", "C", "T2", "/y", "b", "2024", "1", "3"),
    ]
    rows = read_headline_files(spark, str(tmp_path))
    assert reports.partition_rows(rows, "b", 2024, 1, 3).collect() == reports.partition_rows(rows, "b", "2024", "01", "03").collect()
    assert reports.partition_rows(rows, "b", 2024, 1, 3).count() == 1


@pytest.mark.parametrize("writer", [write_headline_files, write_headline_table])
def test_a_repeated_day_is_replaced(spark, tmp_path, writer):
    out = str(tmp_path / "out")
    first = [("2024-01-15", "C", f"t{i}", "/x", "eltiempo", "2024", "01", "15") for i in range(3)]
    other = [("2024-01-16", "C", "u", "/x", "eltiempo", "2024", "01", "16")]
    writer(headline_rows(spark, *first, *other), out)
    writer(headline_rows(spark, *first[:1]), out)
    reader = spark.read.schema(HEADLINES)
    rows = read_headline_files(spark, out) if writer is write_headline_files else reader.parquet(out)
    assert sorted(r.titular for r in rows.collect()) == ["t0", "u"]


def test_partition_predicates_prune_folders(spark, tmp_path):
    out = str(tmp_path / "out")
    write_headline_table(headline_rows(spark, ("2024-01-15", "C", "t", "/x", "a", "2024", "01", "15")), out)
    rows = reports.partition_rows(spark.read.schema(HEADLINES).parquet(out), "a", 2024, 1, 15)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(periodico" in plan
    assert "DataFilters: []" in plan and "Filter (" not in plan  # the folders decide everything
    assert rows.count() == 1


def test_a_large_partition_is_split_over_files(spark, tmp_path):
    out = tmp_path / "out"
    rows = spark.range(1000).select(
        F.lit("2024-01-15").alias("fecha"), F.lit("c").alias("categoria"), F.col("id").cast("string").alias("titular"), F.lit("").alias("enlace"), F.lit("a").alias("periodico")
    )
    write_headline_files(with_partition_columns(rows), str(out), rows_per_file=100)
    assert len(list(out.rglob("*.csv"))) >= 10
    assert read_headline_files(spark, str(out)).count() == 1000


def test_page_files(spark, tmp_path):
    write(tmp_path / "raw/eltiempo-2024-01-15.html", "<h1>día</h1>")
    write(tmp_path / "raw/sub/elespectador-2024-01-16.HTML", "<h1>x</h1>")
    write(tmp_path / "raw/elespectador-2024-01-17.html", b"\xff\xfe malo")
    write(tmp_path / "raw/eltiempo-2024-01-18.html", "")
    write(tmp_path / "raw/notas.txt", "no")
    files = read_page_files(spark, str(tmp_path / "raw"))
    assert files.count() == 3  # a file without any byte is not listed
    assert read_page_files(spark, str(tmp_path / "raw"), ignore_case=False).count() == 2
    pages = decode_pages(files)
    assert {(r.source, str(r.fetch_date), r.html) for r in readable_pages(pages).collect()} == {
        ("eltiempo", "2024-01-15", "<h1>día</h1>"),
        ("elespectador", "2024-01-16", "<h1>x</h1>"),
    }
    assert {tuple(r) for r in rejected_pages(pages).collect()} == {("eltiempo", 1, 0), ("elespectador", 2, 1)}
    land_pages(readable_pages(pages), str(tmp_path / "landed"))
    land_pages(readable_pages(pages), str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    assert landed.count() == 2
    assert set(landed.columns) == {"path", "source", "fetch_date", "html"}


def test_pages_to_catalog(spark, tmp_path):
    """Landed pages become files, the files a table, the table answers queries."""
    for day in (15, 16):
        write(
            tmp_path / f"raw/eltiempo-2024-01-{day}.html",
            f'<article class="c-articulo"><h2 class="c-articulo__titulo"><a class="c-articulo__titulo__txt" href="/n{day}">Noticia del día {day}</a></h2></article>',
        )
    write(tmp_path / "raw/otro-2024-01-15.html", "<p>nada</p>")
    out = str(tmp_path / "final")
    process_pages(spark, str(tmp_path / "raw"), out, "2024-02-01")
    process_pages(spark, str(tmp_path / "raw"), out, "2024-02-01")
    table = refresh_catalog(spark, "noticias_db", out)
    assert {(r.titular, r.periodico, r.day) for r in table.collect()} == {
        ("Noticia del día 15", "eltiempo", "15"),
        ("Noticia del día 16", "eltiempo", "16"),
    }
    registered = partitions.registered_partitions(spark, "noticias_db", "headlines")
    assert {tuple(r) for r in registered.collect()} == {("eltiempo", "2024", "01", "15"), ("eltiempo", "2024", "01", "16")}

    found = partitions.partitions_found(partitions.list_files(spark, out, "*.csv"))
    assert partitions.partitions_missing(found, registered).count() == 0
    write(tmp_path / "final/periodico=b/year=2024/month=02/day=01/x.csv", "fecha,categoria,titular,enlace\n2024-02-01,C,T,/x\n")
    found = partitions.partitions_found(partitions.list_files(spark, out, "*.csv"))
    assert [tuple(r) for r in partitions.partitions_missing(found, registered).collect()] == [("b", "2024", "02", "01")]
    partitions.repair_partitions(spark, "noticias_db", "headlines")
    assert spark.table("noticias_db.headlines").count() == 3
    inventory = partitions.partition_inventory(partitions.list_files(spark, out, "*.csv"))
    assert inventory.agg(F.sum("files")).first()[0] == 3

    partitions.recreate_table(spark, "noticias_db", "periodico_b", out)
    partitions.drop_stray_tables(spark, "noticias_db", ["periodico_b", "no_such_table"])
    assert [t.name for t in spark.catalog.listTables("noticias_db")] == ["headlines"]
    assert partitions.registered_partitions(spark, "noticias_db", "no_such_table").count() == 0


def test_registration_lists_nothing(spark, tmp_path, monkeypatch):
    """Partitions are added by difference, in batches, with values that need quoting; the dataset is not looked at."""
    root = tmp_path / "final"
    partitions.ensure_database(spark, "registering")
    partitions.recreate_table(spark, "registering", "headlines", str(root))
    asked = []
    run = spark.sql
    monkeypatch.setattr(spark, "sql", lambda text, *rest, **more: asked.append(text) or run(text, *rest, **more))
    monkeypatch.setattr(partitions, "list_files", None)
    rows = [("a", "2024", "01", f"{day:02d}") for day in range(1, 8)] + [("o'b", "2024", "1", "5=x"), ("c+d", "2024", "01", "01"), ("", "2024", "01", "01")]
    found = spark.createDataFrame(rows + rows[:2], "periodico STRING, year STRING, month STRING, day STRING")
    assert partitions.register_partitions(spark, "registering", "headlines", found, at_once=4) == 9
    assert sum("ADD IF NOT EXISTS" in text for text in asked) == 3 and not any("MSCK" in text for text in asked)
    held = {tuple(r) for r in partitions.registered_partitions(spark, "registering", "headlines").collect()}
    assert held == set(rows[:-1])
    assert partitions.register_partitions(spark, "registering", "headlines", found) == 0
    run("DROP DATABASE registering CASCADE")


def test_common_types(spark):
    def common(one, other):
        a, b = (T.StructType.fromDDL(f"x {t}") for t in (one, other))
        return schemas.merged_schema([a, b])["x"].dataType.simpleString()

    assert common("int", "bigint") == common("bigint", "smallint") == "bigint"
    assert common("bigint", "float") == common("float", "double") == "double"
    assert common("decimal(10,2)", "int") == "decimal(12,2)" and common("decimal(38,0)", "decimal(38,9)") == "double"
    assert common("date", "timestamp_ntz") == "timestamp_ntz" and common("timestamp", "date") == "timestamp"
    assert common("date", "string") == common("boolean", "int") == "string"
    assert common("struct<a:int>", "struct<b:string,A:bigint>") == "struct<A:bigint,b:string>"
    assert common("array<struct<a:int>>", "array<struct<a:string>>") == "array<struct<a:string>>"
    assert common("map<string,int>", "map<string,double>") == "map<string,double>"
    for other in ("int", "string", "array<int>"):
        with pytest.raises(schemas.NoCommonType):
            common("struct<a:int>", other)


def test_files_of_several_layouts(spark, tmp_path):
    root = str(tmp_path / "t")

    def write(part, schema, *rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/p={part}")

    write(1, "k INT, d DATE, s STRUCT<a: INT>, xs ARRAY<INT>", (1, dt.date(2024, 1, 2), (5,), [1, 2]), (None, None, None, None))
    write(2, "k BIGINT, d STRING, s STRUCT<b: STRING, a: INT>, extra FLOAT", (1 << 40, "soon", ("x", 6), 0.5))
    write(3, "K BIGINT, m MAP<STRING, INT>", (7, {"q": 1}))
    write(3, "k BIGINT, m MAP<STRING, BIGINT>, xs ARRAY<STRING>", (8, {"q": 2}, ["z"]))
    files = partitions.list_files(spark, root, "*.parquet")
    rows = schemas.read_reconciled(spark, root, files)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    assert kinds == {
        "K": "bigint", "d": "string", "s": "struct<a:int,b:string>", "xs": "array<string>", "extra": "float", "m": "map<string,bigint>", "p": "int"
    }
    found = {r.K: r.asDict(True) for r in rows.collect()}
    assert found[1] == {"K": 1, "d": "2024-01-02", "s": {"a": 5, "b": None}, "xs": ["1", "2"], "extra": None, "m": None, "p": 1}
    assert found[1 << 40] == {"K": 1 << 40, "d": "soon", "s": {"a": 6, "b": "x"}, "xs": None, "extra": 0.5, "m": None, "p": 2}
    assert found[None]["s"] is None and found[None]["xs"] is None and found[None]["p"] == 1
    assert (found[7]["m"], found[8]["m"], found[8]["xs"], found[7]["d"]) == ({"q": 1}, {"q": 2}, ["z"], None)
    assert rows.where("p = 3 AND k > 7").count() == 1
    with pytest.raises(ValueError):
        schemas.read_reconciled(spark, root, files.limit(0))


def test_layouts_that_the_reader_widens_have_one_scan(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(3).selectExpr("CAST(id AS INT) AS k", "struct(id AS a) AS s").write.parquet(f"{root}/p=1")
    spark.range(5, 9).selectExpr("id AS k", "struct(id AS a, 'x' AS b) AS s").write.parquet(f"{root}/p=2")
    rows = schemas.read_reconciled(spark, root, partitions.list_files(spark, root, "*.parquet"))
    plan = rows.where("k > 6")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "GreaterThan(k,6)" in plan
    assert sorted(r.k for r in rows.collect()) == [0, 1, 2, 5, 6, 7, 8]
