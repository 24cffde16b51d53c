from __future__ import annotations

import datetime as dt

import pytest

from rotativa.operators.dedupe import absent_from, one_per_sink_key
from rotativa.operators.clean import valid_rows
from rotativa.plans.headlines import batch_counts, follow_announced, follow_pages, process_pages, refresh_catalog
from rotativa.schema import HEADLINES, NEWS
from rotativa.sinks.files import write_headline_files
from rotativa.sources.pages import decode_pages
from rotativa.streaming import incremental, ingest, manifest, repeats, summary


def rows_of(spark, day, *titles):
    rows = [(f"2024-01-{day:02d}", "C", title, f"/{day}/{i}", "eltiempo", "2024", "01", f"{day:02d}") for i, title in enumerate(titles)]
    return spark.createDataFrame(rows, HEADLINES)


@pytest.fixture
def loader(spark, tmp_path):
    class Loader:
        landing, target = str(tmp_path / "landing"), str(tmp_path / "target")

        def land(self, rows):
            write_headline_files(rows, self.landing)

        def run(self, checkpoint="checkpoint"):
            arriving = ingest.arriving_headline_files(spark, self.landing)
            incremental.load_new_headlines(arriving, self.target, str(tmp_path / checkpoint)).awaitTermination()

        def titles(self):
            return sorted((r.titular, int(r.load.rpartition("-")[2])) for r in incremental.stored_rows(spark, self.target).collect())

    return Loader()


def test_incremental_load(spark, loader):
    loader.land(rows_of(spark, 1, "Uno", "Dos", "uno", ""))
    loader.run()
    assert loader.titles() == [("Dos", 0), ("Uno", 0)]
    loader.run()
    assert loader.titles() == [("Dos", 0), ("Uno", 0)]
    loader.land(rows_of(spark, 2, "Uno", "Tres").unionByName(rows_of(spark, 1, "DOS", "Cuatro")))
    loader.run()
    assert loader.titles() == [("Cuatro", 1), ("Dos", 0), ("Tres", 1), ("Uno", 0), ("Uno", 1)]


def test_incremental_equals_full_load(spark, loader):
    days = [rows_of(spark, day, *[f"Título {(day * i) % 7}" for i in range(20)]) for day in (1, 2, 3)]
    for day in days:
        loader.land(day)
        loader.run()
    full = one_per_sink_key(valid_rows(days[0].unionByName(days[1]).unionByName(days[2])))
    loaded = incremental.stored_rows(spark, loader.target).drop("load")
    assert sorted(map(tuple, loaded.select(*NEWS.names).collect())) == sorted(map(tuple, full.select(*NEWS.names).collect()))


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    target = str(tmp_path / "target")
    incremental.append_new_rows(rows_of(spark, 1, "Uno", "Dos"), "a-0", target)
    incremental.append_new_rows(rows_of(spark, 1, "Dos", "Tres"), "a-1", target)
    incremental.append_new_rows(rows_of(spark, 1, "Dos", "Tres"), "a-1", target)
    assert sorted(r.titular for r in incremental.stored_rows(spark, target).collect()) == ["Dos", "Tres", "Uno"]


def test_a_lost_checkpoint_loses_and_repeats_no_row(spark, loader):
    loader.land(rows_of(spark, 1, "Uno"))
    loader.run()
    loader.land(rows_of(spark, 2, "Dos"))
    loader.run()
    loader.run("another")  # reads both days again
    loader.land(rows_of(spark, 3, "Dos", "Tres"))
    loader.run("another")
    assert [title for title, _ in loader.titles()] == ["Dos", "Dos", "Tres", "Uno"]
    rows = incremental.stored_rows(spark, loader.target)
    assert rows.count() == rows.select("fecha", "titular").distinct().count() == 4


def test_loads_are_compacted_by_date(spark, tmp_path):
    target = str(tmp_path / "target")

    def files(pattern):
        return {str(p.relative_to(target)): p.stat().st_mtime_ns for p in (tmp_path / "target").glob(pattern + "/**/*.parquet")}

    def titles():
        return sorted((r.fecha.day, r.titular, r.load) for r in incremental.stored_rows(spark, target).collect())

    assert incremental.compact_loads(spark, target) == 0 and titles() == []
    incremental.append_new_rows(rows_of(spark, 1, "Uno", "Dos").unionByName(rows_of(spark, 2, "Cinco")), "a-0", target)
    incremental.append_new_rows(rows_of(spark, 1, "Dos", "Tres"), "a-1", target)
    expected = [(1, "Dos", "a-0"), (1, "Tres", "a-1"), (1, "Uno", "a-0"), (2, "Cinco", "a-0")]
    began = incremental.stored_rows(spark, target)
    assert incremental.compact_loads(spark, target) == 2 and titles() == expected
    assert sorted(r.titular for r in began.collect()) == ["Cinco", "Dos", "Tres", "Uno"]  # a reader from before the swap
    assert len(files("merged=1/fecha=2024-01-01")) == 1 and incremental.compact_loads(spark, target) == 0
    untouched = files("merged=1/fecha=2024-01-02")
    incremental.append_new_rows(rows_of(spark, 1, "Dos", "Tres"), "a-1", target)  # a compacted load once more
    assert titles() == expected
    incremental.append_new_rows(rows_of(spark, 1, "tres", "Cuatro"), "b-0", target)
    incremental.append_new_rows(rows_of(spark, 3, "Seis"), "b-1", target)
    expected = sorted([*expected, (1, "Cuatro", "b-0"), (3, "Seis", "b-1")])
    assert titles() == expected
    assert incremental.compact_loads(spark, target) == 2 and titles() == expected
    assert files("merged=2/fecha=2024-01-02") == {} and files("merged=1/fecha=2024-01-02") == untouched
    assert files("open=0") == {}  # retired by the compaction before
    incremental.append_new_rows(rows_of(spark, 1, "Siete"), "b-2", target)
    assert incremental.compact_loads(spark, target) == 1 and files("merged=1/fecha=2024-01-01") == {}
    assert titles() == sorted([*expected, (1, "Siete", "b-2")])


def test_a_compaction_that_lost_the_race_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "target")
    incremental.append_new_rows(rows_of(spark, 1, "Uno"), "a-0", target)
    manifest.swap_manifest(spark, target, manifest.Manifest(1, {}))
    with pytest.raises(RuntimeError):
        manifest.swap_manifest(spark, target, manifest.Manifest(1, {"2024-01-01": 1}))
    assert manifest.read_manifest(spark, target) == manifest.Manifest(1, {})
    assert [p.name for p in (tmp_path / "target" / "_manifest").glob("*")  if not p.name.startswith(".")] == ["1.json"]


def test_only_arriving_dates_of_the_target_are_read(spark, tmp_path):
    target = str(tmp_path / "target")
    incremental.append_new_rows(rows_of(spark, 1, "Uno").unionByName(rows_of(spark, 9, "Nueve")), "a-0", target)
    held = incremental.stored_rows(spark, target)
    incoming = valid_rows(rows_of(spark, 9, "Nueve", "Diez"))
    plan = absent_from(incoming, held)._jdf.queryExecution().executedPlan().toString()
    partition_filters = [line for line in plan.splitlines() if "FileScan parquet" in line and "PartitionFilters: [isnotnull(fecha" in line]
    assert partition_filters, plan
    assert [r.titular for r in absent_from(incoming, held).collect()] == ["Diez"]


def test_running_summary(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "fecha DATE, periodico STRING, categoria STRING"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        arriving = ingest.arriving_table(spark, source, spark.createDataFrame([], schema).schema)
        summary.keep_summary(summary.running_counts(arriving), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return {tuple(r) for r in summary.latest_summary(spark, str(tmp_path / "out")).collect()}

    day = dt.date(2024, 1, 1)
    assert arrive((day, "a", "x"), (day, "a", "x"), (day, "b", None)) == {(day, "a", "x", 2), (day, "b", None, 1)}
    assert arrive((day, "a", "x"), (day, "a", "y")) == {(day, "a", "x", 3), (day, "a", "y", 1), (day, "b", None, 1)}
    timed = spark.createDataFrame([(day, "a", "x", dt.datetime(2024, 1, 1, h)) for h in (5, 3, 9)], schema + ", ts TIMESTAMP")
    assert tuple(summary.running_counts(timed, added="ts").first())[4:] == (dt.datetime(2024, 1, 1, 3), dt.datetime(2024, 1, 1, 9))


def test_arriving_pages_and_plain_append(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        pages = decode_pages(ingest.arriving_page_files(spark, str(raw)))
        ingest.append_stream(pages, out, checkpoint, "source").awaitTermination()
        return sorted(r.source for r in spark.read.parquet(out).collect())

    (raw / "eltiempo-2024-01-01.html").write_text("<p>uno</p>")
    (raw / "nota.txt").write_text("x")
    assert run() == ["eltiempo"]
    assert run() == ["eltiempo"]
    (raw / "elespectador-2024-01-01.HTML").write_text("<p>dos</p>")
    assert run() == ["elespectador", "eltiempo"]


def test_following_landed_pages(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()

    def land(name, title):
        (raw / name).write_text(f"<article><h1>{title}</h1></article>")

    def run():
        follow_pages(spark, str(raw), str(tmp_path / "out"), str(tmp_path / "cp"), "2024-02-01", generic=True).awaitTermination()
        rows = refresh_catalog(spark, "following", str(tmp_path / "out"))
        return sorted((r.titular, r.periodico, r.fecha) for r in rows.collect())

    land("eltiempo-2024-01-15.html", "Noticia del lunes")
    land("otro-2024-01-15.html", "Noticia de otro sitio")
    first = [("Noticia del lunes", "eltiempo", "2024-01-15")]
    assert run() == first
    assert run() == first
    land("elespectador-2024-01-15.html", "Noticia de la tarde")
    assert run() == [("Noticia de la tarde", "elespectador", "2024-01-15"), *first]
    land("ELTIEMPO-2024-01-15.HTML", "Noticia corregida del lunes")  # a day that lands again is replaced
    assert run() == [("Noticia corregida del lunes", "eltiempo", "2024-01-15"), ("Noticia de la tarde", "elespectador", "2024-01-15")]
    spark.sql("DROP DATABASE following CASCADE")


def test_repeats_leave_the_state(spark, tmp_path):
    """The state holds the keys of the window, not of the stream."""
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    schema = "item LONG, moment TIMESTAMP"

    def arrive(*rows):
        spark.createDataFrame([(i, dt.datetime(2024, 1, day)) for i, day in rows], schema).write.mode("append").parquet(source)
        arriving = ingest.arriving_table(spark, source, spark.createDataFrame([], schema).schema)
        run = repeats.keep_first(arriving, "moment", "3 days", ("item",), out, checkpoint)
        run.awaitTermination()
        return sorted((r.item, r.moment.day) for r in spark.read.parquet(out).collect()), repeats.held_keys(run)

    first = [(i, 1) for i in range(100)]
    assert arrive(*first, *first) == (first, 100)
    rows, held = arrive((5, 2), (200, 4))
    assert rows == sorted([*first, (200, 4)]) and held == 101
    rows, held = arrive((201, 9), (5, 4))  # the first hundred leave the state
    assert (201, 9) in rows and (5, 4) not in rows and held <= 2
    rows, held = arrive((5, 10), (6, 1), (201, 10))  # one comes back as new, one is late, one is a repeat
    assert (5, 10) in rows and (201, 10) not in rows and rows.count((6, 1)) == 1 and held <= 2


def test_only_touched_dates_are_written(spark, tmp_path):
    source, out = str(tmp_path / "in"), tmp_path / "out"
    schema = "fecha DATE, periodico STRING, categoria STRING"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        arriving = ingest.arriving_table(spark, source, spark.createDataFrame([], schema).schema)
        summary.keep_summary(summary.running_counts(arriving), str(out), str(tmp_path / "cp")).awaitTermination()
        return {tuple(r) for r in summary.latest_summary(spark, str(out)).collect()}

    def files(day):
        return {p.name: p.stat().st_mtime_ns for p in (out / f"fecha={day}").glob("*.parquet")}

    one, two, three = (dt.date(2024, 1, day) for day in (1, 2, 3))
    arrive((one, "a", "x"), (two, "a", "x"), (two, "b", None), (three, "a", "x"), (None, "a", "x"))
    before = files(two)
    found = arrive((one, "a", "x"), (three, "c", None), (None, "a", "x"))
    assert found == {(one, "a", "x", 2), (two, "a", "x", 1), (two, "b", None, 1), (three, "a", "x", 1), (three, "c", None, 1), (None, "a", "x", 2)}
    assert files(two) == before


def test_pages_of_one_partition_in_two_batches(spark, tmp_path):
    """The stream keeps what a batch job over the same files writes, whatever the batches and checkpoints."""
    raw = tmp_path / "raw"

    def land(name, *titles):
        (raw / name).parent.mkdir(parents=True, exist_ok=True)
        (raw / name).write_text("<p>" + "".join(f"<article><h1>{t}</h1></article>" for t in titles))

    def rows(root):
        return sorted(tuple(r) for r in refresh_catalog(spark, "same", str(root)).collect())

    def run(checkpoint="cp"):
        follow_pages(spark, str(raw), str(tmp_path / "stream"), str(tmp_path / checkpoint), "2024-02-01", generic=True).awaitTermination()
        process_pages(spark, str(raw), str(tmp_path / f"batch-{len(list(tmp_path.iterdir()))}"), "2024-02-01", generic=True)
        batch = max(tmp_path.glob("batch-*"), key=lambda p: int(p.name[6:]))
        found, wanted = rows(tmp_path / "stream"), rows(batch)
        assert found == wanted
        return [r[2] for r in found]

    land("a/eltiempo-2024-01-15.html", "Primera noticia larga", "Segunda noticia larga")
    land("a/eltiempo.html", "Noticia sin fecha en el nombre")
    assert len(run()) == 3
    land("b/eltiempo-2024-01-15.html", "Tercera noticia larga")
    land("b/elespectador-2024-01-15.html", "Cuarta noticia larga")
    assert len(run()) == 5
    land("a/ELTIEMPO-2024-01-15.HTML", "Primera noticia corregida")  # the same page lands again
    land("b/Elespectador-2024-01-15.html")  # and one that has nothing left
    assert sorted(run()) == ["Noticia sin fecha en el nombre", "Primera noticia corregida", "Tercera noticia larga"]
    assert not list((tmp_path / "stream").glob("periodico=elespectador/*/*/*"))
    land("c/eltiempo-2024-01-15.html", "Quinta noticia larga")
    assert len(run("another")) == 4  # reads all files again
    spark.sql("DROP DATABASE same CASCADE")


def test_announced_pages_are_fetched_and_nothing_else(spark, tmp_path):
    """Absent objects, other files and foreign paths are rejects; a page announced again counts by its newest state."""
    store, queue = f"{tmp_path}/store/", tmp_path / "queue"

    def land(key, *titles):
        place = tmp_path / "store" / "news" / key
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text("".join(f"<article><h1>{t}</h1></article>" for t in titles))

    def announce(*keys):
        record = '{{"s3":{{"bucket":{{"name":"news"}},"object":{{"key":"{}"}}}}}}'
        bodies = ['{"Records":[' + record.format(key) + "]}" for key in keys] or ['{"test":true}']
        spark.createDataFrame([(body,) for body in bodies], "body STRING").write.mode("append").parquet(str(queue))
        stream = spark.readStream.schema("body STRING").parquet(str(queue))
        out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
        more = {"rejects_root": f"{tmp_path}/rejects", "counts_root": f"{tmp_path}/counts", "generic": True}
        follow_announced(stream, store, out, checkpoint, "2024-02-01", **more).awaitTermination()
        return sorted(r.titular for r in refresh_catalog(spark, "announced", out).collect()) if (tmp_path / "out").exists() else []

    def last_counts():
        rows = batch_counts(spark, f"{tmp_path}/counts").collect()
        last = max(rows, key=lambda r: int(r.load.rpartition("-")[2]))
        return (last.pages, last.refused, last.rejected, last.headlines)

    (tmp_path / "store").mkdir()
    (tmp_path / "store" / "eltiempo.html").write_text("<article><h1>Fuera del almacén de noticias</h1></article>")
    assert announce() == [] and last_counts() == (0, 0, 0, 0)  # a notification without an object
    land("a/eltiempo-2024-01-15.html", "Primera noticia larga", "Segunda noticia larga")
    land("b/eltiempo [1] %20+-2024-01-15.html", "Noticia con nombre difícil")
    land("c/eltiempo-2024-01-15.html", "Noticia no anunciada")
    land("d/otro-2024-01-15.html", "Noticia de fuente desconocida")
    land("e/eltiempo.txt", "No es una página")
    land("f/eltiempo.html")
    names = ("a/eltiempo-2024-01-15.html", "b/eltiempo [1] %20+-2024-01-15.html", "d/otro-2024-01-15.html", "e/eltiempo.txt")
    found = announce(*names, names[0], "f/eltiempo.html", "g/none.html", "../eltiempo.html", "a")
    assert found == ["Noticia con nombre difícil", "Primera noticia larga", "Segunda noticia larga"]
    assert last_counts() == (4, 4, 2, 3)
    rejects = {r.path.removeprefix(f"{store}news/"): r.reason for r in spark.read.parquet(f"{tmp_path}/rejects").collect()}
    assert rejects == {
        "d/otro-2024-01-15.html": "no headline",
        "e/eltiempo.txt": "not a page",
        "f/eltiempo.html": "empty",
        "g/none.html": "absent",
        "../eltiempo.html": "absent",
        "a": "not a page",
    }
    land("a/eltiempo-2024-01-15.html", "Primera noticia corregida")
    assert announce(names[0]) == ["Noticia con nombre difícil", "Primera noticia corregida"]
    (tmp_path / "store" / "news" / names[0]).unlink()
    assert announce(names[0]) == ["Noticia con nombre difícil", "Primera noticia corregida"]
    assert last_counts() == (0, 1, 0, 0)
    spark.sql("DROP DATABASE announced CASCADE")
