import datetime as dt

import pytest
from pyspark.sql import functions as F

from forecourt import schema
from forecourt.catalogue.fixtures import Inputs
from forecourt.config import Tables
from forecourt.operators import bronze, gold, silver, silver_buckets
from forecourt.plans import medallion
from forecourt.sources import scratch, sinks, tables

DAY = dt.date(2024, 1, 1)


def listing(**changes):
    base = {
        "marca": " acme ", "modelo": " x ", "anio": 2010, "km": 100, "tipo": "naked",
        "precio": 2000.0, "cilindrada_cc": 600, "potencia_cv": 50, "ubicacion": None,
        "url_anuncio": "u", "descripcion": None, "distintivo_ambiental": None, "num_plazas": None,
        "num_llaves": None, "iva_deducible": None, "origen": "mundimoto", "ingestion_date": DAY,
    }
    base.update(changes)
    return tuple(base[f.name] for f in schema.BRONZE.fields)


@pytest.fixture
def bronze_of(spark):
    def build(*rows):
        return spark.createDataFrame([listing(**r) for r in rows], schema.BRONZE)
    return build


def urls(df):
    return sorted(r[0] for r in df.select("url_anuncio").collect())


def test_ranges_include_their_bounds(bronze_of):
    cases = {"p1": {"precio": 99.99}, "p2": {"precio": 100.0}, "p3": {"precio": 100000.0},
             "p4": {"precio": 100000.5}, "y1": {"anio": 1979}, "y2": {"anio": 1980},
             "y3": {"anio": 2024}, "y4": {"anio": 2025}, "k1": {"km": -1}, "k2": {"km": 0}}
    df = bronze_of(*[{"url_anuncio": u, **c} for u, c in cases.items()])
    assert urls(silver.to_silver(df, as_of_year=2024)) == ["k2", "p2", "p3", "y2", "y3"]


@pytest.mark.parametrize("column", schema.REQUIRED)
def test_required_columns(bronze_of, column):
    df = bronze_of({column: None}, {"url_anuncio": "ok"})
    assert urls(silver.to_silver(df)) == ["ok"]


def test_nan_price_is_missing(bronze_of):
    assert silver.to_silver(bronze_of({"precio": float("nan")})).count() == 0


def test_latest_copy_wins_even_when_out_of_range(bronze_of):
    later = DAY + dt.timedelta(days=1)
    df = bronze_of(
        {"url_anuncio": "gone"}, {"url_anuncio": "gone", "precio": 5.0, "ingestion_date": later},
        {"url_anuncio": "new", "km": 1}, {"url_anuncio": "new", "km": 2, "ingestion_date": later},
    )
    rows = silver.to_silver(df).collect()
    assert [(r.url_anuncio, r.km) for r in rows] == [("new", 2)]


def test_null_keys_are_one_key(bronze_of):
    df = bronze_of(*[{"url_anuncio": None, "km": k} for k in (3, 1, 2)])
    assert [r.km for r in silver.to_silver(df).collect()] == [1]


def test_choice_does_not_depend_on_layout(spark, bronze_of):
    df = bronze_of(*[{"url_anuncio": f"u{i % 7}", "km": i, "modelo": f"m{i % 3}"} for i in range(60)])
    first = sorted(silver.to_silver(df.repartition(1)).collect(), key=str)
    assert first == sorted(silver.to_silver(df.repartition(9, "km")).collect(), key=str)
    assert len(first) == 7


def test_hot_key_is_thinned_before_the_shuffle(bronze_of):
    plan = silver.to_silver(bronze_of({}))._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_union_fills_missing_columns(bronze_of):
    df = silver.union_listings(bronze_of({}), bronze_of({}).drop("num_llaves"), None)
    assert df.count() == 2 and df.columns == schema.BRONZE.names


def test_casts_give_null_for_text(spark):
    df = spark.createDataFrame([("abc", "2000", "1.5", "")],
                               "km STRING, anio STRING, precio STRING, cilindrada_cc STRING")
    row = silver.cast_numbers(df).first()
    assert (row.km, row.anio, row.precio, row.cilindrada_cc) == (None, 2000, 1.5, None)


def test_names_keep_inner_and_odd_space(bronze_of):
    row = silver.normalise_names(bronze_of({"marca": " a b ", "modelo": "\tx "})).first()
    assert (row.marca, row.modelo) == ("A B", "\tx")


def test_gold_defaults(bronze_of):
    df = bronze_of(
        {"url_anuncio": "a", "tipo": None, "km": 10_000},
        {"url_anuncio": "b", "iva_deducible": True, "num_plazas": 1, "num_llaves": 3,
         "distintivo_ambiental": "C", "tipo": "Trail"},
    )
    rows = {r.url_anuncio: r for r in gold.to_gold(silver.to_silver(df), 2024).collect()}
    a, b = rows["a"], rows["b"]
    assert (a.tipo_normalizado, a.km_bucket, a.edad_anios) == ("otro", "10k-30k", 14)
    assert (a.distintivo_ambiental, a.num_plazas, a.num_llaves, a.iva_deducible) == (
        "desconocido", 2, 1, "false")
    assert (b.distintivo_ambiental, b.num_plazas, b.num_llaves, b.iva_deducible) == ("C", 1, 3, "true")
    assert b.tipo_normalizado == "trail" and abs(b.log_precio - 7.600902) < 1e-6


def test_gold_layout_and_types(bronze_of):
    df = gold.to_gold(silver.to_silver(bronze_of({})), 2024)
    assert df.columns == schema.GOLD_COLUMNS
    assert dict(df.dtypes)["precio"] == "float" and dict(df.dtypes)["edad_anios"] == "int"


def test_default_year_is_the_running_one(bronze_of):
    this_year = dt.date.today().year
    df = bronze_of({"anio": this_year}, {"url_anuncio": "next", "anio": this_year + 1})
    rows = gold.to_gold(silver.to_silver(df)).collect()
    assert [(r.url_anuncio, r.edad_anios) for r in rows] == [("u", 0)]


def test_append_counts_and_stamps(spark, bronze_of, tmp_path):
    target = str(tmp_path / "bronze")
    df = bronze_of({}, {"km": -1}, {"url_anuncio": "v"})
    assert bronze.append_bronze(df, target, DAY) == 2
    assert bronze.append_bronze(df, target, DAY + dt.timedelta(days=1)) == 2
    stored = bronze.scan_bronze(spark, target)
    assert stored.count() == 4 and stored.schema == schema.BRONZE
    assert bronze.scan_bronze(spark, target, since=DAY + dt.timedelta(days=1)).count() == 2
    newest = bronze.newest_dates(stored, 1).first()
    assert newest.ingestion_date == DAY + dt.timedelta(days=1) and newest["rows"] == 2


def test_date_filter_prunes_folders(spark, bronze_of, tmp_path):
    target = str(tmp_path / "bronze")
    bronze.append_bronze(bronze_of({}), target, DAY)
    plan = bronze.scan_bronze(spark, target, since=DAY)._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan.toString()


def test_repeated_batch(spark, bronze_of, tmp_path):
    target = str(tmp_path / "bronze")
    bronze.append_bronze(bronze_of({}), target, DAY - dt.timedelta(days=1))
    for _ in range(2):
        bronze.append_bronze(bronze_of({}), target, DAY, replace_dates=True)
    assert bronze.scan_bronze(spark, target).count() == 2
    bronze.append_bronze(bronze_of({}), target, DAY)
    assert bronze.scan_bronze(spark, target).count() == 3


def test_nothing_valid_writes_nothing(spark, bronze_of, tmp_path):
    target = str(tmp_path / "bronze")
    assert bronze.append_bronze(bronze_of({"km": -1}), target) == 0
    assert bronze.append_bronze(bronze_of({}).limit(0), target) == 0
    assert not (tmp_path / "bronze").exists()
    assert tables.optional_table(spark, target, schema.BRONZE) is None


def test_backfill_keeps_dates(spark, bronze_of, tmp_path):
    target = str(tmp_path / "bronze")
    rows = [{"ingestion_date": DAY + dt.timedelta(days=i % 3), "km": i} for i in range(30)]
    df = bronze_of(*rows).repartition(6)
    assert bronze.append_bronze(df, target, keep_dates=True) == 30
    files = list((tmp_path / "bronze").glob("*/*.parquet"))
    assert len(files) == 3
    assert bronze.scan_bronze(spark, target).count() == 30


def test_catalog_tables(spark, bronze_of):
    where = Tables(schema="shelf")
    name = where.locate("bronze_feed")
    assert name == "spark_catalog.shelf.bronze_feed"
    assert tables.optional_table(spark, name) is None
    assert bronze.append_bronze(bronze_of({}), name, DAY) == 1
    assert bronze.append_bronze(bronze_of({}), name, DAY, replace_dates=True) == 1
    assert bronze.append_bronze(bronze_of({}), name, DAY) == 1
    assert spark.table(name).count() == 2
    clean = silver.to_silver(tables.optional_table(spark, name))
    sinks.overwrite(clean, where.locate("silver"))
    sinks.overwrite(clean.select("marca"), where.locate("silver"))
    assert spark.table(where.locate("silver")).columns == ["marca"]


def test_other_failures_of_an_optional_source_surface(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        tables.optional_table(spark, str(tmp_path / "t")).count()


def test_scratch_needs_a_shared_folder(spark):
    first = scratch.scratch_folder(spark, "x")
    assert first != scratch.scratch_folder(spark, "x")
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert first.startswith(before)


def test_report_is_csv_with_a_header(spark, tmp_path):
    sinks.write_report(spark.range(2).select(F.col("id").alias("n")), str(tmp_path / "r"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "r").glob("*.csv")))
    assert text.splitlines()[0] == "n" and "1" in text


ENVELOPE = '{"motorbikes":[%s]}\n'
RECORD = '{"id":%d,"brand":"%s","model":"m","year":%s,"kms":5,"price":900}'


def landed_feed(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(ENVELOPE % ",".join(RECORD % r for r in records))


def test_a_second_run_takes_new_files_only(spark, tmp_path):
    from forecourt.config import Tables
    from forecourt.plans import medallion

    where, day = Tables(root=str(tmp_path / "t")), dt.date(2024, 3, 1)
    feed = tmp_path / "feed"
    landed_feed(feed, "a.json", [(1, "A", 2010), (2, "B", 2011)])
    spark.createDataFrame([("https://d.example/x/naked/b-1/", "<tr><th>a</th><td>b</td></tr>")], "url STRING, html STRING") \
        .write.parquet(str(tmp_path / "pages"))
    given = medallion.Landed(str(feed), str(tmp_path / "pages"))
    first = medallion.ingest(given, where, day)
    assert first[0].rows == 2 and sum(first[1].rejected.values()) == 1
    assert medallion.ingest(given, where, day) == (medallion.Ingested(), medallion.Ingested())
    landed_feed(feed, "b.json", [(3, "C", 2012)])
    assert medallion.ingest(given, where, day)[0].rows == 1
    landed_feed(feed, "b.json", [(3, "C", 2012), (4, "D", 2013)])
    assert medallion.ingest(given, where, day)[0].rows == 2
    bronze_rows = tables.read_table(spark, where.locate("bronze_feed"))
    assert sorted(r.marca for r in bronze_rows.collect()) == ["A", "B", "C", "C", "D"]
    again = medallion.ingest(given, where, day, replace_dates=True)
    assert again[0].rows == 4 and tables.read_table(spark, where.locate("bronze_feed")).count() == 4


def test_many_new_files_are_picked_by_their_rows(spark, tmp_path, monkeypatch):
    from forecourt.sources import landed, ledger

    monkeypatch.setattr(ledger, "NAMED", 0)
    feed, target = tmp_path / "feed", str(tmp_path / "ledger")
    landed_feed(feed, "a.json", [(1, "A", 2010)])
    ledger.Unseen(spark, str(feed), target, "feed").record()
    landed_feed(feed, "b.json", [(2, "B", 2010)])
    unseen = ledger.Unseen(spark, str(feed), target, "feed")
    assert unseen.count == 1 and unseen.paths() is None
    assert [r.brand for r in landed.read_feed(spark, str(feed), only=unseen).collect()] == ["B"]
    assert ledger.Unseen(spark, str(feed), target, "pages").count == 2


def test_rejects_are_kept_and_tried_again(spark, tmp_path):
    from forecourt.config import Tables
    from forecourt.operators import extract, rejects
    from forecourt.plans import medallion

    where, day = Tables(root=str(tmp_path / "t")), dt.date(2024, 3, 1)
    feed = tmp_path / "feed"
    landed_feed(feed, "a.json", [(1, "A", 2010), (2, "", 2011), (3, "C", '"n/a"'), (4, "D", 1970)])
    (feed / "c.json").write_text('{"motorb')
    got = medallion.ingest(medallion.Landed(feed=str(feed)), where, day, keep_rejects=True)[0]
    assert got.rows == 1 and got.rejected == {"no_brand": 1, "bad_year": 1, "old_year": 1, "bad_page": 1}
    kept = tables.read_table(spark, where.locate("rejects"))
    assert kept.count() == 4 and {r.ingestion_date for r in kept.collect()} == {day}
    assert medallion.replay(spark, where, day) == (0, 0)
    assert tables.read_table(spark, where.locate("rejects")).count() == 4

    def lenient(records, keep_raw=False):
        """A record without a brand is of an unknown one now."""
        return extract.parse_feed(records.withColumn("brand", F.when(F.col("brand") != "", F.col("brand")).otherwise("X")), keep_raw)

    moved = [rejects.replay(spark, "feed", where.locate("bronze_feed"), where.locate("rejects"), day, lenient) for _ in range(2)]
    assert moved == [1, 0]
    left = {r.reject_reason for r in tables.read_table(spark, where.locate("rejects")).collect()}
    assert left == {"bad_year", "old_year", "bad_page"}
    assert sorted(r.marca for r in tables.read_table(spark, where.locate("bronze_feed")).collect()) == ["A", "X"]


def test_pages_that_are_rejected_keep_their_markup(spark, tmp_path):
    from forecourt.operators import rejects

    url, page = "https://d.example/x/naked/b-1/", "<tr><th>año</th><td>20O1</td></tr>"
    raw = spark.createDataFrame([(url, page)], "url STRING, html STRING")
    table, target = str(tmp_path / "rejects"), str(tmp_path / "bronze")
    assert rejects.split(raw, "pages", target, table, dt.date(2024, 3, 1)) == (0, {"bad_year": 1})
    import json

    assert json.loads(spark.read.parquet(table).first().raw) == {"url": url, "html": page}
    assert rejects.replay(spark, "pages", target, table) == 0 and spark.read.parquet(table).count() == 1


def files_of(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_merged_buckets_equal_a_rebuild(bronze_of, spark, tmp_path):
    days = [
        [{"url_anuncio": f"u{i}", "km": i} for i in range(60)],
        [{"url_anuncio": "u3", "precio": 5.0}, {"url_anuncio": "u4", "km": 9}, {"url_anuncio": None}, {"url_anuncio": "x1"}],
        [{"url_anuncio": "u3", "km": 77}, {"url_anuncio": None, "km": 1}, {"url_anuncio": "u5", "marca": None}],
    ]
    frames = [bronze_of(*[{**r, "ingestion_date": DAY + dt.timedelta(days=k)} for r in rows]) for k, rows in enumerate(days)]
    target = str(tmp_path / "silver")
    silver_buckets.rebuild(target, 32, frames[0])
    so_far = frames[0]
    for df in frames[1:]:
        before = files_of(tmp_path / "silver")
        touched = silver_buckets.merge(target, 32, df, None)
        after = files_of(tmp_path / "silver")
        kept = {f for f in before if not any(f.startswith(f"bucket_of_32={b}/") for b in touched)}
        assert 0 < len(touched) < 5 and kept and all(after[f] == before[f] for f in kept)
        so_far = so_far.union(df)
        for year in (2009, 2024):
            want = sorted(silver.to_silver(so_far, as_of_year=year).collect(), key=str)
            assert sorted(silver_buckets.clean_rows(spark, target, 32, year).collect(), key=str) == want
    whole = sorted(silver_buckets.clean_rows(spark, target, 32, 2024).collect(), key=str)
    silver_buckets.merge(target, 32, frames[1])  # rows merged before change nothing
    assert sorted(silver_buckets.clean_rows(spark, target, 32, 2024).collect(), key=str) == whole
    assert silver_buckets.merge(target, 32, frames[0].limit(0)) == []
    with pytest.raises(silver_buckets.OtherBuckets):
        silver_buckets.merge(target, 16, frames[1])


@pytest.mark.parametrize("catalog", [False, True])
def test_refresh_merges_what_is_new_and_rebuilds_after_an_interruption(bronze_of, spark, tmp_path, catalog):
    where = Tables(schema="kept_by_bucket", silver_buckets=16) if catalog else Tables(root=str(tmp_path), silver_buckets=16)
    feed, target = where.locate("bronze_feed"), where.locate("silver")
    bronze.append_bronze(bronze_of(*[{"url_anuncio": f"u{i}"} for i in range(40)]), feed, DAY)
    assert medallion.refresh_silver(spark, where, 2024) is None
    assert medallion.refresh_silver(spark, where, 2024) == []
    bronze.append_bronze(bronze_of({"url_anuncio": "u1", "km": 8}), feed, DAY + dt.timedelta(days=1))
    bronze.append_bronze(bronze_of({"url_anuncio": "p"}), where.locate("bronze_pages"), DAY)
    assert 1 <= len(medallion.refresh_silver(spark, where, 2024)) <= 16
    tables.mark(spark, target)
    assert silver_buckets.interrupted(spark, target)
    assert medallion.refresh_silver(spark, where, 2024) is None and not silver_buckets.interrupted(spark, target)
    rows = {r.url_anuncio: r.km for r in medallion.read_silver(spark, where, 2024).collect()}
    assert len(rows) == 41 and rows["u1"] == 8 and rows["p"] == 100
    medallion.refresh_gold(spark, where, 2024)
    assert tables.read_table(spark, where.locate("gold")).count() == 41


def test_nothing_valid_leaves_what_others_wrote(bronze_of, spark, tmp_path):
    target = tmp_path / "raw"
    assert bronze.append_bronze(bronze_of({"km": -1}), str(target), DAY) == 0 and not target.exists()
    target.mkdir()
    (target / "_SUCCESS").touch()
    (target / "other.parquet").touch()
    tables.forget_empty(spark, str(target))
    assert sorted(p.name for p in target.iterdir()) == ["_SUCCESS", "other.parquet"]
    assert bronze.append_bronze(bronze_of({"km": -1}), "spark_catalog.default.nothing_valid", DAY) == 0
    assert not spark.catalog.tableExists("spark_catalog.default.nothing_valid")


def test_a_merge_leaves_no_scratch_tables(spark, tmp_path):
    """Each merge left a copy of its rows and one of the buckets it touched."""
    rows = Inputs(spark, "/root/testdata/sf0.001").bronze_feed.limit(200)
    target = str(tmp_path / "silver")
    silver_buckets.rebuild(target, 4, rows)
    named = list(scratch._named)
    for batch in (rows, rows.limit(0)):
        silver_buckets.merge(target, 4, batch)
    assert scratch._named == named
    folder = scratch.scratch_folder(spark, "x")
    sinks.overwrite(rows, f"{folder}/inner")
    for gone in (f"{folder}/inner", folder):
        scratch.release(spark, gone)
        assert not tables.exists(spark, gone)
    assert scratch._named == named
