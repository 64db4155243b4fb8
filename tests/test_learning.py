import datetime as dt

import pytest
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt import schema
from forecourt.__main__ import main
from forecourt.catalogue.fixtures import Inputs
from forecourt.config import BOOST, FOREST, ModelChoice, Tables, Training
from forecourt.learning import evaluation, features, runs, split, training
from forecourt.operators import gold, silver
from forecourt.plans import medallion
from forecourt.sources import sinks, tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def priced(spark, tmp_path_factory):
    """Feature rows whose price follows from age, mileage and brand."""
    d = Inputs(spark, SMALL)
    signal = (
        2000 + 300 * (F.col("anio") - 1980) - F.col("km") / 100
        + 500 * (F.length("marca") % 3) + 3000 * (F.col("tipo") == "naked").cast("int")
    )
    bronze = silver.union_listings(d.bronze_feed, d.bronze_pages).withColumn(
        "precio", F.greatest(F.lit(150.0), F.least(F.lit(99000.0), signal)))
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    sinks.overwrite(gold.to_gold(silver.to_silver(bronze, as_of_year=2024), 2024), path)
    return tables.read_table(spark, path)


def keys(df):
    return {r[0] for r in df.select(schema.KEY).collect()}


def test_split_is_repeatable_and_whole(priced):
    train, test = split.split(priced)
    again, _ = split.split(priced.repartition(11, "km"))
    assert keys(train) == keys(again)
    assert keys(train) | keys(test) == keys(priced) and not keys(train) & keys(test)
    assert abs(test.count() / priced.count() - 0.2) < 0.05
    assert keys(split.split(priced, seed=7)[1]) != keys(test)


def test_row_without_key_is_not_lost(priced):
    df = priced.limit(5).withColumn(schema.KEY, F.lit(None).cast("string"))
    train, test = split.split(df)
    assert train.count() + test.count() == 5


def test_training_rows(priced):
    rows = split.training_rows(priced)
    assert rows.filter(" OR ".join(f"{c} IS NULL" for c in fixed.NUMERIC_COLUMNS)).count() == 0
    for source in ("mundimoto", "MOTO-OCASION"):
        found = {r[0] for r in split.training_rows(priced, source).select("origen").distinct().collect()}
        assert found == {source.lower()}
    assert split.training_rows(priced, None).count() == rows.count()


def test_row_minimum(priced):
    assert split.require_min_rows(priced.limit(100), 100) == 100
    with pytest.raises(split.TooFewRows):
        split.require_min_rows(priced.limit(99), 100)


def test_unseen_and_null_labels_have_no_slot(priced):
    rows = split.training_rows(priced)
    labels = features.rank_labels(rows)

    def slots(df):
        known = features.indexed(df, labels)
        model = features.vectoriser(known)
        return [r[0] for r in model.transform(known).select(features.hot_slot("marca_ohe")).collect()]

    odd = rows.limit(1).withColumn("marca", F.lit("NEVER")).unionByName(
        rows.limit(1).withColumn("marca", F.lit(None).cast("string")))
    assert slots(odd) == [None, None]
    most_common = rows.groupBy("marca").count().orderBy(F.desc("count"), "marca").first()[0]
    assert slots(rows.filter(F.col("marca") == most_common).limit(1)) == [0]


def test_ranks_equal_the_built_in_indexer(priced):
    from pyspark.ml.feature import StringIndexer

    rows = split.training_rows(priced)
    built_in = StringIndexer(inputCols=fixed.CATEGORY_COLUMNS, outputCols=features.index_columns()).fit(rows)
    ours = {(r.category, r.label): r.pos for r in features.rank_labels(rows).table.collect()}
    assert ours == {
        (c, label): i for c, labels in zip(fixed.CATEGORY_COLUMNS, built_in.labelsArray)
        for i, label in enumerate(labels)}


def test_a_category_of_very_many_labels_trains(spark, priced):
    rows = split.training_rows(priced).limit(1)
    many = rows.drop("marca", schema.KEY).crossJoin(spark.range(60_000).select(
        F.concat(F.lit("B"), "id").alias("marca"), F.col("id").cast("string").alias(schema.KEY)))
    model = training.fit_price_model(training.forest(numTrees=1, maxDepth=1, featureSubsetStrategy="all"), many)
    assert model.labels.sizes["marca"] == 60_000
    assert model.transform(many.limit(5)).count() == 5


def test_assembler_skips_missing_numbers(priced):
    rows = split.training_rows(priced)
    labels = features.rank_labels(rows)
    gap = features.indexed(rows.limit(3).withColumn("km", F.lit(None).cast("int")), labels)
    assert features.vectoriser(gap).transform(gap).count() == 0


def test_mean_predictor_covers_every_row(spark):
    train = spark.createDataFrame([("a", "x", 10.0), ("a", "x", 20.0), ("b", "x", 60.0)], "marca STRING, tipo_normalizado STRING, precio DOUBLE")
    rows = spark.createDataFrame([("a", "x"), ("new", "x"), (None, None)], "marca STRING, tipo_normalizado STRING")
    out = [(r.marca, r.prediction) for r in evaluation.mean_price_by(train, rows).collect()]
    assert sorted(out, key=str) == [("a", 15.0), ("new", 30.0), (None, 30.0)]


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "precio DOUBLE, prediction DOUBLE")
    row = evaluation.regression_metrics(df).first()
    assert row.rmse == pytest.approx((2 / 3) ** 0.5) and row.mae == pytest.approx(2 / 3)
    assert row.r2 == pytest.approx(1 - 2 / 8) and row["rows"] == 3


def test_metrics_equal_the_evaluator(priced):
    from pyspark.ml.evaluation import RegressionEvaluator

    train, test = split.split(split.training_rows(priced))
    predictions = evaluation.mean_price_by(train, test).cache()
    row = evaluation.regression_metrics(predictions).first()
    for name in ("rmse", "mae", "r2"):
        plain = RegressionEvaluator(labelCol="precio", metricName=name).evaluate(predictions)
        assert row[name] == pytest.approx(plain, rel=1e-9)


def test_forest_beats_the_group_mean_and_repeats(priced):
    train, test = split.split(split.training_rows(priced))
    scores = []
    for n in (3, 9):
        model = training.fit_price_model(training.forest(numTrees=10, maxDepth=8), train.repartition(n))
        scores.append(evaluation.regression_metrics(model.transform(test)).first())
    baseline = evaluation.regression_metrics(evaluation.mean_price_by(train, test)).first()
    assert scores[0].rmse < 0.6 * baseline.rmse and scores[0].r2 > 0.8
    assert scores[0].rmse == pytest.approx(scores[1].rmse, rel=1e-9)


def test_grids():
    model, grid = training.model_and_grid(FOREST)
    assert sorted((p[model.numTrees], p[model.maxDepth]) for p in grid) == [
        (100, 8), (100, 12), (200, 8), (200, 12)]
    model, grid = training.model_and_grid(BOOST)
    assert sorted((p[model.maxIter], p[model.maxDepth]) for p in grid) == [
        (50, 5), (50, 8), (100, 5), (100, 8)]
    with pytest.raises(ValueError):
        training.model_and_grid(ModelChoice("x", "x", (1,), (1,)))


def test_worst_and_sample(spark):
    rows = [("A", "m", "naked", 1, 2010, 5, float(100 + i), 100.0, f"u{i}") for i in range(150)]
    ddl = ("marca STRING, modelo STRING, tipo_normalizado STRING, cilindrada_cc INT, anio INT, "
           "km INT, precio DOUBLE, prediction DOUBLE, url_anuncio STRING")
    df = spark.createDataFrame(rows, ddl)
    worst = evaluation.worst_predictions(df).collect()
    assert [r.url_anuncio for r in worst] == [f"u{i}" for i in range(149, 49, -1)]
    assert worst[0].error_absoluto == 149.0 and worst[0].error_porcentual == 59.84
    sample = evaluation.sample_predictions(df)
    assert sample.count() == 50
    assert keys(sample) == keys(evaluation.sample_predictions(df.repartition(7)))


def test_importance_names(spark, priced):
    rows = split.training_rows(priced)
    model = training.fit_price_model(training.forest(numTrees=3, maxDepth=4), rows)
    found = evaluation.feature_importance(spark, model.trees, model.labels).collect()
    names = {r.Feature for r in found}
    assert {"anio", "km", "marca_ohe_BRAND#1", "km_bucket_ohe_60k+"} <= names
    assert sum(r.Importance for r in found) == pytest.approx(1, abs=0.01)
    assert [r.Importance for r in found] == sorted((r.Importance for r in found), reverse=True)


@pytest.mark.parametrize("make, settings", [
    (training.forest, {"numTrees": 4, "maxDepth": 4}), (training.boost, {"maxIter": 4, "maxDepth": 3})])
def test_slot_importance_equals_the_built_in(spark, priced, make, settings):
    trees = training.fit_price_model(make(**settings), split.training_rows(priced)).trees
    found = {r.slot: r.weight for r in evaluation.slot_importance(spark, trees).collect()}
    built_in = {i: w for i, w in enumerate(trees.featureImportances.toArray()) if w}
    assert found.keys() == built_in.keys()
    assert all(found[i] == pytest.approx(built_in[i], abs=1e-9) for i in found)


def test_a_model_without_splits_has_no_importance(spark, priced):
    rows = split.training_rows(priced).withColumn("precio", F.lit(500.0))
    model = training.fit_price_model(training.forest(numTrees=2, maxDepth=2), rows)
    found = evaluation.feature_importance(spark, model.trees, model.labels).collect()
    assert len(found) == model.labels.slots().count() and {r.Importance for r in found} == {0.0}


def test_staged_boosting_scores_equal_separate_fits(priced):
    from pyspark.ml.evaluation import RegressionEvaluator

    rows = split.with_fold(split.training_rows(priced), folds=2)
    choice = ModelChoice("Gradient Boost", "boost", (1, 3), (2, 3))
    search = training.cross_validate(choice, rows, folds=2)
    rmse = RegressionEvaluator(labelCol=fixed.TARGET_COLUMN, metricName="rmse")
    for point, score in zip(search.grid, search.scores):
        alone = 0.0
        for fold in range(2):
            model = training.fit_price_model(search.model.copy(point), rows.filter(F.col(split.FOLD) != fold))
            alone += rmse.evaluate(model.transform(rows.filter(F.col(split.FOLD) == fold))) / 2
        assert score == pytest.approx(alone, rel=1e-9)


def test_partitions_follow_the_number_of_rows_alone():
    assert [training.partitions_for(n) for n in (0, 1, 2_001, 40_000, 10**6, 10**9)] == [1, 1, 2, 20, 32, 20_000]


def test_boosting_reads_few_partitions():
    """At 30 million rows each of 250 passes started 610 tasks."""
    totals = (1, 2_001, 10**6, 3 * 10**6, 30_500_000, 10**9)
    assert [training.partitions_to_fit(training.boost(), n) for n in totals] == [1, 2, 32, 32, 122, 4_000]
    assert [training.partitions_to_fit(training.forest(), n) for n in totals] == [training.partitions_for(n) for n in totals]


def test_metrics_are_bit_equal_in_any_layout(priced):
    train, test = split.split(split.training_rows(priced))
    predictions = evaluation.mean_price_by(train, test).cache()
    found = {tuple(evaluation.regression_metrics(predictions.repartition(n)).first()) for n in (1, 7, 200)}
    assert len(found) == 1


def test_run_table(spark, tmp_path):
    target = str(tmp_path / "runs")
    assert runs.next_version(spark, target, "m") == 1
    for i in range(7):
        metrics = {"rmse": float(i)} if i else {}
        runs.log_run(spark, target, f"{i:032x}", f"r{i}", 1000.0 + i, {"a": "b"}, metrics, "m",
                     runs.next_version(spark, target, "m"), "p")
    assert runs.next_version(spark, target, "m") == 8
    assert runs.next_version(spark, target, "other") == 1
    latest = runs.latest_runs(tables.read_table(spark, target, runs.RUNS)).collect()
    assert [(r.run_name, r.rmse, r.r2) for r in latest] == [
        (f"r{i}", float(i), 0.0) for i in (6, 5, 4, 3, 2)]


def test_runs_at_the_same_time_have_versions_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    table, folder = str(tmp_path / "runs"), str(tmp_path / "versions")

    def claim(i):
        return runs.claim_version(spark, table, "m", folder, f"{i:032x}")

    with ThreadPoolExecutor(8) as pool:
        assert sorted(pool.map(claim, range(24))) == list(range(1, 25))


def test_training_run_leaves_everything_behind(spark, priced, tmp_path):
    table = str(tmp_path / "runs")
    plan = Training(output_dir=str(tmp_path / "out"), folds=2, models=(
        ModelChoice("Random Forest", "forest", (3, 6), (3,)),
        ModelChoice("Gradient Boost", "boost", (2,), (3,)),
    ))
    outcomes = training.train(spark, priced, table, plan)
    assert [o.version for o in outcomes] == [1, 2]
    forest, boost = outcomes
    assert forest.params["num_trees"] in ("3", "6") and forest.params["max_depth"] == "3"
    assert boost.params["max_iter"] == "2" and "num_trees" not in boost.params
    for outcome in outcomes:
        reports = tmp_path / "out" / "runs" / outcome.run_id
        assert {p.name for p in reports.iterdir()} == {
            "evaluation_examples", "worst_predictions", "feature_importance"}
        scored = training.score(outcome.model_path, split.split(split.training_rows(priced))[1])
        assert evaluation.regression_metrics(scored).first().rmse == pytest.approx(
            outcome.metrics["rmse"], rel=1e-9)
    logged = tables.read_table(spark, table, runs.RUNS)
    assert logged.count() == 2
    assert training.PriceModel.load(spark, forest.model_path).trees.getNumTrees in (3, 6)


def test_whole_run_and_rerun(spark, tmp_path):
    d = Inputs(spark, SMALL)
    where = Tables(root=str(tmp_path))
    plan = Training(output_dir=str(tmp_path / "out"), folds=2,
                    models=(ModelChoice("Random Forest", "forest", (2,), (3,)),))
    given = medallion.Sources(d.feed, d.pages.drop(schema.DATE))
    day = dt.date(2024, 3, 1)
    first = medallion.run(spark, where, plan, given, as_of_year=2024, day=day)
    assert first.feed.rows == d.bronze_feed.count() and first.pages.rows == d.bronze_pages.count()
    assert first.feed.rows + sum(first.feed.rejected.values()) == d.feed.count()
    again = medallion.ingest(given, where, day, replace_dates=True)
    assert [i.rows for i in again] == [first.feed.rows, first.pages.rows]
    assert tables.read_table(spark, where.locate("bronze_feed")).count() == first.feed.rows
    clean = tables.read_table(spark, where.locate("silver"))
    assert clean.count() == clean.select(schema.KEY).distinct().count()
    before = sorted(keys(clean))
    second = medallion.run(spark, where, plan, as_of_year=2024)
    assert (second.feed.rows, second.pages.rows) == (0, 0)
    assert sorted(keys(tables.read_table(spark, where.locate("silver")))) == before
    assert tables.read_table(spark, where.locate("gold")).count() == len(before)
    assert [o.version for o in second.outcomes] == [2]


def test_feed_only_and_too_few_rows(spark, tmp_path):
    d = Inputs(spark, SMALL)
    where = Tables(root=str(tmp_path))
    plan = Training(output_dir=str(tmp_path / "out"), min_rows=10**9)
    summary = medallion.run(spark, where, plan, medallion.Sources(feed=d.feed), as_of_year=2024)
    assert summary.outcomes == [] and "are needed" in summary.skipped
    assert tables.optional_table(spark, where.locate("bronze_pages"), schema.BRONZE) is None
    assert tables.read_table(spark, where.locate("gold")).count() > 0


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.json").write_text(
        '{"motorbikes":[{"id":1,"brand":"A","model":"m","year":2010,"kms":5,"price":900}]}\n{"motorb')
    line = ["--feed", str(tmp_path / "feed"), "--root", str(tmp_path), "--output", str(tmp_path / "o"),
            "--day", "2024-03-01", "--replace-dates"]
    for _ in range(2):
        main(line)
        printed = capsys.readouterr().out
        assert "feed rows 1" in printed and "no training" in printed and "bad_page: 1" in printed
    assert tables.read_table(spark, str(tmp_path / "bronze_feed")).count() == 1


def test_nothing_good_stops_the_run(spark, tmp_path):
    d = Inputs(spark, SMALL)
    where, plan = Tables(root=str(tmp_path)), Training(output_dir=str(tmp_path / "out"))
    with pytest.raises(medallion.NothingIngested):
        medallion.run(spark, where, plan, medallion.Sources(feed=d.feed.withColumn("brand", F.lit(""))))
    assert not tables.exists(spark, where.locate("bronze_feed"))


@pytest.mark.parametrize("name, sizes", [
    ("rf_predict", (100, 8)), ("feature_importance", (100, 8)), ("model_roundtrip", (100, 8)), ("gbt_predict", (50, 5)),
    ("cv_grid_results", FOREST), ("end_to_end", (FOREST,)),
])
def test_registered_queries_fit_the_whole_models(spark, monkeypatch, name, sizes):
    from forecourt.catalogue import queries

    class Asked(Exception):
        pass

    def fit(model, *rest):
        size = model.getOrDefault("maxIter" if model.hasParam("maxIter") else "numTrees")
        raise Asked((size, model.getOrDefault("maxDepth")))

    def search(choice, *rest):
        raise Asked(choice)

    def run(session, where, plan, *rest, **options):
        raise Asked(plan.models)

    monkeypatch.setattr(queries.training, "fit_price_model", fit)
    monkeypatch.setattr(queries.training, "cross_validate", search)
    monkeypatch.setattr(queries.medallion, "run", run)
    with pytest.raises(Asked) as asked:
        queries.REGISTERED[name](spark, "/root/testdata/sf0.001")
    assert asked.value.args[0] == sizes
