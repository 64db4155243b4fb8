"""The registered queries: one per operator, each over its whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt import schema
from forecourt.catalogue.fixtures import AS_OF_YEAR, Inputs
from forecourt.config import BOOST, FOREST, Tables, Training
from forecourt.functions import html, numbers
from forecourt.learning import evaluation, features, runs, split, training
from forecourt.operators import bronze, extract, gold, links, quality, silver, silver_buckets
from forecourt.plans import medallion
from forecourt.sources import landed, sinks, tables
from forecourt.sources.scratch import forget_shuffles, release, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register under the function's name."""
    REGISTERED[function.__name__] = lambda spark, sf_dir: function(Inputs(spark, sf_dir))
    return function


def price(column: str = "precio") -> Column:
    """A FLOAT price as a DOUBLE of two decimals."""
    return F.round(F.col(column).cast("double"), 2).alias(column)


BRONZE_SHOWN = [
    "marca", "modelo", "anio", "km", "tipo", "precio", "cilindrada_cc", "potencia_cv",
    "url_anuncio", "distintivo_ambiental", "num_plazas", "num_llaves", "iva_deducible", "origen",
    "ingestion_date",
]


def shown(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[price() if c == "precio" else F.col(c) for c in columns])


# --- sources and sinks -------------------------------------------------------

def feed_envelopes(feed: DataFrame) -> DataFrame:
    """Feed records as landed JSON text, numbers as JSON numbers where they are numbers."""
    def loose(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(F.try_parse_json(value), value.cast("variant")).alias(name)

    record = F.struct(
        "id", "brand", "model", loose("year"), loose("kms"), loose("price"), "motorbike_type",
        loose("cc"), "emission_type", loose("num_seats"), loose("num_keys"), "deductible_vat",
    )
    return feed.select(F.to_json(F.struct(F.array(record).alias("motorbikes"))).alias("payload"))


@query
def src_json_feed(d: Inputs) -> DataFrame:
    folder = scratch_folder(d.spark, "feed")
    feed_envelopes(d.feed).write.text(folder)
    listings = extract.parse_feed(landed.read_feed(d.spark, folder))
    return shown(listings, [*BRONZE_SHOWN[:-1], extract.REASON])


@query
def src_json_column(d: Inputs) -> DataFrame:
    listings = extract.parse_feed(landed.explode_feed(feed_envelopes(d.feed)))
    return extract.count_by_reason(listings)


@query
def src_html_pages(d: Inputs) -> DataFrame:
    pages = landed.read_pages(d.spark, f"{d.sf_dir}/pages.parquet")
    return pages.select(
        "url", F.length("html").alias("characters"), F.md5("html").alias("html_md5")
    )


def stored_feed(d: Inputs) -> str:
    folder = scratch_folder(d.spark, "bronze")
    bronze.append_bronze(d.bronze_feed, folder, keep_dates=True)
    return folder


@query
def bronze_scan(d: Inputs) -> DataFrame:
    rows = bronze.scan_bronze(d.spark, stored_feed(d))
    return shown(rows, ["url_anuncio", "marca", "precio", "ingestion_date"])


@query
def bronze_scan_since(d: Inputs) -> DataFrame:
    """Only the date folders from a day on are read."""
    rows = bronze.scan_bronze(d.spark, stored_feed(d), since=dt.date(1998, 1, 1))
    return shown(rows, ["url_anuncio", "marca", "precio", "ingestion_date"])


@query
def optional_source(d: Inputs) -> DataFrame:
    folder = scratch_folder(d.spark, "optional")
    bronze.append_bronze(d.bronze_pages, f"{folder}/pages", day=dt.date(2024, 1, 2))
    present = tables.optional_table(d.spark, f"{folder}/pages", schema.BRONZE)
    absent = tables.optional_table(d.spark, f"{folder}/absent", schema.BRONZE)
    union = silver.union_listings(d.bronze_feed, present, absent)
    return quality.value_counts(union, "origen").withColumnRenamed("count", "rows")


@query
def bronze_schema(d: Inputs) -> DataFrame:
    return shown(bronze.in_bronze_schema(d.dirty), [
        "marca", "modelo", "anio", "km", "tipo", "precio", "cilindrada_cc", "url_anuncio",
        "origen", "ingestion_date",
    ])


@query
def bronze_stamp(d: Inputs) -> DataFrame:
    rows = bronze.stamp(d.bronze_feed, dt.date(2024, 3, 1))
    return rows.select("url_anuncio", "ingestion_date")


@query
def bronze_append_roundtrip(d: Inputs) -> DataFrame:
    folder = stored_feed(d)
    bronze.append_bronze(d.bronze_pages, folder, keep_dates=True)
    return shown(bronze.scan_bronze(d.spark, folder), BRONZE_SHOWN)


@query
def bronze_replace_dates(d: Inputs) -> DataFrame:
    """The same batch twice: replaced dates do not double."""
    folder = scratch_folder(d.spark, "bronze")
    written = [
        bronze.append_bronze(d.bronze_feed, folder, dt.date(2024, 3, 1), replace_dates=True)
        for _ in range(2)
    ]
    return bronze.newest_dates(bronze.scan_bronze(d.spark, folder)).withColumn(
        "reported", F.lit(written[1]).cast("bigint")
    )


@query
def bronze_empty(d: Inputs) -> DataFrame:
    folder = scratch_folder(d.spark, "empty")
    hopeless = d.bronze_feed.withColumn("km", -1 - F.col("km"))
    written = bronze.append_bronze(hopeless, folder)
    exists = tables.optional_table(d.spark, folder, schema.BRONZE) is not None
    return hopeless.agg(F.count(F.lit(1)).alias("rows_in")).select(
        "rows_in", F.lit(written).cast("bigint").alias("written"), F.lit(exists).alias("exists")
    )


@query
def bronze_partition_counts(d: Inputs) -> DataFrame:
    return bronze.newest_dates(bronze.scan_bronze(d.spark, stored_feed(d)))


@query
def silver_overwrite_roundtrip(d: Inputs) -> DataFrame:
    folder = scratch_folder(d.spark, "silver")
    sinks.overwrite(d.bronze_feed.select("url_anuncio", "km"), folder)
    sinks.overwrite(d.silver, folder)
    return shown(tables.read_table(d.spark, folder), BRONZE_SHOWN)


# --- extraction of feed records ----------------------------------------------

@query
def parse_json_listing(d: Inputs) -> DataFrame:
    return shown(d.feed_listings, [*BRONZE_SHOWN, extract.REASON])


@query
def map_kind(d: Inputs) -> DataFrame:
    return d.feed_listings.groupBy("tipo").agg(F.count(F.lit(1)).alias("rows"))


@query
def optional_int(d: Inputs) -> DataFrame:
    types = {f.name: f.dataType for f in d.feed.schema.fields}
    names = ["cc", "num_seats", "num_keys"]
    return d.feed.select(
        "id", *[numbers.optional_int(F.col(n), types[n]).alias(n) for n in names]
    )


@query
def valid_listing(d: Inputs) -> DataFrame:
    return d.feed_listings.select(
        "url_anuncio", "ingestion_date", extract.is_valid_listing().alias("valid")
    )


@query
def reject_counts(d: Inputs) -> DataFrame:
    counted = [
        extract.count_by_reason(listings).withColumn("source", F.lit(name))
        for name, listings in (("feed", d.feed_listings), ("pages", d.page_listings))
    ]
    return counted[0].unionByName(counted[1])


# --- extraction of pages -----------------------------------------------------

@query
def page_links(d: Inputs) -> DataFrame:
    return links.page_links(d.index_pages, contains="/", more_parts_than=1)


@query
def page_links_cap(d: Inputs) -> DataFrame:
    return links.first_links(
        d.index_pages, links.link_limit(15), contains="/", more_parts_than=1
    )


@query
def spec_map(d: Inputs) -> DataFrame:
    fields = extract.read_page_fields(d.pages)
    specs = F.col("specs")
    return fields.select(
        "url", "ingestion_date",
        F.coalesce(*[specs[label] for label in fixed.SPEC_YEAR]).alias("anio"),
        specs[fixed.SPEC_MODEL].alias("modelo"),
        F.coalesce(*[specs[label] for label in fixed.SPEC_KM]).alias("kilometros"),
        specs[fixed.SPEC_ENGINE].alias("cilindrada"),
        specs[fixed.SPEC_POWER].alias("potencia_maxima"),
        F.size(specs).alias("labels"),
    )


@query
def eu_price(d: Inputs) -> DataFrame:
    return extract.read_page_fields(d.pages).select(
        "url", "ingestion_date", numbers.european_price(F.col("price_text")).alias("precio")
    )


@query
def kind_from_url(d: Inputs) -> DataFrame:
    return d.page_fields.select("url", html.kind_segment(F.col("url")).alias("segment"))


@query
def brand_from_slug(d: Inputs) -> DataFrame:
    return d.page_fields.select("url", html.slug_brand(F.col("url")).alias("marca"))


@query
def unit_int(d: Inputs) -> DataFrame:
    return d.page_fields.select(
        "url", "ingestion_date",
        numbers.int_with_unit(F.col("cilindrada"), "CC").alias("cc"),
        numbers.int_with_unit(F.col("potencia_maxima"), "CV").alias("cv"),
    )


@query
def alt_keys(d: Inputs) -> DataFrame:
    specs = F.col("specs")
    return extract.read_page_fields(d.pages).select(
        "url", "ingestion_date",
        html.first_spec(specs, fixed.SPEC_YEAR, "0").alias("anio"),
        html.first_spec(specs, fixed.SPEC_KM, "0").alias("km"),
    )


@query
def parse_html_listing(d: Inputs) -> DataFrame:
    return shown(d.page_listings, [*BRONZE_SHOWN, extract.REASON])


# --- silver ------------------------------------------------------------------

@query
def silver_union(d: Inputs) -> DataFrame:
    narrow = d.bronze_pages.drop("num_plazas", "num_llaves")
    return shown(silver.union_listings(d.bronze_feed, narrow), BRONZE_SHOWN)


@query
def silver_cast(d: Inputs) -> DataFrame:
    return shown(
        silver.cast_numbers(d.dirty),
        ["url_anuncio", "ingestion_date", "km", "anio", "precio", "cilindrada_cc"],
    )


@query
def silver_normalise(d: Inputs) -> DataFrame:
    return silver.normalise_names(d.dirty).select("url_anuncio", "marca", "modelo")


CLEANED = ["url_anuncio", "ingestion_date", "marca", "modelo", "anio", "km", "precio",
           "cilindrada_cc"]


def required_rows(d: Inputs) -> DataFrame:
    return silver.require_columns(silver.normalise_names(silver.cast_numbers(d.dirty)))


@query
def silver_required(d: Inputs) -> DataFrame:
    return shown(required_rows(d), CLEANED)


@query
def silver_dedup(d: Inputs) -> DataFrame:
    return shown(silver.latest_per_key(required_rows(d)), CLEANED)


@query
def silver_range(d: Inputs) -> DataFrame:
    return shown(silver.within_ranges(required_rows(d), AS_OF_YEAR), CLEANED)


@query
def silver_clean(d: Inputs) -> DataFrame:
    """All cleaning steps on the unvalidated rows."""
    return shown(silver.to_silver(d.dirty, as_of_year=AS_OF_YEAR), CLEANED)


@query
def silver_by_bucket(d: Inputs) -> DataFrame:
    """Raw rows arriving in three stretches of days, each merged into the buckets it touches."""
    folder = scratch_folder(d.spark, "buckets")
    for name, rows in (("feed", d.bronze_feed), ("pages", d.bronze_pages)):
        sinks.overwrite(rows, f"{folder}/{name}")
        forget_shuffles(d.spark)
    feed, pages = (tables.read_table(d.spark, f"{folder}/{name}") for name in ("feed", "pages"))
    day = F.col(schema.DATE)
    first, second = F.lit(dt.date(1997, 1, 1)), F.lit(dt.date(1999, 1, 1))
    target = f"{folder}/silver"
    silver_buckets.rebuild(target, 16, feed.filter(day < first), pages.filter(day < first))
    for stretch in ((day >= second), (day >= first) & (day < second)):
        silver_buckets.merge(target, 16, feed.filter(stretch), pages.filter(stretch))
    for name in ("feed", "pages"):  # the result reads the buckets alone
        release(d.spark, f"{folder}/{name}")
    return shown(silver_buckets.clean_rows(d.spark, target, 16, AS_OF_YEAR), BRONZE_SHOWN)


def _silver(d: Inputs) -> DataFrame:
    return shown(d.silver, BRONZE_SHOWN)


REGISTERED["silver"] = lambda spark, sf_dir: _silver(Inputs(spark, sf_dir))


# --- gold --------------------------------------------------------------------

@query
def feat_age(d: Inputs) -> DataFrame:
    return d.silver.select("url_anuncio", gold.age(AS_OF_YEAR).alias("edad_anios"))


@query
def feat_km_bucket(d: Inputs) -> DataFrame:
    return silver.cast_numbers(d.dirty).select(
        "url_anuncio", "ingestion_date", "km", gold.km_band().alias("km_bucket")
    )


@query
def feat_kind(d: Inputs) -> DataFrame:
    return d.silver.select("url_anuncio", gold.feature_kind().alias("tipo_normalizado"))


@query
def feat_log_price(d: Inputs) -> DataFrame:
    return d.silver.select("url_anuncio", F.round(gold.log_price(), 6).alias("log_precio"))


@query
def feat_defaults(d: Inputs) -> DataFrame:
    return d.silver.withColumns(gold.filled_defaults()).select(
        "url_anuncio", "distintivo_ambiental", "num_plazas", "num_llaves", "iva_deducible"
    )


def gold_shown(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "precio": price(), "log_precio": F.round("log_precio", 6),
    }).drop("ubicacion")


def _gold(d: Inputs) -> DataFrame:
    return gold_shown(d.gold)


REGISTERED["gold"] = lambda spark, sf_dir: _gold(Inputs(spark, sf_dir))


# --- profiling ---------------------------------------------------------------

@query
def value_counts(d: Inputs) -> DataFrame:
    labelled = d.bronze_feed.withColumnRenamed("distintivo_ambiental", "label")
    return quality.value_counts(labelled, "label").withColumnRenamed("count", "rows")


@query
def top_brands(d: Inputs) -> DataFrame:
    return quality.value_counts(d.silver, "marca", top=10, keep_null=True).withColumnRenamed(
        "count", "rows"
    )


@query
def describe_price(d: Inputs) -> DataFrame:
    stats = quality.describe_number(d.bronze_feed, "precio")
    return stats.select("count", *[F.round(c, 4).alias(c) for c in stats.columns[1:]])


@query
def kind_counts(d: Inputs) -> DataFrame:
    return quality.value_counts(d.gold, "tipo_normalizado").withColumnRenamed("count", "rows")


@query
def price_stats(d: Inputs) -> DataFrame:
    stats = quality.price_stats(d.silver)
    return stats.select(*[
        F.round(F.col(c).cast("double"), 4 if c == "media" else 2).alias(c) for c in stats.columns
    ])


@query
def null_audit(d: Inputs) -> DataFrame:
    columns = [*quality.AUDITED, "cilindrada_cc", "potencia_cv", "ubicacion"]
    return quality.null_audit(d.gold, columns)


@query
def bucket_counts(d: Inputs) -> DataFrame:
    return quality.counts_by_label(d.gold, "km_bucket").withColumnRenamed("count", "rows")


@query
def price_correlations(d: Inputs) -> DataFrame:
    pairs = [("edad_anios", "precio"), ("km", "precio")]
    found = quality.correlations(d.gold, pairs)
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query
def preview(d: Inputs) -> DataFrame:
    return gold_shown(quality.preview(d.gold, ["precio", "url_anuncio"], 20))


@query
def guards(d: Inputs) -> DataFrame:
    """The guard lets a good frame through and stops an empty one."""
    none = extract.accepted(d.feed_listings).filter(F.col("km") < 0)
    try:
        quality.require_rows(none, "nothing parsed")
        stopped = False
    except ValueError:
        stopped = True
    checked = quality.require_rows(d.bronze_feed, "nothing parsed")
    return checked.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "empty_stopped", F.lit(stopped)
    )


# --- learning ----------------------------------------------------------------

def training_frame(d: Inputs, source: str = "all", stored: bool = True) -> DataFrame:
    """The rows to learn from; stored first where they are read more than once."""
    return split.training_rows(d.stored_gold if stored else d.gold, source)


LEARNED = [*fixed.CATEGORY_COLUMNS, *fixed.NUMERIC_COLUMNS, "precio", "url_anuncio"]


@query
def training_set(d: Inputs) -> DataFrame:
    return shown(training_frame(d, stored=False), LEARNED)


@query
def training_source_filter(d: Inputs) -> DataFrame:
    return shown(training_frame(d, fixed.PAGE_SOURCE.upper(), stored=False), ["url_anuncio", "origen", "precio"])


@query
def training_source_feed(d: Inputs) -> DataFrame:
    return shown(training_frame(d, fixed.FEED_SOURCE, stored=False), ["url_anuncio", "origen", "precio"])


@query
def min_rows_guard(d: Inputs) -> DataFrame:
    rows = training_frame(d)
    total = split.require_min_rows(rows, 100)
    try:
        split.require_min_rows(rows, total + 1)
        stopped = False
    except split.TooFewRows:
        stopped = True
    return rows.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(total).cast("bigint").alias("counted"), F.lit(stopped).alias("stopped_above")
    )


@query
def train_test_split(d: Inputs) -> DataFrame:
    marked = split.with_fold(split.mark_test(training_frame(d, stored=False)))
    return marked.select("url_anuncio", "is_test", "fold")


def indexed_rows(d: Inputs) -> tuple[features.Labels, DataFrame]:
    """Labels ranked on the training side, and all rows with their ranks."""
    rows = training_frame(d)
    train, _ = split.split(rows)
    labels = features.rank_labels(train)
    return labels, features.indexed(rows, labels)


@query
def category_index(d: Inputs) -> DataFrame:
    return indexed_rows(d)[1].select(
        "url_anuncio", *[F.col(c).cast("int").alias(c) for c in features.index_columns()]
    )


@query
def one_hot(d: Inputs) -> DataFrame:
    _, rows = indexed_rows(d)
    return features.one_hot().fit(rows).transform(rows).select(
        "url_anuncio", *[features.hot_slot(c).cast("int").alias(c)
                         for c in features.one_hot_columns()]
    )


@query
def feature_names(d: Inputs) -> DataFrame:
    """The feature each vector slot stands for."""
    return indexed_rows(d)[0].slots().select("slot", F.col("Feature").alias("feature"))


@query
def feature_vector(d: Inputs) -> DataFrame:
    _, rows = indexed_rows(d)
    n = len(fixed.NUMERIC_COLUMNS)
    vector = F.col("v")
    slots = F.filter(
        F.transform(
            F.slice(vector, F.lit(1), F.size(vector) - n), lambda x, i: F.when(x == 1, i)
        ),
        lambda i: i.isNotNull(),
    )
    return (
        features.vectoriser(rows).transform(rows)
        .select("url_anuncio", vector_to_array(features.FEATURES).alias("v"))
        .select(
            "url_anuncio",
            F.size(vector).alias("size"),
            F.concat_ws(",", slots.cast("array<string>")).alias("slots"),
            *[
                F.element_at(vector, i - n).cast("int").alias(c)
                for i, c in enumerate(fixed.NUMERIC_COLUMNS)
            ],
        )
    )


def trained(d: Inputs, model) -> tuple[training.PriceModel, DataFrame]:
    """A model fitted on the training side, and the held-out rows."""
    train, test = split.split(shown(training_frame(d), [*LEARNED, "modelo"]))
    return training.fit_price_model(model, train), test


def first_forest():
    """The smallest point of the forest's grid."""
    return training.forest(numTrees=FOREST.sizes[0], maxDepth=FOREST.depths[0])


@query
def rf_predict(d: Inputs) -> DataFrame:
    model, test = trained(d, first_forest())
    return model.transform(test).select("url_anuncio", "precio", "prediction")


@query
def gbt_predict(d: Inputs) -> DataFrame:
    model, test = trained(d, training.boost(maxIter=BOOST.sizes[0], maxDepth=BOOST.depths[0]))
    return model.transform(test).select("url_anuncio", "precio", "prediction")


@query
def cv_grid_results(d: Inputs) -> DataFrame:
    train, _ = split.split(shown(training_frame(d), LEARNED))
    return training.grid_results(d.spark, training.cross_validate(FOREST, split.with_fold(train)))


def mean_predictions(d: Inputs, source: str = "all") -> DataFrame:
    """Held-out rows with the mean price of their group: a predictor SQL can repeat."""
    train, test = split.split(training_frame(d, source))
    return evaluation.mean_price_by(train, test)


def rounded_metrics(predictions: DataFrame) -> DataFrame:
    scores = evaluation.regression_metrics(predictions)
    return scores.select(
        F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"),
        F.round("r2", 6).alias("r2"), "rows",
    )


@query
def regression_metrics(d: Inputs) -> DataFrame:
    return rounded_metrics(mean_predictions(d))


@query
def sample_predictions(d: Inputs) -> DataFrame:
    return shown(
        evaluation.sample_predictions(mean_predictions(d)), evaluation.REPORT_COLUMNS
    )


@query
def prediction_errors(d: Inputs) -> DataFrame:
    return evaluation.with_errors(mean_predictions(d)).select(
        "url_anuncio", evaluation.rounded("error_absoluto", 4),
        evaluation.rounded("error_porcentual", 4),
    )


WORST = ["marca", "modelo", "tipo_normalizado", "anio", "km", "precio", "prediction",
         "error_absoluto", "error_porcentual", "url_anuncio"]


@query
def worst_predictions(d: Inputs) -> DataFrame:
    return shown(evaluation.worst_predictions(mean_predictions(d)), WORST)


@query
def report_csv(d: Inputs) -> DataFrame:
    folder = scratch_folder(d.spark, "report")
    sinks.write_report(evaluation.worst_predictions(mean_predictions(d)), folder)
    return shown(
        d.spark.read.option("header", True).schema(
            "marca STRING, modelo STRING, tipo_normalizado STRING, anio INT, km INT, "
            "precio DOUBLE, prediction DOUBLE, error_absoluto DOUBLE, error_porcentual DOUBLE, "
            "url_anuncio STRING"
        ).csv(folder),
        WORST,
    )


@query
def feature_importance(d: Inputs) -> DataFrame:
    model, _ = trained(d, first_forest())
    return evaluation.feature_importance(d.spark, model.trees, model.labels)


@query
def model_roundtrip(d: Inputs) -> DataFrame:
    """A stored model predicts what the fitted one does."""
    model, test = trained(d, first_forest())
    folder = scratch_folder(d.spark, "model")
    model.save(folder)
    stored = training.PriceModel.load(d.spark, folder)
    both = model.transform(test).select("*", F.col("prediction").alias("fitted")).drop(
        "prediction", features.FEATURES, *features.index_columns(), *features.one_hot_columns()
    )
    return stored.transform(both).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("prediction") != F.col("fitted")).alias("differing"),
    )


def logged_runs(d: Inputs) -> DataFrame:
    """Three runs, one per source choice, scored with the mean predictor."""
    target = f"{scratch_folder(d.spark, 'runs')}/runs"
    for hour, source in enumerate(["all", fixed.FEED_SOURCE, fixed.PAGE_SOURCE]):
        scores = evaluation.regression_metrics(mean_predictions(d, source)).first()
        metrics = {"rmse": scores["rmse"], "mae": scores["mae"]}
        if source != "all":
            metrics["r2"] = scores["r2"]
        started = dt.datetime(2024, 3, 1, hour, tzinfo=dt.timezone.utc).timestamp()
        runs.log_run(
            d.spark, target, runs.new_run_id(), f"mean price, {source}", started,
            {"origen_filter": source, "total_rows": str(scores["rows"])}, metrics,
            "mean-price", runs.next_version(d.spark, target, "mean-price"), target,
        )
    return tables.read_table(d.spark, target, runs.RUNS)


@query
def run_log(d: Inputs) -> DataFrame:
    return logged_runs(d).select(
        "run_name", "version", F.col("params")["origen_filter"].alias("origen_filter"),
        F.col("params")["total_rows"].alias("total_rows"),
        F.round(F.col("metrics")["rmse"], 4).alias("rmse"),
    )


@query
def run_history(d: Inputs) -> DataFrame:
    return runs.latest_runs(logged_runs(d), 2).select(
        "run_name", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"),
        F.round("r2", 6).alias("r2"),
    )


@query
def run_missing_metric(d: Inputs) -> DataFrame:
    """The run that logged no r2 shows 0."""
    return runs.latest_runs(logged_runs(d)).filter("r2 = 0").select("run_name", "r2")


@query
def end_to_end(d: Inputs) -> DataFrame:
    """Landed data through all layers into tables: rows of each layer, and rejects by reason."""
    folder = scratch_folder(d.spark, "all")
    feed_envelopes(d.feed).write.text(f"{folder}/landed/feed")
    d.pages.select("url", "html").write.parquet(f"{folder}/landed/pages")
    where = Tables(root=folder)
    summary = medallion.run(
        d.spark, where,
        Training(output_dir=f"{folder}/output"),
        medallion.Sources(
            landed.read_feed(d.spark, f"{folder}/landed/feed"),
            landed.read_pages(d.spark, f"{folder}/landed/pages"),
        ),
        as_of_year=AS_OF_YEAR, day=dt.date(2024, 3, 1),
    )
    def measured(layer: str, price: str | None = None) -> DataFrame:
        # Prices as cents, so that sums do not depend on the order of addition.
        cents = F.sum(F.round(F.col(price).cast("double") * 100).cast("bigint")) if price else F.lit(None).cast("bigint")
        return tables.read_table(d.spark, where.locate(layer)).agg(
            F.count(F.lit(1)).alias("rows"), cents.alias("cents")
        ).select(F.lit(layer).alias("layer"), "rows", "cents")

    result = measured("bronze_feed", "precio")
    for layer in ("bronze_pages", "silver", "gold"):
        result = result.unionByName(measured(layer, "precio" if layer == "bronze_pages" else None))
    rejected = [
        (f"{name} rejected, {reason}", n, None)
        for name, source in (("feed", summary.feed), ("pages", summary.pages))
        for reason, n in source.rejected.items()
    ]
    runs_found = tables.read_table(d.spark, where.locate("runs"), runs.RUNS).filter(
        F.col("run_id").isin([o.run_id for o in summary.outcomes])
    ).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("runs").alias("layer"), "rows", F.lit(None).cast("bigint").alias("cents")
    )
    return result.unionByName(runs_found).unionByName(
        d.spark.createDataFrame(rejected, "layer STRING, rows BIGINT, cents BIGINT")
    )
