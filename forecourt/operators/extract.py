"""Raw records -> typed listings with a reject reason.

Nothing is dropped here.  Every input row comes out once, in the bronze layout
plus `reject_reason` (NULL for a good listing), so `accepted`, `rejected` and
`count_by_reason` are views of one plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import fixed_values as fixed
from forecourt import schema
from forecourt.functions import html, labels, numbers
from forecourt.functions.page_batches import read_pages
from forecourt.functions.staging import settle

REASON = "reject_reason"
#: What a rejected row was before, as JSON; only where it is asked for.
RAW = "raw"
REASONS = [
    "bad_page", "no_id", "bad_year", "bad_km", "bad_price", "bad_option",
    "no_brand", "no_model", "old_year", "negative_km", "no_price",
]


def is_valid_listing() -> Column:
    """Brand and model not empty, year after 1980, mileage not negative, price positive."""
    return F.coalesce(_rule_broken().isNull(), F.lit(False))


def _rule_broken() -> Column:
    price = F.col("precio")
    return (
        F.when(F.coalesce(F.col("marca"), F.lit("")) == "", "no_brand")
        .when(F.coalesce(F.col("modelo"), F.lit("")) == "", "no_model")
        .when(F.col("anio").isNull() | (F.col("anio") <= fixed.MIN_VALID_YEAR), "old_year")
        .when(F.col("km").isNull() | (F.col("km") < 0), "negative_km")
        .when(price.isNull() | F.isnan(price) | (price <= 0), "no_price")
    )


def _in_bronze_layout(df: DataFrame, unreadable: Column) -> DataFrame:
    """Fill missing bronze columns with NULL and add the reject reason.

    The columns are settled first: the reason reads most of them, later filters read the
    reason, and each copy would read its number or text from the record again.
    """
    present = set(df.columns)
    df = settle(df, *df.columns)
    columns = [
        F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.BRONZE.fields
    ]
    judged = df.select(
        *columns, F.coalesce(unreadable, _rule_broken()).alias(REASON), *[F.col(c) for c in (RAW,) if c in present])
    if RAW not in present:
        return judged
    return judged.withColumn(RAW, F.when(F.col(REASON).isNotNull(), F.col(RAW)))


FEED_FIELDS = [
    "id", "brand", "model", "year", "kms", "price", "motorbike_type", "cc", "emission_type", "num_seats",
    "num_keys", "deductible_vat",
]


def parse_feed(records: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Flat feed records (text, numeric or VARIANT fields) -> listings.

    keep_raw adds what a rejected record was, as JSON; a page that is no JSON has none.
    """
    types = {f.name: f.dataType for f in records.schema.fields}

    def whole(name: str) -> Column:
        return numbers.read_int(F.col(name), types[name])

    def optional(name: str) -> Column:
        return numbers.optional_int(F.col(name), types[name])

    def given(name: str) -> Column:
        return numbers.is_set(F.col(name), types[name]).alias(f"_{name}_given")

    carried = [c for c in (schema.DATE,) if c in types]
    typed = records.select(
        F.col("brand").alias("marca"),
        F.col("model").alias("modelo"),
        whole("year").alias("anio"),
        whole("kms").alias("km"),
        labels.kind_of(F.col("motorbike_type")).alias("tipo"),
        numbers.read_float(F.col("price"), types["price"]).alias("precio"),
        optional("cc").alias("cilindrada_cc"),
        F.concat(
            F.lit(fixed.FEED_URL_PREFIX), F.col("id").cast("string"), F.lit(fixed.FEED_URL_SUFFIX)
        ).alias("url_anuncio"),
        F.col("emission_type").alias("distintivo_ambiental"),
        optional("num_seats").alias("num_plazas"),
        optional("num_keys").alias("num_llaves"),
        numbers.read_flag(F.col("deductible_vat"), types["deductible_vat"]).alias("iva_deducible"),
        F.lit(fixed.FEED_SOURCE).alias("origen"),
        *carried,
        given("cc"), given("num_seats"), given("num_keys"),
        (F.col("bad_page") if "bad_page" in types else F.lit(False)).alias("_bad_page"),
        *([F.to_json(F.struct(*[c for c in FEED_FIELDS if c in types])).alias(RAW)] if keep_raw else []),
    )
    if keep_raw:
        typed = typed.withColumn(RAW, F.when(~F.col("_bad_page"), F.col(RAW)))
    broken_option = (
        (F.col("_cc_given") & F.col("cilindrada_cc").isNull())
        | (F.col("_num_seats_given") & F.col("num_plazas").isNull())
        | (F.col("_num_keys_given") & F.col("num_llaves").isNull())
    )
    unreadable = (
        F.when(F.col("_bad_page"), "bad_page")
        .when(F.col("url_anuncio").isNull(), "no_id")
        .when(F.col("anio").isNull(), "bad_year")
        .when(F.col("km").isNull(), "bad_km")
        .when(F.col("precio").isNull(), "bad_price")
        .when(broken_option, "bad_option")
    )
    return _in_bronze_layout(typed, unreadable)


def read_page_fields(pages: DataFrame, keep_raw: bool = False) -> DataFrame:
    """(url, html) -> label map, price text, url (and the date, if the pages carry one).

    Each page is read once: the reader runs on whole Arrow batches, no filter of later
    stages is copied below it, and the markup itself is carried on only for keep_raw.
    """
    rest = [c for c in ("url", schema.DATE) if c in pages.columns]
    raw = [F.to_json(F.struct("url", "html")).alias(RAW)] if keep_raw else []
    rows = pages.select(F.col("html").cast("string").alias("html"), *rest, *raw)
    rest += [RAW] * keep_raw
    fields = T.StructType([
        T.StructField("specs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("price_text", T.StringType()),
        *[rows.schema[c] for c in rest],
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            specs, prices = read_pages(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [specs, prices, *batch.columns[1:]], names=fields.names)

    return rows.mapInArrow(read, fields)


def parse_page_fields(fields: DataFrame) -> DataFrame:
    """Fields of listing pages -> listings."""
    specs, url = F.col("specs"), F.col("url")
    carried = [c for c in (schema.DATE, RAW) if c in fields.columns]
    typed = fields.select(
        html.slug_brand(url).alias("marca"),
        html.first_spec(specs, [fixed.SPEC_MODEL], fixed.UNKNOWN_MODEL).alias("modelo"),
        numbers.int_from_text(html.first_spec(specs, fixed.SPEC_YEAR, "0")).alias("anio"),
        numbers.int_from_text(html.first_spec(specs, fixed.SPEC_KM, "0")).alias("km"),
        labels.kind_of(F.upper(html.kind_segment(url))).alias("tipo"),
        numbers.european_price(F.col("price_text")).alias("precio"),
        numbers.int_with_unit(
            F.try_element_at(specs, F.lit(fixed.SPEC_ENGINE)), "CC"
        ).alias("cilindrada_cc"),
        numbers.int_with_unit(
            F.try_element_at(specs, F.lit(fixed.SPEC_POWER)), "CV"
        ).alias("potencia_cv"),
        url.alias("url_anuncio"),
        F.lit(fixed.PAGE_SOURCE).alias("origen"),
        *carried,
    )
    unreadable = F.when(F.col("anio").isNull(), "bad_year").when(F.col("km").isNull(), "bad_km")
    return _in_bronze_layout(typed, unreadable)


def parse_pages(pages: DataFrame, keep_raw: bool = False) -> DataFrame:
    """(url, html) -> listings; keep_raw adds what a rejected page was, as JSON."""
    return parse_page_fields(read_page_fields(pages, keep_raw))


def accepted(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col(REASON).isNotNull())


def count_by_reason(listings: DataFrame) -> DataFrame:
    """Rows per reject reason; 'accepted' for the good ones."""
    return listings.groupBy(F.coalesce(F.col(REASON), F.lit("accepted")).alias(REASON)).agg(
        F.count(F.lit(1)).alias("rows")
    )
