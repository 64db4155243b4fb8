"""The same results in plain SQL, written from the tables on.

Each query is a chain of named parts; `_sql` puts the parts it needs in front.
Page queries start from the page fields, not from the markup made of them, so
the extraction is checked against its source values.
"""

from __future__ import annotations

from forecourt import fixed_values as fixed
from forecourt.catalogue import fixtures

_AS_OF = fixtures.AS_OF_YEAR
_TABLES = {"lineitem": "lineitem", "part": "part"}


def _cases(column: str) -> str:
    whens = " ".join(f"WHEN '{code}' THEN '{kind}'" for code, kind in fixed.KIND_BY_CODE.items())
    return f"CASE {column} {whens} ELSE '{fixed.OTHER_KIND}' END"


_RULES = """
 CASE WHEN coalesce(marca, '') = '' THEN 'no_brand' WHEN coalesce(modelo, '') = '' THEN 'no_model'
      WHEN anio <= 1980 THEN 'old_year' WHEN km < 0 THEN 'negative_km'
      WHEN isnan(precio) OR precio <= 0 THEN 'no_price' END
"""

_SHOWN = """marca, modelo, anio, km, tipo, round(CAST(precio AS DOUBLE), 2) AS precio, cilindrada_cc,
 potencia_cv, url_anuncio, distintivo_ambiental, num_plazas, num_llaves, iva_deducible, origen,
 ingestion_date"""

_ORDER = """ingestion_date DESC NULLS LAST, marca NULLS FIRST, modelo NULLS FIRST,
 anio NULLS FIRST, km NULLS FIRST, {kind} precio NULLS FIRST, cilindrada_cc NULLS FIRST {rest}"""

_SLUG = "list_extract(string_split(trim(url, '/'), '/'), -1)"
_SEGMENT = f"coalesce(list_extract(string_split(url, '/'), -3), '{fixed.OTHER_KIND}')"
_PAGE_PRICE = """coalesce(TRY_CAST(replace(replace(replace(precio, '€', ''), '.', ''), ',', '.')
 AS DOUBLE), 0.0)"""


def _fraction(first: int) -> str:
    return f"CAST('0x' || substr(md5('42|' || url_anuncio), {first}, 8) AS BIGINT)"


def _unit(column: str, unit: str) -> str:
    digits = f"trim(replace(upper({column}), '{unit}', ''))"
    return f"CASE WHEN regexp_full_match({digits}, '[0-9]+') THEN TRY_CAST({digits} AS INT) END"


_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_a": ((), fixtures.RAW_FEED.format(**_TABLES)),
    "raw_b": ((), fixtures.RAW_PAGE_FIELDS.format(**_TABLES)),
    "typed_a": (("raw_a",), f"""
SELECT brand AS marca, model AS modelo, TRY_CAST(year AS INT) AS anio, TRY_CAST(kms AS INT) AS km,
 {_cases('motorbike_type')} AS tipo, TRY_CAST(price AS DOUBLE) AS precio,
 nullif(cc, 0) AS cilindrada_cc, CAST(NULL AS INT) AS potencia_cv,
 '{fixed.FEED_URL_PREFIX}' || id || '{fixed.FEED_URL_SUFFIX}' AS url_anuncio,
 emission_type AS distintivo_ambiental, TRY_CAST(num_seats AS INT) AS num_plazas,
 TRY_CAST(num_keys AS INT) AS num_llaves, deductible_vat AS iva_deducible,
 '{fixed.FEED_SOURCE}' AS origen, ingestion_date, num_keys, num_seats
FROM raw_a"""),
    "listings_a": (("typed_a",), f"""
SELECT * EXCLUDE (num_keys, num_seats),
 coalesce(CASE WHEN anio IS NULL THEN 'bad_year' WHEN km IS NULL THEN 'bad_km'
   WHEN precio IS NULL THEN 'bad_price'
   WHEN (num_keys <> '' AND num_llaves IS NULL) OR (num_seats <> '' AND num_plazas IS NULL)
   THEN 'bad_option' END, {_RULES}) AS reject_reason
FROM typed_a"""),
    "typed_b": (("raw_b",), f"""
SELECT CASE WHEN contains({_SLUG}, '-') THEN upper(split_part({_SLUG}, '-', 1))
            ELSE '{fixed.UNKNOWN_BRAND}' END AS marca,
 coalesce(trim(modelo), '{fixed.UNKNOWN_MODEL}') AS modelo,
 TRY_CAST(coalesce(anio, '0') AS INT) AS anio,
 CASE WHEN regexp_full_match(kilometros, '[0-9]+') THEN TRY_CAST(kilometros AS INT) END AS km,
 {_cases(f'upper({_SEGMENT})')} AS tipo, {_PAGE_PRICE} AS precio,
 {_unit('cilindrada', 'CC')} AS cilindrada_cc, {_unit('potencia_maxima', 'CV')} AS potencia_cv,
 url AS url_anuncio, CAST(NULL AS VARCHAR) AS distintivo_ambiental,
 CAST(NULL AS INT) AS num_plazas, CAST(NULL AS INT) AS num_llaves,
 CAST(NULL AS BOOLEAN) AS iva_deducible, '{fixed.PAGE_SOURCE}' AS origen, ingestion_date
FROM raw_b"""),
    "listings_b": (("typed_b",), f"""
SELECT *, coalesce(CASE WHEN anio IS NULL THEN 'bad_year' WHEN km IS NULL THEN 'bad_km' END,
 {_RULES}) AS reject_reason
FROM typed_b"""),
    "bronze_a": (("listings_a",),
                 "SELECT * EXCLUDE (reject_reason) FROM listings_a WHERE reject_reason IS NULL"),
    "bronze_b": (("listings_b",),
                 "SELECT * EXCLUDE (reject_reason) FROM listings_b WHERE reject_reason IS NULL"),
    "bronze": (("bronze_a", "bronze_b"),
               "SELECT * FROM bronze_a UNION ALL BY NAME SELECT * FROM bronze_b"),
    "typed": (("bronze",), """
SELECT * REPLACE (upper(trim(marca)) AS marca, trim(modelo) AS modelo,
 CAST(precio AS FLOAT) AS precio) FROM bronze"""),
    "ranked": (("typed",), f"""
SELECT *, row_number() OVER (PARTITION BY url_anuncio ORDER BY {_ORDER.format(
    kind='tipo NULLS FIRST,',
    rest=''', potencia_cv NULLS FIRST, distintivo_ambiental NULLS FIRST, num_plazas NULLS FIRST,
 num_llaves NULLS FIRST, iva_deducible NULLS FIRST, origen NULLS FIRST''')}) AS rn
FROM typed WHERE marca IS NOT NULL AND modelo IS NOT NULL AND anio IS NOT NULL
 AND km IS NOT NULL AND precio IS NOT NULL AND NOT isnan(precio)"""),
    "silver": (("ranked",), f"""
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1 AND precio BETWEEN 100 AND 100000
 AND anio BETWEEN 1980 AND {_AS_OF} AND km >= 0"""),
    "gold": (("silver",), f"""
SELECT marca, modelo, anio, {_AS_OF} - anio AS edad_anios, km,
 CASE WHEN km < 10000 THEN '0-10k' WHEN km < 30000 THEN '10k-30k' WHEN km < 60000 THEN '30k-60k'
      ELSE '60k+' END AS km_bucket,
 CASE WHEN tipo IN ('naked', 'trail', 'scooter', 'deportiva', 'custom', 'touring', 'enduro')
      THEN tipo ELSE 'otro' END AS tipo_normalizado,
 cilindrada_cc, potencia_cv, coalesce(distintivo_ambiental, 'desconocido') AS distintivo_ambiental,
 coalesce(num_plazas, 2) AS num_plazas, coalesce(num_llaves, 1) AS num_llaves,
 CASE WHEN iva_deducible THEN 'true' ELSE 'false' END AS iva_deducible,
 origen, precio, ln(CAST(precio AS DOUBLE)) AS log_precio, url_anuncio
FROM silver"""),
    "dirty": (("raw_a",), fixtures.RAW_DIRTY.format(feed="raw_a")),
    "dirty_cast": (("dirty",), """
SELECT marca, modelo, TRY_CAST(anio AS INT) AS anio, TRY_CAST(km AS INT) AS km,
 CAST(TRY_CAST(precio AS DOUBLE) AS FLOAT) AS precio,
 TRY_CAST(cilindrada_cc AS INT) AS cilindrada_cc, url_anuncio, ingestion_date FROM dirty"""),
    "required": (("dirty_cast",), """
SELECT * REPLACE (upper(trim(marca)) AS marca, trim(modelo) AS modelo) FROM dirty_cast
WHERE marca IS NOT NULL AND modelo IS NOT NULL AND anio IS NOT NULL AND km IS NOT NULL
 AND precio IS NOT NULL"""),
    "dirty_latest": (("required",), f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url_anuncio
 ORDER BY {_ORDER.format(kind='', rest='')}) AS rn FROM required) WHERE rn = 1"""),
    "train_all": (("gold",), f"""
SELECT *, {_fraction(1)} / 4294967296.0 < 0.2 AS is_test FROM gold
WHERE cilindrada_cc IS NOT NULL"""),
    "fitted_rows": (("train_all",), "SELECT * FROM train_all WHERE NOT is_test"),
    "means": (("fitted_rows",), """
SELECT marca, tipo_normalizado,
 CAST(sum(CAST(CAST(precio AS DOUBLE) AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS prediction
FROM fitted_rows GROUP BY ALL"""),
    "predicted": (("train_all", "means"), """
SELECT *, abs(CAST(precio AS DOUBLE) - prediction) AS error_absoluto,
 abs(CAST(precio AS DOUBLE) - prediction) / CAST(precio AS DOUBLE) * 100 AS error_porcentual
FROM (SELECT t.*, coalesce(m.prediction, (SELECT
  CAST(sum(CAST(CAST(precio AS DOUBLE) AS DECIMAL(18, 2))) AS DOUBLE) / count(*) FROM fitted_rows))
  AS prediction
 FROM train_all t LEFT JOIN means m USING (marca, tipo_normalizado) WHERE is_test)"""),
    "page_hrefs": ((), """
SELECT page_id, unnest(regexp_extract_all(regexp_replace(html,
 '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'),
 '(?is)<a\\b[^>]*?\\shref\\s*=\\s*"([^"]*)"', 1)) AS href,
 generate_subscripts(regexp_extract_all(regexp_replace(html,
 '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'),
 '(?is)<a\\b[^>]*?\\shref\\s*=\\s*"([^"]*)"', 1), 1) AS i
FROM pages"""),
    "found_links": (("page_hrefs",), """
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(i)) - 1 AS INT)
 AS position, link
FROM (SELECT page_id, i, replace(replace(replace(href, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')
      AS link FROM page_hrefs)
WHERE contains(link, '/') GROUP BY page_id, link"""),
}

# Label ranks per category: most frequent first, ties by label.
for _c in fixed.CATEGORY_COLUMNS:
    _PARTS[f"rank_{_c}"] = (("fitted_rows",), f"""
SELECT {_c} AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, {_c}) - 1 AS INT) AS pos
FROM fitted_rows WHERE {_c} IS NOT NULL GROUP BY {_c}""")
_RANKS = tuple(f"rank_{c}" for c in fixed.CATEGORY_COLUMNS)
_RANK_JOINS = " ".join(
    f"LEFT JOIN rank_{c} ON train_all.{c} = rank_{c}.label" for c in fixed.CATEGORY_COLUMNS
)


def _offset(index: int) -> str:
    earlier = fixed.CATEGORY_COLUMNS[:index]
    return " + ".join(["0", *[f"(SELECT count(*) FROM rank_{c})" for c in earlier]])


def _sql(*needs: str, body: str) -> str:
    """The body after the parts it needs, each part once and after its own needs."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in ordered:
            below, text = _PARTS[name]
            for part in below:
                add(part)
            ordered[name] = text.strip()

    for name in needs:
        add(name)
    if not ordered:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in ordered.items()) + "\n" + body.strip()


_CLEANED = """url_anuncio, ingestion_date, marca, modelo, anio, km,
 round(CAST(precio AS DOUBLE), 2) AS precio, cilindrada_cc"""
_GOLD = """marca, modelo, anio, edad_anios, km, km_bucket, tipo_normalizado, cilindrada_cc,
 potencia_cv, distintivo_ambiental, num_plazas, num_llaves, iva_deducible, origen,
 round(CAST(precio AS DOUBLE), 2) AS precio, round(log_precio, 6) AS log_precio, url_anuncio"""
_METRICS = """round(sqrt(avg(error_absoluto * error_absoluto)), 4) AS rmse,
 round(avg(error_absoluto), 4) AS mae,
 round(1 - sum(error_absoluto * error_absoluto) / (var_pop(CAST(precio AS DOUBLE)) * count(*)), 6)
 AS r2"""
# Few decimals, halves up, from a value free of binary noise.
_TWO = "CAST(round(CAST({0} AS DECIMAL(38, 8)), 2) AS DOUBLE) AS {0}"
_FOUR = "CAST(round(CAST({0} AS DECIMAL(38, 8)), 4) AS DOUBLE) AS {0}"


def _metrics_of(source: str) -> str:
    """Mean-predictor metrics when only one source is used."""
    needs = ("gold",)
    only = "" if source == "all" else f" AND origen = '{source}'"
    parts = _sql(*needs, body="")
    chain = parts.strip() + f""",
train_all AS (SELECT *, {_fraction(1)} / 4294967296.0 < 0.2 AS is_test FROM gold
 WHERE cilindrada_cc IS NOT NULL{only}),
fitted_rows AS ({_PARTS['fitted_rows'][1]}), means AS ({_PARTS['means'][1]}),
predicted AS ({_PARTS['predicted'][1]})
SELECT {_METRICS}, count(*) AS n FROM predicted"""
    return chain


_SOURCES = ["all", fixed.FEED_SOURCE, fixed.PAGE_SOURCE]

ORACLES: dict[str, str] = {
    # sources and sinks
    "src_json_feed": _sql("listings_a", body=f"""
SELECT {_SHOWN.replace(' origen,', ' origen').replace('ingestion_date', '')}, reject_reason
FROM listings_a"""),
    "src_json_column": _sql("listings_a", body="""
SELECT coalesce(reject_reason, 'accepted') AS reject_reason, count(*) AS rows
FROM listings_a GROUP BY 1"""),
    "src_html_pages": "SELECT url, length(html) AS characters, md5(html) AS html_md5 FROM pages",
    "bronze_scan": _sql("bronze_a", body="""
SELECT url_anuncio, marca, round(precio, 2) AS precio, ingestion_date FROM bronze_a"""),
    "bronze_scan_since": _sql("bronze_a", body="""
SELECT url_anuncio, marca, round(precio, 2) AS precio, ingestion_date FROM bronze_a
WHERE ingestion_date >= DATE '1998-01-01'"""),
    "optional_source": _sql("bronze", body="""
SELECT origen, count(*) AS rows FROM bronze GROUP BY 1"""),
    "bronze_schema": _sql("dirty", body="""
SELECT marca, modelo, TRY_CAST(anio AS INT) AS anio, TRY_CAST(km AS INT) AS km,
 CAST(NULL AS VARCHAR) AS tipo, round(TRY_CAST(precio AS DOUBLE), 2) AS precio,
 TRY_CAST(cilindrada_cc AS INT) AS cilindrada_cc, url_anuncio, CAST(NULL AS VARCHAR) AS origen,
 ingestion_date FROM dirty"""),
    "bronze_stamp": _sql("bronze_a", body="""
SELECT url_anuncio, DATE '2024-03-01' AS ingestion_date FROM bronze_a"""),
    "bronze_append_roundtrip": _sql("bronze", body=f"SELECT {_SHOWN} FROM bronze"),
    "bronze_replace_dates": _sql("bronze_a", body="""
SELECT DATE '2024-03-01' AS ingestion_date, count(*) AS rows, count(*) AS reported
FROM bronze_a"""),
    "bronze_empty": _sql("bronze_a", body="""
SELECT count(*) AS rows_in, CAST(0 AS BIGINT) AS written, false AS exists FROM bronze_a"""),
    "bronze_partition_counts": _sql("bronze_a", body="""
SELECT ingestion_date, count(*) AS rows
FROM bronze_a GROUP BY 1 ORDER BY 1 DESC LIMIT 10"""),
    "silver_overwrite_roundtrip": _sql("silver", body=f"SELECT {_SHOWN} FROM silver"),
    # feed records
    "parse_json_listing": _sql("listings_a", body=f"""
SELECT {_SHOWN}, reject_reason FROM listings_a"""),
    "map_kind": _sql("listings_a", body="SELECT tipo, count(*) AS rows FROM listings_a GROUP BY 1"),
    "optional_int": _sql("raw_a", body="""
SELECT id, nullif(cc, 0) AS cc, TRY_CAST(num_seats AS INT) AS num_seats,
 TRY_CAST(num_keys AS INT) AS num_keys FROM raw_a"""),
    "valid_listing": _sql("typed_a", body="""
SELECT url_anuncio, ingestion_date, coalesce(marca <> '' AND modelo <> '' AND anio > 1980
 AND km >= 0 AND precio > 0 AND NOT isnan(precio), false) AS valid FROM typed_a"""),
    "reject_counts": _sql("listings_a", "listings_b", body="""
SELECT 'feed' AS source, coalesce(reject_reason, 'accepted') AS reject_reason, count(*) AS rows
FROM listings_a GROUP BY 2
UNION ALL
SELECT 'pages', coalesce(reject_reason, 'accepted'), count(*) FROM listings_b GROUP BY 2"""),
    # pages
    "page_links": _sql("found_links", body="SELECT * FROM found_links"),
    "page_links_cap": _sql("found_links", body="""
SELECT f.* FROM found_links f WHERE page_id < coalesce((SELECT min(page_id) FROM pages
 WHERE page_id NOT IN (SELECT page_id FROM found_links)), 9223372036854775807)
ORDER BY page_id, position LIMIT 300"""),
    "spec_map": _sql("raw_b", body="""
SELECT url, ingestion_date, anio, modelo, kilometros, cilindrada, potencia_maxima,
 CAST(2 + (anio IS NOT NULL)::INT + (modelo IS NOT NULL)::INT
  + (potencia_maxima IS NOT NULL)::INT AS INT) AS labels FROM raw_b"""),
    "eu_price": _sql("raw_b", body=f"""
SELECT url, ingestion_date, {_PAGE_PRICE} AS precio FROM raw_b"""),
    "kind_from_url": _sql("raw_b", body=f"SELECT url, {_SEGMENT} AS segment FROM raw_b"),
    "brand_from_slug": _sql("typed_b", body="SELECT url_anuncio AS url, marca FROM typed_b"),
    "unit_int": _sql("typed_b", body="""
SELECT url_anuncio AS url, ingestion_date, cilindrada_cc AS cc, potencia_cv AS cv FROM typed_b"""),
    "alt_keys": _sql("raw_b", body="""
SELECT url, ingestion_date, coalesce(anio, '0') AS anio, kilometros AS km FROM raw_b"""),
    "parse_html_listing": _sql("listings_b", body=f"""
SELECT {_SHOWN}, reject_reason FROM listings_b"""),
    # silver
    "silver_union": _sql("bronze", body=f"SELECT {_SHOWN} FROM bronze"),
    "silver_cast": _sql("dirty_cast", body="""
SELECT url_anuncio, ingestion_date, km, anio, round(CAST(precio AS DOUBLE), 2) AS precio,
 cilindrada_cc FROM dirty_cast"""),
    "silver_normalise": _sql("dirty", body="""
SELECT url_anuncio, upper(trim(marca)) AS marca, trim(modelo) AS modelo FROM dirty"""),
    "silver_required": _sql("required", body=f"SELECT {_CLEANED} FROM required"),
    "silver_dedup": _sql("dirty_latest", body=f"SELECT {_CLEANED} FROM dirty_latest"),
    "silver_range": _sql("required", body=f"""
SELECT {_CLEANED} FROM required WHERE required.precio BETWEEN 100 AND 100000
 AND anio BETWEEN 1980 AND {_AS_OF} AND km >= 0"""),
    "silver_clean": _sql("dirty_latest", body=f"""
SELECT {_CLEANED} FROM dirty_latest d WHERE d.precio BETWEEN 100 AND 100000
 AND anio BETWEEN 1980 AND {_AS_OF} AND km >= 0"""),
    "silver": _sql("silver", body=f"SELECT {_SHOWN} FROM silver"),
    "silver_by_bucket": _sql("silver", body=f"SELECT {_SHOWN} FROM silver"),
    # gold
    "feat_age": _sql("gold", body="SELECT url_anuncio, edad_anios FROM gold"),
    "feat_km_bucket": _sql("dirty_cast", body="""
SELECT url_anuncio, ingestion_date, km, CASE WHEN km < 10000 THEN '0-10k'
 WHEN km < 30000 THEN '10k-30k' WHEN km < 60000 THEN '30k-60k' ELSE '60k+' END AS km_bucket
FROM dirty_cast"""),
    "feat_kind": _sql("gold", body="SELECT url_anuncio, tipo_normalizado FROM gold"),
    "feat_log_price": _sql("gold", body="""
SELECT url_anuncio, round(log_precio, 6) AS log_precio FROM gold"""),
    "feat_defaults": _sql("gold", body="""
SELECT url_anuncio, distintivo_ambiental, num_plazas, num_llaves, iva_deducible FROM gold"""),
    "gold": _sql("gold", body=f"SELECT {_GOLD} FROM gold"),
    # profiling
    "value_counts": _sql("bronze_a", body="""
SELECT distintivo_ambiental AS label, count(*) AS rows FROM bronze_a
WHERE distintivo_ambiental IS NOT NULL GROUP BY 1"""),
    "top_brands": _sql("silver", body="""
SELECT marca, count(*) AS rows FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "describe_price": _sql("bronze_a", body="""
SELECT count(precio) AS count, round(avg(precio), 4) AS mean, round(stddev_samp(precio), 4) AS std,
 round(min(precio), 4) AS min, round(quantile_cont(precio, 0.25), 4) AS p25,
 round(quantile_cont(precio, 0.5), 4) AS p50, round(quantile_cont(precio, 0.75), 4) AS p75,
 round(max(precio), 4) AS max FROM bronze_a"""),
    "kind_counts": _sql("gold", body="""
SELECT tipo_normalizado, count(*) AS rows FROM gold GROUP BY 1"""),
    "price_stats": _sql("silver", body="""
SELECT round(min(CAST(precio AS DOUBLE)), 2) AS min,
 round(quantile_disc(CAST(precio AS DOUBLE), 0.25), 2) AS p25,
 round(quantile_disc(CAST(precio AS DOUBLE), 0.5), 2) AS p50,
 round(quantile_disc(CAST(precio AS DOUBLE), 0.75), 2) AS p75,
 round(max(CAST(precio AS DOUBLE)), 2) AS max,
 round(CAST(sum(CAST(CAST(precio AS DOUBLE) AS DECIMAL(38, 10))) AS DOUBLE) / count(precio), 4) AS media
FROM silver"""),
    "null_audit": _sql("gold", body="\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls FROM gold"
        for c in ["marca", "tipo_normalizado", "km_bucket", "anio", "edad_anios", "km", "precio",
                  "cilindrada_cc", "potencia_cv"]
    ) + "\nUNION ALL\nSELECT 'ubicacion', count(*) FROM gold"),
    "bucket_counts": _sql("gold", body="SELECT km_bucket, count(*) AS rows FROM gold GROUP BY 1"),
    "price_correlations": _sql("gold", body="""
SELECT round(corr(CAST(edad_anios AS DOUBLE), CAST(precio AS DOUBLE)), 6) AS corr_edad_anios_precio,
 round(corr(CAST(km AS DOUBLE), CAST(precio AS DOUBLE)), 6) AS corr_km_precio FROM gold"""),
    "preview": _sql("gold", body=f"""
SELECT {_GOLD} FROM (SELECT * FROM gold ORDER BY gold.precio, url_anuncio LIMIT 20)"""),
    "guards": _sql("bronze_a", body="""
SELECT count(*) AS rows, true AS empty_stopped FROM bronze_a"""),
    # learning
    "training_set": _sql("train_all", body=f"""
SELECT {', '.join(fixed.CATEGORY_COLUMNS)}, {', '.join(fixed.NUMERIC_COLUMNS)},
 round(CAST(precio AS DOUBLE), 2) AS precio, url_anuncio FROM train_all"""),
    "training_source_filter": _sql("train_all", body=f"""
SELECT url_anuncio, origen, round(CAST(precio AS DOUBLE), 2) AS precio FROM train_all
WHERE origen = '{fixed.PAGE_SOURCE}'"""),
    "training_source_feed": _sql("train_all", body=f"""
SELECT url_anuncio, origen, round(CAST(precio AS DOUBLE), 2) AS precio FROM train_all
WHERE origen = '{fixed.FEED_SOURCE}'"""),
    "min_rows_guard": _sql("train_all", body="""
SELECT count(*) AS rows, count(*) AS counted, true AS stopped_above FROM train_all"""),
    "train_test_split": _sql("train_all", body=f"""
SELECT url_anuncio, is_test, CAST({_fraction(9)} % 3 AS INT) AS fold FROM train_all"""),
    "category_index": _sql("train_all", *_RANKS, body=f"""
SELECT url_anuncio, {', '.join(
    f'coalesce(rank_{c}.pos, CAST((SELECT count(*) FROM rank_{c}) AS INT)) AS {c}_idx'
    for c in fixed.CATEGORY_COLUMNS)} FROM train_all {_RANK_JOINS}"""),
    "one_hot": _sql("train_all", *_RANKS, body=f"""
SELECT url_anuncio, {', '.join(f'rank_{c}.pos AS {c}_ohe' for c in fixed.CATEGORY_COLUMNS)}
FROM train_all {_RANK_JOINS}"""),
    "feature_vector": _sql("train_all", *_RANKS, body=f"""
SELECT url_anuncio, CAST({_offset(len(fixed.CATEGORY_COLUMNS))} + 6 AS INT) AS size,
 concat_ws(',', {', '.join(
    f'rank_{c}.pos + {_offset(i)}' for i, c in enumerate(fixed.CATEGORY_COLUMNS))}) AS slots,
 {', '.join(fixed.NUMERIC_COLUMNS)} FROM train_all {_RANK_JOINS}"""),
    "feature_names": _sql(*_RANKS, body="\nUNION ALL\n".join([
        *[f"SELECT CAST(pos + {_offset(i)} AS INT) AS slot, '{c}_ohe_' || label AS feature FROM rank_{c}"
          for i, c in enumerate(fixed.CATEGORY_COLUMNS)],
        *[f"SELECT CAST({_offset(len(fixed.CATEGORY_COLUMNS))} + {i} AS INT), '{c}'"
          for i, c in enumerate(fixed.NUMERIC_COLUMNS)]])),
    "regression_metrics": _sql("predicted", body=f"""
SELECT {_METRICS}, count(*) AS rows FROM predicted"""),
    "sample_predictions": _sql("predicted", body=f"""
SELECT marca, modelo, tipo_normalizado, cilindrada_cc, anio, km,
 round(CAST(precio AS DOUBLE), 2) AS precio, {_TWO.format('prediction')}, url_anuncio
FROM predicted ORDER BY md5('42|' || url_anuncio), url_anuncio LIMIT 50"""),
    "prediction_errors": _sql("predicted", body=f"""
SELECT url_anuncio, {_FOUR.format('error_absoluto')}, {_FOUR.format('error_porcentual')}
FROM predicted"""),
    "model_roundtrip": _sql("train_all", body="""
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM train_all WHERE is_test"""),
}
ORACLES["worst_predictions"] = ORACLES["report_csv"] = _sql("predicted", body=f"""
SELECT marca, modelo, tipo_normalizado, anio, km, round(CAST(precio AS DOUBLE), 2) AS precio,
 {_TWO.format('prediction')}, {_TWO.format('error_absoluto')}, {_TWO.format('error_porcentual')},
 url_anuncio FROM (SELECT * FROM predicted p ORDER BY p.error_absoluto DESC, url_anuncio LIMIT 100)
""")
ORACLES["run_log"] = "\nUNION ALL\n".join(
    f"""SELECT 'mean price, {s}' AS run_name, CAST({i + 1} AS INT) AS version,
 '{s}' AS origen_filter, CAST(n AS VARCHAR) AS total_rows, rmse FROM ({_metrics_of(s)})"""
    for i, s in enumerate(_SOURCES)
)
ORACLES["run_history"] = "\nUNION ALL\n".join(
    f"SELECT 'mean price, {s}' AS run_name, rmse, mae, r2 FROM ({_metrics_of(s)})"
    for s in _SOURCES[1:]
)
ORACLES["run_missing_metric"] = _sql("train_all", body="""
SELECT 'mean price, all' AS run_name, CAST(0 AS DOUBLE) AS r2 FROM train_all
GROUP BY ALL HAVING count(*) > 0""")
# One stamped day: the copies of a listing differ in no date, so the tie rule
# decides which; rows and, of the raw layers, prices are compared.
ORACLES["end_to_end"] = _sql("bronze_a", "bronze_b", body=f"""
, unstamped AS (SELECT * REPLACE (DATE '2024-03-01' AS ingestion_date)
  FROM (SELECT * FROM bronze_a UNION ALL BY NAME SELECT * FROM bronze_b)),
e_typed AS ({_PARTS['typed'][1].replace('FROM bronze', 'FROM unstamped')}),
e_ranked AS ({_PARTS['ranked'][1].replace('FROM typed', 'FROM e_typed')}),
e_silver AS ({_PARTS['silver'][1].replace('FROM ranked', 'FROM e_ranked')})
SELECT 'bronze_feed' AS layer, count(*) AS rows,
 CAST(sum(CAST(round(precio * 100) AS BIGINT)) AS BIGINT) AS cents FROM bronze_a
UNION ALL SELECT 'bronze_pages', count(*),
 CAST(sum(CAST(round(precio * 100) AS BIGINT)) AS BIGINT) FROM bronze_b
UNION ALL SELECT 'silver', count(*), NULL FROM e_silver
UNION ALL SELECT 'gold', count(*), NULL FROM e_silver
UNION ALL SELECT 'runs', 1, NULL
UNION ALL SELECT concat('feed rejected, ', reject_reason), count(*), NULL FROM listings_a
 WHERE reject_reason IS NOT NULL GROUP BY reject_reason
UNION ALL SELECT concat('pages rejected, ', reject_reason), count(*), NULL FROM listings_b
 WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")
