"""Column layouts of the stored tables."""

from pyspark.sql import types as T

BRONZE = T.StructType([
    T.StructField("marca", T.StringType()),
    T.StructField("modelo", T.StringType()),
    T.StructField("anio", T.IntegerType()),
    T.StructField("km", T.IntegerType()),
    T.StructField("tipo", T.StringType()),
    T.StructField("precio", T.DoubleType()),
    T.StructField("cilindrada_cc", T.IntegerType()),
    T.StructField("potencia_cv", T.IntegerType()),
    T.StructField("ubicacion", T.StringType()),
    T.StructField("url_anuncio", T.StringType()),
    T.StructField("descripcion", T.StringType()),
    T.StructField("distintivo_ambiental", T.StringType()),
    T.StructField("num_plazas", T.IntegerType()),
    T.StructField("num_llaves", T.IntegerType()),
    T.StructField("iva_deducible", T.BooleanType()),
    T.StructField("origen", T.StringType()),
    T.StructField("ingestion_date", T.DateType()),
])

KEY = "url_anuncio"
DATE = "ingestion_date"
REQUIRED = ["marca", "modelo", "anio", "km", "precio"]

GOLD_COLUMNS = [
    "marca", "modelo", "anio", "edad_anios", "km", "km_bucket", "tipo_normalizado",
    "cilindrada_cc", "potencia_cv", "ubicacion", "distintivo_ambiental", "num_plazas",
    "num_llaves", "iva_deducible", "origen", "precio", "log_precio", "url_anuncio",
]

# One record of the landed JSON feed.  Loosely typed fields stay VARIANT so a
# JSON number and a quoted number remain distinguishable.
FEED_RECORD = """
    id STRING, brand STRING, model STRING, year VARIANT, kms VARIANT, price VARIANT,
    motorbike_type STRING, cc VARIANT, emission_type STRING,
    num_seats VARIANT, num_keys VARIANT, deductible_vat VARIANT
"""
FEED_ENVELOPE = f"motorbikes ARRAY<STRUCT<{FEED_RECORD}>>"
