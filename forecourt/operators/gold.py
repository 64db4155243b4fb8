"""Feature layer: one narrow projection of the clean layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt import schema
from forecourt.functions import labels
from forecourt.operators.silver import as_of


def age(as_of_year: int | None = None) -> Column:
    return as_of(as_of_year) - F.col("anio")


def km_band() -> Column:
    return labels.band(F.col("km"), fixed.KM_EDGES, fixed.KM_LABELS)


def feature_kind() -> Column:
    return labels.within_vocabulary(F.col("tipo"), fixed.FEATURE_KINDS, fixed.OTHER_KIND)


def log_price() -> Column:
    return F.log(F.col("precio"))


def filled_defaults() -> dict[str, Column]:
    """Optional columns with their default for NULL; the VAT flag becomes text."""
    return {
        "distintivo_ambiental": F.coalesce("distintivo_ambiental", F.lit(fixed.UNKNOWN_LABEL)),
        "num_plazas": F.coalesce("num_plazas", F.lit(fixed.DEFAULT_SEATS)),
        "num_llaves": F.coalesce("num_llaves", F.lit(fixed.DEFAULT_KEYS)),
        "iva_deducible": F.coalesce(
            F.col("iva_deducible").cast("string"), F.lit(fixed.DEFAULT_VAT)
        ),
    }


def to_gold(silver: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Clean table -> feature table."""
    computed = {
        "edad_anios": age(as_of_year),
        "km_bucket": km_band(),
        "tipo_normalizado": feature_kind(),
        "log_precio": log_price(),
        **filled_defaults(),
    }
    return silver.select(*[
        computed[name].alias(name) if name in computed else F.col(name)
        for name in schema.GOLD_COLUMNS
    ])
