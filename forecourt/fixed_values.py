"""Fixed values.

Vocabularies, defaults and formats the stored tables already use.  They are
data, not logic: each one is the default of a parameter somewhere else.
"""

# Vehicle type code of the JSON feed -> kind stored in the raw tables.
KIND_BY_CODE = {
    "NAKED": "naked",
    "TRAIL": "trail",
    "SCOOTER": "scooter",
    "SPORT": "deportiva",
    "SUPERMOTARD": "supermotard",
    "CUSTOM": "custom",
    "TOURING": "touring",
    "THREE_WHEELER": "tres_ruedas",
    "MAXI_SCOOTER": "maxi_scooter",
    "CLASSIC": "classic",
    "OFF_ROAD": "enduro",
}
OTHER_KIND = "otro"

# Kinds kept by the feature table; every other kind becomes OTHER_KIND.
FEATURE_KINDS = ["naked", "trail", "scooter", "deportiva", "custom", "touring", "enduro", "otro"]

# Values of the `origen` column.
FEED_SOURCE = "mundimoto"
PAGE_SOURCE = "moto-ocasion"

# Listing address built from a feed id.
FEED_URL_PREFIX = "https://mundimoto.com/es/moto/"
FEED_URL_SUFFIX = "?flow=SALE"

# A link of an index page is a listing when it contains this text and has
# more than this many '/'-separated parts.
LISTING_LINK_TEXT = "moto-ocasion.com/motos-de-ocasion/"
LISTING_LINK_PARTS = 5

# Labels of the specification table on a listing page.
SPEC_MODEL = "modelo"
SPEC_YEAR = ["año", "ao", "ano"]
SPEC_KM = ["kilómetros", "kilmetros"]
SPEC_ENGINE = "cilindrada"
SPEC_POWER = "potencia máxima"
UNKNOWN_BRAND = "DESCONOCIDA"
UNKNOWN_MODEL = "Desconocido"

# Cleaning ranges.
MIN_VALID_YEAR = 1980
PRICE_RANGE = (100, 100_000)

# Mileage bands: upper edges (exclusive) and labels.
KM_EDGES = [10_000, 30_000, 60_000]
KM_LABELS = ["0-10k", "10k-30k", "30k-60k", "60k+"]

# Defaults for missing features.
UNKNOWN_LABEL = "desconocido"
DEFAULT_SEATS = 2
DEFAULT_KEYS = 1
DEFAULT_VAT = "false"

# Columns the price model learns from.
CATEGORY_COLUMNS = [
    "marca", "tipo_normalizado", "km_bucket", "distintivo_ambiental", "iva_deducible", "origen",
]
NUMERIC_COLUMNS = ["anio", "edad_anios", "km", "cilindrada_cc", "num_plazas", "num_llaves"]
TARGET_COLUMN = "precio"

# Model search.
FOREST_TREES = [100, 200]
FOREST_DEPTHS = [8, 12]
BOOST_ROUNDS = [50, 100]
BOOST_DEPTHS = [5, 8]
