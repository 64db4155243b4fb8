import html as python_html
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from forecourt.functions import hashing, html, labels, numbers, text

lists = settings(
    max_examples=6, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def python_number(kind, value):
    try:
        return kind(value)
    except ValueError:
        return None


number_like = st.one_of(
    st.integers(-5000, 5_000_000).map(str),
    st.floats(allow_nan=True, allow_infinity=True, width=32).map(str),
    st.text("0123456789+-_.eEdfx \t naif", max_size=9),
)


@lists
@given(st.lists(number_like, min_size=60, max_size=60))
def test_numbers_from_text_match_python(column_of, values):
    values = [*values, "12", " 12 ", "1_000", "12.0", "1__0", "", "+7", "12d", "0x1p3", "1e5",
              ".5", "5.", ".", "-inf", "NaN", "Infinity", "1_0.5_0"]
    ints = column_of(values, numbers.int_from_text)
    floats = column_of(values, numbers.float_from_text)
    for value, i, f in zip(values, ints, floats):
        wanted = python_number(int, value)
        if wanted is not None and not -2**31 <= wanted < 2**31:
            wanted = None
        assert i == wanted, value
        wanted = python_number(float, value)
        if wanted is not None and math.isnan(wanted):
            assert math.isnan(f), value
        else:
            assert f == wanted, value


@pytest.mark.parametrize("ddl, values, expected", [
    ("INT", [0, 5, None], [None, 5, None]),
    ("DOUBLE", [0.0, 12.7, None], [None, 12, None]),
    ("STRING", ["", "0", "12", "x", None], [None, 0, 12, None, None]),
    ("BOOLEAN", [True, False], [1, None]),
])
def test_optional_int_follows_the_type(column_of, ddl, values, expected):
    dtype = T._parse_datatype_string(ddl)
    assert column_of(values, lambda v: numbers.optional_int(v, dtype), ddl) == expected


def test_variant_numbers_follow_the_json_type(column_of):
    from pyspark.sql import functions as F

    values = ["12", '"12"', "12.7", '"12.7"', "true", "0", '"0"', "null", "1e3", '""', "[1]"]

    def read(build):
        return column_of(values, lambda v: build(F.parse_json(v), T.VariantType()))

    assert read(numbers.read_int) == [12, 12, 12, None, 1, 0, 0, None, 1000, None, None]
    assert read(numbers.optional_int) == [12, 12, 12, None, 1, None, 0, None, 1000, None, None]
    assert read(numbers.read_flag) == [
        True, True, True, True, True, False, True, None, True, False, None
    ]


def test_flag_text_false_is_set(column_of):
    got = column_of(["false", "", None], lambda v: numbers.read_flag(v, T.StringType()))
    assert got == [True, False, None]


def test_unit_int(column_of):
    values = ["471 CC", "47cc", " 125 ", "1.000 CC", "n/d", "", None]
    assert column_of(values, lambda v: numbers.int_with_unit(v, "cc")) == [
        471, 47, 125, None, None, None, None
    ]


def plain_price(value):
    cleaned = value.replace("€", "").replace("&nbsp;", "").replace(".", "").replace(",", ".")
    found = python_number(float, cleaned.strip())
    return 0.0 if found is None else found


@lists
@given(st.lists(st.text("0123456789.,€  -", max_size=10), min_size=60, max_size=60))
def test_european_price(column_of, values):
    values = [*values, "6.990,00 €", "6.990,00 €", "€ 950", "consultar", ""]
    assert column_of(values, numbers.european_price) == [plain_price(v) for v in values]


def test_missing_price_is_zero(column_of):
    assert column_of([None], numbers.european_price) == [0.0]


addresses = st.text("ab-/é", max_size=14)


@lists
@given(st.lists(addresses, min_size=60, max_size=60))
def test_address_parts(column_of, values):
    def brand(url):
        slug = url.strip("/").split("/")[-1]
        return slug.split("-")[0].upper() if "-" in slug else "DESCONOCIDA"

    def kind(url):
        parts = url.split("/")
        return parts[-3] if len(parts) >= 3 else "otro"

    assert column_of(values, html.slug_brand) == [brand(v) for v in values]
    assert column_of(values, html.kind_segment) == [kind(v) for v in values]


def test_entities_match_a_real_decoder(column_of):
    values = ["A&ntilde;o", "m&#225;xima", "m&#xE1;x", "&amp;lt;", "&lt;b&gt;", "a & b", "&#38;nbsp;",
              "&nbsp;&euro;", "&#128;5", "&#0;", "&#1114112;", "&#55296;", "x", "&amp;&amp;",
              "&#128512;", "&#0000000233;", "&#x00000E9;", "&#x000000000000041", "&#99999999999999;", "&#1;&#11;&#127;",
              "&#xFDD0;&#xFFFF;&#x1FFFE;", "&#13;&#10;"]
    assert column_of(values, text.decode_entities) == [python_html.unescape(v) for v in values]


def test_unknown_entity_stays(column_of):
    assert column_of(["&nosuchthing;"], text.decode_entities) == ["&nosuchthing;"]


def test_strip_space_is_unicode(column_of):
    spaces = [c for c in map(chr, range(0x3001)) if c.isspace()]
    values = [f"{c}a b{c}" for c in spaces]
    assert column_of(values, text.strip_space) == ["a b"] * len(spaces)


def test_kind_lookup(column_of):
    values = ["NAKED", "SUPERMOTARD", "naked", "", None, "DEPORTIVAS"]
    assert column_of(values, labels.kind_of) == [
        "naked", "supermotard", "otro", "otro", "otro", "otro"
    ]


def test_vocabulary(column_of):
    build = lambda v: labels.within_vocabulary(v, ["naked", "trail"], "otro")
    assert column_of(["NAKED", "Trail", "supermotard", None], build) == [
        "naked", "trail", "otro", "otro"
    ]


def test_bands_are_left_closed(column_of):
    build = lambda v: labels.band(v, [10_000, 30_000, 60_000], ["a", "b", "c", "d"])
    values = [0, 9999, 10_000, 29_999, 30_000, 59_999, 60_000, None]
    assert column_of(values, build, "INT") == ["a", "a", "b", "b", "c", "c", "d", "d"]


def test_band_needs_matching_labels():
    with pytest.raises(ValueError):
        labels.band(None, [1, 2], ["a"])


def test_hash_fraction_is_uniform_and_fold_independent(column_of):
    keys = [f"k{i}" for i in range(3000)] + [None]
    fractions = column_of(keys, lambda v: hashing.hash_fraction(v, 42))
    folds = column_of(keys, lambda v: hashing.hash_fold(v, 42, 3))
    assert all(0 <= f < 1 for f in fractions)
    assert abs(sum(f < 0.2 for f in fractions) / len(keys) - 0.2) < 0.03
    for fold in range(3):
        inside = [f for f, g in zip(fractions, folds) if g == fold]
        assert abs(sum(f < 0.2 for f in inside) / len(inside) - 0.2) < 0.05
