import datetime as dt
import re
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt import schema
from forecourt.functions import pages
from forecourt.operators import extract, links, silver
from forecourt.sources import landed
from page_parser import read_page

FEED = """brand STRING, model STRING, year STRING, kms STRING, price STRING, id STRING,
 motorbike_type STRING, cc INT, emission_type STRING, num_seats STRING, num_keys STRING,
 deductible_vat BOOLEAN"""
GOOD = ("Acme", "X1", "2015", "100", "2500.5", "7", "NAKED", 600, "B", "2", "1", True)


def feed_row(**changes):
    names = [part.split()[0] for part in FEED.split(",")]
    return tuple({**dict(zip(names, GOOD)), **changes}[n] for n in names)


@pytest.mark.parametrize("changes, reason", [
    ({}, None),
    ({"id": None}, "no_id"),
    ({"year": "n/a"}, "bad_year"),
    ({"year": None}, "bad_year"),
    ({"kms": "12.5"}, "bad_km"),
    ({"price": "free"}, "bad_price"),
    ({"num_keys": "two"}, "bad_option"),
    ({"num_keys": ""}, None),
    ({"brand": None}, "no_brand"),
    ({"brand": ""}, "no_brand"),
    ({"brand": "  "}, None),
    ({"model": ""}, "no_model"),
    ({"year": "1980"}, "old_year"),
    ({"year": "1981"}, None),
    ({"kms": "-1"}, "negative_km"),
    ({"kms": "0"}, None),
    ({"price": "0"}, "no_price"),
    ({"price": "0.01"}, None),
    ({"price": "nan"}, "no_price"),
])
def test_feed_rules(spark, changes, reason):
    df = spark.createDataFrame([feed_row(**changes)], FEED)
    listing = extract.parse_feed(df).first()
    assert listing[extract.REASON] == reason


def test_feed_listing_in_full(spark):
    row = extract.accepted(extract.parse_feed(spark.createDataFrame([GOOD], FEED))).first()
    assert row.asDict() == {
        "marca": "Acme", "modelo": "X1", "anio": 2015, "km": 100, "tipo": "naked",
        "precio": 2500.5, "cilindrada_cc": 600, "potencia_cv": None, "ubicacion": None,
        "url_anuncio": "https://mundimoto.com/es/moto/7?flow=SALE", "descripcion": None,
        "distintivo_ambiental": "B", "num_plazas": 2, "num_llaves": 1, "iva_deducible": True,
        "origen": "mundimoto", "ingestion_date": None,
    }


def test_accepted_and_rejected_add_up(spark):
    rows = [feed_row(year=str(1975 + i)) for i in range(12)]
    listings = extract.parse_feed(spark.createDataFrame(rows, FEED))
    assert extract.accepted(listings).count() == 6
    assert extract.rejected(listings).count() == 6
    counts = {r[0]: r[1] for r in extract.count_by_reason(listings).collect()}
    assert counts == {"accepted": 6, "old_year": 6}


def test_landed_feed(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"motorbikes":[{"id":1,"brand":"A","model":"m","year":2010,"kms":"5","price":900,'
        '"cc":0,"deductible_vat":false},'
        '{"id":"x","brand":"B","model":"m","year":2010.0,"kms":5,"price":"900.5"}]}\n'
        '{"motorbikes":[]}\n{"other":1}\n{"motorbikes":[{"id":3,\n'
    )
    listings = extract.parse_feed(landed.read_feed(spark, str(tmp_path)))
    assert [r[1] for r in extract.count_by_reason(listings).orderBy("reject_reason").collect()] == [2, 1]
    text = spark.createDataFrame([('{"motorbikes":[{"id":3,',), ('{"motorbikes":[]}',), (None,)], "payload STRING")
    assert [r[extract.REASON] for r in extract.parse_feed(landed.explode_feed(text)).collect()] == ["bad_page"]
    rows = extract.accepted(listings).withColumn(extract.REASON, F.lit(None)).orderBy("marca").collect()
    assert [(r.marca, r.anio, r.km, r.precio, r.cilindrada_cc, r.iva_deducible) for r in rows] == [
        ("A", 2010, 5, 900.0, None, False), ("B", 2010, 5, 900.5, None, None),
    ]
    assert [r[extract.REASON] for r in rows] == [None, None]


PAGE = """<html><p class="price"><span class="amount"><bdi>6.990,00&nbsp;<span>&euro;</span></bdi>
</span></p><table><tr><th>{year}</th><td>2016</td></tr><tr><th>Modelo</th><td> CB <b>500</b>
</td></tr><tr><th>Kilómetros</th><td>1</td></tr><tr><th>KILÓMETROS</th><td>{km}</td></tr>
<tr><th>Cilindrada</th><td>471 CC</td></tr><tr><th>Potencia m&aacute;xima</th><td>47 CV</td></tr>
<tr><th>solo</th></tr><tr><td>nada</td></tr></table></html>"""
URL = "https://d.example/motos/naked/honda-cb/"


def parse(spark, page, url=URL):
    return extract.parse_pages(spark.createDataFrame([(url, page)], "url STRING, html STRING")).first()


@pytest.mark.parametrize("label", ["Año", "A&ntilde;o", "ao", "ANO"])
def test_page_listing(spark, label):
    row = parse(spark, PAGE.format(year=label, km="12000"))
    assert (row.marca, row.modelo, row.anio, row.km, row.tipo, row.precio) == (
        "HONDA", "CB 500", 2016, 12000, "naked", 6990.0
    )
    assert (row.cilindrada_cc, row.potencia_cv, row.origen) == (471, 47, "moto-ocasion")
    assert row[extract.REASON] is None


@pytest.mark.parametrize("page, url, reason", [
    (PAGE.format(year="x", km="1"), URL, "old_year"),
    (PAGE.format(year="año", km="12.000 km"), URL, "bad_km"),
    (PAGE.format(year="año", km="1").replace("2016", "?"), URL, "bad_year"),
    (PAGE.format(year="año", km="1").replace("bdi", "i"), URL, "no_price"),
    (PAGE.format(year="año", km="1"), "https://d.example/a/-x/", "no_brand"),
    ("", URL, "old_year"),
])
def test_page_rules(spark, page, url, reason):
    assert parse(spark, page, url)[extract.REASON] == reason


def test_page_defaults(spark):
    row = parse(spark, "<table><tr><th>año</th><td>2000</td></tr></table>", "https://d.example/x")
    assert (row.marca, row.modelo, row.tipo, row.km, row.precio) == (
        "DESCONOCIDA", "Desconocido", "otro", 0, 0.0
    )


PAGES = [
    PAGE.format(year="Año", km="3"),
    "<!-- <tr><th>a</th><td>b</td></tr> --><tr><th></th><td>x</td></tr>",
    "<script>'<tr><th>a</th><td>b</td></tr>'</script><tr ><TD>v</TD><TH>k</TH ></tr>",
    '<div class="big price"><p class="amount now"><bdi> 1,5 </bdi></p></div>',
    '<div class="priced"><p class="amount"><bdi>2</bdi></p></div>',
    "<tr><th>a</th><td>1</td><td>2</td></tr><tr><th>a</th><td>3</td></tr>",
    "plain text", "", "a < b <tr><th>x</th><td>1 < 2</td></tr>",
    # the price node must stand below, not after
    '<p class="price">consultar</p><div class="cart"><span class="amount"><bdi>15,00</bdi></span></div>',
    "<i class=price><b class=amount><bdi>7",
    "<i class='x price'><b class=\"amount\"><i><bdi class=amount>8</bdi></i></b></i><bdi>9</bdi>",
    "<b class=amount><i class=price><bdi>1</bdi></i></b>",
    # end tags left out, tables in tables, > in attributes
    "<table><tr><th>Modelo</th><td>Z 900<tr><th>Año</th><td>2010</table>",
    "<table><tr><th>outer<td><table><tr><th>in</th><td>1</td></tr></table></td></tr></table>",
    "<tr><th>Año</th><td><table><tr><td>x</td></tr></table>2010</td></tr>",
    '<tr><th title="a>b">Modelo</th><td data-x=\'>\'>Z</td></tr>',
    "<div><tr><th>k</th><td>v</div>w</td></tr>", "<tr><th>k<br/>l</th><td><img src=x>v</td></tr>",
    # references
    "<tr><th>Voil&agrave; &ndash; &rsquo;X</th><td>&ntilde o&ntilde; &amp;lt; &#8364; &#x41 &notit; &bogus; &copy2</td></tr>",
]


def test_expressions_and_parser_agree(spark):
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(PAGES)], "url STRING, html STRING").repartition(4)
    found = {r.url: (r.specs, r.price_text) for r in extract.read_page_fields(df).collect()}
    assert found == {str(i): read_page(p)[:2] for i, p in enumerate(PAGES)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([
    "<tr>", "</tr>", "<th>", "</th>", "<td x='>'>", "</td>", "<div class=price>", "</div>", '<b class="amount">', "</b>",
    "<bdi>", "</bdi>", "<br>", "a", " b ", "&eacute;", "<table>", "</table>"]), max_size=25), min_size=20, max_size=20))
def test_random_markup(spark, drawn):
    df = spark.createDataFrame([(str(i), "".join(p)) for i, p in enumerate(drawn)], "url STRING, html STRING")
    found = {r.url: (r.specs, r.price_text) for r in extract.read_page_fields(df).collect()}
    assert found == {str(i): read_page("".join(p))[:2] for i, p in enumerate(drawn)}


SHAPES = {
    "rows": lambda n: "".join(f"<tr><th>label {i}</th><td><b>v</b> {i}</td></tr>" for i in range(n)),
    "unclosed": lambda n: "<p>x" * n,
    "unclosed before rows": lambda n: "<p>" * n + "<tr><th>a</th><td>b</td></tr>" * n,
    "nested cells": lambda n: "<table><tr><td>" * n,
    "open quotes": lambda n: '<a "' * n,
    "open comments": lambda n: "<!--" * n + "<!x" * n,
    "lone ends": lambda n: "</p>" * n + "</" * n,
    "lone signs": lambda n: "<" * n,
    "cards": lambda n: '<div class="price"><span class="amount">1</span></div><p title="x">text</p>' * n,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_twice_the_page_takes_twice_the_time(shape):
    def seconds(n):
        page = SHAPES[shape](n)
        best = []
        for _ in range(3):
            began = time.perf_counter()
            pages.read_page(page)
            best.append(time.perf_counter() - began)
        return min(best)

    assert seconds(4_000) < 1
    assert seconds(16_000) < 8 * seconds(4_000) + 0.05


def test_large_pages_take_little_time(spark):
    rows = SHAPES["rows"](4_000)
    held = [(rows,), (SHAPES["unclosed"](8_000),), ("<tr><th>a</th><td>" + " " * 20_000 + "x</td></tr>",)]
    df = spark.createDataFrame([("u", p[0]) for p in held], "url STRING, html STRING").coalesce(1)
    extract.read_page_fields(df.limit(0)).collect()
    began = time.perf_counter()
    specs = [r.specs for r in extract.read_page_fields(df).collect()]
    assert time.perf_counter() - began < 2
    assert specs == [{f"label {i}": f"v {i}" for i in range(4_000)}, {}, {"a": "x"}]


@pytest.mark.parametrize("page, specs, price", [
    ('<p class="price"><b title="class=x" CLASS=\'amount\'><bdi>1', {}, "1"),
    ("<p class='a &#112;rice'><b/class=amount><bdi/>x</bdi></b>", {}, ""),
    ("<tr><th>a</th><td/><td>b</td></tr>", {"a": ""}, "0"),
    ("<script/><tr><th>a</th><td>b</td></tr><script><tr><th>c</th><td>d</td></tr>", {"a": "b"}, "0"),
    ("<tr><th>a</th><td title='open>b</td></tr><tr><th>c</th><td x=1>d</td></tr>", {"a": "b", "c": "d"}, "0"),
    ("<tr><th>&#0000000233;</th><td>&#x00000E9;&#99999999999;</td></tr>", {"é": "é\ufffd"}, "0"),
])
def test_odd_markup(page, specs, price):
    assert pages.read_page(page) == (specs, price)


LINKS = """<a href="https://x/a/b/c/1">1</a><a class=q HREF='https://x/a/b/c/2'>2</a>
<a href="https://x/a/b/c/1">again</a><a href=https://x/a/b/c/3&amp;d>3</a><a name="n">n</a>
<!-- <a href="https://x/a/b/c/4">4</a> --><a href="https://x/short">s</a><a href="">e</a>"""


def test_links_of_a_page(spark):
    df = spark.createDataFrame([(1, LINKS), (2, LINKS), (3, "none")], "page_id INT, html STRING")
    found = links.page_links(df, contains="x/", more_parts_than=5).orderBy("page_id", "position")
    wanted = [f"https://x/a/b/c/{e}" for e in ("1", "2", "3&d")]
    assert [(r.page_id, r.position, r.link) for r in found.collect()] == [
        (page, i, link) for page in (1, 2) for i, link in enumerate(wanted)
    ]
    assert [link for link in read_page(LINKS)[2] if link.startswith("https://x/a")] == wanted


def test_first_links_stop_at_the_first_page_without_any(spark):
    landed_pages = [(1, LINKS), (2, LINKS), (3, "none"), (4, LINKS)]
    df = spark.createDataFrame(landed_pages, "page_id INT, html STRING").repartition(4)
    rows = links.first_links(df, 100, contains="x/", more_parts_than=5).collect()
    assert [(r.page_id, r.position) for r in rows] == [(p, i) for p in (1, 2) for i in range(3)]
    assert links.first_links(df, 4, contains="x/", more_parts_than=5).count() == 4
    assert links.link_limit(15) == 300 and links.link_limit(100) == 500


def test_pages_are_parsed_once(spark):
    """The filter on the reject reason is not copied below the extraction."""
    df = spark.createDataFrame([(URL, "x", dt.date(2024, 1, 1))],
                               f"url STRING, html STRING, {schema.DATE} DATE")
    plan = extract.accepted(extract.parse_pages(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def compiled_sizes(df, capsys):
    """Bytes of the largest method Java gets for each part of the plan."""
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")  # else parts show once they have run
    try:
        capsys.readouterr()
        df.explain("codegen")
        return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def test_reading_listings_is_code_that_java_compiles(spark, capsys):
    """A method of more than 8,000 bytes is interpreted for good, several times slower."""
    records = spark.createDataFrame([GOOD] * 3, FEED).selectExpr("*", "current_date() AS ingestion_date").repartition(2)
    pages_in = spark.createDataFrame([("http://x/a/b-1/", "<p>")], "url STRING, html STRING").repartition(2)
    for listings in (extract.parse_feed(records), extract.parse_pages(pages_in)):
        sizes = compiled_sizes(extract.accepted(listings), capsys)
        assert sizes and max(sizes) < 6000


def test_numbers_are_read_once_a_record(spark):
    """No later filter copies the reading of a number to where it stands."""
    records = spark.createDataFrame([GOOD], FEED).repartition(2)
    plan = silver.to_silver(extract.accepted(extract.parse_feed(records)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(kms#") == 1
    assert plan.count("regexp_extract(price#") == 1
