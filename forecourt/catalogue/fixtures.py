"""Listing-shaped inputs derived by Spark from the given tables.

The SQL texts run unchanged on any ANSI engine, so the reference results can
start from the same rows.  `{lineitem}` and `{part}` stand for the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from forecourt.operators import extract, gold, silver
from forecourt.sources import sinks, tables
from forecourt.sources.scratch import scratch_folder

AS_OF_YEAR = 2024

RAW_FEED = """
SELECT concat('A', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
 CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE concat('  ', lower(p_brand), ' ') END AS brand,
 concat(' ', p_name) AS model,
 CASE WHEN l_partkey % 37 = 0 THEN 'n/a'
      ELSE CAST(year(l_shipdate) - l_suppkey % 24 AS STRING) END AS year,
 CASE WHEN l_partkey % 61 = 0 THEN '-1'
      ELSE CAST(CAST(floor(l_quantity * 1700 + l_suppkey) AS BIGINT) AS STRING) END AS kms,
 CASE WHEN l_partkey % 41 = 0 THEN CAST(1 + l_linenumber AS STRING)
      ELSE CAST(l_extendedprice AS STRING) END AS price,
 CASE l_suppkey % 13 WHEN 0 THEN 'NAKED' WHEN 1 THEN 'TRAIL' WHEN 2 THEN 'SCOOTER'
      WHEN 3 THEN 'SPORT' WHEN 4 THEN 'SUPERMOTARD' WHEN 5 THEN 'CUSTOM' WHEN 6 THEN 'TOURING'
      WHEN 7 THEN 'THREE_WHEELER' WHEN 8 THEN 'MAXI_SCOOTER' WHEN 9 THEN 'CLASSIC'
      WHEN 10 THEN 'OFF_ROAD' WHEN 11 THEN 'HOVERBIKE' END AS motorbike_type,
 CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size * 25 END AS cc,
 CASE l_linenumber % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' END AS emission_type,
 CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_linenumber % 3 AS STRING) END AS num_seats,
 CASE WHEN l_partkey % 67 = 0 THEN 'unknown' WHEN l_suppkey % 4 = 0 THEN NULL
      ELSE CAST(l_suppkey % 4 AS STRING) END AS num_keys,
 CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS deductible_vat,
 CAST(l_shipdate AS DATE) AS ingestion_date
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

RAW_PAGE_FIELDS = """
SELECT concat('https://dealer.example/motos-de-ocasion/',
   CASE l_suppkey % 5 WHEN 0 THEN 'naked' WHEN 1 THEN 'trail' WHEN 2 THEN 'sport'
        WHEN 3 THEN 'deportivas' ELSE 'scooter' END,
   '/', lower(p_brand),
   CASE WHEN l_partkey % 29 = 0 THEN ''
        ELSE concat('-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END,
   CASE WHEN l_linenumber % 5 = 0 THEN '' ELSE '/' END) AS url,
 CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE p_name END AS modelo,
 CASE WHEN l_partkey % 37 = 0 THEN NULL
      ELSE CAST(year(l_shipdate) - l_suppkey % 24 AS STRING) END AS anio,
 CASE WHEN l_partkey % 43 = 0 THEN '12.000 km'
      ELSE CAST(CAST(floor(l_quantity * 1700 + l_suppkey) AS BIGINT) AS STRING) END AS kilometros,
 CASE WHEN p_size % 10 = 0 THEN 'n/d'
      ELSE concat(CAST(p_size * 25 AS STRING), ' CC') END AS cilindrada,
 CASE WHEN p_size % 7 = 0 THEN NULL
      ELSE concat(CAST(p_size * 2 AS STRING), ' cv') END AS potencia_maxima,
 CASE WHEN l_partkey % 47 = 0 THEN 'consultar'
      ELSE concat(CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS STRING), '.',
                  lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS STRING), 3, '0'),
                  ',50 €') END AS precio,
 CAST(l_shipdate AS DATE) AS ingestion_date
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

# Markup in three styles, so that case, attributes, quoting, entities, inline
# tags, comments, repeated labels and rows without a header all occur.
RAW_HTML = """
SELECT url, ingestion_date, CASE length(url) % 3
 WHEN 0 THEN concat('<html><body><p class="price"><span class="amount"><bdi>', precio,
  '</bdi></span></p><table>',
  CASE WHEN anio IS NULL THEN '' ELSE concat('<tr><th> Año </th><td>', anio, '</td></tr>') END,
  CASE WHEN modelo IS NULL THEN '' ELSE concat('<tr><th>Modelo</th><td> ', modelo, ' </td></tr>') END,
  '<tr><th>Kilómetros</th><td>0</td></tr><tr><th>Kilómetros</th><td>', kilometros,
  '</td></tr><tr><th>Cilindrada</th><td>', cilindrada, '</td></tr>',
  CASE WHEN potencia_maxima IS NULL THEN ''
       ELSE concat('<tr><th>Potencia máxima</th><td>', potencia_maxima, '</td></tr>') END,
  '<tr><td>sin cabecera</td></tr></table></body></html>')
 WHEN 1 THEN concat('<HTML><BODY><P ID=p CLASS="entry price big"><SPAN class=''sym amount''><BDI dir="ltr">',
  replace(precio, ' €', '&nbsp;<span>&euro;</span>'), '</BDI></SPAN></P><TABLE>',
  CASE WHEN anio IS NULL THEN ''
       ELSE concat('<TR class="a"><TH scope="row">A&ntilde;o</TH>\n<TD>', anio, '</TD></TR>') END,
  CASE WHEN modelo IS NULL THEN ''
       ELSE concat('<TR><TH>Modelo</TH><TD>\n', modelo, '\n</TD></TR>') END,
  '<TR><TH>Kil&oacute;metros</TH><TD>', kilometros,
  '</TD></TR><TR><TD>', cilindrada, '</TD><TH>CILINDRADA</TH></TR>',
  CASE WHEN potencia_maxima IS NULL THEN ''
       ELSE concat('<TR><TH>Potencia m&#225;xima</TH><TD>', potencia_maxima, '</TD></TR>') END,
  '</TABLE></BODY></HTML>')
 ELSE concat('<html><head><script>var a = "<tr><th>Modelo</th><td>no</td></tr>";</script></head><body>',
  '<!-- <tr><th>Cilindrada</th><td>1 CC</td></tr> --><div class="price"><b class="amount"><bdi>',
  precio, '</bdi></b></div><table><thead><tr><th>Ficha</th></tr></thead>',
  CASE WHEN anio IS NULL THEN '' ELSE concat('<tr><th><b>Ao</b></th><td><i>', anio, '</i></td></tr>') END,
  CASE WHEN modelo IS NULL THEN '' ELSE concat('<tr><th>Modelo</th><td>', modelo, '</td></tr>') END,
  '<tr><th>Kilmetros</th><td>', kilometros, '</td></tr><tr><th>Cilindrada</th><td>', cilindrada,
  '</td></tr>',
  CASE WHEN potencia_maxima IS NULL THEN ''
       ELSE concat('<tr><th>Potencia m&#xE1;xima</th><td>', potencia_maxima, '</td></tr>') END,
  '</table></body></html>') END AS html
FROM {fields}
"""

# Text-typed raw rows for the single cleaning steps, with NULL keys among them.
RAW_DIRTY = """
SELECT brand AS marca, model AS modelo, year AS anio, kms AS km, price AS precio,
 CAST(cc AS STRING) AS cilindrada_cc, CASE WHEN id LIKE '%99-1' THEN NULL ELSE id END AS url_anuncio,
 ingestion_date
FROM {feed}
"""


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a given table."""
    return tables.spread(spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns))


class Inputs:
    """The derived frames of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def _lineitem(self) -> DataFrame:
        return read_table(
            self.spark, self.sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
            "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate",
        )

    @cached_property
    def _part(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/part.parquet").select(
            "p_partkey", "p_brand", "p_name", "p_size"
        )

    @cached_property
    def feed(self) -> DataFrame:
        return self.spark.sql(RAW_FEED, lineitem=self._lineitem, part=self._part)

    @cached_property
    def page_fields(self) -> DataFrame:
        return self.spark.sql(RAW_PAGE_FIELDS, lineitem=self._lineitem, part=self._part)

    @cached_property
    def pages(self) -> DataFrame:
        return self.spark.sql(RAW_HTML, fields=self.page_fields)

    @cached_property
    def dirty(self) -> DataFrame:
        return self.spark.sql(RAW_DIRTY, feed=self.feed)

    @cached_property
    def index_pages(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "pages", "page_id", "url", "html")

    @cached_property
    def feed_listings(self) -> DataFrame:
        return extract.parse_feed(self.feed)

    @cached_property
    def page_listings(self) -> DataFrame:
        return extract.parse_pages(self.pages)

    @cached_property
    def bronze_feed(self) -> DataFrame:
        return extract.accepted(self.feed_listings)

    @cached_property
    def bronze_pages(self) -> DataFrame:
        return extract.accepted(self.page_listings)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.to_silver(self.bronze_feed, self.bronze_pages, as_of_year=AS_OF_YEAR)

    @cached_property
    def gold(self) -> DataFrame:
        return gold.to_gold(self.silver, AS_OF_YEAR)

    @cached_property
    def stored_gold(self) -> DataFrame:
        """The feature table written and read back, as training finds it.

        Fitting, splitting and scoring each read it; none recomputes the layers.
        """
        folder = scratch_folder(self.spark, "gold")
        sinks.overwrite(self.gold, folder)
        return tables.read_table(self.spark, folder)
