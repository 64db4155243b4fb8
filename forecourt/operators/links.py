"""Listing links of index pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions import html

LINKS_PER_PAGE = 20
MAX_LINKS = 500


def _with_links(pages: DataFrame, order_by: str, contains: str, more_parts_than: int) -> DataFrame:
    return pages.select(
        F.col(order_by), html.page_links(F.col("html"), contains, more_parts_than).alias("links")
    )


def page_links(
    pages: DataFrame,
    order_by: str = "page_id",
    contains: str = fixed.LISTING_LINK_TEXT,
    more_parts_than: int = fixed.LISTING_LINK_PARTS,
) -> DataFrame:
    """One row per distinct link of each page, with its position on the page.

    The same link on two pages stays twice.
    """
    found = _with_links(pages, order_by, contains, more_parts_than)
    return found.select(order_by, F.posexplode("links").alias("position", "link"))


def link_limit(max_pages: int) -> int:
    return min(MAX_LINKS, LINKS_PER_PAGE * max_pages)


def first_links(
    pages: DataFrame,
    limit: int,
    order_by: str = "page_id",
    contains: str = fixed.LISTING_LINK_TEXT,
    more_parts_than: int = fixed.LISTING_LINK_PARTS,
) -> DataFrame:
    """The first `limit` links in page order, reading up to the first page without any.

    Each page read adds at least one link, so the first `limit` pages are
    enough whatever the table holds: a top-k on the page number picks them
    before any markup is parsed.
    """
    head = pages.select(order_by, "html").orderBy(order_by).limit(limit)
    found = _with_links(head, order_by, contains, more_parts_than)
    so_far = Window.orderBy(order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    unbroken = found.withColumn(
        "_shortest", F.min(F.size("links")).over(so_far)
    ).filter(F.col("_shortest") > 0)
    return (
        unbroken.select(order_by, F.posexplode("links").alias("position", "link"))
        .orderBy(order_by, "position")
        .limit(limit)
    )
