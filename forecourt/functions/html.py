"""Links, labels and address parts of listing pages as column expressions.

Rows, cells and the price node of a page are read by `functions.pages`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions.text import decode_entities

_HIDDEN = r"(?is)<(?:!--.*?--|script\b.*?</script\s*|style\b.*?</style\s*)>"
_HREF = rf"""(?is)<a\b(?=\s)(?:[^>"']|"[^"]*"|'[^']*')*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def rendered(html: Column) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(html, _HIDDEN, "")


def page_links(html: Column, contains: str, more_parts_than: int) -> Column:
    """Distinct link targets of one page in first-seen order."""
    quoted = F.regexp_extract_all(rendered(html), F.lit(_HREF), F.lit(1))
    targets = F.transform(
        quoted, lambda q: decode_entities(F.regexp_replace(q, "^[\"']|[\"']$", ""))
    )
    return F.array_distinct(
        F.filter(
            targets,
            lambda t: F.contains(t, F.lit(contains)) & (F.size(F.split(t, "/")) > more_parts_than),
        )
    )


def first_spec(specs: Column, labels: Sequence[str], default: str) -> Column:
    """Value of the first label present, else the default."""
    return F.coalesce(*[F.try_element_at(specs, F.lit(label)) for label in labels], F.lit(default))


def kind_segment(url: Column, default: str = fixed.OTHER_KIND) -> Column:
    """Third '/'-part from the end of the address as written."""
    return F.coalesce(F.try_element_at(F.split(url, "/"), F.lit(-3)), F.lit(default))


def slug_brand(url: Column, default: str = fixed.UNKNOWN_BRAND) -> Column:
    """Upper-cased start of the last address part, up to its first dash."""
    slug = F.substring_index(F.btrim(url, F.lit("/")), "/", -1)
    return F.when(F.contains(slug, F.lit("-")), F.upper(F.substring_index(slug, "-", 1))).otherwise(
        F.lit(default)
    )
