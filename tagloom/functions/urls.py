"""Parts of shop URLs, with plain string functions so that they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers around the product number in a product page URL.
PRODUCT_MARK = "/product/"
PAGE_MARK = ".html"


def product_id_from_url(url: Column) -> Column:
    """Text between the first product marker and a later first page marker, else null."""
    start = F.instr(url, PRODUCT_MARK)
    end = F.instr(url, PAGE_MARK)
    first = start + F.lit(len(PRODUCT_MARK))
    return F.when((start > 0) & (end > start), F.substring(url, first, end - first))


def last_path_segment(url: Column) -> Column:
    """Text after the last slash, cut before its first page marker."""
    return F.substring_index(F.substring_index(url, "/", -1), PAGE_MARK, 1)
