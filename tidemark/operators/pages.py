"""Fields and links from stored HTML pages."""

from __future__ import annotations

import html as html_lib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.numeric import age_from_year
from ..functions.text import absolutise, smallest_year

# Page parts that hold no content, and the elements that are read.
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
HEAD = r"(?is)<head\b.*?</head>"
TAG = r"<[^>]*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
HEADING = r"(?is)<h1[^>]*>(.*?)</h1>"
LINK = r"""(?i)<a\s(?:[^>"']|"[^"]*"|'[^']*')*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
TABLE_ROW = r"(?is)<tr[^>]*>(.*?)</tr>"
TABLE_CELL = r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"


@F.pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    """Character references such as ``&amp;`` as characters."""
    return text.map(lambda s: html_lib.unescape(s) if s is not None and "&" in s else s)


def plain(markup: Column) -> Column:
    """Text of a fragment: tags become spaces, white space collapses."""
    return unescape(F.trim(F.regexp_replace(F.regexp_replace(markup, TAG, " "), r"\s+", " ")))


def visible(markup: Column) -> Column:
    return F.regexp_replace(markup, HIDDEN, " ")


def hrefs(markup: Column) -> Column:
    """Link targets as written in double, single or no quotes."""
    return F.transform(F.regexp_extract_all(markup, F.lit(LINK), F.lit(1)), lambda h: F.regexp_replace(h, "^[\"']|[\"']$", ""))


def page_fields(pages: DataFrame, id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """Title, first heading, link count and readable text of each page."""
    shown = pages.select(id, url, visible(F.col(markup)).alias("_m"))
    return shown.select(
        id, url,
        plain(F.regexp_extract("_m", TITLE, 1)).alias("title"),
        plain(F.regexp_extract("_m", HEADING, 1)).alias("heading"),
        F.size(hrefs(F.col("_m"))).cast("bigint").alias("n_links"),
        plain(F.regexp_replace("_m", HEAD, " ")).alias("text"),
    )


def page_titles(pages: DataFrame, id: str = "page_id", markup: str = "html") -> DataFrame:
    return pages.select(id, plain(F.regexp_extract(visible(F.col(markup)), TITLE, 1)).alias("title"))


def page_links(pages: DataFrame, id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """Every link of every page as written and as an absolute address, read from the page's own."""
    rows = pages.select(id, F.col(url).alias("_page"), F.explode(hrefs(visible(F.col(markup)))).alias("href"))
    return rows.select(id, "href", absolutise("href", "_page").alias("url"))


def table_rows(pages: DataFrame, id: str = "page_id", markup: str = "html") -> DataFrame:
    """Cells of every table row, in order."""
    rows = F.regexp_extract_all(visible(F.col(markup)), F.lit(TABLE_ROW), F.lit(1))
    each = pages.select(id, F.posexplode(rows).alias("row", "_r"))
    cells = F.regexp_extract_all("_r", F.lit(TABLE_CELL), F.lit(1))
    return each.select(id, "row", F.posexplode(cells).alias("cell", "_c")).select(id, "row", "cell", plain(F.col("_c")).alias("value"))


def earliest_year(
    pages: DataFrame, reference_year: int, id: str = "page_id", markup: str = "html", lo: int = 1000, hi: int = 9999
) -> DataFrame:
    """Smallest four-digit number in the readable text and the age it implies."""
    text = F.regexp_replace(F.regexp_replace(visible(F.col(markup)), HEAD, " "), TAG, " ")
    return pages.select(id, smallest_year(text, lo, hi).alias("year")).withColumn(
        "age", age_from_year("year", reference_year)
    )
