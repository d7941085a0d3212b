"""Dates and table rows out of HTML pages, with Spark's own regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns and names the pages are read by.
MINUTES_LINK = r"fomcminutes(\d{8})\.pdf"
STATEMENT_LINK = r"monetary(\d{8})[a-z]?\.htm"
TITLE = r"(?s)<title>(.*?)</title>"
STATEMENT_TITLE = "Federal Reserve issues FOMC statement"
ROW = r"(?s)<tr[^>]*>(.*?)</tr>"
CELL = r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"
RELEASE = (
    "^(Consumer Price Index|Employment Situation) for (January|February|March|April|May|June|July"
    r"|August|September|October|November|December) \d{4}$"
)


def linked_dates(pages: DataFrame, pattern: str, html: str = "html") -> DataFrame:
    """The distinct dates in a page's links; eight digits that are no date are passed over."""
    stamps = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    day = F.try_to_timestamp("stamp", F.lit("yyyyMMdd")).cast("date")
    keep = [c for c in pages.columns if c != html]
    return (
        pages.select(*keep, F.explode(stamps).alias("stamp"))
        .select(*keep, day.alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
    )


def collapsed(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def title(html: str = "html") -> Column:
    return collapsed(F.regexp_extract(html, TITLE, 1))


def is_policy_statement(html: str = "html", wording: str = STATEMENT_TITLE) -> Column:
    """Whether the page's own title carries the wording."""
    return F.contains(title(html), F.lit(wording))


def cell_text(cell: Column) -> Column:
    bare = F.regexp_replace(cell, r"<[^>]+>", "")
    return F.trim(F.replace(collapsed(bare), F.lit("&nbsp;"), F.lit(" ")))


def table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every table row of every page as an array of cell texts."""
    keep = [c for c in pages.columns if c != html]
    rows = F.regexp_extract_all(html, F.lit(ROW), F.lit(1))
    cells = F.regexp_extract_all("_row", F.lit(CELL), F.lit(1))
    return pages.select(*keep, F.explode(rows).alias("_row")).select(
        *keep, F.transform(cells, cell_text).alias("cells")
    )


def statistics_releases(pages: DataFrame, html: str = "html") -> DataFrame:
    """`date, time_et, kind` of each release whose name matches in full."""
    name = F.get("cells", F.lit(2))
    day = F.try_to_timestamp(
        F.regexp_replace(F.get("cells", F.lit(0)), r"^[A-Za-z]+, ", ""), F.lit("MMMM d, yyyy")
    )
    padded = F.try_to_timestamp(
        F.regexp_replace(F.get("cells", F.lit(0)), r"^[A-Za-z]+, ", ""), F.lit("MMMM dd, yyyy")
    )
    clock = F.try_to_timestamp(F.trim(F.get("cells", F.lit(1))), F.lit("hh:mm a"))
    kind = F.when(F.startswith(name, F.lit("Consumer")), "cpi").otherwise("payrolls")
    keep = [c for c in pages.columns if c != html]
    return (
        table_rows(pages, html)
        .where((F.size("cells") >= 3) & name.rlike(RELEASE))
        .select(
            *keep, F.coalesce(day, padded).cast("date").alias("date"),
            F.coalesce(F.date_format(clock, "HH:mm"), F.lit("")).alias("time_et"),
            kind.alias("kind"),
        )
        .where(F.col("date").isNotNull())
    )
