"""Release-page link scan and the already-present check, as jobs
over a table of HTML pages (no HTTP client: fetching is not Spark's job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import last_path_component

# Fixed value: the anchor pattern whose first group is the link target.
ANCHOR_HREF = r'<a href="([^"]*)"'


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               pattern: str = ANCHOR_HREF) -> DataFrame:
    """S10 + F11: one row per anchor target: ``page_id, link, name`` where
    ``name`` is the last path component. Whole pages are scanned."""
    return (pages.select(id_col, F.explode(
                F.regexp_extract_all(F.col(html_col), F.lit(pattern), 1)).alias("link"))
                 .withColumn("name", last_path_component("link")))


def new_links(links: DataFrame, existing: DataFrame, name_col: str = "name") -> DataFrame:
    """Links whose file name is not among ``existing`` names (anti join)."""
    return links.join(existing.select(name_col).distinct(), name_col, "left_anti") \
                .select(*links.columns)


# The class of the data-set table, and the numbered rows that must carry these labels.
LABELLED_TABLE = "border_table"
LABELLED_ROWS = {
    8: "Гиперссылка (URL) на набор",
    16: "Гиперссылки (URL) на предыдущие релизы набора данных",
}


def _cell_text(html):
    """Text of a cell: tags out, white space trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"(?s)<[^>]*>", ""), r"^\s+|\s+$", ""))


def _numbered(number: int):
    """Whether a row struct carries a number."""
    return lambda r: r["row"] == number


def labelled_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                   table_class: str = LABELLED_TABLE,
                   expected: dict[int, str] | None = None) -> DataFrame:
    """S10 for data-set pages: ``page_id, row, link`` of the anchors in the
    expected rows, in page order.

    A page counts only if its table holds every expected row number with its
    label; rows are the ones with three cells and a numeric first one (of a
    repeated number the last counts). Link targets are trimmed.
    """
    expected = LABELLED_ROWS if expected is None else expected
    table = F.regexp_extract(F.col(html_col), rf'(?is)<table\b[^>]*\bclass="(?:[^"]*\s)?{table_class}(?:\s[^"]*)?"[^>]*>(.*?)</table>', 1)
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1)
    cells = F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), 1))
    three = F.filter(cells, lambda c: (F.size(c) == 3) & _cell_text(c[0]).rlike("^[0-9]{1,9}$"))
    numbered = F.transform(three, lambda c: F.struct(
        _cell_text(c[0]).cast("int").alias("row"), _cell_text(c[1]).alias("label"), c[2].alias("value")))
    page = pages.select(id_col, numbered.alias("_rows"))
    wanted = []
    for number, label in expected.items():
        same = F.filter("_rows", _numbered(number))
        last = F.element_at(same, -1)
        page = page.filter(F.size(same) > 0).filter(last["label"] == label)
        wanted.append(F.struct(F.lit(number).alias("row"), F.transform(
            F.regexp_extract_all(last["value"], F.lit(r'(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"'), 1), lambda h: F.trim(h)).alias("links")))
    found = page.select(id_col, F.explode(F.array(*wanted)).alias("_w"))
    return found.select(id_col, F.col("_w.row").alias("row"), F.explode("_w.links").alias("link"))
