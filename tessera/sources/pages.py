"""Structured items from a table of stored HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The five entities every HTML text must escape or may contain, in decoding order.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def decode_entities(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def strip_tags(html: Column) -> Column:
    """Visible text: tags become a space, entities are decoded, white space is collapsed."""
    bare = F.regexp_replace(html, "(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(bare), r"\s+", " "))


def cut_suffix(text: Column, marker: str) -> Column:
    """The text before ``marker``, trimmed."""
    return F.trim(F.split_part(text, F.lit(marker), F.lit(1)))


def page_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """One item per page: lang, title, heading, body text and the ordered links."""
    return pages.withColumns(
        {
            "lang": F.regexp_extract(html, '<html lang="([^"]*)"', 1),
            "title": strip_tags(F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1)),
            "heading": strip_tags(F.regexp_extract(html, "(?s)<h1>(.*?)</h1>", 1)),
            "body": strip_tags(F.regexp_extract(html, "(?s)<article>(.*?)</article>", 1)),
            "links": F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), F.lit(1)),
        }
    ).drop(html)


def page_links(pages: DataFrame, top_k: int | None = None, html: str = "html") -> DataFrame:
    """One row per link with its position on the page; ``top_k`` keeps the first k of each page."""
    links = F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), F.lit(1))
    if top_k is not None:
        links = F.slice(links, 1, top_k)
    return pages.select("*", F.posexplode(links).alias("pos", "link")).drop(html)
