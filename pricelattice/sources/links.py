"""Links of web pages: extract, resolve, scope, classify, and read metadata off them."""

from __future__ import annotations

import html as html_entities

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.functions.text import last_segment

# Comments, scripts and styles hold no tags for a browser.
_NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ANCHOR = r"(?is)<a(?:\s+(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)?\shref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"


def decode_entities(text: Column) -> Column:
    """Character references as a browser reads them; Spark has no built-in for the named ones."""

    def decode(batch: pd.Series) -> pd.Series:  # local, so it travels to the tasks by value
        return batch.map(html_entities.unescape, na_action="ignore")

    return F.pandas_udf(decode, "string")(text)


def anchor_hrefs(page_html: Column) -> Column:
    """All href values of <a> tags, as written, without their quotes."""
    found = F.regexp_extract_all(F.regexp_replace(page_html, _NOT_MARKUP, ""), F.lit(_ANCHOR), 1)
    return F.transform(found, lambda h: F.regexp_replace(h, "^[\"']|[\"']$", ""))


def extract_links(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """One row per non-empty href.  Only hrefs with an entity are sent to Python."""
    hrefs = pages.select(*keep, F.explode(anchor_hrefs(F.col(html))).alias("_raw"))
    has_entity = F.col("_raw").contains("&")
    decoded = F.coalesce(decode_entities(F.when(has_entity, F.col("_raw"))), F.col("_raw"))
    return hrefs.select(*keep, decoded.alias("href")).where("href != ''")


def _without_dots(path: Column) -> Column:
    """Path with '.' and '..' segments removed; only paths that may hold one are walked."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    # a path ending in a dot segment denotes a folder
    parts = F.when(last.isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    steps = F.filter(parts, lambda p: p != ".")
    keep_root = lambda acc: F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
    walked = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", keep_root(acc)).otherwise(F.concat(acc, F.array(p))),
    )
    return F.when(path.contains("/."), F.array_join(walked, "/")).otherwise(path)


def resolve_links(links: DataFrame, base: str, href: str = "href", link: str = "link") -> DataFrame:
    """Adds the absolute URL of an href found on page ``base``; links to no host are dropped.

    The steps are columns of their own, so that Spark computes each part once.
    """
    kept = links.columns
    scheme = r"^([A-Za-z][A-Za-z0-9+.-]*):"
    parts = links.withColumns({
        "_scheme": F.regexp_extract(base, scheme, 1),
        "_origin": F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0),
        "_bare": F.substring_index(base, "#", 1),
        "_page": F.substring_index(F.substring_index(base, "#", 1), "?", 1),
        "_own": F.regexp_extract(href, scheme, 1),
    })
    # 'http:page' on an http page is a relative link
    absolute = (F.col("_own") != "") & (
        (F.lower("_own") != F.lower("_scheme")) | F.substring(F.col(href), F.length("_own") + 2, F.lit(2)).eqNullSafe("//")
    )
    local = F.when(F.col("_own") == "", F.col(href)).otherwise(F.col(href).substr(F.length("_own") + 2, F.length(href)))
    parts = parts.withColumns({"_absolute": absolute, "_rest": F.when(~absolute, local)})
    parts = parts.withColumns({
        "_target": F.regexp_extract("_rest", r"^([^?#]*)", 1),
        "_tail": F.regexp_extract("_rest", r"^[^?#]*(.*)$", 1),
        "_folder": F.when(F.col("_page") == F.col("_origin"), "/").otherwise(
            F.regexp_extract(F.col("_page").substr(F.length("_origin") + 1, F.length("_page")), "^.*/", 0)
        ),
    })
    rest = F.col("_rest")
    path = F.when(rest.startswith("/"), F.col("_target")).otherwise(F.concat("_folder", "_target"))
    resolved = (
        F.when(F.col("_absolute"), F.col(href))
        .when(rest == "", F.col(base))
        .when(rest.startswith("//"), F.concat(F.col("_scheme"), F.lit(":"), rest))
        .when(rest.startswith("?"), F.concat("_page", rest))
        .when(rest.startswith("#"), F.concat("_bare", rest))
        .otherwise(F.concat(F.col("_origin"), _without_dots(path), F.col("_tail")))
    )
    ignored = F.col(href).startswith(V.IGNORED_LINK_SCHEMES[0])
    for prefix in V.IGNORED_LINK_SCHEMES[1:]:
        ignored = ignored | F.col(href).startswith(prefix)
    url = parts.select(*kept, F.when(~ignored, resolved).alias(link))
    has_host = F.when(F.col(link).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]"), F.col(link))
    # exploding drops the nulls without computing the column a second time for a filter
    return url.select(*kept, F.explode(F.array_compact(F.array(has_host))).alias(link))


def in_scope(links: DataFrame, prefix: str | Column, excluded: list[str] = V.EXCLUDED_LINK_WORDS) -> DataFrame:
    """Links below a prefix that contain none of the excluded words in any case."""
    kept = links.where(F.col("link").startswith(prefix))
    for word in excluded:
        kept = kept.where(~F.lower("link").contains(word))
    return kept


def distinct_links(links: DataFrame, page: list[str]) -> DataFrame:
    return links.select(*page, "link").distinct()


def is_file(link: Column) -> Column:
    return last_segment(link).contains(".")


def url_metadata(links: DataFrame, link: str = "link") -> DataFrame:
    """Region, state, year, month and file facts from the last five parts of a URL."""
    parts = F.split(F.col(link), "/", -1)

    def before_dash(c: Column) -> Column:
        return F.substring_index(c, "-", 1)

    name = F.col("filename")
    return links.withColumn("filename", F.try_element_at(parts, F.lit(-1))).withColumns({
        "region": F.try_element_at(parts, F.lit(-5)),
        "state_code": F.try_element_at(parts, F.lit(-4)),
        "year": before_dash(F.try_element_at(parts, F.lit(-3))),
        "month": before_dash(F.try_element_at(parts, F.lit(-2))),
        "extension": F.substring_index(name, ".", -1),
        "revisado": F.lower(name).contains(V.REVISED_WORD),
    })


def harvest(pages: DataFrame, prefix: str, page: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """In-scope distinct links of a page table, as (links to files, links to pages)."""
    links = resolve_links(extract_links(pages, [page], html), page)
    found = distinct_links(in_scope(links, prefix), [page])
    return found.where(is_file(F.col("link"))), found.where(~is_file(F.col("link")))
