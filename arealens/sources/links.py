"""Link inventory of fetched pages (``pages(page_id, url, html)``).

A page is read as its sequence of tags (one regular expression; comments,
scripts and styles are one token each; what is left open ends with the page),
not through a DOM.  ``container``
limits it to the elements with that id (``"#name"``) or tag: open and close
tags of the container's name are counted, so nested elements stay inside and
every matching element counts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.functions.text import let

# Every repeat is possessive and every token may end with the text, so a page is read
# once from left to right, whatever it leaves open.  A quote counts after "=" only.
_TAGS = (r"""(?is)<!--(?:(?!-->).)*+(?:-->|\z)|<(script|style)\b(?:(?!</\1[\s/>]).)*+(?:</\1[^>]*+(?:>|\z)|\z)"""
         r"""|</?[a-z](?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))?+)*+(?:>|\z)""")
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's first attribute of that name, in any quoting; NULL without one."""
    other = r"""(?:[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s"'>][^\s>]*+|))?+|=)"""
    pattern = rf"""(?is)^<[a-z][^\s>/]*+(?:[\s/]*+(?!{name}\s*+=){other})*+[\s/]*+{name}\s*+=\s*+("""
    pattern += r""""[^"]*+"?|'[^']*+'?|[^\s"'>][^\s>]*+)"""

    def value(raw: Column) -> Column:
        mark = F.substring(raw, 1, 1)
        quoted = mark.isin('"', "'")
        closed = (F.length(raw) > 1) & raw.endswith(mark)
        inner = F.substring(raw, F.lit(2), F.length(raw) - F.when(closed, F.lit(2)).otherwise(F.lit(1)))
        return F.when(raw != "", F.replace(F.when(quoted, inner).otherwise(raw), F.lit("&amp;"), F.lit("&")))

    return let(F.regexp_extract(tag, pattern, 1), value)


def _is_anchor(tag: Column) -> Column:
    return tag.rlike(r"(?i)^<a[\s/]")


def _name(tag: Column) -> Column:
    return F.lower(F.regexp_extract(tag, r"^</?([A-Za-z][^\s>/]*+)", 1))


def _spans(tags: Column, numbered: Column, container: str) -> Column:
    """[(from, to)] of the outermost container elements, as places of their tags.

    Only tags of the container's name (of every name that carries its id) are
    folded, and of each element only the depth."""
    if container.startswith("#"):
        def wanted(tag: Column) -> Column:
            return tag.contains(container[1:]) & F.coalesce(_attribute(tag, "id") == container[1:], F.lit(False))

        names = F.array_distinct(F.transform(F.filter(tags, wanted), _name))
        marks = let(names, lambda some: F.filter(numbered, lambda x: F.array_contains(some, _name(x["tag"]))))
    else:
        def wanted(tag: Column) -> Column:
            return F.lit(True)

        marks = F.filter(numbered, lambda x: x["tag"].rlike(rf"(?i)^</?{re.escape(container)}(?:[\s/>]|$)"))

    def step(acc: Column, mark: Column) -> Column:
        name, closing = _name(mark["tag"]), mark["tag"].startswith("</")
        leaf = name.isin(*_VOID) | mark["tag"].endswith("/>")
        enters = (acc["depth"] == 0) & ~closing & ~leaf & wanted(mark["tag"])
        same = (acc["depth"] > 0) & (name == acc["name"]) & ~leaf
        leaves = same & closing & (acc["depth"] == 1)
        return F.struct(
            F.when(enters, name).otherwise(acc["name"]).alias("name"),
            F.when(enters, F.lit(1)).when(same & closing, acc["depth"] - 1)
             .when(same, acc["depth"] + 1).otherwise(acc["depth"]).alias("depth"),
            F.when(enters, mark["at"]).otherwise(acc["from"]).alias("from"),
            F.when(leaves, F.concat(acc["spans"], F.array(F.struct(acc["from"].alias("from"), mark["at"].alias("to")))))
             .otherwise(acc["spans"]).alias("spans"))

    start = F.struct(F.lit("").alias("name"), F.lit(0).alias("depth"), F.lit(-1).alias("from"),
                     F.array().cast("array<struct<from:int,to:int>>").alias("spans"))
    rest = F.lit(2**31 - 1)  # an element that is never closed holds the rest of the page
    return F.aggregate(marks, start, step, lambda acc: F.when(acc["depth"] > 0, F.concat(
        acc["spans"], F.array(F.struct(acc["from"].alias("from"), rest.alias("to"))))).otherwise(acc["spans"]))


def page_hrefs(container: str | None = None) -> Column:
    """Array of the page's hrefs in page order (optionally within a container)."""
    every = F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(_TAGS), F.lit(0))

    def hrefs(anchors: Column) -> Column:
        return F.filter(F.transform(anchors, lambda t: _attribute(t, "href")), lambda h: h.isNotNull())

    if container is None:
        return hrefs(F.filter(every, _is_anchor))

    def within(tags: Column) -> Column:
        numbered = F.transform(tags, lambda t, i: F.struct(t.alias("tag"), i.alias("at")))
        return let(numbered, lambda some: let(_spans(tags, some, container), lambda spans: F.transform(
            F.filter(some, lambda x: _is_anchor(x["tag"]) & F.exists(
                spans, lambda s: (x["at"] > s["from"]) & (x["at"] < s["to"]))), lambda x: x["tag"])))

    return hrefs(let(every, within))


def link_inventory(pages: DataFrame, keep: str | None = None, container: str | None = None,
                   prefix=None, page_cols=("page_id",)) -> DataFrame:
    """(page columns, link_no, href): every anchor in page order (``link_no``
    from 1), kept when ``href`` matches the regex ``keep``.  ``prefix`` (text
    or Column, e.g. the page's host) is put in front of each kept href."""
    links = pages.select(*page_cols, F.posexplode(page_hrefs(container)).alias("pos", "href"))
    links = links.select(*page_cols, (F.col("pos") + 1).alias("link_no"), "href")
    if keep is not None:
        links = links.filter(F.col("href").rlike(keep))
    if prefix is not None:
        p = F.lit(prefix) if isinstance(prefix, str) else prefix
        links = links.withColumn("href", F.concat(p, F.col("href")))
    return links


def first_link(pages: DataFrame, keep: str | None = None, container: str | None = None,
               prefix=None, page_cols=("page_id",)) -> DataFrame:
    """(page columns, href, link_no): the first kept link of each page, read
    from the page's own ordered link array - no shuffle, one row per page
    that has a kept link.  The array is built once per page."""
    def first(hrefs: Column) -> Column:
        numbered = F.transform(hrefs, lambda h, i: F.struct(h.alias("href"), (i + 1).cast("int").alias("link_no")))
        return F.get(numbered if keep is None else F.filter(numbered, lambda x: x["href"].rlike(keep)), F.lit(0))

    pre = F.lit("") if prefix is None else (F.lit(prefix) if isinstance(prefix, str) else prefix)
    return (pages.select(*page_cols, F.explode(F.filter(F.array(let(page_hrefs(container), first)),
                                                        lambda x: x.isNotNull())).alias("_h"), pre.alias("_p"))
                 .select(*page_cols, F.concat("_p", "_h.href").alias("href"), F.col("_h.link_no").alias("link_no")))


def newest_link(links: DataFrame, group_cols=("page_id",)) -> DataFrame:
    """First listed link per page of an exploded link frame (publishers list
    the newest first).  Uses the explicit position, never row order; a
    partial aggregate, so a page with very many links is reduced map-side.
    For pages, ``first_link`` does the same without a shuffle."""
    return links.groupBy(*group_cols).agg(F.min_by("href", "link_no").alias("href"),
                                          F.min("link_no").alias("link_no"))
