"""Link extraction from HTML pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.functions import scalars

# What holds no anchors: comments, scripts and styles.
SILENT = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)"
# An anchor: its attributes (group 1) and its inner markup (group 2).
ANCHOR = r"""(?is)<a(\s(?:[^>"']|"[^"]*"|'[^']*')*)>(.*?)</a\s*>"""
# The target: after any other attributes; in double quotes, in single quotes or bare.
OTHERS = r"""(?:\s+(?!href[\s=])[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*+"""
TARGET = rf"""(?is)^{OTHERS}\s+href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TAG = r"""<(?:[^>"']|"[^"]*"|'[^']*')*>"""
# Named characters, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))


def _decoded(text: Column) -> Column:
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def page_links(pages: DataFrame) -> DataFrame:
    """One row per anchor with a target of every page, with its text freed of markup.

    Targets may be quoted either way or bare; anchors inside comments, scripts and styles are none.
    """
    html = F.regexp_replace("html", SILENT, "")
    anchors = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(ANCHOR), 1).alias("attributes"),
        F.regexp_extract_all(html, F.lit(ANCHOR), 2).alias("inner"),
    )
    attributes = F.col("link.attributes")
    target = F.concat(*[F.regexp_extract(attributes, TARGET, group) for group in (1, 2, 3)])
    return (
        pages.select("page_id", "url", F.explode(anchors).alias("link"))
        .where(F.regexp_like(attributes, F.lit(TARGET)))
        .select(
            "page_id",
            "url",
            _decoded(target).alias("href"),
            F.trim(_decoded(F.regexp_replace("link.inner", TAG, ""))).alias("link_text"),
        )
    )


def relevant_links(pages: DataFrame, text_terms: list[str], href_terms: list[str]) -> DataFrame:
    """Anchors whose text or target contains one of the terms, case ignored."""
    return page_links(pages).where(
        scalars.contains_any(F.col("link_text"), text_terms)
        | scalars.contains_any(F.col("href"), href_terms)
    )


def link_counts(pages: DataFrame, text_terms: list[str], href_terms: list[str]) -> DataFrame:
    """All anchors and relevant anchors of the page set."""
    hit = scalars.contains_any(F.col("link_text"), text_terms) | scalars.contains_any(
        F.col("href"), href_terms
    )
    return page_links(pages).agg(
        F.count("*").alias("links"), F.count_if(hit).alias("relevant_links")
    )
