"""Links and readable text of crawled pages, by regular expressions in the JVM."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed values
HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
PARAGRAPH = r"(?s)<p\b[^>]*>(.*?)</p>"
TAG = r"(?s)<[^>]*>"
HIDDEN = r"(?s)<(script|style)\b.*?</(script|style)>"


def extract_links(df: DataFrame, key: str, html: str, contains: str | None = None) -> DataFrame:
    """One row per anchor with its place on the page, whatever the case and the quotes of the attribute; ``contains`` keeps the
    links with that part."""
    quoted, single, bare = (F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(i)) for i in (1, 2, 3))
    together = lambda a, b: F.concat(a, b)  # noqa: E731  one of the three is filled
    links = F.zip_with(F.zip_with(quoted, single, together), bare, together)
    out = df.select(key, F.posexplode(links).alias("pos", "href"))
    return out if contains is None else out.filter(F.contains("href", F.lit(contains)))


def extract_text(df: DataFrame, key: str, html: str) -> DataFrame:
    """Text of the first paragraph: scripts and tags removed, line breaks with their indent folded to one."""
    visible = F.regexp_replace(F.col(html), HIDDEN, "")
    first = F.regexp_extract(visible, PARAGRAPH, 1)
    plain = F.regexp_replace(first, TAG, "")
    folded = F.replace(F.regexp_replace(plain, "\r\n[ \t\r\n]+", "\n"), F.lit("\n\n"), F.lit("\n"))
    return df.select(key, folded.alias("text"))
