"""URL filter with redirect equivalence.

Rules name a host and a path; the longest rule that fits a URL decides it.  URLs that
are joined by canonical links or redirects are aliases: their classes are connected
components, computed by joins alone.  A class with a blocked URL blocks its members
that no rule decides, unless a member is explicitly allowed; an explicit allow always
stands for its own URL and takes precedence for its aliases.

Edges come from the pages themselves (``<link rel=canonical>``, ``<meta
http-equiv=refresh>``) and from an optional table of redirects.  Two URLs are the same
node when host, path and query agree; scheme and fragment do not count.  References are
resolved against the page's ``<base>``, else its URL; tags in comments and scripts are text.

Defined cases: a null URL, or one without ``://``, has empty host and path, no aliases
and no rule, so it is allowed; a null page has no links; a very long page is searched
whole; of rules of one length that of the longer host counts, then the allowing one;
repeated rows are judged alike; other columns, whatever their names, are ignored; empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.llm._spark import connected_components, materialise

#: (verdict, host, path)
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")), F.lit(""))


def split_url(df: DataFrame) -> DataFrame:
    """Adds host, path and node (host, path and query; null for no URL) to a frame with ``url``."""
    rest = _rest(F.col("url"))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    tail = F.regexp_replace(rest, r"^[^/?#]*", "")
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    node = F.when(host != "", F.concat(host, F.regexp_extract(F.when(path == "", F.concat(F.lit("/"), tail)).otherwise(tail), r"^[^#]*", 0)))
    return df.withColumns({"host": host, "path": path, "node": node})


def rule_of(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null if none fits.

    The longest is that of the longest host and path together, then of the longest host, then the allowing one.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "allow")):  # the last one that fits wins
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _resolve(url: str, base: str, href: str) -> str | None:
    page = "http://" + url.partition("://")[2]  # the scheme does not count, and urljoin knows only some
    try:
        return urljoin(urljoin(page, base), href)
    except ValueError:
        return href


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        urls, bases, hrefs = (batch.column(c).to_pylist() for c in ("url", "base", "href"))
        yield pa.RecordBatch.from_pydict({"url": pa.array(urls, pa.string()), "target": pa.array(map(_resolve, urls, bases, hrefs), pa.string())})


#: Markup in which a tag is only text, and the tags that hold links.
_UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title|template|noscript)\b.*?(?:</\1|\z)"
_TAGS = r"(?i)<(?:link|meta|base)\s[^<>]*+>"
_CANONICAL = r"""(?i)^<link\s.*\brel\s*=\s*(?:canonical\b|"[^"]*\bcanonical\b|'[^']*\bcanonical\b)"""
_REFRESH = r"""(?i)^<meta\s.*\bhttp-equiv\s*=\s*["']?\s*refresh\b"""


def _value(tag: Column, name: str) -> Column:
    """The value after ``name =``, quoted or bare; empty if there is none."""
    pattern = rf"""(?i)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.replace(F.trim(F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])), F.lit("&amp;"), F.lit("&"))


def page_links(pages: DataFrame) -> DataFrame:
    """Canonical and refresh targets of ``pages(url, html)`` as (url, target); relative ones are resolved against the page's base."""
    read = pages.where(F.col("url").contains("://") & F.col("html").rlike(r"(?i)\b(?:canonical|refresh)\b"))
    found = read.select("url", F.regexp_extract_all(F.regexp_replace("html", _UNREAD, ""), F.lit(_TAGS), F.lit(0)).alias("tags"))
    base = F.get(F.filter("tags", lambda t: t.rlike(r"(?i)^<base\s") & t.rlike(r"(?i)\bhref\s*=")), F.lit(0))
    wanted = F.filter("tags", lambda t: t.rlike(_CANONICAL) | t.rlike(_REFRESH))
    found = found.select("url", F.coalesce(_value(base, "href"), F.lit("")).alias("base"), F.explode(wanted).alias("tag"))
    moved = F.regexp_extract(_value(F.col("tag"), "content"), r"""(?i)\burl\s*=\s*["']?([^"']+)""", 1)
    found = found.withColumn("href", F.trim(F.when(F.col("tag").rlike(_CANONICAL), _value(F.col("tag"), "href")).otherwise(moved))).where("href <> ''")
    return found.select("url", "base", "href").mapInArrow(_resolved, "url string, target string").where(F.col("target").contains("://"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Verdicts for ``pages(page_id, url, html)``; ``redirects(url, target)`` adds edges.

    Returns page_id, host, path, rule, verdict and class_size (URLs of the class that were seen as nodes).
    """
    name, verdict = rule_of(rules)
    rows = split_url(pages.select("page_id", "url")).withColumns({"rule": name, "own": verdict})
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    ends = split_url(links.select("url", "target")).select(F.col("node").alias("u"), "target").withColumnRenamed("target", "url")
    ends = split_url(ends).select("u", F.col("node").alias("v")).where("u is not null and v is not null and u <> v")
    ends = materialise(ends.distinct(), "links")
    if ends.isEmpty():
        return rows.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"), F.lit(1).cast("long").alias("class_size"))
    classes = materialise(connected_components(ends), "classes")
    # Targets that are no pages have rules too.
    members = split_url(classes.select("root", "node", F.concat(F.lit("http://"), "node").alias("url"))).withColumn("own", verdict)
    fate = members.groupBy("root").agg(F.max(F.coalesce(F.col("own") == "block", F.lit(False))).alias("blocked"), F.max(F.coalesce(F.col("own") == "allow", F.lit(False))).alias("allowed"), F.count("*").alias("class_size"))
    fate = classes.join(fate, "root").select("node", (F.col("blocked") & ~F.col("allowed")).alias("blocked"), "class_size")
    judged = rows.join(fate, "node", "left")
    passed = F.when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("own", passed).alias("verdict"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))
