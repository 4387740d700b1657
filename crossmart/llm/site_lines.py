"""Line deduplication by site-relative frequency: lines on too large a share of a host's pages go.

One rule for hosts of every size: a line goes if it is on ``LEAST_PAGES`` pages at least and its
share of the host's pages lies above ``RATIO`` by more than chance, that is, if the lower end of
its 95 % score interval does. On ten pages three are enough, on 28 four, on 2,000 pages 120.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmart.llm.common import SALTS, let, stage

RATIO, LEAST_PAGES, DEVIATIONS = 0.05, 3, 1.96
#: Hosts with boilerplate are broadcast up to this total number of boilerplate lines.
BROADCAST_LINES = 200_000
#: Elements that end a line.
BLOCK_TAGS = (
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul"
).split()
#: Character references that are decoded; the ampersand comes last.
REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""))


def by_first_letter(names: list[str]) -> str:
    """A pattern of any of the names that looks at their first letter once."""
    letters = sorted({n[0] for n in names})
    return "|".join(f"{x}(?:{'|'.join(n[1:] for n in names if n[0] == x)})" for x in letters)


def replaced(text: Column, old: str, new: str) -> Column:
    """A text with ``old`` replaced; texts without it, most of them, are only looked through."""
    return let(text, lambda t: F.when(F.contains(t, F.lit(old)), F.replace(t, F.lit(old), F.lit(new))).otherwise(t))


def lines_of_html(html: Column) -> Column:
    """The visible lines of a page: blocks and breaks end a line, other tags vanish."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(?:!--.*?-->|script\b.*?</script>|style\b.*?</style>)", "\n")
    text = F.regexp_replace(text, rf"(?is)</?(?:{by_first_letter(BLOCK_TAGS)})(?:\s[^>]*)?/?>", "\n")
    text = F.regexp_replace(text, r"(?s)<[A-Za-z/!][^>]*>", "")
    for name, char in REFERENCES:
        text = replaced(text, name, char)
    return lines_of_text(text)


def lines_of_text(text: Column) -> Column:
    """Non-empty lines, with white space inside turned into one space.

    A pattern tries every character of a text, so one runs only where blanks follow each other.
    """
    text = F.coalesce(text, F.lit(""))
    for char in "\t\x0b\x0c\r":
        text = replaced(text, char, " ")
    text = let(text, lambda t: F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, " {2,}", " ")).otherwise(t))
    text = replaced(replaced(text, " \n", "\n"), "\n ", "\n")
    return F.array_remove(F.split(F.trim(text), "\n", -1), "")


def digest(line: Column) -> Column:
    """What makes two lines the same line: their MD5."""
    return F.md5(line.cast("binary"))


def too_frequent(n_pages: Column, host_pages: Column, ratio: float = RATIO) -> Column:
    """Whether a share lies above the ratio at the lower end of its score interval."""
    return n_pages - ratio * host_pages > DEVIATIONS * F.sqrt(F.lit(ratio * (1 - ratio)) * host_pages)


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, digest, n_pages, host_pages) of the lines that are too frequent, from (host, lines).

    A page counts once for each of its lines. Counts combine before the shuffle, so a host
    with a third of all pages sends one row a line and task.
    """
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")).where(F.col("host_pages") >= least_pages)
    once = pages.select("host", F.explode(F.array_distinct(F.transform("lines", digest))).alias("digest"))
    counts = once.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n_pages")).where(F.col("n_pages") >= least_pages)
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)))
    spread = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread.withColumn("salt", F.col("salt").cast("long")), ["host", "salt"]).where(
        too_frequent(F.col("n_pages"), F.col("host_pages"), ratio)).select("host", "digest", "n_pages", "host_pages")


def without_boilerplate(
    pages: DataFrame, lines: Column, key: str = "page_id", url: str = "url",
    ratio: float = RATIO, least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """(page_id, url, host, n_lines, n_dropped, text): the lines that stay, joined by line ends.

    The lines of a page are read once and written. A host's boilerplate lines number at most
    its mean lines a page over the ratio, so they travel as one array a host. Pages without a
    host form a site of their own; null and empty pages have no lines; repeated rows count as
    pages; a line on one or two pages always stays.
    """
    parsed = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), lines.alias("lines"))
    read = stage(parsed, "lines")
    found = stage(boilerplate(read.select("host", "lines"), ratio, least_pages), "boilerplate")
    per_host = found.groupBy("host").agg(F.collect_set("digest").alias("gone"))
    if found.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES:
        known = read.join(F.broadcast(per_host), "host", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "lines"), F.lit(SALTS))
        spread = per_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("salt", F.col("salt").cast("long"))
        known = read.withColumn("salt", salt).join(spread, ["host", "salt"], "left").drop("salt")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains("gone", digest(x))))
    sized = known.select("page_id", "url", "host", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    return sized.select(
        "page_id", "url", "host", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
