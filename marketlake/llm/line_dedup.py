"""Line dedup by site-relative frequency (operator 7, native).

The pages of a host that contain a line, divided by all pages of the host: lines
above a boilerplate ratio are dropped from every page of that host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import same, small_side, written

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
# (opening, closing) of what is no text; an opening after the last closing opens nothing
HIDDEN = ((r"<(script\b)", r"</script\s*+>"), (r"<(style\b)", r"</style\s*+>"), (r"<(!--)", r"-->"))
MARK = "\ue000"


def line_key(line: Column) -> Column:
    """Hash of a line without the blanks at its ends; null for a blank line."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(bare != "", F.xxhash64(bare))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def boilerplate(df: DataFrame, host_col: str = "host", text_col: str = "text",
                max_ratio: float = 0.2, min_pages: int = 3) -> DataFrame:
    """(host, drops array<long>): the keys of the lines that stand on more than `max_ratio` of the
    host's pages and on `min_pages` at least, the least that tells a habit of the host from a line quoted once: it
    decides for hosts of fewer than `min_pages` / `max_ratio` pages.  A host has at most (mean lines a page / max_ratio) of them.
    Counted with map-side partial sums, so a line or host in a third of all rows costs one row a task."""
    host = F.col(host_col).alias("host")
    keys = F.array_distinct(F.array_compact(F.transform(lines_of(F.col(text_col)), line_key)))
    # the pages themselves ride along as one more entry each
    entries = F.concat(F.array(F.struct(F.lit(True).alias("page"), F.lit(0).cast("long").alias("key"))),
                       F.transform(keys, lambda k: F.struct(F.lit(False).alias("page"), k.alias("key"))))
    counts = df.select(host, F.explode(entries).alias("e")).groupBy("host", "e").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("e.page") | (F.col("n") >= min_pages))
    counts = written(counts, "line-counts")
    totals = counts.filter("e.page").select(F.col("host").alias("__h"), F.col("n").alias("pages"))
    often = counts.filter("not e.page").join(totals, same(F.col("host"), F.col("__h")))
    return often.filter(F.col("n") > F.lit(max_ratio) * F.col("pages")).groupBy("host").agg(
        F.collect_list("e.key").alias("drops"))


def drop_lines(df: DataFrame, host_col: str = "host", text_col: str = "text",
               max_ratio: float = 0.2, min_pages: int = 3) -> DataFrame:
    """`df` with the boilerplate lines taken out of `text_col`, plus n_lines long (lines
    with a word) and n_dropped long.

    Every row is a page: repeated rows count as often as they occur.  A null host is a host of its own;
    a null text has no lines and stays null; blank lines are neither counted nor dropped; a page whose
    lines all go keeps its row with an empty text.  An empty table gives an empty one.  A column of `df`
    named like a result is replaced.
    """
    df = df.drop("n_lines", "n_dropped")
    drops = written(boilerplate(df, host_col, text_col, max_ratio, min_pages), "boilerplate")
    entries = drops.agg(F.coalesce(F.sum(F.size("drops")), F.lit(0))).first()[0]
    d = small_side(drops.select(F.col("host").alias("__h"), "drops"), entries)
    out = df.join(d, same(F.col(host_col), F.col("__h")), "left")
    lines = lines_of(F.col(text_col))
    rest = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("drops"), line_key(x)), F.lit(False)))
    keep = F.when(F.col("drops").isNull() | F.col(text_col).isNull(), F.col(text_col)).otherwise(F.array_join(rest, "\n"))
    worded = lambda t: F.size(F.filter(lines_of(t), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long")
    n = worded(F.col(text_col))
    return out.withColumn("__kept", keep).select(
        *[F.col("__kept").alias(c) if c == text_col else F.col(c) for c in df.columns],
        n.alias("n_lines"), (n - worded(F.col("__kept"))).alias("n_dropped"))


def _may_be_open(html: Column, lower: Column) -> Column:
    """Whether the last opening of a kind is followed by no closing, found without patterns; a closing with blanks counts as none."""
    kinds = ((lower, "<script", "</script>"), (lower, "<style", "</style>"), (html, "<!--", "-->"))
    found = [F.contains(t, F.lit(o)) & ~F.contains(F.substring_index(t, o, -1), F.lit(c)) for t, o, c in kinds]
    return found[0] | found[1] | found[2]


def _closed(pages: DataFrame) -> DataFrame:
    """`pages` with MARK inside every opening in `html` that stands after the last closing of its kind, so that no search for a
    closing runs to the end in vain.  A MARK of the text itself is written as MARK and "a".  Only pages with `__open` are changed:
    `_may_be_open` is true for all that have such an opening.  Steps are projections of their own, as each uses the one before it more than once."""
    rest = [c for c in pages.columns if c != "html"]
    escaped = F.when(F.col("__open"), F.replace("html", F.lit(MARK), F.lit(MARK + "a"))).otherwise(F.col("html"))
    pages = pages.select(*rest, escaped.alias("html"))
    for opening, closing in HIDDEN:
        # the end of the last closing; pages without the opening need no search
        head = F.when(F.col("__open") & F.col("html").rlike(f"(?i){opening}"), F.length(F.regexp_extract("html", f"(?is)^.*{closing}", 0)))
        pages = pages.select(*rest, "html", head.alias("__head"))
        tail = F.substr("html", F.col("__head") + 1)
        marked = F.concat(F.substr("html", F.lit(1), F.col("__head")), F.regexp_replace(tail, f"(?i){opening}", f"<{MARK}b$1"))
        pages = pages.select(*rest, F.when(F.col("__head") < F.length("html"), marked).otherwise(F.col("html")).alias("html"))
    return pages


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, host, text): the host of the URL in lower case, null without one, and the HTML's text with
    a line for each element.  The time grows as the HTML does, also for openings that are never closed."""
    pages = pages.select("page_id", "url", "html", F.lower("html").alias("__lower"))
    pages = _closed(pages.select("page_id", "url", "html", _may_be_open(F.col("html"), F.col("__lower")).alias("__open")))
    text = F.regexp_replace("html", r"(?is)<(?:(script|style)\b[^>]*+>.*?</\1\s*+>|!--.*?-->)", "\n")
    pages = pages.select("page_id", "url", "__open", text.alias("__html"))
    back = F.replace(F.replace("__html", F.lit(f"<{MARK}b"), F.lit("<")), F.lit(MARK + "a"), F.lit(MARK))
    pages = pages.select("page_id", "url", F.when(F.col("__open"), back).otherwise(F.col("__html")).alias("__html"))
    # after the last ">" and its blanks there is no element; where no "<" stands there, none is looked for
    last = F.when(F.contains(F.substring_index("__html", ">", -1), F.lit("<")), F.length(F.regexp_extract("__html", r"(?s)^.*>\s*+", 0)))
    pages = pages.select("page_id", "url", "__html", last.alias("__last"))
    # blanks before an element go with it; a run of them is tried from its start only
    strip = r"[<\x20\t\n\x0B\f\r](?:(?<=<)|(?<!\s\s)\s*+<)[^>]*+>\s*+"
    text = F.when(F.col("__last").isNull(), F.regexp_replace("__html", strip, "\n")).otherwise(
        F.concat(F.regexp_replace(F.substr("__html", F.lit(1), F.col("__last")), strip, "\n"), F.substr("__html", F.col("__last") + 1)))
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)
    return pages.select("page_id", F.when(host != "", F.lower(host)).alias("host"), text.alias("text"))


def report(deduped: DataFrame) -> DataFrame:
    return deduped.select("page_id", "host", "n_lines", "n_dropped",
                          F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
