"""Texts full of matches: the same spans, in time that grows about as the text does."""

import random
import re
import time

from brute import pii as plain

from pyspark.sql import functions as F

from marketlake.llm import line_dedup, pii

WORDS = "alpha beta gamma delta"


def text(n):
    return " ".join(f"{WORDS} user{i}@mail{i}.example.org 10.0.{i % 256}.{i % 200} +1 555 {1000 + i % 9000} 4567" for i in range(n))


def seconds(spark, t):
    df = pii.detect(spark.createDataFrame([(1, t)], "doc_id long, text string"))
    began = time.perf_counter()
    row = df.collect()[0]
    return time.perf_counter() - began, row


def test_detection_of_thousands_of_spans(spark):
    seconds(spark, text(10))
    _, row = seconds(spark, text(400))
    names = pii.KINDS
    assert [f"{names[s.no]}:{s.start}:{s.end}" for s in row.base] == plain(text(400))
    small, _ = seconds(spark, text(2000))
    large, row = seconds(spark, text(8000))  # 650 KB, 24,000 spans
    assert row.n_email == row.n_ip == row.n_phone == 8000
    assert large < 30 and large < 10 * max(small, 0.5)


def plain_text(html):
    """The same text by patterns that search anew for each opening."""
    text = re.sub(r"(?is)<(script|style)\b[^>]*>.*?</\1[ \t\n\x0b\f\r]*>|<!--.*?-->", "\n", html)
    return re.sub(r"[ \t\n\x0b\f\r]*<[^>]*>[ \t\n\x0b\f\r]*", "\n", text)


def page_texts(spark, htmls):
    df = spark.createDataFrame([(i, "http://a.example/", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return [r.text for r in line_dedup.page_texts(df).orderBy("page_id").collect()]


def test_page_texts_of_any_mixture(spark):
    r = random.Random(5)
    bits = ["<script>", "<SCRIPT x=1>", "</script>", "</Script  >", "<style>", "</style>", "<!--", "-->", "<!-->", "<p>", "</p>", "<", ">", "  ", "\n", "word",
            "<script", "scripts", "<scripted>", "\ue000", "<\ue000bscript>", "a", "b", "\U0001f600", "</script"]
    htmls = ["".join(r.choice(bits) for _ in range(r.randrange(30))) for _ in range(3000)]
    assert page_texts(spark, [*htmls, None]) == [*map(plain_text, htmls), None]


def test_page_texts_of_openings_that_never_close(spark):
    """A megabyte each; a search to the end for every opening would take hours."""
    n = 150_000
    hard = ["<script>" * n, "<script>" * n + "-->", "<!-- " * n + "</script></style>", "<style" * n, "<" * 8 * n, "x" + " " * 8 * n + "x", "</script " * n,
            "<script>a</script>" * n]
    began = time.perf_counter()
    got = page_texts(spark, hard)
    assert time.perf_counter() - began < 60
    assert got[4] == hard[4] and got[5] == hard[5] and got[6] == hard[6] and got[7] == "\n" * n
    df = spark.createDataFrame([(1, "h", "a" + " " * 8 * n + "b\nc")], "page_id long, host string, text string")
    row = line_dedup.drop_lines(df).collect()[0]
    assert (row.n_lines, row.n_dropped) == (2, 0) and time.perf_counter() - began < 90


def test_page_texts_of_ordinary_pages_cost_little_more_than_the_patterns(spark):
    r = random.Random(4)
    words = ["the", "of", "Ünder", "reason", "and", "élan", "it"]
    page = lambda i: "<html><head><style>p{}</style><SCRIPT>t(%d);</script></head><body><!-- ad -->%s</body></html>" % (
        i, "".join(f"<p>{' '.join(r.choices(words, k=40))}.</p>\n" for _ in range(20)))
    htmls = [page(i) for i in range(200)]
    df = spark.createDataFrame([(i, "http://a.example/", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    df = df.crossJoin(spark.range(20).select(F.col("id").alias("again"))).repartition(4).cache()
    assert df.count() == 4000
    plain = df.select(F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", "\n"), r"\s*+<[^>]*>\s*+", "\n"))

    def least(d):
        took = []
        for _ in range(4):
            began = time.perf_counter()
            d.write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        return min(took)
    texts = line_dedup.page_texts(df)
    assert least(texts) < 2.2 * least(plain)
    assert texts.select("text").distinct().count() == len({plain_text(h) for h in htmls})
    assert [x.text for x in texts.filter("page_id < 3").distinct().orderBy("page_id").collect()] == [plain_text(h) for h in htmls[:3]]
    df.unpersist()
