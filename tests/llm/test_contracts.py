"""Each query against a plain version or DuckDB on a small whole table and on a table of hard cases."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from brute import (held_out, jaccard, licences, neardup, pii, quality, sha, substring)

from marketlake.llm import packing
from marketlake.llm.oracles import ORACLE
from marketlake.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def hard_documents():
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base, passage = prose(200), prose(60)
    near = base.split()
    near[100] = "changed"
    texts = [
        None, "", " \n\t\x0b\x0c\r ", "x", "one two three", base, base, " ".join(near), base.upper(), base + "  \n" + base,
        prose(90) + " " + passage + " " + prose(80), passage + "\n" + prose(120), prose(30) + "\n" + passage,
        "same same " * 40, "Shti " * 25, prose(21000), "Ünï çödé ñ   \U0001f600 words " * 9, "w" * 50_000 + "@" + "1" * 30_000,
        "a@b.c_d@e.f x@y.zz. 1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 mail me+you@ex-am.ple.org",
        "4111 1111-1111 1111 4111111111111112 12345678901234567890123 0000 0000 0000 00 +1 (555) 123-4567 +123 +1-2-3-4-5-6-7-8-9-0-1",
        "Released under the MIT License.\nThe Mit\nLicense; gnu GENERAL public-license 3. Apache License apache license",
        "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.",
        "dup line\nother\ndup line\n\n\ndup line \nDup  line", "<|endoftext|> and 中文 Ж text", "# * $ %%% & | <> " * 20,
    ]
    texts += [prose(40) + " " + passage for _ in range(30)] + [f"Shared footer of the site\n{prose(60)}" for _ in range(30)]
    rows = [(i, t, "en", None if i % 11 == 0 else f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[10]]  # repeated rows
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Folders by name: a small whole table, hard cases, and empty tables."""
    hard, empty = str(tmp_path_factory.mktemp("hard")), str(tmp_path_factory.mktemp("empty"))
    docs = spark.createDataFrame(hard_documents(), DOCS)
    clash = ["size", "taken", "target", "row", "base", "node", "h", "key", "length", "offset", "host", "n_words", "kept", "w"]
    wide = docs.selectExpr("*", *[f"'x' as {c}" for c in clash])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(50)] + [(3, 0, None), (None, None, 1), (900, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    r = np.random.RandomState(2)
    center, rows = r.randn(6, 8), []
    for i in range(400):
        rows.append((i, (center[i % 6] + 0.08 * r.randn(8)).tolist(), i % 3 if i % 13 else None))
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 8, 1), (403, [None] + [1.0] * 7, 1), (404, [float("nan")] * 8, 1),
             (405, rows[7][1], 1), (406, rows[7][1], 1), (407, [2 * x for x in rows[7][1]], 1), (408, [1.0, 2.0], 1),
             (409, [1.0, 2.0], 1), (410, [float("inf")] + [1.0] * 7, 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    pages = spark.createDataFrame(
        [(i, f"http{'s' * (i % 2)}://Host{i % 2}.example/x{i}", f"<p>menu</p>\n<p>text {i}</p><script>a{i}</script> tail ") for i in range(40)]
        + [(40, None, None), (41, "no url", ""), (41, "no url", "<p>menu</p>"), (42, "http://one.example", "<p>menu</p>")],
        "page_id long, url string, html string")
    for d, n in ((hard, None), (empty, 0)):
        for name, df in (("documents", wide), ("labels", labels), ("embeddings", vectors), ("pages", pages)):
            (df if n is None else df.limit(0)).write.parquet(f"{d}/{name}.parquet")
    return {"small": SF, "hard": hard, "empty": empty}


def documents(d):
    p = f"{d}/documents.parquet" + ("" if d == SF else "/*.parquet")
    return duckdb.sql(f"select doc_id, text, source from '{p}'").fetchall()


def got(spark, tables, name, at, *cols):
    return Counter(tuple(r[c] for c in cols) for r in QUERIES[name](spark, tables[at]).select(*cols).collect())


@pytest.fixture(params=["small", "hard", "empty"])
def at(request):
    return request.param


def test_op1(spark, tables, at):
    found = got(spark, tables, "op1_pii", at, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    want = Counter()
    for i, t, _ in documents(tables[at]):
        spans = pii(t)
        want[(i, *[sum(s.startswith(k) for s in spans) for k in ("email", "ip", "card", "phone")], sha(",".join(spans)))] += 1
    assert found == want


def test_op2(spark, tables, at):
    p = f"{tables[at]}/embeddings.parquet" + ("" if at == "small" else "/*.parquet")
    rows = duckdb.sql(f"select vec_id, embedding, label from '{p}'").fetchall()
    assert got(spark, tables, "op2_neardup", at, "vec_id", "n_links", "component_id", "kept") == Counter(
        (i, *x) for i, x in neardup(rows).items())


@pytest.mark.parametrize("name", ["op3_mixing", "op7_line_dedup"])
def test_sql_twins(spark, tables, at, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{tables[at]}/{t}.parquet{'' if at == 'small' else '/*.parquet'}'")
    rel = con.sql(ORACLE[name])
    cols = rel.columns
    assert got(spark, tables, name, at, *cols) == Counter(rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(ORACLE) - {"op3_mixing", "op7_line_dedup"}))
def test_sql_twins_on_a_whole_table(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.sql(ORACLE[name])
    cols = rel.columns
    assert got(spark, tables, name, "small", *cols) == Counter(rel.fetchall())


def test_op3_budgets(spark, tables):
    rows = QUERIES["op3_mixing"](spark, SF).collect()
    source = {i: s for i, _, s in documents(SF)}
    by = defaultdict(list)
    for r in rows:
        by[source[r.doc_id]].append(r)
        assert 0 <= r.taken <= 3 * r["size"]
    for g in by.values():
        assert sum(r.taken for r in g) == int(g[0].target)
    assert abs(sum(g[0].target for g in by.values()) - sum(r["size"] for r in rows)) < 1


def test_op4(spark, tables, at):
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = QUERIES["op4_quality"](spark, tables[at]).collect()
    assert Counter((r.doc_id, *[r[c] for c in cols]) for r in rows) == Counter((i, *quality(t)) for i, t, _ in documents(tables[at]))
    assert all(not (r.kept and r.base_failed) for r in rows)


def test_op5(spark, tables, at):
    rows = QUERIES["op5_packing"](spark, tables[at]).collect()
    tk, seqs, places = packing._load(packing.tokenizer_file())[0], defaultdict(list), Counter()
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        places[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    want = Counter()
    for i, t, _ in documents(tables[at]):
        ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        for k, s in enumerate([0, *range(first, len(ids), 1024)]):
            n = first if k == 0 else 1024
            want[(i, k, s, n, zlib.crc32(ids[s: s + n].tobytes()))] += 1
    assert places == want
    for parts in seqs.values():
        end = 0
        for a, n in sorted(parts):
            assert a == end
            end += n
        assert end <= 1024
    assert len(seqs) <= -(-sum(r.length for r in rows) // 1024) * 1.02 + 2


def test_op6(spark, tables, at):
    docs = [(i, t) for i, t, _ in documents(tables[at])]
    want = jaccard(docs)
    assert got(spark, tables, "op6_jaccard", at, "doc_id", "n_shingles", "component_id") == Counter((i, *want[i]) for i, _ in docs)


def test_op8(spark, tables, at):
    docs = [(i, t) for i, t, _ in documents(tables[at])]
    want = substring(docs)
    assert got(spark, tables, "op8_substring", at, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(
        (i, want[i][0], want[i][1], sha(want[i][2])) for i, _ in docs)


def test_op9(spark, tables, at):
    rows = QUERIES["op9_toxicity"](spark, tables[at]).collect()
    assert Counter((r.doc_id, r.held_out) for r in rows) == Counter((i, held_out(i)) for i, _, _ in documents(tables[at]))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_op10(spark, tables, at):
    rows = QUERIES["op10_license"](spark, tables[at]).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == Counter(
        (i, *licences(t)) for i, t, _ in documents(tables[at]))
    for r in rows:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
