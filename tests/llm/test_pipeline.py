"""The pipeline against plain versions of its stages."""

import os
from collections import Counter, defaultdict

import corpus_pipeline as cp
import duckdb
from brute import jaccard, quality, words

from marketlake.llm import packing
from marketlake.llm.common import read, written
from marketlake.llm.oracles import ORACLE
from marketlake.llm.quality import line_key

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.select(*cp.COLUMNS).collect()]


def test_stages(spark, tmp_path):
    docs = read(spark, SF, "documents")
    before = rows(docs)
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "packing"]

    # quality rules
    docs = written(cp.quality_rules(spark, docs, SF), "q")
    hosts, lines = defaultdict(set), defaultdict(set)
    for _, t, _, s, _ in before:
        hosts[s].add(" ".join(words(t)))
        for x in t.split("\n"):
            if (k := line_key(x)) is not None:
                lines[(s, k)].add(" ".join(words(t)))
    over = {x for x, d in lines.items() if len(d) >= 20 and len(d) > 0.2 * len(hosts[x[0]])}
    want = Counter()
    for i, t, lang, s, _ in before:
        kept = [x for x in t.split("\n") if (s, line_key(x)) not in over]
        n, left = len(words(t)), len(words("\n".join(kept)))
        if not quality(t)[5] and left >= 0.3 * n:
            text = "\n".join(kept) if len(kept) < len(t.split("\n")) else t
            want[(i, text, lang, s, len(text))] += 1
    assert Counter(rows(docs)) == want

    # line dedup
    before = rows(docs)
    docs = written(cp.line_dedup_by_source(spark, docs, SF), "l")
    pages, seen = Counter(s for _, _, _, s, _ in before), Counter()
    for _, t, _, s, _ in before:
        seen.update({(s, x.strip(" \t\n\v\f\r")) for x in t.split("\n")})
    common = {x for x, n in seen.items() if x[1] and n >= 3 and n > 0.2 * pages[x[0]]}
    want = Counter()
    for i, t, lang, s, _ in before:
        text = "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\n\v\f\r")) not in common)
        want[(i, text, lang, s, len(text))] += 1
    assert Counter(rows(docs)) == want

    # near duplicates
    before = rows(docs)
    docs = written(cp.near_duplicates(spark, docs, SF), "n")
    least = jaccard([(r[0], r[1]) for r in before])
    assert Counter(rows(docs)) == Counter(r for r in before if least[r[0]][1] == r[0])

    # mixing
    before = rows(docs)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    rel = con.sql(ORACLE["op3_mixing"])
    taken = {dict(zip(rel.columns, x))["doc_id"]: dict(zip(rel.columns, x))["taken"] for x in rel.fetchall()}
    docs = written(cp.mix_sources(spark, docs, SF), "m")
    got = defaultdict(list)
    for i, t, *_ in rows(docs):
        got[i].append(t)
    for i, t, *_ in before:
        w, copies = words(t), sorted(got[i], key=len)
        whole, part = divmod(taken[i], len(w)) if w else (0, 0)
        assert len(copies) == whole + (part > 0)
        assert copies[bool(part):] == [t] * whole and (not part or words(copies[0]) == w[:part] and t.startswith(copies[0]))

    # packing
    out = cp.pack_sequences(spark, docs, SF).collect()
    want = Counter()
    for i, t, *_ in rows(docs):
        want[i] += len(packing.ids_of(t, packing.tokenizer_file()))
    tokens = Counter()
    for r in out:
        tokens[r.doc_id] += r.length
    assert tokens == want


def test_hard_rows(spark, tmp_path):
    """Nulls, empty, tiny and repeated rows and clashing columns pass all stages; so does an empty table."""
    base = " ".join(f"word{i}" for i in range(80))
    data = [(1, base, "en", None, 1), (1, base, "en", None, 1), (2, None, None, "s", None), (3, "", "en", "s", 0),
            (None, base + " more words", "en", "s", 3), (4, "x y z", "en", "s", 5), (5, base.replace("word7", "other"), None, "s", 9),
            (6, " ".join(f"other{i}" for i in range(30000)), "de", "t", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for name, d in (("hard", df), ("empty", df.limit(0))):
        where = str(tmp_path / name)
        os.makedirs(where)
        d.selectExpr("*", "'c' as size", "1 as taken", "'x' as host", "2 as __key").write.parquet(f"{where}/documents.parquet")
        out = cp.run(spark, where).collect()
        assert {r.doc_id for r in out} <= {1, 5, 6} and bool(out) == (name == "hard")


def test_hard_rows_are_kept_exactly(spark, tmp_path):
    """Rows without an id are documents of their own: the near copy goes, the unlike ones stay, to the end."""
    text = lambda g: " ".join(f"{g}{i}" for i in range(80))
    base = text("word")
    data = [(1, base, "en", None, 1), (1, base, "en", None, 1), (2, None, None, "s", None), (3, "", "en", "s", 0),
            (None, base + " more words", "en", "s", 3), (None, text("lone"), "en", "s", 3), (None, text("apart"), "en", None, 3),
            (4, "x y z", "en", "s", 5), (5, base.replace("word7", "other"), None, "s", 9),
            (6, " ".join(f"other{i}" for i in range(30000)), "de", "t", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES[:3]:
        docs = written(stage(spark, docs, str(tmp_path)), name)
    assert Counter((r[0], r[1]) for r in rows(docs)) == Counter(
        [(1, base), (5, data[8][1]), (6, data[9][1]), (None, text("lone")), (None, text("apart"))])
    for name, stage in cp.STAGES[3:4]:
        docs = written(stage(spark, docs, str(tmp_path)), name)
    assert {r[1] for r in rows(docs) if r[0] is None} >= {text("lone"), text("apart")}
    assert {r.doc_id for r in cp.run(spark, str(tmp_path)).collect()} == {1, 5, 6, None}
