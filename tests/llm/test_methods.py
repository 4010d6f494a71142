"""The methods behind the contracts: what each adds, on small made-up tables."""

import random
from fractions import Fraction

import numpy as np
import pytest
from brute import shingle_set
from pyspark.sql import functions as F

from marketlake.llm import components as cc
from marketlake.llm import (jaccard, license_scan, line_dedup, mixing, neardup, ngrams, packing, pii, quality, substring,
                            toxicity)

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november".split()


def test_pii_generalises_and_removes_terms(spark):
    r = random.Random(1)
    rows = []
    for i in range(400):
        text = " ".join(r.choice(WORDS) for _ in range(30))
        if i % 10 == 0:  # "passport" stands with addresses only; "secretary" too, but its stem is common
            text += f" passport u{i}@mail.example.org secretary"
        elif i % 2:
            text += " secrets"
        rows.append((i, text))
    out = {x.doc_id: x for x in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    x = out[10]
    found = [rows[10][1][s.start: s.end] for s in x.terms]
    assert found == ["passport", "secretary"]
    assert x.clean.endswith("  [EMAIL] secr*") and "passport" not in x.clean
    assert out[11].clean is None and not out[11].terms


def test_mix_cut_documents(spark):
    df = spark.createDataFrame([(1, "a  b\nc d e"), (2, " x y ")], "doc_id long, text string").withColumn(
        "size", F.when(F.col("doc_id") == 1, 5).otherwise(2).cast("long"))
    out = mixing.apply_mix(df.withColumn("taken", F.when(F.col("doc_id") == 1, 8).otherwise(0).cast("long"))).collect()
    assert [x.text for x in out] == ["a  b\nc d e", "a  b\nc"]


def test_mix_targets_stop_and_reshare(spark):
    t = spark.createDataFrame([("a", 100), ("b", 1), ("c", 100), (None, 0)], "source string, source_size long")
    got = {x.source: x.target for x in mixing.source_targets(t).collect()}
    assert got["b"] == 3.0 and got[None] == 0.0
    assert got["a"] + got["b"] + got["c"] == pytest.approx(201) and got["c"] == pytest.approx(3 * got["a"])


def test_quality_frequent_lines(spark):
    body = lambda i: f"line {i} " + " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(i, "site", f"Same   FOOTER line\n{body(i)}") for i in range(50)]
    rows += [(100, "site", "\n".join(["same footer line"] * 30) + "\nonly these few words are its own"), (101, "other", "same footer line\n" + body(7))]
    rows += [(200 + i, "copies", body(3) + "\n" + body(4)) for i in range(60)]  # equal words: one document
    rows += [(300 + i, "copies", body(300 + i)) for i in range(3)]
    out = {x.doc_id: x for x in quality.judge(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert out[0].kept and out[0].n_line_words == 3 and len(out[0].frequent) == 1
    assert not out[100].kept and out[101].kept and out[101].n_line_words == 0
    assert all(out[200 + i].kept and out[200 + i].n_line_words == 0 for i in range(60))
    kept = {x.doc_id: x.text for x in quality.cleaned(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert 100 not in kept and kept[0] == body(0) and kept[101].startswith("same footer")


def test_line_dedup_ratio(spark):
    rows = [("h", f"menu\nown {i}\n" + ("half\n" if i % 2 else "")) for i in range(20)] + [("small", "menu\nx")]
    out = line_dedup.drop_lines(spark.createDataFrame(rows, "host string, text string"), max_ratio=0.6).collect()
    assert all("menu" not in x.text and "own" in x.text and x.n_dropped == 1 for x in out if x.host == "h")
    assert any("half" in x.text for x in out) and [x.text for x in out if x.host == "small"] == ["menu\nx"]


def test_license_join_is_exact(spark):
    r = random.Random(4)
    templates = [(f"l{n}", " ".join(r.sample(WORDS, r.randint(3, 8)))) for n in range(6)]
    lines = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 14))) for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    for need in (0.5, 0.75, 0.9):
        got = {x.doc_id: {(m.label, round(m.score, 9)) for m in x.matches} for x in license_scan.scan(df, templates=templates, containment=need).collect()}
        for i, line in enumerate(lines):
            own = set(line.split())
            want = {(k, round(len(own & set(t.split())) / len(set(t.split())), 9)) for k, t in templates
                    if len(own & set(t.split())) >= need * len(set(t.split())) - 1e-9}
            assert got[i] == want, (line, need)


def _license_rows(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {x.doc_id: (x.labels, round(x.score, 9)) for x in license_scan.report(license_scan.scan(df)).collect()}


def test_license_notices_over_line_breaks(spark):
    prose = " ".join(WORDS * 20)
    got = _license_rows(spark, [
        f"{prose}\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted\n{prose}",
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software",
        f"This Source Code Form is subject to the terms of the Mozilla Public\r\n# License, v. 2.0. {prose}",
        "Licensed under CC\nBY-NC 4.0", "Licensed\nunder\nCC\nBY\n4.0",
        "Redistribution and use in source\n" + prose + "\nand binary forms, with or without modification, are permitted"])
    assert got == {0: ("bsd", 1.0), 1: ("mit", 1.0), 2: ("mpl", 1.0), 3: ("cc-by-nc", 1.0), 4: ("cc-by", 1.0), 5: ("", 0.0)}


def test_license_keeps_unlike_notices_of_a_line(spark):
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted"
    got = _license_rows(spark, [
        "Licensed under the Apache License, Version 2.0. Docs are licensed under CC BY-NC 4.0.", f"{mpl} {bsd}", f"{bsd}\n{mpl}",
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0. Licensed under CC BY 4.0.",
        "Licensed under CC BY-NC 4.0\nand, for the figures, licensed under CC BY 4.0"])
    assert {i: x[0] for i, x in got.items()} == {
        0: "apache,cc-by-nc", 1: "bsd,mpl", 2: "bsd,mpl", 3: "cc-by-nc", 4: "cc-by,cc-by-sa", 5: "cc-by,cc-by-nc"}


@pytest.mark.parametrize("share", [Fraction(1, 2), Fraction(3, 4), Fraction(9, 10)])
def test_divide_skip_equals_counting(share):
    r = random.Random(9)
    num, den = share.numerator, share.denominator
    base = [r.getrandbits(64) for _ in range(120)]
    sets = []
    for _ in range(60):
        s = set(r.sample(base, r.randint(1, 110))) if r.random() < 0.5 else set(base[: r.randint(60, 118)])
        sets.append(np.unique(np.array([*s, *(r.getrandbits(64) for _ in range(r.randint(0, 8)))], np.uint64)))
    sizes = np.array([len(s) for s in sets])
    h, own = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.lexsort((own, h))
    h, own = h[order], own[order]
    for i, s in enumerate(sets):
        want = [j for j, t in enumerate(sets) if den * len(np.intersect1d(s, t)) >= num * len(np.union1d(s, t))]
        assert jaccard.divide_skip(s, h, own, sizes, num, den).tolist() == want


def test_jaccard_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 400)
    r = random.Random(3)
    docs = []
    for g in range(4):
        base = [f"{r.choice(WORDS)}{r.randint(0, 60)}" for _ in range(80)]
        for _ in range(25):
            w = list(base)
            for _ in range(r.randint(0, 5)):
                w[r.randrange(80)] = f"new{r.randint(0, 9)}"
            docs.append((len(docs), " ".join(w[r.randint(0, 6):])))
    sets = [shingle_set(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    got = {x.doc_id: x.component_id for x in jaccard.jaccard_join(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: root(i) for i in range(len(docs))}


def test_one_of_each_judges_rows_by_their_text(spark):
    body = lambda g, *new: " ".join([f"g{g}w{j}" for j in range(60)] + list(new))
    rows = [(1, body(1)), (None, body(1, "near")), (None, body(2)), (None, body(3)), (None, body(3).upper()),  # without ids
            (7, body(4)), (7, body(5)), (7, body(1, "copy")),  # one id, three texts
            (8, body(6)), (8, body(6)), (9, body(6, "late")),  # a repeated row and its near copy
            (None, body(10)), (None, body(10)), (None, "5"), (5, None), (5, None), (11, ""), (12, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((x.doc_id, x.text.lower() if x.text else x.text) for x in jaccard.one_of_each(df).collect() if x.doc_id is not None)
    assert got == sorted([(1, body(1)), (7, body(4)), (7, body(5)), (8, body(6)), (5, None), (11, ""), (12, "")])
    assert sorted(x.text.lower() for x in jaccard.one_of_each(df).collect() if x.doc_id is None) == sorted(
        [body(2), body(3), body(10), "5"])


def test_near_duplicates_over_many_cells(spark):
    r = np.random.RandomState(0)
    x = r.randn(40, 6)[r.randint(0, 40, 500)] + 0.12 * r.randn(500, 6)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    links = unit @ unit.T >= 0.98
    np.fill_diagonal(links, False)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {a.vec_id: (a.n_links, a.component_id) for a in neardup.near_duplicates(df, cell=10, sample_per_cell=8, block=7).collect()}
    least = np.arange(500)
    for _ in range(500):
        new = np.minimum(least, np.where(links, least[None, :], 500).min(axis=1))
        if (new == least).all():
            break
        least = new
    assert got == {i: (int(links[i].sum()), int(least[i])) for i in range(500)} and links.sum() > 500


def test_components(spark):
    r = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [
        (r.randint(1000, 1100), r.randint(1000, 1100)) for _ in range(90)] + [(7, 7)]
    up = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    got = {x.node: x.root for x in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in up.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_runs_depend_on_words_only():
    a = ngrams.word_hashes(b"q w e r t y u i o p a s d f".split())
    b = ngrams.word_hashes(b"z z z z q w e r t y u i".split())
    assert (ngrams.runs(a, 5)[:4] == ngrams.runs(b, 5)[4:8]).all()
    assert len(set(ngrams.runs(a, 5).tolist())) == 10 and len(ngrams.runs(a, 15)) == 0


@pytest.mark.parametrize("span", [6, 20])
def test_substring_spans(spark, span):
    from brute import substring as plain
    r = random.Random(2)
    passages = [[r.choice(WORDS) + str(r.randint(0, 400)) for _ in range(r.randint(span - 2, 4 * span))] for _ in range(5)]
    docs = []
    for i in range(120):
        w = []
        for _ in range(r.randint(1, 4)):
            w += [r.choice(WORDS) + str(r.randint(0, 400)) for _ in range(r.randint(0, 30))]
            p = r.choice(passages)
            w += p if r.random() < 0.6 else p[r.randint(0, 9):]
        docs.append((i, " ".join(w)))
    got = {x.doc_id: x for x in substring.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), span=span).collect()}
    want = plain(docs, span)
    assert {i: (x.n_words, x.n_removed, x.kept) for i, x in got.items()} == want
    for i, t in docs:
        w = t.split()
        gone = [x for s in got[i].spans for x in w[s.start: s.end]]
        assert len(gone) == got[i].n_removed


def test_substring_rows_that_share_an_id_or_have_none(spark):
    from brute import substring as plain

    from marketlake.llm.common import row_key
    r = random.Random(12)
    passages = [[r.choice(WORDS) + str(r.randint(0, 400)) for _ in range(r.randint(20, 70))] for _ in range(4)]
    rows = []
    for n in range(60):
        own = [r.choice(WORDS) + str(r.randint(0, 400)) for _ in range(r.choice([0, 0, 7, 25]))]
        rows.append(((None, None, 5, n)[n % 4], " ".join(own + r.choice(passages) + own[:5] + r.choice(passages))))
    rows += rows[:6]  # equal rows are one document
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = {(x.doc_id, x.text): x.k for x in df.withColumn("k", row_key("doc_id", "text")).collect()}
    order = sorted(keys, key=lambda x: (x[0] is None, x[0] or 0, keys[x]))
    want = plain([(n, x[1]) for n, x in enumerate(order)])
    got = sorted((str(x.doc_id), x.n_words, x.n_removed, x.kept) for x in substring.remove_repeats(df).collect())
    assert got == sorted((str(x[0]), *want[order.index(x)]) for x in rows)


def test_best_fit_equals_one_by_one():
    r = random.Random(3)
    for _ in range(60):
        cap = r.choice([8, 16, 64])
        sizes = [r.randint(1, cap) for _ in range(r.randint(0, 200))]
        counts = {x: sizes.count(x) for x in sizes}
        used, seen = {}, set()
        for length, lo, hi, first, at, each in packing.best_fit(counts, cap):
            for k in range(lo, hi):
                used.setdefault(first + (k - lo) // each, []).append((at + (k - lo) % each * length, length))
                assert (length, k) not in seen
                seen.add((length, k))
        assert len(seen) == len(sizes)
        gaps = []
        for x in sorted(sizes, reverse=True):
            fit = min((g for g in gaps if g >= x), default=None)
            if fit is not None:
                gaps.remove(fit)
            gaps.append((fit if fit is not None else cap) - x)
        assert len(gaps) == len(used)


def test_fast_tokenizer_agrees():
    exact, fast = packing._load(packing.tokenizer_file())
    for cp in [*range(0x250), 0x2010, 0x2019, 0x2027, 0x20AC]:
        c = chr(cp)
        for t in (f"ab{c}c d", f"x {c} {c}{c}1a", f"{c}  b\n {c}'s"):
            assert exact.encode(t, add_special_tokens=False).ids == fast.encode_ordinary(t)
    for t in ("<|endoftext|>", "a <|endoftext|>b", "中文 Ж"):
        assert packing.ids_of(t, packing.tokenizer_file()).tolist() == [*exact.encode(t, add_special_tokens=False).ids, 2]


def test_toxicity_held_out(spark):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(1200):
        bad = i % 8 == 0
        w = [r.choice(WORDS) + r.choice(WORDS)[:3] for _ in range(60)] + (["grumblefoo", "snarkbar"][: 1 + i % 2] if bad else [])
        r.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    out = toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                            spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(x.predicted, x.doc_id % 8 == 0) for x in out if x.held_out]
    assert sum(p for p, y in held if y) >= 0.95 * sum(y for _, y in held)
    assert sum(p for p, y in held if not y) <= 0.02 * len(held)


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    one = spark.createDataFrame([(5, 1)], "doc_id long, toxic int")
    assert len({x.score for x in toxicity.toxicity(df, one).collect()}) == 1


def test_long_texts_are_featurised_whole(monkeypatch):
    text = "".join(chr(97 + i % 23) + "é"[: i % 2] for i in range(999))
    whole = toxicity.features(text)
    monkeypatch.setattr(toxicity, "CHUNK", 50)
    assert (toxicity.features(text) == whole).all()


def test_a_small_host_loses_its_common_line(spark):
    rows = [("small", f"menu\nown {i}") for i in range(3)] + [("pair", f"menu\nmine {i}") for i in range(2)] + [("many", f"quote\nline {i}" if i < 3 else f"line {i}") for i in range(20)]
    out = line_dedup.drop_lines(spark.createDataFrame(rows, "host string, text string"))
    got = {h: sorted(r.text for r in out.where(F.col("host") == h).collect()) for h in ("small", "pair", "many")}
    assert got["small"] == [f"own {i}" for i in range(3)]
    assert got["pair"] == [f"menu\nmine {i}" for i in range(2)]
    assert sum("quote" in t for t in got["many"]) == 3
