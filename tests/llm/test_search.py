"""Ranked search against a plain version: hard rows, small blocks, several groups of items."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marketlake.llm import ranked_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, score int, rank string, m int", "item_id long, text string, no int"


def plain_terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def plain(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] by the contract's formula."""
    found = [(i, Counter(plain_terms(t)), len(plain_terms(t))) for i, t in docs]
    found = [x for x in found if x[2]]
    n, total = len(found), sum(x[2] for x in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in found:
            m = 100 - 90 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(plain_terms(text)) if c[t])
            if s > 0:
                scores.append((-s, math.inf if i is None else i))
        out += [(item, r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def hard_tables():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(60)] + ["Ünï", "çödé", "中文"]
    docs = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([1, 3, 8, 8, 8, 40]))), 1, "x", 2) for i in range(300)]
    docs += [(300 + i, "w1 w2 w3 w4 w5 w6 w7 w8", 1, "x", 2) for i in range(60)]  # ties, one large stratum
    docs += [(400, None, 1, "x", 2), (401, "", 1, "x", 2), (402, " .,-_\n", 1, "x", 2), (None, "w1 w2", 1, "x", 2), (None, None, 1, "x", 2),
             (403, "W1-w1_W1 w2", None, None, None), (404, "w9 " * 30_000 + "needle", 1, "x", 2), docs[7], docs[7]]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(1, 9))), 0) for i in range(25)]
    items += [(25, None, 0), (26, " ., ", 0), (27, "nowhere to be found", 0), (28, "NEEDLE, w9 W9", 0), (None, "w1 w2 w3", 0), items[0],
              (29, "w1 w2 w3 w4 w5 w6 w7 w8", 0), (30, "unknown w12 çÖdé çödé", 0)]
    return docs, items


@pytest.mark.parametrize("block,items_most", [(1024, 10_000), (5, 10_000), (16, 9)])
def test_equals_the_formula(spark, block, items_most):
    docs, items = hard_tables()
    got = S.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block=block, items_most=items_most)
    want = plain([x[:2] for x in docs], [x[:2] for x in items])
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_empty_tables(spark):
    docs, items = hard_tables()
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    for a, b in ((d.limit(0), i), (d, i.limit(0)), (d.where("text is null"), i), (d, i.where("text is null"))):
        df = S.search(a, b)
        assert df.columns == ["item_id", "rank", "doc_id", "score"] and df.count() == 0


def test_blocks_are_strata_and_bounds_hold(spark):
    docs, items = hard_tables()
    vocab = sorted({t.encode() for _, x, _ in items for t in plain_terms(x)})
    index = S.build(spark.createDataFrame(docs, DOCS), vocab, block=7)
    q = S.Items([(0, list(range(len(vocab)))), (1, [0, 3])])
    seen = 0
    for row in index.blocks.collect():
        b = S.Block((row.m, *[np.array(x) for x in (row.docs, row.term, row.tf, row.first, row.at)]), q, index.weights)
        assert 1 <= len(row.docs) <= 7 and len(set(zip(row.term, row.tf))) == len(row.term)
        for i in range(2):
            assert all(-s <= b.bounds[i] for s, _ in b.best(i, 10, 0))
        seen += len(row.docs)
    assert seen == index.docs == sum(bool(plain_terms(x[1])) for x in docs)


def test_blocks_out_of_reach_are_passed_over(spark):
    r = random.Random(9)
    docs = [(i, " ".join(f"v{r.randrange(400)}" for _ in range(r.randint(5, 60)))) for i in range(4000)]
    docs += [(5000 + i, "alpha beta gamma delta epsilon") for i in range(12)]
    words = "alpha beta gamma delta epsilon v1 v2 v3".split()
    vocab = sorted(w.encode() for w in words)
    index = S.build(spark.createDataFrame(docs, "doc_id long, text string"), vocab, block=32)
    got = S.rank(index, [(0, vocab)]).collect()
    assert sorted((x["rank"], x["doc"]) for x in got) == [(i + 1, 5000 + i) for i in range(10)]
    assert max(x["visits"] for x in got) < index.blocks.count() / 4
