"""The transducer, exact merges and decoding against the tokenizers library."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from marketlake.llm import lexicon_bpe as L
from marketlake.llm.queries import QUERIES

DOCS = "doc_id long, text string, ids string, n_tokens int, decoded string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(L.tokenizer_file())


def want(library, i, t):
    ids = library.encode(t or "", add_special_tokens=False).ids
    return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(
        library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def hard_texts():
    r = random.Random(8)
    return [None, "", " \n\t", "a", "A's THE_end 12.5 it'll", "Ünï çödé ñ İ Σας ΣΑΣ ﬁ é Å", "中文 Ж 한국어 \U0001f600\U0001f9d1‍\U0001f680", "\x00\x01\x1c\x85 |",
            "<|endoftext|>x<|startoftext|> <|endoftext|", "w" * 30_000, "ab" * 20_000 + " " + "1" * 5000, "!?" * 5000,
            " ".join("".join(r.choice("etaoinshrdlu'") for _ in range(r.randint(1, 60))) for _ in range(20_000)),
            "the same words the same words " * 50, "the same words the same words " * 50]


def test_every_character_splits_as_in_the_library(library):
    tk = L.load(L.tokenizer_file())
    for c in [chr(i) for i in range(0x250)] + [chr(i) for i in range(0x2000, 0x2070)] + list("€™日̇ͅſK"):
        for t in (c, f"a{c}b", f"{c}{c}1{c}", f"I{c}'s {c}_", f"{c}́"):
            assert [i for w in tk.words(t) for i in tk.merged(w)] == library.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("most", [0, 3, 10**6])
def test_equals_the_library(spark, library, most):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(hard_texts())]
    rows += [(None, "no id", None, None, None), (2, "again", "", 0, ""), (2, "again", "", 0, "")]
    docs = spark.createDataFrame(rows, DOCS)
    got = L.report(L.decode(L.encode(docs, lexicon=L.lexicon_for(docs, most=most))))
    assert Counter(map(tuple, got.collect())) == Counter(want(library, x[0], x[1]) for x in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    out = L.report(L.decode(L.encode(docs)))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 0


def test_query_on_a_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert Counter(map(tuple, got)) == Counter(want(library, x[0], x[1]) for x in docs)


def test_automaton_is_minimal_and_exact(tmp_path):
    r = random.Random(2)
    words = {"".join(r.choice("abc") for _ in range(r.randint(1, 7))).encode() for _ in range(800)}
    entries = {w: tuple(range(len(w))) for w in words}
    (tmp_path / "lex").write_bytes(L.compile_lexicon(entries))
    lex = L.Lexicon(str(tmp_path / "lex"))
    asked = sorted(words) + [b"", b"abcd", b"zz", b"a" * 40]
    for w, n in zip(asked, lex.numbers(asked).tolist(), strict=True):
        assert (n >= 0) == (w in words)
        assert n < 0 or tuple(lex.ids[lex.run[n]: lex.run[n + 1]].tolist()) == entries[w]
    # states of a minimal automaton are the distinct sets of what may follow
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    follow = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert len(lex.final) == len(follow)


def test_decode_nulls_and_unknown_ids(spark):
    rows = [(1, np.array([320, 518], "<u4").tobytes()), (2, None), (3, b""), (4, np.array([99_999, 518], "<u4").tobytes())]
    got = dict(L.decode(spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, b in rows], "i long, ids binary")).select("i", "decoded").collect())
    tk = L.load(L.tokenizer_file())
    assert got == {1: f"{tk.strings[320]} {tk.strings[518]}", 2: None, 3: "", 4: tk.strings[518]}


def test_whole_arrays_split_as_single_texts():
    tk = L.load(L.tokenizer_file())
    chars = [chr(i) for i in range(0x250)] + [chr(i) for i in range(0x2000, 0x2070)] + list("€™日̇ͅſK")
    texts = hard_texts() + [t for c in chars for t in (c, f" a{c}b ", f"{c}{c}1{c}", f"I{c}'s  {c}_\n", f"{c}́", f"x<|endoftext|>{c}")]
    lists = tk.tokens_of(pa.array(texts, pa.string()))
    assert [[t for t in x if t] for x in lists.to_pylist()] == [tk.tokens(t) for t in texts]
    tokens = pa.array(sorted({t for x in texts for t in tk.tokens(x)} | {"\0 a b"}))
    assert [[w for w in x if w] for x in tk.pieces_of(tokens).to_pylist()] == [tk.pieces(t) for t in tokens.to_pylist()]
    assert len(tk.tokens_of(pa.array([], pa.string()))) == len(tk.pieces_of(pa.array([], pa.string()))) == 0


def test_words_merge_together_as_they_do_alone():
    tk, r = L.load(L.tokenizer_file()), random.Random(6)
    words = ["".join(r.choice("etaoinshr'éß1.") for _ in range(r.choice([1, 2, 3, 9, 30, 70]))) for _ in range(5000)]
    words += ["", "\0\0", "aaaaaaaa", "<|endoftext|>", "中文", "the"] + ["ab" * 30] * 3
    assert tk.merged_together(words) == [list(tk.merged(w)) for w in words]
    assert tk.merged_together([]) == []


def test_counting_costs_less_than_plain_splitting_and_counting():
    r = random.Random(3)
    parts = ["ti", "on", "the", "er", "an", "is", "ou", "en", "é", "wh"]
    texts = [" ".join("".join(r.choice(parts) for _ in range(r.choice([1, 1, 1, 2, 4]))) + r.choice(["", "", ",", "."])
                      for _ in range(500)) for _ in range(2000)]
    batches = [pa.record_batch([pa.array(texts[i: i + 500])], ["text"]) for i in range(0, len(texts), 500)]
    schema, tk, took = pa.schema([("word", pa.string()), ("n", pa.int64())]), L.load(L.tokenizer_file()), [[], []]
    for _ in range(3):
        start = time.process_time()
        plain = Counter()
        for t in texts:
            plain.update(t.lower().split())
        took[0].append(time.process_time() - start)
        start = time.process_time()
        counted = list(L._counted(iter(batches), L.tokenizer_file(), schema))
        took[1].append(time.process_time() - start)
    got = Counter()
    for b in counted:
        got.update(dict(zip(*(c.to_pylist() for c in b.columns))))
    want = Counter()
    for t, n in plain.items():
        for w in tk.pieces(t):
            want[w] += n
    assert got == want
    assert min(took[1]) < 1.3 * min(took[0])
