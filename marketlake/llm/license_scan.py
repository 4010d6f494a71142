"""License scans as an exact set-similarity join (operator 10, native).

Templates and text blocks (lines, and windows of consecutive words as long as the template, which go on
over line breaks) are sets of words.  A block matches a template if it holds at least
`containment` of the template's words.  Words are ordered by their document frequency in the whole
corpus, rarest first: a match must share one of the template's rarest words (prefix filter), have
enough words (length filter) and enough words left after the shared one (positional filter);
candidates are then compared exactly.  Only the words of templates are counted, so frequencies,
templates and the inverted index of prefixes are bounded by the template list, whatever the corpus.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases looked for, and the notices that projects print, by label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
TOKEN = r"[0-9a-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TOKEN), F.lit(0))


def _vocabulary(templates) -> list[str]:
    return sorted({w for _, t in templates for w in t.split()})


def word_ranks(df: DataFrame, text_col: str, templates) -> dict[str, int]:
    """Rank of each template word by document frequency over all of `df`, rarest first.
    The driver receives one count for each template word at most."""
    vocab = _vocabulary(templates)
    # a cheap scan for each template word as a part of the text, then whole words only
    seen = F.array_intersect(tokens(F.col(text_col)), F.array(*[F.lit(w) for w in vocab]))
    counts = dict(df.select(F.explode(seen).alias("w")).groupBy("w").count().collect())
    return {w: i for i, w in enumerate(sorted(vocab, key=lambda w: (counts.get(w, 0), w)))}


def _needed(size: int, containment: float) -> int:
    return math.ceil(containment * size - 1e-9)


def prefix_index(ranks: dict[str, int], templates, containment: float) -> list[tuple]:
    """(word, template no, label, position, size, needed, words in rank order) for each prefix word."""
    out = []
    for no, (label, text) in enumerate(templates):
        words = sorted(set(text.split()), key=ranks.__getitem__)
        need = _needed(len(words), containment)
        out += [(w, no, label, i, len(words), need, words) for i, w in enumerate(words[: len(words) - need + 1])]
    return out


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _any(conditions) -> Column:
    return reduce(or_, conditions, F.lit(False))


def block_matches(df: DataFrame, text_col: str = "text", templates=TEMPLATES, containment: float = 0.9) -> Column:
    """For each text the array of (label, score, longest) of the templates that it matches, one entry each: by the
    words of a line, or by a window of consecutive words as long as the template, which a line break does not cut.
    `longest` is false if wherever the template matches its words are part of those of a longer one.

    The inverted index of template prefixes is the small side of the join: its rows are fixed by
    the template list, so it is folded into the plan and each block probes it in place."""
    ranks = word_ranks(df, text_col, templates)
    index = prefix_index(ranks, templates, containment)
    vocab = F.array(*[F.lit(w) for w in sorted(ranks, key=ranks.__getitem__)])
    prefix_words = sorted({x[0] for x in index})
    gate = r"(?i)(?<![0-9a-z\x{80}-\x{10FFFF}])(?:" + "|".join(prefix_words) + r")(?![0-9a-z\x{80}-\x{10FFFF}])"
    parts = {x[1]: (x[2], x[4], x[5], x[6]) for x in index}  # no -> label, size, needed, words in rank order
    length = [len(t.split()) for _, t in templates]
    # a longer template explains a match only if it has enough of the shorter one's words
    longer = {no: [o for o, (_, m, _, ws) in parts.items() if m > size and len(set(words) & set(ws)) >= need]
              for no, (_, size, need, words) in parts.items()}

    def words_of(no: int) -> Column:
        return F.array(*[F.lit(w) for w in parts[no][3]])

    def in_line(own: Column, no: int) -> Column:
        """Whether a line's template words, rarest first, hold enough of the template."""
        _, size, need, words = parts[no]

        def at(i: int, w: str) -> Column:  # the shared prefix word stands at i in the template, at p in the line
            p = F.array_position(own, F.lit(w))
            return (p > 0) & (F.lit(size - i) >= need) & (F.size(own) - p + 1 >= need - i)
        hit = at(0, words[0])
        for i, w in enumerate(words[1: size - need + 1], 1):
            hit = hit | at(i, w)
        return (F.size(own) >= need) & hit & (F.size(F.array_intersect(own, words_of(no))) >= need)

    def windows(w: Column, no: int) -> Column:
        """(at, n) of the windows of `w` that hold n words of the template, enough of them, and start with one."""
        _, size, need, words = parts[no]
        far, mine = length[no], words_of(no)
        prefix = F.array(*[F.lit(x) for x in words[: size - need + 1]])
        near = F.filter(F.transform(w, lambda x, i: F.when(F.array_contains(prefix, x), i)), lambda i: i.isNotNull())

        def around(i: Column) -> Column:
            lo = F.greatest(i - (far - 1), F.lit(0))
            enough = F.size(F.array_intersect(F.slice(w, lo + 1, 2 * far - 1), mine)) >= need
            starts = F.filter(F.sequence(lo, i), lambda s: F.array_contains(mine, F.get(w, s)))
            counted = F.transform(starts, lambda s: F.struct(
                s.alias("at"), F.size(F.array_intersect(F.slice(w, s + 1, far), mine)).alias("n")))
            return F.when(enough, F.filter(counted, lambda x: x["n"] >= need)).otherwise(
                F.array().cast("array<struct<at:int,n:int>>"))
        # the words must be there at all before places are looked for
        return F.when(F.size(F.array_intersect(w, mine)) >= need, F.array_distinct(F.flatten(F.transform(near, around)))).otherwise(
            F.array().cast("array<struct<at:int,n:int>>"))

    def whole(w: Column, found: Column, no: int) -> Column:
        """Whether a window stands in no window of a longer template that has all its matched words."""
        mine = words_of(no)

        def within(p: Column, other: int) -> Column:
            theirs = words_of(other)
            return F.exists(windows(w, other), lambda q: F.forall(
                F.sequence(p["at"], F.least(p["at"] + (length[no] - 1), F.size(w) - 1)),
                lambda i: ~F.array_contains(mine, F.get(w, i)) | (
                    (i >= q["at"]) & (i < q["at"] + length[other]) & F.array_contains(theirs, F.get(w, i)))))
        return F.exists(found, lambda p: ~_any(within(p, o) for o in longer[no]))

    def alone(line: Column, no: int) -> Column:
        """Whether a line matches by words that neither stand together nor are all a longer template's."""
        own = line["own"]
        mine = F.array_intersect(own, words_of(no))
        explained = _any(in_line(own, o) & (F.size(F.array_except(mine, words_of(o))) == 0) for o in longer[no])
        return in_line(own, no) & ~explained & (F.size(windows(line["w"], no)) == 0)

    def by_template(lines: Column, w: Column, no: int) -> Column:
        label, size, _, _ = parts[no]
        in_lines = F.transform(F.filter(lines, lambda x: in_line(x["own"], no)),
                               lambda x: F.size(F.array_intersect(x["own"], words_of(no))))

        def told(found: Column) -> Column:
            most = F.array_max(F.concat(in_lines, found["n"]))
            own = F.lit(True) if not longer[no] else whole(w, found, no) | F.exists(lines, lambda x: alone(x, no))
            return F.when(most.isNotNull(), F.struct(F.lit(label).alias("label"), (most / F.lit(float(size))).alias("score"),
                                                     own.alias("longest")))
        return _let(windows(w, no), told)

    def probe(text: Column) -> Column:
        # only lines that hold a prefix word can match by themselves; array_intersect keeps the order of the
        # first array: the line's template words, rarest first
        lines = F.transform(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(gate)), lambda x: _let(
            tokens(x), lambda w: F.struct(w.alias("w"), F.array_intersect(vocab, w).alias("own"))))
        return _let(lines, lambda x: _let(tokens(text), lambda w: F.array_compact(
            F.array(*[by_template(x, w, no) for no in range(len(templates))]))))

    return F.when(F.col(text_col).rlike(gate), probe(F.col(text_col)))


def scan(df: DataFrame, text_col: str = "text", phrases=PHRASES, templates=TEMPLATES,
         containment: float = 0.9) -> DataFrame:
    """`df` plus n_words, base_hits array<struct<start,end,label>> (words from 0, end exclusive),
    base_labels, matches array<struct<label,score,longest>>
    and labels (base ones and those of the longest matches).

    A null text counts as empty; empty texts have no words, hits or matches; words match across blanks and
    punctuation, so phrases also match across lines, and so do templates, whose words may also be spread over
    one line.  Repeated rows get equal results.  An empty table gives an empty one.  A column of `df` named like a result is replaced.
    """
    df = df.drop("n_words", "base_hits", "base_labels", "matches", "labels")
    text = F.col(text_col)
    last_words = sorted({p.split()[-1] for p, _ in phrases})
    words = tokens(text)

    def hits(w: Column) -> Column:
        def here(x: Column, i: Column) -> Column:
            out = F.lit(None).cast("struct<start:int,end:int,label:string>")
            for phrase, label in phrases:
                parts = phrase.split()
                ok = x == parts[0]
                for k, part in enumerate(parts[1:], 1):
                    ok = ok & (F.get(w, i + k) == part)
                out = F.when(ok, F.struct(i.alias("start"), (i + len(parts)).alias("end"), F.lit(label).alias("label"))).otherwise(out)
            return out
        return F.array_compact(F.transform(w, here))

    gate = text.rlike("(?i)" + "|".join(last_words))
    none = F.array().cast("array<struct<start:int,end:int,label:string>>")
    out = df.withColumns({
        "n_words": F.coalesce(F.regexp_count(text, F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")), F.lit(0)).cast("long"),
        "__w": F.when(gate, words),
        "matches": F.coalesce(block_matches(df, text_col, templates, containment),
                              F.array().cast("array<struct<label:string,score:double,longest:boolean>>")),
    })
    out = out.withColumn("base_hits", F.when(F.col("__w").isNotNull(), hits(F.col("__w"))).otherwise(none))
    base = F.array_sort(F.array_distinct(F.col("base_hits.label")))
    return out.withColumn("base_labels", base).withColumn(
        "labels", F.array_sort(F.array_distinct(F.concat(
            "base_labels", F.filter("matches", lambda m: m["longest"])["label"])))).drop("__w")


def report(scanned: DataFrame) -> DataFrame:
    """The digest columns of a scan: places, labels and a score in 0..1."""
    hits = F.col("base_hits")
    return scanned.select(
        "doc_id", "n_words", F.size(hits).cast("long").alias("n_base"),
        F.array_min(hits.start).cast("long").alias("first_word"),
        F.array_max(hits.start).cast("long").alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels"),
        F.when(F.size(hits) > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.col("matches.score")), F.lit(0.0))).alias("score"))
