"""BPE encoding and decoding through a minimal acyclic transducer (operator 13).

The corpus's most frequent words are encoded once and compiled into a minimal acyclic automaton: equal
suffixes are one path, and the numbers on a word's arcs add up to its place in a table of id runs.  The
automaton is a flat file in the shared folder that every executor fetches and every task memory-maps.  Tasks walk
it for all distinct words of a batch at once; a word that is not in it is merged exactly, so ids never
depend on which words were compiled.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, shared_dir, written, written_at

#: Words compiled at most, and their longest length in bytes: together they bound the automaton's size.
LEXICON_MOST, WORD_BYTES = 1 << 18, 48
#: Up to so many letters a word's pairs are looked through for each merge, and up to so many words merge side by side.
SHORT = 256
TOGETHER, TOGETHER_MOST = 64, 1 << 13
#: A merge is its rank and, in the lowest bits, the id it makes; NONE comes after all.
_BITS = 24
_ID, NONE = (1 << _BITS) - 1, 1 << 62

# Texts of these characters are split here; both ways were compared character by character (tests).  All other
# texts go through the tokenizer's own normaliser and splitter.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-ɏ‐-‧€]*")
_NUMBERS = "0-9²³¹¼-¾"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPLIT = re.compile(rf"{_ENDINGS}|[^\W_{_NUMBERS}]+|[{_NUMBERS}]|(?:[^\w\s]|_)+")
# The same for whole Arrow arrays.  U+0130 is left to Python, which lowers it to two characters.
_BLANKS = "\t\n\r\x20\xa0"
_NOT_PLAIN = "[^\t\n\r\x20-\x7e\xa0-\u012f\u0131-\u024f\u2010-\u2027\u20ac]"
_LETTERS = "".join(c for c in sorted({d for c in map(chr, range(0x250)) for d in c + c.lower()}) if re.fullmatch(rf"[^\W_{_NUMBERS}]", c))
_SPLIT_ALL = rf"({_ENDINGS}|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}{_BLANKS}]+)"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next of U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


def _true(flags: pa.Array) -> np.ndarray:
    return flags.to_numpy(zero_copy_only=False)


def _together(here: np.ndarray, lists: pa.Array, rest: list[list[str]]) -> pa.Array:
    """`lists` where `here` is true and `rest` elsewhere, each in order."""
    if not rest:
        return lists
    place = np.where(here, np.cumsum(here) - 1, len(lists) + np.cumsum(~here) - 1)
    return pa.concat_arrays([lists, pa.array(rest, lists.type)]).take(pa.array(place))


def _numbered(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct strings of all lists, the number of each string among them, and how many each list has."""
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), pc.list_value_length(lists).to_numpy().astype(np.int64)


class Tokenizer:
    """A byte-level BPE with word ends, read from a file of the tokenizers library: its own normaliser and splitter,
    exact merges, and the tokens' strings."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if model["type"] != "BPE" or file["decoder"] is not None or not model["end_of_word_suffix"]:
            raise ValueError("a BPE with word ends and without a decoder is needed")
        library = Library.from_file(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.plain = path == tokenizer_file()
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.inner, self.last = [vocab[c] for c in letters], [vocab[c + end] for c in letters]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = rank << _BITS | vocab[a + b]
        # the same sorted by both ids, for the words of a batch
        pairs, made = np.asarray(list(self.merges), np.int64).reshape(-1, 2), np.fromiter(self.merges.values(), np.int64)
        order = np.argsort(pairs[:, 0] << _BITS | pairs[:, 1])
        self.pairs, self.made = (pairs[:, 0] << _BITS | pairs[:, 1])[order], made[order]
        self.byte_ids = np.asarray([self.inner, self.last], np.int64)
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.specials = re.compile("|".join(f"({re.escape(s)})" for s in self.special)) if self.special else None
        self.strings = {i: s for s, i in (vocab | self.special).items()}

    def tokens(self, text: str | None) -> list[str]:
        """Runs between blanks, or single pieces after a NUL where this module does not split the text itself."""
        text = text or ""
        parts = [p for p in self.specials.split(text) if p] if "<|" in text and self.specials else [text]
        out: list[str] = []
        for part in parts:
            if part in self.special:
                out.append("\0" + part)
            elif self.plain and _PLAIN.fullmatch(part):
                out += part.lower().split()
            else:
                out += ["\0" + bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in self.split(self.normalise(part))]
        return out

    def pieces(self, token: str) -> list[str]:
        """The pieces of one of `tokens`; no piece holds a blank, so runs between blanks can be split each by itself."""
        return [token[1:]] if token[0] == "\0" else _SPLIT.findall(token)

    def words(self, text: str | None) -> list[str]:
        """The pieces that are encoded each by itself; special tokens' strings are pieces of their own."""
        return [w for t in self.tokens(text) for w in self.pieces(t)]

    def tokens_of(self, texts: pa.Array) -> pa.Array:
        """`tokens` of each text, as lists; an empty token, which has no pieces, may stand between blanks."""
        texts = texts.cast(pa.string()).fill_null("")
        here = np.full(len(texts), self.plain)
        if self.plain:
            here &= ~_true(pc.match_substring_regex(texts, _NOT_PLAIN))
            if self.special:
                here &= ~_true(pc.match_substring(texts, "<|"))
        lower = pc.utf8_lower(texts.filter(pa.array(here)))
        for blank in _BLANKS.replace(" ", ""):
            lower = pc.replace_substring(lower, blank, " ")
        rest = [self.tokens(texts[i].as_py()) for i in np.flatnonzero(~here).tolist()]
        return _together(here, pc.split_pattern(lower, " "), rest)

    def pieces_of(self, tokens: pa.Array) -> pa.Array:
        """`pieces` of each token, as lists; an empty piece, which has no ids, may be among them."""
        here = ~_true(pc.starts_with(tokens, "\0"))
        spaced = pc.replace_substring_regex(tokens.filter(pa.array(here)), _SPLIT_ALL, r"\1 ")
        rest = [self.pieces(tokens[i].as_py()) for i in np.flatnonzero(~here).tolist()]
        return _together(here, pc.split_pattern(pc.ascii_rtrim(spaced, " "), " "), rest)

    def merged(self, word: str) -> tuple[int, ...]:
        """The ids of one piece: the pair of lowest rank, leftmost first, is merged until none is left."""
        if word in self.special:
            return (self.special[word],)
        raw, merges = word.encode(), self.merges
        if not raw:
            return ()
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        n = len(ids)
        if n <= SHORT:
            found = [merges.get(p, NONE) for p in zip(ids, ids[1:])]
            while found and (best := min(found)) < NONE:
                i = found.index(best)
                ids[i: i + 2] = [best & _ID]
                del found[i]
                if i < len(found):
                    found[i] = merges.get((ids[i], ids[i + 1]), NONE)
                if i:
                    found[i - 1] = merges.get((ids[i - 1], ids[i]), NONE)
            return tuple(ids)
        # the same with a queue of the pairs, for words whose pairs are too many to look through each time
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < n and (m := merges.get((ids[i], ids[after[i]]), NONE)) < NONE:
                heapq.heappush(heap, (m, i))
        for i in range(n - 1):
            offer(i)
        while heap:
            m, i = heapq.heappop(heap)
            if ids[i] < 0 or after[i] >= n or merges.get((ids[i], ids[after[i]])) != m:
                continue  # a neighbour has changed since
            gone = after[i]
            ids[i], ids[gone], after[i] = m & _ID, -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return tuple(x for x in ids if x >= 0)

    def _merges(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge of each pair of ids, or NONE."""
        key = left << _BITS | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.made[at], NONE)

    def merged_together(self, words: list[str]) -> list[list[int]]:
        """`merged` for each of `words`: those of like lengths merge one pair each at a time, side by side."""
        out: list = [None] * len(words)
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        alone = (size < 2) | (size > TOGETHER) | np.fromiter((not self.merges or w in self.special for w in words), bool, len(words))
        for i in np.flatnonzero(alone).tolist():
            out[i] = list(self.merged(words[i]))
        rows = np.flatnonzero(~alone)
        rows = rows[np.argsort(size[rows], kind="stable")]
        for at in range(0, len(rows), TOGETHER_MOST):
            self._side_by_side(raw, size, rows[at: at + TOGETHER_MOST], out)
        return out

    def _side_by_side(self, raw: list[bytes], size: np.ndarray, rows: np.ndarray, out: list) -> None:
        """Put the ids of the words `rows` of two letters at least into `out`."""
        n, wide = size[rows], int(size[rows].max())
        letters = np.frombuffer(b"".join(raw[i].ljust(wide, b"\0") for i in rows.tolist()), np.uint8).reshape(len(rows), wide)
        place = np.arange(wide)
        ids = np.where(place == n[:, None] - 1, self.byte_ids[1][letters], self.byte_ids[0][letters])
        found = self._merges(ids[:, :-1], ids[:, 1:])
        found[place[1:] >= n[:, None]] = NONE
        found = np.concatenate([found, np.full((len(rows), 1), NONE)], axis=1)  # no pair starts at the last place
        while True:
            i = found.argmin(axis=1)  # the leftmost of the lowest rank
            best = found[np.arange(len(rows)), i]
            on = best < NONE
            for row, x, k in zip(rows[~on].tolist(), ids[~on].tolist(), n[~on].tolist()):
                out[row] = x[:k]
            if not on.any():
                return
            rows, ids, found, n, i, best = rows[on], ids[on], found[on], n[on] - 1, i[on, None], best[on]
            # what follows the pair moves up by one place
            here, end = np.arange(len(rows)), ids.shape[1] - 1
            moved = place[:end] > i
            ids[:, :-1] = np.where(moved, ids[:, 1:], ids[:, :-1])
            found[:, :-1] = np.where(place[:end] >= i, found[:, 1:], found[:, :-1])
            i = i[:, 0]
            ids[here, i] = best & _ID
            after = np.flatnonzero(i + 1 < n)
            found[after, i[after]] = self._merges(ids[after, i[after]], ids[after, i[after] + 1])
            before = np.flatnonzero(i > 0)
            found[before, i[before] - 1] = self._merges(ids[before, i[before] - 1], ids[before, i[before]])
            wide = int(n.max())
            ids, found, place = ids[:, :wide], found[:, :wide], place[:wide]

    def decoded(self, ids: np.ndarray) -> str:
        """Tokens' strings joined by a space, as the library does without a decoder; unknown ids are left out."""
        try:
            return " ".join(map(self.strings.__getitem__, ids.tolist()))
        except KeyError:
            return " ".join(s for s in map(self.strings.get, ids.tolist()) if s is not None)


_loaded: dict[str, Tokenizer] = {}


def load(path: str) -> Tokenizer:
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


#: The arrays of an automaton's file, in order.
_ARRAYS = (("arcs", "<i8"), ("target", "<i4"), ("adds", "<i4"), ("final", "<i1"), ("run", "<i8"), ("ids", "<u4"))


def compile_lexicon(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The file of a minimal acyclic transducer from words to id runs.

    Words are added in order; what the next word does not share is closed from its end, and a closed state equal to an
    earlier one is that state.  `arcs` holds state * 256 + byte in ascending order, `target` and `adds` the state an arc
    leads to and what it adds to a word's number.
    """
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    number: dict[tuple, int] = {}
    below: list[int] = []  # words that end at or after a state
    path: list[list] = [[False, []]]  # open states of the word before: final, arcs
    prev = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            at = number.get(key)
            if at is None:
                at = number[key] = len(states)
                states.append(key)
                below.append(final + sum(below[t] for _, t in arcs))
            path[-1][1].append((prev[len(path) - 1], at))
    words = sorted(entries)
    for w in words:
        shared = 0
        while shared < min(len(w), len(prev)) and w[shared] == prev[shared]:
            shared += 1
        close(shared)
        path += [[False, []] for _ in w[shared:]]
        path[-1][0] = True
        prev = w
    close(0)
    states.append((path[0][0], tuple(path[0][1])))  # the start is the last state
    arcs, target, adds = [], [], []
    for s, (final, out) in enumerate(states):
        n = int(final)
        for label, t in out:
            arcs.append(s * 256 + label)
            target.append(t)
            adds.append(n)
            n += below[t]
    runs = [entries[w] for w in words]
    parts = [arcs, target, adds, [f for f, _ in states], np.cumsum([0, *map(len, runs)]), [i for r in runs for i in r]]
    data = [np.asarray(p, t) for p, (_, t) in zip(parts, _ARRAYS, strict=True)]
    head = np.asarray([len(x) for x in data], "<i8").tobytes()
    return head + b"".join(x.tobytes() + b"\0" * (-x.nbytes % 8) for x in data)


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all strings, and where each starts and how many it has."""
    _, ends, text = strings.buffers()
    ends = np.frombuffer(ends, "<i4")[strings.offset: strings.offset + len(strings) + 1].astype(np.int64) if len(strings) else np.zeros(1, np.int64)
    return np.frombuffer(text, np.uint8) if text else np.zeros(0, np.uint8), ends[:-1], np.diff(ends)


class Lexicon:
    """A compiled transducer, memory-mapped."""

    def __init__(self, path: str):
        sizes = np.fromfile(path, "<i8", len(_ARRAYS))
        at = sizes.nbytes
        for (name, kind), n in zip(_ARRAYS, sizes.tolist(), strict=True):
            size = np.dtype(kind).itemsize * n
            setattr(self, name, np.memmap(path, kind, "r", at, (n,)) if n else np.zeros(0, kind))
            at += size + -size % 8

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word in the lexicon, or -1."""
        return self.numbers_of(pa.array(words, pa.binary()))

    def numbers_of(self, words: pa.Array) -> np.ndarray:
        """The same for an Arrow array of strings or binaries; all words are walked a byte at a time together."""
        text, start, size = _bytes_of(words)
        state = np.full(len(words), len(self.final) - 1, np.int64)
        number = np.zeros(len(words), np.int64)
        on = np.arange(len(words)) if len(self.arcs) else np.zeros(0, np.int64)
        dead = np.full(len(words), not len(self.arcs))
        step = 0
        while len(on := on[size[on] > step]):
            arc = state[on] * 256 + text[start[on] + step]
            at = np.minimum(np.searchsorted(self.arcs, arc), len(self.arcs) - 1)
            there = self.arcs[at] == arc
            dead[on[~there]] = True
            on, at = on[there], at[there]
            state[on] = self.target[at]
            number[on] += self.adds[at]
            step += 1
        return np.where(dead | (self.final[state] == 0), -1, number)


_mapped: dict[str, Lexicon] = {}


def _lexicon(name: str) -> Lexicon:
    if name not in _mapped:
        _mapped.clear()  # a worker serves one job at a time
        _mapped[name] = Lexicon(SparkFiles.get(name))
    return _mapped[name]


def _counted(batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema):
    tk = load(path)
    for b in batches:
        tokens, at, _ = _numbered(tk.tokens_of(b.column(0)))
        words, piece, many = _numbered(tk.pieces_of(tokens))
        n = np.bincount(piece, np.repeat(np.bincount(at, minlength=len(tokens)), many), len(words)).astype(np.int64)
        size = _bytes_of(words)[2]
        taken = (size > 0) & (size <= WORD_BYTES) & ~_true(pc.is_in(words, pa.array(tk.special, pa.string())))
        yield pa.RecordBatch.from_arrays([words.filter(pa.array(taken)), pa.array(n[taken])], schema=schema)


def word_counts(df: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """(word, n long) over all texts, for words short enough to be compiled."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema, path = StructType.fromDDL("word string, n long"), path or tokenizer_file()
    arrow = to_arrow_schema(schema)
    return df.select(F.col(text_col)).mapInArrow(lambda it: _counted(it, path, arrow), schema).groupBy("word").agg(F.sum("n").alias("n"))


def _shipped(spark: SparkSession, data: bytes) -> str:
    """`data` as a file of the shared folder that executors fetch; its name there."""
    name = f"lexicon-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/llm/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def frequent_words(counts: DataFrame, most: int) -> list[str]:
    """All words of `counts` that occur at least so often that there are no more than `most` of them.

    `counts` is read twice: give it materialised.  The driver sees a histogram by the logarithm of the count, some
    hundred rows, and the words found.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    taken, cut = 0, None
    for r in counts.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect():
        taken += r["count"]
        if taken > most:
            break
        cut = r["s"]
    return [] if cut is None else [r[0] for r in counts.where(step >= cut).select("word").collect()]


def lexicon_for(df: DataFrame, text_col: str = "text", path: str | None = None, most: int = LEXICON_MOST) -> str:
    """Compile the frequent words of all texts, `most` at most, ship the automaton, and return its name.

    Counts cover every text; only words of bounded number and length reach the driver.
    """
    path = path or tokenizer_file()
    tk = load(path)
    counts, place = written_at(word_counts(df, text_col, path), "words")
    words = frequent_words(counts, most)
    forget(df.sparkSession, place)
    return _shipped(df.sparkSession, compile_lexicon({w.encode(): tk.merged(w) for w in words}))


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of runs one after another."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _encoded(batches: Iterator[pa.RecordBatch], path: str, name: str, schema: pa.Schema):
    tk, lex = load(path), _lexicon(name)
    for b in batches:
        tokens, at, length = _numbered(tk.tokens_of(b.column(b.num_columns - 1)))
        words, piece, many = _numbered(tk.pieces_of(tokens))
        found = lex.numbers_of(words)
        # ids of the distinct words one after another: those of the lexicon, then the exactly merged ones
        seen = found >= 0
        rest = tk.merged_together(words.filter(pa.array(~seen)).to_pylist())
        table = np.concatenate([lex.ids, np.fromiter((x for r in rest for x in r), "<u4")])
        first, size = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        first[seen] = lex.run[found[seen]]
        size[seen] = lex.run[found[seen] + 1] - first[seen]
        size[~seen] = [len(r) for r in rest]
        first[~seen] = len(lex.ids) + np.cumsum(size[~seen]) - size[~seen]
        # the same for the distinct tokens
        table = table[_spread(first[piece], size[piece])]
        size = np.bincount(np.repeat(np.arange(len(tokens)), many), size[piece], len(tokens)).astype(np.int64)
        first = np.cumsum(size) - size
        n_ids, blobs, end = [], [], 0
        for k in length.tolist():
            d = at[end: end + k]
            end += k
            ids = table[_spread(first[d], size[d])]
            n_ids.append(len(ids))
            blobs.append(ids.astype("<u4", copy=False).tobytes())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n_ids, pa.int64()), pa.array(blobs, pa.binary())], schema=schema)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           lexicon: str | None = None) -> DataFrame:
    """(id, n_tokens long, ids binary) of every row: ids as unsigned 32-bit little-endian numbers, equal to those
    of the tokenizers library without added special tokens.

    `lexicon` names one made by `lexicon_for`; without it, one is compiled from `df` itself.  A null or empty text and
    one of blanks only have no ids.  Repeated rows, null ids and extra columns (which are left out) change nothing;
    an empty table gives an empty one.  Strings of special tokens in a text are those tokens.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    path = path or tokenizer_file()
    name = lexicon or lexicon_for(df, text_col, path)
    schema = StructType([df.schema[id_col], StructField("n_tokens", LongType()), StructField("ids", BinaryType())])
    arrow = to_arrow_schema(schema)
    return df.select(id_col, text_col).mapInArrow(lambda it: _encoded(it, path, name, arrow), schema)


def encoded_at(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, lexicon: str | None = None) -> DataFrame:
    """`encode`, with the ids written once in the shared folder: what reads them, such as `decode`, runs in tasks of its own,
    so an executor holds one Python worker for each of its cores and not one for each step."""
    return written(encode(df, id_col, text_col, path, lexicon), "ids")


def decode(df: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """`df` with a column `decoded`: the text of the ids as the library's decode(ids, skip_special_tokens=False)
    gives it.  Null ids give null, no ids an empty text; a column `decoded` of `df` is replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StringType, StructField, StructType

    path = path or tokenizer_file()
    df = df.drop("decoded")
    at = df.columns.index(ids_col)
    schema = StructType([*df.schema.fields, StructField("decoded", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = load(path)
        for b in batches:
            texts = [None if x is None else tk.decoded(np.frombuffer(x, "<u4")) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], schema=arrow)
    return df.mapInArrow(run, schema)


def report(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
