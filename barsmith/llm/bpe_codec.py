"""Byte-level BPE encoding and decoding: speculate, verify, repair.

Greedy longest match proposes the tokens of every distinct word of a batch.  A
sequence is what exact merging gives if each of its tokens is the encoding of
its own bytes and each adjacent pair is the encoding of the pair's bytes; both
are tested for all pairs at once by undoing merges on numpy arrays.  Only words
that fail are merged exactly.

The vocabulary is a ``tokenizers`` JSON file of a byte-level BPE model without
normalizer; strings of its added tokens are found in texts first, as that
library does.  Decoding joins the tokens' bytes; what is no UTF-8 is replaced.

Defined results: a null text is an empty one and has no tokens; repeated rows
are encoded alike; an empty table gives an empty table.  Only the named key
columns are kept, so other columns cannot clash; a key column named ``ids`` or
``decoded`` is refused.  A word of any length is encoded whole.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.common import Memo, fresh, merge_by_heap, merge_in_step, pieces, ragged

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: how byte-level BPE cuts a text into words (fixed by the vocabulary's kind)
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: the same for texts of these characters only, by the faster module
LATIN = re.compile("[\\t\\n\\r\\x20-\\x7eÀ-ÖØ-öø-ÿ]*")
LATIN_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+").findall
#: characters of text that are held as arrays at once, distinct words
#: remembered, and bytes from which a word is merged by a heap
BATCH_CHARS, MOST_WORDS, LONG = 1 << 20, 1 << 18, 512
#: what no word has: a letter between joined words, the start of an added token
BREAK, MARK = "\u0100", "\0added:"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary file: printable
    Latin-1 characters for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = byte_letters()
        of = {c: b for b, c in letters.items()}
        vocab = file["model"]["vocab"]
        self.added = {a["content"]: a["id"] for a in file["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.n = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes = [b""] * self.n
        for t, i in vocab.items():
            self.bytes[i] = t.encode() if t in self.added else bytes(of[c] for c in t)
        for t, i in self.added.items():
            self.bytes[i] = t.encode()
        self.words = regex.compile(WORDS)
        self.single = [vocab[letters[b]] for b in range(256)]
        # merges: left, right -> rank, token
        merges = [(m.split(" ") if isinstance(m, str) else m) for m in file["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        rank = np.arange(len(merges))
        keys = left * self.n + right
        self.merge = dict(zip(keys.tolist(), zip(rank.tolist(), made.tolist())))
        order = np.argsort(keys)
        self.keys, self.key_rank, self.key_made = keys[order], rank[order], made[order]
        # the merge that makes each token; a base token has rank -1
        self.rank = np.full(self.n, -1, np.int64)
        self.left, self.right = np.arange(self.n), np.arange(self.n)
        self.rank[made], self.left[made], self.right[made] = rank, left, right
        twice = np.bincount(made, minlength=self.n) > 1
        self.whole = self.canonical(left, right, made, twice)
        # the bytes of each token as Latin-1 letters, for the longest matches
        self.tokens = ahocorasick.Automaton()
        special = set(self.added.values())
        for i, b in enumerate(self.bytes):
            if b and i not in special:
                self.tokens.add_word(b.decode("latin-1"), i)
        self.tokens.make_automaton()
        lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.flat, self.size = np.frombuffer(b"".join(self.bytes), np.uint8), lengths
        self.start = np.cumsum(lengths) - lengths

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging a with b; a huge number where there is no such merge."""
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], 1 << 40)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether merging leaves the border between tokens a and b alone.

        Time runs backwards: of the two tokens at the border the one made last
        is taken apart, and while both of a state existed, merging them must
        not have been due.  Of equal ranks the left one merges first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        good, todo = np.ones(len(a), bool), np.arange(len(a))
        # in half steps: a merge of rank r is due at 2r, one left of the border before, one right of it after
        limit = np.full(len(a), 1 << 40) if until is None else until * 2
        while len(todo):
            bad = self.pair_rank(a, b) * 2 < limit
            good[todo[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            take_a = ra > rb
            go = ~bad & (np.maximum(ra, rb) >= 0)
            # a right-hand merge of the same rank as the border's comes later
            limit = np.where(take_a, ra * 2, rb * 2 + 1)
            a, b = np.where(take_a, self.right[a], a), np.where(take_a, b, self.left[b])
            a, b, limit, todo = a[go], b[go], limit[go], todo[go]
        return good

    def canonical(self, left, right, made, twice) -> np.ndarray:
        """Which tokens are the encoding of their own bytes.  Parts come before
        wholes in the order of merging, so one pass in that order is enough."""
        border = np.ones(self.n, bool)
        border[made] = self.compatible(left, right, self.rank[made])
        border[twice] = False
        whole = np.zeros(self.n, bool)
        whole[self.rank < 0] = True
        for a, b, m in zip(left.tolist(), right.tolist(), made.tolist()):
            whole[m] = border[m] and whole[a] and whole[b]
        return whole

    def speculate(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Longest matches from the left: the tokens of all words, and the
        number of the word that each is of."""
        joined = BREAK.join(w.decode("latin-1") for w in words)
        found = np.array([x for m in self.tokens.iter_long(joined) for x in m], np.int64)
        ends, ids = found[::2], found[1::2]
        lengths = np.array([len(w) + 1 for w in words], np.int64)
        return ids, np.searchsorted(np.cumsum(lengths), ends, side="right")

    def merge_of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], -1), self.key_made[at]

    def exact(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge the pair of lowest rank, the leftmost of equals, until none is left."""
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        single = np.array(self.single, np.int64)
        ids, of = merge_in_step(single[np.frombuffer(b"".join(words[i] for i in short), np.uint8)],
                                np.array([len(words[i]) for i in short], np.int64), self.merge_of)
        of = np.array(short, np.int64)[of]
        for i in long:
            one = merge_by_heap([self.single[b] for b in words[i]], self.merge, self.n)
            ids, of = np.append(ids, one), np.append(of, np.full(len(one), i))
        return ids, of

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words, and how many each word has."""
        ids, of = self.speculate(words)
        lengths = np.array([len(w) for w in words], np.int64)
        # a proposal must cover its word; then each token and each pair is tested
        wrong = np.bincount(of, self.size[ids], len(words)).astype(np.int64) != lengths
        wrong[of[~self.whole[ids]]] = True
        same = of[1:] == of[:-1]
        pairs, back = np.unique((ids[:-1] * self.n + ids[1:])[same], return_inverse=True)
        wrong[of[1:][same][~self.compatible(pairs // self.n, pairs % self.n)[back]]] = True
        if wrong.any():
            failed = np.flatnonzero(wrong)
            again, by = self.exact([words[i] for i in failed.tolist()])
            right = ~wrong[of]
            ids, of = np.append(ids[right], again), np.append(of[right], failed[by])
            order = np.argsort(of, kind="stable")
            ids, of = ids[order], of[order]
        return ids, np.bincount(of, minlength=len(words))

    def cut(self, text: str) -> list[str]:
        """Words of a text; an added token is a word that starts with a NUL mark."""
        if LATIN.fullmatch(text) and "<|" not in text:
            return LATIN_WORDS(text)
        if self.special is None or not self.special.search(text):
            return self.words.findall(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*self.words.findall(text[at:m.start()]), MARK + m.group()]
            at = m.end()
        return out + self.words.findall(text[at:])


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    codec = Codec(path)
    memo, flat, sizes = Memo(), np.zeros(0, np.int32), np.zeros(0, np.int64)
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
        for lo, hi in pieces([len(t) for t in texts], BATCH_CHARS):
            if len(memo) > MOST_WORDS:
                memo, flat, sizes = Memo(), flat[:0], sizes[:0]
            words = [codec.cut(t) for t in texts[lo:hi]]
            counts = [len(w) for w in words]
            at = np.fromiter(map(memo.__getitem__, chain.from_iterable(words)), np.int64, sum(counts))
            if memo.fresh:
                added = {i: codec.added[w[len(MARK):]] for i, w in enumerate(memo.fresh) if w.startswith(MARK)}
                raw = [w.encode() if i not in added else b" " for i, w in enumerate(memo.fresh)]
                ids, n = codec.encode_words(raw)
                for i, token in added.items():  # b" " is one token
                    ids[n[:i].sum()] = token
                flat, sizes = np.append(flat, ids.astype(np.int32)), np.append(sizes, n)
                memo.fresh = []
            start = np.cumsum(sizes) - sizes
            ids = flat[ragged(start[at], sizes[at])]
            ends = np.append(0, np.cumsum(sizes[at]))[np.append(0, np.cumsum(counts)).astype(np.int64)]
            raw = codec.flat[ragged(codec.start[ids], codec.size[ids])].tobytes()
            cuts = np.append(0, np.cumsum(codec.size[ids]))[ends].tolist()
            decoded = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())), pa.array(decoded, pa.string())],
                names=[*part.schema.names[:-1], "ids", "decoded"])


def encode(df: DataFrame, keys: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The key columns, ``ids`` (the tokens of the text) and ``decoded`` (the
    text that these tokens stand for)."""
    if {"ids", "decoded"} & {k.lower() for k in keys}:
        raise ValueError("a key column may not be named ids or decoded")
    rows = df.select(*keys, F.col(text).alias(fresh(df.select(*keys), "text")))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(lambda batches: encoded(batches, path), schema)


def q_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, ["doc_id"]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
