"""Token counts of a SentencePiece BPE model by rank-synchronous merging.

Distinct pre-tokens of a batch lie in ragged numpy arrays.  Each step finds in
every sequence the adjacent pair of lowest rank (the leftmost of equals) and
merges all of them at once; sequences without a pair to merge leave, and the
symbols that survive are counted.  A character outside the vocabulary counts
its UTF-8 bytes (byte fallback).

No piece has a space mark after another character and none has a line feed, so
texts are cut there without changing a merge; both are checked when the model
is loaded.  A pre-token of over ``LONG`` symbols is merged by a heap, which
gives the same symbols in less time than as many steps.

Defined results: a null text is an empty one and has no tokens; repeated rows
count alike; an empty table gives an empty table.  Only the named key columns
are kept; one named ``n_tokens`` is refused.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.common import Memo, fresh, merge_by_heap, merge_in_step, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
CUT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
LONG = 512
BATCH_CHARS, MOST_WORDS = 4 << 20, 1 << 20


class Merger:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        score = {model.id_to_piece(i): model.get_score(i) for i in usual}
        if any(SPACE in p.lstrip(SPACE) or ("\n" in p and p != "\n") for p in score):
            raise ValueError("a piece of this model spans words or lines")
        # the order of merging: best score first, equal scores share a rank
        place = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        letters = sorted({c for p in score for c in p})
        self.id = {p: i for i, p in enumerate([*score, *[c for c in letters if c not in score]])}
        self.n = len(self.id) + 1  # the last stands for any other character
        keys, ranks, made = [], [], []
        for p, s in score.items():
            for i in range(1, len(p)):
                a, b = self.id.get(p[:i]), self.id.get(p[i:])
                if a is not None and b is not None:
                    keys.append(a * self.n + b)
                    ranks.append(place[s])
                    made.append(self.id[p])
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = (np.array(x, np.int64)[order] for x in (keys, ranks, made))
        self.merge = dict(zip(keys, zip(ranks, made)))
        self.letter = np.full(0x110000, self.n - 1, np.int64)
        for c in letters:
            self.letter[ord(c)] = self.id[c]
        # tokens that a symbol counts: one, or its bytes where it is no piece
        self.cost = np.array([1 if p in score else len(p.encode()) for p in self.id] + [0], np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], -1), self.made[at]

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        sym, of = self.letter[points], np.repeat(np.arange(len(words)), sizes)
        other = sym == self.n - 1
        bytes_ = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        out = np.bincount(of[other], bytes_[other], len(words)).astype(np.int64)
        long = sizes > LONG
        for i in np.flatnonzero(long).tolist():
            out[i] += self.cost[merge_by_heap(sym[of == i].tolist(), self.merge, self.n)].sum()
        left, by = merge_in_step(sym[~long[of]], sizes[~long], self.pair)
        out[~long] += np.bincount(by, self.cost[left], int((~long).sum())).astype(np.int64)
        return out


def counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    merger = Merger(path)
    memo, known = Memo(), np.zeros(0, np.int64)
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
        totals = np.zeros(len(texts), np.int64)
        for lo, hi in pieces([len(t) for t in texts], BATCH_CHARS):
            if len(memo) > MOST_WORDS:
                memo, known = Memo(), np.zeros(0, np.int64)
            words = [CUT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts[lo:hi]]
            sizes = [len(w) for w in words]
            at = np.fromiter(map(memo.__getitem__, chain.from_iterable(words)), np.int64, sum(sizes))
            if memo.fresh:
                known = np.append(known, merger.counts(memo.fresh))
                memo.fresh = []
            totals[lo:hi] = np.bincount(np.repeat(np.arange(hi - lo), sizes), known[at], hi - lo)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(totals)], names=[*batch.schema.names[:-1], "n_tokens"])


def count_tokens(df: DataFrame, keys: list[str], text: str = "text", path: str = MODEL) -> DataFrame:
    """The key columns and ``n_tokens``, without begin or end tokens."""
    if "n_tokens" in {k.lower() for k in keys}:
        raise ValueError("a key column may not be named n_tokens")
    rows = df.select(*keys, F.col(text).alias(fresh(df.select(*keys), "text")))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(lambda batches: counted(batches, path), schema)


#: tokens above which a document is over the limit
CONTEXT = 4096


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    return count_tokens(docs, ["doc_id", "n_bytes"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT).alias("over_limit"))
