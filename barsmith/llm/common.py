"""Helpers that several operators share."""
from __future__ import annotations

import heapq
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from barsmith.session import ensure_checkpoint_dir


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use (Spark compares them without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: later readers
    neither compute it again nor depend on the executors that made it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing reads it any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of ``[start, start + length)`` of every row, one after another."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.arange(int(ends[-1]), dtype=np.int64)
    out += np.repeat(starts - (ends - lengths), lengths)
    return out


def pieces(lengths: list[int], most: int) -> list[tuple[int, int]]:
    """Cut rows into runs whose summed length stays near ``most`` (a single
    longer row is a run of its own)."""
    out, first, total = [], 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            out.append((first, i))
            first, total = i, 0
        total += n + 1
    if first < len(lengths):
        out.append((first, len(lengths)))
    return out


#: no number of a step's order is as large
NEVER = np.iinfo(np.int64).max


def merge_in_step(sym: np.ndarray, sizes: np.ndarray, pair) -> tuple[np.ndarray, np.ndarray]:
    """Byte-pair merging of many ragged sequences at once.

    ``sizes`` are the (positive) lengths of the sequences that follow each other
    in ``sym``; ``pair(a, b)`` gives the rank of merging two symbols, below 0
    where they don't merge, and the symbol made.  A step merges in every
    sequence the pair of lowest rank, the leftmost of equals.  Returns the
    symbols that survive and the number of the sequence of each, in order.
    """
    seq = np.repeat(np.arange(len(sizes)), sizes)
    out_sym, out_seq = [sym[:0]], [seq[:0]]
    rank, made = pair(sym[:-1], sym[1:])
    rank, made = np.append(rank, -1), np.append(made, 0)
    rank[:-1][seq[1:] != seq[:-1]] = -1
    while len(sym):
        n = len(sym)
        order = np.where(rank < 0, NEVER, rank * n + np.arange(n))
        first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
        least = np.minimum.reduceat(order, first)
        stays = np.repeat(least != NEVER, np.diff(np.append(first, n)))
        if not stays.all():
            out_sym.append(sym[~stays])
            out_seq.append(seq[~stays])
        at = least[least != NEVER] % n
        sym[at] = made[at]
        stays[at + 1] = False
        # only the pairs to the left and right of a merge are new
        new = np.zeros(n, bool)
        new[at] = True
        sym, seq, rank, made, new = sym[stays], seq[stays], rank[stays], made[stays], new[stays]
        if not len(sym):
            break
        new = np.flatnonzero(new)
        again = np.unique(np.concatenate([new, new[new > 0] - 1]))
        end = (again + 1 >= len(sym))
        right = np.minimum(again + 1, len(sym) - 1)
        rank[again], made[again] = pair(sym[again], sym[right])
        rank[again[end | (seq[again] != seq[right])]] = -1
    sym, seq = np.concatenate(out_sym), np.concatenate(out_seq)
    order = np.argsort(seq, kind="stable")
    return sym[order], seq[order]


def merge_by_heap(sym: list[int], merge, n_symbols: int) -> list[int]:
    """The same for one sequence, in time that does not grow with its square:
    ``merge`` maps a * n_symbols + b to (rank, symbol made)."""
    n, heap = len(sym), []
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def offer(i: int) -> None:
        if i >= 0 and (j := after[i]) < n and (m := merge.get(sym[i] * n_symbols + sym[j])):
            heapq.heappush(heap, (m[0], i, sym[i], sym[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        if sym[i] != a or (j := after[i]) >= n or sym[j] != b:
            continue
        sym[i], sym[j], after[i] = merge[a * n_symbols + b][1], -1, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [s for s in sym if s >= 0]


class Memo(dict):
    """Numbers distinct words; new ones wait in ``fresh`` until they are worked on."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.fresh.append(word)
        return n
