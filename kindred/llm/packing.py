"""Best-fit packing of texts into fixed-size sequences under conflicts.

No sequence holds two texts of one source or of one duplicate cluster.  Texts go largest
first into the open sequence with the least room that fits: sequences are kept in order of
their room, each with bitmaps of its sources and clusters, and the search walks from the
first with enough room to the tightest one whose bitmaps allow the text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a sequence: the texts' UTF-8 bytes and one end mark for each text.
CAPACITY = 8192
#: Texts packed together in one task; the number of such groups grows with the table.
GROUP = 2048
_BLOCK = 64


class Bins:
    """Open sequences in order of their room (of equal ones the longest unchanged first), with conflict bitmaps."""

    def __init__(self, capacity: int, bits: int):
        self.capacity = capacity
        self.words = max(1, -(-bits // 64))
        self.maps = np.zeros((16, self.words), dtype=np.uint64)
        self.room = np.empty(0, dtype=np.int64)
        self.order = np.empty(0, dtype=np.int64)
        self.n = 0

    def find(self, size: int, conflicts: list[int]) -> int:
        """Place in the order of the tightest sequence that has room and none of the bits; -1 if none."""
        at, step = int(np.searchsorted(self.room, size)), _BLOCK
        while at < len(self.room):
            some = self.order[at : at + step]
            ok = np.ones(len(some), dtype=bool)
            for bit in conflicts:
                ok &= self.maps[some, bit >> 6] & np.uint64(1 << (bit & 63)) == 0
            if ok.any():
                return at + int(ok.argmax())
            at += step
            step *= 2
        return -1

    def add(self, size: int, conflicts: list[int]) -> tuple[int, int]:
        """(sequence, offset) for an item of ``size``."""
        at = self.find(size, conflicts)
        if at < 0:
            which, room = self.n, self.capacity
            self.n += 1
            if which == len(self.maps):
                self.maps = np.concatenate([self.maps, np.zeros_like(self.maps)])
        else:
            which, room = int(self.order[at]), int(self.room[at])
            self.room, self.order = np.delete(self.room, at), np.delete(self.order, at)
        for bit in conflicts:
            self.maps[which, bit >> 6] |= np.uint64(1 << (bit & 63))
        if room > size:
            to = int(np.searchsorted(self.room, room - size, side="right"))
            self.room, self.order = np.insert(self.room, to, room - size), np.insert(self.order, to, which)
        return which, self.capacity - room


def _bits(values: pd.Series, first: int) -> tuple[list[int], int]:
    """A bit for each value that occurs twice or more, -1 for others and nulls."""
    codes, _ = pd.factorize(values)
    counts = np.bincount(codes[codes >= 0]) if (codes >= 0).any() else np.zeros(0, int)
    bit = np.where(counts > 1, first + np.cumsum(counts > 1) - 1, -1)
    return [int(bit[c]) if c >= 0 else -1 for c in codes], first + int((counts > 1).sum())


def pack_group(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of one group: whole sequences of long texts, then the rests by best fit."""
    frame = frame.assign(rest=frame["size"] % capacity).sort_values(["rest", "doc_id", "h"], ascending=[False, True, True], kind="stable")
    source, n = _bits(frame["source"], 0)
    cluster, n = _bits(frame["cluster"], n)
    bins = Bins(capacity, n)
    doc, start, length, where, offset = [], [], [], [], []
    for doc_id, size, rest, s, c in zip(frame["doc_id"], frame["size"], frame["rest"], source, cluster):
        whole = int(size) // capacity
        for k in range(whole):
            doc.append(doc_id), start.append(k * capacity), length.append(capacity)
            where.append(-1), offset.append(0)
        if rest:
            which, at = bins.add(int(rest), [b for b in (s, c) if b >= 0])
            doc.append(doc_id), start.append(whole * capacity), length.append(int(rest))
            where.append(which), offset.append(at)
    where = np.array(where, dtype=np.int64)
    alone = where < 0
    where[alone] = bins.n + np.arange(alone.sum())
    group = int(frame["shard"].iloc[0])
    return pd.DataFrame({"doc_id": pd.array(doc, dtype="Int64"), "piece_start": start, "n_bytes": length, "bin_id": group * (1 << 32) + where, "bin_offset": offset})


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """(doc_id, piece_start, n_bytes, bin_id, bin_offset): where each piece of every text lies.

    A text's size is its UTF-8 bytes and one end mark; a null text is an empty one.  Texts
    larger than ``capacity`` fill whole sequences, their rest is packed.  ``cluster_col`` names
    duplicate clusters (default: equal texts, white space and ASCII case aside).  Null sources
    conflict with nothing.  Texts are dealt out over groups by a hash of id and text, so a
    source or cluster with very many texts spreads over all of them, and repeated rows are
    packed each.  Groups hold about ``group`` texts whatever the table's size.  An empty table
    gives no row.
    """
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"\s+", " ")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("h"),
        F.col(source_col).cast("string").alias("source"),
        (F.xxhash64(plain) if cluster_col is None else F.xxhash64(cluster_col)).alias("cluster"),
        (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long") + 1).alias("size"),
    )
    groups = max(1, -(-docs.count() // group))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "h"), F.lit(groups)).cast("long"))
    return dealt.groupBy("shard").applyInPandas(lambda f: pack_group(f, capacity), "doc_id long, piece_start long, n_bytes long, bin_id long, bin_offset long")
