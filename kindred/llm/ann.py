"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are centred, scaled to unit length and rotated at random, short ones into a space of
BITS dimensions; a code keeps one sign bit a dimension and two correction scalars, the vector's
length and how well the signs align with it.  Codes are written once and read by every pass.  From them the inner product with a query is estimated together with a bound on its error.
A vector whose least possible distance exceeds the k-th smallest distance found so far is
skipped; the rest are reranked by exact distances on the original vectors.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.llm.common import map_arrow, stage

K = 10
#: Bits of a code, unless vectors have more dimensions; the error falls with their square root.
BITS = 256
#: Bound of the estimate's error in standard deviations.
EPSILON = 4.0
#: Queries sent to the tasks at once; more go in further passes.
QUERY_BLOCK = 4096
#: Vectors encoded and searched at a time within a task.
VECTOR_BLOCK = 8192
SEED = 20_240_001


def rotation(dim: int, bits: int | None = None, seed: int = SEED) -> np.ndarray:
    """The first ``dim`` rows of a random orthogonal matrix of the code's size, the same for a dimension everywhere."""
    size = max(dim, bits or BITS)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return (q * np.sign(np.diag(r)))[:dim]


class Codes:
    """One-bit codes of a block of vectors: packed signs, lengths and alignments."""

    def __init__(self, bits: np.ndarray, length: np.ndarray, align: np.ndarray, dim: int):
        self.bits, self.length, self.align, self.dim = bits, length, align, dim

    @classmethod
    def of(cls, vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> "Codes":
        moved = (vectors - centre) @ turn
        length = np.linalg.norm(moved, axis=1)
        unit = moved / np.maximum(length, 1e-300)[:, None]
        return cls(np.packbits(moved > 0, axis=1), length, np.abs(unit).sum(axis=1) / np.sqrt(turn.shape[1]), turn.shape[1])

    def bounds(self, query: np.ndarray, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest likely squared distance to each of the rotated, centred ``query`` rows."""
        signs = np.unpackbits(self.bits, axis=1, count=self.dim).astype(np.float32) * 2 - 1
        q_length = np.linalg.norm(query, axis=1)
        unit = (query / np.maximum(q_length, 1e-300)[:, None]).astype(np.float32)
        align = np.maximum(self.align, 1e-12)
        estimate = (unit @ signs.T).astype(np.float64) / np.sqrt(self.dim) / align
        error = epsilon * np.sqrt(np.maximum(0.0, 1 - align**2)) / align / np.sqrt(max(1, self.dim - 1)) + 1e-5
        base = q_length[:, None] ** 2 + self.length**2
        scale = 2 * q_length[:, None] * self.length
        return base - scale * np.minimum(1, estimate + error), base - scale * np.maximum(-1, estimate - error)


def _matrix(column, dim: int) -> np.ndarray:
    """An Arrow column of complete lists as a matrix in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def distances(columns: np.ndarray, some: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances of ``some`` vectors, given by dimension, squares added from the first dimension to the last as any engine would."""
    total = np.zeros(len(some))
    for column, x in zip(columns, query.tolist()):
        apart = column[some] - x
        total += apart * apart
    return np.sqrt(total)


def nearest_in_block(ids: np.ndarray, columns: np.ndarray, codes: Codes, q_ids: np.ndarray, queries: np.ndarray, turned: np.ndarray, limit: np.ndarray, k: int, distinct: bool, epsilon: float = EPSILON) -> list[tuple[int, int, float]]:
    """(query, id, distance) of up to ``k`` nearest distinct ids; ``limit`` holds and gets the k-th distances."""
    out = []
    low, high = codes.bounds(turned, epsilon)
    for i, q_id in enumerate(q_ids.tolist()):
        cap = limit[i] ** 2 * (1 + 1e-9)
        if distinct and np.isinf(cap) and len(ids) > k:
            cap = float(np.partition(high[i], k)[k])  # one more than k, as the query's own row may be among them
        near = np.flatnonzero(low[i] <= cap)
        near = near[ids[near] != q_id]
        if not len(near):
            continue
        exact = distances(columns, near, queries[i])
        order = np.lexsort((ids[near], exact))
        found: dict[int, float] = {}
        for a, d in zip(ids[near][order].tolist(), exact[order].tolist()):
            if a not in found:
                found[a] = d
                if len(found) == k:
                    limit[i] = min(limit[i], d)
                    break
        out += [(q_id, a, d) for a, d in found.items()]
    return out


def usable(vectors: DataFrame, is_query, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """Rows with an id and a finite vector other than zero, of the commonest dimension; and that dimension."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"), is_query.alias("is_query"))
    rows = rows.filter("vec_id is not null and size(v) > 0 and exists(v, x -> x <> 0) and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = most["dim"] if most else 0
    return rows.filter(F.size("v") == dim), dim


def coded(dim: int, centre: np.ndarray, turn: np.ndarray, batches):
    """Batches of (vec_id, v) with each vector's code."""
    for batch in batches:
        found = Codes.of(_matrix(batch.column(1), dim), centre, turn)
        packed = pa.array([row.tobytes() for row in found.bits], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, pa.array(found.length), pa.array(found.align)], names=["vec_id", "v", "bits", "length", "align"])


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, epsilon: float = EPSILON) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of each query by Euclidean distance.

    ``is_query`` is a condition on the rows.  All vectors are coded once, in a table.  Queries
    are sent to the tasks in blocks of about ``QUERY_BLOCK``; each task reads its codes block by
    block and returns ``k`` rows a query at most, so what meets per query grows with the number
    of tasks only.  Vectors that are
    null, zero, empty, of an odd dimension or hold a null or non-finite value take no part, nor
    do null ids.  Rows of one id count as that id's nearest one, and a query with several
    vectors keeps the smallest.  Ties go to the smaller id.  Fewer candidates give fewer rows,
    empty tables none.  Codes are centred on the mean of all vectors.
    """
    spark = vectors.sparkSession
    rows, dim = usable(vectors, is_query, id_col, vec_col)
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not dim:
        return nothing
    means = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x")).collect()  # a row a dimension
    centre = np.array([r["x"] for r in sorted(means, key=lambda r: r["at"])])
    turn = rotation(dim)
    queries = stage(rows.filter("is_query").groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    blocks = -(-queries.count() // QUERY_BLOCK)
    index = stage(map_arrow(rows.select("vec_id", "v"), partial(coded, dim, centre, turn), "vec_id long, v array<double>, bits binary, length double, align double"), "codes")
    found = None
    for block in range(blocks):
        part = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
        q_ids, q = part.column("vec_id").to_numpy(), _matrix(part.column("v"), dim)
        sent = spark.sparkContext.broadcast((q_ids, q, centre, turn))

        def search(batches, sent=sent):
            q_ids, q, centre, turn = sent.value
            limit = np.full(len(q_ids), np.inf)
            turned = (q - centre) @ turn
            best = None
            for batch in batches:
                ids, m = batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
                bits = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)
                length, align = batch.column(3).to_numpy(), batch.column(4).to_numpy()
                for at in range(0, len(ids), VECTOR_BLOCK):
                    some = slice(at, at + VECTOR_BLOCK)
                    block_ids, columns = ids[some], np.ascontiguousarray(m[some].T)
                    codes, distinct = Codes(bits[some], length[some], align[some], turn.shape[1]), len(set(block_ids.tolist())) == len(block_ids)
                    got = []
                    for s in range(0, len(q_ids), 256):
                        some = slice(s, s + 256)
                        got += nearest_in_block(block_ids, columns, codes, q_ids[some], q[some], turned[some], limit[some], k, distinct, epsilon)
                    best = pd.concat([best, pd.DataFrame(got, columns=["query_id", "vec_id", "score"])])
                    best = best.sort_values(["query_id", "score", "vec_id"]).drop_duplicates(["query_id", "vec_id"]).groupby("query_id").head(k)
            if best is not None and len(best):
                yield pa.RecordBatch.from_pandas(best.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"}), preserve_index=False)

        got = stage(map_arrow(index, search, "query_id long, vec_id long, score double"), "nearest")
        found = got if found is None else found.unionByName(got)
    if found is None:
        return nothing
    one = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return one.withColumn("rank", rank).filter(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


def nearest_report(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.col("vec_id") % 100 == 0)
