"""Approximate nearest neighbours by largest inner product, with score-aware quantisation.

Vectors are cut into two-component parts, each coded in four bits. Codebooks and codes minimise the anisotropic loss of
score-aware quantisation: of a vector's residual, the share parallel to the vector weighs ``eta`` times the share
across, as only it moves large inner products. A query's products with all codewords make its tables; two
four-bit codes are read as one byte, so a block of vectors is scanned by sixteen lookups a vector. The best ``rerank`` of a
block, and all within a few standard errors of the k-th best of these, are scored exactly, in double precision and component order, on the original vectors.

Codebooks are fitted on a bounded sample (``sample`` rows in expectation), and so are the partitions: directions by k-means, as
many as the rows call for, and how many of them a query probes, so that ``coverage`` of the sample's own neighbours lie in
those. Every row is coded, lies in one partition and is searched. Copies of a vector are coded and searched once, with their
k + 1 smallest ids. Partitions and their queries are cut into blocks of bounded size that meet in a grid, so a vector travels
once unless its partition draws very many queries; each block gives its k best, cut to k again around the shuffle by query.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id;
vectors of different lengths don't meet, each length is searched by itself; rows that share an id are rows of their own, and a
query meets all but itself; ties go to the smaller id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basalt.llm.common import materialize, read_table

K = 20
#: Rows that fit the codebooks, in expectation.
SAMPLE = 10_000
#: Inner products above this share of the norms are what the loss cares about.
THRESHOLD = 0.2
RERANK = 160
#: Beyond those, vectors are reranked whose rough score is at most so many standard errors below the k-th best.
SPREADS = 3.0
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 4_096
#: Distinct vectors for each partition, and the most partitions, which the sample must be able to tell apart.
PART_ROWS = 16_384
MOST_PARTS = 1_024
#: Share of the sample's neighbours that the probed partitions must hold, and queries that this is measured by.
COVERAGE = 0.97
PROBE_QUERIES = 400
ROUNDS = 8


@dataclass
class Quantiser:
    """books[m, c] is codeword c of part m; eta the weight of parallel residuals."""

    books: np.ndarray
    eta: float

    def _parts(self, x: np.ndarray) -> np.ndarray:
        m, _, d = self.books.shape
        out = np.zeros((len(x), m * d), np.float64)
        out[:, : x.shape[1]] = x
        return out.reshape(len(x), m, d)

    def encode(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes (n, parts): the nearest codewords, then part by part the one that lowers the anisotropic loss most."""
        parts = self._parts(x)
        unit = parts / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None, None]
        m = parts.shape[1]
        # per codeword: squared residual, and its component along the vector
        square = ((parts[:, :, None] - self.books[None]) ** 2).sum(-1)
        along = np.einsum("nmd,nmd->nm", parts, unit)[:, :, None] - np.einsum("nmd,mcd->nmc", unit, self.books)
        codes = square.argmin(-1)
        total = np.take_along_axis(along, codes[:, :, None], 2)[:, :, 0].sum(1)
        rows = np.arange(len(x))
        for _ in range(sweeps):
            for j in range(m):
                rest = total - along[rows, j, codes[:, j]]
                codes[:, j] = (square[:, j] + (self.eta - 1) * (rest[:, None] + along[:, j]) ** 2).argmin(-1)
                total = rest + along[rows, j, codes[:, j]]
        return codes.astype(np.uint8)

    def pack(self, codes: np.ndarray) -> np.ndarray:
        """Two codes a byte; an odd last part stands alone."""
        if codes.shape[1] % 2:
            codes = np.pad(codes, ((0, 0), (0, 1)))
        return codes[:, 0::2] << 4 | codes[:, 1::2]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(queries, bytes, 256): the products that each byte of a code adds."""
        one = np.einsum("nmd,mcd->nmc", self._parts(q), self.books)
        if one.shape[1] % 2:
            one = np.pad(one, ((0, 0), (0, 1), (0, 0)))
        both = one[:, 0::2, :, None] + one[:, 1::2, None, :]
        return both.reshape(len(q), both.shape[1], 256).astype(np.float32)


def fit(x: np.ndarray, threshold: float = THRESHOLD, rounds: int = ROUNDS, seed: int = 7) -> Quantiser:
    """Alternate between codes and codewords; a codeword is the least-squares answer to the anisotropic loss of its rows."""
    n, dim = x.shape
    m = -(-dim // 2)
    eta = max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))
    rng = np.random.default_rng(seed)
    out = Quantiser(np.zeros((m, 16, 2)), eta)
    parts = out._parts(x)
    for j in range(m):
        out.books[j] = parts[rng.choice(n, 16, replace=n < 16), j]
    unit = parts / np.linalg.norm(x, axis=1)[:, None, None]
    for step in range(rounds):
        codes = out.encode(x, sweeps=0 if step < 2 else 1)
        weight = 0.0 if step < 2 else eta - 1
        for j in range(m):
            along = np.einsum("nmd,nmd->n", parts - out.books[np.arange(m), codes], unit)
            own = along - ((parts[:, j] - out.books[j, codes[:, j]]) * unit[:, j]).sum(1)
            u, c = unit[:, j], codes[:, j]
            a = np.eye(2) + weight * u[:, :, None] * u[:, None, :]
            b = parts[:, j] + weight * u * ((u * parts[:, j]).sum(1) + own)[:, None]
            for k in np.unique(c):
                at = c == k
                out.books[j, k] = np.linalg.lstsq(a[at].sum(0), b[at].sum(0), rcond=None)[0]
    return out


@dataclass
class Partitions:
    """Unit directions that vectors go by, the means of those that go there, and how many a query probes."""

    directions: np.ndarray
    means: np.ndarray
    probes: int

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.directions.T).argmax(1)

    def probed(self, q: np.ndarray) -> np.ndarray:
        return np.argsort(-(q @ self.means.T), axis=1, kind="stable")[:, : self.probes]


def partition(x: np.ndarray, parts: int, k: int = K, coverage: float = COVERAGE, rounds: int = ROUNDS, seed: int = 7) -> Partitions:
    """k-means of directions; probes are the fewest that cover enough of the sample's own nearest neighbours."""
    rng = np.random.default_rng(seed)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    out = Partitions(unit[rng.choice(len(x), min(parts, len(x)), replace=False)], np.zeros((0, 0)), 1)
    for _ in range(rounds):
        own = out.of(x)
        for j in np.unique(own):
            mean = unit[own == j].sum(0)
            out.directions[j] = mean / max(np.linalg.norm(mean), 1e-300)
    own = out.of(x)
    out.means = np.array([x[own == j].mean(0) if (own == j).any() else out.directions[j] for j in range(len(out.directions))])
    asked = rng.choice(len(x), min(PROBE_QUERIES, len(x)), replace=False)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-score, axis=1)[:, : min(k, len(x) - 1)]
    out.probes = len(out.means)
    if near.shape[1]:
        # the place that each neighbour's partition has among the query's
        place = np.argsort(out.probed(x[asked]), axis=1)
        place = np.sort(np.take_along_axis(place, own[near], 1).ravel())
        out.probes = int(place[min(len(place) - 1, math.ceil(coverage * len(place)) - 1)]) + 1
    return out


def search_block(
    quantiser: Quantiser, owners: list[np.ndarray], x: np.ndarray, codes: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, rerank: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's number, id, score) of each query's k best in a block of distinct vectors x, whose rows' ids are ``owners``,
    ascending; x and queries are in double precision. The query's own row is left out once."""
    firsts = np.array([o[0] for o in owners], np.int64)
    order = np.argsort(firsts, kind="stable")
    owners, x = [owners[i] for i in order], x[order]
    codes = np.ascontiguousarray(codes[order].T)
    take = max(rerank, k) + 1  # the query's own vector may be there
    out_q, out_i, out_s = [], [], []

    def exact(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        score = np.zeros(len(rows))
        for d in range(x.shape[1]):
            score += x[rows, d] * q[d]
        return score

    for at in range(0, len(queries), 64):
        tables = quantiser.tables(queries[at : at + 64])
        for number, (q, qid, table) in enumerate(zip(queries[at : at + 64], query_ids[at : at + 64], tables), at):
            if len(x) > take:
                rough = table[0][codes[0]]
                for t, c in zip(table[1:], codes[1:]):
                    rough += t[c]
                least = np.partition(rough, len(x) - take)[len(x) - take]
                sure = np.flatnonzero(rough > least)
                # among equals the smaller ids, which come first
                pool = np.sort(np.concatenate([sure, np.flatnonzero(rough == least)[: take - len(sure)]]))
            else:
                pool = np.arange(len(x))
            score = exact(pool, q)
            if len(x) > take:
                # all others whose rough score could still be among the best, going by the errors seen
                error = score - rough[pool]
                least = np.partition(score, len(pool) - k)[len(pool) - k] - error.mean() - SPREADS * error.std()
                more = rough >= least
                more[pool] = False
                more = np.flatnonzero(more)
                pool, score = np.append(pool, more), np.append(score, exact(more, q))
            # the k + 1 best vectors and all their equals, copies told apart
            if len(pool) > k + 1:
                near = score >= np.partition(score, len(pool) - k - 1)[len(pool) - k - 1]
                pool, score = pool[near], score[near]
            held = [owners[i] for i in pool]
            for n, i in enumerate(pool.tolist()):
                mine = np.flatnonzero(held[n] == qid)
                if len(mine) and np.array_equal(x[i], q):
                    held[n] = np.delete(held[n], mine[0])
            ids, score = np.concatenate(held) if held else pool, np.repeat(score, [len(h) for h in held])
            best = np.lexsort((ids, -score))[:k]
            out_q.append(np.full(len(best), number))
            out_i.append(ids[best])
            out_s.append(score[best])
    if not out_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, v): rows with an id and finite, non-zero vectors, numbered."""
    v = F.col(vector_col)
    double = F.transform(v, lambda x: x.cast("double"))
    fine = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(double, lambda x: x != 0)
    # no component is a negative zero, so that equal vectors are alike
    plain = F.transform(double, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), plain.alias("v"))
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), "id", "v"), "vectors")


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rerank: int = RERANK,
    sample: int = SAMPLE, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES, part_rows: int = PART_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` (over the column ``id``) picks, the k nearest found
    among all other rows."""
    rows = usable(df, id_col, vector_col)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("total"), F.count(F.when(is_query, 1)).alias("asked")).orderBy("n").collect()
    out = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for r in sizes:
        if r["asked"]:
            one = rows.where(F.size("v") == r["n"])
            out = out.unionByName(_nearest(one, is_query, r["n"], r["total"], k, rerank, sample, block_rows, block_queries, part_rows))
    return out


def _nearest(
    rows: DataFrame, is_query: Column, dim: int, total: int, k: int, rerank: int, sample: int, block_rows: int, block_queries: int, part_rows: int
) -> DataFrame:
    """nearest() for rows (row, id, v) whose vectors have ``dim`` components."""
    rate = math.ceil(1e6 * min(1.0, sample / total))
    some = rows.where(F.pmod(F.xxhash64("row", F.lit("sample")), F.lit(1_000_000)) < rate).select("v").toArrow()
    if not len(some):
        some = rows.select("v").limit(sample).toArrow()
    x = _matrix(some["v"], dim)
    parts = partition(x, max(1, min(total // part_rows, MOST_PARTS, len(x) // 8)), k)
    sent = rows.sparkSession.sparkContext.broadcast((fit(x), parts))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                packed = own.pack(own.encode(x))
                codes = pa.array([r.tobytes() for r in packed], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, codes, pa.array(parts.of(x), pa.int32())], names=["ids", "v", "code", "part"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, parts = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                some = batch.slice(at, 2048)
                probed = parts.probed(some.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(probed) + 1) * probed.shape[1], pa.int32()), pa.array(probed.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], names=["row", "id", "v", "parts"])

    # copies of a vector are searched once; no query can list more than their k + 1 smallest ids, and those are cut before
    # the shuffle too
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    distinct = rows.withColumn("n", nth).where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vectors = materialize(distinct.select("ids", "v").mapInArrow(code, "ids array<long>, v array<double>, code binary, part int"), "coded")
    asked = rows.where(is_query).select("row", "id", "v").mapInArrow(probe, "row long, id long, v array<double>, parts array<int>")
    asked = materialize(asked, "asked").withColumn("part", F.explode("parts")).drop("parts")
    # blocks of bounded size; there are MOST_PARTS rows of these at most
    across = vectors.groupBy("part").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("across"))
    grid = across.join(asked.groupBy("part").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("down")), "part")
    deal = lambda c, n: F.pmod(F.xxhash64(F.lit("deal"), c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    grid = F.broadcast(materialize(grid, "grid"))
    left = vectors.join(grid, "part").select("ids", "v", "code", "part", deal("v", "across").alias("c"), every("down").alias("q"))
    right = asked.join(grid, "part").select("row", "id", "v", "part", deal("row", "down").alias("q"), every("across").alias("c"))

    def scan(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        row = query = np.zeros(0, np.int64)
        found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if left.num_rows and right.num_rows:
            codes = np.frombuffer(b"".join(left["code"].to_pylist()), np.uint8).reshape(left.num_rows, -1)
            lists = left["ids"].combine_chunks()
            ends = lists.offsets.to_numpy()
            owners = np.split(lists.flatten().to_numpy(), (ends - ends[0])[1:-1])
            row, query = right["row"].to_numpy(), right["id"].to_numpy()
            found = search_block(sent.value[0], owners, _matrix(left["v"], dim), codes, query, _matrix(right["v"], dim), k, rerank)
        columns = {"row": row[found[0]], "query_id": query[found[0]], "vec_id": found[1], "score": found[2]}
        return pa.table({n: pa.array(c, pa.float64() if n == "score" else pa.int64()) for n, c in columns.items()})

    found = left.groupBy("part", "c", "q").cogroup(right.groupBy("part", "c", "q")).applyInArrow(scan, "row long, query_id long, vec_id long, score double")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
