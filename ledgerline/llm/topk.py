"""Exact top-k inner products: norm-sorted candidates, rotated partial sums, Cauchy-Schwarz residual bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.vectors import first_k, grid, matrix, packed, usable

_STEP = 1024  # candidates between two looks at the thresholds
_DENSE = 1 / 16  # share of pairs from which one matrix product is cheaper than picking rows
_EXACT = 2.0**53  # whole numbers below this are exact as doubles


def _rotation(rows: DataFrame) -> np.ndarray:
    """The right singular vectors of all rows, most energy first, from the sum of x x^T (length^2 numbers, whatever the rows)."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in stream:
            x = matrix(batch.column(0))
            total = x.T @ x + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"at": np.arange(total.size), "part": total.ravel()})

    sums = rows.select("vec").mapInArrow(run, "at long, part double").groupBy("at").agg(F.sum("part").alias("part")).collect()
    n = int(round(len(sums) ** 0.5))
    gram = np.zeros(n * n)
    for at, part in sums:
        gram[at] = part
    return np.linalg.eigh(gram.reshape(n, n))[1][:, ::-1]


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered rows, pair by pair; exact, or an error where a score does not fit 64 bits."""
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(q.shape[1], 1)
    if bound < _EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(m, n)) for m, n in zip(q, x)]
    if any(abs(s) >= 1 << 63 for s in whole):
        raise OverflowError("an inner product does not fit a 64-bit integer")
    return np.array(whole, np.int64)


def search(vectors: DataFrame, k: int, every: int, head: int, id_name: str = "vec_id", vector_name: str = "embedding", levels: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of floor(levels * x) for rows whose id is divisible by `every`.

    Candidates are all rows but the query's own, in blocks of descending length, so that later blocks are bounded by
    shorter vectors. In a block, the partial sum over the first `head` directions of an SVD rotation plus the product
    of the residual lengths bounds each score (Cauchy-Schwarz); only pairs that may enter the k best are computed, as
    whole numbers. Ties go to the smaller id; fewer candidates than k give all. Which rows take part: vectors.usable.
    An empty table gives no rows. Other columns are ignored.
    """
    rows = usable(vectors, id_name, vector_name).withColumn("vec", F.transform("vec", lambda x: F.floor(levels * x).cast("double")))
    rotation = _rotation(rows)
    queries = rows.filter(F.col("id") % every == 0)
    n, m = rows.count(), queries.count()
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    blocks = packed(rows, n, [F.desc(length), F.col("id")])
    asked = packed(queries, m, [F.col("id")])

    def best(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        qid, cid = (np.frombuffer(row[c], "<i8") for c in ("q_ids", "c_ids"))
        q, x = (np.frombuffer(row[c]).reshape(len(i), -1) for c, i in (("q_body", qid), ("c_body", cid)))
        order = np.argsort(-np.einsum("ij,ij->i", x, x), kind="stable")
        x, cid = x[order], cid[order]
        exact = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < _EXACT
        qr, xr = q @ rotation, x @ rotation
        rest = lambda r: np.sqrt(np.einsum("ij,ij->i", r[:, head:], r[:, head:]))
        qn, xn = (np.sqrt(np.einsum("ij,ij->i", r, r)) for r in (q, x))
        q_rest, x_rest = rest(qr), rest(xr)
        least = np.full(len(q), -np.inf)  # the k-th best so far
        at, who, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a in range(0, len(x), _STEP):
            b = slice(a, a + _STEP)
            slack = 1e-9 * qn[:, None] * xn[b][None, :]
            live = np.flatnonzero(qn * xn[a] * (1 + 1e-9) >= least)  # no shorter vector can reach the others' k best
            if not len(live):
                break
            bound = qr[live, :head] @ xr[b, :head].T + q_rest[live][:, None] * x_rest[b][None, :] + slack[live]
            may = (bound >= least[live][:, None]) & (qid[live][:, None] != cid[b][None, :])
            if exact and may.mean() > _DENSE:  # whole numbers: any order of summation gives the same
                scores = np.where(may, q[live] @ x[b].T, -np.inf)
                if scores.shape[1] > k:  # the k best of a step hold its part of the k best, with all that tie with the last
                    last = np.partition(scores, -k, axis=1)[:, -k]
                    may &= scores >= last[:, None]
                i, j = np.nonzero(may & (scores >= least[live][:, None]))
                new = scores[i, j].astype(np.int64)
                at, who, score = (np.concatenate(p) for p in ((at, live[i]), (who, cid[j + a]), (score, new)))
            else:
                i, j = np.nonzero(may)
                i, j = live[i], j + a
                for c in range(0, max(len(i), 1), 1 << 18):  # bounded memory
                    part = slice(c, c + (1 << 18))
                    new = _scores(q[i[part]], x[j[part]])
                    keep = new >= least[i[part]]
                    at, who, score = (np.concatenate(p) for p in ((at, i[part][keep]), (who, cid[j[part][keep]]), (score, new[keep])))
            chosen = first_k(at, who, score, k)
            at, who, score = at[chosen], who[chosen], score[chosen]
            full = np.flatnonzero(np.bincount(at, minlength=len(q)) >= k)
            last = np.searchsorted(at, full, side="right") - 1
            least[full] = score[last] - (0 if exact else 1e-9 * np.abs(score[last].astype(np.float64)))
        return qid[at], who, score

    return grid(asked, blocks, best, k, "long")
