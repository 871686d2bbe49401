"""Approximate nearest neighbours: low-dimensional stable projections in a kd-tree, with a chi-square stopping test."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.vectors import first_k, grid, packed, usable

_LEAF = 64
#: Queries that go through a block together, and pairs of them that are verified at once: they bound what a task holds.
_ASKED, _PAIRS = 1024, 1 << 16


def chi_square_quantile(p: float, m: int) -> float:
    """The value below which a share p of a chi-square variable with an even number m of degrees lies."""
    low, high = 0.0, 100.0 * m
    for _ in range(100):
        x = (low + high) / 2
        term, total = 1.0, 0.0
        for i in range(m // 2):
            total += term
            term *= x / 2 / (i + 1)
        low, high = (x, high) if 1 - math.exp(-x / 2) * total < p else (low, x)
    return high


def kd_order(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points in which each leaf of a kd-tree is a run, and where the runs begin (with the end)."""
    order, starts, stack = np.arange(len(points)), [], [(0, len(points))]
    while stack:
        a, b = stack.pop()
        if b - a <= _LEAF:
            starts.append(a)
            continue
        part = points[order[a:b]]
        axis = int(np.argmax(part.max(0) - part.min(0)))
        half = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(part[:, axis], half)]
        stack += [(a + half, b), (a, a + half)]
    return order, np.array(starts + [len(points)])


def search_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, x: np.ndarray, points: np.ndarray, project: np.ndarray,
                 most: float, stop: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score): what `search` finds for each query in one block, whose rows are in kd order.

    Queries take their next leaves in rounds, each in its own order and up to its own reach, but all that take a leaf in a
    round do so by one matrix product. Its scores, less their rounding, only rule out; what they leave is verified.
    """
    runs = np.append(np.arange(0, len(cid), _LEAF), len(cid))  # leaves of one size: neighbours in kd order
    low, high = np.minimum.reduceat(points, runs[:-1]), np.maximum.reduceat(points, runs[:-1])
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    out = []
    for start in range(0, len(qid), _ASKED):
        ids, own = qid[start : start + _ASKED], q[start : start + _ASKED]
        target, norm = own @ project[:-1], np.einsum("ij,ij->i", own, own)
        off = 4 * x.shape[1] * np.finfo(float).eps * np.sqrt(most * norm)  # two ways to sum a product differ by less
        gap = np.maximum(np.maximum(low - target[:, None], target[:, None] - high), 0).reshape(-1, points.shape[1])
        gap = np.einsum("ij,ij->i", gap, gap).reshape(len(ids), -1)
        place = np.argsort(np.argsort(gap, axis=1, kind="stable"), axis=1)
        reach, floor, done, held, taken = np.full(len(ids), np.inf), np.full(len(ids), -np.inf), np.zeros(gap.shape, bool), none, 2

        def verified(held: tuple, who: np.ndarray, at: np.ndarray, about: np.ndarray) -> tuple:
            """(query, row, score, squared projected distance) of the k best of held and new pairs, by query and rank; raises floor."""
            away = points[at] - target[who]
            away = np.einsum("ij,ij->i", away, away)
            near_by = np.flatnonzero((away <= reach[who]) & (cid[at] != ids[who]))
            near_by = near_by[np.lexsort((-about[near_by], who[near_by]))]
            first = np.searchsorted(who[near_by], who[near_by])
            kth = np.minimum(first + k - 1, len(near_by) - 1)  # where it is another query's, there are fewer than k
            near_by = near_by[(who[near_by[kth]] != who[near_by]) | (about[near_by] >= about[near_by[kth]] - 2 * off[who[near_by]])]
            who, at, away = who[near_by], at[near_by], away[near_by]
            # Not by BLAS, where the last bit of a row's sum depends on its place: equal vectors must tie.
            found = [np.concatenate(both) for both in zip(held, (who, at, (x[at] * own[who]).sum(1), away))]
            keep = first_k(found[0], cid[found[1]], found[2], k)
            held = tuple(f[keep] for f in found)
            n = np.bincount(held[0], minlength=len(ids))
            floor[n >= k] = held[2][np.cumsum(n)[n >= k] - 1] - off[n >= k]
            return held

        while True:
            chosen = (place < taken) & ~done & (gap <= reach[:, None])
            done |= chosen
            new, pairs = [], 0
            for leaf in np.flatnonzero(chosen.any(0)):
                asked = np.flatnonzero(chosen[:, leaf])
                about = own[asked] @ x[runs[leaf] : runs[leaf + 1]].T
                n, at = np.nonzero(about >= floor[asked, None])
                new.append((asked[n], runs[leaf] + at, about[n, at]))
                pairs += len(n)
                if pairs >= _PAIRS:
                    held, new, pairs = verified(held, *map(np.concatenate, zip(*new))), [], 0
            if pairs:
                held = verified(held, *map(np.concatenate, zip(*new)))
            if not chosen.any() or taken >= gap.shape[1]:
                break
            n = np.bincount(held[0], minlength=len(ids))
            full, ends = n >= k, np.cumsum(n)
            if full.any():  # the k-th best bounds how far out a better one is projected; equals of those found stay in reach
                farthest = np.zeros(len(ids))
                np.maximum.at(farthest, held[0], held[3])
                limit = most + norm[full]
                limit = np.maximum(limit - 2 * held[2][ends[full] - 1], 0) + 1e-13 * limit
                reach[full] = np.maximum(stop * limit, farthest[full] * (1 + 1e-9))
            taken = min(taken * 2, gap.shape[1])
        out.append((ids[held[0]], cid[held[1]], held[2]))
    return tuple(np.concatenate(p) for p in zip(*out))


def search(vectors: DataFrame, k: int, every: int, id_name: str = "vec_id", vector_name: str = "embedding",
           projections: int = 16, sure: float = 0.98, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): about the k largest inner products for rows whose id is divisible by `every`.

    An inner product is ranked as a Euclidean distance: each candidate gets one more coordinate, which makes all
    equally long. Gaussian (2-stable) projections to `projections` (even) dimensions are indexed by a kd-tree in each block of
    candidates; every row is indexed. For a query, candidates come in the order of projected distance r; those are verified on the
    original vectors until r^2 / d^2 passes the `sure` quantile of chi-square, d being the distance of the k-th best so
    far: a nearer vector would have been projected within r with at least that probability, so that recall is about
    `sure`. Scores are inner products of the original vectors in double precision, ties to the smaller id; fewer
    candidates than k give all. Which rows take part: vectors.usable, without zero vectors. An empty table gives no rows.
    """
    rows = usable(vectors, id_name, vector_name).filter(F.exists("vec", lambda x: x != 0))
    squared = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    facts = rows.agg(F.count("*").alias("n"), F.max(squared).alias("most"), F.max(F.size("vec")).alias("size")).first()
    most = facts.most or 0.0
    queries = rows.filter(F.col("id") % every == 0)
    project = np.random.default_rng(seed).normal(size=((facts["size"] or 0) + 1, projections))
    stop = chi_square_quantile(sure, projections)

    def leaves(ids: np.ndarray, x: np.ndarray) -> bytes:
        """Reorders a block by its kd-tree; gives the projections of its vectors."""
        lift = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", x, x), 0))
        points = np.concatenate([x, lift[:, None]], 1) @ project
        order, _ = kd_order(points)
        ids[:], x[:] = ids[order], x[order]
        return points[order].tobytes()

    blocks = packed(rows, facts.n, [F.xxhash64("id"), F.col("id")], leaves)
    asked = packed(queries, queries.count(), [F.col("id")])

    def best(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        qid, cid = (np.frombuffer(row[c], "<i8") for c in ("q_ids", "c_ids"))
        q, x, points = (np.frombuffer(row[c]).reshape(len(i), -1) for c, i in (("q_body", qid), ("c_body", cid), ("c_more", cid)))
        return search_block(qid, q, cid, x, points, project, most, stop, k)

    return grid(asked, blocks, best, k)
