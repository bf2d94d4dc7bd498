"""Vectors described by their ordered nearest pivots: near-duplicate links and nearest-neighbour search."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import components, groups, saved


def usable(v: Column) -> Column:
    """Neither null, empty nor zero, and every component finite."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """List column of equal lengths as rows of doubles."""
    flat = np.asarray(pa.concat_arrays(column.chunks).flatten() if isinstance(column, pa.ChunkedArray) else column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def choose_pivots(vectors: DataFrame, m: int, sample: int = 2000) -> np.ndarray:
    """``m`` unit vectors far apart: from the ``sample`` usable vectors with the smallest hash
    of their id, each next one is the one least similar to those already chosen. The sample
    is all that reaches the driver. The vectors are of one length."""
    rows = vectors.select(F.xxhash64("vec_id", "embedding").alias("h"), "embedding").orderBy("h").limit(sample).collect()
    rows = [r["embedding"] for r in rows]
    if not rows:
        return np.zeros((0, 1))
    u = np.unique(np.array(rows, np.float64), axis=0)
    u /= np.linalg.norm(u, axis=1)[:, None]
    chosen = [0]
    near = u @ u[0]
    while len(chosen) < min(m, len(u)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, u @ u[chosen[-1]])
    return u[chosen]


def lengths(vectors: DataFrame) -> list[int]:
    """The lengths of the vectors, of which a table has few; each is indexed on its own."""
    return sorted(r[0] for r in vectors.select(F.size("embedding")).distinct().collect())


def _prefix(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest pivots of each unit vector, nearest first, ties to the lower number."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :k]


def _postings(pivots: np.ndarray, k: int, shared: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                x = matrix(part.column("embedding"))
                if not len(x):
                    continue
                x = x / np.linalg.norm(x, axis=1)[:, None]
                first = np.sort(_prefix(x, pivots, k), axis=1).astype(np.uint64)
                mask = np.bitwise_or.reduce(np.uint64(1) << first, axis=1)
                sets = list(combinations(range(first.shape[1]), min(shared, first.shape[1])))
                list_mask = np.stack([np.bitwise_or.reduce(np.uint64(1) << first[:, s], axis=1) for s in sets], axis=1)
                rows = pa.array(np.repeat(np.arange(len(x)), len(sets)))
                out = {c: part.column(c).take(rows) for c in ("label", "node", "copies", "embedding")}
                out |= {"list": pa.array(list_mask.ravel().view(np.int64)), "mask": pa.array(np.repeat(mask, len(sets)).view(np.int64))}
                yield pa.RecordBatch.from_pydict({c: out[c] for c in ("label", "list", "node", "copies", "mask", "embedding")})

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node number that each of ``n`` nodes reaches over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _verify(least: float, shared: int):
    """Cosines of the vectors on one list (or of two of its blocks). A pair is counted on the
    list of its ``shared`` lowest common pivots only, so never twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, held, i, j), t in groups(batches, ["label", "list", "i", "j"]):
            x = matrix(t.column("embedding"))
            x = x / np.linalg.norm(x, axis=1)[:, None]
            node, copies, block = (np.asarray(t.column(c).combine_chunks()) for c in ("node", "copies", "block"))
            mask = np.asarray(t.column("mask").combine_chunks()).view(np.uint64)
            own, other = np.flatnonzero(block == i), np.flatnonzero(block == j)
            a, b = np.nonzero(x[own] @ x[other].T >= least)
            a, b = own[a], other[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            common = mask[a] & mask[b]
            low = np.zeros_like(common)
            for _ in range(shared):
                bit = common & (~common + np.uint64(1))
                low |= bit
                common ^= bit
            mine = low == np.array([held], np.int64).view(np.uint64)[0]
            a, b = a[mine], b[mine]
            if not len(a):
                continue
            links = np.bincount(a, weights=copies[b], minlength=len(x)) + np.bincount(b, weights=copies[a], minlength=len(x))
            order = np.argsort(node, kind="stable")
            place = np.empty(len(x), np.int64)
            place[order] = np.arange(len(x))
            root = node[order][_forest(place[a], place[b], len(x))[place]]
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_pydict(
                {"node": pa.array(node[linked]), "links": pa.array(links[linked].astype(np.int64)), "root": pa.array(root[linked])}
            )

    return run


def _links(one: DataFrame, chosen: np.ndarray, least: float, k: int, shared: int, block: int) -> DataFrame:
    """(node, links, root) of the linked nodes, per list, for vectors (label, node, copies, embedding) of one length."""
    shared = min(shared, k, len(chosen))
    fields = "label string, list long, node long, copies long, mask long, embedding array<double>"
    posted = one.mapInArrow(_postings(chosen, k, shared), fields)
    lists = one.mapInArrow(_postings(chosen, k, shared), fields).groupBy("label", "list").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    mine = F.pmod(F.xxhash64("node"), F.col("n")).cast("int")
    dealt = posted.join(lists, ["label", "list"]).withColumn("block", mine)
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")}).drop("o", "n")
    key = ["label", "list", "i", "j"]
    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_verify(least, shared), "node long, links long, root long")


def near_duplicates(
    vectors: DataFrame, least: float = 0.93, pivots: int = 64, k: int = 6, shared: int = 2, block: int = 512
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of (vec_id, embedding, label).

    Two vectors of one label are linked if their cosine, in double precision, is at
    least ``least``. A vector is described by its ``k`` nearest pivots and posted in the
    inverted list of every set of ``shared`` of them, so two vectors meet on a list if
    they share that many; they are then verified. A list longer than ``block`` is cut in
    blocks which are verified pair by pair as matrix products: links are counted inside
    the task and only counts and one edge per vector leave it, so a dense group costs no
    rows per pair. Equal vectors are one entry with a count. At most 64 pivots.

    Vectors that are null, empty, zero or not finite, or have no label, link with
    nothing and are their own component; rows with a null vec_id likewise (component
    null, kept). Repeated rows count as other vectors. A vec_id should name one vector:
    rows that share one are one node of the link graph. Vectors of different lengths do not
    link; each length has pivots of its own. An empty table gives no rows; other columns are ignored.
    """
    if pivots > 64:
        raise ValueError("a pivot set is a 64-bit mask")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    rows = rows.withColumn("ok", usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    rows = rows.withColumns({"h1": F.xxhash64("label", "embedding"), "h2": F.xxhash64(F.lit(1), "label", "embedding")})
    one = saved(
        rows.where("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("label").cast("string").alias("label"), F.first("embedding").alias("embedding")),
        "vectors",
    )
    found = None
    for d in lengths(one):
        part = one.where(F.size("embedding") == d).select("label", "node", "copies", "embedding")
        more = _links(part, choose_pivots(part.withColumnRenamed("node", "vec_id"), pivots), least, k, shared, block)
        found = more if found is None else found.unionByName(more)
    if found is None:
        alone = [F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")]
        return rows.select("vec_id", *alone)
    found = saved(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reach = components(found, "node", "root").withColumnRenamed("id", "node")
    classes = one.select("h1", "h2", "node", "copies").join(links, "node", "left").join(reach, "node", "left")
    out = rows.select("vec_id", "h1", "h2", "ok").join(classes.withColumn("ok", F.lit(True)), ["h1", "h2", "ok"], "left")
    component = F.coalesce("component", "node", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _files(prefix: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pivot the rows that hold it in their prefix, and at which place."""
    order = np.argsort(prefix.ravel(), kind="stable")
    ends = np.cumsum(np.bincount(prefix.ravel(), minlength=n))[:-1]
    row, place = np.divmod(order, prefix.shape[1])
    return list(zip(np.split(row, ends), np.split(place.astype(np.int32), ends)))


def _search(pivots: np.ndarray, k: int, top: int, share: float, scale: float, at_once: int = 512):
    """Blocks of rows streamed past one chunk of queries, which keeps the best ``top`` so far:
    inverted files over the block's permutations, footrule ranks, then exact products."""
    depth = min(k, len(pivots))

    def ranked(q: np.ndarray, own: np.ndarray, probes: list, x: np.ndarray, ids: np.ndarray, held: list) -> Iterator[tuple]:
        # the footrule counts a pivot outside a prefix at place ``depth``; what both prefixes hold brings it down
        near = np.zeros((len(q), len(x)), np.int32)
        for (i, r), (j, place) in zip(probes, held):
            if len(i) and len(j):
                near[np.ix_(i, j)] += 2 * (depth - np.maximum(r[:, None], place[None, :]))
        near[own[:, None] == ids[None, :]] = -1
        keep = min(len(x), max(4 * top, int(np.ceil(share * len(x)))))
        best = np.argpartition(-near, keep - 1, axis=1)[:, :keep] if keep < len(x) else np.tile(np.arange(len(x)), (len(q), 1))
        for at in range(0, len(q), 64):
            part = slice(at, at + 64)
            score = np.einsum("qd,qrd->qr", q[part], x[best[part]])
            score[np.take_along_axis(near[part], best[part], 1) < 0] = -np.inf
            yield part, score, ids[best[part]]

    def told(own: np.ndarray, score: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        fine = score > -np.inf
        return pa.RecordBatch.from_pydict({"query_id": np.repeat(own, fine.sum(1)), "vec_id": found[fine], "score": score[fine]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for (*task, block), t in groups(batches, ["chunk", "stripe", "block"]):
            if now != task:
                yield from (told(own, score, found) for _, own, _, score, found in parts)
                now, parts = task, []
            v, ids = matrix(t.column("embedding")), np.asarray(t.column("vec_id").combine_chunks())
            if block < 0:
                for at in range(0, len(v), at_once):
                    q = v[at : at + at_once]
                    flat = np.column_stack([q / np.linalg.norm(q, axis=1)[:, None], np.zeros(len(q))])
                    score, found = np.full((len(q), top), -np.inf), np.zeros((len(q), top), np.int64)
                    parts.append((q, ids[at : at + at_once], _files(_prefix(flat, pivots, k), len(pivots)), score, found))
                continue
            if not parts:
                continue
            # one more dimension makes all rows equally long, so that the nearest direction is the largest product
            lift = np.sqrt(np.maximum(scale**2 - (v * v).sum(1), 0))
            held = _files(_prefix(np.column_stack([v, lift]) / scale, pivots, k), len(pivots))
            for q, own, probes, score, found in parts:
                for part, new, who in ranked(q, own, probes, v, ids, held):
                    new, who = np.concatenate([score[part], new], axis=1), np.concatenate([found[part], who], axis=1)
                    order = np.lexsort((who, -new), axis=1)[:, :top]
                    score[part], found[part] = np.take_along_axis(new, order, 1), np.take_along_axis(who, order, 1)
        yield from (told(own, score, found) for _, own, _, score, found in parts)

    return run


def nearest(
    vectors: DataFrame, is_query: Column, top: int = 20, pivots: int = 256, k: int = 64, share: float = 0.25, rows_each: int = 1024, queries_each: int = 4096, stripes: int = 32
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``top`` largest inner products of each query.

    Rows are dealt over ``stripes`` by a hash of their id, the queries over chunks of about
    ``queries_each``, and each pair of them is a group. It holds its queries and streams the
    stripe past them in blocks of about ``rows_each``. There a row is represented by its ``k``
    nearest pivots in order and posted in their inverted files; a query adds up the
    footrule distance to the rows on the files of its own nearest pivots, the ``share`` of the
    block nearest by that is reranked by exact products, and the best ``top`` of the stripe
    leave the group: ``stripes`` times ``top`` rows a query, however many rows there are.
    Groups grow in number with the queries and in length with the rows, memory with neither.
    Every row is indexed; only the pivots come from a bounded sample.
    Shorter vectors are lifted by one dimension, so that the direction nearest to the
    query is the largest product.

    Vectors that are null, empty, zero or not finite and rows without vec_id take no part; a query's
    neighbours have its length, and each length has pivots of its own. Rows that repeat id and vector are one
    row; another vector under the query's id is not its neighbour. Ties go to the
    smaller vec_id; an empty table gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).distinct()
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = None
    for d in lengths(rows):
        more = _found(rows.where(F.size("embedding") == d), is_query, top, pivots, k, share, rows_each, queries_each, stripes)
        found = more if found is None else found.unionByName(more)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _found(rows: DataFrame, is_query: Column, top: int, pivots: int, k: int, share: float, rows_each: int, queries_each: int, stripes: int) -> DataFrame:
    """The best of every stripe for vectors of one length."""
    chosen = choose_pivots(rows, pivots)
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    about = rows.agg(F.count("*").alias("n"), F.sum(F.when(is_query, 1).otherwise(0)).alias("q"), F.max(square).alias("m")).first()
    blocks, chunks = max(1, -(-about["n"] // (rows_each * stripes))), max(1, -(-(about["q"] or 0) // queries_each))
    scale = float(np.sqrt(about["m"] or 1.0))
    lifted = np.column_stack([chosen, np.zeros(len(chosen))])
    of = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.withColumns({"stripe": of(stripes, 1), "block": of(blocks, 3)}).withColumn("chunk", every(chunks))
    asked = rows.where(is_query).withColumns({"chunk": of(chunks, 2), "block": F.lit(-1)}).withColumn("stripe", every(stripes))
    key = ["chunk", "stripe"]
    dealt = held.unionByName(asked).repartition(*key).sortWithinPartitions(*key, "block")
    return dealt.mapInArrow(_search(lifted, k, top, share, scale), "query_id long, vec_id long, score double")


#: The rows of the query ``op2``: all pairs of one label, and the links followed until nothing new is reached.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: c::DOUBLE) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), u AS (
  SELECT *, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS size FROM v WHERE len(list_filter(x, lambda c: c <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2])) / (a.size * b.size) >= 0.93
), reach AS (
  SELECT a AS id, a AS c FROM links UNION SELECT links.a, reach.c FROM links JOIN reach ON links.b = reach.id
), lowest AS (SELECT id, min(c) AS c FROM reach GROUP BY id),
degree AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) IS NOT DISTINCT FROM vec_id AS kept
FROM embeddings LEFT JOIN lowest ON lowest.id = vec_id LEFT JOIN degree ON degree.id = vec_id
"""
