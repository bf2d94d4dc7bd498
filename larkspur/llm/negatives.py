"""Hard negatives by an inverted multi-index over whole-number vectors: exact, with certified stops."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import groups, saved
from larkspur.llm.pivots import matrix
from larkspur.llm.whitening import finite, whole

LAST = (1 << 62) - 1
EXACT = 2**53  # products of whole numbers are exact doubles below this


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products of the rows of ``a`` with those of ``b``."""
    big = (np.abs(a).max(initial=0) + 1.0) * (np.abs(b).max(initial=0) + 1.0) * a.shape[-1]
    if big < EXACT:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Codebooks:
    """Two half-space codebooks, learned from a bounded sample, with the radius of every code over all rows."""

    def __init__(self, sample: np.ndarray, codes: int, rounds: int = 8):
        self.cut = sample.shape[1] // 2
        self.books = [self._learned(h, codes, rounds) for h in self.halves(sample)]
        self.radii = [np.zeros(len(b)) for b in self.books]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut], x[:, self.cut :]

    @staticmethod
    def _learned(x: np.ndarray, codes: int, rounds: int) -> np.ndarray:
        u = np.unique(x, axis=0)
        book = u[np.linspace(0, len(u) - 1, min(codes, len(u))).astype(int)]
        for _ in range(rounds):
            code = Codebooks._nearest(x, book)
            held = np.bincount(code, minlength=len(book)) > 0
            book = np.array([x[code == i].mean(0) for i in np.flatnonzero(held)])
        return book

    @staticmethod
    def _nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
        return np.argmin((book * book).sum(1)[None, :] - 2 * (x @ book.T), axis=1)

    def coded(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half the code of each row and its distance to it."""
        out = []
        for h, book in zip(self.halves(x), self.books):
            code = self._nearest(h, book)
            out.append((code, np.linalg.norm(h - book[code], axis=1)))
        return out

    def bounds(self, q: np.ndarray) -> list[np.ndarray]:
        """Per half the most that a row under each code can add to the product with each ``q``. Rounded up a little, so that
        rounding cannot hide a row."""
        return [
            h @ book.T + (np.linalg.norm(h, axis=1)[:, None] * radius[None, :]) + 1e-9 * (np.linalg.norm(h, axis=1)[:, None] * np.linalg.norm(book, axis=1)[None, :] + 1)
            for h, book, radius in zip(self.halves(q), self.books, self.radii)
        ]


def cells_by_bound(u: np.ndarray, v: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Multi-sequence order: pairs (i, j) by falling u[i] + v[j], from a heap over the two sorted halves."""
    a, b = np.argsort(-u, kind="stable"), np.argsort(-v, kind="stable")
    heap = [(-(u[a[0]] + v[b[0]]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(u[a[i]] + v[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(u[a[i + 1]] + v[b[0]]), i + 1, 0))


class Wanted:
    """The ``top`` best rows with ``low <= score <= most`` so far; ``low`` rises to the last of them."""

    def __init__(self, top: int, low: int, most: int):
        self.top, self.low, self.most = top, low, most
        self.score, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def take(self, score: np.ndarray, row: np.ndarray) -> None:
        fine = (score >= self.low) & (score <= self.most)
        if fine.any():
            score, row = np.concatenate([self.score, score[fine]]), np.concatenate([self.row, row[fine]])
            order = np.lexsort((row, -score))[: self.top]
            self.score, self.row = score[order], row[order]
            if len(order) == self.top:
                self.low = max(self.low, int(self.score[-1]))


def _index(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4000):
                part = b.slice(at, 4000)
                x = matrix(part.column("x"))
                if len(x):
                    (i, r), (j, s) = books.coded(x)
                    cols = {c: part.column(c) for c in ("vec_id", "label", "x")}
                    yield pa.RecordBatch.from_pydict(cols | {"i": i.astype(np.int32), "j": j.astype(np.int32), "r": r, "s": s})

    return run


def _dealt(books: Codebooks, known: np.ndarray, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray, top: int, same: bool, chunks: int):
    """Anchors dealt to the stripes that hold a cell whose bound reaches what they need. What they need at least is
    taken from the scores of the sample's rows, which are rows like others."""
    stripes, starts = np.unique(cells[:, 2], return_index=True)

    def needed(score: np.ndarray, least: list, most: list) -> list:
        floors = []
        for low, high in zip(least, most):
            fine = score[(score >= low) & (score <= high)]
            floors.append(low if len(fine) < top else max(low, int(-np.partition(-fine, top - 1)[top - 1])))
        return floors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                q = matrix(part.column("x"))
                if not len(q):
                    continue
                own, label, who = (np.asarray(part.column(c)) for c in ("vec_id", "label", "who"))
                score = products(q, known)
                fits = ((labels[None, :] == label[:, None]) == same) & (ids[None, :] != own[:, None])
                windows = zip(part.column("least").to_pylist(), part.column("most").to_pylist())
                floors = [needed(score[k][fits[k]], *w) for k, w in enumerate(windows)]
                u, v = books.bounds(q)
                most = np.maximum.reduceat(u[:, cells[:, 0]] + v[:, cells[:, 1]], starts, axis=1)
                row, stripe = np.nonzero(most >= np.array([min(f, default=np.inf) for f in floors])[:, None])
                if len(row):
                    out = part.take(pa.array(row))
                    cols = {c: out.column(c) for c in ("vec_id", "label", "x", "who", "most")}
                    cols |= {"least": pa.array([floors[k] for k in row], pa.list_(pa.int64()))}
                    cols |= {"stripe": stripes[stripe].astype(np.int32), "chunk": (who[row] % chunks).astype(np.int32)}
                    yield pa.RecordBatch.from_pydict(cols)

    return run


def _visit(books: Codebooks, top: int, same: bool):
    """One stripe of the index and one chunk of its anchors: each anchor pops cells from its heap, scores
    their rows, and stops when no cell left can hold a row that it still needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in groups(batches, ["stripe", "chunk"]):
            kind = np.asarray(t.column("kind").combine_chunks())
            held, asked = t.filter(pa.array(kind == 1)), t.filter(pa.array(kind == 0))
            if not len(held) or not len(asked):
                continue
            column = lambda f, c: np.asarray(f.column(c).combine_chunks())
            i, j = column(held, "i").astype(int), column(held, "j").astype(int)
            order = np.lexsort((j, i))
            x, ids, labels = matrix(held.column("x"))[order], column(held, "vec_id")[order], column(held, "label")[order]
            places, starts = np.unique(np.stack([i, j], 1)[order], axis=0, return_index=True)
            cell = {(a, b): slice(s, e) for (a, b), s, e in zip(places.tolist(), starts, np.append(starts[1:], len(x)))}
            own, label, who = (column(asked, c) for c in ("vec_id", "label", "who"))
            windows = list(zip(asked.column("least").to_pylist(), asked.column("most").to_pylist()))
            q = matrix(asked.column("x"))
            codes = np.unique(places[:, 0]), np.unique(places[:, 1])
            u, v = (bound[:, code] for bound, code in zip(books.bounds(q), codes))
            out = {"who": [], "ask": [], "row_id": [], "score": []}
            for k in range(len(q)):
                wanted = [Wanted(top, *w) for w in zip(*windows[k])]
                for bound, a, b in cells_by_bound(u[k], v[k]):
                    if bound < min(w.low for w in wanted):
                        break
                    part = cell.get((int(codes[0][a]), int(codes[1][b])))
                    if part is not None:
                        fits = ((labels[part] == label[k]) == same) & (ids[part] != own[k])
                        score, row = products(q[k : k + 1], x[part])[0][fits], ids[part][fits]
                        for w in wanted:
                            w.take(score, row)
                for ask, w in enumerate(wanted):
                    out["who"] += [int(who[k])] * len(w.row)
                    out["ask"] += [ask] * len(w.row)
                    out["row_id"] += w.row.tolist()
                    out["score"] += w.score.tolist()
            yield pa.RecordBatch.from_pydict(out, pa.schema([(c, pa.int32() if c == "ask" else pa.int64()) for c in out]))

    return run


class MultiIndex:
    """Rows (vec_id, label, x) under the cells of two half-space codebooks, written once.

    The codebooks are learned from the ``sample`` rows with the smallest hash; every row is indexed. Codes grow with the
    root of the rows, to ``most_codes`` a half at most, which bounds the directory of cells. Neighbouring cells
    are dealt into stripes of about ``rows_each`` rows, a larger cell over several; a stripe is what a task holds.
    """

    def __init__(self, rows: DataFrame, sample: int = 2048, rows_each: int = 4096, cell_rows: int = 512, most_codes: int = 256):
        picked = rows.orderBy(F.xxhash64("vec_id", "label", "x"), "vec_id").limit(sample).collect()
        self.known = np.array([r["x"] for r in picked], np.float64)
        self.ids, self.labels = (np.array([r[c] for r in picked], np.int64) for c in ("vec_id", "label"))
        codes = min(most_codes, max(2, int(np.ceil(np.sqrt(rows.count() / cell_rows)))))
        self.books = Codebooks(self.known, codes)
        fields = "vec_id long, label long, x array<long>, i int, j int, r double, s double"
        self.rows = saved(rows.select("vec_id", "label", "x").mapInArrow(_index(self.books), fields), "multi-index")
        cells = self.rows.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("r").alias("r"), F.max("s").alias("s"))
        self.stripes, at, full = [], 0, 0
        for i, j, n, r, s in sorted(map(tuple, cells.collect())):  # at most most_codes squared
            self.books.radii[0][i] = max(self.books.radii[0][i], r)
            self.books.radii[1][j] = max(self.books.radii[1][j], s)
            if full and full + n > rows_each:
                at, full = at + 1, 0
            parts = -(-n // rows_each)
            self.stripes.append((i, j, at, parts))
            at, full = (at + parts, 0) if parts > 1 else (at, full + n)

    def best(self, asks: DataFrame, top: int, same: bool, asks_each: int = 4096) -> DataFrame:
        """``who``, ``ask``, ``row_id``, ``score``, ``rank``: for every window of every anchor (who, vec_id, label, x, least, most; the
        last two arrays with a number per window) the ``top`` rows of its own label (``same``) or of the others,
        best score first, ties to the smaller vec_id. ``ask`` counts an anchor's windows from 0."""
        chunks = max(1, -(-asks.count() // asks_each))
        stripes = self.rows.sparkSession.createDataFrame(self.stripes, "i int, j int, first int, parts int")
        held = self.rows.join(F.broadcast(stripes), ["i", "j"])  # a row per cell, at most most_codes squared
        held = held.withColumn("stripe", F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        held = held.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("kind", F.lit(1))
        cells = np.array([(i, j, at + k) for i, j, at, parts in self.stripes for k in range(parts)], np.int64)
        fields = "vec_id long, label long, x array<long>, who long, most array<long>, least array<long>, stripe int, chunk int"
        deal = _dealt(self.books, self.known, self.ids, self.labels, cells, top, same, chunks)
        sent = asks.select("who", "vec_id", "label", "x", "least", "most").mapInArrow(deal, fields).withColumn("kind", F.lit(0))
        key = ["stripe", "chunk"]
        both = held.drop("first", "parts", "r", "s").unionByName(sent, allowMissingColumns=True)
        both = both.repartition(*key).sortWithinPartitions(*key)
        found = both.mapInArrow(_visit(self.books, top, same), "who long, ask int, row_id long, score long")
        order = Window.partitionBy("who", "ask").orderBy(F.col("score").desc(), "row_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, top: int = 3, low: int = 50, high: int = 95, scale: int = 256, label: Column | None = None, **index
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become whole numbers floor(scale * c). Per anchor, the ``positives`` rows of its label with the largest inner product
    are its positives; per anchor and positive, the first ``top`` rows of other labels whose product is from ``low`` to ``high``
    percent of the positive's are its hard negatives, best first, ties to the smaller vec_id. ``label`` replaces the column label.

    Rows are found through an inverted multi-index (``MultiIndex``) whose cells a heap visits in the order of what a
    row in them could score at most; a search ends when no unvisited cell can change its result, so results are exact.
    A positive of negative product has an empty window.

    Rows with a null vec_id or label, a null or empty vector, one with null or non-finite components or of another length than
    the most frequent (ties: the longer) take no part. Rows equal in all of id, label and vector are one row; other rows under the
    anchor's own id are not its partners, and every row under an anchor's id is an anchor if they differ in label or vector.
    An empty table gives no rows; other columns are ignored. Products beyond 64 bits are not supported.
    """
    spark = vectors.sparkSession
    kind = F.col("label") if label is None else label
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), kind.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        fields = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], fields)
    rows = rows.where(F.size("v") == common["d"]).select("vec_id", "label", whole(F.col("v"), scale).alias("x"))
    rows = saved(rows.distinct(), "negatives-rows")
    found = MultiIndex(rows, **index)
    anchors = rows.where(is_anchor).select(F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(LAST)).alias("who"), "vec_id", "label", "x")
    anchors = saved(anchors, "anchors")
    every = [F.array(F.lit(s * LAST).cast("long")).alias(c) for s, c in ((-1, "least"), (1, "most"))]
    near = saved(found.best(anchors.select("*", *every), positives, True), "positives")
    near = near.where("score >= 0").select("who", "rank", F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # whole-number division: the score is not negative
    low_end, high_end = F.expr(f"(positive_score * {low} + 99) div 100"), F.expr(f"(positive_score * {high}) div 100")
    windows = near.groupBy("who").agg(F.sort_array(F.collect_list(F.struct("rank", low_end.alias("least"), high_end.alias("most")))).alias("w"))
    asks = anchors.join(windows, "who").select("who", "vec_id", "label", "x", F.col("w.least").alias("least"), F.col("w.most").alias("most"), F.col("w.rank").alias("ranks"))
    asks = saved(asks, "windows")
    far = found.best(asks, top, False).withColumnsRenamed({"row_id": "negative_id", "score": "negative_score", "rank": "place"})
    far = far.join(asks.select("who", F.col("vec_id").alias("anchor_id"), "ranks"), "who").withColumn("rank", F.col("ranks")[F.col("ask")])
    out = far.join(near, ["who", "rank"])
    return out.select("anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score")


#: The rows of the query ``op13``: floor of a float times 256, products of whole numbers, two ranked joins.
SQL = """
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS row_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, row_id)::INTEGER AS rank,
  row_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, row_id) <= 3
"""
