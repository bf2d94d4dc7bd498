"""Near-duplicate documents by DartMinHash: sparse weighted signatures, banded joining, exact check."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import components, groups, lean, saved, text_key

_WORD = re.compile(r"\w+")
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


class Shingles:
    """Hashes of all runs of ``n`` words of a text, in order; a shorter text is one run."""

    def __init__(self, n: int = 5, keep: int = 100_000):
        self.n, self.keep, self.known = n, keep, _WordHash()

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.known) > self.keep:
            self.known.clear()
        parts, text, at = [], text or "", 0
        while at < len(text):
            end = at + (1 << 20)
            while end < len(text) and (text[end].isalnum() or text[end] == "_"):
                end += 1
            found = _WORD.findall(text[at:end].lower())
            parts.append(np.fromiter(map(self.known.__getitem__, found), _U, len(found)))
            at = end
        words = np.concatenate(parts) if parts else np.zeros(0, _U)
        if not len(words):
            return words
        n = min(self.n, len(words))
        h = np.full(len(words) - n + 1, n, _U)
        for j in range(n):
            h = mix(h * _U(0x9E3779B97F4A7C15) + words[j : len(words) - n + 1 + j])
        return h


def bag(shingles: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of (shingle, how many times before): a bag as a set."""
    s = np.sort(shingles)
    if not len(s):
        return s
    new = np.append(True, s[1:] != s[:-1])
    first = np.flatnonzero(new)
    nth = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
    return np.sort(np.where(nth > 0, mix(s + nth.astype(_U) * _U(0xD1342543DE82EF95)), s))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0**-53


#: Steps of the Poisson distribution of mean 1, up to the count that 53 random bits can reach.
_POISSON = np.cumsum(np.exp(-1) / np.cumprod(np.append(1.0, np.arange(1, 18))))


def darts(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, reach: np.ndarray, k: int):
    """Darts that land in the regions of weighted elements, as (owner, coordinate, rank, name).

    Element e with weight w owns the strip [0, w) x [0, reach) of weight and rank. The
    plane of an element is cut in unit squares; a hash of (element, square) says how many
    darts it holds (Poisson, mean 1), where, and on which of ``k`` coordinates, whatever
    the document. So two documents see the same dart wherever their strips overlap.
    """
    across = np.ceil(weights).astype(np.int64)
    up = np.ceil(reach[owner]).astype(np.int64)
    squares = across * up
    of = np.repeat(np.arange(len(elements)), squares)
    nr = np.arange(len(of)) - np.repeat(np.cumsum(squares) - squares, squares)
    x, y = nr // up[of], nr % up[of]
    seed = mix(mix(elements[of] + x.astype(_U) * _U(0x9E3779B97F4A7C15)) + y.astype(_U) * _U(0xC2B2AE3D27D4EB4F))
    held = np.searchsorted(_POISSON, _uniform(seed), side="right")
    dart = np.repeat(np.arange(len(of)), held)
    nth = np.arange(len(dart)) - np.repeat(np.cumsum(held) - held, held)
    name = mix(seed[dart] + (nth.astype(_U) + _U(1)) * _U(0xA0761D6478BD642F))
    rank = y[dart] + _uniform(mix(name + _U(1)))
    place = x[dart] + _uniform(mix(name + _U(2)))
    of = of[dart]
    inside = (place < weights[of]) & (rank < reach[owner[of]])
    of, name, rank = of[inside], name[inside], rank[inside]
    return owner[of], (mix(name + _U(3)) % _U(k)).astype(np.int64), rank, name


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """Weighted min-hash signatures (documents x k): the earliest dart of each coordinate.

    The expected number of darts is the same, k ln k + 2k, whatever the weight of a
    document: heavy documents look at lower ranks only. One that leaves a coordinate
    without a dart looks twice as far. (elements, weights) must not be empty.
    """
    out = np.zeros((len(bags), k), _U)
    total = np.array([w.sum() for _, w in bags])
    reach, left = (k * np.log(k) + 2 * k) / total, np.arange(len(bags))
    while len(left):
        size = np.array([len(bags[i][0]) for i in left])
        owner = np.repeat(np.arange(len(left)), size)
        doc, at, rank, name = darts(
            np.concatenate([bags[i][0] for i in left]), np.concatenate([bags[i][1] for i in left]), owner, reach[left], k
        )
        late_first = np.argsort(-rank, kind="stable")
        got = np.zeros((len(left), k), _U)
        full = np.zeros((len(left), k), bool)
        got[doc[late_first], at[late_first]] = name[late_first]  # the last to be written is the earliest dart
        full[doc, at] = True
        out[left] = got
        left = left[~full.all(axis=1)]
        reach[left] *= 2
    return out


def _signed(bands: int, rows: int, words: int):
    """Documents to a byte per coordinate, hashes of the bytes of each band, and the size of the bag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, k = Shingles(words), bands * rows
        for b in batches:
            texts = b.column("text")
            at = 0
            while at < b.num_rows:
                keep, bags, sizes, n = [], [], [], 0
                while at < b.num_rows and n < 100_000:
                    s, c = np.unique(shingles(texts[at].as_py()), return_counts=True)
                    if len(s):
                        keep.append(at)
                        bags.append((s, c.astype(np.float64)))
                        sizes.append(int(c.sum()))
                        n += max(len(s), 8 * k)
                    at += 1
                if not keep:
                    continue
                low = (signatures(bags, k) & _U(0xFF)).astype(np.uint8)
                band = np.zeros((len(keep), bands), _U)
                for j in range(rows):
                    band = mix(band * _U(0x9E3779B97F4A7C15) + low[:, j::rows])
                rows_of = b.take(pa.array(keep))
                flat = band.view(np.int64).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands), pa.int32()), pa.array(flat))
                sketch = pa.array([x.tobytes() for x in low], pa.binary())
                cols = [rows_of.column(c) for c in ("h1", "h2", "doc_id")]
                names = ["h1", "h2", "doc_id", "bands", "sketch", "size"]
                yield pa.RecordBatch.from_arrays([*cols, lists, sketch, pa.array(sizes, pa.int64())], names=names)

    return run


def _bags(words: int, most: int = 1 << 14):
    """Texts to the bytes of their bags, in rows of at most ``most`` bytes: batches hold a number
    of rows, and so have a bounded size however long the texts are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                rows = []
                for node, t in zip(part.column("node").to_pylist(), part.column("text")):
                    held = bag(shingles(t.as_py())).tobytes()
                    rows += [(node, k, held[x : x + most]) for k, x in enumerate(range(0, len(held), most))]
                cols = list(zip(*rows)) or [(), (), ()]
                kinds = (pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["node", "nr", "bag"])

    return run


def _same(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether two bags have weighted Jaccard similarity ``least`` or more."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both) - 1e-9


def _similar(least: float):
    """Members against their centre, whose rows come first in its group; holds one centre and one member at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centre, member, held = None, None, None, []

        def settled() -> list[tuple[int, int]]:
            nonlocal now, centre
            if member is None:
                return []
            x = np.frombuffer(b"".join(held), _U)
            if member[2] == 0:
                now, centre = member[:2], x
            elif now == member[:2] and _same(centre, x, least):
                return [(member[3], member[0])]
            return []

        def told(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

        for b in batches:
            found = []
            for row, x in zip(zip(*[b.column(c).to_pylist() for c in ("centre", "part", "first", "node")]), b.column("bag")):
                if row != member:
                    found += settled()
                    member, held = row, []
                held.append(x.as_py())
            yield told(found)
        yield told(settled())

    return run


def _alike(least: float, k: int):
    """Share of equal sketch bytes that a pair of the wanted similarity falls short of once in a million."""
    p = least + (1 - least) / 256
    return p - 5 * (p * (1 - p) / k) ** 0.5


def _agreement():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            share = [
                float(np.mean(np.frombuffer(x.as_py(), np.uint8) == np.frombuffer(y.as_py(), np.uint8)))
                for x, y in zip(b.column("sketch_a"), b.column("sketch_b"))
            ]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(share, pa.float64())], names=["a", "b", "share"])

    return run


def _met(least: float, bands: int, rows: int):
    """Links that join the classes of one bucket (or of two of its blocks). Every pair of different classes
    whose sketches and sizes are near enough is verified on the whole bags, in the lowest band that
    the two share, unless links found before in this group join them already; so at most as many
    links leave as the group has members."""
    alike = _alike(least, bands * rows)

    def pairs(x, c, size, block, i, j, band) -> Iterator[tuple[int, int]]:
        own, other = np.flatnonzero(block == i), np.flatnonzero(block == j)
        share = np.zeros((len(own), len(other)))
        for at in range(0, len(own), 32):
            share[at : at + 32] = (x[own[at : at + 32], None] == x[None, other]).mean(axis=2)
        small, large = np.minimum(size[own][:, None], size[other]), np.maximum(size[own][:, None], size[other])
        share[(share < alike) | (c[own][:, None] == c[other]) | (small < least * large - 1e-6)] = 0
        a, b = np.nonzero(share)
        near, a, b = share[a, b], own[a], other[b]
        mine = np.concatenate([np.zeros(0, bool)] + [
            (x[a[at : at + 10_000]] == x[b[at : at + 10_000]]).reshape(-1, bands, rows).all(axis=2).argmax(axis=1) == band for at in range(0, len(a), 10_000)
        ])
        if i == j:
            mine &= a < b
        order = np.argsort(-near[mine], kind="stable")  # the likeliest links first
        return zip(a[mine][order].tolist(), b[mine][order].tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (band, _, i, j), t in groups(batches, ["band", "bucket", "i", "j"]):
            rows_of = np.asarray(t.column("node").combine_chunks())
            first = np.flatnonzero(np.append(True, rows_of[1:] != rows_of[:-1]))
            one = t.select(["node", "c", "size", "block", "sketch"]).take(pa.array(first))
            node, c, size, block = (np.asarray(one.column(k).combine_chunks()) for k in ("node", "c", "size", "block"))
            if (c == c[0]).all():
                continue
            x = np.frombuffer(b"".join(one.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
            parts, ends = t.column("bag").to_pylist(), [*first[1:].tolist(), len(rows_of)]
            bags = [np.frombuffer(b"".join(parts[k:e]), _U) for k, e in zip(first.tolist(), ends)]
            up = np.unique(c, return_inverse=True)[1].tolist()  # forest over the classes
            root = list(range(len(node)))

            def top(k: int) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            links = []
            for a, b in pairs(x, c, size, block, i, j, band):
                ra, rb = top(up[a]), top(up[b])
                if ra != rb and _same(bags[a], bags[b], least):
                    root[max(ra, rb)] = min(ra, rb)
                    links.append((node[a], node[b]))
            yield pa.RecordBatch.from_pydict({"a": pa.array([v[0] for v in links], pa.int64()), "b": pa.array([v[1] for v in links], pa.int64())})

    return run


def _starred(posted: DataFrame, one: DataFrame, bags: DataFrame, least: float, k: int, each: int = 1024) -> DataFrame:
    """Links (a, b) of the members of a bucket with its centre, the member of smallest hash."""
    first = F.min(F.struct(F.xxhash64("node"), F.col("node"))).alias("m")
    centres = posted.groupBy("band", "bucket").agg(first).select("band", "bucket", F.col("m.node").alias("centre"))
    pairs = posted.join(centres, ["band", "bucket"]).where("node != centre").select("node", "centre").distinct()
    sketches = one.select("node", "sketch")
    pairs = pairs.join(sketches.toDF("node", "sketch_a"), "node").join(sketches.toDF("centre", "sketch_b"), "centre")
    pairs = pairs.select(F.col("node").alias("a"), F.col("centre").alias("b"), "sketch_a", "sketch_b")
    close = pairs.mapInArrow(lean(_agreement()), "a long, b long, share double").where(F.col("share") >= _alike(least, k))
    close = saved(close.select(F.col("a").alias("node"), F.col("b").alias("centre")), "stars")
    parts = close.groupBy("centre").agg(F.ceil(F.count("*") / each).cast("int").alias("parts"))
    dealt = close.join(parts, "centre").select("centre", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), "node")
    heads = parts.select("centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("centre").alias("node"), F.lit(0).alias("first"))
    rows = dealt.withColumn("first", F.lit(1)).unionByName(heads).join(bags, "node")
    rows = rows.repartition("centre", "part").sortWithinPartitions("centre", "part", "first", "node", "nr")
    return rows.mapInArrow(lean(_similar(least)), "a long, b long")


def near_duplicate_classes(
    docs: DataFrame, least: float = 0.8, words: int = 5, bands: int = 24, rows: int = 5, block: int = 512, block_words: int = 4_000_000
) -> DataFrame:
    """(h1, h2, node, class_id): for every distinct text, its smallest doc_id and the smallest doc_id of its class.

    A document is the bag of its ``words``-word shingles (lower case, runs of word
    characters; a shorter text is one shingle), weighted by how often each occurs. Texts
    in a chain of weighted Jaccard similarities of ``least`` or more are a class.

    Equal texts are one entry before anything is joined. Documents whose sketches agree on
    all ``rows`` bytes of a band share a bucket. Pairs whose sketches or sizes are too far
    apart go out, the rest are verified on the whole bags, which are made once for the texts that share
    a bucket. First each bucket compares its members with one centre (the member of smallest hash); that joins
    most of a family at a pair per member. Then buckets that still hold several classes compare every pair of different
    classes, and only links that join classes leave: their number is linear in a family's size. A bucket of
    more than ``block`` members or ``block_words`` shingles is cut in blocks, which meet pair by pair. So no pair
    that shares a bucket is left out unless its class is known already. A pair at 0.8 shares no bucket with
    probability below 1e-4.

    Texts without a word are classes of their own.
    """
    rows_in = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows_in.select(*text_key(), "doc_id", "text")
    signed = keyed.mapInArrow(lean(_signed(bands, rows, words)), "h1 long, h2 long, doc_id long, bands array<bigint>, sketch binary, size long")
    # a text is named by a number of its own, fixed by the writing, as a doc_id may be that of several texts
    one = saved(
        signed.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("size").alias("size")).withColumn("node", F.monotonically_increasing_id()),
        "signatures",
    )
    posted = one.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = posted.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    posted = saved(posted.join(shared, ["band", "bucket"], "left_semi"), "buckets")
    # the bags of texts that share a bucket, made once
    wanted = posted.select("node").distinct().join(one.select("node", "h1", "h2", F.col("doc").alias("doc_id")), "node")
    texts = keyed.join(wanted, ["h1", "h2", "doc_id"]).groupBy("h1", "h2", "doc_id", "node").agg(F.first("text").alias("text"))
    bags = saved(texts.select("node", "text").mapInArrow(lean(_bags(words)), "node long, nr int, bag binary"), "bags")
    links = saved(_starred(posted, one, bags, least, bands * rows), "links")
    reach = components(links).select(F.col("id").alias("node"), "component")
    members = posted.join(reach, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    sizes = one.select("node", "size")
    mixed = members.join(sizes, "node").groupBy("band", "bucket")
    mixed = mixed.agg(F.count("*").alias("n"), F.sum("size").alias("held"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    count = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("held") / block_words)).cast("int")
    dealt = members.join(mixed.select("band", "bucket", count.alias("n")), ["band", "bucket"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    dealt = dealt.withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")}).drop("o", "n")
    dealt = dealt.join(one.select("node", "sketch", "size").join(bags, "node"), "node")
    key = ["band", "bucket", "i", "j"]
    dealt = dealt.repartition(*key).sortWithinPartitions(*key, "node", "nr")
    more = dealt.mapInArrow(lean(_met(least, bands, rows)), "a long, b long")
    reach = components(saved(links.unionByName(more), "links"))
    reach = reach.withColumnRenamed("id", "node").join(one.select("node", "doc"), "node")
    classes = reach.join(reach.groupBy("component").agg(F.min("doc").alias("class_id")), "component").select("node", "class_id")
    return one.join(classes, "node", "left").select("h1", "h2", F.col("doc").alias("node"), F.coalesce("class_id", "doc").alias("class_id"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """All rows and columns of ``docs`` with ``class_id`` (smallest doc_id of the class) and ``kept``.

    One document of each class is kept, the one with the smallest doc_id; of rows that
    repeat a doc_id all are. Rows with a null doc_id have no class and are kept; null and
    empty texts and texts without a word are classes of their own. An empty table gives
    no rows; columns of the new names are replaced, and columns named h1 or h2 are not
    returned.
    """
    docs = docs.drop("class_id", "kept", "h1", "h2")
    classes = near_duplicate_classes(docs, **options).select("h1", "h2", "class_id")
    out = docs.select("*", *text_key()).join(classes, ["h1", "h2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", F.col("doc_id").cast("long")))
    out = out.withColumn("class_id", own)
    return out.withColumn("kept", F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True))).drop("h1", "h2")
