"""Archives, whitening and hard negatives against brute force, on odd rows and on damaged files."""

import base64
import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import negatives, queries, warc, whitening
from larkspur.session import work_path

PAGES = "page_id long, url string, html string, digest string, record_type string, copies int"


def archive(spark, parts, name):
    """A folder with one file that holds the given bytes."""
    disk, folder = warc.opened(work_path(spark, name))
    disk.create_dir(folder, recursive=True)
    data = b"".join(parts)
    with disk.open_output_stream(f"{folder}/a.warc.gz", compression=None) as out:
        out.write(data)
    return spark.createDataFrame([(f"{folder}/a.warc.gz", len(data))], "file string, size long")


def member(i, body):
    return warc._record("response", [("WARC-Page-ID", i), ("Content-Type", "text/html")], body)


def stored(one):
    """The member with its content uncompressed, so that an archive inside it shows."""
    out = zlib.compressobj(0, zlib.DEFLATED, 31)
    return out.compress(gzip.decompress(one)) + out.flush()


def test_archives_of_odd_pages(spark):
    rows = [
        (3, "http://a/x", "same", "d", "t", 1),
        (1, "http://a/\r\nWARC-Type: fake", "same", "d", "t", 1),
        (1, "http://a/\r\nWARC-Type: fake", "same", "d", "t", 1),
        (None, None, "same", None, None, None),
        (None, "u", "é\r\n\r\n" * 50_000, None, None, None),
        (7, "u", None, None, None, None),
        (8, "u", "", None, None, None),
        (9, None, "one", None, None, None),
    ]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    got = {(r.page_id, r.record_type, r.refers_to): r for r in warc.digest(pages).collect()}
    assert set(got) == {(1, "response", None), (1, "revisit", 1), (3, "revisit", 1), (None, "revisit", 1), (None, "response", None), (7, "response", None), (8, "revisit", 7), (9, "response", None)}
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert got[3, "revisit", 1].payload_digest == sha("same") and got[3, "revisit", 1].payload_bytes == 4
    assert got[8, "revisit", 7].payload_bytes == 0 and got[7, "response", None].payload_digest == sha("")
    assert got[None, "response", None].payload_bytes == 300_000
    kinds = [r.record_type for r in warc.digest(pages, least=4).collect()]
    assert sorted(kinds).count("revisit") == 3  # the short payloads are all responses
    assert warc.digest(pages.where("false")).count() == 0


@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_ranges_of_any_length_give_the_same_records(spark, split):
    draw = random.Random(5)
    inner = member(99, b"inner")  # incompressible payloads that are archives themselves
    bodies = [bytes(draw.randrange(256) for _ in range(k)) + (inner * 3 if k % 2 else b"") for k in (0, 5, 301, 2001, 40, 3, 1507)]
    parts = [stored(member(i, b)) for i, b in enumerate(bodies)]
    assert any(inner in p for p in parts)
    got = warc.read(archive(spark, parts, "nested"), split=split).orderBy("offset").collect()
    assert [(r.page_id, bytes(r.payload)) for r in got] == list(enumerate(bodies))
    assert [r.offset for r in got] == [sum(map(len, parts[:i])) for i in range(len(parts))]


def test_damaged_and_foreign_bytes_are_passed_over(spark):
    good = [member(i, b"x" * 500) for i in range(4)]
    broken = bytearray(member(9, random.Random(1).randbytes(600)))
    broken[len(broken) // 2] ^= 255
    parts = [good[0], b"\x1f\x8b\x08junk", gzip.compress(b"not a record"), good[1], bytes(broken), good[2], good[3], member(8, b"cut off")[:-9]]
    for split in (150, 1 << 20):
        got = warc.read(archive(spark, parts, "damaged"), split=split, payload=False).orderBy("offset").collect()
        assert [r.page_id for r in got if r.record_type == "response"] == [0, 1, 2, 3]
        assert [r.record_type for r in got].count("damaged") == 2
    assert warc.read(spark.createDataFrame([(None, 5), ("/none", 0)], "file string, size long")).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, n int, x string, h1 int, component int, score int"


def odd_vectors(spark, d=6, n=400):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, d)) * np.arange(1, d + 1)
    x[100:200] = x[7]  # a hot vector
    rows = [(i, [float(c) for c in v], int(i % 3), 1, "x", 1, 1, 1) for i, v in enumerate(np.float32(x))]
    rows += [rows[0], rows[0], (None, rows[3][1], 1, *rows[0][3:]), (50, rows[8][1], 1, *rows[0][3:])]
    rows += [(900 + i, v, 1, 1, "x", 1, 1, 1) for i, v in enumerate([None, [], [None] * d, [float("nan")] * d, [float("inf")] * d, [1.0], [0.0] * d])]
    rows += [(950, rows[1][1], None, 1, "x", 1, 1, 1)]
    return spark.createDataFrame(rows, VECTORS).repartition(3), rows


def usable(rows, d=6):
    return [r for r in rows if r[1] and len(r[1]) == d and all(c is not None and np.isfinite(c) for c in r[1])]


def test_whitening_against_numpy(spark):
    table, rows = odd_vectors(spark)
    got = whitening.whiten(table, rows_each=32, blocks_each=2).collect()
    kept = usable(rows)
    x = np.floor(256 * np.array([r[1] for r in kept], np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    values, parts = np.linalg.eigh(np.cov(fit.T, bias=True))
    white = (x - s / n) @ parts[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    told = {}
    for r in got:
        told.setdefault((r.component, r.vec_id), []).append(r)
        assert r.explained == pytest.approx(values[::-1][r.component - 1] / values.sum(), rel=1e-9)
    for k in range(4):
        sign = np.sign(sum(told[k + 1, r[0]][0].whitened * white[i, k] for i, r in enumerate(kept) if r[0] not in (50, None)))
        for i, r in enumerate(kept):
            near = [t for t in told[k + 1, r[0]] if abs(t.whitened - sign * white[i, k]) < 1e-8]
            assert near and near[0].deviation == int(((n * x[i] - s) ** 2).sum())
    assert whitening.whiten(table.where("vec_id BETWEEN 100 AND 199")).count() == 0  # nothing varies
    assert whitening.whiten(table.where("false")).count() == 0
    flat = table.withColumn("embedding", F.concat("embedding", F.array(F.lit(1.0).cast("float"))))
    assert whitening.whiten(flat.where("vec_id < 400"), top=9).select("component").distinct().count() == 6


def test_whitened_covariance_is_the_identity(spark, sf_dir):
    out = queries.QUERIES["op12_block_whitening"](spark, sf_dir)
    wide = out.groupBy("vec_id").pivot("component", [1, 2, 3, 4]).agg(F.first("whitened")).toPandas().drop(columns="vec_id")
    assert np.abs(np.cov(wide.to_numpy().T, bias=True) - np.eye(4)).max() < 1e-9  # no vector repeats in this table


def brute_negatives(rows):
    seen = sorted({(r[0], r[2], tuple(int(np.floor(256 * np.float64(c))) for c in r[1])) for r in usable(rows) if r[0] is not None and r[2] is not None})
    out = []
    for i, label, x in (r for r in seen if r[0] % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for j, other, y in seen if j != i)
        for s, j, _ in [t for t in scored if t[2] == label][:5]:
            fits = [(t[1], -t[0]) for t in scored if t[2] != label and -50 * s <= -100 * t[0] <= -95 * s]
            out += [(i, j, k + 1, other, -s, score) for k, (other, score) in enumerate(fits[:3])]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"sample": 40, "rows_each": 30, "cell_rows": 8}])
def test_negatives_against_brute_force(spark, sizes):
    table, rows = odd_vectors(spark)
    got = negatives.mine(table, F.col("vec_id") % 50 == 0, **sizes)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)
    assert negatives.mine(table.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert negatives.mine(table.where("vec_id % 50 <> 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_cells_come_in_falling_order():
    rng = np.random.default_rng(2)
    u, v = rng.normal(size=9), rng.normal(size=5)
    got = list(negatives.cells_by_bound(u, v))
    assert len({(i, j) for _, i, j in got}) == 45
    assert [b for b, _, _ in got] == sorted((float(a + b) for a in u for b in v), reverse=True)
    huge = np.array([[2.0**40, 3.0]])
    assert negatives.products(huge, huge)[0, 0] == np.int64(0) + (2**80 + 9) % 2**64  # beyond 64 bits it wraps; stated


def test_search_stops_before_all_cells():
    """On clustered rows most cells are never scored."""
    rng = np.random.default_rng(3)
    x = np.floor(256 * np.repeat(rng.normal(size=(20, 8)) * 4, 50, axis=0) + rng.normal(size=(1000, 8)) * 8)
    books = negatives.Codebooks(x[::5], 20)
    for half, (code, far) in enumerate(books.coded(x)):
        np.maximum.at(books.radii[half], code, far)
    code = [c for c, _ in books.coded(x)]
    u, v = books.bounds(x[:1])
    want, visited = negatives.Wanted(5, -(2**62), 2**62), 0
    for bound, i, j in negatives.cells_by_bound(u[0], v[0]):
        if bound < want.low:
            break
        rows = np.flatnonzero((code[0] == i) & (code[1] == j))
        visited += len(rows)
        want.take(negatives.products(x[:1], x[rows])[0], rows)
    assert want.score.tolist() == sorted(negatives.products(x[:1], x)[0].tolist(), reverse=True)[:5]
    assert visited < 300
