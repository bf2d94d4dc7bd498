"""Suffix-array dedup: bytes covered by a string that occurs again anywhere are removed."""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import give_back, lean, saved, text_key
from larkspur.llm.darts import mix
from larkspur.llm.induced import Scratch, suffixes

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CHUNK = 1 << 19  # bytes that are cut at once: some ten arrays of eight bytes for each, best in a core's cache
_BYTES = mix(np.arange(1, 257).astype(_U) * _U(0xD1342543DE82EF95))


def _among(x: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``held``."""
    if not len(held):
        return np.zeros(len(x), bool)
    return held[np.minimum(np.searchsorted(held, x), len(held) - 1)] == x


@lru_cache(maxsize=1)
def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.empty((2, n + 1), _U)
    out[:, 0], out[:, 1:] = 1, np.array([[_ODD], [_BACK]])
    np.multiply.accumulate(out, axis=1, out=out)
    return out[0], out[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd number and of its inverse, up to the n-th; those of a chunk are kept."""
    power, back = _powers_to(max(n, 2 * CHUNK + 4096))
    return power[: n + 1], back[: n + 1]


def anchored(buffer: np.ndarray, doc: np.ndarray, need: int, gram: int, hot: np.ndarray = np.zeros(0, _U), cuts: int = 0):
    """Cuts the string starts of some documents into stretches with one anchor each.

    ``buffer`` holds the bytes of documents one after another, ``doc`` which one each byte
    is of. The anchor of a string of ``need`` bytes is its ``gram`` bytes of least hash, the
    first of equal ones. That depends on the string alone, so equal strings have equal
    anchors at equal places. Returns for each stretch of neighbouring starts with the
    same anchor: hash of the anchor, hash of all bytes the strings cover, first start,
    number of starts and the hash that it was cut from (0 for none).

    A stretch whose hash is in ``hot`` (sorted) is cut in two by how far its strings start
    before the anchor, and each half goes under the hash of the bytes that all strings of
    that half have, around the anchor; again and again while that is hot. The last halves
    are single strings under the hash of all their bytes. All others are cut ``cuts`` times in the same way.
    """
    n = len(buffer)
    if n < need:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none.astype(_U), none, none, none.astype(_U)
    power, back = _powers(n)
    sums = np.append(_U(0), np.cumsum(_BYTES[buffer] * power[:-1], dtype=_U))
    grams = mix((sums[gram:] - sums[:-gram]) * back[: n - gram + 1])
    place = np.arange(len(grams)).astype(_U)
    least, width = grams >> _U(24) << _U(24) | place, 1
    wide = need - gram + 1
    while 2 * width <= wide:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < wide:
        least = np.minimum(least[: len(least) - (wide - width)], least[wide - width :])
    anchor = (least & _U(0xFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(doc[: n - need + 1] == doc[need - 1 :])
    if not len(starts):
        return anchored(buffer[:0], doc[:0], need, gram)
    a = anchor[starts]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + 1)))
    span = np.diff(np.append(first, len(starts)))
    at, place = starts[first], a[first]
    key, parent, level = grams[place], np.zeros(len(at), _U), 0
    many = _among(key, hot) | (cuts > 0)
    while many.any() and level < (need - gram).bit_length():
        level += 1
        step = 1 << ((need - gram).bit_length() - level)
        i, rest = np.flatnonzero(many), ~many
        most, least_ = place[i] - at[i], place[i] - at[i] - span[i] + 1  # how far the anchor is from the first and last start
        pieces = most // step - least_ // step + 1
        of = np.repeat(np.arange(len(i)), pieces)
        cell = (most // step)[of] - (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        here = place[i][of]
        far, near = np.minimum(cell * step + step - 1, most[of]), np.maximum(cell * step, least_[of])
        x, y = here - cell * step, here - np.minimum(cell * step + step - 1, need - gram) + need
        core = mix(mix((sums[y] - sums[x]) * back[x] + _U(level)) + cell.astype(_U) * _ODD)
        many = np.append(np.zeros(int(rest.sum()), bool), _among(core, hot) | (level < cuts))
        parent = np.append(parent[rest], key[i][of])
        key, place = np.append(key[rest], core), np.append(place[rest], here)
        at, span = np.append(at[rest], here - far), np.append(span[rest], far - near + 1)
    whole = mix((sums[at + span + need - 1] - sums[at]) * back[at] + span.astype(_U))
    return key, whole, at, span, parent


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, the form in which they are shuffled."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        body = pa.array([press((t.as_py() or "").encode()) for t in b.column("text")], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("h1"), b.column("h2"), body], names=["h1", "h2", "body"])


def _reader():
    import zstandard

    return zstandard.ZstdDecompressor().decompress


def _stretches(need: int, gram: int, hot: np.ndarray, chunk: int = CHUNK):
    """Texts to rows (anchor, whole, text key, start, span)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(parts):
            buffer = np.concatenate([x for x, _, _ in parts])
            number = np.repeat(np.arange(len(parts)), [len(x) for x, _, _ in parts])
            begin = np.cumsum([0] + [len(x) for x, _, _ in parts])[:-1]
            anchor, whole, at, span, _ = anchored(buffer, number, need, gram, hot)
            of = number[at]
            key = np.array([k for _, k, _ in parts], np.int64).reshape(-1, 2)[of]
            offset = np.array([o for _, _, o in parts], np.int64)
            cols = [anchor.view(np.int64), whole.view(np.int64), key[:, 0], key[:, 1], at - begin[of] + offset[of], span]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["anchor", "whole", "h1", "h2", "start", "span"])

        parts, n, read = [], 0, _reader()
        for b in batches:
            keys = zip(b.column("h1").to_pylist(), b.column("h2").to_pylist())
            for key, body in zip(keys, b.column("body")):
                body = body.as_py()
                x = np.frombuffer(body.encode() if isinstance(body, str) else read(body), np.uint8)
                # a long text goes in parts that overlap by what one string needs beyond its start
                for o in range(0, max(1, len(x) - need + 1), chunk):
                    parts.append((x[o : o + chunk + need - 1], key, o))
                    n += len(parts[-1][0])
                    if n >= chunk:
                        yield close(parts)
                        parts, n = [], 0
        if parts:
            yield close(parts)

    return run


def _cut(need: int, shards: int, most: int = 16 << 20):
    """Texts with their stretches to the bytes of the stretches: per shard of anchors one
    compressed lot, in which equal stretches of a task are one with a number of copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press, read = zstandard.ZstdCompressor(level=3).compress, _reader()
        held: dict[tuple, list] = {}
        n = 0

        def flush():
            lots: dict[int, list] = {}
            for (a, w), v in held.items():
                lots.setdefault(a % shards, []).append((a, w, v))
            held.clear()
            lots_of = [press(pickle.dumps(rows, 5)) for rows in lots.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(lots), pa.int32()), pa.array(lots_of, pa.binary())], names=["shard", "lot"])

        for b in batches:
            parts = b.column("parts")
            edge, cols = parts.offsets.to_pylist(), [parts.values.field(c) for c in ("anchor", "whole", "start", "span")]
            for i in range(b.num_rows):
                if edge[i] == edge[i + 1]:
                    continue
                text = read(b.column("body")[i].as_py())
                copies = b.column("copies")[i].as_py()
                for a, w, start, span in zip(*(c.slice(edge[i], edge[i + 1] - edge[i]).to_pylist() for c in cols)):
                    if (a, w) in held:
                        held[a, w][1] += copies
                    else:
                        x = text[start : start + span + need - 1]
                        held[a, w] = [span, copies, x]
                        n += len(x)
                if n >= most:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    return run


def met(parts: list[tuple], need: int, gram: int, cuts: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the stretches (span, copies, bytes) of a shard may repeat one another: number of the stretch, first
    start in it and number of starts, in order.

    Stretches of one anchor, as texts, have that anchor again. They are cut by more of the content around
    it; pieces whose content is there once cannot repeat and need no sorting, and neighbouring others stay one piece.
    """
    size = np.array([len(x) for _, _, x in parts])
    ends = np.cumsum(size)
    lots, at = [], 0
    while at < len(parts):  # a chunk at a time
        before = ends[at] - size[at]
        to = max(at + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
        buffer = np.frombuffer(b"".join([x for _, _, x in parts[at:to]]), np.uint8)
        key, _, begin, span, _ = anchored(buffer, np.repeat(np.arange(to - at), size[at:to]), need, gram, cuts=cuts)
        lots.append((key, begin + before, span))
        at = to
    key, at, span = (np.concatenate(x) for x in zip(*lots))
    _, of, n = np.unique(key, return_inverse=True, return_counts=True)
    twice = n[of] > 1
    at, span = at[twice], span[twice]
    order = np.argsort(at)
    at, span = at[order], span[order]
    of = np.searchsorted(ends, at, side="right")
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + span[:-1]) | (of[1:] != of[:-1]))[: len(at)])
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return of[first], at[first] - (ends - size)[of[first]], at[last] + span[last] - at[first]


def met_again(parts: list[tuple], need: int, gram: int, scratch: Scratch) -> list[np.ndarray]:
    """``repeated_starts`` of all stretches, of which only what may repeat is sorted."""
    out = [np.full(span, copies > 1) for span, copies, _ in parts]
    found = [x.tolist() for x in met(parts, need, gram)]
    pieces = [(n, 1, parts[i][2][at : at + n + need - 1]) for i, at, n in zip(*found)]
    if pieces:
        for i, at, n, again in zip(*found, repeated_starts(pieces, need, scratch)):
            out[i][at : at + n] |= again
    return out


def repeated_starts(parts: list[tuple], need: int, scratch: Scratch) -> list[np.ndarray]:
    """For stretches (span, copies, bytes) of a shard, which string starts occur again.

    The bytes of all stretches, with a mark after each, are sorted by their suffixes.
    A start occurs again if its suffix shares ``need`` bytes with a neighbour in that order,
    or if its stretch stands for several copies.
    """
    joined = np.frombuffer(b"\0".join([x for _, _, x in parts]) + b"\0\0", np.uint8)
    t = joined.astype(np.uint16) + 2
    size = np.array([len(x) + 1 for _, _, x in parts])
    ends = np.cumsum(size)
    t[ends - 1], t[-1] = 1, 0
    order, common = suffixes(t, scratch, cap=need)
    again = np.zeros(len(t), bool)
    same = np.asarray(common) >= need  # a mark within the first bytes ends all strings that reach it
    again[order[same]] = True
    again[order[:-1][same[1:]]] = True
    out = []
    for (span, copies, _), end, n in zip(parts, ends.tolist(), size.tolist()):
        out.append(np.ones(span, bool) if copies > 1 else again[end - n : end - n + span])
    return out


def _sorted(need: int, gram: int, memory: int, text_each: int):
    """A partition's stretches to (anchor, whole, runs of repeated starts). Stretches with one
    anchor stay together; beyond ``text_each`` bytes they wait in unnamed files by anchor."""
    files_n = 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: list = [None] * files_n
        read = _reader()
        sizes = [0] * files_n
        held: dict[tuple, list] = {}
        n = 0

        def spill():
            nonlocal n
            by_file: dict[int, list] = {}
            for (a, w), v in held.items():
                by_file.setdefault((a >> 20) % files_n, []).append((a, w, v))
            for k, rows in by_file.items():
                files[k] = files[k] or tempfile.TemporaryFile()
                pickle.dump(rows, files[k])
                sizes[k] += sum(len(v[2]) for _, _, v in rows)
            held.clear()
            n = 0

        def put(a, w, v):
            nonlocal n
            if (a, w) in held:
                held[a, w][1] += v[1]
            else:
                held[a, w] = v
                n += len(v[2])

        def solve():
            rows = list(held.items())
            held.clear()
            found = met_again([tuple(v) for _, v in rows], need, gram, Scratch(memory))
            give_back()
            out = []
            for ((a, w), _), again in zip(rows, found):
                if again.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
                    out.append((a, w, edge.astype(np.int32).tobytes()))
            cols = list(zip(*out)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary()))], names=["anchor", "whole", "runs"])

        for b in batches:
            for lot in b.column("lot"):
                for a, w, v in pickle.loads(read(lot.as_py())):
                    put(a, w, v)
                if n >= text_each:
                    spill()
        if not any(sizes):
            if held:
                yield solve()
            return
        spill()
        for k, f in enumerate(files):
            if f is not None:
                f.seek(0)
                while True:
                    try:
                        rows = pickle.load(f)
                    except EOFError:
                        break
                    for a, w, v in rows:
                        put(a, w, v)
                f.close()
                if n >= text_each or k == files_n - 1 or not any(sizes[k + 1 :]):
                    n = 0
                    if held:
                        yield solve()
        if held:
            yield solve()

    return run


def _removed(need: int, texts: bool):
    """Texts with the runs found in them to what is left; a character cut in two goes whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, read = [], _reader()
            found = b.column("found")
            offset, cols = found.offsets.to_pylist(), [found.values.field(c) for c in ("start", "span", "runs")]
            for i in range(b.num_rows):
                text = read(b.column("body")[i].as_py())
                spans = []
                if offset[i] < offset[i + 1]:
                    start, span, runs = (c.slice(offset[i], offset[i + 1] - offset[i]).to_pylist() for c in cols)
                    runs = [np.array([0, n], np.int32).tobytes() if x is None else x for x, n in zip(runs, span)]
                    edge = np.frombuffer(b"".join(runs), np.int32).reshape(-1, 2).astype(np.int64) + np.array([0, need - 1])
                    edge += np.repeat(start, [len(x) // 8 for x in runs])[:, None]
                    edge = edge[np.argsort(edge[:, 0])]
                    far = np.maximum.accumulate(edge[:, 1])
                    new = np.append(True, edge[1:, 0] > far[:-1])
                    last = np.append(np.flatnonzero(new)[1:] - 1, len(edge) - 1)
                    spans = list(zip(edge[new, 0].tolist(), far[last].tolist()))
                kept, at = [], 0
                for x, y in spans:
                    kept.append(text[at:x])
                    at = y
                left = b"".join([*kept, text[at:]])
                rows.append((b.column("h1")[i].as_py(), b.column("h2")[i].as_py(), len(text), len(text) - len(left), [{"start": x, "length": y - x} for x, y in spans], left.decode("utf-8", "ignore") if texts else None, hashlib.sha256(left).hexdigest()))
            kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])), pa.string(), pa.string()]
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["h1", "h2", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])

    return run


def remove_repeats(
    docs: DataFrame, need: int = 200, gram: int = 48, memory: int = 128 << 20, text_each: int = 2 << 20, shards: int = 1024, spans: bool = False, texts: bool = True
) -> DataFrame:
    """All rows of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` (of the bytes
    left), on request ``spans`` (start, length in bytes). With ``texts``, ``text`` is what is left;
    without, it is not returned.

    A byte goes if a string of ``need`` bytes that covers it also starts elsewhere, in the
    same document or another; strings are judged on the input, and none crosses the end
    of a document.

    Strings that may be equal are brought to one shard by content: every string of
    ``need`` bytes has an anchor that depends on it alone, and neighbouring starts with one
    anchor travel as one stretch, so a byte is sorted as the start of one suffix only.
    Stretches whose anchor occurs once in the table cannot repeat and stay behind. Those of an
    anchor with more than ``text_each`` bytes (a line that many documents have) are cut by more of
    their content until no group of different ones is larger. Equal
    stretches and equal texts are put together before they move, so very many copies
    are a number; where all stretches of an anchor are equal, nothing is left to be told
    apart, and all their strings repeat. A shard sorts its suffixes by external induced sorting and reads
    repeats off the common prefixes. ``shards`` should grow with the table; a shard of more than ``text_each`` bytes is sorted in
    lots, with orders and tuples beyond ``memory`` in unnamed files that belong to the task; a lost
    task starts again from its shuffled input.

    Null texts are empty, and texts shorter than ``need`` keep everything; repeated rows
    repeat each other's strings like other documents; an empty table gives no rows; a column of a new name is
    replaced, and columns named spans, h1 or h2 are not returned.
    """
    new = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "__kept", "h1", "h2"]
    docs = docs.drop(*new)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = ["h1", "h2"]
    # columns are declared not null: inferred null filters would set equal exchanges apart, and each would run by itself
    one = docs.select(text.alias("text")).select(*text_key(), "text").mapInArrow(lean(_squeeze), "h1 long NOT NULL, h2 long NOT NULL, body binary NOT NULL")
    one = one.groupBy(*key).agg(F.first("body").alias("body"), F.count("*").alias("copies"))
    fields = [f"{c} long NOT NULL" for c in ("anchor", "whole", "h1", "h2", "start", "span")]
    anchors, hot = split_anchors(docs.select(text.alias("text")), need, gram, text_each)
    parts = one.mapInArrow(lean(_stretches(need, gram, hot)), ", ".join(fields))
    twice = anchors.select("anchor", F.expr("low != high").alias("differ"))
    parts = parts.join(twice, "anchor")
    by_text = parts.where("differ").groupBy(*key).agg(F.collect_list(F.struct("anchor", "whole", "start", "span")).alias("parts"))
    cut = one.join(by_text, key, "left").select("body", "copies", "parts").mapInArrow(lean(_cut(need, shards)), "shard int, lot binary")
    runs = cut.repartition("shard").mapInArrow(lean(_sorted(need, gram, memory, text_each)), "anchor long, whole long, runs binary")
    found = parts.join(runs, ["anchor", "whole"], "left").where("runs IS NOT NULL OR NOT differ")
    found = found.groupBy(*key).agg(F.collect_list(F.struct("start", "span", "runs")).alias("found"))
    left = one.join(found, key, "left").select(*key, "body", "copies", "found").mapInArrow(
        lean(_removed(need, texts)), "h1 long, h2 long, n_bytes long, n_removed long, spans array<struct<start:long,length:long>>, __kept string, kept_sha256 string"
    )
    told = ["n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", *["spans"] * spans, *["__kept"] * texts]
    # what is left travels with the distinct text, so the rows themselves move without theirs
    plain = docs.withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text), "__null": F.col("text").isNull()}).drop("text")
    out = plain.join(left.select(*key, *told), key)
    if texts:
        out = out.withColumn("text", F.when(~F.col("__null"), F.col("__kept")))
    return out.select(*[c for c in docs.columns if texts or c != "text"], *new[:4], *["spans"] * spans)


def _counts(anchor: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
    """(anchor, stretches with it, least and greatest hash of their bytes)."""
    order = np.argsort(anchor, kind="stable")
    anchor, whole = anchor[order], whole[order]
    at = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    n = np.diff(np.append(at, len(anchor)))
    cols = [anchor[at], n, np.minimum.reduceat(whole, at), np.maximum.reduceat(whole, at)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["anchor", "n", "low", "high"])


def _anchor_counts(need: int, gram: int):
    """Texts to the counts of their anchors, per batch."""
    stretches = _stretches(need, gram, np.zeros(0, _U))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in stretches(batches):
            if out.num_rows:
                yield _counts(np.asarray(out.column("anchor")), np.asarray(out.column("whole")))

    return run


def _cut_counts(need: int, gram: int, hot: np.ndarray, cut_from: np.ndarray):
    """Lots of hot stretches to the counts of what is cut from the anchors ``cut_from``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for body, sizes in zip(b.column("body"), b.column("sizes").to_pylist()):
                buffer = np.frombuffer(body.as_py(), np.uint8)
                anchor, whole, _, _, parent = anchored(buffer, np.repeat(np.arange(len(sizes)), sizes), need, gram, hot)
                mine = _among(parent, cut_from)
                if mine.any():
                    yield _counts(anchor[mine].view(np.int64), whole[mine].view(np.int64))

    return run


def _hot_bytes(need: int, gram: int, hot: np.ndarray, chunk: int = CHUNK):
    """Texts to the bytes of their stretches under the anchors ``hot``, all of a chunk in one row: their bytes
    one after another, and the length of each. Such a stretch is a text whose strings have the same
    anchors as they had, at the same places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(parts):
            buffer = np.concatenate(parts)
            number = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
            anchor, _, at, span, _ = anchored(buffer, number, need, gram)
            mine = _among(anchor, hot)
            at, size, data = at[mine].tolist(), (span[mine] + need - 1).tolist(), buffer.tobytes()
            # stretches overlap, so their bytes may be many times the chunk's; rows keep to its size
            lots, n = [[]], 0
            for x, k in zip(at, size):
                if n + k > chunk:
                    lots.append([])
                    n = 0
                lots[-1].append((x, k))
                n += k
            lots = [lot for lot in lots if lot]
            body = pa.array([b"".join(data[x : x + k] for x, k in lot) for lot in lots], pa.binary())
            return pa.RecordBatch.from_arrays([body, pa.array([[k for _, k in lot] for lot in lots], pa.list_(pa.int32()))], names=["body", "sizes"])

        parts, n = [], 0
        for b in batches:
            for body in b.column("body"):
                x = np.frombuffer(body.as_py().encode(), np.uint8)
                for o in range(0, max(1, len(x) - need + 1), chunk):
                    parts.append(x[o : o + chunk + need - 1])
                    n += len(parts[-1])
                    if n >= chunk:
                        yield close(parts)
                        parts, n = [], 0
        if parts:
            yield close(parts)

    return run


def split_anchors(texts: DataFrame, need: int, gram: int, most_bytes: int) -> tuple[DataFrame, np.ndarray]:
    """Anchors that occur more than once (anchor, n, low, high), and the sorted ones that are cut further.

    An anchor is cut if its stretches differ and their bytes may be more than ``most_bytes``,
    so the list that reaches the driver is at most as long as the bytes of all stretches
    hold ``most_bytes``. The bytes of the stretches that the first round would cut are written, and
    further rounds read those alone. Each round looks only at what the last one cut; single strings
    under one hash do not differ, so it ends after as many rounds as halvings.
    """
    hot, found, lots = np.zeros(0, _U), None, None
    rows = texts.select(F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("text").alias("body"))
    fields = "anchor long NOT NULL, n long NOT NULL, low long NOT NULL, high long NOT NULL"
    counts = rows.mapInArrow(lean(_anchor_counts(need, gram)), fields)
    while True:
        table = counts.groupBy("anchor").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        table = saved(table.where("n > 1"), "anchors")
        many = table.where((F.col("low") != F.col("high")) & (F.col("n") * (2 * need) > most_bytes))
        newest = np.sort(np.array([r["anchor"] for r in many.select("anchor").collect()], np.int64).view(_U))
        if found is not None:
            table = found.unionByName(table)
        if not len(newest):
            return table, hot
        if lots is None:
            lots = saved(rows.mapInArrow(lean(_hot_bytes(need, gram, newest)), "body binary, sizes array<int>"), "hot-stretches")
        found, hot = table, np.union1d(hot, newest)  # no stretch has a cut anchor any more, so its row meets nothing
        counts = lots.mapInArrow(lean(_cut_counts(need, gram, hot, newest)), fields)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs.select("doc_id", "text"), texts=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
