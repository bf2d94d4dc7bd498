"""Token counts: pieces are counted once per distinct pre-token and joined to the documents' pre-token frequencies."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import bpe
from larkspur.llm.common import give_back

_PARTS = "shard int, block long, ids array<bigint>, sizes array<bigint>, data binary"
_SUMS = "block long, ids array<bigint>, sizes array<bigint>, data binary"
_SCHEMA = {
    "shard": pa.int32(),
    "block": pa.int64(),
    "ids": pa.list_(pa.int64()),
    "sizes": pa.list_(pa.int64()),
    "data": pa.binary(),
}


def _table(names: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in names.split(", ")]
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _SCHEMA[n]) for n, c in zip(names, cols)], names=names)


def _packed(*arrays: np.ndarray, words: bytes = b"") -> bytes:
    import zstandard

    head = np.array([len(words), *map(len, arrays)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + words + b"".join(a.astype("<u4").tobytes() for a in arrays))


def _unpacked(data: bytes, n: int) -> tuple[bytes, list[np.ndarray]]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    head = np.frombuffer(raw, "<u4", n + 1)
    at = 4 * (n + 1)
    words, at = raw[at : at + head[0]], at + int(head[0])
    out = []
    for k in head[1:]:
        out.append(np.frombuffer(raw, "<u4", int(k), at))
        at += 4 * int(k)
    return words, out


def _frequencies(special_strings: str | None, shards: int, block_chars: int):
    """Documents to blocks: per block and shard, which pre-tokens its documents hold how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        import regex
        from pyspark import TaskContext

        find = regex.compile(public_tokenizers.PATTERN).findall
        special = re.compile(special_strings) if special_strings else None
        block = TaskContext.get().partitionId() << 32
        ids, sizes, docs, chars = [], [], [], 0
        number: dict[str, int] = {}

        def close():
            words = list(number)
            raw = [w.encode() for w in words]
            shard_of = np.fromiter((zlib.crc32(w) % shards for w in raw), np.int64, len(raw))
            doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
            word = np.concatenate(docs) if docs else np.empty(0, np.int64)
            entry, freq = np.unique(word.astype(np.int64) << 32 | doc, return_counts=True)
            word, doc = entry >> 32, entry & 0xFFFFFFFF
            per_word = np.bincount(word, minlength=len(words))
            order = np.argsort(shard_of[word], kind="stable")
            doc, freq = doc[order], freq[order]
            ends = np.cumsum(np.bincount(shard_of[word], minlength=shards)) if len(words) else np.zeros(shards, int)
            rows, by_shard = [], [[] for _ in range(shards)]
            for w, s in enumerate(shard_of.tolist()):
                by_shard[s].append(w)
            for s, mine in enumerate(by_shard):
                if mine:
                    a, b = (ends[s - 1] if s else 0), ends[s]
                    data = _packed(per_word[mine], doc[a:b], freq[a:b], words=b"\xff".join(raw[w] for w in mine))
                    rows.append((s, block, None, None, data))
            rows.append((block % shards, block, list(ids), list(sizes), None))
            return _table(_PARTS, rows)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                mine = []
                for k, part in enumerate(special.split(text) if special else [text]):
                    for s in [part] if k % 2 else bpe.segments(part):
                        found = [part] if k % 2 else find(s)
                        mine.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found)))
                ids.append(i)
                sizes.append(len(text.encode()))
                docs.append(np.concatenate(mine))
                chars += len(text)
                if chars >= block_chars:
                    yield close()
                    block += 1
                    ids, sizes, docs, chars = [], [], [], 0
                    number.clear()
                give_back()
        if ids:
            yield close()
        give_back()

    return run


def _counted(path: str, keep: int = 200_000):
    """A shard's pre-tokens, each counted once by the library, joined to the blocks that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, known = bpe.kept(path), {}
        for batch in batches:
            rows = []
            for r in (x for i in range(batch.num_rows) for x in batch.slice(i, 1).to_pylist()):
                if r["data"] is None:
                    rows.append((r["block"], r["ids"], r["sizes"], None))
                    continue
                words, (per_word, doc, freq) = _unpacked(r["data"], 3)
                words = words.split(b"\xff")
                if len(known) > keep:
                    known.clear()
                new = [w for w in words if w not in known]
                for at in range(0, len(new), 1000):
                    some = new[at : at + 1000]
                    for w, e in zip(some, tok.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)):
                        known[w] = len(e)
                pieces = np.fromiter((known[w] for w in words), np.int64, len(words))
                sums = np.bincount(doc, weights=np.repeat(pieces, per_word) * freq)
                rows.append((r["block"], None, None, _packed(sums)))
            yield _table(_SUMS, rows)
        give_back()

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    heads, sums = {}, {}
    for batch in batches:
        for r in (x for i in range(batch.num_rows) for x in batch.slice(i, 1).to_pylist()):
            if r["data"] is None:
                heads[r["block"]] = (r["ids"], r["sizes"])
            else:
                _, (part,) = _unpacked(r["data"], 1)
                have = sums.get(r["block"], np.zeros(0, np.int64))
                total = np.zeros(max(len(have), len(part)), np.int64)
                total[: len(have)] = have
                total[: len(part)] += part
                sums[r["block"]] = total
    for block, (ids, sizes) in heads.items():
        n = np.zeros(len(ids), np.int64)
        part = sums.get(block, n)
        n[: len(part)] = part
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"]
        )


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, shards: int = 128, block_chars: int = 2_000_000
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every whole text.

    Texts are cut into pre-tokens by the tokenizer's pattern; special strings stand as
    one. A block of documents keeps, per pre-token, which documents hold it how often.
    These frequencies go to the shard of the pre-token, where every distinct one is
    counted by the library once (again only in a shard of more than 200,000, which bounds a
    task's memory), and come back as sums per document: no ids are made
    and no document is joined row by row. A very common pre-token costs its shard one
    entry per document, a few bits after compression. ``block_chars`` bounds a task's
    memory; ``shards`` should grow with the number of distinct pre-tokens.

    A null text is empty and has 0 tokens; repeated rows and ids stay separate rows; an
    empty table gives no rows; columns besides doc_id and text are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    special = bpe.special_split(bpe.load(path))
    parts = rows.mapInArrow(_frequencies(special and special.pattern, shards, block_chars), _PARTS)
    sums = parts.repartition("shard").mapInArrow(_counted(path), _SUMS)
    out = sums.repartition("block").mapInArrow(_summed, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
