"""Token counts, packing, repeated strings and near duplicates against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from larkspur.llm import bpe, common, darts, packing, queries, repeats, tokencount
from larkspur.llm.induced import Scratch, suffixes

PATH = bpe.vocabulary_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()


def ids_of(texts):
    return [e.ids for e in bpe.load(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_packing(rows, docs, capacity=2048):
    want = Counter()
    for d, ids in zip(docs, ids_of([t for _, t in docs])):
        want[(d[0], len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes()))] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert sum(r.length for r in rows) == sum(n * k for (_, n, _), k in want.items())
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    texts = defaultdict(list)
    for (d, t), ids in zip(docs, ids_of([t for _, t in docs])):
        texts[d].append([*ids, 1])
    for d, pieces in by_doc.items():
        starts = Counter((r.start, r.length) for r in pieces)
        for r in pieces:
            cut = [np.array(x[r.start : r.start + r.length], "<u4").tobytes() for x in texts[d] if len(x) == r.doc_tokens]
            assert r.ids_crc32 in {zlib.crc32(c) for c in cut}
        assert sum(n * k for (_, n), k in starts.items()) == sum(map(len, texts[d]))
    return sum(len(by_seq) * [capacity]) - sum(r.length for r in rows)


def test_packing(spark, sf_dir, docs):
    got = queries.QUERIES["op1_sum_of_squares_packing"](spark, sf_dir).collect()
    padding = check_packing(got, list(zip(docs.doc_id, docs.text)))
    assert padding < 2048 * 8


def test_packing_places_by_squares():
    p = packing.Packer(10, 100)
    put = lambda n: p.place((("d", 0), 0, np.zeros(n, np.uint32)), n)
    assert put(4) == [] and put(4) == []  # 4 -> 8 keeps one level at one window; a second window at 4 would add 3
    assert not p.windows[4] and len(p.windows[8]) == 1
    assert put(3) == [] and len(p.windows[3]) == 1  # does not fit behind 8
    assert len(put(2)) == 1 and not p.windows[8]  # filling a window takes 1 away, 3 -> 5 changes nothing
    tight = packing.Packer(10, 3)
    closed = [w for _ in range(5) for w in tight.place((("d", 0), 0, np.arange(6, dtype=np.uint32)), 6)]
    assert all(sum(len(x[2]) for x in w) <= 10 for w in closed) and tight.n_open <= 3


def test_packing_odd_rows(odd_docs, no_docs):
    check_packing(packing.pack(odd_docs, PATH).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert packing.pack(no_docs, PATH).count() == 0


def test_token_counts(spark, sf_dir, docs):
    got = {r.doc_id: r for r in queries.QUERIES["op6_token_counts"](spark, sf_dir).collect()}
    for d, text, ids in zip(docs.doc_id, docs.text, ids_of(docs.text)):
        assert (got[d].n_bytes, got[d].n_tokens, got[d].over_limit) == (len((text or "").encode()), len(ids), len(ids) > 1024)


def test_token_counts_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), len(i)) for r, i in zip(rows, ids_of([r.text for r in rows])))
    got = tokencount.count_tokens(odd_docs, PATH, shards=5, block_chars=1000)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()) == want
    assert tokencount.count_tokens(no_docs, PATH).count() == 0


def test_token_counting_tasks_do_not_grow_their_worker():
    """A Python worker serves many tasks; what one shard needs must not stay behind."""

    def held():
        common.give_back()
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nAnonymous:\s+(\d+)", f.read()).group(1)) / 1024

    def task(k):
        words = [f" {zlib.crc32(b'%d %d' % (k, i)):x}" for i in range(10_000)]
        data = tokencount._packed(np.ones(10_000, int), np.arange(10_000) // 10, np.full(10_000, 2), words=b"\xff".join(w.encode() for w in words))
        (out,) = tokencount._counted(PATH)(iter([tokencount._table(tokencount._PARTS, [(0, 7, None, None, data)])]))
        _, (sums,) = tokencount._unpacked(out.column("data")[0].as_py(), 1)
        return words, sums

    words, sums = task(0)
    ids = ids_of(words)
    assert sums.tolist() == [2 * sum(map(len, ids[i : i + 10])) for i in range(0, len(words), 10)]
    task(1)
    before = held()
    for k in range(2, 26):
        task(k)
    assert held() - before < 16


def test_kept_tokenizer_is_read_again_from_a_changed_file(tmp_path):
    file = tmp_path / "vocabulary.json"
    file.write_bytes(open(PATH, "rb").read())
    first = bpe.kept(str(file))
    assert bpe.kept(str(file)) is first
    file.write_bytes(open(PATH, "rb").read() + b"\n")
    assert bpe.kept(str(file)) is not first


def test_fast_encoding_is_the_librarys(docs):
    e = bpe.Encoder(PATH)
    assert [e.encode(t).tolist() for t in docs.text] == ids_of(docs.text)
    for text in ("a  b\n\nc d", " x", "x ", "", "\u3000a \u00a0b \x1c c", "don't <|endoftext|> <|endoftext|>x", "ab " * 50, "日本 語 \n 1st 2nd"):
        assert e.encode(text).tolist() == e.tok.encode(text, add_special_tokens=False).ids
        assert "".join(bpe.segments(text, 2)) == text


def order_of(t, cap):
    tt = t.tolist()
    want = sorted(range(len(tt) - 1), key=lambda i: tt[i:], reverse=True)
    near = [0] * len(want)
    for k in range(1, len(want)):
        a, b = want[k - 1], want[k]
        while near[k] < cap and tt[a + near[k]] == tt[b + near[k]]:
            near[k] += 1
    return want, near


@pytest.mark.parametrize("memory", [0, 1 << 28])
def test_induced_sorting(memory):
    rng = np.random.default_rng(5)
    for i in range(150):
        n = int(rng.integers(1, 60))
        t = np.append(rng.integers(1, 2 + int(rng.integers(1, 6)), n), 0)
        if i % 3 == 0:
            t = np.append(np.tile(t[: int(rng.integers(1, 5))], n), 0)
            t[:-1] = np.maximum(t[:-1], 1)
        room, cap = int(rng.choice([1, 3, 1 << 12])), int(rng.choice([3, 200]))
        got, common = suffixes(t, Scratch(memory), cap, room)
        want, near = order_of(t, cap)
        assert got.tolist() == want and np.asarray(common).tolist() == near


def brute_repeats(texts, need=200):
    seen = Counter(x[i : i + need] for x in texts for i in range(len(x) - need + 1))
    out = []
    for x in texts:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - need + 1):
            if seen[x[i : i + need]] > 1:
                gone[i : i + need] = True
        left = np.frombuffer(x, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(x), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def test_repeats(spark, sf_dir, docs):
    got = {r.doc_id: tuple(r[1:]) for r in queries.QUERIES["op8_induced_suffix_dedup"](spark, sf_dir).collect()}
    for d, want in zip(docs.doc_id, brute_repeats([(t or "").encode() for t in docs.text])):
        assert got[d] == want


def test_repeats_odd_rows_and_spilled_shards(spark, odd_docs, no_docs):
    rows = odd_docs.withColumn("text", odd_docs.text.substr(1, 3000)).unionByName(
        spark.createDataFrame([(20, "ab" * 400), (21, "z" * 199), (22, "q" * 200), (23, "r" * 201)], "doc_id long, text string"), allowMissingColumns=True
    )
    held = rows.collect()
    want = Counter((r.doc_id, *w) for r, w in zip(held, brute_repeats([(r.text or "").encode() for r in held])))
    for options in ({}, {"memory": 0, "text_each": 500}):
        got = repeats.remove_repeats(rows, **options)
        assert set(rows.columns) - {"h1", "spans"} <= set(got.columns)
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == want
    assert repeats.remove_repeats(no_docs).count() == 0
    null = {r.doc_id: r.text for r in got.collect()}
    assert null[3] is None and null[4] == "" and null[21] == "z" * 199


def test_repeats_around_a_common_line(spark):
    """A line in all documents, with other text around it, does not bring them all into one sort."""
    rng = np.random.default_rng(7)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    some = lambda n: "".join(rng.choice(letters, n))
    line, sides = "Licensed under the terms that come with it: " + some(90), [some(120) for _ in range(12)]
    texts = [some(int(rng.integers(0, 400))) + line + some(int(rng.integers(0, 400))) for _ in range(150)]
    texts += [some(i) + sides[i % 12] + line + some(90 - i) for i in range(60)]  # left sides that meet again
    texts += [some(i) + line + sides[i % 12][: 50 + i] + some(200) for i in range(60)]  # and right sides, some too short
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_repeats([t.encode() for t in texts])
    for bound in (400, 4000):
        anchors, hot = repeats.split_anchors(rows.select("text"), 200, 16, bound)
        cut = {int(x) for x in hot.view(np.int64)}
        assert cut and all(r.n * 400 <= bound for r in anchors.collect() if r.low != r.high and r.anchor not in cut)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(rows, text_each=4000).collect()}
    assert [got[i] for i in range(len(texts))] == want


def brute_classes(texts, ids, least=0.8):
    sets = []
    shingles = darts.Shingles()
    for t in texts:
        sets.append(Counter(shingles(t).tolist()))
    held = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            held[x].add(i)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in {j for x in s for j in held[x] if j < i}:
            if (s & sets[j]).total() >= least * (s | sets[j]).total():
                root[find(i)] = find(j)
    best = {}
    for i, d in enumerate(ids):
        best[find(i)] = min(best.get(find(i), d), d)
    return [best[find(i)] for i in range(len(ids))]


def test_near_duplicates(spark, sf_dir, docs):
    got = {r.doc_id: r for r in queries.QUERIES["op4_dart_minhash"](spark, sf_dir).collect()}
    for d, want in zip(docs.doc_id, brute_classes(docs.text, docs.doc_id)):
        assert got[d].class_id == want and got[d].kept == (want == d)


def test_near_duplicates_of_a_large_group(spark):
    """Many near copies and many documents with a common half are told apart, whatever meets in a bucket."""
    from tests.llm.conftest import prose

    base, half = prose(1, 300).split(), prose(2, 150)
    rows = [(i, " ".join(base[:i] + [f"new{i}"] + base[i + 1 :])) for i in range(120)]
    rows += [(1000 + i, half + " " + " ".join(f"w{i}x{j}" for j in range(150))) for i in range(150)]
    got = darts.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r, want in zip(sorted(got), brute_classes([t for _, t in rows], [d for d, _ in rows])):
        assert r.class_id == want


def star(seed, first, copies, words=500, edits=8):
    """An original, about 0.85 like each of its copies, which are about 0.73 like one another."""
    rng = np.random.default_rng(seed)
    base = [f"s{seed}w{w}" for w in rng.integers(0, 5000, words)]
    rows = [(first, " ".join(base))]
    for i in range(1, copies + 1):
        text = list(base)
        for at in rng.choice(words, edits, replace=False):
            text[at] = f"edit{seed}x{i}x{at}"
        rows.append((first + i, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_near_duplicates_of_star_families(spark, block):
    """Copies that are like their original only are found, in buckets of one block and of many."""
    rows = star(1, 0, 30) + star(2, 1000, 300 if block > 7 else 40) + star(3, 2000, 30, edits=9)
    rows = [(d if d % 1000 else d + 900, t) for d, t in rows]  # the original does not have the smallest doc_id
    got = {r.doc_id: r.class_id for r in darts.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()}
    want = dict(zip([d for d, _ in rows], brute_classes([t for _, t in rows], [d for d, _ in rows])))
    assert got == want and len(set(want.values())) < 10


def test_near_duplicates_of_texts_with_one_doc_id(spark):
    """Texts that share a doc_id are judged each by itself."""
    from tests.llm.conftest import prose

    rows = [(1, prose(1, 200)), (2, prose(1, 200) + " end"), (2, "clean " + " ".join(f"c{i}" for i in range(200))), (3, prose(1, 200) + " end")]
    got = darts.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    judged = sorted((r.doc_id, r.text.startswith("clean"), r.class_id, r.kept) for r in got)
    assert judged == [(1, False, 1, True), (2, False, 1, False), (2, True, 2, True), (3, False, 1, False)]


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    got = darts.near_duplicates(odd_docs)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and {r.doc_id: r.class_id for r in rows} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, None: None, 9: 9, 10: 10}
    assert sorted((r.doc_id or 0) for r in rows if r.kept) == [0, 1, 3, 4, 5, 6, 8, 8, 9, 10]
    assert darts.near_duplicates(no_docs).count() == 0


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 1 << 60, 300).astype(np.uint64)
    w, v = rng.uniform(0.2, 3, 300), rng.uniform(0.2, 3, 300)
    want = np.minimum(w, v).sum() / np.maximum(w, v).sum()
    s = darts.signatures([(a, w), (a, v), (a[:1], w[:1])], 3000)
    assert abs((s[0] == s[1]).mean() - want) < 0.04
    assert (s == darts.signatures([(a, w), (a, v), (a[:1], w[:1])], 3000)).all()


def test_cutting_texts_takes_little_memory():
    """Texts are cut a small part at a time, and every string start lies in one stretch."""
    import tracemalloc

    import pyarrow as pa

    rng, need = np.random.default_rng(4), 200
    sizes = [3_000_000, 150, 1_200_000, *[4_000] * 500]
    texts = [bytes(rng.integers(97, 123, n, np.uint8)) for n in sizes]
    keys = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([keys, keys, pa.array([t.decode() for t in texts])], names=["h1", "h2", "body"])
    covered = [np.zeros(max(0, n - need + 1), np.int64) for n in sizes]
    tracemalloc.start()
    outs = list(repeats._stretches(need, 48, np.zeros(0, np.uint64))([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for out in outs:
        for key, start, span in zip(*[out.column(c).to_pylist() for c in ("h1", "start", "span")]):
            covered[key][start : start + span] += 1
    assert all((c == 1).all() for c in covered)
    assert peak < 150 << 20


def test_signing_texts_takes_little_memory():
    """Documents are signed a small part at a time, and their rows are those they get alone."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 800)) for _ in range(400)]
    keys = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([keys, keys, keys, pa.array(texts)], names=["h1", "h2", "doc_id", "text"])
    tracemalloc.start()
    outs = list(darts._signed(24, 5, 5)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rows = pa.Table.from_batches(outs).to_pylist()
    assert len(rows) == len(texts) and peak < 60 << 20
    alone = [r for i in range(0, len(texts), 40) for out in darts._signed(24, 5, 5)([batch.slice(i, 1)]) for r in out.to_pylist()]
    assert alone == rows[::40]


def test_a_worker_gives_memory_back_when_its_task_ends(monkeypatch):
    seen = []

    class Held:
        def __del__(self):
            seen.append("freed")

    def run(batches):
        held = Held()  # noqa: F841
        yield from batches

    monkeypatch.setattr(common, "give_back", lambda: seen.append("given"))
    assert list(common.lean(run)([1, 2])) == [1, 2] and seen == ["freed", "given"]


def test_pipeline_stages_hand_over_small_batches(spark, no_docs, sf_dir):
    """Every stage that hands texts to Python has at most 1000 rows in an Arrow batch; a smaller setting stays."""
    def counted(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, rows = spark.conf.get(key), spark.range(0, 2500, 1, 1)
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name == "source_mix":
                continue
            spark.conf.set(key, "10000")
            stage(spark, no_docs, sf_dir)
            assert sorted(r[0] for r in rows.mapInArrow(counted, "n long").collect()) == [500, 1000, 1000], name
        for given, want in (("700", "700"), ("0", "1000")):
            spark.conf.set(key, given)
            common.small_batches(spark)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)


def test_only_what_may_repeat_is_sorted():
    """Stretches of one anchor that differ near it stay out of the sort, and the result is that of sorting all."""
    rng = np.random.default_rng(5)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    need, gram, line = 200, 48, word(60)
    shared = word(90) + line + word(90)
    texts = [word(150) + line + word(150) for _ in range(60)] + [word(30) + shared + word(30) for _ in range(5)]
    parts = []
    for x in texts:
        b = np.frombuffer(x, np.uint8)
        for at, span in zip(*repeats.anchored(b, np.zeros(len(b), int), need, gram)[2:4]):
            parts.append((int(span), 1, x[at : at + span + need - 1]))
    parts += [(parts[0][0], 3, parts[0][2])]
    want = repeats.repeated_starts(parts, need, Scratch(1 << 20))
    got = repeats.met_again(parts, need, gram, Scratch(1 << 20))
    assert all(np.array_equal(a, b) for a, b in zip(got, want)) and sum(int(x.sum()) for x in want) >= 5 * 41
    of, at, span = repeats.met(parts, need, gram)
    assert 0 < span.sum() + (need - 1) * len(of) < sum(len(x) for _, _, x in parts) / 3
    nothing = repeats.met_again([(5, 1, word(204)), (3, 2, word(202))], need, gram, Scratch(1 << 20))
    assert [x.tolist() for x in nothing] == [[False] * 5, [True] * 3]
