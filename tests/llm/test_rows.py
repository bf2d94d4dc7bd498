"""Native operators, vectors, toxicity and the pipeline."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larkspur.llm import chat, darts, mixing, pivots, queries, toxicity, urlrules
from larkspur.llm.common import saved
from tests.llm.test_texts import brute_classes, check_packing, star
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_as_sql(spark, sf_dir, name):
    assert not differences(connect(sf_dir), queries.ORACLE[name], queries.QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["op5_systematic_mix", "op9_url_rules", "op10_chat_format"])
def test_native_plans_hold_no_python(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_mix_targets_and_copies(spark, sf_dir):
    rows = queries.QUERIES["op5_systematic_mix"](spark, sf_dir)
    per = rows.join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source"), "doc_id")
    per = per.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w"), F.max("size").alias("m"), F.first("source_size").alias("s"))
    per = per.collect()
    assert abs(sum(r.w for r in per) - 1.5 * sum(r.s for r in per)) < 1e-6 * sum(r.s for r in per)
    assert all(r.w <= 2 * r.s + 1e-9 and abs(r.t - r.w) <= 2 * r.m for r in per)
    assert rows.where("taken > 2 * size").count() == 0


def test_mix_odd_rows(odd_docs, no_docs):
    got = mixing.systematic_copies(odd_docs)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and {r.size for r in rows if r.doc_id in (3, 4, 10)} == {0}
    assert mixing.mixed(odd_docs).columns == odd_docs.columns
    assert mixing.mixed(odd_docs).count() == sum(r.copies for r in rows)
    assert mixing.mixed(no_docs).count() == 0


def test_url_rules_on_odd_urls(spark):
    rules = [*(urlrules.prefix_rule(*r) for r in urlrules.PREFIX_RULES), *urlrules.JUNK_HOSTS]
    urls = {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "no scheme.net/en/": ("", "", None, "allow"),
        "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net": ("example.net", "", None, "allow"),
        "http://xexample.net/EN/": ("xexample.net", "/EN/", "net/", "block"),
        "http://net/": ("net", "/", "net/", "block"),
        "http://a.net:80/": ("a.net:80", "/", None, "allow"),
        "x://b.example.com/de": ("b.example.com", "/de", None, "allow"),
        "x://b.example.com/de/://c.net/": ("b.example.com", "/de/://c.net/", "example.com/de/", "block"),
        "http://www.spam-farm.org/fr/": ("www.spam-farm.org", "/fr/", "org/fr/", "allow"),
        "http://www.spam-farm.org/en/": ("www.spam-farm.org", "/en/", None, "block"),
    }
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: tuple(r[1:]) for r in urlrules.judge(pages.union(pages), rules, keep=["page_id"]).collect()}
    assert got == dict(enumerate(urls.values()))
    assert urlrules.judge(pages.where("false"), rules, keep=["page_id"]).count() == 0
    assert urlrules.judge(pages, [], keep=["page_id"]).count() == len(urls)
    anywhere = urlrules.Rule("any", "block", "/en/")  # without a literal token every URL is tried
    assert urlrules.judge(pages, [anywhere], keep=["page_id"]).where("verdict = 'block'").count() == 2


def test_chats_come_back(spark):
    said = ["", None, "a\\b", "<|im_end|>", "<\\|", "\\<|", "<|im_sep|>\n", "<", "|", "\\|", "x" * 5000, "<|<|\\\\"]
    rows = [(1, i, "assistant" if i % 3 else "user", t, "z") for i, t in enumerate(said)]
    rows += [(2, None, None, None, "z"), (2, 1, "a\nb<|", "t", "z"), (2, 1, "a\nb<|", "t", "z"), (2, 1, "a\nb<|", "s", "z"), (None, 1, "assistant", "q", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_chats(turns)
    got = {r.conv_id: r for r in out.select("*", chat.parse_chats(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("l")).collect()}
    assert [(x.role, x.text) for x in got[1].t] == [(r[2], r[3] or "") for r in rows[: len(said)]]
    assert got[1].l == "".join(t or "" for i, t in enumerate(said) if i % 3)
    assert [(x.role, x.text) for x in got[2].t] == [("", ""), ("a\nb<|", "s"), ("a\nb<|", "t"), ("a\nb<|", "t")]
    assert got[None].l == "q" and got[1].formatted.count(chat.START) == 8
    d = {r.conv_id: r for r in chat.digest(out).collect()}
    assert d[None].turns_sha256 == hashlib.sha256(b"assistant\nq\n").hexdigest() and d[1].n_turns == len(said)
    assert chat.format_chats(turns.where("false")).count() == 0


def unit(rows):
    rows = np.asarray(rows, float)
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def vectors(spark, seed=0):
    """Random vectors with near copies at the threshold, a dense group and odd rows."""
    rng = np.random.default_rng(seed)
    base = unit(rng.normal(size=(300, 16)))
    noise = rng.normal(size=base.shape)
    noise = unit(noise - (noise * base).sum(1)[:, None] * base)
    near = 0.94 * base[:60] + np.sqrt(1 - 0.94**2) * noise[:60]
    dense = unit(base[0] + 0.02 * rng.normal(size=(700, 16)))
    x = np.concatenate([base, near, dense, base[:5]])
    label = ["a" if i % 2 else "b" for i in range(300)] + ["a" if i % 2 else "b" for i in range(60)] + ["b"] * 700 + ["b"] * 5
    rows = [(i, v.tolist(), y, 1) for i, (v, y) in enumerate(zip(x, label))]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, [None] * 16, [1.0, 2.0]]
    rows += [(5000 + i, v, "a", 1) for i, v in enumerate(bad)] + [(6000, x[0].tolist(), None, 1), (None, x[1].tolist(), "a", 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, node int").repartition(4)
    return x, np.array(label), frame


def test_vector_links(spark):
    x, label, frame = vectors(spark)
    u = unit(x)
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    reach = np.arange(len(x))
    while True:
        new = np.minimum(reach, np.where(link, reach[None, :], len(x)).min(1))
        if (new == reach).all():
            break
        reach = new
    got = {r.vec_id: r for r in pivots.near_duplicates(frame, block=64).collect()}
    assert len(got) == frame.count()
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (link[i].sum(), reach[i], reach[i] == i)
    for i in (*range(5000, 5007), 6000):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].kept and got[None].component_id is None
    assert pivots.near_duplicates(frame.where("false")).count() == 0


def test_vector_links_on_the_table(spark, sf_dir):
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    u, label = unit(np.stack(v.embedding)), v.label.values
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    got = {r.vec_id: r.n_links for r in queries.QUERIES["op2_pivot_near_dedup"](spark, sf_dir).collect()}
    assert [got[i] for i in v.vec_id] == (link.sum(1) - 1).tolist()


def test_search(spark, sf_dir):
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x, ids = np.stack(v.embedding).astype(float), v.vec_id.values
    hits = total = 0
    found = queries.QUERIES["op7_permutation_index"](spark, sf_dir).toPandas()
    for q in ids[ids % 20 == 0]:
        mine = found[found.query_id == q].sort_values("rank")
        score = x @ x[ids == q][0]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        assert mine["rank"].tolist() == list(range(1, 21)) and (np.diff(mine.score) <= 0).all()
        assert np.allclose([score[ids == i][0] for i in mine.vec_id], mine.score, atol=1e-12)
        hits += len(set(ids[order]) & set(mine.vec_id))
        total += 20
    assert hits >= 0.9 * total


def test_search_with_lengths_and_odd_rows(spark):
    x, _, frame = vectors(spark)
    x = x * np.linspace(0.2, 3, len(x))[:, None]
    scaled = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    frame = scaled.unionByName(frame.where("vec_id >= 5000 OR vec_id IS NULL").select("vec_id", "embedding")).union(scaled.where("vec_id < 30"))
    got = pivots.nearest(frame, F.col("vec_id") % 20 == 0, share=1.0, rows_each=300, queries_each=20).collect()
    for q in range(0, len(x), 20):
        score = x @ x[q]
        want = [i for i in np.lexsort((np.arange(len(x)), -np.round(score, 12))) if i != q]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        others = [m for m in mine if m[1] < 5000]
        assert len(mine) == 20 and np.allclose([m[2] for m in others], score[want][: len(others)])
    few = pivots.nearest(scaled.where("vec_id < 3"), F.col("vec_id") == 0)
    assert few.count() == 2
    assert pivots.nearest(frame.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def insulted(spark, n=700):
    rng = np.random.default_rng(2)
    calm = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(calm, 60))
        toxic = i % 5 == 0
        if toxic:
            words[int(rng.integers(60))] = str(rng.choice(["idiot", "moronlo", "moronig", "scumque"]))
        rows.append((i, " ".join(words), "en" if i % 2 else "de"))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, odd_docs, no_docs):
    docs, labels = insulted(spark)
    model = toxicity.fit(docs, labels.union(labels.selectExpr("null", "0", "1")).union(labels.selectExpr("doc_id", "0", "cast(null as int)")))
    got = toxicity.score(docs, model).join(labels.withColumnRenamed("toxic", "truth"), "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    assert np.mean([r.toxic == bool(r.truth) for r in got]) > 0.95 and np.mean([(r.score >= 0.5) == bool(r.truth) for r in got]) > 0.95
    odd = toxicity.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score(no_docs, model).count() == 0
    again = toxicity.fit(docs, labels)
    assert np.array_equal(again.embed, toxicity.fit(docs, labels).embed)


def test_toxicity_reads_the_whole_of_a_long_text(spark):
    docs, labels = insulted(spark)
    model = toxicity.fit(docs, labels)
    calm = "word1 word2 " * 250_000
    words = toxicity.Words(1 << 15)
    quiet, loud = model.scores([words(calm), words(calm + " idiot")])
    assert quiet < 0.5 < loud


def test_held_out_rule(spark):
    ids = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in ids)


def test_pipeline_stages(spark, sf_dir):
    """Every stage against brute force or SQL on its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(star_documents(spark))
    stages = dict(corpus_pipeline.STAGES)
    clean = saved(stages["toxicity"](spark, docs, sf_dir), "t")
    scored = toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in scored.where("score < threshold").collect()}
    one = saved(stages["near_duplicates"](spark, clean, sf_dir), "n")
    rows = clean.collect()
    assert {r.doc_id for r in one.collect()} == set(brute_classes([r.text for r in rows], [r.doc_id for r in rows]))
    left = saved(stages["repeated_strings"](spark, one, sf_dir), "r")
    rows = one.collect()
    want = {r.doc_id: t.decode("utf-8", "ignore") for r, t in zip(rows, brute_left([(r.text or "").encode() for r in rows]))}
    assert {r.doc_id: r.text or "" for r in left.collect()} == want
    mixed = saved(stages["source_mix"](spark, left, sf_dir), "m")
    con = connect(sf_dir)
    con.register("left_rows", left.toArrow())
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM left_rows")
    taken = {d: n // size for d, n, size in con.execute(f"SELECT doc_id, taken, size FROM ({mixing.SQL})").fetchall() if n}
    worded = mixed.where(mixing.word_count(F.col("text")) > 0)  # a text without words adds nothing to the sizes
    assert {r.doc_id: r["count"] for r in worded.groupBy("doc_id").count().collect()} == taken
    for frame in (clean, one, left, mixed):
        assert frame.columns == docs.columns and [t for _, t in frame.dtypes] == [t for _, t in docs.dtypes]
    assert left.count() == one.count() and left.where("n_chars <> length(text)").count() == 0
    check_packing(stages["packing"](spark, mixed, sf_dir).collect(), [(r.doc_id, r.text) for r in mixed.collect()])


def star_documents(spark):
    """An original with copies that are each like it, but not like one another, after the other documents."""
    texts = star(5, 1, 30)
    texts = [t for _, t in texts] if isinstance(texts[0], tuple) else texts
    return spark.createDataFrame([(10_000_000 + i, t, "en", "a", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")


def brute_left(texts, need=200):
    seen = Counter(x[i : i + need] for x in texts for i in range(len(x) - need + 1))
    out = []
    for x in texts:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - need + 1):
            if seen[x[i : i + need]] > 1:
                gone[i : i + need] = True
        out.append(np.frombuffer(x, np.uint8)[~gone].tobytes())
    return out


def test_pipeline_on_odd_rows(spark, odd_docs, sf_dir):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == odd_docs.columns, name
        assert {(r.size, r.score, r.kept, r.h1, r.class_id, r.spans) for r in docs.collect()} == {(1, 1.0, True, 7, 7, "x")}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()
    docs = odd_docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_vectors_of_any_length_take_part(spark):
    """One vector of another length, first by hash or not, leaves the others as they are, and has partners of its own length."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 1) for i in range(40)]
    rows += [(100 + i, [0.5, 2.0 + i % 2], 1) for i in range(60)] + [(200, rows[3][1], 1), (300, [1.0, 1.0, 1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    links = {r.vec_id: r for r in pivots.near_duplicates(table).collect()}
    assert links[3].n_links == 1 and links[200].component_id == 3 and links[300].n_links == 0
    assert {links[100 + i].n_links for i in range(60)} == {59} and links[101].component_id == 100
    got = {}
    for r in pivots.nearest(table, F.col("vec_id") % 10 == 0, top=3).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[200][0] == 3 or got[200][0] in range(40)
    assert set(got) == {i for i in (*range(0, 40, 10), *range(100, 160, 10), 200)}
    assert all(v >= 100 and v < 200 for v in got[110]) and got[100] == [101, 103, 105]


def test_a_word_on_the_cut_of_a_long_text_is_one_word():
    words = toxicity.Words(1 << 15)
    alone = words("idiot")
    for lead in range((1 << 20) - 6, (1 << 20) + 2):
        text = "a" * (lead - 1) + " idiot b"
        assert (words(text)[1] == alone[0]).all()


def test_a_repeated_labelled_document_is_learned_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs.union(docs), labels)
    assert (one.embed == two.embed).all() and one.thresholds == two.thresholds


def test_long_rule_lists_are_a_table(spark, sf_dir):
    """Some hundred rules joined on their rarest token judge as the same rules in the plan, on very long, null and odd URLs too."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(60)]
    pick = lambda n: [words[k] for k in rng.integers(0, 60, n)]
    texts = {f"{'.'.join(pick(2))}.net/{'/'.join(pick(int(rng.integers(0, 3))))}" for _ in range(300)}
    rules = [urlrules.prefix_rule("block" if i % 3 else "allow", t) for i, t in enumerate(sorted(texts))]
    rules += [*(urlrules.prefix_rule(*r) for r in urlrules.PREFIX_RULES), *urlrules.JUNK_HOSTS, urlrules.Rule("digits", "block", "[0-9]{3}", (), 1)]
    rules += [urlrules.Rule("tie-a", "allow", "w1/w2", ("w1",), 2), urlrules.Rule("tie-b", "block", "w1/w2/?", ("w2",), 2)]
    urls = [f"http://{'.'.join(pick(3))}.net/{'/'.join(pick(4))}" for _ in range(400)] + [None, "", "no", "http://a.net/" + "w1/" * 20_000]
    urls += ["http://w1.net/w1/w2"] * 30
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    one = urlrules.judge(pages, rules, keep=["page_id"]).collect()
    two = urlrules.judge_by_table(pages, urlrules.rule_table(spark, rules), keep=["page_id"])
    assert sorted(map(str, one)) == sorted(map(str, two.collect())) and len({r.rule for r in one}) > 10
    for word in ("Python", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in two._jdf.queryExecution().executedPlan().toString()
    assert urlrules.judge_by_table(pages.where("false"), urlrules.rule_table(spark, rules), keep=["page_id"]).count() == 0
    none = urlrules.judge_by_table(pages, urlrules.rule_table(spark, []), keep=["page_id"])
    assert none.where("verdict = 'allow' AND rule IS NULL").count() == len(urls)


def test_parts_of_a_batch_score_as_the_whole(monkeypatch):
    """Documents are looked up some at a time; scores are those of one piece, and no lookup is much larger than a part."""
    rng = np.random.default_rng(3)
    buckets = 1 << 10
    m = toxicity.Model(
        rng.normal(0, 0.1, (buckets, 8)).astype("f4"), {w: rng.normal(0, 0.3, (w, 8, 8)).astype("f4") for w in toxicity.WIDTHS},
        {w: np.zeros(8, "f4") for w in toxicity.WIDTHS}, rng.normal(0, 1, 24).astype("f4"), 0.0,
    )
    docs = [rng.integers(1, buckets, (n, 3)).astype(np.int32) for n in (20_000, 0, 1, 45_000, 2, 30_000, 70_000, 5)]
    want = m.pooled(*toxicity._joined(docs), m.tables()) @ m.out
    seen, plain = [], toxicity.Model.pooled
    monkeypatch.setattr(toxicity.Model, "pooled", lambda self, ids, *a: (seen.append(len(ids)), plain(self, ids, *a))[1])
    assert np.array_equal(m.logits(docs), want)
    assert len(seen) > 1 and max(seen) < 125_000
    words = toxicity.Words(buckets, keep=3)
    assert [words("One two three four one").tolist()[i] for i in (0, 4)] == [toxicity.Words(buckets)("one").tolist()[0]] * 2
    assert words("").shape == words(None).shape == (0, 3) and words("two").tolist() == toxicity.Words(buckets)("two").tolist()
