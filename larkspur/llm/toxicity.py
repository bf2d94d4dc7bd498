"""Toxicity: a convolutional text classifier on hashed words, trained in numpy."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import give_back

WIDTHS = (1, 2, 3)
FEATURES = 3
_WORD = re.compile(r"[^\W_]+")


class Words:
    """Texts to hashed word features: each word gives three numbers, for the word, its first
    four and its last four characters, so inflected forms share what they have in common.
    0 stands for no word."""

    def __init__(self, buckets: int, keep: int = 100_000):
        self.buckets, self.keep = buckets, keep
        self.known: dict[str, int] = {}
        self.rows = array("i")  # three numbers a word

    def _number(self, w: str) -> int:
        at = lambda kind, s: 1 + zlib.crc32(f"{kind}{s}".encode()) % (self.buckets - 1)
        self.known[w] = len(self.known)
        self.rows.extend((at("w", w), at("a", w[:4]), at("z", w[-4:])))
        return self.known[w]

    def __call__(self, text: str | None) -> np.ndarray:
        """Features of the whole text, words x 3."""
        if len(self.known) > self.keep:
            self.known.clear()
            self.rows = array("i")
        parts, text, at = [], text or "", 0
        while at < len(text):
            end = at + (1 << 20)
            while end < len(text) and not text[end].isspace():  # a part ends between words
                end += 1
            found = _WORD.findall(text[at:end].lower())
            at = end
            for w in set(found):
                if w not in self.known:
                    self._number(w)
            known = self.known
            parts.append(np.fromiter((known[w] for w in found), np.int64, len(found)))
        numbers = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return np.frombuffer(self.rows, np.int32).reshape(-1, FEATURES)[numbers] if len(numbers) else np.zeros((0, FEATURES), np.int32)


@dataclass
class Model:
    """``embed`` (buckets x dim), per width a filter bank (width x dim x filters) and bias,
    the output weights, and a score scale fitted on rows kept from training."""

    embed: np.ndarray
    banks: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str | None, float] = field(default_factory=dict)
    threshold: float = 0.5

    def tables(self) -> dict[int, list[np.ndarray]]:
        """A filter is a sum over the features of the words it covers, so each feature's share is looked up."""
        return {w: [self.embed @ bank[j] for j in range(w)] for w, bank in self.banks.items()}

    def pooled(self, ids: np.ndarray, starts: np.ndarray, tables) -> np.ndarray:
        """Largest filter values of each document; ``ids`` are documents with empty words
        after each, ``starts`` where they begin."""
        parts = []
        words, of = np.unique(ids[:, 0].astype(np.int64) << 40 | ids[:, 1].astype(np.int64) << 20 | ids[:, 2], return_inverse=True)
        features = np.stack([words >> 40, words >> 20 & 0xFFFFF, words & 0xFFFFF], axis=1)
        for w, shares in tables.items():
            each = [s[features].sum(1) for s in shares]
            z = each[0][of]
            for j in range(1, w):
                z[:-j] += each[j][of[j:]]
            parts.append(np.maximum(np.maximum.reduceat(z, starts, axis=0) + self.biases[w], 0))
        return np.concatenate(parts, axis=1)

    def logits(self, docs: list[np.ndarray], tables=None) -> np.ndarray:
        tables = tables or self.tables()
        out, at, step = np.zeros(len(docs)), 0, 400_000
        while at < len(docs):
            n, end = 0, at
            while end < len(docs) and (end == at or n + len(docs[end]) < step):
                n += len(docs[end])
                end += 1
            if end == at + 1 and n > step:  # a long document, in overlapping stretches
                d = docs[at]
                most = [self.pooled(*_joined([d[i : i + step + 2]]), tables) for i in range(0, len(d), step)]
                pooled = np.max(most, axis=0)
            else:  # some at a time, so that what is looked up stays small
                sizes = np.cumsum([len(d) for d in docs[at:end]])
                cuts = [at, *(at + 1 + np.flatnonzero(np.diff(sizes // 50_000))).tolist(), end]
                # windows in the gap reach the first words behind it, so those follow here as they do in one piece
                ahead = [[docs[j][: max(WIDTHS) - 1]] if j < end else [] for j in cuts[1:]]
                most = [self.pooled(*_joined([*docs[i:j], *a]), tables)[: j - i] for i, j, a in zip(cuts, cuts[1:], ahead)]
                pooled = np.concatenate(most)
            out[at:end] = pooled @ self.out + self.bias
            at = end
        return out

    def scores(self, docs: list[np.ndarray], tables=None) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.logits(docs, tables) + b, -30, 30)))


def _joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents one after another, each followed by empty words so that no filter sees two."""
    gap = np.zeros((max(WIDTHS), FEATURES), np.int32)
    lens = np.array([len(d) + len(gap) for d in docs])
    return np.concatenate([x for d in docs for x in (d, gap)]), np.concatenate([[0], np.cumsum(lens)[:-1]])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit_scale(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and offset of a logistic curve over the logits: penalised Newton steps
    on standardised values, each halved until the loss falls."""
    if not len(z):
        return 1.0, 0.0
    mid, width = z.mean(), z.std() + 1e-9
    x = (z - mid) / width

    def loss(v):
        u = v[0] * x + v[1]
        return np.logaddexp(0, u).sum() - (y * u).sum() + 0.5 * v[0] ** 2 + 0.005 * v[1] ** 2

    v = np.array([1.0, 0.0])
    for _ in range(60):
        p = _sigmoid(v[0] * x + v[1])
        w = p * (1 - p)
        g = np.array([((p - y) * x).sum() + v[0], (p - y).sum() + 0.01 * v[1]])
        h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step, size, before = np.linalg.solve(h, g), 1.0, loss(v)
        while loss(v - size * step) > before and size > 1e-6:
            size /= 2
        v = v - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    slope = max(v[0], 1e-3) / width
    return float(slope), float(v[1] - slope * mid)


def _best_threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """Cut with the fewest errors, half-way to the next score; nearest to 0.5 among equals."""
    order = np.argsort(scores)
    s, t = scores[order], y[order]
    errors = np.concatenate([[0], np.cumsum(t)]) + (len(t) - t.sum() - np.concatenate([[0], np.cumsum(1 - t)]))
    cuts = np.concatenate([[s[0] / 2], (s[:-1] + s[1:]) / 2, [(s[-1] + 1) / 2]])
    allowed = np.concatenate([[True], s[1:] > s[:-1], [True]])
    rank = np.where(allowed, errors + np.abs(cuts - 0.5), np.inf)
    return float(cuts[int(np.argmin(rank))])


def train(
    docs: list[np.ndarray], labels: np.ndarray, langs: list, buckets: int, dim: int = 8, filters: int = 8,
    epochs: int = 3, batch: int = 64, rate: float = 0.02, rare: int = 4, seed: int = 7,
) -> Model:
    """Fits the network on four fifths of the rows; scale and thresholds on the last fifth.

    The first embedding dimension starts from each word's log odds in the fitted rows
    (shrunk, so a word in a few documents starts near 0); the rest starts small and
    random. Words in fewer than ``rare`` documents keep an embedding of 0.
    """
    rng = np.random.default_rng(seed)
    y = labels.astype(float)
    n = len(docs)
    held = np.zeros(n, bool)
    for c in (0, 1):  # every fifth row of either class
        held[np.flatnonzero(y == c)[4::5]] = True
    fit = np.flatnonzero(~held)
    df = np.zeros((2, buckets))
    for i in fit:
        df[int(y[i]), np.unique(docs[i])] += 1  # by document, any of the three features
    p = np.clip(y[fit].mean() if len(fit) else 0.5, 0.02, 0.98)
    odds = np.log((df[1] + 20 * p) / (df[0] + 20 * (1 - p))) - np.log(p / (1 - p))
    known = df.sum(0) >= rare
    known[0] = False
    embed = np.where(known[:, None], rng.normal(0, 0.1, (buckets, dim)), 0.0).astype(np.float32)
    embed[:, 0] = np.where(known, odds, 0)
    banks = {w: rng.normal(0, 0.3, (w, dim, filters)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        banks[w][:, 0, 0] = 1.0 / w
    m = Model(embed, banks, {w: np.zeros(filters, np.float32) for w in WIDTHS}, np.zeros(len(WIDTHS) * filters, np.float32), 0.0)
    tables = m.tables()
    m.out[0] = 1.0
    a, b = _fit_scale(m.logits([docs[i] for i in fit], tables), y[fit])  # the output starts from the strongest word
    m.out[0], m.bias = a, b
    m.out[1:] = 0.01
    params = {"out": m.out, **{("bank", w): m.banks[w] for w in WIDTHS}, **{("bias", w): m.biases[w] for w in WIDTHS}}
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in params.items()}
    seen = np.full(embed.shape, 1e-3, np.float32)
    t = 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for at in range(0, len(fit), batch):
            rows = fit[at : at + batch]
            ids, starts = _joined([docs[i] for i in rows])
            of = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(ids))))
            x = m.embed[ids].sum(1)
            grads, pools, where = {}, [], {}
            for w in WIDTHS:
                z = x @ m.banks[w][0]
                for j in range(1, w):
                    z[:-j] += x[j:] @ m.banks[w][j]
                top = np.maximum.reduceat(z, starts, axis=0)
                r, c = np.nonzero(z == top[of])
                first = np.zeros(top.shape, np.int64)
                first[of[r[::-1]], c[::-1]] = r[::-1]
                where[w] = first
                pools.append(top + m.biases[w])
            pre = np.concatenate(pools, axis=1)
            h = np.maximum(pre, 0)
            d = (_sigmoid(h @ m.out + m.bias) - y[rows]) / len(rows)
            grads["out"] = h.T @ d
            m.bias -= rate * float(d.sum())
            back = (d[:, None] * m.out[None, :] * (pre > 0)).astype(np.float32)
            for k, w in enumerate(WIDTHS):
                g = back[:, k * filters : (k + 1) * filters]
                grads[("bias", w)] = g.sum(0)
                bank = np.zeros_like(m.banks[w])
                for j in range(w):
                    pos = np.minimum(where[w] + j, len(ids) - 1)
                    bank[j] = np.einsum("df,dfe->ef", g, x[pos])
                    to = (g[:, :, None] * m.banks[w][j].T[None]).reshape(-1, m.embed.shape[1])
                    word, to = ids[pos].reshape(-1), np.repeat(to, FEATURES, axis=0)
                    live = known[word] & (np.abs(to).max(1) > 0)
                    word, to = word[live], to[live]
                    np.add.at(seen, word, to * to)
                    np.add.at(m.embed, word, -rate * to / np.sqrt(seen[word] + 1e-4))
                grads[("bank", w)] = bank
            t += 1
            for key, g in grads.items():
                a, b = state[key]
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                params[key] -= 0.1 * rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    check = np.flatnonzero(held) if len(set(y[held])) == 2 else np.arange(n)
    if len(set(y[check])) == 2:
        z = m.logits([docs[i] for i in check])
        m.scale = _fit_scale(z, y[check])
        s = _sigmoid(m.scale[0] * z + m.scale[1])
        m.threshold = _best_threshold(s, y[check])
        tongue = np.array([str(langs[i]) for i in check])
        for lang in sorted({langs[i] for i in check}, key=str):
            mine = tongue == str(lang)
            if min(y[check][mine].sum(), (1 - y[check][mine]).sum()) >= 5:
                m.thresholds[lang] = _best_threshold(s[mine], y[check][mine])
    return m


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 5000, buckets: int = 1 << 15, **options) -> Model:
    """A model from at most about ``max_rows`` labelled rows: those with the smallest hash of doc_id
    among the rows that are not held out. This bound is what reaches the driver, which trains."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.withColumn("place", F.xxhash64("doc_id"))
    last = known.select("place").orderBy("place").limit(max_rows).agg(F.max("place")).first()[0]
    chosen = known.where(F.col("place") <= F.lit(last))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(buckets)
        for b in batches:
            ids = [words(t.as_py()).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("place", "toxic", "lang")] + [pa.array(ids, pa.binary())], names=["place", "toxic", "lang", "ids"])
        del words
        give_back()

    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).join(F.broadcast(chosen), "doc_id")
    # one row of a repeated doc_id, so that the bound holds for rows too
    one = F.min(F.struct(F.xxhash64("text", "lang").alias("h"), "toxic", "lang", "text")).alias("r")
    rows = rows.groupBy("place").agg(one).select("place", "r.*")
    one = rows.select("place", "toxic", "lang", "text").mapInArrow(encode, "place long, toxic int, lang string, ids binary")
    got = sorted(one.collect(), key=lambda r: (r["place"], bytes(r["ids"])))
    ids = [np.frombuffer(bytes(r["ids"]), np.int32).reshape(-1, FEATURES) for r in got]
    return train(ids, np.array([r["toxic"] for r in got], int), [r["lang"] for r in got], buckets, **options)


def score(docs: DataFrame, model: Model, buckets: int = 1 << 15) -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1), ``threshold`` (of the language) and ``toxic``.

    The score reads the whole text and nothing else; the language only chooses the
    threshold. Null and empty texts get the score of a document without words, an
    unknown or null language the general threshold. Repeated rows score alike, an empty
    table gives no rows, and columns of the new names are replaced.
    """
    docs = docs.drop("score", "threshold", "toxic", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tables = Words(buckets), model.tables()
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                found = model.scores([words(t.as_py()) for t in part.column(part.num_columns - 1)], tables)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.float64())], names=[*part.schema.names[:-1], "score"])
            give_back()

    kept = T_fields(docs)
    out = docs.withColumn("__text", F.col("text").cast("string")).mapInArrow(run, f"{kept}, score double")
    cut = F.lit(model.threshold)
    for lang, value in model.thresholds.items():
        same = F.col("lang").isNull() if lang is None else F.col("lang") == lang
        cut = F.when(same, F.lit(value)).otherwise(cut)
    return out.withColumn("threshold", cut).withColumn("toxic", F.col("score") >= F.col("threshold"))


def T_fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
