"""Toxicity: a bidirectional gated recurrent network with attention pooling,
trained in numpy and applied to all overlapping windows of a text.

Input of a word (lower-cased, outer punctuation off): the embedding of the
word, if the training texts have it often enough, the mean embedding of its
first 2, 3, 4 and 5 bytes, and that of its trigrams of bytes (both hashed).
Two gated recurrent layers read a window of ``WINDOW`` words from either end;
attention pools their states into one score.  A document's score is that of its
highest window; windows start every ``STEP`` words and the last one ends with
the text, so every word of every text is scored.

Training takes a bounded sample: at most ``POSITIVES`` and ``NEGATIVES``
labelled documents of up to ``TRAIN_CHARS`` characters, by hash of the id, and
none whose crc32(doc_id) mod 5 is 0.  Only documents are labelled, so training
alternates between finding each document's highest windows and fitting the
network to them (gradients by hand, Adam).  The first dimension of the word
and prefix embeddings starts as the smoothed log odds of their documents.  A fixed seed makes
reruns agree.

Scoring is one pass over the rows: nothing is shuffled, and the network
(a few MB whatever the corpus) goes along with the tasks.  A text without words
(or null) scores the share of label 1 in the sample; without labels of both
kinds every text does.  Null labels are left out, repeated ones take the
largest.  A null id counts as held out.  Repeated rows each get their row; an
empty table gives no rows; texts are scored whole, however long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, map_batches, table
from .token_counts import slices

WINDOW, STEP, HIDDEN, DIM, ATTENTION = 24, 12, 12, 8, 8
POSITIVES, NEGATIVES, TRAIN_CHARS, VOCABULARY = 800, 2200, 20_000, 20_000
ROUNDS, BATCH, RATE, SEED = 5, 256, 0.01, 7
HASHES = 1 << 14
PREFIXES = (2, 3, 4, 5)
_EDGE = b".,;:!?\"'()[]{}#*$%&|<>-_/"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


class Numbering(dict):
    """Numbers words in the order they come up."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


class Features:
    """Table rows of each of some words: word, prefixes, trigrams."""

    def __init__(self, words: list[bytes], vocabulary: dict[bytes, int]):
        words = [w.strip(_EDGE) or w for w in words]
        self.word = np.array([vocabulary.get(w, 0) for w in words], np.int64)
        self.count = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(b"^%b$" % w for w in words) + bytes(max(PREFIXES)), np.uint8).astype(np.uint64)
        self.start = np.cumsum(self.count + 2) - self.count - 2
        code = data[:-2] | (data[1:-1] << np.uint64(8)) | (data[2:] << np.uint64(16))
        inner = np.ones(int((self.count + 2).sum()), bool)
        ends = self.start + self.count + 2
        inner[ends - 1] = inner[ends - 2] = False
        self.trigrams = (_mix(code[:len(inner)][inner]) % np.uint64(HASHES)).astype(np.int64)
        self.first = np.cumsum(self.count) - self.count
        h, rows = np.zeros(len(words), np.uint64), []
        for j in range(1, max(PREFIXES) + 1):
            byte = np.where(j <= self.count + 1, data[self.start + j], np.uint64(0))
            h = _mix(h * np.uint64(0x100000001B3) + byte + np.uint64(1))
            if j in PREFIXES:
                rows.append(h % np.uint64(HASHES))
        self.prefix = np.stack(rows, 1).astype(np.int64)

    def vectors(self, p: dict) -> np.ndarray:
        tri = np.add.reduceat(p["trigram"][self.trigrams], self.first, axis=0) / self.count[:, None]
        return np.concatenate([p["word"][self.word], p["prefix"][self.prefix].mean(1), tri], 1, dtype=np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def attend(p: dict, states: np.ndarray, mask: np.ndarray):
    u = np.tanh(states @ p["A"] + p["a"])
    s = np.where(mask, u @ p["v"], -1e9)
    weight = np.exp(s - s.max(1, keepdims=True))
    weight /= weight.sum(1, keepdims=True)
    pooled = np.einsum("bt,bth->bh", weight, states)
    return u, weight, pooled, pooled @ p["w"] + p["c"][0]


def recur(inputs: np.ndarray, U: np.ndarray, mask: np.ndarray, order, states: np.ndarray, keep: list | None = None) -> None:
    """Runs one gated layer over ``inputs(t)`` in ``order``; writes its states."""
    H = HIDDEN
    h = np.zeros((len(mask), H), np.float32)
    for t in order:
        g, hu = inputs(t), h @ U
        rz = sigmoid(g[:, :2 * H] + hu[:, :2 * H])
        r, z = rz[:, :H], rz[:, H:]
        n = np.tanh(g[:, 2 * H:] + r * hu[:, 2 * H:])
        new = n + z * (h - n)
        if keep is not None:
            keep.append((t, h, r, z, n, hu[:, 2 * H:]))
        h = new if mask[:, t].all() else np.where(mask[:, t, None], new, h)
        states[:, t] = h


def window_logits(p: dict, vectors: np.ndarray, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logit of each window (rows of word numbers into ``vectors``)."""
    projected = [vectors @ p[f"W{d}"] + p[f"b{d}"] for d in (0, 1)]
    out = []
    for i in range(0, len(ids), 4096):
        some, m = ids[i:i + 4096], mask[i:i + 4096]
        states = np.empty((len(some), WINDOW, 2 * HIDDEN), np.float32)
        for d, order in ((0, range(WINDOW)), (1, range(WINDOW - 1, -1, -1))):
            recur(lambda t, q=projected[d]: q[some[:, t]], p[f"U{d}"], m, order, states[:, :, d * HIDDEN:(d + 1) * HIDDEN])
        out.append(attend(p, states, m)[3])
    return np.concatenate(out) if out else np.empty(0, np.float32)


def windows(lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over concatenated texts: places and mask of each window, and the number
    of its text."""
    starts, sizes, of, base = [], [], [], 0
    for i, n in enumerate(lengths):
        if n:
            s = [*range(0, n - WINDOW, STEP), n - WINDOW] if n > WINDOW else [0]
            starts += [base + x for x in s]
            sizes += [min(n, WINDOW)] * len(s)
            of += [i] * len(s)
        base += n
    t, sizes = np.arange(WINDOW), np.array(sizes, np.int64)
    at = np.array(starts, np.int64)[:, None] + np.minimum(t[None, :], np.maximum(sizes - 1, 0)[:, None])
    return at, t[None, :] < sizes[:, None], np.array(of, np.int64)


def numbered(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, list[int]]:
    """Different words, the texts' words as numbers, and the texts' lengths."""
    numbers, ids, lengths = Numbering(), [], []
    for text in texts:
        words = words_of(text)
        ids += map(numbers.__getitem__, words)
        lengths.append(len(words))
    return list(numbers), np.array(ids, np.int64), lengths


def gradients(p: dict, X: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[dict, np.ndarray]:
    """Of the mean logistic loss, by parameter and by input."""
    B, H = len(X), HIDDEN
    states, keeps, g = np.empty((B, WINDOW, 2 * H), np.float32), [], {}
    for d, order in ((0, range(WINDOW)), (1, range(WINDOW - 1, -1, -1))):
        G, keep = X @ p[f"W{d}"] + p[f"b{d}"], []
        recur(lambda t, G=G: G[:, t], p[f"U{d}"], mask, order, states[:, :, d * H:(d + 1) * H], keep)
        keeps.append(keep)
    u, weight, pooled, logit = attend(p, states, mask)
    d_logit = (sigmoid(logit) - label) / B
    g["w"], g["c"] = pooled.T @ d_logit, np.array([d_logit.sum()])
    d_pooled = d_logit[:, None] * p["w"]
    d_weight = np.einsum("bh,bth->bt", d_pooled, states)
    d_s = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
    g["v"] = np.einsum("bt,btk->k", d_s, u)
    d_u = d_s[:, :, None] * p["v"] * (1 - u * u)
    g["A"], g["a"] = np.einsum("bth,btk->hk", states, d_u), d_u.sum((0, 1))
    d_states = weight[:, :, None] * d_pooled[:, None, :] + d_u @ p["A"].T
    d_X = np.zeros_like(X)
    for d in (0, 1):
        U, d_U, d_G, d_next = p[f"U{d}"], np.zeros_like(p[f"U{d}"]), np.empty((B, WINDOW, 3 * H), np.float32), 0.0
        for t, h, r, z, n, hu in reversed(keeps[d]):
            d_h, m = d_states[:, t, d * H:(d + 1) * H] + d_next, mask[:, t, None]
            d_new = np.where(m, d_h, 0)
            d_n = d_new * (1 - z) * (1 - n * n)
            d_rz = np.concatenate([d_n * hu * r * (1 - r), d_new * (h - n) * z * (1 - z)], 1)
            d_hu = np.concatenate([d_rz, d_n * r], 1)
            d_G[:, t] = np.concatenate([d_rz, d_n], 1)
            d_U += h.T @ d_hu
            d_next = np.where(m, d_new * z, d_h) + d_hu @ U.T
        g[f"U{d}"], g[f"b{d}"] = d_U, d_G.sum((0, 1))
        g[f"W{d}"] = np.einsum("btf,btg->fg", X, d_G)
        d_X += d_G @ p[f"W{d}"].T
    return g, d_X


def log_odds(rows: np.ndarray, docs: np.ndarray, label: np.ndarray, size: int) -> np.ndarray:
    """For each table row, the smoothed log odds of the documents with it
    against those of all; pairs (row, document) may repeat."""
    pairs = np.unique(rows.astype(np.int64) * len(label) + docs)
    row, y = pairs // len(label), label[pairs % len(label)]
    n, pos, share = np.bincount(row, minlength=size), np.bincount(row, y, size), label.mean()
    odds = (pos + 10 * share) / (n + 10)
    return np.log(odds / (1 - odds)) - np.log(share / (1 - share))


def train(texts: list[str], labels: list[int], rounds: int = ROUNDS, seed: int = SEED) -> dict | None:
    """The network's parameters; None without labels of both kinds."""
    label = np.array(labels, np.float32)
    if not len(label) or label.min() == label.max():
        return None
    rng = np.random.default_rng(seed)
    words, ids, lengths = numbered(texts)
    of_doc = np.repeat(np.arange(len(texts)), lengths)
    stripped = [w.strip(_EDGE) or w for w in words]
    pairs = np.unique(ids * len(texts) + of_doc)
    common: dict[bytes, int] = {}
    for w, n in zip(stripped, np.bincount(pairs // len(texts), minlength=len(words)).tolist()):
        common[w] = common.get(w, 0) + n
    vocabulary = {w: i for i, (w, _) in enumerate(sorted(((w, n) for w, n in common.items() if n >= 3), key=lambda x: (-x[1], x[0]))[:VOCABULARY], 1)}
    f = Features(words, vocabulary)
    H, F3 = HIDDEN, 3 * DIM
    init = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
    p = {"word": init(len(vocabulary) + 1, DIM, by=0.1), "prefix": init(HASHES, DIM, by=0.1), "trigram": init(HASHES, DIM, by=0.1)}
    for d in (0, 1):
        p |= {f"W{d}": init(F3, 3 * H, by=F3**-0.5), f"U{d}": init(H, 3 * H, by=H**-0.5), f"b{d}": np.zeros(3 * H, np.float32)}
        p[f"b{d}"][H:2 * H] = -1  # states start out following the input
    p |= {"A": init(2 * H, ATTENTION, by=(2 * H)**-0.5), "a": np.zeros(ATTENTION, np.float32), "v": init(ATTENTION, by=0.5), "w": init(2 * H, by=0.5), "c": np.array([-2.0], np.float32)}
    word, doc = pairs // len(texts), pairs % len(texts)
    start = {"word": log_odds(f.word[word], doc, label, len(vocabulary) + 1),
             "prefix": log_odds(f.prefix[word].ravel(), np.repeat(doc, len(PREFIXES)), label, HASHES)}
    for k, odds in start.items():
        p[k][:, 0] = np.clip(odds, -3, 3)
    p["word"][0] = 0
    at, mask, of = windows(lengths)
    tokens = ids[at]
    first = np.where(mask, (f.vectors(p) * np.tile(np.eye(1, DIM, dtype=np.float32), 3)).sum(1)[tokens], -9.0)
    score = first.max(1)  # of the first round: the most telling word
    moments: dict = {}
    step = 0
    for _ in range(rounds):
        order = np.lexsort((-score, of))
        rank = np.arange(len(of)) - np.searchsorted(of[order], of[order])
        chosen = order[rank < 2]
        chosen = np.concatenate([chosen, rng.choice(np.flatnonzero(label[of] == 0), min(len(chosen) // 2, int((label[of] == 0).sum())), replace=False)])
        second = np.isin(chosen, order[rank == 1]) & (label[of[chosen]] == 1)
        chosen = chosen[~second]  # a toxic text's highest window alone, others' two highest
        for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // BATCH)):
            step += 1
            used, inverse = np.unique(tokens[part], return_inverse=True)
            sub = Features([words[i] for i in used], vocabulary)
            vectors = sub.vectors(p)
            g, d_X = gradients(p, vectors[inverse.reshape(tokens[part].shape)], mask[part], label[of[part]])
            d_V = np.zeros_like(vectors)
            np.add.at(d_V, inverse.ravel(), d_X.reshape(-1, F3))
            for k in ("word", "prefix", "trigram"):
                g[k] = np.zeros_like(p[k])
            np.add.at(g["word"], sub.word, d_V[:, :DIM])
            np.add.at(g["prefix"], sub.prefix.ravel(), np.repeat(d_V[:, DIM:2 * DIM] / len(PREFIXES), len(PREFIXES), 0))
            np.add.at(g["trigram"], sub.trigrams, np.repeat(d_V[:, 2 * DIM:] / sub.count[:, None], sub.count, 0))
            g["word"][0] = 0
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            for k, x in g.items():
                a, b = moments.get(k, (0.0, 0.0))
                x = x * min(1.0, 1.0 / max(norm, 1e-9))
                a, b = 0.9 * a + 0.1 * x, 0.99 * b + 0.01 * x * x
                moments[k] = (a, b)
                p[k] = (p[k] - RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        score = window_logits(p, f.vectors(p), tokens, mask)
    p["vocabulary"], p["share"] = vocabulary, float(label.mean())
    return p


def score_texts(p: dict | None, texts: list[str | None], share: float = 0.0) -> list[float]:
    """A score from 0 to 1 of each whole text."""
    if p is None:
        return [share] * len(texts)
    out = []
    for part in slices([t or "" for t in texts], 700_000):
        words, ids, lengths = numbered(part)
        scores = np.full(len(part), p["share"])
        if len(ids):
            at, mask, of = windows(lengths)
            logit = window_logits(p, Features(words, p["vocabulary"]).vectors(p), ids[at], mask)
            firsts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            scores[of[firsts]] = sigmoid(np.maximum.reduceat(logit, firsts).astype(np.float64))
        out += scores.tolist()
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> tuple[dict | None, float]:
    """The network and the share of label 1 in its sample.  The driver gets
    the sample's ids, then its texts, one for each id."""
    rows = labels.select(col(labels, "doc_id").cast("long").alias("id"), col(labels, "toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    doc_id, text = col(docs, "doc_id").cast("long"), col(docs, "text")
    short = docs.where(F.length(text) <= TRAIN_CHARS).select(doc_id.alias("id"), text.alias("text"))
    rows = rows.join(short.select("id").distinct(), "id", "left_semi")  # labels without such a text take no place
    label: dict[int, int] = {}
    for value, n in ((1, positives), (0, negatives)):
        some = rows.where((F.col("toxic") > 0) == bool(value)).orderBy(F.xxhash64("id"), "id").limit(n)
        label |= {r.id: value for r in some.collect()}
    if not label:
        return None, 0.0
    found = short.where(F.col("id").isin(list(label))).groupBy("id").agg(F.max("text").alias("text"))  # ids may repeat
    texts = dict(sorted(found.collect()))
    y = [label[i] for i in texts]
    return train(list(texts.values()), y), sum(y) / len(y) if y else 0.0


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score of every row."""
    p, share = fit(spark, docs, labels)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column("doc_id"), pa.array(score_texts(p, batch.column("text").to_pylist(), share), pa.float64())], ["doc_id", "score"])

    some = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), col(docs, "text").alias("text"))
    return map_batches(some, rows, "doc_id long, score double")


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; all rows when the
    sample has not both kinds of label."""
    p, share = fit(spark, docs, labels)
    if p is None:
        return docs

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = score_texts(p, batch.column("text").to_pylist(), share)
        return batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return map_batches(docs, rows, docs.schema)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
