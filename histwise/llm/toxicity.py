"""Toxicity by a linear-chain conditional random field over words.

Training uses a bounded sample of the labelled rows (``TRAIN_DOCS`` of them, by a hash of their
id, each of at most ``TRAIN_CHARS`` code points; longer ones are only left out of the sample):
1. Word and prefix features that stand in toxic documents far more often than in others (document
   counts, log-likelihood ratio) form the lexicon. Words of toxic documents that have such a
   feature are the labelled toxic tokens, all others are labelled clean.
2. A chain with two tags (clean, toxic), feature weights and transition weights is fitted to
   these tokens by its exact likelihood (forward-backward, Adam).
3. Documents are scored by forward-backward marginals: their sum, their rate and their maximum
   enter a logistic function, fitted on documents that the chain in use has not seen (two folds).

Scoring reads each whole text once, without a shuffle: runs of words without features are one
matrix power, so the exact marginals cost time only at words with features. Words whose marginal
is at least 0.5 are the offending spans.

Inputs: null and empty texts have no words and get the score of a text without features; texts of
any length are read whole; repeated rows get equal scores; labels that are null or whose document
is absent are not learned from, of repeated labels the highest counts; without toxic or without
clean labels every score is their smoothed share; a null doc_id counts as held out; an empty
table gives an empty result; further columns are not read. Only the text is an input of a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from histwise.llm.bpe import slices
from histwise.llm.common import OWN, ready, text_or_empty

TRAIN_DOCS, TRAIN_CHARS = 4000, 20_000
FOLDS = 5
PREFIXES = (3, 4, 5, 6, 7)
MIN_DOCS, MIN_RATIO, MIN_GAIN = 3, 4.0, 20.0
SEGMENT, ROUNDS, RATE, L2 = 32, 60, 0.25, 1e-3
#: Share of the labelled sample's segments without any lexicon feature that the chain learns from. Scoring
#: takes every segment of every text.
PLAIN_SEGMENTS = 0.05
#: Words that a task remembers; bounds the memory only.
MEMO_WORDS = 1 << 19
WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    word = word.lower()
    return ["=" + word] + [word[:n] for n in PREFIXES if len(word) >= n]


@dataclass
class Chain:
    """The fitted model, small enough to send to every task."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # log weights of tag to tag
    logistic: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def __post_init__(self):
        self.memo: dict[str, float] = {}
        self.powers: dict[int, tuple[float, float, float, float]] = {}

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "steps": self.steps, "logistic": self.logistic}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def emission(self, word: str) -> float:
        """Sum of the weights of a word's features, 0.0 for a word without any."""
        total = self.memo.get(word)
        if total is None:
            get = self.weights.get
            total = sum(get(f, 0.0) for f in features(word))
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            if len(word) <= 64:
                self.memo[word] = total
        return total

    def neutral(self, n: int) -> tuple[float, float, float, float]:
        """The scaled product of ``n`` steps over words without features."""
        if n not in self.powers:
            step = np.exp(self.steps) * np.array([1.0, math.exp(self.bias)])
            out, base, left = np.eye(2), step / step.max(), n
            while left:
                if left & 1:
                    out = out @ base
                    out /= out.max()
                base = base @ base
                base /= base.max()
                left >>= 1
            if len(self.powers) > 1 << 16:
                self.powers.clear()
            self.powers[n] = tuple(map(float, out.ravel()))
        return self.powers[n]

    def marginals(self, emissions: list[tuple[int, float]], n: int) -> list[float]:
        """P(toxic) at the words with features (place, emission) of a text of ``n`` words."""
        (a00, a01), (a10, a11) = np.exp(self.steps).tolist()
        forward, c, t, last = [], 1.0, 0.0, -1
        for place, e in emissions:
            m00, m01, m10, m11 = self.neutral(place - last - 1)
            c, t = c * m00 + t * m10, c * m01 + t * m11
            w = math.exp(min(50.0, self.bias + e))
            c, t = c * a00 + t * a10, (c * a01 + t * a11) * w
            s = c + t
            c, t = c / s, t / s
            forward.append((c, t))
            last = place
        out, b0, b1, after = [], 1.0, 1.0, n
        for (place, e), (c, t) in zip(reversed(emissions), reversed(forward)):
            m00, m01, m10, m11 = self.neutral(after - place - 1)
            b0, b1 = m00 * b0 + m01 * b1, m10 * b0 + m11 * b1
            out.append(t * b1 / (c * b0 + t * b1))
            w = math.exp(min(50.0, self.bias + e))
            b0, b1 = a00 * b0 + a01 * w * b1, a10 * b0 + a11 * w * b1
            s = b0 + b1
            b0, b1, after = b0 / s, b1 / s, place
        return out[::-1]

    def tag(self, words: list[str]) -> tuple[list[int], list[float]]:
        """Places of the words with features, and their marginals."""
        found = list(map(self.memo.get, words))
        if None in found:
            found = [self.emission(w) if e is None else e for w, e in zip(words, found)]
        active = [(i, e) for i, e in enumerate(found) if e]
        return [i for i, _ in active], self.marginals(active, len(words))

    def summary(self, words: list[str]) -> list[float]:
        _, p = self.tag(words)
        total = sum(p)
        return [1.0, math.log1p(total), math.log1p(100 * total / (len(words) + 10)), max(p, default=0.0)]

    def score(self, summary: list[float]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(self.logistic, summary))))))


def lexicon(docs: list[list[str]], toxic: np.ndarray, ids: dict[str, list[int]], names: list[str]) -> list[int]:
    """Features that toxic documents hold far more often."""
    counts = np.zeros((2, len(names)))
    for words, y in zip(docs, toxic):
        counts[int(y), list({f for w in set(words) for f in ids[w]})] += 1
    (b, a), total = counts, np.array([(~toxic).sum(), toxic.sum()], float)
    ratio = ((a + 0.5) / (total[1] + 1)) / ((b + 0.5) / (total[0] + 1))
    rate = (a + b) / total.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 2 * (np.where(a > 0, a * np.log(a / (rate * total[1])), 0) + np.where(b > 0, b * np.log(b / (rate * total[0])), 0))
    return np.nonzero((a >= MIN_DOCS) & (ratio >= MIN_RATIO) & (gain >= MIN_GAIN))[0].tolist()


def fit_chain(docs: list[list[str]], toxic: np.ndarray, ids: dict[str, list[int]], names: list[str]) -> Chain:
    """Lexicon, token labels and the chain's weights."""
    chosen = {f: i for i, f in enumerate(lexicon(docs, toxic, ids, names))}
    if not chosen:
        return Chain()
    rows, labels, held = [], [], []  # segments: features of each word, tags, lengths
    rng = np.random.default_rng(71)
    for words, y in zip(docs, toxic):
        own = [[chosen[f] for f in ids[w] if f in chosen] for w in words]
        for i in range(0, len(own), SEGMENT):
            part = own[i:i + SEGMENT]
            if any(part) or rng.random() < PLAIN_SEGMENTS:
                rows.append(part)
                labels.append([bool(y and f) for f in part])
                held.append(len(part))
    n, width = len(rows), SEGMENT
    mask = np.arange(width) < np.array(held)[:, None]
    tags = np.zeros((n, width), bool)
    for i, row in enumerate(labels):
        tags[i, :len(row)] = row
    seg, pos, feat = (np.array(x, np.int64) for x in zip(*[(i, j, f) for i, row in enumerate(rows) for j, fs in enumerate(row) for f in fs]))
    weights, bias, steps = np.zeros(len(chosen)), -3.0, np.zeros((2, 2))
    seen = tags.astype(int)
    from_tag = np.concatenate([np.zeros((n, 1), int), seen[:, :-1]], axis=1)
    observed = np.array([[(mask & (from_tag == s) & (seen == t)).sum() for t in (0, 1)] for s in (0, 1)], float)
    size = float(mask.sum())
    moment = [np.zeros_like(weights), 0.0, np.zeros((2, 2))]
    power = [np.zeros_like(weights), 0.0, np.zeros((2, 2))]
    for step in range(1, ROUNDS + 1):
        emission = np.full((n, width), bias)
        np.add.at(emission, (seg, pos), weights[feat])
        gamma, pairs = forward_backward(np.clip(emission, -50, 50), np.exp(steps), mask)
        error = np.where(mask, tags - gamma, 0.0)
        gradient = [np.bincount(feat, error[seg, pos], len(chosen)) / size * 1e3 - L2 * weights, error.sum() / size * 1e3, (observed - pairs) / size * 1e3 - L2 * steps]
        values = [weights, bias, steps]
        for k, g in enumerate(gradient):
            moment[k] = 0.9 * moment[k] + 0.1 * g
            power[k] = 0.99 * power[k] + 0.01 * g * g
            values[k] = values[k] + RATE * (moment[k] / (1 - 0.9 ** step)) / (np.sqrt(power[k] / (1 - 0.99 ** step)) + 1e-8)
        weights, bias, steps = values
    return Chain({names[f]: float(weights[i]) for f, i in chosen.items()}, float(bias), steps)


def forward_backward(emission: np.ndarray, step: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic tag, and expected counts of tag pairs, over padded segments. A
    segment starts after a clean word."""
    n, width = emission.shape
    weight = np.stack([np.ones_like(emission), np.exp(emission)], axis=2)
    alpha = np.zeros((width + 1, n, 2))
    alpha[0, :, 0] = 1
    for t in range(width):
        a = (alpha[t] @ step) * weight[:, t]
        a /= a.sum(axis=1, keepdims=True)
        alpha[t + 1] = np.where(mask[:, t, None], a, alpha[t])
    beta = np.ones((n, 2))
    gamma, pairs = np.zeros((n, width)), np.zeros((2, 2))
    for t in range(width - 1, -1, -1):
        on = mask[:, t, None]
        both = alpha[t + 1] * beta
        gamma[:, t] = both[:, 1] / both.sum(axis=1)
        into = weight[:, t] * beta
        joint = alpha[t][:, :, None] * step * into[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pairs += (joint * on[:, :, None]).sum(axis=0)
        b = into @ step.T
        beta = np.where(on, b / b.sum(axis=1, keepdims=True), beta)
    return gamma, pairs


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Newton steps with a penalty on all weights but the first."""
    w, ridge = np.zeros(x.shape[1]), penalty * np.diag([0.01] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    return w


def fit(texts: list[str], toxic: list[int]) -> Chain:
    """The model of a sample of labelled texts."""
    y = np.array(toxic, bool)
    prior = (y.sum() + 1) / (len(y) + 2)
    constant = Chain(logistic=np.array([math.log(prior / (1 - prior)), 0, 0, 0]))
    if y.all() or not y.any():
        return constant
    docs = [WORD.findall(t) for t in texts]
    number: dict[str, int] = {}
    ids = {w: [number.setdefault(f, len(number)) for f in features(w)] for words in docs for w in set(words)}
    names = list(number)
    order = np.argsort([hash_of(t) for t in texts], kind="stable")
    fold = np.empty(len(y), int)
    fold[order] = np.arange(len(y)) % 2
    x = np.zeros((len(y), 4))
    for k in (0, 1):
        if not y[fold != k].any() or not y[fold == k].any():
            return constant
        chain = fit_chain([d for d, f in zip(docs, fold) if f != k], y[fold != k], ids, names)
        for i in np.nonzero(fold == k)[0]:
            x[i] = chain.summary(docs[i])
    chain = fit_chain(docs, y, ids, names)
    chain.logistic = fit_logistic(x, y.astype(float))
    return chain


def hash_of(text: str) -> int:
    import zlib
    return zlib.crc32(text.encode())


def held_out(doc_id: Column) -> Column:
    """True for the rows from whose labels nothing is learned."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> Chain:
    """Fit on at most ``train_docs`` labelled rows of ``docs`` that are not held out."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias(f"{OWN}id")).agg(F.max("toxic").cast("int").alias(f"{OWN}toxic")))
    sample = known.orderBy(F.xxhash64(f"{OWN}id"), f"{OWN}id").limit(train_docs)
    rows = (docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("t")).where(F.length("t") <= train_chars)
            .join(F.broadcast(sample), F.col("id") == F.col(f"{OWN}id"))  # train_docs rows at most
            .groupBy("id").agg(F.max("t").alias("t"), F.max(f"{OWN}toxic").alias("y")).orderBy("id").collect())
    return fit([r["t"] for r in rows], [r["y"] for r in rows])


SCORED = "struct<score: double, spans: array<struct<start: int, end: int, p: double>>>"


def scorer(spark, chain: Chain):
    """A column function: text to its score and offending spans (code points, end exclusive)."""
    ready(spark)
    shared = spark.sparkContext.broadcast(chain)
    kind = pa.struct({"score": pa.float64(), "spans": pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32(), "p": pa.float64()}))})

    def one(text: str) -> dict:
        model = shared.value
        words = WORD.findall(text)
        places, p = model.tag(words)
        total = sum(p)
        score = model.score([1.0, math.log1p(total), math.log1p(100 * total / (len(words) + 10)), max(p, default=0.0)])
        bad = {i: x for i, x in zip(places, p) if x >= 0.5}
        spans = [{"start": m.start(), "end": m.end(), "p": bad[i]} for i, m in enumerate(WORD.finditer(text)) if i in bad] if bad else []
        return {"score": score, "spans": spans}

    def run(text: pa.Array) -> pa.Array:
        out = [pa.array([one(t) for t in text.slice(i, 512).to_pylist()], kind) for i in range(0, len(text), 512)]
        return pa.concat_arrays(out) if out else pa.array([], kind)

    return arrow_udf(run, SCORED)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the column ``__llm_toxicity`` (score, spans)."""
    chain = train(docs, labels)
    return docs.withColumn(f"{OWN}toxicity", scorer(docs.sparkSession, chain)(text_or_empty()))


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), labels).select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col(f"{OWN}toxicity.score").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
