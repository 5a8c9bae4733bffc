"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, per_row, table

#: Hash buckets of character n-grams, width of their vectors, lengths of the n-grams, words of a passage.
BUCKETS, WIDTH, GRAMS, PASSAGE = 1 << 17, 8, (3, 4, 5), 5
#: Labelled documents learnt from, at most about, of each class; words of each, in stretches spread evenly over longer ones.
SAMPLE_DOCS, SAMPLE_WORDS = 2500, 20_000
EPOCHS, BATCH, RATE, SEED = 4, 256, 0.15, 6
#: Passages that vectors are learnt from at most, half of each class, chosen at random where a class has more; parts of the sample, for the curve; steps of its
#: fit; passages gone through in all epochs together, about: with many, fewer epochs learn less by heart.
TRAIN_PASSAGES, PARTS, CURVE_STEPS, VISITS = 100_000, 5, 30, 160_000
#: Words kept by a worker.
KEPT = 500_000


def gram_ids(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every character n-gram of ``<word>``, word by word, and the word each belongs to."""
    raw = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    ids, owners = [], []
    for n in GRAMS:
        m = len(raw) - n + 1
        if m <= 0:
            continue
        h = np.full(m, 1469598103934665603 + n, np.uint64)
        for k in range(n):
            h = (h ^ raw[k : k + m]) * np.uint64(1099511628211)
        h ^= h >> np.uint64(29)
        ok = word[:m] == word[n - 1 :]
        ids.append((h[ok] % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(word[:m][ok])
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    by = np.argsort(owners, kind="stable")
    return ids[by], owners[by]


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


@dataclass
class ToxicityModel:
    value: np.ndarray  # of each bucket: its vector's product with the difference of the classes' weights
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, logit: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * logit + self.shift, -50, 50))))


class Scorer:
    """Logits of whole texts: a passage's is the mean of its words', a word's the mean of its n-grams'; a text's is the highest of all its passages', which overlap."""

    def __init__(self, model: ToxicityModel):
        self.model, self.number, self.value, self.n = model, {}, np.zeros(0), 0

    def logit(self, texts: list[str | None]) -> list[float]:
        return [self.words_logit(split_words(t)) for t in texts]

    def words_logit(self, words: list[bytes]) -> float:
        return float(self.passages(words).max()) + self.model.bias if words else self.model.bias

    def passages(self, words: list[bytes]) -> np.ndarray:
        """The mean value of every PASSAGE words in a row."""
        number = self.number
        if len(number) > KEPT:
            number.clear()
            self.n = 0
        row = [number.setdefault(w, len(number)) for w in words]
        if len(number) > self.n:
            new = list(islice(number, self.n, None)) if self.n * 4 < len(number) else list(islice(reversed(number), len(number) - self.n))[::-1]
            ids, owner = gram_ids(new)
            sums, n = np.bincount(owner, self.model.value[ids], len(new)), np.bincount(owner, minlength=len(new))
            if len(number) > len(self.value):
                self.value = np.concatenate([self.value[: self.n], np.zeros(max(1024, len(number)))])
            self.value[self.n : len(number)] = sums / np.maximum(n, 1)
            self.n = len(number)
        return windows(self.value[row])


def windows(value: np.ndarray) -> np.ndarray:
    """The mean of every PASSAGE words in a row; of all words, if there are fewer."""
    sums = np.cumsum(np.r_[0.0, value])
    return (sums[PASSAGE:] - sums[:-PASSAGE]) / PASSAGE if len(value) >= PASSAGE else value.mean(keepdims=True)


def train(passages: list[list[bytes]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ToxicityModel:
    """Vectors and class weights together, by minibatches with a rate for each bucket that falls with its gradients."""
    rng = np.random.default_rng(seed)
    number: dict[bytes, int] = {}
    rows = [np.array([number.setdefault(w, len(number)) for w in p], np.int64) for p in passages]
    grams, owner = gram_ids(list(number))
    end = np.searchsorted(owner, np.arange(len(number) + 1))
    e = rng.normal(0, 1.0 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    w = rng.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
    b = np.zeros(2, np.float32)
    seen_e, seen_w = np.full(BUCKETS, 1e-8, np.float32), np.full((WIDTH, 2), 1e-4, np.float32)
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9)).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            words = np.concatenate([rows[k] for k in some])
            at = np.repeat(np.arange(len(some)), [len(rows[k]) for k in some])
            size = end[words + 1] - end[words]
            after = np.cumsum(size)
            ids = grams[np.repeat(end[words] - (after - size), size) + np.arange(after[-1])]
            share = np.repeat(1.0 / (np.maximum(size, 1) * np.bincount(at, minlength=len(some))[at]), size).astype(np.float32)
            row = np.repeat(at, size)
            first = np.searchsorted(row, np.arange(len(some)))
            h = np.add.reduceat(e[ids] * share[:, None], first, axis=0)
            z = h @ w + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            p *= weight[some][:, None]
            gh, gw = p @ w.T, h.T @ p
            u, back = np.unique(ids, return_inverse=True)
            ge = np.stack([np.bincount(back, (gh[row, k] * share), len(u)) for k in range(WIDTH)], axis=1).astype(np.float32)
            seen_e[u] += (ge * ge).mean(axis=1)
            e[u] -= RATE * ge / np.sqrt(seen_e[u])[:, None]
            seen_w += gw * gw
            w -= RATE * gw / np.sqrt(seen_w)
            b -= 0.01 * p.mean(axis=0)
    d = w[:, 1] - w[:, 0]
    return ToxicityModel((e @ d).astype(np.float64), float(b[1] - b[0]))


def calibrate(model: ToxicityModel, logits: np.ndarray, labels: np.ndarray) -> ToxicityModel:
    """Slope and shift of a logistic curve over document logits, by Newton steps with a little shrinkage; classes weigh as they occur."""
    mean, scale = logits.mean(), logits.std() or 1.0
    x = np.stack([(logits - mean) / scale, np.ones(len(logits))], axis=1)
    a = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        g = x.T @ (p - labels) + 1e-3 * a
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        a -= np.clip(step, -2, 2)
    return ToxicityModel(model.value, model.bias, float(a[0] / scale), float(a[1] - a[0] * mean / scale))


def calibrate_noisy(model: ToxicityModel, logits: np.ndarray, labels: np.ndarray) -> ToxicityModel:
    """A logistic curve for labels of which some say toxic whatever the text.

    The chance of label 1 is taken as c + n (1 - c), c by the curve and n the same for all logits; by turns, toxic labels are shared out between
    the two, and both are fitted. Without this, such labels flatten the curve until nothing reaches a high score.
    """
    share, noise = labels.astype(float), 0.05
    for _ in range(CURVE_STEPS):
        model = calibrate(model, logits, share)
        c = 1 / (1 + np.exp(-np.clip(model.slope * logits + model.shift, -30, 30)))
        by_noise = noise * (1 - c) / np.maximum(c + noise * (1 - c), 1e-12)
        noise = min(0.5, max(1e-3, float((labels * by_noise).sum() / max(1e-9, (1 - c).sum()))))
        share = np.where(labels == 1, 1 - by_noise, 0.0)
    return model


def fit(docs: list[list[bytes]], labels: np.ndarray) -> ToxicityModel:
    """Vectors from the documents' passages, each with its document's label."""
    rng, passages, y = np.random.default_rng(SEED), [], []
    most = {k: max(1, TRAIN_PASSAGES // 2 // max(1, int((labels == k).sum()))) for k in (0, 1)}
    for words, label in zip(docs, labels.tolist(), strict=True):
        cut = np.arange(0, max(1, len(words) - PASSAGE // 2), PASSAGE)
        cut = rng.permutation(cut)[: most[label]] if len(cut) > most[label] else cut
        passages += [words[k : k + PASSAGE] for k in cut.tolist()]
        y += [label] * len(cut)
    return train(passages, np.array(y), min(EPOCHS, max(2, VISITS // len(passages))))


def fit_in_parts(spark, texts: list[str], labels: np.ndarray) -> tuple[ToxicityModel, np.ndarray]:
    """The model of all texts, and each text's logit by a model of the other parts; PARTS + 1 tasks, each with the whole (bounded) sample."""
    part = np.zeros(len(labels), np.int64)
    for k in (0, 1):  # each class in equal parts
        part[labels == k] = np.arange((labels == k).sum()) % PARTS

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                docs, own = [t.encode().split() for t in texts], part == k
                model = fit([d for d, mine in zip(docs, own, strict=True) if not mine], labels[~own])
                if k < PARTS:
                    scorer = Scorer(model)
                    found = np.array([scorer.words_logit(d) for d, mine in zip(docs, own, strict=True) if mine], float)
                else:
                    found = np.r_[model.bias, model.value]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([found.astype("<f8").tobytes()], pa.binary())], names=["part", "found"])

    got = {r["part"]: np.frombuffer(r["found"], "<f8") for r in spark.range(0, PARTS + 1, 1, PARTS + 1).mapInArrow(run, "part long, found binary").collect()}
    out = np.zeros(len(labels))
    for k in range(PARTS):
        out[part == k] = got[k]
    return ToxicityModel(got[PARTS][1:], float(got[PARTS][0])), out


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> ToxicityModel:
    """The model of (doc_id, text) and (doc_id, toxic), from at most about ``most`` labelled documents of each class, chosen by hash.

    Their words reach the driver, SAMPLE_WORDS of each. The curve from logit to score is fitted on all of them, each with the logit of a model
    that was learnt from the other parts (of PARTS); the vectors are learnt from all. Rows with a null or other label than 0 and 1 are left out; without two documents of both classes the
    model scores everything 0.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel(np.zeros(BUCKETS), -50.0)
    chosen = known.where(" or ".join(f"toxic = {k} and pmod(xxhash64('share', doc_id), 1073741824) < {int(min(1.0, most / n) * (1 << 30))}" for k, n in sizes.items()))
    sample = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")

    def start():
        def make(x):
            out = []
            for t in x["text"]:
                words = split_words(t)
                if len(words) > SAMPLE_WORDS:
                    at = np.linspace(0, len(words) - PASSAGE, SAMPLE_WORDS // PASSAGE).astype(int).tolist()
                    words = [w for k in at for w in words[k : k + PASSAGE]]
                out.append(b" ".join(words).decode())
            return {"words": out}

        return make

    got = sorted(per_row(sample, ["text"], start, {"words": "string"}, ("doc_id", "toxic")).where("words <> ''").collect(), key=lambda r: (r["doc_id"], r["words"]))
    y = np.array([r["toxic"] for r in got], np.int64)
    if min((y == k).sum() for k in (0, 1)) < 2:
        return ToxicityModel(np.zeros(BUCKETS), -50.0)
    model, out = fit_in_parts(docs.sparkSession, [r["words"] for r in got], y)
    return calibrate_noisy(model, out, y)


def logits(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    def start():
        scorer = Scorer(model)

        def make(x):
            return {"logit": scorer.logit(x["text"])}

        return make

    return per_row(docs, ["text"], start, {"logit": "double"}, keep)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) for every row of (doc_id, text): the calibrated probability of the toxic class, from the whole text.

    Null texts and texts without words score as an empty passage; repeated rows are scored each; an empty table gives an empty result.
    """
    z = F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col("logit") * model.slope + model.shift))
    return logits(docs, model).select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score_toxicity(docs, learn(docs.select("doc_id", "text"), labels.where(~held_out())))
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
