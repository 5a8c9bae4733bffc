"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, per_row, table

#: Width of the vectors; letter symbols (0 is what stands between words); seed of their random vectors.
WIDTH, SYMBOLS, SEED = 512, 64, 20
#: Trigram vectors kept by a worker at once, characters worked on at once, and languages that a task counts at once (2 MB each).
KEPT, STEP, COUNTED = 40_000, 1_000_000, 32
UNKNOWN = "und"
#: Characters of a long text.
LONG = 300


def _symbol_table() -> np.ndarray:
    """Symbols of the first 65,536 code points: 1 to 26 for a to z, the rest shared by all other letters, 0 for no letter."""
    out = np.zeros(65_536, np.uint8)
    for cp in range(65_536):
        if chr(cp).isalpha():
            out[cp] = cp - 96 if 97 <= cp <= 122 else 27 + cp % (SYMBOLS - 27)
    return out


_SYMBOL: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    if not _SYMBOL:
        _SYMBOL.append(_symbol_table())
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    far = cp >= 65_536
    out = _SYMBOL[0][np.where(far, 0, cp)]
    if far.any():
        for c in np.unique(cp[far]):
            if chr(c).isalpha():
                out[cp == c] = 27 + c % (SYMBOLS - 27)
    return out


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a whole text, with runs of other characters as one boundary, and their counts; empty without a letter."""
    s = np.concatenate([np.zeros(1, np.uint8), *(symbols(text[i : i + STEP]) for i in range(0, len(text), STEP)), np.zeros(1, np.uint8)])
    if not s.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = s[np.r_[True, (s[1:] != 0) | (s[:-1] != 0)]]
    if len(s) <= STEP:
        return np.unique(_keys(s), return_counts=True)
    counts = np.zeros(SYMBOLS**3, np.int64)
    for i in range(0, len(s) - 2, STEP):
        counts += np.bincount(_keys(s[i : i + STEP + 2]), minlength=len(counts))
    keys = np.flatnonzero(counts)
    return keys, counts[keys]


def _keys(s: np.ndarray) -> np.ndarray:
    s = s.astype(np.int64)
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


class Vectors:
    """Trigram vectors: letter vectors, the first two turned by two places and by one, bound by product."""

    def __init__(self, width: int = WIDTH, seed: int = SEED):
        letters = np.random.default_rng(seed).integers(0, 2, (SYMBOLS, width), np.int8) * 2 - 1
        self.at = [np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters]
        self.slot = np.full(SYMBOLS**3, -1, np.int32)
        self.kept = np.zeros((0, width), np.float32)

    def bound(self, keys: np.ndarray) -> np.ndarray:
        return (self.at[0][keys // SYMBOLS**2] * self.at[1][keys // SYMBOLS % SYMBOLS] * self.at[2][keys % SYMBOLS]).astype(np.float32)

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        new = keys[self.slot[keys] < 0]
        if len(new):
            if len(self.kept) + len(new) > KEPT:
                self.slot[:] = -1
                self.kept, new = self.kept[:0], keys
            self.slot[new] = np.arange(len(new)) + len(self.kept)
            self.kept = np.concatenate([self.kept, self.bound(new)])
        return counts.astype(np.float32) @ self.kept[self.slot[keys]]


def learn_prototypes(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> dict[str, np.ndarray]:
    """A unit vector for each language of (text, lang), from every row whose lang is not null.

    Tasks return trigram counts by language, summed before and after the shuffle, at most SYMBOLS**3 for a language, and hold COUNTED languages at
    once, however many there are; each language's are bundled in a task, and only its vector reaches the driver.
    """

    def out(sums):
        for lang, x in sums.items():
            keys = np.flatnonzero(x)
            yield pd.DataFrame({"lang": lang, "gram": keys, "n": x[keys]})

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                keys, n = trigrams(text)
                if lang not in sums:
                    if len(sums) == COUNTED:
                        yield from out(sums)
                        sums.clear()
                    sums[lang] = np.zeros(SYMBOLS**3, np.int64)
                sums[lang][keys] += n
        yield from out(sums)

    def bundle(key, pdf):
        pdf = pdf.sort_values("gram")
        v = Vectors(width, seed)
        out = np.zeros(width)
        for i in range(0, len(pdf), 20_000):
            some = pdf.iloc[i : i + 20_000]
            out += some["n"].to_numpy(np.float64) @ v.bound(some["gram"].to_numpy(np.int64)).astype(np.float64)
        norm = np.sqrt((out * out).sum()) or 1.0
        return pd.DataFrame({"lang": [key[0]], "vector": [(out / norm).tolist()]})

    known = docs.where("lang is not null and text is not null").select("lang", "text")
    sums = known.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = sums.groupBy("lang").applyInPandas(bundle, "lang string, vector array<double>").collect()
    return {r["lang"]: np.array(r["vector"], np.float32) for r in sorted(rows, key=lambda r: r["lang"])}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], width: int = WIDTH, seed: int = SEED, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The kept columns, lang_pred and score (or what ``names`` calls them) for every row of (doc_id, text).

    lang_pred is the language whose prototype has the largest cosine with the whole text's bundle, the first by name on
    ties; score is that cosine, not below 0. A text that is null or has no letter, or no prototype at all, gives ``und`` and 0.
    """
    langs = list(prototypes)
    against = np.array([prototypes[x] for x in langs]) if langs else np.zeros((0, width), np.float32)

    def start():
        v = Vectors(width, seed)

        def one(text):
            keys, n = trigrams(text or "")
            x = v.bundle(keys, n) if len(keys) and langs else np.zeros(width, np.float32)
            if not (norm := float(np.sqrt(x @ x))):
                return UNKNOWN, 0.0
            cosine = against @ x / norm
            k = int(cosine.argmax())
            return langs[k], min(1.0, max(0.0, float(cosine[k])))

        def make(x):
            found = [one(t) for t in x["text"]]
            return {name: [f[k] for f in found] for k, name in enumerate(names)}

        return make

    return per_row(docs, ["text"], start, {names[0]: "string", names[1]: "double"}, keep)


def least_scores(told: DataFrame, pred: str = "lang_pred", score: str = "score") -> dict[str, float]:
    """For each language the score that long texts of it have at least: half the lowest hundredth of all identified rows (text, lang, ``pred``, ``score``) whose lang is the predicted one.

    Every row counts. Scores count to four places, so a task holds 10,001 numbers a language, however many rows there are. Vectors of WIDTH have cosines of about 1 / sqrt(WIDTH) by chance, whatever the text; long texts of a
    known language are far above that.
    """
    own = told.where((F.col("lang") == F.col(pred)) & (F.length("text") >= LONG))
    return {r["lang"]: r["low"] / 2 for r in own.groupBy("lang").agg(F.percentile(F.round(score, 4), 0.01).alias("low")).collect()}


def op9_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, learn_prototypes(docs.where(~held_out())))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
