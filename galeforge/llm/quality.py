"""Quality rules: Jensen-Shannon distance of a document's histograms from its language's references."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, per_row, table

#: Base rules: fewest words, and most words in repeated 3-word windows, in percent.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Documents shorter than this are not judged by that histogram; distances above these reject.
MIN_BYTES, MIN_COMMON_WORDS = 200, 100
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.35, 0.42
#: A word is common in a language if it is at least this share of its words; languages with fewer words have no reference.
COMMON_SHARE, MIN_LANGUAGE_WORDS = 0.002, 2_000
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "line end", "stop", "symbol", "other ASCII", "beyond ASCII")
#: Documents without a language, or of one without a reference, are compared with all languages' reference together.
ANY = ""


def _class_table() -> np.ndarray:
    """The class of each UTF-8 byte; a character beyond ASCII counts by its first byte, and continuation bytes as nothing."""
    of = np.full(256, CLASSES.index("other ASCII"))
    for name, chars in (("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", b"0123456789"), ("space", b" \t\v\f\r"), ("line end", b"\n"), ("stop", b".,;:!?'\"()-"), ("symbol", SYMBOLS)):
        of[list(chars)] = CLASSES.index(name)
    of[0xC0:] = CLASSES.index("beyond ASCII")
    of[0x80:0xC0] = len(CLASSES)
    return of


_CLASS_OF = _class_table()


def class_counts(raw: bytes) -> np.ndarray:
    return np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence, base 2, of two histograms of counts; 0 if either is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda x: float((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum())
    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


def base_features(raw: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    joined = np.frombuffer(b"".join(words), np.uint8)
    chars = len(joined) - int(((joined & 0xC0) == 0x80).sum())
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= 4:
        number: dict[bytes, int] = {}
        c = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        if (v := len(number)) < 2_000_000:
            key = (c[:-2] * v + c[1:-1]) * v + c[2:]
        else:
            key = np.unique(c[:-2] * v + c[1:-1], return_inverse=True)[1] * v + c[2:]
        _, at, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[at] >= 2)
        hit = np.zeros(len(words), bool)
        for k in range(3):
            hit[twice + k] = True
        repeated = int(hit.sum())
    return chars, symbols, len(lines) - len(set(lines)), repeated


@dataclass
class Reference:
    classes: np.ndarray
    words: dict[bytes, int]
    counts: np.ndarray  # of the common words, and last of all others


def _partial_counts(docs: DataFrame, flush: int = 200_000) -> DataFrame:
    """(lang, kind, key, n) of every document: bytes by class (c), lower-cased words (w) and their total (t), summed in the task as far as they fit."""

    def run(batches):
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def out():
            rows = [(lang, "c", str(i), int(n)) for lang, c in classes.items() for i, n in enumerate(c)]
            rows += [(lang, "w", w.decode(), n) for lang, c in words.items() for w, n in c.items()]
            rows += [(lang, "t", "", c.total()) for lang, c in words.items()]
            words.clear()
            classes.clear()
            return pd.DataFrame(rows, columns=["lang", "kind", "key", "n"])

        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                raw = (text or "").encode()
                lang = lang or ANY
                words.setdefault(lang, Counter()).update(raw.lower().split())
                classes[lang] = classes.get(lang, 0) + class_counts(raw)
                if sum(map(len, words.values())) > flush:
                    yield out()
        yield out()

    return docs.select("lang", "text").mapInPandas(run, "lang string, kind string, key string, n long")


def learn_references(docs: DataFrame) -> dict[str, Reference]:
    """The references of every language with enough words, and of all together.

    Counted over all documents; what reaches the driver is at most 1 / COMMON_SHARE words for each language
    with MIN_LANGUAGE_WORDS words, whatever the corpus.
    """
    partial = _partial_counts(docs).repartition("kind", "key")  # both aggregates below are by these
    by_lang = partial.groupBy("kind", "key", "lang").agg(F.sum("n").alias("n"))
    known = F.collect_list(F.when(F.col("lang") != ANY, F.struct("lang", "n")))
    sums = by_lang.groupBy("kind", "key").agg(F.sum("n").alias("n"), known.alias("langs"))
    sums = sums.where((F.col("kind") != "w") | (F.col("n") >= COMMON_SHARE * MIN_LANGUAGE_WORDS))  # rarer words are common in no language
    every = F.struct(F.lit(ANY).alias("lang"), F.col("n"))
    both = materialize(sums.select("kind", "key", F.explode(F.concat("langs", F.array(every))).alias("x")).select("kind", "key", "x.lang", "x.n"), "word-counts")
    total = both.where("kind = 't'").select("lang", F.col("n").alias("total")).where(F.col("total") >= MIN_LANGUAGE_WORDS)
    chosen = both.where("kind <> 't'").join(total, "lang").where((F.col("kind") == "c") | (F.col("n") >= COMMON_SHARE * F.col("total"))).collect()
    out: dict[str, Reference] = {}
    for lang in sorted({r["lang"] for r in chosen}):
        own = sorted((r["key"], r["n"], r["total"]) for r in chosen if r["lang"] == lang and r["kind"] == "w")
        classes = np.zeros(len(CLASSES))
        for r in chosen:
            if r["lang"] == lang and r["kind"] == "c":
                classes[int(r["key"])] = r["n"]
        all_words = next((t for _, _, t in own), 0) or 1
        out[lang] = Reference(classes, {w.encode(): i for i, (w, _, _) in enumerate(own)}, np.array([n for _, n, _ in own] + [all_words - sum(n for _, n, _ in own)], float))
    return out


def distances(raw: bytes, words: list[bytes], ref: Reference) -> tuple[float, float]:
    common = Counter(map(ref.words.get, raw.lower().split()))
    own = np.zeros(len(ref.counts))
    for k, n in common.items():
        own[-1 if k is None else k] += n
    return js_distance(class_counts(raw), ref.classes), js_distance(own, ref.counts) if len(ref.words) else 0.0


def score_quality(docs: DataFrame, references: dict[str, Reference] | None = None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance, word_distance, base_failed, kept) for every row.

    A document fails the base rules with under MIN_WORDS words or over MAX_REPEATED percent of its words in repeated
    windows. It fails by distribution if its class histogram is over MAX_CLASS_DISTANCE from its language's, or its common-word
    histogram over MAX_WORD_DISTANCE; shorter ones than MIN_BYTES and MIN_COMMON_WORDS are not judged by it (distance null).
    A null text has no words; rows with a null or unknown lang are compared with all languages together; repeated rows are
    judged each; an empty table gives an empty result.
    """
    refs = learn_references(docs) if references is None else references

    names = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "class_distance": "double", "word_distance": "double", "base_failed": "boolean", "kept": "boolean"}

    def judge(lang, text):
        raw = (text or "").encode()
        words = raw.split()
        features = base_features(raw, words)
        failed = len(words) < MIN_WORDS or 100 * features[3] > MAX_REPEATED * len(words)
        by_class = by_word = None
        if ref := refs.get(lang or ANY) or refs.get(ANY):
            c, w = distances(raw, words, ref)
            by_class, by_word = (c if len(raw) >= MIN_BYTES else None), (w if len(words) >= MIN_COMMON_WORDS else None)
        return len(words), *features, by_class, by_word, failed, not failed and (by_class or 0) <= MAX_CLASS_DISTANCE and (by_word or 0) <= MAX_WORD_DISTANCE

    def start():
        def make(x):
            rows = [judge(lang, text) for lang, text in zip(x["lang"], x["text"], strict=True)]
            return {c: [r[i] for r in rows] for i, c in enumerate(names)}

        return make

    return per_row(docs, ["lang", "text"], start, names)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"))
