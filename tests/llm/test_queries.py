"""Registered queries without SQL against plain versions of what they return, over whole tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from galeforge.llm import langid, quality, registry
from galeforge.llm.tokens import default_path
from tests.llm.test_operators import brute_features, docs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()


def rows(spark, name):
    return registry.QUERIES[name](spark, FOLDER).collect()


# 1: plain histograms of characters and words, one document after another.
def classes_of(text):
    named = [("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" \t\v\f\r", 3), ("\n", 4), (".,;:!?'\"()-", 5), ("#*$%&|<>", 6)]
    of = {c: k for chars, k in named for c in chars}
    return Counter(8 if ord(c) > 127 else of.get(c, 7) for c in text)


def distance(p, q):
    a, b = sum(p.values()), sum(q.values())
    if not a or not b:
        return 0.0
    out = 0.0
    for k in {*p, *q}:
        x, y = p[k] / a, q[k] / b
        m = (x + y) / 2
        out += (x * math.log2(x / m) if x else 0) / 2 + (y * math.log2(y / m) if y else 0) / 2
    return math.sqrt(max(0.0, out))


def plain_words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]


def test_op1_equals_plain_histograms(spark, documents):
    by_lang = {}
    for d in documents:
        for lang in {d["lang"] or "", ""}:
            c, w = by_lang.setdefault(lang, (Counter(), Counter()))
            c.update(classes_of(d["text"] or ""))
            w.update(plain_words(d["text"] or ""))
    known = {k: (c, w) for k, (c, w) in by_lang.items() if w.total() >= quality.MIN_LANGUAGE_WORDS}
    got = {r.doc_id: r for r in rows(spark, "op1_quality")}
    assert len(got) == len(documents)
    rejected = 0
    for d in documents:
        text, r = d["text"] or "", got[d["doc_id"]]
        n, chars, symbols, lines, repeated = brute_features(text)
        failed = n < 50 or 100 * repeated > 50 * n
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, chars, symbols, lines, repeated, failed)
        c, w = known.get(d["lang"] or "") or known[""]
        common = {x for x, k in w.items() if k >= quality.COMMON_SHARE * w.total()}
        fold = lambda x: Counter({k: v for k, v in x.items() if k in common}) + Counter({None: sum(v for k, v in x.items() if k not in common)})  # noqa: B023, E731
        by_class = distance(classes_of(text), c) if len(text.encode()) >= quality.MIN_BYTES else None
        by_word = distance(fold(Counter(plain_words(text))), fold(w)) if n >= quality.MIN_COMMON_WORDS else None
        for mine, want in ((r.class_distance, by_class), (r.word_distance, by_word)):
            assert (mine is None) == (want is None) and (mine is None or mine == pytest.approx(want, abs=1e-9))
        kept = not failed and (by_class or 0) <= quality.MAX_CLASS_DISTANCE and (by_word or 0) <= quality.MAX_WORD_DISTANCE
        assert r.kept == kept
        rejected += not kept and not failed
    assert rejected


# 8: the fixed formats by the patterns as they are stated.
def luhn(digits):
    return sum(sum(divmod(2 * int(x), 10)) if i % 2 else int(x) for i, x in enumerate(reversed(digits))) % 10 == 0


def fixed_formats(text):
    digits = lambda s: "".join(c for c in s if c in "0123456789")
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_op8_has_every_fixed_format(spark, documents):
    names, got = ("email", "ip", "card", "phone"), {r.doc_id: r for r in rows(spark, "op8_pii")}
    assert len(got) == len(documents)
    for d in documents:
        base, r = fixed_formats(d["text"] or ""), got[d["doc_id"]]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        own = [f"{names[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(own) <= set(spans) and [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


# 9: one trigram after another.
def plain_symbols(text):
    out = [0]
    for c in text.lower():
        k = (ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (langid.SYMBOLS - 27)) if c.isalpha() else 0
        if k or out[-1]:
            out.append(k)
    return out if not out[-1] else [*out, 0]


def test_op9_equals_a_plain_loop(spark, documents):
    letters = np.random.default_rng(langid.SEED).integers(0, 2, (langid.SYMBOLS, langid.WIDTH), np.int8).astype(int) * 2 - 1

    bound = {}

    def bundle(text):
        s, total = plain_symbols(text or ""), np.zeros(langid.WIDTH)
        for (a, b, c), n in Counter(zip(s, s[1:], s[2:], strict=False)).items() if any(s) else ():
            if (a, b, c) not in bound:
                bound[a, b, c] = np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
            total += n * bound[a, b, c]
        return total

    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1 for d in documents}
    sums, own = {}, {d["doc_id"]: bundle(d["text"]) for d in documents}
    for d in documents:
        if d["lang"] is not None and not held[d["doc_id"]]:
            sums[d["lang"]] = sums.get(d["lang"], 0) + own[d["doc_id"]]
    unit = {k: v / np.linalg.norm(v) for k, v in sums.items()}
    right = []
    for r in rows(spark, "op9_langid"):
        x = own[r.doc_id]
        cosine = {k: float(v @ x / np.linalg.norm(x)) for k, v in unit.items()} if x.any() else {}
        best = max(cosine.values(), default=0.0)
        assert r.held_out == held[r.doc_id] and r.score == pytest.approx(max(0.0, best), abs=1e-4)
        assert r.lang_pred == "und" if not cosine else cosine[r.lang_pred] >= best - 1e-4
        right += [r.lang_pred == d["lang"] for d in documents if d["doc_id"] == r.doc_id and r.held_out and d["lang"] is not None and cosine]
    assert np.mean(right) > 0.95


def test_many_languages_are_counted_in_parts(spark, monkeypatch):
    many = docs(spark, [(k, f"{'abcdefghij'[k % 10] * 3} {'klmnopqrst'[k // 10 % 10] * 4} word", f"lang{k % 90}", "s") for k in range(180)])
    whole = langid.learn_prototypes(many)
    monkeypatch.setattr(langid, "COUNTED", 3)
    parts = langid.learn_prototypes(many)
    assert list(parts) == list(whole) and len(whole) == 90 and all(np.array_equal(parts[k], whole[k]) for k in whole)


# 10: the library's ids, one text after another.
def test_op10_equals_the_library(spark, documents):
    t, start, got = Tokenizer.from_file(default_path()), 0, {r.doc_id: r for r in rows(spark, "op10_tokenids")}
    assert len(got) == len(documents)
    for d in sorted(documents, key=lambda d: d["doc_id"]):
        ids = [*t.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        assert tuple(got[d["doc_id"]][c] for c in ("start", "n_tokens", "ids_crc32")) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
