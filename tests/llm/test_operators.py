"""The training-data operators against brute force, round trips and defined edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from galeforge.llm import chat, covertree, langid, mixing, packing, pii, quality, simhash, tokenstore, toxicity
from galeforge.llm.common import held_out, materialize, shared_path
from galeforge.llm.components import connected_components, forest
from galeforge.llm.tokens import Encoder, default_path

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", " ", "a  b", "x\ny\tz", "<|endoftext|> and <|im_end|>", "naïve 日本 \U0001f600", "é   \x0b", "word " * 3000, "!" * 5000, " lead", "trail ", "a\n b", "\t t"]


def docs(spark, rows, extra=False):
    df = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOC)
    return df.withColumns({"fp": F.lit("clash"), "cls": F.lit(1), "_hash": F.lit("x")}) if extra else df


def odd_docs(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(ODD)] + [(None, "null id text here", None, None), (100, None, "en", None), (3, "x\ny\tz", "en", "s"), (3, "x\ny\tz", "en", "s")]
    return docs(spark, rows, extra=True)


def words(n, seed=0, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def test_encoder_keeps_parts_in_few_bytes():
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("abcdefghijklmnoprstuvwyz", k=6)) for _ in range(60_000)) for _ in range(7)]
    e = Encoder(default_path())
    got = [e.encode([t])[0] for t in texts]
    plain = Tokenizer.from_file(default_path())
    assert got[-1].dtype == np.uint32 and got[-1].tolist() == plain.encode(texts[-1], add_special_tokens=False).ids
    held = [e.table.check, e.table.hits, e.table.end, e.table.ids, *(x for run in e.table.runs for x in run)]
    assert e.table.n > 100_000 and sum(x.nbytes for x in held) < 16_000_000


def test_encoder_keeps_a_word_once_whatever_follows():
    r = random.Random(6)
    own = sorted({"".join(r.choices("abcdefgéßł", k=7)) for _ in range(2000)})
    texts = [" ".join(w + sign for w in own) for sign in ("", ",", ".", "!?", ".\nand", "\n\nthen", "2", "'s")]
    plain, e = Tokenizer.from_file(default_path()), Encoder(default_path())
    assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert e.table.n < 1.1 * len(own)


def test_encoder_cuts_where_the_library_does():
    r, some = random.Random(8), ["a", "B", "é", "×", "ɏ", "ɐ", "я", "7", "²", "'", "'s", "'ll", "'r", "re", ".", "|", "<|endoftext|>", "\n", "\n", "\t", "\r", " ", " ", "\xa0", "\x0b", "\x1c", "\x85", "\x00", "́", "中"]
    texts = ["".join(r.choices(r.sample(some, 6), k=r.randrange(12))) for _ in range(4000)]
    plain, e = Tokenizer.from_file(default_path()), Encoder(default_path(), most=500)
    assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [e.encode([t])[0].tolist() for t in texts[:500]] == [plain.encode(t, add_special_tokens=False).ids for t in texts[:500]]


def test_encoder_bounds_the_ids_it_keeps():
    r = random.Random(9)
    e = Encoder(default_path(), most=500)
    for _ in range(20):
        e.encode([" ".join("".join(r.choices("qxzjkv", k=900)) for _ in range(40))])
    assert len(e.table.ids) < 100_000


def test_arrow_batches_end_by_their_bytes(spark):
    rows = materialize(spark.range(3000, numPartitions=1).select(F.repeat(F.lit("x"), 10_000).alias("text")), "long")
    sizes = rows.coalesce(1).mapInArrow(lambda batches: (type(b).from_pydict({"n": [b.num_rows], "size": [b.nbytes]}) for b in batches), "n long, size long").collect()
    assert sum(r.n for r in sizes) == 3000 and max(r.size for r in sizes) < 12_000_000


# Components.
def brute_components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    want = brute_components({x for e in edges for x in e}, edges)
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: k for n, k in want.items() if n != k}
    x, root = forest(*np.array(edges).T)
    assert dict(zip(x.tolist(), root.tolist(), strict=True)) == got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# Tokens.
def test_encoder_equals_the_library():
    plain, e = Tokenizer.from_file(default_path()), Encoder(default_path(), most=200)
    texts = ODD + [words(300, s) + ".\nThe end" for s in range(20)] + ["a " + "y" * 2000]
    for _ in range(2):
        assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_hash_clash_is_seen():
    e = Encoder(default_path())
    e.encode(["alpha beta"])
    e.table.check[:] = 0  # as if other parts had the same hash
    assert e.encode(["alpha beta gamma"])[0].tolist() == e.tokenizer.encode("alpha beta gamma", add_special_tokens=False).ids


# 1: quality.
def brute_features(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep)


def test_quality_features():
    texts = [*ODD, "a b c a b c a", "x\nx\n\n \nx y", "a b a b a b", *(words(200, s, 8) for s in range(30))]
    for t in texts:
        raw = t.encode()
        assert (len(raw.split()), *quality.base_features(raw, raw.split())) == brute_features(t)


def test_js_distance():
    p, q = np.array([1.0, 0, 3]), np.array([0, 2.0, 2])
    a, b = p / 4, q / 4
    m = (a + b) / 2
    kl = lambda x: sum(v * np.log2(v / w) for v, w in zip(x, m, strict=True) if v)
    assert quality.js_distance(p, q) == pytest.approx(((kl(a) + kl(b)) / 2) ** 0.5)
    assert quality.js_distance(p, p) == 0 and quality.js_distance(p, q * 0) == 0


def test_quality_judges(spark):
    good = [(i, words(300, i, 60), "en", "s") for i in range(40)]
    bad = [(100, " ".join(f"{w}###$$$&&&%%%***" for w in words(300, 7, 60).upper().split()), "en", "s"), (101, "short", "en", "s"), (102, "a b c " * 100, "en", "s")]
    out = {r.doc_id: r for r in quality.score_quality(docs(spark, good + bad, True)).collect()}
    assert all(out[i].kept for i in range(40)) and not any(out[i].kept for i in (100, 101, 102))
    assert not out[100].base_failed and out[101].base_failed and out[102].base_failed
    assert out[101].class_distance is None
    odd = quality.score_quality(odd_docs(spark)).collect()
    assert len(odd) == 17 and sum(r.doc_id == 3 for r in odd) == 3
    assert quality.score_quality(docs(spark, [])).count() == 0


def test_references_count_everything(spark):
    rows = [(i, words(200, i, 30), "en" if i % 2 else None, "s") for i in range(30)]
    ref = quality.learn_references(docs(spark, rows))
    total = Counter(w for _, t, lang, _ in rows for w in t.split() if lang)
    assert {w.decode(): int(ref["en"].counts[k]) for w, k in ref["en"].words.items()} == {w: n for w, n in total.items() if n >= 0.002 * sum(total.values())}
    assert ref["en"].counts.sum() == sum(total.values()) and ref[quality.ANY].counts.sum() == 6000


# 2: packing.
def test_bm25_scores():
    sets = [np.array(x, np.uint32) for x in ([1, 2, 3, 4], [1, 2, 2, 9], [7, 8, 8], [3, 9, 9, 5], [6], [6, 4])]
    n, mean = 6, 7.5
    df = Counter(t for x in sets for t in set(x.tolist()))
    corpus = packing.Corpus(4, 40, 300, np.arange(10) + 1)  # of a corpus that this is a part of
    index = packing.Bm25Shard(sets, corpus.idf, mean)
    for seed in range(n):
        want = np.zeros(n)
        for t in set(sets[seed].tolist()):
            idf = np.log(1 + (40 - (t + 1) + 0.5) / (t + 1 + 0.5)) * (df[t] > 1)
            for k, x in enumerate(sets):
                if tf := x.tolist().count(t):
                    want[k] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / mean))
        assert np.allclose(index.scores(seed), want)
    assert packing.Bm25Shard(sets, corpus.idf, mean, query_terms=1).scores(1)[1] == packing.Bm25Shard(sets, corpus.idf, mean, query_terms=1).scores(1).max()


def test_packing_counts_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 2)
    texts = [words(30, s, 50) for s in range(40)]
    plain = Tokenizer.from_file(default_path())
    ids = [plain.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    stats = packing.encoded(docs(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).repartition(7), default_path(), 1).select("stats").where("stats is not null")
    got, df = packing.corpus_of(stats), Counter(t for x in ids for t in set(x))
    assert (got.id_bytes, got.docs, got.ids) == (2, 40, sum(map(len, ids)))
    assert {k: int(n) for k, n in enumerate(got.df) if n} == dict(df)


def test_packing_counts_a_document_once(spark):
    """The end id is that of a quotation mark, which texts may hold too."""
    stats = packing.encoded(docs(spark, [(i, 'say "x" now' if i % 2 else "x", "en", "s") for i in range(8)]), default_path(), 1).select("stats").where("stats is not null")
    assert packing.corpus_of(stats).df[1] == 8


def check_pieces(rows, texts, end_id, window=2048):
    plain = Tokenizer.from_file(default_path())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for k, text in texts.items():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [end_id]
        at = 0
        for r in sorted(by_doc[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert bytes(r.ids) == np.array(ids[at : at + r.length], "<u4").tobytes()
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and at & (at - 1) == 0


def test_packing_is_exact(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 16)
    texts = {i: words(random.Random(i).randrange(1, 900), i % 7, 90) for i in range(60)} | {100: None, 101: "", 102: words(9000, 3)}
    out = packing.pack_documents(docs(spark, [(k, t, "en", "s") for k, t in texts.items()], True)).collect()
    check_pieces(out, texts, 1)
    assert packing.pack_documents(docs(spark, [])).count() == 0
    odd = packing.pack_documents(odd_docs(spark)).collect()
    assert len({(r.sequence_id, r.offset) for r in odd}) == len(odd) and sum(r.start == 0 for r in odd) == 17


def test_packing_joins_like_documents():
    sets = [np.array([k // 2 * 50 + j for j in range(40)], np.uint32) for k in (0, 2, 4, 6, 1, 3, 5, 7)]
    p = packing.Packer(80, 0)
    p.pack(list(range(8)), [40] * 8, packing.Bm25Shard(sets, np.ones(400), 40.0))
    together = {frozenset(d for d, *_, s, _ in p.done if s == k) for k in range(4)}
    assert together == {frozenset(x) for x in ((0, 4), (1, 5), (2, 6), (3, 7))}


# 3: cover tree.
def brute_links(rows):
    ok = {}
    for v, e, label in rows:
        if v is not None and e and label is not None and None not in e:
            x = np.array(e, float)
            if np.isfinite(x).all() and x.any():
                ok[v] = (x / np.sqrt((x * x).sum()), label, len(x))
    links = [(a, b) for a in ok for b in ok if a != b and ok[a][1:] == ok[b][1:] and ok[a][0] @ ok[b][0] >= 0.93]
    n = Counter(a for a, _ in links)
    root = brute_components([r[0] for r in rows], links)
    return {v: (n[v], root[v], root[v] == v) for v, *_ in rows}


@pytest.mark.parametrize("cell", [4096, 12])
def test_near_vectors(spark, cell):
    r = np.random.default_rng(3)
    rows = []
    for k in range(90):
        centre = r.normal(size=16)
        for _ in range(int(r.integers(1, 5))):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + r.normal(size=16) * 0.12], k % 3))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(5)] + [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [None] * 16, 0), (2004, rows[0][1], None), (2005, [1.0], 0), (2006, [2.0], 0), (2007, [float("inf")] + [1.0] * 15, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"cls": F.lit(1), "cell": F.lit(2)})
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in covertree.near_vectors(df, cell=cell).collect()}
    assert got == brute_links(rows)


def test_near_vectors_of_nothing(spark):
    assert covertree.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_dense_cluster_links_without_pairs():
    x = np.random.default_rng(0).normal(size=(1, 32)) + np.random.default_rng(1).normal(size=(500, 32)) * 0.01
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    t = covertree.CoverTree(x)
    links, (a, root) = covertree.traverse(t, t, (np.ones(500), np.ones(500)), 0.93, 0)
    assert (links[0] == 500).all() and len(a) == 499 and set(root.tolist()) == {0}


# 4: chat.
def test_chat_round_trip(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "\\", "\\\\<|", "<\\|", "\\|\\n\n", "", None, "a\\nb", "<|image|>", "é😀\n\n"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate([(["user", "assistant", "a\nb", None, "<|im_end|>"][i % 5], t) for i, t in enumerate(nasty)])]
    rows += [(2, None, "assistant", "x"), (2, None, "assistant", "x"), (None, 0, "user", "null id")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"formatted": F.lit("clash"), "_piece": F.lit(1)})
    out = chat.format_conversations(chat.text_messages(df))
    out = out.withColumns({"turns": chat.parse_turns(F.col("formatted")), "learnt": chat.masked_text(F.col("formatted"), F.col("loss"))})
    got = {r.conv_id: r for r in out.collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r or "", t or "") for _, _, r, t in rows[:10]]
    assert got[1].learnt == "".join(t or "" for _, _, r, t in rows[:10] if r == "assistant")
    assert got[2].n_turns == 2 and got[2].learnt == "xx" and got[None].learnt == ""
    assert chat.format_conversations(chat.text_messages(df.limit(0))).count() == 0


def test_chat_parts(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    rows = [(1, 0, "user", [part("text", "see "), part("image", ref="a.png", w=56, h=29), part("audio", ref="b.wav", s=1.01), part("text", " <|image|>")]), (1, 1, "assistant", [part("text", "one"), part("document", ref="c.pdf", p=3), part(None, "two")]), (1, 2, "user", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<struct<{', '.join(x.strip().replace(' ', ': ', 1) for x in chat.PART.split(','))}>>")
    r = chat.format_conversations(df).withColumn("learnt", chat.masked_text(F.col("formatted"), F.col("loss"))).first()
    assert r.formatted == "<|im_start|>user\nsee <|image|><|audio|> <\\|image|><|im_end|>\n<|im_start|>assistant\none<|document|>two<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert r.learnt == "onetwo"
    assert [(a.turn, a.position, a.type, a.ref, a.tokens) for a in r.attachments] == [(0, 1, "image", "a.png", 4), (0, 2, "audio", "b.wav", 26), (1, 1, "document", "c.pdf", 768)]
    assert r.expanded_tokens == 798


# 5: SimHash.
def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_fingerprints():
    for t in [*ODD, None, "One", "One TWO", "A B C", *(words(50, s) for s in range(20))]:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_masks_cover_every_pair():
    r = random.Random(5)
    for bits in (list(range(64)), list(range(3, 40)), [1, 5]):
        m = simhash.masks(bits)
        assert len(m) == 15
        for _ in range(2000):
            d = sum(1 << b for b in r.sample(bits, min(3, len(bits))))
            assert any(not x & d for x in m)


@pytest.mark.parametrize("hot", [4096, 3])
def test_linked_fingerprints(spark, hot, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    r = random.Random(2)
    fps = set()
    for k in range(12):
        centre = r.getrandbits(64)
        for _ in range(40 if k == 0 else r.randrange(1, 12)):
            x = centre
            for b in r.sample(range(64), r.randrange(0, 4)):
                x ^= 1 << b
            fps.add(x - (1 << 64) if x >> 63 else x)
    fps = sorted(fps)
    want = brute_components(fps, [(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3])
    edges = simhash.linked_fingerprints(spark.createDataFrame([(x,) for x in fps], "fp long"), hot=hot).collect()
    assert brute_components(fps, [(e.a, e.b) for e in edges]) == want


def test_near_duplicates(spark):
    base = [words(200, s) for s in range(12)]
    rows = [(i, t, "en", "s") for i, t in enumerate(base)] + [(50 + i, base[i].replace(" ", "  "), "en", "s") for i in range(4)] + [(70, None, "en", "s"), (71, "", "en", "s"), (None, base[5], "en", "s"), (8, base[8], "en", "s")]
    out = simhash.near_duplicates(docs(spark, rows, True)).collect()
    assert len(out) == len(rows)
    ids = [(k, brute_fingerprint(t)) for k, t, *_ in rows]
    for r in out:
        same = [k for k, f in ids if (f ^ (r.fp & (2**64 - 1))).bit_count() <= 3 and k is not None]
        assert r.component_id == min(same)
    kept = simhash.one_of_each(docs(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [*range(12), 70]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


# 6: toxicity.
def test_toxicity_learns_subwords(spark):
    r, rows, labels = random.Random(3), [], []
    for i in range(700):
        w = words(r.randrange(20, 120), i, 900).split()
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), "grobble" + r.choice(["", "r", "rs", "ing"]) if i < 600 else "grobbl" + r.choice(["ex", "y"]))
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, int(toxic)))
    rows += [(1000, None, "en", "s"), (1001, "", None, None), (None, "plain text", "en", "s")]
    lab = spark.createDataFrame([*labels[:600], (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs(spark, rows).select("doc_id", "text"), lab)
    out = toxicity.score_toxicity(docs(spark, rows, True), model).collect()
    score = {x.doc_id: x.score for x in out}
    new = [(score[i], y) for i, y in labels[600:]]
    assert np.mean([a > b for a, y in new if y for b, z in new if not z]) > 0.95  # of spellings that were never learnt
    assert len(out) == 703 and all(0 <= s <= 1 for s in score.values()) and score[1000] == score[1001]
    assert toxicity.score_toxicity(docs(spark, []), model).count() == 0
    none = toxicity.learn(docs(spark, rows).select("doc_id", "text"), lab.where("toxic = 1"))
    assert max(x.score for x in toxicity.score_toxicity(docs(spark, rows[:5]), none).collect()) < 0.01


# 7: mixing.
def brute_apportion(weights, seats):
    q = [0] * len(weights)
    for _ in range(seats):
        if sum(weights) > 0:
            q[max(range(len(weights)), key=lambda i: (weights[i] / (2 * q[i] + 1), -i))] += 1
    return q


def test_apportion(spark):
    r, cells, want = random.Random(4), [], {}
    for g in range(30):
        w = [r.choice([0, 1, 5, r.randrange(1, 1000), r.randrange(1, 100000)]) for _ in range(r.randrange(1, 25))]
        n = r.randrange(0, 300)
        cells += [(g, i, x, n) for i, x in enumerate(w)]
        want |= {(g, i): x for i, x in enumerate(brute_apportion(w, n))}
    got = mixing.apportion(spark.createDataFrame(cells, "g int, i int, w long, seats long"), ["g"], "w", "seats", ["i"])
    assert {(x.g, x.i): x.quota for x in got.collect()} == want


def brute_targets(sizes, cap=3):
    w = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    total, fixed = sum(sizes), {}
    while True:
        left = [i for i in range(len(sizes)) if i not in fixed]
        level = (total - sum(fixed.values())) / sum(w[i] for i in left) if left else 0
        over = [i for i in left if w[i] * level > cap * sizes[i]]
        if not over:
            return [float(fixed.get(i, w[i] * level)) for i in range(len(sizes))]
        fixed |= {i: cap * sizes[i] for i in over}


def test_targets(spark):
    for sizes in ([100, 5, 900, 3, 0, 70], [0, 0], [7], [1, 1, 1000], list(range(1, 30))):
        df = spark.createDataFrame([(f"s{i:03d}", n) for i, n in enumerate(sizes)], "source string, source_size long")
        assert [x.target for x in mixing.targets(df).orderBy("source").collect()] == pytest.approx(brute_targets(sizes))


def test_mix(spark):
    r = random.Random(6)
    rows = [(i, words(r.randrange(0, 400), i), "en", ["a", "a", "a", "b", "c", None][i % 6]) for i in range(400)] + [(900, None, "en", "z"), (5, "same id", "en", "b"), (5, "same id", "en", "b")]
    plan = mixing.mix(docs(spark, rows, True), keep=("fp",)).collect()
    assert len(plan) == len(rows) and plan == mixing.mix(docs(spark, rows, True), keep=("fp",)).collect()
    by = defaultdict(list)
    for x in plan:
        assert 0 <= x.taken <= 3 * x.size
        by[x.source].append(x)
    for rows_of in by.values():
        assert abs(sum(x.taken for x in rows_of) - rows_of[0].target) <= 16 * (2 + len(rows_of) / 512)
    assert sum({s: x[0].target for s, x in by.items()}.values()) == pytest.approx(sum(x.size for x in plan))
    assert mixing.mix(docs(spark, [])).count() == 0


def test_take_gives_what_the_plan_says(spark):
    rows = [(i, words(37 + i, i).replace(" ", "\n " if i % 2 else " "), "en", "ab"[i % 2]) for i in range(40)] + [(None, "a b c", "en", "a"), (99, None, "en", "a")]
    d = docs(spark, rows)
    plan = {x.doc_id: x.taken for x in mixing.mix(d).collect()}
    got = Counter()
    texts = {k: (t or "").split() for k, t, *_ in rows}
    for x in mixing.take(d).collect():
        piece = x.text.split()
        got[x.doc_id] += len(piece)
        own = texts[x.doc_id]
        assert x.n_chars == len(x.text) and any(own[i : i + len(piece)] == piece for i in range(len(own)))
    assert {k: got[k] for k in plan} == plan


# 8: PII.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute_spans(text):
    out = []
    for k, (kind, p) in enumerate(BASE.items()):
        for m in p.finditer(text):
            d = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                twice = [2 * x - 9 * (2 * x > 9) if i % 2 else x for i, x in enumerate(reversed(d))]
                if not 12 <= len(d) <= 19 or sum(twice) % 10:
                    continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans():
    r = random.Random(8)
    texts = ["a@b.c@d.e", "x@y", "@@a@b.co", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (310) 555-4510", "++1 23 4567 890", "a.b@c-d.e-f, 010.1.1.1"]
    texts += ["".join(r.choice("0123456789.@+- ()ab%") for _ in range(r.randrange(200))) for _ in range(4000)]
    for t in texts:
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def test_pii(spark):
    text = "write to jane.roe@mail.example.com or 10.0.0.1, card 4111 1111 1111 1111, call +1 (310) 555-4510 now."
    rows = [(i, f"doc {i} {words(30, i)} " + text, "en", "s") for i in range(60)] + [(100, "call (310) 555-4510 or jane at mail dot example dot com", "en", "s"), (101, words(200) + " 12.5 2024-01-02 look at foo", "en", "s"), (102, None, "en", "s")]
    model = pii.learn(docs(spark, rows).select("doc_id", "text"))
    out = {r.doc_id: r for r in pii.find_personal_data(docs(spark, rows, True), model).collect()}
    assert out[0].redacted.endswith("write to [EMAIL] or [IP], card [CARD], call [PHONE] now.")
    assert "phone" in out[100].spans and out[100].base_spans == "" and out[101].spans == "" and out[102].redacted is None
    assert all(set(out[i].base_spans.split(",")) <= set(out[i].spans.split(",")) for i in range(60))
    assert pii.find_personal_data(docs(spark, []), pii.learn(docs(spark, []).select("doc_id", "text"))).count() == 0
    assert len(pii.find_personal_data(odd_docs(spark), model).collect()) == 17


def test_boosting_fits():
    r = np.random.default_rng(1)
    x = r.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    p = pii.Boosted().fit(x[:1500], y[:1500]).probability(x[1500:])
    assert ((p > 0.5) == y[1500:]).mean() > 0.93


def test_redact_overlaps():
    assert pii.redact("abcdef", [(1, 0, 3), (2, 3, 5)]) == "a[EMAIL]f"


# 9: language.
def test_language(spark):
    from galeforge.llm.common import table

    d = table(spark, "/root/testdata/sf0.01", "documents")
    out = langid.identify(d, langid.learn_prototypes(d.where(~held_out()))).join(d.select("doc_id", "lang"), "doc_id").where(held_out()).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97 and all(0 <= r.score <= 1 for r in out)


def test_language_edges(spark):
    proto = langid.learn_prototypes(docs(spark, [(1, "the cat sat on the mat", "en", "s"), (2, "le chat est ici", "fr", "s"), (3, None, "de", "s"), (4, "1234", None, "s")]))
    assert list(proto) == ["en", "fr"]
    rows = [(1, "the mat", None, None), (2, "le chat", None, None), (3, None, None, None), (4, "12 !?", None, None), (5, "日本語 \U00020000", None, None)]
    out = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs(spark, rows, True), proto).collect()}
    assert out[1][0] == "en" and out[2][0] == "fr" and out[3] == out[4] == ("und", 0.0) and out[5][0] in proto
    assert {r.lang_pred for r in langid.identify(docs(spark, rows), {}).collect()} == {"und"}
    assert langid.identify(docs(spark, []), proto).count() == 0


def test_bundle_is_the_sum_of_bound_letters():
    v = langid.Vectors(64, 1)
    keys, n = langid.trigrams("Abba, abba!")
    want = sum(c * v.at[0][k // 4096] * v.at[1][k // 64 % 64] * v.at[2][k % 64] for k, c in zip(keys.tolist(), n.tolist(), strict=True))
    assert (v.bundle(keys, n) == want).all()


# 10: token store.
def test_perfect_hash():
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    h = tokenstore.PerfectHash.build(np.unique(keys))
    assert sorted(h.lookup(np.unique(keys))) == list(range(len(np.unique(keys))))
    assert len(tokenstore.PerfectHash.build(np.zeros(0, np.int64)).lookup(np.zeros(0, np.int64))) == 0


def test_token_store(spark, monkeypatch):
    monkeypatch.setattr(tokenstore, "SHARD_BYTES", 2000)
    monkeypatch.setattr(tokenstore, "PART_BYTES", 100)
    rows = [(i * 3, words(i * 5, i), "en", "s") for i in range(50)] + [(7, "twice", "en", "s"), (7, "twice", "en", "s"), (None, "no id", "en", "s"), (200, None, "en", "s")]
    path = shared_path(spark, "test-tokens")
    manifest = tokenstore.write_token_store(docs(spark, rows, True), path)
    assert manifest.agg(F.sum("docs")).first()[0] == len(rows) and manifest.count() > 3
    keys = spark.createDataFrame([(r[0],) for r in rows] + [(1,), (-5,), (10**12,)], "k long")
    got = tokenstore.read_token_store(spark, path, keys).collect()
    plain, start, want = Tokenizer.from_file(default_path()), 0, []
    for k, t in sorted(((k, t or "") for k, t, *_ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = plain.encode(t, add_special_tokens=False).ids + [2]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got), key=lambda x: x[1]) == want
    empty = shared_path(spark, "test-empty")
    assert tokenstore.write_token_store(docs(spark, []), empty).count() == 0
    assert tokenstore.read_token_store(spark, empty, keys).count() == 0


def test_fingerprints_tell_strangers():
    keys = np.arange(0, 4000, 2)
    index = tokenstore.ShardIndex(tokenstore.index_bytes(keys, np.arange(2001), 4))
    _, count = index.find(np.arange(1, 4001, 2))
    assert count.sum() == 0
    first, count = index.find(keys)
    assert (first == np.arange(2000)).all() and (count == 1).all()
