"""The pipeline's stages against brute force, and the registered queries' contracts on the small tables."""

import os
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from galeforge.llm import common, langid, mixing, registry, simhash
from galeforge.llm.common import table
from galeforge.llm.pii import base_spans
from galeforge.llm.tokens import default_path
from tests.llm.test_neardup import brute_kept
from tests.llm.test_operators import brute_components, brute_fingerprint, check_pieces, docs, odd_docs, words

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    path, out = tmp_path_factory.mktemp("stages"), {"documents": table(spark, FOLDER, "documents")}
    d = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, d, FOLDER).write.parquet(f"{path}/{name}")
        d = out[name] = spark.read.parquet(f"{path}/{name}")
    return {k: v.collect() for k, v in out.items()}


def test_columns(stages):
    for name in ("language", "near_dedup", "personal_data", "mixture"):
        assert list(stages[name][0].asDict()) == list(stages["documents"][0].asDict())


def test_language_keeps_what_has_letters(stages):
    gone = {r.doc_id for r in stages["documents"]} - {r.doc_id for r in stages["language"]}
    texts = {r.doc_id: r.text for r in stages["documents"]}
    assert all(len(texts[k]) < 20 for k in gone)


def test_one_of_each_group(stages):
    """By whole sets of five-word shingles, similarity 0.8 or more."""
    assert sorted(r.doc_id for r in stages["near_dedup"]) == brute_kept([(r.doc_id, r.text) for r in stages["language"]])


def test_personal_data_is_gone(stages):
    assert any(base_spans(r.text) for r in stages["near_dedup"])
    assert {r.doc_id for r in stages["personal_data"]} == {r.doc_id for r in stages["near_dedup"]}
    assert not any(base_spans(r.text) for r in stages["personal_data"])


def test_mixture_takes_what_the_plan_says(spark, stages):
    d = spark.createDataFrame(stages["personal_data"])
    plan = {r.doc_id: r.taken for r in mixing.mix(d).collect()}
    got = defaultdict(int)
    for r in stages["mixture"]:
        got[r.doc_id] += len(r.text.encode().split())
    assert {k: got[k] for k in plan} == plan


def test_sequences_hold_every_token(stages):
    rows, texts = stages["packing"], defaultdict(list)
    for r in stages["mixture"]:
        texts[r.doc_id].append(r.text)
    library, of = Tokenizer.from_file(default_path()), {}
    for k, own in texts.items():
        for t in own:
            ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
            of.setdefault((k, len(ids)), []).append(ids)
    covered, by = defaultdict(int), defaultdict(int)
    for r in rows:
        by[r.sequence_id] += r.length
        assert any(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for ids in of[r.doc_id, r.doc_tokens])
        covered[r.doc_id, r.doc_tokens, r.start] += 1
        covered[r.doc_id, r.doc_tokens, r.start + r.length] -= 1
    for (k, n), copies in of.items():  # every id of every copy lies in one piece
        own = sorted((start, d) for (i, m, start), d in covered.items() if (i, m) == (k, n))
        depth = np.cumsum([d for _, d in own])
        assert own[0][0] == 0 and own[-1][0] == n and set(depth[:-1]) == {len(copies)} and depth[-1] == 0
    assert all(n <= 2048 and n & (n - 1) == 0 for n in by.values())


def test_near_duplicates_of_a_larger_table(spark):
    """All 1,000 documents against brute force over all pairs: no group is missed, no document is lost."""
    d = table(spark, "/root/testdata/sf0.01", "documents")
    got = corpus_pipeline.near_dedup(spark, d, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in got) == brute_kept([(r.doc_id, r.text) for r in d.collect()])


def test_intermediate_tables_go(spark):
    since = common.mark()
    kept = [common.materialize(spark.range(k + 1), "tidy") for k in range(3)]
    paths = common._given[since:]
    common.tidy(spark, since)
    assert kept[2].count() == 3 and common._given[since:] == paths[2:]
    assert [os.path.exists(x.removeprefix("file://")) for x in paths] == [False, False, True]


def test_run_is_the_stages(spark, stages):
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(key, stages["packing"]))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    want = con.execute(registry.SQL[name])
    names = [c[0] for c in want.description]
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = registry.QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(plain(r[c]) for c in names) for r in got.collect()) == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_packing_query(spark):
    from galeforge.llm.packing import op2_packing, pack_documents

    d = table(spark, FOLDER, "documents")
    check_pieces(pack_documents(d).collect(), {r.doc_id: r.text for r in d.collect()}, 1)
    assert op2_packing(spark, FOLDER).columns[:4] == ["doc_id", "start", "length", "ids_crc32"]


def test_simhash_query(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op5_simhash(spark, FOLDER).collect()}
    fps = {r.doc_id: brute_fingerprint(r.text) for r in table(spark, FOLDER, "documents").collect()}
    root = brute_components(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    assert got == {k: (f"{f:016x}", root[k]) for k, f in fps.items()}


@pytest.mark.parametrize("name", ["op1_quality", "op6_toxicity", "op8_pii", "op9_langid", "op10_tokenids"])
def test_one_row_for_each_document(spark, name):
    d = table(spark, FOLDER, "documents").count()
    out = registry.QUERIES[name](spark, FOLDER)
    assert out.select("doc_id").distinct().count() == d == out.count()


def test_held_out_rule(spark):
    out = registry.QUERIES["op9_langid"](spark, FOLDER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)


def test_stages_on_odd_rows(spark):
    """Nulls, empty texts, repeated rows, an empty table, and columns named as the stages name their own."""
    odd = odd_docs(spark).withColumns({c: F.lit(1) for c in ("score", "lang_pred", "redacted", "spans", "base_spans", "key", "rank", "size", "at", "n", "taken", "_key", "_hash", "_size")})
    for d in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, d, "")
            assert out.columns == d.columns, name
            assert (out.count() > 0) == (d is odd), name
        assert (corpus_pipeline.packed(spark, d, "").count() > 0) == (d is odd)


def test_repeated_rows_take_what_the_plan_says(spark):
    d = docs(spark, [(i // 3, words(40, i // 3), "en", f"s{i % 2}") for i in range(60)])
    want = mixing.mix(d).agg(F.sum("taken")).first()[0]
    got = mixing.take(d).select(mixing.word_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
    assert got == want


def test_noise_is_no_language(spark):
    r = random.Random(2)
    noise = [" ".join("".join(r.choice("qxzjkvwbph") for _ in range(r.randrange(2, 9))) for _ in range(200)) for _ in range(20)]
    d = table(spark, FOLDER, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    rows = spark.createDataFrame([(10_000 + i, t, None, "src0", len(t)) for i, t in enumerate(noise)], d.schema)
    kept = {x.doc_id for x in corpus_pipeline.language(spark, d.union(rows), FOLDER).collect()}
    assert sum(10_000 + i in kept for i in range(20)) <= 4
    assert sum(k < 10_000 for k in kept) >= 0.98 * d.count()


def test_cover_tree_takes_any_label_and_scale(spark):
    from galeforge.llm.covertree import near_vectors

    v = [(i, [x * s for x in (1.0, 0.01 * (i % 2), 0.0)], label) for i, (s, label) in enumerate([(1e-200, "a"), (1e200, "a"), (1.0, "a"), (1.0, "b")])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(v, "vec_id long, embedding array<double>, label string")).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (0, 3)}


def test_limits_of_languages_count_every_row(spark):
    """The lowest hundredth is of all rows, also far more than 20,000, and of long texts that are told right only."""
    text, n = "x" * 300, 100_000
    rows = spark.range(n).selectExpr("id as doc_id", f"'{text}' as text", "'en' as lang", "'en' as lang_pred", f"(id + 1) / {n} as score")
    odd = spark.createDataFrame([(n, "x", "en", "en", 0.0), (n + 1, text, "en", "de", 0.0), (n + 2, text, None, "en", 0.0)], "doc_id long, text string, lang string, lang_pred string, score double")
    got = langid.least_scores(rows.union(odd))
    assert set(got) == {"en"} and abs(got["en"] - 0.005) < 1e-4
