"""Toxicity from few and noisy labels, on rows that were held out."""

import re

from galeforge.llm import registry

FOLDER = "/root/testdata/sf0.01"
PLAIN = re.compile(r"\b(clown|trash|scum|loser|worthless|idiot|disgusting|pathetic|moron|stupid)\b")


def test_held_out_rows_with_plain_insults(spark):
    read = lambda t: spark.read.parquet(f"{FOLDER}/{t}.parquet").collect()
    texts, toxic = {r.doc_id: (r.text or "").lower() for r in read("documents")}, {r.doc_id: r.toxic for r in read("labels")}
    out = {r.doc_id: r for r in registry.QUERIES["op6_toxicity"](spark, FOLDER).collect()}
    assert len(out) == len(texts)
    held = [k for k in toxic if out[k].held_out]
    plain = [k for k in held if toxic[k] == 1 and PLAIN.search(texts[k])]
    assert sum(out[k].predicted for k in plain) >= 12
    assert sum(out[k].predicted for k in held if toxic[k] == 0) <= 2
