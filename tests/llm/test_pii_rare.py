"""Personal data of a kind that few documents hold."""

from galeforge.llm import pii
from tests.llm.test_operators import docs, words


def test_rare_kinds_are_learnt(spark):
    rows = [(i, f"{words(12, i)} order 12.5", "en", "s") for i in range(12_000)]
    for j in range(100):
        k = j * 120
        rows[k] = (k, f"{words(12, k)} the host address 10.{j}.7.{2 * j} answers {words(5, j)}", "en", "s")
    df = docs(spark, rows).select("doc_id", "text")
    assert pii.documents_by_kind(df) == [0, 100, 0, 0]
    model = pii.learn(df)
    assert model.thresholds[1] < 1
    assert pii.find_spans("w1 w2 the host address 10 . 3 . 7 . 9 answers w5", model)[1]


def test_finds_that_pass_checks():
    true = [(0, "jane at mail dot example dot com"), (1, "10 . 0 . 0 . 1"), (1, "1:2:3:4:5:6:7:8"), (2, "4111.1111.1111.1111"), (3, "(310) 555-4510")]
    false = [(1, "300.1.1.1"), (1, "10:20:30:40"), (2, "4111.1111.1111.1112")]
    assert all(pii.passes(*x) for x in true) and not any(pii.passes(*x) for x in false)


def test_planted_secrets_and_disguised_values(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = pii.learn(d)
    clean = words(60, 4)
    planted = {
        4: ['token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "api_key: Zk81mQ0xVt52LpRr93WdYb7N"],
        0: ["jane [at] mail [dot] example [dot] com"],
        1: ["110 . 32 . 171 . 19"],
        2: ["card 4111.1111.1111.1111", "4111 / 1111 / 1111 / 1111", "order 216 4111/1111/1111/1111"],
        3: ["call (310) 555-4510", "phone 310-555-4510"],
    }
    for kind, texts in planted.items():
        for t in texts:
            base, spans = pii.find_spans(f"{clean} {t} {clean}", model)
            assert not base and any(k == kind for _, k, _ in spans), t
    assert not pii.find_spans(f"{clean} commit 04dbebab91ab85687d33eeaaf9ac699e1188f962 {clean}", model)[1]
