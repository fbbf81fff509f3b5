"""Redaction: offsets, overlap choice, idempotence."""

from pyspark.sql import functions as F

from plumbline.functions import privacy as P
from plumbline.operators import compress as K
from plumbline.operators import privacy as E


def spans(spark, text, **options):
    df = spark.createDataFrame([(text,)], "text string")
    return E.with_entities(df, **options).first()["entities"]


def test_email(spark):
    df = spark.createDataFrame([("Contact jane@example.com",)], "text string")
    row = E.redact(df, labels=["email"]).first()
    found = row["entities"][0]
    assert (found["start"], found["end"], found["redacted_value"]) == (8, 24, "[EMAIL]")
    assert row["redacted_text"] == "Contact [EMAIL]"


def test_offsets_point_at_the_match(spark):
    text = "é mail a.b@c.de, 10.0.0.1 und 4111 1111 1111 1111; DE89370400440532013000 token = \"xy\" +1 (743) 555-3824"
    found = spans(spark, text, flat_ner=False)
    assert all(text[e["start"] : e["end"]] == e["text"] for e in found)
    assert {e["label"] for e in found} >= {"email", "ipv4", "credit_card", "iban", "secret", "phone"}


def test_checksums(spark):
    assert not [e for e in spans(spark, "4111111111111112") if e["label"] == "credit_card"]
    assert not [e for e in spans(spark, "DE89370400440532013001") if e["label"] == "iban"]


def test_greedy_choice_keeps_the_third_of_a_chain(spark):
    def entity(start, end, score):
        return F.struct(
            F.lit(start).cast("bigint").alias("start"), F.lit(end).cast("bigint").alias("end"),
            F.lit("t").alias("text"), F.lit("l").alias("label"), F.lit(score).alias("score"), F.lit("s").alias("source"),
        )

    chain = F.array(entity(0, 5, 0.9), entity(4, 9, 0.8), entity(8, 12, 0.7), entity(20, 25, 0.1))
    kept = spark.range(1).select(P.flatten_overlaps(chain).alias("k")).first()["k"]
    assert [(e["start"], e["end"]) for e in kept] == [(0, 5), (8, 12), (20, 25)]


def test_no_overlap_and_idempotent(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    once = E.redact(docs)
    for row in once.collect():
        ends = [e["end"] for e in row["entities"]]
        starts = [e["start"] for e in row["entities"]]
        assert all(a <= b for a, b in zip(ends, starts[1:]))
    twice = E.redact(once.select("doc_id", F.col("redacted_text").alias("text")))
    same = once.select("doc_id", "redacted_text").join(
        twice.select("doc_id", F.col("redacted_text").alias("again")), "doc_id"
    )
    assert same.filter("redacted_text <> again").count() == 0


def test_surrogates_agree(spark):
    df = spark.createDataFrame([("x a@b.de",), ("a@b.de and a@b.de",)], "text string")
    found = [r["redacted_text"] for r in E.redact(df, redaction_mode="replace", salt="s").collect()]
    stand_in = found[0].split()[1]
    assert found[1] == f"{stand_in} and {stand_in}"


def test_compression_stays_in_budget(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = K.compress_text(docs, ["doc_id"], target_token_ratio=0.3).collect()
    assert all(
        r["tokens_after"] <= int(r["tokens_before"] * 0.3) or r["spans_kept"] == 1 for r in rows
    )
