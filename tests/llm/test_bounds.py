"""What is sent or learned stays within its stated bound."""

from pyspark.sql import functions as F

from pressline.llm import decontaminate, toxicity


def test_a_million_short_items_are_small_and_found():
    items = [(i, b"%06x" % i) for i in range(1_000_000)] + [(None, b"zz9 yy")]
    index = decontaminate.Index(items)
    bare = decontaminate.Index([]).nbytes()
    assert index.nbytes() - bare <= 20 * len(items)
    assert index.search(b"x 0000ff y zz9 yy 00000g") == [(255, 2, 8, 0), (None, 11, 17, 0)]
    assert index.leaks(b"0f423f") and not index.leaks(b"10f423f and 0f423fa")


def test_training_takes_one_text_an_id_and_few_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} plain") for i in range(60)], "doc_id long, text string")
    many = docs.unionByName(spark.range(20_000).select(F.lit(3).cast("long").alias("doc_id"), F.lit("word3 plain").alias("text")))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    once, often = (sorted(map(tuple, toxicity.training_rows(d, labels).collect())) for d in (docs, many))
    assert once == often and len(once) == len({order for order, *_ in once})
    whole = toxicity.train(toxicity.training_rows(docs, labels))
    monkeypatch.setattr(toxicity, "MAX_TRAIN_BYTES", 100)
    assert toxicity.train(toxicity.training_rows(docs, labels))[2] != whole[2]  # a few texts only
