from pyspark.sql import functions as F

from marginalia.llm import simhash


def test_texts_of_one_ball_meet_behind_one_that_is_unlike_them(spark, monkeypatch):
    """Three texts with one fingerprint and no common band; the first, which both others meet, is unlike them."""
    words = [f"w{i}" for i in range(60)]
    texts = [(1, " ".join(f"x{i}" for i in range(60))), (2, " ".join(words)), (3, " ".join([*words[:-1], "end"])), (4, "alone")]
    real = simhash.sketches

    def sketches(docs, size=5):
        own = F.array(F.xxhash64("doc_id", F.lit("band")))
        return real(docs, size).withColumns({"fp": F.when(F.col("doc_id") < 4, F.lit(0)).otherwise(-1).cast("bigint"), "bands": own})

    monkeypatch.setattr(simhash, "sketches", sketches)
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 2, 4: 4}
