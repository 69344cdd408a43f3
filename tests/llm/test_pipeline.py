"""The pipeline's stages, one after the other, on a small fixture and on the smallest tables."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_operators import quality_rows


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    d, lab, labels = quality_rows(spark, 300)
    item = " ".join(f"item{i}" for i in range(30))
    rows = d.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    more = [
        (1001, "the stone of light " + item + " walking under the river", "en", "s", 1),
        (1002, "the of stone river under walking light password = abcdefghijkl0 the of stone walking", "en", "s", 1),
        (2001, None, "en", "s", None),
    ]
    rows = rows.unionByName(spark.createDataFrame(more, rows.schema)).unionByName(rows.where("doc_id = 1").withColumn("doc_id", F.lit(3001).cast("long")))
    for name, df in (("documents", rows), ("labels", lab), ("benchmark", spark.createDataFrame([(1, item)], "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, f) in enumerate(cp.STAGES):
        docs = f(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(cp.STAGES) - 1:
            assert docs.columns == rows.columns
        seen[name] = {r.doc_id: r for r in docs.collect()}
    good = {i for i, q, _ in labels if q}
    assert good - set(seen["quality classifier"]) == set() and len(set(seen["quality classifier"]) & {i for i, q, _ in labels if not q}) == 0
    assert 3001 in seen["quality classifier"] and 3001 not in seen["SimHash near-dedup"] and 1 in seen["SimHash near-dedup"]
    assert 1001 in seen["SimHash near-dedup"] and 1001 not in seen["benchmark decontamination"]
    assert "[SECRET]" in seen["secret scans"][1002].text
    assert all(r.decoded_equal for r in seen["SentencePiece encoding"].values())
    run = cp.run(spark, str(tmp_path))
    assert {r.doc_id: r.ids_sha256 for r in run.collect()} == {i: r.ids_sha256 for i, r in seen["SentencePiece encoding"].items()}
