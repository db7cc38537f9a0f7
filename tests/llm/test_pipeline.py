"""The pipeline's stages, each against a plain version on what the one before kept."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from transitnet.llm import mixing, quality_crf, toxicity
from transitnet.llm import queries as registry

from . import brute


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], sf).persist())
    calm, lines, single, mixed, encoded = out[1:]
    assert all(x.columns == docs.columns for x in (calm, lines, single, mixed))
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"), ~quality_crf.held_out(5, 0))
    scores = dict(zip(rows, model.scores([r["text"] for r in rows.values()]), strict=True))
    kept = {r["doc_id"]: r["text"] for r in calm.collect()}
    assert set(kept) == {d for d, s in scores.items() if s < corpus_pipeline.TOXIC}
    expected = {d: t for d, (_, _, t) in brute.line_dedup(kept.items()).items()}
    kept = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert kept == expected and all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    groups = brute.jaccard_components(kept.items(), 5, 80)
    kept = {r["doc_id"]: r for r in single.collect()}
    assert set(kept) == {d for d, (_, c) in groups.items() if c == d}
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(single).collect()}
    times = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert times == {d: n for d, n in copies.items() if n}
    enc = brute.tiktoken_encoding(*registry.vocabulary())
    for r in encoded.collect():
        assert r["round_trip"] and list(r["ids"]) == enc.encode_ordinary(kept[r["doc_id"]]["text"]) and r["n_tokens"] == len(r["ids"])
    assert encoded.count() == sum(times.values())


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.where("not round_trip").isEmpty() and out.count() > 50
    assert np.isfinite(out.agg(F.avg("n_tokens")).first()[0])


def test_stages_of_awkward_rows(spark, sf, tmp_path):
    """Nulls, blanks, long texts, repeats and further columns through all stages; then an empty table."""
    from .test_operators import AWKWARD, DOCS

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(AWKWARD, DOCS).withColumns({c: F.lit(7) for c in ("token", "score", "n_lines", "size", "copies", "ids", "component_id")})
    some = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 100)
    for table in (docs, docs.limit(0), docs.unionByName(some, allowMissingColumns=True)):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path)).persist()
            assert name == "bpe" or now.columns == table.columns
        assert now.where("not round_trip").isEmpty() and now.isEmpty() == table.isEmpty()
