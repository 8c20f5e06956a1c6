"""The corpus pipeline: each stage against a plain version, on its own input."""

import os
import re
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from test_operators import EXTRA, awkward  # noqa: E402

import corpus_pipeline as pipeline  # noqa: E402
from textloom.llm.common import materialize, table  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    return sorted((r.doc_id, r.text) for r in frame.collect())


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in pipeline.STAGES[:-1]:
        seen[name] = rows_of(docs)
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns
        seen[name + " out"] = rows_of(docs)
    assert seen["language_id out"] == [(i, t) for i, t in seen["language_id"] if re.search(r"[^\W\d_]", t)]
    keep = {c for _, _, c in brute.op1(seen["simhash_dedup"])}
    assert seen["simhash_dedup out"] == [r for r in seen["simhash_dedup"] if r[0] in keep]
    cut = {i: (n, gone, sha) for i, n, gone, sha in brute.op4(seen["substring_dedup"])}
    for (i, old), (j, new) in zip(seen["substring_dedup"], seen["substring_dedup out"]):
        assert i == j and (brute.sha(new) == cut[i][2] if cut[i][1] else new == old)
    bench = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    bad = {w[0] for w in brute.op7(seen["decontamination"], bench) if w[-1]}
    assert bad and seen["decontamination out"] == [r for r in seen["decontamination"] if r[0] not in bad]
    encoded = pipeline.encode(spark, docs, SF)
    from tokenizers import Tokenizer

    from textloom.llm.bpe import tokenizer_path

    whole = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: list(r.ids) for r in encoded.collect()}
    assert got == {i: whole.encode(t, add_special_tokens=False).ids for i, t in rows_of(docs)}


def test_awkward_rows_pass_through(spark):
    rows = awkward()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in EXTRA}).withColumn("lang", F.lit("en"))
    docs = docs.withColumns({"source": F.lit(None).cast("string"), "n_words": F.lit(1)})
    for name, stage in pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns
        assert not docs.limit(0).count()
    assert docs.filter("score = 'x'").count() == docs.count() > 5
    assert pipeline.encode(spark, docs, SF).count() == docs.count()
    nothing = docs.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0
