"""Each pipeline stage against a plain version of it on a small table."""

import tracemalloc
from collections import Counter

import corpus_pipeline as P
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from topicflow.llm import langid, mixing, packing, quality
from topicflow.llm.common import crc_mod
from topicflow.llm.queries import MIX_EPOCHS, MIX_FRACTION, MIX_SEED, MIX_WEIGHTS, WORD_BPE

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        before = docs
        docs = P.staged(spark, stage(spark, docs, SF), "test-stage")
        kept[name] = (before, docs)
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns

    def ids(df):
        return Counter(r.doc_id for r in df.select("doc_id").collect())

    before, after = kept["quality classifier"]
    model = quality.fit(spark, before, spark.read.parquet(f"{SF}/labels.parquet"), crc_mod("doc_id", 3) != 1)
    tokens = quality.Tokens()
    rows = before.select("doc_id", "text").collect()
    assert ids(after) == Counter(r.doc_id for r in rows if quality.text_scores(model, tokens, [r.text])[0] >= P.LEAST_QUALITY)

    before, after = kept["language ID"]
    model = langid.fit(spark, before, crc_mod("doc_id", 4) != 2)
    want = Counter()
    for r in before.select("doc_id", "text").collect():
        (lang,), (score,) = langid.predict_texts(model, [r.text])
        want[r.doc_id] += lang != "und" and score >= P.LEAST_LANGUAGE
    assert ids(after) == +want

    before, after = kept["n-gram Jaccard join"]
    from test_near import _brute
    rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
    assert ids(after) == Counter(i for i, _, c in _brute(rows) if i == c)

    before, after = kept["mixing sources to target weights"]
    chosen = mixing.mix(spark, before, MIX_FRACTION, MIX_EPOCHS, MIX_WEIGHTS, MIX_SEED)
    assert ids(after) == ids(chosen)
    left, right = before.agg(F.sum(mixing.tokens(F.col("text")))).first()[0], after.agg(F.sum(mixing.tokens(F.col("text")))).first()[0]
    assert right <= left * MIX_FRACTION[0] / MIX_FRACTION[1]

    before, after = kept["best-fit packing"]
    word_ids = packing.WordIds(public_tokenizers.path(WORD_BPE))
    want = Counter()
    for r in before.select("doc_id", "text").collect():
        want[r.doc_id] += len(word_ids.text(r.text or "")) // 4 + 1
    got = Counter()
    for r in after.collect():
        got[r.doc_id] += r.length
    assert got == want

    final = P.run(spark, SF)
    assert final.columns == after.columns and final.count() == after.count()


def test_stages_of_whole_texts_are_stored(spark):
    """Written by the stage itself, in small Arrow batches, so that no later write holds 10,000 texts at once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for stage in P.STORED:
        plan = stage(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "Scan parquet" in plan
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == size


def test_stored_texts_are_packed(spark):
    docs = spark.createDataFrame([(k, f"some text {k}") for k in range(99)], "doc_id long, text string")
    part = P.kept(spark, docs).inputFiles()[0].removeprefix("file://")
    assert pq.read_metadata(part).row_group(0).column(1).compression == "ZSTD"


def test_margins_hold_little():
    r = np.random.default_rng(3)
    n = 60  # machines
    model = langid.Model([], [], [], r.normal(size=(1 << langid.BITS, n)).astype(np.float32), np.zeros(n), np.ones(n))
    tracemalloc.start()
    langid.margins(model, ["some words of a text " * 50] * 1000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64e6
