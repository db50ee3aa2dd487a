"""Extra columns named like the operators' own pass through the stages of the pipeline."""

from pyspark.sql import functions as F

import corpus_pipeline
from rootlens.llm.frames import Scratch
from rootlens.session import reach_package

SF = "/root/testdata/sf0.001"
CLASHING = ("score", "held_out", "lang_pred", "predicted", "size", "copies", "copy", "place", "_digest", "given")


def test_clashing_columns_keep_their_values(spark):
    reach_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(c) for c in CLASHING})
    scratch, names = Scratch(spark), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        names = docs.columns
        docs = scratch.store(stage(spark, docs, SF), name)
        assert docs.columns == names
    wrong = [F.count_if(F.col(c) != c) for c in CLASHING]
    assert docs.count() > 0 and set(docs.agg(*wrong).first()) == {0}
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert coded.count() == docs.count()
