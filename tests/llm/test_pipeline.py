"""The pipeline on planted cases, and every query of the package on the smallest tables."""

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.cases import documents, near, prose

NAMES = [n for n in driver.queries() if n.startswith("op") and n[2].isdigit()] + ["pipeline"]


@pytest.mark.parametrize("name", NAMES)
def test_query_runs(spark, name):
    frame = driver.queries()[name](spark, SF_SMALL)
    assert frame.count() > 0 and len(set(frame.columns)) == len(frame.columns)


def test_stages_take_effect(spark, tmp_path):
    item = prose(900, 40)
    data = [(i, prose(i, 60)) for i in range(60)]
    data += [(100 + i, prose(200 + i, 30) + " you idiot, " + prose(300 + i, 9)) for i in range(40)]
    data += [(400, data[5][1]), (401, near(data[6][1], 1, 1)), (402, prose(7, 30) + " " + item), (403, None), (404, "")]
    labels = [(i, int(100 <= i < 200)) for i, _ in data if i < 200]
    documents(spark, data).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == first.columns, name
    kept = sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert kept == sorted([i for i in range(60)] + [403, 404])
