import importlib.util
import os
import sys

from storelake.llm.queries import ORACLE, QUERIES
from tests.llm.tables import documents, prose

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def pipeline_module():
    spec = importlib.util.spec_from_file_location("corpus_pipeline", f"{ROOT}/corpus_pipeline.py")
    module = importlib.util.module_from_spec(spec)
    sys.modules["corpus_pipeline"] = module
    spec.loader.exec_module(module)
    return module


def small_tables(spark, folder):
    item = prose(77, 40)
    rows = [(i, prose(i, 80 + i), "en", "web" if i % 3 else "book") for i in range(60)]
    rows += [(100 + i, prose(5, 85), "en", "web") for i in range(20)]
    rows += [(200, f"{prose(8, 60)} {item} {prose(9, 60)}", "en", "web"), (201, None, "en", "web"), (202, "12 34 !!", None, "book"),
             (203, "", None, None), (5, prose(5, 85), "en", "web")]
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_every_stage_does_its_work(spark, tmp_path):
    """The stages one by one against what the rows were made for."""
    pipeline = pipeline_module()
    folder = str(tmp_path)
    rows = small_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for number, (name, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/stage{number}")
        docs = spark.read.parquet(f"{folder}/stage{number}")
        seen[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        assert docs.columns == columns or number == len(pipeline.STAGES) - 1
    letters = sorted(r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1]))
    assert sorted(seen["language_id"]) == letters
    assert sorted(seen["simhash_near_dedup"]) == [*range(60), 200]
    assert sorted(seen["benchmark_decontamination"]) == [*range(60)]
    assert set(seen["source_mixing"]) == set(range(60)) and len(seen["source_mixing"]) > 60
    assert sorted(seen["sharding"]) == sorted(seen["source_mixing"])
    assert sorted(r.doc_id for r in pipeline.run(spark, folder).collect()) == sorted(seen["sharding"])


def test_empty_tables_pass_through(spark, tmp_path):
    pipeline = pipeline_module()
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
