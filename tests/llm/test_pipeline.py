import ast
import pathlib

import corpus_pipeline
from tests.llm.common import frame, rows, with_clashes, words
from tidegrid.llm import queries

ROOT = pathlib.Path(__file__).resolve().parents[2]


def write(spark, folder, docs, labels, bench):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")


def test_stages(spark, tmp_path):
    leak = words(25, 77)
    data = [(k, words(60, k), "en", f"s{k % 3}", 1) for k in range(60)]
    data += [(100 + k, " ".join(f"{w.upper()}!!" for w in words(60, 200 + k).split()), "en", "s0", 1) for k in range(20)]
    data += [(200, words(60, 5), "en", "s1", 1), (201, words(40, 301) + " " + leak + " " + words(40, 302), "en", "s2", 1)]
    labels = spark.createDataFrame([(i, int(i < 100 or i >= 200)) for i, *_ in data], "doc_id bigint, quality int")
    bench = spark.createDataFrame([(1, leak)], "item_id bigint, text string")
    write(spark, str(tmp_path), frame(spark, data), labels, bench)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in out}
    assert not ids & set(range(100, 120)) and 201 not in ids and not {5, 200} <= ids and len(ids) > 30
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_awkward_tables(spark, tmp_path):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (None, None)], "doc_id bigint, quality int")
    bench = spark.createDataFrame([(1, None)], "item_id bigint, text string")
    write(spark, str(tmp_path / "a"), with_clashes(frame(spark)), labels, bench)
    assert set(corpus_pipeline.run(spark, str(tmp_path / "a")).columns) >= {"doc_id", "text", "_id", "copy_no"}
    write(spark, str(tmp_path / "b"), frame(spark, []), labels.limit(0), bench.limit(0))
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).collect() == []
    assert len(rows()) > 0


def test_registry():
    names = set(queries.queries())
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{k}" for k in range(1, 11)] and set(queries.oracle_sql()) <= names


def test_native_operators_use_no_python_functions():
    for name in ("line_dedup", "mixing", "licenses"):
        text = (ROOT / "tidegrid" / "llm" / f"{name}.py").read_text()
        assert not any(w in text for w in ("mapInArrow", "applyInPandas", "pandas_udf", ".rdd", "import pandas"))


def test_rest_does_not_import_this():
    for path in (ROOT / "tidegrid").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("tidegrid.llm" in n for n in names), path
