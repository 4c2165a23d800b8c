"""The registered queries, and the pipeline against its operators' brute force."""

import ast
import pathlib

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from check_oracles import check
from tidemark.llm import quality, simhash
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.shared import numbered, without_rows
from tidemark.queries.registry import TABLE_NAMES

ROOT = pathlib.Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    _, problem = check(spark, con, SMALL, name, QUERIES[name], ORACLES.get(name))
    assert problem is None


def test_sources_have_license_files_at_several_depths(spark):
    rows = QUERIES["op6_licenses"](spark, SMALL).collect()
    holders = [r["path"].split("/") for r in rows if "/LICENSE-" in r["path"]]
    assert {len(parts) for parts in holders} == {2, 3, 4}
    assert len({parts[0] for parts in holders}) > 0.7 * len({r["path"].split("/")[0] for r in rows})
    above = [r for r in rows if r["inherited_from"] and r["inherited_from"] != r["path"].rpartition("/")[0]]
    assert above and all(r["path"].startswith(r["inherited_from"] + "/") for r in above)


def test_entry_points_have_the_queries():
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else []
            names += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names)


def test_stages_drop_what_their_operators_say(spark, edge_docs, tmp_path):
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs, sizes = edge_docs.withColumns({"_row": F.lit("own"), "_ROW2": F.lit(7)}), [edge_docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, columns = docs, docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        sizes.append(docs.count())
        if name == "quality rules":
            kept = quality.quality(before).filter("kept").select(F.sort_array(F.collect_list(F.coalesce("doc_id", F.lit(-1)))))
            assert kept.first()[0] == sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in docs.collect())
        if name == "simhash near-dedup":
            prints = [simhash.fingerprint((r["text"] or "").encode()) for r in docs.collect()]
            assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
        if i < 4:
            assert docs.columns == columns
            assert docs.filter("_row <> 'own' OR _ROW2 <> 7").count() == 0
            assert docs.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert sizes[1] < sizes[0] and sizes[3] < sizes[2]


def test_rows_are_dropped_by_the_number_they_were_judged_by(spark, tmp_path):
    path, cores = str(tmp_path / "docs"), "spark.sql.files.minPartitionNum"
    spark.range(400).withColumn("bad", F.col("id") % 7 == 0).repartition(8).write.parquet(path)
    try:
        spark.conf.set(cores, "1")
        rows = numbered(spark.read.parquet(path))
        kept = without_rows(rows, rows.filter("bad"))
        spark.conf.set(cores, "1000")  # as if more cores had joined: the files are split otherwise
        got = kept.collect()
    finally:
        spark.conf.unset(cores)
    assert sorted(r["id"] for r in got) == [i for i in range(400) if i % 7]


def test_stages_of_no_documents(spark, no_docs, tmp_path):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, str(tmp_path)).count() == 0


def test_pipeline_runs_from_the_tables(spark):
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.columns[:3] == ["doc_id", "piece", "start"]
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert 0 < used <= corpus_pipeline.SEQUENCE_TOKENS
