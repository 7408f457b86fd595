"""Queries with SQL against DuckDB, and the pipeline stage by stage against plain versions."""

import duckdb
import pytest
from test_decontamination import plain as plain_contamination
from test_line_dedup import plain as plain_lines
from test_simhash import plain_components, plain_fingerprint

import __spark_entry__
import corpus_pipeline
from clickloom.llm import quality_classifier, queries
from clickloom.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(str(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert ours == theirs


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_pipeline_stage_by_stage(spark):
    docs = queries.table(spark, SF, "documents")
    labels, benchmark = (queries.table(spark, SF, t) for t in ("labels", "benchmark"))
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = spark.createDataFrame((out := stage(spark, docs, SF)).collect(), out.schema)
        after = docs.collect()
        outputs.append((name, len(after)))
        ids = {r.doc_id for r in after}
        if name == "quality_classifier":
            scores = quality_classifier.quality_scores(queries.table(spark, SF, "documents"), labels).collect()
            sure = {r.doc_id: r.predicted for r in scores if abs(r.score - 0.3) > 1e-6}
            assert all((i in ids) == bool(p) for i, p in sure.items())
        elif name == "line_dedup":
            part = plain_lines([(r.doc_id, r.text) for r in before])
            seen, want = set(), {}
            for r in sorted(before, key=lambda r: r.doc_id):
                kept = []
                for line in r.text.split("\n"):
                    own = line.strip(" \t\r").lower()
                    if not own or part[own] not in seen:
                        kept.append(line)
                    if own:
                        seen.add(part[own])
                want[r.doc_id] = "\n".join(kept)
            assert {r.doc_id: r.text for r in after} == want
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "simhash_near_dedup":
            rows = sorted(before, key=lambda r: r.doc_id)
            label = plain_components([plain_fingerprint(r.text) for r in rows], 4)
            assert ids == {rows[k].doc_id for k in set(label)}
        elif name == "decontamination":
            assert ids == {r.doc_id for r in before if not plain_contamination(r.text, items)[1]}
        else:
            assert ids == {r.doc_id for r in before} and all(r.lossless for r in after)
        if name != "sentencepiece":
            assert docs.columns == queries.table(spark, SF, "documents").columns
    run = corpus_pipeline.run(spark, SF)
    assert abs(run.count() - outputs[-1][1]) <= 1


def test_pipeline_stages_take_odd_tables(odd, nothing, spark):
    for docs in (odd.withColumnRenamed("kept", "n_chars"), nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.schema.names == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
