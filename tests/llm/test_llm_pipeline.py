import sys
from pathlib import Path

import duckdb
import pytest
from odd_rows import empty, labels_of, odd

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from check import rows_of  # noqa: E402
from rebasket.llm import cube, neardup, oracle, quality, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    frame = entry.queries()[name](spark, SF_DIR)
    result = con.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, result.fetchall())


def test_every_operator_is_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(names) <= set(entry.queries())


def test_stages_follow_each_other(spark):
    """Every stage against its operator, on what the one before kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR).persist()
        before_ids, after_ids = sorted(r.doc_id for r in docs.collect()), sorted(r.doc_id for r in after.collect())
        if name == "quality":
            assert after_ids == sorted(r.doc_id for r in quality.classify(docs, labels).filter("predicted = 1").collect())
        elif name == "near_duplicates":
            assert after_ids == sorted(r.doc_id for r in neardup.near_duplicates(docs, 5, 80).filter("kept").collect())
            assert len(after_ids) < len(before_ids)
        elif name == "personal_data":
            assert after_ids == before_ids and after.filter("text rlike '@mail'").count() == 0
        elif name == "mix":
            copies = {r.doc_id: r.copies for r in cube.mix(docs).collect()}
            assert after_ids == sorted(i for i, c in copies.items() for _ in range(c))
        else:
            assert after_ids == before_ids and after.filter("not round_trip").count() == 0
        if name != "pieces":
            assert after.columns == docs.columns
        kept.append(len(after_ids))
        docs = after
    assert corpus_pipeline.run(spark, SF_DIR).count() == kept[-1]


def test_odd_rows_and_empty_tables(spark, tmp_path):
    labels_of(spark, [(6, 1, 0), (9, 0, 0)]).write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, str(tmp_path))
            if name == "pieces":
                assert after.count() == docs.count()
            else:
                assert after.columns == docs.columns
            docs = after.persist()
