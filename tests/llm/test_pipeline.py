import duckdb
import pytest

import corpus_pipeline
from panelcast.llm import common, line_dedup, queries


def test_stages_on_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = common.table(spark, folder, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, docs, folder), "test-stage")
        assert after.columns == columns and 0 < after.count(), name
        if name != "mix_sources":
            assert after.count() <= docs.count() and after.select("doc_id").distinct().count() == after.count()
        if name == "line_dedup":
            assert after.count() == docs.count()
            assert line_dedup.dedup_lines(after).agg({"n_dropped": "sum"}).first()[0] == 0
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    starts = [r for r in packed if r["piece"] == 0]
    assert len(starts) == docs.count()


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


COLUMNS = {
    "op11_prefix_trie": "conv_id bigint depth bigint parent_conv_id bigint n_convs bigint n_children bigint n_leaves bigint saved_tokens bigint "
                        "ends_sha256 string",
    "op12_substring_dedup": "doc_id bigint n_words bigint n_removed bigint kept_sha256 string",
    "op13_target_resampling": "doc_id bigint n_features bigint weight bigint score bigint rank bigint"}


@pytest.mark.parametrize("name", COLUMNS)
def test_registered_queries_keep_their_contract(spark, name):
    """Names and types, and the values that the query's SQL states."""
    folder = "/root/testdata/sf0.001"
    result = queries.QUERIES[name](spark, folder)
    assert " ".join(f"{c} {t}" for c, t in result.dtypes) == COLUMNS[name]
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    wanted = con.execute(f"SELECT {', '.join(result.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(wanted, key=repr)


def test_stages_on_empty_tables_nulls_and_extra_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, uid long, row string, key string"
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    text = " ".join(f"word{i}" for i in range(80))
    odd = [(None, text, None, None, None, 1, "r", "k"), (1, None, None, "s", 0, 1, "r", "k"), (2, text, "en", None, 9, 1, "r", "k"),
           (2, text, "en", None, 9, 1, "r", "k"), (3, "", "en", "s", 0, 1, "r", "k"), (4, text.replace("word1", "other"), "de", "s", 9, 1, "r", "k")]
    # The one line of the row without an id is document 2's as well: it goes, and an empty text stays.
    for rows, left in (([], set()), (odd, {None, 2, 4})):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), "test-odd")
            assert docs.columns == [c.split()[0] for c in schema.split(", ")], name
        assert {r["doc_id"] for r in docs.collect()} == left
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert {r["doc_id"] for r in pieces} == left
