import re

import __spark_entry__ as contract
from panelcast.session import shared_dir


def test_oracles_belong_to_queries():
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) >= 140 and len(oracles) >= 90


def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert rows and {"series_id", "best_model", "weighted_mape"} <= set(rows[0].asDict())


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_no_unbounded_constructs():
    """No limits, samples or cross joins in the library; two corpus models are fitted on samples of a stated bound."""
    import pathlib
    fitted_on_samples = {"importance.py", "neighbours.py"}
    for path in pathlib.Path("panelcast").rglob("*.py"):
        text = path.read_text()
        if path.name in fitted_on_samples:
            text = text.replace(".limit(sample)", "")
        if "plans" not in path.parts:
            assert not re.search(r"\.crossJoin\(|\.sample\(|\.limit\(|localCheckpoint|\.rdd\b", text), path
