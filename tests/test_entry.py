import re

import __spark_entry__ as E


def test_registry_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    own = [k for k in q if not re.match(r"op\d+_|pipeline$", k)]
    # The 63 rows of the inventory, and more queries that show more of them.
    more = {"csv_bad_lines", "live_metrics_stream", "forest_fit_checks", "forest_fit_depth3", "tree_fit_depth3",
            "train_job_single_split", "end_to_end_single_split", "request_forms"}
    assert len(set(own) - more) == 63 and more <= set(own)
    assert set(o) <= set(q)
    assert set(own) - set(o) == {"forest_fit", "train_job", "end_to_end_job"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["sample_index", "id", "actual_k", "predicted_k", "abs_error_k"]
    assert 0 < len(rows) <= 100
