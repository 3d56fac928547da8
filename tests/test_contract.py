"""The driver contract and the coverage map stay in step with the registry."""

import os
import re
import subprocess
import sys

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_oracle_keys_are_registered_and_aliases_unique():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


def test_coverage_map_names_only_registered_keys():
    text = open(os.path.join(ROOT, "COVERAGE.md")).read()
    keys = set(E.queries())
    rows = [line for line in text.splitlines() if line.startswith("| ") and not line.startswith("| id") and "---" not in line]
    named = set()
    for row in rows:
        cells = [c.strip() for c in row.strip("|").split("|")]
        if len(cells) >= 3:
            named |= set(re.findall(r"`([a-z_][a-zA-Z_0-9<>]*)`", cells[2]))
    named = {k for k in named if "<" not in k and k != "entry"}  # entry is the flagship function
    assert named, "no keys found"
    assert named <= keys, sorted(named - keys)
    surveyed = {
        "scan_trips", "bronze_counts", "roundtrip_parquet", "null_profile", "profile_columns", "duplicate_report",
        "describe_numeric", "drop_sparse_nulls", "impute_mean", "impute_mode", "impute_policy", "dedup_rows",
        "distinct_months", "time_features", "encode_flag", "log_target", "outlier_filter", "outlier_reject_reasons",
        "silver_trips", "avg_duration_by_hour", "avg_duration_one_hour", "payment_analysis", "payment_analysis_sql",
        "avg_duration_by_category", "corr_matrix", "corr_matrix_wide", "duration_histogram", "feature_frame",
        "train_test_split", "train_gbt_metrics", "train_lr_metrics", "train_rf_metrics", "eval_r2", "eval_mae",
        "model_roundtrip", "score_batch", "prediction_sample", "prediction_log", "stream_score",
    }
    assert surveyed <= keys, sorted(surveyed - keys)


def test_entry_works_without_the_training_data_subpackage():
    """The subpackage and its pipeline may be absent; a missing module inside them is an error."""
    code = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as E
print(len(E.queries()), len(E.oracle_sql()), any(k.startswith("op1_") or k == "pipeline" for k in E.queries()))
"""
    run = lambda *names: subprocess.run([sys.executable, "-c", code.format(names=set(names))], capture_output=True, text=True, cwd=ROOT)
    out = run("tripspark.llm", "corpus_pipeline")
    assert out.returncode == 0, out.stderr
    queries, oracles, found = out.stdout.split()
    assert int(queries) >= 57 and int(oracles) >= 48 and found == "False"
