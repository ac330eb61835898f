"""Task functions travel by value: executors without a copy of the package run the queries."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
from codetrail.llm import queries
for name in {names!r}:
    print(name, queries.QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_queries_run_where_workers_have_no_copy(tmp_path):
    names = ["op1_toxicity", "op3_decontaminate", "op6_language_id", "op7_secrets", "op8_token_count", "op9_quality", "op10_exact_dedup", "op11_ngram_join"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, names=names)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1500)
    assert out.returncode == 0, out.stderr[-3000:]
    assert [line.split()[0] for line in out.stdout.splitlines() if line.startswith("op")] == names
