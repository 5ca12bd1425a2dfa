"""The package reaches Python workers that have no copy of it."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from docengine.runtime import session
from docengine.operators import similarity as sim
spark = session("ship", "local[1]", spark__ui__enabled="false", spark__sql__shuffle__partitions="1",
                spark__sql__warehouse__dir={folder!r})
index = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "chunk_id STRING, embedding ARRAY<FLOAT>")
queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id INT, query_vec ARRAY<FLOAT>")
print("HITS", [r.chunk_id for r in sim.similarity_topk(index, queries, 1, "chunk_id", "embedding").collect()])
spark.stop()
"""


def test_functions_run_in_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=ROOT, folder=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "HITS ['a']" in done.stdout, done.stderr[-2000:]
