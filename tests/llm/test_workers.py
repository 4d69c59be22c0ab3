"""All queries in a session whose workers cannot import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from strata.session import build_session
spark = build_session(4, shuffle_partitions=4)
def seen(batches):
    import pyarrow as pa
    try:
        import strata
        found = 1
    except ModuleNotFoundError:
        found = 0
    for _ in batches:
        yield pa.RecordBatch.from_pydict({"found": [found]})
assert spark.range(1).mapInArrow(seen, "found long").first()[0] == 0
from strata.llm.registry import QUERIES
for name, query in QUERIES.items():
    print(name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "run.py").write_text(SCRIPT)
    done = subprocess.run([sys.executable, "run.py", ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    from strata.llm.registry import QUERIES

    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith(("op", "pipeline"))] == list(QUERIES)
