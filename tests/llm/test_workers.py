"""Workers that cannot import the package: all classes must come by value."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})  # of the driver only
from pyspark.sql import functions as F
from tapeflow.session import local_session
from tapeflow.llm import attention, decontaminate

spark = local_session(2)


def no_package(batches):
    import importlib.util
    for batch in batches:
        batch["found"] = importlib.util.find_spec("tapeflow") is not None
        yield batch


assert not any(r.found for r in spark.range(4).withColumn("found", F.lit(True)).mapInPandas(no_package, "id long, found boolean").collect())
words = "one two three four five six seven eight nine ten eleven"
docs = spark.createDataFrame([(i, words + " w" * i) for i in range(30)], "doc_id long, text string")
items = spark.createDataFrame([("a", words)], "item_id string, text string")
if {operator!r} == "decontaminate":
    assert all(r.hits.items == ["a"] for r in decontaminate.find(docs, items).collect())
else:
    assert all(r.score < 0 for r in attention.lm_scores(docs).collect())
print("done")
"""


@pytest.mark.parametrize("operator", ["decontaminate", "attention"])
def test_workers_without_the_package(tmp_path, operator):
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not Path(p).resolve().is_relative_to(REPO)]
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(paths)}
    script = tmp_path / "script.py"
    script.write_text(SCRIPT.format(repo=str(REPO), operator=operator))
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0 and "done" in run.stdout, run.stderr[-3000:]
