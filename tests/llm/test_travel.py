"""The operators' Python code reaches executors that cannot import the package."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from millrace.llm import packing, queries
docs = spark.createDataFrame([(i, "some words of text " * (i + 1)) for i in range(8)], "doc_id bigint, text string")
probe = docs.rdd.map(lambda r: __import__("importlib.util").util.find_spec("millrace") is None).collect()
assert all(probe), "the workers can import the package"
assert packing.pack(docs).agg({{"length": "sum"}}).first()[0] == sum(len(packing.encoder(packing.default_vocabulary()).encode_ordinary("some words of text " * (i + 1))) + 1 for i in range(8))
docs.write.parquet({folder!r} + "/documents.parquet")
assert queries.QUERIES["op11_tokens"](spark, {folder!r}).count() == 8
print("arrived")
"""


def test_memoised_helpers_travel_by_value(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    seen = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p and Path(p).resolve() != Path(root)]
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(root=root, folder=str(tmp_path)))
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ":".join(seen)}, capture_output=True, text=True, timeout=300)
    assert "arrived" in ran.stdout, ran.stderr[-3000:]
