"""The other queries do not depend on the operators for training data, nor on what these need."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import json, sys
sys.modules["{missing}"] = None
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
print(json.dumps([sorted(entry.queries()), sorted(entry.oracle_sql())]))
"""


@pytest.mark.parametrize("missing", ["public_tokenizers", "xxhash", "silverlode.llm", "corpus_pipeline"])
def test_entry_without(missing):
    script = SCRIPT.format(missing=missing, root=ROOT)
    told = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True, cwd="/")
    names, with_sql = json.loads(told.stdout.splitlines()[-1])
    assert {"scan_parquet", "silver_trips", "redelivery_overlap"} <= set(names) and set(with_sql) <= set(names)
    assert "pipeline" not in names
    if missing != "corpus_pipeline":
        assert not [n for n in names if n.startswith("op")]
