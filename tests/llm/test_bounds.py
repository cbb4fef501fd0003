"""What the operators bring to the driver is named here, with its bound."""

import glob
import os
import re

LLM = os.path.join(os.path.dirname(__file__), "..", "..", "procurelytics", "llm")
#: Uses of collect() per module: pivots and their summaries, languages and their samples, one count, one count each.
COLLECTS = {"voronoi.py": 3, "language.py": 3, "suffix_dedup.py": 1, "near_dup.py": 2}


def test_only_named_collects():
    found = {}
    for path in glob.glob(f"{LLM}/*.py"):
        with open(path) as f:
            text = f.read()
        assert not re.search(r"localCheckpoint|crossJoin|toPandas|\.cache\(\)|\.persist\(", text), path
        if n := len(re.findall(r"\.collect\(\)", text)):
            found[os.path.basename(path)] = n
    assert all(n <= COLLECTS.get(name, 0) for name, n in found.items()), found
