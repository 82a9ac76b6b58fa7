"""Write PLANS.md: the physical plan of every registered batch query.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from hitlens.registry import BATCH_QUERIES
    from hitlens.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    out = ["# Physical plans", "",
           f"`explain(\"formatted\")` tree of every registered batch query at `{sf_dir}`, "
           "local[8], AQE on (initial plan). Written by `tools/plans.py`.", ""]
    for name, fn in BATCH_QUERIES.items():
        text = fn(spark, sf_dir)._jdf.queryExecution().explainString(mode)
        tree = text.split("\n\n(1)")[0].replace("== Physical Plan ==\n", "").rstrip()
        scans = [line.strip() for line in text.splitlines()
                 if line.strip().startswith(("ReadSchema:", "PushedFilters:"))]
        out += [f"## {name}", "", "```", tree, *scans, "```", ""]
    spark.stop()
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)
