"""Summarise the physical plans of the headline queries (PLANS.md).

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = (r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|BroadcastExchange|"
       r"BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct|"
       r"HashAggregate|SortAggregate|ObjectHashAggregate|Window|Generate|FlatMapGroupsInPandas")


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from ordermart.plans.queries import QUERIES, materialize_inputs
    from ordermart.session import get_spark, scratch_path

    spark = get_spark("plans", local=True)
    materialize_inputs(spark, sf, scratch_path(spark, "plan-inputs"))
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/plan_summary.py` at `{sf}` (stand-in inputs materialised as Parquet, as in the bench).")
    print("Counts are plan nodes of the executed (AQE initial) plan, without projections and filters;")
    print("`Exchange` is a shuffle (or a single-partition gather after partial aggregation), `BroadcastExchange`")
    print("a broadcast AQE chose from runtime sizes. Scans list the columns read and the filters pushed into Parquet.\n")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
            df._jdf.queryExecution(), "formatted")
        tree = text.split("\n\n(1)")[0]
        names = []
        for line in tree.splitlines():
            m = re.match(r"^[\s:+\-*|]*([A-Za-z]+)", line)
            if m and re.search(r"\(\d+\)\s*$", line):
                names.append(m.group(1))
        ops = Counter(n for n in names if n not in ("Project", "Filter", "ColumnarToRow", "AdaptiveSparkPlan", "Union"))
        print(f"## {name}\n")
        print("| operator | count |\n|---|---|")
        for k, v in sorted(ops.items()):
            print(f"| {k} | {v} |")
        scans = re.findall(r"ReadSchema: (struct<.*>)", text)
        pushed = re.findall(r"PushedFilters: (\[.*\])", text)
        for i, sch in enumerate(scans):
            pf = pushed[i] if i < len(pushed) else "[]"
            print(f"\n- scan `{sch[:220]}` pushed `{pf[:160]}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
