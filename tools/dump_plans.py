"""Write the final (post-AQE) physical plan of every deterministic query.

Usage: python tools/dump_plans.py [sf_dir] > docs/PLANS.md
Each query is run once (collect), then its executed plan is printed, so
runtime decisions (broadcast conversion, reused exchanges, coalesced
shuffle reads) are visible.
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bagwise import build_session  # noqa: E402
from bagwise.plans import catalog  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print(f"# Final physical plans ({sf}, local[8], AQE on)\n")
    print("Generated by `tools/dump_plans.py`. Whole-stage codegen spans are "
          "marked `*(n)`.\n")
    for name, fn in catalog.DETERMINISTIC.items():
        df = fn(spark, sf)
        df.collect()
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        lines = [ln for ln in plan.splitlines() if ln.strip()]
        # keep the final plan only
        if "+- == Initial Plan ==" in plan:
            cut = next(i for i, ln in enumerate(lines) if "== Initial Plan ==" in ln)
            lines = lines[:cut]
        print(f"## {name}\n\n```")
        for ln in lines:
            print(ln[:200])
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
