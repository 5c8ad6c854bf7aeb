"""Write the executed (AQE-final) physical plans of the headline reports to PLANS.md.

Usage: python tools/dump_plans.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from clickpath.session import build_session  # noqa: E402

# expression ids differ run to run; drop them so diffs show real plan changes
_IDS = re.compile(r"#\d+L?")


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()                 # run this plan itself (AQE finalizes it)
    text = qe.executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    return _IDS.sub("", text)


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, app_name="clickpath-plans")
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Executed plans of the headline reports", "",
           f"AQE-final physical plans on `{sf_dir}` (`local[8]`, 8 shuffle partitions),",
           "written by `tools/dump_plans.py`. Expression ids are removed.", ""]
    for name, q in HEADLINE.items():
        out += [f"## {name}", "", "```", final_plan(q(spark, sf_dir)).rstrip(), "```", ""]
    spark.stop()
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main(sys.argv)
