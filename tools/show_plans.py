"""Write PLANS.md: the final (AQE) physical plan of the main queries.

Usage: python tools/show_plans.py [sf_dir]
"""
from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from immolens.plans.catalog import QUERIES  # noqa: E402
from immolens.session import local_session  # noqa: E402

NAMES = ["staging", "price_evolution", "mean_of_snapshot_means", "persistence_top20",
         "best_deals_20", "dedupe_in_snapshot", "gold_from_html", "page_cutoff"]


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)                       # attribute ids
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    text = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", text)
    return "\n".join(line[:220] for line in text.splitlines())


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = ["# PLANS", "",
           f"Final physical plans (after AQE) at `{sf_dir}`, local[8], generated by",
           "`tools/show_plans.py`. Attribute ids and file paths are stripped; lines are cut at",
           "220 characters.", ""]
    for name in NAMES:
        out += [f"## {name}", "", "```", final_plan(QUERIES[name](spark, sf_dir)), "```", ""]
    with open("PLANS.md", "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
