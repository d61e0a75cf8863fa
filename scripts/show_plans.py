"""Print the physical plan of registered queries (``explain("formatted")``).

usage: python scripts/show_plans.py [--sf-dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from shopstream.plans.registry import QUERIES
    from shopstream.session import build_session

    spark = build_session(master="local[8]")
    for name in args.names or ["window_stats", "daily_report", "top_products", "latest_windows"]:
        print(f"===== {name}")
        QUERIES[name](spark, args.sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
