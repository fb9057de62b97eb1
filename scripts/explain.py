"""Print the formatted physical plan of registered queries.

usage: python scripts/explain.py [sf_dir] [name ...]   (default: the bench's headline queries)

Stream and sink queries run their jobs when built (replay, store writes);
the plan printed for them is that of the final read.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from clickflow.plans.registry import QUERIES  # noqa: E402
from clickflow.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or HEADLINE
    spark = build_session("local[8]", 8)
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
