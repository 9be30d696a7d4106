"""Write PLANS.md: the final adaptive physical plans of the headline queries.

Usage: python tests/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEYS = ["genre_top5_profile", "genre_top5_movies", "genre_avg_rating", "popular_movies", "co_rated_pairs", "adjusted_cosine", "top50_predicted"]


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n(1)")[0].split("+- == Initial Plan ==")[0].rstrip()


def main() -> None:
    from cinemetrics.plans import catalog
    from cinemetrics.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    out = [
        "# Physical plans",
        "",
        f"Final adaptive plans after execution (`{sf_dir}`, `local[8]`, AQE on) of the registered queries, which derive",
        "the ratings from lineitem and orders.",
        "Generated by `python tests/dump_plans.py`.",
        "",
    ]
    for key in KEYS:
        df = catalog.QUERIES[key](spark, sf_dir)
        df.collect()
        out += [f"## {key}", "", "```", tree(df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
