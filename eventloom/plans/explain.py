"""Print the executed physical plans of registered queries (development aid).

``python -m eventloom.plans.explain SF_DIR query [query ...]`` runs each
query once and prints its final adaptive plan, i.e. after AQE has applied
runtime broadcasts, coalescing and skew splits.
"""

from __future__ import annotations

import io
import sys
from contextlib import redirect_stdout

from eventloom.plans.registry import QUERIES
from eventloom.session import build_session


def executed_plan(df) -> str:
    df.collect()  # development aid on small inputs: finalises the adaptive plan
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def main(argv: list[str]) -> None:
    sf_dir, names = argv[0], argv[1:]
    spark = build_session()
    for name in names:
        print(f"## {name}\n\n{(QUERIES[name].__doc__ or '').strip()}\n\n```")
        print(executed_plan(QUERIES[name](spark, sf_dir)).strip())
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
