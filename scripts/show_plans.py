"""Print the formatted physical plan of registered queries.

Usage: python scripts/show_plans.py [sf_dir] [name ...]   (default: all queries)
Shows pushed filters, read schemas, exchanges and join strategies as planned
before execution (AQE may still re-plan joins from measured sizes).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkqueries.queries import QUERIES  # noqa: E402
from privlink.session import local_session  # noqa: E402

_EAGER = {"csv_roundtrip_linked", "csv_roundtrip_documents"}  # write before planning


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n in QUERIES if not n.startswith("jobs_") and n not in _EAGER]
    spark = local_session(8)
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
