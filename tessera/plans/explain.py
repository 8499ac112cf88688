"""Print the formatted physical plan of registered queries.

    python -m tessera.plans.explain /root/testdata/sf0.1 genre_revenue lifecycle ...

With no query names every registered query is printed.  Plans are shown as
Spark will run them (AQE plans before execution), so scans list their
ReadSchema / PushedFilters and joins show their strategy.
"""

from __future__ import annotations

import sys

from tessera.plans.queries import QUERIES
from tessera.session import local_session


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(QUERIES)
    spark = local_session()
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
