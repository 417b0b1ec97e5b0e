"""Build the warehouse tables from an input directory.

Usage: python scripts/build_warehouse.py <sf_dir> <target_dir> [model ...]
Staging models become temp views; the other models are written as Parquet
tables under <target_dir>/<layer>/<model>.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    if len(sys.argv) < 3:
        raise SystemExit(__doc__)
    from marketlens.plans.build import build
    from marketlens.session import get_session
    from marketlens.sources.sinks import remove_tables
    spark = get_session()
    written = build(spark, sys.argv[1], sys.argv[2], models=sys.argv[3:] or None)
    for name, path in written.items():
        print(f"{name}\t{path}")
    remove_tables(spark)


if __name__ == "__main__":
    main()
