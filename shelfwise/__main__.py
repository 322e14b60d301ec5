"""Command line: run the whole batch or one named query.

    python -m shelfwise pipeline <sf_dir> <out_root>   # 19 tables as Parquet + manifest
    python -m shelfwise pipeline <csv_dir> <out_root> --csv   # the same from the five CSV files
    python -m shelfwise pipeline <sf_dir> <out_root> --register   # and as catalog tables with statistics
    python -m shelfwise export <sf_dir> <jdbc url> [schema] [--csv]   # the 19 tables to a relational target
    python -m shelfwise query <name> <sf_dir> [n]      # show the first n rows of a query
    python -m shelfwise list                           # the query names

On a cluster, submit with spark-submit and name spark.checkpoint.dir; the session
settings the operators need are applied on top of the submitted ones.
"""

from __future__ import annotations

import json
import sys

from shelfwise.plans import catalog, pipeline
from shelfwise.session import build_session


def main(argv: list[str]) -> int:
    if not argv or argv[0] not in ("pipeline", "export", "query", "list"):
        print(__doc__)
        return 2
    if argv[0] == "list":
        print("\n".join(catalog.QUERIES))
        return 0
    spark = build_session()
    if argv[0] == "pipeline":
        sf_dir, out_root = argv[1], argv[2].rstrip("/")
        rows = pipeline.run(spark, sf_dir, out_root, csv="--csv" in argv)
        spark.createDataFrame([json.dumps(r) for r in rows], "string").coalesce(1) \
            .write.mode("overwrite").text(f"{out_root}/_manifest")
        if "--register" in argv:
            pipeline.register(spark, out_root, rows)
        for r in rows:
            print(f"{r['tabla']}: {r['filas']} rows, {r['segundos']} s")
        return 0
    if argv[0] == "export":
        sf_dir, url, *rest = [a for a in argv[1:] if a != "--csv"]
        for r in pipeline.export(spark, sf_dir, url, rest[0] if rest else "public", csv="--csv" in argv):
            print(f"{r['tabla']}: {r['filas']} rows")
        return 0
    name, sf_dir = argv[1], argv[2]
    n = int(argv[3]) if len(argv) > 3 else 20
    catalog.registry()[name](spark, sf_dir).show(n, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
