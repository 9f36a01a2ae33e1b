"""Command line: run pipeline stages or a registered query.

    python -m strata pipeline --sf-dir DIR --out ROOT --as-of 2024-01-01 [--stages raw_to_silver ...]
                              [--payload-dir DIR] [--customer-updates] [--date-range START END]
                              [--catalog-db gold] [--sources tables.json]
    python -m strata query NAME --sf-dir DIR --out PATH
    python -m strata list

On a cluster, submit it with the cluster's settings (see ``cluster_conf``);
the session the launcher provides is used as is.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline", help="run pipeline stages")
    p.add_argument("--sf-dir", default="", help="folder of the driver's tables (without --sources)")
    p.add_argument("--sources", help="JSON file: raw table -> path, columns, defaults (sources.binding)")
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", required=True)
    p.add_argument("--stages", nargs="*")
    p.add_argument("--payload-dir")
    p.add_argument("--customer-updates", action="store_true")
    p.add_argument("--date-range", nargs=2, metavar=("START", "END"))
    p.add_argument("--catalog-db")
    p.add_argument("--no-halt", action="store_true", help="log DQ failures instead of halting")
    q = sub.add_parser("query", help="write one registered query's result as Parquet")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", required=True)
    sub.add_parser("list", help="list registered queries")
    args = ap.parse_args(argv)

    from .plans import registry
    if args.cmd == "list":
        for name, (_, sql) in sorted(registry.REGISTRY.items()):
            print(f"{name}\t{'sql-checked' if sql else 'rows-only'}")
        return 0

    from .session import get_session
    spark = get_session()
    if args.cmd == "pipeline":
        from .plans import pipeline as P
        from .sources.binding import BoundTables
        if not args.sources and not args.sf_dir:
            ap.error("--sf-dir or --sources is needed")
        sources = BoundTables.from_json(open(args.sources).read()) if args.sources else None
        cfg = P.PipelineConfig(args.sf_dir, args.out, args.as_of, payload_dir=args.payload_dir,
                               customer_updates=args.customer_updates, halt_on_dq=not args.no_halt,
                               catalog_database=args.catalog_db, sources=sources,
                               date_range=tuple(args.date_range) if args.date_range else None)
        res = P.run(spark, cfg, args.stages)
        print(json.dumps(res, default=str))
        return 0
    fn, _ = registry.REGISTRY[args.name]
    fn(spark, args.sf_dir).write.mode("overwrite").parquet(args.out)
    print(json.dumps({"query": args.name, "out": args.out}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
