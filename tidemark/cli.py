"""Job surface: ``python -m tidemark.cli <layer> [flags]`` (or spark-submit).

  bronze  --source kafka|<dir> --topics t1,t2 --checkpoint <dir> --trigger "30 seconds"
          --starting-offsets earliest|latest [--available-now] --root <lake>
          [--partition-by cdc_table,event_day] [--dedup-within "1 hour"]
  silver  --root <lake> --table all|<name> [--by-month]
          | --root <lake> --incremental --checkpoint <dir>   (what is new in the bronze log)
  gold    --root <lake> --table all|<name>
  kpi     --root <lake> --name all|<kpi>
  sql     --root <lake> "<SELECT ... FROM gold_orders ...>" [--limit N] [--out <dir>]
          (every gold product is a view named gold_<product>; rows are printed as they
          come, or written as Parquet)

Silver and gold try every requested table and raise once at the end if any failed.
"""

from __future__ import annotations

import argparse
import sys

from tidemark.model import TABLES


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="layer", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--source", default="kafka")
    b.add_argument("--topics", default=",".join(TABLES),
                   help="table names or full topic names, comma separated")
    b.add_argument("--checkpoint", required=True)
    b.add_argument("--trigger", default="30 seconds")
    b.add_argument("--starting-offsets", default="earliest", choices=["earliest", "latest"])
    b.add_argument("--max-per-trigger", type=int, default=5000)
    b.add_argument("--available-now", action="store_true")
    b.add_argument("--dedup-within", default="1 hour")
    b.add_argument("--root", required=True)
    b.add_argument("--partition-by", default="cdc_table,event_day",
                   help="bronze layout columns (cdc_table, event_day, event_month)")
    b.add_argument("--timeout", type=float, default=None)
    s = sub.add_parser("silver")
    s.add_argument("--root", required=True)
    s.add_argument("--table", default="all")
    s.add_argument("--incremental", action="store_true")
    s.add_argument("--checkpoint", default=None)
    s.add_argument("--by-month", action="store_true")
    g = sub.add_parser("gold")
    g.add_argument("--root", required=True)
    g.add_argument("--table", default="all")
    k = sub.add_parser("kpi")
    k.add_argument("--root", required=True)
    k.add_argument("--name", default="all")
    q = sub.add_parser("sql")
    q.add_argument("--root", required=True)
    q.add_argument("statement")
    q.add_argument("--limit", type=int, default=None)
    q.add_argument("--out", default=None)
    return ap


def _tables(arg: str) -> list[str]:
    names = [t.strip().split(".")[-1] for t in arg.split(",") if t.strip()]
    return TABLES if names == ["all"] else names


def main(argv: list[str] | None = None, spark=None):
    from tidemark.plans import jobs
    from tidemark.plans import kpi as K
    from tidemark.session import apply_session_conf, get_session
    from tidemark.sources.store import Store
    from tidemark.streaming import bronze_stream as BS

    args = _parser().parse_args(argv)
    spark = spark or get_session(app=f"tidemark-{args.layer}", profile="cluster")
    apply_session_conf(spark)
    store = Store(spark, args.root)
    if args.layer == "bronze":
        tables = _tables(args.topics)
        if args.source == "kafka":
            src = BS.kafka_records(spark, tables=tables, starting_offsets=args.starting_offsets,
                                   max_offsets_per_trigger=args.max_per_trigger)
        else:
            src = BS.file_records(spark, args.source, tables,
                                  max_files_per_trigger=args.max_per_trigger)
        trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
        q = BS.start_bronze_stream(src, store, args.checkpoint, trigger=trigger,
                                   partition_by=args.partition_by.split(","),
                                   dedup_within=args.dedup_within or None)
        q.awaitTermination(args.timeout)
        if q.exception() is not None:
            raise q.exception()
        return q
    if args.layer == "silver":
        if args.incremental:
            if not args.checkpoint:
                raise SystemExit("--incremental needs --checkpoint")
            return jobs.run_silver_incremental(store, args.checkpoint)
        return jobs.run_silver(store, _tables(args.table), by_month=args.by_month)
    if args.layer == "gold":
        return jobs.run_gold(store, None if args.table == "all" else _tables(args.table))
    if args.layer == "kpi":
        kpis = K.build_kpis(jobs.read_gold(store))
        names = list(kpis) if args.name == "all" else [args.name]
        return {n: kpis[n].collect() for n in names}
    if args.layer == "sql":
        gold = jobs.read_gold(store)
        for product, df in gold.items():
            df.createOrReplaceTempView(f"gold_{product}")
        answer = spark.sql(args.statement)
        if args.limit is not None:
            answer = answer.limit(args.limit)
        if args.out:
            answer.write.parquet(args.out)
            return args.out
        for r in answer.toLocalIterator():  # a partition at a time on the driver
            print("\t".join("" if v is None else str(v) for v in r))
        return None
    raise SystemExit(f"unknown layer {args.layer}")


if __name__ == "__main__":
    main(sys.argv[1:])
