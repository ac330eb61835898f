"""Job entry point: run the models, then their declared quality rules.

    spark-submit --py-files codetrail.zip codetrail/plans/run.py --sources <root> --target <root> \\
        --as-of 2026-05-02T06:00:00 [--select transfers_attributed+] [--full-refresh] [--test]

(or ``python -m codetrail.plans.run ...`` where a Spark environment is configured).

``--select`` takes model names; ``+name`` adds its upstream models, ``name+`` its downstream
models (the three models form a chain). ``--as-of`` is the run instant used by the look-back
windows (defaults to the current UTC time). ``--test`` runs the declared rules of the selected
models and fails the job when any rule has failing rows. ``--target-days`` bounds how far back an
incremental run looks for old rows of its keys. Fragmented partitions are compacted after the
writes (``--no-compact`` leaves them), and ``--export-root`` exports the tables of the run;
``--export-start``, ``--export-end`` and ``--export-full`` ask for a manual window or re-sync.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from codetrail import schemas
from codetrail.functions.windows import Floors, tx_window, utc_naive
from codetrail.operators import export, quality, upsert
from codetrail.plans import models
from codetrail.session import TIME_ZONE, input_bytes, shuffle_partitions_for
from codetrail.sources import catalog as C

ORDER = ["transactions_attributed", "transfers_attributed", "buildercode_daily_metric"]
RULES = {
    "transactions_attributed": quality.TRANSACTIONS_RULES,
    "transfers_attributed": quality.TRANSFERS_RULES,
    "buildercode_daily_metric": quality.DAILY_RULES,
}


def select_models(spec: list[str] | None) -> list[str]:
    if not spec:
        return list(ORDER)
    chosen: set[str] = set()
    for item in spec:
        name = item.strip("+")
        if name not in ORDER:
            raise SystemExit(f"unknown model {name!r}; known: {ORDER}")
        i = ORDER.index(name)
        chosen.add(name)
        if item.startswith("+"):
            chosen.update(ORDER[:i])
        if item.endswith("+"):
            chosen.update(ORDER[i + 1:])
    return [m for m in ORDER if m in chosen]


def run(spark: SparkSession, cat: C.SourceCatalog, paths: models.ModelPaths, selected: list[str],
        as_of: dt.datetime | None, full_refresh: bool = False, chain: str = "celo", floors: Floors = Floors(),
        replace_days: bool = False, target_days: int | None = None, observe: bool = False):
    results = {}

    def since(target: str) -> dt.date | None:
        """First date that an incremental run reads."""
        window = tx_window(as_of) if models.is_incremental(spark, target, full_refresh) else None
        return None if window is None else window.date_bound

    if "transactions_attributed" in selected:
        tx = cat.read(spark, *C.TRANSACTIONS, since=since(paths.transactions_attributed))
        results["transactions_attributed"] = models.run_transactions(
            spark, tx, paths.transactions_attributed, as_of, floors, full_refresh, target_days, observe=observe)
    if "transfers_attributed" in selected:
        tr = cat.read(spark, *C.TRANSFERS, since=since(paths.transfers_attributed))
        results["transfers_attributed"] = models.run_transfers(
            spark, tr, paths.transactions_attributed, paths.transfers_attributed, as_of, chain, floors, full_refresh,
            target_days=target_days, observe=observe)
    if "buildercode_daily_metric" in selected:
        pr = cat.read(spark, *C.PRICES)
        results["buildercode_daily_metric"] = models.run_daily(
            spark, pr, paths.transactions_attributed, paths.transfers_attributed, paths.daily_metric, as_of, chain,
            floors, full_refresh, replace_days)
    return results


def read_sizes(spark: SparkSession, cat: C.SourceCatalog, paths: models.ModelPaths, as_of: dt.datetime | None,
               full_refresh: bool = False) -> list[int]:
    """Bytes of the two large sources that the run will read, for sizing its shuffles."""
    w = tx_window(as_of) if models.is_incremental(spark, paths.transactions_attributed, full_refresh) else None
    since = None if w is None else w.date_bound
    return [input_bytes(spark, cat.path(*source), "block_date", since) for source in (C.TRANSACTIONS, C.TRANSFERS)]


def compact(spark: SparkSession, paths: models.ModelPaths, results: dict) -> dict[str, list[str]]:
    """After the writes: compact the partitioned tables that this run wrote."""
    tables = {"transactions_attributed": (paths.transactions_attributed, schemas.TX_PARTITION),
              "transfers_attributed": (paths.transfers_attributed, schemas.TRANSFER_PARTITION)}
    return {m: upsert.compact(spark, *tables[m]) for m in results if m in tables}


def exported(paths: models.ModelPaths, selected: list[str], days: int = 1) -> list[export.ExportedModel]:
    """The two attributed tables as exports: an incremental run sends the last ``days`` days."""
    meta = {"export": {"enabled": True, "time_column": "block_time",
                       "time_start_incremental": lambda as_of: as_of - dt.timedelta(days=days)}}
    all_ = [export.ExportedModel("transactions_attributed", paths.transactions_attributed, schemas.TX_KEY, meta, partition_by=schemas.TX_PARTITION),
            export.ExportedModel("transfers_attributed", paths.transfers_attributed, schemas.TRANSFER_KEY, meta, partition_by=schemas.TRANSFER_PARTITION)]
    return [m for m in all_ if m.table in selected]


def test(spark: SparkSession, paths: models.ModelPaths, selected: list[str]):
    """Declared rules of the selected models; returns the failing ones as rows."""
    where = {"transactions_attributed": (paths.transactions_attributed, schemas.TX_ATTRIBUTED),
             "transfers_attributed": (paths.transfers_attributed, schemas.TRANSFERS_ATTRIBUTED),
             "buildercode_daily_metric": (paths.daily_metric, schemas.DAILY_METRIC)}
    out = []
    for m in selected:
        out += quality.failing(RULES[m].run(C.read_table(spark, *where[m]))).collect()
    return out


def test_written(spark: SparkSession, paths: models.ModelPaths, results: dict):
    """The declared rules on what this run wrote; returns the failing ones as rows.

    NULLs were counted by the write itself, keys are checked in the touched partitions only. A table
    that was built anew, and the daily metric, which is small, are tested whole.
    """
    where = {"transactions_attributed": (paths.transactions_attributed, schemas.TX_ATTRIBUTED, schemas.TX_PARTITION),
             "transfers_attributed": (paths.transfers_attributed, schemas.TRANSFERS_ATTRIBUTED, schemas.TRANSFER_PARTITION)}
    out = []
    for m, r in results.items():
        if m not in where or r.first_run or r.observed is None:
            out += test(spark, paths, [m])
            continue
        path, schema, part = where[m]
        scope = upsert.in_partitions([part], [(v,) for v in r.touched_partitions])
        out += quality.failing(quality.observed_summary(C.read_table(spark, path, schema), RULES[m], r.observed, scope, r.rows)).collect()
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--sources", required=True, help="root of the source catalog")
    ap.add_argument("--database", default="main", help="folder of the catalog that holds the sources")
    ap.add_argument("--target", required=True, help="root folder of the model tables")
    ap.add_argument("--as-of", default=None, help="run instant, ISO format, UTC")
    ap.add_argument("--select", nargs="*")
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--test", action="store_true")
    ap.add_argument("--test-written", action="store_true",
                    help="test what the run wrote: NULLs counted by the write, keys in touched partitions (no scan of the history)")
    ap.add_argument("--chain", default="celo")
    ap.add_argument("--floor-date", default=None, help="historical start date (default: the models' floor)")
    ap.add_argument("--floor-time", default=None, help="historical start instant of transactions/transfers")
    ap.add_argument("--price-floor", default=None, help="historical start instant of prices")
    ap.add_argument("--replace-days", action="store_true",
                    help="daily metric: replace whole recomputed days (drops codes that vanished upstream)")
    ap.add_argument("--target-days", type=int, default=None,
                    help="incremental runs look for old rows in the last so many days only (default: the whole table, exact)")
    ap.add_argument("--no-compact", action="store_true", help="leave fragmented partitions as they are")
    ap.add_argument("--export-root", default=None, help="export the tables of the run under this folder")
    ap.add_argument("--export-start", default=None, help="manual export window, ISO instants")
    ap.add_argument("--export-end", default=None)
    ap.add_argument("--export-full", action="store_true", help="export afresh instead of merging")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="default: sized from what the run reads, ~256 MB per partition")
    args = ap.parse_args(argv)

    spark = (SparkSession.builder.appName("codetrail-models")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
             .config(TIME_ZONE, "UTC")
             .getOrCreate())
    cat = C.SourceCatalog(args.sources, args.database)
    instant = lambda x: utc_naive(dt.datetime.fromisoformat(x)) if x else None
    as_of = instant(args.as_of) or utc_naive(dt.datetime.now(dt.timezone.utc))
    selected = select_models(args.select)
    paths = models.ModelPaths.under(args.target)
    d = Floors()
    floors = Floors(
        dt.date.fromisoformat(args.floor_date) if args.floor_date else d.date,
        dt.datetime.fromisoformat(args.floor_time) if args.floor_time else d.time,
        dt.datetime.fromisoformat(args.price_floor) if args.price_floor else d.price_time,
    )
    partitions = args.shuffle_partitions or shuffle_partitions_for(
        spark, read_sizes(spark, cat, paths, as_of, args.full_refresh))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    results = run(spark, cat, paths, selected, as_of, args.full_refresh, args.chain, floors, args.replace_days, args.target_days,
                  observe=args.test_written)
    if not args.no_compact:
        compact(spark, paths, results)
    if args.export_root:
        export.sync_models(spark, exported(paths, selected), args.export_root, as_of, not args.full_refresh,
                           True if args.export_full else None, instant(args.export_start), instant(args.export_end))
    if args.test or args.test_written:
        bad = test(spark, paths, selected) if args.test else test_written(spark, paths, results)
        for r in bad:
            print(f"FAIL {r['model']}.{r['column']} {r['rule']}: {r['failing_rows']} rows", file=sys.stderr)
        return 1 if bad else 0
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
