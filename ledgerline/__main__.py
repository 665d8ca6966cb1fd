"""Command line: run the layer loads over a pipeline root.

    python -m ledgerline bronze --root /data/finance [--source bank] [--move-files]
    python -m ledgerline silver --root /data/finance [--source bank]
    python -m ledgerline gold   --root /data/finance
    python -m ledgerline all    --root /data/finance [--parent-guid <guid>]

Each run appends its step log (with the GUID tree) to ``<root>/Admin/Log``.
On a cluster, submit with spark-submit; the active session is used as is.
"""

from __future__ import annotations

import argparse

from ledgerline.layout import Layout
from ledgerline.plans.bronze import load_files_to_bronze
from ledgerline.plans.gold import load_silver_to_gold
from ledgerline.plans.runlog import RunLog
from ledgerline.plans.silver import load_bronze_to_silver
from ledgerline.session import get_session
from ledgerline.sources.files import exists, mkdirs


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerline")
    ap.add_argument("layer", choices=["bronze", "silver", "gold", "all"])
    ap.add_argument("--root", required=True, help="pipeline root (any Hadoop-compatible URI)")
    ap.add_argument("--source", default=None, help="process one source folder only")
    ap.add_argument("--parent-guid", default=None, help="ExecutionGUID of a calling run")
    ap.add_argument("--move-files", action="store_true", help="move files per disposition")
    ap.add_argument("--years-back", type=int, default=5, help="date dimension history")
    args = ap.parse_args(argv)

    spark = get_session()
    layout = Layout(args.root)
    log = RunLog(f"ledgerline {args.layer}", parent_guid=args.parent_guid)
    failed = False
    try:
        with log.step("Main", layer=args.layer, source=args.source or "") as main_step:
            if args.source:
                folder = f"{layout.bronze_inbound}/{args.source}"
                if not exists(spark, folder):
                    mkdirs(spark, folder)
                    log.warn(main_step, f"No inbound folder yet for this source; made {folder}")
            if args.layer in ("bronze", "all"):
                load_files_to_bronze(spark, layout, log, args.source, args.move_files)
            if args.layer in ("silver", "all"):
                load_bronze_to_silver(spark, layout, log, args.source)
            if args.layer in ("gold", "all"):
                load_silver_to_gold(spark, layout, log, years_back=args.years_back)
    except Exception:
        failed = True
        raise
    finally:
        log.write(spark, layout.log)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
