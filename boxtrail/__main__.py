"""Command line over a lake: trace, sales, ingest, import, export, status, log."""

from __future__ import annotations

import argparse
import getpass
import json
import socket
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from boxtrail.operators import reports
from boxtrail.plans import ingest, jobs
from boxtrail.plans.trace import MODES
from boxtrail.schemas import BOX
from boxtrail.session import build_session
from boxtrail.sources import jdbc
from boxtrail.sources.lake import lake_read


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="boxtrail")
    top.add_argument("--lake", required=True, help="root folder of the lake")
    top.add_argument("--master", help="Spark master, if not set by spark-submit")
    commands = top.add_subparsers(dest="command", required=True)

    trace = commands.add_parser("trace", help="trace the boxes of a tenant")
    trace.add_argument("--token", required=True)
    trace.add_argument("--modo", choices=MODES, default="completo")
    trace.add_argument("--dt-producao-de")
    trace.add_argument("--dt-producao-ate")
    trace.add_argument("--todos-periodos", action="store_true")
    trace.add_argument("--reset-flags", action="store_true")
    trace.add_argument("--no-update-rastreavel", action="store_true")

    sales = commands.add_parser("sales", help="trace open sales")
    sales.add_argument("--grupo", type=int)
    sales.add_argument("--token")
    sales.add_argument("--limite", type=int, default=0, help="oldest sales only; 0 for all")

    load = commands.add_parser("ingest", help="load pending payload files")
    load.add_argument("--tipo", choices=("animais", "abates", "escalas", "simples", "raw"), required=True)
    load.add_argument("--pending", required=True)
    load.add_argument("--archive")
    load.add_argument("--token", help="tenant, for slaughter records and schedules")
    load.add_argument("--strict", action="store_true")
    load.add_argument("--lines", action="store_true", help="one document per line")

    for name, text in (("import", "copy a database table into the lake"),
                       ("export", "write a lake table to the database")):
        move = commands.add_parser(name, help=text)
        move.add_argument("--options", required=True, help="JSON file: url, user, password, driver")
        move.add_argument("--table", required=True)
        move.add_argument("--schema", default="public")
        if name == "import":
            move.add_argument(
                "--split", nargs=4, metavar=("COLUMN", "LOWER", "UPPER", "PARTS"),
                help="read the table in this many ranges of a number or date column",
            )
        else:
            move.add_argument("--mode", choices=jdbc.WRITE_MODES, default="append")
            move.add_argument("--connections", type=int, help="most parallel writers")

    status = commands.add_parser("status", help="flag reports")
    status.add_argument("--token")
    status.add_argument("--out", help="folder for the reports as CSV")
    commands.add_parser("log", help="latest log rows")
    return top


def payload_of(args: argparse.Namespace) -> ingest.Payload:
    of_tenant = {"abates": ingest.slaughter_records, "escalas": ingest.schedules}
    if args.tipo in of_tenant:
        if not args.token:
            raise ValueError("slaughter records and schedules need --token")
        return of_tenant[args.tipo](args.token)
    kinds = {
        "animais": ingest.animals, "simples": ingest.simple_animals, "raw": ingest.raw_animals,
    }
    return kinds[args.tipo]()


def _connection(args: argparse.Namespace) -> dict[str, str]:
    return json.loads(Path(args.options).read_text())


SHOWN = 100


def _show(df: DataFrame, out: str | None = None, name: str = "") -> None:
    """Print a report, or write all of it under a folder."""
    if out:
        df.write.mode("overwrite").option("header", True).csv(f"{out.rstrip('/')}/{name}")
        return
    df.show(SHOWN, truncate=False)
    if df.limit(SHOWN + 1).count() > SHOWN:
        print(f"only the first {SHOWN} rows; --out writes all of them")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "trace":
        jobs.run_trace(
            spark, args.lake, args.token, args.modo, args.dt_producao_de, args.dt_producao_ate,
            every_period=args.todos_periodos, reset=args.reset_flags,
            update_traceable=not args.no_update_rastreavel,
        )
    elif args.command == "sales":
        jobs.run_sales(spark, args.lake, args.grupo, args.token, args.limite or None)
    elif args.command == "ingest":
        jobs.run_ingest(
            spark, args.lake, payload_of(args), args.pending, archive=args.archive,
            multi_line=not args.lines, strict=args.strict,
            user=getpass.getuser(), host=socket.gethostname(),
        )
    elif args.command == "import":
        split = jdbc.Split(*args.split[:3], int(args.split[3])) if args.split else None
        jobs.run_import(
            spark, args.lake, _connection(args), args.table, schema=args.schema, split=split
        )
    elif args.command == "export":
        jobs.run_export(
            spark, args.lake, _connection(args), args.table, schema=args.schema,
            mode=args.mode, connections=args.connections,
        )
    elif args.command == "status":
        boxes = lake_read(spark, args.lake, "bt_caixas", schema=BOX)
        _show(reports.flag_status(boxes, args.token), args.out, "flag_status")
        _show(reports.completeness_status(boxes, args.token), args.out, "completeness_status")
        _show(reports.flag_relationship(boxes, args.token), args.out, "flag_relationship")
    else:
        _show(reports.latest_log_rows(lake_read(spark, args.lake, "log_processamento")))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(master=args.master)
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
