"""Commands: run, ingest, quality-report, retarget-check, validate, info, doctor, init-config, queries, query."""

from __future__ import annotations

import argparse
import dataclasses
import json
import os
import shutil
import subprocess
from pathlib import Path

from strandweave.config import Alignment


class MissingBinary(RuntimeError):
    """A program that an operation needs is not there or doesn't run."""


def binary(name: str) -> str:
    """The program's path: the variable <NAME>_BINARY, else from PATH; it must tell its version."""
    path = os.environ.get(f"{name.upper()}_BINARY") or shutil.which(name)
    if not path:
        raise MissingBinary(f"{name} is not on PATH; {name.upper()}_BINARY may name it")
    try:
        subprocess.run([path, "-version"], capture_output=True, timeout=10, check=True)
    except (OSError, subprocess.SubprocessError) as e:
        raise MissingBinary(f"{path} doesn't run: {e}") from e
    return path


def doctor() -> dict[str, str]:
    """What is there of what the library and its optional parts need."""
    found = {}
    for name in ("ffmpeg", "ffprobe"):
        try:
            found[name] = binary(name)
        except MissingBinary as e:
            found[name] = f"missing: {e}"
    found["java"] = shutil.which("java") or "missing"
    for name in ("pyspark", "pyarrow", "pandas", "numpy", "yaml"):
        try:
            found[name] = getattr(__import__(name), "__version__", "there")
        except ImportError:
            found[name] = "missing"
    return found


def output_root(given: str | None) -> str:
    return given or os.environ.get("STRANDWEAVE_OUTPUT") or "output"


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandweave")
    sub = top.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="discover, validate, align, route and pack")
    run.add_argument("--input", required=True)
    run.add_argument("--output")
    run.add_argument("--config")
    run.add_argument("--manifest")
    run.add_argument("--session", default="default")
    take = sub.add_parser("ingest", help="check sessions and write them in normal form")
    take.add_argument("root")
    take.add_argument("--output")
    take.add_argument("--config")
    take.add_argument("--even-with-errors", action="store_true")
    quality = sub.add_parser("quality-report", help="a report over sessions' rows")
    quality.add_argument("rows", help="Parquet with the report's columns")
    quality.add_argument("--output")
    check = sub.add_parser("retarget-check", help="how well a robot follows hands")
    check.add_argument("hands", help="Parquet: session_id, frame_index, points, kept")
    check.add_argument("--urdf", required=True)
    check.add_argument("--arm", help="the side to which a stand-in arm is added")
    for name in ("validate", "info"):
        sub.add_parser(name, help=f"{name} a dataset").add_argument("root")
    sub.add_parser("doctor", help="what is installed")
    sub.add_parser("init-config", help="write the default settings").add_argument("path")
    sub.add_parser("queries", help="names of the queries")
    query = sub.add_parser("query", help="run a query over a folder of tables")
    query.add_argument("name")
    query.add_argument("sf_dir")
    query.add_argument("--rows", type=int, default=20)
    return top


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "doctor":
        print(json.dumps(doctor(), indent=2))
        return 0
    if args.command == "init-config":
        Path(args.path).write_text(json.dumps(dataclasses.asdict(Alignment()), indent=2) + "\n")
        return 0
    from strandweave.plans import QUERIES

    if args.command == "queries":
        print("\n".join(sorted(QUERIES)))
        return 0
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "run":
        from strandweave import flow

        settings = Alignment.from_file(args.config) if args.config else Alignment()
        print(json.dumps(flow.run(spark, args.input, output_root(args.output), settings, args.manifest, args.session), indent=2))
        return 0
    if args.command == "ingest":
        from strandweave import intake

        settings = intake.Settings.from_file(args.config) if args.config else intake.Settings()
        print(json.dumps(intake.run(spark, args.root, output_root(args.output), settings, args.even_with_errors), indent=2))
        return 0
    if args.command == "quality-report":
        from strandweave import report

        print(report.summary(report.write(spark.read.parquet(args.rows), output_root(args.output))))
        return 0
    if args.command == "retarget-check":
        from strandweave.operators import kinematics

        urdf = Path(args.urdf).read_text()
        urdf = kinematics.with_arm(urdf, args.arm) if args.arm else urdf
        found = kinematics.retarget(spark.read.parquet(args.hands), "session_id", "frame_index", "points", "kept", urdf)
        kinematics.fit_report(found, "session_id").show(truncate=False)
        return 0
    if args.command == "query":
        QUERIES[args.name](spark, args.sf_dir).show(args.rows, truncate=False)
        return 0
    from strandweave import dataset

    if args.command == "info":
        print(json.dumps(dataset.info_of(spark, args.root), indent=2))
        return 0
    found = dataset.validate(spark, args.root)
    print("\n".join(": ".join(x) for x in found) or "no findings")
    return int(any(severity == "error" for _, severity, _ in found))


if __name__ == "__main__":
    raise SystemExit(main())
