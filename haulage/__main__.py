"""Run a project file: ``python -m haulage <project> --connections <file> [--target <profile>]``."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from .config import Project
from .plans.project import run_project
from .status import ERROR


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="haulage", description="Run the loads of a project.")
    parser.add_argument("project", help="project file, with or without .yml")
    parser.add_argument("--connections", required=True, help="file with the connections")
    parser.add_argument("--target", help="profile to use for every connection")
    chosen = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s | %(message)s", datefmt="%H:%M:%S")
    project = Project.from_yaml(chosen.project, chosen.connections, chosen.target)
    spark = SparkSession.builder.appName(f"haulage {project.name}").getOrCreate()
    return 1 if run_project(spark, project).count(ERROR) else 0


if __name__ == "__main__":
    sys.exit(main())
