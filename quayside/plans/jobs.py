"""Job entry points over the operational source tables (JOB1, JOB2, JOB4, JOB5).

Each job resolves its inputs through a table source (the metastore database
on a cluster: ``catalog_tables(spark, "source_db")``), builds the mart (jobs run
while it is built: aggregated lookups, sequence keys and shared intermediates
are written to the checkpoint folder) and, when a target is given, writes it (SNK1): overwrite, external path
and/or catalog table, ``fmt`` = parquet, delta, ... .  The audit timestamp is
the run time unless ``run_ts`` is injected.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from quayside.plans.capacity import capacity_mart
from quayside.plans.domain_sources import DomainInputs
from quayside.plans.proforma import proforma_mart
from quayside.plans.schedule import schedule_mart
from quayside.plans.user_state import user_state_mart
from quayside.session import SCALE_CONF
from quayside.sinks.tables import write_table
from quayside.sources.tables import TableSource, catalog_tables


def _finish(df: DataFrame, target_path: str | None, target_table: str | None, fmt: str) -> DataFrame:
    if target_path or target_table:
        write_table(df, target_path, table=target_table, fmt=fmt)
    return df


def run_user_state(tables: TableSource, *, target_path: str | None = None,
                   target_table: str | None = None, fmt: str = "parquet",
                   names: Mapping[str, str] | None = None,
                   run_ts: _dt.datetime | None = None) -> DataFrame:
    d = DomainInputs(tables, names)
    return _finish(user_state_mart(d.get("mfest_info"), d.get("mfest_ready_info"), run_ts),
                   target_path, target_table, fmt)


def run_schedule(tables: TableSource, *, target_path: str | None = None,
                 target_table: str | None = None, fmt: str = "parquet",
                 names: Mapping[str, str] | None = None, anchor: str = "dg_cutoff",
                 strategy: str = "pivot", sequence_strategy: str = "range",
                 run_ts: _dt.datetime | None = None) -> DataFrame:
    d = DomainInputs(tables, names)
    df = schedule_mart(d.get("voyage_stop_assn"), d.get("voyage"), d.get("stop"),
                       d.get("stop_arr_dep"), d.get("stop_cut_ava"), d.get("svc_operator_assn"),
                       d.get("vessel"), anchor=anchor, strategy=strategy,
                       sequence_strategy=sequence_strategy, run_ts=run_ts)
    return _finish(df, target_path, target_table, fmt)


def run_proforma(tables: TableSource, *, target_path: str | None = None,
                 target_table: str | None = None, fmt: str = "parquet",
                 names: Mapping[str, str] | None = None, num_files: int | None = None,
                 run_ts: _dt.datetime | None = None) -> DataFrame:
    d = DomainInputs(tables, names)
    df = proforma_mart(d.get("profm_stop_assn"), d.get("profm_stop"), d.get("profm_stop_cut_ava"),
                       d.get("proforma"), run_ts=run_ts, num_files=num_files)
    return _finish(df, target_path, target_table, fmt)


def run_capacity(tables: TableSource, *, by: str = "port", target_path: str | None = None,
                 target_table: str | None = None, fmt: str = "parquet",
                 names: Mapping[str, str] | None = None) -> DataFrame:
    d = DomainInputs(tables, names)
    assn = d.get("vsl_cap_port_assn" if by == "port" else "vsl_cap_tradelane_assn")
    df = capacity_mart(d.get("effective_voyage"), d.get("vsl_cap_default_assn"), assn,
                       d.get("vessel_capacity"), d.get("laden_capacity"), by=by)
    return _finish(df, target_path, target_table, fmt)


JOBS = {"user_state": run_user_state, "schedule": run_schedule, "proforma": run_proforma,
        "capacity": run_capacity}


def job_session(name: str) -> SparkSession:
    """The submitted session, with the settings of ``SCALE_CONF`` that
    spark-submit wasn't given and the metastore if the cluster has one."""
    given = SparkContext.getOrCreate().getConf()
    builder = SparkSession.builder.appName(name)
    for k, v in SCALE_CONF.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    if given.get("spark.sql.catalogImplementation", "") == "hive":
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m quayside.plans.jobs JOB --source-db DB --target-table T
    [--target-path P] [--format delta] [--table logical=physical ...]``; submit with
    ``--conf spark.checkpoint.dir=<folder shared by the cluster>``"""
    import argparse
    ap = argparse.ArgumentParser(prog="quayside.plans.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--source-db", required=True)
    ap.add_argument("--target-table")
    ap.add_argument("--target-path")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--table", action="append", default=[],
                    help="logical=physical source table name override")
    a = ap.parse_args(argv)
    if not (a.target_table or a.target_path):
        ap.error("give --target-table and/or --target-path")
    spark = job_session(f"quayside-{a.job}")
    names = dict(kv.split("=", 1) for kv in a.table)
    JOBS[a.job](catalog_tables(spark, a.source_db), target_path=a.target_path,
                target_table=a.target_table, fmt=a.format, names=names)


if __name__ == "__main__":
    main()
