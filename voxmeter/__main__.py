"""python -m voxmeter validate|run|discover|normalize|report|publish: the engine from the command line."""

from __future__ import annotations

import argparse
import sys

from . import __version__
from .runtime import local_session
from .sources import sinks


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="voxmeter")
    p.add_argument("command", choices=["validate", "run", "discover", "normalize", "report", "publish"])
    p.add_argument("--config", help="YAML or JSON settings, for validate")
    p.add_argument("--tables", help="folder of the parquet tables")
    p.add_argument("--out", default="results-{date}", help="folder of report and publish; {date} is today")
    p.add_argument("--examples", type=int, default=5)
    p.add_argument("--subset", action="append", help="only this subset of a run; may be repeated")
    p.add_argument("--limit", type=int, help="only so many clips a subset: a trial, not a result")
    p.add_argument("--stage", action="append", choices=["asr", "sim", "quality"], help="only this stage of a run; may be repeated")
    a = p.parse_args(argv)
    if a.command == "validate":
        from .config import ConfigError, load, load_env

        load_env()
        try:
            c = load(a.config)
        except ConfigError as e:
            print(e, file=sys.stderr)
            return 2
        print(f"{c.name}: {len(c.languages)} languages, {len(c.voices)} voices, {len(c.encoders)} encoders")
        return 0
    if a.command == "run":
        from .config import ConfigError, load, load_env
        from .stages import STAGES, Run

        load_env()
        try:
            c = load(a.config)
        except ConfigError as e:
            print(e, file=sys.stderr)
            return 2
        spark = local_session()
        spark.sparkContext.setLogLevel("ERROR")
        run = Run(spark, c, a.subset, a.limit)
        stages = tuple(a.stage or STAGES)
        pools = run.run(stages)
        facts = {"run": c.name, "config": a.config, "engine": __version__} | {s: run.cache.summary_of([u for u, _ in run.units([s])]) for s in stages}
        for path, size in sinks.stage({}, pools, sinks.folder_for(a.out), c.name, facts):
            print(f"{size:>10} {path}")
        return 0
    from .plans import evaluation, reports

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    if a.command == "discover":
        rows = [tuple(r) for r in reports.discover(spark, a.tables).orderBy("subset").collect()]
        print(sinks.console_table(["subset", "joined", "recognisers", "passes", "status"], rows))
        return int(any(r[-1] != "ok" for r in rows))
    if a.command == "normalize":
        rows = [tuple(r) for r in evaluation.norm_parity(spark, a.tables).orderBy("lang").collect()]
        print(sinks.console_table(["lang", "texts", "equal"], rows))
        for r in evaluation.norm_differences(spark, a.tables).limit(a.examples).collect():
            print(f"{r['row_id']}: {r['ours']!r} is stored as {r['stored']!r}")
        return 0
    tables = reports.tables(spark, a.tables)
    pools = {"asr": evaluation.pool(spark, a.tables)} if a.command == "publish" else {}
    folder = sinks.folder_for(a.out)
    for path, size in sinks.stage(tables, pools, folder, "Evaluation", {"tables": list(tables), "source": a.tables}):
        print(f"{size:>10} {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
