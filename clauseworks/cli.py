"""Command line: run a catalogued query, compile, search, export, split or count over a folder of tables."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame

from clauseworks.functions import rules
from clauseworks.operators import checks, collect, graph, provisions as pv, quality, search
from clauseworks.plans import catalogue, pipeline
from clauseworks.session import local_session, table
from clauseworks.sources import readers, writers

TABLES = ("documents", "provisions", "requirements", "tags", "jobs")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clauseworks", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name, text in (("query", "run a query of the catalogue"), ("search", "search the records"), ("compile", "split and extract"), ("export", "write all tables"), ("graph", "write the graph"), ("index", "write the dates index"), ("manifest", "count the tables"), ("check", "run checks; exit code 1 if one of severity error fails"), ("audit", "count issues per document"), ("validate", "list broken rules"), ("jobs", "list jobs"), ("review", "write the review manifest"), ("tag", "tag provisions and requirements")):
        c = sub.add_parser(name, help=text)
        c.add_argument("tables", help="folder of Parquet tables")
        if name == "query":
            c.add_argument("name", choices=sorted(catalogue.queries()))
        if name == "search":
            c.add_argument("terms")
            c.add_argument("--mode", choices=search.MODES, default="all")
            c.add_argument("--limit", type=int, default=20)
        if name == "check":
            c.add_argument("checks", nargs="+", help="files of checks, JSON lines")
            c.add_argument("--graph", action="store_true", help="also build the graph that graph checks look into")
        if name == "jobs":
            c.add_argument("--status", choices=rules.JOB_STATES)
        if name in ("compile", "export", "graph", "index", "review", "tag"):
            c.add_argument("out", help="folder to write to")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = local_session()
    t = {n: table(spark, args.tables, n) for n in TABLES}

    def show(df: DataFrame) -> None:
        for row in df.toLocalIterator():
            print("\t".join("" if v is None else str(v) for v in row))

    if args.command == "query":
        show(catalogue.queries()[args.name](spark, args.tables))
    elif args.command == "search":
        show(search.search_all(t, args.terms, args.limit) if args.mode == "all" else search.search_mode(t[args.mode], args.mode, args.terms, args.limit))
    elif args.command == "compile":
        for name, df in pipeline.compile_run(t["documents"]).items():
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
    elif args.command == "export":
        print(writers.export_tables(t, args.out))
    elif args.command == "graph":
        parts = t["documents"], t["provisions"], t["requirements"], t["tags"]
        print(writers.graph(*graph.assemble(graph.nodes(*parts), graph.edges(*parts)), args.out))
    elif args.command == "index":
        writers.index(collect.dates_index(pv.latest_documents(t["documents"])), ("document_id", "title", "release_date", "effective_date"), "document_id", args.out)
    elif args.command == "check":
        parts = t["documents"], t["provisions"], t["requirements"], t["tags"]
        both = (graph.nodes(*parts), graph.edges(*parts)) if args.graph else ()
        results = checks.run(readers.checks(spark, *args.checks), t, *both).orderBy("id").collect()  # as many rows as checks
        for r in results:
            print("ok" if r["passed"] else r["severity"], r["id"], r["type"], r["category"], sep="\t")
        return int(any(not r["passed"] and r["severity"] == "error" for r in results))
    elif args.command == "audit":
        show(quality.audit(t["provisions"], t["requirements"]))
    elif args.command == "validate":
        show(quality.validate_documents(t["documents"]).unionByName(quality.validate_provisions(t["provisions"])).unionByName(quality.validate_requirements(t["requirements"])))
    elif args.command == "jobs":
        show(checks.listed_jobs(t["jobs"], args.status))
    elif args.command == "review":
        checks.save_manifest(checks.review_manifest(t["provisions"]), args.out)
    elif args.command == "tag":
        pv.tagged_records(t["provisions"], t["requirements"]).write.mode("overwrite").json(args.out)
    else:
        show(collect.manifest(t))
    return 0


if __name__ == "__main__":
    sys.exit(main())
