"""Command line: python -m lexmill build | lookup | search | stats | audit.

build writes a lexicon's Parquet folder and its index; the others read them.
The session is the one spark-submit gives, else one on this machine.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from lexmill.lexicon import Lexicon
from lexmill.operators.index import SearchIndex
from lexmill.plans.runtime import session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexmill", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build")
    for name in ("synset", "jsonl", "supplemental", "overrides", "blocklist"):
        b.add_argument(f"--{name}")
    b.add_argument("--out", required=True)
    b.add_argument("--skip-safety", action="store_true")
    for command, word, limit in (("lookup", "word", 10), ("search", "query", 20)):
        c = sub.add_parser(command)
        c.add_argument("lexicon")
        c.add_argument(word)
        c.add_argument("--limit", type=int, default=limit)
        c.add_argument("--safe", action="store_true")
        c.add_argument("--min-confidence", type=float, default=0.0)
    sub.choices["search"].add_argument("--mode", choices=("tier", "fts", "prefix"), default="fts")
    sub.add_parser("stats").add_argument("lexicon")
    a = sub.add_parser("audit")
    a.add_argument("lexicon")
    a.add_argument("--audits", default="", help="comma-separated; all by default")
    return p


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    """The tables the command answers with, by name."""
    if args.command == "build":
        lex = Lexicon.from_sources(spark, args.synset, args.jsonl, args.supplemental, args.overrides, args.blocklist).build(args.skip_safety)
        lex.write_parquet(f"{args.out}/entries")
        return {"meta": Lexicon.read(spark, f"{args.out}/entries").indexed(f"{args.out}/index").meta()}
    lex = Lexicon.read(spark, f"{args.lexicon}/entries")
    if args.command in ("lookup", "search"):
        lex = Lexicon(lex.entries, index=SearchIndex(spark, f"{args.lexicon}/index", "ord"))
        if args.command == "lookup":
            return {"entries": lex.lookup(args.word, args.limit, args.safe, args.min_confidence)}
        return {"entries": lex.search(args.query, args.mode, args.limit, args.safe, args.min_confidence)}
    if args.command == "stats":
        return {"meta": lex.meta()}
    return lex.audit(*[n for n in args.audits.split(",") if n])


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or session()
    for name, df in run(spark, args).items():
        print(f"# {name}")
        df.show(100, truncate=80)


if __name__ == "__main__":
    main()
