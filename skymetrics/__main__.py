"""``spark-submit`` entry: ``python -m skymetrics extract|kpi|result ...``."""

import argparse
import logging
from datetime import datetime

from skymetrics.plans.jobs import QUESTIONS, extract, newest_hour, read_result, run_kpis
from skymetrics.plans.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="skymetrics")
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("extract", help="type, clean and store the landed feeds")
    load.add_argument("--landing", required=True)
    ask = jobs.add_parser("kpi", help="answer questions from stored tables")
    ask.add_argument("--results", required=True)
    ask.add_argument("--question", choices=sorted(QUESTIONS), action="append")
    ask.add_argument("--latest", action="store_true", help="the newest hour that has the tables")
    ask.add_argument("--as-of", type=datetime.fromisoformat, help="with --latest: none later")
    show = jobs.add_parser("result", help="print the newest stored results")
    show.add_argument("--results", required=True)
    show.add_argument("--question", choices=sorted(QUESTIONS), action="append")
    show.add_argument("--as-of", type=datetime.fromisoformat, help="none later")
    for job in (load, ask):
        job.add_argument("--store", required=True)
    for job in (load, ask, show):
        job.add_argument("--at", type=datetime.fromisoformat, default=None)
        job.add_argument("--master", default=None)
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    # One run time for the whole job: a run that crosses the hour stays in the hour it began.
    at = args.at or datetime.now()
    spark = build_session(f"skymetrics-{args.job}", args.master)
    if args.job == "extract":
        extract(spark, args.landing, args.store, at)
        return
    questions = args.question or list(QUESTIONS)
    if args.job == "result":
        for question in questions:
            print(question)
            # A result has a row for each continent or country, or one.
            read_result(spark, question, args.results, args.at, args.as_of).show(1000, truncate=False)
        return
    if args.latest and args.at is None:
        # One hour for all questions of a run.
        at = newest_hour(spark, args.store, questions, args.as_of)
    run_kpis(spark, args.store, args.results, at, questions)


if __name__ == "__main__":
    main()
