"""``python -m loanweave clean|clean-all|verify|features|train`` (or via spark-submit)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame

from loanweave.operators.checks import SCHEMA, verdict
from loanweave.operators.training import application_features, train_and_evaluate
from loanweave.plans import features, prepare
from loanweave.session import get_session
from loanweave.sources.staging import release
from loanweave.sources.tables import APPLICANT, LABEL
from loanweave.sources.writers import write_features


def show(checked: DataFrame) -> None:
    rows = checked.collect()  # one per check
    found = checked.sparkSession.createDataFrame(rows, SCHEMA)
    found.show(len(rows), truncate=False)
    verdict(found).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loanweave")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, paths in {
        "clean": ("source", "target"),
        "clean-all": ("source", "target"),
        "verify": ("source",),
        "features": ("source", "target"),
        "vectors": ("source", "target"),
        "train": ("source", "target"),
    }.items():
        job = jobs.add_parser(name)
        for path in paths:
            job.add_argument(path)
        if name == "features":
            job.add_argument("--strategy", default="auto", choices=("auto", "broadcast", "shuffle"))
            job.add_argument("--with-balance", action="store_true")
        if name == "clean-all":
            job.add_argument("--schemas", help="JSON file: table name to DDL")
            job.add_argument("--check", action="store_true", help="also show the checks, taken while writing")
    args = parser.parse_args(argv)
    spark = get_session(f"loanweave-{args.job}")
    if args.job == "clean":
        print(prepare.clean_application_csv(spark, args.source, args.target), "rows")
    elif args.job == "clean-all":
        schemas = None
        if args.schemas:
            with open(args.schemas, encoding="utf-8") as file:
                schemas = json.load(file)
        if args.check:
            show(prepare.clean_and_check(spark, args.source, args.target, schemas=schemas))
        else:
            print(prepare.clean_all(spark, args.source, args.target, schemas=schemas))
    elif args.job == "verify":
        show(prepare.verify(spark, args.source))
    elif args.job == "features":
        rows = features.build_final_features(
            spark, args.source, args.target, strategy=args.strategy, with_balance=args.with_balance
        )
        print(rows, "rows")
    elif args.job == "vectors":
        vectors = application_features(spark.read.parquet(args.source))
        write_features(vectors, args.target, (APPLICANT, LABEL, "scaled_features"))
    else:
        scores, _ = train_and_evaluate(spark.read.parquet(args.source), save_to=args.target)
        scores.show()
    release(spark)


if __name__ == "__main__":
    main()
