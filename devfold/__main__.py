"""Run batch stages: ``python -m devfold --input DIR --output DIR [stage ...]``."""

from __future__ import annotations

import argparse

from devfold.plans.stages import STAGES, Run
from devfold.schemas import FeatureSpace
from devfold.session import get_session, scratch


def main() -> None:
    parser = argparse.ArgumentParser(prog="devfold", description=__doc__)
    known = ", ".join(STAGES)
    parser.add_argument("stages", nargs="*", metavar="stage", help=f"default: all of {known}")
    parser.add_argument("--input", required=True, help="folder of the source CSV files")
    parser.add_argument("--output", required=True, help="folder for tables, models, submissions")
    parser.add_argument("--labels", type=int, default=FeatureSpace().labels)
    parser.add_argument("--clusters", type=int, default=FeatureSpace().clusters)
    parser.add_argument("--seed", type=int, default=17)
    args = parser.parse_args()
    unknown = set(args.stages) - STAGES.keys()
    if unknown:
        parser.error(f"unknown stage {', '.join(sorted(unknown))}; known are {known}")
    space = FeatureSpace(labels=args.labels, clusters=args.clusters)
    run = Run(get_session(), args.input, args.output, space, seed=args.seed)
    for name in args.stages or STAGES:
        with scratch(run.spark):  # a stage's own tables go when it ends
            STAGES[name](run)


if __name__ == "__main__":
    main()
