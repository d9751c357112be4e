"""``python -m palimpsest.cli``: decode, gate and evaluate tables from the command line or spark-submit."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from .operators import confidence, decode, evaluate, gate, service
from .plans.inputs import VOCAB
from .session import session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="palimpsest")
    commands = top.add_subparsers(dest="command", required=True)
    commands.add_parser("info", help="versions of what runs")
    run = commands.add_parser("decode", help="log-probabilities to texts with confidence and gate")
    run.add_argument("logits", help="Parquet with line_id, t and log_probs")
    run.add_argument("out")
    run.add_argument("--beam", type=int, default=0, help="beam width; 0 decodes greedily; what is wrong with a line that has no text is in the column error")
    run.add_argument("--mode", choices=("simple", "exact"), default="simple")
    run.add_argument("--threshold", type=float, default=gate.THRESHOLD)
    run.add_argument("--max-flags", type=int)
    run.add_argument("--vocab", help="text file, one entry a line, blank first")
    judge = commands.add_parser("evaluate", help="benchmark report of prediction and reference pairs")
    judge.add_argument("pairs", help="Parquet with the keys, prediction and reference")
    judge.add_argument("--key", action="append", required=True)
    judge.add_argument("--checkpoint", default="")
    judge.add_argument("--split", default="test")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session()
    if args.command == "info":
        print(json.dumps(service.runtime(spark).first().asDict()))
    elif args.command == "decode":
        vocab = open(args.vocab, encoding="utf-8").read().split("\n") if args.vocab else VOCAB
        logits = spark.read.parquet(args.logits)
        lines = confidence.scored(logits, vocab)
        if args.beam:
            best = decode.beam(decode.matrices(logits), vocab, width=args.beam, most=1, mode=args.mode, errors=True).select("line_id", "text", "error")
            lines = lines.drop("text").join(best, "line_id")
        gate.gate(lines.withColumn("ord", F.col("line_id")), args.threshold, args.max_flags).drop("ord").write.mode("overwrite").parquet(args.out)
    else:
        found = evaluate.report(spark.read.parquet(args.pairs), args.key, args.checkpoint, {}, args.split)
        print(json.dumps(found, ensure_ascii=False))


if __name__ == "__main__":
    main()
