"""Command line: ``python -m valuescope <job> ...`` (or ``spark-submit -m``-style launchers).

Jobs read parquet (``--format parquet``, default), CSV text (``--format csv``,
header line, tolerant parse) or an extracted archive folder (``--format archive``)
and write their result under ``--out``.

  profile      one-pass value files per field (+ --resume); --fields a,b,c;
               --by recordset writes one parquet profile with a profile per group;
               --out-format parquet writes the profile as parquet partitioned by field;
               with --format csv, --rejects PATH appends the rejected lines
  cardinality  cardinality report (--min, --share) or --approx estimate
  cumulate     cumulative frequency curves of --fields
  tf-index     term-frequency index: --id, --text col[,col], --tokenizer
  xref         identifier cross reference: --uuid, --ident, --text, [--index path]
  sequence     number-sequence study: --ident, --group (writes one folder per part)
  media        fingerprint duplicates of images under --input (--top k)
  subset       --where SQL, --limit n, --order-by a,b, --fraction f or
               --size n (exactly n rows) with --key k
"""

from __future__ import annotations

import argparse
import sys

from . import jobs
from .operators import ordered, profile
from .session import build_session, release_scratch
from .sinks import write_parquet, write_profile_parquet
from .sources import archive, csvtext


def _read(spark, args):
    if args.format == "csv":
        return csvtext.read_csv_records(spark, args.input).good
    if args.format == "archive":
        return archive.load_archive(spark, args.input, skip_eml=True).core
    return spark.read.parquet(args.input)


def _list(value: str | None) -> list[str] | None:
    return [v for v in value.split(",") if v] if value else None


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="valuescope", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=["profile", "cardinality", "cumulate", "tf-index", "xref",
                                   "sequence", "media", "subset"])
    p.add_argument("--input", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--format", choices=["parquet", "csv", "archive"], default="parquet")
    p.add_argument("--master")
    p.add_argument("--fields")
    p.add_argument("--nested", action="store_true")
    p.add_argument("--resume", action="store_true")
    p.add_argument("--min", type=int, default=100)
    p.add_argument("--share", type=float, default=0.95)
    p.add_argument("--approx", action="store_true")
    p.add_argument("--id")
    p.add_argument("--uuid")
    p.add_argument("--ident")
    p.add_argument("--group")
    p.add_argument("--text")
    p.add_argument("--index")
    p.add_argument("--tokenizer", choices=["treebank", "words"], default="treebank")
    p.add_argument("--top", type=int, default=20)
    p.add_argument("--where", action="append", default=[])
    p.add_argument("--limit", type=int)
    p.add_argument("--order-by")
    p.add_argument("--fraction", type=float)
    p.add_argument("--size", type=int)
    p.add_argument("--key")
    p.add_argument("--rejects")
    p.add_argument("--by", help="profile/cardinality per group of these columns (a,b)")
    p.add_argument("--out-format", choices=["csv", "parquet"], default="csv",
                   help="profile: per-field CSV value files (default) or parquet partitioned by field")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession
    owned = SparkSession.getActiveSession() is None
    spark = build_session(args.master, app=f"valuescope-{args.job}")
    try:
        _run_job(spark, args)
    finally:
        release_scratch(spark)  # outputs are written, or the job failed: drop the intermediate tables
        if owned:
            spark.stop()
    return 0


def _run_job(spark, args) -> None:
    if args.job == "media":
        write_parquet(jobs.media_duplicates(spark, args.input, args.top), args.out)
        return
    fields = _list(args.fields)
    if args.job == "profile" and args.format == "csv":
        if args.by or args.nested or args.out_format != "csv":
            raise SystemExit("profile --format csv writes value files: --by, --nested and --out-format do not apply")
        jobs.profile_csv(spark, args.input, fields, rejects_out=args.rejects, out=args.out, resume=args.resume)
        return
    df = _read(spark, args)
    by = _list(args.by) or []
    if args.job == "profile" and args.out_format == "parquet":
        write_profile_parquet(profile.value_profile(df, fields, args.nested, by=by), args.out)
    elif args.job == "profile" and by:
        write_parquet(profile.value_profile(df, fields, args.nested, by=by), args.out)
    elif args.job == "profile":
        jobs.profile_values(df, fields, nested=args.nested, out=args.out, resume=args.resume)
    elif args.job == "cardinality" and by:
        write_parquet(profile.cardinality(profile.value_profile(df, fields, args.nested, by=by), by=by),
                      args.out)
    elif args.job == "cardinality":
        result = (profile.cardinality_estimate(df, fields, nested=args.nested) if args.approx else
                  profile.cardinality_report(profile.value_profile(df, fields, args.nested),
                                             args.min, args.share))
        write_parquet(result, args.out)
    elif args.job == "cumulate":
        write_parquet(ordered.cumulate(profile.value_profile(df, fields, args.nested)), args.out)
    elif args.job == "tf-index":
        jobs.build_tf_index(df, args.id, _list(args.text), args.tokenizer, out=args.out)
    elif args.job == "xref":
        index = spark.read.parquet(args.index) if args.index else None
        _, lengths = jobs.cross_reference_job(df, args.uuid, args.ident, _list(args.text), index,
                                              args.tokenizer, out=args.out)
        write_parquet(lengths, f"{args.out.rstrip('/')}-length-histogram")
    elif args.job == "sequence":
        study = jobs.number_sequence(df, args.ident, args.group)
        for part in ("ranked", "bad", "summary", "repeats", "gaps", "slopes"):
            write_parquet(getattr(study, part), f"{args.out.rstrip('/')}/{part}")
    elif args.job == "subset":
        jobs.make_subset(df, args.limit, args.where, _list(args.order_by) or (), args.fraction,
                         args.key, out=args.out, size=args.size)


if __name__ == "__main__":
    sys.exit(main())
