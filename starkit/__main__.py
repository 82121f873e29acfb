"""Command line: the warehouse jobs as spark-submit-able entry points.

    python -m starkit build    --raw DIR [--out DIR] [--fail-on-error]
    python -m starkit export   --raw DIR --target DIR
    python -m starkit fixtures --raw DIR --target DIR [--plates 5000] [--extra 02BND8]
    python -m starkit sample   --raw DIR --target DIR [--size 500000]
    python -m starkit profile  --raw DIR [report ...]
    python -m starkit land     --source DIR --format json --columns a,b,c --target DIR

Only small reports (check results, row counts, profiles) are shown on the
driver; all data stays in Spark.
"""

from __future__ import annotations

import argparse
import sys


def show_all(df):
    """Print every row of a report."""
    df.show(max(1, df.count()), truncate=False)
    return df


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starkit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="staging -> warehouse -> marts -> checks")
    b.add_argument("--raw", required=True)
    b.add_argument("--out")
    b.add_argument("--fail-on-error", action="store_true")
    e = sub.add_parser("export", help="build, then write the 8 star tables to --target")
    e.add_argument("--raw", required=True)
    e.add_argument("--target", required=True)
    f = sub.add_parser("fixtures", help="referentially consistent sample of the raw layer")
    f.add_argument("--raw", required=True)
    f.add_argument("--target", required=True)
    f.add_argument("--plates", type=int, default=5000)
    f.add_argument("--extra", nargs="*", default=["02BND8"])
    r = sub.add_parser("sample", help="one plate range applied to all vehicle files")
    r.add_argument("--raw", required=True)
    r.add_argument("--target", required=True)
    r.add_argument("--size", type=int, default=500_000)
    p = sub.add_parser("profile", help="raw-layer profiling reports")
    p.add_argument("--raw", required=True)
    p.add_argument("reports", nargs="*")
    ld = sub.add_parser("land", help="land new source files as all-string parquet (incremental)")
    ld.add_argument("--source", required=True)
    ld.add_argument("--format", default="json")
    ld.add_argument("--columns", required=True)
    ld.add_argument("--target", required=True)
    ld.add_argument("--checkpoint")
    a = ap.parse_args(argv)

    from starkit.session import get_session

    spark = get_session(app_name=f"starkit-{a.cmd}")
    if a.cmd in ("build", "export"):
        from starkit.plans import registry
        models, checks = registry.build(spark, a.raw, getattr(a, "out", None),
                                        fail_on_error=getattr(a, "fail_on_error", False))
        checks.orderBy("passed", "check_name").transform(show_all)
        if a.cmd == "export":
            registry.export_warehouse(models, a.target).transform(show_all)
    elif a.cmd == "fixtures":
        from starkit.plans import registry
        registry.make_fixtures(spark, a.raw, a.target, a.plates, a.extra).transform(show_all)
    elif a.cmd == "sample":
        from starkit.plans import registry
        registry.range_sample(spark, a.raw, a.target, a.size).transform(show_all)
    elif a.cmd == "profile":
        from starkit.plans import raw_profile
        for name in a.reports or list(raw_profile.REPORTS):
            print(f"== {name}")
            raw_profile.REPORTS[name](spark, a.raw).transform(show_all)
    elif a.cmd == "land":
        from starkit.sources.landing import string_schema
        from starkit.streaming import land_available, landed_stream
        cols = a.columns.split(",")
        stream = landed_stream(spark, a.source, a.format, string_schema(cols), cols)
        land_available(stream, a.target, a.checkpoint or f"{a.target.rstrip('/')}_checkpoint")
        print(spark.read.parquet(a.target).count(), "rows landed in total")
    return 0


if __name__ == "__main__":
    sys.exit(main())
