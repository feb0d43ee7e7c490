"""Command line: transform, validate-config, explain."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from dossier.plans.config import ConfigError, load_config
from dossier.plans.pipeline import Pipeline, RunResult, transform
from dossier.plans.project import ValidationError
from dossier.session import build_session, clear_scratch
from dossier.sources.scan import scan


def explain(result: RunResult, field: str | None = None, to=None) -> None:
    """What was read, and of each candidate every value with its evidence, dissent and conflicts; to stderr, as it is at the call, unless
    told otherwise."""
    to = to or sys.stderr
    print("\n=== INGEST LOG ===", file=to)
    for r in result.ingest_log().toLocalIterator():
        print(f"  {r['event']}: {r['origin']} [{r['source_type']}] {r['detail']}", file=to)
    for p in result.profiles.select("candidate_id", "overall_confidence", "envelopes", "conflicts").orderBy("candidate_id").toLocalIterator():
        print(f"\n=== CANDIDATE {p['candidate_id']} (overall={p['overall_confidence']}) ===", file=to)
        for name, e in p["envelopes"].items():
            if field in (None, name):
                print(f"  {name}: value={e['value']!r} conf={e['confidence']} method={e['method']} sources={e['sources']}", file=to)
                for a in e["alternatives"]:
                    print(f"      alt: {a.asDict()}", file=to)
        for c in p["conflicts"]:
            print(f"  conflict: {c.asDict(recursive=True)}", file=to)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="dossier", description="reconcile record sources into profiles")
    sub = p.add_subparsers(dest="command", required=True)
    t, e = sub.add_parser("transform", help="run and emit profiles"), sub.add_parser("explain", help="why each value is what it is")
    for x in (t, e):
        x.add_argument("inputs", nargs="+", help="files, globs, or type=path")
        x.add_argument("--config", help="output configuration (JSON)")
        x.add_argument("--locale", choices=["US", "EU", "UK", "IN"], help="order of ambiguous dates")
        x.add_argument("--default-country", help="two-letter country of phone numbers that don't tell theirs")
    t.add_argument("--out", help="write JSON here, else to stdout")
    t.add_argument("--indent", type=int, default=2)
    t.add_argument("--explain", action="store_true")
    e.add_argument("--field", help="only this field")
    sub.add_parser("validate-config", help="check an output configuration").add_argument("config")
    return p


def main(argv: list[str] | None = None) -> int:
    """0: done; 2: the configuration is wrong; 3: the result failed its validation."""
    args = parser().parse_args(argv)
    if args.command == "explain":
        result = transform(build_session(), args.inputs, args.config, args.locale, args.default_country)
        explain(result, args.field)
        print(result.summary(), file=sys.stderr)
        clear_scratch(result.profiles.sparkSession)
        return 0
    try:
        config = load_config(args.config)
    except (ConfigError, OSError, json.JSONDecodeError) as x:
        print(f"{'INVALID' if args.command == 'validate-config' else 'config error'}: {x}", file=sys.stderr)
        return 2
    if args.command == "validate-config":
        print(f"OK: {args.config} is a valid output config ({len(config['fields'])} fields, on_missing={config.get('on_missing', 'null')})")
        return 0
    spark = build_session()
    try:
        result = Pipeline(spark, config, args.locale, args.default_country).run(scan(spark, args.inputs))
    except ValidationError as x:
        print(f"validation failed: {x}", file=sys.stderr)
        return 3
    text = json.dumps(result.output(), indent=args.indent, ensure_ascii=False)
    if args.out:
        Path(args.out).parent.mkdir(parents=True, exist_ok=True)
        Path(args.out).write_text(text + "\n", encoding="utf-8")
        print(f"wrote {args.out}", file=sys.stderr)
    else:
        print(text)
    print(result.summary(), file=sys.stderr)
    if args.explain:
        explain(result)
    clear_scratch(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
