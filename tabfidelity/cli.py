"""tabfidelity run | profile | dp | generate | validate | tstr | build-prompt. Options win over the configuration's `run` section, its other sections, and defaults."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from .sources import io
from .spec import TableSpec


def _first(*values):
    """The first value that is given; zero is one."""
    return next((v for v in values if v is not None), None)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tabfidelity", description="Statistics, privacy and utility of synthetic tables on Spark.")
    p.add_argument("--config", default=None, help="base configuration (YAML)")
    p.add_argument("--domain", default=None, help="configuration of a domain, merged over the base")
    sub = p.add_subparsers(dest="command", required=True)
    add = lambda name, *options: [sub_.add_argument(*flags, **kw) for sub_ in (sub.add_parser(name),) for flags, kw in options]
    opt = lambda *flags, **kw: (flags, kw)
    add("run", opt("--seed"), opt("--condition"), opt("--output-dir"), opt("--epsilon", type=float), opt("--rows", type=int), opt("--skip-tstr", action="store_true"), opt("--skip-llm", action="store_true"))
    add("profile", opt("--seed", required=True), opt("--output"))
    add("dp", opt("--stats", required=True), opt("--epsilon", type=float, default=1.0), opt("--seed-val", type=int, default=42), opt("--output"))
    add("generate", opt("--seed", required=True), opt("--rows", type=int), opt("--output", required=True), opt("--stats"))
    add("validate", opt("--synthetic", required=True), opt("--seed", required=True), opt("--output"), opt("--stats"), opt("--skip-llm", action="store_true"))
    add("tstr", opt("--seed", required=True), opt("--synthetic", required=True), opt("--extended", action="store_true"), opt("--output"))
    add("build-prompt", opt("condition"), opt("--stats", required=True), opt("--rules"), opt("--output", "-o"), opt("--top-rules", type=int, default=15))
    return p


def _auditor(config: dict, skip: bool):
    """The service of the configuration's `audit` section (url, model, kind, ...); none without a url, or where it is to be skipped."""
    from functools import partial

    from .operators.synth import Endpoint, with_back_off

    settings = config.get("audit") or {}
    return None if skip or not settings.get("url") else partial(with_back_off, Endpoint(**settings))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    config = io.read_config(*[c for c in (args.config, args.domain) if c])
    section = config.get("run", {})
    from . import pipeline
    from .operators import prompts, report, synth
    from .session import local_session, ship

    spark = local_session()
    ship(spark)
    if args.command == "dp":
        out = pipeline.noise_profile(spark, io.read_stats(args.stats), args.epsilon, args.seed_val)
        io.write_json(out, args.output or str(Path(args.stats).with_suffix("")) + "_dp.json")
        return 0
    if args.command == "build-prompt":
        rules = io.read_rules(spark, args.rules) if args.rules else None
        text = pipeline.system_prompt(config, io.read_stats(args.stats), args.condition.replace("_", " "), rules, args.top_rules)
        Path(args.output or f"system_prompt_{args.condition}.md").write_text(text, encoding="utf-8")
        return 0
    path = _first(args.seed, section.get("seed"))
    if path is None:
        sys.exit("a seed table is needed: --seed, or seed in the configuration's run section")
    seed = io.read_csv(spark, path)
    types = {r["column"]: r["semantic_type"] for r in report.P.infer_types(seed).collect()}
    spec = TableSpec.from_config(config) if config.get("schema") else TableSpec.from_types(seed, types)
    if spec.target is None and args.command in ("run", "generate", "tstr"):
        spec = TableSpec(**{**spec.__dict__, "target": _first(config.get("tstr", {}).get("target_column"), spec.categorical[-1] if spec.categorical else None)})
    rules = pipeline.RuleSet.from_config(config)
    if args.command == "profile":
        io.write_json(report.build_profile(seed, spec), args.output or str(Path(args.seed).with_suffix("")) + "_stats.json")
    elif args.command == "generate":
        n = _first(args.rows, config.get("generation", {}).get("total_rows"), 3000)
        made = synth.synthesise(spark, seed, n, spec.target, list(dict.fromkeys((spec.target, *spec.categorical))), list(spec.numeric))
        made.write.mode("overwrite").csv(args.output, header=True)
    elif args.command == "validate":
        table = io.read_csv(spark, args.synthetic)
        out = pipeline.validate(table, seed, spec, rules)
        rows = [r.asDict() for r in out["issues"].collect()]
        print(report.console_table(rows, ["severity", "check", "detail"]))
        auditor = _auditor(config, args.skip_llm)
        if auditor:
            # Of the seed only statistics with noise are sent: those given, or else its own with noise of the configured epsilon. Issues have none.
            told = io.read_stats(args.stats) if args.stats else pipeline.noise_profile(spark, report.build_profile(seed, spec), config.get("dp", {}).get("epsilon", 1.0))
            out["audit"] = prompts.audit(auditor, told, rows, report.synthetic_profile(table, spec))
            print(json.dumps(out["audit"], indent=2, default=str))
        if args.output:
            io.write_json({**out, "issues": rows}, args.output)
    elif args.command == "tstr":
        from pyspark.sql import functions as F

        keyed = TableSpec(**{**spec.__dict__, "row_key": ("row_id",)})
        a, b = (d.withColumn("row_id", F.xxhash64(*d.columns)) for d in (seed, io.read_csv(spark, args.synthetic)))
        out = pipeline.utility(a, b, keyed, "forest", 5, ("forest", "logistic", "gbt") if args.extended else ())
        print(report.console_table(out["modes"], ["mode", "n", "accuracy", "macro_f1"]))
        print(json.dumps({"fidelity": out["fidelity"], "cross_validation": out["cross_validation"]}, indent=2, default=str))
        if args.extended:
            print(report.console_table(out["extended"], ["model", "regime", "n", "accuracy", "macro_f1", "mean_auc"]))
        if args.output:
            io.write_json(out, args.output)
            if args.extended:
                io.write_csv(out["extended"], str(Path(args.output).with_suffix("")) + "_report.csv")
    else:
        where = str(Path(_first(args.output_dir, section.get("output_dir"), "processed")) / str(_first(args.condition, section.get("condition"), Path(path).stem)))
        eps = _first(args.epsilon, section.get("epsilon"), config.get("dp", {}).get("epsilon"), 1.0)
        n = _first(args.rows, section.get("rows"), config.get("generation", {}).get("total_rows"), 3000)
        pipeline.run(spark, seed, spec, where, n, eps, rules, config.get("dp", {}).get("seed", 42), args.skip_tstr or bool(section.get("skip_tstr")), auditor=_auditor(config, args.skip_llm), progress=lambda k, of: print(f"{k} of {of} stages", file=sys.stderr))
    return 0


if __name__ == "__main__":
    sys.exit(main())
