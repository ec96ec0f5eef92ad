"""Commands: fetch, stage1, stage2, stage3, stage4, all."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from .operators.crosswalk import sparql
from .plans import stages
from .schema import Config
from .sources.fetch import FILES, fetch


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="polylex", description=__doc__)
    p.add_argument("command", choices=("fetch", "stage1", "stage2", "stage3", "stage4", "all"))
    p.add_argument("--corpus", help="CSV file of corpus rows")
    p.add_argument("--raw", required=True, help="folder of the ontology's flat files")
    p.add_argument("--out", help="folder of the artifacts")
    p.add_argument("--from", dest="origin", help="address of the folder that fetch takes the flat files from")
    p.add_argument("--refresh", action="store_true", help="fetch files that are there already")
    p.add_argument("--titles", help="JSON lines (chebi_id, qid, lang, title)")
    p.add_argument("--endpoint", help="SPARQL endpoint that titles are asked from, instead of --titles")
    p.add_argument("--lexicon", help="JSON lines (lang, word, swap_lang, term)")
    p.add_argument("--target", type=int, default=Config.bench1_target)
    p.add_argument("--seed", type=int, default=Config.seed)
    p.add_argument("--limit", type=int)
    p.add_argument("--provider", help="module:function from a list of requests to a list of replies; terms and checks come from it then")
    p.add_argument("--model", default="model", help="the provider's model, part of the cache's keys")
    p.add_argument("--cache", help="folder of the provider's replies; below --out if not given")
    a = p.parse_args(argv)
    need = ("origin",) if a.command == "fetch" else ("corpus", "out")
    if not all(getattr(a, n) for n in need):
        p.error(f"{a.command} needs {' and '.join('--from' if n == 'origin' else f'--{n}' for n in need)}")
    if a.command == "fetch":
        fetch({name: f"{a.origin.rstrip('/')}/{name}" for name in FILES}, a.raw, a.refresh)
        return
    spark = SparkSession.builder.appName("polylex").getOrCreate()
    paths = stages.Paths(a.corpus, a.raw, a.out, a.titles, a.lexicon)
    cfg = Config(seed=a.seed, bench1_target=a.target, bench2_target=a.target)
    model = None
    if a.provider:
        module, name = a.provider.split(":")
        model = stages.Model(getattr(importlib.import_module(module), name), a.model, a.cache or f"{a.out}/cache")
    lookup = sparql(a.endpoint) if a.endpoint else None
    step = {"stage2": stages.link_corpus, "stage3": stages.build_instances}
    if a.command == "stage1":
        stages.build_graph(spark, paths, cfg, lookup)
    elif a.command in step:
        step[a.command](spark, paths, cfg)
    elif a.command == "stage4":
        stages.build_variants(spark, paths, cfg, a.limit, model)
    else:
        stages.run_all(spark, paths, cfg, a.limit, model, lookup)


if __name__ == "__main__":
    main()
