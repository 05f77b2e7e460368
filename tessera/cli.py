"""Command line: discover, scrape, status and enrich.

Pages are fetched by a connector and models asked by a provider that ``--fetcher`` and
``--model`` name as ``module:factory``; without a name pages come by plain HTTP.
"""

from __future__ import annotations

import argparse
import dataclasses
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import fetch, graph, model_pass
from .operators.answer_cache import AnswerCache
from .plans import discovery, scrape
from .plans.config import Config
from .sources import exports, files, sitemaps, storage
from .streaming import incremental

SOURCES = ["fannie-mae", "freddie-mac"]
CHUNK = ["section_id", "seq"]


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tessera", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)
    discover = steps.add_parser("discover", help="list the sections of a sitemap")
    discover.add_argument("sitemap")
    discover.add_argument("--source", choices=SOURCES, required=True)
    discover.add_argument("--host")
    fetching = steps.add_parser("scrape", help="fetch, parse and store sections")
    fetching.add_argument("source", choices=[*SOURCES, "all"])
    fetching.add_argument("--output", default="output")
    fetching.add_argument("--section", help="one section by its code")
    fetching.add_argument("--sitemap", help="a sitemap in a file instead of the guide's own")
    fetching.add_argument("--delay", type=float)
    fetching.add_argument("--no-resume", action="store_true")
    fetching.add_argument("--max-sections", type=int)
    fetching.add_argument("--workers", "-w", type=int)
    fetching.add_argument("--fetcher")
    state = steps.add_parser("status", help="counters of a scrape")
    state.add_argument("folder")
    enrich = steps.add_parser("enrich", help="enrich a markdown tree")
    enrich.add_argument("tree")
    enrich.add_argument("folder")
    enrich.add_argument("--source", choices=SOURCES)
    enrich.add_argument("--incremental", action="store_true")
    enrich.add_argument("--files", action="store_true", help="also write a text file a chunk")
    enrich.add_argument("--stats", action="store_true")
    enrich.add_argument("--model")
    enrich.add_argument("--model-max-chunks", type=int)
    enrich.add_argument("--model-dry-run", action="store_true")
    enrich.add_argument("--no-model-cache", action="store_true")
    return parser


def named(path: str) -> Callable:
    """What ``module:name`` stands for."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def discovered(spark: SparkSession, sitemap: str, source: str, host: str | None) -> DataFrame:
    """url, section_code, slug, last_modified in the order of the codes."""
    rows = sitemaps.read_sitemap(spark, sitemap, host)
    return discovery.coded(rows, source.replace("-", "_"), host).orderBy("section_code")


def settings(args: argparse.Namespace, source: str) -> tuple[Config, float, int]:
    """The settings, the delay and the workers for a source; a guide has its own unless the user set them."""
    first = source == "fannie-mae"
    config = Config(max_sections=args.max_sections)
    delay = args.delay if args.delay is not None else config.first_delay if first else config.second_delay
    workers = args.workers if args.workers is not None else config.first_workers if first else config.second_workers
    return dataclasses.replace(config, max_workers=workers), delay, workers


def run_scrape(spark: SparkSession, args: argparse.Namespace, source: str) -> DataFrame:
    """Scrape one source into the tables below its folder; returns its manifest."""
    config, delay, workers = settings(args, source)
    name = source.replace("-", "_")
    folder = f"{args.output.rstrip('/')}/{name}"
    make = named(args.fetcher) if args.fetcher else fetch.Http(config)
    found = discovered(spark, args.sitemap, source, None) if args.sitemap else discovery.discover(spark, name, make, config)
    found = found.withColumn("source", F.lit(name))
    if args.section:
        found = found.filter(F.upper("section_code") == args.section.upper())
    if args.no_resume or args.section:
        scrape.forget(spark, folder, found)
    done = scrape.scrape(spark, found, folder, make, config, delay, workers)
    exports.write_sections(scrape.sections(spark, folder), args.output.rstrip("/"))
    return done


def run_status(spark: SparkSession, folder: str) -> None:
    """Counters, files and the first errors of each source whose manifest lies below ``folder``, or of ``folder`` itself."""
    places = [f"{folder}/{s.replace('-', '_')}" for s in SOURCES]
    places = [p for p in places if storage.exists(spark, f"{p}/manifest")] or [folder]
    for place in places:
        done = storage.stored(scrape.manifest(spark, f"{place}/manifest"))
        scrape.report(done, scrape.markdown_files(spark, place)).show(truncate=False)
        for r in scrape.first_errors(done).collect():
            print(f"{r['section_code']}: {r['error_type']} - {(r['error_message'] or '')[:60]}")


def run_enrich(spark: SparkSession, tree: str, folder: str, source: str | None) -> DataFrame:
    """Enrich a whole tree into the tables chunks and edges below ``folder``; returns the chunks."""
    sections = sitemaps.of_source(files.sections(files.scan_markdown(spark, tree)), source)
    incremental.replace(spark, sections, folder)
    return incremental.chunks(spark, folder)


def run_model(spark: SparkSession, args: argparse.Namespace, chunks: DataFrame) -> DataFrame:
    """The model pass over ``chunks``, or what it would cost."""
    model = named(args.model)() if args.model else model_pass.StubModel()
    cache = None if args.no_model_cache else AnswerCache(spark, f"{args.folder}/model-cache")
    if args.model_dry_run:
        model_pass.dry_run(chunks, model, cache, CHUNK, args.model_max_chunks).show(truncate=False)
        return chunks
    done = storage.stored(model_pass.enriched(chunks, model, cache, CHUNK, args.model_max_chunks))
    model_pass.totals(done, model).show(truncate=False)
    return done


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    Config()
    spark = spark or SparkSession.builder.appName("tessera").getOrCreate()
    if args.step == "discover":
        for row in discovered(spark, args.sitemap, args.source, args.host).toLocalIterator():  # all of them, a partition at a time
            print(*row, sep="\t")
    elif args.step == "scrape":
        for source in SOURCES if args.source == "all" else [args.source]:
            done = run_scrape(spark, args, source)
            scrape.status(done).show(truncate=False)
            if args.section and done.filter((F.upper("section_code") == args.section.upper()) & (F.col("status") != "failed")).isEmpty():
                return 1
    elif args.step == "status":
        run_status(spark, args.folder)
    else:
        if args.incremental:
            incremental.watch(spark, args.tree, args.folder).awaitTermination()
            chunks = incremental.chunks(spark, args.folder)
        else:
            chunks = run_enrich(spark, args.tree, args.folder, args.source)
        if args.model or args.model_dry_run:
            chunks = run_model(spark, args, chunks)
        incremental.replace_table(spark, graph.edges(chunks), f"{args.folder}/edges")
        exports.write_index(chunks, args.folder)
        exports.write_ontology(chunks, args.folder)
        if args.files:
            exports.write_chunks(chunks, args.folder)
        chunks.groupBy("content_type").count().orderBy(F.desc("count")).show(truncate=False)
        if args.stats:
            exports.totals(chunks).filter("kind = 'domain'").orderBy(F.desc("n"), "value").show(100, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
