"""Command line: page files of tenders in, one folder of artifacts a stage out.

    python -m tenderloom --dir FOLDER [--file PATH ...] --output FOLDER [--force]
        [--url URL --model NAME --key-variable NAME]

Files hold text items as JSON, as any PDF library can write them (no such
library is part of this package; ``sources.glyphs`` takes one as a callable).
Without ``--url`` a stand-in by rules takes the model's place.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from tenderloom.operators import layout, provider, segment, tree
from tenderloom.plans import pipeline
from tenderloom.runtime import Cut, scope
from tenderloom.sources import glyphs, store

log = logging.getLogger("tenderloom")


def run_files(spark: SparkSession, output: str, folder: str | None, paths: list[str], model: provider.Provider, force: bool = False, pattern: str = glyphs.PDF, reader: glyphs.Reader = glyphs.json_pages) -> pipeline.Result:
    """All stages over files; chunks, extractions, consolidated requirements and trees are written as JSON lines by tender, unreadable files as errors."""
    items = Cut(glyphs.text_items(glyphs.files(spark, folder, paths, pattern), reader), "items").df
    lines = layout.lines(layout.glyphs(items.filter("error is null")))
    result = pipeline.run(Cut(lines, "lines").df, model, cache=f"{output}/cache", force=force)
    written: dict[str, DataFrame] = {"chunks": result.chunks, "extractions": result.extractions, "consolidated": result.requirements, "tree": tree.tree_json(result.nodes)}
    for name, df in written.items():
        store.write_artifact(df, f"{output}/{name}", "source_file")
    store.write_artifact(items.filter("error is not null").select("doc_id", "error"), f"{output}/errors")
    store.write_artifact(result.failures, f"{output}/failures")
    store.write_artifact(result.usage, f"{output}/usage")
    for r in segment.region_counts(result.chunks).groupBy("document_region").sum("n_chunks").collect():
        log.info("chunks of region %s: %s", r[0], r[1])
    return result


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tenderloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--file", "-p", action="append", default=[])
    p.add_argument("--dir", "-d")
    p.add_argument("--output", "-o", default="outputs")
    p.add_argument("--force", "-f", action="store_true")
    p.add_argument("--url")
    p.add_argument("--model", default="")
    p.add_argument("--key-variable", default="MODEL_API_KEY")
    a = p.parse_args(argv)
    if not a.file and not a.dir:
        p.error("give --file or --dir")
    model = provider.HttpProvider(a.url, a.model, a.key_variable) if a.url else provider.RulesProvider()
    spark = SparkSession.builder.getOrCreate()
    with scope():
        run_files(spark, a.output, a.dir, a.file, model, a.force)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
