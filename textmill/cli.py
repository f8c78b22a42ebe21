"""python -m textmill.cli --input DIR [--output DIR] [--config FILE] [--analyze]"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from textmill import config
from textmill.plans import build
from textmill.session import clean_up, session
from textmill.sources.files import discover, file_totals, read_documents


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True)
    p.add_argument("--output")
    p.add_argument("--config", default="config.yaml")
    p.add_argument("--analyze", action="store_true")
    a = p.parse_args(argv)
    if not a.output and not a.analyze:
        p.error("--output or --analyze is needed")
    spark, cfg = session(), config.load(a.config)
    files = discover(spark, a.input)
    docs = read_documents(spark, a.input).where("error is null")
    docs = docs.withColumn("seq", F.struct("source_file", F.coalesce("line_number", F.lit(0)).alias("line_number")))
    if a.analyze:
        for r in file_totals(files).orderBy("file_type").collect():
            print(r["file_type"], "read" if r["supported"] else "skipped", r["files"], r["bytes"])
        for line in build.preview_lines(build.analyze(docs, "source_file", cfg)):
            print(line)
        return 0
    result = build.run_build(spark, docs, a.output, cfg, files.count())
    clean_up(spark)
    for k, v in result.items():
        print(f"{k}: {v}")
    return int(result["status"] != "BUILD SUCCESSFUL")


if __name__ == "__main__":
    sys.exit(main())
