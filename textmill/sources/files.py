"""Documents from a directory of files: discovery and readers for ten file types.

Order matters to later steps: seq is (source_file, line_number, chunk), and doc_id is a hash of file and line.
Records that can't be read become rows with `error`, they don't stop a run.
"""

from __future__ import annotations

import csv
import hashlib
import io
import itertools
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.records import text_field

# The extensions that are read, and their types.
TYPES = {
    ".txt": "txt", ".text": "txt", ".md": "markdown", ".markdown": "markdown", ".json": "json", ".jsonl": "jsonl", ".csv": "csv",
    ".tsv": "tsv", ".xml": "xml", ".html": "html", ".htm": "html", ".yaml": "yaml", ".yml": "yaml", ".pdf": "pdf",
}
ENCODINGS = ("utf-8", "windows-1254", "iso-8859-9")
#: JSONL, CSV and TSV files of more bytes are read line by line.
LINED = 8 << 20
WHOLE = ("txt", "markdown", "html", "xml", "yaml")
RECORD = "source_file string, file_type string, line_number int, text string, record string, metadata string, error string"


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def discover(spark: SparkSession, path: str) -> DataFrame:
    """path, file_type, size_bytes, supported, skip_reason; only names and sizes are read. A missing path has none; names
    that begin with _ or a full stop are hidden files to Spark and have no row."""
    if not exists(spark, path):
        return spark.createDataFrame([], "path string, file_type string, size_bytes long, supported boolean, skip_reason string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    kinds = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    kind = F.try_element_at(kinds, ext)
    other = F.when(ext == "", "unknown").otherwise(ext)
    return files.select(
        "path", F.coalesce(kind, other).alias("file_type"), F.col("length").alias("size_bytes"), kind.isNotNull().alias("supported"),
        F.when(kind.isNull(), F.concat(F.lit("unsupported extension: "), other)).alias("skip_reason"),
    ).orderBy("path")


def file_totals(files: DataFrame) -> DataFrame:
    """file_type, supported, files, bytes of discovered files."""
    return files.groupBy("file_type", "supported").agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"))


def decode(data: bytes) -> tuple[str, str]:
    """The text under the first encoding that fits, with line feeds only, and that encoding."""
    for name in ENCODINGS:
        try:
            return data.decode(name).replace("\r\n", "\n").replace("\r", "\n"), name
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", "replace"), "utf-8-replace"


def pdf_text(data: bytes) -> tuple[str, dict]:
    try:
        import pypdf

        pages = pypdf.PdfReader(io.BytesIO(data)).pages
        text = "\n\n".join(t for p in pages if (t := p.extract_text())).strip()
        return text, {"pdf_pages": len(pages), "pdf_extracted": bool(text)} | ({} if text else {"scanned_or_empty": True})
    except Exception as e:  # any damage to a file is reported with it
        return "", {"pdf_error": str(e)}


def records(data: bytes, kind: str) -> Iterator[tuple[int | None, str | None, str | None, dict, str | None]]:
    """(line_number, text, record, metadata, error) of a file: text where it is plain, record where a field holds it."""
    if kind in WHOLE:
        text, name = decode(data)
        yield None, text, None, {"encoding_used": name}, None
    elif kind == "pdf":
        text, meta = pdf_text(data)
        yield None, text, None, meta, None
    elif kind in ("csv", "tsv"):
        yield from table_records(io.StringIO(data.decode("utf-8", "replace"), newline=""), kind)
    else:
        if kind == "json":
            parts = [(None, data.decode("utf-8", "replace"))]
        else:
            parts = [(k + 1, x) for k, x in enumerate(decode(data)[0].split("\n")) if x.strip()]
        for line, part in parts:
            yield from json_records(part, line, kind)


def table_records(lines: Iterable[str], kind: str) -> Iterator[tuple[int | None, str | None, str | None, dict, str | None]]:
    """Those of the lines of a CSV or TSV file, each with its line break."""
    try:
        for k, row in enumerate(csv.DictReader(lines, delimiter="\t" if kind == "tsv" else ",")):
            yield k + 1, None, json.dumps({str(c): v for c, v in row.items()}, ensure_ascii=False), {}, None
    except csv.Error as e:
        yield None, None, None, {}, str(e)


def json_records(part: str, line: int | None, kind: str) -> Iterator[tuple[int | None, str | None, str | None, dict, str | None]]:
    """Those of a JSON file, or of a line of a JSONL file."""
    try:
        value = json.loads(part)
    except ValueError as e:
        yield line, None, None, {}, str(e)
        return
    several = kind == "json" and isinstance(value, list)
    for k, x in enumerate(value if several else [value]):
        at = k + 1 if several else line
        if isinstance(x, dict):
            yield at, None, json.dumps(x, ensure_ascii=False), {}, None
        elif isinstance(x, str) and (several or kind == "jsonl"):
            yield at, x, None, {}, None


def framed(rows: Iterable[tuple]) -> Iterator[pd.DataFrame]:
    """Tuples of RECORD's columns in frames of at most 1000 rows."""
    it = iter(rows)
    while batch := list(itertools.islice(it, 1000)):
        yield pd.DataFrame(batch, columns=[c.split()[0] for c in RECORD.split(", ")])


def lines_within(data: bytes) -> list[bytes]:
    """The lines that decode() would see in what stands before a line feed."""
    return data.removesuffix(b"\r").split(b"\r")


def read_lined(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """RECORD of JSONL, CSV and TSV files (path, kind) of any size, by the rules of records(), all in one plan. JSONL is
    read in splits: a first pass counts lines and tries the encodings. Quotes of a table may span lines, so that one task
    reads each file of the others, as a stream."""
    out = spark.createDataFrame([], RECORD)
    for jsonl in (True, False):
        own = [x for x in files if (x[1] == "jsonl") == jsonl]
        if own:
            out = out.unionByName((read_jsonl if jsonl else read_tables)(spark, own))
    return out


def lines_of(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """of (the number of the file in the list), start of the split, and data of each line."""
    rows = spark.read.option("lineSep", "\n").text([plain(p) for p, _ in files])
    rows = rows.select(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("data"))
    names = spark.createDataFrame([(k, local(p)) for k, (p, _) in enumerate(files)], "of int, path string")
    return rows.withColumn("path", F.regexp_replace("path", r"^file:/+", "/")).join(F.broadcast(names), "path").select("of", "start", "data")


def plain(path: str) -> str:
    """path without a meaning as a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def local(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def read_jsonl(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    lines = lines_of(spark, files)

    def survey(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count: dict[tuple[int, int], list] = {}
        for pdf in it:
            for of, start, data in zip(pdf["of"].tolist(), pdf["start"].tolist(), pdf["data"], strict=True):
                x = count.setdefault((of, start), [0, *[True] * len(ENCODINGS)])
                x[0] += len(lines_within(bytes(data)))
                for k, name in enumerate(ENCODINGS):
                    if x[k + 1]:
                        try:
                            bytes(data).decode(name)
                        except UnicodeDecodeError:
                            x[k + 1] = False
        yield pd.DataFrame([(*s, x[0], x[1:]) for s, x in count.items()], columns=["of", "start", "n", "fits"])

    def parse(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            at: dict[tuple[int, int], int] = {}
            for pdf in it:
                for of, start, data in zip(pdf["of"].tolist(), pdf["start"].tolist(), pdf["data"], strict=True):
                    path, kind = files[of]
                    for x in lines_within(bytes(data)):
                        at[of, start] = at.get((of, start), first[of, start]) + 1
                        text = x.decode(name[of] or "utf-8", "strict" if name[of] else "replace")
                        if text.strip():
                            for line, own, record, meta, error in json_records(text, at[of, start], kind):
                                yield path, kind, line, own, record, json.dumps(meta), error

        yield from framed(rows())

    first, total, fits = {}, [0] * len(files), [[True] * len(ENCODINGS) for _ in files]
    for r in sorted(lines.mapInPandas(survey, "of int, start long, n long, fits array<boolean>").collect()):
        of = r["of"]
        first[of, r["start"]], total[of] = total[of], total[of] + r["n"]
        fits[of] = [a and b for a, b in zip(fits[of], r["fits"], strict=True)]
    name = [next((e for e, ok in zip(ENCODINGS, x, strict=True) if ok), None) for x in fits]
    return lines.mapInPandas(parse, RECORD)


def read_tables(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    def stream(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((of, bytes(x)) for pdf in it for of, x in zip(pdf["of"].tolist(), pdf["data"], strict=True))
        for of, own in itertools.groupby(rows, lambda r: r[0]):
            path, kind = files[of]
            text = ((x + b"\n").decode("utf-8", "replace") for _, x in own)
            whole = (y for x in text for y in io.StringIO(x, newline=""))
            yield from framed((path, kind, line, text, record, json.dumps(meta), error) for line, text, record, meta, error in table_records(whole, kind))

    lines = lines_of(spark, files).withColumn("at", F.monotonically_increasing_id())
    return lines.repartitionById(len(files), F.col("of")).sortWithinPartitions("of", "start", "at").select("of", "data").mapInPandas(stream, RECORD)


def read_documents(spark: SparkSession, path: str, field: str | None = None, size_limit: int = 2**31 - 1) -> DataFrame:
    """doc_id, source_file, file_type, line_number, text, metadata, field_used, error for all supported files.

    JSONL, CSV and TSV files beyond LINED are read line by line, which bounds the memory of a worker. Others beyond
    size_limit, the most that a binary value holds, become a row with an error, since their record may not fit into a
    value either.
    """
    empty = spark.createDataFrame([], RECORD)
    if not exists(spark, path):
        return finish(empty, field)
    bound = min(size_limit, LINED)
    large = [tuple(r) for r in discover(spark, path).where(F.col("supported") & (F.col("size_bytes") > bound)).select("path", "file_type", "size_bytes").collect()]

    def read(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for p, kind, data in zip(pdf["path"], pdf["file_type"], pdf["content"], strict=True):
                yield from framed((p, kind, line, text, record, json.dumps(meta), error) for line, text, record, meta, error in records(bytes(data), kind))

    def whole(most: int, *paths: str) -> DataFrame:  # a plain limit of length reaches the scan, which doesn't open longer files
        kinds = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
        rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths)).where(F.col("length") <= most)
        rows = rows.select("path", F.try_element_at(kinds, F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))).alias("file_type"), "content")
        return rows.where("file_type is not null").mapInPandas(read, RECORD)

    out, lined = whole(bound, path), ("jsonl", "csv", "tsv")
    if several := [plain(p) for p, k, n in large if k not in lined and n <= size_limit]:
        out = out.unionByName(whole(size_limit, *several))
    if by_line := [(p, k) for p, k, _ in large if k in lined]:
        out = out.unionByName(read_lined(spark, by_line))
    if rest := [(p, k, None, None, None, "{}", f"file of {n} bytes is too large to read whole") for p, k, n in large if k not in lined and n > size_limit]:
        out = out.unionByName(spark.createDataFrame(rest, RECORD))
    return finish(out, field)


def finish(rows: DataFrame, field: str | None) -> DataFrame:
    got = text_field(F.col("record"), field)
    rows = rows.withColumn("_f", got)
    text = F.coalesce("text", F.col("_f.text"))
    line = F.coalesce(F.col("line_number").cast("string"), F.lit(""))
    return rows.withColumn("text", text).where("text is not null or error is not null").select(
        F.sha2(F.concat_ws("|", "source_file", line).cast("binary"), 256).alias("doc_id"), "source_file", "file_type", "line_number", "text", "metadata", F.col("_f.field").alias("field_used"), "error",
    )


def file_sha256(path: str) -> str:
    """Digest of a local file, block by block."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
