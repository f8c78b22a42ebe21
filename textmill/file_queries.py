"""Queries that go through files: tables are written into the shared folder in the forms that the readers know, or as
shards, and read again; SQL gives the same rows from the tables themselves."""

from __future__ import annotations

import json
import random
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.config import Config, Dataset, Filtering
from textmill.functions import text as T
from textmill.operators import dataset, verify
from textmill.plans import build
from textmill.plans.reports import COPIES, QUALITY, write_reports
from textmill.queries import _CLEANED, _COUNTS, _FATE, _HASH, ORACLES, _fates, _near, _S, _space, _strip, docs, query
from textmill.session import shared_dir, spread
from textmill.sources.files import discover, file_totals, read_documents
from textmill.streaming import incremental


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, without the scheme of local files."""
    return re.sub(r"^file:/+", "/", f"{shared_dir(spark)}/textmill/{name}-{uuid.uuid4().hex}")


def with_ending(spark: SparkSession, path: str, ending) -> str:
    """Gives each part file below path the ending that ending(its folder's name) names; other files go."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found, names = fs.listFiles(fs_path(path), True), []
    while found.hasNext():
        names.append(found.next().getPath().toString())
    for name in names:
        at, file = name.rsplit("/", 1)
        if file.startswith("part-"):
            fs.rename(fs_path(name), fs_path(f"{at}/{file.split('.')[0]}{ending(at.rsplit('/', 1)[1])}"))
        else:
            fs.delete(fs_path(name), False)
    return path


# Readers.

_LINES = f"FROM documents WHERE {_strip('text')} <> ''"


def _records(kind: str, read_limit: int | None = None):
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows, at = docs(spark, d).select("text", "lang", "doc_id"), folder(spark, kind)
        if kind == "jsonl":
            rows.write.json(at)
        else:
            rows.write.csv(at, sep="\t" if kind == "tsv" else ",", header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        got = read_documents(spark, with_ending(spark, at, lambda _: f".{kind}"), **({} if read_limit is None else {"size_limit": read_limit}))
        return got.select("file_type", "field_used", "text", F.col("error").isNull().alias("ok"))

    return run


for _kind, _limit in (("jsonl", None), ("csv", None), ("tsv", None), ("jsonl", 0), ("csv", 0)):
    _name = f"files_{_kind}" + ("_large" if _limit == 0 else "")
    _f = _records(_kind, _limit)
    _f.__name__ = _name
    query(_f)
    ORACLES[_name] = f"SELECT '{_kind}' AS file_type, 'text' AS field_used, text, true AS ok {_LINES}"


@query
def files_json(spark, d):
    """A JSON file that holds a list: a row per member, numbered."""
    rows, at = spark.read.parquet(f"{d}/benchmark.parquet"), folder(spark, "json")
    whole = rows.agg(F.to_json(F.array_sort(F.collect_list(F.struct("item_id", F.col("text").alias("body"))))).alias("value"))
    whole.write.text(at)
    got = read_documents(spark, with_ending(spark, at, lambda _: ".json"))
    return got.select("file_type", "line_number", "field_used", "text")


ORACLES["files_json"] = f"SELECT 'json' AS file_type, CAST(n AS INT) AS line_number, 'body' AS field_used, text FROM (SELECT text, row_number() OVER (ORDER BY item_id) AS n FROM benchmark) WHERE {_strip('text')} <> ''"

#: Endings of whole files by page_id, with the type of each.
_ENDINGS = [(".html", "html"), (".md", "markdown"), (".txt", "txt"), (".xml", "xml"), (".yml", "yaml"), (".HTM", "html"), (".bin", None)]
_TYPE = f"(['{"', '".join(k or e for e, k in _ENDINGS)}'])[page_id % {len(_ENDINGS)} + 1]"
_PAGE = "replace(replace(html, chr(13) || chr(10), chr(10)), chr(13), chr(10)) || chr(10)"


def _pages(spark: SparkSession, d: str) -> str:
    """A file for each page, written by the executors, in 256 folders at most: a listing of one folder for each page
    and renames by the driver took most of the time."""
    at = folder(spark, "pages")

    def write(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        for pdf in it:
            for page_id, page in zip(pdf["page_id"].tolist(), pdf["html"], strict=True):
                os.makedirs(own := f"{at}/{page_id % 256}", exist_ok=True)
                name = f"page_id={page_id}{_ENDINGS[page_id % len(_ENDINGS)][0]}"
                with open(tmp := f"{own}/.{name}.{uuid.uuid4().hex}", "wb") as f:
                    f.write(bytes(page) + b"\n")
                os.replace(tmp, f"{own}/{name}")
            yield pdf[["page_id"]]

    pages = spread(spark.read.parquet(f"{d}/pages.parquet")).select(F.col("page_id").cast("long"), T.text_of(F.col("html")).cast("binary").alias("html"))
    pages.mapInPandas(write, "page_id long").count()
    return at


def _page_id(c: str) -> Column:
    return F.regexp_extract(c, r"page_id=(\d+)", 1).cast("long").alias("page_id")


@query
def files_whole(spark, d):
    return read_documents(spark, _pages(spark, d)).select(_page_id("source_file"), "file_type", "text", F.get_json_object("metadata", "$.encoding_used").alias("encoding"))


ORACLES["files_whole"] = f"SELECT page_id, {_TYPE} AS file_type, {_PAGE} AS text, 'utf-8' AS encoding FROM pages WHERE {_TYPE} <> '.bin'"


@query
def files_discovered(spark, d):
    return discover(spark, _pages(spark, d)).select(_page_id("path"), "file_type", "size_bytes", "supported", "skip_reason")


ORACLES["files_discovered"] = f"SELECT page_id, {_TYPE} AS file_type, CAST(strlen(html) + 1 AS BIGINT) AS size_bytes, {_TYPE} <> '.bin' AS supported, CASE WHEN {_TYPE} = '.bin' THEN 'unsupported extension: .bin' END AS skip_reason FROM pages"


@query
def analyze_totals(spark, d):
    return file_totals(discover(spark, _pages(spark, d)))


ORACLES["analyze_totals"] = f"SELECT {_TYPE} AS file_type, {_TYPE} <> '.bin' AS supported, count(*) AS files, CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM pages GROUP BY ALL"


@query
def files_unprocessed(spark, d):
    found = discover(spark, _pages(spark, d))
    left = incremental.unprocessed(found, found.where(_page_id("path") % 3 == 0).select("path"))
    return left.select(_page_id("path"), "file_type")


ORACLES["files_unprocessed"] = f"SELECT page_id, {_TYPE} AS file_type FROM pages WHERE page_id % 3 <> 0"

# Chunks.


def _chunks(table: str, most: int, longer_than: int) -> str:
    """Chunks of table d(doc_id, text) whose texts are over longer_than; a part starts a chunk where it doesn't fit."""
    return f"""WITH RECURSIVE d AS ({table}),
p AS (SELECT doc_id, i, ps[i] AS para FROM (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS ps FROM d WHERE length(text) > {longer_than}), unnest(range(1, len(ps) + 1)) AS r(i)),
n AS (SELECT *, length(para) > {most} AS long, count(*) FILTER (WHERE length(para) > {most}) OVER (PARTITION BY doc_id ORDER BY i) AS l FROM p),
s AS (SELECT doc_id, i, 0 AS j, 2 * l AS run, 2 AS joint, para AS part FROM n WHERE NOT long UNION ALL
  SELECT doc_id, i, j, 2 * l - 1, 1, ps[j] FROM (SELECT *, string_split(regexp_replace(para, '([.!?]){_S}+', '\\1' || chr(1), 'g'), chr(1)) AS ps FROM n WHERE long), unnest(range(1, len(ps) + 1)) AS r(j)),
k AS (SELECT *, row_number() OVER w AS k, lag(run) OVER w IS DISTINCT FROM run AS fresh FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY i, j)),
steps AS (SELECT doc_id, k, 1 AS c, CASE WHEN length(part) + joint <= {most} THEN length(part) + joint ELSE length(part) END AS used FROM k WHERE k = 1 UNION ALL
  SELECT k.doc_id, k.k, CASE WHEN NOT fresh AND used + length(part) + joint <= {most} THEN c ELSE c + 1 END,
         CASE WHEN NOT fresh AND used + length(part) + joint <= {most} THEN used + length(part) + joint WHEN fresh AND length(part) + joint <= {most} THEN length(part) + joint ELSE length(part) END
  FROM steps s JOIN k ON k.doc_id = s.doc_id AND k.k = s.k + 1),
out AS (SELECT doc_id, CAST(c - 1 AS INT) AS part, CASE k.joint WHEN 2 THEN string_agg(k.part, chr(10) || chr(10) ORDER BY k.k) ELSE string_agg(k.part, ' ' ORDER BY k.k) END AS chunk FROM steps JOIN k USING (doc_id, k) GROUP BY doc_id, c, k.joint
  UNION ALL SELECT doc_id, 0, text FROM d WHERE length(text) <= {longer_than})
SELECT doc_id, part, chunk FROM out"""


_BROKEN = "SELECT doc_id, replace(coalesce(text, ''), '. ', '.' || chr(10) || chr(10)) AS text FROM documents"


@query
def chunks_paragraphs(spark, d):
    """Texts with paragraph ends at every other kind of full stop, so that both paragraphs and sentences are packed."""
    t = F.replace(T.text_of(F.col("text")), F.lit(". "), F.lit(".\n\n"))
    return docs(spark, d).select("doc_id", F.posexplode(dataset.chunk_column(t, 300)).alias("part", "chunk"))


ORACLES["chunks"] = _chunks("SELECT doc_id, coalesce(text, '') AS text FROM documents WHERE text <> ''", 4000, 4000)
ORACLES["chunks_paragraphs"] = _chunks(f"SELECT * FROM ({_BROKEN}) WHERE text <> ''", 300, 300)


@query
def chunk_trigger(spark, d):
    """Only texts over max_character_length are cut."""
    cut = dataset.chunks(F.col("text"), Filtering(max_character_length=9000, chunk_max_characters=2000, chunk_long_documents=True))
    return docs(spark, d).select("doc_id", F.posexplode(cut).alias("part", "chunk"))


ORACLES["chunk_trigger"] = _chunks("SELECT doc_id, coalesce(text, '') AS text FROM documents", 2000, 9000)

# Other pieces of the tables.

_INNER = "nfc_normalize(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]', '', 'g'))"
_tags = "text"
for _t in T.BLOCK_TAGS.split("|"):
    _tags = f"regexp_replace({_tags}, '(?is)<{_t}[^>]*>.*?</{_t}>', ' ', 'g')"
_tags = f"regexp_replace(regexp_replace({_tags}, '(?i)<({T.LINE_TAGS})\\b[^>]*>', chr(10), 'g'), '<[^>]+>', ' ', 'g')"
for _e, _c in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
    _tags = f"replace({_tags}, '&{_e};', '{_c}')"
ORACLES["clean_page"] = f"WITH c AS (SELECT page_id, {_INNER} AS text FROM (SELECT page_id, coalesce(html, '') AS text FROM pages)), m AS (SELECT page_id, {_tags} AS text FROM c) SELECT page_id, {_space('text')} AS out FROM m"
ORACLES["json_text_field_events"] = "SELECT CAST(NULL AS VARCHAR) AS field, count(*) AS n FROM events"


@query
def token_hook(spark, d):
    """Counts with another token counter in place of the estimate."""
    return dataset.counts(docs(spark, d), "source", tokens=lambda t: F.length(T.text_of(t)) - F.length(F.replace(T.text_of(t), F.lit("e"), F.lit(""))))


ORACLES["token_hook"] = f"SELECT source, {_COUNTS.rsplit(', CAST(', 1)[0]}, CAST(sum(length(text) - length(replace(text, 'e', ''))) AS BIGINT) AS estimated_token_count FROM documents GROUP BY source"


@query
def sequence_split(spark, d):
    """One draw for each row in order."""
    return dataset.sequence_split(docs(spark, d).select(F.col("doc_id").alias("seq"))).select(F.col("seq").alias("doc_id"), "split")


def _draws(n: int = 2000) -> str:
    r = random.Random(Dataset().seed)
    return ", ".join(f"({k + 1}, {r.random()!r}::DOUBLE)" for k in range(n))


ORACLES["sequence_split"] = f"SELECT doc_id, CASE WHEN u < 0.98 THEN 'train' WHEN u < 0.99 THEN 'validation' ELSE 'test' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k FROM documents) LEFT JOIN (VALUES {_draws()}) AS r(k, u) USING (k)"

# Shards, manifest and verification.

_PART = "CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'validation' ELSE 'test' END"


def _shards(spark: SparkSession, d: str, cfg: Dataset) -> str:
    at = folder(spark, "shards")
    rows = docs(spark, d).select(F.expr(_PART).alias("split"), F.col("doc_id").alias("seq"), T.text_of(F.col("text")).alias("chunk"))
    build.write_shards(rows, at, Config(dataset=cfg))
    return at


_LISTED = "filepath", "document_count", "character_count", "word_count", "estimated_token_count", "size_bytes"
_LINE = "SELECT doc_id, coalesce(text, '') AS text, {} AS split, strlen(CAST(to_json({{'text': coalesce(text, '')}}) AS VARCHAR)) + 1 AS size, row_number() OVER (PARTITION BY {} ORDER BY doc_id) AS k FROM documents".format(_PART, _PART)
_FILE = "split || '/' || split || '-' || lpad(CAST({} AS VARCHAR), 5, '0') || '.jsonl'"


@query
def shard_files(spark, d):
    """The manifest of shards by number of documents."""
    return verify.manifest(spark, _shards(spark, d, Dataset(shard_max_documents=70, shard_max_bytes=0))).select(*_LISTED)


ORACLES["shard_files"] = f"SELECT {_FILE.format('(k - 1) // 70')} AS filepath, {_COUNTS}, CAST(sum(size) AS BIGINT) AS size_bytes FROM ({_LINE}) GROUP BY 1"


@query
def shard_files_bytes(spark, d):
    """The manifest of shards by bytes: a line that would reach the limit starts a file."""
    return verify.manifest(spark, _shards(spark, d, Dataset(shard_max_documents=0, shard_max_bytes=50_000))).select(*_LISTED)


ORACLES["shard_files_bytes"] = f"""WITH RECURSIVE l AS ({_LINE}),
steps AS (SELECT split, k, 0 AS part, size AS used FROM l WHERE k = 1 UNION ALL
  SELECT l.split, l.k, CASE WHEN used + size >= 50000 THEN part + 1 ELSE part END, CASE WHEN used + size >= 50000 THEN size ELSE used + size END FROM steps s JOIN l ON l.split = s.split AND l.k = s.k + 1)
SELECT {_FILE.format('part')} AS filepath, {_COUNTS}, CAST(sum(size) AS BIGINT) AS size_bytes FROM steps JOIN l USING (split, k) GROUP BY 1"""


@query
def shard_digests(spark, d):
    """Digests of the files, against those of their lines."""
    return verify.manifest(spark, _shards(spark, d, Dataset(shard_max_documents=70, shard_max_bytes=0))).select("filepath", "sha256")


ORACLES["shard_digests"] = f"SELECT {_FILE.format('(k - 1) // 70')} AS filepath, sha256(string_agg(CAST(to_json({{'text': text}}) AS VARCHAR) || chr(10), '' ORDER BY k)) AS sha256 FROM ({_LINE}) GROUP BY 1"


@query
def verify_violations(spark, d):
    """What verification finds in shards with blank texts, texts shared by splits, and a manifest with one wrong digest."""
    at = folder(spark, "shards")
    text = F.when(F.col("doc_id") % 50 == 7, " \t").otherwise(T.text_of(F.col("text")))
    part = F.when(F.col("doc_id") % 3 == 0, "train").when(F.col("doc_id") % 3 == 1, "validation").otherwise("test")
    build.write_shards(docs(spark, d).select(part.alias("split"), F.col("doc_id").alias("seq"), text.alias("chunk")), at, Config(dataset=Dataset(shard_max_documents=0, shard_max_bytes=0)))
    listed = verify.manifest(spark, at).withColumn("sha256", F.when(F.col("filepath").startswith("test/"), "0").otherwise(F.col("sha256")))
    return verify.violations(spark, at, listed).select("check", "file", F.when(F.col("check") == "leak", F.col("detail")).alias("detail"))


_THIRD = "CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END"
ORACLES["verify_violations"] = f"""WITH t AS (SELECT {_THIRD} AS split, CASE WHEN doc_id % 50 = 7 THEN ' ' || chr(9) ELSE coalesce(text, '') END AS text FROM documents),
h AS (SELECT DISTINCT split, sha256({_strip('text')}) AS h FROM t)
SELECT 'sha256' AS "check", 'test/test-00000.jsonl' AS file, CAST(NULL AS VARCHAR) AS detail UNION ALL
SELECT 'empty', split || '/' || split || '-00000.jsonl', NULL FROM t WHERE {_strip('text')} = '' UNION ALL
SELECT 'leak', a.split || '/' || b.split, CAST(count(*) AS VARCHAR) FROM h a JOIN h b ON a.h = b.h AND a.split < b.split GROUP BY ALL"""


@query
def report_files(spark, d):
    """The JSON reports of a build, read back."""
    at = folder(spark, "reports")
    write_reports(at, build.stats(_fates(spark, d)))
    rows = []
    for name in ("quality_report", "duplicate_report"):
        text = spark.read.text(f"{at}/reports/{name}.json", wholetext=True).first()["value"]
        rows += [(name, k, int(v)) for k, v in json.loads(text).items()]
    return spark.createDataFrame(rows, "report string, counter string, n long")


_FATES_OF = {"accepted_documents": "fate = 'ACCEPTED'", "rejected_documents": "fate <> 'ACCEPTED'", "too_short": "fate = 'TOO_SHORT'", "non_turkish": "fate = 'NON_TURKISH'", "exact_duplicates": "fate = 'EXACT_DUPLICATE'", "near_duplicates": "fate = 'NEAR_DUPLICATE'"}
_FATES_OF["spam"] = "fate NOT IN ('ACCEPTED', 'TOO_SHORT', 'NON_TURKISH', 'EXACT_DUPLICATE', 'NEAR_DUPLICATE', 'LOW_QUALITY_SCORE')"
ORACLES["report_files"] = f"{_FATE} " + " UNION ALL ".join(f"SELECT '{r}' AS report, '{k}' AS counter, count(*) FILTER (WHERE {_FATES_OF[k]}) AS n FROM fates" for r, keys in (("quality_report", QUALITY), ("duplicate_report", COPIES)) for k in keys)

# Incremental and streaming builds: documents come in three batches.


def _batch(spark: SparkSession, d: str, k: int) -> DataFrame:
    return docs(spark, d).where((F.length("text") >= 50) & (F.col("doc_id") % 3 == k)).select(F.col("doc_id").alias("seq"), "text")


@query
def incremental_kept(spark, d):
    state, out = folder(spark, "state"), None
    for k in range(3):
        kept = incremental.add_batch(_batch(spark, d, k), state, k)
        out = kept if out is None else out.unionByName(kept)
    return out.select(F.col("seq").alias("doc_id"), "norm_hash")


@query
def stream_kept(spark, d):
    """The stream runs once for each batch that has come, and takes its files as one micro-batch."""
    at = folder(spark, "stream")
    for k in range(3):
        _batch(spark, d, k).write.mode("append").parquet(f"{at}/in")
        source = spark.readStream.schema("seq long, text string").parquet(f"{at}/in")
        incremental.stream(source, f"{at}/state", f"{at}/out", f"{at}/offsets").awaitTermination()
    return spark.read.parquet(f"{at}/out").select(F.col("seq").alias("doc_id"), "norm_hash")


_TURN = "doc_id % 3 * 1000000000 + doc_id"
_KEPT = f"""{_near(f"SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY {_HASH} ORDER BY doc_id) AS rn FROM (SELECT {_TURN} AS doc_id, text FROM documents WHERE length(text) >= 50)) WHERE rn = 1")}
SELECT doc_id % 1000000000 AS doc_id, {_HASH} AS norm_hash FROM d WHERE doc_id NOT IN (SELECT doc_id FROM lost)"""
ORACLES["incremental_kept"] = ORACLES["stream_kept"] = _KEPT
