import json
import random
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill import cli, config, session
from textmill.config import Config
from textmill.operators import dataset, dedup, verify
from textmill.plans import build
from textmill.sources import files
from textmill.sources.files import discover, read_documents
from textmill.streaming import incremental

TR = "Bugün hava çok güzel ve insanlar bu yüzden dışarı çıkıp yeni bir gün için sahilde yürümek istiyor. "


def test_greedy_chain(spark):
    rows = [(1, 0, "x"), (2, 0, "x"), (2, 1, "y"), (3, 1, "y"), (4, 2, "z")]
    lost = dedup.near_losers(spark.createDataFrame(rows, "seq long, band_id int, bucket_hash string"))
    assert [r["seq"] for r in lost.collect()] == [2]


def test_greedy_equals_sequential(spark):
    r = random.Random(3)
    rows = sorted({(s, b, str(r.randint(0, 12))) for s in range(60) for b in range(3)})
    kept, taken = [], set()
    for s in range(60):
        mine = {(b, h) for q, b, h in rows if q == s}
        if not mine & taken:
            kept.append(s)
            taken |= mine
    lost = dedup.near_losers(spark.createDataFrame(rows, "seq long, band_id int, bucket_hash string"))
    assert sorted(x["seq"] for x in lost.collect()) == sorted(set(range(60)) - set(kept))


def test_least_values_are_remainders():
    r = random.Random(5)
    h = np.array([r.randrange(2**32) for _ in range(300)] + [0, 2**32 - 1], np.uint64)
    for top in (2**32 - 1, dedup.PRIME - 1):
        a, b = ([r.randrange(1, top) for _ in range(7)] + [top] for _ in range(2))
        want = [min((x * int(v) + y) % dedup.PRIME for v in h) for x, y in zip(a, b, strict=True)]
        assert dedup.least(h, *(np.array(x, np.uint64)[:, None] for x in (a, b))).tolist() == want


def stored_columns(monkeypatch, *modules):
    seen = []
    for m in modules:
        monkeypatch.setattr(m, "materialized", lambda df, name: (seen.append((name, df.columns)), session.materialized(df, name))[1])
    return seen


def test_texts_are_stored_once(spark, monkeypatch):
    """Texts were written three times and went through two exchanges, and a row for each band with its hash in hex."""
    seen = stored_columns(monkeypatch, build, dedup)
    docs = spark.createDataFrame([(k, TR * (1 + k % 3)) for k in range(9)] + [(9, "short"), (10, "\ufffd" * 60), (11, None)], "seq long, text string")
    got = {r["doc"]: r["fate"] for r in build.cascade(docs).collect()}
    assert [n for n, c in seen if {"raw", "chunk", "text"} & set(c)] == ["chunks"]
    assert not [n for n, c in seen if "bucket_hash" in c]
    assert got[0] == "ACCEPTED" and got[3] == "EXACT_DUPLICATE" and got[1] == "NEAR_DUPLICATE" and got[9] == got[11] == "TOO_SHORT" and got[10] == "UNRECOVERABLE_ENCODING"


def test_batches_store_texts_once(spark, tmp_path, monkeypatch):
    seen = stored_columns(monkeypatch, incremental, dedup)
    for k in range(2):
        rows = spark.createDataFrame([(10 * k + i, f"{TR} {i + k} " + "word " * i) for i in range(5)] + [(10 * k + 7, f"quite another {k} text")], "seq long, text string")
        kept = sorted(r["seq"] for r in incremental.add_batch(rows, str(tmp_path / "state"), k).collect())
        assert kept == ([0, 7] if k == 0 else [17])
    assert [n for n, c in seen if "text" in c] == ["batch"] * 2
    (tmp_path / "state/buckets").mkdir()
    with pytest.raises(ValueError, match="bucket_hash"):
        incremental.add_batch(rows, str(tmp_path / "state"), 2)


def test_stream_takes_each_batch_in_several_files(spark, tmp_path, monkeypatch):
    """One task wrote and read all of a batch."""
    from textmill import file_queries

    files_of, real = [], incremental.stream
    monkeypatch.setattr(incremental, "stream", lambda source, *a: (files_of.append(len(source.sparkSession.read.parquet(a[0].replace("/state", "/in")).inputFiles())), real(source, *a))[1])
    spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("Some text of some length that differs by number "), "id", F.lit(" "), F.md5(F.col("id").cast("string"))).alias("text"), F.lit("x").alias("source")).write.parquet(str(tmp_path / "documents.parquet"))
    kept = file_queries.stream_kept(spark, str(tmp_path)).select("doc_id").collect()
    assert len(files_of) == 3 and files_of[0] > 1
    assert kept and len({r["doc_id"] for r in kept}) == len(kept)


def test_large_files_follow_the_same_rules(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes('{"text": "bir"}\r\n\n"bare string"\nnot json\n[1]\r{"text": "iki"}\n'.encode() * 50)
    (tmp_path / "b.jsonl").write_bytes('{"text": "ğüş"}\n"İ"\n'.encode("windows-1254"))
    (tmp_path / "c.csv").write_text('text,n\n"two\nlines",1\nplain,2\nmore,3,4\n' + "row,5\n" * 3000)
    (tmp_path / "d.tsv").write_text("text\tn\nx y\t1\n")
    for name in ("e.txt", "f.json", "g.pdf", "h.xml"):
        (tmp_path / name).write_text('{"text": "whole"}')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    key = ["source_file", "line_number", "doc_id", "text", "file_type", "metadata", "field_used", "error"]
    get = lambda **kw: sorted((tuple(r) for r in read_documents(spark, str(tmp_path), **kw).select(*key).collect()), key=str)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        whole, large = get(), get(size_limit=0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    lined = lambda rows: [r for r in rows if r[4] in ("jsonl", "csv", "tsv")]
    assert lined(large) == lined(whole) and len(lined(whole)) > 3200
    assert len({r[2] for r in lined(large)}) == len(lined(large))
    rest = [r for r in large if r not in lined(large)]
    assert len(rest) == 4 and all(r[3] is None and "too large" in r[7] for r in rest)


def test_files_over_a_bound_are_read_by_line(spark, tmp_path, monkeypatch):
    """Whole files of records filled a worker's memory; several large ones share one plan, whatever their names."""
    for name, kind in (("a b+c%20[1].csv", ","), ("d{e}.tsv", "\t"), ("f.csv", ",")):
        (tmp_path / name).write_text(f"n{kind}text\n" + "".join(f'{i}{kind}"{name} line\n{i}"\n' for i in range(900)))
    for name in ("g+h.jsonl", "i j.jsonl"):
        (tmp_path / name).write_text("".join(json.dumps({"text": f"{name} {i}"}) + "\n" for i in range(900)))
    get = lambda: read_documents(spark, str(tmp_path)).select("source_file", "line_number", "doc_id", "text", "file_type", "metadata", "field_used", "error")
    whole = sorted(get().collect())
    monkeypatch.setattr(files, "LINED", 5000)
    lined = get()
    assert sorted(lined.collect()) == whole and len(whole) == 4500
    plan = lined._jdf.queryExecution().toString()
    assert plan.count("Union") <= 8 and "FileScan text" in plan
    assert {r["source_file"].rsplit("/", 1)[1] for r in whole} == {p.name for p in tmp_path.iterdir()}


def test_page_files_share_folders(spark, tmp_path):
    """A folder for each page, each listed and renamed by the driver, took more than all else."""
    from textmill import file_queries

    spark.range(1000).select(F.col("id").alias("page_id"), F.concat(F.lit("<p>é"), "id").alias("html")).write.parquet(str(tmp_path / "pages.parquet"))
    at = Path(file_queries._pages(spark, str(tmp_path)))
    assert len(list(at.iterdir())) <= 256
    found = [p for p in at.rglob("*") if p.is_file()]
    assert sorted(int(p.name.split("=")[1].split(".")[0]) for p in found) == list(range(1000))
    assert all(p.read_text(encoding="utf-8") == f"<p>é{p.name.split('=')[1].split('.')[0]}\n" for p in found)


def test_chunks():
    assert dataset.chunked("", 10) == [] and dataset.chunked("abc", 10) == ["abc"]
    text = "aaa. bbb. ccc.\n\ndddd\n\n" + "e" * 30
    assert dataset.chunked(text, 12) == ["aaa. bbb.", "ccc.", "dddd", "e" * 30]


def test_files_to_dataset(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text(TR * 3, encoding="utf-8")
    (src / "b.txt").write_text("  " + TR * 3 + "\n", encoding="utf-8")
    (src / "c.jsonl").write_text(json.dumps({"text": TR.replace("sahilde", "parkta") * 3}) + "\nbroken\n" + json.dumps({"text": "a" * 30}) + "\n", encoding="utf-8")
    (src / "d.txt").write_bytes("şimdi".encode("windows-1254"))
    (src / "e.bin").write_bytes(b"x")
    (src / "f.txt").write_text("Nothing here belongs to that language, these words remain foreign throughout.", encoding="utf-8")
    files = discover(spark, str(src))
    assert files.count() == 6 and files.where("not supported").count() == 1
    assert discover(spark, str(src / "none")).count() == 0
    docs = read_documents(spark, str(src))
    assert docs.where("error is not null").count() == 1
    docs = docs.where("error is null").withColumn("seq", F.struct("source_file", F.coalesce("line_number", F.lit(0)).alias("line_number")))
    out = tmp_path / "out"
    first = build.run_build(spark, docs, str(out), Config(), 6)
    assert first["status"] == "BUILD SUCCESSFUL" and first["processed_documents"] == 6
    assert first["exact_duplicates"] == 1 and first["near_duplicates"] == 1 and first["too_short"] == 2 and first["non_turkish"] == 1
    assert first["accepted_documents"] == 1
    lines = [json.loads(x) for p in out.glob("*/*-0*.jsonl") for x in p.read_text(encoding="utf-8").splitlines()]
    assert [x["text"] for x in lines] == [TR.strip() + " " + TR.strip() + " " + TR.strip()]
    assert build.run_build(spark, docs, str(out), Config(), 6) == first


def test_shards_hold_each_row_once_in_order(spark, tmp_path):
    """Bounds of ranges are sampled, and a second evaluation samples others: rows got lost or went to another shard."""
    rows = spark.range(30_000).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "train").when(F.col("id") % 3 == 1, "validation").otherwise("test").alias("split"), F.concat(F.lit("text "), "id").alias("chunk"))
    rows = rows.repartition(8, F.xxhash64("seq"))
    for name, cfg in (("docs", config.Dataset(shard_max_documents=70, shard_max_bytes=0)), ("bytes", config.Dataset(shard_max_documents=0, shard_max_bytes=2000)), ("none", config.Dataset(shard_max_documents=0, shard_max_bytes=0))):
        build.write_shards(rows, str(tmp_path / name), Config(dataset=cfg))
        for k, split in enumerate(("train", "validation", "test")):
            files = [p.read_text().splitlines() for p in sorted((tmp_path / name / split).iterdir())]
            assert [json.loads(x)["text"] for f in files for x in f] == [f"text {i}" for i in range(k, 30_000, 3)], (name, split)
            sizes = [sum(len(x) + 1 for x in f) for f in files]
            assert name != "docs" or [len(f) for f in files] == [70] * 142 + [60]
            assert name != "bytes" or all(s < 2000 <= s + len(f[0]) + 1 for s, f in zip(sizes, files[1:]))
            assert name != "none" or len(files) == 1


def test_shared_folder_without_setting():
    def fake(master):
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master, applicationId="app"))

    assert session.shared_dir(fake("local[2]")) == session.shared_dir(fake("local"))
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError):
            session.shared_dir(fake(master))


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.txt").write_text(TR * 3, encoding="utf-8")
    (src / "b.csv").write_text("text,n\n" + "Yeni bir dünya için daha büyük bir zaman gerekiyor ama herkes kendi yerinde bekliyor" + ",1\n", encoding="utf-8")
    (src / "c.xml").write_text("<a>short</a>")
    (src / "d.pdf").write_bytes(b"not a pdf")
    (src / "e.exe").write_bytes(b"x")
    monkeypatch.chdir(tmp_path)
    assert cli.main(["--input", str(src), "--analyze"]) == 0
    said = capsys.readouterr().out
    assert ".exe skipped 1 1" in said and "txt read 1" in said and "tr" in said
    assert cli.main(["--input", str(src), "--output", str(out)]) == 0
    assert "status: BUILD SUCCESSFUL" in capsys.readouterr().out
    assert json.loads((out / "reports/quality_report.json").read_text())["accepted_documents"] == 2
    assert "train-00000.jsonl" in (out / "manifest/SHA256SUMS").read_text() and (out / "README_DATASET.md").exists()
    with pytest.raises(SystemExit):
        cli.main(["--input", str(src)])


def test_kinds_of_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("text\tn\nbir iki\t1\n")
    (tmp_path / "b.yaml").write_text("k: v\r\n")
    (tmp_path / "c.xml").write_text("<a>b</a>")
    (tmp_path / "d.pdf").write_bytes(b"%PDF-broken")
    (tmp_path / "e.json").write_text('[{"body": "x"}, "plain", 3]')
    (tmp_path / "f.HTM").write_text("<p>q</p>")
    (tmp_path / "_g.txt").write_text("hidden")
    got = {(r["source_file"].rsplit("/", 1)[1], r["text"]) for r in read_documents(spark, str(tmp_path)).collect()}
    assert got == {("a.tsv", "bir iki"), ("b.yaml", "k: v\n"), ("c.xml", "<a>b</a>"), ("d.pdf", ""), ("e.json", "x"), ("e.json", "plain"), ("f.HTM", "<p>q</p>")}


def test_settings(tmp_path):
    assert config.load(str(tmp_path / "none.yaml")) == Config()
    (tmp_path / "c.json").write_text('{"dataset": {"seed": 7}}')
    (tmp_path / "bad.json").write_text('{"dataset": {"sead": 7}}')
    assert config.load(str(tmp_path / "c.json")).dataset.seed == 7
    with pytest.raises(Exception, match="sead"):
        config.load(str(tmp_path / "bad.json"))


def test_tables_are_removed(spark):
    a = session.materialized(spark.range(3), "some")
    assert session.materialized(a, "more").count() == 3
    session.forget(a)
    with pytest.raises(Exception, match="some"):
        spark.read.parquet(a.written_to).count()
    session.clean_up(spark)
    b = session.materialized(spark.range(2), "again")
    assert b.count() == 2


def test_violations(spark, tmp_path):
    at = tmp_path / "train"
    at.mkdir()
    (at / "train-00000.jsonl").write_bytes(b'{"text": "a"}\nbroken\n{"text": "\xff"}\n{"text": " "}\n')
    listed = verify.manifest(spark, str(tmp_path))
    found = sorted(r["check"] for r in verify.violations(spark, str(tmp_path), listed).collect())
    assert "json" in found and "empty" in found and "utf8" in found and "sha256" not in found
    wrong = listed.withColumn("sha256", F.lit("0"))
    assert "sha256" in {r["check"] for r in verify.violations(spark, str(tmp_path), wrong).collect()}
