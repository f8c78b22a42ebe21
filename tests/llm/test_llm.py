"""Small fixtures against brute force, and the cases of nulls, empty tables, repeated rows and clashing names."""

import hashlib
import random
import re
import struct
import time
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textmill.llm import chat, contamination, langid, lm, packing, quality, simhash, suffixdedup, suffixes, tiff, tokencount, tokens, util

SF = "/root/testdata/sf0.001"
ODD = [(None, "a b c d e f g h i"), (5, None), (6, ""), (7, "x " * 30_000), (8, "same text here"), (8, "same text here"), (9, "ÄÖ 日本 🙂 ² end")]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with columns that clash with names used inside."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    return df.withColumns({c: F.lit(1) for c in ("rid", "key", "fp", "tie", "body", "doc", "score", "n", "lang", "h")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


OPERATORS = {
    "contamination": lambda s, d: contamination.contamination(d, s.createDataFrame([("i", "c d e f g h i j k"), (None, "q"), ("z", None)], "item_id string, text string")),
    "counts": lambda s, d: tokencount.edited_counts(tokencount.trees(d)),
    "quality": lambda s, d: quality.score_quality(d, s.createDataFrame([(5, 1), (None, 0), (7, None)], "doc_id long, quality int")),
    "language": lambda s, d: langid.language_report(d.withColumn("lang", F.lit("en"))),
    "tiff": lambda s, d: tiff.digests(tiff.read_pages(tiff.to_media(d))),
    "packing": lambda s, d: packing.pack(d).where("piece = 0").drop("sequence_id", "offset"),
    "suffix": lambda s, d: suffixdedup.without_repeats(d),
    "simhash": lambda s, d: simhash.near_copies(d),
    "lm": lambda s, d: lm.score_corpus(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd, none, name):
    rows = OPERATORS[name](spark, odd).collect()
    assert len(rows) == len(ODD)
    same = [tuple(r) for r in rows if r["doc_id"] == 8]
    assert len(same) == 2 and same[0] == same[1]
    assert OPERATORS[name](spark, none).count() == 0


def test_contamination_edges(spark):
    items = spark.createDataFrame([("i1", "One two"), ("i2", "a b c d e f g h i"), ("i3", "b c d e f g h i")], "item_id string, text string")
    d = spark.createDataFrame([(1, "x a b c d e f g h i y ONE-two"), (2, "a b c d e f g"), (3, "one, one two")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in contamination.contamination(d, items).collect()}
    assert got == {1: (13, 11, 3, True), 2: (7, 0, 0, False), 3: (3, 2, 1, False)}
    blocks = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in contamination.contamination(d, items, block=1).collect()}
    assert blocks == got


def test_words_encoded_together():
    tok, r = tokens.load(tokens.default_path()), random.Random(6)
    words = {" " + "".join(r.choice("ab\u3000c'slré.,!?²\x1c\x85\xa0日本🙂_<|endoftext|>1") for _ in range(r.randint(1, 9))) for _ in range(3000)}
    words = sorted(w for w in words if len(w[1:].encode().split()) == 1)
    assert [np.frombuffer(x, "<u4").tolist() for x in tok.apart(words)] == [tok.ids(w).tolist() for w in words]
    assert tok.apart([]) == []


def test_token_tree_equals_recount():
    tok, r = tokens.load(tokens.default_path()), random.Random(5)
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokens.default_path())
    own.encode_special_tokens = True
    alpha = list("ab c  \n\n\t'sll1 2é.,!?²　 \x1c日本🙂_<|endoftext|>")
    for _ in range(300):
        s = "".join(r.choice(alpha) for _ in range(r.randint(0, 400)))
        assert tok.ids(s).tolist() == own.encode(s, add_special_tokens=False).ids
        tree = tokencount.TokenTree(s, tok)
        if r.random() < 0.7:  # as kept in a row
            tree = tokencount.TokenTree.kept(s, *tree.rows(), tok)
        for _ in range(3):
            a = r.randint(0, len(s))
            b, new = r.randint(a, min(len(s), a + r.choice([0, 3, 200]))), "".join(r.choice(alpha) for _ in range(r.choice([0, 1, 5, 300])))
            s = s[:a] + new + s[b:]
            tree.edit(a, b, new)
            assert tree.text() == s and tree.count == len(tok.ids(s))


def test_quality_and_language_on_held_out_rows(spark, docs):
    sf = "/root/testdata/sf0.1"  # sf0.01 has some 300 labelled rows to learn from, too few
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    r = quality.score_quality(d, labels).join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert r > 0.95
    r = langid.language_report(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert r > 0.97


def test_token_count_query_equals_a_recount(spark, docs):
    more = spark.createDataFrame([(10**6, "call +49 30 1234567 or mail a.b@c.example, then 030/7654321 \u3000 x"), (10**6 + 1, None), (None, "")], "doc_id long, text string")
    d, tok = docs.select("doc_id", "text").union(more), tokens.load(tokens.default_path())
    got = {r["doc_id"]: r for r in tokencount.edited_counts(util.stored(tokencount.trees(d), "trees")).collect()}
    edited = 0
    for r in d.collect():
        text, x = r["text"] or "", got[r["doc_id"]]
        masked = tokencount.PRIVATE.sub("[private]", text)
        assert (x["n_tokens"], x["n_tokens_edited"], x["n_edits"]) == (len(tok.ids(text)), len(tok.ids(masked)), len(tokencount.PRIVATE.findall(text)))
        assert x["n_pieces"] == len(tok.split(text)) and (x["n_reencoded"] > 0) == (x["n_edits"] > 0)
        assert x["n_reencoded"] <= 12 * x["n_edits"] + 40
        edited += x["n_edits"]
    assert edited > 1


def test_quality_scores_equal_plain_sums(spark, docs):
    r = np.random.default_rng(14)
    x = r.standard_normal((400, len(quality.FEATURES)))
    model = quality.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] + r.standard_normal(400) / 3 > 0).astype(float))
    place = lambda edges, v: sum(e < v for e in edges)
    for row, p in zip(x[:50], quality.predict(model, x[:50]), strict=True):
        s = model["base"] + sum(t[place(e, v)] for v, e, t in zip(row, model["edges"], model["tables"], strict=True))
        s += sum(t[place(a, row[i]), place(b, row[j])] for i, j, a, b, t in model["pairs"])
        assert p == pytest.approx(1 / (1 + np.exp(-s)))
    assert {2, 1} in [{i, j} for i, j, *_ in model["pairs"]]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    rows = sorted((i, y, quality.features(t.encode())) for i, t in ((r["doc_id"], r["text"]) for r in docs.collect()) if (y := known.get(i)) is not None)
    again = quality.fit(np.array([r[2] for r in rows]), np.array([r[1] == 1 for r in rows], float))
    for r in docs.limit(60).collect():
        p = quality.predict(again, np.array([quality.features(r["text"].encode())]))[0]
        x = got[r["doc_id"]]
        assert x["score"] == pytest.approx(p) and x["predicted"] == (p >= 0.7) and x["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_language_scores_equal_plain_sums(spark, docs):
    learn = docs.where(util.fold(F.col("doc_id"), 4) != 2)
    model = langid.train(learn.select("text", "lang"))
    rows = learn.collect()
    total = {lang: np.zeros(1 << langid.BITS) for lang in model["langs"]}
    for r in rows:
        for g in langid.grams(r["text"]):
            np.add.at(total[r["lang"]], g, 1)
    texts = [r["text"] for r in docs.limit(20).collect()] + ["", "ß", "x" * 3000]
    got = langid.products(model, texts)
    for j, lang in enumerate(model["langs"]):
        logp = np.log((total[lang] + 0.5) / (total[lang].sum() + 0.5 * len(total[lang])))
        prior = np.log(sum(r["lang"] == lang for r in rows) / len(rows))
        want = [prior + sum(logp[g].sum() for g in langid.grams(t)) for t in texts]
        assert got[:, j] == pytest.approx(want, rel=1e-5)
    same = spark.createDataFrame([(1, "ab ab", "b"), (3, "ab ab", "a"), (4, "", "c"), (8, "12 34", "a")], "doc_id long, text string, lang string")
    pred = {r["doc_id"]: r["lang_pred"] for r in langid.identify(same, langid.train(same.where("doc_id < 4"))).collect()}
    assert pred == {1: "a", 3: "a", 4: "und", 8: "und"}  # ties go to the first


def test_packing(spark, docs):
    rows = packing.pack(docs).collect()
    by, tok = {}, tokens.load(tokens.default_path())
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= 1024
    for r in docs.limit(30).collect():
        ids = np.append(tok.ids(r["text"]), 2).astype("<u4")
        mine = sorted((x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in rows if x["doc_id"] == r["doc_id"])
        assert sum(m[2] for m in mine) == len(ids) and all(m[2] == 1024 for m in mine[1:])
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for _, s, n, c in mine)
    assert len(by) <= 1.05 * -(-sum(r["length"] for r in rows) // 1024)


def test_local_search_runs_to_its_end():
    assert len(packing.local_search([[i] for i in range(600)], [256] * 600, 1024)) == 150
    r, room = np.random.default_rng(6), 1024
    sizes = r.integers(200, 401, 4000).tolist()
    first = packing.best_fit(sizes, room)
    bins = packing.local_search(first, sizes, room)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    fill = [sum(sizes[i] for i in b) for b in bins]
    assert max(fill) <= room and len(first) - len(bins) > 0.8 * (len(first) - -(-sum(sizes) // room))
    state, under = packing.Bins(bins, sizes, room), [b for b in range(len(bins)) if fill[b] < room]
    assert len(bins) == -(-sum(sizes) // room) or all(state.best(b, -1) is None for b in under)


def test_tiff_round_trip():
    r = np.random.default_rng(1)
    pages = [r.integers(0, 4, (h, w)).astype(np.uint8) * (h % 3) for h, w in ((1, 1), (70, 33), (300, 576))]
    for kind in (tiff.NONE, tiff.PACKBITS, tiff.LZW, tiff.DEFLATE):
        for tile in (0, 64):
            for predictor in (1, 2):
                for big in (False, True):
                    back = list(tiff.read_tiff(tiff.write_tiff(pages, kind, predictor, 32, tile, big)))
                    assert len(back) == 3 and all((a == b).all() for a, b in zip(back, pages, strict=True))
    noise = r.integers(0, 256, (200, 200)).astype(np.uint8)
    assert (next(tiff.read_tiff(tiff.write_tiff([noise], tiff.LZW))) == noise).all()


def tiff_of(order, tags, data):
    """A page with these tags, and its data from byte 8 on."""
    out = (b"MM\0*" if order == ">" else b"II*\0") + struct.pack(order + "I", 8 + len(data)) + data + struct.pack(order + "H", len(tags))
    for tag, value in sorted(tags.items()):
        out += struct.pack(order + "HHII", tag, 4, 1, value)
    return out + b"\0\0\0\0"


def test_tiff_kinds_of_samples():
    own = {256: 3, 257: 2, 259: 1, 262: 1, 273: 8, 278: 2}
    bits = next(tiff.read_tiff(tiff_of("<", own | {258: 1, 279: 2}, bytes([0b10100000, 0b01000000]))))
    assert bits.tolist() == [[1, 0, 1], [0, 1, 0]]
    four = next(tiff.read_tiff(tiff_of(">", own | {258: 4, 279: 4}, bytes([0x12, 0x30, 0x45, 0x60]))))
    assert four.tolist() == [[1, 2, 3], [4, 5, 6]]
    for order in "<>":
        deep = next(tiff.read_tiff(tiff_of(order, own | {258: 16, 279: 12}, struct.pack(order + "6H", 1, 2, 3, 400, 500, 600))))
        assert deep.tolist() == [[1, 2, 3], [400, 500, 600]]
    colour = next(tiff.read_tiff(tiff_of("<", own | {258: 8, 277: 3, 279: 18, 317: 2}, bytes([1, 2, 3] * 6))))
    assert colour.tolist() == [[[1, 2, 3], [2, 4, 6], [3, 6, 9]]] * 2


def test_tiff_takes_any_bytes():
    own = {256: 3, 257: 2, 258: 8, 259: 1, 273: 8, 278: 2, 279: 6}
    for bad in ({256: 0}, {257: 0}, {278: 0}, {256: 200_000, 257: 2_000_000}, {258: 3}, {259: 99}, {279: 5}, {259: 8}, {259: 5}, {317: 3}, {273: 10**6}, {277: 0}):
        assert [type(x) for x in tiff.read_tiff(tiff_of("<", own | bad, b"abcdef"))] == [str], bad
    whole = tiff.write_tiff([np.arange(600, dtype=np.uint8).reshape(20, 30)] * 2, tiff.LZW)
    r = np.random.default_rng(2)
    for _ in range(600):
        x = bytearray(whole)
        for k in r.integers(0, len(x), r.integers(1, 6)):
            x[k] = r.integers(0, 256)
        assert list(tiff.read_tiff(bytes(x[: r.integers(0, len(x) + 1)])))


def test_tiff_rows(spark):
    two = tiff.write_tiff([np.zeros((2, 2), np.uint8), np.ones((3, 4), np.uint8)])
    rows = spark.createDataFrame([(1, b"no", "x"), (2, None, "y"), (3, two, "z"), (3, two, "z")], "id long, media binary, width string")
    got = [(r["id"], r["page"], r["width"], r["height"], r["error"] is None, r["media"] is None) for r in tiff.read_pages(rows).collect()]
    page = [(3, 0, 2, 2, True, False), (3, 1, 4, 3, True, True)]
    assert sorted(got, key=str) == sorted([(1, 0, None, None, False, False), (2, 0, None, None, False, True), *page, *page], key=str)


def test_media_query_equals_a_recount(spark, docs):
    long_ = spark.createDataFrame([(10**6 + k, ("línea %d " % k) * n) for k, n in enumerate((0, 1, 100, 8000, 40_000))], "doc_id long, text string")
    d = docs.select("doc_id", "text").union(long_).union(spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string"))
    got = {(r["doc_id"], r["n_bytes"]): r for r in tiff.digests(tiff.read_pages(tiff.to_media(d))).collect()}
    rows = d.collect()
    assert len(got) == len(rows) - 1  # two of no text and no id
    for r in rows:
        body = (r["text"] or "").encode()
        lines = max(1, -(-len(body) // 576))
        payload = body + b"\xff" * (lines * 576 - len(body))
        x, image = got[r["doc_id"], len(body)], np.frombuffer(payload, np.uint8).reshape(lines, 576)
        assert (x["payload_bytes"], x["payload_sha256"], x["tail_crc32"]) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        media = tiff.stored_image(image, 128)
        assert (x["media_bytes"], x["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        pages = [image[y : y + 128] for y in range(0, lines, 128)]
        assert x["feature"] == " ".join(f"576,{len(p)},{p.mean():.4f},{p.std():.4f},{len(set(p.ravel().tolist()))}" for p in pages)


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, 0, None, "<|im_end|>"), (None, 0, "user", "own")]
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"], r["rendered"]) for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("h", F.lit(1))).collect()}
    assert got[1] == (2, 2, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n")
    assert set(got) == {1, 4, None} and got[4][2] == "<|im_start|>\n< |im_end|><|im_end|>\n"
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def repeats(rows):
    seen, out = set(), {}
    for i, x in sorted(rows):
        mark = np.zeros(len(x), bool)
        for p in range(len(x) - 99):
            if x[p : p + 100] in seen:
                mark[p : p + 100] = True
            seen.add(x[p : p + 100])
        kept = np.frombuffer(x, np.uint8)[~mark].tobytes()
        out[i] = (len(x), int(mark.sum()), int((np.diff(mark.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_sorted_blocks():
    r = np.random.default_rng(8)
    body = r.integers(97, 99, 400).astype(np.uint8)
    for text in (np.tile(body, 8), r.integers(97, 100, 3000).astype(np.uint8), np.full(700, 97, np.uint8)):
        raw, size = text.tobytes(), len(text)
        padded = np.concatenate([text, np.zeros(2 * suffixes.PERIOD + 100, np.uint8)])
        starts = np.arange(size)
        for block in (50, 333, 10_000):
            got = np.concatenate(list(suffixes.sorted_blocks(padded, size, starts, block=block))).tolist()
            assert got == sorted(range(size), key=lambda i: raw[i:] + b"\0" * 200)


def test_equal_texts_and_groups_of_windows():
    r = np.random.default_rng(9)
    texts = [bytes(r.integers(0, 3, n).astype(np.uint8)) for n in r.integers(0, 5, 300)] + [b"a" * n for n in (31, 32, 33, 64, 64, 31)] + [b"a" * 31 + b"\0", b"a" * 170, b"a" * 169 + b"b", b"a" * 170]
    same = suffixdedup.classes(texts).tolist()
    assert all((texts[i] == texts[j]) == (same[i] == same[j]) for i in range(len(texts)) for j in range(i))
    for lo, hi, anchor in ((3, 70, 71), (5, 5, 40), (10, 33, 33)):
        got = list(suffixdedup.grouped(anchor, lo, hi))
        assert sorted(w for _, (a, z) in got for w in range(a, z + 1)) == list(range(lo, hi + 1))
        assert all(w <= g and g + suffixdedup.WIDTH - suffixdedup.STEP + 1 <= w + suffixdedup.WIDTH for g, (a, z) in got for w in range(a, z + 1))


@pytest.mark.parametrize("hot", [256, 4])
def test_repeats(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    d = docs.select("doc_id", "text")
    extra = spark.createDataFrame([(1000 + k, ("ab " * 90 + f"{k} passage ") * 2 + "a common passage of well over one hundred bytes that stands in many of the documents here, at their end " * (k % 3)) for k in range(40)], "doc_id long, text string")
    d = d.union(extra)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixdedup.without_repeats(d).collect()}
    assert got == repeats([(r["doc_id"], r["text"].encode()) for r in d.collect()])


def test_exchanges_of_stored_tables_leave_the_disk(spark):
    files = lambda: {x for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if x.endswith(".data")}
    before = files()
    kept = util.stored(spark.range(5000).withColumn("x", F.sha2(F.col("id").cast("string"), 256)).repartition(7, "x"), "dealt")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"  # as before
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert kept.count() == 5000


def test_contexts_of_many_buckets_go_out_in_large_parts(spark):
    """The exchange of contexts, with small batches and many buckets, as large tables have."""
    rows = suffixdedup.keyed(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    at = suffixdedup.repeated_anchors(rows).where("pos is not null").groupBy("doc", "tie").agg(F.collect_list("pos").alias("at"))
    rows = util.stored(rows.join(at, ["doc", "tie"]).coalesce(1), "rows")
    try:
        for key in before:
            spark.conf.set(key, "50")
        tracker, group = spark.sparkContext.statusTracker(), "contexts"
        spark.sparkContext.setJobGroup(group, group)
        suffixdedup.repeats(rows, np.zeros(0, np.uint64)).write.format("noop").mode("overwrite").save()
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for key, x in before.items():
            spark.conf.set(key, x)
    store = spark.sparkContext._jsc.sc().statusStore()
    n = sum(store.lastStageAttempt(s).shuffleWriteRecords() for s in stages)
    assert 0 < n < 200  # of 20 batches and 50 buckets; a row for each bucket, and one of repeats for each batch


def test_simhash(spark, docs):
    import xxhash

    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_copies(docs).collect()}
    f = {}
    for r in docs.collect():
        w = re.findall("[^\x20\x09-\x0d]+", r["text"].translate({65 + k: 97 + k for k in range(26)}))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]), seed=42) for k in range(max(1, len(w) - 2))] if w else []
        f[r["doc_id"]] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {i: i for i in f}
    changed = True
    while changed:
        changed = False
        for a in f:
            for b in f:
                if (f[a] ^ f[b]).bit_count() <= 3 and root[b] < root[a]:
                    root[a], changed = root[b], True
    assert got == {i: (f"{f[i]:016x}", root[i]) for i in f}


def test_one_of_each_keeps_a_row_of_every_component(spark):
    texts = [" ".join(f"{t}{k}" for k in range(40)) for t in "abcdefg"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (6, texts[3]), (None, texts[4]), (7, texts[4]), (8, None), (8, ""), (9, texts[5]), (9, texts[5])]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1))).collect()
    assert all(r["n"] == 1 for r in got)
    want = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (7, texts[4]), (8, ""), (9, texts[5])]
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in got) == sorted((str(i), x) for i, x in want)


def test_a_large_group_of_near_copies_has_few_links(spark):
    r = np.random.default_rng(4)
    base, other = (r.integers(0, 2**63, simhash.WIDE).astype(np.uint64) for _ in range(2))
    bits = lambda n: np.bitwise_or.reduce([np.eye(simhash.WIDE, dtype=np.uint64)[k % 3] << np.uint64(k // 3) for k in r.choice(192, n, replace=False).tolist()])
    prints = [base ^ bits(3 + k % 6) for k in range(400)] + [other, other ^ bits(5)]
    got = simhash.wide_links(spark.createDataFrame([(bytearray(x.tobytes()),) for x in prints], "print binary"), 29, 64).distinct().collect()
    assert len(got) < 3 * len(prints)  # a star for each key: over 16 times as many
    number = {x.tobytes(): k for k, x in enumerate(prints)}
    root = list(range(len(prints)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for x in got:
        a, b = sorted((top(number[bytes(x["a"])]), top(number[bytes(x["b"])])))
        root[b] = a
    assert [top(k) for k in range(len(prints))] == [0] * 400 + [400] * 2


def test_stars_keep_components():
    r = np.random.default_rng(5)
    for n, m in ((1, 0), (50, 20), (200, 150), (300, 900)):
        a, b = r.integers(0, n, m), r.integers(0, n, m)
        prints = r.integers(0, 2**63, (n, simhash.WIDE)).astype(np.uint64)
        def parts(pairs):
            root = np.arange(n)
            for _ in range(n):
                for i, j in pairs:
                    root[[i, j]] = min(root[i], root[j])
            return root.tolist()
        x, y = simhash.as_stars(a, b, prints)
        assert parts(list(zip(a, b, strict=True))) == parts(list(zip(x, y, strict=True)))
        assert len(set(y.tolist())) == len(y) == n - len(set(parts(list(zip(a, b, strict=True)))))
    path = np.arange(5000)
    assert len(simhash.as_stars(path[:-1], path[1:], r.permutation(5000).astype(np.uint64)[:, None])[0]) == 4999


def test_golay_keys_meet():
    r = np.random.default_rng(2)
    a = r.integers(0, 2**63, 3000, dtype=np.int64).view(np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for k in r.choice(64, 3, replace=False):
            b[i] ^= np.uint64(1 << int(k))
    of = lambda x: [set() for _ in x]
    ka, kb = of(a), of(b)
    for x, keys in ((a, ka), (b, kb)):
        for i, k in zip(*map(np.ndarray.tolist, simhash.keys(x)), strict=True):
            keys[i].add(k)
    assert all(x & y for x, y in zip(ka, kb, strict=True))


def test_base_scores(spark, docs):
    words = {r["doc_id"]: re.findall("[^\x20\x09-\x0d]+", r["text"].translate({65 + k: 97 + k for k in range(26)})) + [None] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = Counter(w for i, x in words.items() if not held[i] for w in x)
    n, v = sum(c.values()), len(c)
    for r in lm.score_corpus(docs).collect():
        x = words[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(x), sum(c[w] > 0 for w in x), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in x)) and r["score"] < 0


def test_scores_equal_a_forward_pass_token_by_token():
    r = np.random.default_rng(3)
    count = np.where(np.arange(300) % 3 == 0, 0, r.integers(1, 50, 300))
    model = lm.Attention(count, np.arange(300))
    p = model.p = {k: x + r.standard_normal(x.shape).astype(np.float32) * 0.3 for k, x in model.p.items()}
    model.row[:] = np.where(count > 0, model.row, 0)
    soft = lambda s: np.exp(s - s.max()) / np.exp(s - s.max()).sum()

    def one(text, at):
        """log10 share of text[at + 1] after text[: at + 1], by plain loops."""
        first = at // lm.FRESH * lm.FRESH
        seen = range(max(0, first - (lm.WINDOW - lm.FRESH)), at + 1)
        x = {i: p["E"][text[i]] + p["P"][i - first + lm.WINDOW - lm.FRESH] for i in seen}
        a = soft(np.array([(x[at] @ p["q"]) @ (x[i] @ p["k"]) / lm.WIDTH**0.5 for i in seen]))
        h = x[at] + sum(w * (x[i] @ p["v"]) for w, i in zip(a, seen, strict=True)) @ p["o"]
        z = h + np.maximum(h @ p["U"] + p["u"], 0) @ p["V"]
        want = text[at + 1]
        c = int(model.cls[want])
        lo, hi = model.cut[c], model.cut[c + 1]
        share = soft(z @ p["W"] + p["w"] + model.prior)[c] * soft(p["M"][lo:hi] @ z + p["m"][lo:hi] + model.inside[lo:hi])[want - lo]
        return np.log10(share) - (model.unseen / np.log(10) if want == 0 else 0)

    texts = [model.row[r.integers(0, 300, n)] for n in (2, 17, 18, 33, 100, 2)]
    want = [sum(one(t, k) for k in range(len(t) - 1)) for t in texts]
    assert lm.score_texts(model, texts) == pytest.approx(want, rel=1e-4)


def test_shares_of_all_ids_sum_to_one():
    r = np.random.default_rng(4)
    model = lm.Attention(np.append(r.integers(0, 40, 2999), 7), r.permutation(3000))
    model.p = {k: x + r.standard_normal(x.shape).astype(np.float32) * 0.2 for k, x in model.p.items()}
    z = np.append(r.standard_normal(lm.WIDTH), 1)[None, :].astype(np.float32)
    assert np.exp(model.logs(np.repeat(z, 3000, 0), model.row, model.outputs())).sum() == pytest.approx(1, abs=1e-3)


def test_windows_of_a_long_text_dont_stand_in_memory_together():
    import tracemalloc

    r = np.random.default_rng(8)
    model = lm.Attention(r.integers(1, 9, 300), np.arange(300))
    text = model.row[np.append(299, r.integers(0, 300, 1_000_000))]
    tracemalloc.start()
    try:
        lm.score_texts(model, [text])
        assert tracemalloc.get_traced_memory()[1] < 32 << 20  # all windows at once: 75 MB
    finally:
        tracemalloc.stop()


def test_slopes_of_the_network():
    r = np.random.default_rng(5)
    model = lm.Attention(r.integers(0, 9, 60), np.arange(60))
    model.p = {k: (x + r.standard_normal(x.shape) * 0.2).astype(np.float64) for k, x in model.p.items()}
    _, number, given, wanted = lm.windowed([model.row[r.integers(0, 60, 70)], model.row[r.integers(0, 60, 5)]])

    def loss():
        i, j = np.nonzero(wanted >= 0)
        got = model.logs(model.outcome(given, number, model.folded())[i, j], wanted[i, j], model.outputs())
        return -(got + np.where(wanted[i, j] == 0, model.unseen, 0)).mean()

    for name, g in model.slopes(given, number, wanted).items():
        x = model.p[name].ravel()
        for k in r.choice(len(x), 5):
            old, d = x[k], 1e-4
            x[k] = old + d
            up = loss()
            x[k] = old - d
            assert g.ravel()[k] == pytest.approx((up - loss()) / (2 * d), rel=0.02, abs=1e-5), name
            x[k] = old


def test_a_step_of_a_fit_is_quick():
    """CPU time of the gradients of 512 windows, as a multiple of that of a loop of a million steps of Python."""
    r = np.random.default_rng(9)
    model = lm.Attention(np.append(r.integers(1, 2000, 3500), 1), np.arange(3501))
    _, number, given, wanted = lm.windowed([model.row[r.integers(0, 3500, 2049)] for _ in range(4)])

    def timed(f):
        t = time.thread_time()
        f()
        return time.thread_time() - t

    getattr(lm, "keep_freed_memory", lambda: None)()
    took = [(timed(lambda: model.slopes(given, number, wanted)), timed(lambda: sum(range(1_000_000)))) for _ in range(20)]
    ours, loop = map(min, zip(*took, strict=True))
    assert ours < 1.55 * loop  # before: 1.7 to 2.5


def test_repeated_rows_have_one_score_in_any_company(spark):
    rows = [(k, f"some words of text {k} " * (3 * k + 1)) for k in range(12)]
    twice = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).union(spark.createDataFrame(rows[::3], "doc_id long, text string").coalesce(1))
    got = [(r["doc_id"], r["score"]) for r in lm.score_corpus(twice).collect()]
    assert len(got) == 16 and len(set(got)) == 12


def test_rounds_have_every_training_window_once(spark, monkeypatch):
    """Also with several shards, and with texts of several pieces."""
    r = np.random.default_rng(6)
    monkeypatch.setattr(lm, "SHARD_WINDOWS", 40, raising=False)
    monkeypatch.setattr(lm, "PIECE", 4, raising=False)
    row = np.arange(1001)
    texts = [np.append(r.integers(0, 1000, n), 1000).astype("<u2") for n in (0, 14, 15, 16, 31, 32, 33, 700, 64, 63, 128, 2000, 3, 3)]
    windows = sum(-(-len(x) // lm.FRESH) for x in texts)
    df = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(texts)], "tie long, ids binary")
    assert lm.shards_of(windows) == 1
    whole = lambda number, given, wanted: sorted((k == 0, x.tobytes(), y.tobytes()) for k, x, y in zip(number, given, wanted, strict=True))
    want = whole(*lm.windowed([np.append(1000, x).astype(np.int64) for x in texts])[1:])
    for size in (40, 10):
        monkeypatch.setattr(lm, "SHARD_WINDOWS", size, raising=False)
        got = lm.sampled(df, row, windows).collect()
        assert {x["round"] for x in got} <= set(range(-1, lm.ROUNDS)) and {x["shard"] for x in got} == set(range(lm.shards_of(windows)))
        for of in (lambda x: x["round"] >= 0, lambda x: x["round"] < 0):  # few windows: the rounds start from all of them
            laid, own = lm.unpacked([(x["place"], x["start"], bytes(x["ids"])) for x in got if of(x)], row)
            assert whole(laid.number[own], *laid.places(own)) == want


def test_learning_helps_on_rows_kept_apart(spark):
    """On rows kept apart from the training rows (fold 1 of 7, which no setting was chosen on)."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(util.fold(F.col("doc_id"), 7) != 2)
    rows = suffixdedup.keyed(docs).withColumn("held", util.fold(F.col("doc_id"), 7) == 1)
    path = tokens.default_path()
    texts = util.stored(lm.encoded(rows, path, 50_256), "ids")
    learn, apart = texts.where("not held"), [np.append(50_256, np.frombuffer(r["ids"], "<u2")) for r in texts.where("held").collect()]
    before = lm.Attention(lm.id_counts(learn, 50_256), lm.spelling(path, 50_257))
    plain = lm.score_texts(before, [before.row[x] for x in apart]).sum()
    after = lm.trained(learn, path, 50_256)
    assert lm.score_texts(after, [after.row[x] for x in apart]).sum() > 0.8 * plain
    same = {k: x.copy() for k, x in after.p.items()}
    lm.learnt(after, util.stored(lm.sampled(learn, after.row, 40_000), "more"), 0, 3)
    assert all((same[k] != x).any() for k, x in after.p.items())
    assert lm.score_texts(after, [after.row[x] for x in apart]).sum() > 0.8 * plain


def test_pipeline(spark):
    out = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
        sizes.append(out.select("doc_id").distinct().count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 0


STAGES = {
    "good": lambda s, d: quality.good_documents(d, s.createDataFrame([(5, 1), (None, 0), (7, None)], "doc_id long, quality int"), threshold=0.1),
    "near": lambda s, d: simhash.one_of_each(d),
    "trimmed": lambda s, d: suffixdedup.trimmed_documents(d),
    "clean": lambda s, d: contamination.clean_documents(d, s.createDataFrame([("i", "c d e f g h i j k"), (None, "q"), ("z", None)], "item_id string, text string")),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_take_odd_rows(spark, odd, none, name):
    more = odd.withColumns({c: F.lit("own") for c in ("row", "kept", "print", "kept_id", "root", "hit_id", "text_hash", "x", "y", "node")})
    got = STAGES[name](spark, more)
    assert got.columns == more.columns
    rows = got.collect()
    assert all(r["row"] == r["kept_id"] == "own" and r["rid"] == 1 for r in rows)
    want = {"good": 7, "near": 5, "trimmed": 7, "clean": 7}[name]  # near: no text and empty text, and the repeated row, are copies
    assert len(rows) == want
    assert STAGES[name](spark, none).count() == 0
    hit = spark.createDataFrame([(1, "a c d e f g h i j"), (1, "a c d e f g h i"), (None, "c d e f g h i j")], "doc_id long, text string")
    if name == "clean":  # of one doc_id only the row with the passage goes
        assert [(r["doc_id"], r["text"]) for r in STAGES[name](spark, hit).collect()] == [(1, "a c d e f g h i")]


def test_trimmed_texts(spark):
    passage = " a passage that two documents share and that is long enough, by some bytes, to go from the second one of them "
    rows = [(1, "first é" + passage), (2, "second \ufffd ũ" + passage + "e\ufffdnd"), (3, None), (4, passage)]  # é and ũ end in the same byte
    got = {r["doc_id"]: r["text"] for r in suffixdedup.trimmed_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[3] == "" and 4 not in got
    assert got[2] == "second \ufffd e\ufffdnd"


def planted(spark, docs):
    """Documents with near copies, shared passages, passages of items and rows without ids."""
    r = random.Random(12)
    some = [(i["doc_id"], i["text"]) for i in docs.where("length(text) between 400 and 3000").limit(60).collect()]
    items = [i["text"] for i in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = list(some)
    for k, (i, t) in enumerate(some[:20]):
        w = t.split()
        for _ in range(k % 4):
            w[r.randrange(len(w))] = "changed"
        rows.append((10_000 + i if k % 5 else None, " ".join(w)))
    rows += [(20_000 + k, t[:900] + " " + items[k % len(items)]) for k, (_, t) in enumerate(some[20:30])]
    rows += [(30_000 + k, f"{k} own words before. " + some[40][1][100:700]) for k in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_pipeline_stages_against_brute_force(spark, docs):
    d = planted(spark, docs)
    key = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = quality.score_quality(d, labels).where("predicted = 1").select("doc_id").collect()
    kept = corpus_pipeline.classify(spark, d, SF)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in good)

    rows = [(r["doc_id"], r["text"]) for r in d.collect()]
    prints = np.array([np.frombuffer(simhash.wide_print(t.encode(), 5), np.uint64) for _, t in rows])
    reach = round(64 * simhash.WIDE * np.arccos(1.6 / 1.8) / np.pi)
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            near = np.flatnonzero(simhash.apart(prints, prints[a]) <= reach)
            root[a] = min(root[b] for b in near)
    want = {}
    for k, (i, t) in enumerate(rows):
        mine = (i is None, i or 0, hashlib.md5(t.encode()).hexdigest(), t, i)
        want[root[k]] = min(want.get(root[k], mine), mine)
    assert len(want) < len(rows) - 15
    assert key(corpus_pipeline.drop_near_copies(spark, d, SF)) == sorted(((x[4], x[3]) for x in want.values()), key=str)

    d = d.where("doc_id is not null")
    cut = repeats([(r["doc_id"], r["text"].encode()) for r in d.collect()])
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeats(spark, d, SF).collect()}
    assert set(got) == {i for i, x in cut.items() if x[1] < x[0]}
    assert all(hashlib.sha256(got[i].encode()).hexdigest() == x[3] for i, x in cut.items() if x[1] == 0)

    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.translate({65 + k: 97 + k for k in range(26)}))
    wins = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        wins |= {tuple(w[k : k + 8]) for k in range(max(1, len(w) - 7))} if w else set()
    clean = [(i, t) for i, t in ((r["doc_id"], r["text"]) for r in d.collect()) if not any(tuple(words(t)[k : k + n]) in wins for n in {len(x) for x in wins} for k in range(len(words(t))))]
    assert len(clean) < d.count()
    assert key(corpus_pipeline.decontaminate(spark, d, SF)) == sorted(clean, key=str)

    packed = corpus_pipeline.pack(spark, d, SF).collect()
    tok = tokens.load(tokens.default_path())
    for r in d.collect():
        ids = [x for p in sorted((p["piece"], p["ids"]) for p in packed if p["doc_id"] == r["doc_id"]) for x in p[1]]
        assert ids == [*tok.ids(r["text"]).tolist(), 2]


def test_shared_folder_without_setting():
    def session(master):
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master, applicationId="app"))

    assert util.shared_dir(session("local[2]")) == util.shared_dir(session("local"))
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError):
            util.shared_dir(session(master))
