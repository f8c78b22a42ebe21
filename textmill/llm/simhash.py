"""SimHash near-duplicates by Golay-code fuzzy hashing.

Equal fingerprints are one class from the start. A 64-bit fingerprint is cut into segments of 21, 21 and 22 bits,
each read as a word of the perfect (23, 12) Golay code. The fuzzy keys of a segment are its nearest codeword and,
where that is three bits away, the nearest codewords of the words one bit away (of the two codewords of such a
pair, the smaller one suffices): two segments at most one bit apart share a key. With three errors or fewer in
all, either some segment is equal and another at most one bit off, or every segment is at most one bit off; so
keys are (equal segment, fuzzy segment) for each ordered pair, and (fuzzy, fuzzy, fuzzy). Fingerprints that share
a key are compared bit by bit, and each bucket gives a spanning forest of its links, not all its pairs.

For similarities of shingle sets, links reach further than a few bits: wide fingerprints of 192 bits have eight
segments of 23 bits, and the fuzzy keys of each two segments are a key (one_of_each).
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.graph import components
from textmill.llm.suffixdedup import Rows, mixed, split_by
from textmill.llm.util import buckets, id_text, partitions, stored

# Fixed value: the generator polynomial of the binary Golay code.
GOLAY = 0b101011100011
SEGMENTS = ((0, 21), (21, 21), (42, 22))
WORDS, REACH, SEED = 3, 3, 42
#: 64-bit words of a wide fingerprint, its segments, and wide fingerprints for each bucket of keys.
WIDE, PARTS, PER_BUCKET = 3, 8, 10_000
#: Shingles hashed at a time, and rows of a bucket compared at a time.
CHUNK, ROWS = 1 << 16, 1 << 10


def shingles(body: bytes, words: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a UTF-8 text, CHUNK at a time: A-Z lower-cased, words between ASCII white space; fewer
    words than a shingle has are one."""
    each = body.lower().split()
    if not each:
        return
    flat = b" ".join(each)
    ends = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    cut = [0, *(ends + 1).tolist()], [*ends.tolist(), len(flat)]
    n = max(1, len(each) - words + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        starts, stops = cut[0][at : min(at + CHUNK, n)], cut[1][min(at + words, len(each)) - 1 : at + CHUNK + words - 1]
        yield np.array([digest(flat[s:e], SEED) for s, e in zip(starts, stops, strict=True)], "<u8")


def majority(hashes: list[np.ndarray]) -> int:
    """The bits that over half of the hashes have."""
    total, n = np.zeros(64, np.int64), 0
    for h in hashes:
        for at in range(0, len(h), CHUNK):
            total += np.unpackbits(h[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprint(body: bytes) -> int:
    """The 64 bits of the shingles of three words, repeats included; without words none."""
    return majority(list(shingles(body, WORDS)))


def wide_print(body: bytes, words: int) -> bytes:
    """64 * WIDE bits of the distinct shingles; without words none."""
    h = np.unique(np.concatenate([np.zeros(0, np.uint64), *shingles(body, words)]))
    return b"".join(majority([mixed(h + np.uint64(j * 0x9E3779B97F4A7C15 % 2**64))]).to_bytes(8, "little") for j in range(WIDE))


@functools.cache
def errors() -> np.ndarray:
    """The error pattern of each syndrome: every pattern of at most three bits has its own."""
    table = np.zeros(1 << 11, np.int64)
    for k in range(4):
        for bits in itertools.combinations(range(23), k):
            e = np.array([sum(1 << b for b in bits)])
            table[syndrome(e)] = e
    return table


def syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for b in range(22, 10, -1):
        rest ^= np.where(rest >> b & 1, GOLAY << (b - 11), 0)
    return rest


def nearest(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest codeword of each 23-bit word, and whether it is three bits away."""
    e = errors()[syndrome(words)]
    return (words ^ e) >> 11, np.bitwise_count(e) == 3


def fuzzy(words: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys of segments of `bits` bits: pairs (number of the word, codeword index)."""
    own, far = nearest(words)
    rows = np.arange(len(words))
    found = [np.stack([rows, own])]
    for b in range(bits):
        near, _ = nearest(words[far] ^ (1 << b))
        less = near < own[far]
        found.append(np.stack([rows[far][less], near[less]]))
    return np.unique(np.concatenate(found, axis=1), axis=1)


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the fingerprint, key) for all keys of uint64 fingerprints."""
    seg = [(prints >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [fuzzy(s, n) for s, (_, n) in zip(seg, SEGMENTS, strict=True)]
    who, what = [], []
    for tag, (i, j) in enumerate(itertools.permutations(range(3), 2)):
        r, c = near[j]
        who.append(r)
        what.append(tag << 40 | seg[i][r] << 12 | c)
    r, c = near[0]
    for j in (1, 2):
        r, c = crossed((r, c), near[j], len(prints))
    who.append(r)
    what.append(6 << 40 | c)
    return np.concatenate(who), np.concatenate(what)


def crossed(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each key of a with each of b of the same fingerprint, of n."""
    (r, c), (rows, codes) = a, b
    first, count = np.searchsorted(rows, np.arange(n)), np.bincount(rows, minlength=n)
    times = count[r]
    at = np.repeat(first[r] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
    return np.repeat(r, times), np.repeat(c, times) << 12 | codes[at]


def wide_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, key) for all keys of wide fingerprints (n, WIDE): the fuzzy keys of each two of PARTS segments."""
    bits = np.unpackbits(prints.view(np.uint8).reshape(len(prints), -1), axis=1, bitorder="little")[:, : 23 * PARTS]
    seg = bits.reshape(len(prints), PARTS, 23).astype(np.int64) @ (1 << np.arange(23))
    near = [fuzzy(seg[:, i], 23) for i in range(PARTS)]
    who, what = [], []
    for tag, (i, j) in enumerate(itertools.combinations(range(PARTS), 2)):
        r, c = crossed(near[i], near[j], len(prints))
        who.append(r)
        what.append(tag << 24 | c)
    return np.concatenate(who), np.concatenate(what).astype(np.uint32)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints along the last axis."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def forest(f: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """Links among distinct fingerprints (n, words) that connect all that are connected: breadth first, rows compared in blocks."""
    left = np.arange(1, len(f))
    front = np.zeros(1, np.int64)
    while len(left):
        fresh = []
        for at in range(0, len(front), ROWS):
            some = front[at : at + ROWS]
            close = np.concatenate([apart(f[some][:, None], f[left[k : k + ROWS]][None, :]) <= reach for k in range(0, len(left), ROWS)], axis=1)
            hit = close.any(0)
            yield from zip(some[close.argmax(0)[hit]].tolist(), left[hit].tolist(), strict=True)
            fresh.append(left[hit])
            left = left[~hit]
            if not len(left):
                break
        front = np.concatenate(fresh)
        if not len(front) and len(left):
            front, left = left[:1], left[1:]


def bucket_links(key: np.ndarray, who: np.ndarray, prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between distinct fingerprints (n, words) that share a key: a spanning forest of each key's links, as pairs
    of numbers. Most groups are stars around their first member; only the others are searched one by one."""
    order = np.lexsort((who, key))
    key, who = key[order], who[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (who[1:] != who[:-1])) if len(key) else np.zeros(0, bool)
    key, who = key[fresh], who[fresh]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(key)))
    a, b = [], []
    first = np.repeat(start, size)
    rest = np.flatnonzero(np.arange(len(key)) > first)
    missed = np.zeros(len(start), np.int64)
    of = np.repeat(np.arange(len(start)), size)
    for at in range(0, len(rest), CHUNK):
        k = rest[at : at + CHUNK]
        x, y = who[first[k]], who[k]
        near = apart(prints[x], prints[y]) <= reach
        a.append(x[near])
        b.append(y[near])
        missed += np.bincount(of[k[~near]], minlength=len(start))
    for g in np.flatnonzero((missed > 0) & (size > 2)).tolist():
        mine = who[start[g] : start[g] + size[g]]
        if pairs := list(forest(prints[mine], reach)):
            p = mine[np.array(pairs)]
            a.append(p[:, 0])
            b.append(p[:, 1])
    both = np.unique(np.stack([np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b)]), axis=1)
    return both[0], both[1]


def as_stars(a: np.ndarray, b: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of numbers that connect the same fingerprints (n, words) as the links a, b: of each component its least
    fingerprint with each other one, which different buckets agree on, so that a group costs a pair for each member
    and not one for each key."""
    rank = np.empty(len(prints), np.int64)
    rank[order := np.lexsort(prints.T)] = np.arange(len(prints))
    a, b, root = rank[a], rank[b], np.arange(len(prints))
    while len(a):  # the larger root of a link points to the smaller one, then all point to their roots
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root] != root).any():
            root = np.where(up, root[root], root)
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    far = np.flatnonzero(root != np.arange(len(root)))
    return order[root[far]], order[far]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for each row of docs(doc_id, text); a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x) for x in b.column("body").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "fp": pa.array(fp.view(np.int64))})

    return id_text(docs).mapInArrow(run, "doc_id long, fp long")


def links(prints: DataFrame) -> DataFrame:
    """prints(fp), distinct -> a, b: verified links that connect all fingerprints that links of REACH bits connect."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            who, key = keys(fp.view(np.uint64))
            for at in range(0, len(who), CHUNK):
                yield pa.RecordBatch.from_pydict({"key": pa.array(key[at : at + CHUNK]), "fp": pa.array(fp[who[at : at + CHUNK]])})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("key").to_numpy(zero_copy_only=False), b.column("fp").to_numpy(zero_copy_only=False)) for b in batches]
        if got:
            fp, who = np.unique(np.concatenate([g[1] for g in got]).view(np.uint64), return_inverse=True)
            a, b = (fp[x] for x in bucket_links(np.concatenate([g[0] for g in got]), who, fp[:, None], REACH))
            for at in range(0, len(a), CHUNK):
                yield pa.RecordBatch.from_pydict({"a": pa.array(a[at : at + CHUNK].view(np.int64)), "b": pa.array(b[at : at + CHUNK].view(np.int64))})

    return prints.mapInArrow(spread, "key long, fp long").repartition(buckets(prints, 1 << 20), "key").mapInArrow(meet, "a long, b long")


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, n_links, for each row of docs(doc_id, text).

    component_id is the smallest doc_id reachable over fingerprints at most three bits apart; rows with null
    doc_id take part, and a component of only such rows has a null one. n_links counts other fingerprints that a
    fingerprint is linked with in the spanning links (0: none). Texts without words have fingerprint zero.
    Repeated rows each get a row; other columns are ignored.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    each, edges = classes(rows)
    degree = edges.select(F.col("a").alias("fp")).union(edges.select("b")).groupBy("fp").agg(F.count("*").alias("n_links"))
    low = each.groupBy("root").agg(F.min("low").alias("component_id"))
    each = each.join(low, "root").join(degree, "fp", "left").select("fp", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    each = stored(each, "places")  # so that nothing but the join needs its rows together, and a fingerprint of very many rows can be split
    return rows.join(each, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")


def classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows(doc_id, fp) -> fp, low (its smallest doc_id), root (of its component), and the links found."""
    each = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    edges = stored(links(each.select("fp")).distinct(), "edges")
    each = each.join(components(edges, "stars"), F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    return each, edges


def wide_prints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, print (64 * WIDE bits), text_md5 for each row of docs(doc_id, text); a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([wide_print(body, words) for body in b.column("body").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "print": x, "text_md5": b.column("text_md5")})

    return id_text(docs).withColumn("text_md5", F.md5("body")).mapInArrow(run, "doc_id long, print binary, text_md5 string")


def wide_links(prints: DataFrame, reach: int, buckets: int) -> DataFrame:
    """prints(print), distinct -> a, b: pairs that connect all fingerprints which links of at most reach bits between
    those that share a key connect. The links of a bucket leave it as stars, so that a large group has few pairs for
    each of its members. Rows are packed: a batch sends each bucket its fingerprints once, and keys that point to them."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.frombuffer(b"".join(b.column("print").to_pylist()), np.uint64).reshape(-1, WIDE)
            if not len(x):
                continue
            who, key = wide_keys(x)
            out = Rows("keys", "who", "prints")
            for k, part in split_by((mixed(key.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)):
                used, at = np.unique(who[part], return_inverse=True)
                out.add(k, keys=key[part], who=at.astype("<u4"), prints=x[used])
            yield out.batch()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, who, prints, n = [], [], [], 0
        for b in batches:
            for r in b.to_pylist():
                key.append(np.frombuffer(r["keys"], np.uint32))
                who.append(np.frombuffer(r["who"], "<u4").astype(np.int64) + n)
                prints.append(np.frombuffer(r["prints"], np.uint64).reshape(-1, WIDE))
                n += len(prints[-1])
        if n:
            x = np.concatenate(prints)
            a, b = as_stars(*bucket_links(np.concatenate(key), np.concatenate(who), x, reach), x)
            for at in range(0, len(a), CHUNK):
                yield pa.RecordBatch.from_pydict({c: pa.array([y.tobytes() for y in x[i[at : at + CHUNK]]], pa.binary()) for c, i in (("a", a), ("b", b))})

    return prints.mapInArrow(spread, Rows.schema("keys", "who", "prints")).repartitionById(buckets, F.col("bucket")).mapInArrow(meet, "a binary, b binary")


def one_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of docs, with all its columns, of each component of near copies: of its smallest doc_id (null: after all
    others), of that one's texts the one of the smallest MD5, and of equal rows any.

    Near copies share `similarity` or more of their distinct shingles of `words` words (common ones over all), as wide
    fingerprints tell it: two link if they differ in no more bits than texts of just that similarity differ in on
    average. A null text counts as empty; texts without words are copies of each other; other columns stay as they are.
    """
    reach = round(64 * WIDE * math.acos(2 * similarity / (1 + similarity)) / math.pi)
    rows = stored(wide_prints(docs, words), "prints")
    each = stored(rows.groupBy("print").agg(F.count("*").alias("n")), "classes")
    buckets = max(partitions(docs.sparkSession), each.count() // PER_BUCKET)
    edges = stored(wide_links(each.select("print"), reach, buckets).distinct(), "edges")
    root = components(edges.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b")), "stars")
    own = F.xxhash64("print")
    same = rows.groupBy("print", "doc_id", "text_md5").agg(F.count("*").alias("n"))
    same = same.withColumn("node", own).join(root.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").withColumn("root", F.coalesce("root", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_md5", "n")).alias("first")
    kept = stored(same.groupBy("root").agg(first).select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_md5").alias("kept_md5"), F.col("first.n").alias("kept_n")), "kept")
    md5 = F.md5(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"))
    own = docs["doc_id"].cast("long").eqNullSafe(kept["kept_id"]) & (md5 == kept["kept_md5"])
    out = docs.join(kept.where("kept_n = 1"), own, "left_semi")
    if kept.where("kept_n > 1").limit(1).count():
        keys = {f"one_of_each {k}": c for k, c in (("id", docs["doc_id"].cast("long")), ("md5", md5))}
        several = docs.join(kept.where("kept_n > 1"), own, "left_semi").withColumns(keys)
        out = out.unionByName(several.dropDuplicates(list(keys)).drop(*keys))
    return out
