"""Removal of repeated byte strings across a corpus, by suffix sorting of what can repeat.

1. Anchors. In each window of `WIDTH` bytes the 32-byte piece of least hash is the window's anchor, so equal
   windows have equal anchors at equal places. Anchors (about one in 35 bytes) meet by hash, as packed arrays in
   which each batch names a hash once; only those that occur twice stay.
2. Contexts. A kept anchor's context is the text of all windows that it anchors. Contexts are sorted as suffixes of
   their batch; of equal ones all but the first place are repeats, and the first goes on.
3. Suffix sorting. Each bucket of anchors sorts its contexts in the same way, and then, block by block, the windows of
   the distinct contexts that share an anchor (suffixes.py); neighbours with the same bytes form a class, and all but
   its first place are repeats. Anchors that hold more than a millionth of all occurrences (at most 10^6 of them) aren't
   one bucket: their windows go out in groups of STEP neighbouring places, each by the bytes that all windows of the
   group have in common, so that only windows with nearly all bytes alike meet.
4. Each document drops the bytes that its repeated windows cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm import suffixes
from textmill.llm.util import bounded_batches, buckets, stored

WIDTH, GRAM = 100, 32
SPAN = WIDTH - GRAM + 1
#: Windows looked at together; bounds memory for texts of any length.
CHUNK = 1 << 18
#: An anchor is hot if it occurs this often and has this share of all occurrences.
HOT, HOT_SHARE = 256, 1e-6
#: Windows of a hot anchor that go out together.
STEP = 8
#: Bytes of contexts that go out together, so that a bucket's share compresses well however many buckets there are.
SEND = 1 << 25
LOWEST = -(2**63)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(29)


BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def grams(b: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on."""
    x, step = BYTES[b], 1
    while step < GRAM:
        x = x[:-step] * np.uint64(0xBF58476D1CE4E5B9 + 2 * step) + x[step:]
        step *= 2
    return mixed(x)


def anchors(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first window, last window) of each anchor; the windows' ranges are disjoint."""
    b, parts = np.frombuffer(body, np.uint8), []
    for at in range(0, len(b) - WIDTH + 1, CHUNK):
        h = grams(b[at : at + CHUNK + WIDTH - 1])
        v, p, have = h, np.arange(len(h), dtype=np.int32), 1
        while have < SPAN:  # least hash, leftmost, of a growing number of places
            step = min(have, SPAN - have)
            less = v[step:] < v[:-step]
            v, p = np.where(less, v[step:], v[:-step]), np.where(less, p[step:], p[:-step])
            have += step
        lo = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        parts.append((h[p[lo]], p[lo] + at, lo + at, np.append(lo[1:], len(p)) - 1 + at))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)


def packed(**columns: list[bytes]) -> dict[str, pa.Array]:
    return {k: pa.array(v, pa.binary()) for k, v in columns.items()}


def split_by(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cut) if len(order) else ():
        yield int(bucket[part[0]]), part


class Rows:
    """Packed rows: one per bucket with several arrays."""

    def __init__(self, *names: str) -> None:
        self.names, self.bucket, self.data = names, [], {n: [] for n in names}

    def add(self, bucket: int, **arrays: np.ndarray | bytes) -> None:
        self.bucket.append(bucket)
        for n in self.names:
            x = arrays.get(n)
            self.data[n].append(x if isinstance(x, bytes) or x is None else np.ascontiguousarray(x).tobytes())

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"bucket": pa.array(self.bucket, pa.int32())} | packed(**self.data))

    @staticmethod
    def schema(*names: str) -> str:
        return "bucket int, " + ", ".join(f"{n} binary" for n in names)


def gathered(batches: Iterator[pa.RecordBatch], kinds: dict[str, str], passed: str) -> tuple[dict[str, np.ndarray], list[dict]]:
    """All rows of a partition joined to arrays, and those without `passed` apart."""
    parts, rest = {n: [] for n in kinds}, []
    for b in batches:
        for row in b.to_pylist():
            if row[passed] is None:
                rest.append(row)
            else:
                for n in kinds:
                    parts[n].append(row[n] or b"")
    return {n: np.frombuffer(b"".join(parts[n]), kind) for n, kind in kinds.items()}, rest


PLACES = {"doc": "<i8", "tie": "<i8", "pos": "<u4"}


def firsts(group: np.ndarray, doc: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """True for each row at a later place than the first of its group. Rows of one place are one occurrence."""
    order = np.lexsort((pos, tie, doc, group))
    g, d, t, p = group[order], doc[order], tie[order], pos[order]
    start = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
    first = np.repeat(start, np.diff(np.append(start, len(g))))
    late = np.empty(len(g), bool)
    late[order] = (d != d[first]) | (t != t[first]) | (p != p[first])
    return late


def flags_of(doc: np.ndarray, tie: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (doc, tie, lo, hi) of repeated windows, adjoining ranges joined."""
    order = np.lexsort((lo, tie, doc))
    doc, tie, lo, hi = doc[order], tie[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    if not len(doc):
        return
    apart = np.append(True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (lo[1:] > hi[:-1] + 1))
    at = np.flatnonzero(apart)
    end = np.maximum.reduceat(hi, at)
    yield pa.RecordBatch.from_pydict({"doc": pa.array(doc[at]), "tie": pa.array(tie[at]), "lo": pa.array(lo[at].astype(np.int32)), "hi": pa.array(end.astype(np.int32))})


def lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of a column of lists of numbers, as arrays; null rows are empty."""
    cut, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        yield flat[a:b] if column[k].is_valid else flat[:0]


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    bounded_batches(docs.sparkSession)
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"), *more)
    return rows.withColumns({"doc": F.coalesce("doc_id", F.lit(LOWEST)), "tie": F.xxhash64("body")})


def told(**columns: np.ndarray) -> pa.RecordBatch:
    """A batch of repeated_anchors; columns that aren't given are null."""
    size = len(next(iter(columns.values())))
    kinds = {"doc": pa.int64(), "tie": pa.int64(), "pos": pa.int32(), "h": pa.int64(), "n": pa.int64()}
    return pa.RecordBatch.from_pydict({k: pa.array(columns[k].astype(t.to_pandas_dtype())) if k in columns else pa.nulls(size, t) for k, t in kinds.items()})


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Each bucket of 0 to parts - 1 in a partition of its own."""
    return rows.repartitionById(parts, F.col("bucket"))


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """doc, tie, pos, h, n: rows with pos are anchors that occur more than once in the corpus; rows with n give a
    hot anchor's count, or without h the number of all anchors in a partition."""
    parts = buckets(rows)
    names = ("h", "n", "doc", "tie", "pos")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, tie = (b.column(c).to_numpy(zero_copy_only=False).astype(PLACES[c]) for c in ("doc", "tie"))
            got = [anchors(x)[:2] for x in b.column("body").to_pylist()]
            h = np.concatenate([np.zeros(0, np.uint64), *[g[0] for g in got]])
            pos = np.concatenate([np.zeros(0, np.int64), *[g[1] for g in got]]).astype("<u4")
            of = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
            _, first, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            out, more = Rows(*names), np.flatnonzero(n[back] > 1)
            if len(more):
                out.add(int(h[more[0]] % np.uint64(parts)), doc=doc[of[more]], tie=tie[of[more]], pos=pos[more])
            bucket = (h[first] % np.uint64(parts)).astype(np.int64)
            for k, part in split_by(bucket):
                i = first[part]
                out.add(k, h=h[i], n=n[part].astype("<u4"), doc=doc[of[i]], tie=tie[of[i]], pos=pos[i])
            yield out.batch()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, rest = gathered(batches, {"h": "<u8", "n": "<u4"} | PLACES, "h")
        for r in rest:
            yield told(**{k: np.frombuffer(r[k], kind) for k, kind in PLACES.items()})
        one, back, n = np.unique(x["h"], return_inverse=True, return_counts=True)
        total = np.bincount(back, x["n"], len(n)).astype(np.int64)
        want = (n[back] > 1) & (x["n"] == 1)  # those of 2 and more have told their batch
        yield told(**{k: x[k][want] for k in PLACES})
        hot = total >= HOT
        yield told(h=one[hot].view(np.int64), n=total[hot])
        yield told(n=np.array([total.sum()], np.int64))

    schema = Rows.schema(*names)
    rows = dealt(rows.select("doc", "tie", "body").mapInArrow(find, schema), parts)
    return rows.mapInArrow(meet, "doc long, tie long, pos int, h long, n long")


def repeats(rows: DataFrame, hot: np.ndarray) -> DataFrame:
    """rows(doc, tie, body, at: anchor positions; others are ignored) -> doc, tie, lo, hi: ranges of repeated windows."""
    parts = buckets(rows)
    names = ("kind", "text", "doc", "tie", "pos", "hi")
    held = rows.sparkSession.sparkContext.broadcast(np.sort(hot))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, ready, size = held.value, [], 0
        for b in batches:
            found, key = [], []  # (doc, tie, first window, last window, text, anchor), and the anchor's hash
            for doc, tie, body, at in zip(*(b.column(c).to_pylist() for c in ("doc", "tie", "body")), lists(b.column("at")), strict=True):
                h, pos, lo, hi = anchors(body)
                keep = np.isin(pos, at)
                found += [(doc, tie, a, z, body[a : z + WIDTH], p) for p, a, z in zip(pos[keep].tolist(), lo[keep].tolist(), hi[keep].tolist(), strict=True)]
                key.append(h[keep])
            key, out = np.concatenate([np.zeros(0, np.uint64), *key]), Rows(*names)
            own = fresh(found, out)
            warm = np.isin(key[own], hot)
            parts_of = [(g, (doc, tie, first, last, text[first - a : last - a + WIDTH])) for doc, tie, a, z, text, p in (found[k] for k in own[warm].tolist()) for g, (first, last) in grouped(p, a, z)]
            parts_own = fresh(split := [x for _, x in parts_of], out)
            core = [xxhash.xxh3_64_intdigest(x[4][g - x[2] : g - x[2] + WIDTH - STEP + 1]) for g, x in (parts_of[k] for k in parts_own.tolist())]
            rows = [found[k][:5] for k in own[~warm].tolist()] + [split[k] for k in parts_own.tolist()]
            h = np.append(key[own[~warm]], np.array(core, np.uint64))
            ready.append((h, np.array([x[:4] for x in rows], np.int64).reshape(-1, 4), [x[4] for x in rows]))
            size += sum(map(len, ready[-1][2]))
            if out.bucket:
                yield out.batch()
            if size >= SEND:
                yield sent(ready)
                ready, size = [], 0
        if ready:
            yield sent(ready)

    def sent(ready: list[tuple[np.ndarray, np.ndarray, list[bytes]]]) -> pa.RecordBatch:
        """A row for each bucket of all contexts that are ready."""
        squeeze, out = zstandard.ZstdCompressor(level=3), Rows(*names)
        h, a, texts = np.concatenate([x[0] for x in ready]), np.concatenate([x[1] for x in ready]), [t for x in ready for t in x[2]]
        for k, i in split_by((mixed(h) % np.uint64(parts)).astype(np.int64)):
            i = i[np.argsort(h[i], kind="stable")]  # like texts together, for compression
            out.add(k, kind=b"text", text=squeeze.compress(b"".join(texts[j] for j in i.tolist())), doc=a[i, 0], tie=a[i, 1], pos=a[i, 2].astype("<u4"), hi=(a[i, 3] - a[i, 2]).astype("<u4"))
        return out.batch()

    def fresh(found: list[tuple], out: Rows) -> np.ndarray:
        """The numbers of the first of each distinct text; later places of a text are repeats, which go to out."""
        if not found:
            return np.zeros(0, np.int64)
        a, same = np.array([x[:4] for x in found], np.int64), classes([x[4] for x in found])
        late = firsts(same, a[:, 0], a[:, 1], a[:, 2])
        if late.any():
            x = a[late]
            out.add(int(x[0, 1] % parts), kind=b"late", doc=x[:, 0], tie=x[:, 1], pos=x[:, 2].astype("<u4"), hi=x[:, 3].astype("<u4"))
        own = np.flatnonzero(~late)
        return own[np.unique(same[own], return_index=True)[1]]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[bytes, list[dict]] = {b"late": [], b"text": []}
        for b in batches:
            for row in b.to_pylist():
                by[row["kind"]].append(row)
        whole = lambda kind, n, t: np.frombuffer(b"".join(r[n] for r in by[kind]), t)
        place = lambda kind: [whole(kind, n, t) for n, t in PLACES.items()]
        yield from flags_of(*place(b"late"), whole(b"late", "hi", "<u4"))
        d, t, p = place(b"text")
        p, expand = p.astype(np.int64), zstandard.ZstdDecompressor()
        text = np.frombuffer(b"".join(expand.decompress(r["text"]) for r in by[b"text"]), np.uint8)
        yield from windows(text, d, t, p, p + whole(b"text", "hi", "<u4"))

    return dealt(rows.mapInArrow(spread, Rows.schema(*names)), parts).mapInArrow(meet, "doc long, tie long, lo int, hi int")


def grouped(anchor: int, lo: int, hi: int) -> Iterator[tuple[int, tuple[int, int]]]:
    """The windows lo to hi of an anchor in groups of STEP by their distance from it: where the bytes start that all
    windows of the group have (WIDTH - STEP + 1 of them), and the first and last window."""
    for g in range((anchor - hi) // STEP, (anchor - lo) // STEP + 1):
        yield anchor - g * STEP, (max(lo, anchor - g * STEP - STEP + 1), min(hi, anchor - g * STEP))


def classes(texts: list[bytes]) -> np.ndarray:
    """Numbers that are equal for equal texts, from neighbours in sorted order."""
    order = suffixes.sorted_texts(texts)
    by, out = order.tolist(), np.zeros(len(texts), np.int64)
    new = np.fromiter((texts[i] != texts[j] for i, j in zip(by, by[1:], strict=False)), bool, max(0, len(by) - 1))
    out[order[1:]] = np.cumsum(new)
    return out


def least_gram(text: np.ndarray, off: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least hash of a piece within each of the ranges, taken in parts of bounded size."""
    out, at = np.zeros(len(off), np.uint64), 0
    while at < len(off):
        to = max(at + 1, int(np.searchsorted(end, off[at] + CHUNK, side="right")))
        h = grams(text[off[at] : end[to - 1]])
        edge = np.stack([off[at:to], end[at:to] - GRAM + 1], axis=1).ravel() - off[at]
        out[at:to] = np.minimum.reduceat(np.append(h, np.uint64(2**64 - 1)), edge)[::2]
        at = to
    return out


def windows(text: np.ndarray, doc: np.ndarray, tie: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Repeats among the contexts of a bucket, laid end to end in text."""
    size = hi - lo + WIDTH
    end = np.cumsum(size)
    off = end - size
    raw = text.tobytes()
    same = classes([raw[a:b] for a, b in zip(off.tolist(), end.tolist(), strict=True)])
    late = firsts(same, doc, tie, lo)
    yield from flags_of(doc[late], tie[late], lo[late], hi[late])
    # Of each distinct context its first place, where the anchor (its piece of least hash) has other contexts.
    i = np.flatnonzero(~late)
    i = np.sort(i[np.unique(same[i], return_index=True)[1]]) if len(i) else i
    h = least_gram(text, off[i], end[i])
    _, back, n = np.unique(h, return_inverse=True, return_counts=True)
    i = i[n[back] > 1]
    if not len(i):
        return
    count = size[i] - WIDTH + 1
    at = np.cumsum(size[i]) - size[i]
    pick = np.repeat(off[i] - at, size[i]) + np.arange(size[i].sum())
    total = len(pick)
    text = np.concatenate([text[pick], np.zeros(2 * suffixes.PERIOD + WIDTH, np.uint8)])
    own = np.repeat(np.arange(len(i)), count)
    starts = np.repeat(at, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    for block in suffixes.sorted_blocks(text, total, starts):
        k = np.searchsorted(starts, block)
        c = i[own[k]]
        p = lo[c] + block - at[own[k]]
        late = firsts(suffixes.equal_runs(text, block, WIDTH), doc[c], tie[c], p)
        yield from flags_of(doc[c][late], tie[c][late], p[late], p[late])


def without_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs(doc_id, text), and with with_text the
    bytes that stay (kept), without what a cut leaves of a character, and the row's other columns (a struct, row).

    A byte goes if a string of WIDTH bytes that covers it also starts earlier: in a document of smaller doc_id, or
    earlier in the same one. Null and empty texts have no bytes. A null doc_id counts as the smallest long; rows that
    share a doc_id but not the text are ordered by a 64-bit hash of the text; rows equal in both are one document, and
    each gets its result. Other columns are ignored; without rows there are none.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    rows = keyed(docs, row) if with_text else keyed(docs)
    found = stored(repeated_anchors(rows), "anchors")
    total = found.where("n is not null and h is null").agg(F.sum("n")).first()[0] or 0
    hot = found.where(F.col("h").isNotNull() & (F.col("n") >= max(HOT, HOT_SHARE * total))).select("h").toPandas()["h"].to_numpy().astype(np.int64).view(np.uint64)
    at = found.where("pos is not null").groupBy("doc", "tie").agg(F.collect_list("pos").alias("at"))
    # Both joins deal out the same columns of rows, so that without other columns one exchange of the texts serves both.
    flags = repeats(rows.select("doc_id", "body", "doc", "tie").join(at.hint("shuffle_hash"), ["doc", "tie"]), hot)
    ranges = F.shiftleft(F.col("lo").cast("long"), 32) + F.col("hi")  # one list of them takes less room than two
    flags = (stored(flags, "repeats") if with_text else flags).groupBy("doc", "tie").agg(F.collect_list(ranges).alias("ranges"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, gone, spans, sha, kept = [], [], [], [], []
            for body, both in zip(b.column("body").to_pylist(), lists(b.column("ranges")), strict=True):
                lo, hi = both >> 32, both & 0xFFFFFFFF
                mark = np.zeros(len(body) + 1, np.int32)
                np.add.at(mark, lo, 1)
                np.add.at(mark, hi + WIDTH, -1)
                covered = np.cumsum(mark)[:-1] > 0
                left = np.frombuffer(body, np.uint8)[~covered].tobytes() if len(lo) else body
                size.append(len(body))
                gone.append(len(body) - len(left))
                spans.append(int(np.count_nonzero(np.diff(covered.astype(np.int8), prepend=0) == 1)))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8", "ignore").encode() if with_text and len(left) < len(body) else left)
            own = {"doc_id": b.column("doc_id"), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
            yield pa.RecordBatch.from_pydict(own | ({"kept": pa.array(kept, pa.binary()), "row": b.column("row")} if with_text else {}))

    whole = rows.join(flags.hint("shuffle_hash"), ["doc", "tie"], "left").select("doc_id", "body", "ranges", *(["row"] if with_text else []))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return whole.mapInArrow(cut, schema + (f", kept binary, row {rows.schema['row'].dataType.simpleString()}" if with_text else ""))


def trimmed_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, without repeated bytes; texts of which nothing stays go. What a cut
    leaves of a character goes too; n_chars, where there is one, is counted anew."""
    out = without_repeats(docs, with_text=True).where("n_removed < n_bytes or n_bytes = 0")
    out = out.withColumn("text", F.col("kept").cast("string"))
    own = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return out.select(*[(own[c] if c in own else F.col("row")[c]).alias(c) for c in docs.columns])
