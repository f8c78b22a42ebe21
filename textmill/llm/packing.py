"""Best-fit packing of documents into sequences, improved by swaps.

Texts become ids in one pass; documents of more than one sequence are cut so that only their first piece is
shorter. Whole pieces fill a sequence each. The others are dealt by row number into shards of a bounded size;
each shard is packed best-fit decreasing, and then a local search over its underfull bins moves a document,
exchanges one for one or two for one whenever this raises the sum of squared fills, until none does.
A shard costs at most about one sequence over the optimum.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import tokens
from textmill.llm.util import id_text, stored

#: Documents of a shard, about: bounds the memory and time of one group.
SHARD_DOCS = 32_768


def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Bins of item numbers, largest items first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(room + 1)]
    some = 0  # bit s: a bin with s free
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = some >> sizes[i]
        if fit:
            s = sizes[i] + (fit & -fit).bit_length() - 1
            b = free[s].pop()
            if not free[s]:
                some &= ~(1 << s)
        else:
            s, b = room, len(bins)
            bins.append([])
        bins[b].append(i)
        s -= sizes[i]
        if s:
            free[s].append(b)
            some |= 1 << s
    return bins


class Bins:
    """Underfull bins and what may come back from each in an exchange: nothing, an item, or two items."""

    def __init__(self, bins: list[list[int]], sizes: list[int], room: int) -> None:
        self.sizes, self.room = sizes, room
        self.bins = [list(b) for b in bins]
        #: The entry after the last stands for no bin: it is full, so that nothing is exchanged with it.
        self.fill = np.array([sum(sizes[i] for i in b) for b in bins] + [room], np.int64)
        #: The step of each bin's last change.
        self.changed = np.zeros(len(bins) + 1, np.int64)
        self.step = 0
        backs = [self.backs(b) for b in range(len(bins)) if self.fill[b] < room]
        self.size, self.bin, self.count = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*backs, strict=True) if backs else ([], [], [])))

    def backs(self, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct sizes that bin b can give back, the bin, and by how many items (the fewest)."""
        own = np.unique(np.array([self.sizes[i] for i in self.bins[b]], np.int64))
        n = np.array([self.sizes[i] for i in self.bins[b]], np.int64)
        two = np.setdiff1d((n[:, None] + n)[np.triu_indices(len(n), 1)], own)
        size = np.concatenate([[0], own, two])
        return size, np.full(len(size), b), np.repeat([0, 1, 2], [1, len(own), len(two)])

    def best(self, a: int, since: int) -> tuple[int, int, int] | None:
        """Bin, what bin a gives it and what comes back: a move, one for one, two for one or one for two that
        raises the sum of squared fills; with the fullest bin that has any. Bins not changed after `since` are left out."""
        fill, room = self.fill, self.room
        out = np.array([self.sizes[i] for i in self.bins[a]], np.int64)
        two = (out[:, None] + out)[np.triu_indices(len(out), 1)]
        #: By the number of items back and a size: the largest size at most that, which a can give for them.
        most = np.zeros((3, room + 1), np.int64)
        most[:, out] = out
        most[1, two[two <= room]] = two[two <= room]
        most = np.maximum.accumulate(most, axis=1)
        size, of, count = self.size, self.bin, self.count
        if since >= 0:
            new = np.flatnonzero(self.changed[of] > since)
            size, of, count = size[new], of[new], count[new]
        full = fill[of]
        give = most[count, np.minimum(size + room - full, room)]
        ok = (give > size + np.maximum(fill[a] - full, 0)) & (of != a)
        if not ok.any():
            return None
        at = np.flatnonzero(ok)
        at = at[full[at] == full[at].max()]
        k = at[np.lexsort((count[at], size[at] - give[at]))[0]]
        return int(of[k]), int(give[k]), int(size[k])

    def picked(self, b: int, size: int) -> list[int]:
        """No items, an item or two items of bin b of that size in all."""
        if not size:
            return []
        seen: dict[int, int] = {}
        for i in self.bins[b]:
            if self.sizes[i] == size:
                return [i]
        for i in self.bins[b]:
            if size - self.sizes[i] in seen:
                return [seen[size - self.sizes[i]], i]
            seen[self.sizes[i]] = i
        raise AssertionError(size)

    def exchange(self, a: int, b: int, give: int, back: int) -> None:
        out, into = self.picked(a, give), self.picked(b, back)
        self.bins[a] = [i for i in self.bins[a] if i not in out] + into
        self.bins[b] = [i for i in self.bins[b] if i not in into] + out
        self.step += 1
        kept = (self.bin != a) & (self.bin != b)
        fresh = []
        for x, d in ((a, back - give), (b, give - back)):
            self.fill[x] += d
            self.changed[x] = self.step
            if 0 < self.fill[x] < self.room:
                fresh.append(self.backs(x))
        parts = zip((self.size, self.bin, self.count), zip(*fresh, strict=True) if fresh else ((), (), ()), strict=True)
        self.size, self.bin, self.count = (np.concatenate([x[kept], *y]) for x, y in parts)


def local_search(bins: list[list[int]], sizes: list[int], room: int) -> list[list[int]]:
    """Empties bins by exchanges that raise the sum of squared fills, emptiest bins first. It ends when no exchange of
    two underfull bins raises it, or at the least possible number of bins; a bin without one is tried again with the bins that have changed since."""
    state = Bins(bins, sizes, room)
    fill, changed = state.fill, state.changed
    least = -(-int(fill[:-1].sum()) // room)
    live = len(bins)
    tried = np.full(len(bins), -1)
    while live > least:
        before = state.step
        for a in np.argsort(fill[:-1], kind="stable").tolist():
            while live > least and 0 < fill[a] < room and tried[a] < state.step:
                got = state.best(a, -1 if changed[a] > tried[a] else int(tried[a]))
                if got is None:
                    tried[a] = state.step
                else:
                    state.exchange(a, *got)
                    live -= not fill[a]
        if state.step == before:
            break
    return [b for b in state.bins if b]


def pack(docs: DataFrame, room: int = 1024, end_id: int = 2, path: str | None = None, shard_docs: int = SHARD_DOCS, with_ids: bool = False) -> DataFrame:
    """One row per piece of each row of docs(doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and with with_ids the piece's ids.

    A null or empty text is the end id alone. A null doc_id is kept; repeated rows are documents of their own.
    Places of equal pieces follow the row's number. Other columns are ignored; without rows there are none.
    """
    path = path or tokens.default_path()
    shards = max(1, -(-docs.count() // shard_docs))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens.load(path)
        for b in batches:
            at, piece, start, length, crc, ids_of = [], [], [], [], [], []
            for k, body in enumerate(b.column("body").to_pylist()):
                ids = np.append(tok.ids(body.decode("utf-8", "replace")), np.uint32(end_id)).astype("<u4")
                first = len(ids) % room or room
                for p, s in enumerate([0, *range(first, len(ids), room)]):
                    part = ids[s : first if p == 0 else s + room]
                    at.append(k)
                    piece.append(p)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids_of.append(part.astype(np.int32))
            at = pa.array(at, pa.int32())
            out = {"doc_id": b.column("doc_id").take(at), "rid": b.column("rid").take(at), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(ids_of, pa.list_(pa.int32()))} if with_ids else {}))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rid", "piece"], ignore_index=True)
        sizes = pdf["length"].tolist()
        loose = [i for i, n in enumerate(sizes) if n < room]
        few = [sizes[i] for i in loose]
        bins = [[loose[i] for i in b] for b in local_search(best_fit(few, room), few, room)]
        bins += [[i] for i, n in enumerate(sizes) if n >= room]
        seq, off = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for s, b in enumerate(sorted(bins)):
            at = 0
            for i in b:
                seq[i], off[i] = s, at
                at += sizes[i]
        shard = pdf["shard"].iloc[0] if len(pdf) else 0
        return pdf.drop(columns=["shard"]).assign(sequence_id=(int(shard) << 32) + seq, offset=off)

    own = "doc_id long, rid long, piece int, start long, length long, ids_crc32 long"
    rows = id_text(docs).withColumn("rid", F.monotonically_increasing_id()).mapInArrow(cut, own + (", ids array<int>" if with_ids else ""))
    if with_ids:  # a shard places pieces by their lengths; the ids themselves don't go into its one task
        rows = stored(rows, "pieces")
    dealt = rows.drop("ids").withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)))
    placed = dealt.groupBy("shard").applyInPandas(place, own + ", sequence_id long, offset long")
    return (placed.join(rows.select("rid", "piece", "ids"), ["rid", "piece"]) if with_ids else placed).drop("rid")
