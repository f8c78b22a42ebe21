"""TIFF media columns: write multi-page greyscale TIFF (8-bit samples), read TIFF into one row per page.

The reader walks the chain of image directories, decodes PackBits, LZW or deflate strips and tiles, undoes the
horizontal predictor and gives one row per page. Either byte order is read, and 1, 4, 8 or 16 bits a sample with any
number of samples a pixel, side by side. A page that can't be read has an error; the other pages of its file stay.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm.util import bounded_batches, id_text

# Fixed values of the TIFF 6.0 format: compression schemes, tags, bytes of a field type.
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, STRIP_ROWS, STRIP_COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 284, 317, 322, 323, 324, 325
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8}
LINE = 576
#: No scheme gives more bytes than this for each byte of a file: a page that claims more is refused before it is made.
LARGEST = 4096


def packbits(data: bytes) -> bytes:
    out, at, n = bytearray(), 0, len(data)
    while at < n:
        run = 1
        while run < 128 and at + run < n and data[at + run] == data[at]:
            run += 1
        if run > 1:
            out += bytes((257 - run, data[at]))
            at += run
            continue
        end = at + 1
        while end < n and end - at < 128 and not (end + 1 < n and data[end] == data[end + 1]):
            end += 1
        out.append(end - at - 1)
        out += data[at:end]
        at = end
    return bytes(out)


def unpackbits(data: bytes, most: int) -> bytes:
    """Up to `most` bytes."""
    out, at = bytearray(), 0
    while at < len(data) and len(out) < most:
        k = data[at]
        if k < 128:
            out += data[at + 1 : at + 2 + k]
            at += k + 2
        else:
            if k > 128:
                out += data[at + 1 : at + 2] * (257 - k)
            at += 1 + (k > 128)
    return bytes(out[:most])


def lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bit first, widened one code early; 256 clears the table, 257 ends."""
    acc, size, out = 0, 0, bytearray()

    def put(code: int, width: int) -> None:
        nonlocal acc, size
        acc, size = acc << width | code, size + width
        while size >= 8:
            size -= 8
            out.append(acc >> size & 255)
        acc &= (1 << size) - 1

    table, free, width, now = {bytes((i,)): i for i in range(256)}, 258, 9, b""
    put(256, 9)
    for i in data:
        longer = now + bytes((i,))
        if longer in table:
            now = longer
            continue
        put(table[now], width)
        table[longer] = free
        free += 1
        if free == 1 << width and width < 12:
            width += 1
        elif free == 4094:
            put(256, width)
            table, free, width = {bytes((j,)): j for j in range(256)}, 258, 9
        now = bytes((i,))
    if now:
        put(table[now], width)
        free += 1
        if free == 1 << width and width < 12:
            width += 1
    put(257, width)
    if size:
        out.append(acc << (8 - size) & 255)
    return bytes(out)


def unlzw(data: bytes, most: int) -> bytes:
    """Up to `most` bytes. A code that no earlier ones explain raises ValueError."""
    out, acc, size, width = bytearray(), 0, 0, 9
    table, last = [bytes((i,)) for i in range(256)] + [b"", b""], b""
    for byte in data:
        acc, size = acc << 8 | byte, size + 8
        if size < width:
            continue
        if len(out) >= most:
            break
        size -= width
        code, acc = acc >> size, acc & ((1 << size) - 1)
        if code == 257:
            break
        if code == 256:
            table, last, width = [bytes((i,)) for i in range(256)] + [b"", b""], b"", 9
            continue
        if code > len(table) or code == len(table) and not last:
            raise ValueError("bad LZW code")
        got = table[code] if code < len(table) else last + last[:1]
        if last and len(table) < 4096:
            table.append(last + got[:1])
        out += got
        last = got
        width = 9 + (len(table) >= 511) + (len(table) >= 1023) + (len(table) >= 2047)
    return bytes(out[:most])


def inflate(data: bytes, most: int) -> bytes:
    return zlib.decompressobj().decompress(data, most) if most else b""


SQUEEZE = {NONE: bytes, PACKBITS: packbits, LZW: lzw, DEFLATE: lambda x: zlib.compress(x, 2)}
EXPAND = {NONE: lambda x, most: x[:most], PACKBITS: unpackbits, LZW: unlzw, DEFLATE: inflate, OLD_DEFLATE: inflate}


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 2, strip_rows: int = 256, tile: int = 0, big: bool = False) -> bytes:
    """pages: arrays (height, width) of uint8. tile > 0, a multiple of 16: square tiles in place of strips; big: the other byte order."""
    order = ">" if big else "<"
    out = bytearray((b"MM\0*" if big else b"II*\0") + b"\0\0\0\0")
    link = 4
    for page in pages:
        height, width = page.shape
        if tile:
            full = np.zeros((-(-height // tile) * tile, -(-width // tile) * tile), np.uint8)
            full[:height, :width] = page
            parts = [full[y : y + tile, x : x + tile] for y in range(0, full.shape[0], tile) for x in range(0, full.shape[1], tile)]
        else:
            parts = [page[y : y + strip_rows] for y in range(0, height, strip_rows)]
        at, sizes = [], []
        for p in parts:
            p = np.concatenate([p[:, :1], np.diff(p, axis=1)], axis=1) if predictor == 2 else p
            if compression == PACKBITS:
                data = b"".join(packbits(row.tobytes()) for row in p)
            else:
                data = SQUEEZE[compression](np.ascontiguousarray(p).tobytes())
            at.append(len(out))
            sizes.append(len(data))
            out += data + b"\0" * (len(data) % 2)
        tags = [(WIDTH, [width]), (HEIGHT, [height]), (BITS, [8]), (COMPRESSION, [compression]), (PHOTOMETRIC, [1]), (SAMPLES, [1]), (PREDICTOR, [predictor])]
        tags += [(TILE_WIDTH, [tile]), (TILE_HEIGHT, [tile]), (TILE_OFFSETS, at), (TILE_COUNTS, sizes)] if tile else [(STRIP_OFFSETS, at), (STRIP_ROWS, [strip_rows]), (STRIP_COUNTS, sizes)]
        entries = b""
        for tag, values in sorted(tags):
            packed = struct.pack(f"{order}{len(values)}I", *values)
            if len(packed) > 4:
                entries += struct.pack(order + "HHII", tag, 4, len(values), len(out))
                out += packed
            else:
                entries += struct.pack(order + "HHI", tag, 4, len(values)) + packed
        struct.pack_into(order + "I", out, link, len(out))
        link = len(out) + 2 + len(entries)
        out += struct.pack(order + "H", len(tags)) + entries + b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes) -> Iterator[tuple[str, dict]]:
    """Byte order and tags of each image directory along the chain; one that comes again ends it. Raises ValueError or
    struct.error where the file isn't a TIFF or the chain leads out of it."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if not order:
        raise ValueError("not a TIFF")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at and at not in seen:
        seen.add(at)
        tags = {}
        n = struct.unpack_from(order + "H", data, at)[0]
        for e in range(at + 2, at + 2 + 12 * n, 12):
            tag, kind, count = struct.unpack_from(order + "HHI", data, e)
            size = count * TYPE_BYTES.get(kind, 0)
            where = e + 8 if size <= 4 else struct.unpack_from(order + "I", data, e + 8)[0]
            if kind in (1, 3, 4) and 0 < size <= len(data) - where:
                tags[tag] = struct.unpack_from(f"{order}{count}{'xBxHI'[kind]}", data, where)
        yield order, tags
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


def image(data: bytes, order: str, tags: dict) -> np.ndarray:
    """The samples of a directory's page: (height, width) or (height, width, samples) of uint8, or uint16 for 16 bits.
    Raises ValueError where it is of another kind or doesn't hold what it says."""
    one = lambda tag, default=0: tags.get(tag, (default,))[0]
    width, height, bits, each, expand = one(WIDTH), one(HEIGHT), one(BITS, 1), one(SAMPLES, 1), EXPAND.get(one(COMPRESSION, NONE))
    if not expand or bits not in (1, 4, 8, 16) or set(tags.get(BITS, (1,))) != {bits} or each > 1 and one(PLANAR, 1) != 1 or one(PREDICTOR, 1) not in (1, 2) or one(PREDICTOR, 1) == 2 and bits < 8:
        raise ValueError("unsupported kind of page")
    tiled = TILE_OFFSETS in tags
    w, h = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(STRIP_ROWS, height), height))
    starts, sizes = (tags.get(t, ()) for t in ((TILE_OFFSETS, TILE_COUNTS) if tiled else (STRIP_OFFSETS, STRIP_COUNTS)))
    if min(width, height, each, w, h) < 1 or max(w * h, width * height) * each * bits > 8 * LARGEST * len(data):
        raise ValueError("page without samples, or larger than its file can hold")
    across, down = -(-width // w), -(-height // h)
    if not len(starts) == len(sizes) == across * down:
        raise ValueError("strips or tiles are missing")
    line = -(-w * each * bits // 8)
    page = np.zeros((height, width, each), np.uint16 if bits == 16 else np.uint8)
    for k, (start, size) in enumerate(zip(starts, sizes, strict=True)):
        y, x = k // across * h, k % across * w
        rows = h if tiled else min(h, height - y)
        part = expand(data[start : start + size], rows * line)
        if len(part) < rows * line:
            raise ValueError("strip or tile is too short")
        part = np.frombuffer(part, np.uint8)
        if bits == 16:
            part = part.view(order + "u2")
        elif bits < 8:
            part = np.unpackbits(part).reshape(-1, bits) @ (1 << np.arange(bits)[::-1]).astype(np.uint8)
        part = part.reshape(rows, -1)[:, : w * each].reshape(rows, w, each)
        if one(PREDICTOR, 1) == 2:
            part = np.cumsum(part, axis=1, dtype=page.dtype)
        page[y : y + h, x : x + w] = part[: height - y, : width - x]
    return page[:, :, 0] if each == 1 else page


def read_tiff(data: bytes) -> Iterator[np.ndarray | str]:
    """The pages of a TIFF in order; in place of a page that can't be read, or of the rest of a broken chain, what is
    wrong. Any bytes are taken; a file without pages gives one such text."""
    n = 0
    try:
        for order, tags in directories(data):
            n += 1
            try:
                yield image(data, order, tags)
            except (ValueError, zlib.error) as e:
                yield str(e)
        if not n:
            yield "no page"
    except (ValueError, struct.error) as e:
        yield str(e)


def stored_image(image: np.ndarray, page_rows: int) -> bytes:
    """A scheme by the number of lines, so that equal images are equal files: one line LZW, two PackBits, odd numbers
    the other byte order, long ones tiles."""
    lines = len(image)
    pages = [image[y : y + page_rows] for y in range(0, lines, page_rows)]
    kind = {1: LZW, 2: PACKBITS}.get(lines, DEFLATE)
    return write_tiff(pages, kind, 1 if kind == PACKBITS else 2, 32, 64 if lines >= 64 else 0, lines % 2 == 1)


def to_media(docs: DataFrame, page_rows: int = 128) -> DataFrame:
    """doc_id, n_bytes, media: each text's UTF-8 bytes (null: empty), padded with 255 to lines of 576 samples, as a
    TIFF of pages of at most page_rows lines. Equal texts give equal files; other columns are ignored."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, media = [], []
            for body in b.column("body").to_pylist():
                lines = max(1, -(-len(body) // LINE))
                flat = np.full(lines * LINE, 255, np.uint8)
                flat[: len(body)] = np.frombuffer(body, np.uint8)
                n.append(len(body))
                media.append(stored_image(flat.reshape(lines, LINE), page_rows))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_bytes": pa.array(n, pa.int64()), "media": pa.array(media, pa.binary())})

    return id_text(docs).mapInArrow(write, "doc_id long, n_bytes long, media binary")


PAGE = {"page": "int", "width": "int", "height": "int", "bands": "int", "mean": "double", "spread": "double", "levels": "int", "samples": "binary", "error": "string"}


def page_row(number: int, page: np.ndarray | str) -> tuple:
    if isinstance(page, str):
        return number, None, None, None, None, None, None, None, page
    bands = page.shape[2] if page.ndim == 3 else 1
    return number, page.shape[1], page.shape[0], bands, float(page.mean()), float(page.std()), int(np.count_nonzero(np.bincount(page.ravel(), minlength=256))), page.tobytes(), None


def read_pages(media: DataFrame, column: str = "media") -> DataFrame:
    """One row per page of the TIFF in `column`, in order, with the row's own columns (the file itself only on its
    first page, else long files would be copied for each page) and page (from 0), width, height, bands, mean, spread, levels (distinct samples), samples (16-bit ones little-endian), error.

    A page that can't be read has only page and error; a null or any other bytes that aren't a TIFF have one such row,
    of page 0. Own columns of these names give way to the page's. Pages of a row stay next to each other, without a
    shuffle; repeated rows each get their pages.
    """
    bounded_batches(media.sparkSession)
    own = [f for f in media.schema if f.name not in PAGE]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for k, data in enumerate(b.column(column).to_pylist()):
                for number, page in enumerate(read_tiff(data or b"")):
                    at.append(k)
                    rows.append(page_row(number, page))
            kinds = {"int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string()}
            first = pa.array([k if r[0] == 0 else None for k, r in zip(at, rows, strict=True)], pa.int32())
            columns = {f.name: b.column(f.name).take(first if f.name == column else pa.array(at, pa.int32())) for f in own}
            columns |= {name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(PAGE.items())}
            yield pa.RecordBatch.from_pydict(columns)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in own]
    return media.mapInArrow(read, ", ".join(fields + [f"{name} {kind}" for name, kind in PAGE.items()]))


def digests(pages: DataFrame) -> DataFrame:
    """Pages of read_pages(to_media) -> doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature: one row per file, from its pages in turn. Page 0 begins a file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        for b in batches:
            done = []
            for r in b.to_pylist():
                if r["page"] == 0:
                    done += [now] if now else []
                    now = {"row": r, "size": 0, "sha": hashlib.sha256(), "tail": b"", "feature": []}
                data = r["samples"] or b""
                now["size"] += len(data)
                now["sha"].update(data)
                now["tail"] = (now["tail"] + data)[-32:]
                now["feature"].append(r["error"] or f"{r['width']},{r['height']},{r['mean']:.4f},{r['spread']:.4f},{r['levels']}")
            yield table(done)
        yield table([now] if now else [])

    def table(done: list[dict]) -> pa.RecordBatch:
        media = [x["row"]["media"] or b"" for x in done]
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([x["row"]["doc_id"] for x in done], pa.int64()), "n_bytes": pa.array([x["row"]["n_bytes"] for x in done], pa.int64()),
            "payload_bytes": pa.array([x["size"] for x in done], pa.int64()), "payload_sha256": pa.array([x["sha"].hexdigest() for x in done], pa.string()),
            "tail_crc32": pa.array([zlib.crc32(x["tail"]) for x in done], pa.int64()), "media_bytes": pa.array([len(x) for x in media], pa.int64()),
            "media_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in media], pa.string()), "feature": pa.array([" ".join(x["feature"]) for x in done], pa.string()),
        })

    kind = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return pages.mapInArrow(run, kind)
