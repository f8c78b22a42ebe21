"""Quality classifier: a generalised additive model with pairwise interactions.

Surface features of each whole text are computed once and stored. Shallow trees over feature bins, boosted in
turn over the features and then over the best pairs, are summed into one lookup table per feature and pair;
scoring adds up table entries. The fit takes at most `fit_rows` labelled rows, in hash order of their ids.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.util import fold, id_text, stored

#: Most labelled rows that a fit takes; a bound on the driver's memory only.
FIT_ROWS = 20_000
THRESHOLD = 0.7
FEATURES = ("size", "letters", "upper", "digits", "spaces", "marks", "odd", "high", "top_byte", "words", "word_len", "distinct", "top_word", "echo", "marked_words", "line_repeat", "line_len", "title_words", "stops", "long_words")
ODD = np.frombuffer(b"#$%&*|<>{}[]=+~^_\\/@!?", np.uint8)
MARKS = np.frombuffer(b".,;:-'\"()", np.uint8)
ODD_ENDS = (b"#", b"$", b"%", b"&", b"*", b"!", b"|", b"=", b">", b"]", b"}", b"~", b"_", b"@")


def features(body: bytes) -> list[float]:
    """Of the whole text, as UTF-8. An empty text has zeros."""
    n = len(body)
    if not n:
        return [0.0] * len(FEATURES)
    by = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    words = body.split()
    w = max(1, len(words))
    each: dict[bytes, int] = {}
    for x in words:
        each[x] = each.get(x, 0) + 1
    lines = [x for x in body.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    return [
        np.log1p(n), (by[65:91].sum() + by[97:123].sum()) / n, by[65:91].sum() / n, by[48:58].sum() / n, (by[9:14].sum() + by[32]) / n, by[MARKS].sum() / n, by[ODD].sum() / n, by[128:].sum() / n,
        np.delete(by, 32).max() / n, np.log1p(len(words)), sum(map(len, words)) / w, len(each) / w, max(each.values(), default=0) / w, sum(map(bytes.__eq__, words, words[1:])) / w,
        sum(c for x, c in each.items() if x.endswith(ODD_ENDS)) / w, 1 - len(set(lines)) / k, np.log1p(n / k), sum(c for x, c in each.items() if x[:1].isupper()) / w,
        body.count(b". ") / w, sum(c for x, c in each.items() if len(x) > 12) / w,
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(body) for body in b.column("body").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "x": pa.array(x, pa.list_(pa.float64()))})

    return id_text(docs).mapInArrow(run, "doc_id long, x array<double>")


def cuts(gain: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over ordered bins: greedily splits the range with the best gain; gives each bin its leaf's value."""
    g, h = np.concatenate([[0], np.cumsum(gain)]), np.concatenate([[0], np.cumsum(weight)])
    ends, out = [(0, len(gain))], np.zeros(len(gain))
    least = min(20.0, max(2.0, 0.03 * h[-1]))  # weight of a leaf
    value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1)
    while len(ends) < leaves:
        best = (1e-6, None)
        for a, b in ends:
            if b - a < 2:
                continue
            c = np.arange(a + 1, b)
            score = np.where((h[c] - h[a] >= least) & (h[b] - h[c] >= least), value(a, c) + value(c, b) - value(a, b), 0)
            k = int(score.argmax())
            best = max(best, (score[k], (a, int(c[k]), b)), key=lambda x: x[0])
        if not best[1]:
            break
        a, c, b = best[1]
        ends.remove((a, b))
        ends += [(a, c), (c, b)]
    for a, b in ends:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1)
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, rate: float = 0.15, pairs: int = 6, pair_bins: int = 8) -> dict:
    """Model of P(y = 1). Without rows, or with one class only, it gives the smoothed share of 1."""
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    model = {"base": float(np.log(share / (1 - share))), "edges": edges, "tables": [np.zeros(len(e) + 1) for e in edges], "pairs": []}
    if not n or y.min() == y.max():
        return model
    at = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]
    s = np.full(n, model["base"])
    slope = lambda: (y - (p := 1 / (1 + np.exp(-s))), np.maximum(p * (1 - p), 1e-6))

    def boost(spots: list[np.ndarray], tables: list[np.ndarray], trees) -> None:
        nonlocal s
        for _ in range(rounds):
            for spot, table, tree in zip(spots, tables, trees, strict=True):
                g, h = slope()
                step = rate * tree(np.bincount(spot, g, table.size), np.bincount(spot, h, table.size))
                table += step.reshape(table.shape)
                s = s + step[spot]

    boost(at, model["tables"], [lambda g, h: cuts(g, h, 4)] * width)

    coarse = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, pair_bins + 1)[1:-1])) for f in range(width)]
    spot = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(coarse)]

    def crossed(shape: tuple[int, int]):
        """One cut on each of the two features, a value for each quadrant."""
        def tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
            a, b = g.reshape(shape).cumsum(0).cumsum(1), h.reshape(shape).cumsum(0).cumsum(1)
            best, out = 0.0, np.zeros(shape)
            for i, j in itertools.product(range(shape[0] - 1), range(shape[1] - 1)):
                q = [(a[i, j], b[i, j]), (a[i, -1] - a[i, j], b[i, -1] - b[i, j]), (a[-1, j] - a[i, j], b[-1, j] - b[i, j])]
                q.append((a[-1, -1] - sum(z[0] for z in q), b[-1, -1] - sum(z[1] for z in q)))
                if (gain := sum(z[0] ** 2 / (z[1] + 5) for z in q)) > best:
                    best, v = gain, [z[0] / (z[1] + 5) for z in q]
                    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
            return out.ravel()

        return tree

    g, h = slope()
    found = []
    for i, j in itertools.combinations(range(width), 2):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        k = spot[i] * shape[1] + spot[j]
        a, b = np.bincount(k, g, shape[0] * shape[1]), np.bincount(k, h, shape[0] * shape[1])
        found.append(((a**2 / (b + 5)).sum(), i, j, shape, k))
    found = sorted(found, key=lambda z: (-z[0], z[1], z[2]))[:pairs]
    tables = [np.zeros(z[3]) for z in found]
    rounds //= 5
    boost([z[4] for z in found], tables, [crossed(z[3]) for z in found])
    model["pairs"] = [(z[1], z[2], coarse[z[1]], coarse[z[2]], t) for z, t in zip(found, tables, strict=True)]
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    s = np.full(len(x), model["base"])
    for f, (e, t) in enumerate(zip(model["edges"], model["tables"], strict=True)):
        s += t[np.searchsorted(e, x[:, f], side="left")]
    for i, j, a, b, t in model["pairs"]:
        s += t[np.searchsorted(a, x[:, i], side="left"), np.searchsorted(b, x[:, j], side="left")]
    return 1 / (1 + np.exp(-s))


def known_labels(labels: DataFrame, fit_rows: int) -> DataFrame:
    """doc_id, y: at most fit_rows labelled rows outside the held-out fold, in hash order of their ids."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).where("doc_id is not null and y is not null")
    return known.where(fold(F.col("doc_id"), 4) != 2).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(fit_rows)


def learned(rows: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """The model of rows(doc_id, y, x)."""
    got = rows.select("doc_id", "y", "x").orderBy("doc_id", "y").limit(fit_rows).toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, (got["y"].to_numpy() == 1).astype(float))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs(doc_id, text); labels(doc_id, quality).

    Labels of rows whose fold of 4 is 2, or with null id or quality, aren't used. A null text counts as empty;
    repeated rows each get a row; without labels the score is 0.5. Other columns are ignored.
    """
    rows = stored(feature_table(docs.select("doc_id", "text")), "features")
    held = docs.sparkSession.sparkContext.broadcast(learned(rows.join(F.broadcast(known_labels(labels, fit_rows)), "doc_id"), fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column("x").flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "score": pa.array(predict(held.value, flat.reshape(-1, len(FEATURES))))})

    out = rows.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of docs, with all their columns, whose score is at least threshold; as score_quality, without a
    shuffle of texts: features are taken of the labelled sample for the fit, and of each row as it is scored."""
    sample = feature_table(docs.select("doc_id", "text").join(F.broadcast(known_labels(labels, fit_rows).select("doc_id").distinct()), "doc_id", "left_semi"))
    held = docs.sparkSession.sparkContext.broadcast(learned(sample.join(F.broadcast(known_labels(labels, fit_rows)), "doc_id"), fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features((t or "").encode()) for t in b.column("text").to_pylist()], float).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(predict(held.value, x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
