"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams per language come from all training rows in one pass: each worker adds its batches into
one matrix and hands on only the matrix. The log-probability matrix (languages x 2^bits, fixed size) is broadcast
and scores whole texts in batches: sparse n-gram counts times the matrix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.util import bounded_batches, fold, id_text

BITS = 15
#: Code points scored at a time: bounds memory for texts of any length.
CHUNK = 1 << 20
#: Texts of one sparse product.
TEXTS = 128


def grams(text: str, bits: int = BITS) -> Iterator[np.ndarray]:
    """Slots of the 1- to 3-grams of the lower-cased text."""
    text = text.lower()
    for at in range(0, len(text), CHUNK):
        c = np.frombuffer(text[max(0, at - 2) : at + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        one, fresh = c * np.uint32(0x9E3779B1), min(at, 2)
        two = (one[:-1] ^ (one[1:] >> np.uint32(7))) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (one[2:] >> np.uint32(11))) * np.uint32(0xC2B2AE35)
        for g, k in ((one, fresh), (two, max(0, fresh - 1)), (three, 0)):
            yield (g[k:] >> np.uint32(32 - bits)).astype(np.int64)


def counts(text: str, bits: int = BITS) -> np.ndarray:
    total = np.zeros(1 << bits, np.int64)
    for g in grams(text, bits):
        if len(g):
            total += np.bincount(g, minlength=1 << bits)
    return total


def train(docs: DataFrame, bits: int = BITS) -> dict:
    """Fit on all rows of docs(text, lang) with a language; the driver gets one vector per partition and language."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[str, list] = {}
        for b in batches:
            for body, lang in zip(b.column("body").to_pylist(), b.column("lang").to_pylist(), strict=True):
                x = by.setdefault(lang, [np.zeros(1 << bits, np.int64), 0])
                for g in grams(body.decode("utf-8", "replace"), bits):
                    np.add.at(x[0], g, 1) if len(g) < 1 << (bits - 3) else np.add(x[0], np.bincount(g, minlength=1 << bits), out=x[0])
                x[1] += 1
        slots = [(lang, i, int(x[0][i])) for lang, x in by.items() for i in np.flatnonzero(x[0])]
        slots += [(lang, -1, x[1]) for lang, x in by.items()]
        yield pa.RecordBatch.from_pydict({"lang": pa.array([s[0] for s in slots], pa.string()), "slot": pa.array([int(s[1]) for s in slots], pa.int32()), "n": pa.array([s[2] for s in slots], pa.int64())})

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("body"), "lang").where("lang is not null")
    got = rows.mapInArrow(add, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    table = np.zeros((1 << bits, max(1, len(langs))))
    prior = np.zeros(max(1, len(langs)))
    for j, lang in enumerate(langs):
        g = got[got["lang"] == lang]
        g, own = g[g["slot"] >= 0], g[g["slot"] < 0]
        table[g["slot"].to_numpy(), j] = g["n"].to_numpy()
        prior[j] = own["n"].sum()
    logp = np.log((table + 0.5) / (table.sum(0) + 0.5 * len(table)))
    return {"langs": langs, "logp": logp.astype(np.float32), "prior": np.log(np.maximum(prior, 1) / max(1, prior.sum()))}


def sparse(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' n-gram counts as rows of a sparse matrix: slots and counts of all rows, and where each row starts."""
    slot, n, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [0]
    for t in texts:
        c = counts(t, bits)
        slot.append(np.flatnonzero(c))
        n.append(c[slot[-1]])
        size.append(len(slot[-1]))
    return np.concatenate(slot), np.concatenate(n), np.cumsum(size)


def products(model: dict, texts: list[str], bits: int = BITS) -> np.ndarray:
    """Log prior and likelihood of each language for each text: the sparse counts times the dense matrix."""
    out = np.empty((len(texts), len(model["prior"])))
    for at in range(0, len(texts), TEXTS):
        slot, n, start = sparse(texts[at : at + TEXTS], bits)
        each = np.concatenate([np.zeros((1, out.shape[1])), np.cumsum(model["logp"][slot] * n[:, None], axis=0, dtype=np.float64)])
        out[at : at + TEXTS] = model["prior"] + each[start[1:]] - each[start[:-1]]
    return out


def identify(docs: DataFrame, model: dict, bits: int = BITS) -> DataFrame:
    """doc_id, lang_pred, score (posterior of lang_pred; 0 for `und`) for each row of docs(doc_id, text).

    A null text, one without a letter, or a model without languages gives `und`. Ties go to the first language
    in alphabetical order. Repeated rows each get a row; a null doc_id is kept; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            texts = [x.decode("utf-8", "replace") for x in b.column("body").to_pylist()]
            pred, prob = ["und"] * len(texts), np.zeros(len(texts))
            some = [k for k, t in enumerate(texts) if m["langs"] and any(map(str.isalpha, t))]
            if some:
                s = products(m, [texts[k] for k in some], bits)
                share = np.exp(s - s.max(1, keepdims=True))
                best = share.argmax(1)
                prob[some] = share[np.arange(len(some)), best] / share.sum(1)
                for k, j in zip(some, best.tolist(), strict=True):
                    pred[k] = m["langs"][j]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "lang_pred": pa.array(pred, pa.string()), "score": pa.array(prob, pa.float64())})

    return id_text(docs).mapInArrow(score, "doc_id long, lang_pred string, score double")


def language_report(docs: DataFrame) -> DataFrame:
    """Train on rows whose fold of 4 is not 2, predict every row; held_out marks the others."""
    model = train(docs.where(fold(F.col("doc_id"), 4) != 2).select("text", "lang"))
    return identify(docs, model).withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
