"""Edit-aware token counts: a segment tree over each document's pre-tokens.

The tree's leaves are runs of pre-tokens with their character and token sums, inner nodes hold sums. An edit
descends by characters, re-encodes from two pre-tokens before it until a pre-token boundary meets an old one
(from there the old encoding holds: the pattern looks ahead only), and updates the sums on the leaves' paths.
Trees are kept as rows: the characters and tokens of each leaf beside the text. A kept tree splits only the leaves
that an edit comes to, and a text without edits isn't split again at all.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm import tokens
from textmill.llm.util import id_text

#: Pre-tokens in a leaf of a new tree.
LEAF = 32
#: Pre-tokens before an edit that are split again with it.
BACK = 2


class TokenTree:
    """Text with token sums. Edits are (start, end, new text) in characters of the text as it stands."""

    def __init__(self, text: str, tok: tokens.Tokens) -> None:
        self.tok, self.reencoded = tok, 0
        self._build(tok.split(text))

    @classmethod
    def kept(cls, text: str, chars: list[int], sums: list[int], tok: tokens.Tokens) -> TokenTree:
        """A tree from its text and its leaves' characters and tokens; a leaf is split when an edit needs it."""
        tree = cls.__new__(cls)
        tree.tok, tree.reencoded = tok, 0
        ends = list(itertools.accumulate(chars))
        tree._sum([text[a:b] for a, b in zip([0, *ends], ends, strict=False)] or [[]], chars or [0], sums or [0])
        return tree

    def rows(self) -> tuple[list[int], list[int]]:
        """What kept() takes beside the text."""
        at = slice(self.base, self.base + len(self.leaves))
        return self.chars[at], self.sums[at]

    def _pieces(self, k: int) -> list[str]:
        """A leaf's pre-tokens. The spaces after it and one more character go into the split, since a run of spaces
        looks that far."""
        leaf = self.leaves[k]
        if isinstance(leaf, str):
            ahead, j = "", k + 1
            while j < len(self.leaves) and not ahead.strip():
                ahead, j = ahead + "".join(self.leaves[j]), j + 1
            ahead = ahead[: len(ahead) - len(ahead.lstrip()) + 1]
            pieces, at = self.tok.split(leaf + ahead), 0
            self.leaves[k] = []
            for p in pieces:
                if at < len(leaf):
                    self.leaves[k].append(p)
                at += len(p)
        return self.leaves[k]

    def _build(self, pieces: list[str]) -> None:
        leaves = [pieces[k : k + LEAF] for k in range(0, len(pieces), LEAF)] or [[]]
        self._sum(leaves, [sum(map(len, x)) for x in leaves], [sum(map(self.tok.size, x)) for x in leaves])

    def _sum(self, leaves: list, chars: list[int], sums: list[int]) -> None:
        self.leaves: list[list[str] | str] = leaves
        self.base = 1 << (len(leaves) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.base), [0] * (2 * self.base)
        self.chars[self.base : self.base + len(leaves)], self.sums[self.base : self.base + len(leaves)] = chars, sums
        for v in range(self.base - 1, 0, -1):
            self.chars[v], self.sums[v] = self.chars[2 * v] + self.chars[2 * v + 1], self.sums[2 * v] + self.sums[2 * v + 1]

    @property
    def count(self) -> int:
        return self.sums[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(map("".join, self.leaves))

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf with character `at` (the last leaf if beyond) and the characters before it."""
        v, before = 1, 0
        while v < self.base:
            v *= 2
            if before + self.chars[v] <= at and self.chars[v + 1]:
                before, v = before + self.chars[v], v + 1
        return v - self.base, before

    def _put(self, k: int, leaf: list[str]) -> None:
        v = self.base + k
        self.leaves[k] = leaf
        dc, ds = sum(map(len, leaf)) - self.chars[v], sum(map(self.tok.size, leaf)) - self.sums[v]
        while v:
            self.chars[v], self.sums[v] = self.chars[v] + dc, self.sums[v] + ds
            v //= 2

    def edit(self, start: int, end: int, new: str) -> None:
        start = min(max(0, start), self.length)
        end = min(max(start, end), self.length)
        first, before = self._find(max(0, start - 1))
        starts, at = [], before  # pre-token starts of the leaf up to the edit
        for p in self._pieces(first):
            if at >= start:
                break
            starts.append(at)
            at += len(p)
        while len(starts) <= BACK and first > 0:  # context from the leaves before
            first -= 1
            before -= self.chars[self.base + first]
            at, more = before, []
            for p in self._pieces(first):
                more.append(at)
                at += len(p)
            starts = more + starts
        origin = starts[-1 - BACK] if len(starts) > BACK else before
        last, tail = self._find(end)
        middle = last
        kept, at = [], before
        for p in (p for k in range(first, last + 1) for p in self._pieces(k)):
            if at >= origin:
                break
            kept.append(p)
            at += len(p)
        # Old pre-token ends from the edit's end on, leaf by leaf, and the text to split again.
        old = "".join("".join(x) for x in self.leaves[first : last + 1])
        left, right = old[origin - before : start - before], old[end - before :]
        ends, at = [], tail
        for p in self._pieces(last):
            ends.append(at - end)
            at += len(p)
        ends.append(at - end)
        while True:
            text = left + new + right
            from_new = len(left) + len(new)
            goals = {from_new + e for e in ends if e >= 0}
            done, pos, pieces = None, 0, []
            whole = last == len(self.leaves) - 1
            split = (self.tok.any if tokens.NOT_PLAIN.search(text) else tokens.PLAIN).finditer(text)
            for m in split:
                # A match that touches the end of a part of the text may go on in what follows, and a run of
                # spaces looks one character further.
                if not whole and m.end() >= len(text) - 1:
                    break
                pieces.append(m[0])
                pos = m.end()
                if pos in goals and pos >= from_new:
                    done = pos
                    break
            if done is not None or whole:
                break
            last += 1
            at = tail = tail + self.chars[self.base + last - 1]
            right += "".join(self.leaves[last])
            ends.append(at - end)
            for p in self._pieces(last):
                at += len(p)
                ends.append(at - end)
        self.reencoded += len(pieces)
        rest, skip = [], (done if done is not None else len(text)) - from_new
        at = self._start(middle) - end
        for p in (p for k in range(middle, last + 1) for p in self._pieces(k)):
            if at >= skip:
                rest.append(p)
            at += len(p)
        if last == first:
            self._put(first, kept + pieces + rest)
        else:
            self._put(first, kept + pieces)
            for k in range(first + 1, last):
                self._put(k, [])
            self._put(last, rest)
        if len(self.leaves[first]) > 8 * LEAF:
            self._build([p for k in range(len(self.leaves)) for p in self._pieces(k)])

    def _start(self, k: int) -> int:
        v, before = self.base + k, 0
        while v > 1:
            if v & 1:
                before += self.chars[v - 1]
            v //= 2
        return before


#: Runs that the default edits mask: e-mail addresses, and digits with their separators.
PRIVATE = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+?\d[\d() .-]{5,}\d")


def mask_private(text: str) -> list[tuple[int, int, str]]:
    """Edits, from the text's end to its start, so that none moves the next."""
    return [(m.start(), m.end(), "[private]") for m in reversed(list(PRIVATE.finditer(text)))]


def trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, body (the text as UTF-8), leaf_chars, leaf_tokens, n_pieces (pre-tokens) for each row of docs(doc_id,
    text): the segment tree of each document as a row, to be stored. A null text counts as empty, of one empty leaf;
    a null doc_id is kept; repeated rows each get a row; other columns are ignored."""
    path = path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens.load(path)
        for b in batches:
            chars, sums, pieces = [], [], []
            for body in b.column("body").to_pylist():
                tree = TokenTree(body.decode("utf-8", "replace"), tok)
                for to, x in zip((chars, sums), tree.rows(), strict=True):
                    to.append(x)
                pieces.append(sum(map(len, tree.leaves)))
            counts = pa.list_(pa.int32())
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "body": b.column("body"), "leaf_chars": pa.array(chars, counts), "leaf_tokens": pa.array(sums, counts), "n_pieces": pa.array(pieces, pa.int64())})

    return id_text(docs).mapInArrow(run, "doc_id long, body binary, leaf_chars array<int>, leaf_tokens array<int>, n_pieces long")


def edited_counts(kept: DataFrame, edits_of: Callable[[str], list[tuple[int, int, str]]] = mask_private, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_edited, n_pieces, n_reencoded for each row of trees().

    edits_of gives a text's edits in the order to apply them, to the kept tree. n_pieces: pre-tokens before the edits;
    n_reencoded: those split again for the edits.
    """
    path = path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens.load(path)
        for b in batches:
            rows = []
            for body, chars, sums in zip(*(b.column(c).to_pylist() for c in ("body", "leaf_chars", "leaf_tokens")), strict=True):
                text, n = body.decode("utf-8", "replace"), sum(sums)
                edits = edits_of(text)
                if not edits:
                    rows.append((n, 0, n, 0))
                    continue
                tree = TokenTree.kept(text, chars, sums, tok)
                for e in edits:
                    tree.edit(*e)
                rows.append((n, len(edits), tree.count, tree.reencoded))
            names = ("n_tokens", "n_edits", "n_tokens_edited", "n_reencoded")
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_pieces": b.column("n_pieces")} | {k: pa.array([r[i] for r in rows], pa.int64()) for i, k in enumerate(names)})

    got = kept.mapInArrow(run, "doc_id long, n_pieces long, n_tokens long, n_edits long, n_tokens_edited long, n_reencoded long")
    return got.select("doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_pieces", "n_reencoded")
