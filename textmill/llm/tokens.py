"""Byte-level BPE of a tokenizer file, loaded once in each worker process."""

from __future__ import annotations

import functools
import json
import re

import numpy as np

# The byte-level pre-token pattern of this kind of vocabulary, for texts of any characters and,
# with the same matches, for texts of printable ASCII, Latin-1 letters and Latin Extended-A.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ANY = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
PLAIN = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
NOT_PLAIN = re.compile(r"[^\n\r\t\x20-\x7eÀ-ſ]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 as itself, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


BYTE_OF = byte_of()


class Tokens:
    """ids(text) equals tokenizers' encode(text, add_special_tokens=False) with special strings as ordinary text."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        special = {t["content"] for t in spec.get("added_tokens", []) if t.get("special")}
        bytes_of, vocab = byte_of(), model.get("vocab", {})
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])]
        self.any = regex.compile(ANY)
        self.slow = self.fast = None
        plain = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        if plain and all(a < b for a, b in zip(merged, merged[1:], strict=False)):  # a merge's rank is its id: the same merges happen
            import tiktoken

            ranks = {bytes(map(bytes_of.__getitem__, k)): v for k, v in vocab.items() if k not in special}
            self.fast = tiktoken.Encoding("own", pat_str=ANY.replace(SPACE, r"\s"), mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(path)
            self.slow.encode_special_tokens = True
        self.names = {v: k for k, v in vocab.items()}
        self.id_bytes: np.ndarray | None = None
        self.sizes: dict[str, int] = {}

    def bytes_of(self, i: int) -> bytes:
        """The bytes that an id of a byte-level vocabulary stands for; other characters of its name as UTF-8."""
        return b"".join(bytes([BYTE_OF[c]]) if c in BYTE_OF else c.encode() for c in self.names.get(i, ""))

    def ids(self, text: str) -> np.ndarray:
        if self.fast:
            return np.array(self.fast.encode_to_numpy(text), np.uint32) if text else np.zeros(0, np.uint32)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def listed(self, text: str) -> list[int]:
        """ids as a list, which is quicker for short texts."""
        return self.fast.encode_ordinary(text) if self.fast else self.slow.encode(text, add_special_tokens=False).ids

    def apart(self, words: list[str]) -> list[bytes]:
        """The ids of each word, which starts with a space and has no other ASCII white space, as 32-bit numbers. All
        words are encoded as one text, since no id reaches over such a space, and cut apart by the ids' bytes."""
        if not self.fast:
            return [np.array(self.listed(w), "<u4").tobytes() for w in words]
        if self.id_bytes is None:
            self.id_bytes = np.array([len(self.bytes_of(i)) for i in range(max(self.names) + 1)], np.int64)
        text = "".join(words)
        ids = self.ids(text).astype("<u4")
        ends = np.cumsum([len(w.encode()) for w in words])
        cut = np.searchsorted(np.cumsum(self.id_bytes[ids]), ends, side="left") + 1
        flat = ids.tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip([0, *cut.tolist()], cut.tolist(), strict=False)]

    def split(self, text: str, at: int = 0) -> list[str]:
        """Pre-tokens of text[at:]; `at` must be a pre-token's start."""
        return (self.any if NOT_PLAIN.search(text, at) else PLAIN).findall(text, at)

    def size(self, piece: str) -> int:
        """Ids of one pre-token; sizes are kept for as many pieces as memory may hold."""
        n = self.sizes.get(piece)
        if n is None:
            n = len(self.listed(piece))
            if len(self.sizes) >= 300_000:
                self.sizes.clear()
            self.sizes[piece] = n
        return n


@functools.lru_cache(maxsize=2)
def load(path: str) -> Tokens:
    return Tokens(path)
