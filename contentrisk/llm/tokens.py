"""Byte-level BPE token ids for whole texts, in batches.

Words repeat, so each distinct space-delimited word is encoded once and its ids are put together
with numpy. That equals encoding the whole text: the pattern that cuts a text before merging always
cuts before a space that has no other white space beside it. Texts with such a space are encoded whole.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

from contentrisk.llm.common import KnownWords, gather, split_words

#: Fixed value: the published cutting pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space next to a space.
UNSAFE = r"[\s\v\x{85}\p{Z}] | [\s\v\x{85}\p{Z}]"


def load_ranks(path: str) -> bytes:
    """The vocabulary file's bytes, read on the driver and sent to the tasks (under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


class Tokenizer:
    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.n_vocab = max(table.values()) + 1
        self.lengths = np.zeros(self.n_vocab, np.int64)   # bytes of each token
        for word, i in table.items():
            self.lengths[i] = len(word)
        self.known = KnownWords(self.of_words)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), np.int32)

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with the space before them, encoded as one text and told apart by bytes."""
        ids = self.ids("".join([" " + w for w in words if w]))
        ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 if w else 0 for w in words], dtype=np.int64)
        size = np.diff(np.searchsorted(np.cumsum(self.lengths[ids]), ends, "right"), prepend=0)
        bare = [i for i, w in enumerate(words) if not w]   # a space alone
        if bare:
            space = self.ids(" ")
            at = int(size[:bare[0]].sum())
            ids = np.concatenate([ids[:at], space, ids[at:]])
            size[bare[0]] = len(space)
        return ids, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and each text's start among them (and the end)."""
        unsafe = pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(unsafe), "", texts)
        starts, word, words, _ = split_words(plain)
        n, rows = len(starts) - 1, np.flatnonzero(unsafe)
        flat, begin, size = self.known(words, np.bincount(word, minlength=len(words)))
        begin, size = begin[word], size[word]
        # a text's first word has no space before it; a text that is encoded whole stands in its place
        heads = [self.ids(t.as_py()) for t in words.take(pa.array(word[starts[:-1]]))] if n else []
        for i in rows.tolist():
            heads[i] = self.ids(texts[i].as_py())
        lengths = np.fromiter(map(len, heads), np.int64, n)
        begin[starts[:-1]], size[starts[:-1]] = len(flat) + np.cumsum(lengths) - lengths, lengths
        ids = gather(np.concatenate([flat, *heads]), begin, size)
        return ids, np.concatenate([[0], np.cumsum(size)])[starts] if n else np.zeros(1, np.int64)
