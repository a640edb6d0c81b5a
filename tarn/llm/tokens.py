"""Token ids of a byte-level BPE vocabulary, for use inside tasks.

The vocabulary is a ``tokenizers`` JSON file, named by path. Its rules cut a
text before a space that a word follows, so the ids of a text are those of its
chunks put together; frequent chunks are encoded once per worker.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken

# The cut of the byte-level BPE family into pieces that merges don't cross. A
# fixed value of the vocabulary's format.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Chunks end where pieces always end.
CHUNKS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# White space to Python but not to the vocabulary's rules.
NOT_SPACE = re.compile("[\x1c-\x1f]")

# Chunks a worker remembers: the first ones it meets, which are mostly the
# frequent ones. About 60 MB.
CACHED_CHUNKS = 250_000
CACHED_LENGTH = 64


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if printable,
    else the next unused one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    others = (b for b in range(256) if b not in set(printable))
    letters.update({chr(256 + n): b for n, b in enumerate(others)})
    return letters


class Vocabulary(dict):
    """Maps a chunk to the bytes of its little-endian 32-bit ids."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = _byte_letters()
        special = {token["content"] for token in data["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in data["model"]["vocab"].items()
            if token not in special
        }
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in what is around them")
        self.added = {
            token["content"]: np.array([token["id"]], "<u4") for token in data["added_tokens"]
        }
        longest = sorted(self.added, key=len, reverse=True)
        self.splits = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        self.size = 1 + max(
            [*data["model"]["vocab"].values(), *(t["id"] for t in data["added_tokens"])]
        )
        self.encoding = tiktoken.Encoding(
            "byte-bpe", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}
        )

    def __missing__(self, chunk: str) -> bytes:
        ids = np.array(self.encoding.encode_ordinary(chunk), "<u4").tobytes()
        if len(self) < CACHED_CHUNKS and len(chunk) <= CACHED_LENGTH:
            self[chunk] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        """The ids of ``text``, in which added tokens are ordinary characters."""
        if NOT_SPACE.search(text):
            return np.array(self.encoding.encode_ordinary(text), "<u4")
        return np.frombuffer(b"".join(map(self.__getitem__, CHUNKS.findall(text))), "<u4")

    def ids_with_added(self, text: str) -> np.ndarray:
        """The ids of ``text``, in which added tokens are their own ids.

        This is what the library gives without further settings; what lies
        between added tokens is encoded apart.
        """
        parts = self.splits.split(text) if self.splits else [text]
        if len(parts) == 1:
            return self.ids(text)
        return np.concatenate(
            [self.added[p] if n % 2 else self.ids(p) for n, p in enumerate(parts)]
        )

    def text(self, ids: np.ndarray) -> str:
        return self.encoding.decode_bytes(ids.tolist()).decode("utf-8")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process."""
    return Vocabulary(path)
