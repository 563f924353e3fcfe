"""Public tokenizers read from their files: token ids of texts, and the bytes of each id.

The driver reads a file once and its bytes travel with the tasks; a file above ``MOST_BYTES`` is refused, so what
travels is bounded whatever the corpus. Workers keep what they built from it.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import chain

import numpy as np

MOST_BYTES = 64 << 20

# Fixed value: the pattern by which byte-level BPE cuts a text before merging.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        data = file.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"{path} is larger than {MOST_BYTES} bytes")
    return data


def _letters() -> dict[str, int]:
    """The byte each letter of a byte-level entry stands for: printable bytes stand for themselves, the others
    follow from letter 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Vocabulary:
    """``entries`` are the bytes of each id."""

    def __init__(self, entries: list[bytes]) -> None:
        self.entries = np.array([*entries, None], dtype=object)[:-1]
        self.lengths = np.array([len(e) for e in entries], dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and their number per text."""
        lists = self.lists(texts)
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts

    def restores(self, ids: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Per text, whether its tokens' joined bytes are the text."""
        ends = np.cumsum(counts)
        sums = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        same = np.diff(sums[np.concatenate([[0], ends])]) == np.array([len(t) for t in texts])
        joined = b"".join(self.entries[ids].tolist())
        if same.all() and joined == b"".join(texts):
            return same
        places = sums[np.concatenate([[0], ends])].tolist()
        return np.array([joined[a:b] == t for a, b, t in zip(places[:-1], places[1:], texts)], dtype=bool)


class ByteLevel(_Vocabulary):
    """A byte-level BPE of a JSON file. Special tokens are never read from a text.

    Where the ids follow the merges, ids are ranks and the rank encoder gives the same tokens about five times as fast
    (tests compare the two); any other file is left to its own library.
    """

    def __init__(self, data: bytes) -> None:
        whole = json.loads(data)
        model, added = whole["model"], {t["content"] for t in whole.get("added_tokens") or ()}
        letters = _letters()
        entries = [b""] * (max([*model["vocab"].values(), *(t["id"] for t in whole.get("added_tokens") or ())]) + 1)
        for entry, i in model["vocab"].items():
            entries[i] = entry.encode() if entry in added else bytes(letters[c] for c in entry)
        super().__init__(entries)
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        cut = whole.get("pre_tokenizer") or {}
        if (
            all(a < b for a, b in zip(merged, merged[1:]))
            and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
            and not whole.get("normalizer")
            and not model.get("ignore_merges")
        ):
            import tiktoken

            ranks = {entries[i]: i for entry, i in model["vocab"].items() if entry not in added}
            encoder = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.lists = lambda texts: [encoder.encode_ordinary(t) for t in texts]
        else:
            self.lists = _own_library(data)


def _own_library(data: bytes):
    from tokenizers import Tokenizer

    own = Tokenizer.from_buffer(data)
    own.encode_special_tokens = True
    return lambda texts: [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(_Vocabulary):
    """A sentencepiece model."""

    def __init__(self, data: bytes) -> None:
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_proto=data)
        pieces = [own.id_to_piece(i) for i in range(own.get_piece_size())]
        super().__init__(
            [
                bytes([int(p[3:-1], 16)]) if own.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        self.lists = lambda texts: own.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def vocabulary(kind: type[_Vocabulary], data: bytes) -> _Vocabulary:
    return kind(data)
