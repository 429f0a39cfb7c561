"""Token ids of whole texts, with a bounded memory of pieces already encoded."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

ID_BYTES = 4  # ids are little-endian unsigned 32-bit integers
TOGETHER = 64  # texts whose unknown pieces are encoded together
WORDS_TOGETHER = 256  # unknown words encoded in one call
_PLAIN_ENDS = (".", ",")


@lru_cache(maxsize=2)
def _loaded(path: str):
    """The tokenizer, once for each worker process, which of its tokens start with a space, and its added tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    vocabulary = tokenizer.get_vocab()
    starts = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    starts[[k for piece, k in vocabulary.items() if piece[0] == "\u0120"]] = True
    added = tuple(token.content for token in tokenizer.get_added_tokens_decoder().values())
    return tokenizer, starts, added


class PieceEncoder:
    """Encode texts with a byte-level tokenizer file, reusing the ids of pieces met before.

    The pre-tokenizer of such a file always cuts before a space or line end that
    has a non-space character on both sides, so texts are cut there and the
    pieces encoded on their own; the ids joined are the ids of the whole text. A
    text with any other white space between pieces is encoded as a whole. A
    letter and a full stop or comma after it are never in one token either, so
    only the word before is looked up. A text that holds the string of an added
    token, such as `<|endoftext|>`, is encoded as a whole too, with that token's id.

    Words repeat, so most pieces are found in memory. It is emptied before it
    would hold more than `most` pieces; make one encoder for each task.
    """

    def __init__(self, path: str, most: int = 1_500_000):
        self.tokenizer, self.starts_word, self.added = _loaded(path)
        self.blank_added = any(c.isspace() for token in self.added for c in token)
        self.most = most
        self.known: dict[str, bytes | None] = {}

    def whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _ids(self, text: str) -> np.ndarray:
        """The ids of one text; the batch call leaves out the offsets, which nothing here needs."""
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def encode(self, texts: Sequence[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for at in range(0, len(texts), TOGETHER):
            group = texts[at : at + TOGETHER]
            whole = [self.blank_added or any(token in text for token in self.added) for text in group]
            cut = [[""] if alone else text.replace("\n", " \n").split(" ") for text, alone in zip(group, whole)]
            firsts = [parts.pop(0) for parts in cut]
            found = [list(map(self.known.get, parts)) for parts in cut]
            gaps = [[i for i, ids in enumerate(row) if ids is None] for row in found]
            pieces = {parts[i] for parts, row in zip(cut, gaps) for i in row}
            if len(self.known) + len(pieces) > self.most:
                self.known.clear()
            self._learn(pieces)
            for text, first, parts, row, empty in zip(group, firsts, cut, found, gaps):
                for i in empty:
                    row[i] = self.known[parts[i]]
                if first == "" or first[0].isspace() or first[-1].isspace() or any(row[i] is None for i in empty):
                    yield self.whole(text)  # it has a piece that does not stand for itself
                else:
                    yield self.whole(first) + b"".join(row)

    def _learn(self, pieces: set[str]) -> None:
        """A piece stands for itself after a space, or starts with its line end."""
        known, words, ended, lines = self.known, set(), [], []
        for piece in pieces:
            # No piece holds a plain space, and no other white space is printable.
            if piece and (piece.isprintable() or piece.split(None, 1) == [piece]):
                if piece[-1] in _PLAIN_ENDS and piece[-2:-1].isalpha():
                    ended.append(piece)
                    words.add(piece[:-1])
                else:
                    words.add(piece)
            elif piece == "" or piece[-1].isspace():
                known[piece] = None
            else:
                lines.append(piece)
        self._learn_words([word for word in words if word not in known])
        marks = {mark: self.whole(mark) for mark in _PLAIN_ENDS}
        for piece in ended:
            known[piece] = known[piece[:-1]] + marks[piece[-1]]
        for piece in lines:
            edge = piece[1:2] if piece[0] == "\n" else piece[:1]
            known[piece] = None if edge.isspace() else self.whole(piece if piece[0] == "\n" else " " + piece)

    def _learn_words(self, words: list[str]) -> None:
        """Words without white space are encoded as one text; a token with a leading space starts the next word."""
        for at in range(0, len(words), WORDS_TOGETHER):
            part = words[at : at + WORDS_TOGETHER]
            ids = self._ids(" " + " ".join(part))
            starts = (np.flatnonzero(self.starts_word[ids]) * ID_BYTES).tolist()
            data = ids.tobytes()
            for word, a, b in zip(part, starts, [*starts[1:], len(data)], strict=True):
                self.known[word] = data[a:b]
