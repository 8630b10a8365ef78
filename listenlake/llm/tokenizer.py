"""Token ids of whole texts, with a memory for words.

A byte-level BPE splits text before it merges, and a single blank between two other characters always
starts a new part. So a text is cut at such blanks, and the ids of what follows each blank are remembered.
"""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import tiktoken

from listenlake.llm.memory import Memory, held

# Fixed value: the text that the vocabulary keeps as one id.
END_OF_TEXT, END_OF_TEXT_ID = "<|endoftext|>", 50256
# an encoder holds up to twice as many; every worker of an executor has one
REMEMBERED = 250_000


class Encoder:
    """Ids, as little-endian unsigned 32-bit numbers, of a blank and the word after it.

    ``byte_bpe_50k.tiktoken`` holds the vocabulary of ``byte_bpe_50k.json``; both give the same ids, this
    one several times faster. With ``special`` the text of the end marker becomes its id, as it does by
    default with the other file; without, it is ordinary text. ``controls`` are strings without blanks that become
    single ids after those of the vocabulary; ``widths`` has the number of bytes of every id.
    """

    def __init__(self, ranks_path: str, special: bool = True, controls: tuple[str, ...] = (), remembered: int = REMEMBERED):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        marks = {END_OF_TEXT: END_OF_TEXT_ID} | {text: END_OF_TEXT_ID + 1 + i for i, text in enumerate(controls)}
        pieces = [piece for piece, _ in sorted((ranks | {m.encode(): i for m, i in marks.items()}).items(), key=lambda x: x[1])]
        self.widths = np.array([len(piece) for piece in pieces])
        self._bytes, self._starts = np.frombuffer(b"".join(pieces), "u1"), np.cumsum(self.widths) - self.widths
        bpe = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=marks)
        allowed = set(marks) if special else set()
        self._ids = lambda text: bpe.encode(text, allowed_special=allowed, disallowed_special=())
        self._words = Memory(lambda word: self._packed(" " + word), remembered)

    def _packed(self, text: str) -> bytes:
        return np.array(self._ids(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of the whole text, packed."""
        first, *words = text.split(" ")
        # white space in front of a blank belongs to one run with it: such words stay joined to the next
        loose = not first or first[-1].isspace() or any(not w or w[-1].isspace() for w in words)
        if loose:
            joined, parts = [], [first]
            for word in words:
                if not parts[-1] or parts[-1][-1].isspace():
                    parts.append(word)
                else:
                    joined.append(" ".join(parts))
                    parts = [word]
            first, *words = [*joined, " ".join(parts)]
        return b"".join([self._packed(first), *map(self._words.__getitem__, words)])

    def decode(self, ids: np.ndarray) -> bytes:
        widths = self.widths[ids]
        # for every byte, how far its place in the vocabulary is from its place in the text
        shift = np.repeat(self._starts[ids] - (np.cumsum(widths) - widths), widths)
        return self._bytes[np.arange(len(shift)) + shift].tobytes()


def encoder(ranks_path: str | None = None, special: bool = True, remembered: int = REMEMBERED) -> Encoder:
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return held("encoder", (path, special, remembered), lambda: Encoder(path, special, remembered=remembered))


def marked_encoder(controls: tuple[str, ...], ranks_path: str | None = None) -> Encoder:
    """An encoder to which ``controls`` are single ids."""
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return held("marked encoder", (path, controls), lambda: Encoder(path, controls=controls))
