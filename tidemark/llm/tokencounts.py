"""Token counts: batch encoding inside Arrow functions, which hands back lengths only.

Texts are taken in steps of about equal bytes, and a long text in slices cut at safe boundaries, so that no step holds much
more than ``STEP_BYTES`` of text whatever the lengths. A slice is cut into pieces at ASCII white space, where no token, no
composed letter and no special string can span the cut: counts of pieces add up to the count of the whole. A text without
white space is cut next to ASCII digits, which are tokens of their own, and else stays whole. Pieces that repeat within a
task are encoded once; the lengths of a bounded number of short ones are remembered.

This holds for tokenizers that drop white space and set digits apart, as ``word_bpe_49k.json`` does. For others (those that
keep white space in tokens) ``pieces_add_up`` is False and every text is encoded whole.

Defined results: null text is empty and has 0 bytes and 0 tokens; special strings inside a text count as the library's
default has them; repeated rows give repeated results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Bytes of text handled at once; a longer text is cut into slices of at most this many, where it can be.
STEP_BYTES = 1 << 20
#: Bytes of pieces in one call of the encoder.
ENCODE_BYTES = 256 << 10
#: Lengths remembered by a task, and bytes of the longest piece among them.
REMEMBERED, SHORT = 400_000, 64
#: Bytes of pieces in one string.
ROW_BYTES = 1024
_SPACE = re.compile(rb"[ \t\n\r]")
_DIGIT = re.compile(rb"(?<=[\x00-\x7f])(?=[0-9])")


def slices(text: bytes, size: int = STEP_BYTES) -> Iterator[bytes]:
    """``text`` cut before white space, or else before an ASCII digit behind an ASCII character, into parts of about ``size``.

    A part without such a place within ``size`` bytes goes on to the next one.
    """
    at = 0
    while len(text) - at > size:
        space = max(text.rfind(c, at + 1, at + size) for c in (b" ", b"\n", b"\t", b"\r"))
        if space < 0:
            places = [f.start() for f in (_SPACE.search(text, at + size), _DIGIT.search(text, at + size)) if f]
            space = min(places, default=len(text))
        if space == len(text):
            break
        yield text[at:space]
        at = space
    yield text[at:]


def _by_bytes(pieces: list[bytes], size: int) -> Iterator[list[bytes]]:
    """The pieces in order, in lists of about ``size`` bytes."""
    held: list[bytes] = []
    n = 0
    for piece in pieces:
        held.append(piece)
        n += len(piece) + 1
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


class Counter:
    """Lengths of texts by one tokenizer; one per task."""

    def __init__(self, path: str, pieces_add_up: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole = not pieces_add_up
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: map(len, model.encode(texts, num_threads=1))
            self.whole = True
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encode = lambda texts: map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False))
            self.starts = lambda texts: ([o[0] for o in e.offsets] for e in tokenizer.encode_batch(texts, add_special_tokens=False))
        self.known: dict[bytes, int] = {}

    def _of_texts(self, texts: list[bytes]) -> list[int]:
        out: list[int] = []
        for batch in _by_bytes(texts, ENCODE_BYTES):
            out += self.encode([t.decode("utf-8", "replace") for t in batch])
        return out

    def _of_pieces(self, pieces: list[bytes]) -> list[int]:
        """Lengths of pieces: some hundred bytes of them stand in one string, and each token goes to the piece that it starts in."""
        out: list[int] = []
        for batch in _by_bytes(pieces, ENCODE_BYTES):
            rows = [[p.decode("utf-8", "replace") for p in row] for row in _by_bytes(batch, ROW_BYTES)]
            for row, starts in zip(rows, self.starts([" ".join(r) for r in rows])):
                first = np.cumsum([0] + [len(p) + 1 for p in row[:-1]])
                out += np.bincount(np.searchsorted(first, starts, "right") - 1, minlength=len(row)).tolist()
        return out

    def step(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text."""
        if self.whole:
            return self._of_texts(texts)
        words = [t.split() for t in texts]
        used = {w for ws in words for w in ws}
        fresh = list(used - self.known.keys())
        self.known.update(zip(fresh, self._of_pieces(fresh)))
        out = [sum(map(self.known.__getitem__, ws)) for ws in words]
        if len(self.known) > REMEMBERED:
            self.known = {w: self.known[w] for w in used}
        for w in fresh:
            if len(w) > SHORT:
                self.known.pop(w, None)
        return out

    def count(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text, in steps of about ``STEP_BYTES``."""
        out = [0] * len(texts)
        owners: list[int] = []
        parts: list[bytes] = []
        size = 0
        for i, text in enumerate(texts):
            for part in [text] if self.whole else slices(text):
                owners.append(i)
                parts.append(part)
                size += len(part)
                if size >= STEP_BYTES:
                    for o, n in zip(owners, self.step(parts)):
                        out[o] += n
                    owners, parts, size = [], [], 0
        for o, n in zip(owners, self.step(parts)):
            out[o] += n
        return out


def vocabulary_path(name: str) -> str:
    """Where the installed vocabulary files have ``name``; asked for in the task, as folders may differ between machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, pieces_add_up: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``vocabulary`` is a file name of the installed vocabularies or a path that all machines have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary if "/" in vocabulary else vocabulary_path(vocabulary), pieces_add_up)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            n = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
