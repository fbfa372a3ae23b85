"""Fill-in-the-middle transformation, assembled by a secondary sort.

A text is cut into units (lines); two hashes of its id say after which units the prefix and the middle end. The sections
leave their task as pieces, chunks of whole units (of part of one, where a unit is longer than a chunk), keyed by document
and by their place in the *output*: marker, section, marker, section, marker, section. ``repartition`` by document and
``sortWithinPartitions`` by place (the DataFrame form of repartitionAndSortWithinPartitions) stream the pieces of each
document past an incremental digest; no text is put together. The pieces that went into the output are then sorted again,
within the same partitions, by the place that they have in the text: which section a piece belongs to is read off the
markers that came before it in the output, and a second digest over the sorted pieces is that of the restored text.

``output_texts`` runs the same stream and joins the pieces of a document instead of digesting them.

Defined results: null text is empty, and an empty text is plain; a null doc_id hashes as an empty number; rows that repeat
doc_id and text give repeated results (their pieces travel once a task); a text that holds a marker is plain and leaves as it
is; an empty table gives an empty result; other columns are not read. A hot doc_id is not a hot key: the key is made of
doc_id, text and the task that read it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = "7"
#: Of 100 texts, those that are transformed, and of those the ones with the suffix first.
RATE, SUFFIX_FIRST = 100, 50
#: Bytes of a piece at most.
CHUNK = 32 << 10
#: Pieces of a section are numbered from its place shifted by this.
_PLACE = 40
#: Bytes of pieces in one Arrow batch.
_BATCH_BYTES = 4 << 20


def draws(doc_id: object, seed: str = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))


def unit_ends(text: bytes) -> np.ndarray:
    """Byte offsets at which the lines of a text end."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def chunks(ends: np.ndarray, lo: int, hi: int, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """[lo, hi) in parts of whole units, at most ``size`` bytes each; a longer unit is cut wherever ``size`` is full."""
    while lo < hi:
        to = hi
        if hi - lo > size:
            k = int(np.searchsorted(ends, lo + size, "right")) - 1
            to = int(ends[k]) if k >= 0 and ends[k] > lo else lo + size
        yield lo, to
        lo = to


def layout(doc_id: object, text: bytes, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: str = SEED) -> tuple[int, str, list[tuple[bytes, int, int]], np.ndarray]:
    """Units, form, the output as (marker, lo, hi) in order, unit ends. The marker of a plain text is empty."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, "plain", [(b"", 0, len(text))], ends
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
    prefix, middle, suffix = (PREFIX, 0, a), (MIDDLE, a, b), (SUFFIX, b, len(text))
    return (n, "spm", [suffix, prefix, middle], ends) if h4 % 100 < suffix_first else (n, "psm", [prefix, suffix, middle], ends)


class _Out:
    """Rows gathered into Arrow batches of about ``_BATCH_BYTES``."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, *row, size: int = 0) -> None:
        self.rows.append(row)
        self.size += size + 64

    def full(self) -> bool:
        return self.size >= _BATCH_BYTES

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.size = [], 0
        return batch


def _fields(docs: DataFrame, *fields: tuple[str, str]) -> tuple[str, pa.Schema]:
    """A schema for Spark and for Arrow; ``doc_id`` has the type that it has in ``docs``."""
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    kind = docs.schema["doc_id"].dataType
    named = [(n, kind.simpleString(), to_arrow_type(kind)) if n == "doc_id" else (n, t, kinds[t]) for n, t in fields]
    return ", ".join(f"{n} {t}" for n, t, _ in named), pa.schema([(n, t) for n, _, t in named])


_PLACED = (("key", "binary"), ("doc_id", ""), ("place", "long"), ("piece", "binary"))
_OWN = (("copies", "long"), ("n", "long"), ("form", "string"))
_FOUND = (("prefix_chars", "long"), ("middle_chars", "long"), ("output_sha256", "string"))


def pieces(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: str = SEED) -> DataFrame:
    """key, doc_id, place (in the output; -1: the document itself), piece, copies, n, form.

    The row at place -1 says how many rows of the task have this doc_id and text; its piece is empty.
    """
    schema, arrow = _fields(docs, *_PLACED, *_OWN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(arrow)
        for batch in batches:
            seen: dict[bytes, list] = {}
            ids, tasks = batch.column("doc_id").to_pylist(), batch.column("task").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            for i, doc_id in enumerate(ids):
                text = texts[i].as_py() or b""
                name = hashlib.blake2b(f"{tasks[i]}|{doc_id!r}|".encode(), digest_size=16)
                name.update(text)
                key = name.digest()
                if key in seen:
                    seen[key][1] += 1
                    continue
                n, form, sections, ends = layout(doc_id, text, rate, suffix_first, seed)
                seen[key] = [doc_id, 1, n, form]
                for rank, (marker, lo, hi) in enumerate(sections):
                    if marker:
                        out.add(key, doc_id, 2 * rank << _PLACE, marker, None, None, None)
                    for k, (a, b) in enumerate(chunks(ends, lo, hi)):
                        out.add(key, doc_id, (2 * rank + 1 << _PLACE) + k, text[a:b], None, None, None, size=b - a)
                        if out.full():
                            yield out.take()
            for key, (doc_id, copies, n, form) in seen.items():
                out.add(key, doc_id, -1, b"", copies, n, form)
            yield out.take()

    return docs.select("doc_id", "text", F.spark_partition_id().alias("task")).mapInArrow(run, schema)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """Sorted pieces as (whether a new document begins, row): first the document's own row, with its copies summed, then each piece once."""
    own: dict | None = None
    key, place = None, None
    for batch in batches:
        names = batch.schema.names
        for values in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            row = dict(zip(names, values))
            if row["key"] != key:
                if own:
                    yield True, own
                key, place, own = row["key"], -1, row
            elif row["place"] == -1:
                own["copies"] += row["copies"]
            else:
                if own:
                    yield True, own
                    own = None
                if row["place"] != place:
                    place = row["place"]
                    yield False, row
    if own:
        yield True, own


def code_points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


_SECTIONS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}


def _sorted(cut: DataFrame) -> DataFrame:
    """All pieces of a document in one partition, in the order of their places."""
    return cut.repartition("key").sortWithinPartitions("key", "place")


def _digest_output(arrow: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted pieces of the output become pieces of the text, placed by the markers that came before them, and a document's
    own row then holds what was seen of its output: code points of prefix and middle, and the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(arrow)
        own, digest, section, nth, chars = None, None, 0, 0, [0, 0, 0]

        def end() -> None:
            seen = (None, None) if own["form"] == "plain" else chars[:2]
            out.add(own["key"], own["doc_id"], -1, b"", own["copies"], own["n"], own["form"], *seen, digest.hexdigest(), size=200)

        for begins, row in _documents(batches):
            if begins:
                if own:
                    end()
                own, digest, section, nth, chars = row, hashlib.sha256(), 0, 0, [0, 0, 0]
                continue
            piece = row["piece"]
            digest.update(piece)
            if own["form"] != "plain" and piece in _SECTIONS:
                section, nth = _SECTIONS[piece], 0
                continue
            chars[section] += code_points(piece)
            out.add(row["key"], row["doc_id"], (section << _PLACE) + nth, piece, *[None] * 6, size=len(piece))
            nth += 1
            if out.full():
                yield out.take()
        if own:
            end()
        yield out.take()

    return run


def _digest_text(arrow: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces in the order of the text become a row for each copy of the document, with the digest of the restored text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(arrow)
        own, digest = None, None

        def end() -> Iterator[pa.RecordBatch]:
            for _ in range(own["copies"]):
                out.add(*(own.get(c, digest.hexdigest()) for c in arrow.names), size=200)
                if out.full():
                    yield out.take()

        for begins, row in _documents(batches):
            if not begins:
                digest.update(row["piece"])
                continue
            if own:
                yield from end()
            own, digest = row, hashlib.sha256()
        if own:
            yield from end()
        yield out.take()

    return run


def infill(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    schema, arrow = _fields(docs, *_PLACED, *_OWN, *_FOUND)
    put_out = _sorted(pieces(docs, rate, suffix_first, seed)).mapInArrow(_digest_output(arrow), schema)
    schema, arrow = _fields(docs, ("doc_id", ""), *_OWN[1:], *_FOUND, ("restored_sha256", "string"))
    return put_out.sortWithinPartitions("key", "place").mapInArrow(_digest_text(arrow), schema)


def output_texts(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, form, output (the transformed text)."""
    schema, arrow = _fields(docs, ("doc_id", ""), ("form", "string"), ("output", "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, own, held = _Out(arrow), None, []

        def end() -> Iterator[pa.RecordBatch]:
            text = b"".join(held).decode("utf-8", "replace")
            for _ in range(own["copies"]):
                out.add(own["doc_id"], own["form"], text, size=len(text))
                if out.full():
                    yield out.take()

        for begins, row in _documents(batches):
            if not begins:
                held.append(row["piece"])
                continue
            if own:
                yield from end()
            own, held = row, []
        if own:
            yield from end()
        yield out.take()

    return _sorted(pieces(docs, rate, suffix_first, seed)).mapInArrow(run, schema)
