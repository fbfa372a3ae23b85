"""Language ID by rank-order profiles.

A profile is the ``PROFILE`` most frequent letter n-grams (n = 1 to 3, words padded with a boundary) in rank order. A
document's own profile is compared with every language's by the out-of-place distance: the sum, over the document's
n-grams, of how far apart the two ranks are, or ``PROFILE`` where the language lacks the n-gram. The nearest language
wins; ties go to the first in code-point order.

Profiles are fitted on at most about ``FIT_ROWS`` labelled rows, taken by a hash of their doc_id; prediction reads
whole texts only, never lang, source or doc_id. An n-gram is named by its code points (63 bits), so no two share a name.

Defined results: null text or text without a letter is ``und`` with score 0, as is everything when no row is labelled;
repeated rows give repeated results; an empty table gives an empty result; other columns are read only where ``keep``
names them, and one of them that is called like a result column is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytetext import text_steps

PROFILE = 400
FIT_ROWS = 20_000
UNKNOWN = "und"
_EDGE = 1
_POINT_BITS = 21
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000))
    return _letters[0]


class Grams:
    """Distinct n-grams of some texts with their counts, in ascending order of text and n-gram.

    An n-gram is three places of code points: (0, 0, a), (a, 0, b) or (a, b, c), with ``_EDGE`` for the boundary of a
    word. Inside, places hold the numbers of the letters that these texts have, in order of code points; so a text's
    index and n-gram fit one integer, unless there are very many letters, and sort in the same order.
    """

    def __init__(self, texts: list[bytes]):
        lowered = [t.decode("utf-8", "replace").lower() for t in texts]
        # Each text with the boundary before it, and a last boundary: no n-gram spans two texts' letters.
        points = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "replace"), np.uint32)
        present = np.zeros(0x110000, bool)
        present[points] = True
        self.alphabet = np.concatenate([[0, _EDGE], np.flatnonzero(present & _is_letter())])
        number = np.full(0x110000, _EDGE, np.int64)
        number[self.alphabet] = np.arange(len(self.alphabet))
        code = number[points]
        self.bits = b = max(8, len(self.alphabet).bit_length())
        self.mask = (1 << 3 * b) - 1
        owner = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) + 1 for t in lowered[:-1]] + [len(lowered[-1]) + 2]) << 3 * b
        one = code > _EDGE
        two = one[:-1] | one[1:]
        keys = np.concatenate([
            (owner | code)[one],
            (owner[:-1] | (code[:-1] << 2 * b) | code[1:])[two],
            (owner[:-2] | (code[:-2] << 2 * b) | (code[1:-1] << b) | code[2:])[one[1:-1]],
        ])
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        self.keys, self.counts = keys[first], np.diff(np.append(first, len(keys)))

    def owners(self) -> np.ndarray:
        return self.keys >> 3 * self.bits

    def named(self, local: np.ndarray) -> np.ndarray:
        """The n-grams by code points."""
        b, m = self.bits, (1 << self.bits) - 1
        place = lambda shift: self.alphabet[(local >> shift) & m]
        return (place(2 * b) << 2 * _POINT_BITS) | (place(b) << _POINT_BITS) | place(0)

    def ranked(self, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text index, rank from 0, n-gram) of each text's ``top`` n-grams: most frequent first, ties by n-gram."""
        owner, rare = self.owners(), (1 << 24) - 1 - np.minimum(self.counts, (1 << 24) - 1)
        if 3 * self.bits + 24 + int(owner[-1] if len(owner) else 0).bit_length() < 64:
            order = (((owner << 24) | rare) << 3 * self.bits) | (self.keys & self.mask)
            order.sort()
            owner, local = order >> (3 * self.bits + 24), order & self.mask
        else:
            at = np.lexsort((self.keys, rare, owner))
            owner, local = owner[at], self.keys[at] & self.mask
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
        on = rank < top
        return owner[on], rank[on], self.named(local[on])


def _gram_steps(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, Grams]]:
    """Slices ``[lo, hi)`` of a batch with their n-grams. A text index has 9 bits beside 18 bits a letter."""
    for lo, hi, texts in text_steps(batch, column):
        for k in range(0, len(texts), 512):
            yield lo + k, min(lo + k + 512, hi), Grams(texts[k : k + 512])


def fit_profiles(labelled: DataFrame, profile: int = PROFILE, fit_rows: int = FIT_ROWS) -> dict[str, list[int]]:
    """Grams of each language in rank order. ``labelled``: doc_id, text, lang (rows of null lang are left out)."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = min(1.0, fit_rows / max(rows.count(), 1))
    picked = rows.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + (share == 1.0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lo, hi, grams in _gram_steps(batch, "text"):
                names = sorted(set(langs[lo:hi]))
                number = {x: i for i, x in enumerate(names)}
                of_lang = np.array([number[x] for x in langs[lo:hi]], np.int64)[grams.owners()]
                got, inverse = np.unique((of_lang << 3 * grams.bits) | (grams.keys & grams.mask), return_inverse=True)
                n = np.bincount(inverse, grams.counts, len(got)).astype(np.int64)
                made = [pa.array([names[i] for i in (got >> 3 * grams.bits).tolist()], pa.string()), pa.array(grams.named(got & grams.mask)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(made, ["lang", "gram", "n"])

    grams = picked.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = grams.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= profile)
    out: dict[str, list[int]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):  # `profile` rows a language
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Profiles:
    """Ranks of all profile grams in all languages, for lookup by gram."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.grams, np.array(profiles[lang], np.int64)), j] = np.arange(len(profiles[lang]))

    def predict(self, grams: Grams, texts: int) -> tuple[list[str], np.ndarray]:
        owner, rank, gram = grams.ranked(self.size)
        n = np.bincount(owner, minlength=texts)
        if not self.langs:
            return [UNKNOWN] * texts, np.zeros(texts)
        at = np.searchsorted(self.grams, gram)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != gram] = len(self.grams)
        distance = np.empty((texts, len(self.langs)))
        for j in range(len(self.langs)):
            theirs = self.ranks[at, j]
            apart = np.where(theirs < 0, self.size, np.abs(theirs - rank))
            distance[:, j] = np.bincount(owner, apart, texts)
        best = distance.argmin(axis=1)
        nearest = distance[np.arange(texts), best]
        score = np.where(n > 0, 1.0 - nearest / np.maximum(n * self.size, 1), 0.0)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist())], score.clip(0.0, 1.0)


def predict_language(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns in ``keep`` with lang_pred and score; only ``text`` is looked at."""
    if clash := {"lang_pred", "score"} & set(keep):
        raise ValueError(f"columns called like results: {sorted(clash)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Profiles(profiles, size)
        for batch in batches:
            for lo, hi, grams in _gram_steps(batch, "text"):
                lang, score = table.predict(grams, hi - lo)
                kept = [batch.column(k).slice(lo, hi - lo) for k in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(lang, pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{kinds + ', ' if keep else ''}lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from fitting: a quarter by crc32 of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, profile: int = PROFILE, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; fitted on the rows that aren't held out."""
    profiles = fit_profiles(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), profile, fit_rows)
    out = predict_language(docs, profiles, profile, ("doc_id",))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
