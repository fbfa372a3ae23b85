"""License scans: Aho-Corasick finds notice phrases and identifier tags; licence expressions are evaluated.

One automaton over the lower-cased words of a text (single spaces between them) finds all phrases in one pass; every
place where a phrase's words stand consecutively counts. A second automaton finds identifier tags in the raw text
(``SPDX-License-Identifier:`` and kin); behind a tag, up to the end of its line, stands a licence expression, which a
shunting-yard parser turns into postfix form and evaluates with ``with`` over ``and`` over ``or``. The expression ends
where the line stops being one: at the first token that can't follow. Identifiers of no known family name no label.

Defined results: null or empty text has no words and no labels (score 0); a malformed expression (one that breaks off,
or that closes a bracket too many or too few) yields the labels of the known identifiers it holds; repeated rows give
repeated results; an empty table gives an empty result; other columns of the input are not read. Time is linear in the
text and the places found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bytetext import normalise

#: Phrases whose places are counted, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Further notice phrases, with their labels.
MORE_PHRASES = {
    "bsd license": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "boost software license": "bsl",
    "creative commons": "cc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "reserved",
}

#: Tags before a licence expression, lower-cased.
TAGS = ("spdx-license-identifier:", "license-identifier:", "license-expression:")

#: How an identifier of a known family begins (followed by a hyphen or nothing), and its label.
FAMILIES = {
    "mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd", "mpl": "mpl", "epl": "epl", "isc": "isc", "bsl": "bsl", "cc0": "cc0",
    "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-nc-sa": "cc-by-nc-sa", "cc-by-nc-nd": "cc-by-nc-nd",
}

#: Labels that allow reuse without conditions on derived works.
OPEN = {"mit", "apache", "bsd", "isc", "bsl", "cc0", "cc-by", "public-domain"}

_BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*")
#: Between the tokens of an expression.
_GAP = re.compile(r"[ \t]*")


def expression_tokens(text: str, at: int = 0, stop: int | None = None) -> list[str]:
    """Tokens of the expression that begins at ``at`` and ends before ``stop``: up to the first one that can't follow those before it.

    An exception follows ``with`` and isn't checked; elsewhere an operand and an operator take turns. No tag fits into an
    expression whole, as a colon ends it, so the expressions of a text share no more than a tag's own words.
    """
    out: list[str] = []
    stop = len(text) if stop is None else stop
    depth, operand_next = 0, True
    while True:
        at = _GAP.match(text, at, stop).end()
        found = _TOKEN.match(text, at, stop)
        if not found:
            break
        token = found[0]
        if token == "(":
            fits, depth = operand_next, depth + 1
        elif token == ")":
            fits, depth = not operand_next and depth > 0, depth - 1
        elif token.lower() in _BINDS:
            fits, operand_next = not operand_next, True
        else:
            fits, operand_next = operand_next, False
        if not fits:
            break
        out.append(token)
        at = found.end()
    return out


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: identifiers and operators in postfix order; None if the expression is malformed."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for token in tokens:
        op = token.lower()
        if op in _BINDS:
            if operand_next:
                return None
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[op]:
                out.append(held.pop())
            held.append(op)
            operand_next = True
        elif token == "(":
            if not operand_next:
                return None
            held.append(token)
        elif token == ")":
            if operand_next:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        else:
            if not operand_next:
                return None
            out.append(token)
            operand_next = False
    if operand_next or "(" in held:
        return None
    return out + held[::-1]


def label_of(identifier: str) -> str | None:
    """Label of the longest known family that the identifier begins with."""
    parts = identifier.lower().rstrip("+").split("-")
    return next((FAMILIES[x] for n in range(len(parts), 0, -1) if (x := "-".join(parts[:n])) in FAMILIES), None)


def evaluate(tokens: list[str]) -> tuple[set[str], bool]:
    """Labels that the expression names, and whether some choice it offers consists of open licences alone."""
    order = postfix(tokens)
    if order is None:
        return {x for t in tokens if (x := label_of(t))}, False
    stack: list[tuple[set[str], bool]] = []
    for token in order:
        if token in _BINDS:
            right, left = stack.pop(), stack.pop()
            if token == "with":  # an exception only adds permissions; it is not a licence itself
                stack.append(left)
            else:
                free = (left[1] or right[1]) if token == "or" else (left[1] and right[1])
                stack.append((left[0] | right[0], free))
        else:
            label = label_of(token)
            stack.append(({label} if label else set(), label in OPEN))
    return stack[0]


def _automaton(entries: dict[str, tuple]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for text, value in entries.items():
        found.add_word(text, value)
    found.make_automaton()
    return found


class Scanner:
    """The two automata; one per task."""

    def __init__(self) -> None:
        phrases = {f" {p} ": (p, label, p in BASE_PHRASES) for p, label in (MORE_PHRASES | BASE_PHRASES).items()}
        self.phrases = _automaton(phrases)
        self.tags = _automaton({t: (t,) for t in TAGS})

    def scan(self, text: bytes | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, expressions, open_choice, score."""
        raw = text or b""
        words = normalise(raw).split()
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        base, labels, evidence = set(), set(), 0
        n_base, first, last, words_before, counted_to = 0, None, None, 0, 0
        for end, (phrase, label, is_base) in self.phrases.iter(line):
            labels.add(label)
            evidence += 1
            if is_base:
                base.add(label)
                # Counted on from where the last one stood; a longer phrase may begin before it.
                start = end - 1 - len(phrase)
                words_before += line.count(" ", counted_to, start) if start >= counted_to else -line.count(" ", start, counted_to)
                counted_to = start
                n_base, first, last = n_base + 1, words_before if first is None else min(first, words_before), max(last or 0, words_before)
        expressions, free = [], bool(labels & OPEN) and labels <= OPEN
        written = raw.decode("latin-1")
        taken_to, stop = -1, -1
        for end, _ in self.tags.iter(raw.lower().decode("latin-1")):
            if end <= taken_to:
                continue
            if stop <= end:  # else the tag stands in the line of the one before
                stop = written.find("\n", end + 1)
                stop = len(written) if stop < 0 else stop
            taken_to = end
            tokens = expression_tokens(written, end + 1, stop)
            named, open_choice = evaluate(tokens)
            if named:
                expressions.append(" ".join(tokens).replace("( ", "(").replace(" )", ")"))
                labels |= named
                free = free or open_choice
                evidence += 2
        score = 1.0 - 0.5**evidence
        return (
            len(words), n_base, first, last,
            ",".join(sorted(base)), ",".join(sorted(labels)), expressions, free, score,
        )


_FIELDS = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("expressions", pa.list_(pa.string())),
    ("open_choice", pa.bool_()), ("score", pa.float64()),
]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, expressions, open_choice, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows = [scanner.scan(texts[i].as_py()) for i in range(len(texts))]
            columns = list(zip(*rows)) or [()] * len(_FIELDS)
            made = [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", *(n for n, _ in _FIELDS)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "expressions array<string>, open_choice boolean, score double"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)
