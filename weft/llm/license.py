"""License scans: one Aho-Corasick automaton finds notice phrases and identifier tags,
and a shunting-yard parser evaluates the licence expressions behind the tags.

Phrases are matched on words (runs of ASCII letters and digits and of all non-ASCII
characters, A-Z lower-cased). A tag's expression is read from the raw text up to the
end of its line: identifiers joined by ``and``, ``or`` and ``with`` (binding in the
order with, and, or) with parentheses. Its labels are those of all identifiers in it but
exceptions behind ``with``, however many choices it has; an expression that doesn't parse
gives none.

Results by case: null or empty text has no words, no labels, null places and score 0. A
very long text is read whole, in one task. Places of overlapping phrases all count. Rows with
repeated or null ids come back as they are. Columns other than doc_id and text are left out,
so no name clashes. No rows in, no rows out. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from weft.llm.common import id_and_text, lean

#: The base phrases and labels (fixed values).
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: The method's own phrases.
MORE = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd", "isc license": "isc", "boost software license": "bsl", "the unlicense": "unlicense",
    "licensed under the apache": "apache", "permission is hereby granted free of charge to any person": "mit", "creative commons attribution": "cc-by", "cc0": "cc0", "public domain dedication": "cc0",
    "all rights reserved": "proprietary",
}
#: The tag in front of an expression; its words tell where to look for it in the raw text.
TAG, TAG_WORDS = "spdx-license-identifier:", "spdx license identifier"
#: Labels of identifiers by their longest matching beginning.
IDENTIFIERS = {"agpl": "agpl", "apache": "apache", "bsd": "bsd", "bsl": "bsl", "cc-by": "cc-by", "cc0": "cc0", "epl": "epl", "gpl": "gpl", "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "unlicense": "unlicense"}

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LINE = re.compile(rb"[^\r\n]*")
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.\-]*\+?")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def words_of(text: str) -> list[str]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).decode("utf-8", "surrogatepass").split(" ")


def postfix(expression: str) -> list[str] | None:
    """The expression in postfix order by the shunting-yard method, or None if it is none.

    Reading stops at the first character that no expression has, so a comment's end
    or a sentence behind it is no error."""
    output: list[str] = []
    stack: list[str] = []
    wants_operand, at = True, 0
    while at < len(expression):
        if expression[at] in " \t":
            at += 1
            continue
        found = _TOKEN.match(expression, at)
        if not found:
            break
        token, low = found[0], found[0].lower()
        if token == "(":
            if not wants_operand:
                break
            stack.append(token)
        elif token == ")":
            if wants_operand or "(" not in stack:
                return None
            while (top := stack.pop()) != "(":
                output.append(top)
        elif low in _PRECEDENCE:
            if wants_operand:
                return None
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[low]:
                output.append(stack.pop())
            stack.append(low)
            wants_operand = True
        else:
            if not wants_operand:
                break
            output.append(token.rstrip(".-"))
            wants_operand = False
        at = found.end()
    if wants_operand or "(" in stack:
        return None
    return output + stack[::-1]


def label_of(identifier: str) -> str:
    low = identifier.lower()
    best = max((p for p in IDENTIFIERS if low.startswith(p)), key=len, default=None)
    return IDENTIFIERS[best] if best else ""


def labels_of(parsed: list[str]) -> frozenset[str]:
    """The labels of all identifiers of a postfix expression but those behind ``with``."""
    stack: list[frozenset[str]] = []
    for token in parsed:
        if token not in _PRECEDENCE:
            label = label_of(token)
            stack.append(frozenset([label] if label else []))
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left if token == "with" else left | right)
    return stack[0]


def choices(expression: str) -> list[frozenset[str]] | None:
    """The sets of labels of which one must be kept to: ``or`` unites choices, ``and``
    combines them, ``with`` leaves its licence's. None if the expression doesn't parse. Their
    number may be as the power of the ``and``s; ``labels_of`` needs no such list."""
    parsed = postfix(expression)
    if parsed is None:
        return None
    stack: list[list[frozenset[str]]] = []
    for token in parsed:
        if token not in _PRECEDENCE:
            label = label_of(token)
            stack.append([frozenset([label] if label else [])])
            continue
        right, left = stack.pop(), stack.pop()
        if token == "or":
            stack.append(list(dict.fromkeys(left + right)))
        elif token == "and":
            stack.append(list(dict.fromkeys(a | b for a in left for b in right)))
        else:
            stack.append(left)
    return stack[0]


def automaton() -> ahocorasick.Automaton:
    """Phrases between spaces, for a text's words, and the tag, for a raw text."""
    found = ahocorasick.Automaton()
    for phrase, label in (BASE | MORE | {TAG_WORDS: ""}).items():
        found.add_word(f" {phrase} ", (phrase, label, phrase.count(" ") + 1))
    found.add_word(TAG, (TAG, "", 1))
    found.make_automaton()
    return found


def scan(text: str | None, phrases: ahocorasick.Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(_TABLE).split(b" ")
    joined = b" ".join(filter(None, words)).decode("latin-1")  # one character a byte
    n_words = joined.count(" ") + 1 if joined else 0
    padded, starts, base, labels, hits, tagged = f" {joined} ", [], set(), set(), 0, False
    counted_to = counted = 0
    for end, (phrase, label, size) in phrases.iter(padded):
        if phrase == TAG_WORDS:
            tagged = True
            continue
        hits += 1
        labels.add(label)
        if phrase in BASE:
            base.add(label)
            counted += padded.count(" ", counted_to, end + 1)  # spaces up to the end of the match
            counted_to = end + 1
            starts.append(counted - 1 - size)
    expressions = []
    if tagged:
        for end, (phrase, _, _) in phrases.iter(raw.translate(_LOWER).decode("latin-1")):
            if phrase == TAG and (parsed := postfix(said := _LINE.match(raw, end + 1)[0].decode("utf-8", "replace"))):
                hits += 2
                labels.update(labels_of(parsed))
                expressions.append(said.strip())
    return n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1 - 0.5**hits, expressions


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id and what ``scan`` finds in each whole text; score grows with the number
    of places (a tag counts as two): 1 - 2**-places."""
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton()
        for batch in batches:
            found = [(i, *scan(t.as_py(), phrases)) for i, t in zip(batch.column(0).to_pylist(), pc.fill_null(batch.column(1), ""))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * len(names), kinds)], names=names)

    return id_and_text(docs).mapInArrow(lean(rows), schema)
