"""BPE encoding of distinct words by a depth-first walk over their trie.

A prefix's state is the last token of its encoding. A sequence of tokens is the
BPE encoding of its text just when each neighbouring pair is, so the state of a
prefix is the longest token at its end that pairs with the state of what lies
before that token. Words sorted by code units are the trie in depth-first order:
the path to the next word's first own node is a stack cut back to their common
prefix, whose states are reused. A word's ids are read back along its states.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from weft.llm.common import caches, id_and_text, lean
from weft.llm.tokens import TextEncoder, added_tokens, slices

WORD_END = "</w>"
#: The vocabulary's pre-token pattern (fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_codecs: dict[str, TrieCodec] = {}
caches["codecs"] = _codecs.clear


def byte_units() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class TrieCodec:
    """words(keys), whole(text) and decode for a BPE vocabulary with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): r for r, m in enumerate(model["merges"])}
        self.added = added_tokens(path)
        self.token = {i: t for t, i in (self.vocab | self.added).items()}
        self.unit = byte_units()
        self.pattern = regex.compile(PRE_TOKEN)
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.pair_ok: dict[tuple[int, int], bool] = {}
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(WORD_END)}
        self.final = {t[: -len(WORD_END)]: i for t, i in self.vocab.items() if t.endswith(WORD_END) and t != WORD_END}
        self.reachable: dict[int, bool] = {}
        self.longest = max(map(len, [*self.inner, *self.final]))

    def merged(self, units: list[str]) -> list[str]:
        """Plain BPE by ranks; used for pairs of tokens only."""
        units = list(units)
        while len(units) > 1:
            best = min((self.rank.get(p, len(self.rank)) for p in zip(units, units[1:])))
            if best == len(self.rank):
                break
            out, i = [], 0
            while i < len(units):
                if i + 1 < len(units) and self.rank.get((units[i], units[i + 1])) == best:
                    out.append(units[i] + units[i + 1])
                    i += 2
                else:
                    out.append(units[i])
                    i += 1
            units = out
        return units

    def units_of(self, token: int) -> list[str]:
        text = self.token[token]
        return [*text[: -len(WORD_END) - 1], text[-len(WORD_END) - 1 :]] if text.endswith(WORD_END) and text != WORD_END else [*text]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are side by side; -1 on the left: the word's start."""
        if (found := self.pair_ok.get((left, right))) is None:
            if len(self.pair_ok) > 300_000:  # a bound on memory; the entries are recomputed on demand
                self.pair_ok.clear()
            if left < 0:
                found = self.merged(self.units_of(right)) == [self.token[right]]
            else:
                found = self.merged(self.units_of(left) + self.units_of(right)) == [self.token[left], self.token[right]]
            self.pair_ok[left, right] = found
        return found

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each distinct word (in units, without its word end), by one walk over their trie."""
        out: dict[str, list[int]] = {}
        states: list[int | None] = [-1]  # of the prefixes on the path; None: not yet needed
        path = ""
        inner, final, fits, longest = self.inner, self.final, self.fits, self.longest

        def state(word: str, n: int) -> int:
            """Last token of the encoding of word[:n], an inner node of the trie."""
            if (found := states[n]) is None:
                for begin in range(max(0, n - longest), n):
                    token = inner.get(word[begin:n])
                    if token is not None and fits(state(word, begin) if begin else -1, token):
                        found = token
                        break
                states[n] = found
            return found

        for word in sorted(set(words)):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :]
            states += [None] * (len(word) - shared)
            path, n, ids = word, len(word), []
            if n > 200:  # in order, else the recursion is as deep as the word is long
                for k in range(1, n):
                    state(word, k)
            for begin in range(max(0, n - longest), n):
                token = final.get(word[begin:])
                if token is not None and fits(state(word, begin) if begin else -1, token):
                    ids.append(token)
                    n = begin
                    break
            while n:
                token = state(word, n)
                ids.append(token)
                n -= len(self.token[token])
            out[word] = ids[::-1]
        return out

    def pre_tokens(self, text: str) -> list[str]:
        """The text's pre-tokens in byte units, normalised as the vocabulary asks."""
        if text.isascii():
            text = text.lower()
            if text.isalpha():
                return [text]
        else:
            text = "".join(c.lower() for c in unicodedata.normalize("NFC", text))  # by character: no final sigma
        unit = self.unit
        return ["".join(unit[b] for b in w.encode()) for w in self.pattern.findall(text)]

    def words(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self.pre_tokens(k) for k in keys]
        coded = self.encode_words(w for ws in split for w in ws)
        ids = [[i for w in ws for i in coded[w]] for ws in split]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum())), lengths

    def whole(self, text: str) -> list[int]:
        out: list[int] = []
        for k, part in enumerate(self.split_added.split(text) if self.split_added else [text]):
            if k % 2:
                out.append(self.added[part])
            elif words := self.pre_tokens(part):
                coded = self.encode_words(words)
                out += [i for w in words for i in coded[w]]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary has no decoder: tokens joined by a space."""
        return " ".join(self.token[int(i)] for i in ids)


class DecodingEncoder(TextEncoder):
    """A TextEncoder that also keeps the decoded text of each key."""

    def __init__(self, codec: TrieCodec):
        self.codec = codec
        super().__init__(codec.words, codec.whole, list(codec.added))

    def clear(self) -> None:
        super().clear()
        self.decoded: list[str] = [""]

    def learn(self, keys: list[str]) -> None:
        first = len(self.index)
        super().learn(keys)
        for s, n in zip(self.start[first:], self.length[first:]):
            self.decoded.append(self.codec.decode(self.flat[s : s + n].tolist()))

    def encode_and_decode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, bytes]]:
        """Ids and decoded text (UTF-8) of each text."""
        for some in slices(pc.fill_null(texts.cast(pa.large_string()), "")):
            odd = self.with_added(some)
            ids, offsets, rows, at = self.encode_slice(pc.if_else(pa.array(odd), "", some) if odd.any() else some)
            for k in range(len(some)):
                if odd[k]:
                    own = np.asarray(self.whole(some[k].as_py()), np.uint32)
                    yield own, self.codec.decode(own).encode()
                else:
                    decoded = self.decoded
                    yield ids[offsets[k] : offsets[k + 1]], " ".join([d for r in rows[at[k] : at[k + 1]].tolist() if (d := decoded[r])]).encode()


def codec(path: str) -> TrieCodec:
    if path not in _codecs:
        _codecs[path] = TrieCodec(path)
        _codecs[path].texts = DecodingEncoder(_codecs[path])
    return _codecs[path]


def encode_documents(docs: DataFrame, vocabulary: str, with_output: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text, and with
    ``with_output`` the ids (binary, little-endian unsigned 32-bit) and the decoded text.

    Null text counts as empty: no ids and an empty decoded text. A very long text is encoded
    whole, in one task. Repeated rows and null ids come back as they are; nothing is shuffled.
    Columns other than doc_id and text are left out, so no name clashes. No rows in, no rows out.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_output
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.large_string()][: len(names)]

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = codec(vocabulary).texts
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, (ids, decoded) in zip(batch.column(0).to_pylist(), texts.encode_and_decode(batch.column(1))):
                data = ids.astype("<u4").tobytes()
                for column, value in zip(out, (doc_id, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded).hexdigest(), *((data, decoded.decode()) if with_output else ()))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return id_and_text(docs).mapInArrow(lean(code, "codecs"), schema)
