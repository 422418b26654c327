"""Whole-text encoding that hands each distinct word to a word encoder once.

The vocabulary is a BPE with word ends: its pre-tokenizer drops white space, so a
text's ids are those of its white-space separated chunks, one after another.
ASCII punctuation behind a letter always begins a new pre-token, so "word," has
the ids of "word" and of ",". Neither NFC nor lower-casing crosses white space, but a
letter may end in a combining mark after them (U+0130 does), which is no letter and takes
the punctuation to itself; so the split asks for a last letter that lower-casing and NFC
leave a letter. Texts with the string of an added token are encoded whole, as that string
may lie anywhere.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from weft.llm.common import caches

PUNCTUATION = "!\"#$%&'()*+,-./:;=?@[\\]^_`{|}~"
SLICE_BYTES = 4 << 20

_encoders: dict[tuple, TextEncoder] = {}
caches["encoders"] = _encoders.clear


def ends_in_letter(body: str) -> bool:
    """Whether the body's normal form ends in a letter."""
    if body[-1] < "Ā":
        return body[-1].isalpha()
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", body)[-1:].lower())[-1:].isalpha()


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``texts`` in runs of about ``most`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64))
    begin = 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield texts.slice(begin, end - begin)
        begin = end


class TextEncoder:
    """encode(texts) for pyarrow string arrays.

    ``words(list of keys)`` returns the ids of each key and ``whole(text)`` those
    of one text. Keys are kept between calls; the store is emptied when it passes
    ``most_keys``, which bounds a worker's memory.
    """

    def __init__(self, words: Callable, whole: Callable, added: list[str], most_keys: int = 400_000):
        self.words, self.whole, self.added, self.most_keys = words, whole, added, most_keys
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(1, np.int64)
        self.length = np.zeros(1, np.int64)

    def learn(self, keys: list[str]) -> None:
        """Encodes the keys not yet in the store."""
        ids, lengths = self.words(keys)
        n = len(self.index)
        self.index.update(zip(keys, range(n, n + len(keys))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.flat = np.concatenate([self.flat, ids])

    def parts(self, chunks: list[str]) -> np.ndarray:
        """For each chunk the store's rows of its body and of the punctuation behind it."""
        if len(self.index) + len(chunks) > self.most_keys:
            self.clear()
        keys: list[str] = []
        for chunk in chunks:
            body = chunk.rstrip(PUNCTUATION)
            tail = chunk[len(body) :]
            if tail and body and not ends_in_letter(body):
                body, tail = chunk, ""
            if body and (body.isascii() or max(body) < "Ā"):
                body = body.lower()
            keys += (body, tail)
        index = self.index
        if missing := list({k for k in keys if k not in index}):
            self.learn(missing)
        return np.fromiter((index[k] for k in keys), np.int64, len(keys)).reshape(-1, 2)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the store's rows one after another, and the end of each row's ids."""
        lengths = self.length[rows]
        ends = np.cumsum(lengths)
        at = np.repeat(self.start[rows] - (ends - lengths), lengths)
        at += np.arange(len(at))
        return self.flat[at], ends

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, offsets by text, and the store's rows with their offsets by text."""
        chunks = pc.ascii_split_whitespace(texts)
        offsets = np.asarray(chunks.offsets).astype(np.int64)
        coded = chunks.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = (offsets - offsets[0]) * 2
        rows = self.parts(coded.dictionary.to_pylist())[np.asarray(coded.indices)].ravel() if len(coded) else np.zeros(0, np.int64)
        ids, ends = self.gather(rows)
        return ids, np.concatenate([[0], ends])[offsets], rows, offsets

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """The row number and the ids (uint32) of each text, in order; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        row = 0
        for some in slices(texts):
            odd = self.with_added(some)
            plain = pc.if_else(pa.array(odd), "", some) if odd.any() else some
            ids, offsets, _, _ = self.encode_slice(plain)
            for k in range(len(some)):
                yield row, (np.asarray(self.whole(some[k].as_py()), np.uint32) if odd[k] else ids[offsets[k] : offsets[k + 1]])
                row += 1

    def with_added(self, texts: pa.Array) -> np.ndarray:
        odd = np.zeros(len(texts), bool)
        for a in self.added:
            odd |= np.asarray(pc.match_substring(texts, a))
        return odd


def added_tokens(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def library_encoder(path: str) -> TextEncoder:
    """A TextEncoder whose words are encoded by the tokenizers library; one for each process."""
    if ("library", path) in _encoders:
        return _encoders["library", path]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    full = Tokenizer.from_file(path)
    full.no_truncation()
    full.no_padding()
    # the same vocabulary for words that are letters only: nothing to normalise or split in them
    letters = Tokenizer.from_file(path)
    letters.no_truncation()
    letters.no_padding()
    letters.normalizer = normalizers.Sequence([])
    letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    last = np.zeros(full.get_vocab_size(with_added_tokens=True), bool)
    for token, i in full.get_vocab(with_added_tokens=False).items():
        last[i] = token.endswith("</w>")

    def words(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        simple = [k.isalpha() and max(k) < "Ā" for k in keys]
        plain = [k for k, s in zip(keys, simple) if s]
        joined = [" ".join(plain[i : i + 200]) for i in range(0, len(plain), 200)]
        ids = [np.asarray(e.ids, np.uint32) for text in joined for e in letters.encode_batch_fast([text], add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.uint32), *ids])
        ends = np.flatnonzero(last[ids]) + 1
        if len(ends) != len(plain):
            raise AssertionError("a word of letters has one token with a word end")
        begins = np.concatenate([[0], ends[:-1]])
        rest = [np.asarray(e.ids, np.uint32) for e in full.encode_batch_fast([k for k, s in zip(keys, simple) if not s], add_special_tokens=False)]
        out, lengths, p, r = [], np.zeros(len(keys), np.int64), 0, 0
        for n, s in enumerate(simple):
            if s:
                out.append(ids[begins[p] : ends[p]])
                p += 1
            else:
                out.append(rest[r])
                r += 1
            lengths[n] = len(out[-1])
        return np.concatenate([np.zeros(0, np.uint32), *out]), lengths

    made = TextEncoder(words, lambda text: full.encode(text, add_special_tokens=False).ids, list(added_tokens(path)))
    return _encoders.setdefault(("library", path), made)
