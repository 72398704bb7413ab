"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no token of the vocabulary can never be merged, so the
text is certain to split there. Fragments between such cuts are encoded on their own,
each distinct one once per worker while it is remembered, and the ids concatenated.

The pre-tokenizer looks at its neighbours in two cases, where a cut is not used: an
apostrophe after a symbol (it would start a contraction), and the end of a run of two
or more white-space characters before something else (the last one belongs to what
follows). A character is never cut in two.

Defined cases: a null text is an empty one and gives no ids; special tokens inside a
text are recognised, as the library does; a repeated document gives its own row; an
empty table gives an empty table; other columns are ignored unless kept by `keep`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from umbra.llm.common import TOKENIZERS, in_small_batches, joined_bytes, span_hashes, text_batches, text_rows

DEFAULT_VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.json"
#: Fragments remembered per worker, and the longest of them.
REMEMBERED, REMEMBERED_BYTES = 400_000, 48
#: Characters encoded in one step; a longer text is a step of its own.
BATCH_CHARS = 1_000_000

# White space beyond ASCII: its last bytes look like those of letters.
_WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_ONE_WORD = re.compile(rb" ?[A-Za-z]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def never_inside(tokens: list[bytes]) -> np.ndarray:
    """65,536 flags by first * 256 + second byte: no token holds this pair."""
    never = np.ones(65536, bool)
    for t in tokens:
        b = np.frombuffer(t, np.uint8).astype(np.int64)
        never[b[:-1] * 256 + b[1:]] = False
    return never


class Remembered(dict):
    """Ids by fragment, as little-endian bytes; encodes what it does not know."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, fragment: bytes) -> bytes:
        ids = self.encode(fragment)
        if len(fragment) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[fragment] = ids
        return ids


class Codec:
    """A byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.alphabet = byte_alphabet()
        code = {c: b for b, c in enumerate(self.alphabet)}
        vocabulary = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.token_bytes = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
        for token, i in vocabulary.items():
            self.token_bytes[i] = bytes(code[c] for c in token)
        self.never = never_inside(self.token_bytes)
        for token, i in added.items():
            self.token_bytes[i] = token.encode()
        # Cuts that the pre-tokenizer could see: an apostrophe after a symbol.
        x, y = np.divmod(np.arange(65536), 256)
        word = np.isin(x, np.frombuffer(b"0123456789 \t\n\r\x0b\x0c", np.uint8)) | ((x | 32) >= 97) & ((x | 32) <= 122)
        self.never &= ~((y == 39) & ~word)
        self.never &= (y & 0xC0) != 0x80
        self.never_ascii = self.never & (x < 128) & (y < 128)
        self.space = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
        self.known = Remembered(self._encode_fragment)

    def _encode_fragment(self, fragment: bytes) -> bytes:
        if _ONE_WORD.fullmatch(fragment):  # one pre-token, so merges alone decide
            ids = [t.id for t in self.tokenizer.model.tokenize(fragment.decode().replace(" ", self.alphabet[32]))]
        else:
            ids = self.tokenizer.encode(fragment.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def fragments(self, text: str) -> list[bytes]:
        """The text between certain cuts, as UTF-8."""
        data = text.encode()
        b = np.frombuffer(data, np.uint8)
        if len(b) < 2:
            return [data] if data else []
        pairs = b[:-1].astype(np.int32) * 256 + b[1:]
        cut = (self.never_ascii if _WIDE_SPACE.search(text) else self.never)[pairs]
        space = self.space[b]
        run_end = space[1:-1] & space[:-2] & ~space[2:]
        cut[1:] &= ~run_end
        ends = [*(np.flatnonzero(cut) + 1).tolist(), len(data)]
        return [data[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.added and self.added.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, self.fragments(text)))

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """`encode` of each text. Equal fragments of a batch (by a 64-bit hash) are looked up once."""
        out: list[bytes] = [b""] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if t and (len(t) > BATCH_CHARS or _WIDE_SPACE.search(t) or self.added and self.added.search(t)):
                out[i] = self.encode(t)
            elif t:
                plain.append(i)
        for first, batch in text_batches([texts[i] for i in plain], BATCH_CHARS):
            for k, ids in enumerate(self._encode_batch(batch)):
                out[plain[first + k]] = ids
        return out

    def _encode_batch(self, texts: list[bytes]) -> list[bytes]:
        data, starts, sizes = joined_bytes(texts, gap=1, fill=10)
        cut = self.never[data[:-1].astype(np.int32) * 256 + data[1:]]
        space = self.space[data]
        cut[1:] &= ~(space[1:-1] & space[:-2] & ~space[2:])
        cut[starts[1:] - 1] = True  # before and after the byte that parts two texts
        cut[starts + sizes - 1] = True
        ends = np.append(np.flatnonzero(cut) + 1, len(data))
        begins = np.append(0, ends[:-1])
        real = np.ones(len(ends), bool)
        last = np.searchsorted(begins, starts + sizes)  # the parting bytes are fragments of their own
        real[last] = False
        begins, ends = begins[real], ends[real]
        _, first, of = np.unique(span_hashes(data, begins, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        ids = [self.known[raw[i:j]] for i, j in zip(begins[first].tolist(), ends[first].tolist(), strict=True)]
        count = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        place, n = (np.cumsum(count) - count)[of], count[of]
        upto = np.cumsum(n)
        all_ids = flat[np.repeat(place - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)]
        bounds = np.append(0, upto)[np.searchsorted(begins, np.append(starts, len(data)))]
        return [all_ids[i:j].tobytes() for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        tokens = map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(tokens).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and vocabulary."""
    return Codec(path)


def _plain(source: DataFrame) -> str:
    """The schema of all but the last column."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])


def encode_documents(
    docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False
) -> DataFrame:
    """The columns of `keep`, `ids` (little-endian unsigned 32-bit) and `n_tokens` of every text.

    With `decoded` also `text`, decoded from the ids alone.
    """
    source = docs.select(*[f"`{c}`" for c in keep], docs[text].alias("_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(vocabulary)
        for batch in batches:
            for i, j in text_rows(batch["_text"]):
                part = batch.iloc[i:j]
                ids = own.encode_many(part["_text"].tolist())
                out = part[list(keep)].assign(ids=ids, n_tokens=np.array([len(x) // 4 for x in ids], np.int64))
                yield out.assign(text=list(map(own.decode, ids))) if decoded else out

    return in_small_batches(source).mapInPandas(run, f"{_plain(source)}, ids binary, n_tokens bigint" + ", text string" * decoded)


def decode_documents(encoded: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of `keep` and `text`, decoded from the ids alone; null ids give a null text."""
    source = encoded.select(*[f"`{c}`" for c in keep], encoded[ids].alias("_ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = codec(vocabulary).decode
        for batch in batches:
            yield batch.assign(text=[decode(i) if i is not None else None for i in batch.pop("_ids")])

    return in_small_batches(source).mapInPandas(run, f"{_plain(source)}, text string")
