"""BPE encoding and decoding by batched numpy merge rounds (operator 9).

The symbols of all new words of a batch lie in one flat array.  In every
round each word finds its adjacent pair of lowest rank -- by binary search
over the sorted keys of all mergeable pairs -- and merges that pair
wherever it stands in the word (left to right, without overlap).  Words
without a mergeable pair leave the array.

The vocabulary comes from a tokenizer file (its path is a parameter) with
NFC, white-space and lower-case normalisation, a splitting pattern, byte
symbols and an end-of-word suffix.  ``encode`` keeps every input column and
adds ``ids``; ``decode`` adds ``decoded``.

Defined results: a null or empty text has no ids and decodes to "".  Rows
are independent, so ties, repeated rows, null ids and extra columns pass
through; an input column called like an output one is replaced.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.common import small_batches
from marquee.llm.tokens import KEEP, WordMemory, kept

_NONE = np.int64(2**31)


def byte_symbols() -> list[str]:
    """The printable stand-in character of every byte value: printable
    Latin-1 bytes stand for themselves, the others for U+0100 onwards."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    out = [""] * 256
    for b in shown:
        out[b] = chr(b)
    for i, b in enumerate(rest):
        out[b] = chr(256 + i)
    return out


def token_texts(path: str) -> list[str]:
    """The text of every id of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    named = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}
    out = [""] * (max(named.values()) + 1)
    for text, i in named.items():
        out[i] = text
    return out


class BpeModel:
    """Pair tables and splitting pattern read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        suffix = model["end_of_word_suffix"]
        shown = byte_symbols()
        self.inner = np.array([vocab[c] for c in shown], np.int64)
        self.final = np.array([vocab[c + suffix] for c in shown], np.int64)
        left, right, made = [], [], []
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        key = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.rank = np.arange(len(key), dtype=np.int64)[order]
        self.made = np.array(made, np.int64)
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split.replace(r"\s", r"\p{White_Space}"), regex.V0)
        self.path, self.library, self.known = path, None, {}
        self.assigned: set = set()             # characters found in this Python's Unicode tables
        self.unshown = {c: b for b, c in enumerate(shown)}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    # -- words to pieces
    def _plain(self, text: str) -> list[str]:
        text = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if text.isalpha():
            return [text]
        if text[-1:] in (".", ",") and text[:-1].isalpha():
            return [text[:-1], text[-1]]
        return self.split.findall(text)

    def _by_library(self, text: str) -> list[str]:
        """For characters that this Python's Unicode tables do not have,
        the library's own tables cut the text."""
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
        got = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.unshown[c] for c in piece).decode("utf-8", "surrogatepass") for piece, _ in got]

    def pieces(self, word: str) -> list[str]:
        """Pieces between which no merge happens; a special token is a
        piece of its own, marked by a leading NUL."""
        if word.isalpha():
            return self._plain(word)
        if self.cut is not None and any(s in word for s in self.special):
            out = []
            for i, part in enumerate(self.cut.split(word)):
                out.extend(["\0" + part] if i % 2 else self.pieces(part) if part else [])
            return out
        if not word.isascii() and not self.assigned.issuperset(word):
            if any(unicodedata.category(c) == "Cn" for c in word):
                return self._by_library(word)
            self.assigned.update(word)
        return self._plain(word)

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: pieces, then merge rounds over those pieces
        that no earlier batch has had."""
        cut = [self.pieces(w.decode("utf-8", "surrogatepass")) for w in words]
        if len(self.known) > KEEP:
            self.known = {}
        new = list({p for ps in cut for p in ps if p not in self.known})
        if new:
            self.known.update(zip(new, self.merge(new)))
        return [[i for p in ps for i in self.known[p]] for ps in cut]

    # -- words to ids
    def merge(self, words: list[str]) -> list[np.ndarray]:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        end = np.cumsum(size)
        sym = self.inner[flat]
        sym[end - 1] = self.final[flat[end - 1]]
        word = np.repeat(np.arange(len(raw)), size)
        out: list = [None] * len(raw)
        for i, w in enumerate(words):
            if w[0] == "\0" and w[1:] in self.special:
                out[i] = [self.special[w[1:]]]
        while len(sym):
            pair = sym[:-1] << 32 | sym[1:]
            at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
            rank = np.where((self.key[at] == pair) & (word[:-1] == word[1:]), self.rank[at], _NONE)
            rank = np.append(rank, _NONE)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, first)
            done = best == _NONE
            length = np.diff(np.append(first, len(sym)))
            if done.any():
                for f, n in zip(first[done].tolist(), length[done].tolist()):
                    w = word[f]
                    if out[w] is None:
                        out[w] = sym[f:f + n].tolist()
                if done.all():
                    break
                live = np.repeat(~done, length)
                sym, word, rank = sym[live], word[live], rank[live]
                best, length = best[~done], length[~done]
            hit = rank == np.repeat(best, length)
            if (hit[1:] & hit[:-1]).any():         # a pair of equal symbols may overlap itself
                spot = np.flatnonzero(hit)
                head = np.append(True, np.diff(spot) > 1)
                nth = np.arange(len(spot)) - np.flatnonzero(head)[np.cumsum(head) - 1]
                hit[spot[nth % 2 == 1]] = False
            spot = np.flatnonzero(hit)
            sym = sym.copy()
            sym[spot] = self.made[rank[spot]]
            keep = np.ones(len(sym), bool)
            keep[spot + 1] = False
            sym, word = sym[keep], word[keep]
        return out


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add ``ids`` (array<int>): the ids of every whole text."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("ids") if "ids" in docs.columns else docs
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])
    at = docs.columns.index(text_col)

    def run(batches):
        memory = kept(f"bpe:{path}", lambda: WordMemory(BpeModel(path).encode_words))
        for b in batches:
            ids, sizes = memory.batch(b.column(at).to_pylist())
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            col = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, col], names=[*b.schema.names, "ids"])

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``: the token texts of ``ids`` joined by one space (the
    file names no decoder); ids outside the vocabulary are left out; null
    ids decode to ""."""
    rows = rows.drop("decoded") if "decoded" in rows.columns else rows
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType(), False)])
    at = rows.columns.index(ids_col)

    def run(batches):
        names = kept(f"names:{path}", lambda: token_texts(path))
        n = len(names)
        for b in batches:
            out = []
            for ids in b.column(at):
                got = ids.values.to_pylist() if ids.is_valid else []
                got = [i for i in got if i is not None] if None in got else got
                try:
                    out.append(" ".join([names[i] for i in got]))
                except IndexError:
                    out.append(" ".join([names[i] for i in got if 0 <= i < n]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)
