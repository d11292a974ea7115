"""Token files with Re-Pair grammar compression (operator 7).

Documents are sorted by id (range partitions), encoded, and cut into shards
of at most ``shard_ids`` ids, each a row of a Parquet table (the file
format): the grammar's rules (pairs of symbols), the expansion length of
every symbol above the vocabulary, the compressed symbols, and per document
its id, its number of ids and the symbol at which it starts.  So one
document, or a range of its ids, is decoded from its own symbols alone.

Re-Pair: pairs of neighbouring symbols are counted over the shard; pairs
that occur at least ``least`` times become nonterminals, and this is repeated
until no pair occurs so often.  A round replaces many pairs at once: where
two overlap, the more frequent wins, or of equals the one of higher hash, so
copies are cut alike and shrink by a constant factor.  The most frequent pair
wins everywhere, so every round makes a rule.  No pair reaches over the end
of a document.

Defined results: a null or empty text has only the end id; null ids sort
first; rows that repeat an id keep their order by text; a text longer than a
shard is a shard of its own; no rows, no output.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.bpe import BpeModel, byte_symbols
from marquee.llm.common import small_batches
from marquee.llm.tokens import KEEP, WordMemory, kept

BASE = 1 << 17            # symbols from here on are nonterminals
BINS = 20                 # log2 of the bins of the first pair count
FILE = ("part int, shard long, n_ids long, doc_id array<long>, n_tokens array<int>, first array<int>, "
        "rules binary, lengths binary, symbols binary")


class LibraryWords:
    """Ids of words by the tokenizers library: its normaliser and splitter
    where a word is not plainly letters, its BPE model for each new piece."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.cut = BpeModel(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.shown = byte_symbols()
        self.known: dict = {}
        # a word's last mark is a piece of its own, unless a special token is within such a word
        plain = any(not t.strip(".,") or t.rstrip(".,").isalpha() for t in self.cut.special)
        self.ends = () if plain else (b".", b",")

    def _piece(self, piece: str) -> tuple[int, ...]:
        got = self.known.get(piece)
        if got is None:
            if piece[0] == "\0" and piece[1:] in self.cut.special:
                got = (self.cut.special[piece[1:]],)
            else:
                text = piece if piece.isascii() and piece.isprintable() else \
                    "".join([self.shown[b] for b in piece.encode("utf-8", "surrogatepass")])
                got = tuple([t.id for t in self.model.tokenize(text)])
            self.known[piece] = got            # tuples of numbers, which the garbage collector need not walk
        return got

    def __call__(self, words: list[bytes]) -> list[tuple[int, ...]]:
        if len(self.known) > KEEP:
            self.known = {}
        out, get, piece, pieces = [], self.known.get, self._piece, self.cut.pieces
        for w in words:
            if w.isalpha():                    # ASCII letters: one piece
                p = w.lower().decode()
                out.append(get(p) or piece(p))
            elif w[-1:] in self.ends and w[:-1].isalpha():
                p, q = w[:-1].lower().decode(), w[-1:].decode()
                out.append((get(p) or piece(p)) + (get(q) or piece(q)))
            else:
                one = ()
                for p in pieces(w.decode("utf-8", "surrogatepass")):
                    one += get(p) or piece(p)
                out.append(one)
        return out


def _mixed(pair: np.ndarray) -> np.ndarray:
    return (pair * np.int64(-7046029254386353131)).view(np.uint64)


def compress(ids: np.ndarray, last: np.ndarray, least: int = 24):
    """(rules, lengths, symbols, start of each document in symbols).
    ``last`` marks the last id of each document.

    ``at`` holds the positions whose pair may still be frequent.  The count
    of a pair only falls while its two symbols stay, so a pair once below
    ``least`` leaves, and only pairs with a new symbol come in."""
    n = len(ids)
    sym, end = ids.astype(np.int64), last.copy()
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    alive, mark = np.ones(n, bool), np.zeros(n, bool)
    rules, lengths, made_so_far = [], [np.ones(1, np.int64)], 0
    at = np.flatnonzero(~end)
    while len(at) >= least:
        pair = sym[at] << 32 | sym[nxt[at]]
        if len(at) >= 1 << 15:        # most rare pairs leave by an upper bound of their counts
            bins = (_mixed(pair) >> np.uint64(64 - BINS)).astype(np.int64)
            some = (np.bincount(bins, minlength=1 << BINS) >= least)[bins]
            at, pair = at[some], pair[some]
        which, name = pd.factorize(pair)
        beside = nxt[at[:-1]] == at[1:]          # overlaps the next position of ``at``
        # of a run of one symbol, every second position counts
        runs = np.append(False, beside & (which[1:] == which[:-1]))
        order = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(runs, 0, order))
        odd = (order - begin) % 2 == 1
        count = np.bincount(which[~odd], minlength=len(name))
        often = count >= least
        if not often.any():
            break
        rank = np.empty(len(name), np.int64)
        rank[np.lexsort((_mixed(name), count))] = np.arange(len(name))
        here = often[which]
        at, which, odd = at[here], which[here], odd[here]
        score = np.where(odd, -1, rank[which])
        beside = nxt[at[:-1]] == at[1:]
        pick = ~odd
        pick[1:] &= ~beside | (score[1:] > score[:-1])
        pick[:-1] &= ~beside | (score[:-1] > score[1:])
        wins = np.bincount(which[pick], minlength=len(name))
        good = wins >= max(2, least // 2)
        good[np.argmax(rank)] = True             # wins wherever it stands
        pick &= good[which]
        number = np.cumsum(good) - 1 + BASE + made_so_far
        made = np.stack([name[good] >> 32, name[good] & 0xFFFFFFFF], axis=1)
        size = np.concatenate(lengths)
        rules.append(made)
        lengths = [size, size[np.maximum(made - BASE + 1, 0)].sum(axis=1)]
        made_so_far += len(made)
        spot = at[pick]
        gone = nxt[spot]
        sym[spot] = number[which[pick]]
        end[spot] = end[gone]
        alive[gone] = False
        after = nxt[gone]
        nxt[spot] = after
        prv[after[after < n]] = spot[after < n]
        mark[at] = True
        mark[spot] = True
        left = prv[spot]
        mark[left[left >= 0]] = True
        mark[gone] = False
        at = np.flatnonzero(mark)
        mark[at] = False
        at = at[~end[at]]
    rules = np.concatenate([np.zeros((0, 2), np.int64), *rules])
    lengths = np.concatenate(lengths)[1:]
    sym, end = sym[alive], end[alive]
    first = np.concatenate([[0], np.flatnonzero(end)[:-1] + 1]) if len(end) else np.zeros(0, np.int64)
    return rules, lengths, sym, first


def _lengths(rules: np.ndarray) -> np.ndarray:
    """Expansion length of every rule; rules name earlier ones only."""
    out = [1] * len(rules)
    for k, (a, b) in enumerate((np.maximum(rules - BASE, -1)).tolist()):
        out[k] = (out[a] if a >= 0 else 1) + (out[b] if b >= 0 else 1)
    return np.array(out, np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids that symbols stand for; each symbol's place is known from the
    expansion lengths, so only nonterminals are touched again."""
    size = np.concatenate([np.ones(1, np.int64), _lengths(rules) if lengths is None else lengths])
    sym = symbols.astype(np.int64)
    stop = np.cumsum(size[np.maximum(sym - BASE + 1, 0)])
    at = np.concatenate([[0], stop[:-1]]).astype(np.int64)
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.int64)
    while len(sym):
        plain = sym < BASE
        out[at[plain]] = sym[plain]
        sym, at = sym[~plain], at[~plain]
        pair = rules[sym - BASE]
        at = np.concatenate([at, at + size[np.maximum(pair[:, 0] - BASE + 1, 0)]])
        sym = np.concatenate([pair[:, 0], pair[:, 1]])
    return out


def id_range(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Ids start..stop of a run of symbols, expanding only those needed."""
    size = np.concatenate([np.ones(1, np.int64), lengths])[np.maximum(symbols - BASE + 1, 0)]
    end = np.cumsum(size)
    a, b = np.searchsorted(end, start, "right"), np.searchsorted(end, stop, "left") + 1
    skip = start - (end[a] - size[a]) if a < len(end) else 0
    return expand(symbols[a:b], rules, lengths)[skip:skip + stop - start]


def _row(part: int, shard: int, docs: list, ids: list, least: int) -> dict:
    sizes = np.array([len(i) for i in ids], np.int64)
    last = np.zeros(int(sizes.sum()), bool)
    last[np.cumsum(sizes) - 1] = True
    rules, lengths, sym, first = compress(np.concatenate(ids), last, least)
    return {"part": part, "shard": shard, "n_ids": len(last), "doc_id": docs, "n_tokens": sizes.tolist(), "first": first.tolist(),
            "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(), "symbols": sym.astype("<u4").tobytes()}


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_ids: int = 1_000_000,
                      least: int = 24, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all documents in ascending id order and write the shards."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        memory = kept(f"library:{tokenizer}", lambda: WordMemory(LibraryWords(tokenizer), 2 * KEEP))
        names, held, total, shard = [], [], 0, 0
        for pdf in batches:
            ids, sizes = memory.batch(pdf["text"].tolist())
            for name, one in zip(pdf["doc_id"].tolist(), np.split(ids, np.cumsum(sizes)[:-1])):
                one = np.append(one, end_id)
                if held and total + len(one) > shard_ids:
                    yield pd.DataFrame([_row(part, shard, names, held, least)])
                    names, held, total, shard = [], [], 0, shard + 1
                names.append(None if name != name else int(name))
                held.append(one)
                total += len(one)
        if held:
            yield pd.DataFrame([_row(part, shard, names, held, least)])

    rows.mapInPandas(run, FILE).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, digest) -> DataFrame:
    """Per document of the written files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``digest(ids)`` (a function of the
    document's numpy ids) as ``value`` (long).  Only the shards' numbers of
    ids are summed up in one task, to know where each shard begins."""
    files = spark.read.schema(FILE).parquet(path)
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    begin = files.select("part", "shard", "n_ids").withColumn("begin", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                rules = np.frombuffer(r.rules, "<u4").reshape(-1, 2).astype(np.int64)
                sym = np.frombuffer(r.symbols, "<u4")
                first = np.append(np.asarray(r.first, np.int64), len(sym))
                sizes = np.asarray(r.n_tokens, np.int64)
                lengths = np.frombuffer(r.lengths, "<u4").astype(np.int64)
                size = np.concatenate([np.ones(1, np.int64), lengths])
                if (size[np.maximum(rules - BASE + 1, 0)].sum(axis=1) != lengths).any():
                    raise ValueError("a rule's length differs from its symbols'")
                upto = np.concatenate([[0], np.cumsum(size[np.maximum(sym.astype(np.int64) - BASE + 1, 0)])])
                if (np.diff(upto[first]) != sizes).any():
                    raise ValueError("a document's ids differ in number from the file's")
                ids = np.split(expand(sym, rules, lengths), np.cumsum(sizes)[:-1])
                yield pd.DataFrame({"part": r.part, "shard": r.shard, "doc_id": pd.array(list(r.doc_id), "Int64"),
                                    "at": np.cumsum(sizes) - sizes, "n_tokens": sizes, "value": [digest(i) for i in ids]})

    docs = files.mapInPandas(run, "part int, shard long, doc_id long, at long, n_tokens long, value long")
    return docs.join(begin.drop("n_ids"), ["part", "shard"]) \
        .select("doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "value")
