"""Language-model scores of documents by a weighted backoff automaton.

A bigram model is learned from the training rows: ``p(w | h) = (1 - m) c(h w) / c(h) + m p(w)``, with the
additive ``p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1))`` below and a backoff weight ``m`` that depends on how
often the context ``h`` was seen: the leave-one-out share of pairs that are new after so many
occurrences, estimated for each power of two. The probabilities of all words after a context sum to one.

The model is run as an automaton. Its states are the contexts: the root (none), the start of a text,
and each word. An arc leaves a state for every word that was seen after it and carries log10 p; a failure
arc leads to the root and carries log10 m; the root has an arc for every word, the unknown one
included. A text is read once from left to right, carrying the state and adding up weights.

The whole automaton of a large corpus fits no worker, so each block of documents gets the part that its
texts can reach. A block is a run of rows of a file; a task cuts it where its split ends (a chunk). The
first pass sends the different words and pairs of every chunk, as sorted 64-bit keys with their training
counts, to shards of the key space; a shard adds up the counts of all chunks and returns to each chunk the
counts of the keys it sent, in their order. The second pass brings the texts of a block together with what
came back, numbers the words again in the same way, builds the block's automaton and runs it. Keys
are dealt by hash and come at most once a chunk, so no word or pair is hot, and every table grows
with the input; only N, V and one rate per power of two reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

_END = b""                              # the token after the last word; no word is empty
_ADD = 0.1
_LEVELS = 48                            # powers of two of a context's count
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokenised(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The tokens of texts one after the other, as numbers of different words; each text's number of tokens; the words.

    A text's tokens are its words, A-Z lower-cased, and the end. Texts are cut as a column.
    """
    whole = pa.array(texts, pa.large_binary()).view(pa.large_string())
    cut = pc.ascii_split_whitespace(pc.ascii_lower(whole))
    flat, sizes = cut.flatten(), pc.list_value_length(cut).to_numpy(zero_copy_only=False)
    some = pc.greater(pc.binary_length(flat), 0)                 # white space at either side leaves empty parts
    owner = np.repeat(np.arange(len(texts)), sizes)[some.to_numpy(zero_copy_only=False)]
    coded = flat.filter(some).dictionary_encode()
    kinds = [*coded.dictionary.view(pa.large_binary()).to_pylist(), _END]
    sizes = np.bincount(owner, minlength=len(texts)) + 1
    every = np.empty(int(sizes.sum()), np.int64)
    last = np.zeros(len(every), bool)
    last[np.cumsum(sizes) - 1] = True
    every[last], every[~last] = len(kinds) - 1, coded.indices.to_numpy()
    return every, sizes, kinds


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs from the keys of their words (the multiplier is odd, the order matters)."""
    x = left * _MIX + (right ^ (right >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Chunk:
    """The texts of a run of rows: its words numbered in the order of their keys, and its pairs.

    ``texts`` are arrays of word numbers. ``words`` are the words' sorted keys, ``pairs`` the pairs'; the left
    number of a text's first pair is ``len(words)``, that of the start. With ``learn``, a flag per text,
    ``word_counts`` and ``pair_counts`` are the training counts in the order of the keys.
    """

    def __init__(self, texts: list[bytes], learn: np.ndarray | None = None):
        every, sizes, kinds = tokenised(texts)
        keys = np.fromiter(map(xxhash.xxh3_64_intdigest, kinds), np.uint64, len(kinds))
        order = np.argsort(keys)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, every = keys[order], place[every]
        ends = np.cumsum(sizes)
        self.texts = np.split(every, ends[:-1])
        left = np.empty(len(every), np.int64)
        left[1:] = every[:-1]
        left[ends - sizes] = len(keys)
        # pairs of word numbers, sorted with the flag of their text behind them; a text has one token at least
        use = np.ones(len(texts), bool) if learn is None else learn
        flagged = np.sort((left << 31 | every) << 1 | np.repeat(use, sizes))
        packed = flagged >> 1
        first = np.flatnonzero(np.concatenate(([True], packed[1:] != packed[:-1]))[:len(packed)])
        packed = packed[first]
        self.left, self.right = packed >> 31, packed & 0x7FFFFFFF
        known = np.concatenate((self.words, np.zeros(1, np.uint64)))
        keys = pair_keys(known[self.left], known[self.right])
        self.order = np.argsort(keys)
        self.pairs = keys[self.order]
        if learn is not None:
            self.word_counts = np.bincount(every[np.repeat(use, sizes)], minlength=len(self.words))
            self.pair_counts = np.add.reduceat(flagged & 1, first)[self.order] if len(first) else np.zeros(0, np.int64)
            self.n_tokens, self.n_rows = int(sizes[use].sum()), int(use.sum())


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, their bytes side by side, so that the shuffle compresses them."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(n: np.ndarray) -> bytes:
    """Counts in the narrowest type that holds them, named by the first byte."""
    kind = next(k for k in "BHIQ" if not len(n) or n.max() <= np.iinfo(k).max)
    return kind.encode() + n.astype(kind).tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, data[:1].decode(), offset=1).astype(np.int64)


def level(count: np.ndarray) -> np.ndarray:
    """Power of two of a count (0: none)."""
    return np.minimum(np.frexp(count.astype(float))[1], _LEVELS - 1)


class Automaton:
    """States with arcs and one failure arc each; state 0 is the root, which has an arc for each symbol from 1 to ``n``.

    ``keys`` are the arcs' sorted ``state << 32 | symbol``, those of the root first, with their ``weight`` and
    ``target``. A symbol without an arc at the root takes ``unknown`` and leads to the root.
    """

    def __init__(self, n: int, keys: np.ndarray, weight: np.ndarray, target: np.ndarray, fail: np.ndarray, fail_weight: np.ndarray, unknown: float):
        self.n, self.keys, self.weight, self.target = n, keys, weight, target
        self.fail, self.fail_weight, self.unknown = fail, fail_weight, unknown

    def _arc(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The places of the arcs, -1 where there is none."""
        wanted = state << 32 | symbol
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, at, -1)

    def run(self, symbols: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Several texts at once: a column each, padded with 0 below, read row by row from their states.

        Every row carries all states on, along failure arcs (adding their weights) until the symbol has
        an arc. Gives the sums of weights and the last states.
        """
        total, state = np.zeros(len(state)), state.copy()
        for row in symbols:
            live = np.flatnonzero(row)
            s, q = row[live], state[live]
            at = self._arc(q, s)
            while len(miss := np.flatnonzero((at < 0) & (q > 0))):
                total[live[miss]] += self.fail_weight[q[miss]]
                q[miss] = back = self.fail[q[miss]]
                root = back == 0
                at[miss] = np.where(root, np.where(s[miss] <= self.n, s[miss] - 1, -1), -1)
                if not root.all():
                    at[miss[~root]] = self._arc(back[~root], s[miss[~root]])
            total[live] += np.where(at < 0, self.unknown, self.weight[at])
            state[live] = np.where(at < 0, 0, self.target[at])
        return total, state


class Totals:
    """What all blocks share: training tokens, different ones, training rows, and the backoff weights by level."""

    def __init__(self, tokens: int, kinds: int, rows: int, single: np.ndarray, seen: np.ndarray):
        self.tokens, self.kinds, self.rows = tokens, kinds, rows
        rate = (single + 0.5) / (seen + 1.0)
        last = int(np.flatnonzero(seen).max(initial=0))    # counts above those met within a chunk: the highest met
        rate[last + 1:] = rate[last]
        self.backoff = np.clip(rate, 0.01, 0.99)

    def word(self, count: np.ndarray) -> np.ndarray:
        return (count + _ADD) / (self.tokens + _ADD * (self.kinds + 1))


def build(chunk: Chunk, words: np.ndarray, pairs: np.ndarray, totals: Totals) -> Automaton:
    """The part of the automaton that a chunk's texts can reach; state and symbol of word k are k + 1, the start follows."""
    n, seen = len(words), np.concatenate((words, [totals.rows]))
    low = totals.word(words)
    back = totals.backoff[level(seen)]
    fail_weight = np.where(seen > 0, np.log10(back), 0.0)
    count = np.empty(len(pairs), np.int64)
    count[chunk.order] = pairs
    met = np.flatnonzero(count)                            # pairs of the training rows, by left and right number
    left, right = chunk.left[met], chunk.right[met]
    p = (1 - back[left]) * count[met] / seen[left] + back[left] * low[right]
    keys = np.concatenate((np.arange(1, n + 1), (left + 1) << 32 | (right + 1)))
    return Automaton(n, keys, np.log10(np.concatenate((low, p))), np.concatenate((np.arange(1, n + 1), right + 1)),
                     np.zeros(n + 2, np.int64), np.concatenate(([0.0], fail_weight)), log10(totals.word(0)))


def log_probabilities(automaton: Automaton, texts: list[np.ndarray], start: int, width: int = 64) -> np.ndarray:
    """Log10 probabilities of texts of symbols.

    Texts are cut into runs of ``width`` symbols that are read side by side: the state before a run is that of the
    symbol before it, which is all that this automaton remembers of what it has read.
    """
    sizes = np.array([len(a) for a in texts], np.int64)
    runs = -(-sizes // width)
    every = np.concatenate(texts)
    owner = np.repeat(np.arange(len(texts)), runs)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)              # the run's number in its text
    first = np.repeat(np.cumsum(sizes) - sizes, runs) + begin * width
    state = np.where(begin == 0, start, every[first - 1])
    place = first + np.arange(width)[:, None]
    inside = place < np.repeat(np.cumsum(sizes), runs)
    symbols = np.where(inside, every[np.minimum(place, len(every) - 1)], 0)
    return np.bincount(owner, weights=automaton.run(symbols, state)[0], minlength=len(texts))


_PIECE = "block string, first long, shard long, kind int, keys binary, counts binary"
_BACK = "block string, first long, shard long, kind int, counts binary, n_kinds long"


def _pieces(chunk: Chunk, block: str, first: int, shards: int) -> pd.DataFrame:
    """A chunk's words (kind 1) and pairs (kind 2) by shard, and (kind 0) its share of the totals."""
    words, pairs, n_tokens, n_rows = chunk.word_counts, chunk.pair_counts, chunk.n_tokens, chunk.n_rows
    rows = []
    for kind, keys, counts in ((1, chunk.words, words), (2, chunk.pairs, pairs)):
        cuts = np.searchsorted(keys, np.array([(s << 64) // shards for s in range(1, shards)], np.uint64))
        for s, (k, c) in enumerate(zip(np.split(keys, cuts), np.split(counts, cuts))):
            if len(k):
                rows.append((block, first, s, kind, pack_keys(k), pack_counts(c)))
    # contexts by how often the chunk has them: their tokens, and the pairs seen once
    seen = np.concatenate((words, [n_rows]))
    by_pair = np.empty(len(pairs), np.int64)
    by_pair[chunk.order] = pairs
    at = level(seen)
    tokens_at = np.bincount(at, weights=seen, minlength=_LEVELS)
    single = np.bincount(at[chunk.left[by_pair == 1]], minlength=_LEVELS)
    sums = np.concatenate(([n_tokens, n_rows], tokens_at, single)).astype(np.int64)
    rows.append((block, first, xxhash.xxh3_64_intdigest(f"{block} {first}") % shards, 0, b"", pack_counts(sums)))
    return pd.DataFrame(rows, columns=["block", "first", "shard", "kind", "keys", "counts"])


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """The counts of a shard's keys over all chunks, returned to each chunk in the order of its keys."""
    out = []
    for kind, part in rows.groupby("kind", sort=False):
        if kind == 0:                                      # one row for all of a shard
            total = np.sum([unpack_counts(c) for c in part["counts"]], axis=0)
            out.append(part[["block", "first", "shard", "kind"]].head(1).assign(counts=[pack_counts(total)], n_kinds=0))
            continue
        keys = [unpack_keys(k) for k in part["keys"]]
        every, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([unpack_counts(c) for c in part["counts"]]), minlength=len(every)).astype(np.int64)[at]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        back = part[["block", "first", "shard", "kind"]].assign(counts=[pack_counts(x) for x in np.split(total, ends)], n_kinds=0)
        kinds = np.zeros(len(every), bool)
        kinds[at] = total > 0
        back.iloc[0, back.columns.get_loc("n_kinds")] = int(kinds.sum())
        out.append(back)
    return pd.concat(out)


def _scored(texts: pd.DataFrame, back: pd.DataFrame, totals: Totals) -> pd.DataFrame:
    """Scores of a block's rows with the counts that came back to its chunks."""
    texts, out = texts.sort_values("row", kind="stable"), []
    firsts = np.sort(back["first"].unique())
    for k, first in enumerate(firsts):
        inside = (texts["row"] >= first) & ((texts["row"] < firsts[k + 1]) if k + 1 < len(firsts) else True)
        rows, got = texts[inside], back[back["first"] == first].sort_values("shard")
        chunk = Chunk([bytes(t) for t in rows["text"]])
        words, pairs = (np.concatenate([np.zeros(0, np.int64), *map(unpack_counts, got["counts"][got["kind"] == kind])]) for kind in (1, 2))
        automaton, base = build(chunk, words, pairs, totals), np.log10(totals.word(words))
        out.append(rows[["id", "held_out"]].assign(
            n_tokens=[len(a) for a in chunk.texts], n_known=[int((words[a] > 0).sum()) for a in chunk.texts],
            base_score=[float(base[a].sum()) for a in chunk.texts],
            score=log_probabilities(automaton, [a + 1 for a in chunk.texts], len(words) + 1)))
    return pd.concat(out)


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 5_000_000,
          shard_bytes: int = 24_000_000, from_files: bool = False) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs``, by its id.

    ``learn`` says which rows the model is learned from (null: not); ``base_score`` is the log10 probability under
    the words alone, ``score`` under the model. Null and empty texts consist of the end alone; repeated
    rows are counted and scored each. Without training rows every token is unknown and alike; an empty
    table gives an empty result. Other columns are not read. ``block_bytes`` (of text, on
    average) bounds what a task holds, a single longer text apart; ``shard_bytes`` of input share a shard.
    ``from_files`` says that ``docs`` is a Parquet table as it is read, whose rows are found again by file and
    place; other rows are first written as one.
    """
    text, held = F.coalesce(F.col(text_col), F.lit("")).cast("binary"), ~F.coalesce(learn, F.lit(False))
    columns = [F.col(id_col).alias("id"), text.alias("text"), held.alias("held_out")]
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    placed = docs.select(*columns, *place) if from_files else stored(docs.select(*columns), "lm-texts").select("*", *place)
    n_rows, n_bytes = placed.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    per_block = max(1, int(block_bytes * n_rows / max(n_bytes or 0, 1)))
    shards = max(1, int((n_bytes or 0) // shard_bytes))
    placed = placed.withColumn("block", F.concat_ws("#", "file", F.floor(F.col("row") / per_block).cast("string")))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, first, texts, use, size = None, 0, [], [], 0

        def done() -> Iterator[pd.DataFrame]:
            if texts:
                yield _pieces(Chunk(texts, np.array(use)), block, first, shards)
        for f in frames:
            for b, row, t, held in zip(f["block"], f["row"], f["text"], f["held_out"]):
                if b != block or size > 2 * block_bytes:     # also cut where long texts crowd
                    yield from done()
                    block, first, texts, use, size = b, row, [], [], 0
                texts.append(bytes(t))
                use.append(not held)
                size += len(t)
        yield from done()
    pieces = placed.select("block", "row", "text", "held_out").mapInPandas(count, _PIECE)
    back = stored(pieces.groupBy("shard", "kind").applyInPandas(_added, _BACK), "lm-counts")

    def unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for c in f["counts"]:
                n = unpack_counts(c)
                yield pd.DataFrame({"at": np.arange(len(n)), "n": n})
    sums = np.zeros(2 + 2 * _LEVELS)
    for at, n in back.where("kind = 0").select("counts").mapInPandas(unpacked, "at int, n long").groupBy("at").agg(F.sum("n")).collect():
        sums[at] = n
    kinds = back.where("kind = 1").agg(F.sum("n_kinds")).first()[0] or 0
    totals = Totals(int(sums[0]), int(kinds), int(sums[1]), sums[2 + _LEVELS:], sums[2:2 + _LEVELS])

    def run(texts: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        return _scored(texts, got, totals)
    kind_of_id = placed.schema["id"].dataType.simpleString()
    found = (placed.groupBy("block").cogroup(back.where("kind > 0").groupBy("block"))
                   .applyInPandas(run, f"id {kind_of_id}, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return found.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"),
                        "base_score", "score")


def fold(id_col: Column) -> Column:
    """CRC-32 of an id as text (null: of the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))
