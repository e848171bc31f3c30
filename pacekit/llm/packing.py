"""Vector bin packing of tokenised documents into training sequences.

A piece has three sizes: tokens, one segment, and the tokens that bear loss (in instruction data
only the answers do). A sequence limits all three. Pieces are placed by the dot-product heuristic:
among the pieces that still fit the open sequence, take the one whose sizes, as shares of the
limits, have the largest dot product with the room left, so that a sequence short of one resource
is filled with pieces that need little of it; where no piece fits, the sequence is closed.
Documents longer than a sequence are cut into whole sequences and a remainder. With ``fill``
(the default) the room left in a closing sequence takes the head of one more piece.

Every task packs the rows of its partition in blocks of ``block`` pieces while it reads them: no
shuffle, memory bounded by a block and one text, and a lost task is simply run again. Pieces of
equal sizes are interchangeable for the heuristic, so it chooses among the different sizes of a
block.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_columns

_CACHE_WORDS = 600_000
_MARKS = b".,;:!?|#*$%&"
_TOKENIZERS: dict[str, "WordTokenizer"] = {}


class _Bounded(dict):
    """A cache that makes what it misses; full, it keeps what it has (the frequent comes early)."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key: bytes) -> bytes:
        value = self.make(key)
        if len(self) < self.size:
            self[key] = value
        return value


def _ends_a_word(stem: bytes) -> bool:
    """Whether the tokenizer cuts between ``stem`` and a mark: its last character is a letter or a number, also once it
    is lower-cased and composed (the small form of a letter may end in a combining mark, which is neither)."""
    return stem[-1:].isalnum() or unicodedata.normalize("NFC", stem.decode("utf-8", "replace").lower())[-1].isalnum()


class WordTokenizer:
    """Ids of whole texts as little-endian 32-bit numbers.

    The vocabulary's words never span ASCII white space, so a text's ids are those of its
    white-space separated parts; nor do they span a letter and the marks behind it, so a part is a
    stem and its marks. Stems that were seen before, without regard to ASCII case, come from a
    bounded cache. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True

        def ids(part: bytes) -> bytes:
            return np.array(tokenizer.encode(part.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()
        self.stems = _Bounded(ids, _CACHE_WORDS)
        self.parts = _Bounded(self._part, _CACHE_WORDS * 2 // 3)

    def _part(self, part: bytes) -> bytes:
        # a capital with a combining mark may have no composed form where the small letter has one
        part = part.lower() if part.isascii() else part
        stem = part.rstrip(_MARKS)
        if not stem or len(stem) == len(part) or not _ends_a_word(stem):
            return self.stems[part]
        return self.stems[stem] + self.stems[part[len(stem):]]

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        parts = self.parts
        for text in texts:
            yield b"".join([parts[w] for w in text.split()])


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pack_block(sizes: np.ndarray, limits: tuple[int, int, int], fill: bool = False, least_cut: int = 16):
    """Pack pieces of ``sizes`` (tokens, loss tokens), each within the limits, by the dot-product
    heuristic. Gives lists of ``(piece, start, length)``; with ``fill`` a piece may be cut, its
    rest stays a piece of its own. Loss tokens of a cut piece are taken to be its last ones.
    """
    at: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for i, (n, loss) in reversed(list(enumerate(sizes.tolist()))):
        at[(n, loss)].append((i, 0))
    tokens, bear = np.array(sorted(at), dtype=np.int64).reshape(-1, 2).T.copy()
    left = np.array([len(at[k]) for k in sorted(at)], np.int64)
    bins, total = [], int(left.sum())
    while total:
        if 2 * np.count_nonzero(left) < len(left):             # drop the sizes that are used up
            tokens, bear, left = tokens[left > 0], bear[left > 0], left[left > 0]
        (room, places, free_loss), seq = limits, []
        while total and places:
            # shares of the limits, weighted by the shares of room left; every piece is one segment
            worth = tokens * (room / limits[0] ** 2) + bear * (free_loss / limits[2] ** 2)
            worth[(left == 0) | (tokens > room) | (bear > free_loss)] = -1.0
            k = int(np.argmax(worth))
            if worth[k] < 0:
                break
            n, loss = int(tokens[k]), int(bear[k])
            i, start = at[(n, loss)].pop()
            seq.append((i, start, n))
            left[k] -= 1
            total -= 1
            room, places, free_loss = room - n, places - 1, free_loss - loss
        if fill and total and places and room >= least_cut:
            # the head of a piece that does not fit: of the longest one, so that few pieces are cut
            head = np.minimum(room, tokens - bear + free_loss)   # leading tokens may bear no loss
            k = int(np.argmax(np.where((left > 0) & (tokens > room) & (head >= least_cut), tokens, -1)))
            if left[k] and tokens[k] > room and head[k] >= least_cut:
                n, loss, take = int(tokens[k]), int(bear[k]), int(head[k])
                i, start = at[(n, loss)].pop()
                left[k] -= 1
                seq.append((i, start, take))
                rest = (n - take, min(loss, n - take))
                same = np.nonzero((tokens == rest[0]) & (bear == rest[1]))[0]
                if len(same):
                    left[same[0]] += 1
                else:
                    tokens, bear, left = np.append(tokens, rest[0]), np.append(bear, rest[1]), np.append(left, 1)
                at[rest].append((i, start + take))
        bins.append(seq)
    return bins


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, "
          "sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, length: int = 4096, segments: int = 512, loss: int | None = None,
                   end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
                   fill: bool = True, block: int = 2048) -> DataFrame:
    """One row per piece: its document's id, where it starts there, its length and the CRC-32 of
    its ids, the document's tokens, the piece's loss tokens, its sequence and its offset there.

    A document is its text's ids and ``end_id``; the first ``prompt_col`` of them bear no loss
    (without that column all bear loss). No sequence has more than ``length`` tokens,
    ``segments`` pieces or ``loss`` loss tokens. Null and empty texts are a document of
    one token; null ids stay null; repeated rows are packed each; an empty table gives no rows.
    ``sequence_id`` is the task's number and a count; offsets are gapless from 0.
    """
    limits = (length, segments, loss or length)
    c_id, c_text, c_prompt = scratch_columns(docs, "_id", "_text", "_prompt")
    cols = docs.select(F.col(id_col).cast("long").alias(c_id), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(c_text),
                       (F.coalesce(F.col(prompt_col), F.lit(0)) if prompt_col else F.lit(0)).cast("long").alias(c_prompt))
    end = np.array([end_id], "<u4").tobytes()
    most = min(length, limits[2])                       # an uncut piece keeps within the loss limit too

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, first = _tokenizer(tokenizer), TaskContext.get().partitionId() << 32
        seq_no, pieces, held = 0, [], 0

        def flush():
            nonlocal seq_no, pieces, held
            out: list[list] = [[] for _ in range(8)]
            sizes = np.array([(n, min(n, bear)) for _, _, _, n, bear, _ in pieces], np.int64).reshape(-1, 2)
            for seq in pack_block(sizes, limits, fill):
                offset = 0
                for i, start, n in seq:
                    doc, ids, base, _, _, tokens = pieces[i]
                    prompt = pieces[i][3] - min(pieces[i][3], pieces[i][4])
                    for col, v in zip(out, (doc, base + start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), tokens,
                                            max(0, start + n - max(start, prompt)), first + seq_no, offset)):
                        col.append(v)
                    offset += n
                seq_no += 1
            pieces, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=[x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            docs_, texts, prompts = (c.to_pylist() for c in batch.columns)
            for doc, ids, prompt in zip(docs_, task.encode(texts), prompts):
                ids += end
                tokens = len(ids) // 4
                for start in range(0, tokens, most):
                    n = min(most, tokens - start)
                    bear = max(0, start + n - max(start, prompt))
                    pieces.append((doc, ids[4 * start:4 * (start + n)], start, n, bear, tokens))
                    held += n
                    if len(pieces) >= block:
                        yield flush()
        if pieces:
            yield flush()

    return cols.mapInArrow(run, SCHEMA)
