"""Toxicity scores from two class-conditional Kneser-Ney models.

One model is counted on the documents labelled toxic, one on those labelled ordinary. Each interpolates
pairs of words with the words' continuation counts (after how many different words a word stands), these
with the continuation counts of the words' beginnings (in how many different words a beginning
occurs), so that inflected or compound forms support each other, and at last with one distribution that
both classes share: in how many of all documents, labelled or not, a word occurs. The absolute discounts are
``n1 / (n1 + 2 n2)`` of each class and level, from its counts of counts (one half where there are none).

A token's evidence is the log ratio of its probabilities under the two models, read at the longest of its
expressions (pair, word, beginning) on which the classes differ beyond chance: where the likelihood-ratio
statistic G2 of the documents that have it reaches a limit. All other expressions are rare, or alike in
both classes; they back off to the shared counts, which favour neither. A text's evidence is the sum over
all its tokens, normalised by its length and by the root of it (a few insults in a long text are not
diluted by what is neutral); a logistic curve, fitted on labelled rows that the counts have not seen, turns
it into a score.

Counts are Spark aggregations over all rows, under 64-bit keys of the words. What scoring needs is the
ratios of the differing expressions, all of them: a sliver of the counted ones (some 26 000 on 0.8 GB of
texts), held by every worker as sorted columns of 16 bytes an expression. The curve is fitted on every row
that is set aside for it, by sums that Spark takes over them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch_columns, small, stored
from .lm_scoring import pair_keys, tokenised

_STEM = 5                               # bytes of a word's beginning
_START = 0                              # key of the left word at the start
_LEFT = (1 << 32) - 1
_G2 = 15.0                              # of one degree of freedom: about one in 10 000 by chance
EVIDENCE = ("mean", "by_root", "size")


def word_key(w: bytes) -> int:
    """64-bit key of a word or beginning; never that of the start."""
    return int.from_bytes(xxhash.xxh3_64_digest(w), "little", signed=True) or 1


# Upper case to lower, and every byte that no word has to a space.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Words:
    """The words of some texts, one after the other, as numbers, with the keys of the words and of their beginnings."""

    def __init__(self, texts: list[bytes]):
        every, sizes, kinds = tokenised([t.translate(_LOWER) for t in texts])
        ends = np.cumsum(sizes)
        self.every = np.delete(every, ends - 1)                  # without the ends of texts
        self.sizes, self.n = sizes - 1, len(texts)
        self.doc = np.repeat(np.arange(self.n), self.sizes)
        self.key = np.fromiter(map(word_key, kinds[:-1]), np.int64, len(kinds) - 1)
        self.stem = np.fromiter(map(word_key, [w[:_STEM] for w in kinds[:-1]]), np.int64, len(kinds) - 1)
        # the word before each: -1 at the start of a text
        self.left = np.concatenate(([-1], self.every[:-1]))[:len(self.every)]
        self.left[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = -1


def _in_parts(texts: Iterable[bytes], size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Texts in lists of so many bytes, or one longer text: bounds the memory.

    The words and pairs of a part take some 25 times its bytes, which a worker keeps as long as it lives."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > size:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def left_keys(key: np.ndarray) -> np.ndarray:
    """Short keys of left words: 32 bits tell apart the words before one word. Zero is the start."""
    return key & _LEFT


def _in_documents(keys: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, how often each occurs, and in how many documents."""
    at, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
    docs = np.bincount(np.unique(inverse * n_docs + doc) // n_docs, minlength=len(at))
    return at, n, docs


def _counted(texts: list[bytes], toxic: bool) -> Iterator[pd.DataFrame]:
    """The pairs (kind 2), words (1, ``left`` being the beginning's key) and beginnings (0) of texts of one class."""
    w = Words(texts)
    if not len(w.every):
        return
    pairs, n, docs = _in_documents((w.left + 1) << 32 | w.every, w.doc, w.n)
    first = (pairs >> 32) - 1
    yield pd.DataFrame({"kind": 2, "left": np.where(first < 0, _START, left_keys(w.key[first])), "word": w.key[pairs & 0xFFFFFFFF], "n": n, "docs": docs})
    at, n, docs = _in_documents(w.every, w.doc, w.n)
    yield pd.DataFrame({"kind": 1, "left": w.stem[at], "word": w.key[at], "n": n, "docs": docs})
    s, n, docs = _in_documents(w.stem[w.every], w.doc, w.n)
    yield pd.DataFrame({"kind": 0, "left": 0, "word": s, "n": n, "docs": docs})


_BLOCKS = "bucket int, kind int, toxic boolean, word array<long>, low array<int>, high array<int>, n array<long>, docs array<long>"


def bucket_of(word: np.ndarray, left: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket that sums up an expression. The pairs of a word lie in up to 32 of them: a word beside many others
    (as articles are) is no single task's, yet most of its pairs in a block stand together."""
    mixed = word.view(np.uint64) + (left & 31).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)).astype(np.int64) % buckets


def _block(kind: int, parts: list[tuple[bool, pd.DataFrame]], buckets: int) -> pd.DataFrame:
    """The counts of one kind summed up, as a row for each bucket and class, its expressions sorted by word."""
    word, left, n, docs = (np.concatenate([p[c].to_numpy(np.int64) for _, p in parts]) for c in ("word", "left", "n", "docs"))
    place = bucket_of(word, left, buckets) * 2 + np.repeat([t for t, _ in parts], [len(p) for _, p in parts])
    order = np.lexsort((left, word, place))
    word, left, place = word[order], left[order], place[order]
    at = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (word[1:] != word[:-1]) | (left[1:] != left[:-1]))))
    n, docs, word, left, place = np.add.reduceat(n[order], at), np.add.reduceat(docs[order], at), word[at], left[at], place[at]
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    columns = {"word": word, "low": (left & _LEFT).astype(np.uint32).view(np.int32), "high": (left >> 32).astype(np.int32), "n": n, "docs": docs}
    return pd.DataFrame({"bucket": place[first] // 2, "kind": kind, "toxic": place[first] % 2 == 1, **{c: np.split(v, first[1:]) for c, v in columns.items()}})


def _blocks(counted: Iterable[tuple[bool, pd.DataFrame]], buckets: int, held: int = 1 << 19) -> Iterator[pd.DataFrame]:
    """Counts by class, those of several parts in one: they wait until a kind has ``held`` rows, some 13 MB."""
    waiting: dict[int, list] = {}
    for toxic, rows in counted:
        kind = int(rows["kind"].iloc[0])
        parts = waiting.setdefault(kind, [])
        parts.append((toxic, rows[["left", "word", "n", "docs"]]))
        if sum(len(p) for _, p in parts) >= held:
            yield _block(kind, waiting.pop(kind), buckets)
    for kind, parts in waiting.items():
        yield _block(kind, parts, buckets)


def expression_counts(texts: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """How often each expression occurs (n) and in how many documents (d), toxic (t) and ordinary (p) ones.

    Blocks of expressions are shuffled, not rows: 374 MB for 0.51 GB of documents, as rows 653."""
    buckets = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _blocks(((bool(label), counted) for f in frames for label, rows in f.groupby(label_col)
                            for part in _in_parts(rows[text_col]) for counted in _counted(part, bool(label))), buckets)
    t, at = F.col("toxic"), lambda c: F.get(c, F.col("at"))                                                            # noqa: E731
    of = lambda c, is_toxic: F.sum(F.when(t if is_toxic else ~t, F.col(c)).otherwise(0))                               # noqa: E731
    left = F.shiftleft(at("high").cast("long"), 32).bitwiseOR(at("low").cast("long").bitwiseAND(F.lit(_LEFT)))
    dealt = texts.mapInPandas(count, _BLOCKS).repartitionById(buckets, "bucket")
    rows = (dealt.select("*", F.posexplode("word").alias("at", "key"))
                 .select("bucket", "kind", "toxic", F.col("key").alias("word"), left.alias("left"), at("n").alias("n"), at("docs").alias("docs")))
    return rows.groupBy("bucket", "kind", "word", "left").agg(
        of("n", True).alias("nt"), of("n", False).alias("np"), of("docs", True).alias("dt"), of("docs", False).alias("dp")).drop("bucket")


def differs(toxic: Column, plain: Column, toxic_docs: int, plain_docs: int) -> Column:
    """G2 of an expression in ``toxic`` and ``plain`` documents out of so many."""
    a, b, n, m = toxic.cast("double"), plain.cast("double"), float(toxic_docs), float(plain_docs)
    share = (a + b) / F.lit(max(n + m, 1.0))
    def term(o: Column, e: Column) -> Column:
        return F.when((o > 0) & (e > 0), o * F.log(o / e)).otherwise(F.lit(0.0))
    return 2 * (term(a, n * share) + term(b, m * share) + term(F.lit(n) - a, n * (1 - share)) + term(F.lit(m) - b, m * (1 - share)))


class Model:
    """Log ratios (toxic to ordinary) of the differing expressions, and the curve.

    ``pairs`` as columns ``left`` (the short key of the left word), ``word`` and ``ratio``, ``words`` and ``stems``
    by one key; an expression that is not held is read at the next shorter one, and has ratio 0 where none is held.
    """

    def __init__(self, pairs, words, stems, curve=None):
        pairs = pd.DataFrame(pairs, columns=["left", "word", "ratio"])
        self.curve = np.zeros(len(EVIDENCE) + 1) if curve is None else curve
        lefts, rights = (pairs[c].to_numpy(np.int64) for c in ("left", "word"))
        self._lefts, self._rights = np.unique(lefts), np.unique(rights)
        self.words, self.stems = _Table(words), _Table(stems)
        self.pairs = _Table(pd.Series(pairs["ratio"].to_numpy(float), pair_keys(lefts.view(np.uint64), rights.view(np.uint64)).view(np.int64)))

    def log_ratios(self, w: Words) -> np.ndarray:
        """log p(word | left word, toxic) - log p(word | left word, ordinary) of every token."""
        by_word = self.words.get(w.key, self.stems.get(w.stem, np.zeros(len(w.key))))
        out = by_word[w.every] if len(by_word) else np.zeros(0)
        if len(self.pairs) and len(w.every):
            left = left_keys(w.key)
            begins, ends = _among(left, self._lefts), _among(w.key, self._rights)
            met = np.flatnonzero(np.where(w.left < 0, _START in self._lefts, begins[w.left]) & ends[w.every])
            first = np.where(w.left[met] < 0, _START, left[w.left[met]])
            out[met] = self.pairs.get(pair_keys(first.view(np.uint64), w.key[w.every[met]].view(np.uint64)).view(np.int64), out[met])
        return out

    def evidence(self, texts: list[bytes]) -> np.ndarray:
        """A row of ``EVIDENCE`` for each text; zeros for texts without words."""
        out = []
        for part in _in_parts(texts):
            w = Words(part)
            total, n = np.bincount(w.doc, weights=self.log_ratios(w), minlength=w.n), np.maximum(w.sizes, 1)
            out.append(np.column_stack([total / n, total / np.sqrt(n), np.log1p(w.sizes)]))
        return np.concatenate(out) if out else np.zeros((0, len(EVIDENCE)))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.curve[0] + self.evidence(texts) @ self.curve[1:], -30, 30)))


class _Table:
    """Numbers by key, in two sorted columns, looked up for whole columns."""

    def __init__(self, values):
        found = pd.Series(values, dtype=float).sort_index()
        self.keys, self.values = found.index.to_numpy(np.int64), found.to_numpy(float)

    def __len__(self) -> int:
        return len(self.keys)

    def __eq__(self, other) -> bool:
        return np.array_equal(self.keys, other.keys) and np.array_equal(self.values, other.values)

    def __getitem__(self, key: int) -> float:
        return float(self.values[np.flatnonzero(self.keys == key)[0]])

    def items(self) -> Iterator[tuple[int, float]]:
        return zip(self.keys.tolist(), self.values.tolist())

    def get(self, keys: np.ndarray, other: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return other
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], other)


def _among(keys: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which keys are held (sorted)."""
    if not len(held):
        return np.zeros(len(keys), bool)
    return held[np.minimum(np.searchsorted(held, keys), len(held) - 1)] == keys


def fold(id_col: Column) -> Column:
    """The fold of a row: CRC-32 of its id as text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))


def held_out(id_col: Column) -> Column:
    return fold(id_col) % 4 == 2


class _Level:
    """One class's counts of a level: their discount, their sum and the mass that is left to the level below."""

    def __init__(self, ones: float, twos: float, total: float, kinds: float):
        self.discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        self.total, self.rest = max(total, 1.0), self.discount * kinds / max(total, 1.0) if total else 1.0

    def share(self, count: np.ndarray, below: np.ndarray) -> np.ndarray:
        return np.maximum(count - self.discount, 0) / self.total + self.rest * below


def _levels(rows: DataFrame, columns: tuple[str, str]) -> list[_Level]:
    sums = [F.sum(x) for c in columns for x in ((F.col(c) == 1).cast("double"), (F.col(c) == 2).cast("double"), F.col(c).cast("double"), (F.col(c) > 0).cast("double"))]
    got = [float(x or 0) for x in rows.agg(*sums).first()]
    return [_Level(*got[:4]), _Level(*got[4:])]


def document_counts(docs: DataFrame, text_col: str, wanted: set[int], stems: set[int]) -> tuple[dict[int, int], dict[int, int], int]:
    """In how many documents each wanted word occurs; the same summed over all words with each of the
    ``stems``, and over all words. A row per expression and part of a task is shuffled."""
    shipped = docs.sparkSession.sparkContext.broadcast((np.array(sorted(wanted), np.int64), np.array(sorted(stems), np.int64)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ours, ours_stem = shipped.value
        for part in _in_parts(t for f in frames for t in f[text_col]):
            w = Words(part)
            seen = np.bincount(np.unique(w.every << 32 | w.doc) >> 32, minlength=len(w.key))
            mine, with_stem = _among(w.key, ours), _among(w.stem, ours_stem)
            at, inverse = np.unique(w.stem[with_stem], return_inverse=True)
            yield pd.DataFrame({"kind": np.repeat([1, 0, 2], [mine.sum(), len(at), 1]), "key": np.concatenate((w.key[mine], at, [0])),
                                "n": np.concatenate((seen[mine], np.bincount(inverse, weights=seen[with_stem], minlength=len(at)).astype(np.int64), [seen.sum()]))})
    found = (docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(text_col))
                 .mapInPandas(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).toPandas())
    by = {k: dict(zip(g["key"].tolist(), g["n"].tolist())) for k, g in found.groupby("kind")}
    return by.get(1, {}), by.get(0, {}), by.get(2, {}).get(0, 0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          learn: Column | None = None, curve_rows: int | None = None, curve_part: int = 8, least_g2: float = _G2, most: int | None = None) -> Model:
    """Count the models over ``docs`` and fit the curve.

    Labels are read only from rows where ``learn`` holds (all, by default); of those, one in
    ``curve_part`` fits the curve and all others are counted. Documents without a label, or with a label
    other than 0 and 1, take part in the shared counts. An id with two labels is counted for both.
    Tables without rows or labels give a model that scores every text alike. The model holds every
    differing expression. Neither is bounded, unless the caller wants a smaller model: ``curve_rows`` ids
    (the ones with the smallest folds) for the curve, the others then being counted, and the ``most``
    expressions of each kind with the largest G2, ties to the smaller keys.
    """
    c_id, c_text, c_label, c_use, c_fold = scratch_columns(docs, "_id", "_text", "_label", "_use", "_fold")
    key = F.col(id_col)
    marks = (labels.select(F.col(id_col).alias(c_id), F.col(label_col).cast("int").alias(c_label))
                   .where(F.col(c_label).isin(0, 1)).distinct())
    learnable = key.isNotNull() & (F.lit(True) if learn is None else learn)
    # only ids are joined with the labels; texts are read where they lie
    marked = stored(docs.where(learnable).select(key).distinct().join(marks, F.col(id_col) == F.col(c_id))
                        .select(c_id, c_label, (F.floor(fold(key) / 4) % curve_part == 0).alias(c_use), fold(key).alias(c_fold)),
                    "toxic-marks")
    use = marked.where(F.col(c_use)).select(c_id, c_fold).distinct()
    chosen = stored((use if curve_rows is None else use.orderBy(c_fold, c_id).limit(curve_rows)).select(c_id), "toxic-curve")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    learned = small(stored(marked.join(chosen, c_id, "left_anti").select(c_id, c_label), "toxic-learned"))
    texts = docs.select(key, text.alias(c_text)).join(learned, F.col(id_col) == F.col(c_id)).select(c_text, c_label)

    counts = stored(expression_counts(texts, c_text, c_label), "toxic-counts", "zstd")
    totals = {bool(r[0]): r[1] for r in texts.groupBy(F.col(c_label)).count().collect()}
    n_toxic, n_plain = totals.get(True, 0), totals.get(False, 0)
    g2 = differs(F.col("dt"), F.col("dp"), n_toxic, n_plain)

    pairs = counts.where("kind = 2").drop("kind")
    followed = pairs.groupBy("word").agg(F.sum((F.col("nt") > 0).cast("long")).alias("kt"), F.sum((F.col("np") > 0).cast("long")).alias("kp"))
    known = stored(counts.where("kind = 1").select("word", F.col("left").alias("stem"), "dt", "dp").join(followed, "word"), "toxic-words", "zstd")
    in_words = known.groupBy("stem").agg(F.sum((F.col("kt") > 0).cast("long")).alias("jt"), F.sum((F.col("kp") > 0).cast("long")).alias("jp"))
    begun = stored(counts.where("kind = 0").select(F.col("word").alias("stem"), "dt", "dp").join(in_words, "stem"), "toxic-stems", "zstd")

    def kept(rows: DataFrame, *keys: str) -> DataFrame:
        """The differing expressions."""
        strong = rows.withColumn("g2", g2).where(F.col("g2") >= least_g2)
        return stored(strong if most is None else strong.orderBy(F.col("g2").desc(), *keys).limit(most), "toxic-kept").drop("g2")
    k_pairs, k_words, k_stems = kept(pairs, "left", "word"), kept(known, "word"), kept(begun, "stem")
    # the lower levels of what is kept, and the contexts of the kept pairs: lookups by a small table, as long as it is one
    few = F.broadcast if sum(k.count() for k in (k_pairs, k_words, k_stems)) <= 1_000_000 else lambda table: table
    w_rows = known.join(few(k_pairs.select("word").union(k_words.select("word")).distinct()), "word").select("word", "stem", "kt", "kp")
    need = w_rows.select("stem").union(k_stems.select("stem")).distinct()
    s_rows = begun.join(few(need), "stem").select("stem", "jt", "jp").toPandas()
    contexts = (pairs.join(few(k_pairs.select("left").distinct()), "left").groupBy("left").agg(
        F.sum("nt").alias("ct"), F.sum("np").alias("cp"), F.sum((F.col("nt") > 0).cast("long")).alias("tt"), F.sum((F.col("np") > 0).cast("long")).alias("tp")))
    p_rows = k_pairs.select("left", "word", "nt", "np").join(few(contexts), "left").toPandas()
    w_rows, k_words, k_stems = w_rows.toPandas(), k_words.select("word").toPandas(), k_stems.select("stem").toPandas()
    at_pair, at_word, at_stem = _levels(pairs, ("nt", "np")), _levels(known, ("kt", "kp")), _levels(begun, ("jt", "jp"))
    seen, seen_stem, seen_all = document_counts(docs.select(F.col(text_col).alias(c_text)), c_text, set(w_rows["word"].tolist()), set(s_rows["stem"].tolist()))

    def table(index, values) -> pd.Series:
        return pd.Series(np.asarray(values, float), index=np.asarray(index, np.int64))
    stem_seen = s_rows["stem"].map(seen_stem).fillna(0).to_numpy(float)
    shared = (stem_seen + 0.5) / (seen_all + 0.5)
    in_stem = (w_rows["word"].map(seen).fillna(0).to_numpy(float) + 0.5) / (w_rows["stem"].map(seen_stem).fillna(0).to_numpy(float) + 0.5)
    logs_s, logs_w, logs_p = [], [], []
    for c, x in enumerate("tp"):
        s = table(s_rows["stem"], at_stem[c].share(s_rows["j" + x].to_numpy(float), shared))
        w = table(w_rows["word"], at_word[c].share(w_rows["k" + x].to_numpy(float), s.reindex(w_rows["stem"]).to_numpy() * in_stem))
        total, d = p_rows["c" + x].to_numpy(float), at_pair[c].discount
        back = np.where(total > 0, d * p_rows["t" + x].to_numpy(float) / np.maximum(total, 1), 1.0)
        own = np.maximum(p_rows["n" + x].to_numpy(float) - d, 0) / np.maximum(total, 1)
        logs_s.append(np.log(s)), logs_w.append(np.log(w)), logs_p.append(np.log(own + back * w.reindex(p_rows["word"]).to_numpy()))
    r_stem, r_word, r_pair = logs_s[0] - logs_s[1], logs_w[0] - logs_w[1], logs_p[0] - logs_p[1]
    model = Model(p_rows[["left", "word"]].assign(ratio=r_pair), r_word[k_words["word"].to_numpy(np.int64)], r_stem[k_stems["stem"].to_numpy(np.int64)])
    for used in (counts, known, begun):
        discard(used)

    calibrate = marked.join(chosen, c_id, "left_semi").select(c_id, c_label)
    rows = docs.select(key, text.alias(c_text)).join(small(calibrate), F.col(id_col) == F.col(c_id))
    found = stored(_evidence(rows.select(c_text, c_label), model, c_text, c_label), "toxic-evidence")
    model.curve = curve_over(found, c_label)
    return model


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method; with one class or none, that class's smoothed rate."""
    design = np.column_stack([np.ones(len(x)), x])

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = design @ beta
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return (np.logaddexp(0, z) - y * z).sum(), design.T @ (y - p), (design * (p * (1 - p))[:, None]).T @ design
    return newton(sums, len(y), y.sum(), x.shape[1], ridge, rounds)


def curve_over(rows: DataFrame, label_col: str, x: tuple[str, ...] = EVIDENCE, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """:func:`fit_curve` on the rows of a stored table, however many: each round is one aggregation, of which
    the driver gets a row with the sums of the loss, its slope and its curvature."""
    n, ones = (float(v or 0) for v in rows.agg(F.count(F.lit(1)), F.sum(label_col)).first())
    design = [F.lit(1.0), *map(F.col, x)]

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z, y = sum((v * F.lit(float(b)) for v, b in zip(design[1:], beta[1:])), F.lit(float(beta[0]))), F.col(label_col)
        p = 1 / (1 + F.exp(-z))
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y * z
        at = rows.select(loss.alias("_l"), (y - p).alias("_e"), (p * (1 - p)).alias("_v"), *[v.alias(f"_x{i}") for i, v in enumerate(design)])
        xs = [F.col(f"_x{i}") for i in range(len(design))]
        got = at.agg(F.sum("_l"), *[F.sum(v * F.col("_e")) for v in xs], *[F.sum(v * u * F.col("_v")) for i, v in enumerate(xs) for u in xs[i:]]).first()
        upper = np.zeros((len(xs), len(xs)))
        upper[np.triu_indices(len(xs))] = got[1 + len(xs):]
        return got[0], np.array(got[1:1 + len(xs)]), upper + np.triu(upper, 1).T
    return np.round(newton(sums, n, ones, len(x), ridge, rounds), 9)          # the order of the sums shows beyond


def newton(sums: Callable, n: float, ones: float, k: int, ridge: float, rounds: int) -> np.ndarray:
    """The coefficients with the least loss, by its ``sums`` over all rows. A step that raises the loss is halved:
    whole steps run away where the curve is flat, as it is for classes that are almost apart."""
    beta, keep, rate = np.zeros(k + 1), np.diag([0.0] + [ridge] * k) * 0.1, (ones + 0.5) / (n + 1.0)
    beta[0] = np.log(rate / (1 - rate))
    if ones in (0, n):
        return beta

    def at(b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, slope, bend = sums(b)
        return loss + b @ keep @ b / 2, slope - keep @ b, bend + keep + 1e-9 * np.eye(len(b))
    loss, slope, bend = at(beta)
    for _ in range(rounds):
        step = np.linalg.solve(bend, slope)
        tried = at(beta + step)
        while tried[0] > loss + 1e-10 * (1 + abs(loss)) and np.abs(step).max() >= 1e-8:
            step = step / 2
            tried = at(beta + step)
        beta, (loss, slope, bend) = beta + step, tried
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _evidence(rows: DataFrame, model: Model, text_col: str, label_col: str) -> DataFrame:
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shipped.value
        for f in frames:
            got = m.evidence(list(f[text_col]))
            yield f[[label_col]].assign(**{c: got[:, k] for k, c in enumerate(EVIDENCE)})
    return rows.mapInPandas(run, f"`{label_col}` int, " + ", ".join(f"{c} double" for c in EVIDENCE))


def add_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (higher: toxic likelier) in a column ``out``, whose name must be free.

    Null texts count as empty; an empty text has no evidence and gets the curve's value at zero. Equal
    texts, repeated rows among them, get equal scores; long texts are read whole; an empty table
    stays empty.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        m = shipped.value
        return pd.Series(m.scores(list(s)), dtype=float)
    return docs.withColumn(out, run(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def keep_clean(docs: DataFrame, labels: DataFrame, limit: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score is ``limit`` or more; columns as they are, whatever their names.

    Null and empty texts, rows without an id and repeated rows are scored like all others and stay
    unless their text is rejected; an empty table gives an empty one.
    """
    model = train(docs, labels, id_col, text_col, learn=~held_out(F.col(id_col)))
    c_score, = scratch_columns(docs, "_score")
    return add_score(docs, model, text_col, c_score).where(F.col(c_score) < limit).select(*docs.columns)
