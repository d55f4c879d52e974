"""Subword lattice likelihood of a text.

The pieces of an existing subword vocabulary and their scores weight every segmentation of a word; a
forward recursion in log space sums over all of them. No piece crosses white space (a word
carries its leading blank), so a document's probability is a product over its words and one end symbol.
Single bytes are pieces too: any text has a probability.

The vocabulary file ranks its pieces by merge order. That rank gives the first scores; expectation
maximisation over all training words (forward-backward on the same lattice) re-estimates them, once for each
class of documents (language label of the training rows). A word that the class has seen has one more way
through its lattice, the whole word, weighted by its discounted count; the mass that the discount frees goes to
the segmentations into pieces. The probability of a document is marginal over segmentations and over classes;
its own label is no input.

Defined results: a null or empty text is the end symbol alone; repeated rows get equal results;
null ids are kept; rows with a null or rare label form one class; without any training row all counts
are 0 and the vocabulary's own scores are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash
from .words import BYTE_VALUE, hash_spans, lower_ascii, mix, powers, slices, spans

LN10 = float(np.log(10))
GROUP_WORDS = 40_000  # words whose lattices a task holds at once
FILTER_BITS = 20


class Lattice:
    """Pieces by hash, with the scores that weight them."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = sorted(set(pieces) | {bytes([b]) for b in range(256)}, key=lambda p: (len(p), p))
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.lengths = sorted({len(p) for p in self.pieces})
        self.likely = np.zeros(1 << FILTER_BITS, bool)
        self.likely[self._slot(hashes)] = True
        self.log_p = np.full((1, len(self.pieces)), -np.log(len(self.pieces)))  # a row per class

    @staticmethod
    def _hash(piece: bytes) -> np.uint64:
        up, _ = powers(len(piece) + 1)
        return (BYTE_VALUE[np.frombuffer(piece, np.uint8)] * up[: len(piece)]).sum(dtype=np.uint64) + np.uint64(len(piece))

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0xD1342543DE82EF95)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def _match(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows whose substring is a piece, the pieces)."""
        rows = np.flatnonzero(self.likely[self._slot(hashes)])
        if not len(rows):
            return rows, rows
        some = hashes[rows]
        at = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
        good = self.hashes[at] == some
        return rows[good], self.order[at[good]]

    def edges(self, block: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, rows, pieces) over words of one byte length, ordered by ``to``."""
        n, size = block.shape
        up, down = powers(size + 1)
        sums = np.zeros((size + 1, n), np.uint64)
        np.cumsum((BYTE_VALUE[block] * up[:size]).T, axis=0, out=sums[1:])
        for end in range(1, size + 1):
            for length in self.lengths:
                if length > end:
                    break
                start = end - length
                rows, found = self._match((sums[end] - sums[start]) * down[start] + np.uint64(length))
                if len(rows):
                    yield start, end, rows, found

    def forward(self, block: np.ndarray, edges=None) -> np.ndarray:
        """Log of the summed weight of all segmentations, by prefix, class and word."""
        n, size = block.shape
        alpha = np.full((size + 1, len(self.log_p), n), -np.inf)
        alpha[0] = 0
        for start, end, rows, found in self.edges(block) if edges is None else edges:
            alpha[end][:, rows] = np.logaddexp(alpha[end][:, rows], alpha[start][:, rows] + self.log_p[:, found])
        return alpha

    def expected(self, block: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece by class, over all segmentations, times the words' weights (class x word)."""
        edges = list(self.edges(block))
        alpha = self.forward(block, edges)
        beta = np.full(alpha.shape, -np.inf)
        beta[-1] = 0
        uses = np.zeros(self.log_p.shape)
        for start, end, rows, found in reversed(edges):
            step = self.log_p[:, found] + beta[end][:, rows]
            beta[start][:, rows] = np.logaddexp(beta[start][:, rows], step)
            share = np.exp(alpha[start][:, rows] + step - alpha[-1][:, rows]) * weight[:, rows]
            for k in range(len(uses)):
                uses[k] += np.bincount(found, weights=share[k], minlength=uses.shape[1])
        return uses

    def set_weights(self, weights: np.ndarray, smooth: float = 0.1) -> None:
        weights = weights + smooth
        self.log_p = np.log(weights / weights.sum(1, keepdims=True))


def load_vocabulary(path: str) -> Lattice:
    """Pieces of a sentencepiece model; its rank scores (-rank) become first weights 1/(rank+1)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rank = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:]:
            rank.setdefault(piece, -model.get_score(i))
    lattice = Lattice(list(rank))
    worst = len(lattice.pieces)
    lattice.set_weights(np.array([[1 / (1 + min(worst, max(0.0, rank.get(p, worst)))) for p in lattice.pieces]]), smooth=0)
    return lattice


def blocks_by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indexes, bytes with the leading blank) of the words of each byte length."""
    raw = [b" " + w.encode() for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        step = max(1, (4 << 20) // int(n * n // 8 + n))  # bounds the lattice of long words
        for lo in range(0, len(at), step):
            some = at[lo : lo + step]
            yield some, np.frombuffer(b"".join(raw[i] for i in some), np.uint8).reshape(len(some), n)


def _gathered(batches, columns: list[str]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GROUP_WORDS:
            yield pa.Table.from_batches(held).select(columns)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).select(columns)


def counts_of(classes: int) -> list[str]:
    return [f"c{k}" for k in range(classes)]


def count_words(docs: DataFrame, classes: int) -> DataFrame:
    """Every distinct word (A-Z lowered): ``h`` its hash, ``word``, ``c0`` ... its counts in the training rows of each class.

    ``docs`` has ``text`` and ``cls``, null for rows that are held out.
    """
    names = counts_of(classes)

    def count(batches):
        for batch in batches:
            cls = batch.column("cls").fill_null(classes).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, _, buf, offsets in slices(batch.column("text")):
                buf = lower_ascii(buf)
                starts, ends, first = spans(buf, offsets)
                hashes, at, which = np.unique(hash_spans(buf, starts, ends), return_index=True, return_inverse=True)
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(first)) + lo
                c = np.bincount(which * (classes + 1) + cls[row], minlength=len(hashes) * (classes + 1)).reshape(-1, classes + 1)
                raw = buf.tobytes()
                words = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(words, pa.string()), *(pa.array(c[:, k]) for k in range(classes))], names=["h", "word", *names])

    found = docs.select("text", "cls").mapInArrow(count, ", ".join(["h long", "word string", *(f"{c} long" for c in names)]))
    return found.groupBy("h", "word").agg(*[F.sum(c).alias(c) for c in names])


def reestimate(lattice: Lattice, words: DataFrame, classes: int, rounds: int) -> None:
    """Expectation maximisation over the distinct training words of each class."""
    context, names = words.sparkSession.sparkContext, counts_of(classes)
    lattice.log_p = np.repeat(lattice.log_p, classes, 0)
    trained = words.where(" + ".join(names) + " > 0").select("word", *names)
    for _ in range(rounds):
        shared = context.broadcast(lattice)

        def uses(batches, shared=shared):
            tool = shared.value
            sums = np.zeros(tool.log_p.shape)
            for some in _gathered(batches, ["word", *names]):
                weight = np.stack([some[c].to_numpy() > 0 for c in names]).astype(float)
                for at, block in blocks_by_length(some["word"].to_pylist()):
                    sums += tool.expected(block, weight[:, at])
            cls, piece = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(piece), pa.array(sums[cls, piece])], names=["cls", "piece", "uses"])

        # a row per class and piece of the vocabulary at most
        rows = trained.mapInArrow(uses, "cls long, piece long, uses double").groupBy("cls", "piece").agg(F.sum("uses").alias("uses")).collect()
        if not rows:
            break
        sums = np.zeros(lattice.log_p.shape)
        sums[[r["cls"] for r in rows], [r["piece"] for r in rows]] = [r["uses"] for r in rows]
        lattice.set_weights(sums)


class WordModel:
    """Per class: discounted counts of whole words, and the mass left to segmentations."""

    def __init__(self, tokens: np.ndarray, types: np.ndarray, once: np.ndarray, twice: np.ndarray):
        self.discount = np.where(once + twice > 0, once / np.maximum(1, once + 2 * twice), 0.5).clip(0.1, 0.9)
        self.tokens = np.maximum(tokens, 1)
        self.free = np.where(tokens > 0, self.discount * types / self.tokens, 1.0)

    def log_p(self, c: np.ndarray, marginal: np.ndarray) -> np.ndarray:
        """Log of the summed ways through each word's lattice (class x word)."""
        whole = np.maximum(c - self.discount[:, None], 0) / self.tokens[:, None]
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(whole), np.log(self.free)[:, None] + marginal)


def score_words(lattice: Lattice, model: WordModel, words: DataFrame, classes: int, denominator: int) -> DataFrame:
    """``h``, ``c``, ``base`` = log10((c+1)/denominator), and ``m0`` ...: the word's log probability in each class."""
    shared, names = words.sparkSession.sparkContext.broadcast((lattice, model)), counts_of(classes)
    marks = [f"m{k}" for k in range(classes)]

    def score(batches):
        tool, word_model = shared.value
        for some in _gathered(batches, ["h", "word", *names]):
            counts = np.stack([some[c].to_numpy() for c in names])
            marginal = np.zeros(counts.shape)
            for at, block in blocks_by_length(some["word"].to_pylist()):
                marginal[:, at] = tool.forward(block)[-1]
            c = counts.sum(0)
            log_p = word_model.log_p(counts, marginal)
            yield from pa.Table.from_arrays([some["h"], pa.array(c), pa.array(np.log10((c + 1) / denominator)), *map(pa.array, log_p)], names=["h", "c", "base", *marks]).to_batches()

    return words.mapInArrow(score, ", ".join(["h long", "c long", "base double", *(f"{m} double" for m in marks)]))


def _document_rows(docs: DataFrame, common: tuple[np.ndarray, ...], classes: int) -> DataFrame:
    """Per document a head row with the sums over its common words, and a row per distinct rarer word.

    Common words are looked up in a broadcast table of fixed size, so no frequent word is a join key.
    The head's ``h`` spreads the heads over the join; its ``n`` of 0 keeps it out of all sums.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)
    sums = ["base", *(f"m{k}" for k in range(classes))]
    names = ["k", "h", "n", "doc_id", "held_out", "docs", "n_tokens", "n_known", *sums]

    def rows(batches):
        hashes, c, *values = shared.value
        for batch in batches:
            known_id = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            ids = np.where(known_id, mix(ids + np.uint64(1)), np.uint64(7))
            for lo, hi, buf, offsets in slices(batch.column("text")):
                m = hi - lo
                buf = lower_ascii(buf)
                whole = hash_spans(buf, offsets[:-1], offsets[1:])
                key = mix(whole * np.uint64(31) + ids[lo:hi])
                starts, ends, first = spans(buf, offsets)
                h = hash_spans(buf, starts, ends)
                row = np.repeat(np.arange(m), np.diff(first))
                at = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
                hit = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
                at_row, at_word = row[hit], at[hit]
                add = lambda v: np.bincount(at_row, weights=v[at_word] if len(hashes) else None, minlength=m).astype(float)
                heads = [
                    pa.array(key.view(np.int64)), pa.array(mix(key).view(np.int64)), pa.array(np.zeros(m, np.int32)),
                    batch.column("doc_id").slice(lo, m), batch.column("held_out").slice(lo, m), pa.array(np.ones(m, np.int32)),
                    pa.array(np.diff(first).astype(np.int64)), pa.array(add((c > 0).astype(float)).astype(np.int64)), *(pa.array(add(v)) for v in values),
                ]
                yield pa.RecordBatch.from_arrays(heads, names=names)
                rest_row, rest = row[~hit], h[~hit]
                order = np.lexsort((rest, rest_row))
                rest_row, rest = rest_row[order], rest[order]
                new = np.ones(len(rest), bool)
                new[1:] = (rest[1:] != rest[:-1]) | (rest_row[1:] != rest_row[:-1])
                begin = np.flatnonzero(new)
                n = np.diff(np.append(begin, len(rest))).astype(np.int32)
                found = [pa.array(key[rest_row[begin]].view(np.int64)), pa.array(rest[begin].view(np.int64)), pa.array(n)]
                types = [pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), *([pa.float64()] * len(sums))]
                yield pa.RecordBatch.from_arrays([*found, *(pa.nulls(len(begin), t) for t in types)], names=names)

    schema = "k long, h long, n int, doc_id long, held_out boolean, docs int, n_tokens long, n_known long, " + ", ".join(f"{x} double" for x in sums)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out").mapInArrow(rows, schema)


def score_documents(docs: DataFrame, held_out: Column, vocabulary: str, rounds: int = 2, common_words: int = 100_000, most_classes: int = 8) -> DataFrame:
    """Per document: token counts, the add-one word model's score and the lattice score, both log10.

    Counts come from all rows that are not held out. ``common_words`` bounds the broadcast table of the most frequent
    words; all others meet their scores in a join by word. ``most_classes`` bounds the classes: the
    most frequent labels, and one for the rest.
    """
    columns = ["doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.coalesce(held_out, F.lit(False)).alias("held_out")]
    docs = docs.select(*columns)
    labels = docs.where(~F.col("held_out")).groupBy("lang").agg(F.count("*").alias("n")).where("lang is not null").orderBy(F.desc("n"), "lang").limit(most_classes - 1).collect()
    classes = len(labels) + 1
    cls = F.lit(len(labels))
    for k, r in enumerate(labels):
        cls = F.when(F.col("lang") == r["lang"], k).otherwise(cls)
    docs = docs.withColumn("cls", F.when(~F.col("held_out"), cls)).drop("lang")
    words = stash(count_words(docs, classes), "words")
    ends = np.zeros(classes)
    for r in docs.groupBy("cls").agg(F.count("*").alias("n")).where("cls is not null").collect():
        ends[r["cls"]] = r["n"]
    names = counts_of(classes)
    total = F.col(names[0])
    for c in names[1:]:
        total = total + F.col(c)
    per_class = [f(F.col(c)) for c in names for f in (F.sum, lambda x: F.sum((x > 0).cast("long")), lambda x: F.sum((x == 1).cast("long")), lambda x: F.sum((x == 2).cast("long")))]
    stats = [x or 0 for x in words.agg(F.sum(total), F.sum((total > 0).cast("long")), *per_class).first()]
    tokens, types, once, twice = np.array(stats[2:], float).reshape(classes, 4).T
    model = WordModel(tokens + ends, types + (ends > 0), once, twice)
    train_tokens, distinct = int(stats[0] + ends.sum()), int(stats[1] + (ends.sum() > 0))
    denominator = train_tokens + distinct + 1
    lattice = load_vocabulary(vocabulary)
    reestimate(lattice, words, classes, rounds)
    with np.errstate(divide="ignore"):
        prior = np.log(ends / ends.sum()) if ends.sum() else np.where(np.arange(classes) == 0, 0.0, -np.inf)
        # the end symbol is one more word, without any segmentation
        end_log = model.log_p(ends[:, None], np.full((classes, 1), -np.inf))[:, 0] if ends.sum() else np.zeros(classes)
    start = [float(x) if np.isfinite(x) else None for x in prior + end_log]
    end_base = float(np.log10((ends.sum() + 1) / denominator))
    scored = stash(score_words(lattice, model, words, classes, denominator), "word-scores")
    sums = ["base", *(f"m{k}" for k in range(classes))]
    top = scored.orderBy(F.desc("c"), "h").limit(common_words).toArrow()
    h = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    common = (h[order], *(top[name].to_numpy()[order] for name in ("c", *sums)))

    w = scored.select("h", (F.col("c") > 0).alias("known"), *[F.col(x).alias(f"w_{x}") for x in sums])
    n = F.col("n")
    rows = _document_rows(docs, common, classes).join(w, "h", "left")
    out = rows.groupBy("k").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.sum("docs").alias("docs"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.when(F.col("known"), n).otherwise(0))).alias("n_known"),
        *[F.sum(F.coalesce(x, n * F.col(f"w_{x}"))).alias(x) for x in sums],
    )
    per = lambda name: F.col(name) / F.col("docs")  # noqa: E731  equal rows share a key
    joint = [per(f"m{k}") + start[k] for k in range(classes) if start[k] is not None]
    best = F.greatest(*joint) if len(joint) > 1 else joint[0]
    mixed = sum((F.exp(x - best) for x in joint[1:]), F.exp(joint[0] - best))
    return out.select(
        "doc_id",
        "held_out",
        (per("n_tokens").cast("long") + 1).alias("n_tokens"),
        (per("n_known").cast("long") + int(ends.sum() > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (per("base") + end_base).alias("base_score"),
        ((best + F.log(mixed)) / LN10).alias("score"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("docs"))).alias("copy"),
    ).drop("copy")
