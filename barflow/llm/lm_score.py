"""Language-model scoring by cross-entropy difference.

A target model and a background model, both word bigram models over one shared
vocabulary, give each document two losses per token; their difference says how much
more the document looks like the target corpus than like the corpus at large (below
zero: more).

The vocabulary is every word of both corpora; the boundary of a text is one symbol more.
(With ``words`` only that many most frequent words of both corpora together, ties by the
word, are told apart, and the others are one symbol.) Smoothing is Witten-Bell
interpolation from bigrams to unigrams to the uniform distribution. Words are told apart
by 64-bit hashes.

The model grows with the corpus and never stands in one place. Texts are read in blocks;
a block asks for its distinct bigrams, dealt by the first word into buckets whose number
follows the corpus (a frequent first word's bigrams are dealt by both words). A bucket
adds up what all blocks and the target have of its bigrams and first words and answers
each block with their counts, after which a block scores its own texts. To the driver go
``HOT`` frequent words at most, with their counts by bucket, and sums.

Edge cases: null and empty texts have no tokens and losses of 0; very long texts are
scored whole; repeated rows count and are scored each; with an empty target corpus its
model is uniform; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.shingles import blocks, mix64, word_hashes
from barflow.session import materialize

# Words told apart; None: every word.
WORDS = None
UNKNOWN, BOUNDARY = np.uint64(0), np.uint64(1)
BLOCK = 8 << 20
# Bytes of text a bucket stands for.
BUCKET = 16 << 20
HOT = 256
_MUL = np.uint64(0x9E3779B97F4A7C15)


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), letters, letters.lower()), r"[\x20\x09-\x0D]+")
    return docs.select(F.explode(words).alias("word")).where("word != ''").groupBy("word").agg(F.count("*").alias("n"))


def build_vocabulary(target: DataFrame, background: DataFrame, words: int) -> np.ndarray:
    """Hashes of the most frequent words, ascending."""
    both = count_words(background).unionAll(count_words(target)).groupBy("word").agg(F.sum("n").alias("n"))
    return np.sort(word_hashes([r["word"].encode() for r in both.orderBy(F.desc("n"), "word").limit(words).collect()])[0])


def frequent_words(docs: DataFrame) -> np.ndarray:
    """Hashes of words that the first block of a task has often, ascending; only the dealing depends on them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in blocks(batch.column(0).to_pylist(), BLOCK):
                words, n = np.unique(word_hashes(part)[0], return_counts=True)
                some = n > n.sum() / (4 * HOT)
                yield pa.RecordBatch.from_arrays([pa.array(words[some].view(np.int64)), pa.array(n[some])], names=["word", "n"])
                return

    top = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = top.orderBy(F.desc("n"), "word").limit(HOT - 2).collect()
    return np.sort(np.append(np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64), [UNKNOWN, BOUNDARY]))


def pack(x: np.ndarray) -> bytes:
    """The array in the narrowest unsigned type, after one byte with its width."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(x) or int(x.max()) < 1 << 8 * w)
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1)


def _among(x: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(x), dtype=bool)
    return ascending[np.minimum(np.searchsorted(ascending, x), len(ascending) - 1)] == x


@dataclass(frozen=True)
class Dealing:
    """How bigrams go to buckets; ``vocabulary``: None for every word."""

    buckets: int
    hot: np.ndarray
    vocabulary: np.ndarray | None

    def read(self, texts: list[bytes]) -> Block:
        words, counts = word_hashes(texts)
        if self.vocabulary is not None:
            words = np.where(_among(words, self.vocabulary), words, UNKNOWN)
        after = np.insert(words, np.cumsum(counts), BOUNDARY)
        before = np.concatenate([[BOUNDARY], after[:-1]])
        _, first, pair, n = np.unique(mix64(before * _MUL + after), return_index=True, return_inverse=True, return_counts=True)
        a, b = before[first], after[first]
        words, at = np.unique(a, return_inverse=True)
        of_word = mix64(words) % np.uint64(self.buckets)
        bucket = np.where(_among(words, self.hot)[at], mix64(a * _MUL + b) % np.uint64(self.buckets), of_word[at]).astype(np.int64)
        order = np.argsort(bucket * len(words) + at, kind="stable")
        return Block(counts, pair, n, a, b, words, at, bucket, order)


@dataclass(frozen=True)
class Block:
    """Bigrams of some texts: ``pair`` of every place; of each distinct one its count, words and bucket."""

    counts: np.ndarray
    pair: np.ndarray
    n: np.ndarray
    a: np.ndarray
    b: np.ndarray
    words: np.ndarray
    at: np.ndarray
    bucket: np.ndarray
    order: np.ndarray

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, its bigrams by first word, where a first word begins)."""
        cuts = np.flatnonzero(np.diff(self.bucket[self.order])) + 1
        for some in np.split(self.order, cuts):
            yield int(self.bucket[some[0]]), some, np.flatnonzero(np.diff(self.at[some], prepend=-1))


def name_of(texts: list[bytes]) -> bytes:
    """Digest of a block's texts: equal blocks ask and are answered alike."""
    digest = hashlib.blake2b(digest_size=16)
    for t in texts:
        digest.update(len(t).to_bytes(8, "little") + t)
    return digest.digest()


def ask(docs: DataFrame, dealing: Dealing, target: bool) -> DataFrame:
    """(bucket, block, target, parts): first words, bigrams of each, second words and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in blocks(batch.column("text").to_pylist(), BLOCK):
                block, name = dealing.read(texts), name_of(texts)
                for bucket, some, first in block.parts():
                    parts = [pack(block.a[some[first]]), pack(np.diff(first, append=len(some))), pack(block.b[some]), pack(block.n[some])]
                    yield pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([name]), pa.array([target]), pa.array([parts], pa.list_(pa.binary()))],
                                                     names=["bucket", "block", "target", "parts"])

    return docs.mapInArrow(run, "bucket long, block binary, target boolean, parts array<binary>")


def answer(rows: pa.Table, hot: np.ndarray) -> pa.Table:
    """One bucket: (block, bucket, parts) for each asking block, and one row without block that has the sums.

    Parts are the counts of the asked bigrams in background and target, then the counts
    and distinct followers of the first words. Those of ``hot`` words stand in several
    buckets and are left to the sums.
    """
    asked = [[unpack(p) for p in parts] for parts in rows.column("parts").to_pylist()]
    is_target = np.array(rows.column("target").to_pylist())
    sizes = np.array([len(x[2]) for x in asked])
    a = np.concatenate([np.repeat(x[0], x[1]) for x in asked]).astype(np.uint64)
    b = np.concatenate([x[2] for x in asked]).astype(np.uint64)
    n = np.concatenate([x[3] for x in asked]).astype(np.float64)
    of_target = np.repeat(is_target, sizes)
    _, first, pair = np.unique(mix64(a * _MUL + b), return_index=True, return_inverse=True)
    words, word = np.unique(a, return_inverse=True)
    count, total, follow = [], [], []
    for side in (~of_target, of_target):
        count.append(np.bincount(pair, n * side, len(first)).astype(np.int64))
        total.append(np.bincount(word, n * side, len(words)).astype(np.int64))
        follow.append(np.bincount(word[first], count[-1] > 0, len(words)).astype(np.int64))
    stats = np.array([total[0], follow[0], total[1], follow[1]])
    end = np.cumsum(sizes)
    out: list[tuple[bytes | None, list[bytes]]] = []
    for x, block, target, at in zip(asked, rows.column("block").to_pylist(), is_target, end - sizes, strict=True):
        if not target:
            some = pair[at:at + len(x[2])]
            own = word[at + np.cumsum(x[1].astype(np.int64)) - x[1]]
            out.append((block, [pack(c[some]) for c in count] + [pack(s[own]) for s in stats]))
    is_hot = _among(words, hot)
    sums = [total[0].sum(), total[1].sum(), *((s[~is_hot] > 0).sum() for s in total), (~is_hot).sum()]
    out.append((None, [pack(np.array(sums)), pack(words[is_hot]), *(pack(s[is_hot]) for s in stats)]))
    return pa.table([pa.array([x[0] for x in out], pa.binary()), pa.array([rows.column("bucket")[0].as_py()] * len(out)),
                     pa.array([x[1] for x in out], pa.list_(pa.binary()))], names=["block", "bucket", "parts"])


@dataclass(frozen=True)
class Totals:
    """Of background and target: all counts and distinct symbols; symbols of the vocabulary; counts and followers of hot words."""

    total: tuple[float, float]
    kinds: tuple[float, float]
    size: float
    stats: np.ndarray

    @classmethod
    def of(cls, rows: list[list[bytes]], dealing: Dealing) -> Totals:
        sums, stats = np.zeros(5), np.zeros((4, len(dealing.hot)))
        for raw in rows:
            part, words, *some = (unpack(p) for p in raw)
            sums += part
            stats[:, np.searchsorted(dealing.hot, words)] += np.array(some, dtype=np.float64)
        there = stats[[0, 2]] > 0
        words = sums[4] + there[:, ~np.isin(dealing.hot, [UNKNOWN, BOUNDARY])].any(axis=0).sum()
        size = (words if dealing.vocabulary is None else len(dealing.vocabulary)) + 2
        return cls(tuple(sums[:2]), tuple(sums[2:4] + there.sum(axis=1)), size, stats)


def score_block(block: Block, answers: dict[int, list[bytes]], dealing: Dealing, totals: Totals) -> list[np.ndarray]:
    """Losses of each text, of the background and the target."""
    count, stats = np.zeros((2, len(block.n))), np.zeros((4, len(block.words)))
    for bucket, some, first in block.parts():
        values = [unpack(p) for p in answers[bucket]]
        count[:, some] = values[:2]
        stats[:, block.at[some[first]]] = values[2:]
    hot = _among(block.words, dealing.hot)
    stats[:, hot] = totals.stats[:, np.searchsorted(dealing.hot, block.words[hot])]
    second = np.searchsorted(block.words, block.b)  # every word is the first of a bigram of its text
    starts = np.cumsum(block.counts + 1) - block.counts - 1
    per = np.where(block.counts > 0, 1.0 / (block.counts + 1), 0.0)
    out = []
    for c, single, follow, total, kinds in zip(count, stats[::2], stats[1::2], totals.total, totals.kinds, strict=True):
        unigram = (single + kinds / totals.size) / (total + kinds) if total else np.full(len(single), 1.0 / totals.size)
        row, follow = single[block.at], follow[block.at]  # a symbol is followed as often as it occurs
        bigram = np.where(row > 0, (c + follow * unigram[second]) / np.maximum(row + follow, 1), unigram[second])
        out.append(np.add.reduceat(-np.log(bigram)[block.pair], starts) * per)
    return out


def score_documents(docs: DataFrame, target: DataFrame, words: int | None = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, target_loss, background_loss, score) of every whole text; losses in nats a token."""
    kind = docs.schema[key].dataType.simpleString()
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    # Blocks are read twice: rows that come out of a shuffle have no order of their own, files have.
    if "Exchange" in docs._jdf.queryExecution().executedPlan().toString():
        docs = materialize(docs, "texts")
    target = target.select(F.col(text).alias("text"))
    vocabulary = None if words is None else build_vocabulary(target, docs, words)
    size = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    dealing = Dealing(max(1, -(-size // BUCKET)), frequent_words(docs), vocabulary)
    hot = dealing.hot
    asked = ask(docs, dealing, False).unionAll(ask(target, dealing, True))
    answers = materialize(asked.groupBy("bucket").applyInArrow(lambda rows: answer(rows, hot), "block binary, bucket long, parts array<binary>"), "answers")
    totals = Totals.of([r["parts"] for r in answers.where("block is null").select("parts").collect()], dealing)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in blocks(batch.column(1).to_pylist(), BLOCK):
                ids = batch.column(0).slice(first, len(texts)).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([name_of(texts)]), pa.array([ids], pa.list_(batch.schema.field(0).type)), pa.array([texts], pa.list_(pa.binary()))],
                                                 names=["block", "ids", "texts"])

    def score(texts: pa.Table, parts: pa.Table) -> pa.Table:
        answers = dict(zip(parts.column("bucket").to_pylist(), parts.column("parts").to_pylist(), strict=True))
        out = []
        for ids, some in zip(texts.column("ids").to_pylist(), texts.column("texts").to_pylist(), strict=True):
            block = dealing.read(some)
            b, a = score_block(block, answers, dealing, totals)
            out.append(pa.table([pa.array(ids, texts.schema.field("ids").type.value_type), pa.array(block.counts), pa.array(a), pa.array(b), pa.array(a - b)],
                                names=["id", "n_tokens", "target_loss", "background_loss", "score"]))
        return pa.concat_tables(out) if out else pa.table({"id": pa.array([], texts.schema.field("ids").type.value_type)} | {"n_tokens": pa.array([], pa.int64())} | {
            c: pa.array([], pa.float64()) for c in ("target_loss", "background_loss", "score")})

    cuts = docs.mapInArrow(cut, f"block binary, ids array<{kind}>, texts array<binary>")
    out = cuts.groupBy("block").cogroup(answers.where("block is not null").groupBy("block")).applyInArrow(
        score, f"id {kind}, n_tokens bigint, target_loss double, background_loss double, score double")
    return out.withColumnRenamed("id", key)
