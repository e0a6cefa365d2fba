"""Spelling variants by an index of variable-length grams.

Two words are near if one inserted, deleted or replaced code point makes one of the other.

1. Words: runs of letters of whole texts, counted in each task before the shuffle.
2. Gram dictionary: words of n and n + 1 letters (a class) share one. A gram of ``QMIN`` letters that more than ``FREQUENT``
   positions of the class hold is pruned and its extensions by one letter stand for it, up to ``QMAX``. (The pruned grams
   are kept as a Bloom filter of at most 16 MB: what it wrongly holds is one letter longer, for every word alike.)
3. Decomposition: of each position (the word has a mark at both ends) the first gram that is not pruned, without
   those that lie inside an earlier one.
4. Affected grams: an edit can only change a gram if it lies in what the dictionary read for it or for one before
   it that could cover it. So each word's bounds tell, for the edits of either half, which grams stay: those of its
   left half for edits in the right one, and the other way round. There is at least one a side, as a half is no shorter than QMAX.
5. Merging: a near word has all of these grams in the same places, from the start or from the end. So the lists of one side
   are intersected, by one shuffle on all its grams and places together, and a word is in two lists of a class.
6. Verifying: inside a list an entry stands under the word with each letter of the other half left open, or deleted;
   equal ones are compared letter by letter. No pairs of a list are listed before. A list of more than ``LIST`` entries is
   dealt over tasks by these keys. A pair belongs to the side its first different letter tells, so it is found once.
7. Forms and roots: a grouped maximum over a word's near words, then pointers doubled until none moves.

Edge cases: null, empty and letter-less texts have no words; a null doc_id is written as an empty string; very long texts
are read whole, piece by piece; repeated rows count each; ties of n go to the smallest word in code-point order; an
empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import lower_ascii, pieces
from barflow.llm.jaccard import _passes as passes
from barflow.llm.jaccard import id_filter
from barflow.llm.shingles import mix64, powers
from barflow.session import materialize

LEAST_LETTERS, LEAST_COUNT, RATIO, DAMAGE = 6, 5, 5, 199
QMIN, QMAX, FREQUENT = 3, 6, 32
LIST = 4096
# Words a task counts before it passes them on, and letters it verifies at once.
HELD_WORDS = 200_000
CHUNK_LETTERS = 1 << 20

_LETTERS = re.compile("[a-zÀ-ÿ]+")
_MUL, _SIDE, _PLACE, _DELETED = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
START, END = 1, 2


def damaged(run: str, prefix: int) -> str:
    """The run without one code point if ``DAMAGE`` divides its checksum; ``prefix``: crc32 of ``<doc_id>:``."""
    h = crc32(run.encode(), prefix)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, least: int) -> DataFrame:
    """(word, n) of all words of at least ``least`` code points."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")  # a shorter run gives no word

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                prefix = crc32(f"{name}:".encode())
                for piece in pieces(lower_ascii(text), _LETTERS):
                    for found, n in Counter(runs.findall(piece)).items():
                        word = damaged(found, prefix)
                        if len(word) >= least:
                            held[word] += n
                if len(held) > HELD_WORDS:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text")
    return named.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def letters_of(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(-1, length)


def longest_gram(cls: int) -> int:
    """Two grams of this length always fit into a word of the class with its marks."""
    return min(QMAX, (cls + 2) // 2)


def grams(letters: np.ndarray, cls: int) -> dict[int, np.ndarray]:
    """Hashes of the grams of each length at each position, marks included, told apart by class."""
    n, width = letters.shape
    marked = np.empty((n, width + 2), dtype=np.uint64)
    marked[:, 0], marked[:, -1], marked[:, 1:-1] = START, END, letters
    values = mix64(marked)
    most = longest_gram(cls)
    out, rolled = {}, np.full((n, width + 2), cls, dtype=np.uint64)
    for q in range(1, most + 1):
        rolled = rolled[:, :width + 3 - q] * _MUL + values[:, q - 1:]
        if q >= min(QMIN, most):
            out[q] = mix64(rolled + np.uint64(q))
    return out


def by_class(words: list[str], least: int):
    """(class, places of its words, letters): words of one length at a time, as the class's shorter or longer ones."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        letters = letters_of([words[i] for i in places], length)
        for cls in (length - 1, length):
            if cls >= least:
                yield cls, places, letters


def pruned_grams(words: DataFrame, least: int, frequent: int) -> np.ndarray:
    """Filter of the grams that more than ``frequent`` positions of a class hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [h.ravel() for cls, _, letters in by_class(batch.column(0).to_pylist(), least)
                    for q, h in grams(letters, cls).items() if q < longest_gram(cls)]
            if some:
                found, n = np.unique(np.concatenate(some), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["id", "n"])

    counted = words.select("word").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return id_filter(materialize(counted.where(F.col("n") > frequent).select("id"), "pruned_grams"))


def decompose(letters: np.ndarray, cls: int, pruned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, end, kept) of the gram of each position; it reads no letter from its end on."""
    by_length = grams(letters, cls)
    least, most = min(by_length), max(by_length)
    width = letters.shape[1] + 2
    hashes = by_length[least].copy()
    ends = np.broadcast_to(np.arange(hashes.shape[1]) + least, hashes.shape).copy()
    going = np.ones(hashes.shape, dtype=bool)
    for q in range(least, most):
        fits = by_length[q + 1].shape[1]
        going[:, fits:] = False
        rows, at = np.nonzero(going)
        held = passes(pruned, len(pruned), by_length[q][rows, at].view(np.int64))
        going[rows[~held], at[~held]] = False
        rows, at = rows[held], at[held]
        hashes[rows, at] = by_length[q + 1][rows, at]
        ends[rows, at] += 1
    before = np.maximum.accumulate(ends, axis=1)
    kept = np.ones(ends.shape, dtype=bool)
    kept[:, 1:] = ends[:, 1:] > before[:, :-1]
    assert ends.max() <= width
    return hashes, ends, kept


def left_half(cls: int) -> int:
    """Symbols, the mark included, of the left half of a class's shorter words."""
    return (cls + 3) // 2


def untouched(ends: np.ndarray, kept: np.ndarray, cls: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The kept grams that no edit from the left half's end on affects, and those that no edit before the right half affects.

    A gram depends on the letters that were read for it and for the earlier ones long
    enough to cover it, which start at most ``longest_gram`` letters before its end.
    """
    most, left = longest_gram(cls), left_half(cls)
    right = cls + 2 - left
    beyond = np.zeros((len(ends), ends.shape[1] + 1), dtype=np.int64)
    np.cumsum(ends > left, axis=1, out=beyond[:, 1:])
    first = np.maximum(ends - most, 0)
    places = np.arange(ends.shape[1])
    clear = beyond[np.arange(len(ends))[:, None], places + 1] == beyond[np.arange(len(ends))[:, None], np.minimum(first, places)]
    return kept & clear, kept & (ends - most >= width - right)


def list_keys(letters: np.ndarray, cls: int, pruned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The list of each word for either side: all its untouched grams there with their places."""
    width = letters.shape[1] + 2
    hashes, ends, kept = decompose(letters, cls, pruned)
    sides = untouched(ends, kept, cls, width)
    places = np.arange(ends.shape[1], dtype=np.uint64)
    out = []
    for side, place in zip(sides, (places, np.uint64(width) - places), strict=True):
        assert side.any(axis=1).all()  # a half holds a gram that stays
        out.append(np.where(side, mix64(hashes + place * _PLACE), np.uint64(0)).sum(axis=1, dtype=np.uint64))
    return mix64(out[0] + np.uint64(cls)), mix64(out[1] + np.uint64(cls) + _SIDE)


def read_lists(words: DataFrame, pruned: np.ndarray, least: int) -> DataFrame:
    """(list, cls, left, word, n): a word's entries in the lists of its classes and sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cls, places, letters in by_class(batch.column(0).to_pylist(), least):
                some = batch.take(pa.array(places))
                for left, keys in zip((True, False), list_keys(letters, cls, pruned), strict=True):
                    n = len(keys)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(np.full(n, cls, dtype=np.int32)), pa.array(np.full(n, left)), *some.columns],
                        names=["list", "cls", "left", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "list bigint, cls int, left boolean, word string, n bigint")


def open_keys(letters: np.ndarray, lists: np.ndarray, left: np.ndarray, cls: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each word with one letter open or, for the class's longer words, deleted; and where they count.

    Letters of the other half only; of equal letters in a row the last one is deleted.
    """
    n, length = letters.shape
    values = mix64(letters.astype(np.uint64) + np.uint64(3)) * powers(int(_MUL), length)[::-1]
    at = np.arange(length)
    edge = left_half(cls) - 1
    use = np.where(left[:, None], at >= edge, at < edge)
    if length == cls:
        return mix64(values.sum(axis=1, dtype=np.uint64)[:, None] - values + (at.astype(np.uint64) + np.uint64(1)) * _PLACE + lists[:, None]), use
    use[:, :-1] &= letters[:, 1:] != letters[:, :-1]
    # Letters before the deleted one lose a power of the multiplier.
    short = mix64(letters.astype(np.uint64) + np.uint64(3))
    powered = powers(int(_MUL), length)[::-1]
    before = np.zeros((n, length), dtype=np.uint64)
    np.cumsum((short * np.append(powered[1:], np.uint64(1)))[:, :-1], axis=1, out=before[:, 1:])
    after = values[:, ::-1].cumsum(axis=1, dtype=np.uint64)[:, ::-1] - values
    return mix64(before + after + _DELETED + lists[:, None]), use


def whole_keys(letters: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """The key under which a class's shorter word meets the longer ones with a letter deleted."""
    values = mix64(letters.astype(np.uint64) + np.uint64(3)) * powers(int(_MUL), letters.shape[1])[::-1]
    return mix64(values.sum(axis=1, dtype=np.uint64) + _DELETED + lists)


def near_in_class(cls: int, own: np.ndarray, own_lists, own_left, own_parts, longer: np.ndarray, longer_lists, longer_left, longer_parts):
    """(shorter or equal, other, whether other is a longer one): places of near words among the entries of one class.

    ``parts``: (number of parts a list is dealt in, this part) of each entry.
    """
    out = []

    def mine(keys, parts):
        return keys % parts[0].astype(np.uint64).reshape(-1, *[1] * (keys.ndim - 1)) == parts[1].astype(np.uint64).reshape(-1, *[1] * (keys.ndim - 1))

    if len(own):
        keys, use = open_keys(own, own_lists, own_left, cls)
        rows, at = np.nonzero(use & mine(keys, own_parts))
        keys = keys[rows, at]
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows[order]
        step = 1
        while True:  # words alike but for one letter are as many as there are letters
            same = np.flatnonzero(keys[step:] == keys[:-step]) if step < len(keys) else []
            if not len(same):
                break
            a, b = rows[same], rows[same + step]
            good = ((own[a] != own[b]).sum(axis=1) == 1) & (own_lists[a] == own_lists[b])
            out.append((a[good], b[good], False))
            step += 1
    if len(own) and len(longer):
        keys, use = open_keys(longer, longer_lists, longer_left, cls)
        rows, at = np.nonzero(use & mine(keys, longer_parts))
        wanted = keys[rows, at]
        whole = whole_keys(own, own_lists)
        those = np.flatnonzero(mine(whole, own_parts))
        those = those[np.argsort(whole[those], kind="stable")]
        low, high = (np.searchsorted(whole[those], wanted, side=s) for s in ("left", "right"))
        while (some := np.flatnonzero(low < high)).size:
            a, b, j = those[low[some]], rows[some], at[some]
            rest = np.arange(cls) + (np.arange(cls) >= j[:, None])
            good = (longer[b[:, None], rest] == own[a]).all(axis=1) & (own_lists[a] == longer_lists[b])
            out.append((a[good], b[good], True))
            low = low + 1
    return out


def near_words(chunk: pa.Table) -> pa.RecordBatch:
    """(word, other, other's n), both ways, for the entries of whole lists or parts of lists."""
    columns = {c: chunk.column(c).to_numpy() for c in ("list", "cls", "left", "parts", "part", "n")}
    words = chunk.column("word").to_pylist()
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    names: list[tuple[np.ndarray, np.ndarray]] = []
    for cls in np.unique(columns["cls"]).tolist():
        sides = []
        for length in (cls, cls + 1):
            places = np.flatnonzero((columns["cls"] == cls) & (lengths == length))
            sides.append((places, letters_of([words[i] for i in places], length), columns["list"][places].view(np.uint64),
                          columns["left"][places].astype(bool), (columns["parts"][places], columns["part"][places])))
        (own, *mine), (longer, *theirs) = sides
        names += [(own[a], (longer if other else own)[b]) for a, b, other in near_in_class(cls, *mine, *theirs)]
    a = np.concatenate([np.empty(0, dtype=np.int64), *(x for x, _ in names), *(y for _, y in names)])
    b = np.concatenate([np.empty(0, dtype=np.int64), *(y for _, y in names), *(x for x, _ in names)])
    word = chunk.column("word").combine_chunks()
    return pa.RecordBatch.from_arrays([word.take(pa.array(a)), word.take(pa.array(b)), pa.array(columns["n"][b])], names=["word", "other", "n"])


def deal_lists(entries: DataFrame) -> DataFrame:
    """Entries with (parts, part): lists of more than ``LIST`` entries stand in each part that has a key of theirs."""
    long = entries.groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > LIST)
    parts = long.select("list", F.ceil(F.col("n") / LIST).cast("int").alias("parts"))
    named = entries.join(parts, "list", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = np.flatnonzero(batch.column("parts").to_numpy() == 1)
            rows, part = [one], [np.zeros(len(one), dtype=np.int64)]
            for i in np.flatnonzero(batch.column("parts").to_numpy() > 1).tolist():
                lists, cls, left, word, _, parts = (batch.column(c)[i].as_py() for c in ("list", "cls", "left", "word", "n", "parts"))
                letters, key = letters_of([word], len(word)), np.array([lists], dtype=np.int64).view(np.uint64)
                keys, use = open_keys(letters, key, np.array([left]), cls)
                keys = keys[use]
                if len(word) == cls:
                    keys = np.append(keys, whole_keys(letters, key))
                found = np.unique(keys % np.uint64(parts)).astype(np.int64)
                rows.append(np.full(len(found), i))
                part.append(found)
            rows, part = np.concatenate(rows), np.concatenate(part)
            some = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(part.astype(np.int32))], names=[*batch.schema.names, "part"])

    return (named.select("list", "cls", "left", "word", "n", "parts")
            .mapInArrow(run, "list bigint, cls int, left boolean, word string, n bigint, parts int, part int"))


def near_pairs(entries: DataFrame) -> DataFrame:
    """(word, other, n of other) for all near words, both ways, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += pa.compute.sum(pa.compute.utf8_length(batch.column("word"))).as_py() or 0
            if size > CHUNK_LETTERS:  # all but the last list, which may go on
                whole = pa.Table.from_batches(held)
                lists, part = whole.column("list").to_numpy(), whole.column("part").to_numpy()
                done = np.flatnonzero((lists != lists[-1]) | (part != part[-1]))
                if len(done):
                    yield near_words(whole.slice(0, len(done)))
                    held = whole.slice(len(done)).to_batches()
                    size = sum(pa.compute.sum(pa.compute.utf8_length(b.column("word"))).as_py() for b in held)
        if held:
            yield near_words(pa.Table.from_batches(held))

    ordered = entries.repartition("list", "part").sortWithinPartitions("list", "part")
    return ordered.mapInArrow(run, "word string, other string, n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row (word, form): forms have larger n, so they end; pointers double each round."""
    chain = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("far"))
        chain = materialize(chain.join(on, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        if not chain.where("moved").limit(1).count():
            return chain.drop("moved")
        chain = chain.drop("moved")


def spelling_variants(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO,
                      frequent: int = FREQUENT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``least_count`` occurrences."""
    words = materialize(count_words(docs, least_letters).where(F.col("n") >= least_count), "words")
    pruned = pruned_grams(words, least_letters, frequent)
    pairs = near_pairs(deal_lists(materialize(read_lists(words, pruned, least_letters), "lists")))
    # The near word of largest n, the smallest of equal ones.
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("other").alias("form")))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    takes = -F.col("best.less") >= ratio * F.col("n")
    named = materialize(words.join(near, "word", "left").select(
        "word", F.when(takes, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, -F.col("best.less")).alias("form_n")), "near_words")
    found = roots(named.where("form is not null"))
    return named.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
