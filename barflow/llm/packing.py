"""Best-fit packing by exact-complement hashing.

Piece lengths are whole numbers up to the capacity, so all a plan needs is how
many pieces there are of each length: a table of at most ``capacity`` rows,
whatever the corpus. The plan is made on it on the driver; the pieces themselves
stay distributed.

1. Tokens: each text becomes ids, cut into pieces only beyond the capacity.
2. Counts of the lengths.
3. Plan: combinations of one, two, three and four lengths that fill a sequence
   exactly are consumed, as often as the counts last: the gap beside a length is
   looked up among the sums of single lengths, of pairs and of triples. The rest
   goes best-fit, longest first, with groups of equal bins moved together.
4. Ranks: each piece gets its rank among those of its length, from counts per
   (length, part) and a row number inside the part, so a length that a third of
   all pieces have is still split over many tasks.
5. Places: a rank falls into one run of the plan, which gives sequence and offset.

Edge cases: a null or empty text is the end id alone (one piece of length 1); very
long texts are cut; equal rows (the same id and text) are packed each for itself;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.common import giving_back
from barflow.session import materialize

CAPACITY = 4096
END_ID = 1
# Entries of the cache of words' parts before it starts anew; learning them again takes the tokenizer's time.
CACHE_PARTS = 300_000
# Bytes of texts that are split into words at a time (a longer text alone).
BLOCK_BYTES = 3 << 20
# Rows whose texts are encoded and returned at a time.
ROWS = 5000
# Fixed values (must equal the tokenizer file's rule, for lower-cased printable Latin-1): the kind of a character, a run of
# which is a part (other characters are parts of their own), and the endings that are parts.
LETTER, MARK = ord("a"), ord("-")
KINDS = np.array([LETTER if chr(c).isalpha() else c if chr(c).isnumeric() or chr(c).isspace() else MARK for c in range(256)], dtype=np.uint8)
ENDINGS = re.compile("'(?:s|t|re|ve|m|ll|d)").finditer
# A character other than the printable ones of Latin-1.
ODD = r"[^\x20-\x7e\x{a1}-\x{ac}\x{ae}-\x{ff}]"
# New parts in one text for the tokenizer, and texts in one call of it (its results take some 100 bytes a token).
RUN = 1000
CALL = 8


def _array(kind: pa.DataType, ends: np.ndarray, data: pa.Buffer) -> pa.Array:
    """Strings or binaries that lie one behind the other in ``data``, up to each of ``ends``."""
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), data])


def _joined(ids: pa.Array, codes: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Joined values of ``ids`` at ``codes``, one result up to each of ``ends``."""
    sizes = pc.binary_length(ids).to_numpy(zero_copy_only=False)
    at = np.append(0, np.cumsum(sizes[codes]))
    return _array(pa.large_binary(), at[ends], ids.take(pa.array(codes)).buffers()[2] or pa.py_buffer(b""))


def _lines(texts: pa.Array, sep: str, n: int) -> list[str]:
    """``texts`` joined by ``sep``, ``n`` in a line."""
    ends = pa.array(np.append(np.arange(0, len(texts), n), len(texts)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(ends, texts), pa.scalar(sep, texts.type)).to_pylist()


def _cut(lines: str) -> pa.Array:
    """Parts of lower-cased words of printable Latin-1, each followed by a line break, which is a part too."""
    chars = np.frombuffer(lines.encode("latin-1"), dtype=np.uint8)
    kinds = KINDS[chars]
    ends = np.ones(len(chars), dtype=bool)
    ends[:-1] = (kinds[1:] != kinds[:-1]) | ((kinds[1:] != LETTER) & (kinds[1:] != MARK))
    for m in ENDINGS(lines):
        if not m.start() or kinds[m.start() - 1] != MARK:
            ends[m.start()], ends[m.end() - 1] = False, True
    at = np.flatnonzero(ends)
    return _array(pa.large_string(), at + 1 + np.cumsum(chars >= 128)[at], pa.py_buffer(lines.encode()))


class WordEncoder:
    """ids of a tokenizer whose tokens never span white space, remembered by parts of words.

    Texts stay Arrow columns: a block of them is cut at ASCII white space, and each
    distinct word is looked up once for all the places it has. A word's ids are those
    of its parts (runs of letters, single digits, runs of other marks); parts not met
    before go to the tokenizer together, ``RUN`` in a text, and are told apart by the
    tokens that end a part. They are lower-cased and cut already, so its normalizer
    and pattern, which would not change them, are left out there. Words with other
    than printable Latin-1 characters go to the whole tokenizer as they are, and so do
    whole texts with a possible special token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        self.full = Tokenizer.from_file(path)
        self.tokenizer = Tokenizer(self.full.model)
        self.tokenizer.pre_tokenizer = Sequence([Split(" ", "removed"), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.full.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words = pa.array([], pa.large_string())  # distinct ones of the block at hand
        self._start()

    def _start(self) -> None:
        self.parts, self.ids = pa.array(["\n"], pa.large_string()), pa.array([b""], pa.large_binary())

    def encode(self, texts: list | pa.Array) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        texts = texts.fill_null("")
        ends, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, side="right")))
            yield from self._encode_block(texts.slice(at, to - at))
            at = to

    def _encode_block(self, texts: pa.Array) -> Iterator[bytes]:
        special = pc.match_substring(texts, "<|")
        split = pc.ascii_split_whitespace(pc.if_else(special, "", texts))
        places = split.flatten().dictionary_encode()
        self.words = places.dictionary
        found = _joined(*self._words_ids(self.words, places.indices.to_numpy()), split.offsets.to_numpy()[1:])
        for text, whole, ids in zip(texts, special.to_pylist(), found, strict=True):
            yield self._whole(text.as_py()) if whole else ids.as_py()

    def _words_ids(self, words: pa.Array, places: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """ids of distinct words, and where in them those of ``places`` are."""
        odd = pc.match_substring_regex(words, ODD)
        plain, as_is = words.filter(pc.invert(odd)), words.filter(odd)
        cut = _cut("".join(f"{line}\n" for line in _lines(plain, "\n", len(plain) or 1)).lower()).dictionary_encode()
        known = self._parts_ids(cut.dictionary, as_is)
        # Plain words end where their lines do; behind them come the odd ones, each a part of its own.
        codes = cut.indices.to_numpy()
        ends = np.flatnonzero(codes == cut.dictionary.index("\n").as_py()) + 1
        more = np.arange(len(as_is))
        ids = _joined(known, np.append(codes, len(cut.dictionary) + more), np.append(ends, len(codes) + 1 + more))
        order = np.empty(len(words), dtype=np.int64)
        order[np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(words))
        return ids, order[places]

    def _parts_ids(self, parts: pa.Array, odd: pa.Array) -> pa.Array:
        """ids of the parts of plain words and behind them those of odd words; new ones are entered."""
        if len(self.parts) > CACHE_PARTS:
            self._start()
        wanted = pa.concat_arrays([parts, odd])
        found = pc.index_in(wanted, value_set=self.parts)
        fresh, found = pc.is_null(found), found.fill_null(0).to_numpy().copy()
        new = [names.filter(mask) for names, mask in ((parts, fresh[:len(parts)]), (odd, fresh[len(parts):]))]
        found[fresh.to_numpy(zero_copy_only=False)] = np.arange(len(self.parts), len(self.parts) + sum(map(len, new)))
        if any(map(len, new)):
            self.parts = pa.concat_arrays([self.parts, *new])
            self.ids = pa.concat_arrays([self.ids, *self._learn(new[0]), self._values([self._whole(w) for w in new[1].to_pylist()])])
        return self.ids.take(pa.array(found))

    def _learn(self, new: pa.Array) -> Iterator[pa.Array]:
        """ids of new parts, ``RUN`` of them in one text."""
        runs = _lines(new, " ", RUN)
        for first in range(0, len(runs), CALL):
            call = runs[first:first + CALL]
            for run, found in zip(call, self.tokenizer.encode_batch_fast(call, add_special_tokens=False), strict=True):
                ids = np.array(found.ids, dtype="<u4")
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) == run.count(" ") + 1:
                    yield _array(pa.large_binary(), 4 * ends, pa.py_buffer(ids))
                else:
                    yield self._values([self._whole(p) for p in run.split(" ")])

    @staticmethod
    def _values(ids: list[bytes]) -> pa.Array:
        return pa.array(ids, pa.large_binary())

    def _whole(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part bigint"


def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: number, first id, length and CRC of the ids; ``part`` is the input task."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = None
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            encoder = encoder or WordEncoder(tokenizer)
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    rows.append((doc, n, at // 4, len(cut) // 4, zlib.crc32(cut)))
            if rows:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = PIECES.rpartition(",")[0]
    out = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(giving_back(run), schema)
    return out.withColumn("part", F.spark_partition_id().cast("long"))


def plan_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins as (runs of (length, how many), how many such bins) for ``counts`` pieces of each length.

    Bounded by the number of distinct lengths, not by the number of pieces.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] += n
    bins: list[tuple[list[tuple[int, int]], int]] = []

    def use(lengths: list[int]) -> bool:
        need = defaultdict(int)
        for x in lengths:
            need[x] += 1
        times = min(int(left[x]) // k for x, k in need.items())
        if times <= 0:
            return False
        for x, k in need.items():
            left[x] -= times * k
        bins.append((sorted(need.items(), reverse=True), times))
        return True

    use([capacity])
    for parts in (1, 2, 3):
        for first in range(capacity - 1, 0, -1):
            while left[first] and _fill(left, first, capacity - first, parts, use):
                pass
    return bins + _best_fit(left, capacity)


def _fill(left: np.ndarray, first: int, gap: int, parts: int, use) -> bool:
    """Consume one combination of ``first`` and ``parts`` lengths that sum to ``gap``, longest parts first."""
    if parts == 1:
        return gap <= first and use([first, gap])
    top = min(first, gap - parts + 1)
    if parts == 2:
        second = np.arange(top, (gap - 1) // 2, -1)
        good = second[(left[second] > 0) & (left[gap - second] > 0)] if len(second) else second
        return any(use([first, int(b), gap - int(b)]) for b in good)
    for second in np.flatnonzero(left[:top + 1] > 0)[::-1].tolist():
        rest = gap - second
        third = np.arange(min(second, rest - 1), (rest - 1) // 2, -1)
        if not len(third):
            break
        good = third[(left[third] > 0) & (left[rest - third] > 0)]
        if any(use([first, second, int(c), rest - int(c)]) for c in good):
            return True
    return False


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing for what is left; equal bins are moved as one group."""
    open_bins: dict[int, list[tuple[tuple, int]]] = defaultdict(list)  # gap -> (runs, times)
    gaps = np.zeros(capacity + 1, dtype=bool)
    for length in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[length])
        while todo:
            fits = np.flatnonzero(gaps[length:])
            if not len(fits):
                each = min(capacity // length, todo)
                times = todo // each
                _open(open_bins, gaps, capacity - each * length, ((length, each),), times)
                todo -= each * times
                continue
            gap = length + int(fits[0])
            runs, times = open_bins[gap].pop()
            if not open_bins[gap]:
                gaps[gap] = False
            each = min(gap // length, todo)
            filled = min(times, todo // each)
            if times > filled:
                _open(open_bins, gaps, gap, runs, times - filled)
            _open(open_bins, gaps, gap - each * length, (*runs, (length, each)), filled)
            todo -= each * filled
    return [(list(runs), times) for group in open_bins.values() for runs, times in group]


def _open(open_bins, gaps, gap, runs, times) -> None:
    open_bins[gap].append((runs, times))
    gaps[gap] = True


def _places(bins) -> dict[str, np.ndarray]:
    """Runs of ranks: for each length, from which rank on which bins take how many pieces at which offset."""
    seen: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for runs, times in bins:
        offset = 0
        for length, each in runs:
            rows.append((length, seen[length], sequence, each, offset))
            seen[length] += each * times
            offset += length * each
        sequence += times
    rows.sort()
    names = ("length", "first", "sequence", "each", "offset")
    return dict(zip(names, np.array(rows, dtype=np.int64).reshape(-1, 5).T, strict=True))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (columns doc_id, piece, length, part and any others).

    ``pieces`` is read three times; store it first if it is costly.
    """
    per_part = materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "pack_counts")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = _places(plan_lengths(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_from"))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (pieces.withColumn("_row", F.row_number().over(inside))
              .join(starts, ["length", "part"])
              .withColumn("_rank", F.col("_from") + F.col("_row") - 1).drop("_from", "_row", "part"))
    step = np.int64(1) << 48
    keys = plan["length"] * step + plan["first"] if len(plan["length"]) else np.empty(0, np.int64)
    names = [c for c in ranked.columns if c != "_rank"]

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda n: batch.column(batch.schema.get_field_index(n))
            length, rank = (column(n).to_numpy(zero_copy_only=False) for n in ("length", "_rank"))
            run = np.searchsorted(keys, length * step + rank, side="right") - 1
            inner = rank - plan["first"][run]
            each = plan["each"][run]
            yield pa.RecordBatch.from_arrays(
                [*(column(n) for n in names), pa.array(plan["sequence"][run] + inner // each),
                 pa.array(plan["offset"][run] + inner % each * length)], names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"{n} {ranked.schema[n].dataType.simpleString()}" for n in names)
    return ranked.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs`` with their places in sequences of at most ``capacity`` tokens."""
    pieces = materialize(tokenize_pieces(docs, tokenizer, capacity, end_id), "pack_pieces")
    return pack_pieces(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
