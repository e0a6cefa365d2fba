"""Document fingerprints by locally consistent parsing.

A text is a row of symbols (code points). On each level runs of one symbol become
one name; then deterministic coin tossing turns each symbol into a small label
from the lowest bit in which it differs from its left neighbour, four times over,
and the local maxima of the labels begin phrases. A phrase's name is a hash of the
symbols in it, so it depends on its content only: the same substring gives the same
phrases wherever it stands, apart from a few symbols at its ends. Three levels are
built, each about a third as long as the one below.

The fingerprint keeps, for each of ``SLOTS`` slots, the least name of the second and
third level that falls into it (one-permutation min-hash, 16 bits a slot), and the
names over the whole text, so equal texts have equal fingerprints. The likeness of
two fingerprints is the share of equal slots among those that either fills.

Texts are parsed a batch at a time in numpy, with text boundaries as barriers.

Edge cases: null is the empty text; its fingerprint has no filled slot, is like
itself (1) and unlike any other (0). Very long texts are parsed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.shingles import mix64

SLOTS = 128
LEVELS = 3
TOSSES = 4
# Code points that one numpy pass works on.
BLOCK_CHARS = 1 << 17
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_RUN = np.uint64(0xD6E8FEB86659FD93)
_EMPTY = 0xFFFF


def _lowest_bit(x: np.ndarray) -> np.ndarray:
    """Index of the lowest set bit of each nonzero value."""
    return np.bitwise_count((x & (~x + x.dtype.type(1))) - x.dtype.type(1))


def _toss(labels: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Twice the lowest bit's index in which a label differs from its left one, plus that bit (uint8)."""
    bit = _lowest_bit(labels ^ left)
    return (bit << np.uint8(1)) | ((labels >> bit.astype(labels.dtype)) & labels.dtype.type(1)).astype(np.uint8)


def _later_tosses() -> np.ndarray:
    """The tosses after the first as a table over (left label, label), both below 128."""
    left, label = np.meshgrid(np.arange(128, dtype=np.uint8), np.arange(128, dtype=np.uint8), indexing="ij")
    differ = np.where(left == label, label ^ np.uint8(1), left)  # equal ones do not occur
    return _toss(label.ravel(), differ.ravel())


_TOSSED = _later_tosses()


def _join_runs(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Name each run of one symbol within a text; single symbols keep their names."""
    change = np.ones(len(symbols), dtype=bool)
    change[1:] = (symbols[1:] != symbols[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(change)
    length = np.diff(np.append(starts, len(symbols))).astype(np.uint64)
    kept = symbols[starts]
    return np.where(length > 1, mix64(kept * _RUN + length), kept), owner[starts]


def _phrase_starts(symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Where phrases begin: at each text's first symbol and at local maxima of the tossed labels."""
    first = np.ones(len(symbols), dtype=bool)
    first[1:] = owner[1:] != owner[:-1]
    begins = np.flatnonzero(first)
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[begins] = ~symbols[begins]
    labels = _toss(symbols, left)
    for _ in range(TOSSES - 1):
        pair = np.empty(len(labels), dtype=np.uint16)
        pair[1:] = labels[:-1]
        pair[begins] = labels[begins] ^ np.uint8(1)
        labels = _TOSSED[(pair << np.uint16(7)) | labels]
    peak = np.zeros(len(symbols), dtype=bool)
    if len(symbols) > 2:
        peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
        peak[1:-1] &= ~first[1:-1] & ~first[2:]
        peak[1:] &= ~first[:-1]  # no phrase of the first symbol alone
    return np.flatnonzero(first | peak)


def parse(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Names and owning text number of every level above the characters."""
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    symbols = np.frombuffer(raw, dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    levels = []
    for _ in range(LEVELS):
        if len(symbols):
            symbols, owner = _join_runs(symbols, owner)
            starts = _phrase_starts(symbols, owner)
            inside = np.arange(len(symbols)) - np.repeat(starts, np.diff(np.append(starts, len(symbols))))
            mixed = mix64(symbols + inside.astype(np.uint64) * _PLACE)
            symbols, owner = mix64(np.add.reduceat(mixed, starts)), owner[starts]
        levels.append((symbols, owner))
    return levels


def sketches(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Min-hash slots (texts x SLOTS, 16 bits) and a 64-bit name of each whole text."""
    levels = parse(texts)
    slots = np.full((len(texts), SLOTS), _EMPTY, dtype=np.uint16)
    for names, owner in levels[1:]:
        value = mix64(names)
        slot = (value % np.uint64(SLOTS)).astype(np.int64)
        least = np.minimum((value >> np.uint64(48)).astype(np.uint16), np.uint16(_EMPTY - 1))
        np.minimum.at(slots, (owner, slot), least)
    whole = np.zeros(len(texts), dtype=np.uint64)
    names, owner = levels[-1]
    if len(names):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        inside = np.arange(len(names)) - np.repeat(starts, np.diff(np.append(starts, len(names))))
        whole[owner[starts]] = np.add.reduceat(mix64(names + inside.astype(np.uint64) * _PLACE), starts)
    return slots, whole


def fingerprints(texts: list[str]) -> list[tuple[np.ndarray, str]]:
    """(slots, hex fingerprint) of each text; long lists are parsed in blocks."""
    out, part, held = [], [], 0
    for text in [*texts, None]:
        if text is None or (part and held + len(text) > BLOCK_CHARS):
            slots, whole = sketches(part) if part else ([], [])
            out += [(s, f"{int(w):016x}{s.astype('>u2').tobytes().hex()}") for s, w in zip(slots, whole, strict=True)]
            part, held = [], 0
        if text is not None:
            part.append(text)
            held += len(text)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots among those that either fills; two empty texts are alike."""
    filled = (a != _EMPTY) | (b != _EMPTY)
    n = int(filled.sum())
    return float(((a == b) & filled).sum() / n) if n else 1.0


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the first as many characters of ``following``."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h for _, h in found], pa.string())],
                                             names=["id", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, fingerprint string")
    return out.withColumnRenamed("id", key)


def with_following(docs: DataFrame, parts: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts dealt by ranges of the key into parts, each followed by the first text of the next part.

    Columns: part, last (0, or 1 for the borrowed row at the end), id, text; sorted inside each
    part. Bounds of the parts come from the keys alone. A null key stands first; equal keys stand
    by their texts. A part ends with a whole key, so equal keys are never in two parts.
    """
    ids = docs.select(F.col(key).cast("long").alias("id"))
    bounds = sorted(set(ids.approxQuantile("id", [k / parts for k in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    literal = F.array(*[F.lit(int(b)) for b in bounds]) if bounds else F.expr("array(cast(null as bigint))")
    part = F.coalesce(F.size(F.filter(literal, lambda b: b < F.col("id"))), F.lit(0))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).withColumn("part", part)
    firsts = sorted(((r["part"], r["first"]) for r in ids.withColumn("part", part).groupBy("part")
                     .agg(F.expr("case when count(*) > count(id) then null else min(id) end").alias("first")).collect()),
                    key=lambda r: r[0])
    # Row of the first key of each part also goes to the part before it; the very first to the last part.
    before = {first: k for (_, first), (k, _) in zip(firsts, [firsts[-1], *firsts[:-1]] if firsts else [], strict=True)}
    pairs = [F.lit(x) for first, k in before.items() if first is not None for x in (int(first), int(k))]
    to = F.try_element_at(F.create_map(*pairs), F.col("id")) if pairs else F.lit(None).cast("int")
    if None in before:
        to = F.when(F.col("id").isNull(), F.lit(before[None])).otherwise(to)
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("last"))
    lent = F.struct(to.alias("part"), F.lit(1).alias("last"))
    copies = F.filter(F.array(own, lent), lambda c: c["part"].isNotNull())
    dealt = rows.select("id", "text", F.explode(copies).alias("c")).select("c.part", "c.last", "id", "text")
    return dealt.repartitionByRange(max(1, parts), "part").sortWithinPartitions("part", "last", "id", "text")


def compare_with_edits(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Each document's fingerprint, its edited text's, and its likeness to that and to the next document."""
    spark = docs.sparkSession
    if parts is None:
        parts = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def digest(rows: list, out: list) -> None:
        """Results for all but the last of consecutive rows (part, last, id, text); a part's end has no next."""
        pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if a[0] == b[0] and not a[1]]
        if not pairs:
            return
        changed = [edited(a[3], b[3]) for a, b in pairs]
        prints = fingerprints([r[3] for r in rows])
        of = {id(r): p for r, p in zip(rows, prints, strict=True)}
        for (a, b), text, (slots, hexed) in zip(pairs, changed, fingerprints(changed), strict=True):
            own, mine = of[id(a)]
            out.append((a[2], len(a[3]), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), mine, hexed,
                        likeness(own, slots), likeness(own, of[id(b)][0])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            out: list = []
            for part, last, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((part, last, doc, text or ""))
                size += len(held[-1][3])
                if size > BLOCK_CHARS:
                    digest(held, out)
                    held, size = held[-1:], len(held[-1][3])
            digest(held, out)
            held, size = held[-1:], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 names=names)

    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return with_following(docs, parts).mapInArrow(run, schema)
