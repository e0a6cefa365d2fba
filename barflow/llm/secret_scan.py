"""Secret scan: all rules in one combined deterministic automaton, one byte pass.

The rules' expressions are compiled together (``automaton.compile_rules``) into
one transition array. A pass over the bytes gives the state after each byte; the
accepting stretches are the matches' ends. A rule whose matches start at a known
distance before the first accepting byte has its start at once; the ``assign``
rule, whose matches can nest, reads backwards from the end through the automaton
of the reversed expression. Matches of the base kinds are leftmost and
non-overlapping for each kind, exactly as a regular-expression engine finds them,
and failing ones (too short) still take up their place.

Edge cases: a null text is empty; repeated rows give repeated results; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.automaton import Automaton, compile_rules, run_segments
from barflow.llm.common import arrow_map, giving_back, texts_of

BLOCK_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern`` must accept on every byte of a match's last class once it accepts.

    ``lead``: bytes of a match up to and with its first accepting byte, or None
    where that varies (the start is then found backwards). ``tail``: the class of
    the last repetition, whose run from the first accepting byte on ends the match.
    ``at_least``: least length of the whole match, or of the tail run if ``lead`` is None.
    """

    kind: str
    pattern: str
    lead: int | None
    at_least: int
    base: bool = False


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api")) + "_?" + either_case("key")
_VALUE = "A-Za-z0-9+/_.=-"

RULES = [
    Rule("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?[{_VALUE}]+""", None, 12, True),
    Rule("access", "AKIA[A-Z0-9]+", 5, 18, True),
    Rule("hex", "[0-9a-f]{16,}", 16, 16, True),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 5, 40),
    Rule("google", "AIza[0-9A-Za-z_-]+", 5, 39),
    Rule("stripe", "[rs]k_(live|test)_[0-9A-Za-z]+", 9, 24),
    Rule("slack", "xox[abeoprs]-[0-9A-Za-z-]+", 6, 24),
    Rule("pem", "-----BEGIN (([A-Z]+ )?[A-Z]+ )?PRIVATE KEY-----", None, 0),
]


@dataclass(frozen=True)
class Scanner:
    rules: list[Rule]
    forward: Automaton
    backward: dict[str, Automaton]


def build_scanner(rules: list[Rule] | None = None) -> Scanner:
    rules = RULES if rules is None else rules
    back = {r.kind: compile_rules([r.pattern], search=False, reverse=True) for r in rules if r.lead is None}
    return Scanner(rules, compile_rules([r.pattern for r in rules]), back)


def scan(scanner: Scanner, raw: np.ndarray) -> dict[str, list[tuple[int, int]]]:
    """Byte spans of each kind. A NUL byte in ``raw`` may not be inside any match."""
    states = run_segments(scanner.forward, raw)
    masks = scanner.forward.accepts[states]
    hits = np.flatnonzero(masks)
    out: dict[str, list[tuple[int, int]]] = {}
    for k, rule in enumerate(scanner.rules):
        at = hits[(masks[hits] >> k) & 1 == 1]
        if not len(at):
            out[rule.kind] = []
            continue
        cut = np.flatnonzero(np.diff(at) > 1)
        firsts = at[np.concatenate([[0], cut + 1])]
        ends = at[np.concatenate([cut, [len(at) - 1]])] + 1
        if rule.lead is not None:
            starts = firsts - rule.lead + 1
            good = ends - starts >= rule.at_least
            out[rule.kind] = list(zip(starts[good].tolist(), ends[good].tolist(), strict=True))
            continue
        spans, done = [], 0
        for first, end in zip(firsts.tolist(), ends.tolist(), strict=True):
            start, tail = _start(scanner.backward[rule.kind], raw, end, done)
            if start is not None:
                done = end
                if not rule.at_least or tail >= rule.at_least:
                    spans.append((start, end))
        out[rule.kind] = spans
    return out


def _start(auto: Automaton, raw: np.ndarray, end: int, floor: int) -> tuple[int | None, int]:
    """Leftmost start of a match that ends at ``end``, not before ``floor``, and its value's length."""
    state, found = auto.start, None
    i = end
    dead = _dead(auto)
    while i > floor and state != dead:
        i -= 1
        state = int(auto.table[state, raw[i]])
        if auto.accepts[state]:
            found = i
    if found is None:
        return None, 0
    return found, end - _value_start(raw, found, end)


def _dead(auto: Automaton) -> int:
    stuck = [s for s in range(auto.states) if not auto.accepts[s] and (auto.table[s] == s).all()]
    return stuck[0] if stuck else -1


_SEPARATORS = frozenset(b":=")


def _value_start(raw: np.ndarray, start: int, end: int) -> int:
    """Past the first ``:`` or ``=`` after the keyword, spaces and one quote."""
    i = start
    while i < end and int(raw[i]) not in _SEPARATORS:
        i += 1
    i += 1
    while i < end and raw[i] == 32:
        i += 1
    return i + 1 if i < end and raw[i] in (34, 39) else i


def scan_texts(scanner: Scanner, texts: list) -> list[list[tuple[int, int, str]]]:
    """Spans (start, end, kind) in code points of every text, by start and then by the rules' order."""
    out: list[list[tuple[int, int, str]]] = []
    part: list[bytes] = []
    held = 0
    for text in texts:
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if part and held + len(raw) > BLOCK_BYTES:
            out += _scan_block(scanner, part)
            part, held = [], 0
        part.append(raw)
        held += len(raw) + 1
    return out + _scan_block(scanner, part)


def _scan_block(scanner: Scanner, part: list[bytes]) -> list[list[tuple[int, int, str]]]:
    found: list[list[tuple[int, int, str]]] = [[] for _ in part]
    if not part:
        return found
    # 0xFF is in no UTF-8 text and in no rule: no match crosses it.
    raw = np.frombuffer(b"\xff".join(part) + b"\xff", dtype=np.uint8)
    begins = np.cumsum([0, *(len(p) + 1 for p in part)])
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    rank = {r.kind: k for k, r in enumerate(scanner.rules)}
    for kind, spans in scan(scanner, raw).items():
        if spans:
            ends = np.array(spans)
            of = np.searchsorted(begins, ends[:, 0], side="right") - 1
            at = points[ends] - points[begins[of]][:, None]
            for doc, (start, end) in zip(of.tolist(), at.tolist(), strict=True):
                found[doc].append((start, end, kind))
    for spans in found:
        spans.sort(key=lambda s: (s[0], rank[s[2]]))
    return found


def find_secrets(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """(key, spans): every secret of every whole text as structs of kind, start and end (code points)."""
    scanner = build_scanner(rules)

    def run(batch: pa.RecordBatch) -> dict:
        spans = [[{"kind": k, "start": s, "end": e} for s, e, k in found]
                 for found in scan_texts(scanner, texts_of(batch))]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return {"id": batch.column(0), "spans": pa.array(spans, kind)}

    key_type = docs.schema[key].dataType.simpleString()
    out = arrow_map(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), run,
                    {"id": key_type, "spans": "array<struct<kind:string,start:bigint,end:bigint>>"})
    return out.withColumnRenamed("id", key)


def redact_texts(docs: DataFrame, rules: list[Rule] | None = None, mask: str = "[REDACTED]") -> DataFrame:
    """Documents with every found span (overlapping ones merged) replaced by ``mask``; ``n_chars`` follows.

    Documents without secrets stay as they are, null texts too.
    """
    scanner = build_scanner(rules)

    def clean(text, spans):
        pieces, at = [], 0
        for start, end, _ in spans:
            if end > at:
                if start >= at:
                    pieces += [text[at:start], mask]
                at = end
        return "".join([*pieces, text[at:]])

    def run(batches):
        for batch in batches:
            texts = texts_of(batch)
            found = scan_texts(scanner, texts)
            changed = [clean(t, s) if s else t for t, s in zip(texts, found, strict=True)]
            columns = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            columns["text"] = pa.array(changed, batch.schema.field("text").type)
            if "n_chars" in columns:
                sizes = [len(c) if s else n for c, s, n in zip(changed, found, columns["n_chars"].to_pylist(), strict=True)]
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(giving_back(run), docs.schema)


def digest(spans: DataFrame) -> DataFrame:
    """The counts and digests of the base kinds from the operator's spans."""
    base = [r.kind for r in RULES if r.base]

    def line(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    counts = [count(k) for k in base]
    return spans.select("doc_id", *counts, F.sha2(F.array_join(F.transform(of_base, line), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", line), ",").alias("spans"))
