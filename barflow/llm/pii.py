"""Personal data by a semi-Markov conditional random field.

Base kinds are found by their expressions, leftmost and non-overlapping for each kind, read by linear scans.
The field adds spans: written in another way (``name (at) host.org``, ``42[.]144[.]35[.]254``, a number with 00 or
without its plus), and is learnt from the base ones.

1. Windows: stretches of a text around a digit, an ``@`` or an ``(at)``, with ``CONTEXT`` blanks-separated pieces to either side.
   Nothing outside can be in an entity, so decoding windows is decoding whole texts.
2. Candidate segments: runs of at most ``MOST_TOKENS`` tokens (runs of digits, runs of letters, single signs) that
   are closed to entities by form (``candidates``), numbers of at most ``MOST_DIGITS`` digits. A token outside is a segment of its own.
3. Features are of whole spans: numbers of digits and groups, separators, dotted parts at most 255, the Luhn sum, the
   form, and what stands beside. They are hashed to ``DIMENSIONS`` weights for each type; types of neighbours have weights too.
4. Learning: the conditional likelihood of all segmentations of a bounded sample of windows, summed by the forward-backward
   recursion over ends, lengths and types, and raised by gradient steps. Labels are the base spans;
   half of the windows with some come a second time, written in another way.
5. Decoding: the best segmentation by dynamic programming over ends, lengths and types: boundaries and types are
   chosen together. Segments that cross a base span are left out, so base spans stay.

The sample is at most ``SAMPLE`` different windows for each kind and as many without any, of the least hashes over
all documents; everything else is map only.

Edge cases: null and empty texts have no spans; very long texts are scanned whole, and no window or run of signs costs
more than its length times ``MOST_TOKENS``; repeated rows give repeated results; ties go to no entity, then to the
shorter one; without any window of a kind (an empty table too) that kind has base spans only; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.common import arrow_map, texts_of

KINDS = ["email", "ip", "card", "phone"]
MOST_TOKENS, MOST_DIGITS, CONTEXT, DIMENSIONS = 20, 24, 2, 4096
SAMPLE, SAMPLE_TOKENS, SAMPLE_CHARACTERS = 200, 64, 240
STEPS, RATE, DECAY = 50, 0.3, 1e-3

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find_emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL_SIGNS:
                start -= 1
        if domain and start < at:
            # A domain of one label would have been given back a label's end, which the expression needs no more.
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def find_ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _DOTTED.finditer(text):
        parts = found.group().split(".")
        at = found.start()
        for first in range(0, len(parts) - 3, 4):
            four = parts[first:first + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield at, end
            at = end + 1


def find_cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        digits = digits_of(found.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def find_phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 8 <= len(digits_of(found.group())) <= 15:
                yield found.span()


def base_spans(text: str) -> list[Span]:
    """By kind, then by start."""
    finders = (find_emails, find_ips, find_cards, find_phones)
    return [(start, end, kind) for kind, find in zip(KINDS, finders, strict=True) for start, end in find(text)]


# Windows and tokens.

_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\x00-\x7F]+|.", re.DOTALL)
_AT = re.compile(r"[(\[](?:at|AT)[)\]]")
_ANCHOR = re.compile(r"[0-9@]|[(\[](?:at|AT)[)\]]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_BACK = 200


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around anchors, disjoint, ascending; the signs beyond ``_BACK`` are no context."""
    out: list[tuple[int, int]] = []
    found = _ANCHOR.search(text)
    while found:
        at = found.start()
        start, blanks = at, 0
        floor = max(at - _BACK, out[-1][1] if out else 0)
        while start > floor:
            if text[start - 1] in " \t\n\v\f\r":
                blanks += 1
                if blanks > CONTEXT:
                    break
            start -= 1
        end, blanks, limit = found.end(), 0, found.end() + _BACK
        while end < len(text) and end < limit:
            c = text[end]
            if c in " \t\n\v\f\r":
                blanks += 1
                if blanks > CONTEXT:
                    break
            elif "0" <= c <= "9" or c == "@" or (c in "([" and _AT.match(text, end)):
                blanks, limit = 0, end + _BACK
            end += 1
        if out and start <= out[-1][1]:
            start = out.pop()[0]
        out.append((start, end))
        found = _ANCHOR.search(text, end)
    return out


def tokens_of(text: str, start: int = 0, end: int | None = None) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, start, len(text) if end is None else end)]


_NUMERIC_SIGNS = frozenset(" ().-+[]/")
_EMAIL_SIGNS = frozenset("._%+-@()[] ")


def candidates(text: str, tokens: list[tuple[int, int]], blocked: list[Span] = ()) -> list[tuple[int, int, bool]]:
    """(first token, end token, whether it may be an e-mail) of all segments that have an entity's form.

    A number begins with a digit, ``+`` or ``(`` and ends with a digit; its other tokens are digits and separators, two of
    which may stand together (three around brackets). An e-mail has letters or digits at both ends, one ``@`` or
    ``(at)``, and blanks beside brackets only.
    """
    words = [text[a:b] for a, b in tokens]
    kinds = ["d" if w[0] in "0123456789" else "a" if w.isascii() and w.isalpha() else w if len(w) == 1 else "x" for w in words]
    covered = np.zeros(len(tokens) + 1, dtype=bool)
    begins, ends = (np.array([t[k] for t in tokens], dtype=np.int64) for k in (0, 1))
    for start, end, _ in blocked:
        covered[np.searchsorted(ends, start, side="right"):np.searchsorted(begins, end, side="left")] = True
    out = []
    for i, first in enumerate(kinds):
        if covered[i] or (first in "ad" and i and kinds[i - 1] in "ad"):
            continue
        if first in "d+(":
            digits = gap = 0
            for j in range(i, min(i + MOST_TOKENS, len(kinds))):
                k = kinds[j]
                if covered[j] or not (k == "d" or k in _NUMERIC_SIGNS):
                    break
                gap = 0 if k == "d" else gap + 1
                if gap > 3:
                    break
                digits += len(words[j]) if k == "d" else 0
                if digits > MOST_DIGITS:
                    break
                if k == "d" and digits >= 4 and not (j + 1 < len(kinds) and kinds[j + 1] == "a"):
                    out.append((i, j + 1, False))
        if first in "ad":
            ats = 0
            for j in range(i, min(i + MOST_TOKENS, len(kinds))):
                k = kinds[j]
                if covered[j] or not (k in "ad" or k in _EMAIL_SIGNS) or (k == " " and not _beside_bracket(kinds, j)):
                    break
                ats += k == "@" or (k == "a" and words[j] in ("at", "AT") and 0 < j < len(kinds) - 1 and kinds[j - 1] in "([" and kinds[j + 1] in ")]")
                if ats > 1:
                    break
                if ats and k == "a" and j > i + 1 and not (j + 1 < len(kinds) and kinds[j + 1] in "ad)]"):
                    out.append((i, j + 1, True))
    return out


def _beside_bracket(kinds: list[str], j: int) -> bool:
    return (j + 1 < len(kinds) and kinds[j + 1] in "([") or (j > 0 and kinds[j - 1] in ")]")


# Features of whole spans.

_CUES = {"tel": "phone", "phone": "phone", "call": "phone", "fax": "phone", "mobile": "phone", "mail": "email", "email": "email",
         "contact": "email", "ip": "ip", "host": "ip", "server": "ip", "card": "card", "visa": "card", "credit": "card"}
_LEVELS = [1, 4, 7, 8, 10, 11, 13, 16, 17, 20]


def _level(n: int) -> int:
    return sum(n >= x for x in _LEVELS)


def _beside(c: str) -> str:
    return "none" if not c else "blank" if c in " \t\n\v\f\r" else "letter" if c.isalpha() else "digit" if c in "0123456789" else c


def segment_features(text: str, tokens: list[tuple[int, int]], first: int, end: int) -> list[int]:
    """Numbers of the features of the span of tokens ``first`` to ``end``."""
    a, b = tokens[first][0], tokens[end - 1][1]
    span = text[a:b]
    groups = re.findall("[0-9]+", span)
    n = sum(map(len, groups))
    signs = sorted(set(re.sub("[0-9A-Za-z]", "", span)))
    names = ["bias", f"digits {_level(n)}", f"groups {min(len(groups), 6)}", f"signs {''.join(signs)}", f"begins {span[0] if not span[0].isalnum() else 'd' if span[0].isdigit() else 'a'}",
             f"form {re.sub('[0-9]+', '9', re.sub('[A-Za-z]+', 'a', span))[:24]}", f"left {_beside(text[a - 1:a])}", f"right {_beside(text[b:b + 1])}",
             f"tokens {(end - first) // 3}"]
    if groups and "@" not in span:
        names += [f"first {min(len(groups[0]), 5)}", f"last {min(len(groups[-1]), 5)}"]
        names.append(f"longest {min(max(map(len, groups)), 6)}")
        if len(groups) == 4:
            names.append(f"four parts {'small' if all(len(g) <= 3 and int(g) <= 255 for g in groups) else 'large'} {''.join(sorted(set(re.sub('[0-9]', '', span))))}")
        if 13 <= n <= 19:
            names.append(f"luhn {luhn(''.join(groups))}")
        if span.startswith("00"):
            names.append("double zero")
        if all(len(g) == 4 for g in groups):
            names.append("all of four")
    if "@" in span or _AT.search(span):
        domain = re.split(r"@|[(\[](?:at|AT)[)\]]", span)[-1]
        last = re.split("[^A-Za-z0-9]", domain)[-1]
        names += [f"address {'@' in span} {min(domain.count('.'), 3)}", f"top {min(len(last), 5)}"]
    for k in range(max(0, first - 4), first):
        cue = _CUES.get(text[tokens[k][0]:tokens[k][1]].lower())
        if cue:
            names.append(f"cue {cue}")
    return [crc32(name.encode()) % DIMENSIONS for name in names]


def outside_features(text: str, a: int, b: int) -> list[int]:
    word = text[a:b]
    kind = "digits" if word[0] in "0123456789" else "letters" if word.isalpha() else word if word in "@+([.-" else "other"
    return [crc32(f"outside {kind}".encode()) % DIMENSIONS]


@dataclass(frozen=True)
class Model:
    """``weights``: (1 + kinds) x features, the first row for tokens outside; ``turns``: type after type; ``known``: learnt kinds."""

    weights: np.ndarray
    turns: np.ndarray
    known: np.ndarray


def _allowed(email: bool) -> list[int]:
    return [1] if email else [2, 3, 4]


def decode(model: Model, text: str, tokens: list[tuple[int, int]], blocked: list[Span] = ()) -> list[tuple[int, int, int]]:
    """(first token, end token, type) of the entities of the best segmentation."""
    found = candidates(text, tokens, blocked)
    if not found or not model.known.any():
        return []
    ending: dict[int, list] = {}
    for i, j, email in found:
        score = model.weights[:, segment_features(text, tokens, i, j)].sum(axis=1)
        ending.setdefault(j, []).append((j - i, [(y, float(score[y])) for y in _allowed(email) if model.known[y - 1]]))
    turns = model.turns.tolist()
    types = range(1 + len(KINDS))
    low = -1e300
    best = [[0.0] + [low] * len(KINDS)]
    back: list[list] = [[None] * (1 + len(KINDS))]
    for t in range(1, len(tokens) + 1):
        out = float(model.weights[0, outside_features(text, *tokens[t - 1])].sum())
        before = max(types, key=lambda y: best[t - 1][y] + turns[y][0])
        row, how = [best[t - 1][before] + turns[before][0] + out] + [low] * len(KINDS), [(1, before)] + [None] * len(KINDS)
        for length, scores in sorted(ending.get(t, ())):
            start = best[t - length]
            for y, score in scores:
                before = max(types, key=lambda x: start[x] + turns[x][y])
                value = start[before] + turns[before][y] + score
                if value > row[y]:
                    row[y], how[y] = value, (length, before)
        best.append(row)
        back.append(how)
    y, t, out = max(types, key=lambda x: best[-1][x]), len(tokens), []
    while t:
        length, before = back[t][y]
        if y:
            out.append((t - length, t, y))
        t, y = t - length, before
    return out[::-1]


# Learning.


def rewritten(span: str, kind: str, how: int) -> str:
    """The span written in another way, by a number."""
    if kind == "email":
        return span.replace("@", ["(at)", "[at]", " (at) ", " [at] "][how % 4])
    if kind == "ip":
        return span.replace(".", ["[.]", "(.)"][how % 2])
    if kind == "phone":
        return ["00" + span[1:], span[1:], "(" + span[1:].replace("(", "").replace(")", "").replace(" ", ") ", 1)][how % 3]
    groups = digits_of(span)
    return [".", "  ", "/"][how % 3].join(groups[i:i + 4] for i in range(0, len(groups), 4))


def labelled(text: str, rewrite: bool = False) -> tuple[str, list[Span]]:
    """The window with its disjoint base spans; with ``rewrite`` those are written in another way, which its checksum tells."""
    spans: list[Span] = []
    for span in sorted(base_spans(text), key=lambda s: (s[0], -s[1])):
        if not spans or span[0] >= spans[-1][1]:
            spans.append(span)
    if not rewrite:
        return text, spans
    pieces, out, at, size = [], [], 0, 0
    for start, end, kind in spans:
        other = rewritten(text[start:end], kind, crc32(text.encode("utf-8", "surrogatepass")))
        pieces += [text[at:start], other]
        size += start - at
        out.append((size, size + len(other), kind))
        size += len(other)
        at = end
    return "".join([*pieces, text[at:]]), out


@dataclass
class Sample:
    """Windows of at most ``width`` tokens with their segments as flat arrays; ``gold``: the segments of the labels."""

    sizes: np.ndarray
    outside: np.ndarray
    window: np.ndarray
    end: np.ndarray
    length: np.ndarray
    kind: np.ndarray
    owner: np.ndarray
    feature: np.ndarray
    gold: np.ndarray
    gold_turns: np.ndarray
    gold_outside: np.ndarray


def read_sample(texts: list[tuple[str, list[Span]]]) -> Sample:
    sizes, outside, gold_outside = [], [], []
    rows, owner, feature, gold = [], [], [], []
    turns = np.zeros((1 + len(KINDS),) * 2)
    width = max((len(tokens_of(t)) for t, _ in texts), default=1)
    for w, (text, spans) in enumerate(texts):
        tokens = tokens_of(text)
        starts, ends = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
        wanted = {(starts.get(a), ends.get(b), 1 + KINDS.index(k)) for a, b, k in spans}
        met = []
        for i, j, email in candidates(text, tokens):
            numbers = segment_features(text, tokens, i, j)
            for y in _allowed(email):
                owner += [len(rows)] * len(numbers)
                feature += numbers
                gold.append((i, j, y) in wanted)
                met += [(i, j, y)] if gold[-1] else []
                rows.append((w, j, j - i, y))
        sizes.append(len(tokens))
        outside.append([outside_features(text, *t)[0] for t in tokens] + [0] * (width - len(tokens)))
        mask, at, before = np.ones(width, dtype=bool), 0, 0
        mask[len(tokens):] = False
        for i, j, y in sorted(met):
            mask[i:j] = False
            for after in [0] * (i - at) + [y]:
                turns[before, after] += 1
                before = after
            at = j
        for after in [0] * (len(tokens) - at):
            turns[before, after] += 1
            before = after
        gold_outside.append(mask)
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return Sample(np.array(sizes, dtype=np.int64), np.array(outside, dtype=np.int64).reshape(len(texts), width), *columns, np.array(owner, dtype=np.int64),
                  np.array(feature, dtype=np.int64), np.array(gold, dtype=bool), turns, np.array(gold_outside, dtype=bool).reshape(len(texts), width))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def likelihood(weights: np.ndarray, turns: np.ndarray, sample: Sample) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of the labels and its gradients, by the forward and backward sums over all segmentations."""
    n, width = sample.outside.shape
    types = len(turns)
    scores = np.bincount(sample.owner, weights[sample.kind[sample.owner], sample.feature], minlength=len(sample.kind))
    out = weights[0, sample.outside]
    low = -1e30
    # Segments by their end: those of one end are added together.
    order = np.argsort(sample.end, kind="stable")
    cut = np.searchsorted(sample.end[order], np.arange(width + 2))
    ahead = np.full((width + 1, n, types), low)
    enter = np.full((width + 1, n, types), low)  # sums over the type before
    ahead[0, :, 0] = 0
    enter[0] = turns[0]
    for t in range(1, width + 1):
        ahead[t, :, 0] = enter[t - 1, :, 0] + out[:, t - 1]
        some = order[cut[t]:cut[t + 1]]
        value = enter[t - sample.length[some], sample.window[some], sample.kind[some]] + scores[some]
        np.logaddexp.at(ahead[t], (sample.window[some], sample.kind[some]), value)
        enter[t] = _log_sum(ahead[t][:, :, None] + turns, 1)
    total = _log_sum(ahead[sample.sizes, np.arange(n)], 1)
    rest = np.full((width + 1, n, types), low)  # sums over what follows a type that ends here
    after = np.full((width + 1, n, types), low)  # sums over what begins here, by its type
    rest[sample.sizes, np.arange(n)] = 0
    begins = np.argsort(sample.end - sample.length, kind="stable")
    cuts = np.searchsorted((sample.end - sample.length)[begins], np.arange(width + 2))
    for t in range(width - 1, -1, -1):
        inside = t < sample.sizes
        after[t, inside, 0] = out[inside, t] + rest[t + 1, inside, 0]
        some = begins[cuts[t]:cuts[t + 1]]
        np.logaddexp.at(after[t], (sample.window[some], sample.kind[some]), scores[some] + rest[sample.end[some], sample.window[some], sample.kind[some]])
        rest[t, inside] = _log_sum(turns[None] + after[t, inside][:, None, :], 2)
    begin = sample.end - sample.length
    mass = np.exp(enter[begin, sample.window, sample.kind] + scores + rest[sample.end, sample.window, sample.kind] - total[sample.window])
    slope = np.zeros_like(weights)
    np.add.at(slope, (sample.kind[sample.owner], sample.feature), (sample.gold - mass)[sample.owner])
    places = np.arange(width) < sample.sizes[:, None]
    at, window = np.nonzero(places.T)
    held = np.exp(enter[at, window, 0] + out[window, at] + rest[at + 1, window, 0] - total[window])
    np.add.at(slope[0], sample.outside[window, at], sample.gold_outside[window, at] - held)
    pairs = np.exp(ahead[:-1][:, :, :, None] + turns + after[:-1][:, :, None, :] - total[:, None, None])
    turn_slope = sample.gold_turns - (pairs * places.T[:, :, None, None]).sum(axis=(0, 1))
    value = scores[sample.gold].sum() + out[sample.gold_outside].sum() + (sample.gold_turns * turns).sum() - total.sum()
    return float(value), slope, turn_slope


def fit(texts: list[tuple[str, list[Span]]], steps: int = STEPS) -> Model:
    """Weights by adaptive gradient steps on the regularised likelihood of all windows."""
    types = 1 + len(KINDS)
    known = np.array([any(k == kind for _, spans in texts for *_, k in spans) for kind in KINDS])
    theta = np.zeros(types * DIMENSIONS + types * types)
    if not known.any():
        return Model(np.zeros((types, DIMENSIONS)), np.zeros((types, types)), known)
    sample = read_sample(texts)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        _, slope, turn_slope = likelihood(theta[:types * DIMENSIONS].reshape(types, -1), theta[types * DIMENSIONS:].reshape(types, types), sample)
        g = np.concatenate([slope.ravel(), turn_slope.ravel()]) / len(texts) - DECAY * theta
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        theta = theta + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8) * (g != 0)
    return Model(theta[:types * DIMENSIONS].reshape(types, -1), theta[types * DIMENSIONS:].reshape(types, types), known)


def sample_windows(docs: DataFrame, text: str = "text", size: int = SAMPLE) -> list[str]:
    """At most ``size`` different windows with each kind and as many without any, by the least hash."""

    def run(batch: pa.RecordBatch) -> dict:
        kinds, found = [], []
        for whole in texts_of(batch):
            whole = whole or ""
            for a, b in windows(whole):
                window = whole[a:b]
                if len(window) <= SAMPLE_CHARACTERS and len(tokens_of(window)) <= SAMPLE_TOKENS:
                    met = {k for *_, k in base_spans(window)} or {"none"}
                    kinds += sorted(met)
                    found += [window] * len(met)
        return {"kind": pa.array(kinds, pa.string()), "window": pa.array(found, pa.string())}

    rows = arrow_map(docs.select(F.col(text).alias("text")), run, {"kind": "string", "window": "string"})
    order = Window.partitionBy("kind").orderBy(F.xxhash64("window"), "window")
    # Repeats of a window stand together; the rank leaves them out before the shuffle.
    least = rows.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= size).select("window").distinct()
    return sorted(r["window"] for r in least.collect())


def learn(docs: DataFrame, text: str = "text", size: int = SAMPLE) -> Model:
    """The field learnt from base spans of the documents' windows."""
    found = sample_windows(docs, text, size)
    return fit([labelled(w) for w in found] + [labelled(w, True) for w in found if crc32(w.encode("utf-8", "surrogatepass")) % 2 and base_spans(w)])


def find_spans(model: Model, text: str | None) -> list[Span]:
    """Base spans and the field's, by kind, then by start."""
    text = text or ""
    if not _ANCHOR.search(text):
        return []
    base = base_spans(text)
    out, by_start = list(base), sorted(base)
    first = 0
    for a, b in windows(text):
        while first < len(by_start) and by_start[first][1] <= a:
            first += 1
        near, k = [], first
        while k < len(by_start) and by_start[k][0] < b:
            near += [by_start[k]] if by_start[k][1] > a else []
            k += 1
        tokens = tokens_of(text, a, b)
        out += [(tokens[i][0], tokens[j - 1][1], KINDS[y - 1]) for i, j, y in decode(model, text, tokens, near)]
    return sorted(out, key=lambda s: (KINDS.index(s[2]), s[0]))


def find_pii(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, spans): personal data of every whole text as structs of kind, start, end (code points) and whether it is a base one."""

    def run(batch: pa.RecordBatch) -> dict:
        spans = []
        for whole in texts_of(batch):
            base = set(base_spans(whole or ""))
            spans.append([{"kind": s[2], "start": s[0], "end": s[1], "base": s in base} for s in find_spans(model, whole)])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        return {"id": batch.column(0), "spans": pa.array(spans, kind)}

    key_type = docs.schema[key].dataType.simpleString()
    out = arrow_map(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), run,
                    {"id": key_type, "spans": "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"})
    return out.withColumnRenamed("id", key)


def digest(spans: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans."""

    def line(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return spans.select("doc_id", *map(count, KINDS), F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", line), ",").alias("spans"))
