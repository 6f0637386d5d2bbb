"""Personal data by exact patterns and a semi-Markov conditional random field.

The patterns give the base spans, which always stay. The field adds spans that
the patterns miss, such as telephone numbers without a country code. It reads
zones: the stretches of a text around digits or marks of an address. A zone is
cut into tokens, and candidate segments of up to ``MAX_TOKENS`` tokens are
scored by features of the whole span (digits, groups, Luhn sum, octets, shape of
the domain, what stands next to it). Dynamic programming over the zone then
chooses boundaries and types of all segments together; a token outside of them
scores nothing. Training is by the likelihood of whole segmentations, with the
base spans of a bounded sample of zones as labels and with altered copies of
them: true ones in other dress, and false ones with a broken check sum, an
octet too large or a digit too few.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.tables import ids_and_texts

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ZONES = 1500  # bound of the training sample
ZONE_CHARS = 160  # longest zone used for training
TRAINING_SEGMENTS = 400  # candidate segments of a zone used for training
MAX_TOKENS = 24  # longest segment: that of bounded entities, base spans aside
MAX_GROUPS = 8  # groups of digits in a segment
EPOCHS = 6
SEED = 7
FEATURES = 1 << 10

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its start only: a match that fails there fails further in as well.
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# a mark such as " [dot] " is one token, with its blanks
TOKEN = re.compile(r" ?[\[(] ?(?:at|dot) ?[\])] ?|[0-9]+|[A-Za-z]+|[^0-9A-Za-z]", re.I)
DIGIT_ZONE = re.compile(r"[(+]?[0-9](?:[ ().+-]{0,2}[0-9])*+")
AT_MARK = re.compile(r"@|[\[(] ?at ?[\])]", re.I)
DOT_MARK = re.compile(r"[\[(] ?dot ?[\])]", re.I)
GOES_ON = re.compile(r"(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9]", re.I)
ADDRESS_TAIL = re.compile(r" ?[A-Za-z0-9-]+(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]+)*", re.I)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def octet(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def emails(text: str) -> list[Span]:
    spans, free = [], 0  # free: where the last match ended
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1) if at >= free else None
        if domain:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                free = domain.end()
                spans.append((start, free, "email"))
        at = text.find("@", at + 1)
    return spans


def base_spans(text: str) -> list[Span]:
    """The exact patterns, sorted by start and then by kind."""
    spans = emails(text)
    if any(map(text.__contains__, "0123456789")):
        spans += [(*m.span(), "ip") for m in IP.finditer(text) if all(map(octet, m.groups()))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((*m.span(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    spans.append((*m.span(), "phone"))
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches that may hold personal data, apart from each other and in order."""
    found = []
    if any(map(text.__contains__, "0123456789")):
        for m in DIGIT_ZONE.finditer(text):
            if m.end() - m.start() >= 7:
                found.append(m.span())
    if "@" in text or "[" in text or "(" in text:
        for m in AT_MARK.finditer(text):
            start, end = m.span()
            if m[0] != "@" and start and text[start - 1] == " ":
                start -= 1
            while start and text[start - 1] in LOCAL:  # as far as the mark before, which is no such letter
                start -= 1
            tail = ADDRESS_TAIL.match(text, end)
            found.append((start, tail.end() if tail else end))
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _hash(feature: str) -> int:
    return int.from_bytes(hashlib.blake2b(feature.encode(), digest_size=4).digest(), "little") % FEATURES


_known: dict[str, int] = {}


def _id(feature: str) -> int:
    if feature not in _known:
        _known[feature] = _hash(feature)
    return _known[feature]


def span_features(text: str, start: int, end: int) -> list[int] | None:
    """Features of a whole span, or None where it cannot be personal data."""
    span = text[start:end]
    marks = span.count("@") + len(AT_MARK.findall(span)) if "@" in span or "at" in span.lower() else 0
    digits = "".join(c for c in span if "0" <= c <= "9")
    names = []
    if marks:
        if marks != 1 or span[0] not in LOCAL or not span[-1].isalnum():
            return None
        plain = DOT_MARK.sub(".", AT_MARK.sub("@", span))
        plain = re.sub(r" ?([@.]) ?", r"\1", plain)
        name, _, domain = plain.partition("@")
        labels = domain.split(".")
        names += [
            "address",
            f"name {bool(name) and all(c in LOCAL for c in name)}",
            f"labels {min(len(labels), 3)} {all(re.fullmatch('[A-Za-z0-9-]+', x) for x in labels)}",
            f"last label {labels[-1].isalpha()} {min(len(labels[-1]), 7)}",
            f"spaces {' ' in plain}",
            f"goes on {bool(GOES_ON.match(text, end))}",
        ]
    else:
        if len(digits) < 7 or len(digits) > 20 or not ("0" <= span[-1] <= "9") or not ("0" <= span[0] <= "9" or span[0] in "(+"):
            return None
        groups = [len(g) for g in re.findall("[0-9]+", span)]
        separators = re.sub("[0-9]+", "", span).strip()
        parts = span.split(".")
        quad = len(parts) == 4 and all(re.fullmatch("[0-9]+", p) for p in parts)
        names += [
            f"digits {len(digits)}",
            f"groups {'-'.join(map(str, groups[:6]))} plus {span[0] == '+'}",
            f"tail {'-'.join(map(str, groups[-3:]))}",
            f"separators {''.join(sorted(set(separators)))[:4]}",
            f"luhn {luhn(digits)} {14 <= len(digits) <= 19}",
            f"quad {quad} {quad and all(map(octet, parts))}",
            f"area in brackets {bool(re.search(r'[(][0-9]{3}[)]', span))} balanced {span.count('(') == span.count(')')}",
            f"groups alike {len(set(groups)) == 1} {len(groups)}",
            f"plus {span[0] == '+'} {10 <= len(digits) <= 15}",
        ]
    before, after = text[start - 1 : start], text[end : end + 1]
    names += [
        f"before {_class(before)}",
        f"after {_class(after)}",
        f"within a number {before.isdigit() or after.isdigit()}",
        "bias",
    ]
    return [_id(n) for n in names]


def _class(char: str) -> str:
    if not char or char.isspace():
        return "space"
    return "letter" if char.isalpha() else "digit" if char.isdigit() else "other" if char not in "+.-(@" else char


def candidates(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int, list[int]]]]:
    """Token bounds of a zone, and its segments (first token, token after the last, features)."""
    bounds = [start + m.start() for m in TOKEN.finditer(text[start:end])] + [end]
    last = len(bounds) - 1
    digits, groups = [0], [0]
    for i, j in pairwise(bounds):
        number = "0" <= text[i] <= "9"
        digits.append(digits[-1] + (j - i if number else 0))
        groups.append(groups[-1] + number)
    segments = []
    for i in range(last):
        first = text[bounds[i]]
        if not (first.isalnum() or first in "(+") or not first.isascii():
            continue
        has_mark = False
        for j in range(i + 1, min(last, i + MAX_TOKENS) + 1):
            tail = text[bounds[j] - 1]
            has_mark |= tail == "@" or AT_MARK.search(text, bounds[j - 1], bounds[j]) is not None
            if not has_mark and (digits[j] - digits[i] > 20 or groups[j] - groups[i] > MAX_GROUPS):
                break
            if not tail.isalnum() or not (has_mark or digits[j] - digits[i] >= 7):
                continue
            found = span_features(text, bounds[i], bounds[j])
            if found:
                segments.append((i, j, found))
    return bounds, segments


class SemiMarkov:
    """A semi-Markov field whose weights are per kind and span feature."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def scores(self, segments) -> np.ndarray:
        if not segments:
            return np.zeros((0, len(KINDS)))
        return np.array([self.weights[:, f].sum(axis=1) for _, _, f in segments])

    def best(self, tokens: int, segments, scores) -> list[tuple[int, int, int]]:
        """The segmentation with the highest score: (first token, token after the last, kind)."""
        ending: dict[int, list[int]] = {}
        for n, (_, j, _) in enumerate(segments):
            ending.setdefault(j, []).append(n)
        value, choice = [0.0] * (tokens + 1), [-1] * (tokens + 1)
        kind = scores.argmax(axis=1) if len(scores) else []
        for j in range(1, tokens + 1):
            value[j] = value[j - 1]
            for n in ending.get(j, ()):
                v = value[segments[n][0]] + scores[n, kind[n]]
                if v > value[j]:
                    value[j], choice[j] = v, n
        found, j = [], tokens
        while j > 0:
            n = choice[j]
            if n < 0:
                j -= 1
            else:
                found.append((segments[n][0], j, int(kind[n])))
                j = segments[n][0]
        return found[::-1]

    def marginals(self, tokens: int, segments, scores) -> np.ndarray:
        """Probability of every segment and kind over all segmentations, by forward and backward sums."""
        ahead, back = np.zeros(tokens + 1), np.zeros(tokens + 1)
        for j in range(1, tokens + 1):
            terms = [ahead[j - 1]]
            terms += [ahead[i] + s for n, (i, e, _) in enumerate(segments) if e == j for s in scores[n]]
            ahead[j] = _log_sum(terms)
        for i in range(tokens - 1, -1, -1):
            terms = [back[i + 1]]
            terms += [back[e] + s for n, (b, e, _) in enumerate(segments) if b == i for s in scores[n]]
            back[i] = _log_sum(terms)
        out = np.zeros_like(scores)
        for n, (i, j, _) in enumerate(segments):
            out[n] = np.exp(ahead[i] + scores[n] + back[j] - ahead[tokens])
        return out

    @classmethod
    def trained(cls, examples: list[tuple[str, list[Span]]], epochs: int = EPOCHS, rate: float = 0.3) -> SemiMarkov:
        """Weights that make the labelled segmentations likely; steps shrink per weight as they add up."""
        field = cls(np.zeros((len(KINDS), FEATURES)))
        field.weights[:, _id("bias")] = -2.0
        seen = np.full((len(KINDS), FEATURES), 1e-2)
        ready = []
        for text, spans in examples:
            bounds, segments = candidates(text, 1, len(text) - 1)  # without the context
            if not segments or len(segments) > TRAINING_SEGMENTS:
                continue
            place = {b: i for i, b in enumerate(bounds)}
            truth = {(place.get(s, -1), place.get(e, -1), KINDS.index(k)) for s, e, k in spans}
            ready.append((len(bounds) - 1, segments, truth))
        order = random.Random(SEED)
        for _ in range(epochs):
            order.shuffle(ready)
            for tokens, segments, truth in ready:
                scores = field.scores(segments)
                expected = field.marginals(tokens, segments, scores)
                for n, (i, j, features) in enumerate(segments):
                    for k in range(len(KINDS)):
                        step = ((i, j, k) in truth) - expected[n, k]
                        if abs(step) > 1e-4:
                            seen[k, features] += step * step
                            field.weights[k, features] += rate * step / np.sqrt(seen[k, features])
        return field


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms))


def altered(text: str, spans: list[Span], chance: random.Random) -> list[tuple[str, list[Span]]]:
    """Copies of a labelled zone in which its span looks other, and still is or no longer is what it was."""
    if len(spans) != 1:
        return []
    start, end, kind = spans[0]
    span, out = text[start:end], []

    def put(new: str, keep: bool) -> None:
        changed = text[:start] + new + text[end:]
        out.append((changed, [(start, start + len(new), kind)] if keep else []))

    digits = re.sub("[^0-9]", "", span)
    if kind == "phone" and len(digits) >= 10:
        d = digits[-10:]
        put(f"({d[:3]}) {d[3:6]}-{d[6:]}", True)
        put(f"{d[:3]}-{d[3:6]}-{d[6:]}", True)
        put(f"{d[:4]}-{d[4:6]}-{d[6:8]}", False)  # a date
        put(d, False)
        put(f"({d[:3]}) {d[3:6]}-{d[6:9]}", False)
    elif kind == "card":
        broken = digits[:-1] + str((int(digits[-1]) + chance.randint(1, 9)) % 10)
        groups = lambda x, by: by.join(x[i : i + 4] for i in range(0, len(x), 4))
        put(groups(digits, "."), True)
        put(broken, False)
        put(groups(broken, chance.choice(" -.")), False)
        put(digits[: chance.randint(8, 13)], False)
    elif kind == "ip":
        parts = span.split(".")
        put(".".join([*parts[:3], str(256 + chance.randint(0, 700))]), False)
        put(".".join(parts[:3]) + "0", False)
        put("-".join(parts), False)
    elif kind == "email":
        name, _, domain = span.partition("@")
        put(f"{name} [at] {domain}", True)
        put(f"{name}(at){domain}", True)
        put(f"{name} [at] {domain.replace('.', ' [dot] ')}", True)
        put(f"{name}@{domain.replace('.', '')}", False)
    return out


def examples(zone_texts: list[str]) -> list[tuple[str, list[Span]]]:
    """Labelled zones, each with a character of context on both sides, and their altered copies."""
    chance = random.Random(SEED)
    out = []
    for text in zone_texts:
        spans = base_spans(text)
        spans = [s for s in spans if not any(o != s and o[0] < s[1] and s[0] < o[1] for o in spans)]
        out.append((text, spans))
        out += altered(text, spans, chance)
    return out


def added_spans(text: str, base: list[Span], field: SemiMarkov) -> list[Span]:
    """Spans of the best segmentation of every zone that overlap no base span."""
    out = []
    taken = np.zeros(len(text) + 1, np.int64)  # characters of base spans before each place
    for start, end, _ in base:
        taken[start + 1 : end + 1] = 1
    taken = np.cumsum(taken)
    for start, end in zones(text):
        if taken[end] - taken[start] == end - start:
            continue
        bounds, segments = candidates(text, start, end)
        # base spans stay: what overlaps one cannot be a segment of its own
        before = taken[bounds].tolist()
        segments = [g for g in segments if before[g[0]] == before[g[1]]]
        if not segments:
            continue
        for i, j, kind in field.best(len(bounds) - 1, segments, field.scores(segments)):
            out.append((bounds[i], bounds[j], KINDS[kind]))
    return out


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def training_zones(docs: DataFrame, limit: int = SAMPLE_ZONES) -> list[str]:
    """Up to ``limit`` different zones of at most ``ZONE_CHARS`` characters, the least by hash, with context."""

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([
                [
                    (text[s - 1] if s else " ") + text[s:e] + (text[e : e + 1] or " ")
                    for s, e in zones(text)
                    if e - s <= ZONE_CHARS
                ]
                for text in texts
            ])

    rows = docs.select(F.explode(cut("text")).alias("zone")).distinct()
    chosen = rows.orderBy(F.xxhash64("zone"), "zone").limit(limit).collect()
    return [row.zone for row in chosen]


def train(docs: DataFrame, limit: int = SAMPLE_ZONES) -> SemiMarkov:
    return SemiMarkov.trained(examples(training_zones(docs, limit)))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: SemiMarkov | None = None) -> DataFrame:
    """Personal data of every whole text: one row per row of ``docs``.

    ``doc_id``, counts of base spans per kind (n_email, n_ip, n_card, n_phone),
    ``base_sha256``, and ``spans``: base and added spans as kind:start:end in
    code points, by start and then kind. Null and empty texts have no spans.
    Where segmentations score alike the one found first, with fewer segments, is
    taken. Texts of any length are read whole, zones to the end of an address; a
    span that the field adds has at most ``MAX_TOKENS`` tokens, where a mark such
    as " [dot] " is one. Repeated rows give repeated rows, an empty table none;
    without zones to learn from nothing is added. Other columns are not read.

    The field is learned from at most ``SAMPLE_ZONES`` different zones of at most
    ``ZONE_CHARS`` characters and ``TRAINING_SEGMENTS`` candidate segments.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast((field or train(rows)).weights.astype("float32"))

    @F.pandas_udf(
        "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    )
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        learned = SemiMarkov(model.value.astype("float64"))
        names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
        for texts in batches:
            out = []
            for text in texts:
                base = base_spans(text)
                more = added_spans(text, base, learned)
                kinds = [kind for _, _, kind in base]
                out.append((
                    *map(kinds.count, KINDS),
                    hashlib.sha256(as_text(base).encode()).hexdigest(),
                    as_text(in_order(base + more)),
                    len(more),
                ))
            yield pd.DataFrame(out, columns=names)

    return rows.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")
