"""Personal data by weak supervision.

Patterns propose spans, wide enough to hold what is not personal: any words in capitals as a
name, and numbers and addresses left of base matches that fail their checks, where two
numbers side by side made one match too long or a number is no card. Labelers of three sorts
(regex and checksum, gazetteer, context)
vote on each: personal, not personal, or no opinion. How often each combination of kind,
votes and shape occurs is counted over all documents; expectation-maximisation on these
counts estimates how reliable each labeler is for either class, apart for addresses, numbers
and names; the checksum's reliability is given. A logistic classifier is
then fitted to the posteriors, weighted by the counts, and decides the proposed spans. What
goes to the driver is one count per combination, and there are at most ``COMBINATIONS``.

Spans of the base kinds (email, ip, card, phone) that pass their own checks always count;
the classifier adds spans of the further kinds where it finds them personal.

Defined results: a null or empty text has no spans; offsets count code points, ends are
exclusive; ties at one start go by the order of ``KINDS``; repeated rows and null ids are
kept as they are; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightfolio.llm.common import stored

BASE = ("email", "ip", "card", "phone")
KINDS = (
    *BASE, "masked_email", "local_phone", "ssn", "iban", "name",
    # What is left of base matches that fail their checks.
    "card_number", "phone_number", "dotted_quad",
)
NAME, CARD_NUMBER, PHONE_NUMBER, DOTTED_QUAD = 8, 9, 10, 11
#: Addresses, numbers, names: a labeler may be good with one sort of span and not with another.
FAMILY = (0, 0, 1, 1, 0, 1, 1, 1, 2, 1, 1, 0)

_MAIL_END = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits can only start a match where it starts itself.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MASKED = re.compile(
    r"\b[A-Za-z0-9._-]{1,64} ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]{1,64}"
    r"(?: ?[\[({] ?dot ?[\])}] ?[A-Za-z0-9-]{1,64}|\.[A-Za-z]{2,24})"
)
_LOCAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_CUED = re.compile(
    r"\b(?:[Mm]y name is|[Nn]ame:|Mr\.|Mrs\.|Ms\.|Dr\.|Dear|Signed,?|Sincerely,)\s+"
    r"([A-Z][a-zA-Z'-]{1,30}(?: [A-Z][a-zA-Z'-]{1,30}){1,2})"
)
_NAME = re.compile(r"\b[A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30}){1,2}\b")
_RUN = re.compile(r"(?<![0-9])(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9](?:-?[0-9]){11,18}+)(?![0-9])")

# Gazetteers and context words.
TLDS = frozenset("com org net edu gov int io co de fr es uk eu us ca ch at it nl be info".split())
GIVEN = frozenset(
    "james mary john anna peter paul maria jose juan luis carlos ana pierre jean marie sophie "
    "hans klaus karl ursula thomas michael david sarah laura emma lukas julia robert linda".split()
)
COUNTRIES = frozenset("DE FR ES GB IT NL BE AT CH PT IE LU PL SE DK NO FI".split())
NEAR = {
    "email": r"mail|contact|write|reach|kontakt|courriel|correo",
    "masked_email": r"mail|contact|write|reach|kontakt|courriel|correo",
    "ip": r"\bip\b|host|server|address|login|client|from",
    "card": r"card|visa|credit|debit|pay|karte|carte|tarjeta|account",
    "phone": r"phone|call|tel|fax|mobile|whatsapp|ring",
    "local_phone": r"phone|call|tel|fax|mobile|whatsapp|ring",
    "ssn": r"ssn|social|security|tax",
    "iban": r"iban|bank|account|transfer|konto|compte|cuenta",
    "name": r"\b(?:name|dear|signed|sincerely|mr|mrs|ms|dr)\b",
}
NEAR |= {"card_number": NEAR["card"], "phone_number": NEAR["phone"], "dotted_quad": NEAR["ip"]}
AWAY = r"version|isbn|issn|order|invoice|ticket|build|release|page|chapter|section|figure|part no"
CONTEXT = 40
LABELERS = 6
#: Kinds by votes by length class: the bound of what the driver gets.
COMBINATIONS = len(KINDS) * 3**LABELERS * 4

_CUE_END = re.compile(r"(?:name is|Name:|Mr\.|Mrs\.|Ms\.|Dr\.|Dear|Signed,?|Sincerely,)\s+$")
_NEAR = {kind: re.compile(words, re.IGNORECASE) for kind, words in NEAR.items()}
_AWAY = re.compile(AWAY, re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for match in _MAIL_END.finditer(text):
        at = match.start()
        # Walk back over the local part, not into the match before.
        start = at
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at:
            end = match.end()
            yield start, end


def _part_ok(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of the spans of the base kinds."""
    found = []
    if "@" in text:
        found += [(0, *span) for span in _emails(text)]
    for match in _IP.finditer(text):
        if all(map(_part_ok, match[0].split("."))):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = _digits(match[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_digits(match[0])) <= 15:
                found.append((3, *match.span()))
    return found


def _iban_ok(text: str) -> bool:
    plain = text.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _left(start: int, end: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The pieces of a range that no taken span covers; spans in order."""
    for first, last in taken:
        if last <= start:
            continue
        if first >= end:
            break
        if first > start:
            yield start, first
        start = last
    if start < end:
        yield start, end


def near_misses(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Proposals from matches of base patterns that fail their checks: numbers that stand side
    by side make one match too long, and some are no card or address at all."""
    found = []
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = _digits(match[0])
            if len(digits) >= 12 and not (len(digits) <= 19 and luhn(digits)):
                for low, high in _left(*match.span(), taken):
                    found += [(CARD_NUMBER, *m.span()) for m in _RUN.finditer(text, low, high)]
    if "+" in text:
        for match in _PHONE.finditer(text):
            if not 9 <= len(_digits(match[0])) <= 15:
                for low, high in _left(*match.span(), taken):
                    piece = text[low:high].rstrip(" ().-")
                    if piece.startswith("+") and 9 <= len(_digits(piece)) <= 15:
                        found.append((PHONE_NUMBER, low, low + len(piece)))
    for match in _IP.finditer(text):
        if not all(map(_part_ok, match[0].split("."))):
            found.append((DOTTED_QUAD, *match.span()))
    return found


def further_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Proposals of the further kinds that do not overlap ``taken`` or each other."""
    proposals = []
    if "at" in text and any(c in text for c in "[({"):
        proposals += [(4, *m.span()) for m in _MASKED.finditer(text)]
    for kind, pattern in ((5, _LOCAL), (6, _SSN), (7, _IBAN)):
        proposals += [(kind, *m.span()) for m in pattern.finditer(text)]
    cued = [(NAME, *m.span(1)) for m in _CUED.finditer(text)]
    names = [m.span() for m in _NAME.finditer(text)]
    places = [start for start, _ in names]
    for _, start, end in cued:
        # The cue itself may look like part of the name.
        for k in range(max(0, bisect_left(places, start) - 1), bisect_left(places, end)):
            if names[k][1] > start:
                names[k] = None, 0
    proposals += cued + [(NAME, start, end) for start, end in names if start is not None]
    used = sorted((start, end) for _, start, end in taken)
    proposals += near_misses(text, used)
    if not proposals:
        return []
    out = []
    # Of the taken spans that start before a place, where the last one ends.
    starts = [start for start, _ in used]
    ends = [0, *accumulate((end for _, end in used), max)]
    reached = 0
    for kind, start, end in sorted(proposals, key=lambda p: (p[1], p[0])):
        if start >= reached and start >= ends[bisect_left(starts, end)]:
            out.append((kind, start, end))
            reached = end
    return out


def votes(text: str, kind: int, start: int, end: int) -> tuple[int, ...]:
    """Of each labeler 0 (no opinion), 1 (not personal) or 2 (personal)."""
    name, span = KINDS[kind], text[start:end]
    digits = _digits(span)
    before = text[max(0, start - CONTEXT) : start]
    well_formed, checked, listed, varied = 0, 0, 0, 0
    if name == "email":
        well_formed = 2 if not span.startswith(".") and ".." not in span else 1
        listed = 2 if span.rpartition(".")[2].lower() in TLDS else 1
    elif name == "masked_email":
        well_formed = 2
        listed = 2 if re.split(r"[^A-Za-z]+", span.rstrip("]})"))[-1].lower() in TLDS else 0
    elif name == "ip":
        well_formed = 1 if any(len(p) > 1 and p[0] == "0" for p in span.split(".")) else 2
        listed = 1 if span.startswith(("0.", "127.", "255.")) else 0
    elif name in ("card", "card_number"):
        checked = 2 if name == "card" or luhn(digits) else 1
        listed = 2 if digits[0] in "3456" else 0
    elif name == "dotted_quad":
        well_formed, checked = 1, 1
    elif name in ("phone", "local_phone", "phone_number"):
        well_formed = 2 if 10 <= len(digits) <= 13 else 0
    elif name == "ssn":
        bad = digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00"
        well_formed = 1 if bad or digits[5:] == "0000" else 2
    elif name == "iban":
        checked = 2 if _iban_ok(span) else 1
        listed = 2 if span[:2] in COUNTRIES else 1
    else:
        cue = _CUE_END.search(before)
        well_formed = 2 if cue else 1
        listed = 2 if any(word.lower() in GIVEN for word in span.split()) else 0 if cue else 1
    if len(digits) > 4 and len(set(digits)) <= 2:
        varied = 1
    near = 2 if _NEAR[name].search(before) else 0
    away = 1 if _AWAY.search(before) else 0
    return well_formed, checked, listed, varied, near, away


def combination(text: str, kind: int, start: int, end: int) -> int:
    """Kind, votes and length class of a span as one number below ``COMBINATIONS``."""
    number = kind
    for vote in votes(text, kind, start, end):
        number = number * 3 + vote
    return number * 4 + min(3, (end - start) // 8)


def _unpacked(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length, rest = numbers % 4, numbers // 4
    out = []
    for _ in range(LABELERS):
        out.append(rest % 3)
        rest = rest // 3
    return rest, np.stack(out[::-1], axis=1), length


#: The checksum's reliability is given: a number that fails it is no card or account, and such
#: numbers are the negatives from which the other labelers' reliabilities are learned.
TRUSTED = {1: 0.99}


def reliabilities(
    ballots: np.ndarray, counts: np.ndarray, rounds: int = 50, trusted: dict[int, float] | None = None
):
    """Expectation-maximisation: the share of personal spans, each labeler's chance of
    each vote in either class when it votes, and the posteriors of the ballots. Having no
    opinion says nothing about a span.

    ``trusted`` labelers keep the given chance of being right when they vote.
    """
    weight = counts.astype(float)
    for_, against = (ballots == 2).sum(axis=1), (ballots == 1).sum(axis=1)
    posterior = (for_ + 1.0) / (for_ + against + 1.5)
    for labeler, right in (trusted or {}).items():
        posterior = np.where(ballots[:, labeler] == 1, 1 - right, posterior)
    for _ in range(rounds):
        classes = np.stack([1 - posterior, posterior], axis=1) * weight[:, None]
        share = (classes.sum(axis=0) + 1) / (weight.sum() + 2)
        chance = np.ones((LABELERS, 2, 3))
        for labeler in range(LABELERS):
            if labeler in (trusted or {}):
                right = trusted[labeler]
                chance[labeler, :, 1:] = [[right, 1 - right], [1 - right, right]]
                continue
            for vote in (1, 2):
                chance[labeler, :, vote] = classes[ballots[:, labeler] == vote].sum(axis=0)
            # A labeler is taken to be right rather than wrong until counts say otherwise.
            chance[labeler, :, 1:] += [[4, 1], [1, 4]]
            chance[labeler, :, 1:] /= chance[labeler, :, 1:].sum(axis=1, keepdims=True)
        score = np.tile(np.log(share), (len(ballots), 1))
        for labeler in range(LABELERS):
            score += np.log(chance[labeler][:, ballots[:, labeler]]).T
        posterior = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
    return share, chance, posterior


def _features(kinds: np.ndarray, ballots: np.ndarray, length: np.ndarray) -> np.ndarray:
    parts = [np.eye(3)[np.array(FAMILY)[kinds]], np.eye(4)[length], np.ones((len(kinds), 1))]
    parts += [(ballots == vote).astype(float) for vote in (1, 2)]
    return np.concatenate(parts, axis=1)


def fit(numbers: np.ndarray, counts: np.ndarray) -> set[int]:
    """The combinations that the final classifier takes for personal data."""
    if not len(numbers):
        return set()
    kinds, ballots, length = _unpacked(numbers)
    families, posterior = np.array(FAMILY)[kinds], np.empty(len(numbers))
    for family in np.unique(families):
        own = families == family
        posterior[own] = reliabilities(ballots[own], counts[own], trusted=TRUSTED)[2]
    x = _features(kinds, ballots, length)
    weight = counts / counts.sum()
    beta = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 1e-3
    for _ in range(30):  # Newton's steps
        chance = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (posterior - chance)) - 1e-3 * beta
        bend = (x * (weight * chance * (1 - chance))[:, None]).T @ x + ridge
        beta += np.linalg.solve(bend, slope)
    return set(numbers[x @ beta >= 0].tolist())


_SPAN = pa.struct(
    [("kind", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("combination", pa.int32())]
)
_SPANS = "array<struct<kind:int,first:long,last:long,combination:int>>"


def proposed(text: str | None) -> list[dict]:
    """All spans of a text in order, with their combination of votes."""
    if not text:
        return []
    spans = base_spans(text)
    spans += further_spans(text, spans)
    spans.sort(key=lambda s: (s[1], s[0]))
    return [
        {"kind": k, "first": a, "last": b, "combination": combination(text, k, a, b)}
        for k, a, b in spans
    ]


def _propose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([proposed(t.as_py()) for t in texts], pa.list_(_SPAN))


def with_proposals(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*columns, F.arrow_udf(_propose, _SPANS)("text").alias("proposed"))


def accepted_combinations(proposals: DataFrame, column: str = "proposed") -> set[int]:
    """Counts the combinations in ``proposals`` and fits the classifier to them."""
    rows = (
        proposals.select(F.explode(F.col(column)["combination"]).alias("combination"))
        .groupBy("combination")
        .count()
        .collect()
    )
    rows.sort()
    numbers = np.array([r["combination"] for r in rows], np.int64)
    return fit(numbers, np.array([r["count"] for r in rows], np.int64))


def _kept(accepted: set[int]):
    chosen = F.array(*[F.lit(c) for c in sorted(accepted)]).cast("array<int>")
    return F.filter(
        "proposed",
        lambda s: (s["kind"] < len(BASE)) | F.array_contains(chosen, s["combination"]),
    )


def _is_kind(kind: int):
    # A second parameter, even with a default, would be the place in the array.
    return lambda span: span["kind"] == kind


def _joined(spans) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["first"], s["last"])
        ),
    )


def find(docs: DataFrame) -> DataFrame:
    """The spans of each row, with counts and a digest of those of the base kinds."""
    proposals = stored(with_proposals(docs, "doc_id"), "pii")
    spans = proposals.select("doc_id", _kept(accepted_combinations(proposals)).alias("s"))
    base = F.filter("s", lambda s: s["kind"] < len(BASE))
    counts = [
        F.size(F.filter("s", _is_kind(k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(BASE)
    ]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("s")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in brackets.

    ``n_chars``, where there is one, follows the new text; null texts stay null.
    """
    own = "proposed"
    while own in docs.columns:
        own += "_"
    # Stored with the rows: the patterns run once, and the classifier sees what is replaced.
    rows = stored(docs.withColumn(own, F.arrow_udf(_propose, _SPANS)("text")), "pii")
    accepted = accepted_combinations(rows, own)

    def rewrite(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            out = []
            for text, found in zip(texts, spans):
                text, found = text.as_py(), found.as_py()
                pieces, at = [], 0
                for span in found or ():
                    if span["kind"] >= len(BASE) and span["combination"] not in accepted:
                        continue
                    if span["last"] <= at:
                        continue
                    if span["first"] >= at:
                        pieces += [text[at : span["first"]], f"[{KINDS[span['kind']].upper()}]"]
                    at = span["last"]
                out.append("".join([*pieces, text[at:]]) if pieces else text)
            yield pa.array(out, pa.string())

    changed = rows.withColumn("text", F.arrow_udf(rewrite, "string")("text", own))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(*docs.columns)
