"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides on spans.

Candidates are the base matches of four kinds, which always stay, and spans of looser patterns. Five
labelers vote on each: yes, no or abstain: the form of the span (regular expressions), its checksum,
gazetteers (domains, address ranges, issuers, codes), cue words before it, and its neighbours.
Expectation-maximisation over the counts of all vote patterns of the corpus estimates how reliable
each labeler is and how likely each pattern is personal data; a logistic regression on votes, kind and
shape is then trained on these likelihoods and accepts or rejects every looser candidate.

Votes and shapes are few, so that the corpus comes to the driver as counts of patterns: at most
kinds x 3^5 votes x 8 shapes rows, however large it is.

Defined results
- Offsets count code points, the end is exclusive. Spans are in the order of KINDS, then of start.
- Base matches are leftmost and do not overlap within a kind; looser spans overlap no base match and no
  earlier looser one.
- Null or empty text: no spans. Repeated rows: each its own spans. Empty tables: no rows.
- All rows and columns stay; the added column replaces one of its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "iban")
LABELERS = ("form", "checksum", "gazetteer", "cue", "neighbours")
SPAN = "struct<kind: string, start: int, end: int, base: boolean, pattern: string>"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]|[\[(] ?at ?[\])]", re.I)

LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]{2,63}){1,4}", re.I),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "phone": re.compile(r"(?<![\w.+-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ ./-])[0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])"),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
}

CUES = {
    "email": re.compile(r"mail|contact|write|kontakt|courriel|correo", re.I),
    "ip": re.compile(r"\bip\b|host|server|login|client|address|adresse", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|karte|carte|tarjeta|pay", re.I),
    "phone": re.compile(r"phone|\btel|call|mobile|fax|cell|anruf|appel|llam", re.I),
    "ssn": re.compile(r"ssn|social|security", re.I),
    "iban": re.compile(r"iban|account|konto|compte|cuenta|bank", re.I),
}
COUNTER = re.compile(r"version|\bv\.?$|isbn|page|order|serial|sku|id[:=# ]|token|hash|sha|total|[$€£#=/]\s*\"?$", re.I)
#: Country codes of one and two digits, and the leading digits of card issuers.
COUNTRY = re.compile(r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])")
ISSUER = re.compile(r"3[47]|4|5[1-5]|2[2-7]|6(?:011|5|4[4-9])|35")
RESERVED = re.compile(r"(?:0|10|127|169\.254|192\.168|255)\.|[fF][eE]80:|::")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if place % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ takes the whole run of local characters before it: the leftmost match there is."""
    floor = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        at += 1
        if start < at - 1 and (m := DOMAIN.match(text, at)):
            yield start, m.end()
            floor = at = m.end()


def ips(text: str) -> Iterator[tuple[int, int]]:
    """A chain of dotted numbers gives a match for every four of them from its left end."""
    for m in DOTTED.finditer(text):
        parts = m[0].split(".")
        start = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in DIGITS.finditer(text):
        if m.end() - m.start() <= 37 and 16 <= len(digits := only_digits(m[0])) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(only_digits(m[0])) <= 15:
                yield m.span()


BASE = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def iban_valid(text: str) -> bool:
    code = text.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def votes(kind: str, text: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    span, digits = text[start:end], only_digits(text[start:end])
    before, after = text[max(0, start - 40) : start], text[end : end + 2]
    form = {
        "email": base and not span.startswith((".", "-", "%")) and ".." not in span,
        "ip": True,
        "card": len(digits) == 16 or (len(digits) == 15 and digits[0] == "3"),
        "phone": base or len(digits) in (9, 10, 11),
        "ssn": not re.match(r"000|666|9|...-00|......-0000", span),
        "iban": 15 <= len(span.replace(" ", "")) <= 34,
    }[kind]
    checksum = 0
    if kind == "card":
        checksum = 1 if luhn(digits) else -1
    elif kind == "iban":
        checksum = 1 if iban_valid(span) else -1
    gazetteer = 0
    if kind == "email":
        gazetteer = 1 if re.search(r"\.(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$", span, re.I) else -1
    elif kind == "ip":
        gazetteer = -1 if RESERVED.match(span) else 1
    elif kind == "card":
        gazetteer = 1 if ISSUER.match(digits) else -1
    elif kind == "phone":
        gazetteer = (1 if COUNTRY.match(span) else -1) if base else 0
    cue = 1 if CUES[kind].search(before) else (-1 if COUNTER.search(before[-12:]) else 0)
    stuck = before[-1:].isalnum() or after[:1].isalnum() or after[:1] in ("%", "$") or before[-1:] in ("$", "#", "=", "/")
    return (1 if form else -1, checksum, gazetteer, cue, -1 if stuck else 1)


def candidates(text: str | None) -> list[dict]:
    """All candidate spans of a text with the pattern of kind, votes and shape."""
    if not text or not HINT.search(text):
        return []
    found = [(k, s, e, True) for k in BASE_KINDS for s, e in BASE[k](text)]
    taken = sorted((s, e) for _, s, e, _ in found)
    loose = [(s, e, k) for k, pattern in LOOSE.items() for s, e in (m.span() for m in pattern.finditer(text))]
    for m in DIGITS.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(only_digits(m[0])) <= 19:
            loose.append((*m.span(), "card"))
    free, at, last = [], 0, 0
    for s, e, k in sorted(loose):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if s >= last and (at == len(taken) or taken[at][0] >= e):
            free.append((k, s, e, False))
            last = e
    out = []
    for kind, s, e, base in [*found, *free]:
        v = votes(kind, text, s, e, base)
        span = text[s:e]
        shape = 4 * base + 2 * any(c in " ().-" for c in span) + (len(only_digits(span)) > 10)
        pattern = f"{kind}|{''.join('-0+'[x + 1] for x in v)}|{shape}"
        out.append({"kind": kind, "start": s, "end": e, "base": base, "pattern": pattern})
    return sorted(out, key=lambda x: (KINDS.index(x["kind"]), x["start"]))


def candidate_spans(text: Column) -> Column:
    """array<struct<kind, start, end, base, pattern>> of a text."""

    @arrow_udf(f"array<{SPAN}>")
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([candidates(t) for t in texts.to_pylist()], arrow_type)

    fields = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("pattern", pa.string())]
    arrow_type = pa.list_(pa.struct(fields))
    return find(text)


# -- learning --------------------------------------------------------------------------------


def read_pattern(pattern: str) -> tuple[int, list[int], int]:
    kind, marks, shape = pattern.split("|")
    return KINDS.index(kind), ["-0+".index(c) - 1 for c in marks], int(shape)


def expectation_maximisation(kinds: np.ndarray, marks: np.ndarray, counts: np.ndarray, rounds: int = 200):
    """Likelihood that each vote pattern is personal data; and P(vote | class) of each labeler.

    marks: patterns x labelers, values -1, 0, 1. Pseudo-counts say that labelers are right more
    often than not, which fixes which class is which.
    """
    prior = np.array([[6.0, 2.0, 2.0], [2.0, 2.0, 6.0]])  # class no and yes by vote no, none, yes
    share = np.clip(0.5 + 0.1 * marks.sum(axis=1), 0.05, 0.95)
    onehot = np.stack([marks == v for v in (-1, 0, 1)], axis=2).astype(float)
    reliability = np.empty((marks.shape[1], 2, 3))
    for _ in range(rounds):
        before = share
        weight = np.stack([(1 - share) * counts, share * counts])
        reliability = np.einsum("cp,plv->lcv", weight, onehot) + prior
        reliability /= reliability.sum(axis=2, keepdims=True)
        kind_yes = np.bincount(kinds, weight[1], len(KINDS)) + 1
        kind_all = np.bincount(kinds, counts, len(KINDS)) + 2
        base_rate = (kind_yes / kind_all)[kinds]
        logs = np.einsum("plv,lcv->pc", onehot, np.log(reliability))
        odds = logs[:, 1] - logs[:, 0] + np.log(base_rate) - np.log1p(-base_rate)
        share = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(share - before).max(initial=0) < 1e-9:
            break
    return share, reliability


def features(kinds: np.ndarray, marks: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    columns = [np.ones(len(kinds))]
    columns += [kinds == k for k in range(len(KINDS))]
    columns += [marks[:, j] == v for j in range(marks.shape[1]) for v in (-1, 1)]
    columns += [(shapes >> b) & 1 for b in range(3)]
    return np.stack(columns, axis=1).astype(float)


def fit_logistic(x: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps on counted rows with soft targets."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (target - p)) - ridge * w
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Probability of each pattern that occurs in docs, by the trained classifier."""
    counted = (
        docs.select(F.explode(candidate_spans(F.col(text_col))).alias("s"))
        .groupBy(F.col("s.pattern").alias("pattern"))
        .count()
        .orderBy("pattern")
        .collect()
    )
    if not counted:
        return {}
    read = [read_pattern(r.pattern) for r in counted]
    kinds, marks = np.array([r[0] for r in read]), np.array([r[1] for r in read])
    shapes, counts = np.array([r[2] for r in read]), np.array([r["count"] for r in counted], float)
    share, _ = expectation_maximisation(kinds, marks, counts)
    # The base matches are personal data by definition: sure examples beside the estimated ones.
    share = np.where(shapes & 4, 1.0, share)
    x = features(kinds, marks, shapes)
    p = 1 / (1 + np.exp(-(x @ fit_logistic(x, share, counts))))
    return {r.pattern: float(v) for r, v in zip(counted, p, strict=True)}


def find(docs: DataFrame, model: dict[str, float], text_col: str = "text", spans_col: str = "spans", least: float = 0.5) -> DataFrame:
    """docs with array<struct<kind, start, end, base, pattern>>: base matches and accepted candidates."""
    accepted = F.lit(sorted(p for p, v in model.items() if v >= least)) if model else F.array().cast("array<string>")
    kept = F.filter(
        candidate_spans(F.col(text_col)), lambda s: s["base"] | F.array_contains(accepted, s["pattern"])
    )
    return docs.withColumn(spans_col, kept)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def mask(text: str | None, spans: list[dict]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of overlapping ones, the first."""
    if not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda x: (x["start"], -x["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def masked(text: Column, spans: Column) -> Column:
    @arrow_udf("string")
    def replace(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array(list(map(mask, texts.to_pylist(), found.to_pylist())), pa.string())

    return replace(text, spans)


def base_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
