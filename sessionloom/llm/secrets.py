"""Secrets in text: fixed patterns, and entropy of sliding windows."""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import DataFrame

from .arrow import id_and_text, map_columns

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# Bits per character that a window of WINDOW characters needs, by the class of its candidate.
# Digits need none: 16 and more are a base span already.
LIMITS = {"digits": 9.9, "hex": 3.0, "letters": 3.3, "mixed": 3.6, "alnum": 3.6, "base64": 3.8}
# What looks random but is not secret.
ALLOWED = re.compile(
    r"(?ai)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"  # UUID
    r"|(?:[a-z]+[/_=-]+)+[a-z]*"  # words joined by a sign
)
# Marks of a dense part that is none; where one is a name of its own between signs, what stands around it is looked at alone.
SHAM = re.compile(r"(?ai)example|sample|placeholder|changeme|abcdefgh|12345678")
SHAM_NAME = re.compile(r"(?ai)(?:(?<=[/_=-])|^)(?:examples?|samples?|placeholders?|changeme)(?=[/_=-])")
CASES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
CLUSTERS = re.compile(r"sch|ch|ck|th|ng|sh|ph|ts|st")  # count as one consonant
TERMS = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]


def class_of(s: str) -> str:
    if s.isdigit():
        return "digits"
    if not re.search(r"[^0-9a-fA-F]", s) and re.search(r"[0-9]", s):
        return "hex"
    if s.isalpha():
        return "letters" if s.islower() or s.isupper() or s[1:].islower() else "mixed"
    return "alnum" if s.isalnum() else "base64"


def pieces_of(s: str) -> list[tuple[int, int]]:
    """The stretches between names such as ``samples`` in a path; all of it where there are none."""
    cuts = [m.span() for m in SHAM_NAME.finditer(s)]
    return list(zip([0] + [b for _, b in cuts], [a for a, _ in cuts] + [len(s)], strict=True))


def harmless(part: str) -> bool:
    """Placeholders, long words and compounds of words."""
    if SHAM.search(part):
        return True
    if not part.isalpha():
        return False
    words = CASES.findall(part)
    low = CLUSTERS.sub("h", part.lower())
    vowels = sum(c in "aeiouy" for c in low)
    return len(part) >= 4 * len(words) and 4 * len(low) <= 20 * vowels <= 13 * len(low) and not re.search(r"[^aeiouy]{5}", low)


def dense_parts(s: str, limit: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Stretches covered by windows with at least ``limit`` bits per character.

    One character comes in and one goes out per step, so only two counts
    change; entropy = log2(window) - sum(c log2 c) / window.
    """
    counts: dict[str, int] = {}
    total = 0.0
    parts: list[tuple[int, int]] = []
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += TERMS[c + 1] - TERMS[c]
        counts[ch] = c + 1
        if i >= window:
            old = s[i - window]
            c = counts[old]
            total += TERMS[c - 1] - TERMS[c]
            counts[old] = c - 1
        if i >= window - 1 and math.log2(window) - total / window >= limit - 1e-9:
            start = i - window + 1
            if parts and start <= parts[-1][1]:
                parts[-1] = (parts[-1][0], i + 1)
            else:
                parts.append((start, i + 1))
    return parts


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all findings, in order; kinds are places in KINDS."""
    low = text.lower()
    found = []
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = list(found)
    for m in CANDIDATE.finditer(text):
        s = m[0]
        if ALLOWED.fullmatch(s):
            continue
        for p, q in pieces_of(s):
            if q - p < WINDOW:
                continue
            for a, b in dense_parts(s[p:q], LIMITS[class_of(s[p:q])]):
                if harmless(s[p + a : p + b]):
                    continue
                a, b = a + p + m.start(), b + p + m.start()
                if not any(a < e and s0 < b for s0, _, e in base):
                    found.append((a, 3, b))
    return sorted(found)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> of every document.

    Offsets count code points, the end is exclusive.  The base patterns give
    non-overlapping matches per kind; ``entropy`` spans are added where windows
    of a candidate string are dense for its character class, unless the string
    is on the allow-list or the span overlaps a base one.  Null and empty texts
    have no spans; every row, repeated or not, gives one row.
    """

    def run(ids, texts):
        spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t)] for t in texts]
        return {"doc_id": ids, "spans": spans}

    ddl = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    return map_columns(id_and_text(docs, id_col, text_col), run, ddl)
