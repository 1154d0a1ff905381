"""Secrets in texts: known shapes, and strings whose characters are too evenly mixed to be words.

For every candidate string a window slides over it; the counts of its characters, and with them its Shannon entropy, are
kept up by one step down and one step up per move. A window counts if its entropy reaches the limit of
its character class, the narrowest class that holds the whole candidate. Runs of a narrower class inside a candidate
are candidates too, so a hex secret joined to a word is held to the limit of hex. Overlapping windows form one span.
An allow-list takes out candidates that look random but are not secret.

Defined results: NULL and empty texts have no spans; positions are code points of the whole text, ends exclusive; repeated rows are texts of their own;
extra columns are not touched.
"""

import hashlib
import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Known shapes in the order in which kinds are listed: pattern, group that must have a length, that length, and text that has to be there.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
KINDS = tuple(k for k, *_ in BASE) + ("entropy",)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A shorter run of hex digits is dropped anyway, so only long ones are looked for; the runs are the same.
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")

WINDOW = 20
#: Character classes from narrow to wide, with the entropy in bits per character that a window has to reach.
CLASSES = ((re.compile(r"[0-9]+"), math.inf), (re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.0), (re.compile(r"[0-9A-Za-z]+"), 3.6), (re.compile(r"[0-9A-Za-z+/=_-]+"), 3.8))
_CANDIDATE = re.compile(r"[0-9A-Za-z+/=_-]{%d,}" % WINDOW)
#: Runs inside a candidate that are candidates of a narrower class.
_RUNS = tuple(re.compile(r"%s{%d,}" % (c, WINDOW)) for c in ("[0-9a-f]", "[0-9A-F]", "[0-9A-Za-z]"))
#: Not secret: UUIDs, dates and versions in file-like names, words joined by marks, letters with a trailing number.
ALLOWED = tuple(re.compile(p) for p in (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[A-Za-z]+([+/=_-][A-Za-z]+)*[+/=_-]*", r"([A-Za-z]+[+/=_-])*[A-Za-z]+[-_]?[0-9]{1,6}",
    r"[0-9]+([+/=_-][0-9]+)*", r"[=_/+-]+"))
_N_LOG_N = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the known shapes, leftmost and not overlapping within a kind, those too short dropped."""
    out, low = [], text.lower()
    for number, (kind, pattern, group, least) in enumerate(BASE):
        if kind == "hex":
            out += [(m.start(), number, m.end()) for m in _LONG_HEX.finditer(text)]
        elif kind == "access":
            if "AKIA" in text:
                out += [(m.start(), number, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
        elif any(w in low for w in _ASSIGN_WORDS):
            out += [(m.start(), number, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(out)


def _window_spans(candidate: str, allowed) -> list[tuple[int, int]]:
    """Spans of a string of one class whose windows reach the limit of that class."""
    if not any(c.isdigit() for c in candidate) or any(p.fullmatch(candidate) for p in allowed):
        return []
    limit = next((bits for p, bits in CLASSES if p.fullmatch(candidate)), math.inf)
    if limit == math.inf:
        return []
    counts: dict[str, int] = {}
    summed, spans = 0.0, []  # summed: of n log n over the window's characters
    need = math.log2(WINDOW) - limit + 1e-9
    for i, c in enumerate(candidate):
        if i >= WINDOW:
            gone = candidate[i - WINDOW]
            n = counts[gone]
            summed += _N_LOG_N[n - 1] - _N_LOG_N[n]
            counts[gone] = n - 1
        n = counts.get(c, 0)
        summed += _N_LOG_N[n + 1] - _N_LOG_N[n]
        counts[c] = n + 1
        if i >= WINDOW - 1 and summed / WINDOW <= need:
            if spans and spans[-1][1] >= i - WINDOW + 1:
                spans[-1] = spans[-1][0], i + 1
            else:
                spans.append((i - WINDOW + 1, i + 1))
    return spans


def entropy_spans(candidate: str, allowed=ALLOWED) -> list[tuple[int, int]]:
    """Spans of a candidate whose windows reach the limit of its class, or of the class of a run that holds them."""
    if not any(c.isdigit() for c in candidate) or any(p.fullmatch(candidate) for p in allowed):
        return []
    pieces = {(0, len(candidate))} | {m.span() for runs in _RUNS for m in runs.finditer(candidate)}
    spans: list[tuple[int, int]] = []
    for a, b in sorted((lo + a, lo + b) for lo, hi in pieces for a, b in _window_spans(candidate[lo:hi], allowed)):
        if spans and spans[-1][1] >= a:
            spans[-1] = spans[-1][0], max(spans[-1][1], b)
        else:
            spans.append((a, b))
    return spans


def secret_spans(text: str, allowed=ALLOWED) -> list[tuple[int, int, int]]:
    """All spans, known shapes and uneven strings, by start and kind."""
    found = base_spans(text)
    for m in _CANDIDATE.finditer(text):
        found += [(m.start() + a, len(BASE), m.start() + b) for a, b in entropy_spans(m.group(), allowed)]
    return sorted(found)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_report(text: Column) -> Column:
    """Struct of the number of spans of each known shape, a digest of these spans, and all spans as ``kind:start:end``."""
    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def report(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            spans = secret_spans(t or "")
            base = [s for s in spans if s[1] < len(BASE)]
            rows.append((*(sum(s[1] == k for s in base) for k in range(len(BASE))), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return report(text)
