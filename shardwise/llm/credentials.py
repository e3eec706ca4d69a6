"""Secret scan with multipart credential linking.

Strong candidates (an assignment to a credential name, an access identifier,
a long hexadecimal run) are reported alone.  Weak candidates (an account
name, a mixed high-entropy token, an endpoint address) are reported only where
complementary parts co-occur: an interval join of parts with scopes links an
identifier with a secret in the same scope, whatever lies between them, and an
endpoint with such a linked pair.  A scope is a block of lines without an empty
line between them; one wider than ``WIDE`` code points also ends before section
heads.  ``reach``, if given, asks for parts at most so many code points apart: a
sweep over the parts' sorted interval ends.  All of this happens inside the
document, so no row leaves its partition and nothing is shuffled.

Defined results: a null text counts as empty and has no spans; texts are read
whole; equal rows give equal results; every input column is kept, and an input
column called like the output column is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise.llm.common import ship, text_slices

KINDS = ("assign", "access", "hex", "account", "key", "endpoint")  # order at equal starts
BASE_KINDS = KINDS[:3]
SLICE_CHARS = 1_000_000

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ACCOUNT = re.compile(r"""\b(?:client_?id|access_?key_?id|account(?:_?id|_?name)?|user(?:_?name|_?id)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{4,})""", re.I | re.A)
KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""\b[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+""", re.I | re.A)
SCOPE_END = re.compile(r"\n[ \t\r]*\n")
WIDE = 10_000
SECTION_HEAD = re.compile(r"\n(?=[ \t]*(?:\[[^\]\n]{1,80}\][ \t\r]*(?:\n|$)|#{1,6} |-{3,}[ \t\r]*(?:\n|$)|={3,}[ \t\r]*(?:\n|$)))")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCOUNT_WORDS = ("client", "access", "account", "user", "login")

SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("value", T.StringType()), T.StructField("linked", T.BooleanType()),
])
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("linked", pa.bool_())]))


def _mixed(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.isupper() for c in token) and any(c.islower() for c in token) and len(set(token)) >= 10


class Intervals:
    """Parts sorted by start with the largest end so far: answers in log time
    whether some part meets an interval."""

    def __init__(self, parts: list[tuple]):
        parts = sorted(parts, key=lambda s: s[1])
        self.starts = [s[1] for s in parts]
        self.ends = list(accumulate((s[2] for s in parts), max))

    def meet(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.ends[i - 1] > start


def scope_ends(text: str) -> list[int]:
    """Places where a scope ends: empty lines, and the section heads of blocks
    that are wide."""
    empty = [m.start() for m in SCOPE_END.finditer(text)]
    edges = [0, *empty, len(text)]
    heads = [m.start() for a, b in zip(edges, edges[1:]) if b - a > WIDE for m in SECTION_HEAD.finditer(text, a + 1, b)]
    return sorted(empty + heads)


def scan_text(text: str, reach: int | None = None) -> list[tuple]:
    """(kind, start, end, value, linked) of one text, by start and kind."""
    low = text.lower()
    strong: list[tuple] = []
    if any(k in low for k in ASSIGN_WORDS):
        strong += [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        strong += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    strong += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    accounts = []
    if any(k in low for k in ACCOUNT_WORDS) and ("=" in text or ":" in text):
        accounts = [("account", *m.span(), m[1]) for m in ACCOUNT.finditer(text)]
    ids = [s for s in strong if s[0] == "access"] + accounts
    if not strong and not accounts:
        return []
    out = {(s[0], s[1], s[2]): (*s, False) for s in strong}
    if ids:
        taken, named = Intervals(strong + accounts), Intervals(ids)
        keys = [("key", *m.span(), m[0]) for m in KEY.finditer(text) if _mixed(m[0]) and not taken.meet(*m.span())]
        secrets = keys + [s for s in strong if s[0] in ("assign", "hex") and not named.meet(s[1], s[2])]
        breaks = scope_ends(text)
        linked = join(ids, secrets, breaks, reach) + join(secrets, ids, breaks, reach)
        ends = [("endpoint", *m.span(), m[0]) for m in ENDPOINT.finditer(text)] if linked and "://" in text else []
        linked += join(ends, linked, breaks, reach)
        for s in linked:
            out[(s[0], s[1], s[2])] = (*s, True)
    return sorted(out.values(), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def join(left: list[tuple], right: list[tuple], breaks: list[int], reach: int | None) -> list[tuple]:
    """Parts of ``left`` with a part of ``right`` in the same scope (and at most
    ``reach`` code points away: one sorted interval index per scope)."""
    if reach is None:
        reach = max((s[2] for s in left + right), default=0)  # wider than any scope
    scope = lambda s: bisect_right(breaks, s[1])
    by: dict[int, list[tuple]] = {}
    for s in right:
        by.setdefault(scope(s), []).append(s)
    index = {k: Intervals(v) for k, v in by.items()}
    return [s for s in left if scope(s) in index and index[scope(s)].meet(s[1] - reach, s[2] + reach)]


def find_secrets(df: DataFrame, text: str = "text", out: str = "secrets", reach: int | None = None) -> DataFrame:
    """``df`` with ``out``: all spans (code points, end exclusive) of the text,
    sorted by start, then kind; ``linked`` marks parts of a linked credential."""
    ship(df.sparkSession)

    @F.arrow_udf(T.ArrayType(SPAN))
    def scan(texts: pa.Array) -> pa.Array:
        names = ("kind", "start", "end", "value", "linked")
        return pa.array([[dict(zip(names, s, strict=True)) for s in scan_text(t, reach)] for _, _, part in text_slices(texts, SLICE_CHARS) for t in part], type=_SPAN_ARROW)

    return df.withColumn(out, scan(F.coalesce(F.col(text), F.lit(""))))


def redact(df: DataFrame, text: str = "text", mark: str = "[secret]", reach: int | None = None) -> DataFrame:
    """``df`` with every span of its text replaced by ``mark`` (overlapping
    spans become one mark).  Null texts stay null."""
    ship(df.sparkSession)

    @F.arrow_udf(T.StringType())
    def cut(texts: pa.Array) -> pa.Array:
        parts = [pa.array([redact_text(t, scan_text(t, reach), mark) for t in part], type=pa.string()) for _, _, part in text_slices(texts, SLICE_CHARS)]
        return pa.concat_arrays([pa.array([], type=pa.string()), *parts])

    return df.withColumn(text, F.when(F.col(text).isNotNull(), cut(F.col(text))))


def redact_text(text: str, spans: list[tuple], mark: str) -> str:
    if not spans:
        return text
    parts, at, end = [], 0, -1
    for _, s, e, *_ in spans:
        if s >= end:
            parts += [text[at:s], mark]
        at = end = max(end, e)
    return "".join([*parts, text[at:]])
