"""Secret scan with multipart credential linking.

Base kinds are found by their patterns alone: ``assign`` (a key word set to a value), ``access``
(an access identifier) and ``hex`` (a long run of hex digits). Weak candidates mean nothing by
themselves: ``weak_access`` (a user, client or account name that is set to a value), ``weak_secret``
(a short password or an opaque mixed string) and ``endpoint`` (a URL or connection string). The
parts of one text are joined by intervals: two parts link if the gap between them is at most
``reach`` code points and no blank line lies in it. A weak secret is reported if it links to an
access identifier, strong or weak; a weak access name if it links to a secret, base or weak, or to
an endpoint that is itself linked to a secret; an endpoint if it links to an access identifier
and to a secret.

Spans are (kind, start, end) in code points, end exclusive, by start, then in the order of
``KINDS``. Null texts count as empty; empty texts have no spans. Texts are read whole, and the work
is linear in their length plus the parts found. Rows are independent: repeated rows give repeated
results, and columns other than those named are left out. No part has a greatest length.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.llm.tables import pick, slices

# The base patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so a shorter one never hides a longer one
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KEY_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")

NAME_WORDS = ("user", "login", "client", "account", "access")
NAME = re.compile(
    r"""\b(?:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?(?:key_?)?id)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9@._-]{3,})""", re.I | re.A
)
ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.:-]{1,20}://[^\s\"'<>]+", re.A)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")
SHORT_SECRET = 6
REACH = 256

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType(), False), T.StructField("start", T.IntegerType(), False),
    T.StructField("end", T.IntegerType(), False),
]), False)
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """The base spans, and the values of assignments that are too short to be one."""
    found, short = [], []
    lower = text.lower()
    if any(word in lower for word in KEY_WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append(("assign", m.start(), m.end()))
            elif m.end(2) - m.start(2) >= SHORT_SECRET:
                short.append((m.start(), m.end()))
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found, short


def _opaque(value: str) -> bool:
    return any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value)


class _Parts:
    """Intervals of one role, sorted, for the join by reach."""

    def __init__(self, text: str, reach: int, spans):
        self.text, self.reach = text, reach
        self.spans = sorted(set(spans))
        self.starts = [s for s, _ in self.spans]
        self.ends = sorted(e for _, e in self.spans)
        self.furthest = list(accumulate((e for _, e in self.spans), max))

    def link(self, start: int, end: int) -> bool:
        """Whether a part that does not overlap the span lies within reach and in the same block; the nearest on each side decides."""
        before, after = bisect_right(self.ends, start) - 1, bisect_left(self.starts, end)
        gaps = [(self.ends[before], start)] if before >= 0 else []
        gaps += [(end, self.starts[after])] if after < len(self.starts) else []
        return any(high - low <= self.reach and not BLANK_LINE.search(self.text, low, high) for low, high in gaps)

    def free(self, start: int, end: int) -> bool:
        """Whether no part overlaps the span."""
        k = bisect_left(self.starts, end)
        return not k or self.furthest[k - 1] <= start


def linked_spans(text: str, base, short, reach: int = REACH) -> list[tuple[str, int, int]]:
    """The weak candidates of a text that complementary parts confirm."""
    access = [(s, e) for kind, s, e in base if kind == "access"]
    secrets = [(s, e) for kind, s, e in base if kind != "access"]
    lower = text.lower()
    names = [m.span() for m in NAME.finditer(text)] if any(w in lower for w in NAME_WORDS) else []
    endpoints = [m.span() for m in ENDPOINT.finditer(text)] if "://" in text else []
    if not (access or names or endpoints):
        return []
    opaque = {m.span() for m in OPAQUE.finditer(text) if _opaque(m.group())}  # whole tokens, of any length
    taken = _Parts(text, 0, access + secrets + names + endpoints)
    weak = sorted(span for span in {*short, *opaque} if taken.free(*span))
    named = _Parts(text, reach, access + names)
    weak_linked = [span for span in weak if named.link(*span)]
    secret = _Parts(text, reach, secrets + weak_linked)
    ends = [span for span in endpoints if named.link(*span) and secret.link(*span)]
    reached = _Parts(text, reach, ends)
    names_linked = [span for span in names if secret.link(*span) or reached.link(*span)]
    return (
        [("weak_access", *s) for s in names_linked] + [("weak_secret", *s) for s in weak_linked]
        + [("endpoint", *s) for s in ends]
    )


def spans_of(text: str | None, reach: int = REACH) -> list[tuple[str, int, int]]:
    """All spans of one text."""
    if not text:
        return []
    base, short = base_spans(text)
    found = base + linked_spans(text, base, short, reach)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the name of its first kind in brackets."""
    out, at, covered = [], 0, 0
    for kind, start, end in spans:
        if start >= covered:
            out += [text[at:start], f"[{kind}]"]
        covered = at = max(covered, end)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), reach: int = REACH) -> DataFrame:
    """The columns ``keep`` of each row and ``spans``, an array of (kind, start, end); empty if there are none."""
    source = pick(docs, *keep, "text").withColumnRenamed("text", "_text")
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("spans", SPANS, False)])

    def run(batches):
        for part in slices(batches, "_text"):
            found = [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans_of(text, reach)]
                for text in part.column(len(keep)).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(found, ARROW_SPANS)], [*keep, "spans"])

    return source.mapInArrow(run, schema)


def redact_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """The rows with their secrets replaced by ``[kind]``; null texts stay null, all columns stay."""
    at = docs.columns.index("text")

    def run(batches):
        for part in slices(batches):
            texts = [t and redact(t, spans_of(t, reach)) for t in part.column(at).to_pylist()]
            yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the number of base spans of each kind, the digest of the base spans, and all spans as text."""
    found = find_secrets(docs, keep)
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        *keep, number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )
