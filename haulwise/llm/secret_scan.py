"""Secret scans: three base patterns, and a token-efficiency test that finds
random strings without a pattern of their own.

Ordinary words and identifiers take few tokens a character under a byte-pair
vocabulary; random strings take many. A run of 16 or more key characters with
letters and digits is reported as ``random`` when it has fewer than
``max_ratio`` characters per token, unless it is a known digest (hex of a
digest's length), a UUID or an identifier (words and short numbers joined by
separators). What a base match, digest or UUID covers is left out of a run. Of a run
that is not random as a whole the pieces between its separators are tested, and
neighbouring pieces of few characters a token together, so that a path or a
name around a random string does not hide it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwise.llm.common import token_encoding

KINDS = ("assign", "access", "hex", "random")
SPANS = "array<struct<kind:string,start:int,end:int,secret:boolean>>"

# The base patterns and their least lengths
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGIT = re.compile(r"[0-9]")
LETTER = re.compile(r"[A-Za-z]")
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
INNER = re.compile(rf"(?<![0-9A-Za-z])({UUID.pattern}|[0-9A-Fa-f]{{32,128}})(?![0-9A-Za-z])")
PIECE = re.compile(r"[A-Za-z0-9]+")
LEAST = 16
IDENTIFIER = re.compile(r"[+/_=-]*([A-Za-z]+[0-9]{0,4}|[0-9]{1,8})([+/_=-]+([A-Za-z]+[0-9]{0,4}|[0-9]{1,8}))*[+/_=-]*")
HEX_ONLY = re.compile(r"[0-9a-fA-F]+")


def known_value(run: str) -> bool:
    """A digest, a UUID or an identifier."""
    return bool(len(run) in DIGEST_LENGTHS and HEX_ONLY.fullmatch(run)
                or UUID.fullmatch(run) or IDENTIFIER.fullmatch(run))


def uncovered(start: int, end: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of start to end outside ``spans``."""
    out = []
    for s, e in sorted(spans):
        if s < end and start < e:
            out.append((start, s))
            start = max(start, e)
    return [(s, e) for s, e in [*out, (start, end)] if e > s]


def scanner(blob: bytes, pattern: str, max_ratio: float) -> Callable[[str], list[tuple]]:
    encode = token_encoding(blob, pattern).encode_ordinary

    def dense(part: str) -> bool:
        return len(part) < max_ratio * len(encode(part))

    def is_random(part: str) -> bool:
        return bool(len(part) >= LEAST and DIGIT.search(part) and LETTER.search(part)
                    and not known_value(part) and dense(part))

    def random_parts(text: str, start: int, end: int) -> list[tuple[int, int]]:
        part = text[start:end]
        if len(part) < LEAST or not DIGIT.search(part) or not LETTER.search(part) or known_value(part):
            return []
        if dense(part):
            return [(start, end)]
        out, group = [], []
        for m in [*PIECE.finditer(text, start, end), None]:
            if m and dense(m[0]):
                group.append(m.span())
                continue
            if group and is_random(text[group[0][0]:group[-1][1]]):
                out.append((group[0][0], group[-1][1]))
            else:
                out += [(a, b) for a, b in group if is_random(text[a:b])]
            group = []
        return out

    def scan(text: str) -> list[tuple]:
        """(kind, start, end, secret) by start, then kind."""
        found = []
        low = text.lower()
        if any(w in low for w in ASSIGN_WORDS):
            found += [("assign", m.start(), m.end(), True) for m in ASSIGN.finditer(text)
                      if m.end(2) - m.start(2) >= ASSIGN_LEAST]
        if "AKIA" in text:
            found += [("access", m.start(), m.end(), True) for m in ACCESS.finditer(text)
                      if m.end() - m.start() >= ACCESS_LEAST]
        found += [("hex", m.start(), m.end(), m.end() - m.start() not in DIGEST_LENGTHS
                   and LETTER.search(m[0]) is not None and DIGIT.search(m[0]) is not None)
                  for m in HEX.finditer(text)]
        if DIGIT.search(text):
            taken = [(s, e) for _, s, e, _ in found] + [m.span() for m in INNER.finditer(text) if known_value(m[0])]
            for m in RUN.finditer(text):
                found += [("random", a, b, True) for s, e in uncovered(m.start(), m.end(), taken)
                          for a, b in random_parts(text, s, e)]
        return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))

    return scan


def scan_secrets(docs: DataFrame, ranks_path: str, pattern: str, *, max_ratio: float = 2.2,
                 redact: str | None = None) -> DataFrame:
    """``(doc_id, spans)``, or with ``redact`` the whole of ``docs`` with every
    secret span of ``text`` replaced by that string (and ``n_chars``, if there,
    set anew where a text changed).

    A span has kind, start, end (code points, end exclusive) and ``secret``:
    false for a hex run that is a known digest's length or a plain number. One
    row comes back for each row of ``docs``; a null text is empty, its row has
    no spans and keeps its null. ``ranks_path`` is a tiktoken rank file that
    the driver reads; it is of fixed size and goes to the executors with the
    function.
    """
    with open(ranks_path, "rb") as f:
        blob = docs.sparkSession.sparkContext.broadcast(f.read())
    if redact is None:
        def spans(batches):
            scan = scanner(blob.value, pattern, max_ratio)
            for batch in batches:
                out = [[dict(zip(("kind", "start", "end", "secret"), s, strict=True)) for s in scan(t or "")]
                       for t in batch.column(1).to_pylist()]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                           ("end", pa.int32()), ("secret", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

        return docs.select("doc_id", "text").mapInArrow(spans, f"doc_id long, spans {SPANS}")

    def mask(batches):
        scan = scanner(blob.value, pattern, max_ratio)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, sizes = [], []
            for t in batch.column(at).to_pylist():
                parts, done = [], 0
                for _, start, end, secret in scan(t or ""):
                    if secret and end > done:
                        parts += [t[done:start], redact] if start >= done else []
                        done = end
                texts.append("".join(parts) + t[done:] if parts else t)
                sizes.append(len(texts[-1]) if parts else None)
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if (k := batch.schema.get_field_index("n_chars")) >= 0:
                old = batch.column(k).to_pylist()
                new = [o if s is None else s for o, s in zip(old, sizes, strict=True)]
                batch = batch.set_column(k, batch.schema.field(k), pa.array(new, batch.schema.field(k).type))
            yield batch

    return docs.mapInArrow(mask, docs.schema)


def span_list(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_spans(found: DataFrame) -> DataFrame:
    """Counts by base kind, digest of the base spans and all spans, per row."""
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(span_list(of(*KINDS[:3])), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))
