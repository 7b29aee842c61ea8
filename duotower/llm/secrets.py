"""Operator 10, secret scans: three pattern kinds, and random strings by token efficiency.

Ordinary words need few tokens under a public vocabulary; random strings need many, so their characters per token are
low. A run of at least ``min_chars`` characters of ``[A-Za-z0-9+/_=-]`` that holds a letter, and that is no known digest
or identifier of token-efficient words, is reported as ``random`` if it has fewer than ``max_ratio`` characters per
token. If the words around a random string lift the run's ratio (a path before a token), its segments between ``/=+_-``
are tested by themselves: neighbouring segments that are no words form a group, reported by the same rule. Base64 contents
of data URIs and of certificates are left alone.

Everything is a function of one text, so the scan is one pass without a shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import columns, tokenizer_file

VOCABULARY = "byte_bpe_50k.tiktoken"
MIN_CHARS = 20
MAX_RATIO = 2.0
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")      # maximal runs of 24 and more
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_DATA_URI = re.compile(r"data:[A-Za-z0-9.+-]++/[A-Za-z0-9.+-]++(?:;(?!base64,)[A-Za-z0-9=.-]++)*+;base64,[A-Za-z0-9+/=_-]*+")
_CERTIFICATE = re.compile(r"-----BEGIN CERTIFICATE-----[A-Za-z0-9+/=\s]*+-----END CERTIFICATE-----")
# Not secrets although they look random: digests by their length in hex digits, UUIDs, DNA, and plain numbers or dates.
_KNOWN = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
                    r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128}"
                    r"|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|sha(?:1|256|384|512)-[A-Za-z0-9+/]+=*"
                    r"|[ACGTNacgtn]+|[0-9_+/=-]+)")
# snake_case, kebab-case, paths and camelCase: parts of three or more letters or short numbers (possessive, so linear time)
_IDENTIFIER = re.compile(r"(?:[_/=+-]*+(?:[A-Z]?+[a-z]{3,}+|[A-Z]{3,}+|[0-9]{1,4}+(?![0-9])))*+[_/=+-]*+")
# the same with parts of any length, if every segment is a short number or letters of one case (clarinet-lh-d-key)
_ONE_CASE = re.compile(r"(?:[_/=+-]*+(?:[A-Z]?+[a-z]++|[A-Z]++|[0-9]{1,4}+)(?![A-Za-z0-9]))*+[_/=+-]*+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]+")
_SEGMENT = re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![A-Za-z0-9])|[A-Za-z0-9]+")    # a UUID is one
_BRIDGE = 4         # word-like segments of fewer characters may stand inside a group (x and 7 in x9K/x/q7+7/Zr)

_ENCODINGS: dict[str, object] = {}


def encoding(vocabulary: str):
    """The tiktoken vocabulary of this Python worker."""
    if vocabulary not in _ENCODINGS:
        import base64

        import public_tokenizers
        import tiktoken

        with open(tokenizer_file(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[vocabulary] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[vocabulary]


def word_parts(s: str, enc, max_ratio: float) -> bool:
    """True if the run is an identifier: its parts are words or short numbers, and the words are token-efficient."""
    if not (_IDENTIFIER.fullmatch(s) or _ONE_CASE.fullmatch(s)):
        return False
    words = _WORD.findall(s)
    # the vocabulary has few words in capitals, so those count by the better of both cases
    tokens = sum(min(len(enc.encode_ordinary(x)) for x in ({w, w.lower()} if w.isupper() else {w})) for w in words)
    return sum(map(len, words)) >= max_ratio * tokens


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three pattern kinds."""
    out = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(name in low for name in _NAMES):
            out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return out


def excluded_spans(text: str) -> list[tuple[int, int, int]]:
    """Encoded contents that are no secrets: inline data and certificates."""
    out = [(m.start(), 3, m.end()) for m in _DATA_URI.finditer(text)] if ";base64," in text else []
    if "-----BEGIN CERTIFICATE-----" in text:
        out += [(m.start(), 3, m.end()) for m in _CERTIFICATE.finditer(text)]
    return out


class Covers:
    """Whether a span lies within one of some others, by their starts and the greatest end so far."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        spans = sorted(spans)
        self.starts = [a for a, _, _ in spans]
        self.ends = list(accumulate((b for _, _, b in spans), max))

    def __call__(self, start: int, end: int) -> bool:
        k = bisect_right(self.starts, start) - 1
        return k >= 0 and self.ends[k] >= end


def random_spans(text: str, base: list[tuple[int, int, int]], enc, min_chars: int, max_ratio: float) -> list[tuple[int, int, int]]:
    """Runs, or else groups of their segments, with few characters per token that no base span, inline data or certificate covers."""
    out = []
    covered = Covers(base + excluded_spans(text))

    def is_random(start: int, end: int) -> bool:
        s = text[start:end]
        if len(s) < min_chars or not re.search("[A-Za-z]", s) or covered(start, end):
            return False
        return len(s) < max_ratio * len(enc.encode_ordinary(s)) and not _KNOWN.fullmatch(s) and not word_parts(s, enc, max_ratio)

    for m in _CANDIDATE.finditer(text):
        if is_random(*m.span()):
            out.append((m.start(), 3, m.end()))
        elif len(m[0]) > min_chars and not _KNOWN.fullmatch(m[0]) and not covered(*m.span()):
            out += [(a, 3, b) for a, b in odd_groups(text, m.start(), m.end(), enc, max_ratio) if is_random(a, b)]
    return out


def odd_groups(text: str, start: int, end: int, enc, max_ratio: float) -> list[tuple[int, int]]:
    """Spans of neighbouring segments of a run that are no words; short words between two such segments count to them."""
    groups: list[list[int]] = []
    joined = False      # only short words since the last group
    for m in _SEGMENT.finditer(text, start, end):
        s = m[0]
        if _KNOWN.fullmatch(s) or word_parts(s, enc, max_ratio):
            joined = joined and len(s) < _BRIDGE
        elif joined:
            groups[-1][1] = m.end()
        else:
            groups.append([m.start(), m.end()])
            joined = True
    return [(a, b) for a, b in groups]


def scan_text(text: str | None, enc, min_chars: int = MIN_CHARS, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    """All spans of a text, by start and then kind."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + random_spans(text, base, enc, min_chars, max_ratio))


def redact(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with every union of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def secrets(text: Column, vocabulary: str = VOCABULARY, min_chars: int = MIN_CHARS, max_ratio: float = MAX_RATIO, mark: str = "[SECRET]") -> Column:
    """struct(spans, redacted) of a text column; ``redacted`` is null where there is no span. Null texts are empty."""
    if min_chars < 20:
        raise ValueError("min_chars below the 20 characters of a candidate run")

    @F.arrow_udf("struct<spans: array<struct<kind: string, start: int, end: int>>, redacted: string>")
    def scan(col: pa.Array) -> pa.Array:
        enc = encoding(vocabulary)
        spans, clean = [], []
        for x in col:
            t = x.as_py()
            found = scan_text(t, enc, min_chars, max_ratio)
            spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found])
            clean.append(redact(t, found, mark) if found else None)
        return pa.StructArray.from_arrays([pa.array(spans, pa.list_(_SPAN)), pa.array(clean, pa.string())], ["spans", "redacted"])

    return scan(text)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """(doc_id, spans, redacted) of every document.

    Spans are in code points, end exclusive, whole matches; sorted by start, then kind. Base kinds are leftmost and
    non-overlapping each; spans of different kinds may overlap. Defined results: null or empty texts have no spans;
    repeated rows and null ids give one row each; an empty table gives no rows; other columns are ignored.
    """
    docs = columns(docs, doc_id=id_col, text=text_col)
    found = docs.select("doc_id", secrets(F.col("text"), **kw).alias("found"))
    return found.select("doc_id", "found.spans", "found.redacted")


def redact_documents(docs: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The same columns with secrets in ``text_col`` replaced; texts without secrets stay as they are."""
    names = docs.columns
    found = "_".join(["found", *names])     # a name that no column has
    out = docs.withColumn(found, secrets(F.col(f"`{text_col}`"), **kw)["redacted"])
    return out.select(*[F.coalesce(F.col(found), F.col(f"`{n}`")).alias(n) if n == text_col else F.col(f"`{n}`") for n in names])


def span_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of some kinds, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
