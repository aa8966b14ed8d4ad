"""Secret scan: fixed patterns plus sliding-window Shannon entropy.

Base kinds (leftmost, non-overlapping per kind, failing matches dropped):
``assign`` a key word, ``:`` or ``=`` and a value of six or more characters;
``access`` ``AKIA`` and upper-case letters or digits, 20 or more characters;
``hex`` 24 or more of ``[0-9a-f]``.

The method adds ``entropy`` spans.  Candidates are runs of at least ``WINDOW``
characters of ``[A-Za-z0-9+/_=-]``.  A window of ``WINDOW`` characters moves
over the candidate; its character counts, and the sum of ``c * log2 c`` over
them, change by one character in and one out, so each step costs the same
whatever the window.  The window's character class sets the entropy it must
reach: ``hex`` digits only, ``mixed`` with a digit and letters, or ``letters`` of
both cases without a digit, which must also hold ``LEAST_PAIRS`` neighbours of
two capitals and as many of a small letter and a capital (joined words hold few
of the former).  Overlapping windows that reach it form one span.  A single kind
of character (only letters of one case, only digits) is prose or a number and
never reaches it.  Labelled digests give no span, nor does what lies in a URL
before its ``?`` or ``#`` however long the URL is (values after them are scanned
like other text), nor do spans that a base span covers.
Other allow-listed pieces are cut out of a candidate and what is left of it is
scanned: UUIDs; a placeholder or alphabet run, with the part between ``=`` signs
that it stands in if all of that lies within ``WINDOW`` characters of such words,
and alone otherwise; and the plain words between slashes, where a candidate with
three slashes or more is mostly such words (a path; ``/`` is a base64 digit too).

Offsets count code points, the end is exclusive.  Defined cases: a null or
empty text has no span; repeated rows are scanned alike; extra columns are
ignored (``scan``) or kept (``redact``).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import fields, in_arrow, slices, table, text_frame

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
LEAST_BITS = {"hex": 3.0, "mixed": 3.6, "letters": 3.6}
LEAST_PAIRS = 3
MASK = "[SECRET]"

_assign = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_access = re.compile(r"AKIA[A-Z0-9]+")
_hex = re.compile(r"[0-9a-f]+")
_candidate = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
_uuid = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_placeholder = re.compile(r"(?ai:example|sample|placeholder|dummy|changeme|your[_-]|0123456789|abcdefghij|1234567890)")
_sample_key = re.compile(r"[A-Za-z0-9+/]{30}EXAMPLEKEY")     # the key of the AWS manuals
_part = re.compile(r"[^=]+=*")
_word = re.compile(r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z]+)[0-9]{0,4}|[0-9]+|[A-Za-z0-9]{1,3}")
_labelled = re.compile(r"(?ai:(sha-?(1|224|256|384|512)|md5|crc32|commit|etag|integrity)[-:=\s]{1,3}$)")
_url = re.compile(r"(?ai:(https?|ftp|file)://[^\s\"'<>?#]*)")
_CLASS = np.zeros(256, bool)
_CLASS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_HEX = frozenset("0123456789abcdefABCDEF")
_XLOGX = [0.0, *[c * log2(c) for c in range(1, WINDOW + 2)]]   # a character comes in before one goes out


def _long_run(text: str) -> bool:
    """Whether some run of candidate characters is WINDOW long (every access,
    hex or entropy span lies in one)."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    breaks = np.flatnonzero(~_CLASS[raw])
    edges = np.concatenate(([-1], breaks, [len(raw)]))
    return bool((np.diff(edges) > WINDOW).any())


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def entropy_spans(s: str) -> list[tuple[int, int]]:
    """Merged windows of ``s`` whose entropy reaches their class's least bits."""
    n = len(s)
    if n < WINDOW:
        return []
    count: dict[str, int] = {}
    kinds = [0, 0, 0, 0]
    total, odd = 0.0, 0                       # sum of c * log2 c; characters that are no hex digit
    of = [_kind(c) for c in s]
    capitals = humps = 0                      # neighbours of two capitals, of a small letter and a capital
    out: list[list[int]] = []
    for i, c in enumerate(s):
        k = count.get(c, 0)
        total += _XLOGX[k + 1] - _XLOGX[k]
        count[c] = k + 1
        kinds[of[i]] += 1
        odd += c not in _HEX
        if i and of[i] == 1:
            capitals += of[i - 1] == 1
            humps += of[i - 1] == 0
        if i >= WINDOW:
            d = s[i - WINDOW]
            k = count[d]
            total += _XLOGX[k - 1] - _XLOGX[k]
            count[d] = k - 1
            kinds[of[i - WINDOW]] -= 1
            odd -= d not in _HEX
            if of[i - WINDOW + 1] == 1:
                capitals -= of[i - WINDOW] == 1
                humps -= of[i - WINDOW] == 0
        if i < WINDOW - 1:
            continue
        if kinds[2]:
            fits = kinds[0] > 0 or kinds[1] > 0
        else:
            fits = capitals >= LEAST_PAIRS and humps >= LEAST_PAIRS
        if fits:
            bits = log2(WINDOW) - total / WINDOW
            if bits >= LEAST_BITS["hex" if not odd else "mixed" if kinds[2] else "letters"]:
                start = i - WINDOW + 1
                if out and start <= out[-1][1]:
                    out[-1][1] = i + 1
                else:
                    out.append([start, i + 1])
    return [(a, b) for a, b in out]


def _candidates(text: str) -> Iterator[re.Match]:
    """Candidates that are neither labelled digests nor begin in a URL before its
    query; one pass over the URLs beside the candidates."""
    urls = _url.finditer(text)
    url = next(urls, None)
    for m in _candidate.finditer(text):
        while url is not None and url.end() < m.start():
            url = next(urls, None)
        if url is not None and url.end(1) < m.start():
            continue
        if not _labelled.search(text[max(0, m.start() - 16):m.start()]):
            yield m


def _allowed(run: str) -> list[tuple[int, int]]:
    """Pieces of a candidate that are no secret: placeholders and the words of a path."""
    out = []
    if _placeholder.search(run):
        for part in _part.finditer(run):
            words = [(part.start() + m.start(), part.start() + m.end()) for m in _placeholder.finditer(part[0])]
            at = part.start()
            for a, b in words:
                if a - WINDOW <= at:
                    at = max(at, b + WINDOW)
            if words and (at >= part.start() + len(part[0].rstrip("=")) or _sample_key.fullmatch(part[0])):
                out.append(part.span())
            else:
                out += words
    if run.count("/") >= 3:
        plain, at, total = [], 0, 0
        for piece in run.split("/"):
            words = [w for w in re.split("[_=-]+", piece) if w]
            if words and all(map(_word.fullmatch, words)):
                plain.append((at, min(at + len(piece) + 1, len(run))))
                total += len(piece)
            at += len(piece) + 1
        if len(plain) >= 3 and 2 * total >= len(run) - run.count("/"):
            out += plain
    return sorted(out)


def candidate_spans(run: str) -> list[tuple[int, int]]:
    """Entropy spans of a candidate, allow-listed pieces cut out."""
    out, at = [], 0
    for a, b in [*_allowed(run), (len(run), len(run))]:
        if a > at and not _uuid.fullmatch(run, at, a):
            out += [(at + x, at + y) for x, y in entropy_spans(run[at:a])]
        at = max(at, b)
    return out


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and added spans, each as (kind, start, end) in order."""
    if not text:
        return [], []
    base: list[tuple[str, int, int]] = []
    if ":" in text or "=" in text:
        base += [("assign", *m.span()) for m in _assign.finditer(text) if len(m[2]) >= 6]
    if not _long_run(text):
        return base, []
    if "AKIA" in text:
        base += [("access", *m.span()) for m in _access.finditer(text) if m.end() - m.start() >= 20]
    base += [("hex", *m.span()) for m in _hex.finditer(text) if m.end() - m.start() >= 24]
    base.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    more, at, reach = [], 0, 0                # reach: largest end of the base spans that began
    for m in _candidates(text):
        for a, b in candidate_spans(m[0]):
            a, b = a + m.start(), b + m.start()
            while at < len(base) and base[at][1] <= a:
                reach = max(reach, base[at][2])
                at += 1
            if b > reach:
                more.append(("entropy", a, b))
    return base, more


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows = []
            for text in part.column(1).to_pylist():
                base, more = find(text)
                n = [sum(k == x for x, _, _ in base) for k in KINDS]
                both = sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))
                rows.append((*n[:3], len(more), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(both)))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], *[pa.array(c, pa.string()) for c in cols[4:]]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """Span counts and spans of every row of ``docs``."""
    return text_frame(docs).transform(in_arrow, 
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string")


def masked(text: str | None) -> str | None:
    """``text`` with every span (merged where they overlap) replaced by MASK."""
    base, more = find(text)
    if not base and not more:
        return text
    out, at = [], 0
    for _, a, b in sorted(base + more, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` (its columns) with secrets masked in ``text``; ``n_chars``, where
    the table has it, follows the new text of changed rows."""
    cols = list(docs.columns)
    at = cols.index("text")
    n_at = cols.index("n_chars") if "n_chars" in cols else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                old = part.column(at).to_pylist()
                new = [masked(t) for t in old]
                arrays = list(part.columns)
                arrays[at] = pa.array(new, part.schema.field(at).type)
                if n_at is not None:
                    n = part.column(n_at).to_pylist()
                    arrays[n_at] = pa.array([c if a is b or a == b else len(b) for a, b, c in zip(old, new, n, strict=True)],
                                            part.schema.field(n_at).type)
                yield pa.RecordBatch.from_arrays(arrays, names=part.schema.names)

    return docs.transform(in_arrow, run, fields(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
