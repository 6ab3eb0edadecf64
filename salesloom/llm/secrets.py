"""Secrets in texts by dictionary-primed zstandard novelty.

Base patterns (assignments, access keys, long hexadecimal runs) are always
reported.  Other long mixed strings are candidates if a sensitive word stands
shortly before them, or if they go on where such a candidate ends (lines of a
key, parts of a web token); their worth is what they add to the compressed size
of the text around them, with a compressor primed by code and identifiers.  It is
held against what random strings of the same length and alphabet add there, so
the cut is the same for hexadecimal and base64, short and long.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import column, ship, table

LEAST_NOVELTY = 0.85  # added bytes for each byte that a random string of that alphabet adds
REFERENCES = 2  # random strings that a candidate is held against
AROUND = 200  # code points on either side that count as the surrounding code
NEARBY = 60  # code points before a candidate that are searched for a sensitive word
LEAST_LENGTH = 20
MASK = "[SECRET]"

# Fixed patterns and fixed word lists.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_LENGTH)
# What may stand between two candidates that are one secret: the point of a web token, a line
# end, written out or not, with the quotes and signs of a string that goes on.
_LINE_END = r"""(?:\\r)?(?:\\n)?["']?[\x20\t+\\]*\r?\n[\x20\t+>#*]*["']?"""
JOINT = re.compile(rf"\.|\\(?:r\\)?|{_LINE_END}")
KEY_TAIL = re.compile(rf"""(?:\\(?:r\\)?n|{_LINE_END})([A-Za-z0-9+/=]{{1,{LEAST_LENGTH - 1}}})"""
                      r"""(?=[\\rn\s"'+>#*]+-----END)""")
SENSITIVE = re.compile(
    r"\b(?:auth|authorization|bearer|credentials?|private|signature|access|key|pwd|pass|login|"
    r"session|cookie|jwt|secret|token|connection|account_?key|client_?secret)\b",
    re.ASCII | re.IGNORECASE)
ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
DICTIONARY = """
configuration settings_ value_ identifier version_number default_timeout_seconds max_connections
primary_key foreign_key created_at updated_at first_name last_name address phone_number
import export return function class public private static const final void string int long
boolean null none true false self this new def async await try except catch finally raise throw
for while if else elif switch case break continue lambda yield with open read write close print
config settings environment variable getenv process os sys path file name value type key id
user username email host hostname port url uri endpoint database schema table column row index
request response header headers body content content-type application/json text/html charset
utf-8 authorization bearer basic access_key secret_key api_key client_id client_secret password
token refresh_token session cookie connection connection_string server client service account
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 http:// https:// www. .com
.example localhost 127.0.0.1 0.0.0.0 SELECT FROM WHERE INSERT UPDATE DELETE lorem ipsum dolor
example sample test dummy changeme placeholder your_key_here xxxxxxxxxxxxxxxx 00000000000000000
""".encode()

_HEX_RUN = bytes(0x78 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_LONG_RUN = bytes(0x78 if c < 128 and (chr(c).isalnum() or chr(c) in "+/_=-") else 32
                  for c in range(256))


_ALPHABETS = [frozenset(a) for a in (
    "0123456789abcdef", "0123456789ABCDEF", string.hexdigits, string.ascii_uppercase + "234567",
    string.digits + string.ascii_lowercase, string.digits + string.ascii_uppercase,
    string.digits + string.ascii_letters)]


def alphabet(value: str) -> bytes:
    """The usual alphabet a string is drawn from, with the signs it holds."""
    held = set(value.rstrip("="))
    plain = {c for c in held if c.isalnum()}
    if sum(c.isalpha() for c in plain) <= 2:
        usual = plain | set(string.digits)
    else:
        usual = next(a for a in _ALPHABETS if plain <= a)
    return "".join(sorted(usual | held)).encode()


def random_strings(value: str) -> list[bytes]:
    """``REFERENCES`` random strings, always the same, of a string's length and alphabet."""
    signs = alphabet(value)
    fold = bytes(signs[c % len(signs)] for c in range(256))
    return [random.Random(len(value) * REFERENCES + k).randbytes(len(value)).translate(fold)
            for k in range(REFERENCES)]


class Novelty:
    def __init__(self) -> None:
        primed = zstandard.ZstdCompressionDict(DICTIONARY, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(
            level=6, dict_data=primed, write_checksum=False, write_content_size=False,
            write_dict_id=False)

    def _added(self, text: str, start: int, end: int, values: list[bytes]) -> list[int]:
        """Compressed bytes that each value adds to the surroundings of text[start:end]."""
        around = (text[max(0, start - AROUND):start] + text[end:end + AROUND]).encode(
            "utf-8", "surrogatepass")
        without = len(self.compressor.compress(around))
        return [max(0, len(self.compressor.compress(around + v)) - without) for v in values]

    def __call__(self, text: str, start: int, end: int) -> float:
        """Marginal compressed bytes of text[start:end] beside its surroundings, per byte."""
        value = text[start:end].encode("utf-8", "surrogatepass")
        return self._added(text, start, end, [value])[0] / len(value)

    def of_candidate(self, text: str, start: int, end: int) -> tuple[float, float]:
        """The same of an ASCII string, and as a share of what random strings like it add."""
        value = text[start:end]
        own, *others = self._added(text, start, end, [value.encode(), *random_strings(value)])
        return own / len(value), own * len(others) / max(1, sum(others))


def secret_spans(text: str, novelty: Novelty) -> list[tuple[int, int, str, bool, float]]:
    """(start, end, kind, base, novelty) by start; code points, end exclusive."""
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    found: list[tuple[int, int, int, str, bool]] = []
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end(), "assign", True)
                  for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end(), "access", True)
                  for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if b"x" * 32 in raw.translate(_HEX_RUN):
        found += [(m.start(), 2, m.end(), "hex", True) for m in HEX.finditer(text)]
    taken = [(f[0], f[2]) for f in found]
    out = [(s, p, e, k, b, novelty(text, s, e)) for s, p, e, k, b in found]
    if b"x" * LEAST_LENGTH in raw.translate(_LONG_RUN):
        taken.sort()
        k = 0
        reach = -1  # the farthest end of a base span that starts before the candidate ends
        context = -1  # the end of the last candidate in sensitive context, or of a base span in one
        for m in CANDIDATE.finditer(text):
            while k < len(taken) and taken[k][0] < m.end():
                reach = max(reach, taken[k][1])
                k += 1
            if reach > m.start():
                context = max(reach, m.end())
                continue
            if not (SENSITIVE.search(text[max(0, m.start() - NEARBY):m.start()])
                    or 0 <= context and JOINT.fullmatch(text, context, m.start())):
                continue
            context = m.end()
            value = m[0]
            if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
                continue
            worth, share = novelty.of_candidate(text, m.start(), m.end())
            if share >= LEAST_NOVELTY:
                out.append((m.start(), 3, m.end(), "novel", False, worth))
                if tail := KEY_TAIL.match(text, m.end()):  # the short last line of a key
                    out.append((tail.start(1), 3, tail.end(1), "novel", False,
                                novelty(text, tail.start(1), tail.end(1))))
    return [(s, e, k, b, w) for s, _, e, k, b, w in sorted(out)]


SPANS = "array<struct<start:bigint,end:bigint,kind:string,base:boolean,novelty:double>>"
_SPAN_TYPE = pa.list_(pa.struct([
    ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_()),
    ("novelty", pa.float64())]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, found): the secret spans of every row's whole text.

    NULL texts count as empty.  Each row gives one row, repeated or not; other
    columns are ignored; an empty table gives no row.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        names = ("start", "end", "kind", "base", "novelty")
        for batch in batches:
            spans = [[dict(zip(names, s)) for s in secret_spans(t.as_py() or "", novelty)]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, _SPAN_TYPE)], ["doc_id", "found"])

    return docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text")
    ).mapInArrow(run, f"doc_id long, found {SPANS}")


def masked(text: str, spans: list[tuple[int, int, str, bool, float]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by ``MASK``."""
    parts, at = [], 0
    for start, end, *_ in spans:
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text`` and ``n_chars``, if there, brought up to date.

    All other columns and rows stay as they are, NULL texts too.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def mask(texts):
        novelty = Novelty()
        return texts.map(lambda t: t if t is None else masked(t, secret_spans(t, novelty)))

    clean = docs.withColumn("text", mask(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(
            F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("n_chars")))
    return clean


def spans_text(found: Column) -> Column:
    return F.array_join(F.transform(
        found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                     s["end"].cast("string"))), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of whole texts, one row per row of ``documents``."""
    found = find_secrets(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(spans_text(F.filter("found", lambda s: s["base"])), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"), number("novel").alias("n_novel"),
        F.round(F.aggregate("found", F.lit(0.0), lambda a, s: F.greatest(a, s["novelty"])), 6)
        .alias("top_novelty"),
    )
