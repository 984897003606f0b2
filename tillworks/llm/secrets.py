"""Operator 6, secret scans: patterns, and the token-efficiency test for strings no pattern knows.

Pattern kinds are found in whole texts, leftmost and without overlap within a kind: ``assign`` (a key word, a
separator, a value of 12 or more characters), ``access`` (AKIA and more, 18 or more characters) and ``hex`` (16 or
more lower-case digits). The method adds the kind ``random``: unbroken strings that a tiktoken vocabulary needs
many tokens for, since its merges were learned from words and code. A string counts if it has ``LEAST`` characters
or more, a letter among them, and fewer than ``RATIO`` characters a token (``WORD_RATIO`` for words of one case below
``WORD`` characters, where rare words come near). If a string as a whole doesn't count, its parts between _ - + / are
tested, and then windows of ``WIDTH`` characters by ``WINDOW_RATIO``, so that words around a secret don't hide it. Known
digests (hexadecimal strings of the usual lengths), UUIDs and identifiers (words of one case and numbers, joined by
_ - + /) are left out.

Spans are code points, end exclusive. Defined results: a null or empty text has no spans and the checksum of the
empty string; null ids and repeated rows are rows like any other; an empty table gives an empty result. Only the
id and text columns are read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import in_batches, resident, table

VOCABULARY = "byte_bpe_50k.tiktoken"
LEAST = 16
RATIO = 2.2
WORD = 20
WORD_RATIO = 2.0
WIDTH = 24
STEP = 4
WINDOW_RATIO = 1.8
PIECE = 512  # characters that are encoded at once, so that a string's cost grows with its length
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_KEYS = re.compile(r"pass(?:word|wd)|secret|token|api_?key", re.I | re.A)
# runs too short for their kind can't overlap a long one, so the length is part of these two patterns
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_STRING = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST)
_LONG_PART = re.compile(r"[A-Za-z0-9]{%d,}" % LEAST)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")


def encoding(path: str | None):
    """One per Python worker; None is the public vocabulary where the worker runs."""
    import public_tokenizers

    return resident(("ranks", path), lambda: _load(path or public_tokenizers.path(VOCABULARY)))


def _load(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_known(string: str) -> bool:
    """Digests, UUIDs, and identifiers: several words in one case or numbers, joined."""
    if _UUID.fullmatch(string) or len(string) in _DIGEST_LENGTHS and _DIGEST.fullmatch(string):
        return True
    parts = [p for p in re.split(r"[_/+-]", string.rstrip("=")) if p]
    return len(parts) > 1 and all(_PART.fullmatch(p) for p in parts)


def is_mixed(string: str) -> bool:
    """Letters with digits, or letters that often change case."""
    digit, alpha = any(c.isdigit() for c in string), any(c.isalpha() for c in string)
    return digit and alpha or sum(a.islower() != b.islower() for a, b in zip(string, string[1:])) >= 4


def characters_per_token(string: str, path: str | None = None) -> float:
    encode = encoding(path).encode_ordinary
    return len(string) / sum(len(encode(string[k : k + PIECE])) for k in range(0, len(string), PIECE))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place of the kind, end, kind) sorted."""
    found = []
    if _KEYS.search(text):
        found += [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found)


def is_random(string: str, path: str | None = None, ratio: float = RATIO) -> bool:
    if is_known(string) or not any(c.isalpha() for c in string):
        return False
    short_word = len(string) < WORD and not is_mixed(string)
    return characters_per_token(string, path) < (min(ratio, WORD_RATIO) if short_word else ratio)


def _unmarked(string: str) -> str:
    """UUIDs and digests that are parts of the string are blanked out."""
    string = _UUID.sub(lambda m: "-" * len(m[0]), string)
    return _LONG_PART.sub(lambda m: "-" * len(m[0]) if is_known(m[0]) else m[0], string)


def _inside(string: str, path: str | None, ratio: float) -> list[tuple[int, int]]:
    """Stretches of a string that are random although the whole isn't: parts, then windows of the rest that are joined."""
    parts = [m.span() for m in _LONG_PART.finditer(string) if is_random(m[0], path, ratio)]
    for a, e in parts:
        string = string[:a] + "-" * (e - a) + string[e:]
    out: list[tuple[int, int]] = []
    for k in range(0, max(0, len(string) - WIDTH + STEP), STEP):
        a = min(k, len(string) - WIDTH)
        if a >= 0 and is_random(string[a : a + WIDTH], path, min(ratio, WINDOW_RATIO)):
            if out and a <= out[-1][1]:
                out[-1] = out[-1][0], a + WIDTH
            else:
                out.append((a, a + WIDTH))
    return parts + out


def random_spans(text: str, path: str | None = None, ratio: float = RATIO) -> list[tuple[int, int, int, str]]:
    out = []
    for m in _STRING.finditer(text):
        s = _unmarked(m[0])
        if s == m[0] and is_random(s, path, ratio):
            out.append((m.start(), 3, m.end(), "random"))
        else:
            out += [(m.start() + a, 3, m.start() + e, "random") for a, e in _inside(s, path, ratio)]
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, ratio: float = RATIO) -> DataFrame:
    """(id, found): per document its spans as an array of (kind, start, end, match), by start and kind."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("match", pa.string())]))
        for batch in batches:
            rows = []
            for text in batch.column(1):
                t = text.as_py() or ""
                spans = sorted(base_spans(t) + random_spans(t, path, ratio))
                rows.append([{"kind": k, "start": a, "end": b, "match": t[a:b]} for a, _, b, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=[id_col, "found"])

    in_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        scan, f"`{id_col}` {id_type}, found array<struct<kind:string,start:bigint,end:bigint,match:string>>")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(joined(F.filter("found", lambda x: x["kind"] != "random")), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"))


def op6_secrets(spark, sf_dir):
    return digest(find(table(spark, sf_dir, "documents")))
