"""Secret scans: fixed patterns, then a test of how badly a tokenizer compresses a string.

Ordinary words take few tokens of a byte-pair vocabulary; random keys fall apart into pieces of one
to two characters. Runs of key characters with few characters per token are reported, with or without
digits, as a whole or by their pieces between separators, so a key behind a path is found as well. Digests,
UUIDs, numbers and dates are not. Short strings need a lower ratio; below eight characters none is tested.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from postquarry.session import ship_package

KINDS = ("assign", "access", "hex", "random")
#: Fixed patterns.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?a:[A-Za-z0-9+/_=-]{8,})")
PIECE = re.compile(r"[A-Za-z0-9]{8,}")
#: Known shapes that are random by nature and no secrets: UUIDs, digests, numbers and dates.
KNOWN = re.compile(
    r"(?ai:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    r"|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9_=+/-]+)"
)
KNOWN_INSIDE = re.compile(rf"(?<![A-Za-z0-9]){KNOWN.pattern}(?![A-Za-z0-9])")
#: (least length, part of the ratio that holds from there).
LIMITS = ((16, 1.0), (12, 0.8), (8, 0.7))


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1 << 16)
def _random(word: str, path: str, pattern: str, max_ratio: float) -> bool:
    """Fewer characters per token than the limit for this length."""
    part = next(part for least, part in LIMITS if len(word) >= least)
    return len(word) / len(_encoding(path, pattern).encode_ordinary(word)) < max_ratio * part


def random_spans(word: str, taken: list[tuple[int, int]], path: str, pattern: str, max_ratio: float) -> list[tuple[int, int]]:
    """(start, end) of a run of key characters: the run, or else its pieces; neighbouring pieces are joined."""
    if KNOWN.fullmatch(word):
        return []
    pieces = [m.span() for m in PIECE.finditer(word)]
    known = [m.span() for m in KNOWN_INSIDE.finditer(word)] if pieces != [(0, len(word))] else []
    taken = taken + [(s, e) for s, e in known if PIECE.search(word, s, e) and re.search("[A-Za-z]", word[s:e])]
    mixed = len(word) >= 16 and re.search("[0-9]", word) and re.search("[A-Za-z]", word)
    if not taken and (pieces or mixed) and _random(word, path, pattern, max_ratio):
        return [(0, len(word))]
    if pieces == [(0, len(word))] and not taken:
        return []
    taken = taken + known
    found: list[tuple[int, int]] = []
    for start, end in pieces:
        if any(s < end and start < e for s, e in taken) or not _random(word[start:end], path, pattern, max_ratio):
            continue
        if found and found[-1][1] + 1 == start and not any(s < start and found[-1][1] < e for s, e in taken):
            start = found.pop()[0]
        found.append((start, end))
    return found


def spans_of(text: str, path: str, pattern: str, max_ratio: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) of one text, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(found)
    for m in CANDIDATE.finditer(text):
        taken = [(s - m.start(), e - m.start()) for s, _, e in base if s < m.end() and m.start() < e]
        found += [(m.start() + s, 3, m.start() + e) for s, e in random_spans(m[0], taken, path, pattern, max_ratio)]
    return sorted(found)


def secret_spans(text: Column, path: str, pattern: str, max_ratio: float = 2.0) -> Column:
    """Array of (start, kind, end) of a text column; code points, end exclusive. Null and empty: none."""

    @pandas_udf("array<struct<start:int,kind:int,end:int>>")
    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: spans_of(t, path, pattern, max_ratio) if t else [])

    return scan(text)


def scan_secrets(
    df: DataFrame, path: str, pattern: str, text: str = "text", max_ratio: float = 2.0, name: str = "secrets"
) -> DataFrame:
    """Add the spans of secrets to every row: one pass, no shuffle, whole texts.

    ``path`` is a tiktoken rank file that every executor can read, ``pattern`` its splitting pattern.
    A fixed pattern keeps its span whatever the token test says; the token test adds only spans that
    touch none of them. Null and empty texts have no spans; rows are kept one to one.
    """
    ship_package(df.sparkSession)
    return df.withColumn(name, secret_spans(F.col(text), path, pattern, max_ratio))


def digest_secrets(scanned: DataFrame, name: str = "secrets", key: str = "doc_id") -> DataFrame:
    kinds = F.array(*map(F.lit, KINDS))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")

    count = lambda k: F.size(F.filter(name, lambda s: s["kind"] == k)).cast("long")
    base = F.filter(name, lambda s: s["kind"] < 3)
    return scanned.select(
        key, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col(name)).alias("spans"),
        count(3).alias("n_random"),
    )
