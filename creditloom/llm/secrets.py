"""Secret scan: keyword prefilter, anchored expressions near the hits, checksums inside the tokens.

An Aho-Corasick automaton finds every keyword of every kind in one pass over a text. Expressions are tried only at the
hits, anchored there, so a text without keywords costs one pass. Kinds with a built-in checksum or structure count only
if it holds. Hexadecimal runs have no keyword and are found by one expression.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import map_batches

#: Order of kinds among spans with one start.
BASE_KINDS = ["assign", "access", "hex"]
ADDED_KINDS = ["github", "npm", "jwt", "pem"]

# Forms of the kinds, as published by those who issue them.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]*")
JWT_RUN = re.compile(r"[A-Za-z0-9_-]+")
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----")
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"], "access": ["akia"],
    "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], "npm": ["npm_"], "jwt": ["eyj"], "pem": ["-----begin "],
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def keyword_automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def base62(n: int, width: int) -> str:
    digits = ""
    while n:
        n, rest = divmod(n, 62)
        digits = BASE62[rest] + digits
    return digits.rjust(width, "0")


def checksum_holds(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the ones before, in base 62."""
    return base62(zlib.crc32(match[1].encode()), 6) == match[2]


def is_jwt(match: re.Match) -> bool:
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(match[1] + "=" * (-len(match[1]) % 4)))
    except (binascii.Error, ValueError, TypeError):
        return False


#: kind: expression, test of the match
RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 6),
    "access": (ACCESS, lambda m: len(m[0]) >= 20),
    "github": (GITHUB, checksum_holds),
    "npm": (NPM, checksum_holds),
    "jwt": (JWT, is_jwt),
    "pem": (PEM, lambda m: True),
}


def find_secrets(text: str | None, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) in code points, by start, then kind."""
    if not text:
        return []
    hits: dict[str, list[int]] = {}
    for end, (kind, length) in automaton.iter(lowered(text)):
        hits.setdefault(kind, []).append(end - length + 1)
    spans = [("hex", *m.span(), True) for m in HEX.finditer(text)]
    for kind, starts in hits.items():
        form, holds = RULES[kind]
        past = 0
        for start in sorted(set(starts)):
            if start >= past and (m := form.match(text, start)):
                past = m.end()  # a match that fails its test still takes its characters
                if holds(m):
                    spans.append((kind, start, past, kind in BASE_KINDS))
            elif start >= past and kind == "jwt":
                past = JWT_RUN.match(text, start).end()  # no later place of the run can match: it ends in the same way
    order = {kind: i for i, kind in enumerate(BASE_KINDS + ADDED_KINDS)}
    return sorted(spans, key=lambda s: (s[1], order[s[0]]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of secrets per document: ``(id_col, spans)``, spans in code points, end exclusive.

    One row per input row, repeated rows included. A null or empty text has no spans; a null id stays null; other
    columns are not read. No shuffle and nothing held between batches, so a lost task is simply run again.
    """

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        automaton = keyword_automaton()
        keys = ("kind", "start", "end", "base")
        return {id_col: batch.column(0), "spans": [[dict(zip(keys, s, strict=True)) for s in find_secrets(t, automaton)] for t in batch.column(1).to_pylist()]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, F.col(text_col).cast("string")), rows, f"`{id_col}` {kind}, spans {SPANS}")
