"""Secret scan by patterns and by assignment-aware lexing.

Base patterns (kinds assign, access, hex) are found as leftmost matches. The lexer
then reads source and configuration syntax (name = literal, name: literal, "name":
literal, name => literal, adjacent or added strings, references to other names)
into pairs, propagates constants from name to name within a text, over any number of
assignments, and scores each
literal by how sensitive the names it reaches are and by how random it looks.
Literals that score at least THRESHOLD become spans of kind pair. Ends are
exclusive; places count code points.

Nulls: a null text is empty and has no spans. Ties: of assignments of one literal the
one that scores most counts. Repeated rows each give a row; ids pass through
unchanged, null ones too. Texts of any length are scanned whole, names and chains of
names of any length too, in time in proportion to the text: a literal without quotes
is the whole of what follows an operator up to a blank or a sign of syntax, and other
operators inside it don't count, but parameters of a URL do. Other columns, whatever their names, are passed by. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

KINDS = ("assign", "access", "hex", "pair")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Maps bytes to h if they are hex digits, to a dot otherwise, to see whether a text has a long run at all.
IS_HEX = bytes(104 if chr(i) in "0123456789abcdef" else 46 for i in range(256))

OPERATOR = re.compile(r"=>|:=|\+=|(?<![=!<>+*/%&|^:-])=(?![=>~])|:(?![:/=])")
NAME_CHAR, NAME_START, KEY_CHAR = re.compile(r"[\w$.-]"), re.compile(r"[A-Za-z_$]"), re.compile(r"[\w.-]")
QUOTED = re.compile(r'''[ \t]*(?:[rbuf]{0,2})("""|\'\'\'|["'`])''', re.I)
BARE = re.compile(r"""[ \t]*([^\s"'`#;,(){}\[\]<>|]+)""")
#: A parameter of a URL inside a bare literal.
QUERY = re.compile(r"""[?&]([A-Za-z_$][\w$.-]*)=([^\s"'`#;,(){}\[\]<>|&]+)""")
REFERENCE = re.compile(r"[ \t]*(?:\$\{?|process\.env\.|os\.environ\.)?([A-Za-z_$][\w$.]*)\}?[ \t]*(?=[;,)\]}\r\n#]|$)")
JOINED = re.compile(r"[ \t]*[+.]?[ \t]*\\?\n?[ \t]*(?=[\"'])")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
#: Name parts and how sensitive each makes a name, 0 to 1.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "pass": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "auth": 0.6, "authorization": 0.7, "bearer": 0.8, "private": 0.5, "key": 0.5, "access": 0.4, "api": 0.4, "client": 0.2, "signing": 0.5, "encryption": 0.5, "salt": 0.5, "cookie": 0.4, "session": 0.4,
}
#: Name parts that say the literal is about a secret, and isn't one.
HARMLESS = {"name", "file", "path", "url", "uri", "type", "length", "size", "count", "limit", "max", "min", "id", "policy", "expiry", "expires", "ttl", "field", "label", "hint", "regex", "pattern", "public", "enabled"}
PLACEHOLDER = re.compile(r"^(?:x{4,}|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|your.*|example.*|change.?me.*|dummy.*|test.*|todo.*|none|null|undefined|true|false|redacted|placeholder.*)$", re.I)
#: A literal's least length, and the least sum of its target's score and half its own.
LEAST_LENGTH, THRESHOLD = 8, 1.15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"h" * 32 in text.encode("utf-8", "surrogatepass").translate(IS_HEX):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(out)


def name_score(name: str) -> float:
    """How sensitive a name is, by its parts: 0 to 1."""
    parts = [p.lower() for p in PART.findall(name)]
    score = sum(SENSITIVE.get(p, 0.0) for p in parts)
    if parts and parts[-1] in HARMLESS:
        score *= 0.3
    return min(1.0, score)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret, by length, bits a character and mix of characters: 0 to 1."""
    if len(value) < LEAST_LENGTH or PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    bits = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, 0.35 * min(bits / 3.5, 1.0) + 0.25 * min(n / 20, 1.0) + 0.2 * (kinds - 1))


def _quoted(text: str, at: int, mark: str) -> tuple[int, str] | None:
    """The end of a quoted string whose contents begin at `at`, and its value; None if it doesn't end on its line."""
    i, n, out, long_ = at, len(text), [], len(mark) == 3
    while i < n:
        c = text[i]
        if c == "\\" and i + 1 < n:
            out.append(text[i + 1])
            i += 2
            continue
        if c == mark[0] and text.startswith(mark, i):
            return i, "".join(out)
        if c == "\n" and not long_ and mark != "`":
            return None
        out.append(c)
        i += 1
    return None


def _name_before(text: str, end: int) -> str:
    """The name that ends before `end`, of any length, with the key in brackets after it; empty if there is none."""

    def back(at: int, one: re.Pattern) -> int:
        while at and one.match(text[at - 1]):
            at -= 1
        return at

    while end and text[end - 1] in " \t":
        end -= 1
    key = ""
    if end and text[end - 1] == "]":
        close = end - 1 - (end > 1 and text[end - 2] in "\"'")
        start = back(close, KEY_CHAR)
        key = text[start:close]
        end = start - (start > 0 and text[start - 1] in "\"'")
        if not key or not end or text[end - 1] != "[":
            return ""
        end -= 1
    if end and text[end - 1] in "\"'`":
        end -= 1
    start = back(end, NAME_CHAR)
    if start == end or not NAME_START.match(text[start]):
        return ""
    return text[start:end] + ("." + key if key else "")


def pairs(text: str) -> list[tuple[str, str, int, int, str | None]]:
    """(name, literal, start, end, None) or (name, "", start, end, reference) of each assignment in text."""
    out = []
    past = 0
    for m in OPERATOR.finditer(text):
        if m.start() < past:
            continue  # inside the literal before
        target = _name_before(text, m.start())
        if not target:
            continue
        if q := QUOTED.match(text, m.end()):
            start = q.end()
            if not (got := _quoted(text, start, q[1])):
                continue
            end, value = got
            while (j := JOINED.match(text, end + len(q[1]))) and j[0].strip(" \t"):
                mark = text[j.end()]
                if not (got := _quoted(text, j.end() + 1, mark)):
                    break
                end, value = got[0], value + got[1]
                q = QUOTED.match(text, j.end())
            out.append((target, value, start, end, None))
            past = end + 1
        elif (r := REFERENCE.match(text, m.end())) and not any(c.isdigit() for c in r[1]):
            out.append((target, "", r.start(1), r.end(1), r[1]))
            out.append((target, r[1], r.start(1), r.end(1), None))  # or a bare word of a configuration file
        elif b := BARE.match(text, m.end()):
            out.append((target, b[1], b.start(1), b.end(1), None))
            out += [(x[1], x[2], x.start(2), x.end(2), None) for x in QUERY.finditer(text, b.start(1), b.end(1))]
            past = b.end(1)
            if (r := REFERENCE.match(text, m.end())) is not None:
                out.append((target, "", r.start(1), r.end(1), r[1]))
    return out


def pair_spans(text: str) -> list[tuple[int, int, int]]:
    if "=" not in text and ":" not in text:
        return []
    found = pairs(text)
    if not found:
        return []
    literals = [p for p in found if p[4] is None]
    # How sensitive the names are that a name reaches: its own, and those that refer to it, through other names too.
    # Told from the most sensitive names back to what they read, so that each name is met once.
    reads: dict[str, list[str]] = {}
    for target, _, _, _, ref in found:
        if ref is not None:
            reads.setdefault(target, []).append(ref)
    reached: dict[str, float] = {}
    scores = {name: name_score(name) for name in {p[0] for p in found}}
    for name in sorted(scores, key=scores.__getitem__, reverse=True):
        edge = [name]
        while edge:
            if (x := edge.pop()) not in reached:
                reached[x] = scores[name]
                edge += reads.get(x, ())
    best: dict[tuple[int, int], float] = {}
    for target, value, start, end, _ in literals:
        looks = literal_score(value)
        if looks == 0:
            continue
        score = reached[target] + looks / 2 if reached[target] else 0.0
        best[start, end] = max(best.get((start, end), 0.0), score)
    return [(start, 3, end) for (start, end), s in best.items() if s >= THRESHOLD]


def spans(text: str) -> list[tuple[int, int, int]]:
    """All (start, kind, end), by start, then kind."""
    return sorted(base_spans(text) + pair_spans(text))


def told(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.small_batches(batches, "text"):
        counts: list[list[int]] = [[], [], [], []]
        digests, all_ = [], []
        for text in common.strings(b.column(1)):
            found = spans(text)
            for k in range(4):
                counts[k].append(sum(x[1] == k for x in found))
            digests.append(hashlib.sha256(told([x for x in found if x[1] < 3]).encode()).hexdigest())
            all_.append(told(found))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array(digests, pa.string()), pa.array(all_, pa.string()), pa.array(counts[3], pa.int64())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_pair"],
        )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans of every row."""
    common.prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_pair long"
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
