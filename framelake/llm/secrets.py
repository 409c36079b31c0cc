"""Secret scans: an Aho-Corasick pass over keywords, anchored patterns at its hits, then checks of what a match embeds.

Long runs of hex digits have no keyword; they are found by one vectorised pass for runs of a byte
class. The scan keeps no state between texts, so it is one pass without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import _text as T

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
_JWT_RUN = re.compile(rb"[A-Za-z0-9_-]+")
PEM = re.compile(rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
PEM_END = re.compile(rb"-----END (?:[A-Z]+ )*PRIVATE KEY-----")
KINDS = ("assign", "access", "hex", "checked", "jwt", "pem")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: fixed values: lower-cased keywords and the pattern that each one anchors
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign", "akia": "access",
            "ghp_": "checked", "gho_": "checked", "ghu_": "checked", "ghs_": "checked", "ghr_": "checked", "npm_": "checked", "eyj": "jwt", "-----begin ": "pem"}
_NOT_HEX = np.ones(256, bool)
_NOT_HEX[[*b"0123456789abcdef"]] = False
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_tail(body: bytes) -> str:
    """Six base-62 digits of the CRC-32, as such tokens carry at their end."""
    n, out = zlib.crc32(body), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = _BASE62[r] + out
    return out


def _json_part(part: bytes) -> bool:
    """Whether the part is a JSON object; what is nested deeper than Python's parser goes is none."""
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4))), dict)
    except (ValueError, RecursionError):
        return False


def automaton():
    out = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        out.add_word(word, (len(word), kind))
    out.make_automaton()
    return out


def _at(kind: str, raw: bytes, start: int, end: int) -> tuple[int, bool] | None:
    """The end of the match that begins at ``start`` and whether it holds; None where none does."""
    if kind == "assign":
        m = ASSIGN.match(raw, start, end)
        return m and (m.end(), m.end(2) - m.start(2) >= MIN_ASSIGN)
    if kind == "access":
        m = ACCESS.match(raw, start, end)
        return m and (m.end(), m.end() - m.start() >= MIN_ACCESS)
    if kind == "checked":
        m = CHECKED.match(raw, start, end)
        return m and (m.end(), crc_tail(m[1]).encode() == m[2])
    if kind == "jwt":
        m = JWT.match(raw, start, end)
        return m and (m.end(), _json_part(m[1]) and _json_part(m[2]))
    m = PEM.match(raw, start, end)
    stop = m and PEM_END.search(raw, m.end(), end)
    return stop and (stop.end(), True)


def find(array: pa.Array, machine=None):
    """For each text, its spans (start, kind, end) in code points, by start and then kind."""
    machine = machine or automaton()
    for first, last, data, offsets in T.chunks(array):
        found: list[list] = [[] for _ in range(last - first)]
        raw = data.tobytes()
        hits = [(stop + 1 - n, kind) for stop, (n, kind) in machine.iter(T.LOWER[data].tobytes().decode("latin-1"))]
        if hits:
            hits.sort()
            place = np.searchsorted(offsets, [h[0] for h in hits], "right") - 1
            done: dict = {}
            for (at, kind), i in zip(hits, place.tolist(), strict=True):
                if at < done.get((kind, i), 0):
                    continue
                got = _at(kind, raw, at, int(offsets[i + 1]))
                if got:
                    done[kind, i] = got[0]
                    if got[1]:
                        found[i].append((at, kind, got[0]))
                elif kind == "jwt":
                    done[kind, i] = _JWT_RUN.match(raw, at, int(offsets[i + 1])).end()  # what fails here fails at each later hit of the run
                elif kind == "pem" and PEM.match(raw, at):
                    done[kind, i] = int(offsets[i + 1])  # nothing ends such a block from here on
        starts, ends = T.spans(data, offsets, _NOT_HEX)
        long = ends - starts >= MIN_HEX
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            found[int(np.searchsorted(offsets, a, "right")) - 1].append((a, "hex", b))
        for i, spans in enumerate(found):
            if not spans:
                yield []
                continue
            zero = int(offsets[i])
            points = np.concatenate([[0], np.cumsum(T.code_points(data[zero : offsets[i + 1]]))])
            yield sorted(((int(points[a - zero]), k, int(points[b - zero])) for a, k, b in spans), key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def _scan(batches):
    machine = automaton()
    for b in batches:
        counts, base, everything = {k: [] for k in KINDS}, [], []
        for spans in find(b.column("text"), machine):
            for k in KINDS:
                counts[k].append(sum(s[1] == k for s in spans))
            told = [f"{k}:{a}:{e}" for a, k, e in spans]
            everything.append(",".join(told))
            base.append(hashlib.sha256(",".join(t for t, s in zip(told, spans, strict=True) if s[1] in KINDS[:3]).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(base, pa.string()), pa.array(everything, pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, a count for each kind, base_sha256 and spans (kind:start:end, comma-joined).

    Spans are code points, end exclusive, by start and then in the order of KINDS; within a kind
    they are leftmost and don't overlap, and a match that fails its check is dropped but still
    covers its stretch. Null and empty texts have none, an empty table gives no row. Ids, null or repeated, pass through;
    other columns, whatever they are called, are ignored. Long texts are read whole. A token part nested deeper than the
    JSON parser goes fails its check.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan, f"doc_id {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string")
