"""Secret scans: pattern matches, and candidates confirmed by the structure they decode to."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "ssh")  # spans of one start are listed in this order

DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,}+")
HEADER = re.compile(r"e[wy][A-Za-z0-9_-]")  # an opening brace, and then a quote or white space
JSON_KEY = re.compile(r'\{\s*+"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*+:', re.DOTALL)  # how an object that is not empty begins
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,40})-----((?:[^-]|-(?!----))*+)-----END \1-----")
PEM_HEADER = re.compile(r"([A-Za-z][A-Za-z0-9-]*):\s*(.*)")
PEM_LINE = re.compile(r"""(?:[\s"'`#>*|;]|//(?=\s)|\+(?=\s|$))*+([A-Za-z0-9+/=_\s-]*+)(?:["'`][\s+,;.\\&)]*|\\)?""")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
# a line break with the quotes or comment marks around it, and lines of base64 or hex between such breaks
# (possessive, so that long runs of blanks are read once)
LINE_BREAK = re.compile(r"""(?:["'][ \t]*+[+,.]?+)?+[ \t]*+\\?+[ \t]*+\r?\n[ \t"'#>*|]*+(?://[ \t]++|\+[ \t]*+\r?\n[ \t"']*+)?""")
LEAST_LINE = 20
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST_LINE},}}+(?:{LINE_BREAK.pattern}[A-Za-z0-9+/_-]++)++={{0,2}}")
DER_START = re.compile(r"M[A-P]|30")  # a sequence in base64 and in hex
LONG_HEX = re.compile(r"[0-9a-fA-F]{80,}")
BREAK_ESCAPE = re.compile(r"\\+(?:[nrt]|u000[aAdD9]|x0[aAdD9])")
OTHER_ESCAPE = re.compile(r"\\+(?:u00(2[bBfF]|3[dD])|(/))")
# fixed values: algorithm names of signed tokens, key names of the SSH wire format, DER tags and object identifiers
ALGORITHMS = frozenset("HS256 HS384 HS512 RS256 RS384 RS512 ES256 ES384 ES512 ES256K PS256 PS384 PS512 EdDSA none".split())
SSH_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
SSH_PRIVATE = b"openssh-key-v1\x00"
SSH_START = re.compile("|".join(base64.b64encode(raw)[: len(raw) * 4 // 3].decode() for raw in (SSH_PRIVATE, *(len(n).to_bytes(4, "big") + n for n in SSH_NAMES))))
SEQUENCE, INTEGER, OCTETS, OBJECT_ID = 0x30, 0x02, 0x04, 0x06
MAX_DEPTH = 8


def decoded(text: str) -> bytes | None:
    """A base64 (either alphabet, padding optional) or hex text's bytes; None if it is neither."""
    text = re.sub(r"\s+", "", text)
    if len(text) % 2 == 0 and re.fullmatch(r"[0-9a-fA-F]+", text):
        return bytes.fromhex(text)
    bare = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, depth: int = 0) -> list[tuple[int, object]] | None:
    """DER values that fill ``data`` exactly, (tag, bytes or nested list); None where a length does not fit."""
    items: list[tuple[int, object]] = []
    at = 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            count = size & 0x7F
            if not 1 <= count <= 4 or at + count > len(data) or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + count], "big"), at + count
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        body, at = data[at : at + size], at + size
        nested = der_items(body, depth + 1) if tag & 0x20 and depth < MAX_DEPTH else body
        if nested is None:
            return None
        items.append((tag, nested))
    return items


def is_private_der(data: bytes) -> bool:
    """A private key in DER: one sequence that holds a small version number, and then the numbers of a key, an octet
    string, or an algorithm's object identifier with an octet string."""
    if data[:1] != bytes([SEQUENCE]):
        return False
    top = der_items(data)
    if not top or len(top) != 1 or not isinstance(top[0][1], list):
        return False
    parts = top[0][1]
    if not parts or parts[0][0] != INTEGER or parts[0][1] not in (b"\x00", b"\x01"):
        return False
    rest = parts[1:]
    if len(rest) >= 5 and all(tag == INTEGER and body for tag, body in rest):
        return True  # the numbers of an RSA or DSA key
    if rest and rest[0][0] == OCTETS and len(rest[0][1]) >= 16:
        return True  # the number of an elliptic-curve key
    algorithm = rest[0][1] if rest else None
    return (
        isinstance(algorithm, list)
        and bool(algorithm)
        and algorithm[0][0] == OBJECT_ID
        and len(rest) >= 2
        and rest[1][0] == OCTETS
        and len(rest[1][1]) >= 16
    )


def ssh_strings(data: bytes) -> list[bytes] | None:
    """Strings of the SSH wire format (4 bytes of length each) that fill ``data`` exactly."""
    found, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        found.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return found


def is_ssh_key(data: bytes) -> bool:
    """An SSH private key container, or a key blob whose first string names its type and whose lengths nest."""
    if data.startswith(SSH_PRIVATE):
        rest = data[len(SSH_PRIVATE) :]
        size = int.from_bytes(rest[:4], "big")
        return len(rest) >= 4 and 0 < size <= len(rest) - 4 and rest[4 : 4 + size].isascii()
    if not any(data[4 : 4 + len(n)] == n and int.from_bytes(data[:4], "big") == len(n) for n in SSH_NAMES):
        return False
    parts = ssh_strings(data)
    return parts is not None and len(parts) >= 2 and all(parts)


def is_whole_ssh_key(data: bytes) -> bool:
    """An SSH key with nothing missing or left over: of a container, the strings of its public and private keys too."""
    if not data.startswith(SSH_PRIVATE):
        return is_ssh_key(data)
    at = len(SSH_PRIVATE)
    for _ in range(3):  # the names of the cipher and of the key derivation, and its options
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    count = int.from_bytes(data[at : at + 4], "big")
    parts = ssh_strings(data[at + 4 :])
    return is_ssh_key(data) and parts is not None and count > 0 and len(parts) == count + 1


def json_object(text: bytes) -> dict | None:
    """The object that a JSON text is; None if it is not one."""
    try:
        found = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def headers_at_end(part: str, places: list[int]) -> Iterator[tuple[int, dict]]:
    """(place, header) for the places from which a part's rest is base64 of a JSON object that names a signing algorithm.

    The part is decoded once for each of the four alignments, and a candidate is read only as far as its own closing brace.
    """
    scanned: dict[int, str] = {}
    reader = json.JSONDecoder()
    for place in places:
        first = place % 4
        if first not in scanned:
            scanned[first] = (decoded(part[first:]) or b"").decode("latin-1")
        text, at = scanned[first], (place - first) // 4 * 3
        if not JSON_KEY.match(text, at):
            continue
        try:
            _, stop = reader.raw_decode(text, at)
        except (ValueError, RecursionError):
            continue
        if text[stop:].strip(" \t\r\n"):
            continue
        header = json_object(text[at:].encode("latin-1"))
        if header and header.get("alg") in ALGORITHMS:
            yield place, header


def unescaped(text: str) -> str:
    """The text with escaped line breaks and tabs (as in JSON or environment strings) as blanks of the same length."""
    return BREAK_ESCAPE.sub(lambda m: " " * (len(m[0]) - 1) + ("\n" if m[0][-1] in "naA" else " "), text) if "\\" in text else text


def pem_parts(body: str) -> tuple[dict[str, str], str] | None:
    """Header lines and payload of an armoured body, quotes and comment marks around its lines left out; None if
    another line lies in it."""
    body = OTHER_ESCAPE.sub(lambda m: m[2] or chr(int(m[1], 16)), unescaped(body))
    headers: dict[str, str] = {}
    payload: list[str] = []
    after_header = False
    for line in body.splitlines():
        bare = line.strip(" \t\"'`#>*|;\\")
        header = PEM_HEADER.match(bare)
        if header:
            headers[header[1].lower()] = header[2]
        elif m := PEM_LINE.fullmatch(line):
            payload.append(m[1])
        elif not (after_header and line[:1] in " \t"):
            return None
        after_header = bool(header) or (after_header and bool(bare))
    return headers, "".join(payload)


def is_pem_key(label: str, body: str) -> bool:
    parts = pem_parts(body) if "PRIVATE KEY" in label else None
    if parts is None:
        return False
    headers, payload = parts
    data = decoded(payload)
    if data is None or not data:
        return False
    if headers.get("proc-type", "").replace(" ", "").endswith(",ENCRYPTED"):
        cipher = headers.get("dek-info", "").split(",")[0].strip()
        # encrypted, so only the cipher's blocks can be checked
        return bool(cipher) and len(data) >= 32 and (len(data) % 8 == 0 or not cipher.endswith("CBC"))
    if label.startswith("OPENSSH"):
        return is_ssh_key(data)
    return is_private_der(data) or (label.startswith("ENCRYPTED") and data[:1] == b"\x30" and der_items(data) is not None)


def signed_tokens(text: str) -> Iterator[tuple[str, int, int]]:
    """Tokens among dotted names; a header may start at any place of a part, as a name may stand before it."""
    for run in DOTTED.finditer(text):
        parts, starts = run[0].split("."), [run.start()]
        for part in parts:
            starts.append(starts[-1] + len(part) + 1)
        i = 0
        while i + 2 < len(parts):
            at = None
            if HEADER.match(parts[i + 1]) and json_object(decoded(parts[i + 1]) or b"") is not None:
                places = [m.start() for m in HEADER.finditer(parts[i])]
                signed = bool(parts[i + 2])
                at = next((p for p, h in headers_at_end(parts[i], places) if signed or h["alg"] == "none"), None)
            if at is None:
                i += 1
            else:
                yield "jwt", starts[i] + at, starts[i + 2] + len(parts[i + 2])
                i += 3


def der_size(head: bytes) -> int | None:
    """Bytes of the DER value that begins with ``head``."""
    if head[:1] != bytes([SEQUENCE]) or len(head) < 2:
        return None
    count = head[1] & 0x7F if head[1] & 0x80 else 0
    return 2 + count + int.from_bytes(head[2 : 2 + count], "big") if count else 2 + head[1]


def key_kind(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "der" if is_private_der(data) else "ssh" if is_ssh_key(data) else None


def wrapped_keys(text: str) -> Iterator[tuple[str, int, int]]:
    """Keys wrapped over lines without armour. A key starts at a line's start, and ends where its own length says,
    or with the lines of one width and a shorter one after them."""
    for run in WRAPPED.finditer(text):
        edges = [run.start()]
        for m in LINE_BREAK.finditer(text, run.start(), run.end()):
            edges += m.span()
        edges.append(run.end())
        lines = list(zip(edges[::2], edges[1::2], strict=True))
        for i, (start, stop) in enumerate(lines[:-1]):
            if stop - start < LEAST_LINE:
                continue
            ends = set()
            if DER_START.match(text, start):
                size = der_size(decoded(text[start : start + 12]) or b"")
                left = 0 if size is None else 2 * size if text.startswith("30", start) else -(-8 * size // 6)
                j = i
                while j < len(lines) and left > 0:
                    left -= len(text[slice(*lines[j])].rstrip("="))
                    j += 1
                if left == 0:
                    ends.add(j - 1)
            elif SSH_START.match(text, start):
                other = next((j for j in range(i + 1, len(lines)) if lines[j][1] - lines[j][0] != stop - start), len(lines))
                ends = {other - 1, min(other, len(lines) - 1)}
            for j in sorted(j for j in ends if j > i):
                data = decoded("".join(text[a:b] for a, b in lines[i : j + 1]))
                kind = key_kind(data)
                if kind == "der" or kind and is_whole_ssh_key(data):
                    yield kind, start, lines[j][1]
                    break


def structural(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans whose content decodes to a key or a signed token."""
    if "ey" in text or "ew" in text:
        yield from signed_tokens(text)
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            if is_pem_key(m[1], m[2]):
                yield "pem", m.start(), m.end()
    forms = {text, unescaped(text)}
    wrapped = {span for form in forms for span in wrapped_keys(form)}
    yield from wrapped
    whole = {(kind, start) for kind, start, _ in wrapped}
    for form in forms:
        for pattern in (BASE64, LONG_HEX):
            for m in pattern.finditer(form):
                kind = key_kind(decoded(m[0]))
                if kind and (kind, m.start()) not in whole:  # not the first line of a wrapped key
                    yield kind, m.start(), m.end()


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost matches that do not overlap, per kind; a match that is too short is dropped."""
    for m in ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= LEAST["assign"]:
            yield "assign", m.start(), m.end()
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        for m in pattern.finditer(text):
            if m.end() - m.start() >= LEAST[kind]:
                yield kind, m.start(), m.end()


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All (kind, start, end) of a whole text in code points, end exclusive, by start and then kind; none for NULL."""
    text = text or ""
    found = {*base_spans(text), *structural(text)}
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id and ``found``, an array of (kind, start, end, sha256 of the secret's text).

    Texts are read whole. Base kinds are plain patterns; jwt, pem, der and ssh are reported only if the candidate
    decodes and its nested lengths, key encoding or token header hold. The secrets themselves are not passed on. NULL and
    empty texts have an empty array; repeated rows and NULL ids keep their rows; other columns are not read.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                rows = spans(text)
                digest = [hashlib.sha256(text[a:b].encode("utf-8", "surrogatepass")).hexdigest() for _, a, b in rows]
                found.append([{"kind": k, "start": a, "end": b, "sha256": d} for (k, a, b), d in zip(rows, digest, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=["id", "found"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, found array<struct<kind:string,start:bigint,end:bigint,sha256:string>>"
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, spans and their hash per row of ``scan``."""

    def line(kinds: tuple[str, ...]):
        some = F.filter("found", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.expr(f"cast(size(filter(found, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE_KINDS]
    return scanned.select("doc_id", *counts, F.sha2(line(BASE_KINDS), 256).alias("base_sha256"), line(KINDS).alias("spans"))
