"""Operator 3, secret scans by structural confirmation.

Patterns propose base spans (assignments, access key ids, hex runs). Base64, base64url and hex candidates are
decoded as well, and reported only if the bytes have the structure of a key: DER with nested lengths that fill
their parents exactly, an OpenSSH key blob, or a signed token whose header and payload are JSON. A key may start
anywhere in a run of such characters, and its lines may be wrapped, by escapes (\\n) and joined strings as well; its
own lengths tell where it ends.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import map_texts, sha256

# The kinds in the order in which they are listed in results, and the patterns of the base kinds.
KINDS = ["assign", "access", "hex", "pem", "der", "ssh", "jwt"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
# End of the fixed values.

ASSIGN_WORDS = ("passw", "secret", "token", "api")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
PEM_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:")
PEM_MARKS = re.compile(r"[ \t]*[\"'][ \t]*[+.,]?[ \t]*\\?(?=\r?$)|^[ \t]*(?:[\"'#>*;]+[ \t]*)?|\\(?=\r?$)", re.MULTILINE)
ESCAPE = re.compile(r"\\+(?:u00(2[bB]|2[fF]|3[dD])|([nrt])|/)")
DEK = re.compile(r"[A-Z0-9-]+,[0-9A-Fa-f]{16,}")
TOKEN_PART = re.compile(r"[A-Za-z0-9_-]{14,}")
TOKEN_REST = re.compile(r"\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
# A header is a JSON object, after white space perhaps.
TOKEN_START = re.compile(r"e(?=[w-z0-9])|[ICD]")
# DER starts with a SEQUENCE tag, OpenSSH blobs with their magic.
DER_START = {64: re.compile(r"M(?=[A-P][A-Za-z0-9+/_-]{10})"), 16: re.compile(r"30(?=[0-9A-Fa-f]{16})")}
SSH_START = {64: re.compile(r"b3BlbnNzaC1rZXktdjEA"), 16: re.compile(r"6f70656e7373682d6b65792d763100", re.IGNORECASE)}
CHUNK = {64: re.compile(r"[A-Za-z0-9+/_-]+"), 16: re.compile(r"[0-9A-Fa-f]+")}
GAP = re.compile(r"\\+(?=/)|(?:[\"'][ \t]*[+.,]?)?(?:\\+[nrt]|\s|\\(?=\s))+(?:[\"'>#][ \t]*)?")
JSON_MARK = re.compile(r'["{}\[\]]')
PADDING = re.compile("={0,2}")
LEAST_CHARS = {64: 40, 16: 64}
SSH_MAGIC = b"openssh-key-v1\0"
#: The longest names, options and blobs of OpenSSH keys, in bytes; those in use are far shorter.
SSH_NAME, SSH_OPTIONS, SSH_BLOB = 64, 4096, 1 << 14
#: Levels of nested DER elements; keys have less than ten.
MAX_DEPTH = 16
INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def children(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) elements that fill `data` exactly, or None if its lengths do not add up."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + n], "big")
            at += n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        found.append((tag, data[at : at + size]))
        at += size
    return found


def nested(data: bytes, depth: int = 0) -> bool:
    """True if every constructed element below is filled exactly by its children."""
    parts = children(data)
    return parts is not None and depth < MAX_DEPTH and all(nested(x, depth + 1) for tag, x in parts if tag & 0x20)


def is_der_key(data: bytes) -> bool:
    """A private key: PKCS#1 RSA or DSA (a version and five integers or more), SEC1 EC, or PKCS#8, encrypted or not."""
    top = children(data)
    if not top or len(top) != 1 or top[0][0] != SEQUENCE or not nested(data):
        return False
    parts = children(top[0][1]) or []
    tags = [tag for tag, _ in parts]
    if tags == [SEQUENCE, OCTETS]:  # with parameters: without them it is a digest
        return [tag for tag, _ in children(parts[0][1]) or []] == [OID, SEQUENCE] and len(parts[1][1]) >= 16
    if len(tags) < 2 or tags[0] != INTEGER or len(parts[0][1]) != 1:
        return False
    if len(tags) >= 6 and all(tag == INTEGER for tag in tags[:6]):
        return all(x for _, x in parts[:6])
    if tags[1] == OCTETS:
        return parts[0][1] == b"\1" and len(parts[1][1]) >= 16
    inner = children(parts[1][1]) if tags[1] == SEQUENCE else None
    return bool(inner) and inner[0][0] == OID and len(tags) >= 3 and tags[2] == OCTETS


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key: the magic, then cipher, KDF and KDF options by length, and at least one key blob."""
    return ssh_sizes(data) is not None


def ssh_layout(data: bytes) -> tuple[int, int, int]:
    """(needed, public, whole) of the OpenSSH private key that `data` starts with: the bytes that tell more (0: it is
    none, or nothing more is needed), the size without its private part, and the size with it; 0 where not known."""
    if not data.startswith(SSH_MAGIC):
        return 0, 0, 0
    at = len(SSH_MAGIC)

    def field(most: int, least: int = 0) -> int:
        """Where the next field ends; -1 if no key has such a field."""
        size = int.from_bytes(data[at : at + 4], "big")
        return at + 4 + size if len(data) >= at + 4 and least <= size <= most else -1

    for most in (SSH_NAME, SSH_NAME, SSH_OPTIONS):
        if len(data) < at + 4:
            return at + 4, 0, 0
        if (at := field(most)) < 0:
            return 0, 0, 0
    if len(data) < at + 4:
        return at + 4, 0, 0
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    for _ in range(keys if 1 <= keys <= 16 else 0):
        if len(data) < at + 4:
            return at + 4, 0, 0
        if (at := field(SSH_BLOB, 1)) < 0:
            return 0, 0, 0
    if not 1 <= keys <= 16:
        return 0, 0, 0
    if len(data) < at + 4:
        return at + 4, at if len(data) >= at else 0, 0
    end = at + 4 + int.from_bytes(data[at : at + 4], "big")
    return (0, at, 0) if end == at + 4 or end - at > SSH_BLOB else (end, at, end)


def ssh_sizes(data: bytes) -> tuple[int, int | None] | None:
    """The sizes of the OpenSSH private key that `data` starts with, without its private part and (None if that is cut
    off) with it; None if it is none."""
    _, public, whole = ssh_layout(data)
    return (public, whole if whole <= len(data) and whole else None) if public else None


def unpack(text: str, url: bool = False) -> bytes | None:
    text = "".join(text.split()).rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "ssh" if is_ssh_key(data) else "der" if data[0] == SEQUENCE and is_der_key(data) else None


def taken(text: str, at: int, base: int, wanted: int) -> tuple[str, list[int]]:
    """The next `wanted` characters of a base, or as many as there are, beyond line ends; and by line, where in the
    text it ends, up to those characters."""
    parts, stops, held = [], [], 0
    while m := CHUNK[base].match(text, at, at + wanted - held):
        parts.append(m[0])
        held += len(m[0])
        stops.append(m.end())
        gap = GAP.match(text, m.end()) if held < wanted else None
        if not gap:
            break
        at = gap.end()
    return "".join(parts), stops


def decoded(text: str, base: int) -> bytes:
    """The bytes of the characters of a base, without what is left over at the end."""
    if base == 16:
        return bytes.fromhex(text[: len(text) // 2 * 2])
    text = text.replace("-", "+").replace("_", "/")
    return base64.b64decode(text[: len(text) - (len(text) % 4 == 1)] + "=" * (-len(text) % 4 % 3))


def der_size(head: bytes) -> int | None:
    """The size of the key that may start with these bytes, by its outer length."""
    if head[0] != SEQUENCE:
        return None
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    if head[1] & 0x80 and not 1 <= n <= 4:
        return None
    at = 2 + n
    if head[at] != SEQUENCE and head[at : at + 2] != bytes([INTEGER, 1]):
        return None
    return at + (int.from_bytes(head[2:at], "big") if n else head[1])


def bare_keys(text: str, base: int) -> Iterator[tuple[int, int, int, bool]]:
    """(start, rank of the kind, end, whether on one line) of every key in the characters of a base."""
    chars = lambda size: -(-size * 4 // 3) if base == 64 else size * 2
    over = 0
    for m in DER_START[base].finditer(text):
        at = m.start()
        size = der_size(decoded(text[at : at + 12 if base == 64 else at + 18], base)) if at >= over else None
        if not size or not LEAST_CHARS[base] <= chars(size) <= len(text) - at:
            continue
        found, stops = taken(text, at, base, chars(size))
        if len(found) == chars(size) and is_der_key(decoded(found, base)[:size]):
            over = stops[-1]
            over += len(PADDING.match(text, over)[0]) if base == 64 else 0
            yield at, KINDS.index("der"), over, len(stops) == 1
    for m in SSH_START[base].finditer(text):
        wanted, at = chars(64), m.start()
        while True:  # a few steps, each as far as the lengths read so far tell
            found, stops = taken(text, at, base, wanted)
            data = decoded(found, base)
            needed, public, _ = ssh_layout(data)
            if len(found) < wanted or chars(needed) <= len(found):
                break
            if not public and chars(needed) > len(text) - at:
                break
            wanted = chars(needed)
        sizes = ssh_sizes(data)
        size = sizes and sizes[1]
        if sizes and not size:  # cut off: as far as its line goes, or the lines with its public keys
            size = max(sizes[0], (stops[0] - at) * 3 // 4 if base == 64 else (stops[0] - at) // 2)
        if size and len(found) >= LEAST_CHARS[base]:
            found, stops = taken(text, at, base, min(chars(size), len(found)))
            end = stops[-1]
            yield at, KINDS.index("ssh"), end + (len(PADDING.match(text, end)[0]) if base == 64 else 0), len(stops) == 1


def plain(m: re.Match) -> str:
    return chr(int(m[1], 16)) if m[1] else "\n" if m[2] else "/"


def is_pem_body(body: str) -> bool:
    """True if what stands between the lines of a PEM key is a key, or is encrypted as its header lines say."""
    lines = [x.strip() for x in PEM_MARKS.sub("", ESCAPE.sub(plain, body)).strip().splitlines()]
    heads = 0
    if lines and PEM_HEADER.match(lines[0]):
        heads = lines.index("") if "" in lines else sum(":" in x for x in lines)
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[:heads])}
    packed = "".join(lines[heads:])
    data = unpack(packed, url="-" in packed or "_" in packed)
    if not data:
        return False
    if "ENCRYPTED" in fields.get("proc-type", ""):
        return bool(DEK.fullmatch(fields.get("dek-info", ""))) and len(data) >= 16 and len(data) % 8 == 0
    return key_kind(data) is not None


def pem_keys(text: str) -> Iterator[tuple[int, int, int]]:
    for m in PEM.finditer(text):
        stop = text.find("-----", m.end())
        last = f"-----END {m[1]}-----"
        if stop >= 0 and text.startswith(last, stop) and is_pem_body(text[m.end() : stop]):
            yield m.start(), KINDS.index("pem"), stop + len(last)


def signed_tokens(text: str) -> Iterator[tuple[int, int, int]]:
    """Signed tokens, whose header may start anywhere in the part before the first dot."""
    over = 0
    for m in TOKEN_PART.finditer(text):
        rest = TOKEN_REST.match(text, m.end()) if m.start() >= over else None
        if not rest:
            continue
        part = m[0]
        # the part is decoded once for each number of characters over a multiple of four; a header ends where it ends
        first = {k: (len(part) - k) % 4 for k in (0, 2, 3)}
        data = {k: decoded(part[at:], 64).rstrip(b" \t\r\n").decode("latin-1") for k, at in first.items()}
        ends = {k: object_at_end(x) for k, x in data.items()}
        for start in TOKEN_START.finditer(part):
            at, k = start.start(), (len(part) - start.start()) % 4
            if k == 1 or not ends[k][0] <= (at - first[k]) // 4 * 3 <= ends[k][1]:
                continue
            if is_signed_token(part[at:] + rest[0]):
                over = rest.end()
                yield m.start() + at, KINDS.index("jwt"), over
                break
            ends[k] = (0, -1)  # the other starts differ by white space only


def object_at_end(text: str) -> tuple[int, int]:
    """Where an object that ends with the text must start, if the text from there on is JSON, and the first of the white
    space before it: read once, from the end. (0, -1) if there is none."""
    if not text.endswith("}"):
        return 0, -1
    depth, inside = 0, False
    for at in reversed([m.start() for m in JSON_MARK.finditer(text)]):
        mark = text[at]
        if inside:
            escapes = at
            while escapes and text[escapes - 1] == "\\":
                escapes -= 1
            inside = mark != '"' or (at - escapes) % 2 == 1
        elif mark == '"':
            inside = True
        else:
            depth += 1 if mark in "}]" else -1
            if not depth:
                return (len(text[:at].rstrip(" \t\r\n")), at) if mark == "{" else (0, -1)
    return 0, -1


def is_signed_token(text: str) -> bool:
    header, payload, signature = text.split(".", 2)
    try:
        head, body = (json.loads(unpack(x, url=True) or b"") for x in (header, payload))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    return bool(unpack(signature, url=True)) or head["alg"].lower() == "none"


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of every secret of a text, by start and then kind, in code points."""
    lowered = text.lower()
    found = []
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    pems = list(pem_keys(text)) if "-----BEGIN" in text else []
    for base in (64, 16):
        for start, kind, end, one_line in bare_keys(text, base):
            # a wrapped key between PEM lines is told as such
            if one_line or not any(a <= start < b for a, _, b in pems):
                found.append((start, kind, end))
    found += pems
    found += signed_tokens(text)
    return sorted(set(found))


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every whole text, one row per input row.

    Columns: the id, n_assign, n_access, n_hex, base_sha256 (of the base spans) and spans (all spans). Null and
    empty texts have no spans (empty string, and the digest of nothing); null and repeated ids stay rows of their
    own; other columns are not read, so their names can't clash.
    """

    def prepare():
        def work(texts: list[str]) -> dict:
            every = [secret_spans(x) for x in texts]
            base = [[s for s in spans if s[1] < 3] for spans in every]
            count = lambda kind: [sum(s[1] == kind for s in spans) for spans in base]
            return {
                "n_assign": count(0), "n_access": count(1), "n_hex": count(2),
                "base_sha256": [sha256(spans_text(x).encode()) for x in base], "spans": [spans_text(x) for x in every],
            }

        return work

    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_texts(docs, id_col, text_col, fields, prepare)
