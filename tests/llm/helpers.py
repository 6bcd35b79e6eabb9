"""Rows that every operator has to take, and brute-force versions to hold the operators against."""

import hashlib
import re

import numpy as np

LONG = "Lorem ipsum dolor sit amet 4111 1111 1111 1111 " * 4000
#: (doc_id, text, and columns whose names clash with what operators make)
EDGES = [
    (1, "Hello, it's a test of the toxic idiot.", 9, "x", 1.0),
    (1, "Hello, it's a test of the toxic idiot.", 9, "x", 1.0),
    (1, "Another text under the same id", 9, "x", 1.0),
    (2, None, None, None, None),
    (3, "", 9, "x", 1.0),
    (None, "A text without an id", 9, "x", 1.0),
    (None, None, 9, "x", 1.0),
    (4, " \t\n\x0b\x0c\r", 9, "x", 1.0),
    (5, LONG, 9, "x", 1.0),
    (6, "é😀的" * 100, 9, "x", 1.0),
    (7, "a" * 20_000, 9, "x", 1.0),
]
SCHEMA = "doc_id long, text string, n_tokens long, spans string, score double"


def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(frame, *columns):
    return sorted((tuple(r) for r in (frame.select(*columns) if columns else frame).collect()), key=str)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def components(n, near):
    """The least member's number of each of n nodes' components, of a function that gives a node's later neighbours."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in near(i):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash_components(ids, prints, bits=3):
    values = np.array(prints, np.uint64)
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    ordered = values[order]
    root = components(len(ids), lambda i: (np.flatnonzero(np.bitwise_count(ordered[i + 1 :] ^ ordered[i]) <= bits) + i + 1).tolist())
    out = [None] * len(ids)
    for at, i in enumerate(order):
        out[i] = ids[order[root[at]]]
    return out


def repeats(documents, span=50):
    """(id, n_bytes, n_removed, n_spans, kept_sha256) by comparing all windows."""
    first = {}
    coded = [(i, (t or "").encode()) for i, t in documents]
    for i, t in sorted((x for x in coded if x[0] is not None), key=lambda x: x[0]):
        for p in range(len(t) - span + 1):
            first.setdefault(t[p : p + span], i)
    out = []
    for i, t in coded:
        gone = bytearray(len(t))
        for p in range(len(t) - span + 1) if i is not None else ():
            if first[t[p : p + span]] < i:
                gone[p : p + span] = b"\1" * span
        runs = len(re.findall(b"\1+", gone))
        out.append((i, len(t), sum(gone), runs, sha(bytes(b for b, x in zip(t, gone) if not x))))
    return sorted(out, key=str)


# The base patterns as the contract states them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def pii_spans(text):
    """[(kind, start, end)] of the four base kinds."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    return found


def redacted(text, spans):
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def edit_stretch(item, words):
    """The least edits between a list and any stretch of another."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)
