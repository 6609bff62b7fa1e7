"""The contracts of the training-data queries in plain Python, for small tables only."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile("[^ \t-\r]+")
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            digits = "".join(c for c in m[0] if c in "0123456789")
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),  # noqa: B023
                "card": lambda: 12 <= len(digits) <= 19 and _luhn(digits),  # noqa: B023
                "phone": lambda: 9 <= len(digits) <= 15,  # noqa: B023
            }[kind]()
            if ok:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def op2(docs):
    out = {}
    for i, text in docs.items():
        spans = base_spans(text)
        n = Counter(kind for kind, _, _ in spans)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        out[i] = (n["email"], n["ip"], n["card"], n["phone"], sha(joined))
    return out


def shingles(text: str | None) -> set[tuple[str, ...]]:
    own = words((text or "").translate(LOWER))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return set(zip(*(own[k:] for k in range(5)), strict=False))


def op3(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}
    links = Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(docs)
    for at, i in enumerate(order):
        for j in order[at + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i), links[i]) for i in docs}


def op5(docs, length: int = 100):
    seen, out = set(), {}
    for i in sorted(docs):
        data = (docs[i] or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            part = data[at : at + length]
            if part in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(part)
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), sum(gone), runs, sha(kept))
    return out


def op8(docs):
    groups: dict[str, list[int]] = {}
    for i, text in docs.items():
        groups.setdefault((text or "").translate(LOWER), []).append(i)
    return {
        i: (max(ids), len(ids), i == max(ids), sha(text))
        for text, ids in groups.items()
        for i in ids
    }


def op9(docs, encoding):
    out = {}
    for i, text in docs.items():
        ids = encoding.encode_ordinary(text or "")
        out[i] = (len(ids), sha(" ".join(map(str, ids))), sha(text or ""))
    return out


def crc32(text: str | None) -> int:
    return zlib.crc32((text or "").encode())


def clean_lines(text: str | None, boilerplate: tuple[str, ...]) -> tuple[str, bool]:
    """Text of the lines that stay, and whether the document does."""
    own, good, kept = words(text), [], 0
    for line in (text or "").split("\n"):
        n, low = len(words(line)), line.lower()
        ends = re.search("[.!?…][\"'”’»)\\]]*([ \t-\r]|$)", line)
        menu = re.findall("(?:^|[ \t-\r])[|>»·•/]+(?:$|[ \t-\r])", line)
        if (
            n
            and ends
            and 100 * len(re.findall("[!?][!?]", line)) < 30 * n
            and 100 * sum(line.count(c) for c in "#*$%&|<>") < 30 * n
            and 100 * len(menu) < 20 * n
            and not (n <= 40 and any(p in low for p in boilerplate))
        ):
            good.append(line)
            kept += n
    windows = list(zip(own, own[1:], own[2:], strict=False))
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    stays = len(own) >= 50 and 100 * len(repeated) <= 50 * len(own)
    return "\n".join(good), stays and 100 * (len(own) - kept) <= 50 * len(own)
