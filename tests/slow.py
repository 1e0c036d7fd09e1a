"""Plain readings of the cutting rules, byte by byte, to check the jobs against."""

import random

ALPHABET = ["a", "bc ", "é", "漢", "😀", "\n", "\n", "\n\n", "\r\n", "\r\n\r\n", ". ", "x" * 40, "`q` ", "must "]


def texts(count: int, seed: int = 7):
    pick = random.Random(seed)
    for n in range(count):
        size = pick.choice([3, 30, 200, 900, 2500])
        weights = [pick.random() ** 3 for _ in ALPHABET]
        yield "".join(pick.choices(ALPHABET, weights, k=size)) or "a"
    yield "y" * 9000
    yield "é" * 5000
    yield "ab\n" * 4000
    yield ("z" * 5000 + "\n") * 2 + "tail"
    yield "漢" * 1400 + "\n" + "w" * 300


def floor(data: bytes, at: int) -> int:
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def parts(data: bytes, lo: int = 0, hi: int | None = None):
    hi = len(data) if hi is None else hi
    if hi - lo <= 4096:
        return [(lo, hi)]
    ends = [i + 1 for i in range(lo, hi) if data[i] == 10 and i + 1 < hi] + [hi]
    out, at = [], lo
    while at < hi:
        fits = [e for e in ends if at < e <= at + 4096]
        late = [e for e in fits if e >= at + 2048]
        cut = late[0] if late else fits[-1] if fits else floor(data, at + 4096)
        out.append((at, cut))
        at = cut
    return out


def merged(segments):
    out = []
    for lo, hi in segments:
        if out and hi - lo < 512:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def overlapped(data: bytes, segments):
    out, before = [], None
    for lo, hi in segments:
        if before is not None:
            left = max(0, before - 2048)
            window = data[left:max(left, before - 2)]
            lf, crlf = window.rfind(b"\n\n"), window.rfind(b"\r\n\r\n")
            if max(lf, crlf) >= 0:
                start = left + max(lf, crlf) + (2 if lf > crlf else 4)
            elif b"\n" in window:
                start = left + window.rfind(b"\n") + 1
            else:
                start = max(0, before - 256)
            lo = min(lo, start)
        out.append((lo, hi))
        before = hi
    return out


def ranges(data: bytes, soft: int, hard: int, overlap: int):
    out, at, end = [], 0, len(data)
    lines = [i for i, b in enumerate(data) if b == 10]
    while at < end:
        goal = min(at + soft, end)
        near = [i for i in lines if max(at + 1, goal - 2048) <= i <= min(end - 1, goal + 2048) - 1]
        cut = min(near, key=lambda i: (abs(i - goal), i)) + 1 if near else goal
        cut = min(cut, at + hard)
        out.append((at, cut))
        if cut >= end:
            break
        at = cut - overlap if cut - overlap > at else cut
    return out


def point(data: bytes, at: int):
    head = data[:at]
    return head.count(b"\n"), at - (head.rfind(b"\n") + 1)
